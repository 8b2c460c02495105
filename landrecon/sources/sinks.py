"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from landrecon.sources import versions


def publish(df: DataFrame, path: str, batch: str | None = None) -> DataFrame:
    """Replace the table at ``path`` in one step and return it. Readers see the old table or the new
    one; a killed write leaves the old. ``df`` may read the table itself."""
    return versions.publish(df, path, batch)


def append_rows(base: DataFrame, extra: DataFrame) -> DataFrame:
    """All rows of both; columns are matched by name, absent ones become NULL."""
    return base.unionByName(extra, allowMissingColumns=True)


def append_table(df: DataFrame, path: str, batch: str | None = None) -> DataFrame:
    """Add the rows to the published table. A batch that was applied already is not applied again."""
    return versions.append(df, path, batch)


def export_keys(df: DataFrame, key: str, year: int, path: str | None = None) -> DataFrame:
    """Distinct keys of one year, optionally published at ``path``."""
    keys = df.filter(F.col("year") == year).select(key).distinct()
    return keys if path is None else publish(keys, path)
