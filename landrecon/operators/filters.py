"""Row filters, with the three-valued logic spelled out."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from landrecon.operators.lookups import attach, with_totals

# Codes and phrases of the declaration forms.
WAITING = "%Wait%"
GENERIC_EXCLUSIONS = ("EXCL", "DELETED_LANDUSE")


def quality_filter(df: DataFrame, year_out: int = 2019) -> DataFrame:
    """Rows with a parcel, a land use, an admitted year and a settled status."""
    return df.filter(
        F.col("hapar_id").isNotNull()
        & (F.col("land_use") != "")
        & (F.col("year") != year_out)
        & ~F.col("application_status").like(WAITING)
    )


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """Drop the rows that meet the condition; a row for which it is unknown stays."""
    return df.filter(~F.coalesce(cond, F.lit(False)))


def zero_exclusion() -> Column:
    """A generic exclusion without area."""
    return F.col("land_use").isin(*GENERIC_EXCLUSIONS) & (
        (F.col("land_use_area") == 0) | F.col("land_use_area").isNull()
    )


def in_list(df: DataFrame, col: str, ref: DataFrame | Iterable[object], ref_col: str | None = None) -> DataFrame:
    """Rows whose value is on the list."""
    if isinstance(ref, DataFrame):
        keys = ref.select(F.col(ref_col or col).alias(col))
        return attach(df, keys, [col], "left_semi")
    return df.filter(F.col(col).isin(*ref))


def off_list(df: DataFrame, col: str, values: Iterable[object]) -> DataFrame:
    """Rows with a known value that is not on the literal list."""
    return df.filter(~F.col(col).isin(*values))


def area_mismatch(df: DataFrame, a: str, b: str, digits: int = 2) -> DataFrame:
    """Rows where ``a``, rounded, differs from ``b``."""
    return df.filter(F.round(F.col(a), digits) != F.col(b))


def ratio_filter(
    df: DataFrame, keys: list[str], measure: str, whole: str, percent: float
) -> DataFrame:
    """Rows of groups whose total of ``measure`` is exactly ``percent`` of the row's whole."""
    total = with_totals(df, keys, {"_total": F.sum(measure)})
    share = F.try_divide(F.col("_total") * 100, F.col(whole))
    return total.filter(share == percent).drop("_total")
