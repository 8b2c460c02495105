"""Group results beside their detail rows.

A window over the group would put the whole group into one task. Here the group is reduced
first, with partial sums on the map side, to one row per key, and the detail joins that row.

Adaptive execution can split a hot key's detail rows over many tasks, but only where both
sides of the join come straight out of a shuffle. A lookup that was grouped by the join keys
would not: its rows already lie where the join wants them. All joins with lookups therefore
carry one more key, ``_lane``, which is always 0 and only makes the lookup, the small side,
take a shuffle of its own. A lookup that turns out small is broadcast by its measured size.

Rows that have been laid out by a key beforehand (``session.co_located``), with the hot keys set
apart, need neither the lane nor a shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from landrecon.operators.notes import noted
from landrecon.session import layout


def _with_lane(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumn("_lane", F.pmod(F.xxhash64(*keys), F.lit(1)))


def attach(
    detail: DataFrame, lookup: DataFrame, keys: list[str], how: str = "left", null_safe: bool = False
) -> DataFrame:
    """Join a lookup that has at most one row per key (any number for semi- and anti-joins).
    ``null_safe`` lets NULL keys match. Where both sides lie by one of the keys, and no key is too
    large for a task, the join takes them as they lie."""
    if layout(keys) is not None:
        return _attach_in_place(detail, lookup, keys, how, null_safe)
    left, right = _with_lane(detail, keys), _with_lane(lookup, keys)
    if not null_safe:
        return left.join(right, [*keys, "_lane"], how).drop("_lane")
    marked = right.select(
        [F.col(c).alias(f"_key_{c}" if c in keys or c == "_lane" else c) for c in right.columns]
    )
    cond = F.col("_lane") == F.col("_key__lane")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    extra = [f"_key_{k}" for k in [*keys, "_lane"]]
    return left.join(marked, cond, how).drop("_lane", *extra)


def _attach_in_place(detail: DataFrame, lookup: DataFrame, keys: list[str], how: str, null_safe: bool) -> DataFrame:
    """A bucket is small enough for its lookup to be hashed, so that the detail need not be sorted."""
    lookup = lookup.hint("shuffle_hash")
    if not null_safe:
        return detail.join(lookup, keys, how)
    marked = lookup.select([F.col(c).alias(f"_key_{c}" if c in keys else c) for c in lookup.columns])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    return detail.join(marked, cond, how).drop(*[f"_key_{k}" for k in keys])


def with_totals(
    df: DataFrame, keys: list[str], aggs: dict[str, Column], null_safe: bool = True
) -> DataFrame:
    """Every row with its group's aggregates, as a window over the group would give."""
    lookup = df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in aggs.items()])
    return attach(df, lookup, keys, null_safe=null_safe)


def latest_donor(
    df: DataFrame, keys: list[str], value: str, order: tuple[str, ...] = ("year",)
) -> DataFrame:
    """One known value per key: that of the latest year, the largest if there are several."""
    best = F.max(F.struct(*order, value))
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys)
        .agg(best.alias("_best"))
        .select(*keys, F.col(f"_best.{value}").alias("_donor"))
    )


def update_from(
    df: DataFrame, lookup: DataFrame, keys: list[str], target: str, value: str,
    cond: Column, note: str, text: str,
) -> DataFrame:
    """Take ``value`` from a one-row-per-key lookup where it has one and the condition holds."""
    joined = attach(df, lookup.withColumn("_found", F.lit(True)), keys)
    hit = F.coalesce(F.col("_found"), F.lit(False)) & cond
    changed = joined.withColumns(
        {target: F.when(hit, F.col(value)).otherwise(F.col(target)), note: noted(note, hit, text)}
    )
    return changed.select(*df.columns)


def fill_from_peer(
    df: DataFrame, keys: list[str], target: str, cond: Column, note: str, text: str
) -> DataFrame:
    """Fill a value from another row with the same keys, chosen by ``latest_donor``."""
    return update_from(
        df, latest_donor(df, keys, target), keys, target, "_donor", cond, note, text
    )


def arg_max_ties(df: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """All rows whose measure equals their group's maximum."""
    top = with_totals(df, keys, {"_max": F.max(measure)})
    return top.filter(F.col(measure) == F.col("_max")).drop("_max")
