"""Keeping or dropping rows by their place in a group.

A filter ``row_number = 1`` is limited per map task before the shuffle, so a hot group sends
one row per task. Filters for later places have no such limit; they compare with the group's
first row instead, found by an ordinary minimum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from landrecon.operators.lookups import arg_max_ties, attach


def first_per_group(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def dedupe(df: DataFrame, columns: list[str], tie: list[str]) -> DataFrame:
    """One row per combination of ``columns``; NULLs count as equal. Ties go to the first."""
    return first_per_group(df, columns, [F.col(c).asc_nulls_last() for c in tie])


def largest_by_group(
    df: DataFrame, keys: list[str], measure: str, tie: list[str], nulls_first: bool = False
) -> DataFrame:
    """The row with the largest measure of each group; ties by ``tie`` ascending."""
    measured = F.col(measure)
    order = measured.desc_nulls_first() if nulls_first else measured.desc_nulls_last()
    return first_per_group(df, keys, [order, *[F.col(c).asc_nulls_last() for c in tie]])


def best_ranked_of_ties(
    df: DataFrame, keys: list[str], measure: str, rank: str, tie: list[str]
) -> DataFrame:
    """Of the rows tied for the group's maximum, the one with the best rank."""
    ties = arg_max_ties(df, keys, measure)
    return first_per_group(ties, keys, [F.col(c).asc_nulls_last() for c in [rank, *tie]])


def extra_parties(df: DataFrame, keys: list[str], party: str) -> DataFrame:
    """Second and later distinct parties of a group, in the order of the party."""
    parties = df.select(*keys, party).distinct()
    first = parties.groupBy(*keys).agg(F.min(party).alias("_first"))
    later = attach(parties, first, keys, how="inner", null_safe=True)
    unknown = F.col(party).isNull() & F.col("_first").isNotNull()
    return later.filter((F.col(party) > F.col("_first")) | unknown).drop("_first")


def repeats(df: DataFrame, columns: list[str], row_id: str) -> DataFrame:
    """All rows of a key combination but the first by ``row_id``, which must be unique."""
    first = df.groupBy(*columns).agg(F.min(row_id).alias("_first"))
    later = attach(df, first, columns, how="inner", null_safe=True)
    return later.filter(F.col(row_id) > F.col("_first")).drop("_first")


def best_tier(pairs: DataFrame, keys: list[str], tier: str = "tier") -> DataFrame:
    """Only the pairs of the best tier among those that share the keys."""
    best = pairs.groupBy(*keys).agg(F.min(tier).alias("_best"))
    kept = attach(pairs, best, keys, how="inner", null_safe=True)
    return kept.filter(F.col(tier) == F.col("_best")).drop("_best")


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def sort_spec(columns: dict[str, str]) -> list[Column]:
    """Sort columns with the source dialect's NULL placement: last ascending, first descending."""
    return [
        F.col(c).desc_nulls_first() if way == "desc" else F.col(c).asc_nulls_last()
        for c, way in columns.items()
    ]
