"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame


def union_distinct(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames).distinct()


def except_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)


def uncovered(a: DataFrame, *others: DataFrame) -> DataFrame:
    """Distinct rows of the first frame that none of the others has."""
    return a.subtract(reduce(DataFrame.unionByName, others))


def audit_view(a: DataFrame, b: DataFrame, cond: Column, order: list[Column]) -> DataFrame:
    """The distinct rows of both tables that meet a condition, sorted. The condition is applied
    to each table before the union."""
    return a.filter(cond).unionByName(b.filter(cond)).distinct().orderBy(*order)
