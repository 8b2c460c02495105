"""Array expressions with the source dialect's NULL rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def array_compact(values: Column) -> Column:
    return F.array_compact(values)


def null_if_empty(values: Column) -> Column:
    return F.when(F.size(values) > 0, values)


def array_cat(first: Column, second: Column) -> Column:
    """Concatenation where a missing array counts as empty; NULL only if both are missing."""
    return F.when(
        first.isNotNull() & second.isNotNull(), F.concat(first, second)
    ).otherwise(F.coalesce(first, second))


def array_len(values: Column) -> Column:
    """Length; NULL for an empty or missing array."""
    return F.when(F.size(values) > 0, F.size(values))


def has_element(values: Column, element: object) -> Column:
    return F.array_contains(values, F.lit(element))


def array_text(values: Column, separator: str = ",") -> Column:
    """Array as text, for reports and comparisons."""
    return F.array_join(values.cast("array<string>"), separator)
