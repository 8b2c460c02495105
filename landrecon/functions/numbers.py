"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def larger_side(owner: Column, user: Column) -> Column:
    """The larger value; the owner's if the comparison is unknown.

    ``greatest`` is no substitute: it skips NULL and would return the user's value.
    """
    return F.when(user > owner, user).otherwise(owner)


def used_area(claimed: Column, declared: Column) -> Column:
    """Claimed area unless it is zero, else the declared area."""
    return F.when(claimed != 0, claimed).otherwise(declared)


def percent(part: Column, whole: Column) -> Column:
    """Percentage as a double; NULL for a zero or missing whole."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100.0


def round2(value: Column) -> Column:
    """Two decimals, half up, in one rounding of the shortest text of a double."""
    return F.round(value.cast("string").cast("decimal(38,18)"), 2).cast("decimal(18,2)")
