"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def pg_concat(*parts: Column) -> Column:
    """Concatenation that skips NULLs; Spark's own ``concat`` would return NULL."""
    return F.concat_ws("", *parts)


def pipe_concat(*parts: Column) -> Column:
    """The ``||`` operator: NULL if any part is NULL."""
    return F.concat(*parts)


def split_part(text: Column, separator: str, n: int) -> Column:
    """n-th part, counted from 1; empty text if there are fewer parts. Searched for as it stands, since
    Spark's own ``split_part`` takes every text apart by a regular expression."""
    if n < 1 or not separator:
        return F.split_part(text, F.lit(separator), F.lit(n))
    if n == 1:
        return F.substring_index(text, separator, 1)
    at = F.locate(separator, text)
    rest = F.substring(text, at + len(separator), F.length(text))
    return F.when(at > 0, split_part(rest, separator, n - 1)).when(at == 0, F.lit(""))


def first_chars(text: Column, n: int) -> Column:
    return F.substring(text, 1, n)


def trim_chars(text: Column, chars: str, where: str = "both") -> Column:
    cut = {"both": F.btrim, "leading": F.ltrim, "trailing": F.rtrim}[where]
    return cut(text, F.lit(chars))


def strip_non_digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def to_text(value: Column) -> Column:
    """Amount as text. Cast to a decimal first: a double would print as 1.0E7."""
    return value.cast("decimal(18,2)").cast("string")


def typed_null(type_name: str) -> Column:
    return F.lit(None).cast(type_name)


def pair_id(owner_id: Column, user_id: Column) -> Column:
    return F.concat_ws(", ", owner_id, user_id)


def has_text(text: Column, pattern: str) -> Column:
    """LIKE pattern test on a note or status column."""
    return text.like(pattern)
