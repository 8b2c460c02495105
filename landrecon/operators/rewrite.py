"""Row-wise rewrites, each with the note that records it."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from landrecon.functions.numbers import zero_if_null
from landrecon.operators.notes import amount_note, noted

SIDES = ("owner", "user")


def prefix_side(df: DataFrame, columns: Iterable[str], side: str) -> DataFrame:
    """Give the measure columns a side prefix; the other columns keep their names."""
    marked = set(columns)
    return df.select([F.col(c).alias(f"{side}_{c}" if c in marked else c) for c in df.columns])


def one_sided(df: DataFrame, columns: Iterable[str], side: str) -> DataFrame:
    """Rows with one side only: the absent side gets NULLs of the same type as the present."""
    marked = list(columns)
    absent = SIDES[1 - SIDES.index(side)]
    types = {f.name: f.dataType for f in df.schema.fields}
    filler = [F.lit(None).cast(types[c]).alias(f"{absent}_{c}") for c in marked]
    return prefix_side(df, marked, side).select("*", *filler)


def add_null_col(df: DataFrame, name: str, kind: str | T.DataType = "string") -> DataFrame:
    return df.withColumn(name, F.lit(None).cast(kind))


def zero_if_null_cols(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: zero_if_null(F.col(c)) for c in columns})


def abs_cols(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.abs(c) for c in columns})


def swap_sides(df: DataFrame, columns: Iterable[str], cond: Column) -> DataFrame:
    """Exchange the owner's and the renter's values on the rows that meet the condition."""
    changes = {}
    for c in columns:
        for side, other in (SIDES, SIDES[::-1]):
            changes[f"{side}_{c}"] = F.when(cond, F.col(f"{other}_{c}")).otherwise(
                F.col(f"{side}_{c}")
            )
    return df.withColumns(changes)


def promote_side(df: DataFrame, columns: Iterable[str], cond: Column) -> DataFrame:
    """Move the renter's values to the owner's side and leave the renter's side empty."""
    changes = {}
    for c in columns:
        changes[f"owner_{c}"] = F.when(cond, F.col(f"user_{c}")).otherwise(F.col(f"owner_{c}"))
        changes[f"user_{c}"] = F.when(~F.coalesce(cond, F.lit(False)), F.col(f"user_{c}"))
    return df.withColumns(changes)


def set_where(
    df: DataFrame, target: str, cond: Column, value: Column, note: str, text: str | Column
) -> DataFrame:
    """Overwrite ``target`` and append to ``note`` on the rows that meet the condition."""
    return df.withColumns(
        {
            target: F.when(cond, value).otherwise(F.col(target)),
            note: noted(note, cond, text),
        }
    )


def fill_from(
    df: DataFrame, target: str, source: str, cond: Column, note: str, text: str
) -> DataFrame:
    """Fill a column from another column of the same row."""
    return set_where(df, target, cond, F.col(source), note, text)


def clamp_to(df: DataFrame, target: str, cap: str, note: str, text: str | Column) -> DataFrame:
    """Lower ``target`` to ``cap`` where it is larger."""
    return set_where(df, target, F.col(target) > F.col(cap), F.col(cap), note, text)


def align_to(
    df: DataFrame, target: str, source: str, guard: Column, note: str, text: str
) -> DataFrame:
    """Take ``source`` for ``target`` where both are known, differ, and the guard holds."""
    return set_where(
        df, target, (F.col(source) != F.col(target)) & guard, F.col(source), note, text
    )


def recompute(
    df: DataFrame, target: str, value: Column, note: str, before: str, after: str
) -> DataFrame:
    """Replace a derived value where it is off, and note by how much it changed."""
    text = amount_note(before, F.col(target) - value, after)
    return set_where(df, target, value != F.col(target), value, note, text)


def fill_const(df: DataFrame, target: str, value: object) -> DataFrame:
    return df.withColumn(target, F.coalesce(F.col(target), F.lit(value)))


def normalise_code(df: DataFrame, target: str, cond: Column, code: str, note: str) -> DataFrame:
    return set_where(
        df, target, cond, F.lit(code), note, f"changed blank {target} to {code}; "
    )


def clear_flag(df: DataFrame, flag: str, key: str, keys: Iterable[object]) -> DataFrame:
    """Reset a flag on the rows of the named keys."""
    hit = F.coalesce(F.col(key).isin(*keys), F.lit(False))
    return df.withColumn(flag, F.when(~hit, F.col(flag)))
