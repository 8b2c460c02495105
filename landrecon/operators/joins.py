"""Joins, semi-joins and anti-joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from landrecon.operators.lookups import attach
from landrecon.session import layout, stage

# A key that makes more pairs than this is split over several tasks.
HOT_PAIRS = 100_000_000


def pair_join(
    left: DataFrame, right: DataFrame, keys: list[str], left_id: str, right_id: str,
    hot_pairs: int = HOT_PAIRS,
) -> DataFrame:
    """Inner join in which a hot key is laid out as a grid of tasks.

    A key of more than ``hot_pairs`` pairs is cut into slices by a hash of the row id, so that
    about ``hot_pairs`` of its pairs fall into one cell; every left slice meets every right slice
    exactly once. The list of hot keys is written once and joined like any lookup. Rows that lie by
    one of the keys, with the hot ones set apart, are joined where they lie.
    """
    if layout(keys) is not None:
        return left.join(right.hint("shuffle_hash"), keys)
    size = F.count(F.lit(1))
    edge = int(hot_pairs**0.5) or 1
    slices = {
        "_rs": F.ceil(F.col("_nr") / edge),
        "_ls": F.ceil(F.col("_nl") * F.least("_nr", F.lit(edge)) / F.lit(edge * edge)),
    }
    hot = stage(
        left.groupBy(*keys).agg(size.alias("_nl"))
        .join(right.groupBy(*keys).agg(size.alias("_nr")), keys)
        .filter(F.col("_nl").cast("double") * F.col("_nr") > hot_pairs)
        .select(*keys, *[n.cast("int").alias(c) for c, n in slices.items()]),
        "hot-keys",
    )

    def spread(df: DataFrame, row_id: str, own: str, other: str, mine: str, theirs: str) -> DataFrame:
        own_slices, other_slices = F.coalesce(own, F.lit(1)), F.coalesce(other, F.lit(1))
        return (
            attach(df, hot, keys)
            .withColumn(mine, F.pmod(F.xxhash64(row_id), own_slices).cast("int"))
            .withColumn(theirs, F.explode(F.sequence(F.lit(0), other_slices - 1)))
            .drop("_ls", "_rs")
        )

    on = [*keys, "_l", "_r"]
    return (
        spread(left, left_id, "_ls", "_rs", "_l", "_r")
        .join(spread(right, right_id, "_rs", "_ls", "_r", "_l"), on)
        .drop("_l", "_r")
    )


def detail_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join of two detail tables, always by a shuffle.

    Estimates decide on broadcasts before anything is counted. They take a table for the bytes of its
    compressed files and an exploded row for one row, so that millions of rows can pass for a small
    table and be gathered by the driver.
    """
    return left.join(right.hint("merge"), keys)


def semi(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return attach(df, keys.select(*on), on, "left_semi")


def anti(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows without a match; a row with a NULL key has none and stays."""
    return attach(df, keys.select(*on), on, "left_anti")


def not_in(df: DataFrame, col: str, listed: DataFrame, listed_col: str | None = None) -> DataFrame:
    """SQL ``NOT IN`` for a list of any size.

    One NULL on the list empties the result; a NULL value is kept only if the list is empty.
    Both are settled by one count of the list, so that the join itself may shuffle; the built-in
    null-aware anti-join would have to broadcast the list.
    """
    values = listed.select(F.col(listed_col or col).alias(col))
    listing = values.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count(col).alias("known"))).scalar()
    no_null = listing["n"] == listing["known"]
    kept = df.filter(no_null & (F.col(col).isNotNull() | (listing["n"] == 0)))
    return anti(kept, values.filter(F.col(col).isNotNull()), [col])


def only_in(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys the other table lacks."""
    return anti(df, other, keys)


def exists_delete(df: DataFrame, originals: DataFrame, keys: list[str], cond: Column) -> DataFrame:
    """Drop the rows that meet the condition and have an equal on all keys in the other frame.

    A NULL key equals nothing, so such rows stay.
    """
    hit = F.coalesce(cond, F.lit(False))
    probe = originals.select(*keys).distinct().withColumn("_found", F.lit(True))
    marked = attach(df, probe, keys)
    return marked.filter(~(hit & F.coalesce("_found", F.lit(False)))).select(*df.columns)


def either_in(
    df: DataFrame, columns: dict[str, Column], listed: DataFrame, listed_col: str, within: tuple[str, ...] = ()
) -> DataFrame:
    """Rows where any of the named expressions is on the list. One lookup per expression, no OR
    in a join condition, so each is an ordinary hash join. ``within`` names columns that a row and
    its entries on the list share."""
    keys = listed.select(*within, F.col(listed_col)).filter(F.col(listed_col).isNotNull()).distinct()
    marked = df
    for name, expr in columns.items():
        probe = keys.select(*within, F.col(listed_col).alias(f"_v_{name}"), F.lit(True).alias(f"_in_{name}"))
        marked = attach(marked.withColumn(f"_v_{name}", expr), probe, [*within, f"_v_{name}"])
    found = reduce(lambda a, b: a | b, [F.coalesce(f"_in_{n}", F.lit(False)) for n in columns])
    return marked.filter(found).select(*df.columns)


def rank_join(df: DataFrame, rank: DataFrame, code: str = "land_use") -> DataFrame:
    """Look up the intensity rank; unranked codes drop out. The list is a fixed inline table."""
    return df.join(F.broadcast(rank.withColumnRenamed("land_use", code)), code)


def other_party_join(
    df: DataFrame, keys: list[str], party: str, cond: Column, row_id: str, hot_pairs: int = HOT_PAIRS
) -> DataFrame:
    """Rows beside the flagged rows of another party with the same keys.

    The condition selects the flagged rows; they carry the prefix ``other_``. One summary per key, of
    the parties and of the numbers of rows, tells which keys can have a pair at all, which rows find
    none but their own party's flagged rows, and which keys are hot: these are laid out as a grid, as
    in ``pair_join``. Rows with the same ``row_id`` stay together there.
    """
    flagged = F.coalesce(cond, F.lit(False))
    edge = int(hot_pairs**0.5) or 1
    rows, marked = F.col("_nl"), F.col("_nr")
    hot = rows.cast("double") * marked > hot_pairs
    slices = {
        "_rs": F.when(hot, F.ceil(marked / edge)).otherwise(1),
        "_ls": F.when(hot, F.ceil(rows * F.least(marked, F.lit(edge)) / F.lit(edge * edge))).otherwise(1),
    }
    summary = (
        df.groupBy(*keys).agg(
            F.min(party).alias("_a"), F.max(party).alias("_b"), F.count(F.lit(1)).alias("_nl"), F.count(F.when(flagged, 1)).alias("_nr"),
            F.min(F.when(flagged, F.col(party))).alias("_fa"), F.max(F.when(flagged, F.col(party))).alias("_fb"),
        )
        .filter("_fa IS NOT NULL AND _a <> _b")
        .select(*keys, "_fa", "_fb", *[n.cast("int").alias(c) for c, n in slices.items()])
    )
    able = attach(df, summary, keys, "inner")

    def spread(side: DataFrame, own: str, other: str, mine: str, theirs: str) -> DataFrame:
        placed = side.withColumn(mine, F.pmod(F.xxhash64(row_id), F.col(own)).cast("int"))
        return placed.withColumn(theirs, F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop("_ls", "_rs", "_fa", "_fb")

    left = spread(able.filter((F.col(party) != F.col("_fa")) | (F.col(party) != F.col("_fb"))), "_ls", "_rs", "_l", "_r")
    right = spread(able.filter(cond), "_rs", "_ls", "_r", "_l")
    on = [*keys, "_l", "_r"]
    named = right.select(*on, *[F.col(c).alias(f"other_{c}") for c in df.columns if c not in keys])
    return left.join(named, on).filter(F.col(party) != F.col(f"other_{party}")).drop("_l", "_r")


def same_total_diff_count(
    left: DataFrame, right: DataFrame, key: str, within: list[str], measure: str
) -> DataFrame:
    """Keys where both tables have the same total but a different number of rows."""

    def totals(df: DataFrame, side: str) -> DataFrame:
        return df.groupBy(key, *within).agg(
            F.sum(measure).alias("_total"), F.count(F.lit(1)).alias(f"_n_{side}")
        ).drop(*within)

    both = totals(left, "l").join(totals(right, "r"), [key, "_total"])
    return both.filter(F.col("_n_l") != F.col("_n_r")).select(key).distinct()


def unique_match(
    left: DataFrame, right: DataFrame, single: list[str], keys: list[str], left_id: str, right_id: str
) -> DataFrame:
    """Match on ``keys`` the rows that are alone on their side within ``single``.

    A group of one row is its own minimum and maximum, so the single rows come out of one
    aggregation per side without a second pass over the detail.
    """

    def alone(df: DataFrame, row_id: str, side: str) -> DataFrame:
        columns = [c for c in dict.fromkeys([*keys, row_id]) if c not in single]
        grouped = df.groupBy(*single).agg(
            F.count(F.lit(1)).alias("_n"), *[F.max(c).alias(c) for c in columns]
        )
        return grouped.filter("_n = 1").drop("_n").withColumnRenamed(row_id, f"{side}_{row_id}")

    return alone(left, left_id, "owner").join(alone(right, right_id, "user"), keys)


def attach_fields(
    holdings: DataFrame, members: DataFrame, fields: DataFrame, holding: str, parcel: str
) -> DataFrame:
    """Field rows of a holding-level result, through the list of fields per holding."""
    listed = fields.join(members.select(parcel, holding), parcel)
    return attach(listed, holdings, [holding], "inner")
