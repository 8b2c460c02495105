"""Largest land use per parcel or holding."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from landrecon.functions.choice import collapse_prefix, effective_use
from landrecon.functions.numbers import used_area, zero_if_null
from landrecon.operators.joins import not_in, rank_join
from landrecon.operators.ranking import best_ranked_of_ties, largest_by_group
from landrecon.plans.reconcile import EXCLUDED


def claims_and_uses(df: DataFrame) -> DataFrame:
    """Effective land use with both sides' claimed and declared areas added up."""
    claimed = zero_if_null(F.col("owner_bps_claimed_area")) + zero_if_null(
        F.col("user_bps_claimed_area")
    )
    declared = zero_if_null(F.col("owner_land_use_area")) + zero_if_null(
        F.col("user_land_use_area")
    )
    return df.select(
        "hapar_id",
        effective_use(F.col("owner_land_use"), F.col("user_land_use")).alias("land_use"),
        claimed.alias("claimed_area"),
        used_area(claimed, declared).alias("used_area"),
    )


def largest(
    df: DataFrame, rank: DataFrame, key: str, code: str, measure: str, name: str,
    nulls_first: bool = False,
) -> DataFrame:
    """Per key the code with the largest total, ties by rank and code; unranked codes drop out."""
    totals = df.groupBy(key, code).agg(F.sum(measure).alias(name))
    best = largest_by_group(
        rank_join(totals, rank, code), [key], name, ["rank", code], nulls_first
    )
    return best.select(key, code, name)


def largest_use(df: DataFrame, rank: DataFrame, commons: DataFrame | None = None) -> DataFrame:
    """Largest use per parcel; parcels listed in ``commons`` are left out."""
    rows = df if commons is None else not_in(df, "hapar_id", commons)
    return largest(
        claims_and_uses(rows), rank, "hapar_id", "land_use", "used_area", "largest_used_area"
    )


def largest_use_commons(
    commons: DataFrame, rank: DataFrame, year: int | None = None, nulls_first: bool = False
) -> DataFrame:
    """Largest claimed use per shared grazing. A holding without any claim ranks last, or first
    with ``nulls_first``, as the source dialect sorts."""
    rows = commons if year is None else commons.filter(F.col("year") == year)
    return largest(
        rows, rank, "cg_hahol_id", "land_use", "bps_claimed_area", "used_area", nulls_first
    )


def largest_claim(df: DataFrame, rank: DataFrame) -> DataFrame:
    """First version: largest claim per parcel without excluded uses, temporary grass as one
    code. Only the maxima compete, and the best rank among them wins."""
    claims = (
        claims_and_uses(df)
        .groupBy("hapar_id", "land_use")
        .agg(F.sum("claimed_area").alias("claimed_area"))
        .filter((F.col("claimed_area") != 0) & ~F.col("land_use").isin(*EXCLUDED))
        .withColumn("land_use", collapse_prefix(F.col("land_use")))
        .groupBy("hapar_id", "land_use")
        .agg(F.sum("claimed_area").alias("max_claimed"))
    )
    ranked = rank_join(claims, rank)
    return best_ranked_of_ties(ranked, ["hapar_id"], "max_claimed", "rank", ["land_use"]).select(
        "hapar_id", "land_use", "max_claimed"
    )
