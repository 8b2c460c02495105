"""Ownership per parcel and its roll-up per property."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from landrecon.functions.numbers import percent
from landrecon.operators.aggregates import holding_area, sum_if
from landrecon.operators.joins import not_in
from landrecon.operators.lookups import attach
from landrecon.operators.spatial import dissolve_rectangles, overlap_join
from landrecon.session import stage

SIDES = ("owner", "user")


def commons_parcels(df: DataFrame) -> DataFrame:
    """Parcels with any row flagged as a commons field."""
    return df.filter(F.col("error_log").like("%commons%")).select("hapar_id").distinct()


def _eligible(df: DataFrame, commons: DataFrame | None) -> DataFrame:
    return not_in(df, "hapar_id", commons_parcels(df) if commons is None else commons)


def parcel_businesses(df: DataFrame, commons: DataFrame | None = None) -> DataFrame:
    """The owners and renters of each parcel that is no commons field, as distinct rows
    (parcel, side, business)."""
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"{s}_habus_id").alias("business")) for s in SIDES])
    listed = _eligible(df, commons).select("hapar_id", F.explode(sides).alias("b")).select("hapar_id", "b.*")
    return listed.filter(F.col("business").isNotNull()).distinct()


def ownership_per_parcel(
    df: DataFrame, businesses: DataFrame, commons: DataFrame | None = None
) -> DataFrame:
    """Number of owners and renters, leased-out flag and claims of each parcel that is no commons
    field. Who they are is in ``businesses``, the rows of ``parcel_businesses``."""
    leased = F.max(F.coalesce((F.col("owner_land_leased_out") == "Y"), F.lit(False)) | F.coalesce(
        (F.col("user_land_leased_out") == "Y"), F.lit(False)))
    parcel = _eligible(df, commons).groupBy("hapar_id").agg(
        leased.alias("_leased"), *[F.sum(f"{s}_bps_claimed_area").alias(f"_{s}_claim") for s in SIDES]
    )
    counts = businesses.groupBy("hapar_id").agg(
        sum_if(F.col("side") == "owner").alias("owners_per_fid"),
        sum_if(F.col("side") == "user").alias("users_per_fid"),
        F.count(F.lit(1)).alias("brns_per_fid"),
    )
    return attach(parcel, counts, ["hapar_id"]).select(
        "hapar_id",
        F.when(F.col("_leased"), "Y").otherwise("N").alias("llo"),
        "owners_per_fid", "users_per_fid", "brns_per_fid",
        *[
            F.when(F.col(f"_{s}_claim") != 0, F.col(f"_{s}_claim")).alias(f"{s}_bps_claimed_area")
            for s in SIDES
        ],
    )


def property_overlay(
    fields: DataFrame, properties: DataFrame, ownership: DataFrame, cell: float,
    rectangles: bool = False, dissolve: bool = False,
) -> DataFrame:
    """Each property's overlap with each parcel, beside the parcel's ownership.

    The parts of a property are overlaid one by one and added up per parcel. ``dissolve`` is for
    rectangular parts that may overlap each other: what they cover together counts once.
    """
    if dissolve:
        properties = stage(dissolve_rectangles(properties, ["property"], cell), "dissolved")
    overlaps = overlap_join(properties, fields, "property", "hapar_id", cell, rectangles=rectangles)
    areas = (
        overlaps.groupBy(F.col("key_a").alias("property"), F.col("key_b").alias("hapar_id"))
        .agg(F.max("area_b").alias("iacs_area_ha"), F.sum("area_overlap").alias("area_of_intersection"))
    )
    whole = holding_area(properties, ["property"], name="aw_area_ha")
    return attach(attach(areas, whole, ["property"], "inner"), ownership, ["hapar_id"], "inner")


def property_rollup(overlay: DataFrame, businesses: DataFrame) -> DataFrame:
    """Areas, leased-out counts and shares, distinct businesses and claims per property."""
    keys = ["property", "aw_area_ha"]
    sums = overlay.groupBy(*keys).agg(
        F.sum("iacs_area_ha").alias("sum_iacs_area"),
        F.sum("area_of_intersection").alias("sum_intersection_area"),
        sum_if(F.col("llo") == "Y").alias("_yes"),
        sum_if(F.col("llo") == "N").alias("_no"),
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(f"{s}_bps_claimed_area").alias(f"{s}_bps_claimed_area") for s in SIDES],
    )
    # One row per (property, side, business), reduced on the map side, counted per side.
    distinct = (
        attach(overlay.select("property", "hapar_id"), businesses, ["hapar_id"], "inner")
        .select("property", "side", "business")
        .distinct()
        .groupBy("property")
        .agg(
            sum_if(F.col("side") == "owner").alias("distinct_owners"),
            sum_if(F.col("side") == "user").alias("distinct_users"),
        )
    )
    return sums.join(distinct, "property", "left").select(
        *keys,
        "sum_iacs_area",
        "sum_intersection_area",
        percent(F.col("sum_intersection_area"), F.col("aw_area_ha")).alias("percent_intersection"),
        F.coalesce("_no", F.lit(0)).alias("n_llo_no"),
        F.coalesce("_yes", F.lit(0)).alias("n_llo_yes"),
        percent(F.col("_no"), F.col("_n")).alias("percent_llo_n"),
        percent(F.col("_yes"), F.col("_n")).alias("percent_llo_yes"),
        "distinct_owners",
        "distinct_users",
        *[f"{s}_bps_claimed_area" for s in SIDES],
    )


def property_report(
    fields: DataFrame, properties: DataFrame, ownership: DataFrame, businesses: DataFrame, cell: float,
    rectangles: bool = False, dissolve: bool = False,
) -> DataFrame:
    """The overlay is made once and written, since areas and businesses both read it."""
    overlay = stage(property_overlay(fields, properties, ownership, cell, rectangles, dissolve), "overlay")
    return property_rollup(overlay, businesses)
