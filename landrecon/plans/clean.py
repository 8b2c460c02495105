"""Cleaning and repair of the two declaration tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from landrecon.operators.filters import delete_where, quality_filter, zero_exclusion
from landrecon.operators.lookups import attach, fill_from_peer, update_from
from landrecon.operators.notes import noted
from landrecon.operators.ranking import dedupe
from landrecon.operators.rewrite import align_to, clamp_to, fill_from
from landrecon.session import layout, stage
from landrecon.sources.ids import prefix_id

# Columns that must agree for two declarations to be copies of each other. The
# payment region and the claim id are the only ones that may differ; the owner table also
# leaves out the leased-out flag.
OWNER_IDENTITY = (
    "mlc_hahol_id", "habus_id", "hahol_id", "hapar_id", "land_parcel_area", "verified_exclusion",
    "bps_eligible_area", "land_activity", "organic_status", "land_use", "land_use_area", "lfass",
    "bps_claimed_area", "application_status", "is_perm_flag", "year",
)
RENTER_IDENTITY = (*OWNER_IDENTITY, "land_leased_out")

# Columns that come out as owner_… and user_… once the sides are joined.
MEASURES = (
    "mlc_hahol_id", "habus_id", "hahol_id", "land_parcel_area", "bps_eligible_area",
    "bps_claimed_area", "verified_exclusion", "land_use_area", "land_use", "land_activity",
    "application_status", "land_leased_out", "lfass_flag",
)

# Wording of the change notes.
PARCEL_FROM_PEER = "land_parcel_area inferred from same hapar_id; "
PARCEL_FROM_USE = "land_parcel_area inferred from land_use_area in single claim row; "
USE_FROM_PARCEL = (
    "land_use_area inferred where land_parcel_area = bps_eligible_area for single claims; "
)
USE_FROM_OTHER_YEAR = "land_use_area inferred from other year where same land_use; "
CLAIM_CLAMPED = "adjust bps_claimed_area to match land_parcel_area where bps > parcel; "
USE_ALIGNED = "adjust {side} land_use_area to match bps_claimed_area; "


def clean_declarations(
    raw: DataFrame, identity: tuple[str, ...], mark: str, year_out: int = 2019
) -> DataFrame:
    """Unique, plausible declarations with positive areas and marked claim ids.

    All filter columns belong to the identity, so filtering first leaves the same survivors
    and shuffles fewer rows. Of several copies the smallest claim id stays.
    """
    plausible = delete_where(quality_filter(raw, year_out), zero_exclusion())
    unique = dedupe(plausible, list(identity), ["claim_id"])
    return unique.select(
        "mlc_hahol_id", "habus_id", "hahol_id", "hapar_id", "land_parcel_area",
        F.abs("bps_eligible_area").alias("bps_eligible_area"), "bps_claimed_area",
        "verified_exclusion", F.abs("land_use_area").alias("land_use_area"), "land_use",
        "land_activity", "application_status", "land_leased_out",
        F.col("lfass").alias("lfass_flag"), "is_perm_flag",
        prefix_id(F.col("claim_id"), mark).alias("claim_id"), "year",
        F.lit(None).cast("string").alias("change_note"),
    )


def repair_parcel_area(df: DataFrame) -> DataFrame:
    """Missing parcel area: from another row of the parcel, else from the row's own use area;
    rows left without any area go."""
    unknown = F.col("land_parcel_area").isNull()
    peers = fill_from_peer(
        df, ["hapar_id"], "land_parcel_area", unknown, "change_note", PARCEL_FROM_PEER
    )
    own = fill_from(
        peers, "land_parcel_area", "land_use_area", unknown, "change_note", PARCEL_FROM_USE
    )
    nothing = (unknown | (F.col("land_parcel_area") == 0)) & (F.col("land_use_area") == 0)
    return delete_where(own, nothing)


def fill_single_claims(df: DataFrame) -> DataFrame:
    """A parcel's only claim of a year, without use area, uses the whole eligible parcel."""
    single = (
        df.groupBy("hapar_id", "year")
        .agg(F.count("land_use").alias("_n"), F.sum("land_use_area").alias("_sum"))
        .filter((F.col("_n") == 1) & ((F.col("_sum") == 0) | F.col("_sum").isNull()))
        .select("hapar_id", "year", F.lit(True).alias("_single"))
    )
    hit = F.coalesce("_single", F.lit(False)) & (
        F.col("land_parcel_area") == F.col("bps_eligible_area")
    )
    return (
        attach(df, single, ["hapar_id", "year"])
        .withColumns(
            {
                "land_use_area": F.when(hit, F.col("land_parcel_area")).otherwise(
                    F.col("land_use_area")
                ),
                "change_note": noted("change_note", hit, USE_FROM_PARCEL),
            }
        )
        .select(*df.columns)
    )


def use_area_donors(df: DataFrame) -> DataFrame:
    """Per parcel and land use of which some year declares no use area at all: the use area of
    the latest year that has one, the largest if there are several.

    Rows are reduced to one cell per parcel, year and land use before the window, whose group
    is then no longer than the list of land-use codes.
    """
    known = F.col("land_use_area").isNotNull()
    cells = df.groupBy("hapar_id", "year", "land_use").agg(
        F.count("land_use_area").alias("_known"), F.max("land_use_area").alias("_area")
    )
    year = Window.partitionBy("hapar_id", "year")
    empty_year = F.sum("_known").over(year) == 0
    newest = F.max(F.when(F.col("_area").isNotNull(), F.struct("year", "_area")))
    return (
        cells.withColumn("_empty", empty_year)
        .groupBy("hapar_id", "land_use")
        .agg(F.max("_empty").alias("_needed"), newest.alias("_newest"))
        .filter(F.col("_needed") & F.col("_newest").isNotNull())
        .select("hapar_id", "land_use", F.col("_newest._area").alias("_donor"))
    )


def repair_use_area(df: DataFrame, side: str) -> DataFrame:
    """Missing use area: single claims, other years; then claims are held to the parcel and the
    use area to the claim; rows still without use area go."""
    singles = fill_single_claims(df)
    if layout(df.columns) is not None:  # read again where the rows lie; only the few donors are written
        donors = stage(use_area_donors(singles), f"{side}-donors")
    else:
        singles = stage(singles, f"{side}-singles")
        donors = use_area_donors(singles)
    area = F.col("land_use_area")
    other_year = update_from(
        singles, donors, ["hapar_id", "land_use"], "land_use_area", "_donor",
        area.isNull() | (area == 0), "change_note", USE_FROM_OTHER_YEAR,
    )
    clamped = clamp_to(
        other_year, "bps_claimed_area", "land_parcel_area", "change_note", CLAIM_CLAMPED
    )
    claimed = F.col("bps_claimed_area")
    aligned = align_to(
        clamped, "land_use_area", "bps_claimed_area",
        (claimed != 0) & (claimed <= F.col("land_parcel_area")),
        "change_note", USE_ALIGNED.format(side=side),
    )
    return aligned.filter(F.col("land_use_area").isNotNull())


def prepare_owners(raw: DataFrame, year_out: int = 2019) -> DataFrame:
    cleaned = stage(clean_declarations(raw, OWNER_IDENTITY, "P", year_out), "owners-clean")
    return repair_use_area(stage(repair_parcel_area(cleaned), "owners-parcel"), "owner")


def prepare_renters(raw: DataFrame, year_out: int = 2019) -> DataFrame:
    cleaned = stage(clean_declarations(raw, RENTER_IDENTITY, "S", year_out), "renters-clean")
    return repair_use_area(stage(repair_parcel_area(cleaned), "renters-parcel"), "user")
