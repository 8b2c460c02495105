"""Shared grazings: build, reconcile, flag, and cross-link with the merged table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from landrecon.functions.numbers import round2
from landrecon.functions.text import pair_id, to_text
from landrecon.operators.aggregates import consolidate, holding_area
from landrecon.operators.filters import delete_where
from landrecon.operators.lookups import attach
from landrecon.operators.notes import amount_note, change, logged, logged_amount, note_digits_exceed, noted
from landrecon.operators.rewrite import clamp_to, clear_flag, recompute
from landrecon.session import dealt, stage

HOLDING_YEAR = ["cg_hahol_id", "year"]
SHARE_IDENTITY = [
    "cg_hahol_id", "mlc_hahol_id", "share_hahol_id", "habus_id", "share_bps_eligible_area",
    "land_use", "year",
]
SHARE_SUMS = ["share_area", "bps_claimed_area", "lfass_claimed_area"]

# Wording of notes and flags, and the activity of merged shares.
MERGED_ACTIVITY = "Undertaking Production Activities"
SHARES_MERGED = (
    "combined share where all same holding ids/brn and summed share_area, bps_claimed_area, "
    "lfass_claimed_area; "
)
ELIGIBLE_CLAMPED = "changed lpid_bps_eligible_area to match commons where eligible area larger by "
ELIGIBLE_RECOMPUTED = "set lpid_bps_eligible_area = commons_area - lpid_excluded_area, change of "
# Rules of the change log, with the text that stands for each in the note, or what is before and after its amount.
LOG = "change_log"
DIGITISED, CLAMPED, MERGED, RECOMPUTED = "digitised", "clamped", "merged", "recomputed"
NOTE_TEXTS = {
    DIGITISED: ("changed commons_area by ", "ha based on digi_area; "), CLAMPED: (ELIGIBLE_CLAMPED, "ha ; "),
    MERGED: SHARES_MERGED, RECOMPUTED: (ELIGIBLE_RECOMPUTED, "ha; "),
}
LARGE_AMOUNT = 10
OVERCLAIM = "overclaim: sum(bps_claimed_area) > lpid_bps_eligible_area by "
DISCREPANCY = (
    "errors larger than 10ha between digi_area and other recorded areas (see change_note); "
)
CLAIMED_COMMONS = "this is a commons field - record duplicated in commons table; "
COMMONS_FIELD = "this is a commons field; "
COPIED = "record duplicated in IACS table; "


def detail_totals(detail: DataFrame) -> DataFrame:
    """Parcel areas per shared grazing and year."""
    return detail.groupBy(*HOLDING_YEAR).agg(
        F.sum("digitised_area").alias("lpid_area"),
        F.sum("bps_eligible_area").alias("lpid_bps_eligible_area"),
        F.sum("excluded_land_area").alias("lpid_excluded_area"),
    )


def commons_join(share: DataFrame, totals: DataFrame, areas: DataFrame) -> DataFrame:
    """Shares beside their grazing's totals and polygon area, all years at once. Both lookups
    have one row per grazing and year; ids of share and total are joined to a pair id."""
    joined = attach(attach(share, totals, HOLDING_YEAR, "inner"), areas, HOLDING_YEAR, "inner")
    digitised = round2(F.col("digi_area"))
    return joined.select(
        "cg_hahol_id", "mlc_hahol_id", "share_hahol_id", "habus_id",
        digitised.alias("commons_area"), digitised.alias("digi_area"), "lpid_area",
        F.col("area_amt").alias("share_area"), "lpid_bps_eligible_area",
        "share_bps_eligible_area", "bps_claimed_area", "lfass_claimed_area",
        "lpid_excluded_area", F.col("activity_type_desc").alias("land_activity"),
        F.col("name").alias("land_use"), "year",
        pair_id(F.col("lpid_id"), F.col("share_id")).alias("id"),
    )


def build_commons(share: DataFrame, totals: DataFrame, shapes: DataFrame, log: bool = False) -> DataFrame:
    """Shares (with ``share_id``), totals (with ``lpid_id``) and yearly polygons (``hahol_id``,
    ``ring``, ``year``) joined; a differing digitised area is noted with the amount.

    The note replaces an earlier one, as there is none yet. ``log`` adds the column ``change_log``, which
    has the changes that the note tells as data; ``clean_commons`` goes on with it.
    """
    areas = holding_area(shapes, ["hahol_id", "year"]).withColumnRenamed("hahol_id", "cg_hahol_id")
    joined = commons_join(share, totals, areas)
    gap = F.col("digi_area") - F.col("lpid_area")
    note = amount_note(NOTE_TEXTS[DIGITISED][0], gap, NOTE_TEXTS[DIGITISED][1])
    if log:
        entry = change(DIGITISED, "commons_area", F.col("lpid_area"), F.col("digi_area"))
        joined = joined.withColumn(LOG, F.when(gap != 0, F.array(entry)))
    return joined.withColumns(
        {
            "change_note": F.when(gap != 0, note),
            "error_log": F.lit(None).cast("string"),
        }
    ).drop("digi_area", "lpid_area")


def flag_overclaim(commons: DataFrame) -> DataFrame:
    """EC1: claims of a grazing and year above its eligible area. All rows of the grazing and
    year are flagged, and the flag replaces an earlier one; of several eligible areas the
    largest excess is shown."""
    excess = F.col("_claimed") - F.col("lpid_bps_eligible_area")
    over = (
        commons.groupBy(*HOLDING_YEAR, "lpid_bps_eligible_area")
        .agg(F.sum("bps_claimed_area").alias("_claimed"))
        .filter(excess > 0)
        .groupBy(*HOLDING_YEAR)
        .agg(F.max(excess).alias("_excess"))
    )
    text = F.concat(F.lit(OVERCLAIM), to_text(F.col("_excess")), F.lit("ha; "))
    flagged = attach(commons, over, HOLDING_YEAR)
    return flagged.withColumn("error_log", F.coalesce(text, "error_log")).drop("_excess")


def flag_discrepancy(commons: DataFrame) -> DataFrame:
    """EC2: several notes whose digits together suggest more than ten hectares."""
    hit = note_digits_exceed("change_note")
    return commons.withColumn("error_log", noted("error_log", hit, DISCREPANCY))


def flag_large_changes(commons: DataFrame, hectares: int = LARGE_AMOUNT) -> DataFrame:
    """EC2 as it is meant: rows whose logged amounts add up to more than so many hectares."""
    return commons.withColumn("error_log", noted("error_log", logged_amount(LOG) > hectares, DISCREPANCY))


def _logged(df: DataFrame, cond: Column, entry: Column) -> DataFrame:
    """The frame with the entry in its change log, if it keeps one."""
    return df.withColumn(LOG, logged(LOG, cond, entry)) if LOG in df.columns else df


def clean_commons(
    commons: DataFrame, cleared: tuple[int, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """Drop empty shares, hold eligible to grazing area, merge equal shares, recompute the
    eligible area, flag. ``cleared`` names grazings whose flags were checked by hand. The second
    frame lists which shares went into which merged row."""
    kept = delete_where(commons, (F.col("share_area") == 0) & (F.col("bps_claimed_area") == 0))
    gap = F.col("commons_area") - F.col("lpid_bps_eligible_area")
    eligible, area = F.col("lpid_bps_eligible_area"), F.col("commons_area")
    kept = _logged(kept, eligible > area, change(CLAMPED, "lpid_bps_eligible_area", eligible, area))
    clamped = clamp_to(
        kept, "lpid_bps_eligible_area", "commons_area", "change_note",
        amount_note(ELIGIBLE_CLAMPED, gap, "ha ; "),
    )
    merged, members = consolidate(
        stage(clamped, "commons-clamped"), SHARE_IDENTITY, SHARE_SUMS, "id", "change_note",
        SHARES_MERGED, {"land_activity": MERGED_ACTIVITY},
    )
    merged = _logged(merged, F.col("n_members") > 1, change(MERGED))
    rest = F.col("commons_area") - F.col("lpid_excluded_area")
    merged = _logged(merged, rest != eligible, change(RECOMPUTED, "lpid_bps_eligible_area", eligible, rest))
    recomputed = recompute(
        merged.drop("n_members"), "lpid_bps_eligible_area", rest, "change_note", ELIGIBLE_RECOMPUTED, "ha; "
    )
    flagged = flag_discrepancy(flag_overclaim(stage(recomputed, "commons-merged")))
    done = clear_flag(flagged, "error_log", "cg_hahol_id", cleared) if cleared else flagged
    return done, members


def flag_commons_fields(iacs: DataFrame, detail: DataFrame) -> DataFrame:
    """EC3 and EC4: the parcel is a commons field, with or without a claim of its own."""
    fields = dealt(detail.select("hapar_id", "year")).distinct().withColumn("_field", F.lit(True))
    field = F.coalesce("_field", F.lit(False))
    claimed = F.coalesce(
        (F.col("owner_bps_claimed_area") != 0) | (F.col("user_bps_claimed_area") != 0),
        F.lit(False),
    )
    text = F.when(claimed, F.lit(CLAIMED_COMMONS)).otherwise(F.lit(COMMONS_FIELD))
    marked = attach(iacs, fields, ["hapar_id", "year"])
    return marked.withColumn("error_log", noted("error_log", field, text)).drop("_field")


def commons_claims(iacs: DataFrame) -> DataFrame:
    """The rows that ``copy_to_commons`` copies."""
    return iacs.filter(F.col("error_log").like("%this is a commons field %"))


def copy_to_commons(
    iacs: DataFrame, detail: DataFrame, commons: DataFrame, strict: bool = False
) -> DataFrame:
    """Claims on commons fields as rows of the commons table.

    ``strict`` keeps a slip of the source: a renter's main holding stands in for the
    renter's holding.
    """
    claims = commons_claims(iacs)
    members = detail.select("cg_hahol_id", "hapar_id", "year").distinct()
    grazings = commons.select(
        "cg_hahol_id", "commons_area", "lpid_bps_eligible_area", "year"
    ).distinct()
    owned = F.col("owner_mlc_hahol_id").isNotNull()
    renter_holding = "user_mlc_hahol_id" if strict else "user_hahol_id"
    claimed = F.coalesce("owner_bps_claimed_area", "user_bps_claimed_area")
    return (
        claims.join(members, ["hapar_id", "year"])
        .join(grazings, HOLDING_YEAR)
        .select(
            "cg_hahol_id",
            F.coalesce("owner_mlc_hahol_id", "user_mlc_hahol_id").alias("mlc_hahol_id"),
            F.when(owned, F.col("owner_hahol_id"))
            .otherwise(F.col(renter_holding))
            .alias("share_hahol_id"),
            F.coalesce("owner_habus_id", "user_habus_id").alias("habus_id"),
            "commons_area",
            F.col("land_parcel_area").alias("share_area"),
            "lpid_bps_eligible_area",
            F.col("bps_eligible_area").alias("share_bps_eligible_area"),
            claimed.alias("bps_claimed_area"),
            F.lit(None).cast(commons.schema["lfass_claimed_area"].dataType).alias(
                "lfass_claimed_area"
            ),
            F.col("verified_exclusion").alias("lpid_excluded_area"),
            "land_activity",
            F.coalesce("user_land_use", "owner_land_use").alias("land_use"),
            "year",
            F.col("claim_id").alias("id"),
            "change_note",
            F.lit(COPIED).alias("error_log"),
        )
    )


def cross_link(
    iacs: DataFrame, commons: DataFrame, detail: DataFrame, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(merged table with commons flags, commons table with the copied claims)."""
    return link_flagged(stage(flag_commons_fields(iacs, detail), "iacs-flagged"), commons, detail, strict)


def link_flagged(
    flagged: DataFrame, commons: DataFrame, detail: DataFrame, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``cross_link`` of rows that bear the commons flags and are written."""
    return flagged, commons.unionByName(copy_to_commons(flagged, detail, commons, strict))
