"""Matching owners with renters and merging both sides into one table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from landrecon.functions.choice import (
    NON_SCHEME_USE, choose_activity, choose_status, coalesce_sides,
)
from landrecon.functions.numbers import larger_side
from landrecon.operators.filters import delete_where
from landrecon.operators.joins import HOT_PAIRS
from landrecon.operators.lookups import attach
from landrecon.operators.matching import Tier, prune_pairs, remove_matched, tiered_match
from landrecon.operators.notes import merge_notes, noted, noted_all
from landrecon.operators.rewrite import one_sided
from landrecon.plans.clean import MEASURES
from landrecon.session import layout, stage
from landrecon.sources.reference_lists import EXCLUDED_LAND_USES

EXCLUDED = tuple(EXCLUDED_LAND_USES)

# Columns merged into one; the others stay apart per side.
MERGED_AREAS = ("land_parcel_area", "bps_eligible_area", "verified_exclusion")
# The columns of the merged table, in the order its readers expect.
FINAL_COLUMNS = (
    "owner_mlc_hahol_id", "user_mlc_hahol_id", "owner_habus_id", "user_habus_id",
    "owner_hahol_id", "user_hahol_id", "hapar_id", "land_parcel_area", "bps_eligible_area",
    "owner_bps_claimed_area", "user_bps_claimed_area", "verified_exclusion",
    "owner_land_use_area", "user_land_use_area", "owner_land_use", "user_land_use",
    "land_activity", "application_status", "owner_land_leased_out", "user_land_leased_out",
    "owner_lfass_flag", "user_lfass_flag", "claim_id", "year", "change_note",
)

# Wording of the change notes.
ASSUMED_AREA = "assume {area} = {side}_{area} {when} {side} > {other}; "
ACTIVITY_CHOSEN = "owner and user land_activity choice based on assumption user knows best; "
STATUS_CHOSEN = (
    "application status assumed under action/assessment if either owner or user says so; "
)
NO_SCHEME_RENTER = "infer non-SAF renter; "
NO_SCHEME_OWNER = "infer non-SAF owner; "
PARCEL_EQUALISED = "adjust land_parcel_area to max(parcel) where different in same year; "


def leasing_guard() -> Column:
    """The owner leases out, or claims nothing without leasing out."""
    out = F.col("owner_land_leased_out")
    return (out == "Y") | ((out == "N") & (F.col("owner_bps_claimed_area") == 0))


def match_tiers() -> list[Tier]:
    by_parcel = ("hapar_id", "year")
    return [
        Tier("first join; ", (*by_parcel, "land_use", "land_use_area"), leasing_guard(), True),
        Tier("second join; ", (*by_parcel, "land_use")),
        Tier("third join; ", (*by_parcel, "land_use_area")),
        Tier("fourth join; ", by_parcel),
    ]


def implausible_pair() -> Column:
    """An excluded use on one side against a claim, or an excluded renter's use, on the other."""
    owner_out = F.col("owner_land_use").isin(*EXCLUDED)
    user_out = F.col("user_land_use").isin(*EXCLUDED)
    return (
        (owner_out & (F.col("user_bps_claimed_area") != 0))
        | (user_out & (F.col("owner_bps_claimed_area") != 0))
        | (~owner_out & user_out)
    )


def match_owners_renters(
    owners: DataFrame, renters: DataFrame, hot_pairs: int = HOT_PAIRS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pairs, owners without a pair, renters without a pair)."""
    kept = [*MEASURES, "hapar_id", "year", "claim_id", "change_note"]
    matched = tiered_match(
        owners.select(*kept), renters.select(*kept), match_tiers(), hot_pairs=hot_pairs
    )
    plausible = prune_pairs(matched, 4, implausible_pair())
    pairs = stage(
        plausible.withColumn(
            "change_note",
            merge_notes(
                F.col("tier_label"), F.col("owner_change_note"), F.col("user_change_note")
            ),
        ).drop("owner_change_note", "user_change_note"),
        "pairs",
    )
    return (
        pairs,
        remove_matched(owners.select(*kept), pairs, "claim_id", "owner", ("hapar_id", "year")),
        remove_matched(renters.select(*kept), pairs, "claim_id", "user", ("hapar_id", "year")),
    )


def one_sided_rows(owners: DataFrame, renters: DataFrame) -> DataFrame:
    """Rows without a partner; the absent side is NULL, in the present side's types."""
    left, right = one_sided(owners, MEASURES, "owner"), one_sided(renters, MEASURES, "user")
    merged = left.unionByName(right)
    sides = {c: (F.col(f"owner_{c}"), F.col(f"user_{c}")) for c in (*MERGED_AREAS, "land_activity", "application_status")}
    return merged.withColumns({c: coalesce_sides(*s) for c, s in sides.items()}).select(
        *FINAL_COLUMNS
    )


def pair_notes(strict: bool = True) -> Column:
    """The pair's note with every assumption made by ``merge_pairs`` appended."""
    entries = []
    for area in MERGED_AREAS:
        owner, user = F.col(f"owner_{area}"), F.col(f"user_{area}")
        upper = "WHEN" if area == "verified_exclusion" else "when"
        text = ASSUMED_AREA.format(area=area, side="owner", other="user", when="when")
        entries.append((owner > user, text))
        text = ASSUMED_AREA.format(area=area, side="user", other="owner", when=upper)
        entries.append((owner < user, text))
    differ = F.col("owner_land_activity") != F.col("user_land_activity")
    owner, user = F.col("owner_application_status"), F.col("user_application_status")
    renter_acts = user.like("%Action") if strict else user.contains("Action")
    acting = (owner.contains("Action") | renter_acts) & (owner != user)
    entries += [(differ, ACTIVITY_CHOSEN), (acting, STATUS_CHOSEN)]
    return noted_all("change_note", entries)


def merge_pairs(pairs: DataFrame, strict: bool = True) -> DataFrame:
    """One row per pair: the larger area, the renter's activity, the status under action.

    ``strict`` keeps the narrower rule for *noting* a chosen status: the renter's must end in
    "Action", although the choice itself looks for it anywhere.
    """
    chosen = {
        **{c: larger_side(F.col(f"owner_{c}"), F.col(f"user_{c}")) for c in MERGED_AREAS},
        "land_activity": choose_activity(F.col("owner_land_activity"), F.col("user_land_activity")),
        "application_status": choose_status(
            F.col("owner_application_status"), F.col("user_application_status")
        ),
        "change_note": pair_notes(strict),
    }
    return pairs.withColumns(chosen).select(*FINAL_COLUMNS)


def infer_outsiders(final: DataFrame) -> DataFrame:
    """Mark the absent side as outside the scheme where the present one implies it."""
    owner_use, user_use = F.col("owner_land_use"), F.col("user_land_use")
    no_renter = (
        F.col("user_habus_id").isNull()
        & (F.col("owner_land_leased_out") == "Y")
        & ~owner_use.isin(*EXCLUDED)
    )
    renter_marked = final.withColumns(
        {
            "user_land_use": F.when(no_renter, F.lit(NON_SCHEME_USE)).otherwise(user_use),
            "change_note": noted("change_note", no_renter, NO_SCHEME_RENTER),
        }
    )
    no_owner = F.col("owner_habus_id").isNull() & ~user_use.isin(*EXCLUDED)
    return renter_marked.withColumns(
        {
            "owner_land_use": F.when(no_owner, F.lit(NON_SCHEME_USE)).otherwise(owner_use),
            "change_note": noted("change_note", no_owner, NO_SCHEME_OWNER),
        }
    )


def drop_empty_exclusions(final: DataFrame) -> DataFrame:
    for side in ("user", "owner"):
        empty = (F.col(f"{side}_land_use_area") == 0) & F.col(f"{side}_land_use").isin(*EXCLUDED)
        final = delete_where(final, empty)
    return final


def equalise_parcel_area(final: DataFrame) -> DataFrame:
    """One parcel area per parcel and year: the largest. Every row of a parcel and year whose
    rows disagree is rewritten and noted, also those that had the largest value already."""
    uneven = (
        final.groupBy("hapar_id", "year")
        .agg(F.max("land_parcel_area").alias("_max"), F.min("land_parcel_area").alias("_min"))
        .filter(F.col("_max") != F.col("_min"))
        .drop("_min")
    )
    hit = F.col("_max").isNotNull()
    return (
        attach(final, uneven, ["hapar_id", "year"])
        .withColumns(
            {
                "land_parcel_area": F.coalesce("_max", "land_parcel_area"),
                "change_note": noted("change_note", hit, PARCEL_EQUALISED),
            }
        )
        .select(*final.columns)
    )


def infer_and_equalise(merged: DataFrame) -> DataFrame:
    """Rows that lie together are read again, for their areas alone, which costs less than to write them first."""
    kept = drop_empty_exclusions(infer_outsiders(merged))
    return equalise_parcel_area(kept if layout(kept.columns) is not None else stage(kept, "merged"))


def reconcile(owners: DataFrame, renters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(merged table, pairs) from prepared declarations."""
    pairs, owners_left, renters_left = match_owners_renters(owners, renters)
    merged = one_sided_rows(owners_left, renters_left).unionByName(merge_pairs(pairs))
    return infer_and_equalise(merged), pairs


