"""Imputed rows, doubled rows and rows filed on the wrong side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from landrecon.functions.text import pg_concat, trim_chars
from landrecon.operators.filters import GENERIC_EXCLUSIONS, WAITING, delete_where
from landrecon.operators.joins import anti
from landrecon.operators.lookups import attach, with_totals
from landrecon.operators.notes import noted
from landrecon.session import stage

PARCEL = ["hapar_id", "land_parcel_area", "year"]
BUSINESS = ["mlc_hahol_id", "habus_id", "hahol_id"]
HOLDER = [*BUSINESS, *PARCEL]

# Codes and wording.
IMPUTED = "IMPUTED_RECORD"
REMAINDER_IMPUTED = (
    "imputed record to correct difference when sum(land_use_area) < land_parcel_area; "
)
REMAINDER_TRANSFERRED = (
    "land_use_area calculated from missing total land_parcel_area for single claims; "
)
RENTER_IMPUTED = (
    "imputed record to create non-SAF renter claim where LLO yes in permanent table; "
)
TO_RENTERS = "S record moved from permanent to seasonal sheet; "
TO_OWNERS = "P record moved from seasonal to permanent sheet; "
DOUBLED_OWNERS = "change to seasonal record; "
DOUBLED_RENTERS = "change to seasonal; "
HALF_PARCEL = "is_perm_flag changed to N; "
MOVED_MARK = "s"


def _no_area() -> Column:
    return F.col("land_use_area").isNull() | (F.col("land_use_area") == 0)


def impute_remainder(df: DataFrame, is_perm_flag: str = "Y") -> DataFrame:
    """Give the undeclared rest of a parcel to its holders.

    Where the declared uses of a parcel and year are positive but fall short of the parcel,
    each holder is owed the rest. A holder with exactly one row without area receives it
    there, provided no holder of the parcel has several such rows; any other holder gets an
    imputed row for each note that its rows bear. The detail is reduced once, to holders and their notes;
    it is read only once more, to receive the transfers.
    """
    noted_holders = stage(
        df.groupBy(*HOLDER, F.col("change_note").alias("_note")).agg(
            F.count(F.when(_no_area(), 1)).alias("_empty"), F.sum("land_use_area").alias("_sum")
        ),
        "holders",
    )
    holders = noted_holders.groupBy(*HOLDER).agg(F.sum("_empty").alias("_empty"), F.sum("_sum").alias("_sum"))
    used = holders.groupBy(*PARCEL).agg(F.sum("_sum").alias("_used"))
    owed = (
        attach(holders, used, PARCEL)
        .filter((F.col("_used") > 0) & (F.col("_used") < F.col("land_parcel_area")))
        .withColumn(
            "_rest", (F.col("land_parcel_area") - F.col("_used")).cast(df.schema["land_use_area"].dataType)
        )
    )
    owed = stage(owed, "remainders")
    complete = F.lit(True)
    for c in BUSINESS:
        complete = complete & F.col(c).isNotNull()
    doubled = owed.filter((F.col("_empty") > 1) & complete)
    receiving = anti(owed.filter((F.col("_empty") == 1) & complete), doubled, ["hapar_id"])
    receiving = receiving.select(*HOLDER, F.col("_rest").alias("_given"))
    hit = F.col("_given").isNotNull() & _no_area()
    filled = attach(df, receiving, HOLDER).withColumns(
        {
            "land_use_area": F.when(hit, F.col("_given")).otherwise(F.col("land_use_area")),
            "change_note": noted("change_note", hit, REMAINDER_TRANSFERRED),
        }
    )
    others = attach(owed, receiving, HOLDER, null_safe=True).filter(F.col("_given").isNull())
    others = attach(noted_holders.select(*HOLDER, "_note"), others.select(*HOLDER, "_rest"), HOLDER, "inner", null_safe=True)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    values = {
        **{c: F.col(c) for c in HOLDER},
        "bps_claimed_area": F.lit(0),
        "land_use_area": F.col("_rest"),
        "land_use": F.lit(IMPUTED),
        "is_perm_flag": F.lit(is_perm_flag),
        "change_note": pg_concat(F.col("_note"), F.lit(REMAINDER_IMPUTED)),
    }
    rows = others.select(
        *[values.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in df.columns]
    )
    return filled.select(*df.columns).unionByName(rows)


def impute_renter(owners: DataFrame) -> DataFrame:
    """A renter outside the scheme for each owner row that leases out."""
    kinds = {f.name: f.dataType for f in owners.schema.fields}
    fixed = {
        "land_use": F.lit(IMPUTED),
        "land_leased_out": F.lit("N"),
        "is_perm_flag": F.lit("N"),
        "change_note": pg_concat(F.col("change_note"), F.lit(RENTER_IMPUTED)),
        **{c: F.lit(None) for c in (*BUSINESS, "claim_id")},
    }
    leased = owners.filter(F.col("land_leased_out") == "Y")
    return leased.select(
        *[fixed.get(c, F.col(c)).cast(kinds[c]).alias(c) for c in owners.columns]
    )


def drop_doubled(df: DataFrame) -> DataFrame:
    """Drop inactive, unflagged rows of parcels whose uses add up to exactly twice the parcel."""
    totals = with_totals(df, PARCEL, {"_used": F.sum("land_use_area")}, null_safe=False)
    twice = F.try_divide(F.col("_used") * 100, F.col("land_parcel_area")) == 200
    idle = (F.col("land_activity") == "") | F.col("land_activity").like("%No Activity%")
    return delete_where(totals, twice & idle & (F.col("lfass_flag") == "N")).select(*df.columns)


def drop_waiting(df: DataFrame) -> DataFrame:
    """Drop parcels and years that have a waiting row without any use area, or a row that is
    not eligible while the parcel has no use area."""
    cells = df.groupBy(*PARCEL).agg(
        F.sum("land_use_area").alias("_used"),
        F.max(F.coalesce(F.col("application_status").like(WAITING), F.lit(False))).alias("_waiting"),
        F.max(F.coalesce(F.col("bps_eligible_area") == 0, F.lit(False))).alias("_ineligible"),
    )
    used = F.col("_used")
    unused = F.coalesce(F.try_divide(used, F.col("land_parcel_area")) == 0, F.lit(False))
    bad = cells.filter(((used.isNull() | (used == 0)) & F.col("_waiting")) | (F.col("_ineligible") & unused))
    return anti(df, bad.select("hapar_id", "year").distinct(), ["hapar_id", "year"])


def _business() -> Column:
    """The business as one comparable value; NULL unless all its ids are known."""
    known = F.lit(True)
    for c in BUSINESS:
        known = known & F.col(c).isNotNull()
    return F.when(known, F.struct(*BUSINESS))


def later_businesses(df: DataFrame) -> DataFrame:
    """Businesses of a parcel and year after the first, with their claimed area."""
    claims = (
        df.withColumn("_b", _business())
        .filter(F.col("_b").isNotNull())
        .groupBy("hapar_id", "year", "_b")
        .agg(F.sum("bps_claimed_area").alias("_claim"))
    )
    first = claims.groupBy("hapar_id", "year").agg(F.min("_b").alias("_first"))
    later = attach(claims, first, ["hapar_id", "year"], "inner").filter(
        F.col("_b") > F.col("_first")
    )
    return later.select("hapar_id", "year", "_b.*", "_claim")


def _move_out(df: DataFrame, hit: Column, mark: str, note: str, lease: bool) -> DataFrame:
    """Re-label the rows that change sides."""
    old = "P" if mark == "S" else "S"
    new_id = F.concat(F.lit(mark), trim_chars(F.col("claim_id"), old), F.lit("-01"))
    changes = {
        "claim_id": F.when(hit, new_id).otherwise(F.col("claim_id")),
        "is_perm_flag": F.when(hit, F.lit("N" if mark == "S" else "Y")).otherwise(
            F.col("is_perm_flag")
        ),
        "change_note": noted("change_note", hit, note),
    }
    if lease:
        leased = hit & (F.col("land_use") != GENERIC_EXCLUSIONS[0])
        changes["land_leased_out"] = F.when(leased, F.lit("Y")).otherwise(F.col("land_leased_out"))
    return df.withColumns({**changes, "_moved": F.coalesce(hit, F.lit(False))})


def _exchange(owners: DataFrame, renters: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    def pick(df: DataFrame, moved: bool) -> DataFrame:
        return df.filter(F.col("_moved") == moved).select(*columns)

    return (
        pick(owners, False).unionByName(pick(renters, True)),
        pick(renters, False).unionByName(pick(owners, True)),
    )


def move_extra_businesses(owners: DataFrame, renters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A later business that claims among the owners is a renter; one that claims nothing among
    the renters is an owner."""
    keys = ["hapar_id", "year", *BUSINESS]
    claiming = later_businesses(owners).filter(F.col("_claim") != 0)
    silent = later_businesses(renters).filter(F.col("_claim") == 0)
    on_owners = attach(owners, claiming, keys)
    on_renters = attach(renters, silent, keys)
    out = F.col("_claim").isNotNull()
    moved_owners = _move_out(on_owners, out & (F.col("land_leased_out") == "N"), "S", TO_RENTERS, False)
    moved_renters = _move_out(on_renters, out, "P", TO_OWNERS, True)
    return _exchange(moved_owners, moved_renters, owners.columns)


def swapped_parcels(owners: DataFrame, renters: DataFrame) -> DataFrame:
    """Parcels and years whose matching rows show claims on the owner's side only.

    The sums over all matching pairs are taken from per-key sums: a pair's sum over the owner
    is the owner total times the number of renters, so no pair is ever made.
    """
    keys = ["hapar_id", "year", "land_use", "land_use_area"]

    def sums(df: DataFrame, side: str) -> DataFrame:
        return df.groupBy(*keys).agg(
            F.sum("bps_claimed_area").alias(f"_{side}"), F.count(F.lit(1)).alias(f"_n_{side}")
        )

    both = sums(owners, "o").join(sums(renters, "u"), keys)
    return (
        both.groupBy("hapar_id", "year")
        .agg(
            F.sum(F.col("_o") * F.col("_n_u")).alias("_o"),
            F.sum(F.col("_u") * F.col("_n_o")).alias("_u"),
        )
        .filter((F.col("_o") != 0) & (F.col("_u") == 0))
        .select("hapar_id", "year", F.lit(True).alias("_swap"))
    )


def swap_parcels(owners: DataFrame, renters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Exchange the sides of swapped parcels; owners that lease out stay."""
    swapped = stage(swapped_parcels(owners, renters), "swapped")
    hit = F.coalesce("_swap", F.lit(False))
    on_owners = attach(owners, swapped, ["hapar_id", "year"])
    on_renters = attach(renters, swapped, ["hapar_id", "year"])
    moved_owners = _move_out(on_owners, hit & (F.col("land_leased_out") == "N"), "S", TO_RENTERS, True)
    moved_renters = _move_out(on_renters, hit, "P", TO_OWNERS, True)
    return _exchange(moved_owners, moved_renters, owners.columns)


def reassign_sides(owners: DataFrame, renters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Move rows filed on the wrong side, first by business, then by parcel."""
    p, s = move_extra_businesses(owners, renters)
    return swap_parcels(stage(p, "owners-moved"), stage(s, "renters-moved"))


def _marked(df: DataFrame, hit: Column, note: str, flag: str | None = None) -> DataFrame:
    """Mark the ids of the rows that are to change sides, with a note."""
    changes = {
        "claim_id": F.when(hit, F.concat(F.lit(MOVED_MARK), "claim_id")).otherwise(F.col("claim_id")),
        "change_note": noted("change_note", hit, note),
    }
    if flag:
        changes["is_perm_flag"] = F.when(hit, F.lit(flag)).otherwise(F.col("is_perm_flag"))
    return df.withColumns(changes)


def mark_doubled_parcels(df: DataFrame, note: str) -> DataFrame:
    """Early pass over parcels whose uses add up to exactly twice the parcel: where they have
    several holders or activities, the rows that claim all of their use are marked."""
    keys = ["hapar_id", "year"]
    cells = df.groupBy(*PARCEL).agg(F.sum("land_use_area").alias("_used"))
    twice = F.try_divide(F.col("_used") * 100, F.col("land_parcel_area")) == 200
    holders = df.select(*keys, *BUSINESS, "land_activity").distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    doubled = attach(holders.filter("_n > 1"), cells.filter(twice), keys, "left_semi")
    joined = attach(df, doubled.select(*keys, F.lit(True).alias("_doubled")), keys)
    claimed = F.col("bps_claimed_area")
    hit = F.coalesce(F.col("_doubled") & (claimed == F.col("land_use_area")) & (claimed != 0), F.lit(False))
    return _marked(joined, hit, note).drop("_doubled")


def move_excluded_uses(owners: DataFrame, renters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of excluded use of a later business, without a change of its lease: renters if it claims
    among the owners, owners if it claims nothing among the renters, then with all its other rows
    of the parcel and year. The rows are re-labelled in place."""
    keys = ["hapar_id", "year", *BUSINESS]

    def later(df: DataFrame, claims: bool) -> DataFrame:
        nothing = F.col("_claim") == 0
        found = later_businesses(df).filter(~nothing if claims else nothing)
        return attach(df, found.select(*keys, F.lit(True).alias("_later")), keys)

    excluded = F.coalesce(F.col("_later"), F.lit(False)) & (F.col("land_use") == GENERIC_EXCLUSIONS[0])
    on_owners = later(owners, True).withColumn("_hit", F.coalesce(excluded, F.lit(False)))
    on_renters = later(renters, False).withColumn("_hit", F.coalesce(excluded, F.lit(False)))
    with_excluded = on_renters.filter("_hit").select(*keys).distinct().withColumn("_other", F.lit(True))
    on_renters = attach(on_renters, with_excluded, keys)
    hit, other = F.col("_hit"), ~F.col("_hit") & F.coalesce(F.col("_other"), F.lit(False))

    def changed(df: DataFrame, mark: str, flag: str, note: str, moved: Column, new_id: Column) -> DataFrame:
        return df.withColumns(
            {
                "claim_id": new_id, "is_perm_flag": F.when(moved, F.lit(flag)).otherwise(F.col("is_perm_flag")),
                "change_note": noted("change_note", moved, note),
            }
        ).select(*owners.columns)

    own = F.col("claim_id")
    owner_id = F.when(hit, F.concat(F.lit("S"), own)).otherwise(own)
    renter_id = (
        F.when(hit, F.concat(F.lit("P"), own)).when(other, F.concat(F.lit("P"), trim_chars(own, "S"))).otherwise(own)
    )
    return (
        changed(on_owners, "S", "N", TO_RENTERS, hit, owner_id),
        changed(on_renters, "P", "Y", TO_OWNERS, hit | other, renter_id),
    )


def flag_half_parcels(df: DataFrame) -> DataFrame:
    """Rows without a lease on parcels of which the uses of a year are exactly twice the area."""
    sums = df.groupBy("hapar_id", "year").agg(F.sum("land_use_area").alias("_used"))
    areas = df.select("hapar_id", "year", "land_parcel_area").distinct()
    half = attach(areas, sums, ["hapar_id", "year"], "inner").filter(
        (F.col("land_parcel_area") > 0) & (F.col("land_parcel_area") * 2 == F.col("_used"))
    )
    joined = attach(df, half.select("hapar_id", "year").distinct().withColumn("_half", F.lit(True)), ["hapar_id", "year"])
    hit = F.coalesce(F.col("_half") & (F.col("land_leased_out") == "N"), F.lit(False))
    return _marked(joined, hit, HALF_PARCEL, "N").drop("_half")
