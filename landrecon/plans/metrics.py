"""Quality metrics and detectors over the declarations, pairs, merged table and commons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from landrecon.functions.rings import area_hectares
from landrecon.functions.numbers import round2
from landrecon.operators.aggregates import bucket_count, distinct_per_group
from landrecon.operators.filters import area_mismatch
from landrecon.operators.joins import detail_join, semi
from landrecon.operators.lookups import attach
from landrecon.operators.matching import repeated_side
from landrecon.plans.reconcile import EXCLUDED
from landrecon.session import layout

PARCEL_YEAR = ["hapar_id", "year"]


def _cells(df: DataFrame, measure: Column) -> DataFrame:
    """Rows reduced to one per parcel, year and parcel area, with the parcel-year total."""
    cells = df.groupBy(*PARCEL_YEAR, "land_parcel_area").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(measure).alias("_part")
    )
    if layout(PARCEL_YEAR) is not None:
        # A join in which NULLs match would not take the cells where they lie; a window does, and no parcel is large.
        return cells.withColumn("total", F.sum("_part").over(Window.partitionBy(*PARCEL_YEAR)))
    totals = cells.groupBy(*PARCEL_YEAR).agg(F.sum("_part").alias("total"))
    return attach(cells, totals, PARCEL_YEAR, null_safe=True)


def parcel_vs_use(df: DataFrame) -> DataFrame:
    """M1: rows by how the parcel area compares with the parcel's summed use area."""
    parcel, used = F.col("land_parcel_area"), F.col("total")
    label = (
        F.when(parcel > used, "Parcel > LU")
        .when(parcel == used, "Equal")
        .when(parcel < used, "Parcel < LU")
        .otherwise("Other")
    )
    cells = _cells(df, F.col("land_use_area"))
    return cells.groupBy(label.alias("area_comparison")).agg(F.sum("_n").alias("n"))


def single_overclaim(pairs: DataFrame) -> DataFrame:
    """M2: pairs whose claims together exceed either side's parcel area."""
    claimed = F.col("owner_bps_claimed_area") + F.col("user_bps_claimed_area")
    over = (claimed > F.col("owner_land_parcel_area")) | (claimed > F.col("user_land_parcel_area"))
    return (
        pairs.filter(over)
        .select("hapar_id", "year", (claimed - F.col("owner_land_parcel_area")).alias("diff"))
        .orderBy(F.col("diff").desc_nulls_first())
    )


def flag_agreement(owners: DataFrame, renters: DataFrame) -> DataFrame:
    """M3: how the leased-out flags agree where both sides match on four keys. Each side is
    reduced to distinct flags per key first, so a key makes a handful of pairs at most."""
    keys = [*PARCEL_YEAR, "land_use", "land_use_area"]
    left = owners.select(*keys, F.col("land_leased_out").alias("_p")).distinct()
    right = renters.select(*keys, F.col("land_leased_out").alias("_s")).distinct()
    p, s = F.col("_p"), F.col("_s")
    known = p.isin("Y", "N") & s.isin("Y", "N")
    outcome = F.when(p == s, F.concat(p, F.lit(" match"))).otherwise(F.concat(p, F.lit("-"), s, F.lit(" no match")))
    label = F.when(known, outcome).otherwise("Other")
    combos = detail_join(left, right, keys).select(*PARCEL_YEAR, "_p", "_s").distinct()
    return bucket_count(combos, label, "llo_flag_compare")


def matched_area(shapes: DataFrame, claims: DataFrame) -> DataFrame:
    """M6, M7: digitised area of the parcels that have a claim in the year, all years at once."""
    parcels = shapes.select(*PARCEL_YEAR, "digi_area").distinct()
    found = semi(parcels, claims, PARCEL_YEAR)
    return found.groupBy("year").agg(F.sum("digi_area").alias("digi_area"))


def claim_keys(owners: DataFrame, renters: DataFrame) -> DataFrame:
    """Parcels and years that either raw table mentions."""
    return owners.select(*PARCEL_YEAR).unionByName(renters.select(*PARCEL_YEAR)).distinct()


def area_bands(final: DataFrame, shapes: DataFrame, strict: bool = True) -> DataFrame:
    """M9: parcels by how far the digitised area is from the declared one, per year. With
    ``strict`` a difference of exactly 0.01, or an unknown one, counts as large."""
    diff = F.abs(F.col("land_parcel_area") - F.col("digi_area"))
    small = diff < 0.01 if strict else diff <= 0.01
    medium = (diff > 0.01) & (diff < 0.1)
    band = F.when(small, "< 0.01 difference").when(medium, "< 0.1 difference")
    large = F.lit("> 0.1 difference")
    if not strict:
        large = F.when(diff.isNotNull(), large).otherwise("unknown")
    declared = final.select(*PARCEL_YEAR, "land_parcel_area").distinct()
    joined = detail_join(declared, shapes.select(*PARCEL_YEAR, "digi_area"), PARCEL_YEAR)
    return joined.groupBy("year", band.otherwise(large).alias("digi_area_match")).agg(
        F.count(F.lit(1)).alias("n")
    )


def overclaims(final: DataFrame) -> DataFrame:
    """Parcels and years whose claims of both sides exceed the parcel area."""
    owner, user = F.col("owner_bps_claimed_area"), F.col("user_bps_claimed_area")
    cells = _cells(final, F.coalesce(owner + user, owner, user))
    over = F.col("total") - F.col("land_parcel_area")
    return cells.filter(over > 0).select(
        *PARCEL_YEAR, F.col("total").alias("total_claim"), "land_parcel_area", over.alias("diff")
    )


def distinct_of_both_sides(final: DataFrame, col: str) -> DataFrame:
    """Distinct known values of both sides per parcel and year, in one scan."""
    both = F.explode(F.array(f"owner_{col}", f"user_{col}"))
    values = final.select(*PARCEL_YEAR, both.alias("_v")).filter(F.col("_v").isNotNull())
    return distinct_per_group(values, PARCEL_YEAR, "_v")


def region_mismatch(detail: DataFrame) -> DataFrame:
    """Eligible area that differs from the sum of the three payment regions."""
    regions = F.col("payment_region_1") + F.col("payment_region_2") + F.col("payment_region_3")
    return detail.filter(F.col("bps_eligible_area") != regions).select(
        "cg_hahol_id", "hapar_id", "year", "digitised_area", "excluded_land_area",
        "bps_eligible_area", regions.alias("region_total"),
        (F.col("bps_eligible_area") - regions).alias("diff"),
    )


def digitised_mismatch(detail: DataFrame, shapes: DataFrame) -> DataFrame:
    """Digitised area that differs from the area of the parcel's polygon in the same year."""
    measured = shapes.select(
        *PARCEL_YEAR, "hahol_id", "start_date",
        round2(area_hectares(F.col("ring"))).alias("calced_has"),
    )
    regions = F.col("payment_region_1") + F.col("payment_region_2") + F.col("payment_region_3")
    gap = F.abs(F.col("calced_has") - F.col("digitised_area"))
    return (
        detail_join(detail, measured, PARCEL_YEAR)
        .filter(gap != 0)
        .select(
            "hapar_id", "cg_hahol_id", "hahol_id", "year", "start_date", "calced_has",
            "digitised_area", gap.alias("digi_diff"), regions.alias("sum_pay_regs"),
            "bps_eligible_area", "excluded_land_area",
        )
    )


def declared_vs_digitised(raw: DataFrame, shapes: DataFrame) -> DataFrame:
    """Declared uses of a parcel and year whose total differs from the digitised area."""
    sums = (
        raw.filter(F.col("land_use_area") != 0)
        .groupBy(*PARCEL_YEAR)
        .agg(F.sum("land_use_area").alias("declared"))
    )
    joined = detail_join(shapes.select(*PARCEL_YEAR, "digi_area"), sums, PARCEL_YEAR)
    return area_mismatch(joined, "digi_area", "declared")


def owner_repeats(pairs: DataFrame) -> DataFrame:
    """Owner claims in several pairs, excluded uses aside."""
    return repeated_side(pairs, "owner").filter(~F.col("owner_land_use").isin(*EXCLUDED))


def side_sum_diff(pairs: DataFrame, col: str) -> DataFrame:
    """Parcels and years whose owner and renter sums differ over the pairs."""
    sums = pairs.groupBy(*PARCEL_YEAR).agg(
        F.sum(f"owner_{col}").alias("sum_owner"), F.sum(f"user_{col}").alias("sum_user")
    )
    gap = F.abs(F.col("sum_owner") - F.col("sum_user"))
    return (
        sums.filter(F.col("sum_owner") != F.col("sum_user"))
        .withColumn("diff", gap)
        .orderBy(F.col("diff").desc())
    )


def total_overclaim(df: DataFrame) -> DataFrame:
    """Parcel area minus claim, over all rows of the overclaimed parcels and years."""
    sums = df.groupBy(*PARCEL_YEAR).agg(
        F.sum("bps_claimed_area").alias("_claimed"),
        F.min("land_parcel_area").alias("_parcel"),
        F.sum(F.col("land_parcel_area") - F.col("bps_claimed_area")).alias("_gap"),
    )
    over = sums.filter(F.col("_claimed") > F.col("_parcel"))
    return over.agg(F.sum("_gap").alias("total_overclaim"))


def use_ratio(pairs: DataFrame, side: str) -> DataFrame:
    """Pairs whose use area exceeds the parcel, with the ratio of parcel to use."""
    parcel, used = F.col(f"{side}_land_parcel_area"), F.col(f"{side}_land_use_area")
    ratio = F.try_divide(parcel.cast("double"), used.cast("double"))
    return (
        pairs.filter(used >= parcel)
        .select("hapar_id", "year", ratio.alias("percent_right"))
        .filter(F.col("percent_right") != 1)
        .orderBy("percent_right")
    )


def claim_kind_mismatch(commons: DataFrame) -> DataFrame:
    """Both kinds of claim are made and differ."""
    basic, lfass = F.col("bps_claimed_area"), F.col("lfass_claimed_area")
    return commons.filter((basic != lfass) & (basic != 0) & (lfass != 0))


def underclaims(commons: DataFrame) -> DataFrame:
    """Grazings that claim less than is eligible, by either kind of claim."""
    eligible = F.col("lpid_bps_eligible_area")
    sums = commons.groupBy("cg_hahol_id", "year", "lpid_bps_eligible_area").agg(
        F.sum("bps_claimed_area").alias("sum_bps_claim"),
        F.sum("lfass_claimed_area").alias("sum_lfass_claim"),
    )
    basic, lfass = eligible - F.col("sum_bps_claim"), eligible - F.col("sum_lfass_claim")
    return (
        sums.withColumns({"bps_underclaim_diff": basic, "lfass_underclaim_diff": lfass})
        .filter((F.col("bps_underclaim_diff") > 0) | (F.col("lfass_underclaim_diff") > 0))
        .orderBy(F.col("bps_underclaim_diff").desc_nulls_first())
    )


def single_use_shares(commons: DataFrame) -> DataFrame:
    """X11: rows of shares that are declared several times with one land use."""
    keys = ["cg_hahol_id", "share_hahol_id", "year"]
    groups = (
        commons.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.min("land_use").alias("_a"),
            F.max("land_use").alias("_b"),
        )
        .filter((F.col("_n") > 1) & (F.col("_a") == F.col("_b")))
        .select(*keys)
    )
    return attach(commons, groups, keys, "inner")


def plausible_loose(pairs: DataFrame, tier: int = 4) -> DataFrame:
    """Loose pairs between productive uses other than the usual grass swaps."""
    owner, user = F.col("owner_land_use"), F.col("user_land_use")
    return pairs.filter(
        (F.col("tier") == tier)
        & (owner != "RGR") & (user != "PGRS") & (owner != "PGRS") & (user != "RGR")
        & ~owner.like("%TGRS%") & ~user.like("%TGRS%")
        & ~owner.isin(*EXCLUDED) & ~user.isin(*EXCLUDED)
    )
