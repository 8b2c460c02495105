"""Error flags of the merged table, each a text appended to ``error_log``."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from landrecon.functions.choice import NON_SCHEME_USE
from landrecon.functions.text import split_part
from landrecon.operators.lookups import attach
from landrecon.operators.notes import noted_all
from landrecon.operators.rewrite import add_null_col
from landrecon.plans.reconcile import EXCLUDED
from landrecon.session import layout

PARCEL_YEAR = ["hapar_id", "year"]
SEPARATOR = ", "

# Wording of the flags, in the order in which they are appended.
FLAG_TEXTS = {
    "E1": "owner_hahol_id <> user_hahol_id; ",
    "E2": "multiple permanent businesses declaring on same hapar_id; ",
    "E3": "sum(owner_land_parcel_area) <> sum(user_land_parcel_area); ",
    "E4": "sum(owner_bps_eligible_area) <> sum(user_bps_eligible_area); ",
    "E5": "doubled user claims in join (one to many); ",
    "E6": "seasonal renter with LLO yes; ",
    "E7": "doubled owner claims in join (many to one); ",
    "E8": "multiple seasonal businesses declaring on same hapar_id; ",
    "E9": "owner_land_use <> user_land_use; ",
    "E10": "sum(land_use_area) > land_parcel_area; ",
    "E11": "sum(bps_claimed_area) > land_parcel_area; ",
}
FROM_PARCEL = {"E2", "E8", "E10", "E11"}
FROM_PAIRS = {"E3", "E4"}
# Told from the row alone.
IN_ROW = {"E1", "E6", "E9"}
# Claims may appear in this many merged rows before they are flagged.
CLAIM_LIMITS = {"E5": ("user", 2, 2), "E7": ("owner", 1, 1)}


def _several(col: str) -> Column:
    """More than one distinct known value: no distinct count needed."""
    return F.min(col) != F.max(col)


def parcel_flags(final: DataFrame, wanted: Iterable[str] = tuple(FLAG_TEXTS)) -> DataFrame:
    """Flags that depend on all rows of a parcel and year; only flagged parcels come out."""
    owner_use, user_use = F.col("owner_land_use_area"), F.col("user_land_use_area")
    owner_claim, user_claim = F.col("owner_bps_claimed_area"), F.col("user_bps_claimed_area")
    smallest = F.min("land_parcel_area")
    conditions = {
        "E2": _several("owner_habus_id"),
        "E8": _several("user_habus_id"),
        "E10": F.sum(F.coalesce(owner_use, user_use)) > smallest,
        "E11": F.sum(F.coalesce(owner_claim + user_claim, owner_claim, user_claim)) > smallest,
    }
    return _flagged(final, {e: c for e, c in conditions.items() if e in set(wanted)})


def pair_flags(pairs: DataFrame, wanted: Iterable[str] = tuple(FLAG_TEXTS)) -> DataFrame:
    """Flags that compare the sides' sums over the pairs of a parcel and year."""
    conditions = {
        "E3": F.sum("owner_land_parcel_area") != F.sum("user_land_parcel_area"),
        "E4": F.sum("owner_bps_eligible_area") != F.sum("user_bps_eligible_area"),
    }
    return _flagged(pairs, {e: c for e, c in conditions.items() if e in set(wanted)})


def _flagged(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    sure = [F.coalesce(c, F.lit(False)).alias(e) for e, c in conditions.items()]
    flags = df.groupBy(*PARCEL_YEAR).agg(*sure)
    return flags.filter(F.greatest(F.lit(False), *conditions))


def _claim_part(side: str) -> Column:
    return split_part(F.col("claim_id"), SEPARATOR, 1 if side == "owner" else 2)


def repeated_claims(final: DataFrame, side: str, more_than: int) -> DataFrame:
    """Claims of one side that appear in more than the given number of joined rows of a parcel and
    year. A claim lies in one parcel and year."""
    joined = final.filter(F.col("change_note").like("%join%"))
    return (
        joined.groupBy(*PARCEL_YEAR, _claim_part(side).alias("_claim"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > more_than)
        .select(*PARCEL_YEAR, "_claim")
    )


def flag_errors(
    final: DataFrame, pairs: DataFrame | None = None, only: Iterable[str] | None = None,
    log: str = "error_log",
) -> DataFrame:
    """Append the flags, all eleven or those named in ``only``, to a new ``error_log`` column.

    One aggregation by parcel and year serves four flags and one over the pairs serves two more;
    the lookups hold flagged keys only. Claims are counted within their parcel and year.
    """
    wanted = [e for e in FLAG_TEXTS if only is None or e in set(only)]
    marked = final if log in final.columns else add_null_col(final, log)
    columns = marked.columns
    lookups = []
    if FROM_PARCEL & set(wanted):
        lookups.append(parcel_flags(final, wanted))
    if FROM_PAIRS & set(wanted):
        lookups.append(pair_flags(pairs, wanted))
    if lookups:
        # Both are grouped by the same keys, so joining them first takes no further shuffle; where the
        # detail lies by the parcel as well, it meets them one by one.
        if layout(PARCEL_YEAR) is None:
            lookups = [reduce(lambda a, b: a.join(b, PARCEL_YEAR, "full"), lookups)]
        for lookup in lookups:
            marked = attach(marked, lookup, PARCEL_YEAR)
    for flag, (side, part, limit) in CLAIM_LIMITS.items():
        if flag not in wanted:
            continue
        # A row without a partner has no second part; no claim is empty.
        own = split_part(F.col("claim_id"), SEPARATOR, part)
        found = repeated_claims(final, side, limit).withColumn(flag, F.lit(True))
        keys = [*PARCEL_YEAR, "_claim"]
        marked = attach(marked.withColumn("_claim", own), found, keys).drop("_claim")

    owner_use, user_use = F.col("owner_land_use"), F.col("user_land_use")
    in_row = {
        "E1": F.col("owner_hahol_id") != F.col("user_hahol_id"),
        "E6": F.col("user_land_leased_out") == "Y",
        "E9": (owner_use != user_use)
        & ~owner_use.isin(*EXCLUDED, NON_SCHEME_USE)
        & ~user_use.isin(*EXCLUDED, NON_SCHEME_USE),
    }
    entries = [(in_row[e] if e in in_row else F.col(e), FLAG_TEXTS[e]) for e in wanted]
    return marked.withColumn(log, noted_all(log, entries)).select(*columns)
