"""Matching owners with renters through key sets of decreasing specificity."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from landrecon.functions.text import pair_id
from landrecon.operators.filters import delete_where
from landrecon.operators.joins import HOT_PAIRS, anti, either_in, pair_join, semi
from landrecon.operators.lookups import attach
from landrecon.operators.rewrite import prefix_side
from landrecon.session import stage


@dataclass(frozen=True)
class Tier:
    """One key set. ``guard`` restricts its pairs; ``consume`` takes matched rows out of both
    pools before the next tier."""

    label: str
    keys: tuple[str, ...]
    guard: Column | None = None
    consume: bool = False


def _rounds(tiers: list[Tier]) -> list[list[tuple[int, Tier]]]:
    rounds: list[list[tuple[int, Tier]]] = [[]]
    for number, tier in enumerate(tiers, start=1):
        rounds[-1].append((number, tier))
        if tier.consume:
            rounds.append([])
    return [r for r in rounds if r]


def _one_round(
    left: DataFrame, right: DataFrame, tiers: list[tuple[int, Tier]], shared: list[str],
    row_id: str, hot_pairs: int,
) -> DataFrame:
    """All tiers that see the same pools, in one join.

    They join on the keys that all of them have. A pair belongs to the first tier whose further
    keys agree, so no pair can come out twice and no anti-join is needed.
    """
    common = [k for k in tiers[0][1].keys if all(k in t.keys for _, t in tiers)]
    extra_common = [k for k in common if k not in shared]
    measures = [c for c in left.columns if c not in shared]
    owners, users = prefix_side(left, measures, "owner"), prefix_side(right, measures, "user")
    for k in extra_common:
        owners = owners.withColumn(f"_k_{k}", F.col(f"owner_{k}"))
        users = users.withColumn(f"_k_{k}", F.col(f"user_{k}"))
    joined = pair_join(
        owners, users, [k if k in shared else f"_k_{k}" for k in common],
        f"owner_{row_id}", f"user_{row_id}", hot_pairs,
    )
    number, label = F.lit(None).cast("int"), F.lit(None).cast("string")
    for n, tier in reversed(tiers):
        agrees = F.lit(True)
        for k in tier.keys:
            if k not in common:
                agrees = agrees & (F.col(f"owner_{k}") == F.col(f"user_{k}"))
        if tier.guard is not None:
            agrees = agrees & tier.guard
        number = F.when(agrees, n).otherwise(number)
        label = F.when(agrees, F.lit(tier.label)).otherwise(label)
    return (
        joined.drop(*[f"_k_{k}" for k in extra_common])
        .withColumns({"tier": number, "tier_label": label})
        .filter(F.col("tier").isNotNull())
        .withColumn(row_id, pair_id(F.col(f"owner_{row_id}"), F.col(f"user_{row_id}")))
    )


def tiered_match(
    left: DataFrame, right: DataFrame, tiers: list[Tier], row_id: str = "claim_id",
    hot_pairs: int = HOT_PAIRS,
) -> DataFrame:
    """Pairs of owner and renter rows, each labelled with the first tier that made it.

    Both inputs have the same columns and a unique ``row_id``. The keys that every tier has
    stay unprefixed; all other columns come out as ``owner_…`` and ``user_…``. The pool
    shrinks only after a consuming tier; otherwise one row may appear in several pairs.
    """
    shared = [k for k in tiers[0].keys if all(k in t.keys for t in tiers)]
    found: DataFrame | None = None
    rounds = _rounds(tiers)
    for i, tiers_here in enumerate(rounds):
        pairs = _one_round(left, right, tiers_here, shared, row_id, hot_pairs)
        if i + 1 < len(rounds):
            pairs = stage(pairs, "pairs")
            left = remove_matched(left, pairs, row_id, "owner", tuple(shared))
            right = remove_matched(right, pairs, row_id, "user", tuple(shared))
        found = pairs if found is None else found.unionByName(pairs)
    return found


def remove_matched(
    pool: DataFrame, pairs: DataFrame, row_id: str, side: str, within: tuple[str, ...] = ()
) -> DataFrame:
    """The rows of a pool that are in no pair. ``within`` names keys that a row and its pairs share."""
    used = pairs.select(*within, F.col(f"{side}_{row_id}").alias(row_id))
    return anti(pool, used, [*within, row_id])


def prune_pairs(pairs: DataFrame, tier: int, rule: Column) -> DataFrame:
    """Drop the pairs of one tier that meet the rule. Catalyst moves the test into the join, so
    the pruned pairs are never shuffled on."""
    return delete_where(pairs, (F.col("tier") == tier) & rule)


def drop_superseded(
    pairs: DataFrame, weak: int, strong: int, row_id: str = "claim_id", within: tuple[str, ...] = ()
) -> DataFrame:
    """Drop weak pairs of any row that has a strong pair. ``within`` names keys that all pairs of a row share."""
    good = pairs.filter(F.col("tier") == strong)
    claims = good.select(*within, F.explode(F.array(f"owner_{row_id}", f"user_{row_id}")).alias("_claim"))
    weak_pairs = pairs.filter(F.col("tier") == weak)
    hit = either_in(
        weak_pairs,
        {"owner": F.col(f"owner_{row_id}"), "user": F.col(f"user_{row_id}")},
        claims,
        "_claim",
        within,
    )
    return anti(pairs, hit, [*within, row_id])


def repeated_side(pairs: DataFrame, side: str, row_id: str = "claim_id", more_than: int = 1) -> DataFrame:
    """Pairs whose row on one side appears in more than the given number of pairs."""
    key = f"{side}_{row_id}"
    often = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > more_than)
    return semi(pairs, often, [key])


def drop_weaker_pairs(pairs: DataFrame, row_id: str = "claim_id", within: tuple[str, ...] = ()) -> DataFrame:
    """Keep the best evidence per renter claim. ``within`` names keys that all pairs of a claim share.

    1. A tier-4 pair goes if either of its rows has a tier-1 pair.
    2. Of a renter claim with several pairs, the tier-4 pairs go.
    3. Of a renter claim that still has several pairs, those go that are not tier 1 and whose
       owner does not lease out.
    """
    better = stage(drop_superseded(pairs, 4, 1, row_id, within), "pairs")
    keys = [*within, f"user_{row_id}"]
    per_claim = better.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count(F.when(F.col("tier") != 4, 1)).alias("_left"),
    )
    counted = attach(better, per_claim, keys)
    step2 = (F.col("_n") > 1) & (F.col("tier") == 4)
    still = F.when(F.col("_n") > 1, F.col("_left")).otherwise(F.col("_n")) > 1
    step3 = still & (F.col("tier") != 1) & (F.col("owner_land_leased_out") == "N")
    return delete_where(counted, step2 | step3).select(*pairs.columns)


def late_tier_repeats(pairs: DataFrame, early: int = 2, row_id: str = "claim_id") -> DataFrame:
    """Pairs beyond the early tiers of renter claims that have several pairs."""
    return repeated_side(pairs, "user", row_id).filter(F.col("tier") > early)


def split_one_sided(
    owners: DataFrame, users: DataFrame, keys: list[str]
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(owners with users, users with owners, owners alone, users alone), by the keys."""
    return (
        semi(owners, users, keys),
        semi(users, owners, keys),
        anti(owners, users, keys),
        anti(users, owners, keys),
    )


def single_claims(df: DataFrame, other: DataFrame, keys: list[str], parcel: str) -> DataFrame:
    """Rows alone within their keys, on parcels that the other table never mentions."""
    alone = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n = 1").select(*keys)
    return semi(anti(df, other, [parcel]), alone, keys)
