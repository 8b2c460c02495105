"""A key that holds a third of all rows is split over several tasks, and nothing is lost."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from landrecon.operators import joins, lookups, matching

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
}
ROWS = 400_000


@pytest.fixture
def small_partitions(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def skewed(spark):
    ids = spark.range(0, ROWS, numPartitions=16)
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 5000)
    return ids.select(
        key.alias("k"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("claim_id"),
        (F.col("id") % 7).alias("x"), F.sha2(F.col("id").cast("string"), 512).alias("ballast"),
    )


def run(df):
    """Rows and final plan of one execution."""
    execution = df._jdf.queryExecution()
    return execution.toRdd().count(), execution.executedPlan().toString()


def test_group_totals_split_the_hot_key(small_partitions, skewed):
    count, plan = run(lookups.with_totals(skewed, ["k"], {"t": F.sum("x")}, null_safe=False))
    assert count == ROWS
    assert "skew=true" in plan and "Window" not in plan


def test_anti_join_splits_the_hot_key(small_partitions, skewed):
    others = skewed.filter("k % 2 = 1").select("k")
    count, plan = run(joins.anti(skewed, others, ["k"]))
    assert count == skewed.filter("k % 2 <> 1").count()
    assert "skew=true" in plan


def test_hot_pairs_are_spread_evenly(small_partitions, skewed):
    """The hot key's pairs fall into many join cells, none of which holds more than a few."""
    left = skewed.select("k", F.col("claim_id").alias("l"))
    right = skewed.filter("x < 1").select("k", F.col("claim_id").alias("r")).filter("k <> -1 OR r < 'c12'")
    pairs = joins.pair_join(left, right, ["k"], "l", "r", hot_pairs=1_000_000)
    expected = left.groupBy("k").count().join(right.groupBy("k").agg(F.count(F.lit(1)).alias("m")), "k")
    assert pairs.count() == expected.agg(F.sum(F.col("count") * F.col("m"))).first()[0]


def test_best_pair_of_a_hot_claim(spark, rows):
    pairs = spark.range(0, 30_000, numPartitions=8).select(
        F.lit("S1").alias("user_claim_id"), F.concat(F.lit("P"), F.col("id").cast("string")).alias("owner_claim_id"),
        F.concat(F.lit("P"), F.col("id").cast("string"), F.lit(", S1")).alias("claim_id"),
        F.when(F.col("id") == 7, 1).otherwise(4).alias("tier"), F.lit("Y").alias("owner_land_leased_out"),
    )
    assert rows(matching.drop_weaker_pairs(pairs), "claim_id") == [("P7, S1",)]


def test_other_parties_of_a_hot_key_in_slices(spark, rows):
    """A third of the rows share one key; a grid of small cells gives what one cell gives."""
    df = spark.range(900).selectExpr(
        "IF(id % 3 = 0, 1, id) AS k", "CAST(id AS string) AS row", "IF(id % 7 = 0, NULL, id % 4) AS party", "id % 5 = 0 AS flag"
    )
    data = df.collect()
    want = [
        (a.k, a.row, b.row) for a in data for b in data
        if a.k == b.k and b.flag and a.party is not None and b.party is not None and a.party != b.party
    ]
    for hot_pairs in (10**8, 500, 7):
        out = joins.other_party_join(df, ["k"], "party", F.col("flag"), "row", hot_pairs)
        assert rows(out, "k", "row", "other_row") == sorted(want, key=lambda r: [(v is None, str(v)) for v in r]), hot_pairs
