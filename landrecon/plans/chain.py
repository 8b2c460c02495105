"""The chain D1 to D8 from raw declarations to flagged rows, with one shuffle of the detail.

All its steps compare rows of one parcel, so the declarations are dealt to buckets by parcel once. Each
step then writes its result in the same buckets, and groupings, lookups and joins take the rows where
they lie: no step shuffles again.

A parcel with more than ``hot_rows`` declarations is too large for that. Such parcels are set apart
before and go through the same steps in their other form, in which lookups split a hot key over many
tasks and pairs are made in a grid. The results are put together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from landrecon.operators.joins import HOT_PAIRS, anti, semi
from landrecon.plans import clean, flags, reconcile
from landrecon.session import co_located, deal, passing, stage

KEY = "hapar_id"
# Owners and renters of a parcel with so many rows together make at most HOT_PAIRS pairs.
HOT_ROWS = 2 * int(HOT_PAIRS**0.5)
# Declarations for one bucket, where there are more than the shuffle partitions take.
BUCKET_ROWS = 100_000


def run_steps(
    owners: DataFrame, renters: DataFrame, year_out: int = 2019, lay: Callable[[DataFrame], DataFrame] = lambda df: df
) -> tuple[DataFrame, DataFrame]:
    """(flagged rows, pairs) of raw declarations, both staged; what is staged on the way goes. ``lay`` lays the
    declarations out."""
    spark = owners.sparkSession

    def prepared(raw: DataFrame, prepare: Callable[[DataFrame, int], DataFrame], name: str) -> DataFrame:
        with passing(spark) as keep:
            done = stage(prepare(lay(raw), year_out), name)
            keep(done)
        return done

    with passing(spark) as keep:
        sides = prepared(owners, clean.prepare_owners, "owners"), prepared(renters, clean.prepare_renters, "renters")
        merged, pairs = reconcile.reconcile(*sides)
        flagged = stage(flags.flag_errors(stage(merged, "merged"), pairs), "flagged")
        for df in (flagged, pairs):
            keep(df)
    return flagged, pairs


def hot_parcels(owners: DataFrame, renters: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Parcels with more declarations than a task should get."""
    counts = [df.filter(f"{KEY} IS NOT NULL").groupBy(KEY).count() for df in (owners, renters)]
    both = counts[0].unionByName(counts[1]).groupBy(KEY).agg(F.sum("count").alias("n"))
    return stage(both.filter(F.col("n") > hot_rows).select(KEY), "hot-parcels")


def run_chain(
    owners: DataFrame, renters: DataFrame, year_out: int = 2019, buckets: int | None = None, hot_rows: int = HOT_ROWS
) -> tuple[DataFrame, DataFrame]:
    """(flagged rows, pairs) of raw declarations. A bucket is one task's work, so ``buckets`` should grow with
    the data; unless given it is the number of shuffle partitions, or more where these are not enough."""
    spark = owners.sparkSession
    hot = hot_parcels(owners, renters, hot_rows)
    number = buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), (owners.count() + renters.count()) // BUCKET_ROWS)
    usual = [anti(df, F.broadcast(hot), [KEY]) for df in (owners, renters)]  # few: each has more than hot_rows rows
    with co_located(spark, KEY, number):
        flagged, pairs = run_steps(*usual, year_out, lambda df: deal(df, "declarations"))
    if hot.isEmpty():
        return flagged, pairs
    parts = run_steps(*[stage(semi(df, hot, [KEY]), "hot") for df in (owners, renters)], year_out)
    return flagged.unionByName(parts[0]), pairs.unionByName(parts[1])
