"""Time the headline queries; prints one JSON line.

Each query is timed three times, from building its frame to all rows computed (a sink that discards
them); the median counts, ``first`` has the first run, which meets cold files and code, and ``spread``
the least and the most.
The chain of domain steps is timed step by step, each over the written result of the one
before, after one warm-up query; ``chain`` is their sum from the raw tables to the flags.
"""

from __future__ import annotations

import json
import os
import time

from landrecon.catalogue import QUERIES
from landrecon.catalogue.tables import Tables
from landrecon.session import build_session

CHAIN = ["perm_clean", "seas_clean", "perm_parcel", "seas_parcel", "perm", "seas", "matched", "final", "flagged"]
COMMONS_CHAIN = ["commons_built", "commons", "linked"]
HEADLINE = [
    "W3_largest_by_group", "J2_tiered_match", "J8_not_in", "J15_arg_max_ties", "A7_array_agg_distinct",
    "A15_consolidate", "W1_dedupe", "W5_extra_parties", "S9_surrogate_ids", "G3_overlap_join",
    "G3_overlap_join_convex", "D8_flag_errors", "D9_ownership_per_parcel", "D10_property_report",
    "D11_largest_use", "D16_impute_remainder", "D17_reassign_sides", "D18_drop_weaker_pairs",
    "M1_parcel_vs_use", "M3_flag_agreement", "M7_matched_area_raw", "M9_area_bands", "M10_overclaims",
    "X2_other_parties", "X7_total_overclaim",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(cpus, "landrecon-bench")
    spark.conf.set("spark.sql.shuffle.partitions", cpus)
    times: dict[str, float] = {}

    def run(name: str) -> None:
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

    run("A12_distinct")  # warm-up
    tables = Tables.of(spark, folder)
    for step in CHAIN + COMMONS_CHAIN:
        start = time.perf_counter()
        getattr(tables, step)
        times[f"step_{step}"] = round(time.perf_counter() - start, 3)
    start = time.perf_counter()
    run("D8_one_shuffle")  # the same chain from the raw rows in buckets, one shuffle
    times["chain_one_shuffle"] = round(time.perf_counter() - start, 3)
    times["chain"] = round(sum(times[f"step_{s}"] for s in CHAIN), 3)
    spread, first = {}, {}
    for name in HEADLINE:
        took = []
        for _ in range(3):
            start = time.perf_counter()
            run(name)
            took.append(round(time.perf_counter() - start, 3))
        times[name] = sorted(took)[1]
        spread[name] = [min(took), max(took)]
        first[name] = took[0]
    total = sum(v for k, v in times.items() if not k.startswith("chain"))
    print(json.dumps({
        "metric": "total wall time of the headline queries", "value": round(total, 3), "unit": "sec",
        "queries": times, "first": first, "spread": spread, "sf": os.path.basename(folder.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
