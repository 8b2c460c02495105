"""Stages that go once they have been read, and the deliveries that let them go."""

from __future__ import annotations

import os
import random

from builders import raw
from landrecon import session
from landrecon.plans import chain
from landrecon.plans.incremental import Deliveries
from test_incremental import declarations


def stages(spark):
    place, files = session.at_path(spark, session.stages_dir(spark))
    return {s.getPath().getName() for s in files.listStatus(place)} if files.exists(place) else set()


def test_what_is_staged_on_the_way_goes(spark, frame):
    before = stages(spark)
    with session.passing(spark):
        with session.passing(spark) as keep:
            session.stage(frame("a int", (1,)), "gone")
            kept = session.stage(frame("a int", (2,)), "kept")
            keep(kept)
        assert [r[0] for r in kept.collect()] == [2] and [n.split("-")[0] for n in stages(spark) - before] == ["kept"]
    assert stages(spark) == before


def test_deliveries_leave_no_stages(spark, tmp_path):
    draw = random.Random(3)
    sides = [raw(spark, *declarations(draw, 60, range(12), mark)) for mark in "ab"]
    kept, before, tables_before = Deliveries(f"file://{tmp_path}/store", parts=4), stages(spark), len(spark.catalog.listTables())
    kept.start(*sides, "one")
    late = [raw(spark, *declarations(draw, 9, range(3), mark)) for mark in "cd"]
    kept.deliver(*late, "two")
    assert stages(spark) == before and len(spark.catalog.listTables()) == tables_before
    assert kept.result(spark).count() > 0
    # Published files are compressed like the stages.
    assert all(f.endswith(".zstd.parquet") for _, _, fs in os.walk(tmp_path) for f in fs if f.endswith(".parquet"))


def test_buckets_grow_with_the_declarations(spark, monkeypatch):
    seen, inner = [], chain.co_located
    monkeypatch.setattr(chain, "co_located", lambda spark, key, n: seen.append(n) or inner(spark, key, n))
    monkeypatch.setattr(chain, "BUCKET_ROWS", 10)
    draw = random.Random(4)
    chain.run_chain(raw(spark, *declarations(draw, 80, range(12), "a")), raw(spark, *declarations(draw, 80, range(12), "b")))
    assert seen == [16]
