"""The chain in buckets: no shuffle after the first, hot parcels apart, same rows."""

from __future__ import annotations

import random
import re

import pytest

from builders import raw
from landrecon import session
from landrecon.plans import chain
from test_incremental import declarations


@pytest.fixture(scope="module")
def delivered(spark):
    draw = random.Random(5)
    hot = [{**d, "hapar_id": 7} for d in declarations(draw, 60, [7], "h")]
    return raw(spark, *declarations(draw, 150, range(30), "a"), *hot), raw(spark, *declarations(draw, 150, range(30), "b"))


@pytest.fixture
def written(spark, monkeypatch):
    """(bucketed, plan, its plan's text) of every table written, with broadcasts off."""
    found = []
    inner = session.stage

    def recorded(df, name="stage"):
        found.append((session.layout(df.columns) is not None, name, df._jdf.queryExecution().executedPlan().toString()))
        return inner(df, name)

    for module in ("session", "operators.joins", "operators.matching", "plans.clean", "plans.reconcile", "plans.chain"):
        monkeypatch.setattr(f"landrecon.{module}.stage", recorded)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield found
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_detail_is_shuffled_once(spark, delivered, written):
    assert session._layout.get() is None
    flagged, pairs = chain.run_chain(*delivered, buckets=4)
    bucketed = [(name, plan) for own, name, plan in written if own]
    dealt = [plan for name, plan in bucketed if name == "declarations"]
    steps = [(name, plan) for name, plan in bucketed if name != "declarations"]
    assert len(dealt) == 2 and len(steps) >= 8
    for name, plan in steps:
        assert not re.search(r"\bExchange\b", plan), f"{name}: {plan}"
        assert "Bucketed: true" in plan or "SelectedBucketsCount" in plan
    assert session._layout.get() is None and spark.conf.get(session.SUBSET) == "true"
    assert flagged.count() > 0 and pairs.count() > 0


@pytest.mark.parametrize("hot_rows", [0, 40, 10**9])
def test_hot_parcels_give_the_same_rows(delivered, hot_rows):
    want = chain.run_steps(*delivered)
    got = chain.run_chain(*delivered, buckets=4, hot_rows=hot_rows)
    for a, b in zip(want, got):
        a = a.select(b.columns)
        assert a.count() == b.count() > 0 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert chain.hot_parcels(*delivered, hot_rows=40).collect() == [(7,)]
