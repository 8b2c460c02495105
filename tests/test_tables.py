"""The chain behind the catalogue's tables: one shuffle of the declarations, hot parcels apart, same rows."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from landrecon import session
from landrecon.catalogue import derive, tables
from landrecon.operators import matching
from landrecon.plans import chain


@pytest.fixture
def folder(spark, tmp_path):
    spark.range(1, 1500).selectExpr(
        "id AS l_orderkey", "CASE WHEN id % 4 = 0 THEN 7 ELSE id % 41 END AS l_partkey", "id % 6 + 1 AS l_suppkey", "CAST(id % 7 + 1 AS INT) AS l_linenumber",
        "CAST(id * 13 % 50 + 1 AS DOUBLE) AS l_quantity", "CAST(id AS DOUBLE) AS l_extendedprice", "(id * 3 % 11) / 100D AS l_discount",
        "(id * 5 % 9) / 100D AS l_tax", "element_at(array('A', 'N', 'R'), CAST(id % 3 + 1 AS INT)) AS l_returnflag",
        "CASE WHEN id % 2 = 0 THEN 'F' ELSE 'O' END AS l_linestatus", "CAST(make_date(CAST(1995 + id % 5 AS INT), 5, 1) AS TIMESTAMP_NTZ) AS l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    return f"file://{tmp_path}"


def test_no_step_shuffles_after_the_first(spark, folder, monkeypatch):
    written, inner = [], session.stage

    def recorded(df, name="stage"):
        written.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return inner(df, name)

    for module in ("catalogue.tables", "operators.joins", "operators.matching", "plans.clean", "plans.reconcile"):
        monkeypatch.setattr(f"landrecon.{module}.stage", recorded)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = tables.Tables(spark, folder)
        flagged, best = t.flagged, t.best_pairs
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    shuffled = [name for name, plan in written if re.search(r"\bExchange\b", plan)]
    assert shuffled == ["clean", "clean"] and len(written) >= 11 and flagged.count() > 0 and best.count() > 0


@pytest.mark.parametrize("hot_rows", [100, 10**9])
def test_hot_parcels_give_the_same_rows(spark, folder, monkeypatch, hot_rows):
    monkeypatch.setattr(tables, "hot_parcels", lambda *raw: chain.hot_parcels(*raw, hot_rows=hot_rows))
    t = tables.Tables(spark, folder)
    assert len(t.chains) == (2 if hot_rows == 100 else 1)
    for got, want in zip((t.flagged, t.pairs), chain.run_steps(t.perm_raw, t.seas_raw, derive.YEAR_OUT)):
        want = want.select(got.columns)
        assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert t.perm_parcel.count() >= t.perm.count() > 0


@pytest.mark.parametrize("hot_rows", [100, 10**9])
def test_weaker_pairs_go_within_the_parcel(spark, folder, monkeypatch, hot_rows):
    monkeypatch.setattr(tables, "hot_parcels", lambda *raw: chain.hot_parcels(*raw, hot_rows=hot_rows))
    t = tables.Tables(spark, folder)
    got, want = t.best_pairs.select("claim_id", "tier"), matching.drop_weaker_pairs(t.pairs).select("claim_id", "tier")
    assert t.pairs.count() > got.count() > 0 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_no_step_broadcasts_what_it_takes_for_small(spark, folder, monkeypatch):
    """Lookups of rows that lie together are joined where they lie, whatever their estimated size."""
    from landrecon.catalogue import QUERIES

    plans, inner = [], session.stage

    def recorded(df, name="stage"):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return inner(df, name)

    for module in ("catalogue.tables", "operators.joins", "operators.matching", "plans.clean", "plans.reconcile"):
        monkeypatch.setattr(f"landrecon.{module}.stage", recorded)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for name in ("J2_tiered_match", "J3_tier_guard", "J5_remove_matched", "J6_prune_pairs"):
        assert QUERIES[name](spark, folder).count() > 0
    assert tables.Tables.of(spark, folder).flagged.count() > 0
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == before
    assert [name for name, plan in plans if "BroadcastExchange" in plan] == []
    assert [name for name, plan in plans if re.search(r"\bExchange\b", plan)] == ["clean", "clean"]


def test_unmatched_claims_are_those_without_a_pair(spark, folder, monkeypatch):
    from landrecon.catalogue import QUERIES

    monkeypatch.setattr(tables, "hot_parcels", lambda *raw: chain.hot_parcels(*raw, hot_rows=100))
    t = tables.Tables.of(spark, folder)
    assert len(t.chains) == 2
    got = QUERIES["J5_remove_matched"](spark, folder)
    left = matching.remove_matched(t.perm.select("claim_id"), t.pairs, "claim_id", "owner")
    want = left.unionByName(matching.remove_matched(t.seas.select("claim_id"), t.pairs, "claim_id", "user"))
    assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("hot_rows", [100, 10**9])
def test_totals_of_parcels_are_taken_where_the_rows_lie(spark, folder, monkeypatch, hot_rows):
    """Flags by parcel, overclaims and area comparison: no shuffle or broadcast of what is told from a parcel's rows,
    and the results of the whole tables."""
    from landrecon.catalogue import QUERIES
    from landrecon.plans import flags, metrics

    names = {"E2_several_owners": "flag", "E3_parcel_sums_differ": "flag", "E7_repeated_owner_claim": "flag", "E11_claim_above_parcel": "flag",
             "M1_parcel_vs_use": "parcel-vs-use", "M10_overclaims": "overclaims"}
    monkeypatch.setattr(tables, "hot_parcels", lambda *raw: chain.hot_parcels(*raw, hot_rows=hot_rows))
    monkeypatch.setattr(tables.Tables, "_known", {})
    plans, inner = [], session.stage

    def recorded(df, name="stage"):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return inner(df, name)

    monkeypatch.setattr(tables, "stage", recorded)
    t = tables.Tables.of(spark, folder)
    whole = {n: flags.flag_errors(t.final, t.pairs, only=[n.split("_")[0]]).select("claim_id", "error_log") for n in names if n[0] == "E"}
    whole |= {"M1_parcel_vs_use": metrics.parcel_vs_use(t.perm), "M10_overclaims": metrics.overclaims(t.final)}
    for name, step in names.items():
        plans.clear()
        got, want = QUERIES[name](spark, folder), whole[name]
        assert [n for n, _ in plans] == [step] * len(t.chains)
        if len(t.chains) == 1:
            # Rows are counted by label in the end.
            assert "BroadcastExchange" not in plans[0][1] and len(re.findall(r"\bExchange\b", plans[0][1])) == (step == "parcel-vs-use")
        want = tables.plain(want).select([F.col(c).cast(got.schema[c].dataType) for c in got.columns])
        assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
