"""Queries over the rows with commons flags: made where the rows lie, nothing written that they do not read, same rows."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from landrecon import session
from landrecon.catalogue import QUERIES, derive, tables
from landrecon.functions.text import split_part
from landrecon.plans import chain, clean, commons, largest_use, ownership, reconcile
from test_tables import folder  # noqa: F401


@pytest.fixture
def linked_folder(spark, folder):  # noqa: F811
    spark.range(1, 60).selectExpr(
        "id AS o_orderkey", "id % 9 AS o_custkey", "element_at(array('F', 'O', 'P'), CAST(id % 3 + 1 AS INT)) AS o_orderstatus",
        "CAST(id * 9000 AS DOUBLE) AS o_totalprice", "CAST(make_date(CAST(1995 + id % 5 AS INT), 3, 1) AS TIMESTAMP_NTZ) AS o_orderdate",
        "element_at(array('1-URGENT', '3-MEDIUM', '5-LOW'), CAST(id % 3 + 1 AS INT)) AS o_orderpriority",
    ).write.parquet(f"{folder}/orders.parquet")
    spark.range(1, 50).selectExpr("id AS p_partkey", "CAST(id % 40 AS INT) AS p_size").write.parquet(f"{folder}/part.parquet")
    spark.range(1, 9).selectExpr("id AS s_suppkey", "CAST(id % 5 AS INT) AS s_nationkey").write.parquet(f"{folder}/supplier.parquet")
    return folder


@pytest.fixture
def written(monkeypatch):
    """(name, plan) of every table written."""
    found, inner = [], session.stage

    def recorded(df, name="stage"):
        found.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return inner(df, name)

    for module in ("catalogue.tables", "catalogue.domain", "operators.joins", "operators.matching", "plans.clean", "plans.commons", "plans.reconcile"):
        monkeypatch.setattr(f"landrecon.{module}.stage", recorded)
    return found


def same(got, want):
    want = tables.plain(want).select([F.col(c).cast(got.schema[c].dataType) for c in got.columns])
    assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("hot_rows", [100, 10**9])
def test_linked_rows_are_read_where_they_lie(spark, linked_folder, monkeypatch, written, hot_rows):
    monkeypatch.setattr(tables, "hot_parcels", lambda *raw: chain.hot_parcels(*raw, hot_rows=hot_rows))
    monkeypatch.setattr(tables.Tables, "_known", {})
    t = tables.Tables.of(spark, linked_folder)
    assert t.flagged.count() > 0
    results = {}
    for name in ("D9_ownership_per_parcel", "D9_parcel_businesses", "D10_property_report", "D10_dissolved_report", "D11_largest_use", "D11_largest_claim"):
        written.clear()
        results[name] = QUERIES[name](spark, linked_folder)
        names = [n for n, _ in written]
        # Neither the rows again nor the table of the commons, which these results do not read.
        assert "commons-clamped" not in names and "commons-merged" not in names
        assert names.count("iacs-flagged") == len(t.chains) - 1
    assert results["D10_property_report"].count() > 0 and results["D10_dissolved_report"].count() > 0
    rows = t.linked[0]
    listed = ownership.commons_parcels(rows)
    assert 0 < listed.count() < rows.select("hapar_id").distinct().count()
    businesses = ownership.parcel_businesses(rows)
    same(results["D9_parcel_businesses"], businesses)
    same(results["D9_ownership_per_parcel"], ownership.ownership_per_parcel(rows, businesses))
    same(results["D11_largest_use"], largest_use.largest_use(rows, t.rank, listed))
    same(results["D11_largest_claim"], largest_use.largest_claim(rows, t.rank))


@pytest.mark.parametrize("hot_rows", [100, 10**9])
def test_the_cross_link_copies_the_claims_on_fields(spark, linked_folder, monkeypatch, written, hot_rows):
    monkeypatch.setattr(tables, "hot_parcels", lambda *raw: chain.hot_parcels(*raw, hot_rows=hot_rows))
    monkeypatch.setattr(tables.Tables, "_known", {})
    t = tables.Tables.of(spark, linked_folder)
    copies, both = QUERIES["J25_copy_to_commons"](spark, linked_folder), QUERIES["D14_cross_link"](spark, linked_folder)
    names = [n for n, _ in written]
    assert names.count("commons-clamped") == 1 and names.count("commons-claims") == len(t.chains)
    rows, grazings = t.linked
    same(copies, commons.copy_to_commons(rows, t.detail, t.commons))
    assert copies.count() > 0
    left = rows.select(F.lit("iacs").alias("side"), F.col("claim_id").alias("id"), "year", "error_log")
    same(both, left.unionByName(grazings.select(F.lit("commons").alias("side"), "id", "year", "error_log")))


def test_merged_rows_do_not_move(spark, folder, monkeypatch, written):  # noqa: F811
    monkeypatch.setattr(tables.Tables, "_known", {})
    t = tables.Tables.of(spark, folder)
    assert t.pairs.count() > 0
    written.clear()
    got = QUERIES["D7_infer_and_equalise"](spark, folder)
    assert [n for n, _ in written] == ["final"] and not re.search(r"\bExchange\b", written[0][1])
    merged = reconcile.one_sided_rows(t.perm_left, t.seas_left).unionByName(reconcile.merge_pairs(t.pairs))
    same(got, reconcile.infer_and_equalise(merged))


def test_methods_that_java_would_not_compile_are_not_used(spark, folder):  # noqa: F811
    """The first step of the declarations makes one of over 8000 bytes."""
    t = tables.Tables(spark, folder)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
    assert clean.clean_declarations(t.perm_raw, clean.OWNER_IDENTITY, "P", derive.YEAR_OUT).count() > 0


@pytest.mark.parametrize("text", ["a, b, c", "a", "", ", b", "a, ", "ä, ö, ", "aaaa", None])
@pytest.mark.parametrize("separator", [", ", "aa", "."])
def test_parts_are_those_of_the_built_in_function(frame, text, separator):
    df = frame("t string", (text,))
    for n in (1, 2, 3):
        got = df.select(split_part(F.col("t"), separator, n), F.split_part("t", F.lit(separator), F.lit(n))).collect()[0]
        assert got[0] == got[1]
