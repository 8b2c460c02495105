"""Detail tables are never gathered by the driver, however small they are estimated."""

from __future__ import annotations

import pytest

from landrecon.plans import metrics, report

YEARS = "explode(sequence(1995, 2001))"


@pytest.fixture
def digitised(spark):
    return spark.range(1, 4).selectExpr("id AS hapar_id", f"{YEARS} AS year", "CAST(10 + id * 0.05 AS DECIMAL(18,3)) AS digi_area")


def broadcasts(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange")


def test_bands_of_the_report(spark, digitised, rows):
    cells = spark.sql(
        """SELECT * FROM VALUES (1L, 1996, 'area', 10.05, CAST(NULL AS STRING), 2L, 5.00, 1L), (2L, 1996, 'area', 10.15, NULL, 1L, 5.00, 0L),
           (3L, 2000, 'area', 99.00, NULL, 1L, 5.00, 0L) AS t(hapar_id, year, kind, area, value, n, claim, noted)"""
    )
    bands = report.of_merged(cells, digitised)[2]
    assert broadcasts(bands) == 0
    found = rows(bands, "metric", "year", "label", "n")
    assert found == [("M9", 1996, "< 0.01 difference", 1), ("M9", 1996, "< 0.1 difference", 1), ("M9", 2000, "> 0.1 difference", 1)]


def test_area_mismatch(spark, tmp_path):
    """On a folder of its own: the declarations are many rows in a small file, and so are the parcels."""
    from landrecon.catalogue import QUERIES

    spark.range(1, 40).selectExpr("id AS p_partkey", "CAST(10 + id % 30 AS INT) AS p_size").write.parquet(f"{tmp_path}/part.parquet")
    spark.range(1, 400).selectExpr(
        "id AS l_orderkey", "id % 39 + 1 AS l_partkey", "id % 5 + 1 AS l_suppkey", "CAST(1 AS INT) AS l_linenumber", "CAST(20 + id % 4 AS DOUBLE) AS l_quantity",
        "CAST(id AS DOUBLE) AS l_extendedprice", "0.02D AS l_discount", "0.01D AS l_tax", "'A' AS l_returnflag", "'F' AS l_linestatus",
        "CAST('1996-05-01' AS TIMESTAMP_NTZ) AS l_shipdate",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = QUERIES["F6_area_mismatch"](spark, f"file://{tmp_path}")
    assert broadcasts(found) == 0 and found.count() > 0


@pytest.fixture
def final(spark):
    return spark.sql("SELECT * FROM VALUES (1L, 1996, 10.05), (2L, 1996, 10.11), (3L, 2000, 99.00), (3L, 2001, NULL) AS t(hapar_id, year, land_parcel_area)")


def test_area_bands(final, digitised, rows):
    bands = metrics.area_bands(final, digitised)
    assert broadcasts(bands) == 0
    assert rows(bands, "year", "digi_area_match", "n") == [
        (1996, "< 0.01 difference", 1), (1996, "> 0.1 difference", 1), (2000, "> 0.1 difference", 1), (2001, "> 0.1 difference", 1)
    ]


def test_declared_vs_digitised(spark, digitised, rows):
    raw = spark.sql("SELECT * FROM VALUES (1L, 1996, 4.00), (1L, 1996, 6.05), (2L, 1996, 7.00), (3L, 1996, 0.00) AS t(hapar_id, year, land_use_area)")
    unlike = metrics.declared_vs_digitised(raw, digitised)
    assert broadcasts(unlike) == 0
    assert rows(unlike, "hapar_id", "year", "digi_area", "declared") == [(2, 1996, 10.1, 7.0)]


def test_area_bands_inclusive(final, digitised, rows):
    bands = metrics.area_bands(final, digitised, strict=False)
    assert broadcasts(bands) == 0
    assert rows(bands, "year", "digi_area_match", "n") == [
        (1996, "< 0.01 difference", 2), (2000, "> 0.1 difference", 1), (2001, "unknown", 1)
    ]
