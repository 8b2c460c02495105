"""The registered queries against their SQL."""

import duckdb
import pytest

from landrecon.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_agrees_with_sql(spark, name):
    engine = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "benchmark"):
        engine.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    df = QUERIES[name](spark, FOLDER)
    cursor = engine.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(tuple, df.select(columns).collect())) == sorted(cursor.fetchall())
