"""Ordered lists in chunks, and change logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from landrecon.operators import aggregates, notes


def test_chunks_of_a_large_group_make_its_list(spark):
    n = 200_000
    df = spark.range(n).selectExpr("IF(id % 4 = 0, id % 40, NULL) AS k", "CAST((id * 7919) % 1000 AS int) AS v").repartition(7)
    got = {}
    for r in aggregates.ordered_chunks(df, ["k"], "v", ["v"], size=1000).collect():
        assert len(r["values"]) <= 1000
        got.setdefault(r.k, {})[r.chunk] = r["values"]
    want = {}
    for r in df.collect():
        want.setdefault(r.k, []).append(r.v)
    assert got.keys() == want.keys()
    for k, chunks in got.items():
        assert sorted(chunks) == list(range(len(chunks))) and all(len(chunks[i]) == 1000 for i in range(len(chunks) - 1))
        assert [v for i in range(len(chunks)) for v in chunks[i]] == sorted(want[k])


def test_text_chunks_leave_nulls_out(frame, rows):
    df = frame("k string, v string", ("a", "y"), ("a", None), ("a", "x"), ("a", "x"), ("b", None), (None, "z"))
    assert rows(aggregates.text_chunks(df, ["k"], "v", ["v"], "|", size=2)) == [("a", 0, "x|x"), ("a", 1, "y"), (None, 0, "z")]


def test_logged_changes(frame, rows):
    df = frame("id int, a int, b int", (1, 5, 17), (2, 5, 5), (3, None, 1)).selectExpr("id", "CAST(a AS decimal(18,2)) AS a", "CAST(b AS decimal(18,2)) AS b").withColumn("log", F.lit(None).cast(f"array<{notes.CHANGE}>"))
    df = df.withColumn("log", notes.logged("log", F.col("a") != F.col("b"), notes.change("raised", "a", F.col("a"), F.col("b"))))
    df = df.withColumn("log", notes.logged("log", F.col("id") == 1, notes.change("seen")))
    out = df.select("id", notes.rendered("log", {"raised": ("raised by ", "; "), "seen": "seen; "}).alias("note"), notes.logged_amount("log").alias("amount"))
    assert rows(out) == [(1, "raised by 12.00; seen; ", 12.0), (2, None, None), (3, None, None)]
    assert df.filter("id = 1").select("log").first()[0][0].asDict() == {"rule": "raised", "column": "a", "before": 5, "after": 17, "amount": 12}
