"""Published tables: replaced in one step, extended once per batch, renewed by parts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from landrecon.sources import ids, sinks, versions


@pytest.fixture
def path(tmp_path):
    return f"file://{tmp_path}/table"


def test_a_killed_publish_leaves_the_old_table(frame, rows, path, spark, monkeypatch):
    sinks.publish(frame("x int", (1,), (2,)), path)
    broken = frame("x int", (3,), (4,)).select(F.when(F.col("x") == 4, F.raise_error(F.lit("lost"))).otherwise(F.col("x")).cast("int").alias("x"))
    with pytest.raises(Exception, match="lost"):
        sinks.publish(broken, path)
    assert rows(versions.read(spark, path)) == [(1,), (2,)]
    monkeypatch.setattr(versions, "_commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        sinks.publish(frame("x int", (5,)), path)
    monkeypatch.undo()
    assert rows(versions.read(spark, path)) == [(1,), (2,)]
    assert len(versions.vacuum(spark, path)) >= 1
    assert rows(versions.read(spark, path)) == [(1,), (2,)]


def test_a_commit_cut_short_is_none(frame, rows, path, spark, tmp_path):
    sinks.publish(frame("x int", (1,)), path)
    (tmp_path / "table" / versions.COMMITS / "0000000002.json").write_text('{"number": 2, "sch')
    assert rows(versions.read(spark, path)) == [(1,)]
    assert rows(sinks.append_table(frame("x int", (2,)), path)) == [(1,), (2,)]
    assert versions.current(spark, path).number == 3


def test_a_table_may_be_made_from_itself(frame, rows, path, spark):
    first = sinks.publish(frame("x int, k string", (1, "a"), (2, "b")), path)
    second = sinks.publish(first.filter("x = 2"), path)
    assert rows(second) == [(2, "b")] and rows(versions.read(spark, path, 1)) == [(1, "a"), (2, "b")]
    assert rows(first) == [(1, "a"), (2, "b")]  # a reader keeps its version


def test_a_batch_is_applied_once(frame, rows, path):
    for _ in range(2):
        sinks.append_table(frame("x int", (1,)), path, "a")
    both = frame("x int, y string", (2, "n"))
    for _ in range(2):
        got = sinks.append_table(both, path, "b")
    assert rows(got) == [(1, None), (2, "n")]
    assert rows(sinks.publish(frame("x int", (9,)), path, "c")) == [(9,)]
    assert rows(sinks.append_table(frame("x int", (1,)), path, "a")) == [(9,)]
    with pytest.raises(ValueError, match="x is int"):
        sinks.append_table(frame("x string", ("1",)), path)


def test_two_writers_of_one_version(frame, path, spark, rows):
    sinks.publish(frame("x int", (1,)), path)
    base = versions.current(spark, path)
    sinks.append_table(frame("x int", (2,)), path)
    with pytest.raises(versions.ConcurrentWrite):
        versions._commit(spark, path, base, versions.Version(schema=base.schema))
    assert rows(versions.read(spark, path)) == [(1,), (2,)]


def test_parts_are_replaced_alone(frame, rows, path, spark):
    def parted(*values):
        return frame("k int", *values).withColumn(versions.PART, F.pmod("k", F.lit(4)))

    versions.publish(parted((0,), (1,), (2,), (3,), (5,)), path)
    assert rows(versions.read(spark, path, parts=[1])) == [(1,), (5,)]
    got = versions.replace_parts(parted((9,)), path, [1, 2], "x")
    assert rows(got) == [(0,), (3,), (9,)]
    assert rows(versions.replace_parts(parted((13,)), path, [1, 2], "x")) == [(0,), (3,), (9,)]
    with pytest.raises(ValueError, match="not named"):
        versions.replace_parts(parted((3,)), path, [1])
    assert rows(versions.replace_parts(parted(), path, [0, 1, 3])) == []


def test_ids_stay_as_deliveries_come(frame, rows, path):
    first = frame("row int, name string", (1, "m"), (2, "c"), (3, None), (4, "m"))
    second = frame("row int, name string", (5, "a"), (6, "m"), (7, "z"), (8, "a"))
    assert rows(ids.delivered_ids(first, ["name"], path, "one")) == [(1, 2), (2, 1), (3, None), (4, 2)]
    for _ in range(2):  # a retried delivery
        assert rows(ids.delivered_ids(second, ["name"], path, "two")) == [(5, 3), (6, 2), (7, 4), (8, 3)]
    assert rows(ids.delivered_ids(first, ["name"], path, "three")) == [(1, 2), (2, 1), (3, None), (4, 2)]
    frames, links = ids.surrogate_ids(second, ["name"], known={"name": ids.surrogate_ids(first, ["name"])[1]["name"]})
    assert rows(frames) == [(5, 3), (6, 2), (7, 4), (8, 3)] and links["name"].count() == 4
