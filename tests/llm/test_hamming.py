"""Nearest codes against all pairs."""

import random

import numpy as np
import pytest

from landrecon.llm import hamming


def brute(rows, queries, k):
    out = []
    for q, code in queries:
        best = sorted(((code ^ c).bit_count(), i) for i, c in rows)[:k]
        out += [(q, n + 1, i, d) for n, (d, i) in enumerate(best)]
    return sorted(out)


def signed(code):
    return code - 2**64 if code >> 63 else code


@pytest.mark.parametrize("block", [hamming.BLOCK, 50, 7])
def test_nearest(spark, block):
    draw = random.Random(3)
    rows = {}
    for i in range(300):
        base = draw.getrandbits(64) if i % 3 else 12345
        rows[i] = base ^ (1 << draw.randrange(64)) if i % 2 else base
    rows = list(rows.items())
    table = spark.createDataFrame([(i, signed(c)) for i, c in rows], "id long, code long")
    got = hamming.nearest(table, table.filter("id % 5 = 0"), 10, block, min(block, 4096)).collect()
    want = brute(rows, [r for r in rows if r[0] % 5 == 0], 10)
    assert sorted((r.query_id, r.rank, r.neighbor_id, r.distance) for r in got) == want


def test_fewer_codes_than_asked_nulls_and_repeats(spark):
    rows = [(1, 0), (2, 1), (2, 1), (None, 0), (3, None), (-4, -1)]
    table = spark.createDataFrame(rows, "id long, code long")
    got = hamming.nearest(table, table, 10).collect()
    assert sorted((r.query_id, r.rank, r.neighbor_id, r.distance) for r in got) == brute(
        [(1, 0), (2, 1), (-4, 2**64 - 1)], [(1, 0), (2, 1), (-4, 2**64 - 1)], 10
    )
    assert hamming.nearest(table.limit(0), table, 10).count() == 0
    assert hamming.nearest(table, table.limit(0), 10).count() == 0


def test_search_stops_early_when_the_kth_is_covered():
    codes = np.arange(5000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    tables = hamming.Tables(codes)
    query, code, distance = tables.search(codes[:50], 1)
    assert (code[distance == 0] == query[distance == 0]).all() and len(query) == 50


def test_sign_code(spark):
    vectors = [([1.0, -1.0] * 32,), ([-1.0] * 63 + [0.0],), ([1.0] * 63,), ([1.0] * 63 + [None],), (None,), ([1.0] * 70,)]
    df = spark.createDataFrame(vectors, "v array<float>")
    got = [r[0] for r in df.select(hamming.sign_code("v")).collect()]
    assert got == [0x5555555555555555, -(2**63), None, None, None, -1]
