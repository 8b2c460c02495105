"""Near vectors against all pairs."""

import numpy as np
import pytest

from landrecon.llm import queries, vectors


def brute(rows, cosine=0.93):
    ids, xs, labels = zip(*rows)
    x = np.array([v / np.linalg.norm(v) for v in xs])
    labels = np.array(labels)
    near = (x @ x.T >= cosine) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(near, False)
    first = np.array(ids)
    while True:
        new = np.minimum(first, np.where(near, first[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (new == first).all():
            return {i: (int(n), int(f)) for i, n, f in zip(ids, near.sum(axis=1), first)}
        first = new


def clusters(n_groups=30, seed=0):
    draw = np.random.default_rng(seed)
    rows = []
    for _ in range(n_groups):
        centre = draw.normal(size=24)
        for k in range(int(draw.integers(1, 9))):
            v = centre + draw.normal(size=24) * 0.12
            rows.append((len(rows), v, int(draw.integers(0, 2))))
            if k == 0:
                rows.append((len(rows), v, rows[-1][2]))
    return rows


@pytest.mark.parametrize("block", [vectors.BLOCK, 4])
def test_links_and_components(spark, block):
    rows = clusters()
    table = spark.createDataFrame([(i, v.tolist(), l) for i, v, l in rows], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(table, block=block, tables=12).collect()}
    want = brute(rows)
    total = sum(n for n, _ in want.values())
    assert set(got) == set(want)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(n for n, _ in got.values()) >= 0.97 * total
    assert np.mean([got[i][1] == want[i][1] for i in want]) > 0.95


def test_one_large_group_in_small_blocks_is_counted_whole(spark):
    draw = np.random.default_rng(1)
    centre = draw.normal(size=16)
    rows = [(i, centre + draw.normal(size=16) * 0.01, 1) for i in range(120)]
    table = spark.createDataFrame([(i, v.tolist(), l) for i, v, l in rows], "vec_id long, embedding array<double>, label int")
    got = vectors.near_vectors(table, block=16).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(119, 0)}
    assert [r.vec_id for r in got if r.kept] == [0]


def test_query_recall_and_no_false_link(spark):
    folder = "/root/testdata/sf0.1"
    rows = [(r.vec_id, np.array(r.embedding, dtype=float), r.label) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    want = brute(rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in queries.QUERIES["op3_embedding_near_dedup"](spark, folder).collect()}
    assert set(got) == set(want) and all(got[i][0] <= want[i][0] for i in want)
    assert sum(n for n, _ in got.values()) >= 0.99 * sum(n for n, _ in want.values())


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1),
        (7, [inf, 1.0], 1), (8, [1.0, None], 1), (9, [], 1), (10, [1.0, 0.0, 0.0], 1), (11, [1.0, 0.0], 2), (None, [1.0, 0.0], 1),
        (2, [2.0, 0.0], 1), (12, [1e300, 0.0], 1), (13, [-1.0, 0.0], 1), (14, [3.0], 1), (15, [4.0], 1),
    ]
    table = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<double>, label int, n int")
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(table).collect()]
    alone = [3, 4, 5, 6, 7, 8, 9, 10, 11, 13]
    want = [(i, 0, i, True) for i in alone] + [(None, 0, None, True), (1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False)]
    want += [(12, 3, 1, False), (14, 1, 14, True), (15, 1, 14, False)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert vectors.near_vectors(table.limit(0)).count() == 0


def test_hadamard_keeps_lengths_and_is_its_own_inverse():
    x = np.random.default_rng(0).normal(size=(5, 32))
    assert np.allclose(vectors.hadamard(vectors.hadamard(x)), x)
    assert np.allclose(np.linalg.norm(vectors.hadamard(x), axis=1), np.linalg.norm(x, axis=1))


def test_recall_by_cosine():
    """Of random pairs at a cosine, the share that meets in a bucket."""
    draw = np.random.default_rng(3)
    n, d = 20_000, 64
    a = vectors.unit(draw.normal(size=(n, d)))
    side = draw.normal(size=(n, d))
    side = vectors.unit(side - (side * a).sum(axis=1, keepdims=True) * a)
    for cosine, least in ((0.93, 0.9995), (0.95, 0.9999), (0.98, 1.0)):
        b = cosine * a + np.sqrt(1 - cosine**2) * side
        left, right = vectors.bucket_keys(a), vectors.bucket_keys(b)
        met = np.zeros(n, dtype=bool)
        for i in range(0, left.shape[1], 2):
            for j in (i, i + 1):
                for k in (i, i + 1):
                    met |= left[:, j] == right[:, k]
        print(f"cosine {cosine}: {met.mean():.5f}")
        assert met.mean() >= least
