"""Whitening against floating-point eigenvectors, and its exact parts against exact sums."""

from fractions import Fraction

import numpy as np
import pytest

from landrecon.llm import whitening
from landrecon.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def brute(vectors):
    """(x, n, deviation, whitened by row, explained) by numpy."""
    x = np.floor(256 * np.array(vectors, dtype=np.float64)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    deviation = ((n * x - s) ** 2).sum(axis=1)
    centred = fit - s / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    return n, deviation, (x - s / n) @ v / np.sqrt(np.where(e > 1e-9, e, np.nan)), e / e.sum()


def check(got, ids, vectors):
    n, deviation, whitened, explained = brute(vectors)
    d = min(4, len(vectors[0]))
    table = {}
    for r in got:
        table.setdefault((r.vec_id, r.component), []).append(r)
    assert len(got) == len(ids) * d and {c for _, c in table} == set(range(1, d + 1))
    for k in range(d):
        rows = [table[i, k + 1].pop() for i in ids]
        assert all(r.n == n and r.deviation == v for r, v in zip(rows, deviation.tolist()))
        assert abs(rows[0].explained - explained[k]) <= 1e-4 * max(explained[k], 1e-12)
        if np.isnan(whitened[:, k]).any():
            assert all(r.whitened is None for r in rows)
            continue
        mine = np.array([r.whitened for r in rows])
        assert min(np.abs(mine - whitened[:, k]).max(), np.abs(mine + whitened[:, k]).max()) < 1e-6
        assert rows[0].identity_error < 1e-9
    assert len({r.identity_error for r in got}) == 1


def test_query(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    check(QUERIES["op12_whitening"](spark, FOLDER).collect(), [r.vec_id for r in rows], [r.embedding for r in rows])


def test_repeats_bad_rows_and_other_columns(spark):
    draw = np.random.default_rng(2)
    good = [(i, (draw.normal(0, 1, 6) * [3, 2, 1, 0.5, 0.2, 0.1]).tolist()) for i in range(60)]
    good += good[:20] + [(None, good[0][1]), (777, good[1][1])]
    bad = [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [float("nan")] * 6), (903, [float("inf")] * 6), (904, [])]
    df = spark.createDataFrame([(i, v, 1) for i, v in good + bad], "vec_id long, embedding array<double>, n int")
    check(whitening.whiten(df).collect(), [i for i, _ in good], [v for _, v in good])
    assert whitening.whiten(df.limit(0)).count() == 0


def test_degenerate_fit_lists(spark):
    def rows(*vectors):
        return whitening.whiten(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")).collect()

    one = rows([1.0, 2.0, 3.0])
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [
        (k, 1, 0, None, 0.0, None) for k in (1, 2, 3)
    ]
    line = rows([0.0, 0.0], [1.0, 1.0], [2.0, 2.0])
    assert [r.whitened for r in line if r.component == 2] == [None] * 3
    assert sorted(round(abs(r.whitened), 9) for r in line if r.component == 1) == [0.0, 1.224744871, 1.224744871]
    mixed = rows([0.0, 0.0], [1.0, 1.0], [5.0], [7.0])
    assert {(r.vec_id, r.n) for r in mixed} == {(i, 2) for i in range(4)}
    square = rows([1.0, 0.0], [-1.0, 0.0], [0.0, 1.0], [0.0, -1.0])  # a double root
    assert {round(r.explained, 12) for r in square} == {0.5} and all(r.identity_error < 1e-12 for r in square)
    huge = rows([1e30, 0.0], [-1e30, 1.0], [0.0, 4.0])
    assert all(r.deviation is None for r in huge[:2]) and huge[0].identity_error < 1e-9


def test_polynomial_and_roots_are_exact(spark):
    draw = np.random.default_rng(4)
    for rank in (5, 3):
        b = draw.integers(-50, 50, (5, rank))
        m = (b @ b.T).tolist()
        found = whitening.characteristic_polynomial(spark, m)
        a, want, k = np.eye(5, dtype=object), [1], 1  # Faddeev-LeVerrier in Python integers
        big = np.array(m, dtype=object)
        for k in range(1, 6):
            a = big @ a
            c = -sum(a[i][i] for i in range(5)) // k
            want.append(c)
            a = a + c * np.eye(5, dtype=object)
        assert found == want[::-1]
        roots = whitening.largest_roots(found, 5, sum(m[i][i] for i in range(5)) + 1)
        near = np.linalg.eigvalsh(np.array(m))[::-1]
        assert np.allclose([float(r) for r in roots], near, atol=1e-6)
        assert [r == 0 for r in roots] == [False] * rank + [True] * (5 - rank)
        for r in roots[:rank]:  # a sign change within the stated precision
            width = r / 2**150
            value = [sum(c * x**i for i, c in enumerate(found)) for x in (r - width, r + width)]
            assert value[0] * value[1] < 0


@pytest.mark.parametrize("roots", [(7, 7, 3, 0), (2, 2, 2, 2), (10**30, 1, 1, 0)])
def test_multiple_roots(roots):
    c = [1]
    for r in roots:
        c = [a - r * b for a, b in zip([0, *c], [*c, 0])]
    got = whitening.largest_roots(c, 4, max(roots) + 1)
    assert all(abs(g - r) <= max(Fraction(r), 1) / 2**150 for g, r in zip(got, roots))
    assert [a == b for a, b in zip(got, got[1:])] == [a == b for a, b in zip(roots, roots[1:])]
    for point in (0, 1, 5, 7):
        assert whitening.roots_above(c, point, 0) == sum(r > point for r in roots)


def test_primes():
    assert [p for p in range(60) if whitening.is_prime(p)] == [2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37, 41, 43, 47, 53, 59]
    assert whitening.primes_below(1 << 31, 1) == [2**31 - 1]
