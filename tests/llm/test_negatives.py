"""Hard negatives against all pairs."""

import numpy as np
import pytest

from landrecon.llm import negatives


def brute(rows, anchors, positives, count, low=30, high=90, base=100):
    rows = list(dict.fromkeys(r for r in rows if None not in r and None not in r[2]))
    out = []
    for a in dict.fromkeys(r for r in anchors if None not in r and None not in r[2]):
        others = [(-sum(p * q for p, q in zip(a[2], r[2])), r[0], r[1]) for r in rows if r != a and len(r[2]) == len(a[2])]
        for p, positive, _ in sorted(o for o in others if o[2] == a[1])[:positives]:
            found = sorted(o for o in others if o[2] != a[1] and -low * p <= -base * o[0] <= -high * p)[:count]
            out += [(a[0], positive, n + 1, i, -p, -s) for n, (s, i, _) in enumerate(found)]
    return sorted(out)


COLUMNS = "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
SCHEMA = "id long, label int, x array<long>"


def mined(spark, rows, anchors, **options):
    df = negatives.mine(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(anchors, SCHEMA), **options)
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


@pytest.mark.parametrize("runs,options", [(4096, {}), (3, {"least": 16, "most": 16})])
def test_mined_rows(spark, monkeypatch, runs, options):
    """Clustered vectors in few and in many blocks; a third of the rows are copies of one vector."""
    monkeypatch.setattr(negatives, "RUNS", runs)
    draw = np.random.default_rng(5)
    centres = draw.normal(0, 60, (6, 8))
    rows = []
    for i in range(300):
        x = np.floor(centres[i % 6] + draw.normal(0, 25, 8)) if i % 3 else np.full(8, 40)
        rows.append((i, int(draw.integers(0, 4)), tuple(int(v) for v in x)))
    anchors = [r for r in rows if r[0] % 10 == 0]
    assert mined(spark, rows, anchors, **options) == brute(rows, anchors, 5, 10)


def test_nulls_repeats_lengths_zeros_and_large_numbers(spark):
    rows = [
        (1, 0, (3, 4)), (1, 0, (3, 4)), (2, 0, (4, 4)), (3, 1, (2, 1)), (4, 1, (1, 2)), (5, None, (3, 3)), (None, 0, (3, 3)),
        (6, 1, None), (7, 1, (2, None)), (8, 1, (2, 1, 5)), (9, 0, (0, 0)), (10, 1, (0, 0)), (11, 0, (3, 4)), (12, 0, ()), (13, 1, ()),
        (14, 0, (2**30, 2**29)), (15, 1, (2**29, 2**29)), (-1, 0, (-3, -4)),
    ]
    assert mined(spark, rows, rows) == brute(rows, rows, 5, 10)
    assert mined(spark, rows, rows, positives=1, negatives=1) == brute(rows, rows, 1, 1)
    assert mined(spark, [], rows) == [] and mined(spark, rows, []) == []


def test_bounds_hold_and_exclude():
    draw = np.random.default_rng(8)
    x = np.floor(draw.normal(0, 100, (400, 16)) * (draw.random((400, 1)) < 0.9))
    x[200:] = np.floor(np.abs(x[200:]) + 150)
    refs = negatives.directions(x)
    norm, angle = negatives.angles_to(x, refs)
    lower, upper = negatives.pair_bounds(norm, angle, norm, angle)
    score = x @ x.T
    assert (lower <= score).all() and (score <= upper).all()
    assert (upper[:200, 200:] < score[200:, 200:].min()).any()  # a pair that need not be scored
    low, high = negatives.run_bounds(norm, angle, np.array([[norm.min(), norm.max()]]), angle.min(axis=0)[None], angle.max(axis=0)[None])
    assert (low[:, 0] <= score.min(axis=1)).all() and (score.max(axis=1) <= high[:, 0]).all()


def test_windows_are_whole_numbers():
    assert negatives.window_list([10, 7, 0, -10, 1], 30, 90, 100) == [(0, 3, 9), (1, 3, 6), (2, 0, 0)]
