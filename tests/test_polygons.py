"""Overlap of polygons of any shape, and rectangles that cover each other in part."""

from __future__ import annotations

import random

import pytest

from landrecon.operators import spatial

RINGS = "name string, rings array<array<struct<x:double,y:double>>>"
EL = [(0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4)]  # area 12
SQUARE = [(0, 0), (4, 0), (4, 4), (0, 4)]
HOLE = [(1, 1), (3, 1), (3, 3), (1, 3)]


def moved(ring, x, y):
    return [(px + x, py + y) for px, py in ring]


def overlaps(spark, left, right, cell=2.0):
    a, b = (spark.createDataFrame([(n, [[(float(x), float(y)) for x, y in r] for r in rings]) for n, rings in side], RINGS) for side in (left, right))
    found = spatial.polygon_overlap_join(a, b, "name", "name", cell).collect()
    assert len({(r.key_a, r.key_b) for r in found}) == len(found)
    return {(r.key_a, r.key_b): tuple(round(v * 10_000, 6) for v in (r.area_a, r.area_b, r.area_overlap)) for r in found}


def test_shapes_by_hand(spark):
    left = [("L", [EL]), ("ring", [SQUARE, HOLE]), ("backwards", [EL[::-1]])]
    right = [
        ("notch", [moved(HOLE, 1, 1)]),  # 2..4 square: touches the L along its notch
        ("inside hole", [[(1.5, 1.5), (2.5, 1.5), (2.5, 2.5), (1.5, 2.5)]]), ("square", [SQUARE]), ("far", [moved(SQUARE, 9, 9)]),
        ("corner", [moved(SQUARE, 4, 4)]), ("L turned", [[(4, 4), (0, 4), (0, 2), (2, 2), (2, 0), (4, 0)]]), ("triangle", [[(0, 0), (4, 0), (0, 4)]]),
        ("ring too", [moved(HOLE, 0, 0), [(1.5, 1.5), (2.5, 1.5), (2.5, 2.5), (1.5, 2.5)][::-1]]),
    ]
    got = overlaps(spark, left, right)
    of_l = {
        "notch": (12, 4, 0), "inside hole": (12, 1, 0.75), "square": (12, 16, 12), "L turned": (12, 12, 8), "triangle": (12, 8, 8),
        "ring too": (12, 3, 2.25),
    }
    assert {b: v for (a, b), v in got.items() if a == "L"} == of_l
    assert {b: v for (a, b), v in got.items() if a == "backwards"} == of_l
    assert {b: v for (a, b), v in got.items() if a == "ring"} == {
        "notch": (12, 4, 3), "square": (12, 16, 12), "corner": (12, 16, 0), "L turned": (12, 12, 9), "triangle": (12, 8, 6), "ring too": (12, 3, 0),
    }


@pytest.mark.parametrize("cell", [1.0, 50.0])
def test_random_combs_against_unit_squares(spark, cell):
    """Rectilinear polygons made of columns of whole height: overlaps are sums over columns."""
    draw = random.Random(4)

    def comb(name):
        x, heights = draw.randrange(12), [draw.randrange(1, 9) for _ in range(draw.randrange(1, 7))]
        top = [(x + i + d, h) for i, h in enumerate(heights) for d in (0, 1)]
        return (name, [[(x, 0), (x + len(heights), 0), *top[::-1]]]), dict(enumerate(heights, x))

    left, right = [comb(f"a{i}") for i in range(12)], [comb(f"b{i}") for i in range(12)]
    got = overlaps(spark, [p for p, _ in left], [p for p, _ in right], cell)
    for (a, _), own in left:
        for (b, _), other in right:
            common = sum(min(own[x], other[x]) for x in own.keys() & other.keys())
            assert got.get((a, b), (0, 0, 0))[2] == common
            if common:
                assert got[a, b][:2] == (sum(own.values()), sum(other.values()))


@pytest.mark.parametrize("cell", [1.0, 3.0, 100.0])
def test_dissolved_rectangles(spark, cell):
    draw = random.Random(6)
    boxes = []
    for key in ("p", "q", None):
        for _ in range(14):
            x, y = draw.randrange(-6, 10), draw.randrange(-6, 10)
            boxes.append((key, x, y, x + draw.randrange(1, 6), y + draw.randrange(1, 6)))
    boxes += boxes[:5]
    rows = [(k, [(float(x), float(y)) for x, y in ((a, b), (c, b), (c, d), (a, d))]) for k, a, b, c, d in boxes]
    df = spark.createDataFrame(rows, "name string, ring array<struct<x:double,y:double>>")
    covered = {}
    for k, a, b, c, d in boxes:
        covered.setdefault(k, set()).update((x, y) for x in range(a, c) for y in range(b, d))
    got = {}
    for r in spatial.dissolve_rectangles(df, ["name"], cell).collect():
        (x0, y0), (x1, y1) = r.ring[0], r.ring[2]
        for x in range(round(x0), round(x1)):
            for y in range(round(y0), round(y1)):
                assert (x, y) not in got.setdefault(r.name, set())
                got[r.name].add((x, y))
    assert got == covered
