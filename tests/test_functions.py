from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from landrecon.functions import arrays, choice, numbers, rings, text


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def test_concat_rules(spark):
    none = F.lit(None).cast("string")
    row = one(spark, text.pg_concat(none, F.lit("a")), text.pipe_concat(none, F.lit("a")))
    assert tuple(row) == ("a", None)


def test_split_trim_digits(spark):
    row = one(
        spark,
        text.split_part(F.lit("P1, S2"), ", ", 2), text.split_part(F.lit("P1"), ", ", 2),
        text.trim_chars(F.lit("S12S"), "S"), text.trim_chars(F.lit("12-01"), "-01", "trailing"),
        text.strip_non_digits(F.lit("by 1.25ha; 3")),
    )
    assert tuple(row) == ("S2", "", "12", "12", "1253")


def test_amount_text_has_no_exponent(spark):
    assert one(spark, text.to_text(F.lit(12345678.9)))[0] == "12345678.90"


@pytest.mark.parametrize("o, u, expected", [(3, 2, 3), (2, 3, 3), (None, 5, None), (4, None, 4)])
def test_larger_side_keeps_owner_when_unknown(spark, o, u, expected):
    row = one(spark, numbers.larger_side(F.lit(o).cast("int"), F.lit(u).cast("int")))
    assert row[0] == expected


def test_used_area_and_percent(spark):
    row = one(
        spark, numbers.used_area(F.lit(0), F.lit(7)), numbers.used_area(F.lit(2), F.lit(7)),
        numbers.percent(F.lit(1), F.lit(0)), numbers.percent(F.lit(1), F.lit(4)),
    )
    assert tuple(row) == (7, 2, None, 25.0)


@pytest.mark.parametrize(
    "o, u, expected",
    [("", "x", "x"), ("x", "", "x"), ("x", "No Activity", "x"), ("", "No Activity", "No Activity"),
     ("x", "y", "y"), ("x", "Unspecified", "x"), (None, "y", "y")],
)
def test_choose_activity(spark, o, u, expected):
    assert one(spark, choice.choose_activity(F.lit(o).cast("string"), F.lit(u)))[0] == expected


@pytest.mark.parametrize(
    "o, u, expected",
    [("Ready", "Under Action/x", "Under Action/x"), ("Under Action", "Ready", "Under Action"),
     ("Ready", "Other", "Ready"), ("An Action", "Action b", "An Action")],
)
def test_choose_status(spark, o, u, expected):
    assert one(spark, choice.choose_status(F.lit(o), F.lit(u)))[0] == expected


def test_round2_rounds_once(spark):
    """Against exact decimals, on areas with more than six decimals."""
    from decimal import ROUND_HALF_UP, Decimal

    draw = random.Random(4)
    values = [1.00499996, 1.005, 0.0049999999, 2.675, -1.00499996, 12345.67499999, 0.0, 1e-9] + [draw.uniform(0, 300) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", numbers.round2(F.col("v")).alias("r"))
    for v, r in df.collect():
        assert r == Decimal(repr(v)).quantize(Decimal("0.01"), ROUND_HALF_UP), v
    assert df.select(numbers.round2(F.lit(None).cast("double"))).first()[0] is None


def test_array_rules(spark):
    empty = F.array().cast("array<int>")
    none = F.lit(None).cast("array<int>")
    some = F.array(F.lit(1), F.lit(None).cast("int"))
    row = one(
        spark, arrays.array_compact(some), arrays.null_if_empty(empty), arrays.array_cat(none, some),
        arrays.array_cat(none, none), arrays.array_len(empty), arrays.array_len(some),
    )
    assert tuple(row) == ([1], None, [1, None], None, None, 2)


def ring(*points):
    return F.array(*[rings.point(F.lit(float(x)), F.lit(float(y))) for x, y in points])


def circle(cx, cy, r, n, turn=0.0):
    return [(cx + r * math.cos(turn + 2 * math.pi * i / n), cy + r * math.sin(turn + 2 * math.pi * i / n)) for i in range(n)]


def test_area_in_both_directions(spark):
    points = [(0, 0), (4, 0), (4, 3), (0, 3)]
    row = one(spark, rings.polygon_area(ring(*points)), rings.polygon_area(ring(*points[::-1])))
    assert tuple(row) == (12.0, 12.0)


def test_clip_triangle_by_square(spark):
    triangle, square = [(0, 0), (4, 0), (0, 4)], [(1, 1), (5, 1), (5, 5), (1, 5)]
    common = rings.clip_convex(ring(*triangle), ring(*square))
    assert one(spark, rings.polygon_area(common))[0] == pytest.approx(2.0)


def test_clip_hexagons_against_plain_python(spark):
    def clip(subject, clipper):
        for (ax, ay), (bx, by) in zip(clipper, clipper[1:] + clipper[:1]):
            side = lambda p: (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax)
            out = []
            for p, q in zip(subject, subject[1:] + subject[:1]):
                if side(p) >= 0:
                    out.append(p)
                if side(p) * side(q) < 0:
                    t = side(p) / (side(p) - side(q))
                    out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
            subject = out
        return subject

    def area(points):
        return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(points, points[1:] + points[:1]))) / 2

    for shift, turn in [(0.5, 0.3), (1.2, 0.9), (3.0, 0.1)]:
        a, b = circle(0, 0, 1, 6), circle(shift, 0.2, 1, 5, turn)
        common = rings.clip_convex(ring(*a), ring(*b))
        got = one(spark, F.when(F.size(common) > 0, rings.polygon_area(common)).otherwise(0.0))[0]
        assert got == pytest.approx(area(clip(a, b)) if clip(a, b) else 0.0)
