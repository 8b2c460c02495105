"""Polygon rings as arrays of (x, y) structs, measured with native array functions.

A ring lists its corners once, in either direction, and need not repeat the first corner.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HECTARES_PER_M2 = 0.0001


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def rect_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1))


def _next_corners(ring: Column) -> Column:
    """The ring moved on by one corner, so that zipping gives the edges."""
    return F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))


def signed_area(ring: Column) -> Column:
    """Shoelace sum; positive when the corners run counter-clockwise."""
    cross = F.zip_with(
        ring, _next_corners(ring), lambda a, b: a["x"] * b["y"] - b["x"] * a["y"]
    )
    return F.aggregate(cross, F.lit(0.0), lambda total, c: total + c) / 2.0


def polygon_area(ring: Column) -> Column:
    return F.abs(signed_area(ring))


def area_hectares(ring: Column) -> Column:
    return polygon_area(ring) * HECTARES_PER_M2


def bounds(ring: Column) -> Column:
    xs, ys = ring["x"], ring["y"]
    return F.struct(
        F.array_min(xs).alias("x0"),
        F.array_min(ys).alias("y0"),
        F.array_max(xs).alias("x1"),
        F.array_max(ys).alias("y1"),
    )


def counter_clockwise(ring: Column) -> Column:
    return F.when(signed_area(ring) < 0, F.reverse(ring)).otherwise(ring)


def is_convex(ring: Column) -> Column:
    """All corners turn the same way, or go straight on; rings may repeat their first corner."""
    second = _next_corners(ring)
    third = _next_corners(second)
    steps = F.zip_with(
        F.zip_with(ring, second, lambda p, q: F.struct(p.alias("p"), q.alias("q"))), third,
        lambda pq, r: (pq["q"]["x"] - pq["p"]["x"]) * (r["y"] - pq["q"]["y"])
        - (pq["q"]["y"] - pq["p"]["y"]) * (r["x"] - pq["q"]["x"]),
    )
    return ~(F.exists(steps, lambda t: t > 0) & F.exists(steps, lambda t: t < 0))


def clip_convex(subject: Column, clip: Column) -> Column:
    """Overlap of two convex rings: keep the part left of every edge of the clip ring.

    ``clip`` must run counter-clockwise. The result has no corners if the rings are apart.
    """
    edges = F.zip_with(clip, _next_corners(clip), lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    def side(p: Column, edge: Column) -> Column:
        a, b = edge["a"], edge["b"]
        return (b["x"] - a["x"]) * (p["y"] - a["y"]) - (b["y"] - a["y"]) * (p["x"] - a["x"])

    def crossing(p: Column, q: Column, sp: Column, sq: Column) -> Column:
        t = F.try_divide(sp, sp - sq)
        return point(p["x"] + t * (q["x"] - p["x"]), p["y"] + t * (q["y"] - p["y"]))

    def keep_left(ring: Column, edge: Column) -> Column:
        def corner(step: Column) -> Column:
            p, q = step["p"], step["q"]
            sp, sq = side(p, edge), side(q, edge)
            here = F.when(sp >= 0, F.array(point(p["x"], p["y"]))).otherwise(F.array())
            cut = F.when(
                ((sp > 0) & (sq < 0)) | ((sp < 0) & (sq > 0)), F.array(crossing(p, q, sp, sq))
            ).otherwise(F.array())
            return F.concat(here, cut)

        steps = F.zip_with(
            ring, _next_corners(ring), lambda p, q: F.struct(p.alias("p"), q.alias("q"))
        )
        return F.flatten(F.transform(steps, corner))

    return F.aggregate(edges, subject, keep_left)


def edges_of(ring: Column) -> Column:
    """The edges as (p, q) structs."""
    return F.zip_with(ring, _next_corners(ring), lambda p, q: F.struct(p.alias("p"), q.alias("q")))


def segments_meet(a: Column, b: Column) -> Column:
    """Whether two edges cross, touch or overlap."""

    def turn(o: Column, p: Column, q: Column) -> Column:
        return F.signum((p["x"] - o["x"]) * (q["y"] - o["y"]) - (p["y"] - o["y"]) * (q["x"] - o["x"]))

    def boxes_meet(axis: str) -> Column:
        low = F.greatest(F.least(a["p"][axis], a["q"][axis]), F.least(b["p"][axis], b["q"][axis]))
        high = F.least(F.greatest(a["p"][axis], a["q"][axis]), F.greatest(b["p"][axis], b["q"][axis]))
        return low <= high

    apart_b = turn(a["p"], a["q"], b["p"]) * turn(a["p"], a["q"], b["q"]) <= 0
    apart_a = turn(b["p"], b["q"], a["p"]) * turn(b["p"], b["q"], a["q"]) <= 0
    return boxes_meet("x") & boxes_meet("y") & apart_a & apart_b
