"""Overlap of polygon tables through a grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from landrecon.functions.rings import (
    HECTARES_PER_M2, bounds, clip_convex, counter_clockwise, edges_of, is_convex, polygon_area, rect_ring, segments_meet, signed_area,
)
from landrecon.operators.joins import HOT_PAIRS, pair_join
from landrecon.operators.lookups import attach
from landrecon.session import stage

# Share of a polygon's area that sums of its triangles may be off by.
ROUNDING = 1e-9


def ring_parts(df: DataFrame, keys: list[str], ring: str = "ring") -> tuple[DataFrame, DataFrame]:
    """All rings of a key as a multi-part value: (key, ring) rows, one per part, and per key the
    number of parts and the area of all of them."""
    sums = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_parts"), F.sum(polygon_area(F.col(ring))).alias("area")
    )
    return df.select(*keys, ring), sums


def _boxed(df: DataFrame, key: str, ring: str, side: str, cell: float) -> DataFrame:
    """Polygons with a number of their own, their box and their grid level: the cell size is
    doubled until it is no less than the longer side of the box."""
    box = bounds(F.col(ring))
    numbered = stage(
        df.select(
            F.monotonically_increasing_id().alias(f"id_{side}"), F.col(key).alias(f"key_{side}"),
            F.col(ring).alias(f"ring_{side}"), box.alias(f"box_{side}"),
        ),
        "polygons",
    )
    at = F.col(f"box_{side}")
    size = F.greatest(at["x1"] - at["x0"], at["y1"] - at["y0"])
    level = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(size / cell, F.lit(1.0)))))
    return numbered.withColumn("_level", level.cast("int"))


def _axis_cells(low: Column, high: Column, size: Column) -> Column:
    return F.sequence(F.floor(low / size), F.floor(high / size))


def _in_cells(boxes: DataFrame, side: str, levels: Column, cell: float) -> DataFrame:
    """One row per grid cell that a box meets on each of the levels, at most four a level; ids and
    boxes only."""
    at = F.col(f"box_{side}")
    size = F.pow(F.lit(2.0), F.col("_at")) * cell
    return (
        boxes.select(f"id_{side}", f"box_{side}", F.explode(levels).alias("_at"))
        .withColumn("_cx", F.explode(_axis_cells(at["x0"], at["x1"], size)))
        .withColumn("_cy", F.explode(_axis_cells(at["y0"], at["y1"], size)))
    )


def _levels(boxes: DataFrame) -> list[int]:
    """The levels in use: a few numbers, as each doubles the size."""
    return sorted(r[0] for r in boxes.select("_level").distinct().collect() if r[0] is not None)


def _candidates(left: DataFrame, right: DataFrame, cell: float, hot_pairs: int) -> DataFrame:
    """Pairs of ids whose boxes overlap or touch, each once: on the level of the larger polygon, in
    the cell of the lower left corner of the boxes' common part."""
    own = F.array("_level")
    levels_left, levels_right = _levels(left), _levels(right)

    def above(levels: list[int], at_least: bool) -> Column:
        every = F.array(*[F.lit(n) for n in levels]) if levels else F.array().cast("array<int>")
        return F.filter(every, lambda n: (n >= F.col("_level")) if at_least else (n > F.col("_level")))

    at = ["_at", "_cx", "_cy"]
    # the right polygon is no larger, then the right one is larger
    halves = [
        (_in_cells(left, "a", own, cell), _in_cells(right, "b", above(levels_left, True), cell)),
        (_in_cells(left, "a", above(levels_right, False), cell), _in_cells(right, "b", own, cell)),
    ]
    p, q = F.col("box_a"), F.col("box_b")
    x0, y0 = F.greatest(p["x0"], q["x0"]), F.greatest(p["y0"], q["y0"])
    x1, y1 = F.least(p["x1"], q["x1"]), F.least(p["y1"], q["y1"])
    size = F.pow(F.lit(2.0), F.col("_at")) * cell
    here = (F.col("_cx") == F.floor(x0 / size)) & (F.col("_cy") == F.floor(y0 / size))
    found = [
        pair_join(a, b, at, "id_a", "id_b", hot_pairs)
        .filter((x0 <= x1) & (y0 <= y1) & here)
        .select("id_a", "id_b", "box_a", "box_b", ((x1 - x0) * (y1 - y0)).alias("area_common"))
        for a, b in halves
    ]
    return found[0].unionByName(found[1])


def overlap_join(
    a: DataFrame, b: DataFrame, key_a: str, key_b: str, cell: float,
    ring: str = "ring", rectangles: bool = False, hot_pairs: int = HOT_PAIRS,
) -> DataFrame:
    """Pairs of polygons that overlap or touch, with both areas and the overlap, in hectares.

    Boxes are joined through a grid with levels: a polygon lies on the level whose cells are about
    its size and meets at most four of them, however large it is; a pair meets on the level of its
    larger polygon. A cell of more than ``hot_pairs`` pairs, such as polygons stacked on one spot,
    is cut into slices against slices. Rings are axis-parallel rectangles (``rectangles``), for
    which the boxes tell everything, or convex; these are fetched by id for the pairs whose boxes
    overlap, and clipped against each other. ``cell`` should be about the size of a small polygon.
    """
    left, right = _boxed(a, key_a, ring, "a", cell), _boxed(b, key_b, ring, "b", cell)
    pairs = _candidates(left, right, cell, hot_pairs)
    if rectangles:
        areas = {s: (F.col(f"box_{s}")["x1"] - F.col(f"box_{s}")["x0"]) * (F.col(f"box_{s}")["y1"] - F.col(f"box_{s}")["y0"]) for s in "ab"}
        keyed = attach(pairs, left.select("id_a", "key_a"), ["id_a"], "inner")
        keyed = attach(keyed, right.select("id_b", "key_b"), ["id_b"], "inner")
        measured = keyed.withColumns({"area_overlap": F.col("area_common"), **{f"_area_{s}": v for s, v in areas.items()}})
    else:
        # prepared once per polygon, not once per pair
        own = left.select("id_a", "key_a", "ring_a", polygon_area(F.col("ring_a")).alias("_area_a"))
        other = right.select(
            "id_b", "key_b", counter_clockwise(F.col("ring_b")).alias("ring_b"), polygon_area(F.col("ring_b")).alias("_area_b")
        )
        joined = attach(attach(pairs.select("id_a", "id_b"), own, ["id_a"], "inner"), other, ["id_b"], "inner")
        common = clip_convex(F.col("ring_a"), F.col("ring_b"))
        measured = (
            joined.withColumn("_common", common)
            .filter(F.size("_common") > 0)
            .withColumn("area_overlap", polygon_area(F.col("_common")))
        )
    return measured.select(
        "key_a", "key_b",
        (F.col("_area_a") * HECTARES_PER_M2).alias("area_a"),
        (F.col("_area_b") * HECTARES_PER_M2).alias("area_b"),
        (F.col("area_overlap") * HECTARES_PER_M2).alias("area_overlap"),
    )


def _edges(df: DataFrame, key: str, rings: str, side: str) -> DataFrame:
    """Polygons as signed triangles: one for each edge, from the polygon's first corner to the edge.
    Inside the polygon their signs add up to 1, outside to 0, whatever its shape; holes run the other
    way round than the outer ring, which is the first. An edge at the first corner gives a triangle
    without area, which is kept for the edge."""
    outer = F.col(rings)[0]
    listed = df.select(
        F.monotonically_increasing_id().alias(f"poly_{side}"), F.col(key).alias("_key"), outer[0].alias("_o"),
        F.transform(rings, lambda r, i: F.when(i == 0, counter_clockwise(r)).otherwise(F.reverse(counter_clockwise(r)))).alias("_rings"),
    )
    polygons = stage(listed.withColumn("_area", F.abs(F.aggregate(F.transform("_rings", signed_area), F.lit(0.0), lambda a, b: a + b))), "polygons")
    edges = polygons.select(f"poly_{side}", "_o", F.explode("_rings").alias("_ring")).select(
        f"poly_{side}", "_o", F.explode(edges_of(F.col("_ring"))).alias("e")
    )
    triangle = F.array("_o", F.col("e")["p"], F.col("e")["q"])
    signed = edges.withColumns({"_triangle": triangle, "_sign": F.signum(signed_area(triangle)).cast("int")})
    return polygons.drop("_rings", "_o"), signed.select(
        f"poly_{side}", "_sign", F.col("e").alias("_edge"), counter_clockwise(F.col("_triangle")).alias("_triangle")
    )


def _triangles_boxed(triangles: DataFrame, side: str, cell: float) -> DataFrame:
    packed = triangles.withColumn("_all", F.struct(f"poly_{side}", "_sign", "_edge"))
    return _boxed(packed, "_all", "_triangle", side, cell)


def polygon_overlap_join(
    a: DataFrame, b: DataFrame, key_a: str, key_b: str, cell: float, rings: str = "rings", hot_pairs: int = HOT_PAIRS
) -> DataFrame:
    """``overlap_join`` for polygons of any shape, with holes: ``rings`` has the outer ring, then the
    holes. Rings do not cross themselves or each other.

    Both sides are taken apart into signed triangles, which meet through the grid like polygons; a pair's
    overlap is the signed sum of the overlaps of its triangles. The work follows the corners that lie
    near each other, and a polygon of very many corners is spread over tasks. Pairs that only touch have
    an overlap of 0.
    """
    polygons_a, triangles_a = _edges(a, key_a, rings, "a")
    polygons_b, triangles_b = _edges(b, key_b, rings, "b")
    left, right = _triangles_boxed(triangles_a, "a", cell), _triangles_boxed(triangles_b, "b", cell)
    pairs = _candidates(left, right, cell, hot_pairs).select("id_a", "id_b")
    met = attach(attach(pairs, left.drop("box_a", "_level"), ["id_a"], "inner"), right.drop("box_b", "_level"), ["id_b"], "inner")
    sign = F.col("key_a._sign") * F.col("key_b._sign")
    common = F.when(sign != 0, polygon_area(clip_convex(F.col("ring_a"), F.col("ring_b")))).otherwise(0.0)
    sums = met.groupBy(F.col("key_a.poly_a").alias("poly_a"), F.col("key_b.poly_b").alias("poly_b")).agg(
        F.sum(sign * common).alias("_overlap"),
        F.max(segments_meet(F.col("key_a._edge"), F.col("key_b._edge"))).alias("_touch"),
    )
    own = polygons_a.select("poly_a", F.col("_key").alias("key_a"), F.col("_area").alias("_area_a"))
    other = polygons_b.select("poly_b", F.col("_key").alias("key_b"), F.col("_area").alias("_area_b"))
    # Below this share of the smaller polygon, a sum is the rounding of terms that cancel.
    real = F.col("_overlap") > ROUNDING * F.least("_area_a", "_area_b")
    return (
        attach(attach(sums, own, ["poly_a"], "inner"), other, ["poly_b"], "inner")
        .filter(real | F.col("_touch"))
        .select(
            "key_a", "key_b", (F.col("_area_a") * HECTARES_PER_M2).alias("area_a"), (F.col("_area_b") * HECTARES_PER_M2).alias("area_b"),
            F.when(real, F.col("_overlap") * HECTARES_PER_M2).otherwise(0.0).alias("area_overlap"),
        )
    )


def dissolve_rectangles(df: DataFrame, keys: list[str], cell: float, ring: str = "ring") -> DataFrame:
    """The axis-parallel rectangles of each key as rectangles that do not overlap: (keys, ring) rows that
    cover just what the given ones cover together.

    Rectangles are cut at the lines of a grid, so that only those near each other meet, and within a cell
    at each other's left and right sides; in the slabs this gives, upright intervals that overlap or touch
    are merged. Equal pieces are dropped before they meet. Work in a cell grows with the square of the
    different pieces in it, so ``cell`` should be about the size of a small part.
    """
    box = bounds(F.col(ring))
    cut = (
        df.select(*keys, box.alias("b"))
        .withColumn("_cx", F.explode(_axis_cells(F.col("b.x0"), F.col("b.x1"), F.lit(cell))))
        .withColumn("_cy", F.explode(_axis_cells(F.col("b.y0"), F.col("b.y1"), F.lit(cell))))
        .select(
            *keys, "_cx", "_cy",
            F.greatest("b.x0", F.col("_cx") * cell).alias("x0"), F.least("b.x1", (F.col("_cx") + 1) * cell).alias("x1"),
            F.greatest("b.y0", F.col("_cy") * cell).alias("y0"), F.least("b.y1", (F.col("_cy") + 1) * cell).alias("y1"),
        )
        .filter("x0 < x1 AND y0 < y1").distinct()
    )
    pieces, place = stage(cut, "pieces"), [*keys, "_cx", "_cy"]
    lines = pieces.groupBy(*place).agg(F.sort_array(F.collect_set("x0")).alias("_from"), F.collect_set("x1").alias("_to"))
    lines = lines.select(*place, F.array_sort(F.array_union("_from", "_to")).alias("_lines"))
    inner = F.filter("_lines", lambda x: (x >= F.col("x0")) & (x <= F.col("x1")))
    slabs = attach(pieces, lines, place, "inner", null_safe=True).withColumn("_own", inner).select(
        *place, "y0", "y1", F.explode(F.transform(F.slice("_own", 1, F.size("_own") - 1), lambda x, i: F.struct(x.alias("l"), F.get("_own", i + 1).alias("r")))).alias("s")
    )
    slab = [*place, "s"]
    below = Window.partitionBy(*slab).orderBy("y0", "y1")
    reached = F.max("y1").over(below.rowsBetween(Window.unboundedPreceding, -1))
    begun = slabs.withColumn("_new", F.when(reached >= F.col("y0"), 0).otherwise(1))
    runs = begun.withColumn("_run", F.sum("_new").over(below.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    merged = runs.groupBy(*slab, "_run").agg(F.min("y0").alias("y0"), F.max("y1").alias("y1"))
    return merged.select(*keys, rect_ring(F.col("s.l"), F.col("y0"), F.col("s.r"), F.col("y1")).alias(ring))


def convex_only(df: DataFrame, ring: str = "ring") -> tuple[DataFrame, DataFrame]:
    """(rows with a convex ring, rejected rows): ``overlap_join`` would clip others wrongly."""
    marked = df.withColumn("_convex", F.coalesce(is_convex(F.col(ring)), F.lit(False)))
    return marked.filter("_convex").drop("_convex"), marked.filter("not _convex").drop("_convex")
