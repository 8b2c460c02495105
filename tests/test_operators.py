from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from landrecon.operators import aggregates, filters, joins, lookups, matching, notes, ranking, rewrite, spatial
from landrecon.sources import ids, reference_lists, tables


# ------------------------------------------------------------------------- notes, rewrites
def test_notes_treat_null_as_empty_and_unknown_as_no(frame, rows):
    df = frame("id int, note string, x int", (1, None, 5), (2, "a; ", 5), (3, "a; ", None), (4, None, 1))
    out = notes.append_note(df, "note", F.col("x") > 2, "big; ")
    assert rows(out, "id", "note") == [(1, "big; "), (2, "a; big; "), (3, "a; "), (4, None)]


def test_noted_all_keeps_order(frame, rows):
    df = frame("id int, note string, x int", (1, None, 5), (2, "n; ", 1), (3, None, 0))
    out = df.withColumn("note", notes.noted_all("note", [(F.col("x") > 0, "a; "), (F.col("x") > 2, "b; ")]))
    assert rows(out, "id", "note") == [(1, "a; b; "), (2, "n; a; "), (3, None)]


def test_note_digits(frame, rows):
    df = frame("id int, n string", (1, "by 1234.56ha; by 78.90ha; "), (2, "by 0.56ha; by 123456.00ha; "),
               (3, "by 12345678ha; "), (4, None))
    assert rows(df.filter(notes.note_digits_exceed("n")), "id") == [(1,)]


def test_swap_and_promote(frame, rows):
    df = frame("id int, owner_a int, user_a int", (1, 1, 2), (2, 3, None), (3, None, 4))
    assert rows(rewrite.swap_sides(df, ["a"], F.col("id") == 1)) == [(1, 2, 1), (2, 3, None), (3, None, 4)]
    assert rows(rewrite.promote_side(df, ["a"], F.col("user_a") == 4)) == [(1, 1, 2), (2, 3, None), (3, 4, None)]


def test_one_sided_types_follow_the_present_side(frame):
    df = frame("id int, area decimal(18,2)", (1, None))
    out = rewrite.one_sided(df, ["area"], "user")
    assert out.schema["owner_area"].dataType == out.schema["user_area"].dataType


def test_align_skips_null_target(frame, rows):
    df = frame("id int, a int, b int, n string", (1, 1, 2, None), (2, None, 2, None), (3, 2, 2, None))
    out = rewrite.align_to(df, "a", "b", F.lit(True), "n", "x; ")
    assert rows(out, "id", "a", "n") == [(1, 2, "x; "), (2, None, None), (3, 2, None)]


# -------------------------------------------------------------------------------- filters
def test_delete_keeps_unknown(frame, rows):
    df = frame("id int, x int", (1, 0), (2, None), (3, 5))
    assert rows(filters.delete_where(df, F.col("x") == 0), "id") == [(2,), (3,)]


@pytest.mark.parametrize(
    "listed, expected",
    [([(1,)], [(2,)]), ([(1,), (None,)], []), ([], [(1,), (2,), (None,)])],
)
def test_not_in_three_valued(frame, rows, listed, expected):
    df = frame("k int", (1,), (2,), (None,))
    assert rows(joins.not_in(df, "k", frame("k int", *listed))) == expected


# -------------------------------------------------------------------------------- lookups
def test_with_totals_equals_window_with_null_keys(frame, rows):
    df = frame("k int, g string, x int", (1, "a", 1), (1, "a", 2), (None, "a", 3), (None, "a", 4), (None, None, 5))
    out = lookups.with_totals(df, ["k", "g"], {"t": F.sum("x")})
    assert rows(out, "x", "t") == [(1, 3), (2, 3), (3, 7), (4, 7), (5, 5)]


def test_donor_is_latest_then_largest(frame, rows):
    df = frame("k int, year int, a int, n string", (1, 2016, 9, None), (1, 2018, 4, None), (1, 2018, 5, None),
               (1, 2017, None, None), (2, 2017, None, None))
    out = lookups.fill_from_peer(df, ["k"], "a", F.col("a").isNull(), "n", "filled; ")
    assert rows(out, "k", "year", "a", "n") == [
        (1, 2016, 9, None), (1, 2017, 5, "filled; "), (1, 2018, 4, None), (1, 2018, 5, None), (2, 2017, None, None),
    ]


# -------------------------------------------------------------------------------- ranking
def test_dedupe_groups_nulls(frame, rows):
    df = frame("a int, b string, id string", (None, "x", "2"), (None, "x", "1"), (1, None, "4"), (1, None, "3"), (1, "x", "5"))
    assert rows(ranking.dedupe(df, ["a", "b"], ["id"]), "id") == [("1",), ("3",), ("5",)]


def test_largest_breaks_ties_by_rank_and_code(frame, rows):
    df = frame("k int, c string, m int, rank int", (1, "b", 5, 2), (1, "a", 5, 1), (1, "z", 4, 0), (2, "q", None, 1), (2, "r", 1, 9))
    assert rows(ranking.largest_by_group(df, ["k"], "m", ["rank", "c"]), "k", "c") == [(1, "a"), (2, "r")]
    first = ranking.largest_by_group(df, ["k"], "m", ["rank", "c"], nulls_first=True)
    assert rows(first, "k", "c") == [(1, "a"), (2, "q")]


def test_extra_parties_and_repeats(frame, rows):
    df = frame("k int, p int, id int", (1, 1, 1), (1, 2, 2), (1, 2, 3), (1, None, 4), (2, 7, 5), (None, 1, 6), (None, 2, 7))
    assert rows(ranking.extra_parties(df, ["k"], "p")) == [(1, 2), (1, None), (None, 2)]
    assert rows(ranking.repeats(df, ["k", "p"], "id"), "id") == [(3,)]


def test_top_one_is_limited_before_the_shuffle(frame):
    df = frame("k int, m int", (1, 1))
    plan = ranking.largest_by_group(df, ["k"], "m", [])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


# --------------------------------------------------------------------------------- pairs
def random_side(rng, n, hot):
    return [(f"{i}", rng.choice([1, 1, 1, 2, 3, None]) if hot else rng.randint(1, 20), rng.choice("ab")) for i in range(n)]


@pytest.mark.parametrize("hot_pairs", [0, 1, 3, 10, 1000])
def test_pair_join_grid_is_exact(frame, rows, hot_pairs):
    """One key holds half of all rows on both sides; the grid makes the same pairs, once each."""
    rng = random.Random(hot_pairs)
    left, right = random_side(rng, 40, True), random_side(rng, 30, True)
    a = frame("l string, k int, c string", *left)
    b = frame("r string, k int, d string", *right)
    got = rows(joins.pair_join(a, b, ["k"], "l", "r", hot_pairs), "l", "r")
    assert got == sorted((x[0], y[0]) for x in left for y in right if x[1] is not None and x[1] == y[1])


def tiers():
    guard = F.col("owner_f") == "Y"
    return [
        matching.Tier("1", ("k", "u", "a"), guard, True), matching.Tier("2", ("k", "u")),
        matching.Tier("3", ("k", "a")), matching.Tier("4", ("k",)),
    ]


def brute_tiers(left, right):
    """Tier by tier over pools, as the definition says."""
    def same(x, y, *cols):
        return all(x[c] is not None and x[c] == y[c] for c in cols)

    first = [(x, y, 1) for x in left for y in right if same(x, y, "k", "u", "a") and x["f"] == "Y"]
    used = {x["id"] for x, _, _ in first} | {y["id"] for _, y, _ in first}
    pool_l = [x for x in left if x["id"] not in used]
    pool_r = [y for y in right if y["id"] not in used]
    seen = {(x["id"], y["id"]): n for x, y, n in first}
    for n, cols in [(2, ("k", "u")), (3, ("k", "a")), (4, ("k",))]:
        for x in pool_l:
            for y in pool_r:
                if same(x, y, *cols) and (x["id"], y["id"]) not in seen:
                    seen[x["id"], y["id"]] = n
    return sorted((a, b, n) for (a, b), n in seen.items())


@pytest.mark.parametrize("seed", range(4))
def test_tiered_match_against_brute_force(frame, rows, seed):
    rng = random.Random(seed)

    def side(mark):
        return [
            {"id": f"{mark}{i}", "k": rng.choice([1, 1, 2, 3, None]), "u": rng.choice(["x", "y", None]),
             "a": rng.choice([1, 2, None]), "f": rng.choice("YN")}
            for i in range(25)
        ]

    left, right = side("P"), side("S")
    schema = "id string, k int, u string, a int, f string"
    values = [[tuple(r[c] for c in ("id", "k", "u", "a", "f")) for r in s] for s in (left, right)]
    pairs = matching.tiered_match(frame(schema, *values[0]), frame(schema, *values[1]), tiers(), "id", hot_pairs=4)
    assert rows(pairs, "owner_id", "user_id", "tier") == brute_tiers(left, right)
    assert pairs.select("id").distinct().count() == pairs.count()


def test_single_rows_match(frame, rows):
    a = frame("id string, k int, u string", ("P1", 1, "x"), ("P2", 2, "x"), ("P3", 2, "y"), ("P4", 3, "x"))
    b = frame("id string, k int, u string", ("S1", 1, "x"), ("S2", 2, "x"), ("S4", 3, "y"))
    out = joins.unique_match(a, b, ["k"], ["k", "u"], "id", "id")
    assert rows(out, "owner_id", "user_id") == [("P1", "S1")]


def test_weaker_pairs(frame, rows):
    pairs = frame(
        "claim_id string, owner_claim_id string, user_claim_id string, tier int, owner_land_leased_out string",
        ("a", "P1", "S1", 1, "Y"), ("b", "P2", "S1", 4, "Y"), ("c", "P3", "S2", 2, "N"), ("d", "P4", "S2", 3, "Y"),
        ("e", "P5", "S3", 4, "N"), ("f", "P6", "S4", 4, "N"), ("g", "P7", "S4", 2, "N"), ("h", "P8", "S5", 4, "Y"), ("i", "P9", "S5", 4, "Y"),
    )
    assert rows(matching.drop_weaker_pairs(pairs), "claim_id") == [("a",), ("d",), ("e",), ("g",)]


# ---------------------------------------------------------------------------- aggregates
def shares(frame):
    return frame(
        "k int, x int, id string, n string, act string",
        (1, 1, "L1, S1", None, "a"), (1, 2, "L1, S2", None, "b"), (2, 5, "L2, S3", "n; ", "a"),
        (None, 1, "L3, S4", None, "a"), (None, 2, "L3, S5", None, "a"),
        (3, 1, "L4, S6", None, "a"), (3, 1, "L4, S7", None, "a"), (3, 1, "L4, S8", None, "a"),
    )


def test_consolidate(frame, rows):
    out, members = aggregates.consolidate(shares(frame), ["k"], ["x"], "id", "n", "m; ", {"act": "Z"})
    assert rows(out, "k", "x", "id", "n", "act", "n_members") == [
        (1, 3, "L1, S1", "m; ", "Z", 2), (2, 5, "L2, S3", "n; ", "a", 1), (3, 3, "L4, S6", "m; ", "Z", 3),
        (None, 1, "L3, S4", None, "a", 1), (None, 2, "L3, S5", None, "a", 1),
    ]
    assert rows(members) == [("L1, S1", "L1, S1"), ("L1, S1", "L1, S2")] + [("L4, S6", f"L4, S{i}") for i in (6, 7, 8)]


def test_consolidate_lists_every_member_of_a_large_group(spark):
    ids = F.format_string("c%05d", F.col("id"))
    df = spark.range(10_000).select(
        F.lit(1).alias("k"), F.lit(2).alias("x"), ids.alias("id"), F.when(F.col("id") % 2 == 0, "even; ").alias("n"))
    out, members = aggregates.consolidate(df, ["k"], ["x"], "id", "n", "m; ")
    assert sorted(tuple(r) for r in out.select("x", "id", "n", "n_members").collect()) == [
        (10_000, "c00000", "even; m; ", 5_000), (10_000, "c00001", "m; ", 5_000)]
    found = {r.member_id: r.id for r in members.collect()}
    assert found == {f"c{i:05d}": f"c0000{i % 2}" for i in range(10_000)}


def test_values_as_rows(frame, rows):
    df = frame("k int, v string", (1, "b"), (1, "a"), (1, "b"), (1, None), (2, None))
    assert rows(aggregates.value_copies(df, ["k"], "v")) == [(1, "a", 1), (1, "b", 2)]
    assert rows(aggregates.distinct_values(df, ["k"], "v")) == [(1, "a"), (1, "b")]
    nested = df.select("k", F.array("v", "v").alias("w"))
    assert rows(aggregates.distinct_elements(nested, ["k"], "w", "v")) == [(1, "a"), (1, "b")]


def test_sum_if_is_null_without_hits(frame, rows):
    df = frame("k int, f string", (1, "Y"), (1, "Y"), (2, "N"))
    assert rows(df.groupBy("k").agg(aggregates.sum_if(F.col("f") == "Y").alias("n"))) == [(1, 2), (2, None)]


# ------------------------------------------------------------------------------- numbering
@pytest.mark.parametrize("block", [2, 1_000_000])
def test_number_rows_is_dense_and_ordered_with_many_copies(frame, rows, monkeypatch, block):
    monkeypatch.setattr(ids, "BLOCK", block)
    data = [(5, "x")] * 7 + [(i % 4, c) for i in range(20) for c in ("a", None)]
    out = rows(ids.number_rows(frame("a int, b string", *data), ["a", "b"]), "id", "a", "b")
    out.sort(key=lambda r: r[0])
    assert [r[0] for r in out] == list(range(1, len(data) + 1))
    expected = sorted(data, key=lambda r: (r[0], r[1] is not None, r[1] or ""))
    assert [(r[1], r[2]) for r in out] == expected


def test_surrogates_keep_null_and_link_back(frame, rows):
    df = frame("id int, private string", (1, "z"), (2, "a"), (3, "z"), (4, None))
    out, links = ids.surrogate_ids(df, ["private"])
    assert rows(out, "id", "private") == [(1, 2), (2, 1), (3, 2), (4, None)]
    assert rows(links["private"], "private", "surrogate_id") == [("a", 1), ("z", 2)]


def test_reference_lists(spark):
    assert reference_lists.excluded_land_uses(spark).count() == 19
    assert reference_lists.land_use_rank(spark, 1).count() == 124
    assert reference_lists.land_use_rank(spark, 2).count() == 125


def test_union_years(frame, rows):
    out = tables.union_years({2017: frame("x int", (1,)), 2016: frame("x int", (2,))})
    assert rows(out) == [(1, 2017), (2, 2016)]


# --------------------------------------------------------------------------------- spatial
@pytest.mark.parametrize("cell", [3.0, 10.0, 200.0])
@pytest.mark.parametrize("rectangles, hot_pairs", [(True, 10**9), (True, 0), (True, 40), (False, 20)])
def test_overlap_against_brute_force(spark, rows, cell, rectangles, hot_pairs):
    from landrecon.functions.rings import rect_ring

    rng = random.Random(7)

    def boxes(n):
        return [(i, x, y, x + rng.randint(1, 15), y + rng.randint(1, 15)) for i in range(n) for x, y in [(rng.randint(-20, 40), rng.randint(-20, 40))]]

    a, b = boxes(30) + [(30, 0, 0, 5, 5)], boxes(30) + [(30, 5, 0, 9, 5)]
    make = lambda data: spark.createDataFrame(data, "id int, x0 int, y0 int, x1 int, y1 int").select(
        "id", rect_ring(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")).alias("ring"))
    got = rows(spatial.overlap_join(make(a), make(b), "id", "id", cell, rectangles=rectangles, hot_pairs=hot_pairs), "key_a", "key_b", F.round(F.col("area_overlap") * 10000, 6))
    expected = []
    for i, p0, q0, p1, q1 in a:
        for j, r0, s0, r1, s1 in b:
            w, h = min(p1, r1) - max(p0, r0), min(q1, s1) - max(q0, s0)
            if w >= 0 and h >= 0:
                expected.append((i, j, float(w * h)))
    assert got == sorted(expected, key=lambda r: [(False, str(v)) for v in r])
    assert (30, 30, 0.0) in got  # a shared edge counts as touching


def test_ring_parts_are_whole(spark):
    from landrecon.functions.rings import rect_ring

    shapes = spark.range(40).select((F.col("id") % 20 == 0).alias("k"), rect_ring(F.lit(0), F.lit(0), F.lit(2), F.lit(1)).alias("ring"))
    parts, sums = spatial.ring_parts(shapes, ["k"])
    assert parts.count() == 40
    assert {r.k: (r.n_parts, r.area) for r in sums.collect()} == {True: (2, 4.0), False: (38, 76.0)}


def test_a_large_polygon_meets_a_handful_of_cells_and_stacked_ones_are_split(spark):
    from landrecon.functions.rings import rect_ring

    large = spark.range(1).select("id", rect_ring(F.lit(3), F.lit(3), F.lit(100_003), F.lit(100_003)).alias("ring"))
    boxes = spatial._boxed(large, "id", "ring", "a", 100.0)
    assert spatial._in_cells(boxes, "a", F.array("_level"), 100.0).count() <= 4
    stacked = spark.range(300).select("id", rect_ring(F.lit(10), F.lit(10), F.lit(20), F.lit(20)).alias("ring"))
    got = spatial.overlap_join(large.unionByName(stacked), stacked, "id", "id", 100.0, rectangles=True, hot_pairs=1000)
    assert got.count() == 301 * 300 and got.distinct().count() == 300 * 300 + 300


def test_rings_that_are_not_convex_are_rejected(spark):
    square, notched = [(0, 0), (4, 0), (4, 4), (0, 4)], [(0, 0), (4, 0), (2, 1), (4, 4), (0, 4)]
    rows = [(i, [(float(x), float(y)) for x, y in ring]) for i, ring in enumerate([square, notched, square[::-1]])]
    df = spark.createDataFrame(rows, "id int, ring array<struct<x: double, y: double>>")
    good, bad = spatial.convex_only(df)
    assert sorted(r.id for r in good.collect()) == [0, 2] and [r.id for r in bad.collect()] == [1]
