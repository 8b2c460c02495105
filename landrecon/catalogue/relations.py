"""Joins, aggregates, windows, set operations and spatial operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from landrecon.catalogue import derive
from landrecon.catalogue.registry import query
from landrecon.functions.rings import area_hectares, point, rect_ring
from landrecon.operators import aggregates, joins, lookups, matching, ranking, setops, spatial
from landrecon.plans import commons, largest_use, reconcile
from landrecon.session import stage

PY = ["hapar_id", "year"]
FOUR = [*PY, "land_use", "land_use_area"]


def n_rows():
    return F.count(F.lit(1))


# --------------------------------------------------------------------------------- joins
@query("J1_inner_join",
       """SELECT p.hapar_id, p.year, p.claim_id AS owner_id, s.claim_id AS user_id FROM perm p
          JOIN seas s USING (hapar_id, year, land_use, land_use_area)""")
def _(t):
    owners = t.perm.select(*FOUR, F.col("claim_id").alias("owner_id"))
    renters = t.seas.select(*FOUR, F.col("claim_id").alias("user_id"))
    return joins.pair_join(owners, renters, FOUR, "owner_id", "user_id").select(*PY, "owner_id", "user_id")


@query("J2_tiered_match", "SELECT claim_id, hapar_id, year, tier, owner_land_use, user_land_use FROM pairs_all", big="tier")
def _(t):
    kept = [*FOUR, "claim_id", "land_leased_out", "bps_claimed_area"]

    def pairs(of):
        found = matching.tiered_match(of.perm.select(*kept), of.seas.select(*kept), reconcile.match_tiers())
        return found.select("claim_id", *PY, F.col("tier").cast("bigint").alias("tier"), "owner_land_use", "user_land_use")

    return t.in_place(pairs, "tiers")


@query("J3_tier_guard",
       """SELECT p.claim_id || ', ' || s.claim_id AS claim_id FROM perm p JOIN seas s USING (hapar_id, year, land_use, land_use_area)
          WHERE p.land_leased_out = 'Y' OR (p.land_leased_out = 'N' AND p.bps_claimed_area = 0)""")
def _(t):
    kept = [*FOUR, "claim_id", "land_leased_out", "bps_claimed_area"]
    first = [matching.Tier("first", tuple(FOUR), reconcile.leasing_guard())]
    return t.in_place(lambda of: matching.tiered_match(of.perm.select(*kept), of.seas.select(*kept), first).select("claim_id"), "tier")


@query("J4_pairs_unique", "SELECT tier, count(*) AS n, count(DISTINCT claim_id) AS n_distinct FROM pairs GROUP BY tier", big="tier n n_distinct")
def _(t):
    return t.pairs.groupBy(F.col("tier").cast("bigint").alias("tier")).agg(
        n_rows().alias("n"), F.countDistinct("claim_id").alias("n_distinct"))


@query("J5_remove_matched", "SELECT claim_id FROM perm_left UNION ALL SELECT claim_id FROM seas_left")
def _(t):
    def left(of):
        """A claim's id names its parcel."""
        claims = [("owner", of.perm), ("user", of.seas)]
        sides = [matching.remove_matched(df.select("hapar_id", "claim_id"), of.pairs, "claim_id", side, ("hapar_id",)) for side, df in claims]
        return sides[0].unionByName(sides[1]).select("claim_id")

    return t.in_place(left, "left")


@query("J6_prune_pairs", "SELECT claim_id FROM pairs WHERE tier = 4")
def _(t):
    kept = [*FOUR, "claim_id", "land_leased_out", "bps_claimed_area"]

    def pairs(of):
        found = matching.tiered_match(of.perm.select(*kept), of.seas.select(*kept), reconcile.match_tiers())
        return matching.prune_pairs(found, 4, reconcile.implausible_pair()).filter("tier = 4").select("claim_id")

    return t.in_place(pairs, "tier-4")


@query("J7_semi_join", "SELECT claim_id FROM perm WHERE (hapar_id, year) IN (SELECT (hapar_id, year) FROM seas)")
def _(t):
    return joins.semi(t.perm, t.seas, PY).select("claim_id")


@query("J8_not_in",
       """SELECT claim_id FROM perm_raw WHERE hapar_id NOT IN (SELECT hapar_id FROM seas_raw WHERE land_use = 'LLO' AND hapar_id IS NOT NULL)""")
def _(t):
    listed = t.seas_raw.filter((F.col("land_use") == "LLO") & F.col("hapar_id").isNotNull())
    return joins.not_in(t.perm_raw, "hapar_id", listed).select("claim_id")


@query("J8_not_in_null_list",
       "SELECT count(*) AS n FROM perm_raw WHERE hapar_id NOT IN (SELECT hapar_id FROM seas_raw)", big="n")
def _(t):
    """A NULL on the list leaves nothing."""
    return joins.not_in(t.perm_raw, "hapar_id", t.seas_raw).agg(n_rows().alias("n"))


@query("J9_exists_delete",
       """SELECT claim_id FROM perm_raw p WHERE NOT (land_leased_out = 'N' AND EXISTS (SELECT 1 FROM seas_raw s
            WHERE s.hapar_id = p.hapar_id AND s.year = p.year AND s.land_use = p.land_use AND s.land_use_area = p.land_use_area))""")
def _(t):
    return joins.exists_delete(t.perm_raw, t.seas_raw, FOUR, F.col("land_leased_out") == "N").select("claim_id")


@query("J10_either_in",
       """SELECT claim_id FROM pairs WHERE owner_claim_id IN (SELECT owner_claim_id FROM pairs_1)
          OR user_claim_id IN (SELECT claim_id FROM seas WHERE land_use = 'WW')""")
def _(t):
    first = t.pairs.filter("tier = 1").select(F.col("owner_claim_id").alias("c"))
    listed = first.unionByName(t.seas.filter("land_use = 'WW'").select(F.col("claim_id").alias("c")))
    columns = {"owner": F.col("owner_claim_id"), "user": F.col("user_claim_id")}
    return joins.either_in(t.pairs.select("claim_id", *[c for c in ("owner_claim_id", "user_claim_id")]), columns, listed, "c").select("claim_id")


@query("J11_update_from",
       """SELECT p.claim_id, CASE WHEN s.top > p.land_use_area THEN s.top ELSE p.land_use_area END AS land_use_area,
                 CASE WHEN s.top > p.land_use_area THEN concat(p.change_note, 'updated; ') ELSE p.change_note END AS change_note
          FROM perm p LEFT JOIN (SELECT hapar_id, year, max(land_use_area) AS top FROM seas GROUP BY ALL) s
          ON s.hapar_id = p.hapar_id AND s.year = p.year""", double="land_use_area")
def _(t):
    top = t.seas.groupBy(*PY).agg(F.max("land_use_area").alias("top"))
    out = lookups.update_from(t.perm, top, PY, "land_use_area", "top", F.col("top") > F.col("land_use_area"), "change_note", "updated; ")
    return out.select("claim_id", "land_use_area", "change_note")


@query("J12_fill_from_peer",
       """SELECT c.claim_id, coalesce(c.land_parcel_area, d.land_parcel_area) AS land_parcel_area FROM perm_clean c LEFT JOIN (
            SELECT hapar_id, land_parcel_area FROM perm_clean WHERE land_parcel_area IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY hapar_id ORDER BY year DESC, land_parcel_area DESC) = 1) d USING (hapar_id)""",
       double="land_parcel_area")
def _(t):
    out = lookups.fill_from_peer(t.perm_clean, ["hapar_id"], "land_parcel_area", F.col("land_parcel_area").isNull(), "change_note", "")
    return out.select("claim_id", "land_parcel_area")


@query("J13_fill_from_other_year",
       """SELECT c.claim_id, coalesce(c.land_use_area, d.land_use_area) AS land_use_area FROM seas_clean c LEFT JOIN (
            SELECT hapar_id, land_use, land_use_area FROM seas_clean WHERE land_use_area IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY hapar_id, land_use ORDER BY year DESC, land_use_area DESC) = 1) d USING (hapar_id, land_use)""",
       double="land_use_area")
def _(t):
    out = lookups.fill_from_peer(t.seas_clean, ["hapar_id", "land_use"], "land_use_area", F.col("land_use_area").isNull(), "change_note", "")
    return out.select("claim_id", "land_use_area")


@query("J14_join_back",
       """SELECT id, count(*) OVER w AS n, sum(share_area) OVER w AS area FROM commons_built
          WINDOW w AS (PARTITION BY cg_hahol_id, year, mlc_hahol_id)""", double="area", big="n")
def _(t):
    aggs = {"n": n_rows(), "area": F.sum("share_area")}
    keys = ["cg_hahol_id", "year", "mlc_hahol_id"]
    return lookups.with_totals(t.commons_built.select("id", *keys, "share_area"), keys, aggs).select("id", "n", "area")


@query("J15_arg_max_ties", "SELECT claim_id FROM (SELECT *, max(land_use_area) OVER (PARTITION BY hapar_id, year) AS top FROM perm) WHERE land_use_area = top")
def _(t):
    return lookups.arg_max_ties(t.perm.select(*PY, "claim_id", "land_use_area"), PY, "land_use_area").select("claim_id")


@query("J16_same_total_diff_count",
       """SELECT DISTINCT p.hapar_id FROM (SELECT hapar_id, year, sum(land_use_area) AS a, count(*) AS n FROM perm GROUP BY ALL) p
          JOIN (SELECT hapar_id, year, sum(land_use_area) AS a, count(*) AS n FROM seas GROUP BY ALL) s
          ON s.hapar_id = p.hapar_id AND s.a = p.a WHERE p.n <> s.n""")
def _(t):
    return joins.same_total_diff_count(t.perm, t.seas, "hapar_id", ["year"], "land_use_area")


@query("J17_other_party_join",
       """SELECT a.claim_id, b.claim_id AS other_claim_id FROM seas a JOIN seas b
          ON a.hapar_id = b.hapar_id AND a.year = b.year AND a.habus_id <> b.habus_id WHERE b.land_leased_out = 'Y'""")
def _(t):
    rows = t.seas.select(*PY, "claim_id", "habus_id", "land_leased_out")
    out = joins.other_party_join(rows, PY, "habus_id", F.col("land_leased_out") == "Y", "claim_id")
    return out.select("claim_id", "other_claim_id")


_STRICT = (
    "hahol_id", "hapar_id", "land_parcel_area", "bps_eligible_area", "bps_claimed_area", "verified_exclusion",
    "land_use_area", "land_use", "year", "land_activity", "application_status", "lfass_flag",
)
_LOOSE = ("hapar_id", "land_parcel_area", "bps_eligible_area", "land_use_area", "land_use", "year")


@query("J18_strict_and_loose_match",
       f"""SELECT claim_id, min(tier) AS tier FROM (
            SELECT p.claim_id || ', ' || s.claim_id AS claim_id, 1 AS tier FROM perm p JOIN seas s USING ({", ".join(_STRICT)})
            UNION ALL SELECT p.claim_id || ', ' || s.claim_id, 2 FROM perm p JOIN seas s USING ({", ".join(_LOOSE)})
            WHERE p.land_leased_out = 'Y' AND s.land_leased_out = 'N') GROUP BY claim_id""", big="tier")
def _(t):
    flags = (F.col("owner_land_leased_out") == "Y") & (F.col("user_land_leased_out") == "N")
    tiers = [matching.Tier("strict", _STRICT), matching.Tier("loose", _LOOSE, flags)]
    kept = [*dict.fromkeys([*_STRICT, *_LOOSE]), "claim_id", "land_leased_out"]
    pairs = matching.tiered_match(t.perm.select(*kept), t.seas.select(*kept), tiers)
    return pairs.select("claim_id", F.col("tier").cast("bigint").alias("tier"))


@query("J19_unique_match",
       """SELECT p.hapar_id, p.year, p.claim_id AS owner_claim_id, s.claim_id AS user_claim_id
          FROM (SELECT *, count(*) OVER (PARTITION BY hapar_id, year) AS n FROM perm) p
          JOIN (SELECT *, count(*) OVER (PARTITION BY hapar_id, year) AS n FROM seas) s
          ON s.hapar_id = p.hapar_id AND s.year = p.year AND s.land_use = p.land_use WHERE p.n = 1 AND s.n = 1""")
def _(t):
    return joins.unique_match(t.perm, t.seas, PY, [*PY, "land_use"], "claim_id", "claim_id").select(*PY, "owner_claim_id", "user_claim_id")


@query("J20_only_in",
       """SELECT claim_id FROM perm p WHERE NOT EXISTS (SELECT 1 FROM seas s WHERE s.hapar_id = p.hapar_id AND s.year = p.year)
          UNION ALL SELECT claim_id FROM seas s WHERE NOT EXISTS (SELECT 1 FROM perm p WHERE s.hapar_id = p.hapar_id AND s.year = p.year)""")
def _(t):
    owners = joins.only_in(t.perm.select(*PY, "claim_id"), t.seas, PY)
    return owners.unionByName(joins.only_in(t.seas.select(*PY, "claim_id"), t.perm, PY)).select("claim_id")


@query("J21_rank_join", "SELECT claim_id, land_use, rank FROM perm_raw JOIN lu_rank USING (land_use)", big="rank")
def _(t):
    ranked = joins.rank_join(t.perm_raw.select("claim_id", "land_use"), t.rank)
    return ranked.withColumn("rank", F.col("rank").cast("bigint"))


_BEST_GRAZING = """SELECT cg_hahol_id, land_use, used_area FROM (
    SELECT cg_hahol_id, land_use, sum(bps_claimed_area) AS used_area FROM commons WHERE year = 2000 GROUP BY ALL) JOIN lu_rank USING (land_use)
    QUALIFY row_number() OVER (PARTITION BY cg_hahol_id ORDER BY used_area DESC NULLS LAST, rank, land_use) = 1"""


@query("J22_attach_fields",
       f"""SELECT b.cg_hahol_id, b.land_use, b.used_area, d.hapar_id, g.x1 - g.x0 AS width FROM ({_BEST_GRAZING}) b
           JOIN (SELECT cg_hahol_id, hapar_id FROM detail WHERE year = 2000) d USING (cg_hahol_id)
           JOIN (SELECT hapar_id, x0, x1 FROM grazing_shape WHERE year = 2000) g USING (hapar_id)""", double="used_area width")
def _(t):
    """Holdings, members and fields of one and the same year."""
    best = largest_use.largest_use_commons(t.commons, t.rank, 2000)
    members = t.detail.filter("year = 2000").select("cg_hahol_id", "hapar_id")
    fields = t.grazing_shape.filter("year = 2000").select("hapar_id", "ring")
    out = joins.attach_fields(best, members, fields, "cg_hahol_id", "hapar_id")
    width = F.col("ring")[1]["x"] - F.col("ring")[0]["x"]
    return out.select("cg_hahol_id", "land_use", "used_area", "hapar_id", width.alias("width"))


_OVERLAP = """SELECT o.property, p.hapar_id, round((o.x1 - o.x0) * (o.y1 - o.y0) * 0.0001, 8) AS area_a,
    round((p.x1 - p.x0) * (p.y1 - p.y0) * 0.0001, 8) AS area_b,
    round((least(o.x1, p.x1) - greatest(o.x0, p.x0)) * (least(o.y1, p.y1) - greatest(o.y0, p.y0)) * 0.0001, 8) AS area_overlap
  FROM property_shape o JOIN parcel_shape p
  ON o.x0 <= p.x1 AND p.x0 <= o.x1 AND o.y0 <= p.y1 AND p.y0 <= o.y1"""


def overlap(t, rectangles):
    out = spatial.overlap_join(t.property_shape, t.parcel_shape, "property", "hapar_id", 100.0, rectangles=rectangles)
    areas = [F.round(c, 8).alias(c) for c in ("area_a", "area_b", "area_overlap")]
    return out.select(F.col("key_a").alias("property"), F.col("key_b").alias("hapar_id"), *areas)


@query("J23_overlap_pairs", "SELECT property, hapar_id FROM property_shape o JOIN parcel_shape p "
       "ON o.x0 <= p.x1 AND p.x0 <= o.x1 AND o.y0 <= p.y1 AND p.y0 <= o.y1")
def _(t):
    return overlap(t, True).select("property", "hapar_id")


@query("J24_commons_join",
       """SELECT lpid_id || ', ' || share_id AS id, lpid_area, lpid_excluded_area, CAST(digi AS DECIMAL(18,2)) AS digi_area
          FROM share s JOIN lpid l USING (cg_hahol_id, year) JOIN (
            SELECT hahol_id, year, sum((x1 - x0) * (y1 - y0)) * 0.0001 AS digi FROM grazing_shape GROUP BY ALL) g
          ON g.hahol_id = s.cg_hahol_id AND g.year = s.year""", double="lpid_area lpid_excluded_area digi_area")
def _(t):
    areas = aggregates.holding_area(t.grazing_shape, ["hahol_id", "year"]).withColumnRenamed("hahol_id", "cg_hahol_id")
    return commons.commons_join(t.share, t.lpid, areas).select("id", "lpid_area", "lpid_excluded_area", "digi_area")


@query("J25_copy_to_commons",
       """SELECT l.claim_id AS id, d.cg_hahol_id, l.year, coalesce(l.owner_mlc_hahol_id, l.user_mlc_hahol_id) AS mlc_hahol_id,
                 CASE WHEN l.owner_mlc_hahol_id IS NOT NULL THEN l.owner_hahol_id ELSE l.user_hahol_id END AS share_hahol_id,
                 coalesce(l.owner_bps_claimed_area, l.user_bps_claimed_area) AS bps_claimed_area, c.commons_area, c.lpid_bps_eligible_area,
                 coalesce(l.user_land_use, l.owner_land_use) AS land_use
          FROM linked l JOIN (SELECT DISTINCT cg_hahol_id, hapar_id, year FROM detail) d ON d.hapar_id = l.hapar_id AND d.year = l.year
          JOIN (SELECT DISTINCT cg_hahol_id, year, commons_area, lpid_bps_eligible_area FROM commons) c
          ON c.cg_hahol_id = d.cg_hahol_id AND c.year = l.year WHERE l.error_log LIKE '%this is a commons field %'""",
       double="bps_claimed_area commons_area lpid_bps_eligible_area")
def _(t):
    copied = commons.copy_to_commons(t.commons_claims, t.detail, t.commons)
    return copied.select("id", "cg_hahol_id", "year", "mlc_hahol_id", "share_hahol_id", "bps_claimed_area", "commons_area", "lpid_bps_eligible_area", "land_use")


# ---------------------------------------------------------------------------- aggregates
@query("A1_group_sum", "SELECT cg_hahol_id, year, lpid_area, lpid_bps_eligible_area, lpid_excluded_area FROM lpid",
       double="lpid_area lpid_bps_eligible_area lpid_excluded_area")
def _(t):
    return commons.detail_totals(t.detail)


@query("A2_group_count", "SELECT hapar_id, year, count(*) AS n, count(land_use_area) AS n_known FROM perm_raw GROUP BY ALL", big="n n_known")
def _(t):
    return aggregates.group_agg(t.perm_raw, PY, {"n": n_rows(), "n_known": F.count("land_use_area")})


@query("A3_distinct_per_group", "SELECT hapar_id, year, count(DISTINCT habus_id) AS n_distinct FROM seas_raw GROUP BY ALL", big="n_distinct")
def _(t):
    return aggregates.distinct_per_group(t.seas_raw, PY, "habus_id")


@query("A4_having", "SELECT hapar_id, year, sum(land_use_area) AS used FROM perm GROUP BY ALL HAVING count(*) > 2 AND sum(land_use_area) <> 0", double="used")
def _(t):
    out = aggregates.group_agg(t.perm, PY, {"used": F.sum("land_use_area"), "n": n_rows()}, (F.col("n") > 2) & (F.col("used") != 0))
    return out.drop("n")


@query("A5_group_spread",
       """SELECT hapar_id, year, max(land_parcel_area) AS max_value, min(land_parcel_area) AS min_value,
                 max(land_parcel_area) - min(land_parcel_area) AS spread FROM perm GROUP BY hapar_id, year""", double="max_value min_value spread")
def _(t):
    return aggregates.group_spread(t.perm, PY, "land_parcel_area")


@query("A6_string_agg", "SELECT hapar_id, year, land_leased_out, count(*) AS copies FROM perm WHERE land_leased_out IS NOT NULL GROUP BY ALL", big="copies")
def _(t):
    """The parts of each group's text, with their copies."""
    return aggregates.value_copies(t.perm, PY, "land_leased_out")


def _chunks_sql(source: str, keys: str, value: str, order: str, size: int) -> str:
    return f"""SELECT {keys}, CAST(c AS BIGINT) AS chunk, array_to_string(v[c * {size} + 1 : (c + 1) * {size}], ', ') AS values
        FROM (SELECT *, unnest(range(0, CAST(ceil(len(v) / {size}.0) AS BIGINT))) AS c
              FROM (SELECT {keys}, list({value} ORDER BY {order}) AS v FROM {source} WHERE {value} IS NOT NULL GROUP BY {keys}))"""


@query("A6_text_chunks", _chunks_sql("perm", "land_use", "claim_id", "year, claim_id", 50))
def _(t):
    """The claims of each land use by year, as texts of at most 50 of them."""
    return aggregates.text_chunks(t.perm, ["land_use"], "claim_id", ["year", "claim_id"], ", ", size=50)


@query("A8_ordered_chunks", _chunks_sql("seas", "hapar_id", "land_use", "land_use", 3))
def _(t):
    """The land uses of each parcel in order with their copies, in lists of three."""
    listed = aggregates.ordered_chunks(t.seas, ["hapar_id"], "land_use", ["land_use"], size=3)
    return listed.select("hapar_id", "chunk", F.array_join("values", ", ").alias("values"))


@query("A7_array_agg_distinct",
       "SELECT DISTINCT hapar_id, hahol_id FROM perm WHERE hahol_id IS NOT NULL")
def _(t):
    return aggregates.distinct_values(t.perm, ["hapar_id"], "hahol_id")


@query("A8_array_agg_sorted", "SELECT hapar_id, land_use, count(*) AS copies FROM seas WHERE land_use IS NOT NULL GROUP BY ALL", big="copies")
def _(t):
    return aggregates.value_copies(t.seas, ["hapar_id"], "land_use")


@query("A9_sum_if", "SELECT hapar_id, sum(CASE WHEN land_leased_out = 'Y' THEN 1 END) AS n_yes FROM perm GROUP BY hapar_id", big="n_yes")
def _(t):
    return aggregates.group_agg(t.perm, ["hapar_id"], {"n_yes": aggregates.sum_if(F.col("land_leased_out") == "Y")})


@query("A10_array_concat_agg",
       """SELECT DISTINCT hapar_id, b FROM (SELECT hapar_id, owner_habus_id AS b FROM final_rows
            UNION ALL SELECT hapar_id, user_habus_id FROM final_rows) WHERE b IS NOT NULL""")
def _(t):
    both = F.array("owner_habus_id", "user_habus_id")
    return aggregates.distinct_elements(t.final.select("hapar_id", both.alias("both")), ["hapar_id"], "both", "b")


@query("A11_total", "SELECT sum(digi_area) AS total FROM digitised", double="total")
def _(t):
    return aggregates.total(t.digitised, "digi_area")


@query("A12_distinct", "SELECT DISTINCT hapar_id, year, land_use FROM perm_raw")
def _(t):
    return t.perm_raw.select(*PY, "land_use").distinct()


@query("A13_pct", "SELECT hapar_id, round(CAST(sum(land_use_area) AS DOUBLE) / nullif(CAST(sum(land_parcel_area) AS DOUBLE), 0) * 100, 9) AS percent FROM perm GROUP BY hapar_id")
def _(t):
    return aggregates.pct(t.perm, ["hapar_id"], "land_use_area", "land_parcel_area").withColumn("percent", F.round("percent", 9))


@query("A14_two_level",
       """SELECT hapar_id, count(*) AS n_business, max(used) AS top FROM (
            SELECT hapar_id, habus_id, sum(land_use_area) AS used FROM perm GROUP BY ALL) GROUP BY hapar_id""", double="top", big="n_business")
def _(t):
    business = aggregates.group_agg(t.perm, ["hapar_id", "habus_id"], {"used": F.sum("land_use_area")})
    return aggregates.group_agg(business, ["hapar_id"], {"n_business": n_rows(), "top": F.max("used")})


def consolidated(t):
    keys = ["cg_hahol_id", "mlc_hahol_id", "year", "land_use"]
    rows = t.commons_built.select(*keys, "share_area", "id", "change_note")
    return aggregates.consolidate(rows, keys, ["share_area"], "id", "change_note", "merged; ")


@query("A15_consolidate",
       """SELECT cg_hahol_id, mlc_hahol_id, year, land_use, sum(share_area) AS share_area, min(id) AS id, count(*) AS n_members,
                 CASE WHEN count(*) > 1 THEN concat(change_note, 'merged; ') ELSE change_note END AS change_note
          FROM commons_built WHERE mlc_hahol_id IS NOT NULL GROUP BY cg_hahol_id, mlc_hahol_id, year, land_use, commons_built.change_note
          UNION ALL SELECT cg_hahol_id, mlc_hahol_id, year, land_use, share_area, id, 1, change_note FROM commons_built WHERE mlc_hahol_id IS NULL""",
       double="share_area", big="n_members")
def _(t):
    return consolidated(t)[0]


@query("A15_consolidated_members",
       """SELECT first AS id, id AS member_id FROM (SELECT id, min(id) OVER w AS first, count(*) OVER w AS n
            FROM commons_built WHERE mlc_hahol_id IS NOT NULL WINDOW w AS (PARTITION BY cg_hahol_id, mlc_hahol_id, year, land_use, change_note)) WHERE n > 1""")
def _(t):
    return consolidated(t)[1]


@query("A16_bucket_count",
       """SELECT CASE WHEN o_totalprice < 100000 THEN 'low' WHEN o_totalprice < 300000 THEN 'mid' ELSE 'high' END AS bucket, count(*) AS n
          FROM orders GROUP BY 1""", big="n")
def _(t):
    price = F.col("o_totalprice")
    return aggregates.bucket_count(t.given("orders"), F.when(price < 100000, "low").when(price < 300000, "mid").otherwise("high"))


_DUP_CODES = """SELECT hapar_id, year, count(DISTINCT land_use) AS n_distinct, count(land_use) AS n_codes, sum(land_use_area) AS total
    FROM {} GROUP BY hapar_id, year HAVING count(DISTINCT land_use) <> count(land_use)"""


@query("A17_dup_codes", _DUP_CODES.format("seas"), double="total", big="n_distinct n_codes")
def _(t):
    return aggregates.dup_codes(t.seas, PY, "land_use", "land_use_area")


@query("A18_holding_area", "SELECT hahol_id, year, round(sum((x1 - x0) * (y1 - y0)) * 0.0001, 6) AS digi_area FROM grazing_shape GROUP BY ALL")
def _(t):
    return aggregates.holding_area(t.grazing_shape, ["hahol_id", "year"]).withColumn("digi_area", F.round("digi_area", 6))


@query("A19_claim_balance",
       """SELECT cg_hahol_id, year, lpid_bps_eligible_area, sum(bps_claimed_area) AS total_claim, sum(bps_claimed_area) - lpid_bps_eligible_area AS diff
          FROM commons GROUP BY cg_hahol_id, year, lpid_bps_eligible_area HAVING sum(bps_claimed_area) > lpid_bps_eligible_area""",
       double="lpid_bps_eligible_area total_claim diff")
def _(t):
    return aggregates.claim_balance(t.commons, ["cg_hahol_id", "year"], "lpid_bps_eligible_area", "bps_claimed_area")


@query("A20_any_flag",
       """SELECT hapar_id, year FROM (SELECT hapar_id, year, string_agg(land_leased_out, '') AS flags FROM seas GROUP BY ALL)
          WHERE flags LIKE '%Y%' AND hapar_id NOT IN (SELECT hapar_id FROM perm WHERE land_leased_out = 'Y')""")
def _(t):
    flagged = aggregates.any_flag(t.seas, PY, F.col("land_leased_out") == "Y")
    return joins.not_in(flagged, "hapar_id", t.perm.filter("land_leased_out = 'Y'"))


# ------------------------------------------------------------------------------- windows
@query("W1_dedupe", "SELECT claim_id FROM seas_raw QUALIFY row_number() OVER (PARTITION BY hapar_id, year, land_use, land_leased_out ORDER BY claim_id) = 1")
def _(t):
    return ranking.dedupe(t.seas_raw, [*PY, "land_use", "land_leased_out"], ["claim_id"]).select("claim_id")


@query("W2_with_totals",
       "SELECT claim_id, sum(land_use_area) OVER w AS used, land_use_area * 100 / nullif(sum(land_use_area) OVER w, 0) > 50 AS most FROM perm_raw WINDOW w AS (PARTITION BY hapar_id, year)",
       double="used")
def _(t):
    rows = t.perm_raw.select(*PY, "claim_id", "land_use_area")
    out = lookups.with_totals(rows, PY, {"used": F.sum("land_use_area")})
    return out.select("claim_id", "used", (F.try_divide(F.col("land_use_area") * 100, F.col("used")) > 50).alias("most"))


_LARGEST_LINE = """SELECT l_partkey AS hapar_id, l_returnflag AS land_use, used FROM (
    SELECT l_partkey, l_returnflag, sum(CAST(l_quantity AS DECIMAL(18,2))) AS used FROM lineitem GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY used DESC, l_returnflag) = 1"""


@query("W3_largest_by_group", _LARGEST_LINE, double="used")
def _(t):
    lines = t.given("lineitem").select(F.col("l_partkey").alias("hapar_id"), F.col("l_returnflag").alias("land_use"), F.col("l_quantity").cast("decimal(18,2)").alias("q"))
    totals = lines.groupBy("hapar_id", "land_use").agg(F.sum("q").alias("used"))
    return ranking.largest_by_group(totals, ["hapar_id"], "used", ["land_use"])


@query("W4_best_ranked_of_ties",
       """SELECT hapar_id, year, land_use, top FROM (SELECT hapar_id, year, land_use, max(land_use_area) AS top FROM perm GROUP BY ALL)
          JOIN lu_rank USING (land_use)
          QUALIFY row_number() OVER (PARTITION BY hapar_id, year ORDER BY top DESC, rank, land_use) = 1""", double="top")
def _(t):
    tops = joins.rank_join(t.perm.groupBy(*PY, "land_use").agg(F.max("land_use_area").alias("top")), t.rank)
    return ranking.best_ranked_of_ties(tops, PY, "top", "rank", ["land_use"]).select(*PY, "land_use", "top")


@query("W5_extra_parties",
       """SELECT hapar_id, year, habus_id FROM (SELECT DISTINCT hapar_id, year, habus_id FROM perm_raw)
          QUALIFY row_number() OVER (PARTITION BY hapar_id, year ORDER BY habus_id) > 1""")
def _(t):
    return ranking.extra_parties(t.perm_raw, PY, "habus_id")


@query("W6_repeats", "SELECT claim_id FROM seas_raw QUALIFY row_number() OVER (PARTITION BY hapar_id, year, land_use, land_leased_out ORDER BY claim_id) > 1")
def _(t):
    return ranking.repeats(t.seas_raw, [*PY, "land_use", "land_leased_out"], "claim_id").select("claim_id")


@query("W7_best_tier", "SELECT claim_id FROM (SELECT claim_id, tier, min(tier) OVER (PARTITION BY user_claim_id) AS best FROM pairs) WHERE tier = best")
def _(t):
    return ranking.best_tier(t.pairs.select("claim_id", "user_claim_id", "tier"), ["user_claim_id"]).select("claim_id")


# ------------------------------------------------------------------------ set operations
@query("U1_union_distinct", "SELECT hapar_id, year FROM perm_raw UNION SELECT hapar_id, year FROM seas_raw")
def _(t):
    return setops.union_distinct(t.perm_raw.select(*PY), t.seas_raw.select(*PY))


@query("U2_append_all", "SELECT hapar_id, year FROM perm_raw UNION ALL SELECT hapar_id, year FROM seas_raw")
def _(t):
    from landrecon.sources.sinks import append_rows

    return append_rows(t.perm_raw.select(*PY), t.seas_raw.select(*PY))


@query("U3_except_distinct", "SELECT hapar_id, year FROM digitised EXCEPT SELECT hapar_id, year FROM final_rows")
def _(t):
    return setops.except_distinct(t.digitised.select(*PY), t.final.select(*PY))


@query("U4_uncovered", "SELECT hapar_id, year FROM digitised EXCEPT (SELECT hapar_id, year FROM perm_raw UNION SELECT hapar_id, year FROM seas_raw)")
def _(t):
    return setops.uncovered(t.digitised.select(*PY), t.perm_raw.select(*PY), t.seas_raw.select(*PY))


@query("U5_audit_view",
       """SELECT hapar_id, year, is_perm_flag, land_use, habus_id FROM perm_raw WHERE land_parcel_area = 71
          UNION SELECT hapar_id, year, is_perm_flag, land_use, habus_id FROM seas_raw WHERE land_parcel_area = 71""")
def _(t):
    columns = [*PY, "is_perm_flag", "land_use", "habus_id"]
    owners, renters = (df.select(*columns, "land_parcel_area") for df in (t.perm_raw, t.seas_raw))
    order = [F.asc(c) for c in ("year", "is_perm_flag", "land_use", "habus_id")]
    view = setops.audit_view(owners, renters, F.col("land_parcel_area") == 71, order)
    return view.select(*columns)


# ------------------------------------------------------------------------------- spatial
def corners(shapes, keys):
    """The rows of a multi-part value corner by corner, with copies, beside count and area."""
    parts, sums = spatial.ring_parts(shapes, keys)
    listed = parts.select(*keys, F.posexplode(F.slice("ring", 1, 4)).alias("corner", "p"))
    counted = listed.select(*keys, (F.col("corner") + 1).cast("bigint").alias("corner"), "p.x", "p.y")
    return lookups.attach(counted.groupBy(*counted.columns).agg(n_rows().alias("copies")), sums, keys)


@query("G1_polygon_area", "SELECT hapar_id, round((x1 - x0) * (y1 - y0) * 0.0001, 8) AS area_ha FROM parcel_shape")
def _(t):
    return t.parcel_shape.select("hapar_id", F.round(area_hectares(F.col("ring")), 8).alias("area_ha"))


_CORNERS = "SELECT {0}, unnest([1, 2, 3, 4]) AS corner, unnest([x0, x1, x1, x0]) AS x, unnest([y0, y0, y1, y1]) AS y FROM {1}"


@query("G2_collect_rings", f"""SELECT * FROM (SELECT property, corner, x, y, count(*) AS copies FROM ({_CORNERS.format("property", "property_shape")}) GROUP BY ALL)
       JOIN (SELECT property, count(*) AS n_parts, sum((x1 - x0) * (y1 - y0)) AS area FROM property_shape GROUP BY property) USING (property)""",
       big="n_parts corner copies", double="x y area")
def _(t):
    """The corners of every part, beside the number of parts and their area."""
    return corners(t.property_shape, ["property"])


@query("G3_overlap_join", _OVERLAP)
def _(t):
    return overlap(t, True)


@query("G3_overlap_join_convex", _OVERLAP)
def _(t):
    return overlap(t, False)


@query("G4_overlap_rollup",
       f"""SELECT property, count(*) AS n_parcels, round(sum(area_overlap), 6) AS overlap, round(sum(area_overlap) / max(whole) * 100, 9) AS percent
           FROM (SELECT property, hapar_id, sum(area_overlap) AS area_overlap FROM ({_OVERLAP}) GROUP BY ALL)
           JOIN (SELECT property, sum((x1 - x0) * (y1 - y0)) * 0.0001 AS whole FROM property_shape GROUP BY property) USING (property)
           GROUP BY property""", big="n_parcels")
def _(t):
    per_parcel = overlap(t, True).groupBy("property", "hapar_id").agg(F.sum("area_overlap").alias("area_overlap"))
    whole = aggregates.holding_area(t.property_shape, ["property"], name="whole")
    sums = per_parcel.groupBy("property").agg(n_rows().alias("n_parcels"), F.sum("area_overlap").alias("o"))
    share = F.try_divide(F.col("o"), F.col("whole")) * 100
    return sums.join(whole, "property").select("property", "n_parcels", F.round("o", 6).alias("overlap"), F.round(share, 9).alias("percent"))


def _common_sql(a: str, b: str) -> str:
    """Common area of two boxes, each given by four expressions."""
    (ax0, ay0, ax1, ay1), (bx0, by0, bx1, by1) = a.split("|"), b.split("|")
    return (f"greatest(least({ax1}, {bx1}) - greatest({ax0}, {bx0}), 0) * greatest(least({ay1}, {by1}) - greatest({ay0}, {by0}), 0)")


_ESTATE, _NOTCH, _POND = "o.x0|o.y0|o.x1|o.y1", "o.x0 + 100|o.y0 + 120|o.x1|o.y1", "o.x0 + 20|o.y0 + 30|o.x0 + 60|o.y0 + 90"
_FIELD, _CORNER = "p.x0|p.y0|p.x1|p.y1", "(p.x0 + p.x1) / 2|p.y0 + 5|p.x1|p.y1"
_SHAPED_OVERLAP = " + ".join(f"{sign} * {_common_sql(a, b)}" for sign, a, b in (
    (1, _ESTATE, _FIELD), (-1, _NOTCH, _FIELD), (-1, _POND, _FIELD), (-1, _ESTATE, _CORNER), (1, _NOTCH, _CORNER), (1, _POND, _CORNER)))


@query("G3_overlap_polygons",
       f"""SELECT * FROM (SELECT o.property, p.hapar_id,
               round(((o.x1 - o.x0) * (o.y1 - o.y0) - (o.x1 - o.x0 - 100) * (o.y1 - o.y0 - 120) - 40 * 60) * 0.0001, 8) AS area_a,
               round(((p.x1 - p.x0) * (p.y1 - p.y0) - (p.x1 - p.x0) / 2 * (p.y1 - p.y0 - 5)) * 0.0001, 8) AS area_b,
               round(({_SHAPED_OVERLAP}) * 0.0001, 8) AS area_overlap
             FROM property_shape o JOIN parcel_shape p ON o.x0 <= p.x1 AND p.x0 <= o.x1 AND o.y0 <= p.y1 AND p.y0 <= o.y1)
           WHERE area_overlap > 0""")
def _(t):
    """L-shaped properties with a pond in them against L-shaped fields."""

    def corner(x, y):
        return point(F.expr(x), F.expr(y))

    def el(x, y):
        """A box without its upper right corner, from (x, y) on."""
        return F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", y), corner(x, y), corner(x, "y1"), corner("x0", "y1"))

    pond = rect_ring(*[F.expr(e) for e in ("x0 + 20", "y0 + 30", "x0 + 60", "y0 + 90")])
    estates = t._derived("supplier", derive.PROPERTY_SHAPE).select("property", F.array(el("x0 + 100", "y0 + 120"), pond).alias("rings"))
    fields = t._derived("part", derive.PARCEL_SHAPE).select("hapar_id", F.array(F.reverse(el("(x0 + x1) / 2", "y0 + 5"))).alias("rings"))
    found = spatial.polygon_overlap_join(estates, fields, "property", "hapar_id", 100.0).filter("area_overlap > 0")
    areas = [F.round(c, 8).alias(c) for c in ("area_a", "area_b", "area_overlap")]
    return found.select(F.col("key_a").alias("property"), F.col("key_b").alias("hapar_id"), *areas).filter("area_overlap > 0")


# Properties whose parts reach 120 m further and so into each other, and the cells that they cover.
WIDE_PROPERTY = {**derive.PROPERTY_SHAPE, "x1": f"{derive.PROPERTY_SHAPE['x1']} + 120"}
_LINES = "SELECT property, {0}, lead({0}) OVER (PARTITION BY property ORDER BY {0}) AS {1} FROM (SELECT property, {2}0 AS {0} FROM wide UNION SELECT property, {2}1 FROM wide)"
DISSOLVED_SQL = f"""
WITH wide AS (SELECT {derive.select_list(WIDE_PROPERTY)} FROM supplier)
SELECT DISTINCT property, l AS x0, b AS y0, r AS x1, t AS y1 FROM ({_LINES.format("l", "r", "x")}) JOIN ({_LINES.format("b", "t", "y")}) USING (property)
JOIN wide USING (property) WHERE wide.x0 <= l AND r <= wide.x1 AND wide.y0 <= b AND t <= wide.y1"""


def wide_property(t):
    return t._ringed(t._derived("supplier", WIDE_PROPERTY))


@query("G4_dissolved_rollup",
       f"""WITH cells AS ({DISSOLVED_SQL}),
           met AS (SELECT o.property, p.hapar_id, sum({_common_sql("o.x0|o.y0|o.x1|o.y1", "p.x0|p.y0|p.x1|p.y1")}) * 0.0001 AS area
                   FROM cells o JOIN parcel_shape p ON o.x0 < p.x1 AND p.x0 < o.x1 AND o.y0 < p.y1 AND p.y0 < o.y1 GROUP BY ALL)
           SELECT property, round(whole, 6) AS whole, coalesce(n_parcels, 0) AS n_parcels, round(coalesce(area, 0), 6) AS overlap
           FROM (SELECT property, sum((x1 - x0) * (y1 - y0)) * 0.0001 AS whole FROM cells GROUP BY property)
           LEFT JOIN (SELECT property, count(*) AS n_parcels, sum(area) AS area FROM met GROUP BY property) USING (property)""", big="n_parcels")
def _(t):
    """Area and overlap of what a property's parts cover together."""
    whole = stage(spatial.dissolve_rectangles(wide_property(t), ["property"], 100.0), "dissolved")
    found = spatial.overlap_join(whole, t.parcel_shape, "property", "hapar_id", 100.0, rectangles=True).filter("area_overlap > 0")
    per_parcel = found.groupBy(F.col("key_a").alias("property"), "key_b").agg(F.sum("area_overlap").alias("o"))
    sums = per_parcel.groupBy("property").agg(n_rows().alias("n_parcels"), F.sum("o").alias("o"))
    areas = aggregates.holding_area(whole, ["property"], name="whole")
    return lookups.attach(areas, sums, ["property"]).select(
        "property", F.round("whole", 6).alias("whole"), F.coalesce("n_parcels", F.lit(0)).alias("n_parcels"), F.round(F.coalesce("o", F.lit(0.0)), 6).alias("overlap"))
