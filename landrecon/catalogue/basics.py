"""Sources, column rewrites, notes, filters and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from landrecon.catalogue.derive import DECLARATION, YEAR_OUT, activity_sql, larger_sql, status_sql
from landrecon.catalogue.registry import query
from landrecon.functions import arrays, choice, numbers, text
from landrecon.operators import filters, joins, notes, rewrite
from landrecon.operators.ranking import top_k
from landrecon.plans.commons import ELIGIBLE_CLAMPED, ELIGIBLE_RECOMPUTED
from landrecon.session import new_path, stage
from landrecon.sources import ids, sinks, tables, versions
from landrecon.sources.reference_lists import land_use_rank


def n_rows():
    return F.count(F.lit(1))


# ------------------------------------------------------------------------------- sources
@query("S1_load", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def _(t):
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string"
    return tables.load(t.spark, t.path("orders"), t.spark.sql("SELECT 1").schema.fromDDL(schema))


@query("S2_excluded_land_uses",
       "SELECT land_use, descript, count(*) AS n FROM perm_raw JOIN excl USING (land_use) GROUP BY ALL", big="n")
def _(t):
    return t.perm_raw.join(F.broadcast(t.excl), "land_use").groupBy("land_use", "descript").agg(n_rows().alias("n"))


@query("S3_land_use_rank",
       """SELECT year, count(*) AS n, sum(rank) AS ranks, count(CASE WHEN land_use <> 'NON_SAF' THEN 1 END) AS n_first
          FROM (SELECT land_use, year FROM perm_raw UNION ALL SELECT user_land_use, year FROM final_rows) JOIN lu_rank USING (land_use)
          GROUP BY year""", big="n ranks n_first")
def _(t):
    codes = t.perm_raw.select("land_use", "year").unionByName(
        t.final.select(F.col("user_land_use").alias("land_use"), "year"))
    first = land_use_rank(t.spark, 1).select("land_use", F.lit(1).alias("in_first"))
    ranked = codes.join(F.broadcast(t.rank), "land_use").join(F.broadcast(first), "land_use", "left")
    return ranked.groupBy("year").agg(n_rows().alias("n"), F.sum("rank").alias("ranks"), F.count("in_first").alias("n_first"))


@query("S4_union_years", "SELECT claim_id, land_use, year FROM perm_raw")
def _(t):
    """Yearly folders read in one scan, the year from the folder's name."""
    path = new_path(t.spark, "deliveries")
    t.perm_raw.select("claim_id", "land_use", "year").write.partitionBy("year").parquet(path)
    return tables.yearly(t.spark, path, "claim_id string, land_use string")


@query("S5_stage", "SELECT hapar_id, year, count(*) AS n FROM seas_raw GROUP BY ALL", big="n")
def _(t):
    return stage(t.seas_raw.select("hapar_id", "year")).groupBy("hapar_id", "year").agg(n_rows().alias("n"))


@query("S6_publish", "SELECT claim_id, land_use_area, year FROM perm", double="land_use_area")
def _(t):
    """A table that was published before, with other rows."""
    path = new_path(t.spark, "published")
    sinks.publish(t.perm_parcel.select("claim_id", "land_use_area", "year"), path)
    return sinks.publish(t.perm.select("claim_id", "land_use_area", "year"), path)


@query("S6_versions", """SELECT 1 AS version, claim_id FROM perm_clean UNION ALL SELECT 2, claim_id FROM perm_clean WHERE land_use = 'PGRS'""")
def _(t):
    """Both versions of a table whose second is made from its first."""
    path = new_path(t.spark, "published")
    first = sinks.publish(t.perm_clean.select("claim_id", "land_use"), path)
    sinks.publish(first.filter("land_use = 'PGRS'"), path)
    both = [versions.read(t.spark, path, n).select(F.lit(n).alias("version"), "claim_id") for n in (1, 2)]
    return both[0].unionByName(both[1])


@query("S7_append_rows",
       "SELECT claim_id, land_use, NULL AS habus_id FROM perm UNION ALL SELECT claim_id, land_use, habus_id FROM seas")
def _(t):
    base = t.perm.select("claim_id", "land_use")
    return sinks.append_rows(base, t.seas.select("claim_id", "land_use", "habus_id"))


@query("S7_append_table",
       "SELECT claim_id, land_use, NULL AS habus_id FROM perm UNION ALL SELECT claim_id, land_use, habus_id FROM seas")
def _(t):
    """The second batch is retried, and brings a column that the table lacked."""
    path = new_path(t.spark, "appended")
    sinks.append_table(t.perm.select("claim_id", "land_use"), path, "owners")
    for _ in range(2):
        sinks.append_table(t.seas.select("claim_id", "land_use", "habus_id"), path, "renters")
    return versions.read(t.spark, path)


@query("S8_export_keys", "SELECT DISTINCT hapar_id FROM perm_raw WHERE year = 2000")
def _(t):
    return sinks.export_keys(t.perm_raw, "hapar_id", 2000)


@query("S9_surrogate_ids",
       """SELECT claim_id, dense_rank() OVER (ORDER BY habus_id) AS habus_id,
                 CASE WHEN hahol_id IS NOT NULL THEN dense_rank() OVER (ORDER BY hahol_id NULLS LAST) END AS hahol_id
          FROM perm_raw""", big="habus_id hahol_id")
def _(t):
    return ids.surrogate_ids(t.perm_raw.select("claim_id", "habus_id", "hahol_id"), ["habus_id", "hahol_id"])[0]


def _delivered_sql(column: str) -> str:
    """Ids of two deliveries: the first one's values in order, then the second's new ones in order."""
    return f"""SELECT v, row_number() OVER (ORDER BY later, v) AS id FROM (
        SELECT {column} AS v, min(CAST(year > 1996 AS INT)) AS later FROM perm_raw WHERE {column} IS NOT NULL GROUP BY {column})"""


@query("S9_stable_ids",
       f"""SELECT claim_id, year, h.id AS habus_id, p.id AS hapar_id FROM perm_raw
           LEFT JOIN ({_delivered_sql("habus_id")}) h ON h.v = habus_id LEFT JOIN ({_delivered_sql("hapar_id")}) p ON p.v = hapar_id""",
       big="habus_id hapar_id")
def _(t):
    """Two deliveries against stored link tables; the second leaves the first one's ids as they are."""
    folder, columns = new_path(t.spark, "links"), ["habus_id", "hapar_id"]
    rows = t.perm_raw.select("claim_id", "year", *columns)
    first, second = rows.filter("year <= 1996"), rows.filter("year > 1996")
    early = ids.delivered_ids(first, columns, folder, "first")
    late = ids.delivered_ids(second, columns, folder, "second")
    return early.unionByName(late)


# ------------------------------------------------------------------------------ rewrites
@query("P1_prefix_side",
       "SELECT claim_id, land_parcel_area AS owner_land_parcel_area, land_use AS owner_land_use, year FROM perm",
       double="owner_land_parcel_area")
def _(t):
    df = t.perm.select("claim_id", "land_parcel_area", "land_use", "year")
    return rewrite.prefix_side(df, ["land_parcel_area", "land_use"], "owner")


@query("P2_one_sided",
       """SELECT claim_id, land_use_area AS user_land_use_area, habus_id AS user_habus_id,
                 CAST(NULL AS DOUBLE) AS owner_land_use_area, CAST(NULL AS BIGINT) AS owner_habus_id FROM seas""",
       double="user_land_use_area")
def _(t):
    return rewrite.one_sided(t.seas.select("claim_id", "land_use_area", "habus_id"), ["land_use_area", "habus_id"], "user")


@query("P3_add_drop_columns", "SELECT claim_id, CAST(NULL AS VARCHAR) AS error_log FROM perm_raw")
def _(t):
    slim = t.perm_raw.drop(*[c for c in DECLARATION if c != "claim_id"])
    return rewrite.add_null_col(slim, "error_log")


@query("P4_coalesce_sides",
       "SELECT claim_id, land_use_area AS area FROM perm UNION ALL SELECT claim_id, land_use_area FROM seas", double="area")
def _(t):
    return t.sides.select("claim_id", choice.coalesce_sides(F.col("owner_land_use_area"), F.col("user_land_use_area")).alias("area"))


@query("P5_larger_side",
       f"""SELECT claim_id, {larger_sql("o", "u")} AS area
          FROM (SELECT claim_id, owner_bps_claimed_area AS o, nullif(user_bps_claimed_area, 30) AS u FROM pairs)""",
       double="area")
def _(t):
    user = F.nullif(F.col("user_bps_claimed_area"), F.lit(30))
    return t.pairs.select("claim_id", numbers.larger_side(F.col("owner_bps_claimed_area"), user).alias("area"))


@query("P6_choose_activity",
       f"SELECT claim_id, {activity_sql('owner_land_activity', 'user_land_activity')} AS activity FROM pairs")
def _(t):
    sides = F.col("owner_land_activity"), F.col("user_land_activity")
    return t.pairs.select("claim_id", choice.choose_activity(*sides).alias("activity"))


@query("P7_choose_status",
       f"SELECT claim_id, {status_sql('owner_application_status', 'user_application_status')} AS status FROM pairs")
def _(t):
    sides = F.col("owner_application_status"), F.col("user_application_status")
    return t.pairs.select("claim_id", choice.choose_status(*sides).alias("status"))


@query("P8_effective_use",
       """SELECT claim_id, CASE WHEN user_land_use IS NULL OR user_land_use = 'NON_SAF' THEN owner_land_use ELSE user_land_use END AS land_use
          FROM final_rows""")
def _(t):
    return t.final.select("claim_id", choice.effective_use(F.col("owner_land_use"), F.col("user_land_use")).alias("land_use"))


@query("P9_zero_if_null",
       "SELECT claim_id, coalesce(land_use_area, 0) AS land_use_area, coalesce(bps_claimed_area, 0) AS bps_claimed_area FROM perm_raw",
       double="land_use_area bps_claimed_area")
def _(t):
    return rewrite.zero_if_null_cols(t.perm_raw.select("claim_id", "land_use_area", "bps_claimed_area"), ["land_use_area", "bps_claimed_area"])


@query("P10_used_area",
       "SELECT claim_id, CASE WHEN bps_claimed_area <> 0 THEN bps_claimed_area ELSE land_use_area END AS used FROM seas", double="used")
def _(t):
    return t.seas.select("claim_id", numbers.used_area(F.col("bps_claimed_area"), F.col("land_use_area")).alias("used"))


@query("P11_abs_cols", "SELECT claim_id, abs(bps_eligible_area) AS bps_eligible_area, abs(land_use_area) AS land_use_area FROM perm_raw",
       double="bps_eligible_area land_use_area")
def _(t):
    return rewrite.abs_cols(t.perm_raw.select("claim_id", "bps_eligible_area", "land_use_area"), ["bps_eligible_area", "land_use_area"])


@query("P12_prefix_id",
       """SELECT 'S' || n AS id, cg_hahol_id, year, name FROM (
            SELECT cg_hahol_id, year, name, row_number() OVER (ORDER BY cg_hahol_id, year, name) AS n FROM share)""")
def _(t):
    keys = ["cg_hahol_id", "year", "name"]
    numbered = ids.number_rows(t.share.select(*keys), keys)
    return numbered.select(ids.prefix_id(F.col("id"), "S").alias("id"), *keys)


@query("P13_pair_id", "SELECT owner_claim_id || ', ' || user_claim_id AS id FROM pairs")
def _(t):
    return t.pairs.select(text.pair_id(F.col("owner_claim_id"), F.col("user_claim_id")).alias("id"))


_SWAPPED = "user_bps_claimed_area = 0 AND owner_bps_claimed_area <> 0"


@query("P14_swap_sides",
       f"""SELECT claim_id, CASE WHEN {_SWAPPED} THEN user_land_use ELSE owner_land_use END AS owner_land_use,
                  CASE WHEN {_SWAPPED} THEN owner_land_use ELSE user_land_use END AS user_land_use,
                  CASE WHEN {_SWAPPED} THEN user_bps_claimed_area ELSE owner_bps_claimed_area END AS owner_bps_claimed_area,
                  CASE WHEN {_SWAPPED} THEN owner_bps_claimed_area ELSE user_bps_claimed_area END AS user_bps_claimed_area FROM pairs""",
       double="owner_bps_claimed_area user_bps_claimed_area")
def _(t):
    columns = ["land_use", "bps_claimed_area"]
    df = t.pairs.select("claim_id", *[f"{s}_{c}" for c in columns for s in ("owner", "user")])
    return rewrite.swap_sides(df, columns, F.expr(_SWAPPED))


@query("P15_promote_side",
       """SELECT claim_id, land_use AS owner_land_use, NULL AS user_land_use FROM perm
          UNION ALL SELECT claim_id, CASE WHEN hit THEN land_use END, CASE WHEN NOT hit THEN land_use END FROM (
            SELECT *, coalesce(land_leased_out = 'Y' AND bps_claimed_area = 0, false) AS hit FROM seas)""")
def _(t):
    cond = (F.col("user_land_leased_out") == "Y") & F.col("user_land_use").isNotNull() & (F.col("user_bps_claimed_area") == 0)
    return rewrite.promote_side(t.sides, ["land_use"], cond).select("claim_id", "owner_land_use", "user_land_use")


@query("P16_normalise_code",
       """SELECT claim_id, CASE WHEN land_use = '' THEN 'RGR' WHEN left(land_use, 4) = 'TGRS' THEN 'TGRS' ELSE land_use END AS land_use,
                 CASE WHEN land_use = '' THEN 'changed blank land_use to RGR; ' ELSE '' END AS note FROM perm_raw""")
def _(t):
    df = t.perm_raw.select("claim_id", "land_use", F.lit("").alias("note"))
    filled = rewrite.normalise_code(df, "land_use", F.col("land_use") == "", choice.ROUGH_GRAZING, "note")
    return filled.withColumn("land_use", choice.collapse_prefix(F.col("land_use")))


@query("P17_fill_from",
       """SELECT claim_id, CASE WHEN hit THEN bps_claimed_area ELSE land_use_area END AS land_use_area,
                 CASE WHEN hit THEN 'land_use_area inferred from bps_claimed_area; ' END AS note
          FROM (SELECT *, coalesce(land_use_area, 0) = 0 AND coalesce(bps_claimed_area, 0) <> 0 AS hit FROM perm_raw)""",
       double="land_use_area")
def _(t):
    df = t.perm_raw.select("claim_id", "land_use_area", "bps_claimed_area", F.lit(None).cast("string").alias("note"))
    area = F.col("land_use_area")
    cond = (area.isNull() | (area == 0)) & (F.col("bps_claimed_area") != 0)
    out = rewrite.fill_from(df, "land_use_area", "bps_claimed_area", cond, "note", "land_use_area inferred from bps_claimed_area; ")
    return out.drop("bps_claimed_area")


@query("P18_clamp_to",
       """SELECT id, CASE WHEN e > c THEN c ELSE e END AS e, CASE WHEN e > c THEN concat(n, 'changed lpid_bps_eligible_area to match commons where eligible area larger by ',
                  CAST(CAST(abs(c - e) AS DECIMAL(18,2)) AS VARCHAR), 'ha ; ') ELSE n END AS n
           FROM (SELECT id, lpid_bps_eligible_area AS e, commons_area - 5 AS c, change_note AS n FROM commons_built)""", double="e")
def _(t):
    df = t.commons_built.select("id", F.col("lpid_bps_eligible_area").alias("e"), (F.col("commons_area") - 5).alias("c"), F.col("change_note").alias("n"))
    return rewrite.clamp_to(df, "e", "c", "n", notes.amount_note(ELIGIBLE_CLAMPED, F.col("c") - F.col("e"), "ha ; ")).drop("c")


@query("P19_align_to",
       """SELECT claim_id, CASE WHEN hit THEN verified_exclusion ELSE land_use_area END AS land_use_area, CASE WHEN hit THEN 'aligned; ' END AS note
          FROM (SELECT *, coalesce(verified_exclusion <> land_use_area AND land_use = 'EXCL', false) AS hit FROM perm_raw)""",
       double="land_use_area")
def _(t):
    df = t.perm_raw.select("claim_id", "land_use_area", "verified_exclusion", "land_use", F.lit(None).cast("string").alias("note"))
    out = rewrite.align_to(df, "land_use_area", "verified_exclusion", F.col("land_use") == "EXCL", "note", "aligned; ")
    return out.select("claim_id", "land_use_area", "note")


@query("P20_recompute",
       """SELECT id, c - x AS e, CASE WHEN c - x <> e THEN concat(n, 'set lpid_bps_eligible_area = commons_area - lpid_excluded_area, change of ',
                  CAST(CAST(abs(e - (c - x)) AS DECIMAL(18,2)) AS VARCHAR), 'ha; ') ELSE n END AS n
           FROM (SELECT id, lpid_bps_eligible_area AS e, commons_area AS c, lpid_excluded_area AS x, change_note AS n FROM commons_built)""",
       double="e")
def _(t):
    df = t.commons_built.select("id", F.col("lpid_bps_eligible_area").alias("e"), "commons_area", "lpid_excluded_area", F.col("change_note").alias("n"))
    rest = F.col("commons_area") - F.col("lpid_excluded_area")
    return rewrite.recompute(df, "e", rest, "n", ELIGIBLE_RECOMPUTED, "ha; ").select("id", "e", "n")


@query("P21_fill_const", "SELECT claim_id, coalesce(land_use_area, 0) AS land_use_area FROM seas_raw", double="land_use_area")
def _(t):
    return rewrite.fill_const(t.seas_raw.select("claim_id", "land_use_area"), "land_use_area", 0)


@query("P22_clear_flag", "SELECT id, CASE WHEN cg_hahol_id IN (17, 23, 42) THEN NULL ELSE error_log END AS error_log FROM commons")
def _(t):
    return rewrite.clear_flag(t.commons, "error_log", "cg_hahol_id", [17, 23, 42]).select("id", "error_log")


# --------------------------------------------------------------------------------- notes
@query("N1_append_note",
       "SELECT claim_id, CASE WHEN bps_claimed_area > 30 THEN concat(change_note, 'large claim; ') ELSE change_note END AS change_note FROM perm")
def _(t):
    return notes.append_note(t.perm, "change_note", F.col("bps_claimed_area") > 30, "large claim; ").select("claim_id", "change_note")


@query("N2_amount_note",
       """SELECT claim_id, CASE WHEN land_use_area <> land_parcel_area THEN concat(change_note, 'off by ',
                 CAST(CAST(abs(land_use_area - land_parcel_area) AS DECIMAL(18,2)) AS VARCHAR), 'ha; ') ELSE change_note END AS change_note FROM seas""")
def _(t):
    gap = F.col("land_use_area") - F.col("land_parcel_area")
    return notes.append_note(t.seas, "change_note", gap != 0, notes.amount_note("off by ", gap, "ha; ")).select("claim_id", "change_note")


@query("N3_merge_notes", "SELECT claim_id, change_note FROM pairs")
def _(t):
    owner = t.perm.select(F.col("claim_id").alias("owner_claim_id"), F.col("change_note").alias("p"))
    user = t.seas.select(F.col("claim_id").alias("user_claim_id"), F.col("change_note").alias("s"))
    joined = t.pairs.select("claim_id", "owner_claim_id", "user_claim_id", "tier_label").join(owner, "owner_claim_id").join(user, "user_claim_id")
    return joined.select("claim_id", notes.merge_notes(F.col("tier_label"), F.col("p"), F.col("s")).alias("change_note"))


@query("N4_has_note", "SELECT claim_id FROM final_rows WHERE change_note LIKE '%fourth join%'")
def _(t):
    return t.final.filter(notes.has_note("change_note", "%fourth join%")).select("claim_id")


@query("N5_note_digits_exceed",
       """SELECT id FROM commons WHERE change_note LIKE '%;%;%' AND left(regexp_replace(change_note, '[^0-9]', '', 'g'), 1) <> '0'
          AND length(regexp_replace(change_note, '[^0-9]', '', 'g')) > 7""")
def _(t):
    return t.commons.filter(notes.note_digits_exceed("change_note")).select("id")


@query("N6_note_frequency",
       """SELECT change_note, n, round(n * 100.0 / (SELECT count(*) FROM final_rows), 1) AS percent
          FROM (SELECT change_note, count(*) AS n FROM final_rows GROUP BY change_note)
          ORDER BY n DESC, change_note NULLS FIRST LIMIT 10""", double="percent", big="n")
def _(t):
    return notes.note_frequency(t.final, "change_note", 10)


# ------------------------------------------------------------------------------- filters
@query("F1_quality_filter",
       f"""SELECT claim_id FROM perm_raw WHERE hapar_id IS NOT NULL AND land_use <> '' AND year <> {YEAR_OUT}
           AND application_status NOT LIKE '%Wait%'""")
def _(t):
    return filters.quality_filter(t.perm_raw, YEAR_OUT).select("claim_id")


@query("F2_delete_where",
       """SELECT claim_id FROM seas_raw EXCEPT ALL SELECT claim_id FROM seas_raw
          WHERE (land_use = 'EXCL' OR land_use = 'DELETED_LANDUSE') AND (land_use_area = 0 OR land_use_area IS NULL)""")
def _(t):
    return filters.delete_where(t.seas_raw, filters.zero_exclusion()).select("claim_id")


@query("F3_in_list", "SELECT claim_id, land_use FROM perm_raw WHERE land_use IN (SELECT land_use FROM excl)")
def _(t):
    return filters.in_list(t.perm_raw, "land_use", t.excl).select("claim_id", "land_use")


@query("F3_off_list", "SELECT claim_id, land_use FROM perm_raw WHERE land_use NOT IN (SELECT land_use FROM excl)")
def _(t):
    from landrecon.plans.reconcile import EXCLUDED

    return filters.off_list(t.perm_raw, "land_use", EXCLUDED).select("claim_id", "land_use")


@query("F4_like", "SELECT claim_id FROM seas_raw WHERE application_status LIKE '%Action%' AND application_status NOT LIKE '%Action'")
def _(t):
    status = F.col("application_status")
    return t.seas_raw.filter(text.has_text(status, "%Action%") & ~text.has_text(status, "%Action")).select("claim_id")


@query("F5_column_comparison",
       "SELECT claim_id FROM pairs WHERE owner_habus_id <> user_habus_id AND owner_bps_claimed_area > user_land_parcel_area")
def _(t):
    return t.pairs.filter((F.col("owner_habus_id") != F.col("user_habus_id")) & (F.col("owner_bps_claimed_area") > F.col("user_land_parcel_area"))).select("claim_id")


@query("F6_area_mismatch",
       """SELECT d.hapar_id, d.year, p.claim_id FROM digitised d JOIN perm p ON p.hapar_id = d.hapar_id AND p.year = d.year
          WHERE round(digi_area, 2) <> land_parcel_area""")
def _(t):
    joined = joins.detail_join(t.perm.select("hapar_id", "year", "claim_id", "land_parcel_area"), t.digitised, ["hapar_id", "year"])
    return filters.area_mismatch(joined, "digi_area", "land_parcel_area").select("hapar_id", "year", "claim_id")


@query("F7_ratio_filter",
       """SELECT claim_id FROM (SELECT *, sum(land_use_area) OVER (PARTITION BY hapar_id, land_parcel_area, year) AS used FROM perm)
          WHERE land_parcel_area <> 0 AND used * 100 / land_parcel_area = 100""")
def _(t):
    return filters.ratio_filter(t.perm, ["hapar_id", "land_parcel_area", "year"], "land_use_area", "land_parcel_area", 100).select("claim_id")


# ------------------------------------------------------------------------------- scalars
@query("C1_pg_concat", "SELECT claim_id, concat(application_status, '/', land_activity) AS v FROM perm_raw")
def _(t):
    return t.perm_raw.select("claim_id", text.pg_concat(F.col("application_status"), F.lit("/"), F.col("land_activity")).alias("v"))


@query("C2_pipe_concat", "SELECT claim_id, application_status || '/' || land_activity AS v FROM perm_raw")
def _(t):
    return t.perm_raw.select("claim_id", text.pipe_concat(F.col("application_status"), F.lit("/"), F.col("land_activity")).alias("v"))


@query("C3_split_part", "SELECT split_part(claim_id, ', ', 1) AS a, split_part(claim_id, ', ', 2) AS b FROM final_rows")
def _(t):
    claim = F.col("claim_id")
    return t.final.select(text.split_part(claim, ", ", 1).alias("a"), text.split_part(claim, ", ", 2).alias("b"))


@query("C4_substring_length", "SELECT claim_id, substring(land_use, 1, 4) AS a, left(land_activity, 2) AS b, length(land_activity) AS n FROM perm_raw", big="n")
def _(t):
    activity = F.col("land_activity")
    return t.perm_raw.select("claim_id", text.first_chars(F.col("land_use"), 4).alias("a"), text.first_chars(activity, 2).alias("b"), F.length(activity).cast("bigint").alias("n"))


@query("C5_trim_chars", "SELECT trim(claim_id, 'S') AS a, rtrim(claim_id, '05') AS b, ltrim(claim_id, 'S1') AS c FROM seas")
def _(t):
    claim = F.col("claim_id")
    return t.seas.select(text.trim_chars(claim, "S").alias("a"), text.trim_chars(claim, "05", "trailing").alias("b"), text.trim_chars(claim, "S1", "leading").alias("c"))


@query("C6_strip_non_digits", "SELECT id, regexp_replace(change_note, '[^0-9]', '', 'g') AS v FROM commons_built")
def _(t):
    return t.commons_built.select("id", text.strip_non_digits(F.col("change_note")).alias("v"))


@query("C7_arithmetic",
       "SELECT hapar_id, year, abs(40 - digi_area) AS a, round(digi_area, 2) AS b, digi_area * 2 - 1 AS c FROM digitised", double="a b c")
def _(t):
    digi = F.col("digi_area")
    return t.digitised.select("hapar_id", "year", F.abs(40 - digi).alias("a"), numbers.round2(digi).alias("b"), (digi * 2 - 1).alias("c"))


@query("C8_cast",
       "SELECT claim_id, CAST(land_use_area AS VARCHAR) AS a, CAST(land_use_area AS DOUBLE) AS b, CAST(NULL AS BIGINT) AS c FROM perm")
def _(t):
    area = F.col("land_use_area")
    return t.perm.select("claim_id", text.to_text(area).alias("a"), area.cast("double").alias("b"), text.typed_null("bigint").alias("c"))


@query("C9_case", "SELECT claim_id, CASE land_leased_out WHEN 'Y' THEN 1 WHEN 'N' THEN 0 END AS flag FROM perm_raw", big="flag")
def _(t):
    out = F.col("land_leased_out")
    return t.perm_raw.select("claim_id", F.when(out == "Y", F.lit(1)).when(out == "N", F.lit(0)).cast("bigint").alias("flag"))


_TWO = "o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS a, CASE WHEN o_orderstatus = 'O' THEN o_orderkey END AS b"


def _two(t):
    """Arrays with NULL elements, empty arrays and missing arrays."""
    rows = t.given("orders").selectExpr(*_TWO.split(", ", 1)[:1], *_TWO.split(", ", 1)[1].split(", "))
    return rows.select("o_orderkey", F.array("a", "b").alias("ab"), F.when(F.col("b").isNotNull(), F.array("b", "a")).alias("ba"))


@query("C10_array_compact",
       f"SELECT o_orderkey, array_to_string(list_filter([a, b], lambda x: x IS NOT NULL), ',') AS v FROM (SELECT {_TWO} FROM orders)")
def _(t):
    return _two(t).select("o_orderkey", arrays.array_compact(F.col("ab")).alias("v"))


@query("C11_null_if_empty",
       f"SELECT o_orderkey, CASE WHEN a IS NULL AND b IS NULL THEN 1 ELSE 0 END AS missing FROM (SELECT {_TWO} FROM orders)")
def _(t):
    kept = arrays.null_if_empty(arrays.array_compact(F.col("ab")))
    return _two(t).select("o_orderkey", F.when(kept.isNull(), 1).otherwise(0).alias("missing"))


@query("C12_array_cat",
       f"""SELECT o_orderkey, CASE WHEN b IS NULL THEN coalesce(CAST(a AS VARCHAR), '') ELSE a || ',' || b || ',' || b || ',' || a END AS v
           FROM (SELECT {_TWO} FROM orders)""")
def _(t):
    return _two(t).select("o_orderkey", arrays.array_compact(arrays.array_cat(F.col("ab"), F.col("ba"))).alias("v"))


@query("C13_array_len",
       f"""SELECT o_orderkey, nullif((CASE WHEN a IS NULL THEN 0 ELSE 1 END) + (CASE WHEN b IS NULL THEN 0 ELSE 1 END), 0) AS n
           FROM (SELECT {_TWO} FROM orders)""", big="n")
def _(t):
    return _two(t).select("o_orderkey", arrays.array_len(arrays.array_compact(F.col("ab"))).cast("bigint").alias("n"))


@query("C14_has_element", f"SELECT o_orderkey FROM (SELECT {_TWO} FROM orders) WHERE a = 42 OR b = 42")
def _(t):
    return _two(t).filter(arrays.has_element(F.col("ab"), 42)).select("o_orderkey")


# ---------------------------------------------------------------------------------- sort
@query("O1_order_by", "SELECT claim_id, application_status, land_use_area FROM perm_raw ORDER BY application_status, land_use_area DESC NULLS FIRST, claim_id",
       double="land_use_area")
def _(t):
    from landrecon.operators.ranking import sort_spec

    order = sort_spec({"application_status": "asc", "land_use_area": "desc", "claim_id": "asc"})
    return t.perm_raw.select("claim_id", "application_status", "land_use_area").orderBy(*order)


@query("O2_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def _(t):
    return top_k(t.given("orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 10)
