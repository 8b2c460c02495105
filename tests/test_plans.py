"""Domain steps on hand-made rows, one rule per test."""

from __future__ import annotations

import pytest
from builders import prepared, raw
from pyspark.sql import functions as F

from landrecon.plans import clean, commons, flags, impute, largest_use, metrics, ownership, reconcile
from landrecon.sources.reference_lists import land_use_rank


# ------------------------------------------------------------------------ clean and repair
def test_clean_drops_copies_and_implausible_rows(spark, rows):
    df = raw(
        spark, {}, {"payment_region": 2}, {"land_leased_out": "Y"}, {"hapar_id": None}, {"land_use": ""},
        {"year": 2019}, {"application_status": "Wait for x"}, {"application_status": None},
        {"land_use": "EXCL", "land_use_area": 0}, {"land_use": "EXCL", "land_use_area": None},
        {"land_use": "EXCL", "land_use_area": 1}, {"bps_eligible_area": -4, "hapar_id": 7},
    )
    owners = clean.clean_declarations(df, clean.OWNER_IDENTITY, "P")
    assert rows(owners, "claim_id") == [("P1",), ("P11",), ("P12",)]
    assert ("P12", 4.0) in rows(owners, "claim_id", "bps_eligible_area")
    renters = clean.clean_declarations(df, clean.RENTER_IDENTITY, "S")
    assert rows(renters, "claim_id") == [("S1",), ("S11",), ("S12",), ("S3",)]


def test_parcel_area_from_peer_then_own_use_then_delete(spark, rows):
    df = prepared(
        spark, "P", {"hapar_id": 1, "land_parcel_area": None}, {"hapar_id": 1, "year": 2016, "land_parcel_area": 6},
        {"hapar_id": 1, "year": 2018, "land_parcel_area": 8}, {"hapar_id": 2, "land_parcel_area": None, "land_use_area": 3},
        {"hapar_id": 3, "land_parcel_area": None, "land_use_area": 0}, {"hapar_id": 4, "land_parcel_area": 0, "land_use_area": 0},
        {"hapar_id": 5, "land_parcel_area": None, "land_use_area": None},
    )
    out = rows(clean.repair_parcel_area(df), "claim_id", "land_parcel_area", "change_note")
    assert out == [
        ("P1", 8.0, clean.PARCEL_FROM_PEER), ("P2", 6.0, None), ("P3", 8.0, None),
        ("P4", 3.0, clean.PARCEL_FROM_USE), ("P7", None, clean.PARCEL_FROM_USE),
    ]


def test_use_area_repairs(spark, rows):
    df = prepared(
        spark, "P",
        {"hapar_id": 1, "land_use_area": 0},  # a single claim that uses the eligible parcel
        {"hapar_id": 2, "land_use_area": None, "bps_eligible_area": 5},  # other year has 4
        {"hapar_id": 2, "land_use_area": 4, "year": 2016, "bps_eligible_area": 5},
        {"hapar_id": 3, "land_use_area": None, "bps_eligible_area": 5},  # nothing known
        {"hapar_id": 4, "bps_claimed_area": 12},  # clamped to the parcel, then equal to the use
        {"hapar_id": 5, "bps_claimed_area": 7},  # use follows the claim
    )
    out = rows(clean.repair_use_area(df, "owner"), "claim_id", "land_use_area", "bps_claimed_area", "change_note")
    assert out == [
        ("P1", 10.0, 0.0, clean.USE_FROM_PARCEL), ("P2", 4.0, 0.0, clean.USE_FROM_OTHER_YEAR), ("P3", 4.0, 0.0, None),
        ("P5", 10.0, 10.0, clean.CLAIM_CLAMPED), ("P6", 7.0, 7.0, clean.USE_ALIGNED.format(side="owner")),
    ]


# --------------------------------------------------------------------------- match, merge
def test_match_guard_fanout_pruning_and_pools(spark, rows):
    owners = prepared(
        spark, "P", {"hapar_id": 1, "land_leased_out": "Y"}, {"hapar_id": 2, "bps_claimed_area": 5},
        {"hapar_id": 3, "land_use": "RGR"}, {"hapar_id": 4, "land_use": "RGR"}, {"hapar_id": 5},
    )
    renters = prepared(
        spark, "S", {"hapar_id": 1}, {"hapar_id": 2}, {"hapar_id": 3, "land_use_area": 1}, {"hapar_id": 3, "land_use_area": 2},
        {"hapar_id": 3, "land_use": "RGR", "land_use_area": 3}, {"hapar_id": 4, "land_use": "BRA", "land_use_area": 3},
        {"hapar_id": 6},
    )
    pairs, left, right = reconcile.match_owners_renters(owners, renters)
    assert rows(pairs, "claim_id", "tier", "change_note") == [
        ("P1, S1", 1, "first join; "), ("P2, S2", 2, "second join; "), ("P3, S3", 4, "fourth join; "),
        ("P3, S4", 4, "fourth join; "), ("P3, S5", 2, "second join; "),
    ]
    assert rows(left, "claim_id") == [("P4",), ("P5",)]  # the pruned pair went back to the pools
    assert rows(right, "claim_id") == [("S6",), ("S7",)]
    merged = reconcile.one_sided_rows(left, right).unionByName(reconcile.merge_pairs(pairs))
    claims = {c for (text,) in rows(merged, "claim_id") for c in text.split(", ")}
    assert claims == {f"P{i}" for i in range(1, 6)} | {f"S{i}" for i in range(1, 8)}


def test_merge_notes_every_choice(spark, rows):
    owners = prepared(spark, "P", {"land_parcel_area": 11, "verified_exclusion": 0, "land_activity": "No Activity",
                                   "application_status": "Ready", "land_leased_out": "Y", "change_note": "p; "})
    renters = prepared(spark, "S", {"bps_eligible_area": 12, "verified_exclusion": 3, "land_activity": "Production",
                                    "application_status": "Under Action/Assessment", "change_note": "s; "})
    merged = reconcile.merge_pairs(reconcile.match_owners_renters(owners, renters)[0])
    row = merged.first()
    assert (float(row.land_parcel_area), float(row.bps_eligible_area), float(row.verified_exclusion)) == (11, 12, 3)
    assert (row.land_activity, row.application_status) == ("Production", "Under Action/Assessment")
    assert row.change_note == (
        "first join; p; s; assume land_parcel_area = owner_land_parcel_area when owner > user; "
        "assume bps_eligible_area = user_bps_eligible_area when user > owner; "
        "assume verified_exclusion = user_verified_exclusion WHEN user > owner; " + reconcile.ACTIVITY_CHOSEN
    )


def test_outsiders_empty_exclusions_and_equal_areas(spark, rows):
    owners = prepared(
        spark, "P", {"hapar_id": 1, "land_leased_out": "Y"}, {"hapar_id": 2}, {"hapar_id": 3, "land_use": "BRA", "land_use_area": 0},
        {"hapar_id": 4, "land_parcel_area": 9}, {"hapar_id": 4, "land_parcel_area": 10},
    )
    renters = prepared(spark, "S", {"hapar_id": 5}, {"hapar_id": 6, "land_use": "ROK"})
    final = reconcile.infer_and_equalise(reconcile.one_sided_rows(owners, renters))
    assert rows(final, "claim_id", "owner_land_use", "user_land_use", "land_parcel_area", "change_note") == [
        ("P1", "PGRS", "NON_SAF", 10.0, reconcile.NO_SCHEME_RENTER), ("P2", "PGRS", None, 10.0, None),
        ("P4", "PGRS", None, 10.0, reconcile.PARCEL_EQUALISED), ("P5", "PGRS", None, 10.0, reconcile.PARCEL_EQUALISED),
        ("S1", "NON_SAF", "PGRS", 10.0, reconcile.NO_SCHEME_OWNER), ("S2", None, "ROK", 10.0, None),
    ]


# --------------------------------------------------------------------------------- flags
def final_frame(spark, *changes):
    owner = prepared(spark, "P")
    base = reconcile.one_sided_rows(owner, owner).schema
    areas = {f.name for f in base.fields if f.dataType.typeName() == "decimal"}
    from decimal import Decimal

    data = []
    for i, change in enumerate(changes, start=1):
        row = {"hapar_id": 1, "year": 2017, "land_parcel_area": 10, "claim_id": f"P{i}", **change}
        data.append(tuple(Decimal(str(row[n])) if n in areas and row.get(n) is not None else row.get(n) for n in base.fieldNames()))
    return spark.createDataFrame(data, base)


JOINED = {"change_note": "first join; "}


@pytest.mark.parametrize(
    "flag, flagged, clean_rows",
    [
        ("E1", [{"owner_hahol_id": 1, "user_hahol_id": 2}], [{"owner_hahol_id": 1}, {"owner_hahol_id": 1, "user_hahol_id": 1}]),
        ("E2", [{"owner_habus_id": 1}, {"owner_habus_id": 2}, {}], [{"hapar_id": 2, "owner_habus_id": 1}, {"hapar_id": 2, "owner_habus_id": 1}]),
        ("E5", [{"claim_id": f"P{i}, S1", **JOINED} for i in range(3)], [{"claim_id": f"P{i}, S2", **JOINED} for i in (5, 6)] + [{}, {}, {}]),
        ("E6", [{"user_land_leased_out": "Y"}], [{"user_land_leased_out": "N"}, {"owner_land_leased_out": "Y"}]),
        ("E7", [{"claim_id": f"P1, S{i}", **JOINED} for i in range(2)], [{"claim_id": "P2, S9", **JOINED}, {"claim_id": "P3"}]),
        ("E8", [{"user_habus_id": 1}, {"user_habus_id": 2}], [{"hapar_id": 2, "user_habus_id": 1}]),
        ("E9", [{"owner_land_use": "PGRS", "user_land_use": "RGR"}],
         [{"owner_land_use": "BRA", "user_land_use": "RGR"}, {"owner_land_use": "NON_SAF", "user_land_use": "RGR"}, {"user_land_use": "RGR"}]),
        ("E10", [{"owner_land_use_area": 6, "user_land_use_area": 9}, {"user_land_use_area": 5}], [{"hapar_id": 2, "owner_land_use_area": 10, "user_land_use_area": 10}]),
        ("E11", [{"owner_bps_claimed_area": 6, "user_bps_claimed_area": 5}], [{"hapar_id": 2, "owner_bps_claimed_area": 10}]),
    ],
)
def test_single_flags(spark, rows, flag, flagged, clean_rows):
    given = [*[{**r, "land_activity": "bad"} for r in flagged], *[{**r, "land_activity": "good"} for r in clean_rows]]
    out = flags.flag_errors(final_frame(spark, *given), only=[flag])
    expected = sorted([("bad", flags.FLAG_TEXTS[flag])] * len(flagged) + [("good", None)] * len(clean_rows))
    assert rows(out, "land_activity", "error_log") == sorted(expected, key=lambda r: [(v is None, str(v)) for v in r])


def test_pair_sums_flag_the_parcel(spark, rows):
    owners = prepared(spark, "P", {"hapar_id": 1, "land_leased_out": "Y"}, {"hapar_id": 2, "land_leased_out": "Y"})
    renters = prepared(spark, "S", {"hapar_id": 1, "land_parcel_area": 12}, {"hapar_id": 2, "bps_eligible_area": 3})
    pairs = reconcile.match_owners_renters(owners, renters)[0]
    out = flags.flag_errors(final_frame(spark, {}, {"hapar_id": 2}, {"hapar_id": 3}), pairs, only=["E3", "E4"])
    assert rows(out, "hapar_id", "error_log") == [(1, flags.FLAG_TEXTS["E3"]), (2, flags.FLAG_TEXTS["E4"]), (3, None)]


def test_flag_order_and_append(spark):
    row = {"owner_hahol_id": 1, "user_hahol_id": 2, "user_land_leased_out": "Y"}
    out = flags.flag_errors(final_frame(spark, row), only=["E6", "E1"]).first()
    assert out.error_log == flags.FLAG_TEXTS["E1"] + flags.FLAG_TEXTS["E6"]


# ---------------------------------------------------------------- largest use, ownership
def test_largest_use(spark, rows):
    df = final_frame(
        spark, {"owner_land_use": "PGRS", "owner_bps_claimed_area": 5}, {"owner_land_use": "PGRS", "user_land_use": "WW", "user_bps_claimed_area": 5},
        {"owner_land_use": "TREE", "owner_land_use_area": 50}, {"hapar_id": 2, "owner_land_use": "RGR", "user_land_use": "NON_SAF", "owner_land_use_area": 3},
        {"hapar_id": 3, "owner_land_use": "RGR", "owner_land_use_area": 3},
    )
    commons_fields = df.filter("hapar_id = 3").select("hapar_id")
    out = largest_use.largest_use(df, land_use_rank(spark), commons_fields)
    assert rows(out) == [(1, "WW", 5.0), (2, "RGR", 3.0)]


def test_ownership_rows_and_counts(spark, rows):
    df = final_frame(
        spark, {"owner_habus_id": 2, "owner_land_leased_out": "Y", "owner_bps_claimed_area": 0},
        {"owner_habus_id": 1, "owner_land_leased_out": "N", "owner_bps_claimed_area": 0}, {"user_habus_id": 9, "user_bps_claimed_area": 4},
        {"hapar_id": 2, "user_habus_id": 9, "user_land_leased_out": "N"}, {"hapar_id": 3, "owner_habus_id": 1},
    ).withColumn("error_log", F.when(F.col("hapar_id") == 3, "this is a commons field; "))
    businesses = ownership.parcel_businesses(df)
    assert rows(businesses) == [(1, "owner", 1), (1, "owner", 2), (1, "user", 9), (2, "user", 9)]
    out = ownership.ownership_per_parcel(df, businesses)
    assert rows(out) == [(1, "Y", 2, 1, 3, None, 4.0), (2, "N", None, 1, 1, None, None)]


# --------------------------------------------------------------------------------- impute
def test_remainder_goes_to_the_empty_row_or_to_an_imputed_one(spark, rows):
    df = prepared(
        spark, "P", {"hapar_id": 1, "land_use_area": 4}, {"hapar_id": 1, "land_use_area": 0, "land_use": "RGR"},
        {"hapar_id": 2, "land_use_area": 4}, {"hapar_id": 3, "land_use_area": 4}, {"hapar_id": 3, "land_use_area": 0}, {"hapar_id": 3, "land_use_area": None},
        {"hapar_id": 4, "land_use_area": 10}, {"hapar_id": 5, "land_use_area": 0},
    )
    out = rows(impute.impute_remainder(df), "hapar_id", "claim_id", "land_use", "land_use_area")
    assert out == sorted([
        (1, "P1", "PGRS", 4.0), (1, "P2", "RGR", 6.0), (2, "P3", "PGRS", 4.0), (2, None, impute.IMPUTED, 6.0),
        (3, "P4", "PGRS", 4.0), (3, "P5", "PGRS", 0.0), (3, "P6", "PGRS", None), (3, None, impute.IMPUTED, 6.0),
        (4, "P7", "PGRS", 10.0), (5, "P8", "PGRS", 0.0),
    ], key=lambda r: [(v is None, str(v)) for v in r])


def test_doubled_parcels_are_marked_where_several_hold_them(spark, rows):
    df = prepared(
        spark, "P", {"habus_id": 1, "land_use_area": 10, "bps_claimed_area": 10}, {"habus_id": 2, "land_use_area": 10, "bps_claimed_area": 3},
        {"hapar_id": 2, "land_use_area": 10, "bps_claimed_area": 10}, {"hapar_id": 2, "land_use_area": 10, "bps_claimed_area": 10},
        {"hapar_id": 3, "habus_id": 1, "land_use_area": 10, "bps_claimed_area": 10}, {"hapar_id": 3, "habus_id": 2, "land_use_area": 9, "bps_claimed_area": 9},
    )
    out = impute.mark_doubled_parcels(df, "x; ")
    assert [r for r in rows(out, "claim_id", "change_note") if r[1]] == [("sP1", "x; ")] and out.count() == 6


def test_excluded_uses_of_later_businesses_move(spark, rows):
    owners = prepared(
        spark, "P", {"habus_id": 1, "land_use": "EXCL", "bps_claimed_area": 1}, {"habus_id": 2, "land_use": "EXCL", "bps_claimed_area": 0},
        {"habus_id": 2, "bps_claimed_area": 5}, {"habus_id": 3, "land_use": "EXCL", "bps_claimed_area": 0},
    )
    renters = prepared(
        spark, "S", {"habus_id": 1, "bps_claimed_area": 4}, {"habus_id": 2, "land_use": "EXCL", "bps_claimed_area": 0},
        {"habus_id": 2, "bps_claimed_area": 0}, {"habus_id": 3, "bps_claimed_area": 0},
    )
    p, s = impute.move_excluded_uses(owners, renters)
    assert rows(p, "claim_id") == [("P1",), ("P3",), ("P4",), ("SP2",)]
    assert rows(s, "claim_id", "is_perm_flag")[:2] == [("P3", "Y"), ("PS2", "Y")] and s.count() == 4


def test_half_parcels_are_flagged_without_a_lease(spark, rows):
    df = prepared(
        spark, "P", {"land_use_area": 12, "land_leased_out": "N"}, {"land_use_area": 8, "land_leased_out": "Y"},
        {"hapar_id": 2, "land_use_area": 15, "land_leased_out": "N"},
    )
    assert rows(impute.flag_half_parcels(df), "claim_id") == [("P2",), ("P3",), ("sP1",)]


def test_later_claiming_owner_becomes_renter_and_silent_renter_owner(spark, rows):
    owners = prepared(spark, "P", {"habus_id": 1}, {"habus_id": 2, "bps_claimed_area": 5}, {"habus_id": 3})
    renters = prepared(spark, "S", {"hapar_id": 7, "habus_id": 1}, {"hapar_id": 7, "habus_id": 2, "bps_claimed_area": 0})
    p, s = impute.move_extra_businesses(owners, renters)
    assert rows(p, "claim_id", "land_leased_out") == [("P1", "N"), ("P2-01", "Y"), ("P3", "N")]
    assert rows(s, "claim_id", "is_perm_flag") == [("S1", "Y"), ("S2-01", "N")]


def test_swapped_parcels(spark, rows):
    owners = prepared(spark, "P", {"bps_claimed_area": 5}, {"hapar_id": 2, "bps_claimed_area": 5})
    renters = prepared(spark, "S", {"bps_claimed_area": 0}, {"hapar_id": 2, "bps_claimed_area": 1})
    assert rows(impute.swapped_parcels(owners, renters), "hapar_id") == [(100,)]
    p, s = impute.reassign_sides(owners, renters)
    assert (rows(p, "claim_id"), rows(s, "claim_id")) == ([("P1-01",), ("P2",)], [("S1-01",), ("S2",)])


# -------------------------------------------------------------------------------- commons
SHARE = ("share_id string, cg_hahol_id long, mlc_hahol_id long, share_hahol_id long, habus_id long, area_amt decimal(18,2), "
         "share_bps_eligible_area decimal(18,2), bps_claimed_area decimal(18,2), lfass_claimed_area decimal(18,2), "
         "activity_type_desc string, name string, year int")  # fmt: skip


def test_commons_from_build_to_flags(spark, frame, rows):
    from decimal import Decimal as D

    from landrecon.functions.rings import rect_ring

    share = frame(
        SHARE, ("S1", 1, 5, 5, 5, D(3), D(1), D(4), D(4), "a", "PGRS", 2017), ("S2", 1, 5, 5, 5, D(2), D(1), D(30), D(1), "b", "PGRS", 2017),
        ("S3", 1, 5, 5, 6, D(0), D(1), D(0), D(0), "c", "PGRS", 2017), ("S4", 2, 7, 7, 7, D(1), D(1), D(1), D(1), "c", "RGR", 2017),
    )
    detail = frame("cg_hahol_id long, hapar_id long, digitised_area decimal(18,2), bps_eligible_area decimal(18,2), excluded_land_area decimal(18,2), year int",
                   (1, 10, D(20), D(30), D(2), 2017), (1, 11, D(5), D(1), D(1), 2017), (2, 12, D(1), D(1), D(0), 2017))
    totals = commons.detail_totals(detail).withColumn("lpid_id", F.concat(F.lit("L"), F.col("cg_hahol_id").cast("string")))
    shapes = frame("hahol_id long, year int, w int, h int", (1, 2017, 100, 2000), (1, 2017, 100, 600), (2, 2017, 100, 100)).withColumn(
        "ring", rect_ring(F.lit(0), F.lit(0), F.col("w"), F.col("h")))
    out, members = commons.clean_commons(commons.build_commons(share, totals, shapes))
    got = {r.id: r for r in out.collect()}
    assert set(got) == {"L1, S1", "L2, S4"}
    assert rows(members) == [("L1, S1", "L1, S1"), ("L1, S1", "L1, S2")]
    row = got["L1, S1"]
    assert (float(row.commons_area), float(row.bps_claimed_area), float(row.lpid_bps_eligible_area)) == (26.0, 34.0, 23.0)
    assert row.land_activity == commons.MERGED_ACTIVITY
    assert row.change_note == (
        "changed commons_area by 1.00ha based on digi_area; " + commons.ELIGIBLE_CLAMPED + "5.00ha ; "
        + commons.SHARES_MERGED + commons.ELIGIBLE_RECOMPUTED + "3.00ha; "
    )
    assert row.error_log == commons.OVERCLAIM + "11.00ha; " + commons.DISCREPANCY
    assert (got["L2, S4"].change_note, got["L2, S4"].error_log) == (None, None)
    assert rows(commons.clean_commons(commons.build_commons(share, totals, shapes), cleared=(1,))[0], "error_log") == [(None,), (None,)]


def test_commons_fields_are_flagged_and_copied_once(spark, frame, rows):
    from decimal import Decimal as D

    iacs = final_frame(spark, {"owner_bps_claimed_area": 4, "owner_mlc_hahol_id": 3, "owner_hahol_id": 8}, {"hapar_id": 2},
                       {"hapar_id": 9, "user_bps_claimed_area": 1}).withColumn("error_log", F.lit(None).cast("string"))
    detail = frame("cg_hahol_id long, hapar_id long, year int", (50, 1, 2017), (50, 1, 2017), (50, 2, 2017))
    grazing = frame("cg_hahol_id long, commons_area decimal(18,2), lpid_bps_eligible_area decimal(18,2), year int, lfass_claimed_area decimal(18,2)",
                    (50, D(9), D(8), 2017, D(1)), (50, D(9), D(8), 2017, D(2)))
    flagged = commons.flag_commons_fields(iacs, detail)
    assert rows(flagged, "hapar_id", "error_log") == [(1, commons.CLAIMED_COMMONS), (2, commons.COMMONS_FIELD), (9, None)]
    copied = commons.copy_to_commons(flagged, detail, grazing)
    assert rows(copied, "cg_hahol_id", "share_hahol_id", "bps_claimed_area", "id") == [(50, 8, 4.0, "P1")]


# -------------------------------------------------------------------------------- metrics
def test_area_bands_at_the_edge(spark, frame, rows):
    from decimal import Decimal as D

    final = final_frame(spark, {}, {"hapar_id": 2, "land_parcel_area": 11}, {"hapar_id": 3, "land_parcel_area": None})
    shapes = frame("hapar_id long, year int, digi_area decimal(18,3)", (1, 2017, D("10.01")), (2, 2017, D("11.005")), (3, 2017, D(1)))
    assert rows(metrics.area_bands(final, shapes), "digi_area_match", "n") == [("< 0.01 difference", 1), ("> 0.1 difference", 2)]
    assert rows(metrics.area_bands(final, shapes, strict=False), "digi_area_match", "n") == [("< 0.01 difference", 2), ("unknown", 1)]


# ----------------------------------------------------------------------------- invariants
def test_row_order_is_irrelevant_and_every_claim_is_merged(spark):
    """The whole chain on given data, once as it lies and once shuffled. Every prepared claim
    is in the merged rows; only empty exclusions are dropped afterwards."""
    from landrecon.catalogue.tables import Tables
    from landrecon.session import stage

    tables = Tables.of(spark, "/root/testdata/sf0.001")

    def chain(order):
        p, s = (order(df) for df in (tables.perm_raw, tables.seas_raw))
        owners, renters = stage(clean.prepare_owners(p)), stage(clean.prepare_renters(s))
        pairs, owners_left, renters_left = reconcile.match_owners_renters(owners, renters)
        merged = reconcile.one_sided_rows(owners_left, renters_left).unionByName(reconcile.merge_pairs(pairs))
        final = flags.flag_errors(reconcile.infer_and_equalise(merged), pairs)
        return owners.select("claim_id").unionByName(renters.select("claim_id")), merged, final

    claims, merged, first = chain(lambda df: df)
    _, _, second = chain(lambda df: df.repartition(5, F.xxhash64("claim_id")).sortWithinPartitions(F.md5("claim_id")))
    assert first.exceptAll(second).isEmpty() and second.exceptAll(first).isEmpty()
    present = merged.select(F.explode(F.split("claim_id", ", ")).alias("claim_id")).distinct()
    assert claims.exceptAll(present).isEmpty() and present.exceptAll(claims).isEmpty()
