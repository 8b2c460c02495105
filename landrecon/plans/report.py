"""All quality metrics as one report, from one pass over each table.

Declarations of a side are reduced to cells: one row per combination of what the metrics look at, with
its number of rows. The merged table is reduced to one row per parcel, year and value of its parcel
area, of a business or of a land use. Both reductions combine on the map side and are written once; the
metrics are then made of cells, whose number does not grow with the rows of a parcel. Joins of cells and
of shapes go by a shuffle, whatever their estimated size (``joins.detail_join``).

A report row has the metric, year and label where the metric has them, a count ``n`` and an ``area``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from landrecon.operators.joins import detail_join
from landrecon.operators.lookups import attach
from landrecon.plans import metrics
from landrecon.session import stage

PY = ["hapar_id", "year"]
DECLARED = [*PY, "land_parcel_area", "land_use", "land_use_area", "land_leased_out"]


def declaration_cells(df: DataFrame) -> DataFrame:
    """Distinct combinations of what M1, M3, M4, X1 and X4 look at, with their number of rows."""
    return stage(df.groupBy(*DECLARED).agg(F.count(F.lit(1)).alias("n")), "cells")


def merged_cells(final: DataFrame) -> DataFrame:
    """(hapar_id, year, kind, area, value, n, claim): one row per parcel area of a parcel and year with its
    rows and claims (kind ``area``), and one per business and land use (``habus_id``, ``land_use``)."""
    owner, user = F.col("owner_bps_claimed_area"), F.col("user_bps_claimed_area")
    claim = F.coalesce(owner + user, owner, user)
    none, nothing = F.lit(None), F.lit(None).cast("string")

    def entry(kind: str, area: Column, value: Column, claimed: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), area.cast("decimal(18,2)").alias("area"), value.cast("string").alias("value"),
            claimed.cast("decimal(20,2)").alias("claim"),
        )

    entries = [entry("area", F.col("land_parcel_area"), nothing, claim)]
    entries += [entry(c, none, F.col(f"{side}_{c}"), none) for c in ("habus_id", "land_use") for side in ("owner", "user")]
    noted = F.when(F.col("change_note").isNotNull(), 1)
    listed = final.select(*PY, noted.alias("noted"), F.explode(F.array(*entries)).alias("e")).select(*PY, "noted", "e.*")
    cells = listed.filter("kind = 'area' OR value IS NOT NULL").groupBy(*PY, "kind", "area", "value").agg(
        F.count(F.lit(1)).alias("n"), F.sum("claim").alias("claim"), F.sum("noted").alias("noted")
    )
    return stage(cells, "cells")


def row(df: DataFrame, metric: str, year=None, label=None, n=None, area=None, by: list[str] = ()) -> DataFrame:
    """Report rows of one metric: ``n`` and ``area`` are aggregates over the groups ``by``."""
    n = F.count(F.lit(1)) if n is None else n
    area = F.lit(None) if area is None else area
    sums = df.groupBy(*by).agg(n.cast("bigint").alias("n"), F.round(area.cast("double"), 3).alias("area"))
    return sums.select(
        F.lit(metric).alias("metric"), F.lit(year).cast("int").alias("year") if year is None else F.col(year).alias("year"),
        F.lit(label).cast("string").alias("label") if label is None else F.col(label).cast("string").alias("label"), "n", "area",
    )


def of_declarations(owners: DataFrame, renters: DataFrame, year: int) -> list[DataFrame]:
    """M1, M3, M4, X1 and X4 from the cells of both sides."""
    area = F.col("land_use_area") * F.col("n")
    parcels = owners.groupBy(*PY, "land_parcel_area").agg(F.sum("n").alias("n"), F.sum(area).alias("part"))
    totals = parcels.groupBy(*PY).agg(F.sum("part").alias("used"))
    compared = attach(parcels, totals.hint("merge"), PY, null_safe=True).withColumn(
        "label", F.when(F.col("land_parcel_area") > F.col("used"), "Parcel > LU").when(F.col("land_parcel_area") < F.col("used"), "Parcel < LU")
        .when(F.col("land_parcel_area") == F.col("used"), "Equal").otherwise("Other"),
    )
    agreement = metrics.flag_agreement(owners, renters)

    def yearly(cells: DataFrame) -> DataFrame:
        return cells.filter(F.col("year") == year).groupBy("hapar_id", "land_parcel_area").agg(F.sum(area).alias("total"), F.sum("n").alias("rows"))

    left, right = yearly(owners).drop("land_parcel_area"), yearly(renters).drop("land_parcel_area").withColumnRenamed("rows", "other")
    unlike = detail_join(left, right, ["hapar_id", "total"]).filter("rows <> other").select("hapar_id").distinct()
    codes = owners.filter("land_use IS NOT NULL").groupBy(*PY, "land_use").agg(F.sum("n").alias("n"), F.sum(area).alias("area"))
    codes = codes.groupBy(*PY).agg(F.max("n").alias("most"), F.sum("area").alias("area")).filter("most > 1")
    areas = owners.select(*PY, "land_parcel_area").distinct().groupBy("hapar_id").count().filter("count > 1")
    return [
        row(compared, "M1", label="label", n=F.sum("n"), by=["label"]),
        row(agreement, "M3", label="llo_flag_compare", n=F.sum("n"), by=["llo_flag_compare"]),
        row(unlike, "M4"),
        row(codes, "X1", year="year", area=F.sum("area"), by=["year"]),
        row(areas, "X4", n=F.sum("count")),
    ]


def of_merged(cells: DataFrame, digitised: DataFrame) -> list[DataFrame]:
    """M6 and M8 to M12, and the numbers of rows and of noted rows, from the cells of the merged table."""
    areas = cells.filter("kind = 'area'")
    totals = areas.groupBy(*PY).agg(F.sum("claim").alias("total"))
    over = attach(areas.select(*PY, "area"), totals.hint("merge"), PY, null_safe=True).withColumn("diff", F.col("total") - F.col("area")).filter("diff > 0")
    digi = digitised.select(*PY, "digi_area").distinct().hint("merge")
    met = attach(digi, totals.select(*PY, F.lit(True).alias("met")), PY)
    gap = F.abs(F.col("area") - F.col("digi_area"))
    banded = detail_join(areas, digitised.select(*PY, "digi_area"), PY).withColumn(
        "label", F.when(gap < 0.01, "< 0.01 difference").when((gap > 0.01) & (gap < 0.1), "< 0.1 difference").otherwise("> 0.1 difference")
    )
    distinct = cells.filter("kind <> 'area'").groupBy(*PY, "kind").agg(F.count(F.lit(1)).alias("values"))
    found = [
        row(met.filter("met"), "M6", year="year", area=F.sum("digi_area"), by=["year"]),
        row(met.filter("met IS NULL").select(*PY).distinct(), "M8", year="year", by=["year"]),
        row(banded, "M9", year="year", label="label", by=["year", "label"]),
        row(over, "M10", year="year", area=F.sum("diff"), by=["year"]),
    ]
    for metric, kind in (("M11", "habus_id"), ("M12", "land_use")):
        own = distinct.filter(F.col("kind") == kind)
        found.append(row(own, metric, year="year", label="values", by=["year", "values"]))
    return [*found, row(areas, "rows", n=F.coalesce(F.sum("n"), F.lit(0))), row(areas, "noted", n=F.coalesce(F.sum("noted"), F.lit(0)))]


def quality_report(
    owners: DataFrame, renters: DataFrame, pairs: DataFrame, final: DataFrame, digitised: DataFrame, detail: DataFrame,
    grazing_shapes: DataFrame, year: int,
) -> DataFrame:
    """All metrics over prepared declarations, pairs, the merged table and the grazings."""
    single = metrics.single_overclaim(pairs)
    regions = metrics.region_mismatch(detail)
    unlike = metrics.digitised_mismatch(detail, grazing_shapes)
    rows = [
        *of_declarations(declaration_cells(owners), declaration_cells(renters), year),
        row(single, "M2", year="year", area=F.sum("diff"), by=["year"]),
        *of_merged(merged_cells(final), digitised),
        row(regions, "M13", year="year", area=F.sum("diff"), by=["year"]),
        row(unlike, "M15", year="year", area=F.sum("digi_diff"), by=["year"]),
    ]
    return reduce(DataFrame.unionByName, rows)
