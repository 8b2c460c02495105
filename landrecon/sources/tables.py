"""Typed scans of the input tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

AREA = T.DecimalType(18, 2)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_L, _S, _I = T.LongType(), T.StringType(), T.IntegerType()

DECLARATION_SCHEMA = _schema(
    mlc_hahol_id=_L, habus_id=_L, hahol_id=_L, hapar_id=_L,
    land_parcel_area=AREA, verified_exclusion=AREA, bps_eligible_area=AREA,
    land_activity=_S, organic_status=_S, land_use=_S, land_use_area=AREA,
    land_leased_out=_S, lfass=_S, bps_claimed_area=AREA, application_status=_S,
    payment_region=_I, is_perm_flag=_S, year=_I, claim_id=_S,
)
COMMONS_SHARE_SCHEMA = _schema(
    cg_hahol_id=_L, mlc_hahol_id=_L, share_hahol_id=_L, habus_id=_L, area_amt=AREA,
    share_bps_eligible_area=AREA, bps_claimed_area=AREA, lfass_claimed_area=AREA,
    activity_type_desc=_S, name=_S, year=_I,
)
COMMONS_DETAIL_SCHEMA = _schema(
    cg_hahol_id=_L, hapar_id=_L, digitised_area=AREA, bps_eligible_area=AREA,
    excluded_land_area=AREA, payment_region_1=AREA, payment_region_2=AREA,
    payment_region_3=AREA, year=_I,
)
RING = T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))
PARCEL_SHAPE_SCHEMA = _schema(
    hapar_id=_L, hahol_id=_L, digi_area=AREA, start_date=T.DateType(), ring=RING
)
PROPERTY_SCHEMA = _schema(property=_S, ring=RING)


def load(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Scan Parquet; a stated schema spares the footer read and fixes the types."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def union_years(deliveries: dict[int, DataFrame]) -> DataFrame:
    """One table from yearly deliveries, each tagged with its year."""
    tagged = [df.withColumn("year", F.lit(year)) for year, df in sorted(deliveries.items())]
    return reduce(DataFrame.unionByName, tagged)


def yearly(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """All deliveries below ``path``, one folder ``year=...`` each, in one scan; a filter on the year
    opens its folder only."""
    return spark.read.schema(f"{columns}, year int").parquet(path)
