"""Hand-made domain rows: only the columns that matter to a test are given."""

from __future__ import annotations

from decimal import Decimal

from landrecon.sources.tables import DECLARATION_SCHEMA

DECLARATION = {
    "mlc_hahol_id": 1, "habus_id": 1, "hahol_id": 1, "hapar_id": 100, "land_parcel_area": 10,
    "verified_exclusion": 0, "bps_eligible_area": 10, "land_activity": "", "organic_status": "N",
    "land_use": "PGRS", "land_use_area": 10, "land_leased_out": "N", "lfass": "N",
    "bps_claimed_area": 0, "application_status": "Ready", "payment_region": 1,
    "is_perm_flag": "Y", "year": 2017, "claim_id": "1",
}
PREPARED = (
    "mlc_hahol_id long, habus_id long, hahol_id long, hapar_id long, land_parcel_area decimal(18,2), "
    "bps_eligible_area decimal(18,2), bps_claimed_area decimal(18,2), verified_exclusion decimal(18,2), "
    "land_use_area decimal(18,2), land_use string, land_activity string, application_status string, "
    "land_leased_out string, lfass_flag string, is_perm_flag string, claim_id string, year int, change_note string"
)
PREPARED_DEFAULTS = {
    **{k: v for k, v in DECLARATION.items() if k not in ("organic_status", "payment_region", "lfass")},
    "lfass_flag": "N", "change_note": None,
}


def _value(value):
    return Decimal(str(value)) if isinstance(value, float) else value


def raw(spark, *changes):
    names = DECLARATION_SCHEMA.fieldNames()
    areas = {f.name for f in DECLARATION_SCHEMA.fields if f.dataType.typeName() == "decimal"}
    data = []
    for i, change in enumerate(changes, start=1):
        row = {**DECLARATION, "claim_id": str(i), **change}
        data.append(tuple(Decimal(str(row[n])) if n in areas and row[n] is not None else row[n] for n in names))
    return spark.createDataFrame(data, DECLARATION_SCHEMA)


def prepared(spark, mark, *changes):
    schema = spark.createDataFrame([], PREPARED).schema
    areas = {f.name for f in schema.fields if f.dataType.typeName() == "decimal"}
    data = []
    for i, change in enumerate(changes, start=1):
        row = {**PREPARED_DEFAULTS, "claim_id": f"{mark}{i}", **change}
        data.append(tuple(Decimal(str(row[n])) if n in areas and row[n] is not None else row[n] for n in schema.fieldNames()))
    return spark.createDataFrame(data, schema)
