"""Inline reference lists: excluded land uses and the intensity rank of land uses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Land uses that are excluded from payment, with their descriptions.
EXCLUDED_LAND_USES = {
    "BLU-GLS": "Blueberries - glasshouse",
    "BRA": "Bracken",
    "BUI": "Building",
    "EXCL": "Generic exclusion",
    "FSE": "Foreshore",
    "GOR": "Gorse",
    "LLO": "Land let out",
    "MAR": "Marsh",
    "RASP-GLS": "Raspberries - glasshouse",
    "ROAD": "Road",
    "ROK": "Rocks",
    "SCB": "Scrub",
    "SCE": "Scree",
    "STRB-GLS": "Strawberries - glasshouse",
    "TOM-GLS": "Tomatoes - glasshouse",
    "TREE": "Trees",
    "TREES": "Trees",
    "TURF": "Trees",
    "WAT": "Water",
}

# Land-use codes with their intensity rank, 1 the most intensive, 99 outside production.
LAND_USE_RANKS = [
    ("ALF", 1), ("AMCP", 1), ("ARTC", 1), ("ASPG", 1), ("ASSF", 1), ("BFLO", 1), ("BFT", 1),
    ("BKB", 1), ("BLB", 1), ("BLR-OPEN", 1), ("BLR-POLY", 1), ("BLU-OPEN", 1), ("BPP", 1),
    ("BRT", 1), ("BSP", 1), ("BW", 1), ("CABB", 1), ("CALA", 1), ("CANS", 1), ("CARR", 1),
    ("CAUL", 1), ("CEL", 1), ("CHIC", 1), ("CHP", 1), ("CLO", 1), ("CRB", 1), ("ENG-B", 1),
    ("GAR", 1), ("GSB", 1), ("HS", 1), ("LEEK", 1), ("LEN", 1), ("LETT", 1), ("LGB", 1), ("LIN", 1),
    ("MAIZ", 1), ("MBSF", 1), ("MSC", 1), ("MU", 1), ("NU-FS", 1), ("NU-OT", 1), ("NU-SH", 1),
    ("OCS-B", 1), ("OCS-K", 1), ("ONI", 1), ("ONU", 1), ("OSFRT", 1), ("OVEG", 1), ("PAR", 1),
    ("PUM", 1), ("RASP-OPEN", 1), ("RASP-POLY", 1), ("RAST", 1), ("RHB", 1), ("RRC", 1), ("SB", 1),
    ("SBEAN", 1), ("SFB", 1), ("SL", 1), ("SO", 1), ("SOSR", 1), ("SPEAS", 1), ("SPOT", 1),
    ("SPP", 1), ("SRYE", 1), ("SSF", 1), ("STRB-OPEN", 1), ("STRB-POLY", 1), ("STRIT", 1),
    ("STS", 1), ("SUN", 1), ("SW", 1), ("SWS", 1), ("TFRT", 1), ("TSF", 1), ("WB", 1), ("WBEAN", 1),
    ("WBS", 1), ("WFB", 1), ("WO", 1), ("WOSR", 1), ("WPEAS", 1), ("WPOT", 1), ("WPP", 1),
    ("WRYE", 1), ("WTRIT", 1), ("WW", 1), ("EX-SS", 2), ("FALW", 2), ("FALW-5", 2), ("GCM", 2),
    ("NETR-A", 2), ("NETR-NA", 2), ("PHA", 2), ("SRC", 2), ("UCAA", 2), ("WDG", 2), ("WFM", 2),
    ("TGRS", 3), ("TGRS1", 3), ("TGRS2", 3), ("TGRS3", 3), ("TGRS4", 3), ("TGRS5", 3), ("VET", 3),
    ("PC", 4), ("PGRS", 4), ("RGR", 5), ("BRA", 99), ("BUI", 99), ("EXCL", 99), ("FSE", 99),
    ("GOR", 99), ("MAR", 99), ("RASP-GLS", 99), ("ROAD", 99), ("ROK", 99), ("SCB", 99), ("SCE", 99),
    ("STRB-GLS", 99), ("TOM-GLS", 99), ("TREES", 99), ("TURF", 99), ("WAT", 99), ("NON_SAF", 99),
]


def _values_table(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    values = ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({columns})")


def excluded_land_uses(spark: SparkSession) -> DataFrame:
    return _values_table(spark, list(EXCLUDED_LAND_USES.items()), "land_use, descript")


def rank_rows(version: int = 2) -> list[tuple[str, int]]:
    """(code, rank) rows; the first version has no rank for use outside the scheme."""
    return [row for row in LAND_USE_RANKS if version >= 2 or row[0] != "NON_SAF"]


def land_use_rank(spark: SparkSession, version: int = 2) -> DataFrame:
    return _values_table(spark, rank_rows(version), "land_use, rank")
