"""Registry of queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from landrecon.catalogue.derive import with_prelude
from landrecon.catalogue.tables import Tables, plain

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
# The checking SQL without the tables that it starts from, for use in other queries' SQL.
BODIES: dict[str, str] = {}


def query(name: str, sql: str | None = None, double: str = "", big: str = ""):
    """Register ``fn(tables)``. ``double`` and ``big`` name the SQL's decimal and count columns,
    which are cast so that both engines return the same types."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(fn(Tables.of(spark, folder)))

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            casts = [f"CAST({c} AS DOUBLE) AS {c}" for c in double.split()]
            casts += [f"CAST({c} AS BIGINT) AS {c}" for c in big.split()]
            body = f"SELECT * REPLACE ({', '.join(casts)}) FROM ({sql})" if casts else sql
            BODIES[name] = body
            ORACLES[name] = with_prelude(body)
        return fn

    return wrap
