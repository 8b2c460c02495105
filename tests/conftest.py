from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from landrecon.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("8", "landrecon-tests", memory="8g")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """frame("a int, b string", (1, "x"), …)"""

    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples, decimals as floats."""

    def plain(value):
        return float(value) if type(value).__name__ == "Decimal" else value

    def read(df, *columns):
        out = df.select(*columns).collect() if columns else df.collect()
        return sorted((tuple(plain(v) for v in r) for r in out), key=lambda r: [(v is None, str(v)) for v in r])

    return read
