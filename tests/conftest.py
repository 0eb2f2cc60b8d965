from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from granero.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("granero-tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                            spark__driver__memory="8g", spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows and a DDL schema to a DataFrame."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def rows():
    """All rows as tuples in a fixed order, NULL first."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=lambda t: [(v is not None, str(v)) for v in t])
