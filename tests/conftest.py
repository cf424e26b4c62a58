from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from courierlake.session import build_session  # noqa: E402
from courierlake.sources.schemas import bronze_schema  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ["TZ"] = "UTC"
    session = build_session(
        "local[4]",
        app="tests",
        spark__sql__shuffle__partitions="4",
        spark__default__parallelism="4",
        spark__driver__memory="4g",
        # Plans name the paths they read; by default Spark cuts these off, sooner in a longer temporary folder.
        spark__sql__maxMetadataStringLength="2000",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def rows(spark):
    """``rows(topic, {...}, {...})``: bronze rows with the given columns, others NULL."""

    def make(topic: str, *given: dict):
        schema = bronze_schema(topic)
        unknown = {k for g in given for k in g} - set(schema.names)
        assert not unknown, unknown
        data = [tuple(g.get(n) for n in schema.names) for g in given]
        return spark.createDataFrame(data, schema)

    return make
