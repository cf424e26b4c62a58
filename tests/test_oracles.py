"""Every registered query against its SQL oracle, on the smallest scale."""

from __future__ import annotations

import pytest

from checks.compare import compare, duck
from checks.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    cursor = con.execute(ORACLES[name])
    assert compare(rows, df.columns, cursor.fetchall(), [d[0] for d in cursor.description]) is None
    assert rows
