"""Every query against its DuckDB text on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from fixtures.compare import compare, duck
from fixtures.oracles import ORACLES
from fixtures.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    got, want, diff = compare(spark, con, SF, QUERIES[name], ORACLES[name])
    assert got == want and not diff


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
