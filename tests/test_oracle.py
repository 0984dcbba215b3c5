"""Every registered query against its DuckDB oracle on sf0.001."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

from tessera.plans import catalog  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = sorted(catalog.queries())


def test_every_query_has_an_oracle():
    assert set(NAMES) == set(catalog.oracle_sql())
    assert set(NAMES) <= set(entry.queries()) and set(NAMES) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert r["ok"], r
    assert not r.get("type_mismatch"), r


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "revenue_usd" in df.columns
