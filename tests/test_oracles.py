"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from blobferry import catalog
from oracle_check import compare, duck_connect

SF = "/root/testdata/sf0.001"
QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF)


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) & set(ORACLES)))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, SF, QUERIES, ORACLES)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["key", "size", "target_size", "action"]
    assert df.count() > 0
