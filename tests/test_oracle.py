"""Every registered query against its DuckDB twin, on the small fixture."""

import pytest

import __spark_entry__ as E
from abx.plans.queries import QUERIES
from oracle_compare import compare, duck

from conftest import SF001

NAMES = sorted(set(E.oracle_sql()) & set(QUERIES))


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, detail = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF001, con)
    assert ok, detail


def test_every_query_has_an_oracle():
    assert not set(QUERIES) - set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["date", "group", "experiment_id"]
    assert df.count() > 0
