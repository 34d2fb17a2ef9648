"""Every registered query against its DuckDB oracle, at sf0.001."""

import pytest

import __spark_entry__ as entry_module
from conftest import SF_SMALL
from oracle_compare import compare, duck

from branchcost.plans import catalog

QUERIES = {k: q for k, q in entry_module.queries().items() if k in catalog.QUERIES}
ORACLES = {k: q for k, q in entry_module.oracle_sql().items() if k in catalog.QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    problems, _ = compare(QUERIES[key](spark, SF_SMALL), con, ORACLES[key])
    assert not problems, problems


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["branch_id", "year", "month", "total_work_hour", "total_salary", "cost_per_hour"]
    assert df.count() == 907
