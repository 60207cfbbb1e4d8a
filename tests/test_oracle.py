"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry_module
from compare import compare, duck

from starmart.exercises import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    problem, _, _ = compare(spark, con, SF, QUERIES[name], ORACLES.get(name))
    assert problem is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["start_time", "user_id"]
