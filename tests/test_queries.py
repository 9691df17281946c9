"""Every registered query gives the same rows and types as its SQL."""

import pytest

import __spark_entry__ as entry
from workload.check import compare, duck
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, SF) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 1500
