"""Every registered query against its SQL on the smallest data."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from testbed.oracles import ORACLES
from testbed.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    expected, actual, missing, extra = compare(duck, entry.queries()[name](spark, SF_DIR), ORACLES[name])
    assert expected == actual and not missing and not extra
    assert actual > 0
