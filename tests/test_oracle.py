"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry
from tests.compare import check, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, duck, name):
    assert check(entry.queries()[name](spark, SF), duck, entry.oracle_sql()[name]) > 0


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_rows_only(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
