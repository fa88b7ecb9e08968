"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, duck, name):
    assert compare(duck, entry.queries()[name](spark, SF_DIR), entry.oracle_sql()[name]) == ""


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["l_extendedprice", "l_returnflag", "n"]
    assert df.count() == 9
