"""Every registered query against its SQL, and the ones without SQL for rows."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, con, name):
    columns, counts, same, _ = compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], FOLDER)
    assert columns and counts[0] == counts[1] and same


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_gives_rows(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


def test_oracles_name_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["k0", "total", "c_acctbal_sum", "c_acctbal_max"]
