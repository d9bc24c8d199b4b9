"""Every registered query against its SQL on the smallest data set."""

import pytest
from check import database, difference
from conftest import SF_DIR

import __spark_entry__ as entry_points
from millrace.plans.oracle import ORACLE
from millrace.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, con, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    assert len(got) > 0
    problem = difference(got, con.execute(ORACLE[name]).df())
    assert problem is None, problem


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert frame.count() > 0
    assert "split" in frame.columns
