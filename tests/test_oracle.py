"""Every registered query against its SQL counterpart, on the smallest data."""

import os

import pytest

import __spark_entry__ as driver
from catalog.check import duck, rows_of

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLES = driver.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_of_the_catalog_states_its_sql():
    from catalog.registry import QUERIES

    assert not set(QUERIES) - set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    df = driver.queries()[name](spark, FOLDER)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows_of(df.columns, got) == rows_of(cols, res.fetchall())


def test_entry_has_rows(spark):
    assert driver.entry(spark).limit(1).count() == 1
