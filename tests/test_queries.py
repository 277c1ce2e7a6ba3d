"""Every query against its SQL, on the smallest test tables."""

import inspect

import pytest

import __spark_entry__ as driver
from checks.compare import database, difference
from checks.queries import QUERIES
from checks.sql import SQL
from conftest import SF_DIR


@pytest.fixture(scope="module")
def db():
    return database(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, db, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    assert difference(got, db.execute(SQL[name]).df()) is None


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(driver.oracle_sql()) <= set(driver.queries()) and set(QUERIES) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).columns == ["doc_id", "value"]


def test_queries_take_whole_tables():
    import checks.queries

    text = inspect.getsource(checks.queries)
    assert ".limit(" not in text and ".sample(" not in text
