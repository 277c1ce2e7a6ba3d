"""Every query that SQL can say against its SQL, and the catalogue."""

import pytest

import __spark_entry__ as driver
from checks.compare import database, difference
from llm_cases import SF_DIR
from millrace.llm.queries import QUERIES
from millrace.llm.sql import SQL


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    assert difference(got, database(SF_DIR).execute(SQL[name]).df()) is None


def test_one_query_for_each_operator():
    numbers = [int(name[2:].split("_")[0]) for name in driver.queries() if name.startswith("op")]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in driver.queries()
