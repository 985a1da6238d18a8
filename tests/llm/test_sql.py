"""The text queries with SQL against it, on the smallest data."""

import os

import duckdb
import pytest

from roadloom.llm import queries
from tests.test_queries import SF, rows

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, name):
    db = duckdb.connect()
    for f in os.listdir(SF):
        db.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    assert rows(queries.QUERIES[name](spark, SF).toPandas()) == rows(db.sql(queries.SQL[name]).df())
