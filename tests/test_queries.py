"""Every query of the registry against its SQL in DuckDB, on the smallest data."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from roadloom.plans import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    return c


def plain(v):
    if v is None or v is pd.NA or isinstance(v, float) and math.isnan(v):
        return "null"
    if isinstance(v, float) and v == int(v) if isinstance(v, float) and math.isfinite(v) else False:
        return str(int(v))
    return str(v)


def rows(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(plain(v) for v in r) for r in df[cols].astype(object).values.tolist())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, db, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    if name in registry.SQL:
        assert rows(got) == rows(db.sql(registry.SQL[name]).df())
    else:
        assert len(got.columns)


def test_entry_points(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
