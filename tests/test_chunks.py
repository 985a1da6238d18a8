import math
import time

from roadloom.operators import timeseries


def plain(rows, seed, tau, first_dt):
    """(row, dt, state) in order; a null value leaves no state."""
    s, last, out = seed, None, []
    for t, row, x in sorted(rows, key=lambda r: r[:2]):
        dt = first_dt if last is None else t - last
        a = 1 - math.exp(-dt / tau)
        s, last = None if s is None or x is None else s + a * (x - s), t
        out.append((row, dt, s))
    return out


def test_busy_chunk_takes_time_in_proportion(spark):
    """100,000 rows of one key in one chunk."""
    rows = [(float(i // 3), i, float(i * 7 % 11)) for i in range(100_000)]
    df = spark.createDataFrame([("k", *r) for r in rows], "k string, t double, row long, x double")
    seeds = spark.createDataFrame([("k", 3.0)], "k string, e double")
    began = time.time()
    got = {r.row: (r.dt, r.e) for r in timeseries.tema(df, "k", "t", "row", {"x": "e"}, seeds, 30.0, 300.0, 1e6).collect()}
    assert time.time() - began < 30
    for row, dt, s in plain(rows, 3.0, 30.0, 300.0):
        assert got[row][0] == dt and abs(got[row][1] - s) < 1e-9


def test_small_batches_nulls_and_missing_seeds(spark):
    """Batches that end within chunks or at their ends, null values, keys without a seed."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    data = {"a": [(i * 5.0, i, float(i % 4)) for i in range(40)], "b": [(i * 9.0, 100 + i, None if i == 13 else float(i)) for i in range(20)], "c": [(7.0, 200, 1.0)]}
    try:
        df = spark.createDataFrame([(k, *r) for k, v in data.items() for r in v] + [(None, 1.0, 900, 1.0), ("a", None, 901, 1.0)], "k string, t double, row long, x double")
        seeds = spark.createDataFrame([("a", 3.0), ("b", None)], "k string, e double")
        got = {r.row: (r.dt, r.e) for r in timeseries.tema(df, "k", "t", "row", {"x": "e"}, seeds, 30.0, 300.0, 20.0).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {row: (dt, s) for k, v in data.items() for row, dt, s in plain(v, 3.0 if k == "a" else 0.0, 30.0, 300.0)}
    assert got.keys() == want.keys()
    for row, (dt, s) in want.items():
        assert got[row][0] == dt and (got[row][1] is None if s is None else abs(got[row][1] - s) < 1e-9)
