import math

import numpy as np

from roadloom.operators import signals, udf
from roadloom.streaming import states

EDGE = "root long, segment_id string, u long, v long, length double, is_junction boolean, is_shape boolean, h_in double, h_out double"


def test_hull_leaves_inner_points_out():
    h = udf.hull(np.array([(0, 0), (2, 0), (2, 2), (0, 2), (1, 1), (1, 0)]))
    assert sorted(map(tuple, h)) == [(0, 0), (0, 2), (2, 0), (2, 2)]
    assert len(udf.hull(np.array([(1, 1), (1, 1)]))) == 1


def test_short_junction_goes_to_the_straightest_neighbour(spark):
    rows = [
        (1, "a", 1, 2, 50.0, False, False, 0.0, 0.0), (1, "j", 2, 3, 10.0, True, True, 10.0, 10.0), (1, "b", 3, 4, 70.0, False, False, 12.0, 12.0),
        (1, "k", 4, 5, 9.0, True, False, 90.0, 90.0), (1, "l", 5, 6, 99.0, True, True, 90.0, 90.0),
    ]
    got = {r.segment_id: (r.into, r.length) for r in udf.merge_short(spark.createDataFrame(rows, EDGE), "root", 18.0).collect()}
    assert got == {"j": ("b", 80.0)}  # b has taken j, and k's other neighbour is a junction; l is too long


def test_junction_pairs_need_one_shape_and_come_once(spark):
    rows = [(1, s, u, v, 5.0, True, shape, 0.0, 0.0) for s, u, v, shape in (("p", 1, 2, True), ("q", 2, 3, False), ("r", 3, 4, True), ("s", 4, 5, True))]
    assert [tuple(r) for r in udf.merge_pairs(spark.createDataFrame(rows, EDGE), "root").collect()] == [("p", "q")]


def test_split_at_signals(spark):
    rows = [
        ("middle", 1, 2, 100.0, True, False, [50.0]), ("end", 2, 3, 100.0, True, False, [97.0]), ("short", 3, 4, 40.0, True, False, [20.0]), ("none", 4, 5, 80.0, True, False, []), ("start", 5, 6, 60.0, True, False, [9.0]),
        ("two", 6, 7, 30.0, True, False, [10.0, 20.0]), ("close", 7, 8, 90.0, True, False, [10.0, 12.0]), ("both_ways", 8, 9, 100.0, False, False, [50.0]), ("link", 9, 10, 45.0, True, True, [5.0]), ("rest", 10, 11, 25.0, True, False, [5.0]),
    ]
    out = signals.split_at_signals(spark.createDataFrame(rows, "segment_id string, u long, v long, length double, oneway boolean, is_link boolean, positions array<double>")).collect()
    got = {r.segment_id: (r.u, r.v, r.from_m, r.to_m, r.positions, r.signal_at_end) for r in out}
    assert got.keys() == {"middle_a", "middle_b", "end", "short", "none", "start_a", "start_b", "two_a", "two_b", "close", "both_ways", "link", "rest"}
    assert got["middle_a"] == ("1", "n_middle", 0.0, 53.5, [50.0], True) and got["middle_b"] == ("n_middle", "2", 53.5, 100.0, [], False)
    assert got["two_b"] == ("n_two", "7", 13.5, 30.0, [6.5], False) and got["start_a"][3] == 12.5 and got["end"] == ("2", "3", 0.0, 100.0, [97.0], False)


def test_stream_equals_a_loop(spark, tmp_path):
    rows = [("a", float(t), float(t % 7)) for t in (0, 3, 3, 10, 11, 40)] + [("b", 5.0, 2.0)]
    spark.createDataFrame(rows, "k string, t double, x double").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, t double, x double").parquet(str(tmp_path / "in"))
    q = states.tema_stream(stream, "k", "t", "x", 30.0, 300.0, 1.0, 5.0).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted((r.k, r.t, round(r.ema, 9), r.dt, r.kept) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    want = []
    for k in "ab":
        s, last, kept = 1.0, None, None
        for _, t, x in sorted(r for r in rows if r[0] == k):
            dt = 300.0 if last is None else t - last
            s += (1 - math.exp(-dt / 30)) * (x - s)
            keep = kept is None or t - kept >= 5
            last, kept = t, t if keep else kept
            want.append((k, t, round(s, 9), dt, keep))
    assert got == sorted(want)
