import itertools
import math
import sqlite3
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadloom.functions import geometry as G
from roadloom.functions import scalar as S
from roadloom.operators import faces, graph, network, timeseries, udf
from roadloom.sources import readers, writers


def value(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def line(*points):
    return F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in points])


def test_jenks_is_optimal():
    r = np.random.default_rng(0)
    for k in (2, 3, 4):
        v = np.sort(r.random(14))
        cost = lambda cuts: sum(((p - p.mean()) ** 2).sum() for p in np.split(v, cuts))
        best = min(itertools.combinations(range(1, 14), k - 1), key=cost)
        want = [v[0], *[v[c - 1] for c in best], v[-1]]
        assert np.allclose(udf.jenks(v, k), want)
    assert udf.jenks(np.array([1.0, 2.0]), 4) == [1.0, 1.25, 1.5, 1.75, 2.0]
    assert udf.jenks(np.array([]), 2) == []


def test_lane_search():
    d = np.linspace(0, 9.6, 300)
    lanes, bounds, how = udf.lane_search(d, 7, None, False)
    assert (lanes, len(bounds), how) == (3, 4, "search")  # 9.6 m are three lanes, whatever the tag says
    clear = np.concatenate([np.full(40, c) + np.linspace(-0.4, 0.4, 40) for c in (1.6, 4.8, 8.0, 11.2)])
    assert udf.lane_search(clear, 1, None, False)[0] in (3, 4) and udf.lane_search(clear, 1, None, True)[1] == pytest.approx([1.2, 11.6])
    assert udf.lane_search(d[:10], 2, None, False) == (2, [0.0, 3.2, 6.4], "grid")
    assert udf.lane_search(d, 2, 3, False)[2] == "manual" and udf.lane_search(d, 1, None, True)[2] == "link"


def test_viterbi_stays_connected():
    a = np.array
    path = udf.viterbi([a([1.0, 2.0]), a([1.0, 3.0]), a([5.0, 1.0])], [a([0, 5]), a([5, 0]), a([1, 9])], [a([1, 6]), a([6, 1]), a([2, 10])], 5.0)
    assert path == [0, 1, 0]  # 0->1, 0->1, 1->2 although the second point lies nearer to another edge
    assert udf.viterbi([a([1.0]), a([])], [a([0]), a([])], [a([1]), a([])], 5.0) == [0]
    assert udf.viterbi([], [], [], 5.0) == []


def test_faces_of_two_squares(spark):
    nodes = {0: (0, 0), 1: (1, 0), 2: (1, 1), 3: (0, 1), 4: (2, 0), 5: (2, 1), 6: (3, 3)}
    links = [(0, 1), (1, 2), (2, 3), (0, 3), (1, 4), (4, 5), (2, 5), (5, 6), (1, 0)]  # a dead end, and one link twice
    rows = [(a, b, *map(float, nodes[a]), *map(float, nodes[b])) for a, b in links]
    got = faces.faces(spark.createDataFrame(rows, "u long, v long, x1 double, y1 double, x2 double, y2 double")).collect()
    assert sorted((f.face, f.area, f.perimeter, f.nodes) for f in got) == [("0-1", 1, 4, [0, 1, 2, 3]), ("1-4", 1, 4, [1, 4, 5, 2])]


def test_geometry(spark):
    bent = line((0, 0), (3, 0), (3, 4))
    assert value(spark, G.length(bent)) == 7
    assert tuple(value(spark, G.interpolate(bent, F.lit(5.0)))) == (3, 2)
    head, tail = G.cut(bent, F.lit(5.0))
    assert [tuple(p) for p in value(spark, head)] == [(0, 0), (3, 0), (3, 2)] and [tuple(p) for p in value(spark, tail)] == [(3, 2), (3, 4)]
    assert value(spark, G.cut(bent, F.lit(9.0))[1]) is None
    assert [tuple(p) for p in value(spark, G.joined(bent, line((3, 4), (9, 9))))] == [(0, 0), (3, 0), (3, 4), (9, 9)]
    left = value(spark, G.project(bent, F.lit(1.0), F.lit(2.0)))
    assert (left["dist"], left["offset"], left["station"]) == (2, -2, 1)
    assert value(spark, G.project(bent, F.lit(5.0), F.lit(2.0)))["offset"] == 2
    assert math.isclose(value(spark, G.end_heading(bent, 3.5)), math.degrees(math.atan2(4, 3)))
    assert value(spark, G.end_heading(bent, 2.0, False)) == 90
    assert value(spark, G.ring_area(line((0, 0), (2, 0), (2, 3), (0, 0)))) == 3
    x, y = G.utm(F.lit(0.0), F.lit(21.0), F.lit(34))
    assert value(spark, x) == 500000 and abs(value(spark, y)) < 1e-6
    x, y = G.utm(F.lit(37.98), F.lit(23.73), F.lit(34))  # Athens
    assert abs(value(spark, x) - 739_750) < 1_000 and abs(value(spark, y) - 4_207_300) < 1_000


def test_scalars(spark):
    assert value(spark, S.turned(F.lit(-170.0), F.lit(170.0))) == 20
    assert [value(spark, S.turn_class(F.lit(float(d)))) for d in (0, 30, -30, 150, 175)] == ["straight", "left", "right", None, "u_turn"]
    assert [value(spark, S.turn_class_through(F.lit(float(d)))) for d in (0, 150, -150, 180)] == ["straight", "left", "right", "u_turn"]
    assert value(spark, S.clip(F.lit(None).cast("double"), 0.0, 1.0)) is None
    lane, outside = S.lane_of(F.lit(9.0), F.array(F.lit(0.0), F.lit(3.0), F.lit(9.0)))
    assert (value(spark, lane), value(spark, outside)) == (1, True)
    r = lambda *x, **k: value(spark, S.rtsm(*[F.lit(float(v)) for v in x], **k))
    assert (r(1, 1, -1, 5), r(1, 1, 0, 0), r(-1, 1, 5, 5), r(5, 0, 5, 5), r(1, 1, -1, -1, invalid=False)) == (-1, 0, 1, 0.5, 0)
    assert [value(spark, S.zone(F.lit(a), F.lit(b))) for a, b in ((1.0, 1.6), (0.0, 0.0), (-1.0, 0.0), (0.0, 2.0), (-1.0, -2.0), (51.0, 0.0))] == ["proceeding", None, "following", "left_front", "right_back", None]
    assert value(spark, S.numbers_in(F.lit("[12, 7]"))) == ["12", "7"]


def test_tema_equals_a_loop_whatever_the_chunks(spark):
    r = np.random.default_rng(3)
    rows = [(f"s{k}", int(i), float(t), float(x)) for k in range(3) for i, (t, x) in enumerate(zip(np.sort(r.integers(0, 500, 60)), r.random(60), strict=True))]
    df = spark.createDataFrame(rows, "k string, row int, t double, x double")
    seeds = spark.createDataFrame([("s0", 5.0), ("s1", -1.0)], "k string, e double")
    want = {}
    for k, start in (("s0", 5.0), ("s1", -1.0), ("s2", 0.0)):
        s, last = start, None
        for _, i, t, x in sorted((a for a in rows if a[0] == k), key=lambda a: (a[2], a[1])):
            dt = 300.0 if last is None else t - last
            s += (1 - math.exp(-dt / 30)) * (x - s)
            last = t
            want[k, i] = s
    for chunk in (7.0, 100.0, 1e9):
        got = {(g.k, g.row): g.e for g in timeseries.tema(df, "k", "t", "row", {"x": "e"}, seeds, 30.0, 300.0, chunk).collect()}
        assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in want)


def test_voronoi_widths_cover_the_segment(spark):
    df = spark.createDataFrame([("a", i, float(x), True, 100.0) for i, x in enumerate((3, 40, 97))] + [("b", 0, 5.0, True, 10.0), ("c", 0, 1.0, False, 9.0)], "k string, row int, at double, bad boolean, len double")
    got = dict(map(tuple, timeseries.outlier_share(df, ["k"], "at", "row", "bad", "len").collect()))
    assert got == {"a": 1.0, "b": 1.0, "c": 0.0}


def test_interpolation_equals_numpy(spark):
    x, y = [0.0, 2.0, 5.0, 9.0], [1.0, 3.0, -1.0, 4.0]
    q = [-1.0, 0.0, 1.0, 2.0, 4.9, 9.0, 12.0]
    points = spark.createDataFrame([("a", *p) for p in zip(x, y, strict=True)], "k string, x double, y double")
    got = timeseries.interpolated(points, ["k"], "x", "y", spark.createDataFrame([("a", v) for v in q], "k string, q double"), "q", "v")
    have = {g.q: g.v for g in got.collect()}
    assert np.allclose([have[v] for v in q], np.interp(q, x, y))


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 502), (500, 502)]
    got = dict(map(tuple, network.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert set(got[i] for i in range(201)) == {0} and set(got[i] for i in (500, 501, 502)) == {500}


def test_contraction_names_chains_by_their_first_segment(spark):
    rows = [("e1", 1, 2, 1), ("e2", 2, 3, 1), ("e3", 3, 4, 1), ("e4", 4, 5, 2), ("e5", 9, 4, 2)]
    got = {g.segment_id: (g.chain_id, g.ord) for g in graph.contracted(spark.createDataFrame(rows, "segment_id string, u long, v long, lanes int")).collect()}
    assert got == {"e1": ("e1", 0), "e2": ("e1", 1), "e3": ("e1", 2), "e4": ("e4", 0), "e5": ("e5", 0)}


def test_ragged_lines(spark):
    text = ["track_id; type; traveled_d; avg_speed; lat; lon", "1; Car; 10; 36; 1; 2; 3.6; 4; 5; 6; 7; 8; 7.2; 9; 1; 2", "2; Motorcycle; 1; 1; 1; 2; 3; 4; 5; 6", "3; Bus; x; 1; 1; 2; 3; 4; bad; 6", "4; Car; 1", "5; Car; 1; 1; 1; 2; 3"]
    got = readers.parse_lines(spark.createDataFrame([(t,) for t in text], "value string")).collect()
    assert [(g.track_id, g.traveled_d, g.avg_speed, g.speed, g.time) for g in got] == [("1", 10.0, 10.0, 1.0, 6.0), ("1", 10.0, 10.0, 2.0, 2.0)]


def test_geopackage_and_files(spark, tmp_path):
    path = tmp_path / "net.gpkg"
    db = sqlite3.connect(path)
    db.execute("create table roads (segment_id text, lanes integer, geom blob)")
    blob = b"GP\x00\x01" + struct.pack("<i", 32634) + b"\x01" + struct.pack("<II4d", 2, 2, 0.0, 1.0, 2.0, 3.0)
    db.execute("insert into roads values ('7_a', 2, ?)", (blob,))
    db.commit()
    db.close()
    row = readers.geopackage(spark, str(path), "roads", "segment_id string, lanes int").first()
    assert (row.segment_id, row.lanes, [tuple(p) for p in row.line]) == ("7_a", 2, [(0, 1), (2, 3)])
    for rec in ("a", "b"):
        (tmp_path / rec).mkdir()
        (tmp_path / rec / "m.csv").write_text("x\n1\n")
    (tmp_path / "a" / "m_filtered.csv").write_text("x\n2\n")
    found = {g.folder.rsplit("/", 1)[1]: g.path.rsplit("/", 1)[1] for g in readers.discovered(spark, str(tmp_path), ["_filtered.csv", ".csv"]).collect()}
    assert found == {"a": "m_filtered.csv", "b": "m.csv"}


def test_json_and_csv(spark, tmp_path):
    df = spark.createDataFrame([("1", 2), ("3", 4)], "k string, v int")
    (tmp_path / "m.json").write_text(writers.json_document(df, "k", "v").first().document)
    assert sorted(map(tuple, readers.json_map(spark, str(tmp_path / "m.json"), "int").collect())) == [("1", 2), ("3", 4)]
    writers.csv(df, str(tmp_path / "out"), ["v"], ["v"])
    assert [r.v for r in readers.csv(spark, str(tmp_path / "out"), "v int").orderBy("v").collect()] == [2, 4]
    assert readers.conform(df, "v long, w double, k string", {"w": -1.0}).first().asDict() == {"v": 2, "w": -1.0, "k": "1"}


def test_restrictions(spark):
    raw = [({"restriction": "no_left_turn"}, [("from", "way", 1), ("via", "node", 5), ("to", "way", 2)]), ({"restriction": "only_straight_on"}, [("from", "way", 1), ("via", "way", 7), ("via", "way", 8), ("to", "way", 2)]), ({}, [])]
    df = spark.createDataFrame(raw, "tags map<string,string>, members array<struct<role:string,type:string,ref:long>>")
    got = readers.restrictions(df)
    assert [(g.type, g["from"], g.to, g.via_ways, g.via_nodes) for g in got.collect()] == [("no_left_turn", "1", "2", [], ["5"]), ("only_straight_on", "1", "2", ["7", "8"], [])]
    no, only = readers.restriction_kinds(got)
    assert (no.count(), only.count()) == (1, 0)


@pytest.mark.parametrize("gap", [0.0, 3.0, 100.0])
def test_min_gap_equals_a_loop(spark, gap):
    t = [0.0, 1.0, 2.9, 3.0, 3.1, 7.0, 7.0, 9.9, 10.0]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(t)], "k string, row int, t double")
    want, last = [], None
    for i, v in enumerate(t):
        if last is None or v - last >= gap:
            want.append(i)
            last = v
    assert sorted(r.row for r in timeseries.min_gap(df, ["k"], "t", "row", gap).collect()) == want
