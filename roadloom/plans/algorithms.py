"""Queries for algorithms that have no relational form, and for those next to them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import faces as X
from ..operators import graph as G
from ..operators import network as N
from ..operators import signals as S
from ..operators import spatial as P
from ..operators import stats
from ..operators import udf as U
from . import views as V
from .base import book
from .spatial import _lines

QUERIES, SQL, query = book()


def _offsets(spark, d):
    t = V.traj(spark, d).select("row_id", "segment_id", (F.col("y") / 100).alias("D"))
    return stats.density_sample(t, "segment_id", "D", "row_id", F.pmod(F.col("row_id") * 2654435761, F.lit(4294967296)), 40, 15_000)


@query()
def jenks_breaks(spark, d):
    out = U.natural_breaks(_offsets(spark, d), "segment_id", "D", 3)
    return out.select("segment_id", F.posexplode("breaks").alias("i", "break"))


@query()
def lane_count_search(spark, d):
    t = _offsets(spark, d)
    facts = t.select("segment_id").distinct().select("segment_id", (1 + F.length("segment_id") % 3).cast("int").alias("lanes"), F.when(F.col("segment_id") == "view", 3).alias("manual"), (F.col("segment_id") == "click").alias("is_link"))
    return U.detected_lanes(t, facts).select("segment_id", "lanes", "how", F.array_join(F.transform("bounds", lambda b: F.format_number(b, 3)), ",").alias("bounds"))


@query()
def hmm_match(spark, d):
    e = V.edges(spark, d).select("segment_id", "u", "v").join(_lines(spark, d), "segment_id")
    near = P.near_lines(V.traj(spark, d).select("track_id", "row_id", "t", "x", "y"), e, 50.0, 100.0)
    out = U.matched(near.select("track_id", "t", "row_id", "segment_id", "u", "v", "dist", "station", "offset"))
    return out.select("track_id", "row_id", "segment_id", *[F.round(c, 4).alias(c) for c in ("station", "offset", "dist")])


def _pieces(spark, d):
    return G.headed(N.with_component(V.edges(spark, d)))


_FACES = """
    lk AS (SELECT u AS a, v AS b, x1 AS ax, y1 AS ay, x2 AS bx, y2 AS bb FROM edges WHERE u <> v UNION SELECT v, u, x2, y2, x1, y1 FROM edges WHERE u <> v),
    he AS (SELECT a, b, ax, ay, bx, bb FROM lk QUALIFY row_number() OVER (PARTITION BY a, b ORDER BY ax) = 1),
    tn AS (SELECT b AS a, a AS b, coalesce(lag(b) OVER w, last_value(b) OVER (PARTITION BY a ORDER BY atan2(bb - ay, bx - ax), b ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS nb FROM he WINDOW w AS (PARTITION BY a ORDER BY atan2(bb - ay, bx - ax), b)),
    hn AS (SELECT he.*, nb FROM he JOIN tn USING (a, b)),
    wk AS (SELECT a AS sa, b AS sb, a, b, nb, 0 AS k, false AS over_it FROM hn UNION ALL SELECT sa, sb, h.a, h.b, h.nb, k + 1, (h.a, h.b) < (sa, sb) OR (h.a = sa AND h.b = sb) FROM wk JOIN hn h ON h.a = wk.b AND h.b = wk.nb WHERE NOT over_it),
    ld AS (SELECT sa, sb, max(k) AS n FROM wk GROUP BY 1, 2 HAVING bool_or(over_it AND a = sa AND b = sb)),
    rg AS (SELECT wk.sa, wk.sb, wk.k, h.* FROM wk JOIN ld ON ld.sa = wk.sa AND ld.sb = wk.sb AND NOT over_it JOIN he h ON h.a = wk.a AND h.b = wk.b),
    fc AS (SELECT concat(sa, '-', sb) AS face, sum(ax * bb - bx * ay) / 2 AS area, sum(sqrt((bx - ax) ** 2 + (bb - ay) ** 2)) AS perimeter, count(*) AS n, string_agg(a::VARCHAR, ',' ORDER BY k) AS nodes FROM rg GROUP BY sa, sb HAVING count(*) >= 3 AND sum(ax * bb - bx * ay) / 2 > 1e-9)"""


@query(f"WITH RECURSIVE {_FACES} SELECT face, round(area, 4) AS area, round(perimeter, 4) AS perimeter, n, nodes FROM fc")
def polygonize_faces(spark, d):
    out = X.faces(V.edges(spark, d))
    return out.select("face", F.round("area", 4).alias("area"), F.round("perimeter", 4).alias("perimeter"), "n", F.array_join("nodes", ",").alias("nodes"))


@query("SELECT v AS node, count(DISTINCT (x1, y1)) AS points, round(coalesce((max(x1) - min(x1)) * (max(y1) - min(y1)), 0), 4) AS box FROM edges GROUP BY 1")
def approach_boxes(spark, d):
    out = V.edges(spark, d).groupBy(F.col("v").alias("node")).agg(F.countDistinct("x1", "y1").alias("points"), F.round((F.max("x1") - F.min("x1")) * (F.max("y1") - F.min("y1")), 4).alias("box"))
    return out


@query("""
    WITH p AS (SELECT DISTINCT v AS node, x1 AS x, y1 AS y FROM edges),
    e AS (SELECT a.node, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS bb FROM p a JOIN p b ON a.node = b.node AND (a.x <> b.x OR a.y <> b.y)
          WHERE NOT EXISTS (SELECT 1 FROM p r WHERE r.node = a.node AND ((b.x - a.x) * (r.y - a.y) - (b.y - a.y) * (r.x - a.x) < 0 OR ((b.x - a.x) * (r.y - a.y) = (b.y - a.y) * (r.x - a.x) AND (r.x - a.x) * (r.x - b.x) + (r.y - a.y) * (r.y - b.y) > 0)))),
    s AS (SELECT node, count(*) AS n, abs(sum(ax * bb - bx * ay)) / 2 AS area FROM e GROUP BY 1)
    SELECT q.node, coalesce(n, 1) AS n, round(coalesce(area, 0), 4) AS area FROM (SELECT DISTINCT node FROM p) q LEFT JOIN s ON s.node = q.node
""")
def controller_hulls(spark, d):
    out = U.convex_hulls(V.edges(spark, d).select(F.col("v").alias("node"), F.col("x1").alias("x"), F.col("y1").alias("y")), "node")
    return out.select("node", F.col("n").cast("bigint").alias("n"), F.round("area", 4).alias("area"))


@query()
def merge_short_segments(spark, d):
    return U.merge_short(_pieces(spark, d), "root", 120.0)


@query()
def merge_junction_pairs(spark, d):
    return U.merge_pairs(_pieces(spark, d).withColumn("is_shape", F.floor(F.col("u") / 10) % 2 == 0), "root")


_SIGNALS = "CASE (u + v * 3) % 7 WHEN 0 THEN {a}50.0{z} WHEN 1 THEN {a}8.0{z} WHEN 2 THEN {a}10.0, 60.0{z} WHEN 3 THEN {a}30.0, 32.0{z} WHEN 4 THEN {a}96.0{z} WHEN 5 THEN {a}97.0, 99.5{z} END"


@query(f"""
    WITH p AS (SELECT segment_id, u, v, length, CASE WHEN kind = 'd' AND u % 2 = 0 THEN 45.0 ELSE length END::DOUBLE AS len, lower(highway) LIKE '%\\_link' ESCAPE '\\' AS is_link, (u + v) % 4 <> 0 AS oneway, coalesce({_SIGNALS.format(a="[", z="]")}, []) AS ps FROM edges),
    q AS (SELECT *, ps[1] + 3.5 AS cut_m, len(ps) AS n FROM p),
    c AS (SELECT *, oneway AND NOT (is_link AND len <= 50) AND CASE WHEN n >= 2 THEN cut_m < len - 2 AND cut_m < ps[2] WHEN n = 1 THEN cut_m < len - 18 AND (ps[1] <= 15 OR len > 50 AND ps[1] BETWEEN 0.2 * len AND 0.8 * len) ELSE false END AS cuts FROM q)
    SELECT segment_id AS parent, segment_id, u::VARCHAR AS u, v::VARCHAR AS v, 0.0 AS from_m, round(len, 4) AS to_m, array_to_string(ps, ',') AS positions, len(list_filter(ps, lambda x: x >= len - 1)) > 0 AS signal_at_end FROM c WHERE NOT cuts
    UNION ALL SELECT segment_id, concat(segment_id, '_a'), u::VARCHAR, concat('n_', segment_id), 0.0, round(cut_m, 4), ps[1]::VARCHAR, true FROM c WHERE cuts
    UNION ALL SELECT segment_id, concat(segment_id, '_b'), concat('n_', segment_id), v::VARCHAR, round(cut_m, 4), round(len, 4), array_to_string([x - cut_m FOR x IN ps[2:]], ','), len(list_filter(ps[2:], lambda x: x >= len - 1)) > 0 FROM c WHERE cuts
""")
def split_at_signals(spark, d):
    e = G.headed(V.edges(spark, d)).withColumn("length", F.when(F.expr("kind = 'd' and u % 2 = 0"), 45.0).otherwise(F.col("length")))
    e = e.withColumns({"oneway": F.expr("(u + v) % 4 <> 0"), "positions": F.coalesce(F.expr(_SIGNALS.format(a="array(", z=")")), F.array()).cast("array<double>")})
    out = S.split_at_signals(e)
    return out.select("parent", "segment_id", "u", "v", F.round("from_m", 4).alias("from_m"), F.round("to_m", 4).alias("to_m"), F.array_join(F.transform("positions", lambda p: p.cast("string")), ",").alias("positions"), "signal_at_end")


@query()
def relaned_points(spark, d):
    """Lanes of a fixed count by natural breaks, then each point's lane."""
    t = V.traj(spark, d).select("row_id", "segment_id", (F.col("y") / 100).alias("D"))
    bounds = U.natural_breaks(_offsets(spark, d), "segment_id", "D", 3).withColumnRenamed("breaks", "bounds")
    return stats.lanes_on(t, "segment_id", "D", bounds).select("row_id", "segment_id", F.col("lane_index").alias("lane_index"), "is_outside")
