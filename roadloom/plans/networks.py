"""Queries over segments in many recordings, lanes and undirected structure."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import network as N
from ..operators import stats
from . import views as V
from .base import book

QUERIES, SQL, query = book()


@query("SELECT segment_id, min(rec) AS rec, arg_min(u, rec) AS u, arg_min(v, rec) AS v FROM networks GROUP BY 1")
def union_dedupe_first(spark, d):
    return N.first_of(V.networks(spark, d), ["segment_id"], ["rec", "u", "v"]).select("segment_id", F.col("rec").cast("bigint").alias("rec"), "u", "v")


@query("SELECT segment_id FROM networks GROUP BY 1 HAVING count(DISTINCT rec) = 10")
def common_intersection(spark, d):
    return N.common(V.networks(spark, d), "segment_id", "rec", 10)


@query("SELECT n AS recordings, count(*) AS segments FROM (SELECT segment_id, count(DISTINCT rec) AS n FROM networks GROUP BY 1) GROUP BY 1")
def presence_histogram(spark, d):
    return N.presence(V.networks(spark, d), "segment_id", "rec").groupBy(F.col("n").alias("recordings")).agg(F.count(F.lit(1)).alias("segments"))


@query("SELECT segment_id, count(DISTINCT rec) AS n FROM networks WHERE segment_id NOT IN (SELECT segment_id FROM edges WHERE is_junction) GROUP BY 1 HAVING count(DISTINCT rec) < 8.5")
def rare_segments(spark, d):
    return N.rare(V.networks(spark, d), "segment_id", "rec", 10, 0.15, V.edges(spark, d).where("is_junction"))


@query("""
    WITH c AS (SELECT segment_id, bool_or(is_junction) AS j, list(DISTINCT rec) AS have FROM networks GROUP BY 1 HAVING count(DISTINCT rec) BETWEEN 7 AND 9)
    SELECT rec, count(*) AS n, coalesce(string_agg(segment_id, ',' ORDER BY segment_id) FILTER (j), '') AS junctions, coalesce(string_agg(segment_id, ',' ORDER BY segment_id) FILTER (NOT j), '') AS others
    FROM c, (SELECT unnest(range(10)) AS rec) WHERE NOT list_contains(have, rec) GROUP BY 1
""")
def missing_report(spark, d):
    n = V.networks(spark, d)
    out = N.missing(n, "segment_id", "rec", n.select("rec").distinct(), 3).join(n.select("segment_id", "is_junction").distinct(), "segment_id")
    ids = lambda c: F.array_join(F.array_sort(F.collect_list(F.when(c, F.col("segment_id")))), ",")
    return out.groupBy(F.col("rec").cast("bigint").alias("rec")).agg(F.count(F.lit(1)).alias("n"), ids(F.col("is_junction")).alias("junctions"), ids(~F.col("is_junction")).alias("others"))


@query("SELECT segment_id FROM edges WHERE NOT is_junction AND highway <> 'primary_link' EXCEPT SELECT segment_id FROM networks WHERE rec = 3")
def removal_difference(spark, d):
    e = V.edges(spark, d).where("not is_junction and highway <> 'primary_link'").select("segment_id")
    return e.subtract(V.networks(spark, d).where("rec = 3").select("segment_id"))


@query("SELECT e.segment_id, coalesce(f.lanes, e.lanes) AS lanes, f.lanes IS NOT NULL AND f.lanes <> e.lanes AS changed FROM edges e LEFT JOIN (SELECT segment_id, max(lanes) + 1 AS lanes FROM networks WHERE rec = 5 GROUP BY 1) f USING (segment_id)")
def combine_first_lanes(spark, d):
    f = V.networks(spark, d).where("rec = 5").groupBy("segment_id").agg((F.max("lanes") + 1).alias("new"))
    out = V.edges(spark, d).join(f, "segment_id", "left")
    return out.select("segment_id", F.coalesce("new", "lanes").alias("lanes"), F.coalesce(F.col("new") != F.col("lanes"), F.lit(False)).alias("changed"))


_DEGREE = "(SELECT node, count(DISTINCT segment_id) AS degree FROM (SELECT u AS node, segment_id FROM edges UNION ALL SELECT v, segment_id FROM edges) GROUP BY 1)"
_WITH = f"(SELECT e.*, a.degree AS du, b.degree AS dv FROM edges e JOIN {_DEGREE} a ON a.node = e.u JOIN {_DEGREE} b ON b.node = e.v)"


@query(f"SELECT degree, count(*) AS nodes FROM {_DEGREE} GROUP BY 1")
def node_degree_distribution(spark, d):
    return N.degrees(V.edges(spark, d)).groupBy("degree").agg(F.count(F.lit(1)).alias("nodes"))


@query(f"SELECT segment_id FROM edges WHERE segment_id NOT IN (SELECT segment_id FROM {_WITH} WHERE (du = 1 AND dv >= 3) OR (dv = 1 AND du >= 3))")
def dangling_prune(spark, d):
    e = V.edges(spark, d)
    return e.join(N.dangling(e).select("segment_id"), "segment_id", "left_anti").select("segment_id")


@query(f"SELECT segment_id FROM {_WITH} WHERE du > 1 AND dv > 1")
def chain_segments(spark, d):
    return N.chain_segments(V.edges(spark, d)).select("segment_id")


@query("SELECT concat(x1::DECIMAL(18,7), '_', y1::DECIMAL(18,7)) AS node, count(*) AS n FROM edges GROUP BY 1")
def endpoint_hash_nodes(spark, d):
    e = V.edges(spark, d)
    return e.groupBy(N.node_key(F.col("x1").cast("decimal(18,7)"), F.col("y1").cast("decimal(18,7)")).alias("node")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT segment_id FROM edges WHERE lower(highway) IN ('primary', 'secondary', 'primary_link', 'secondary_link')")
def road_class_filter(spark, d):
    return V.edges(spark, d).where(F.lower("highway").isin("primary", "secondary", "primary_link", "secondary_link")).select("segment_id")


@query(f"""
    SELECT segment_id, CASE WHEN du > 1 AND dv > 1 AND length < 120 AND u % 3 = 0 THEN 'chain' WHEN lower(highway) IN ('primary', 'secondary', 'primary_link', 'secondary_link') THEN 'major' WHEN n < 8 THEN 'low_volume' ELSE 'general' END AS category
    FROM {_WITH} e LEFT JOIN (SELECT segment_id, count(*) AS n FROM networks GROUP BY 1) USING (segment_id)
""")
def category_priority(spark, d):
    e = N.with_degrees(V.edges(spark, d)).join(V.networks(spark, d).groupBy("segment_id").agg(F.count(F.lit(1)).alias("n")), "segment_id", "left")
    name = F.when(F.expr("du > 1 and dv > 1 and length < 120 and u % 3 = 0"), "chain").when(F.lower("highway").isin("primary", "secondary", "primary_link", "secondary_link"), "major").when(F.col("n") < 8, "low_volume").otherwise("general")
    return e.select("segment_id", name.alias("category"))


@query("SELECT segment_id, count(DISTINCT rec) AS files FROM networks WHERE (u + rec) % 3 <> 0 GROUP BY 1 HAVING count(DISTINCT rec) > 5")
def majority_removal(spark, d):
    bad = V.networks(spark, d).where("(u + rec) % 3 <> 0")
    return bad.groupBy("segment_id").agg(F.countDistinct("rec").alias("files")).where("files > 5")


_COMPONENTS = "r(node, root) AS (SELECT node, min(reached) FROM reach GROUP BY 1)"
_REACH = """WITH RECURSIVE l AS ({links}), reach(node, reached) AS (SELECT a, a FROM l UNION SELECT b, b FROM l UNION SELECT r.node, CASE WHEN l.a = r.reached THEN l.b ELSE l.a END FROM reach r JOIN l ON r.reached IN (l.a, l.b)), """ + _COMPONENTS
_LINKS = "SELECT u AS a, v AS b FROM edges WHERE kind = 'd' OR kind = 'h' AND (u + v) % 3 = 0"


@query(_REACH.format(links=_LINKS) + " SELECT node, root FROM r")
def connected_components(spark, d):
    e = V.edges(spark, d).where("kind = 'd' or kind = 'h' and (u + v) % 3 = 0")
    return N.components(e.select(F.col("u").alias("a"), F.col("v").alias("b")))


@query(_REACH.format(links=_LINKS) + " SELECT e.segment_id FROM edges e JOIN r ON r.node = e.u JOIN (SELECT root, count(*) AS n FROM r GROUP BY 1) USING (root) WHERE (kind = 'd' OR kind = 'h' AND (u + v) % 3 = 0) AND n > 2")
def isolated_component_removal(spark, d):
    e = V.edges(spark, d).where("kind = 'd' or kind = 'h' and (u + v) % 3 = 0")
    return N.with_component(e).where("component_nodes > 2").select("segment_id")


@query(_REACH.format(links=_LINKS) + """, m AS (SELECT e.segment_id, root FROM edges e JOIN r ON r.node = e.u WHERE kind = 'd' OR kind = 'h' AND (u + v) % 3 = 0), ok AS (SELECT segment_id FROM edges WHERE u % 9 = 0)
    SELECT segment_id FROM ok UNION SELECT segment_id FROM m WHERE root IN (SELECT root FROM m WHERE segment_id IN (SELECT segment_id FROM ok))""")
def component_rescue(spark, d):
    e = V.edges(spark, d)
    return N.rescued(e.where("u % 9 = 0"), e.where("kind = 'd' or kind = 'h' and (u + v) % 3 = 0"))


def _fixpoint_sql() -> str:
    steps = ["v0 AS (SELECT segment_id FROM edges WHERE (u * 7 + v * 5) % 9 < 2)", "rel AS (SELECT a.segment_id AS src, b.segment_id AS dst FROM edges a JOIN edges b ON a.v = b.u AND a.u <> b.v)"]
    for i in range(12):
        steps.append(f"v{i + 1} AS MATERIALIZED (SELECT segment_id FROM v{i} WHERE segment_id IN (SELECT unnest([src, dst]) FROM rel WHERE src IN (SELECT segment_id FROM v{i}) AND dst IN (SELECT segment_id FROM v{i}) AND src <> dst))")
    return "WITH " + ", ".join(steps) + " SELECT segment_id FROM v12"


@query(_fixpoint_sql())
def fixpoint_isolated_removal(spark, d):
    e = V.edges(spark, d)
    rel = e.select(F.col("segment_id").alias("src"), "u", F.col("v").alias("n")).join(e.select(F.col("segment_id").alias("dst"), F.col("u").alias("n"), F.col("v").alias("w")), "n").where("u <> w")
    return N.prune_unconnected(e.where("(u * 7 + v * 5) % 9 < 2"), rel.select("src", "dst"))


def _spread_sql(rounds: int) -> str:
    steps = ["p0 AS (SELECT segment_id, u, v, name, CASE WHEN lanes > 1 AND (u + 2 * v) % 3 <> 0 THEN lanes END AS lanes FROM edges)"]
    for i in range(rounds):
        steps.append(f"p{i + 1} AS MATERIALIZED (SELECT a.segment_id, a.u, a.v, a.name, coalesce(a.lanes, max(b.lanes)) AS lanes FROM p{i} a LEFT JOIN p{i} b ON a.lanes IS NULL AND b.lanes IS NOT NULL AND a.name = b.name AND (a.u = b.u OR a.u = b.v OR a.v = b.u OR a.v = b.v) GROUP BY a.segment_id, a.u, a.v, a.name, a.lanes)")
    return "WITH " + ", ".join(steps) + f" SELECT segment_id, lanes FROM p{rounds}"


@query(_spread_sql(10))
def lane_propagation(spark, d):
    e = V.edges(spark, d).withColumn("lanes", F.when(F.expr("lanes > 1 and (u + 2 * v) % 3 <> 0"), F.col("lanes")))
    return N.spread_lanes(e, 10).select("segment_id", "lanes")


# --- lanes ----------------------------------------------------------------------------


@query("SELECT segment_id, round_even(avg(lanes), 0)::BIGINT AS lanes, count(*) AS n FROM votes GROUP BY 1")
def avg_lanes_bankers(spark, d):
    return V.votes(spark, d).groupBy("segment_id").agg(F.bround(F.avg("lanes"), 0).cast("bigint").alias("lanes"), F.count(F.lit(1)).alias("n"))


_CONSENSUS = """
    v AS (SELECT segment_id, rec, pos, CASE WHEN segment_id::INT % 3 = 0 THEN 2 ELSE lanes END AS lanes FROM votes), o AS (SELECT DISTINCT segment_id, 1 + segment_id::BIGINT % 4 AS osm FROM votes WHERE segment_id::INT % 3 <> 1),
    c AS (SELECT segment_id, lanes, count(*) AS n, min((rec, pos)) AS first FROM v GROUP BY 1, 2), b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY segment_id ORDER BY n DESC, first) = 1),
    t AS (SELECT segment_id, count(*) AS total, avg(lanes) AS mean FROM v GROUP BY 1),
    k AS (SELECT segment_id, CASE WHEN n / total >= 0.8 THEN b.lanes WHEN osm IS NOT NULL THEN osm ELSE round_even(mean, 0) END::BIGINT AS lanes, CASE WHEN n / total >= 0.8 THEN 'consensus' WHEN osm IS NOT NULL THEN 'defined' ELSE 'mean' END AS reason
          FROM t JOIN b USING (segment_id) LEFT JOIN o USING (segment_id))
"""


def _consensus(spark, d):
    v = V.votes(spark, d).withColumn("lanes", F.when(F.col("segment_id").cast("int") % 3 == 0, F.lit(2).cast("bigint")).otherwise(F.col("lanes")))
    osm = v.where(F.col("segment_id").cast("int") % 3 != 1).select("segment_id").distinct().select("segment_id", (1 + F.col("segment_id").cast("bigint") % 4).alias("lanes"))
    return stats.consensus(v, "segment_id", "lanes", ["rec", "pos"], osm, 0.8)


@query(f"WITH {_CONSENSUS} SELECT segment_id, lanes, reason FROM k")
def lane_consensus(spark, d):
    return _consensus(spark, d)


@query(f"WITH {_CONSENSUS} SELECT reason, lanes, count(*) AS n FROM k GROUP BY 1, 2")
def lane_decisions(spark, d):
    return _consensus(spark, d).groupBy("reason", "lanes").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT segment_id, lanes AS detected, osm FROM (SELECT segment_id, round_even(avg(lanes), 0)::BIGINT AS lanes, CASE WHEN segment_id::INT % 5 <> 0 THEN 1 + segment_id::BIGINT % 4 END AS osm FROM votes GROUP BY 1) WHERE lanes IS DISTINCT FROM osm")
def lane_mismatch_report(spark, d):
    out = V.votes(spark, d).groupBy("segment_id").agg(F.bround(F.avg("lanes"), 0).cast("bigint").alias("detected"))
    out = out.withColumn("osm", F.when(F.col("segment_id").cast("int") % 5 != 0, 1 + F.col("segment_id").cast("bigint") % 4))
    return out.where(~F.col("detected").eqNullSafe(F.col("osm")))


_BOUNDS = "b AS (SELECT segment_id, quantile_cont(y / 50, 0.02) AS lo, quantile_cont(y / 50, 0.98) AS hi FROM traj GROUP BY 1)"


@query(f"""
    WITH {_BOUNDS}, p AS (SELECT t.*, lo, hi, greatest(0, least(hi - lo, y / 50 - lo)) AS D, [0, (hi - lo) / 3, 2 * (hi - lo) / 3, hi - lo] AS bounds FROM traj t JOIN b USING (segment_id)),
    q AS (SELECT *, len(list_filter(bounds, lambda x: x <= D)) AS i FROM p)
    SELECT row_id, round(D, 4) AS D, greatest(1, least(3, i)) - 1 AS lane_index, (i = 0 OR i = 4) AND x > 20 AS is_outlier FROM q
""")
def lane_digitize(spark, d):
    traj = V.traj(spark, d).withColumn("off", F.col("y") / 50)
    ends = traj.groupBy("segment_id").agg(F.percentile("off", 0.02).alias("lo"), F.percentile("off", 0.98).alias("hi"))
    width = F.col("hi") - F.col("lo")
    bounds = ends.withColumn("bounds", F.array(F.lit(0.0), width / 3, 2 * width / 3, width))
    placed = traj.join(ends, "segment_id").withColumn("D", S.clip(F.col("off") - F.col("lo"), 0.0, F.col("hi") - F.col("lo"))).drop("lo", "hi")
    out = stats.lanes_on(placed, "segment_id", "D", bounds)
    # points at a controller are never outliers
    return out.select("row_id", F.round("D", 4).alias("D"), F.col("lane_index").cast("bigint").alias("lane_index"), (F.col("is_outside") & (F.col("x") > 20)).alias("is_outlier"))


@query("""
    WITH c AS (SELECT segment_id, count(*) FILTER (speed > 7.5 AND y < 500) AS a, count(*) FILTER (speed > 5 AND y < 500) AS b, count(*) FILTER (speed > 3 AND y < 500) AS e FROM traj GROUP BY 1)
    SELECT row_id FROM traj t JOIN c USING (segment_id) WHERE CASE WHEN a >= 50 THEN speed > 7.5 AND y < 500 WHEN b >= 50 THEN speed > 5 AND y < 500 WHEN e >= 50 THEN speed > 3 AND y < 500 ELSE true END
""")
def confident_points(spark, d):
    return stats.confident(V.traj(spark, d), "segment_id", "speed", "y", [7.5, 5.0, 3.0], 50, 500.0).select("row_id")


@query("""
    SELECT e.segment_id, round(coalesce(p, CASE highway WHEN 'primary' THEN 16.7 WHEN 'secondary' THEN 13.9 END, 10), 4) AS speed
    FROM edges e LEFT JOIN (SELECT u * 100000 + u + 1 AS k, quantile_cont(value / 25, 0.95) AS p FROM (SELECT event_id % 50 AS u, value FROM events) GROUP BY 1) s ON s.k::VARCHAR = e.segment_id
""")
def empirical_speed_impute(spark, d):
    ev = V.table(spark, d, "events").select((F.col("event_id") % 50).alias("u"), "value")
    seen = ev.groupBy((F.col("u") * 100_000 + F.col("u") + 1).cast("string").alias("segment_id")).agg(F.percentile(F.col("value") / 25, 0.95).alias("p"))
    default = F.when(F.col("highway") == "primary", 16.7).when(F.col("highway") == "secondary", 13.9)
    return V.edges(spark, d).join(seen, "segment_id", "left").select("segment_id", F.round(F.coalesce("p", default, F.lit(10.0)), 4).alias("speed"))


@query("""
    WITH n AS (SELECT segment_id, count(DISTINCT track_id) AS n FROM (SELECT *, row_id % 23 AS g FROM traj) GROUP BY 1),
    b AS (SELECT *, concat(segment_id, row_id % 97) AS seg FROM traj), c AS (SELECT seg, count(DISTINCT track_id) AS n FROM b GROUP BY 1)
    SELECT count(*) AS points, count(*) FILTER (seg LIKE 'view%') AS by_blacklist, count(*) FILTER (seg NOT LIKE 'view%' AND n < 20) AS by_volume, count(*) FILTER (seg NOT LIKE 'view%' AND n >= 20) AS kept FROM b JOIN c USING (seg)
""")
def removed_points_report(spark, d):
    b = V.traj(spark, d).withColumn("seg", F.concat(F.col("segment_id"), F.col("row_id") % 97))
    c = b.groupBy("seg").agg(F.countDistinct("track_id").alias("n"))
    black = F.col("seg").startswith("view")
    return b.join(c, "seg").agg(F.count(F.lit(1)).alias("points"), F.count_if(black).alias("by_blacklist"), F.count_if(~black & (F.col("n") < 20)).alias("by_volume"), F.count_if(~black & (F.col("n") >= 20)).alias("kept"))


@query("SELECT seg AS segment_id FROM (SELECT *, concat(segment_id, row_id % 97) AS seg FROM traj) WHERE seg NOT LIKE 'view%' GROUP BY 1 HAVING count(DISTINCT track_id) >= 20")
def volume_filter(spark, d):
    b = V.traj(spark, d).withColumn("segment_id", F.concat(F.col("segment_id"), F.col("row_id") % 97))
    return b.where(~F.col("segment_id").startswith("view")).groupBy("segment_id").agg(F.countDistinct("track_id").alias("n")).where("n >= 20").select("segment_id")


@query("""
    SELECT row_id FROM (SELECT *, max(t_proj / seg_length) OVER w - min(t_proj / seg_length) OVER w AS span, max(seg_length) OVER w AS len FROM traj WINDOW w AS (PARTITION BY track_id, segment_id)) WHERE len < 160 OR span >= 0.4
""")
def full_traversal_filter(spark, d):
    t = V.traj(spark, d)
    span = t.groupBy("track_id", "segment_id").agg((F.max(F.col("t_proj") / F.col("seg_length")) - F.min(F.col("t_proj") / F.col("seg_length"))).alias("span"), F.max("seg_length").alias("len"))
    return t.join(span.where("len < 160 or span >= 0.4"), ["track_id", "segment_id"], "left_semi").select("row_id")
