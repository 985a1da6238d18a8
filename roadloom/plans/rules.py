"""Queries for single rules: lookups, predicates, counts and reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import graph as G
from ..operators import network as N
from ..operators import spatial as P
from ..operators import timeseries as T
from ..operators import udf as U
from ..sources import readers as R
from . import views as V
from .base import book
from .graphs import _DELTA, _PATHS, DEPTH
from .sources import _lines
from .traversal import _CHECKED, _checked

QUERIES, SQL, query = book()


@query("SELECT row_id, trunc(t * 1000)::BIGINT AS ms FROM traj")
def time_milliseconds(spark, d):
    return V.traj(spark, d).select("row_id", S.milliseconds(F.col("t")).alias("ms"))


@query("SELECT row_id, round(t_proj / CASE WHEN row_id % 9 = 0 THEN 1.0 ELSE seg_length END, 6) AS prop_dist FROM traj")
def proportional_distance(spark, d):
    length = F.when(F.col("row_id") % 9 == 0, 0.0).otherwise(F.col("seg_length"))
    return V.traj(spark, d).select("row_id", F.round(F.col("t_proj") / F.when(length <= 0, 1.0).otherwise(length), 6).alias("prop_dist"))


@query("SELECT segment_id, CASE WHEN u % 4 = 3 THEN NULL ELSE highway END AS highway FROM edges")
def first_of_tags(spark, d):
    tags = F.when(F.col("u") % 4 == 3, F.array().cast("array<string>")).when(F.col("u") % 4 == 1, F.array("highway", "name")).otherwise(F.array("highway"))
    return V.edges(spark, d).select("segment_id", S.first_element(tags).alias("highway"))


_TAGS = "CASE u % 5 WHEN 0 THEN 'traffic_signals;stop' WHEN 1 THEN 'crossing' ELSE '' END"


@query(f"""
    SELECT DISTINCT u AS node, CASE WHEN {_TAGS} LIKE '%traffic_signals%' THEN 'highway' ELSE 'crossing' END AS kind FROM edges
    WHERE {_TAGS} LIKE '%traffic_signals%' OR u % 7 = 2 OR (u % 3 = 1 AND u % 2 = 0)
""")
def signal_nodes(spark, d):
    text = lambda c, v: F.when(F.expr(c), F.lit(v))
    tags = F.create_map(F.lit("highway"), F.expr(_TAGS), F.lit("crossing"), text("u % 7 = 2", "traffic_signals"), F.lit("crossing:signals"), F.when(F.expr("u % 3 = 1"), F.when(F.expr("u % 2 = 0"), "Yes").otherwise("no")))
    nodes = V.edges(spark, d).select("u").distinct().select("u", tags.alias("tags"))
    return nodes.where(S.is_signal(F.col("tags"))).select(F.col("u").alias("node"), F.when(F.col("tags")["highway"].contains("traffic_signals"), "highway").otherwise("crossing").alias("kind"))


@query("SELECT segment_id FROM edges WHERE u % 6 IN (0, 5)")
def semantic_tags(spark, d):
    tag = F.element_at(F.array(F.lit("roundabout"), F.lit("None"), F.lit(" nan "), F.lit("<NA>"), F.lit("no"), F.lit("circular")), (F.col("u") % 6 + 1).cast("int"))
    return V.edges(spark, d).where(S.is_tagged(F.when(F.col("u") % 12 != 7, tag))).select("segment_id")


@query("SELECT segment_id, lanes FROM edges WHERE u % 4 > 1 AND lanes > 1")
def laned_segments(spark, d):
    """Segments with a name and a lane count that is known."""
    e = V.edges(spark, d)
    raw = F.when(F.col("u") % 4 == 0, " ").when(F.col("u") % 4 == 1, "NaN").otherwise(F.col("segment_id"))
    return e.withColumn("segment_id", raw).where(S.is_named(F.col("segment_id"))).join(e.where("lanes > 1").select("segment_id", F.col("lanes").alias("known")), "segment_id").select("segment_id", F.col("known").alias("lanes"))


@query("""
    WITH a AS (SELECT *, x - lag(x) OVER w AS dx, y - lag(y) OVER w AS dy FROM traj WINDOW w AS (PARTITION BY track_id ORDER BY t, row_id)),
    b AS (SELECT row_id, (((degrees(atan2(dx, dy)) - length(segment_id) * 40 + 180) % 360 + 360) % 360 - 180) AS rel FROM a WHERE dx IS NOT NULL)
    SELECT row_id, round(rel, 4) AS rel_heading FROM b WHERE abs(rel) <= 90
""")
def heading_filter(spark, d):
    """Points that move along their segment's direction, within a right angle."""
    w = Window.partitionBy("track_id").orderBy("t", "row_id")
    step = lambda c: F.col(c) - F.lag(c).over(w)
    moved = V.traj(spark, d).select("row_id", "segment_id", S.azimuth(step("x"), step("y")).alias("az"))
    out = moved.withColumn("rel_heading", S.turned(F.col("az"), F.length("segment_id") * 40.0))
    return out.where(F.abs("rel_heading") <= 90).select("row_id", F.round("rel_heading", 4).alias("rel_heading"))


@query("SELECT row_id FROM traj WHERE row_id % 97 NOT IN (SELECT u FROM edges WHERE is_junction)")
def junction_points_dropped(spark, d):
    inner = V.edges(spark, d).where("is_junction").select(F.col("u").alias("at")).distinct()
    return V.traj(spark, d).select("row_id", (F.col("row_id") % 97).alias("at")).join(inner, "at", "left_anti").select("row_id")


@query("""
    WITH e AS (SELECT u, v, segment_id, lanes, highway, 0 AS pos FROM edges UNION ALL SELECT u, v, concat(segment_id, 'x'), lanes + 3, 'service', 1 FROM edges WHERE u % 3 = 0),
    l AS (SELECT u, v, arg_max(segment_id, pos) AS segment_id, arg_max(lanes, pos) AS lanes, arg_max(highway, pos) AS highway FROM e GROUP BY 1, 2)
    SELECT row_id, coalesce(segment_id, '') AS segment_id, coalesce(lanes, 2) AS lanes, coalesce(highway, 'unknown') AS highway FROM (SELECT row_id, row_id % 120 AS u, row_id % 120 + row_id % 13 AS v FROM traj) p LEFT JOIN l ON l.u = p.u AND l.v = p.v
""")
def edge_lookup(spark, d):
    e = V.edges(spark, d).select("u", "v", "segment_id", "lanes", "highway", F.lit(0).alias("pos"))
    twin = e.where("u % 3 = 0").select("u", "v", F.concat("segment_id", F.lit("x")), F.col("lanes") + 3, F.lit("service"), F.lit(1))
    points = V.traj(spark, d).select("row_id", (F.col("row_id") % 120).alias("u"), (F.col("row_id") % 120 + F.col("row_id") % 13).alias("v"))
    return P.edge_attributes(points, e.union(twin), ["pos"]).select("row_id", "segment_id", F.col("lanes").cast("bigint").alias("lanes"), "highway")


@query("""
    WITH s AS (SELECT s_suppkey AS id, ((s_suppkey * 37) % 1000)::DOUBLE AS x0, ((s_suppkey * 91) % 1000)::DOUBLE AS y0, (20 + s_suppkey % 30)::DOUBLE AS w, (15 + s_suppkey % 20)::DOUBLE AS h FROM supplier)
    SELECT row_id, id AS polygon_id FROM traj JOIN s ON sqrt(greatest(x0 - x, 0, x - x0 - w) ** 2 + greatest(y0 - y, 0, y - y0 - h) ** 2) <= 5
""")
def near_polygon_points(spark, d):
    k = F.col("s_suppkey")
    x, y, w, h = ((k * 37) % 1000).cast("double"), ((k * 91) % 1000).cast("double"), (20 + k % 30).cast("double"), (15 + k % 20).cast("double")
    corner = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    rings = V.table(spark, d, "supplier").select(k.alias("polygon_id"), F.array(corner(x, y), corner(x + w, y), corner(x + w, y + h), corner(x, y + h), corner(x, y)).alias("ring"))
    return P.near_polygons(V.traj(spark, d).select("row_id", "x", "y"), rings, 5.0, 100.0).select("row_id", "polygon_id")


@query("SELECT arg_max(segment_id, (red, -segment_id::BIGINT)) AS segment_id, round(max(red), 4) AS red_light FROM (SELECT (track_id::BIGINT % 200)::VARCHAR AS segment_id, quantile_cont(stopping_duration, 0.95) AS red FROM traversals GROUP BY 1)")
def longest_red_light(spark, d):
    red = V.traversals(spark, d).groupBy((F.col("track_id").cast("bigint") % 200).alias("id")).agg(F.percentile("stopping_duration", 0.95).alias("red"))
    top = red.agg(F.max(F.struct("red", (-F.col("id")).alias("least"))).alias("m"))
    return top.select((-F.col("m.least")).cast("string").alias("segment_id"), F.round("m.red", 4).alias("red_light"))


@query("""
    WITH v AS (SELECT segment_id, round_even(avg(lanes), 0)::BIGINT AS new, 1 + segment_id::BIGINT % 4 AS old FROM votes GROUP BY 1)
    SELECT count(*) AS segments, count(*) FILTER (new <> old) AS changed, (SELECT count(*) FILTER (is_outlier) FROM traj) AS flagged FROM v
""")
def lane_change_counts(spark, d):
    v = V.votes(spark, d).groupBy("segment_id").agg(F.bround(F.avg("lanes"), 0).cast("bigint").alias("new"))
    counts = v.agg(F.count(F.lit(1)).alias("segments"), F.count_if(F.col("new") != 1 + F.col("segment_id").cast("bigint") % 4).alias("changed"), F.lit(0).cast("bigint").alias("flagged"))
    flagged = V.traj(spark, d).agg(F.lit(0).cast("bigint").alias("segments"), F.lit(0).cast("bigint").alias("changed"), F.count_if("is_outlier").alias("flagged"))
    return counts.union(flagged).agg(*[F.sum(c).alias(c) for c in counts.columns])


@query(f"""
    WITH {_CHECKED}, fl AS (SELECT track_id::BIGINT % 7 AS rec, avg(share) AS mean_share, max(share) AS top_share, avg(ostop) AS mean_stop, max(ostop) AS top_stop FROM k GROUP BY 1)
    SELECT count(*) AS files, round(avg(mean_share), 6) AS mean_share, round(avg(top_share), 6) AS mean_top_share, round(avg(mean_stop), 3) AS mean_stop, round(avg(top_stop), 3) AS mean_top_stop FROM fl
""")
def file_outlier_means(spark, d):
    """Means over recordings of their mean and greatest shares of outliers and stops."""
    run = _checked(spark, d).groupBy("track_id", "run").agg(F.first("outlier_share").alias("share"), F.first("outlier_stop").alias("stop"))
    per = run.groupBy((F.col("track_id").cast("bigint") % 7).alias("rec")).agg(F.avg("share").alias("a"), F.max("share").alias("b"), F.avg("stop").alias("c"), F.max("stop").alias("e"))
    mean = lambda c, n, k: F.round(F.avg(c), k).alias(n)
    return per.agg(F.count(F.lit(1)).alias("files"), mean("a", "mean_share", 6), mean("b", "mean_top_share", 6), mean("c", "mean_stop", 3), mean("e", "mean_top_stop", 3))


@query("SELECT CASE WHEN is_junction THEN 'junction' WHEN lower(highway) IN ('primary', 'secondary') THEN 'major' ELSE 'general' END AS category, rec, count(*) AS segments, count(*) FILTER (lanes > 2) AS wide, count(DISTINCT name) AS names FROM networks GROUP BY 1, 2")
def category_counts(spark, d):
    name = F.when(F.col("is_junction"), "junction").when(F.lower("highway").isin("primary", "secondary"), "major").otherwise("general")
    out = V.networks(spark, d).groupBy(name.alias("category"), F.col("rec").cast("bigint").alias("rec"))
    return out.agg(F.count(F.lit(1)).alias("segments"), F.count_if(F.col("lanes") > 2).alias("wide"), F.countDistinct("name").alias("names"))


@query("SELECT u, v, arg_min(segment_id, (rec, segment_id)) AS segment_id, min(rec) AS rec FROM networks WHERE rec % 3 <> 0 OR u % 2 = 0 GROUP BY 1, 2")
def union_dedupe_by_nodes(spark, d):
    n = V.networks(spark, d).where("rec % 3 <> 0 or u % 2 = 0")
    return N.first_of(n, ["u", "v"], ["rec", "segment_id"]).select("u", "v", "segment_id", F.col("rec").cast("bigint").alias("rec"))


_GAP = "86400 * (1 + 0.1 * ((row_id * 2654435761 % 2001) / 1000.0 - 1))"


@query(f"""
    WITH RECURSIVE o AS (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY t, row_id) AS rn, ({_GAP})::DOUBLE AS gap FROM traj),
    r AS (SELECT track_id, rn, row_id, t AS last, true AS keep FROM o WHERE rn = 1
          UNION ALL SELECT o.track_id, o.rn, o.row_id, CASE WHEN o.t - r.last >= o.gap THEN o.t ELSE r.last END, o.t - r.last >= o.gap FROM r JOIN o ON o.track_id = r.track_id AND o.rn = r.rn + 1)
    SELECT track_id, row_id FROM r WHERE keep
""")
def min_gap_jittered(spark, d):
    return T.min_gap(V.traj(spark, d), ["track_id"], "t", "row_id", F.expr(_GAP).cast("double")).select("track_id", "row_id")


@query("SELECT greatest(1, floor(0.05 * count(*)))::BIGINT AS lines FROM (SELECT DISTINCT track_id FROM traj) WHERE track_id::INT % 5 <> 0")
def trial_lines(spark, d):
    return R.limited_test(_lines(spark, d)).agg(F.count(F.lit(1)).alias("lines"))


@query(f"""
    WITH RECURSIVE {_PATHS}, g AS (SELECT src, here AS dst, arg_min(path, (n, path)) AS chain FROM c WHERE done GROUP BY 1, 2),
    b AS (SELECT g.* FROM g JOIN h x ON x.segment_id = g.src JOIN h y ON y.segment_id = g.dst WHERE x.u <> y.v AND abs({_DELTA.format(a="x.hd", b="y.hd")}) <= 25)
    SELECT src, 'to' AS relation, dst, array_to_string(chain, '>') AS chain FROM b UNION ALL SELECT dst, 'from', src, array_to_string(list_reverse(chain), '>') FROM b
""")
def junction_rewiring(spark, d):
    return G.rewired(G.headed(V.edges(spark, d)), DEPTH).withColumn("chain", F.array_join("chain", ">"))


@query("""
    WITH RECURSIVE j AS (SELECT DISTINCT least(u, v) AS a, greatest(u, v) AS b FROM edges WHERE is_junction),
    walk(a, b, node) AS (SELECT a, b, b FROM j UNION SELECT w.a, w.b, CASE WHEN j.a = w.node THEN j.b ELSE j.a END FROM walk w JOIN j ON w.node IN (j.a, j.b) AND NOT (j.a = w.a AND j.b = w.b))
    SELECT segment_id, EXISTS (SELECT 1 FROM walk w WHERE w.a = least(e.u, e.v) AND w.b = greatest(e.u, e.v) AND w.node = w.a) AS is_closed FROM edges e WHERE is_junction
""")
def closed_shapes(spark, d):
    return U.closed_shapes(N.with_component(V.edges(spark, d).where("is_junction")), "root")
