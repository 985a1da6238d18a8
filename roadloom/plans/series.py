"""Queries over tracks and traversals: order-dependent operators and their aggregates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..config import Matching
from ..functions import scalar as S
from ..operators import stats, timeseries as T
from . import views as V
from .base import book

QUERIES, SQL, query = book()

DAY = 86_400.0
R4 = lambda c: F.round(c, 4)


def _limits(spark, d):
    """Start values by segment: the 15th percentile of both speeds."""
    return V.traversals(spark, d).groupBy("segment_id").agg(F.percentile("temporal_mean_speed", 0.15).alias("temporal_threshold"), F.percentile("spatial_mean_speed", 0.15).alias("spatial_threshold"))


_STATES = """
    WITH RECURSIVE lim AS (SELECT segment_id, quantile_cont(temporal_mean_speed, 0.15) AS tt, quantile_cont(spatial_mean_speed, 0.15) AS st FROM traversals GROUP BY 1),
    o AS (SELECT *, row_number() OVER w AS rn, coalesce(timestamp - lag(timestamp) OVER w, 300.0) AS dt FROM traversals WINDOW w AS (PARTITION BY segment_id ORDER BY timestamp, row_id)),
    r AS (SELECT o.segment_id, o.rn, o.row_id, o.timestamp, o.dt, tt + (1 - exp(-dt / 86400)) * (temporal_mean_speed - tt) AS et, st + (1 - exp(-dt / 86400)) * (spatial_mean_speed - st) AS es
          FROM o JOIN lim USING (segment_id) WHERE rn = 1
          UNION ALL SELECT o.segment_id, o.rn, o.row_id, o.timestamp, o.dt, et + (1 - exp(-o.dt / 86400)) * (temporal_mean_speed - et), es + (1 - exp(-o.dt / 86400)) * (spatial_mean_speed - es)
          FROM r JOIN o ON o.segment_id = r.segment_id AND o.rn = r.rn + 1)
"""


def _states(spark, d):
    seeds = _limits(spark, d).withColumnsRenamed({"temporal_threshold": "ema_temporal_speed", "spatial_threshold": "ema_spatial_speed"})
    values = {"temporal_mean_speed": "ema_temporal_speed", "spatial_mean_speed": "ema_spatial_speed"}
    return T.tema(V.traversals(spark, d), "segment_id", "timestamp", "row_id", values, seeds, DAY, 300.0, 60 * DAY)


@query(_STATES + "SELECT segment_id, row_id, timestamp, round(et, 4) AS ema_temporal_speed, round(es, 4) AS ema_spatial_speed, dt AS time_since_last_update FROM r")
def tema_states(spark, d):
    return _states(spark, d).select("segment_id", "row_id", "timestamp", R4("ema_temporal_speed").alias("ema_temporal_speed"), R4("ema_spatial_speed").alias("ema_spatial_speed"), F.col("dt").alias("time_since_last_update"))


@query(_STATES + """
    SELECT segment_id, row_id, round(CASE WHEN tt + st <= 0 THEN 0 ELSE greatest(0, least(1, (greatest(0, tt - et) + greatest(0, st - es)) / (tt + st))) END, 4) AS recalculated_rtsm
    FROM r JOIN lim USING (segment_id)
""")
def tema_rtsm(spark, d):
    out = T.with_rtsm(_states(spark, d), _limits(spark, d), "segment_id", "ema_temporal_speed", "ema_spatial_speed")
    return out.select("segment_id", "row_id", R4("recalculated_rtsm").alias("recalculated_rtsm"))


def _greedy(view: str, key: str, t: str, gap: float) -> str:
    return f"""
    WITH RECURSIVE o AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {t}, row_id) AS rn FROM {view}),
    r AS (SELECT {key}, rn, row_id, {t} AS last, true AS keep FROM o WHERE rn = 1
          UNION ALL SELECT o.{key}, o.rn, o.row_id, CASE WHEN o.{t} - r.last >= {gap} THEN o.{t} ELSE r.last END, o.{t} - r.last >= {gap} FROM r JOIN o ON o.{key} = r.{key} AND o.rn = r.rn + 1)
    SELECT {key}, row_id FROM r WHERE keep"""


@query(_greedy("traj", "track_id", "t", 86400))
def min_gap_resample(spark, d):
    return T.min_gap(V.traj(spark, d), ["track_id"], "t", "row_id", DAY).select("track_id", "row_id")


@query(_greedy("traversals", "segment_id", "timestamp", 86400))
def min_gap_downsample(spark, d):
    return T.min_gap(V.traversals(spark, d), ["segment_id"], "timestamp", "row_id", DAY).select("segment_id", "row_id")


@query("""
    WITH k AS (SELECT track_id FROM traj GROUP BY 1 HAVING max(t) - min(t) >= 2000000 AND sum(seg_length) >= 10000 AND avg(speed) >= 2)
    SELECT t.track_id, t.row_id FROM traj t JOIN k USING (track_id) WHERE kind <> 'Motorcycle'
""")
def track_validity_filter(spark, d):
    return stats.valid_tracks(V.traj(spark, d), "track_id", "t", "seg_length", "speed", 2_000_000, 10_000, 2).where("kind <> 'Motorcycle'").select("track_id", "row_id")


_RUNS = "SELECT *, sum(new) OVER (PARTITION BY track_id ORDER BY t, row_id) AS run FROM (SELECT *, CASE WHEN segment_id IS NOT DISTINCT FROM lag(segment_id) OVER w THEN 0 ELSE 1 END AS new FROM traj WINDOW w AS (PARTITION BY track_id ORDER BY t, row_id))"


@query(f"SELECT track_id, row_id, run::BIGINT AS run FROM ({_RUNS})")
def run_segmentation(spark, d):
    return T.runs(V.traj(spark, d), ["track_id"], ["t", "row_id"], "segment_id").select("track_id", "row_id", "run")


@query("""
    WITH a AS (SELECT *, speed < 8 AS slow FROM traj),
    b AS (SELECT *, CASE WHEN slow IS NOT DISTINCT FROM lag(slow) OVER (PARTITION BY track_id ORDER BY t, row_id) THEN 0 ELSE 1 END AS new FROM a),
    c AS (SELECT *, sum(new) OVER (PARTITION BY track_id ORDER BY t, row_id) AS run FROM b)
    SELECT track_id, row_id, slow AND max(t) OVER w - min(t) OVER w >= 86400 AS is_parked FROM c WINDOW w AS (PARTITION BY track_id, run)
""")
def parked_points(spark, d):
    return T.parked(V.traj(spark, d), ["track_id"], "t", "row_id", "speed", 8.0, DAY).select("track_id", "row_id", "is_parked")


@query("""
    WITH a AS (SELECT *, speed < 8 AS slow, lag(speed < 8) OVER w AS before, t - lag(t) OVER w AS dt FROM traj WINDOW w AS (PARTITION BY track_id ORDER BY t, row_id)),
    b AS (SELECT *, slow AND coalesce(before, false) AS both_slow FROM a),
    c AS (SELECT *, sum(CASE WHEN both_slow THEN 0 ELSE 1 END) OVER (PARTITION BY track_id ORDER BY t, row_id) AS n FROM b),
    s AS (SELECT track_id, max(total) AS m FROM (SELECT track_id, n, sum(dt) AS total FROM c WHERE both_slow GROUP BY 1, 2) GROUP BY 1)
    SELECT DISTINCT t.track_id, round(coalesce(m, 0), 4) AS longest_stop FROM traj t LEFT JOIN s USING (track_id)
""")
def longest_stop(spark, d):
    return T.longest_stop(V.traj(spark, d), ["track_id"], "t", "row_id", F.col("speed") < 8).select("track_id", R4("longest_stop").alias("longest_stop"))


@query("SELECT track_id, row_id FROM (SELECT *, max(t_proj) OVER (PARTITION BY track_id ORDER BY t, row_id) AS top FROM traj) WHERE t_proj >= top")
def monotone_filter(spark, d):
    return T.monotone(V.traj(spark, d), ["track_id"], ["t", "row_id"], "t_proj").select("track_id", "row_id")


@query("""
    WITH RECURSIVE o AS (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY t, row_id) AS rn FROM traj),
    r AS (SELECT track_id, rn, row_id, t_proj AS x FROM o WHERE rn = 1
          UNION ALL SELECT o.track_id, o.rn, o.row_id, greatest(o.t_proj, r.x + 0.001) FROM r JOIN o ON o.track_id = r.track_id AND o.rn = r.rn + 1)
    SELECT track_id, row_id, round(x, 4) AS station FROM r
""")
def monotone_repair(spark, d):
    return T.repaired(V.traj(spark, d), ["track_id"], ["t", "row_id"], "t_proj", 0.001, "station").select("track_id", "row_id", R4("station").alias("station"))


@query("""
    SELECT track_id, coalesce(max(dt), 0) > 172800 AS invalid_gap, count(*) AS n FROM (SELECT *, t - lag(t) OVER (PARTITION BY track_id ORDER BY t, row_id) AS dt FROM traj) GROUP BY 1
""")
def gap_check_invalid(spark, d):
    w = Window.partitionBy("track_id").orderBy("t", "row_id")
    out = V.traj(spark, d).withColumn("dt", F.col("t") - F.lag("t").over(w))
    return out.groupBy("track_id").agg((F.coalesce(F.max("dt"), F.lit(0.0)) > 172_800).alias("invalid_gap"), F.count(F.lit(1)).alias("n"))


@query("""
    WITH a AS (SELECT *, lag(t_proj) OVER w AS p, lead(t_proj) OVER w AS q FROM traj WINDOW w AS (PARTITION BY track_id, segment_id ORDER BY t_proj, row_id)),
    b AS (SELECT *, greatest(0, least(seg_length, coalesce((t_proj + q) / 2, seg_length))) - greatest(0, least(seg_length, coalesce((p + t_proj) / 2, 0))) AS width FROM a)
    SELECT track_id, segment_id, round(CASE WHEN count(*) = 1 THEN max(is_outlier::INT)::DOUBLE ELSE sum(CASE WHEN is_outlier THEN width ELSE 0 END) / max(seg_length) END, 8) AS outlier_share FROM b GROUP BY 1, 2
""")
def voronoi_outlier_ratio(spark, d):
    return T.outlier_share(V.traj(spark, d), ["track_id", "segment_id"], "t_proj", "row_id", "is_outlier", "seg_length").select("track_id", "segment_id", F.round("outlier_share", 8).alias("outlier_share"))


_INTERP = """
    o AS (SELECT track_id, t, row_id, speed, row_number() OVER w * 0.001 + max(t_proj - rn * 0.001) OVER (PARTITION BY track_id ORDER BY t, row_id) AS x
          FROM (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY t, row_id) AS rn FROM traj) WINDOW w AS (PARTITION BY track_id ORDER BY t, row_id))
"""


def _at(y: str) -> str:
    """Interpolated y of o at q.x, by the neighbours on both sides."""
    return f"CASE WHEN q.x <= lo THEN y0 WHEN q.x >= hi THEN y1 ELSE (SELECT a.{y} + (q.x - a.x) / (b.x - a.x) * (b.{y} - a.{y}) FROM (SELECT x, {y} FROM o WHERE o.track_id = q.track_id AND o.x <= q.x ORDER BY x DESC LIMIT 1) a, (SELECT x, {y} FROM o WHERE o.track_id = q.track_id AND o.x > q.x ORDER BY x LIMIT 1) b) END"


@query(f"""
    WITH {_INTERP},
    e AS (SELECT track_id, min(x) AS lo, max(x) AS hi, min_by(t, x) AS y0, max_by(t, x) AS y1 FROM o GROUP BY 1),
    q AS (SELECT e.*, unnest([20.0, 60.0])::DOUBLE AS x FROM e),
    v AS (SELECT track_id, x, {_at("t")} AS v FROM q)
    SELECT track_id, round(max(v) FILTER (x = 60) - max(v) FILTER (x = 20), 2) AS traversal_time FROM v GROUP BY 1
""")
def interp_traversal_time(spark, d):
    points = T.repaired(V.traj(spark, d), ["track_id"], ["t", "row_id"], "t_proj", 0.001, "station")
    ends = points.select("track_id").distinct().select("track_id", F.explode(F.array(F.lit(20.0), F.lit(60.0))).alias("at"))
    got = T.interpolated(points, ["track_id"], "station", "t", ends, "at", "value")
    return got.groupBy("track_id").agg(F.round(F.max(F.when(F.col("at") == 60, F.col("value"))) - F.max(F.when(F.col("at") == 20, F.col("value"))), 2).alias("traversal_time"))


@query(f"""
    WITH {_INTERP},
    e AS (SELECT track_id, min(x) AS lo, max(x) AS hi, min_by(speed, x) AS y0, max_by(speed, x) AS y1 FROM o GROUP BY 1),
    q AS (SELECT e.*, unnest(range(ceil(lo)::BIGINT, greatest(ceil(lo)::BIGINT, floor(hi - 10)::BIGINT) + 1, 10))::DOUBLE AS x FROM e),
    v AS (SELECT track_id, x, {_at("speed")} AS v FROM q WHERE hi - x >= 10)
    SELECT track_id, count(*) AS n, round(avg(v), 4) AS spatial_mean_speed FROM v GROUP BY 1
""")
def resampled_mean_speed(spark, d):
    points = T.repaired(V.traj(spark, d), ["track_id"], ["t", "row_id"], "t_proj", 0.001, "station")
    ends = points.groupBy("track_id").agg(F.min("station").alias("lo"), F.max("station").alias("hi")).where("hi - ceil(lo) >= 10")
    at = ends.select("track_id", F.explode(F.sequence(F.ceil("lo"), F.floor(F.col("hi") - 10), F.lit(10).cast("bigint"))).alias("at")).withColumn("at", F.col("at").cast("double"))
    got = T.interpolated(points, ["track_id"], "station", "speed", at, "at", "value")
    return got.groupBy("track_id").agg(F.count(F.lit(1)).alias("n"), R4(F.avg("value")).alias("spatial_mean_speed"))


@query(f"""
    WITH r AS ({_RUNS}), n AS (SELECT *, lag(seg_length - t_proj) OVER w AS pg, lag(run) OVER w AS pr, lead(t_proj) OVER w AS nt, lead(run) OVER w AS nr FROM r WINDOW w AS (PARTITION BY track_id ORDER BY t, row_id))
    SELECT track_id, run::BIGINT AS run, round(max(CASE WHEN pr <> run THEN -pg END), 4) AS station_before, round(max(CASE WHEN nr <> run THEN seg_length + nt END), 4) AS station_after FROM n GROUP BY 1, 2
""")
def run_neighbours(spark, d):
    return stats.run_neighbours(T.runs(V.traj(spark, d), ["track_id"], ["t", "row_id"], "segment_id"), ["track_id"], ["t", "row_id"], "run", "t_proj", "seg_length").select("track_id", "run", R4("station_before").alias("station_before"), R4("station_after").alias("station_after"))


@query("""
    WITH a AS (SELECT *, x - lag(x) OVER w AS dx, y - lag(y) OVER w AS dy, lead(x) OVER w - x AS dx2, lead(y) OVER w - y AS dy2 FROM traj WINDOW w AS (PARTITION BY track_id ORDER BY t, row_id))
    SELECT track_id, row_id, round(degrees(atan2(coalesce(dx, dx2, 0), coalesce(dy, dy2, 0))), 4) AS azimuth FROM a
""")
def azimuth_diff(spark, d):
    w = Window.partitionBy("track_id").orderBy("t", "row_id")
    step = lambda c: F.coalesce(F.col(c) - F.lag(c).over(w), F.lead(c).over(w) - F.col(c), F.lit(0.0))
    return V.traj(spark, d).select("track_id", "row_id", R4(S.azimuth(step("x"), step("y"))).alias("azimuth"))


@query("""
    WITH a AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py, lag(t) OVER w AS pt FROM traj WINDOW w AS (PARTITION BY track_id ORDER BY t, row_id)),
    s AS (SELECT segment_id, quantile_cont(speed, 0.85) AS free FROM traj GROUP BY 1)
    SELECT track_id, row_id, round(speed / coalesce(free, 10), 4) AS relative_ego_speed, round(sqrt((x - px) ** 2 + (y - py) ** 2), 4) AS step, round(t - pt, 4) AS dt,
           round(CASE WHEN pt IS NOT NULL THEN least(1, sqrt((x - px) ** 2 + (y - py) ** 2) / nullif((t - pt) * coalesce(free, 10), 0)) END, 6) AS ratio
    FROM a LEFT JOIN s USING (segment_id)
""")
def kinematics(spark, d):
    w = Window.partitionBy("track_id").orderBy("t", "row_id")
    traj = V.traj(spark, d)
    free = traj.groupBy("segment_id").agg(F.percentile("speed", 0.85).alias("free"))
    gone = F.hypot(F.col("x") - F.lag("x").over(w), F.col("y") - F.lag("y").over(w))
    dt = F.col("t") - F.lag("t").over(w)
    speed = F.coalesce("free", F.lit(10.0))
    out = traj.join(free, "segment_id", "left").withColumns({"gone": gone, "dt": dt})
    ratio = F.when(F.col("gone").isNotNull(), F.least(F.lit(1.0), F.try_divide(F.col("gone"), F.col("dt") * speed)))
    return out.select("track_id", "row_id", R4(F.try_divide(F.col("speed"), speed)).alias("relative_ego_speed"), R4("gone").alias("step"), R4("dt").alias("dt"), F.round(ratio, 6).alias("ratio"))


@query("""
    WITH f AS (SELECT segment_id AS folder, max(t) AS m FROM traj GROUP BY 1), o AS (SELECT folder, coalesce(sum(m) OVER (ORDER BY folder ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS shift FROM f)
    SELECT row_id, concat(track_id, '_', folder) AS track_id, floor(t + shift)::BIGINT AS t FROM traj JOIN o ON folder = segment_id
""")
def running_offset(spark, d):
    return stats.chained(V.traj(spark, d), "segment_id", "track_id", "t").select("row_id", "track_id", F.floor("t").alias("t"))


@query("""
    SELECT segment_id, total, invalid, round(invalid / total, 6) AS share FROM (SELECT track_id AS segment_id, count(*) AS total, count(*) FILTER (NOT valid) AS invalid FROM traversals GROUP BY 1)
    ORDER BY share DESC, total DESC, segment_id LIMIT 10
""")
def topk_invalid(spark, d):
    out = V.traversals(spark, d).groupBy(F.col("track_id").alias("segment_id")).agg(F.count(F.lit(1)).alias("total"), F.count_if(~F.col("valid")).alias("invalid"))
    return out.withColumn("share", F.round(F.col("invalid") / F.col("total"), 6)).orderBy(F.desc("share"), F.desc("total"), "segment_id").limit(10)


_THRESHOLDS = """
    t AS (SELECT segment_id, max(segment_length) AS len, count(*) FILTER (valid) AS n, count(*) FILTER (NOT valid) AS bad, max(traversal_time) FILTER (valid) AS longest,
                 quantile_cont(traversal_time, 0.05) FILTER (valid) AS p5, quantile_cont(stopping_duration, 0.95) FILTER (valid) AS p95 FROM traversals GROUP BY 1),
    a AS (SELECT *, CASE WHEN n > 1 AND longest > 2 THEN len / (p5 + p95) ELSE -1 END AS tt FROM t),
    b AS (SELECT a.segment_id, quantile_cont(spatial_mean_speed, 0.05) FILTER (temporal_mean_speed >= tt) AS st, quantile_cont(spatial_mean_speed, 0.85) FILTER (temporal_mean_speed >= tt) AS ff
          FROM a JOIN traversals v ON v.segment_id = a.segment_id AND v.valid GROUP BY 1)
"""


@query(f"""
    WITH {_THRESHOLDS}
    SELECT a.segment_id, round(tt, 4) AS temporal_threshold, round(CASE WHEN tt = -1 THEN -1 ELSE coalesce(st, -1) END, 4) AS spatial_threshold, round(CASE WHEN tt = -1 THEN -1 ELSE coalesce(ff, -1) END, 4) AS free_flow_speed,
           round(coalesce(p95, 0), 4) AS red_light_duration, n AS total_traversals, bad AS invalid_traversals FROM a LEFT JOIN b USING (segment_id)
""")
def segment_thresholds(spark, d):
    out = stats.thresholds(V.traversals(spark, d))
    return out.select("segment_id", *[R4(c).alias(c) for c in ("temporal_threshold", "spatial_threshold", "free_flow_speed", "red_light_duration")], "total_traversals", "invalid_traversals")


@query(f"""
    WITH {_THRESHOLDS}, l AS (SELECT a.segment_id, tt, CASE WHEN tt = -1 THEN -1 ELSE coalesce(st, -1) END AS st FROM a LEFT JOIN b USING (segment_id))
    SELECT v.row_id, round(CASE WHEN tt = -1 OR st = -1 THEN -1 WHEN tt + st = 0 THEN 0 WHEN temporal_mean_speed = -1 OR spatial_mean_speed = -1 THEN 1
           ELSE greatest(0, least(1, (greatest(0, tt - temporal_mean_speed) + greatest(0, st - spatial_mean_speed)) / (tt + st))) END, 4) AS rtsm
    FROM traversals v JOIN l USING (segment_id)
""")
def rtsm_quadrant(spark, d):
    v = V.traversals(spark, d)
    out = v.join(stats.thresholds(v).select("segment_id", "temporal_threshold", "spatial_threshold"), "segment_id")
    return out.select("row_id", R4(S.rtsm(F.col("temporal_mean_speed"), F.col("spatial_mean_speed"), F.col("temporal_threshold"), F.col("spatial_threshold"))).alias("rtsm"))


@query("""
    SELECT segment_id, round(quantile_cont(spatial_mean_speed, 0.05) FILTER (temporal_mean_speed >= 15), 4) AS p5, round(quantile_cont(spatial_mean_speed, 0.85) FILTER (temporal_mean_speed >= 15), 4) AS p85 FROM traversals GROUP BY 1
""")
def conditional_percentile(spark, d):
    fast = F.when(F.col("temporal_mean_speed") >= 15, F.col("spatial_mean_speed"))
    return V.traversals(spark, d).groupBy("segment_id").agg(R4(F.percentile(fast, 0.05)).alias("p5"), R4(F.percentile(fast, 0.85)).alias("p85"))


@query("""
    SELECT b AS bucket, track_id, min_by(row_id, (t, row_id)) AS row_id, round(min_by(speed, (t, row_id)), 4) AS speed FROM (SELECT *, floor(t / 86400) * 86400 AS b FROM traj) GROUP BY 1, 2
""")
def time_bucket_first(spark, d):
    out = V.traj(spark, d).withColumn("bucket", S.bucket(F.col("t"), DAY).cast("double"))
    return stats.first_in(out, ["bucket", "track_id"], ["t", "row_id"], ["row_id", "speed"]).select("bucket", "track_id", "row_id", R4("speed").alias("speed"))


@query("""
    WITH b AS (SELECT *, floor(t / 86400) * 86400 AS bucket FROM traj), ego AS (SELECT bucket, count(*) AS n FROM b WHERE track_id IN ('1', '2', '3') GROUP BY 1)
    SELECT s.bucket, coalesce(n, 0) AS n, n IS NULL AS dummy FROM (SELECT DISTINCT bucket FROM b) s LEFT JOIN ego USING (bucket)
""")
def timeline_spine(spark, d):
    b = V.traj(spark, d).withColumn("bucket", S.bucket(F.col("t"), DAY).cast("double"))
    ego = b.where(F.col("track_id").isin("1", "2", "3")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    return b.select("bucket").distinct().join(ego, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"), F.col("n").isNull().alias("dummy"))


@query("""
    WITH u AS (SELECT track_id, (track_id::BIGINT * 2654435761) % 4294967296 AS h FROM (SELECT DISTINCT track_id FROM traj WHERE kind <> 'Motorcycle'))
    SELECT track_id FROM u QUALIFY row_number() OVER (ORDER BY h, track_id) <= greatest(1, floor((SELECT count(*) FROM u) * 0.15))
""")
def deterministic_sample(spark, d):
    ids = V.traj(spark, d).where("kind <> 'Motorcycle'").select("track_id").distinct()
    return stats.sample_ids(ids, "track_id", F.pmod(F.col("track_id").cast("bigint") * 2654435761, F.lit(4294967296)), 0.15)


SAMPLE = 1_500  # rows a segment; the views' segments are smaller than real ones

_BINS = f"""q AS (SELECT segment_id, min(speed) AS lo, max(speed) AS hi FROM traj GROUP BY 1),
    b AS (SELECT t.*, least(39, floor((speed - lo) / (hi - lo) * 40))::BIGINT AS bin FROM traj t JOIN q USING (segment_id)),
    c AS (SELECT segment_id, bin, count(*) AS n FROM b GROUP BY 1, 2), s AS (SELECT segment_id, sum(n)::BIGINT AS total FROM c GROUP BY 1),
    k AS (SELECT segment_id, bin, n, (CASE WHEN total <= {SAMPLE} THEN n ELSE least(n, round_even(n::DOUBLE / total * {SAMPLE}, 0)) END)::BIGINT AS quota FROM c JOIN s USING (segment_id))"""


@query(f"WITH {_BINS} SELECT segment_id, bin, n, quota FROM k")
def density_histogram_quota(spark, d):
    return stats.density_quota(V.traj(spark, d), "segment_id", "speed", Matching().bins, SAMPLE)


@query(f"""
    WITH {_BINS}, r AS (SELECT b.*, quota, row_number() OVER (PARTITION BY segment_id, bin ORDER BY (row_id * 2654435761) % 4294967296, row_id) AS nth FROM b JOIN k USING (segment_id, bin))
    SELECT segment_id, row_id FROM r WHERE nth <= quota
""")
def density_sample(spark, d):
    by = F.pmod(F.col("row_id") * 2654435761, F.lit(4294967296))
    return stats.density_sample(V.traj(spark, d), "segment_id", "speed", "row_id", by, Matching().bins, SAMPLE).select("segment_id", "row_id")


_VALID = f"""
    r AS ({_RUNS}), n AS (SELECT *, lag(seg_length - t_proj) OVER w AS pg, lag(run) OVER w AS pr, lead(t_proj) OVER w AS nt, lead(run) OVER w AS nr FROM r WINDOW w AS (PARTITION BY track_id ORDER BY t, row_id)),
    g AS (SELECT *, t - lag(t) OVER w AS dt, max(t_proj) OVER w AS top, lag(t_proj) OVER v AS vp, lead(t_proj) OVER v AS vn FROM n WINDOW w AS (PARTITION BY track_id, run ORDER BY t, row_id), v AS (PARTITION BY track_id, run ORDER BY t_proj, row_id)),
    k AS (SELECT track_id, run::BIGINT AS run, segment_id, count(*) AS n, max(seg_length) AS len, min(t) AS t0, max(t) AS t1,
                 CASE WHEN count(*) = 1 THEN max(is_outlier::INT)::DOUBLE ELSE sum(CASE WHEN is_outlier THEN greatest(0, least(seg_length, coalesce((t_proj + vn) / 2, seg_length))) - greatest(0, least(seg_length, coalesce((vp + t_proj) / 2, 0))) ELSE 0 END) / max(seg_length) END AS share,
                 coalesce(max(dt), 0) AS gap, max(CASE WHEN pr <> run THEN -pg END) AS before, max(CASE WHEN nr <> run THEN seg_length + nt END) AS after
          FROM g GROUP BY 1, 2, 3)
"""


@query(f"""
    WITH {_VALID}
    SELECT track_id, run, segment_id, n, CASE WHEN share > 0.8 THEN 'outlier_share' WHEN gap > 172800 THEN 'gap' WHEN before IS NULL OR after IS NULL THEN 'bounds' ELSE 'valid' END AS verdict, round(share, 8) AS outlier_share FROM k
""")
def traversal_checks(spark, d):
    return stats.traversal_checks(V.traj(spark, d), 0.8, 172_800.0).select("track_id", "run", "segment_id", "n", "verdict", F.round("outlier_share", 8).alias("outlier_share"))


@query(f"""
    WITH {_VALID}
    SELECT segment_id, count(*) AS total, count(*) FILTER (verdict <> 'valid') AS invalid, count(*) FILTER (verdict = 'outlier_share') AS invalid_outlier_share, count(*) FILTER (verdict = 'gap') AS invalid_gap,
           count(*) FILTER (verdict = 'bounds') AS invalid_bounds, round(sum(share) / count(*), 4) AS mean_share
    FROM (SELECT *, CASE WHEN share > 0.8 THEN 'outlier_share' WHEN gap > 172800 THEN 'gap' WHEN before IS NULL OR after IS NULL THEN 'bounds' ELSE 'valid' END AS verdict FROM k) GROUP BY 1
""")
def invalid_by_reason(spark, d):
    k = stats.traversal_checks(V.traj(spark, d), 0.8, 172_800.0)
    by = lambda v: F.count_if(F.col("verdict") == v).alias(f"invalid_{v}")
    return k.groupBy("segment_id").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("verdict") != "valid").alias("invalid"), by("outlier_share"), by("gap"), by("bounds"), R4(F.try_divide(F.sum("outlier_share"), F.count(F.lit(1)))).alias("mean_share"))


@query(f"""
    WITH {_VALID}, ok AS (SELECT track_id, run FROM k WHERE share <= 0.8 AND gap <= 172800 AND before IS NOT NULL AND after IS NOT NULL)
    SELECT r.row_id, CASE WHEN ok.run IS NOT NULL THEN false ELSE coalesce(is_outlier, false) END AS is_outlier FROM r LEFT JOIN ok ON ok.track_id = r.track_id AND ok.run = r.run
""")
def outliers_reset(spark, d):
    traj = V.traj(spark, d)
    ok = stats.traversal_checks(traj, 0.8, 172_800.0).where("verdict = 'valid'").select("track_id", "run", F.lit(True).alias("ok"))
    points = T.runs(traj, ["track_id"], ["t", "row_id"], "segment_id")
    return points.join(ok, ["track_id", "run"], "left").select("row_id", F.when(F.col("ok"), False).otherwise(F.coalesce("is_outlier", F.lit(False))).alias("is_outlier"))


@query(f"""
    WITH {_VALID}, x AS (SELECT k.*, (t1 - t0) AS took FROM k WHERE share <= 0.8 AND gap <= 172800 AND before IS NOT NULL AND after IS NOT NULL),
    s AS (SELECT r.track_id, r.run, avg(speed) AS mean_speed, count(*) FILTER (speed < 8) AS slow FROM r GROUP BY 1, 2)
    SELECT x.track_id, x.run, x.segment_id, floor(t0)::BIGINT AS timestamp, round(CASE WHEN took > 0 THEN len / took ELSE mean_speed END, 6) AS temporal_mean_speed, round(mean_speed, 4) AS spatial_mean_speed, slow AS slow_points
    FROM x JOIN s ON s.track_id = x.track_id AND s.run = x.run
""")
def traversal_metrics(spark, d):
    traj = V.traj(spark, d)
    k = stats.traversal_checks(traj, 0.8, 172_800.0).where("verdict = 'valid'")
    s = T.runs(traj, ["track_id"], ["t", "row_id"], "segment_id").groupBy("track_id", "run").agg(F.avg("speed").alias("mean_speed"), F.count_if(F.col("speed") < 8).alias("slow_points"))
    took = F.col("t1") - F.col("t0")
    speed = F.when(took > 0, F.try_divide(F.col("length"), took)).otherwise(F.col("mean_speed"))
    return k.join(s, ["track_id", "run"]).select("track_id", "run", "segment_id", F.floor("t0").alias("timestamp"), F.round(speed, 6).alias("temporal_mean_speed"), R4("mean_speed").alias("spatial_mean_speed"), "slow_points")
