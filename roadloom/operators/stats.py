"""Aggregates: thresholds, validity checks, samples, lanes, votes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import lane_of
from . import timeseries as T


def valid_tracks(points: DataFrame, key: str, t: str, length: str, speed: str, least_time: float, least_length: float, least_speed: float) -> DataFrame:
    """Points of tracks that last, go and move enough."""
    good = points.groupBy(key).agg((F.max(t) - F.min(t)).alias("a"), F.sum(length).alias("b"), F.avg(speed).alias("c")).where((F.col("a") >= least_time) & (F.col("b") >= least_length) & (F.col("c") >= least_speed))
    return points.join(good.select(key), key, "left_semi")


def run_neighbours(points: DataFrame, key: list[str], order: list[str], run: str, station: str, length: str) -> DataFrame:
    """Per run, the stations of the points before and after it, seen from its own segment:
    the one before lies at -(its length - its station), the one after at length + station."""
    w = Window.partitionBy(*key).orderBy(*order)
    rest, own = F.lag(F.col(length) - F.col(station)).over(w), F.lag(run).over(w)
    out = points.withColumns({"__rest": rest, "__pr": own, "__nt": F.lead(station).over(w), "__nr": F.lead(run).over(w)})
    before, after = F.when(F.col("__pr") != F.col(run), -F.col("__rest")), F.when(F.col("__nr") != F.col(run), F.col(length) + F.col("__nt"))
    return out.groupBy(*key, run).agg(F.max(before).alias("station_before"), F.max(after).alias("station_after"))


def chained(points: DataFrame, folder: str, track: str, t: str) -> DataFrame:
    """Recordings one after the other: times run on, track ids name their folder."""
    ends = points.groupBy(folder).agg(F.max(t).alias("__m"))
    # one row per folder
    shift = ends.select(folder, F.coalesce(F.sum("__m").over(Window.orderBy(folder).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("__shift"))
    out = points.join(shift, folder)
    return out.withColumns({track: F.concat_ws("_", track, folder), t: F.col(t) + F.col("__shift")}).drop("__shift")


def thresholds(v: DataFrame, low: float = 0.05, high: float = 0.95, spatial: float = 0.05, free: float = 0.85, least: float = 2.0) -> DataFrame:
    """Speed thresholds by segment from traversals; -1 where they can't be told."""
    ok = F.col("valid")
    a = v.groupBy("segment_id").agg(
        F.max("segment_length").alias("len"), F.count_if(ok).alias("total_traversals"), F.count_if(~ok).alias("invalid_traversals"), F.max(F.when(ok, F.col("traversal_time"))).alias("longest"),
        F.percentile(F.when(ok, F.col("traversal_time")), low).alias("fast"), F.percentile(F.when(ok, F.col("stopping_duration")), high).alias("stop"),
    )
    limit = F.when((F.col("total_traversals") > 1) & (F.col("longest") > least), F.try_divide(F.col("len"), F.col("fast") + F.col("stop"))).otherwise(-1.0)
    a = a.withColumn("temporal_threshold", limit)
    quick = F.when(F.col("temporal_mean_speed") >= F.col("temporal_threshold"), F.col("spatial_mean_speed"))
    b = v.where(ok).join(a.select("segment_id", "temporal_threshold"), "segment_id").groupBy("segment_id").agg(F.percentile(quick, spatial).alias("s"), F.percentile(quick, free).alias("f"))
    known = lambda c: F.when(F.col("temporal_threshold") == -1, -1.0).otherwise(F.coalesce(F.col(c), F.lit(-1.0)))
    return a.join(b, "segment_id", "left").select("segment_id", "temporal_threshold", known("s").alias("spatial_threshold"), known("f").alias("free_flow_speed"), F.coalesce("stop", F.lit(0.0)).alias("red_light_duration"), "total_traversals", "invalid_traversals")


def first_in(df: DataFrame, key: list[str], order: list[str], cols: list[str]) -> DataFrame:
    """The first non-null of each column in a group, by an order."""
    return df.groupBy(*key).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))).alias(c) for c in cols])


def sample_ids(ids: DataFrame, key: str, by: Column, share: float, cells: int = 4096) -> DataFrame:
    """max(1, floor(n * share)) of the ids, those with the smallest hash (then key).

    The hash's range is counted in cells; whole cells below the limit are taken where they
    are, and only the cell that the limit falls into is sorted.
    """
    rows = ids.withColumn("__by", by)
    n, low, high = rows.agg(F.count(F.lit(1)), F.min("__by"), F.max("__by")).first()
    left = max(1, int(n * share)) if n else 0
    width = max(1, -(-(high - low + 1) // cells)) if n else 1
    rows = rows.withColumn("__cell", F.floor((F.col("__by") - F.lit(low or 0)) / width))
    edge = 0
    for cell, size in sorted(tuple(r) for r in rows.groupBy("__cell").count().collect()):  # at most ``cells`` rows
        edge = cell
        if size >= left:
            break
        left -= size
    some = rows.where(F.col("__cell") == edge).orderBy("__by", key).limit(left)
    return rows.where(F.col("__cell") < edge).union(some).select(*ids.columns)


def binned(df: DataFrame, key: str, x: str, bins: int) -> DataFrame:
    """df with __bin, half-open bins over each key's range, the last one closed."""
    ends = df.groupBy(key).agg(F.min(x).alias("__lo"), F.max(x).alias("__hi"))
    at = F.coalesce(F.floor(F.try_divide(F.col(x) - F.col("__lo"), F.col("__hi") - F.col("__lo")) * bins), F.lit(0))
    return df.join(ends, key).withColumn("bin", F.least(F.lit(bins - 1), at).cast("bigint")).drop("__lo", "__hi")


def density_quota(df: DataFrame, key: str, x: str, bins: int, most: int, power: float = 1.0) -> DataFrame:
    """How many of each bin a sample of about ``most`` takes: all of a key that has no more,
    else a rounded share by a power of the bin's count."""
    counts = binned(df, key, x, bins).groupBy(key, "bin").agg(F.count(F.lit(1)).alias("n"))
    weight = F.pow(F.col("n").cast("double"), F.lit(power))
    total = counts.groupBy(key).agg(F.sum("n").alias("__all"), F.sum(weight).alias("__w"))
    quota = F.when(F.col("__all") <= most, F.col("n")).otherwise(F.least(F.col("n"), F.rint(weight / F.col("__w") * most))).cast("bigint")
    return counts.join(total, key).select(key, "bin", "n", quota.alias("quota"))


def density_sample(df: DataFrame, key: str, x: str, row: str, by: Column, bins: int, most: int) -> DataFrame:
    """The sample itself: in each bin the rows with the smallest hash."""
    placed = binned(df, key, x, bins).withColumn("__by", by)
    nth = F.row_number().over(Window.partitionBy(key, "bin").orderBy("__by", row))
    return placed.withColumn("__nth", nth).join(density_quota(df, key, x, bins, most).select(key, "bin", "quota"), [key, "bin"]).where("__nth <= quota").drop("__nth", "__by", "quota")


def traversal_checks(points: DataFrame, most_outliers: float, most_gap: float) -> DataFrame:
    """One row per run of a track on a segment, with the first rule that it fails.

    Rules in order: share of outliers, gap in time, a point before and after the run.
    """
    key = ["track_id", "run"]
    run = T.runs(points, ["track_id"], ["t", "row_id"], "segment_id")
    share = T.outlier_share(run, key, "t_proj", "row_id", "is_outlier", "seg_length")
    dt = F.col("t") - F.lag("t").over(Window.partitionBy(*key).orderBy("t", "row_id"))
    facts = run.withColumn("dt", dt).groupBy(*key, "segment_id").agg(F.count(F.lit(1)).alias("n"), F.max("seg_length").alias("length"), F.min("t").alias("t0"), F.max("t").alias("t1"), F.coalesce(F.max("dt"), F.lit(0.0)).alias("gap"))
    ends = run_neighbours(run, ["track_id"], ["t", "row_id"], "run", "t_proj", "seg_length")
    verdict = F.when(F.col("outlier_share") > most_outliers, "outlier_share").when(F.col("gap") > most_gap, "gap").when(F.col("station_before").isNull() | F.col("station_after").isNull(), "bounds").otherwise("valid")
    return facts.join(share, key).join(ends, key).withColumn("verdict", verdict)


# --- lanes ----------------------------------------------------------------------------


def confident(points: DataFrame, key: str, speed: str, deviation: str, speeds: list[float], least: int, most_deviation: float) -> DataFrame:
    """Points above the first of the speeds that leaves a key enough of them, else all."""
    small = F.col(deviation) < most_deviation
    counts = points.groupBy(key).agg(*[F.count_if(small & (F.col(speed) > s)).alias(f"n{i}") for i, s in enumerate(speeds)])
    limit = F.lit(None).cast("double")
    for i, s in reversed(list(enumerate(speeds))):
        limit = F.when(F.col(f"n{i}") >= least, F.lit(float(s))).otherwise(limit)
    out = points.join(counts.select(key, limit.alias("__limit")), key)
    return out.where(F.col("__limit").isNull() | (small & (F.col(speed) > F.col("__limit")))).drop("__limit")


def lanes_on(points: DataFrame, key: str, x: str, bounds: DataFrame) -> DataFrame:
    """points with D (offset clipped to a key's bounds), lane_index and is_outside."""
    lane, outside = lane_of(F.col(x), F.col("bounds"))
    return points.join(bounds.select(key, "bounds"), key).withColumns({"lane_index": lane, "is_outside": outside})


def consensus(votes: DataFrame, key: str, vote: str, order: list[str], defined: DataFrame, share: float) -> DataFrame:
    """A lane count by key: the most frequent vote if its share is enough, else the defined
    count, else the rounded mean of the votes, else 1; with the reason. Ties between votes go
    to the one that comes first."""
    by = votes.groupBy(key, vote).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*order)).alias("first"))
    best = by.withColumn("__r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), "first"))).where("__r = 1").select(key, F.col(vote).alias("mode"), F.col("n").alias("top"))
    total = votes.groupBy(key).agg(F.count(vote).alias("total"), F.avg(vote).alias("mean"))
    out = total.join(best, key).join(defined.select(key, F.col("lanes").alias("osm")), key, "full")
    sure = F.try_divide(F.col("top"), F.col("total")) >= share
    lanes = F.when(sure, F.col("mode")).when(F.col("osm").isNotNull(), F.col("osm")).when(F.col("mean").isNotNull(), F.bround("mean", 0)).otherwise(1)
    reason = F.when(sure, "consensus").when(F.col("osm").isNotNull(), "defined").when(F.col("mean").isNotNull(), "mean").otherwise("default")
    return out.select(key, lanes.cast("bigint").alias("lanes"), reason.alias("reason"))
