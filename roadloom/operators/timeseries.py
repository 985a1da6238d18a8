"""Operators that depend on the order of points in a track or of states on a segment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import rtsm


def ordered(key: list[str], order: list[str]):
    return Window.partitionBy(*key).orderBy(*order)


def min_gap(points: DataFrame, key: list[str], t: str, row: str, gap: Column | float, jitter: float = 0.0) -> DataFrame:
    """Keep a key's first point and then each that comes at least ``gap`` after the last kept.

    With jitter, the gap of a point varies by up to that share, by a hash of its row.
    Only (key, t, row, gap) are sorted, within partitions by key; a task streams through them
    and remembers the last kept time, so a key of any size takes no memory. The kept rows are
    joined back.
    """
    wanted = F.lit(gap) if not isinstance(gap, Column) else gap
    if jitter:
        wanted = wanted * (1 + jitter * (F.pmod(F.xxhash64(row), F.lit(2001)) / 1000.0 - 1))
    slim = points.select(*key, F.col(t).alias("__t"), F.col(row).alias("__row"), wanted.cast("double").alias("__gap"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, last = None, 0.0
        for pdf in batches:
            keep = []
            for name, at, least in zip(pdf[key].itertuples(index=False, name=None), pdf["__t"].tolist(), pdf["__gap"].tolist(), strict=True):
                new = name != now or at - last >= least
                if new:
                    now, last = name, at
                keep.append(new)
            yield pdf.loc[keep, [*key, "__row"]]

    kinds = dict(slim.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in [*key, "__row"])
    kept = slim.repartition(*key).sortWithinPartitions(*key, "__t", "__row").mapInPandas(run, schema)
    return points.join(kept.withColumnRenamed("__row", row), [*key, row], "left_semi")


def runs(points: DataFrame, key: list[str], order: list[str], value: str, name: str = "run") -> DataFrame:
    """Number the runs of equal values in a key's order, from 1."""
    w = ordered(key, order)
    changed = (~F.col(value).eqNullSafe(F.lag(value).over(w))) | (F.row_number().over(w) == 1)
    return points.withColumn("__new", changed.cast("int")).withColumn(name, F.sum("__new").over(w)).drop("__new")


def parked(points: DataFrame, key: list[str], t: str, row: str, speed: str, slow: float, least: float) -> DataFrame:
    """Flag all points of runs slower than ``slow`` that last at least ``least``."""
    out = runs(points.withColumn("__slow", F.col(speed) < slow), key, [t, row], "__slow", "__run")
    w = Window.partitionBy(*key, "__run")
    flag = F.coalesce(F.col("__slow"), F.lit(False)) & (F.max(t).over(w) - F.min(t).over(w) >= least)
    return out.withColumn("is_parked", flag).drop("__slow", "__run")


def longest_stop(points: DataFrame, key: list[str], t: str, row: str, stopped: Column) -> DataFrame:
    """Per key, the longest time between neighbours that are all stopped; 0 if none."""
    w = ordered(key, [t, row])
    pairs = points.withColumn("__s", F.coalesce(stopped, F.lit(False))).withColumn("__both", F.col("__s") & F.coalesce(F.lag("__s").over(w), F.lit(False)))
    pairs = pairs.withColumn("__dt", F.col(t) - F.lag(t).over(w)).withColumn("__n", F.sum(F.when(F.col("__both"), 0).otherwise(1)).over(w))
    sums = pairs.where("__both").groupBy(*key, "__n").agg(F.sum("__dt").alias("__sum"))
    best = sums.groupBy(*key).agg(F.max("__sum").alias("longest_stop"))
    return points.select(*key).distinct().join(best, key, "left").withColumn("longest_stop", F.coalesce("longest_stop", F.lit(0.0)))


def monotone(points: DataFrame, key: list[str], order: list[str], x: str) -> DataFrame:
    """Only points at or beyond the greatest station so far."""
    w = ordered(key, order).rowsBetween(Window.unboundedPreceding, 0)
    return points.withColumn("__top", F.max(x).over(w)).where(F.col(x) >= F.col("__top")).drop("__top")


def repaired(points: DataFrame, key: list[str], order: list[str], x: str, offset: float, name: str) -> DataFrame:
    """Strictly ascending stations: x_i = max(x_i, x_(i-1) + offset), as a running maximum."""
    w = ordered(key, order)
    i = F.row_number().over(w) * F.lit(offset)
    out = points.withColumn("__i", i).withColumn("__x", F.col(x) - F.col("__i"))
    return out.withColumn(name, F.max("__x").over(w.rowsBetween(Window.unboundedPreceding, 0)) + F.col("__i")).drop("__i", "__x")


def outlier_share(points: DataFrame, key: list[str], station: str, row: str, flag: str, length: str) -> DataFrame:
    """Per key, the share of the length that outliers stand for: each point stands for what
    is nearer to it than to its neighbours. A single point counts as a whole."""
    w = ordered(key, [station, row])
    here, prev, nxt = F.col(station), F.lag(station).over(w), F.lead(station).over(w)
    low = F.coalesce((prev + here) / 2, F.lit(0.0))
    high = F.coalesce((here + nxt) / 2, F.col(length))
    bound = lambda c: F.greatest(F.lit(0.0), F.least(F.col(length), c))
    out = points.withColumn("__w", bound(high) - bound(low))
    return out.groupBy(*key).agg(
        F.when(F.count(F.lit(1)) == 1, F.max(F.col(flag).cast("double")))
        .otherwise(F.coalesce(F.try_divide(F.sum(F.when(F.col(flag), F.col("__w")).otherwise(0.0)), F.max(length)), F.lit(0.0))).alias("outlier_share")
    )


def interpolated(points: DataFrame, key: list[str], x: str, y: str, queries: DataFrame, q: str, name: str) -> DataFrame:
    """Piecewise-linear y at each query (key columns and q), held constant beyond the ends.

    Points and queries go through one window per key; no pair of all points and queries is
    made. Stations must ascend strictly.
    """
    both = points.select(*key, F.col(x).alias("__x"), F.col(y).alias("__y"), F.lit(0).alias("__q")).unionByName(queries.select(*key, F.col(q).alias("__x"), F.lit(None).cast("double").alias("__y"), F.lit(1).alias("__q")))
    own = F.when(F.col("__q") == 0, F.struct(F.col("__x").alias("x"), F.col("__y").alias("y")))
    back = ordered(key, ["__x", "__q"]).rowsBetween(Window.unboundedPreceding, 0)
    ahead = ordered(key, ["__x", F.col("__q").desc()]).rowsBetween(0, Window.unboundedFollowing)
    out = both.withColumn("__own", own).withColumn("__a", F.last("__own", True).over(back)).withColumn("__b", F.first("__own", True).over(ahead)).where("__q = 1")
    t = F.try_divide(F.col("__x") - F.col("__a.x"), F.col("__b.x") - F.col("__a.x"))
    mid = F.col("__a.y") + F.coalesce(t, F.lit(0.0)) * (F.col("__b.y") - F.col("__a.y"))
    value = F.when(F.col("__a").isNull(), F.col("__b.y")).when(F.col("__b").isNull(), F.col("__a.y")).otherwise(mid)
    return out.select(*key, F.col("__x").alias(q), value.alias(name))


def _averages(key: str, t: str, row: str, names: list[str], tau: float, first_dt: float, maps: bool):
    """Streams through chunks in order, each a head row with the time before it and the states it
    starts from, then its rows. Gives each row's states or, with maps, each chunk's affine maps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, now, ended = np.nan, [None] * len(names), None
        share = 1.0
        for batch in batches:
            if not batch.num_rows:
                continue
            head = batch.column("__head").to_numpy(zero_copy_only=False).astype(bool)
            times = batch.column("__t").to_numpy(zero_copy_only=False)
            before = np.concatenate([[last], times[:-1]])
            last = times[-1]
            dt = np.where(np.isnan(before), first_dt, times - before)
            gain = 1 - np.exp(-dt / tau)
            flags, gains = head.tolist(), gain.tolist()
            states = []
            for k, n in enumerate(names):
                state, got = now[k], []
                for new, a, x in zip(flags, gains, batch.column(n).to_pylist(), strict=True):
                    if new:
                        state = x
                    else:
                        state = None if state is None or x is None else state * (1 - a) + a * x
                    got.append(state)
                now[k] = state
                states.append(pa.array(got, pa.float64()))
            if not maps:
                out = [batch.column(key), batch.column(t), batch.column(row), pa.array(dt), *states]
                yield pa.RecordBatch.from_arrays(out, names=[key, t, row, "dt", *names]).filter(pa.array(~head))
                continue
            kept = []
            for new, a in zip(flags, gains, strict=True):
                share = 1.0 if new else share * (1 - a)
                kept.append(share)
            out = pa.RecordBatch.from_arrays([batch.column(key), batch.column("__part"), pa.array(kept, pa.float64()), *states], names=[key, "__part", "__m", *names])
            if head[0] and ended is not None:
                yield ended
            yield out.filter(pa.array(np.append(head[1:], False)))  # the last row of each chunk that ends here
            ended = out.slice(out.num_rows - 1)
        if ended is not None:
            yield ended

    return run


def tema(states: DataFrame, key: str, t: str, row: str, values: dict[str, str], seeds: DataFrame, tau: float, first_dt: float, chunk: float) -> DataFrame:
    """Exponential averages over irregular times: s += (1 - exp(-dt / tau)) * (x - s).

    values: column -> output name; seeds: key and a start value by output name. Each step is
    an affine map of s, and maps compose. So a key's history is cut into chunks of time that
    are averaged apart, the chunks' maps are composed in order (one row a chunk), and each
    chunk then starts from what came before it. A busy key is as many tasks as it has chunks.
    A task streams through its chunks, so their size takes no memory and time in proportion.
    Rows without a key or a time are left out.
    """
    names, kinds = list(values.values()), dict(states.dtypes)
    slim = states.where(F.col(key).isNotNull() & F.col(t).isNotNull()).withColumn("__part", F.floor(F.col(t) / chunk))
    body = slim.select(key, "__part", F.lit(False).alias("__head"), t, row, F.col(t).cast("double").alias("__t"), *[F.col(c).cast("double").alias(n) for c, n in values.items()])
    edge = slim.groupBy(key, "__part").agg(F.max(t).cast("double").alias("__last"))
    edge = edge.withColumn("__before", F.lag("__last").over(Window.partitionBy(key).orderBy("__part"))).select(key, "__part", "__before")

    def streamed(heads: DataFrame, maps: bool) -> DataFrame:
        first = heads.select(key, "__part", F.lit(True).alias("__head"), F.lit(None).cast(kinds[t]).alias(t), F.lit(None).cast(kinds[row]).alias(row), F.col("__before").alias("__t"), *names)
        placed = first.unionByName(body).repartition(key, "__part").sortWithinPartitions(key, "__part", F.desc("__head"), t, row, *names)
        own = f"{key} {kinds[key]}, " + ("__part bigint, __m double" if maps else f"{t} {kinds[t]}, {row} {kinds[row]}, dt double")
        return placed.mapInArrow(_averages(key, t, row, names, tau, first_dt, maps), own + "".join(f", {n} double" for n in names))

    maps = streamed(edge.select("*", *[F.lit(0.0).alias(n) for n in names]), True)
    maps = maps.join(seeds.select(key, *[F.col(n).alias(f"__seed_{n}") for n in names]), key, "left")
    # chunks of a key in order: one small row each
    piece = F.struct(F.col("__part").alias("part"), F.col("__m").alias("m"), *names)
    chain = maps.groupBy(key).agg(F.sort_array(F.collect_list(piece)).alias("__chain"), *[F.coalesce(F.first(f"__seed_{n}"), F.lit(0.0)).alias(f"__s_{n}") for n in names])
    kind = "array<struct<part:bigint," + ",".join(f"{n}:double" for n in names) + ">>"

    def carry(a: Column, p: Column) -> Column:
        start = F.struct(p.part.alias("part"), *[a[n].alias(n) for n in names])
        return F.struct(F.concat(a.got, F.array(start)).alias("got"), *[(p.m * a[n] + p[n]).alias(n) for n in names])

    begin = F.struct(F.array().cast(kind).alias("got"), *[F.col(f"__s_{n}").alias(n) for n in names])
    starts = chain.select(key, F.inline(F.aggregate("__chain", begin, carry, lambda a: a.got))).withColumnRenamed("part", "__part")
    return streamed(starts.join(edge, [key, "__part"]), False)


def with_rtsm(states: DataFrame, limits: DataFrame, key: str, temporal: str, spatial: str) -> DataFrame:
    """Add recalculated_rtsm; limits: key, temporal_threshold, spatial_threshold (0 if missing)."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return states.join(limits.select(key, "temporal_threshold", "spatial_threshold"), key, "left").withColumn("recalculated_rtsm", rtsm(F.col(temporal), F.col(spatial), zero("temporal_threshold"), zero("spatial_threshold"), invalid=False)).drop("temporal_threshold", "spatial_threshold")
