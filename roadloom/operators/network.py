"""Segments over many recordings, and the undirected structure of a network."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .loop import cut


def union_first(frames: list[DataFrame], key: list[str], order: list[str]) -> DataFrame:
    """All rows of the frames, one for each key: the first frame's, then by order."""
    parts = [f.withColumn("__file", F.lit(i)) for i, f in enumerate(frames)]
    return first_of(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), key, ["__file", *order]).drop("__file")


def first_of(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row of each key: the first by order."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("__n = 1").drop("__n")


def presence(seen: DataFrame, key: str, rec: str) -> DataFrame:
    """In how many recordings each key is."""
    return seen.groupBy(key).agg(F.countDistinct(rec).alias("n"))


def common(seen: DataFrame, key: str, rec: str, total: int) -> DataFrame:
    """Keys that are in all recordings."""
    return presence(seen, key, rec).where(F.col("n") == total).select(key)


def rare(seen: DataFrame, key: str, rec: str, total: int, removal: float, exempt: DataFrame) -> DataFrame:
    """Keys in less than (1 - removal) of the recordings, but for exempt ones."""
    return presence(seen, key, rec).where(F.col("n") < (1 - removal) * total).join(exempt.select(key), key, "left_anti")


def missing(seen: DataFrame, key: str, rec: str, recs: DataFrame, most: int) -> DataFrame:
    """(rec, key) for keys that at most ``most`` recordings lack, where they are lacking.

    Only for such keys are all recordings listed.
    """
    n = recs.count()
    few = presence(seen, key, rec).where((F.col("n") < n) & (F.col("n") >= n - most)).select(key)
    lists = recs.agg(F.collect_set(rec).alias("all"))  # as long as there are recordings
    held = seen.join(few, key, "left_semi").groupBy(key).agg(F.collect_set(rec).alias("have"))
    return held.join(F.broadcast(lists)).select(key, F.explode(F.array_except("all", "have")).alias(rec))


def endpoints(edges: DataFrame) -> DataFrame:
    """(node, segment_id), both ends of each segment."""
    return edges.select(F.explode(F.array("u", "v")).alias("node"), "segment_id")


def degrees(edges: DataFrame) -> DataFrame:
    return endpoints(edges).groupBy("node").agg(F.countDistinct("segment_id").alias("degree"))


def node_key(x: Column, y: Column, digits: int = 7) -> Column:
    """A node's name from its coordinates."""
    return F.concat_ws("_", F.bround(x, digits).cast("string"), F.bround(y, digits).cast("string"))


def with_degrees(edges: DataFrame) -> DataFrame:
    d = degrees(edges)
    return edges.join(d.select(F.col("node").alias("u"), F.col("degree").alias("du")), "u").join(d.select(F.col("node").alias("v"), F.col("degree").alias("dv")), "v")


def dangling(edges: DataFrame) -> DataFrame:
    """Segments with a loose end whose other end is a crossing."""
    return with_degrees(edges).where("(du = 1 and dv >= 3) or (dv = 1 and du >= 3)")


def chain_segments(edges: DataFrame) -> DataFrame:
    """Segments that go on at both ends."""
    return with_degrees(edges).where("du > 1 and dv > 1")


def components(links: DataFrame) -> DataFrame:
    """(node, root) from links (a, b): the smallest node that can be reached.

    Large-star and small-star steps in turn; two numbers a round come to the driver.
    """
    now = cut(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = cut(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        now = cut(small.where("u <> v").distinct())
        new = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if new == state:
            break
        state = new
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    return ends.join(now.withColumnRenamed("u", "node"), "node", "left").select("node", F.coalesce("v", "node").alias("root"))


def with_component(edges: DataFrame) -> DataFrame:
    """edges with root (the component's smallest node) and component_nodes."""
    root = components(edges.select(F.col("u").alias("a"), F.col("v").alias("b")))
    size = root.groupBy("root").agg(F.count(F.lit(1)).alias("component_nodes"))
    return edges.join(root.withColumnRenamed("node", "u"), "u").join(size, "root")


def rescued(valid: DataFrame, shapes: DataFrame) -> DataFrame:
    """valid segment ids, with all members of each shape component that has a valid one."""
    comp = components(shapes.select(F.col("u").alias("a"), F.col("v").alias("b"))).withColumnRenamed("node", "u")
    member = shapes.join(comp, "u").select("segment_id", "root")
    alive = member.join(valid.select("segment_id"), "segment_id", "left_semi").select("root").distinct()
    return valid.select("segment_id").union(member.join(alive, "root", "left_semi").select("segment_id")).distinct()


def prune_unconnected(valid: DataFrame, relations: DataFrame) -> DataFrame:
    """Remove segments without a valid neighbour until none is left to remove.

    relations: (src, dst); a segment stays while a valid one leads to it or away from it.
    """
    now, n = cut(valid.select("segment_id").distinct()), -1
    while (m := now.count()) != n:
        n = m
        ids = now.select(F.col("segment_id").alias("id"))
        alive = relations.join(ids, relations.src == ids.id, "left_semi").join(ids.withColumnRenamed("id", "id2"), F.col("dst") == F.col("id2"), "left_semi").where("src <> dst")
        near = alive.select(F.explode(F.array("src", "dst")).alias("segment_id")).distinct()
        now = cut(now.join(near, "segment_id", "left_semi"))
    return now


def spread_lanes(edges: DataFrame, rounds: int) -> DataFrame:
    """Fill missing lane counts from the segments of the same name before and after, round by
    round: a segment takes the greatest count among its known neighbours. Each round reads
    the counts of the round before, so no order of segments matters."""
    now = edges.select("segment_id", "u", "v", "name", "lanes")
    for _ in range(rounds):
        near = now.where("lanes is not null").select(F.explode(F.array(F.struct(F.col("v").alias("node")), F.struct(F.col("u").alias("node")))).alias("x"), "name", "lanes", F.col("segment_id").alias("other")).select("x.node", "name", "lanes", "other")
        need = now.where("lanes is null").select("segment_id", F.explode(F.array("u", "v")).alias("node"), "name")
        got = need.join(near, ["node", "name"]).groupBy("segment_id").agg(F.max("lanes").alias("got"))
        if got.isEmpty():
            break
        now = cut(now.join(got, "segment_id", "left").withColumn("lanes", F.coalesce("lanes", "got")).drop("got"))
    return now


def numbered(ids: DataFrame, key: str, name: str = "place") -> DataFrame:
    """ids (one row each) with their place in the order of key, from 0.

    Ranges of keys are sorted apart; only the number of rows of each range comes to the driver.
    """
    parts = cut(ids.repartitionByRange(key).sortWithinPartitions(key).withColumn("__part", F.spark_partition_id()))
    sizes = sorted(tuple(r) for r in parts.groupBy("__part").count().collect())
    begins, total = [], 0
    for part, n in sizes:
        begins.append((part, total))
        total += n
    offsets = ids.sparkSession.createDataFrame(begins, "__part int, __begin bigint")
    own = F.row_number().over(Window.partitionBy("__part").orderBy(key)) - 1
    return parts.join(F.broadcast(offsets), "__part").withColumn(name, own + F.col("__begin")).drop("__part", "__begin")
