"""Faces of a planar street network, followed along half-edges by pointer jumping.

Every link is two half-edges. At its end node a half-edge turns to the neighbour that comes
before its own start in the order of angles; so each half-edge has one that follows it, and
the cycles of that relation are the faces. Cycles are named by their least half-edge and
ranked from it by doubling, in a number of joins that grows with the logarithm of the longest
boundary. No piece of the network has to fit into a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .loop import cut

_EDGE = ["a", "b"]


def half_edges(edges: DataFrame) -> DataFrame:
    """(a, b, ax, ay, bx, by, na, nb): both directions of each link and what follows on each."""
    one = edges.where("u <> v").select(F.col("u").alias("a"), F.col("v").alias("b"), F.col("x1").alias("ax"), F.col("y1").alias("ay"), F.col("x2").alias("bx"), F.col("y2").alias("by"))
    back = one.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("bx").alias("ax"), F.col("by").alias("ay"), F.col("ax").alias("bx"), F.col("ay").alias("by"))
    both = one.union(back).dropDuplicates(_EDGE)
    around = Window.partitionBy("a").orderBy(F.atan2(F.col("by") - F.col("ay"), F.col("bx") - F.col("ax")), "b")
    last = F.last("b").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    turn = both.select(F.col("b").alias("a"), F.col("a").alias("b"), F.coalesce(F.lag("b").over(around), last).alias("nb"))
    return both.join(turn, _EDGE).withColumn("na", F.col("b"))


def _doubled(state: DataFrame, gain) -> DataFrame:
    """state (a, b, ja, jb, x) after enough rounds of x = gain(x, x at j), j = j at j."""
    before = None
    while True:
        other = state.select(F.col("a").alias("ja"), F.col("b").alias("jb"), F.col("ja").alias("ka"), F.col("jb").alias("kb"), F.col("x").alias("y"))
        state = cut(state.join(other, ["ja", "jb"]).select("a", "b", F.col("ka").alias("ja"), F.col("kb").alias("jb"), gain(F.col("x"), F.col("y")).alias("x")))
        now = state.agg(F.sum(F.xxhash64("a", "b", "x").cast("decimal(38,0)"))).first()[0]
        if now == before:
            return state
        before = now


def faces(edges: DataFrame) -> DataFrame:
    """(face, area, perimeter, n, nodes): inner faces; nodes counter-clockwise from the face's
    least half-edge, which names it. edges: u, v, x1, y1, x2, y2; they cross at nodes only."""
    half = cut(half_edges(edges))
    own = F.struct(F.col("a").alias("a"), F.col("b").alias("b"))
    start = half.select("a", "b", F.col("na").alias("ja"), F.col("nb").alias("jb"), own.alias("x"))
    lead = _doubled(start, lambda x, y: F.least(x, y)).select("a", "b", F.col("x").alias("lead"))
    named = cut(half.join(lead, _EDGE))
    side = F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"))
    size = named.groupBy("lead").agg((F.sum(F.col("ax") * F.col("by") - F.col("bx") * F.col("ay")) / 2).alias("area"), F.sum(side).alias("perimeter"), F.count(F.lit(1)).alias("n"))
    inner = cut(size.where("n >= 3 and area > 1e-9"))
    rest = named.join(inner.select("lead"), "lead", "left_semi")
    first = F.col("lead") == own
    step = rest.select("a", "b", F.when(first, F.col("a")).otherwise(F.col("na")).alias("ja"), F.when(first, F.col("b")).otherwise(F.col("nb")).alias("jb"), F.when(first, 0).otherwise(1).cast("bigint").alias("x"))
    far = _doubled(cut(step), lambda x, y: x + y).select("a", "b", F.col("x").alias("left"))
    ring = rest.join(far, _EDGE).groupBy("lead").agg(F.array_sort(F.collect_list(F.struct((-F.col("left")).alias("left"), F.col("a").alias("a")))).alias("r"))
    # steps to the leader: 0 for the leader itself, then the most for what follows it
    nodes = F.concat(F.array(F.element_at("r", -1).a), F.transform(F.slice("r", F.lit(1), F.size("r") - 1), lambda p: p.a))
    out = inner.join(ring, "lead")
    return out.select(F.concat_ws("-", "lead.a", "lead.b").alias("face"), "area", "perimeter", "n", nodes.alias("nodes"))
