"""The directed road graph: successors, predecessors, chains and typed relations.

Edges carry segment_id, u, v, way (a road's name), is_link, h_in and h_out: the headings at
their start and end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Graph
from ..functions.scalar import heading, turn_class, turn_class_through, turned
from .loop import cut


def headed(edges: DataFrame) -> DataFrame:
    """Straight edges with way, is_link, h_in and h_out from their end points."""
    h = heading(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    return edges.withColumns({"way": F.col("name"), "is_link": F.lower("highway").endswith("_link"), "h_in": h, "h_out": h})


def turns(edges: DataFrame, u_turns: bool = False) -> DataFrame:
    """(src, dst, delta, direction, same_way, dst_link): each pair of edges that follow on."""
    a = edges.select(F.col("segment_id").alias("src"), F.col("u").alias("su"), F.col("v").alias("node"), F.col("h_out").alias("ha"), F.col("way").alias("wa"))
    b = edges.select(F.col("segment_id").alias("dst"), F.col("u").alias("node"), F.col("v").alias("dv"), F.col("h_in").alias("hb"), F.col("way").alias("wb"), F.col("is_link").alias("dst_link"))
    out = a.join(b, "node").withColumn("delta", turned(F.col("hb"), F.col("ha")))
    out = out.select("src", "dst", "node", "su", "dv", "delta", turn_class(F.col("delta")).alias("direction"), (F.col("wa") == F.col("wb")).alias("same_way"), "dst_link")
    return out if u_turns else out.where("su <> dv")


def best_successor(edges: DataFrame, banned: DataFrame | None = None, only: DataFrame | None = None, config: Graph = Graph()) -> DataFrame:
    """(src, dst, delta): the follower with the least turn within the limit of its kind.

    banned: (src, dst) that may not follow; only: (src, dst), for whose src nothing else may.
    """
    t = turns(edges)
    limit = F.when(F.col("same_way"), config.same_way).otherwise(config.other_way)
    if only is not None:
        forced = only.select("src", F.col("dst").alias("must"))
        t = t.join(forced, "src", "left").where("must is null or must = dst").withColumn("forced", F.col("must").isNotNull())
    else:
        t = t.withColumn("forced", F.lit(False))
    if banned is not None:
        t = t.join(banned.select("src", "dst"), ["src", "dst"], "left_anti")
    t = t.where(F.col("forced") | (F.abs("delta") <= limit))
    best = Window.partitionBy("src").orderBy(F.abs("delta"), "dst")
    return t.withColumn("__n", F.row_number().over(best)).where("__n = 1").select("src", "dst", "delta")


def best_predecessor(edges: DataFrame, config: Graph = Graph()) -> DataFrame:
    """(dst, src, delta): who comes before a segment; links only where nothing else does."""
    t = turns(edges).where(F.abs("delta") <= config.predecessor)
    link = edges.select(F.col("segment_id").alias("src"), F.col("is_link").alias("src_link"))
    best = Window.partitionBy("dst").orderBy("src_link", F.abs("delta"), "src")
    return t.join(link, "src").withColumn("__n", F.row_number().over(best)).where("__n = 1").select("dst", "src", "delta")


def chain(step: DataFrame, lengths: DataFrame, reach: float, first: DataFrame | None = None) -> DataFrame:
    """(src, ord, dst, length): what follows a segment, one by one, until ``reach`` is covered.

    step: (src, dst), at most one dst each. A chain ends before a segment that it already
    holds. first: (src, dst) pairs that stop a chain at its first hop (right of way).
    """
    hop = cut(step.select(F.col("src").alias("at"), F.col("dst").alias("next")).join(lengths.select(F.col("segment_id").alias("next"), F.col("length").alias("step_len")), "next"))
    now = hop.select(F.col("at").alias("src"), F.lit(1).alias("ord"), F.col("next").alias("dst"), F.col("step_len").alias("length"), F.col("step_len").alias("sofar"), F.array("at", "next").alias("path"))
    now = now.where("src <> dst")
    out = now
    grow = now
    if first is not None:
        grow = now.join(first.select("src", "dst"), ["src", "dst"], "left_anti")
    while True:  # ends, since no path repeats a segment
        grow = cut(grow.where(F.col("sofar") < reach).join(hop, grow.dst == hop["at"]).where(~F.array_contains("path", F.col("next"))).select("src", (F.col("ord") + 1).alias("ord"), F.col("next").alias("dst"), F.col("step_len").alias("length"), (F.col("sofar") + F.col("step_len")).alias("sofar"), F.concat("path", F.array("next")).alias("path")))
        if grow.isEmpty():
            break
        out = out.union(grow.select(*out.columns))
    return out.select("src", "ord", "dst", "length", "sofar")


def relations(edges: DataFrame, config: Graph = Graph()) -> DataFrame:
    """(src, relation, dst) for all immediate relations.

    to: the best successor, if the segment is in turn its best predecessor, else merges_into;
    turns_into and u_turns_into: other followers by direction; from, merged_by and
    opposite_direction: the reverse views; merges_with: others that merge into the same one;
    crosses: segments into the same node that neither follow nor merge.
    """
    t = cut(turns(edges, u_turns=True))
    succ, pred = cut(best_successor(edges, config=config)), cut(best_predecessor(edges, config=config))
    mutual = succ.join(pred.select("src", "dst"), ["src", "dst"], "left_semi").select("src", "dst")
    merge = succ.select("src", "dst").join(mutual, ["src", "dst"], "left_anti")
    rest = t.where("su <> dv").select("src", "dst", "direction").join(succ.select("src", "dst"), ["src", "dst"], "left_anti")
    named = lambda df, r: df.select("src", F.lit(r).alias("relation"), "dst")
    swap = lambda df: df.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    back = t.where("su = dv").select("src", "dst")
    pairs = merge.select("src", F.col("dst").alias("into"))
    along = pairs.join(succ.select(F.col("src").alias("dst"), F.col("dst").alias("into")), "into").where("src <> dst").select("src", "dst")
    into = edges.select("segment_id", "v", "h_out")
    meet = into.select(F.col("segment_id").alias("src"), "v", F.col("h_out").alias("ha")).join(into.select(F.col("segment_id").alias("dst"), "v", F.col("h_out").alias("hb")), "v").where("src <> dst")
    cross = meet.where(F.abs(turned(F.col("hb"), F.col("ha"))).between(config.straight, 180 - config.straight)).select("src", "dst").join(along.union(swap(along)), ["src", "dst"], "left_anti")
    parts = [
        named(mutual, "to"), named(swap(mutual), "from"), named(merge, "merges_into"), named(swap(merge), "merged_by"), named(rest.where("direction in ('left', 'right', 'straight')"), "turns_into"),
        named(back, "u_turns_into"), named(back, "opposite_direction"), named(along.distinct(), "merges_with"), named(cross.where("src < dst"), "crosses"), named(cross.where("src > dst"), "crossed_by"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.distinct()


def mutual(crossing: DataFrame) -> DataFrame:
    """(src, relation, dst): crosses that hold both ways become intersects_with."""
    both = crossing.join(crossing.select(F.col("dst").alias("src"), F.col("src").alias("dst")), ["src", "dst"], "left_semi").withColumn("relation", F.lit("intersects_with"))
    one = crossing.join(both.select("src", "dst"), ["src", "dst"], "left_anti").withColumn("relation", F.lit("crosses"))
    return both.unionByName(one).select("src", "relation", "dst")


def structural_u_turns(edges: DataFrame, banned: list[str]) -> DataFrame:
    """(src, dst): U-turns at nodes that are more than a road's bend, on roads that allow them."""
    t = turns(edges, u_turns=True).where("su = dv")
    n_in = edges.groupBy(F.col("v").alias("node")).agg(F.count(F.lit(1)).alias("n_in"))
    n_out = edges.groupBy(F.col("u").alias("node")).agg(F.count(F.lit(1)).alias("n_out"))
    kind = edges.select(F.col("segment_id").alias("src"), F.lower("highway").alias("highway"))
    out = t.join(n_in, "node").join(n_out, "node").join(kind, "src")
    return out.where(~(F.col("highway").isin(*banned) | ((F.col("n_in") <= 2) & (F.col("n_out") <= 2)))).select("src", "dst")


def dedupe_relations(rel: DataFrame, rank: list[str]) -> DataFrame:
    """Of several relations between two segments, the first by rank."""
    place = F.array_position(F.lit(rank), F.col("relation"))
    return rel.withColumn("__n", F.row_number().over(Window.partitionBy("src", "dst").orderBy(place, "relation"))).where("__n = 1").drop("__n")


def without_bypasses(rel: DataFrame, links: DataFrame) -> DataFrame:
    """Drop src -> dst where src -> link -> dst exists as well."""
    a = rel.join(links.select(F.col("segment_id").alias("dst")), "dst", "left_semi").select("src", F.col("dst").alias("mid"))
    over = a.join(rel.select(F.col("src").alias("mid"), "dst"), "mid").select("src", "dst").distinct()
    return rel.join(over, ["src", "dst"], "left_anti")


def same_name_turns(edges: DataFrame, config: Graph = Graph()) -> DataFrame:
    """(src, dst): turns to drop because a link also leads to a road of that name in nearly
    the same direction."""
    t = turns(edges).where("direction in ('left', 'right')").select("src", "dst")
    facts = edges.select(F.col("segment_id").alias("id"), "way", "h_in", "is_link")
    way = lambda p: facts.select(F.col("id").alias(p), F.col("way").alias(f"{p}_way"), F.col("h_in").alias(f"{p}_h"), F.col("is_link").alias(f"{p}_link"))
    over = t.select("src", F.col("dst").alias("mid")).join(way("mid"), "mid").where("mid_link")
    over = over.join(turns(edges).select(F.col("src").alias("mid"), F.col("dst").alias("end")), "mid").join(way("end"), "end")
    return t.join(way("dst"), "dst").join(over, "src").where((F.col("dst_way") == F.col("end_way")) & (F.abs(turned(F.col("dst_h"), F.col("end_h"))) <= config.parallel)).select("src", "dst").distinct()


def junction_paths(edges: DataFrame, depth: int) -> DataFrame:
    """(src, path, dst, n): ways from a segment through junction segments to one that isn't.

    All paths without repeats, of at most ``depth`` junction segments.
    """
    t = turns(edges).join(edges.select(F.col("segment_id").alias("dst"), F.col("is_junction").alias("inner")), "dst").select("src", "dst", "inner")
    t = cut(t)
    hop = t.select(F.col("src").alias("at"), F.col("dst").alias("next"), F.col("inner").alias("next_inner"))
    begin = t.join(edges.where("not is_junction").select(F.col("segment_id").alias("src")), "src", "left_semi").where("inner")
    grow = begin.select("src", F.array("dst").alias("path"), F.col("dst").alias("at"))
    out = None
    for n in range(1, depth + 1):
        made = grow.join(hop, "at").where("next <> src and not array_contains(path, next)")
        ends = made.where("not next_inner").select("src", "path", F.col("next").alias("dst"), F.lit(n).alias("n"))
        out = ends if out is None else out.union(ends)
        grow = cut(made.where("next_inner").select("src", F.concat("path", F.array("next")).alias("path"), F.col("next").alias("at")))
        if grow.isEmpty():
            break
    return out


def bypassed(edges: DataFrame, depth: int = 10, restrictions: DataFrame | None = None) -> DataFrame:
    """(src, relation, dst, n): relations through junctions, by direction over the whole way.

    restrictions: (src, via, dst) with an array of ways; a path that holds the vias in order
    is not allowed.
    """
    p = junction_paths(edges, depth)
    if restrictions is not None:
        r = restrictions.select("src", "dst", "via")
        p = p.join(r, (p.src == r.src) & (p.dst == r.dst) & subsequence(F.col("via"), p.path), "left_anti")
    facts = edges.select("segment_id", "h_in", "h_out", "u", "v")
    a = facts.select(F.col("segment_id").alias("src"), F.col("h_out").alias("ha"), F.col("u").alias("su"))
    b = facts.select(F.col("segment_id").alias("dst"), F.col("h_in").alias("hb"), F.col("v").alias("dv"))
    way = turn_class_through(turned(F.col("hb"), F.col("ha")))
    rel = F.when(F.col("su") == F.col("dv"), "u_turns_into").when(way == "straight", "to").when(way == "u_turn", "u_turns_into").otherwise("turns_into")
    return dedupe_relations(p.join(a, "src").join(b, "dst").groupBy("src", rel.alias("relation"), "dst").agg(F.min("n").alias("n")), ["to", "merges_into", "turns_into", "u_turns_into"])


def subsequence(few: Column, many: Column) -> Column:
    """Whether the elements of ``few`` occur in ``many`` in their order."""
    return F.aggregate(many, F.lit(0), lambda i, x: F.when(F.try_element_at(few, i + 1) == x, i + 1).otherwise(i)) >= F.size(few)


def junctions(edges: DataFrame, short: float, degree: int, tagged: list[str]) -> DataFrame:
    """segment_id and the rules that make it a junction: short between crossings, or tagged."""
    d = edges.select(F.explode(F.array("u", "v")).alias("node"), "segment_id").groupBy("node").agg(F.countDistinct("segment_id").alias("deg"))
    out = edges.join(d.select(F.col("node").alias("u"), F.col("deg").alias("du")), "u").join(d.select(F.col("node").alias("v"), F.col("deg").alias("dv")), "v")
    shape = (F.col("length") <= short) & (F.col("du") >= degree) & (F.col("dv") >= degree)
    return out.select("segment_id", shape.alias("is_shape_junction"), F.lower("highway").isin(*tagged).alias("is_semantic_junction"), (shape | F.lower("highway").isin(*tagged)).alias("is_internal_junction"))


def contracted(edges: DataFrame) -> DataFrame:
    """(segment_id, chain_id, ord): runs of segments through nodes with one way in and one
    way out and equal lanes become one chain, named by its first segment.

    Pointer jumping: each round doubles how far a segment knows its way back.
    """
    n_in = edges.groupBy(F.col("v").alias("node")).agg(F.count(F.lit(1)).alias("a"), F.first("segment_id").alias("prev"), F.first("lanes").alias("la"), F.first("u").alias("pu"))
    n_out = edges.groupBy(F.col("u").alias("node")).agg(F.count(F.lit(1)).alias("b"), F.first("segment_id").alias("next"), F.first("lanes").alias("lb"), F.first("v").alias("nv"))
    link = n_in.join(n_out, "node").where("a = 1 and b = 1 and la = lb and pu <> nv").select(F.col("next").alias("segment_id"), "prev")
    now = cut(edges.select("segment_id").join(link, "segment_id", "left").select("segment_id", F.coalesce("prev", "segment_id").alias("head"), F.col("prev").isNotNull().cast("int").alias("ord")))
    changed = -1
    for _ in range(30):
        other = now.select(F.col("segment_id").alias("head"), F.col("head").alias("h2"), F.col("ord").alias("o2"))
        now = cut(now.join(other, "head").select("segment_id", F.col("h2").alias("head"), (F.col("ord") + F.col("o2")).alias("ord")))
        total = now.agg(F.sum("ord")).first()[0]
        if total == changed:
            break
        changed = total
    return now.select("segment_id", F.col("head").alias("chain_id"), "ord")


def rewired(edges: DataFrame, depth: int) -> DataFrame:
    """(src, relation, dst, chain): what a segment leads straight to through junction segments,
    with the junction segments in between, and the same seen from the other end, reversed. Of
    several ways the one with fewest segments, then the first by their ids."""
    best = junction_paths(edges, depth).groupBy("src", "dst").agg(F.min(F.struct("n", "path")).alias("m")).select("src", "dst", F.col("m.path").alias("chain"))
    best = best.join(bypassed(edges, depth).where("relation = 'to'").select("src", "dst"), ["src", "dst"], "left_semi")
    there = best.select("src", F.lit("to").alias("relation"), "dst", "chain")
    return there.union(best.select(F.col("dst").alias("src"), F.lit("from").alias("relation"), F.col("src").alias("dst"), F.reverse("chain").alias("chain")))
