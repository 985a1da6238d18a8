"""Queries over the directed graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import Graph
from ..functions import scalar as S
from ..operators import graph as G
from . import views as V
from .base import book

QUERIES, SQL, query = book()

DEPTH = Graph().depth


def _edges(spark, d):
    return G.headed(V.edges(spark, d))


_H = "h AS (SELECT *, degrees(atan2(y2 - y1, x2 - x1)) AS hd, lower(highway) LIKE '%\\_link' ESCAPE '\\' AS is_link FROM edges)"
_DELTA = "((({b} - {a} + 180) % 360 + 360) % 360 - 180)"
_CLASS = "CASE WHEN abs(delta) <= 25 THEN 'straight' WHEN delta > 25 AND delta <= 120 THEN 'left' WHEN delta >= -120 AND delta < -25 THEN 'right' WHEN abs(delta) >= 170 THEN 'u_turn' END"
_T = f"""{_H}, t AS (SELECT *, {_CLASS} AS direction FROM (SELECT a.segment_id AS src, b.segment_id AS dst, a.u AS su, a.v AS node, b.v AS dv, {_DELTA.format(a="a.hd", b="b.hd")} AS delta, a.name = b.name AS same_way, a.is_link AS src_link, b.is_link AS dst_link, b.is_junction AS inner_dst
    FROM h a JOIN h b ON a.v = b.u))"""
_SUCC = f"{_T}, s AS (SELECT * FROM t WHERE su <> dv AND abs(delta) <= CASE WHEN same_way THEN 60 ELSE 45 END QUALIFY row_number() OVER (PARTITION BY src ORDER BY abs(delta), dst) = 1)"
_PRED = "p AS (SELECT * FROM t WHERE su <> dv AND abs(delta) <= 75 QUALIFY row_number() OVER (PARTITION BY dst ORDER BY src_link, abs(delta), src) = 1)"


@query(f"WITH {_T} SELECT src, dst, round(delta, 4) AS delta, direction FROM t WHERE su <> dv")
def heading_delta_class(spark, d):
    return G.turns(_edges(spark, d)).select("src", "dst", F.round("delta", 4).alias("delta"), "direction")


@query(f"WITH {_SUCC} SELECT src, dst, round(delta, 4) AS delta FROM s")
def best_successor(spark, d):
    return G.best_successor(_edges(spark, d)).select("src", "dst", F.round("delta", 4).alias("delta"))


@query(f"""
    WITH {_T}, ban AS (SELECT src, dst FROM t WHERE su <> dv AND node % 6 = 0 AND direction = 'straight'), must AS (SELECT src, min(dst) AS must FROM t WHERE su <> dv AND node % 5 = 0 AND direction = 'right' GROUP BY 1)
    SELECT src, dst, round(delta, 4) AS delta FROM (SELECT t.*, must FROM t LEFT JOIN must USING (src) WHERE su <> dv AND (must IS NULL OR must = dst)) ANTI JOIN ban USING (src, dst) WHERE must IS NOT NULL OR abs(delta) <= CASE WHEN same_way THEN 60 ELSE 45 END
    QUALIFY row_number() OVER (PARTITION BY src ORDER BY abs(delta), dst) = 1
""")
def restricted_successor(spark, d):
    e = _edges(spark, d)
    t = G.turns(e)
    only = t.where("node % 5 = 0 and direction = 'right'").groupBy("src").agg(F.min("dst").alias("dst"))
    return G.best_successor(e, t.where("node % 6 = 0 and direction = 'straight'"), only).select("src", "dst", F.round("delta", 4).alias("delta"))


@query(f"WITH {_T}, {_PRED} SELECT dst, src, round(delta, 4) AS delta FROM p")
def best_predecessor(spark, d):
    return G.best_predecessor(_edges(spark, d)).select("dst", "src", F.round("delta", 4).alias("delta"))


def _chain(step: str, first: str, at: str, to: str) -> str:
    return f"""
    WITH RECURSIVE {_SUCC}, {_PRED}, x AS (SELECT {at} AS here, {to} AS nxt, length FROM {step} JOIN edges e ON e.segment_id = {to}),
    stop AS ({first}),
    c AS (SELECT here AS src, 1 AS ord, nxt AS dst, length AS sofar, [here, nxt] AS path, (here, nxt) IN (SELECT src, dst FROM stop) AS ends FROM x WHERE here <> nxt
          UNION ALL SELECT c.src, c.ord + 1, x.nxt, c.sofar + x.length, list_append(c.path, x.nxt), false FROM c JOIN x ON x.here = c.dst WHERE c.sofar < 350 AND NOT c.ends AND NOT list_contains(c.path, x.nxt))
    SELECT src, ord::BIGINT AS ord, dst, round(sofar, 4) AS sofar FROM c"""


@query(_chain("s", "SELECT src, dst FROM s ANTI JOIN p USING (src, dst)", "src", "dst"))
def successor_chain(spark, d):
    e = _edges(spark, d)
    succ, pred = G.best_successor(e), G.best_predecessor(e)
    stop = succ.join(pred.select("src", "dst"), ["src", "dst"], "left_anti")
    return G.chain(succ, e, 350.0, stop).select("src", F.col("ord").cast("bigint").alias("ord"), "dst", F.round("sofar", 4).alias("sofar"))


@query(_chain("p", "SELECT '' AS src, '' AS dst", "dst", "src"))
def predecessor_chain(spark, d):
    e = _edges(spark, d)
    back = G.best_predecessor(e).select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return G.chain(back, e, 350.0).select("src", F.col("ord").cast("bigint").alias("ord"), "dst", F.round("sofar", 4).alias("sofar"))


_REL = f"""{_SUCC}, {_PRED}, mu AS (SELECT src, dst FROM s SEMI JOIN p USING (src, dst)), me AS (SELECT src, dst FROM s ANTI JOIN p USING (src, dst)),
    al AS (SELECT DISTINCT me.src, s.src AS dst FROM me JOIN s ON s.dst = me.dst WHERE me.src <> s.src),
    cr AS (SELECT * FROM (SELECT a.segment_id AS src, b.segment_id AS dst FROM h a JOIN h b ON a.v = b.v AND a.segment_id <> b.segment_id WHERE abs({_DELTA.format(a="a.hd", b="b.hd")}) BETWEEN 25 AND 155) ANTI JOIN (SELECT src, dst FROM al UNION SELECT dst, src FROM al) USING (src, dst)),
    rel AS (SELECT src, 'to' AS relation, dst FROM mu UNION SELECT dst, 'from', src FROM mu UNION SELECT src, 'merges_into', dst FROM me UNION SELECT dst, 'merged_by', src FROM me
        UNION SELECT src, 'turns_into', dst FROM (SELECT * FROM t WHERE su <> dv AND direction IN ('left', 'right', 'straight')) ANTI JOIN s USING (src, dst)
        UNION SELECT src, 'u_turns_into', dst FROM t WHERE su = dv UNION SELECT src, 'opposite_direction', dst FROM t WHERE su = dv UNION SELECT src, 'merges_with', dst FROM al
        UNION SELECT src, 'crosses', dst FROM cr WHERE src < dst UNION SELECT src, 'crossed_by', dst FROM cr WHERE src > dst)"""


def _relation(name: str):
    def run(spark, d):
        return G.relations(_edges(spark, d)).where(F.col("relation") == name).select("src", "dst")

    run.__name__ = f"relation_{name}"
    return query(f"WITH {_REL} SELECT src, dst FROM rel WHERE relation = '{name}'")(run)


for _name in ("to", "merges_into", "turns_into", "opposite_direction", "merges_with", "crosses"):
    _relation(_name)


@query(f"WITH {_REL} SELECT relation, count(*) AS n FROM rel GROUP BY 1")
def relation_counts(spark, d):
    return G.relations(_edges(spark, d)).groupBy("relation").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
    WITH {_T}, c AS (SELECT src, dst FROM t WHERE su <> dv AND direction IN ('left', 'right') UNION SELECT dst, src FROM t WHERE su <> dv AND direction = 'left' AND node % 2 = 0)
    SELECT src, CASE WHEN (dst, src) IN (SELECT src, dst FROM c) THEN 'intersects_with' ELSE 'crosses' END AS relation, dst FROM c
""")
def mutual_intersections(spark, d):
    t = G.turns(_edges(spark, d))
    c = t.where("direction in ('left', 'right')").select("src", "dst").union(t.where("direction = 'left' and node % 2 = 0").select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    return G.mutual(c)


@query(f"""
    WITH {_T} SELECT src, dst FROM t JOIN (SELECT v AS node, count(*) AS a FROM edges GROUP BY 1) USING (node) JOIN (SELECT u AS node, count(*) AS b FROM edges GROUP BY 1) USING (node)
    JOIN (SELECT segment_id AS src, lower(highway) AS hw FROM edges) USING (src) WHERE su = dv AND NOT (hw = 'primary' OR (a <= 2 AND b <= 2))
""")
def structural_u_turns(spark, d):
    return G.structural_u_turns(_edges(spark, d), ["primary"])


_RANKED = f"{_T}, r AS (SELECT src, 'to' AS relation, dst FROM t WHERE abs(delta) <= 60 UNION ALL SELECT src, 'turns_into', dst FROM t WHERE direction IN ('left', 'right') UNION ALL SELECT src, 'u_turns_into', dst FROM t WHERE su = dv OR abs(delta) > 100)"


def _ranked(spark, d):
    t = G.turns(_edges(spark, d), u_turns=True)
    part = lambda c, r: t.where(c).select("src", F.lit(r).alias("relation"), "dst")
    return part("abs(delta) <= 60", "to").union(part("direction in ('left', 'right')", "turns_into")).union(part("su = dv or abs(delta) > 100", "u_turns_into"))


@query(f"WITH {_RANKED} SELECT src, relation, dst FROM r QUALIFY row_number() OVER (PARTITION BY src, dst ORDER BY list_position(['to', 'merges_into', 'turns_into', 'u_turns_into'], relation)) = 1")
def relation_priority_dedupe(spark, d):
    return G.dedupe_relations(_ranked(spark, d), ["to", "merges_into", "turns_into", "u_turns_into"])


@query(f"""
    WITH {_RANKED}, q AS (SELECT src, dst FROM r UNION SELECT a.src, b.dst FROM t a JOIN t b ON a.dst = b.src WHERE a.su <> a.dv AND b.su <> b.dv AND (a.dst_link OR a.src::BIGINT % 6 = 0))
    SELECT src, dst FROM q ANTI JOIN (SELECT a.src, b.dst FROM q a JOIN q b ON a.dst = b.src JOIN h ON h.segment_id = a.dst AND h.is_link) USING (src, dst)
""")
def bypass_removal(spark, d):
    """Direct relations, and some over two hops; those that a link also leads to go."""
    e = _edges(spark, d)
    t = G.turns(e)
    two = t.select("src", F.col("dst").alias("mid"), "dst_link").join(t.select(F.col("src").alias("mid"), "dst"), "mid").where("dst_link or cast(src as bigint) % 6 = 0")
    rel = _ranked(spark, d).select("src", "dst").union(two.select("src", "dst")).distinct()
    return G.without_bypasses(rel, e.where("is_link"))


@query(f"""
    WITH {_T}, x AS (SELECT src, dst FROM t WHERE su <> dv AND direction IN ('left', 'right'))
    SELECT DISTINCT x.src, x.dst FROM x JOIN x m ON m.src = x.src JOIN h mid ON mid.segment_id = m.dst AND mid.is_link JOIN t n ON n.src = m.dst AND n.su <> n.dv JOIN h e ON e.segment_id = n.dst JOIN h g ON g.segment_id = x.dst
    WHERE g.name = e.name AND abs({_DELTA.format(a="e.hd", b="g.hd")}) <= 60
""")
def same_name_turn_drop(spark, d):
    return G.same_name_turns(_edges(spark, d))


_PATHS = f"""{_T}, c AS (SELECT t.src, [t.dst] AS path, t.dst AS here, 1 AS n, false AS done FROM t JOIN h ON h.segment_id = t.src AND NOT h.is_junction WHERE su <> dv AND inner_dst
    UNION ALL SELECT c.src, CASE WHEN t.inner_dst THEN list_append(path, t.dst) ELSE path END, t.dst, c.n + t.inner_dst::INT, NOT t.inner_dst FROM c JOIN t ON t.src = c.here AND t.su <> t.dv WHERE NOT done AND t.dst <> c.src AND NOT list_contains(path, t.dst) AND c.n + t.inner_dst::INT <= {DEPTH})"""


@query(f"WITH RECURSIVE {_PATHS} SELECT src, array_to_string(path, '>') AS path, here AS dst, n::BIGINT AS n FROM c WHERE done")
def junction_chain_paths(spark, d):
    return G.junction_paths(_edges(spark, d), DEPTH).select("src", F.array_join("path", ">").alias("path"), "dst", F.col("n").cast("bigint").alias("n"))


@query(f"""
    WITH RECURSIVE {_PATHS}, k AS (SELECT c.src, c.here AS dst, min(c.n) AS n FROM c WHERE done GROUP BY 1, 2), w AS (SELECT k.*, a.u AS su, b.v AS dv, {_DELTA.format(a="a.hd", b="b.hd")} AS delta FROM k JOIN h a ON a.segment_id = k.src JOIN h b ON b.segment_id = k.dst)
    SELECT src, CASE WHEN su = dv OR abs(delta) >= 170 THEN 'u_turns_into' WHEN abs(delta) > 25 THEN 'turns_into' ELSE 'to' END AS relation, dst, n::BIGINT AS n FROM w
""")
def junction_bypass(spark, d):
    return G.bypassed(_edges(spark, d), DEPTH).select("src", "relation", "dst", F.col("n").cast("bigint").alias("n"))


@query(f"""
    WITH RECURSIVE {_PATHS}, w AS (SELECT src, here AS dst, path FROM c WHERE done), bad AS (SELECT DISTINCT src, dst, path[1] AS via FROM w WHERE len(path) >= 2 AND src::BIGINT % 3 = 0)
    SELECT src, array_to_string(path, '>') AS path, dst FROM w WHERE NOT EXISTS (SELECT 1 FROM bad WHERE bad.src = w.src AND bad.dst = w.dst AND list_contains(w.path, bad.via))
""")
def restricted_paths(spark, d):
    return _allowed(G.junction_paths(_edges(spark, d), DEPTH))


def _allowed(p):
    r = p.where("size(path) >= 2 and cast(src as bigint) % 3 = 0").select(F.col("src").alias("rs"), F.col("dst").alias("rd"), F.slice("path", 1, 1).alias("via")).distinct()
    return p.join(r, (p.src == r.rs) & (p.dst == r.rd) & G.subsequence(r.via, p.path), "left_anti").select("src", F.array_join("path", ">").alias("path"), "dst")


@query("""
    WITH d AS (SELECT node, count(DISTINCT segment_id) AS deg FROM (SELECT u AS node, segment_id FROM edges UNION ALL SELECT v, segment_id FROM edges) GROUP BY 1)
    SELECT segment_id, length <= 120 AND a.deg >= 7 AND b.deg >= 7 AS is_shape_junction, lower(highway) = 'primary_link' AS is_semantic_junction, (length <= 120 AND a.deg >= 7 AND b.deg >= 7) OR lower(highway) = 'primary_link' AS is_internal_junction
    FROM edges e JOIN d a ON a.node = e.u JOIN d b ON b.node = e.v
""")
def junction_classification(spark, d):
    return G.junctions(_edges(spark, d), 120.0, 7, ["primary_link"])


_ONE = "one AS (SELECT segment_id, u, v, CASE WHEN name = 'Row 1' THEN 1 ELSE lanes END AS lanes FROM edges WHERE kind = 'h' AND floor(u / 10) % 4 = 1)"


@query(f"""
    WITH RECURSIVE {_ONE}, l AS (SELECT b.segment_id AS id, a.segment_id AS prev FROM one a JOIN one b ON a.v = b.u WHERE a.lanes = b.lanes AND a.u <> b.v AND (SELECT count(*) FROM one x WHERE x.v = a.v) = 1 AND (SELECT count(*) FROM one x WHERE x.u = a.v) = 1),
    c AS (SELECT segment_id, segment_id AS chain_id, 0 AS ord FROM one WHERE segment_id NOT IN (SELECT id FROM l) UNION ALL SELECT l.id, c.chain_id, c.ord + 1 FROM c JOIN l ON l.prev = c.segment_id)
    SELECT segment_id, chain_id, ord::BIGINT AS ord FROM c
""")
def chain_contraction(spark, d):
    one = _edges(spark, d).where("kind = 'h' and floor(u / 10) % 4 = 1").withColumn("lanes", F.when(F.col("name") == "Row 1", 1).otherwise(F.col("lanes")))
    return G.contracted(one).select("segment_id", "chain_id", F.col("ord").cast("bigint").alias("ord"))


@query("SELECT DISTINCT least(u, v) AS a, greatest(u, v) AS b FROM edges")
def undirected_pairs(spark, d):
    return V.edges(spark, d).select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()


@query("SELECT v AS node, concat('c_', left(sha1(string_agg(segment_id, ',' ORDER BY segment_id::BIGINT)), 12)) AS controller_id, count(*) AS approaches, avg(x1) AS x, avg(y1) AS y FROM edges GROUP BY 1")
def controller_hash_ids(spark, d):
    g = V.edges(spark, d).groupBy(F.col("v").alias("node")).agg(F.collect_list(F.col("segment_id").cast("bigint")).alias("ids"), F.count(F.lit(1)).alias("approaches"), F.avg("x1").alias("x"), F.avg("y1").alias("y"))
    return g.select("node", F.concat(F.lit("c_"), S.group_id("ids")).alias("controller_id"), "approaches", "x", "y")


@query("""
    WITH c AS (SELECT v AS node, list(segment_id) AS approach, list(segment_id) FILTER (is_junction) AS inner_ids FROM edges GROUP BY 1), ok AS (SELECT segment_id FROM edges WHERE lanes > 1)
    SELECT node, (SELECT count(*) FROM ok WHERE list_contains(approach, segment_id)) AS approaches, (SELECT count(*) FROM ok WHERE list_contains(coalesce(inner_ids, []), segment_id)) AS junctions FROM c WHERE (SELECT count(*) FROM ok WHERE list_contains(approach, segment_id)) > 0
""")
def controller_filter(spark, d):
    e = V.edges(spark, d)
    long = e.select(F.col("v").alias("node"), "segment_id", "is_junction").join(e.where("lanes > 1").select("segment_id"), "segment_id", "left_semi")
    return long.groupBy("node").agg(F.count(F.lit(1)).alias("approaches"), F.count_if("is_junction").alias("junctions"))


@query("""
    SELECT segment_id, arg_min(role, rank) AS role, arg_min(node, (rank, node)) AS controller FROM (
        SELECT segment_id, 'approach' AS role, 1 AS rank, v AS node FROM edges WHERE v % 4 = 0 UNION ALL SELECT segment_id, 'junction', 2, u FROM edges WHERE u % 4 = 0) GROUP BY 1
""")
def controller_mapping(spark, d):
    e = V.edges(spark, d)
    both = e.where("v % 4 = 0").select("segment_id", F.lit("approach").alias("role"), F.lit(1).alias("rank"), F.col("v").alias("node")).union(e.where("u % 4 = 0").select("segment_id", F.lit("junction"), F.lit(2), F.col("u")))
    return both.groupBy("segment_id").agg(F.min(F.struct("rank", "node", "role")).alias("m")).select("segment_id", "m.role", F.col("m.node").alias("controller"))


@query(f"WITH {_REL} SELECT src AS segment_id, relation, concat(count(*), ' segments (', round(sum(length), 1), ' m)') AS summary FROM rel JOIN edges e ON e.segment_id = dst GROUP BY 1, 2")
def adjacency_summary(spark, d):
    e = _edges(spark, d)
    rel = G.relations(e).join(e.select(F.col("segment_id").alias("dst"), "length"), "dst")
    return rel.groupBy(F.col("src").alias("segment_id"), "relation").agg(F.concat(F.count(F.lit(1)).cast("string"), F.lit(" segments ("), F.round(F.sum("length"), 1).cast("string"), F.lit(" m)")).alias("summary"))
