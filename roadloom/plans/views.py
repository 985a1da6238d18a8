"""The driver's tables seen as tracks, traversals, road edges and recordings.

Views are written once, in SQL that Spark and DuckDB share, except for the time columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def seconds(ts) -> F.Column:
    """Epoch seconds of a zone-less timestamp, whatever the session's zone."""
    day = F.unix_date(F.to_date(ts)).cast("bigint") * 86_400
    return day + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.expr(f"cast(extract(second from {ts}) as double)")


_TRAJ = """
    SELECT event_id AS row_id, CAST(user_id AS {text}) AS track_id, t, value / 25 AS speed, event_type AS segment_id,
           CASE event_id % 5 WHEN 0 THEN 'Car' WHEN 1 THEN 'Taxi' WHEN 2 THEN 'Bus' WHEN 3 THEN 'Medium Vehicle' ELSE 'Motorcycle' END AS kind,
           CAST((event_id * 37) % 1000 AS DOUBLE) AS x, CAST((event_id * 91) % 1000 AS DOUBLE) AS y,
           CAST(100 + 20 * length(event_type) AS DOUBLE) AS seg_length, value % 100 AS t_proj, event_id % 7 = 0 AS is_outlier
    FROM {events}
"""
TRAJ_SQL = _TRAJ.format(text="VARCHAR", events="(SELECT *, epoch_us(ts) / 1e6 AS t FROM events)")


def traj(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row_id, track_id, t, speed, segment_id, kind, x, y, seg_length, t_proj, is_outlier."""
    events = table(spark, sf_dir, "events").withColumn("t", seconds("ts"))
    return spark.sql(_TRAJ.format(text="STRING", events="{events}"), events=events)


_TRAVERSALS = """
    SELECT o_orderkey AS row_id, o_orderpriority AS segment_id, CAST(o_custkey AS {text}) AS track_id, t AS timestamp, o_totalprice / 10000 AS temporal_mean_speed,
           CAST(o_custkey % 97 AS DOUBLE) / 4 AS spatial_mean_speed, CAST(5 + o_orderkey % 61 AS DOUBLE) AS traversal_time, CAST(o_custkey % 37 AS DOUBLE) AS stopping_duration,
           CAST(100 + 20 * length(o_orderpriority) AS DOUBLE) AS segment_length, o_orderkey % 11 <> 0 AS valid
    FROM {orders}
"""
TRAVERSALS_SQL = _TRAVERSALS.format(text="VARCHAR", orders="(SELECT *, epoch_us(o_orderdate) / 1e6 AS t FROM orders)")


def traversals(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("t", seconds("o_orderdate"))
    return spark.sql(_TRAVERSALS.format(text="STRING", orders="{orders}"), orders=orders)


#: A street grid over the suppliers, ten to a row, with one-way streets, diagonal links and dead ends.
_EDGES = """
    SELECT CAST(u * 100000 + v AS {text}) AS segment_id, u, v, kind, CASE kind WHEN 'h' THEN concat('Row ', CAST(floor(u / 10) AS {int})) WHEN 'v' THEN concat('Col ', CAST(floor(u % 10 / 2) AS {int})) ELSE concat('Link ', u % 7) END AS name,
           CASE WHEN kind = 'd' THEN 'primary_link' WHEN kind = 'h' AND floor(u / 10) % 3 = 0 THEN 'primary' WHEN kind = 'v' AND u % 4 = 0 THEN 'secondary' ELSE 'residential' END AS highway,
           CAST(1 + (u + v) % 4 AS {int}) AS lanes, CAST(u % 10 * 100 AS DOUBLE) AS x1, CAST(floor(u / 10) * 100 AS DOUBLE) AS y1, CASE kind WHEN 's' THEN CAST(u % 10 * 100 + 30 AS DOUBLE) ELSE CAST(v % 10 * 100 AS DOUBLE) END AS x2, CASE kind WHEN 's' THEN CAST(floor(u / 10) * 100 + 40 AS DOUBLE) ELSE CAST(floor(v / 10) * 100 AS DOUBLE) END AS y2,
           CASE kind WHEN 'd' THEN sqrt(20000.0) WHEN 's' THEN 50.0 ELSE 100.0 END AS length, (u * 7 + v * 4) % 5 = 0 AS is_junction
    FROM (
        SELECT n AS u, n + 1 AS v, 'h' AS kind FROM {n} WHERE n % 10 < 9 AND n + 1 < total
        UNION ALL SELECT n + 1, n, 'h' FROM {n} WHERE n % 10 < 9 AND n + 1 < total AND floor(n / 10) % 4 <> 1
        UNION ALL SELECT n, n + 10, 'v' FROM {n} WHERE n + 10 < total
        UNION ALL SELECT n + 10, n, 'v' FROM {n} WHERE n + 10 < total AND n % 5 <> 2
        UNION ALL SELECT n, n + 11, 'd' FROM {n} WHERE n % 10 < 9 AND n + 11 < total AND n * 3 % 7 = 0
        UNION ALL SELECT n, total + n, 's' FROM {n} WHERE n % 17 = 3) e
"""
EDGES_SQL = _EDGES.format(text="VARCHAR", int="BIGINT", n="(SELECT s_suppkey AS n, count(*) OVER () AS total FROM supplier)")


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """segment_id, u, v, kind, name, highway, lanes, x1, y1, x2, y2, length, is_junction."""
    supplier = table(spark, sf_dir, "supplier")
    n = spark.sql("SELECT s_suppkey AS n, (SELECT count(*) FROM {s}) AS total FROM {s}", s=supplier)
    return spark.sql(_EDGES.format(text="STRING", int="BIGINT", n="{n}"), n=n)


#: Ten recordings that each saw most of the edges.
_NETWORKS = "SELECT e.*, r.rec FROM {edges} e, {recs} r WHERE (u * 3 + v * 4 + rec * 11) % 10 < 8 OR is_junction"
NETWORKS_SQL = _NETWORKS.format(edges=f"({EDGES_SQL})", recs="(SELECT unnest(range(10)) AS rec)")


def networks(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = F.explode(F.sequence(F.lit(0), F.lit(9))).alias("rec")
    seen = edges(spark, sf_dir).select("*", recs)
    return seen.where("(u * 3 + v * 4 + rec * 11) % 10 < 8 OR is_junction")


_VOTES = "SELECT CAST(l_suppkey % 50 AS {text}) AS segment_id, l_orderkey AS rec, l_linenumber AS pos, CAST(1 + l_linenumber % 4 AS {int}) AS lanes, l_quantity FROM {lineitem}"
VOTES_SQL = _VOTES.format(text="VARCHAR", int="BIGINT", lineitem="lineitem")


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_VOTES.format(text="STRING", int="BIGINT", lineitem="{lineitem}"), lineitem=table(spark, sf_dir, "lineitem"))


def sql(text: str) -> str:
    """DuckDB SQL with the views that the text names put before it."""
    known = {"traj": TRAJ_SQL, "traversals": TRAVERSALS_SQL, "edges": EDGES_SQL, "networks": NETWORKS_SQL, "votes": VOTES_SQL}
    used = [f"{n} AS ({known[n]})" for n in known if f" {n}" in text]
    body = text.strip()
    recursive = "WITH RECURSIVE" in body
    body = body.removeprefix("WITH RECURSIVE").removeprefix("WITH")
    own = body if text.strip().startswith("WITH") else None
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ", ".join(used) + ((", " + own) if own else "\n" + body) if used else text
