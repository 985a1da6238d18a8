"""Readers: ragged track texts, CSV with schemas, JSON maps, GeoPackage tables, file discovery."""

from __future__ import annotations

import json
import sqlite3
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT_FIELDS = ["lat", "lon", "speed", "lon_acc", "lat_acc", "time"]

TRAJ = "track_id string, type string, traveled_d double, avg_speed double, lat double, lon double, speed double, lon_acc double, lat_acc double, time double"
MATCHED = TRAJ + ", x double, y double, matched_u long, matched_v long, azcar double, signed_dist double, segment_id string, num_lanes int, segment_length double, prop_dist double, rel_heading double, t_proj double, highway string, controller_id string, dist_to_controller double, D double, lane_index int, is_outlier boolean"


def conform(df: DataFrame, schema: str, defaults: dict | None = None) -> DataFrame:
    """The columns of a schema in its order, cast; missing ones get a default or null."""
    wanted = T._parse_datatype_string(schema)
    have, defaults = set(df.columns), defaults or {}
    cols = [(F.col(f"`{f.name}`") if f.name in have else F.lit(defaults.get(f.name))).cast(f.dataType).alias(f.name) for f in wanted.fields]
    return df.select(*cols)


def parse_lines(lines: DataFrame, column: str = "value", skip: str = "Motorcycle") -> DataFrame:
    """Long points from ragged lines 'id; type; distance; speed km/h; (6 numbers)*'.

    Header lines, lines of fewer than four fields and skipped types give nothing; a tuple
    that is short or isn't numeric is left out. Speeds become metres a second.
    """
    part = F.split(F.col(column), ";")
    rows = lines.where(~F.col(column).contains("track_id")).select(part.alias("p")).where(F.size("p") >= 4)
    field = lambda i: F.trim(F.get("p", F.lit(i) if isinstance(i, int) else i))
    number = lambda i: field(i).try_cast("double")
    head = rows.select(field(0).alias("track_id"), field(1).alias("type"), number(2).alias("traveled_d"), (number(3) / 3.6).alias("avg_speed"), "p").where(F.col("type") != skip)
    n = F.size("p")
    at = F.when(n >= 6, F.sequence(F.lit(4), n - 2, F.lit(6))).otherwise(F.array().cast("array<int>"))
    points = F.transform(at, lambda i: F.struct(*[(number(i + k) / 3.6 if f == "speed" else number(i + k)).alias(f) for k, f in enumerate(POINT_FIELDS)]))
    whole = F.filter(points, lambda p: p.lat.isNotNull() & p.lon.isNotNull() & p.speed.isNotNull() & p.lon_acc.isNotNull() & p.lat_acc.isNotNull() & p.time.isNotNull())
    return head.select("track_id", "type", "traveled_d", "avg_speed", F.inline(whole))


def ragged(spark: SparkSession, path: str) -> DataFrame:
    return parse_lines(spark.read.text(path))


def limited_test(lines: DataFrame, share: float = 0.05, skip: str = "Motorcycle") -> DataFrame:
    """The first lines for a trial run: max(1, 5 % of the lines that count)."""
    ok = lines.where(~F.col("value").contains("track_id")).where(F.trim(F.get(F.split("value", ";"), F.lit(1))) != skip)
    return ok.limit(max(1, int(ok.count() * share)))


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)


def json_map(spark: SparkSession, path: str, value: str) -> DataFrame:
    """(key, value) rows of a JSON document that is one object; value: the values' type."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", f"map<string,{value}>")).alias("key", "value"))


def discovered(spark: SparkSession, folder: str, preferences: list[str]) -> DataFrame:
    """(folder, path): for each folder the file whose name comes first in the preferences."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    name, home = F.element_at(F.split("path", "/"), -1), F.regexp_replace("path", "/[^/]*$", "")
    rank = F.lit(None).cast("int")
    for i, p in reversed(list(enumerate(preferences))):
        rank = F.when(name.endswith(p), F.lit(i)).otherwise(rank)
    ranked = files.select(home.alias("folder"), "path", rank.alias("rank")).where("rank is not null")
    first = Window.partitionBy("folder").orderBy("rank", "path")
    return ranked.withColumn("n", F.row_number().over(first)).where("n = 1").select("folder", "path")


def line_of_blob(blob: bytes) -> list[tuple[float, float]]:
    """Vertices of a GeoPackage LineString (header, optional envelope, then WKB)."""
    if blob is None or blob[:2] != b"GP":
        return []
    envelope = {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}[(blob[3] >> 1) & 7]
    wkb = blob[8 + envelope :]
    order = "<" if wkb[0] == 1 else ">"
    kind, n = struct.unpack(order + "II", wkb[1:9])
    width = 2 + (kind // 1000 in (1, 2)) + 2 * (kind // 1000 == 3)
    flat = struct.unpack(f"{order}{n * width}d", wkb[9 : 9 + 8 * n * width])
    return [(flat[i], flat[i + 1]) for i in range(0, n * width, width)]


def geopackage(spark: SparkSession, path: str, table: str, schema: str, geometry: str = "geom") -> DataFrame:
    """Rows of a GeoPackage table with its lines as array<struct<x,y>> in column 'line'.

    A file is read by one task (it is one SQLite database); many files by as many tasks.
    Files reach the task by Spark's own reader, so any store will do.
    """
    wanted = T._parse_datatype_string(schema)
    names = [f.name for f in wanted.fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for blob in pdf["content"]:
                db = sqlite3.connect(":memory:")
                db.deserialize(bytes(blob))
                cols = ", ".join(f'"{n}"' for n in names)
                cursor = db.execute(f'select {cols}, "{geometry}" from "{table}"')
                while rows := cursor.fetchmany(10_000):
                    out = pd.DataFrame([r[:-1] for r in rows], columns=names)
                    out["line"] = [[{"x": x, "y": y} for x, y in line_of_blob(r[-1])] for r in rows]
                    yield out

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(run, f"{schema}, line array<struct<x:double,y:double>>")


def ways(spark: SparkSession, path: str, kinds: list[str]) -> DataFrame:
    """Road ways from a file of map elements (JSON lines), of the wanted highway kinds."""
    raw = spark.read.schema("type string, id long, tags map<string,string>, nodes array<long>").json(path)
    return raw.where("type = 'way'").where(F.col("tags")["highway"].isin(*kinds)).select("id", F.col("tags")["highway"].alias("highway"), F.col("tags")["name"].alias("name"), "nodes")


def restrictions(raw: DataFrame) -> DataFrame:
    """type, from, to, via_ways, via_nodes of turn restrictions (tags, members by role)."""
    def role(r: str, kind: str):
        return F.transform(F.filter("members", lambda m: (m.role == r) & (m.type == kind)), lambda m: m.ref.cast("string"))

    out = raw.select(F.col("tags")["restriction"].alias("type"), F.try_element_at(role("from", "way"), F.lit(1)).alias("from"), F.try_element_at(role("to", "way"), F.lit(1)).alias("to"), role("via", "way").alias("via_ways"), role("via", "node").alias("via_nodes"))
    none = F.array().cast("array<string>")
    return out.where("type is not null and `from` is not null and `to` is not null").withColumns({"via_ways": F.coalesce("via_ways", none), "via_nodes": F.coalesce("via_nodes", none)})


def restriction_kinds(rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(no_*, only_*) restrictions without ways in between, for direct neighbours."""
    direct = rules.where(F.size("via_ways") == 0)
    return direct.where(F.col("type").startswith("no_")), direct.where(F.col("type").startswith("only_"))


def read_json(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)
