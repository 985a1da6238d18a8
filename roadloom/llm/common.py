"""Helpers that the text operators share: safe column picking, shared storage, hashing."""

from __future__ import annotations

import gc
import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space: what separates words in every operator here.
SPACE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"

M1, M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
S33 = np.uint64(33)


def mix64(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3, over uint64 arrays (wraps silently)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> S33
    x *= M1
    x ^= x >> S33
    x *= M2
    x ^= x >> S33
    return x


def positional(df: DataFrame, prefix: str = "__c") -> tuple[DataFrame, list[str]]:
    """df with unambiguous column names, and the names it had.

    Tables may bring extra columns whose names clash with one another (also by case
    only) or with names that an operator makes; renaming by position avoids both.
    """
    names = df.columns
    return df.toDF(*[f"{prefix}{i}" for i in range(len(names))]), names


def place(names: list[str], name: str) -> int:
    """Where a column stands: its exact name first, else the name in another case."""
    if name in names:
        return names.index(name)
    low = [n.lower() for n in names]
    if name.lower() in low:
        return low.index(name.lower())
    raise ValueError(f"column {name!r} is missing; there are {names}")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, whatever other columns df has."""
    flat, had = positional(df)
    return flat.select(*[F.col(f"__c{place(had, n)}").alias(n) for n in names])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Where nothing is set, a temporary folder serves a session on one machine, as in tests; on
    a cluster it could not, so that is an error.
    """
    sc = spark.sparkContext
    told = spark.conf.get("spark.checkpoint.dir", None)
    if told:
        if sc._jsc.sc().getCheckpointDir().isEmpty():
            sc.setCheckpointDir(told)
        return told
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ckpt-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """df computed once into the shared checkpoint folder; survives lost executors.

    What the optimizer knows about df's columns isn't carried on: in a loop of joins that
    knowledge doubles with every step.
    """
    shared_dir(df.sparkSession)
    with option(df.sparkSession, "spark.sql.constraintPropagation.enabled", "false"):
        return df.checkpoint(eager=True)


def stored(df: DataFrame) -> tuple[DataFrame, str]:
    """(df, place): df as a compressed table of its own in the shared folder."""
    spark = df.sparkSession
    place = f"{shared_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(place)
    return spark.read.schema(df.schema).parquet(place), place


def removed(spark: SparkSession, place: str) -> None:
    """Delete a stored table that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def option(spark: SparkSession, name: str, value: str):
    """A session option for a while."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def no_broadcasts(spark: SparkSession):
    """For a while, no table is broadcast by its size, as planned or as found while running."""
    with option(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"), option(spark, "spark.sql.adaptive.autoBroadcastJoinThreshold", "-1"):
        yield


#: A key is hot with more than 1 / SHARE of the rows, and more than LEAST; FEW rows are one task's work.
SHARE, LEAST, FEW = 512, 500, 50_000


def hot_keys(df: DataFrame, key: list[str], n: str | None = None) -> dict[int, int]:
    """The keys that more than 1 / SHARE of df's rows (and more than LEAST rows) have: fewer
    than SHARE whatever the data, as hash -> number of parts. With n, df has one row for each
    key and n tells how many rows elsewhere have it. df must be cheap to read again (cut, or a
    scan). Up to FEW rows, no key needs parts.
    """
    total = df.count() if n is None else int(df.agg(F.sum(n)).first()[0] or 0)
    if total <= FEW:
        return {}
    limit = max(LEAST, total // SHARE)
    sizes = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n")) if n is None else df.select(*key, F.col(n).alias("__n"))
    found = sizes.where(F.col("__n") > limit).select(F.xxhash64(*key), F.ceil(F.col("__n") / limit).cast("int")).collect()  # fewer than SHARE rows
    return {k: parts for k, parts in found}


def spread_join(big: DataFrame, small: DataFrame, key: list[str], by: Column, hot: dict[int, int], how: str = "inner") -> DataFrame:
    """big joined with small on key, with the hot keys of big dealt over many tasks.

    Rows of a hot key (see ``hot_keys``) go to parts by ``by``, and small's rows of that key
    are repeated once for each part. No row is dropped.
    """
    if not hot:
        return big.join(small, key, how)
    code = F.xxhash64(*key)  # a key that shares its hash with a hot one gets parts on both sides
    table = F.create_map(*[F.lit(x) for k, n in hot.items() for x in (k, n)])
    parts = F.when(code.isin(list(hot)), F.try_element_at(table, code)).otherwise(1)
    left = big.withColumn("__salt", F.pmod(by, parts).cast("int"))
    right = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), parts - 1)))
    return left.join(right, [*key, "__salt"], how).drop("__salt")


def tidy(spark: SparkSession) -> None:
    """Let go of shuffle files that nothing needs any more.

    Spark removes them when the driver's JVM collects the plans they belong to, which an
    idle driver may not do for long; a chain of checkpointed steps would pile them up.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Bound what one Arrow batch of texts holds, so that Python workers stay small."""
    now = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000"))
    if now <= 0 or now > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def hash2(*cols: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes with different seeds: together a 128-bit key."""
    return F.xxhash64(*cols), F.xxhash64(F.lit(0x5BD1E995), *cols)


def text_key(text: Column) -> Column:
    """A 16-byte key of a text; null and the empty text differ."""
    a, b = hash2(text.isNull(), text)
    return F.unhex(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))
