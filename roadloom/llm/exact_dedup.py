"""Exact duplicates by an extendible-hash index on shared files.

1. Every text gets a 64-bit hash (its index key) and its SHA-256; the slim rows are cut
   into the shared folder once.
2. The directory is built from the counts of key prefixes: a bucket over its capacity
   splits on the next bit of the key, and the directory doubles whenever a bucket's local
   depth passes the global depth. Only prefix counts, at most 2**16, reach the driver.
   A prefix of 16 bits that is still too full stays one bucket; its owner streams it.
3. Each map task folds equal texts into one entry, so that a text with very many copies
   sends a row per task, not per copy. Entries go to the task that owns their bucket's key
   range. The owner chains entries with one key and compares their bytes; equal bytes
   merge, different ones stay apart.
4. The owners' entries are written as index files in the shared folder; documents look
   their group up by (key, SHA-256).

Defined results: null counts as the empty text. The row with the largest doc_id stays; a
null doc_id is below all others. Rows that repeat with the same doc_id and text count one
by one in group_size and share their flags. Extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

DEPTH = 16
FOLD_BYTES = 32 << 20


class Directory:
    """Which bucket owns a key: 2**depth entries, shared by buckets of less local depth."""

    def __init__(self, counts: np.ndarray, capacity: int):
        """counts: entries by their first DEPTH bits."""
        self.depth = 0
        self.buckets = [(0, 0)]  # (prefix, local depth)
        sums = np.concatenate([[0], np.cumsum(counts)])

        def held(prefix: int, local: int) -> int:
            step = 1 << (DEPTH - local)
            return int(sums[(prefix + 1) * step] - sums[prefix * step])

        full, done = [(0, 0)], []
        while full:
            prefix, local = full.pop()
            if local < DEPTH and held(prefix, local) > capacity:
                if local == self.depth:
                    self.depth += 1  # the directory doubles
                full += [(2 * prefix + 1, local + 1), (2 * prefix, local + 1)]
            else:
                done.append((prefix, local))
        self.buckets = sorted(done, key=lambda x: x[0] << (DEPTH - x[1]))
        self.entries = np.empty(1 << self.depth, np.int32)
        for i, (prefix, local) in enumerate(self.buckets):
            step = 1 << (self.depth - local)
            self.entries[prefix * step : (prefix + 1) * step] = i

    def owner(self, key: F.Column) -> F.Column:
        """The bucket of a key, looked up by the key's leading bits."""
        at = F.shiftrightunsigned(key, 64 - self.depth).cast("int") if self.depth else F.lit(0)
        return F.element_at(F.lit([int(x) for x in self.entries]), at + 1)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Within a map task, equal texts become one entry; flushed when its memory is used."""
    held: dict[bytes, list] = {}
    size = 0
    schema = None

    def out():
        cols = list(zip(*[(r[0], r[1], r[2], r[3], t) for t, r in held.items()], strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    for batch in batches:
        schema = schema or pa.schema([("key", pa.int64()), ("sha", pa.binary()), ("top", pa.int64()), ("n", pa.int64()), ("text", pa.binary())])
        for key, sha, top, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if (r := held.get(text)) is None:
                held[text] = [key, sha, top, 1]
                size += len(text) + 200
            else:
                r[2] = top if r[2] is None else r[2] if top is None else max(r[2], top)
                r[3] += 1
        if size > FOLD_BYTES:
            yield out()
            held, size = {}, 0
    if held:
        yield out()


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """An owner task: rows come by (bucket, key); each key's chain is compared by bytes."""
    chain: list[list] = []
    now = None
    schema = pa.schema([("key", pa.int64()), ("sha", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64())])

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    for batch in batches:
        done = []
        for key, sha, top, n, text in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if key != now:
                done += [x[:4] for x in chain]
                chain, now = [], key
            for x in chain:
                if x[4] == text:
                    x[2] = top if x[2] is None else x[2] if top is None else max(x[2], top)
                    x[3] += n
                    break
            else:
                chain.append([key, sha, top, n, text])
        if done:
            yield batch_of(done)
    if chain:
        yield batch_of([x[:4] for x in chain])


def build_index(docs: DataFrame, capacity: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, index): slim rows (doc_id, key, sha) and entries (key, sha, keep_id, group_size).

    capacity: entries a bucket holds before it splits; by default what gives each shuffle
    partition about eight buckets, within 64 and 65,536.
    """
    spark = docs.sparkSession
    C.small_batches(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = C.pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("key"), F.unhex(F.sha2(text, 256)).alias("sha"))
    rows = C.cut(keyed.select("doc_id", "key", "sha"))
    prefix = F.shiftrightunsigned("key", 64 - DEPTH).cast("int")
    found = rows.select("key").distinct().groupBy(prefix.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()  # at most 2**DEPTH rows
    counts = np.zeros(1 << DEPTH, np.int64)
    for r in found:
        counts[r.p] = r.n
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    capacity = capacity or int(min(65_536, max(64, counts.sum() // (8 * parts))))
    directory = Directory(counts, capacity)

    entries = keyed.select("key", "sha", "doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(_fold, "key bigint, sha binary, top bigint, n bigint, text binary")
    owned = (
        entries.withColumn("bucket", directory.owner(F.col("key"))).repartition(parts, "bucket")
        .sortWithinPartitions("bucket", "key").select("key", "sha", "top", "n", "text")
        .mapInArrow(_own, "key bigint, sha binary, keep_id bigint, group_size bigint")
    )
    return rows, C.cut(owned)


def exact_duplicates(docs: DataFrame, capacity: int | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows, index = build_index(docs, capacity)
    # a text with very many copies is dealt over many tasks
    out = C.spread_join(rows, index, ["key", "sha"], F.xxhash64("doc_id"), C.hot_keys(index, ["key", "sha"], "group_size"))
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


# --- queries --------------------------------------------------------------------------


def op9_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents; of equal texts the largest doc_id stays."""
    return exact_duplicates(C.table(spark, sf_dir, "documents"))


QUERIES = {"op9_exact_dedup": op9_exact_dedup}
SQL = {
    "op9_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
}
