"""Mixing sources to target weights by pivotal dependent rounding.

Each source should give ``target`` words; a document's fractional number of copies is
``target / source size``, the same for all documents of a source. Its whole part is taken
for sure. The fractional parts p are rounded by the pivotal method: two documents i, j with
fractional parts meet, and mass moves from one to the other along size_i dp_i = -size_j dp_j
until one of them is 0 or 1. The direction is drawn so that both expectations stay, and the
words of the pair never change.

Distribution: documents of a source are dealt by size class (powers of two), and each class
into as many buckets as it needs by a hash of their key, so that a source with a third of all
rows is as many groups as its size needs, all of about the same size. Each bucket rounds its documents and leaves at most LEAVE residuals; residuals of
a class meet in groups of FAN buckets on each level of a reduction tree until LEAVE per class
and source are left. Those, at most LEAVE for each power of two, are settled from the largest
to the smallest document, each taken when that brings the words so far nearer to what they
should be; what a large one misses, the smaller ones make up for. So a source's words end
near its target whatever its largest document is. All draws hash the documents' keys and the
level, never task numbers: reruns and other partitionings agree.

Defined results: a null text has size 0; documents of size 0 take nothing. A null source is
a source of its own, last in order. A source whose documents are all empty has the target 0;
its share goes to the others. Rows that repeat in every column used are one item with their
count; each of them takes the same. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

BUCKET_ROWS = 500
FAN = 1_000
LEAVE = 4
#: Scheme of the weights by a source's place, and the mix's size against the input's.
WEIGHTS, SHARE, MOST = (5.0, 2.0, 1.0), 1.5, 2.0


def targets(sizes: Sequence[int], weights: Sequence[float], share: float = SHARE, most: float = MOST) -> list[float]:
    """Words for each source: weighted shares of share * sum(sizes), none above most * its
    size; what is cut off is shared again by weight among those below their limit."""
    out = [0.0] * len(sizes)
    free = [i for i, s in enumerate(sizes) if s > 0]
    left = share * sum(sizes)
    while free:
        unit = left / sum(weights[i] for i in free)
        full = [i for i in free if unit * weights[i] >= most * sizes[i]]
        if not full:
            for i in free:
                out[i] = unit * weights[i]
            break
        for i in full:
            out[i] = most * sizes[i]
            left -= out[i]
        free = [i for i in free if i not in full]
    return out


def _unit(key: np.ndarray, level: int) -> np.ndarray:
    """A number in [0, 1) from a key."""
    with np.errstate(over="ignore"):
        return (C.mix64(key.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(level + 1)) >> np.uint64(11)) * 2.0**-53


def pivotal(key: np.ndarray, size: np.ndarray, p: np.ndarray, level: int) -> np.ndarray:
    """Round p until at most LEAVE entries are fractional; sum(size * p) stays.

    Pairs are made round by round among those still fractional, as a tournament.
    """
    p = p.astype(float).copy()
    live = np.flatnonzero((p > 0) & (p < 1))
    turn = 0
    while len(live) > LEAVE:
        n = min(len(live) // 2, len(live) - LEAVE)
        i, j = live[0 : 2 * n : 2], live[1 : 2 * n : 2]
        wi, wj = size[i] * 1.0, size[j] * 1.0
        # mass (in words) that can move to i, or to j, before one of both is integral
        to_i = np.minimum((1 - p[i]) * wi, p[j] * wj)
        to_j = np.minimum(p[i] * wi, (1 - p[j]) * wj)
        up = _unit(key[i] ^ (key[j] << 1), 64 * level + turn) * (to_i + to_j) < to_j
        moved = np.where(up, to_i, -to_j)
        at_i, at_j = p[i] * wi + moved, p[j] * wj - moved
        new_i, new_j = at_i / wi, at_j / wj
        # the one that has met its limit is set to it exactly
        i_ends = np.where(up, (1 - p[i]) * wi <= p[j] * wj, p[i] * wi <= (1 - p[j]) * wj)
        new_i = np.where(i_ends, np.where(up, 1.0, 0.0), np.clip(new_i, 0, 1))
        new_j = np.where(i_ends, np.clip(new_j, 0, 1), np.where(up, 0.0, 1.0))
        p[i], p[j] = new_i, new_j
        p[np.abs(p - np.round(p)) < 1e-12] = np.round(p[np.abs(p - np.round(p)) < 1e-12])
        live = live[(p[live] > 0) & (p[live] < 1)]
        turn += 1
    return p


def settle(size: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Decide the last residuals, given from large to small: carry the words missed on."""
    x, owed = np.zeros(len(p)), 0.0
    for i in range(len(p)):
        owed += p[i] * size[i]
        if owed >= size[i] / 2:
            x[i] = 1.0
            owed -= size[i]
    return x


def _level(level: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["key", "key2"], kind="stable").reset_index(drop=True)
        return pdf.assign(p=pivotal(pdf["key"].to_numpy(), pdf["words"].to_numpy(), pdf["p"].to_numpy(), level))

    return run


def _settle(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["words", "key", "key2"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
    return pdf.assign(p=settle(pdf["words"].to_numpy(), pdf["p"].to_numpy()))


ITEM = "source_no int, class int, key bigint, key2 bigint, words bigint, p double, bucket bigint"


def rounded(items: DataFrame, buckets: int) -> DataFrame:
    """items (source_no, class, key, key2, words, p, bucket) with every p 0 or 1.

    buckets: the most buckets that a source has.
    """
    done, level, now = None, 0, items
    while True:
        out = C.cut(now.groupBy("source_no", "class", "bucket").applyInPandas(_level(level), ITEM))
        sure = out.where("p = 0 or p = 1")
        done = sure if done is None else done.unionByName(sure)
        now = out.where("p > 0 and p < 1").withColumn("bucket", F.floor(F.col("bucket") / FAN))
        if buckets <= 1:  # LEAVE per source and power of two
            return done.unionByName(now.groupBy("source_no").applyInPandas(_settle, ITEM))
        buckets, level = -(-buckets // FAN), level + 1


def size_of(text: F.Column) -> F.Column:
    """Number of words; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(C.WORD)), F.lit(0)).cast("bigint")


def plan_mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """An item for each different row: doc_id, source, key, key2, size, n_rows, source_size,
    target, copies (of each of its n_rows rows)."""
    slim = C.pick(docs, "doc_id", "text", "source")
    key, key2 = C.hash2("doc_id", "source", "text")
    rows = slim.select("doc_id", "source", size_of(F.col("text")).alias("size"), key.alias("key"), key2.alias("key2"))
    items = C.cut(rows.groupBy("doc_id", "source", "size", "key", "key2").agg(F.count(F.lit(1)).alias("n_rows")))
    spark = docs.sparkSession
    # one row per source: the list of sources is the mix's specification, never the data
    found = items.groupBy("source").agg(F.sum(F.col("size") * F.col("n_rows")).alias("size")).collect()
    found.sort(key=lambda r: (r.source is None, r.source or ""))
    goal = targets([r["size"] for r in found], [weights[i % len(weights)] for i in range(len(found))], share, most)
    plan = [(i, r.source, r["size"], t, t / r["size"] if r["size"] else 0.0) for i, (r, t) in enumerate(zip(found, goal, strict=True))]
    known = spark.createDataFrame(plan, f"source_no int, name {dict(items.dtypes)['source']}, source_size bigint, target double, ratio double")
    if len(plan) <= 10_000:
        known = F.broadcast(known)
    items = items.join(known, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    sure = F.floor("ratio").cast("bigint")
    live = items.where("size > 0 and ratio > floor(ratio)").select(
        "source_no", F.floor(F.log2(F.col("size") * F.col("n_rows"))).cast("int").alias("class"), "key", "key2", (F.col("size") * F.col("n_rows")).alias("words"), (F.col("ratio") - F.floor("ratio")).alias("p"),
    )
    # a row for each source and power of two
    classes = C.cut(live.groupBy("source_no", "class").agg(F.ceil(F.count(F.lit(1)) / BUCKET_ROWS).alias("buckets")))
    most = classes.agg(F.max("buckets")).first()[0] or 1
    if len(plan) <= 500:
        classes = F.broadcast(classes)
    live = live.join(classes, ["source_no", "class"]).withColumn("bucket", F.pmod(F.xxhash64("key2", "key"), F.col("buckets"))).select(*[x.split()[0] for x in ITEM.split(", ")])
    extra = rounded(live, int(most)).where("p = 1").select("source_no", "key", "key2", F.lit(1).cast("bigint").alias("extra"))
    out = items.join(extra, ["source_no", "key", "key2"], "left")
    copies = F.when(F.col("size") > 0, sure + F.coalesce("extra", F.lit(0))).otherwise(F.lit(0)).cast("bigint")
    return out.select("doc_id", "source", "key", "key2", "size", "n_rows", "source_size", "target", copies.alias("copies"))


def mix_report(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    items = plan_mix(docs, weights, share, most)
    each = items.withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))))
    return each.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """The mix itself: each row of docs as often as it is taken, columns as in docs."""
    flat, names = C.positional(docs)
    i, t, s = (f"__c{C.place(names, n)}" for n in ("doc_id", "text", "source"))
    taken = plan_mix(docs, weights, share, most).where("copies > 0").select("key", "key2", "copies")
    key, key2 = C.hash2(i, s, t)
    keyed = flat.withColumns({"__k": key, "__k2": key2})
    out = keyed.join(taken, (F.col("__k") == F.col("key")) & (F.col("__k2") == F.col("key2")))
    out = out.withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return out.select(*flat.columns).toDF(*names)


# --- queries --------------------------------------------------------------------------


def op3_mix_to_weights(spark, sf_dir: str) -> DataFrame:
    """All documents: weights 5, 2, 1 by source, 150 % of all words, at most 2 copies."""
    return mix_report(C.table(spark, sf_dir, "documents"))


QUERIES = {"op3_mix_to_weights": op3_mix_to_weights}
SQL: dict[str, str] = {}
