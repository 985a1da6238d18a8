"""Toxicity scores by non-negative positive-unlabelled learning.

What is known are documents confirmed as toxic (P) and documents of which nothing is known
(U). With the share of toxic documents, the prior, the risk of a classifier g is

    prior * E_P[loss(g)]  +  max(0, E_U[loss(-g)] - prior * E_P[loss(-g)]),

where the second term estimates the risk on documents that aren't toxic; it can't be
negative, so when the estimate falls below zero its gradient is turned round, which keeps g
from fitting P by heart. g is linear over the presence of word forms and word beginnings (4
to 6 bytes), learnt with numpy by logistic loss.

Bounds: P has at most POSITIVES rows (the smallest hashes of doc_id among labelled rows of
the learning folds), U at most UNLABELLED rows (the smallest hashes among all documents,
labels unread). Counting features runs on the cluster; WIDTH features, those most frequent in
P beyond what U explains, reach the driver, with their places in the rows of P and U.
Scoring reads every text as a whole and sends only the chosen features to all tasks.

The prior is a parameter; by default it is the share of toxic rows among the labelled rows
of the learning folds.

Defined results: null counts as the empty text; it gets the score of a text without any of
the features. Labels that are null or belong to no document aren't learnt from; of labels
that repeat for a doc_id the larger counts. Without confirmed toxic rows every score is 0.
Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .quality_model import held_out

POSITIVES, UNLABELLED, WIDTH, PURE, CUT = 5_000, 20_000, 256, 0.6, 0.3
#: Longer runs are read in pieces of 12 bytes, every 3 bytes: four characters of most scripts without blanks.
LONGEST, PIECE, STEP = 64, 12, 3
_EDGE = b"".join(bytes([c]) for c in range(33, 127) if not bytes([c]).isalnum())


def _forms(word: bytes) -> list[int]:
    """Hashes of a word's form and beginnings; of runs without blanks, of overlapping pieces."""
    word = word.strip(_EDGE)
    if len(word) <= 2:
        return []
    if len(word) > LONGEST:
        return [xxhash.xxh64_intdigest(b"~" + word[i : i + PIECE]) - (1 << 63) for i in range(0, len(word) - PIECE + 1, STEP)]
    cut = {b"=" + word, *(word[:n] for n in (4, 5, 6) if len(word) >= n)}
    return [xxhash.xxh64_intdigest(c) - (1 << 63) for c in cut]


class _Known(dict):
    """word -> what it stands for; forgets when full, which costs time only."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, word: bytes):
        if len(self) > 300_000:
            self.clear()
        v = self[word] = self.make(word)
        return v


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, p, u): in how many rows of P and U of this task a feature occurs."""
    known = _Known(_forms)
    held = Counter(), Counter()

    def out():
        keys = list(held[0].keys() | held[1].keys())
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([held[1][k] for k in keys], pa.int64()), pa.array([held[0][k] for k in keys], pa.int64())], names=["feature", "p", "u"])

    for batch in batches:
        for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held[y].update({f for w in set((text or b"").lower().split()) for f in known[w]})
        if len(held[0]) + len(held[1]) > 500_000:
            yield out()
            held = Counter(), Counter()
    if held[0] or held[1]:
        yield out()


def _matcher(chosen: dict[int, int]) -> _Known:
    return _Known(lambda w: tuple(chosen[f] for f in _forms(w) if f in chosen))


def _places(text: bytes | None, known: _Known) -> list[int]:
    """Which of the chosen features a text has, in order."""
    return sorted({i for w in set((text or b"").lower().split()) if (x := known[w]) for i in x})


def _marks(chosen: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _matcher(chosen)
        for batch in batches:
            found = [_places(t, known) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], names=["y", "at"])

    return run


def fit_nnpu(p: np.ndarray, u: np.ndarray, prior: float, rounds: int = 400, rate: float = 0.1, ridge: float = 3e-4, slack: float = 0.05) -> tuple[np.ndarray, float]:
    """(weights, bias) of the linear classifier with the least non-negative PU risk (Adam)."""
    k = p.shape[1]
    w = np.zeros(k + 1, np.float32)
    w[k] = np.log(prior / (1 - prior))
    p, u = (np.hstack([x, np.ones((len(x), 1))]).astype(np.float32) for x in (p, u))
    m, v = np.zeros(k + 1, np.float32), np.zeros(k + 1, np.float32)

    def sig(x):
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))

    for t in range(1, rounds + 1):
        gp, gu = p @ w, u @ w
        # logistic loss: l(g) = log(1 + exp(-g)); l(-g) has the slope sig(g)
        on_p = -(p.T @ sig(-gp)) / len(p) * prior
        rest = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        on_rest = (u.T @ sig(gu)) / len(u) - prior * (p.T @ sig(gp)) / len(p)
        grad = on_p + on_rest if rest >= -slack else -on_rest
        grad = grad + ridge * np.append(w[:k], 0)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= np.float32(rate) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:k], float(w[k])


def learn(docs: DataFrame, labels: DataFrame, folds: int = 4, fold: int = 2, prior: float | None = None, positives: int = POSITIVES, unlabelled: int = UNLABELLED, width: int = WIDTH, pure: float = PURE):
    """({feature: place}, weights, bias) from toxic rows of the learning folds and unlabelled text."""
    known = C.pick(labels, "doc_id", "toxic").where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    known = known.where(~held_out(F.col("doc_id"), folds, fold))
    if prior is None:
        prior = known.agg(F.avg("y")).first()[0] or 0.0
    if not prior:
        return {}, np.zeros(0), -30.0
    prior = min(prior, 0.9)
    order = (F.xxhash64("doc_id"), "doc_id")
    toxic = known.where("y = 1").orderBy(*order).limit(positives).select("doc_id", F.lit(1).alias("y"))
    slim = C.pick(docs, "doc_id", "text")
    other = slim.select("doc_id").where("doc_id is not null").distinct().orderBy(*order).limit(unlabelled).select("doc_id", F.lit(0).alias("y"))
    # at most positives + unlabelled pairs of numbers; a toxic row may be in U as well
    rows = C.cut(slim.join(F.broadcast(toxic.union(other)), "doc_id").select("y", F.col("text").cast("binary").alias("text")))
    n = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    if not n.get(1) or not n.get(0):
        return {}, np.zeros(0), -30.0
    counts = rows.mapInArrow(_count, "feature bigint, p bigint, u bigint").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    # About prior * (rate in P) / (rate in U) of a feature's occurrences are in toxic texts; features
    # below ``pure`` say little and would add up over long texts. The others are ordered by how far
    # their count in P lies over what their rate in U explains, in standard deviations.
    expected = F.expr(f"(u + 1.0) * {n[1]} / {n[0]}")
    best = counts.where(f"p >= 4 and {prior} * p * {n[0]} >= {pure} * u * {n[1]}").orderBy((-(F.col("p") - expected) / F.sqrt(expected)), "feature").limit(width)
    chosen = {r["feature"]: i for i, r in enumerate(best.select("feature").collect())}
    if not chosen:
        return {}, np.zeros(0), -30.0
    marks = rows.mapInArrow(_marks(chosen), "y int, at array<int>")
    parts = []
    for y, most in ((1, positives), (0, unlabelled)):
        # an order of its own, whatever the tasks' order; rows may repeat an id
        own = [tuple(r["at"]) for r in marks.where(F.col("y") == y).select("at").orderBy("at").limit(most).collect()]
        x = np.zeros((len(own), len(chosen)), np.float32)
        for i, at in enumerate(own):
            x[i, list(at)] = 1
        parts.append(x)
    w, b = fit_nnpu(*parts, prior)
    return chosen, w, b


def score(docs: DataFrame, model, folds: int = 4, fold: int = 2) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    chosen, w, b = model

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = _matcher(chosen)
        for texts in batches:
            raw = np.array([b + sum(w[i] for i in _places(t, known)) for t in texts], float)
            yield pd.Series(1 / (1 + np.exp(-np.clip(raw, -30, 30))) if len(w) else np.zeros(len(texts)))

    # annotations are strings here; an iterator UDF needs the types (its memory lasts over batches)
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    slim = C.pick(docs, "doc_id", "text")
    out = slim.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), F.pandas_udf(run, "double")(F.col("text").cast("binary")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


# --- queries --------------------------------------------------------------------------


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    """All documents, scored by a model learnt outside fold 2 of 4."""
    C.small_batches(spark)
    docs = C.table(spark, sf_dir, "documents")
    return score(docs, learn(docs, C.table(spark, sf_dir, "labels")))


QUERIES = {"op5_toxicity": op5_toxicity}
SQL: dict[str, str] = {}
