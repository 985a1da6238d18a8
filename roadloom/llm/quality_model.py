"""Quality scores from pairwise ranking in the Bradley-Terry model.

A preference pair is a document labelled good and one labelled bad. The probability that the
good one wins is the logistic function of the difference of their scores w . x, so learning
is logistic loss on feature differences. The features are ratios and counts of a text's own
statistics (symbols, capitals, repetition, lengths, punctuation), so a score doesn't depend
on the language, and a text of any length is read whole.

A document's raw score is squashed to 0..1 such that a threshold of CUT is passed exactly by
raw scores above a quantile of the raw scores in the training rows: the quantile at the share
of bad labels, moved to the middle of the gap between neighbouring scores there.

All labelled rows outside the held-out fold are learnt from, and the loss is the mean over all
pairs of a good and a bad one, in time proportional to the rows: on a stretch of raw scores of
length 1 the logistic function is a polynomial up to an error of about 1e-10, so each row is
dealt to the NODES Chebyshev nodes of its stretch by the weights of interpolation, and what
meets in pairs is the nodes, which hold sums of 1, x and x x'. Rows of equal statistics count
as one with a weight. Sums are made in a fixed order, so reruns agree.

Bounds: a task, or with few rows the driver, takes about TASK different rows of statistics.
For each Newton step the driver gets the sums of each stretch that has rows; the ridge keeps
the weights' norm at the least loss below 120, hence the stretches below about 1,000, whatever
the rows. The threshold comes from the scores sorted over tasks, each of which returns its
widest gap. Scoring sends the weights, a few numbers, to all tasks.

Defined results: null counts as the empty text; it gets a score like any other. Labels that
are null, or that belong to no document, are not learnt from; of labels that repeat for a
doc_id with different values, the larger counts. Without labels of both kinds every score
is 0.5. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from numpy.polynomial.chebyshev import chebvander
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C
from .quality_rules import FIELDS, stats_of

TASK, CUT = 20_000, 0.3
NODES = 10
_PLACES = np.cos((2 * np.arange(NODES) + 1) * np.pi / (2 * NODES))  # in -1..1
_BASIS = chebvander(_PLACES, NODES - 1).T * np.r_[1, np.full(NODES - 1, 2)][:, None] / NODES
Sums = dict[int, np.ndarray]  # stretch of raw scores -> (NODES, 1 + features, 1 + features)

NAMES = ["symbols", "repeats", "dup_lines", "capitals", "bars", "bangs", "stutter", "word_length", "long_words", "log_words", "log_lines", "short"]


def features(stats: np.ndarray) -> np.ndarray:
    """One row of features for each row of statistics (columns as in FIELDS)."""
    s = {n: stats[:, i].astype(float) for i, n in enumerate(FIELDS)}
    words, chars = np.maximum(s["n_words"], 1), np.maximum(s["word_chars"], 1)
    length = s["word_chars"] / words

    def steep(x: np.ndarray, scale: float) -> np.ndarray:
        return x / (x + scale)  # near-linear for small ratios, bounded for large ones

    return np.column_stack([
        steep(s["n_symbols"] / chars, 0.05), steep(s["n_repeat_words"] / words, 0.1), steep(s["n_dup_lines"] / np.maximum(s["n_lines"], 1), 0.2),
        steep(s["n_upper"] / np.maximum(s["n_letters"], 1), 0.3), steep(s["n_bars"] / words, 0.1), steep(s["n_bangs"] / words, 0.1), steep(s["n_twice"] / words, 0.1),
        np.minimum(length, 20) / 20, (length > 12).astype(float), np.log1p(s["n_words"]) / 10, np.log1p(s["n_lines"]) / 10, (s["n_words"] < 10).astype(float),
    ])


def moments(x: np.ndarray, count: np.ndarray, w: np.ndarray) -> Sums:
    """For each stretch of raw scores and each of its nodes the sum of (1, x) (1, x)' over the rows."""
    z, raw = np.column_stack([np.ones(len(x)), x]), x @ w
    stretch = np.floor(raw).astype(np.int64)
    order = np.argsort(stretch, kind="stable")
    out = {}
    for rows in np.split(order, np.flatnonzero(np.diff(stretch[order])) + 1):
        if len(rows):
            k, mine = int(stretch[rows[0]]), z[rows]
            at = chebvander(2 * (raw[rows] - k) - 1, NODES - 1) @ _BASIS * count[rows, None]
            out[k] = ((at[:, :, None] * mine[:, None, :]).reshape(len(rows), -1).T @ mine).reshape(NODES, z.shape[1], z.shape[1])
    return out


def _slopes(good: Sums, bad: Sums) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and Hessian of the mean logistic loss over all pairs of a good and a bad row."""
    (s, g), (t, b) = ((np.concatenate([k + (_PLACES + 1) / 2 for k in sums]), np.concatenate(list(sums.values()))) for sums in (good, bad))
    pairs = g[:, 0, 0].sum() * b[:, 0, 0].sum()
    grad, hess = np.zeros(g.shape[1] - 1), np.zeros((g.shape[1] - 1, g.shape[1] - 1))
    for i in range(0, len(s), 1000):  # bounds the table of nodes by nodes
        own = g[i : i + 1000]
        p = 1 / (1 + np.exp(np.clip(s[i : i + 1000, None] - t, -500, 500)))  # chance that the bad one wins
        grad += (own[:, 0, 0] @ p) @ b[:, 0, 1:] - (p @ b[:, 0, 0]) @ own[:, 0, 1:]
        q = p * (1 - p)
        cross = own[:, 0, 1:].T @ q @ b[:, 0, 1:]
        hess += np.tensordot(q @ b[:, 0, 0], own[:, 1:, 1:], 1) + np.tensordot(own[:, 0, 0] @ q, b[:, 1:, 1:], 1) - cross - cross.T
    return grad / pairs, hess / pairs


def _newton(sums: Callable[[np.ndarray], tuple[Sums, Sums]], width: int, rounds: int, ridge: float) -> np.ndarray:
    """Weights of the least loss; sums gives those of good and of bad rows for given weights."""
    w = np.zeros(width)
    for _ in range(rounds):
        good, bad = sums(w)
        if not good or not bad:
            return np.zeros(width)
        grad, hess = _slopes(good, bad)
        grad += ridge * w
        step = np.linalg.solve(hess + ridge * np.eye(width), grad)
        w -= step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(grad).max() < 1e-7:
            break
    return w


ROUNDS, RIDGE = 300, 1e-4


def fit_pairs(x: np.ndarray, good: np.ndarray, rounds: int = ROUNDS, ridge: float = RIDGE, count: np.ndarray | None = None) -> np.ndarray:
    """Weights from all pairs (good, bad) by Newton's method on the logistic loss."""
    count = np.ones(len(x)) if count is None else count
    return _newton(lambda w: (moments(x[good], count[good], w), moments(x[~good], count[~good], w)), x.shape[1], rounds, ridge)


def _window(total: int, bad: int) -> tuple[int, int]:
    """The places of sorted scores around the quantile at the share of bad labels."""
    near = max(1, total // 200)
    return max(0, bad - 1 - near), min(total - 1, bad + near)


def _widest(raw: np.ndarray, count: np.ndarray, before: int, window: tuple[int, int]) -> list[tuple[float, int, float]]:
    """(gap, place, middle) of the widest gap within the window, the first of equal ones; of places
    lo to hi among all scores. raw: sorted; before: how many scores come before them."""
    lo, hi = window
    last = before + np.cumsum(count) - 1  # the place of each score's last row
    found = [(0.0, lo, float(v)) for v in raw[(last >= lo) & (last - count < lo)]]
    gaps = np.where((last[:-1] >= lo) & (last[:-1] < hi), np.diff(raw), -1.0)
    if len(gaps) and gaps.max() >= 0:
        k = int(gaps.argmax())
        found.append((float(gaps[k]), int(last[k]), float((raw[k] + raw[k + 1]) / 2)))
    return [min(found, key=lambda x: (-x[0], x[1]))] if found else []


def _scale(total: np.ndarray, w: np.ndarray) -> float:
    """A quarter of the standard deviation of raw scores. total: the sum of (1, x) (1, x)'."""
    mean = total[0, 1:] / total[0, 0]
    return max(math.sqrt(max(w @ (total[1:, 1:] / total[0, 0] - np.outer(mean, mean)) @ w, 0.0)) / 4, 1e-6)


def fit(x: np.ndarray, good: np.ndarray, count: np.ndarray | None = None) -> tuple[np.ndarray, float, float]:
    """(weights, threshold of the raw score, scale)."""
    count = np.ones(len(x), np.int64) if count is None else count
    w = fit_pairs(x, good, count=count)
    if not w.any():
        return w, 0.0, 1.0
    order = np.argsort(x @ w, kind="stable")
    # around the quantile at the share of bad labels, the widest gap is where both kinds part
    [(_, _, cut)] = _widest((x @ w)[order], count[order], 0, _window(int(count.sum()), int(count[~good].sum())))
    z = np.column_stack([np.ones(len(x)), x])
    return w, cut, _scale((z * count[:, None]).T @ z, w)


def _table(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
    """The columns of a task's rows; none without rows."""
    rows = list(batches)
    return {n: c.to_numpy() for n, c in zip(rows[0].schema.names, pa.Table.from_batches(rows).columns, strict=True)} if rows else {}


def _matrix(cols: dict[str, np.ndarray]) -> np.ndarray:
    return features(np.column_stack([cols[n] for n in FIELDS]))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of sums for each kind and stretch, of rows in their order."""
    now, total = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["y", "stretch", "sums"])

    for batch in batches:
        for y, k, sums in zip(*(batch.column(n).to_pylist() for n in ("y", "stretch", "sums")), strict=True):
            if (y, k) != now:
                if now is not None:
                    yield row()
                now, total = (y, k), 0.0
            total = total + np.frombuffer(sums)
    if now is not None:
        yield row()


def _fit_spread(train: DataFrame, parts: int) -> tuple[np.ndarray, float, float]:
    """As ``fit``, over tasks. train: y (1 for good), FIELDS and c, how many rows have them."""
    width = len(NAMES)
    # the same rows in the same order in every run
    train = train.repartition(parts, F.xxhash64("y", *FIELDS)).sortWithinPartitions("y", *FIELDS)
    train = C.cut(train.withColumn("part", F.spark_partition_id()))

    def sums(w: np.ndarray) -> tuple[Sums, Sums]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if cols := _table(batches):
                x = _matrix(cols)
                found = [(y, k, m.tobytes()) for y in (0, 1) for k, m in moments(x[cols["y"] == y], cols["c"][cols["y"] == y], w).items()]
                part = pa.array([int(cols["part"][0])] * len(found), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.int64()), part, pa.array([f[2] for f in found], pa.binary())], names=["y", "stretch", "part", "sums"])

        made = train.mapInArrow(run, "y int, stretch bigint, part int, sums binary")
        by = ["y", "stretch"]
        got = made.repartition(*by).sortWithinPartitions(*by, "part").mapInArrow(_summed, "y int, stretch bigint, sums binary").collect()
        both: tuple[Sums, Sums] = ({}, {})
        for r in sorted(got, key=lambda r: (r["y"], r["stretch"])):
            both[1 - r["y"]][r["stretch"]] = np.frombuffer(r["sums"]).reshape(NODES, width + 1, width + 1)
        return both

    w = _newton(sums, width, ROUNDS, RIDGE)
    if not w.any():
        return w, 0.0, 1.0
    total = sum(m for kind in sums(w) for m in kind.values()).sum(0)

    def raws(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if cols := _table(batches):
            yield pa.RecordBatch.from_arrays([pa.array(_matrix(cols) @ w), pa.array(cols["c"])], names=["raw", "c"])

    # Spark's own sample for the ranges settles only which task sorts which scores
    values = train.mapInArrow(raws, "raw double, c bigint").groupBy("raw").agg(F.sum("c").alias("c"))
    values = C.cut(values.repartitionByRange(parts, "raw").sortWithinPartitions("raw").withColumn("part", F.spark_partition_id()))
    sizes = values.groupBy("part").agg(F.sum("c").alias("n"), F.min("raw").alias("least"), F.max("raw").alias("most")).orderBy("part").collect()
    ends = np.cumsum([r["n"] for r in sizes])
    starts = {r["part"]: int(end - r["n"]) for r, end in zip(sizes, ends, strict=True)}
    bad = train.where("y = 0").agg(F.sum("c")).first()[0]
    window = _window(int(ends[-1]), bad)

    def widest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if cols := _table(batches):
            for x in _widest(cols["raw"], cols["c"], starts[int(cols["part"][0])], window):
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in x], names=["gap", "place", "middle"])

    found = [tuple(r) for r in values.mapInArrow(widest, "gap double, place bigint, middle double").collect()]
    found += [(b["least"] - a["most"], int(end) - 1, (a["most"] + b["least"]) / 2) for a, b, end in zip(sizes, sizes[1:], ends, strict=False) if window[0] < end <= window[1]]
    return w, float(min(found, key=lambda x: (-x[0], x[1]))[2]), _scale(total, w)


def squash(raw: np.ndarray, cut: float, scale: float) -> np.ndarray:
    """0..1; CUT at the threshold."""
    return 1 / (1 + np.exp(-np.clip((raw - cut) / scale + math.log(CUT / (1 - CUT)), -500, 500)))


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32(doc_id as text) mod folds is fold; a null doc_id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def rated(docs: DataFrame) -> DataFrame:
    """doc_id and the FIELDS of the whole text."""
    return C.pick(docs, "doc_id", "text").select("doc_id", stats_of(F.col("text")).alias("s")).select("doc_id", "s.*")


def labelled(stats: DataFrame, labels: DataFrame, label: str, folds: int, fold: int) -> DataFrame:
    """(y, FIELDS, c): all rows to learn from, those outside the held-out fold; c of them are alike.

    stats: as from ``rated``, cheap to read again.
    """
    known = C.pick(labels, "doc_id", label).where(f"doc_id is not null and {label} is not null").groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    known = known.where(~held_out(F.col("doc_id"), folds, fold))
    stats = stats.where("doc_id is not null")
    rows = C.spread_join(stats, known, ["doc_id"], F.xxhash64(*FIELDS), C.hot_keys(stats, ["doc_id"]))
    return rows.groupBy((F.col("y") == 1).cast("int").alias("y"), *FIELDS).agg(F.count(F.lit(1)).alias("c"))


def learn_rated(stats: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0):
    """The model from all labelled rows: (weights, threshold, scale). stats: as for ``labelled``."""
    with C.no_broadcasts(stats.sparkSession):
        train = C.cut(labelled(stats, labels, "quality", folds, fold))
    n = train.count()
    if n > TASK:
        return _fit_spread(train, -(-n // TASK))
    got = train.orderBy("y", *FIELDS).toPandas()  # at most TASK rows
    if got.empty:
        return np.zeros(len(NAMES)), 0.0, 1.0
    return fit(features(got[FIELDS].to_numpy()), got["y"].to_numpy() == 1, got["c"].to_numpy())


def learn(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0):
    """The model from all labelled rows: (weights, threshold, scale)."""
    return learn_rated(C.cut(rated(docs)), labels, folds, fold)


def score_rated(stats: DataFrame, model, folds: int = 5, fold: int = 0) -> DataFrame:
    """One row per row of stats (as from ``rated``): doc_id, held_out, score, predicted."""
    w, cut, scale = model

    def scored(stats: pd.DataFrame) -> pd.Series:
        if not len(stats):
            return pd.Series([], dtype=float)
        x = features(stats[FIELDS].to_numpy(np.int64))
        return pd.Series(squash(x @ w, cut, scale) if w.any() else np.full(len(stats), 0.5))

    out = stats.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), F.pandas_udf(scored, "double")(F.struct(*FIELDS)).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def score(docs: DataFrame, model, folds: int = 5, fold: int = 0) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    return score_rated(rated(docs), model, folds, fold)


# --- queries --------------------------------------------------------------------------


def op4_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """All documents, scored by a ranking learnt outside fold 0 of 5."""
    C.small_batches(spark)
    stats = C.cut(rated(C.table(spark, sf_dir, "documents")))  # texts are read once
    return score_rated(stats, learn_rated(stats, C.table(spark, sf_dir, "labels")))


QUERIES = {"op4_quality_classifier": op4_quality_classifier}
SQL: dict[str, str] = {}
