import random
import zlib

import numpy as np

from roadloom.llm import quality_model as Q
from roadloom.llm import toxicity as T
from roadloom.llm.quality_rules import statistics as Q_statistics
from tests.llm.conftest import make


def corpus(spark, words, n=600):
    r = random.Random(11)
    rows, labels = [], []
    for i in range(n):
        w = [r.choice(words[:2000]) for _ in range(r.randint(5, 200))]
        bad, toxic = i % 5 == 0, i % 7 == 0
        if bad:
            w = [x + r.choice(["###", "$$$"]) for x in w]
        if toxic:
            for _ in range(2):
                w.insert(r.randrange(len(w)), "vilestem" + r.choice(["a", "en", "ing"]))
        rows.append((i, " ".join(w), f"s{i % 3}"))
        labels.append((i, int(not bad), int(toxic)))
    return make(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_model_ranks_held_out_rows(spark, words, clashing, empty_docs):
    docs, labels = corpus(spark, words)
    model = Q.learn(docs, labels)
    rows = Q.score(docs, model).collect()
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 5 == 0) for x in rows)
    held = [x for x in rows if x.held_out]
    assert np.mean([x.predicted == int(x.doc_id % 5 != 0) for x in held]) > 0.95
    assert all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3) for x in rows)
    assert Q.score(clashing, model).count() == 17 and Q.score(empty_docs, model).count() == 0
    none = labels.where("doc_id < 0")
    assert {x.score for x in Q.score(docs, Q.learn(docs, none)).collect()} == {0.5}
    again = Q.learn(docs.repartition(5), labels)
    assert np.allclose(model[0], again[0])


def test_labels_of_the_held_out_fold_are_not_learnt(spark, words):
    from pyspark.sql import functions as F

    docs, labels = corpus(spark, words, 200)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.allclose(Q.learn(docs, labels)[0], Q.learn(docs, flipped)[0])


def test_toxicity_finds_held_out_rows(spark, words, clashing, empty_docs):
    docs, labels = corpus(spark, words)
    model = T.learn(docs, labels)
    rows = T.score(docs, model).collect()
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in rows)
    held = [x for x in rows if x.held_out]
    assert np.mean([x.predicted == int(x.doc_id % 7 == 0) for x in held]) > 0.95
    assert T.score(clashing, model).count() == 17 and T.score(empty_docs, model).count() == 0
    assert {x.score for x in T.score(docs, T.learn(docs, labels.where("toxic = 0"))).collect()} == {0.0}


def test_nnpu_separates_and_stays_bounded():
    r = np.random.default_rng(0)
    p = (r.random((300, 20)) < np.r_[np.full(3, 0.7), np.full(17, 0.1)]).astype(float)
    n = (r.random((1800, 20)) < np.r_[np.full(3, 0.01), np.full(17, 0.1)]).astype(float)
    hidden = (r.random((200, 20)) < np.r_[np.full(3, 0.7), np.full(17, 0.1)]).astype(float)
    w, b = T.fit_nnpu(p, np.vstack([n, hidden]), 0.1)
    assert ((hidden @ w + b) > -0.85).mean() > 0.9 and ((n @ w + b) > -0.85).mean() < 0.1


def test_quality_scores_match_a_plain_version(spark, words):
    import math
    import re

    docs, labels = corpus(spark, words, 150)
    w, cut, scale = Q.learn(docs, labels)

    def plain(text):
        word, lines = re.findall(r"[^\x20\x09-\x0D]+", text), [x for x in text.split("\n") if x.strip()]
        chars, n = max(1, sum(map(len, word))), max(1, len(word))
        windows = [tuple(word[i : i + 5]) for i in range(len(word) - 4)]
        again = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(5)}
        upper, letters = sum("A" <= c <= "Z" for c in text), sum(c.isascii() and c.isalpha() for c in text)
        steep = lambda x, s: x / (x + s)
        length = sum(map(len, word)) / n
        x = [
            steep(sum(c in "#*$%&|<>" for c in text) / chars, 0.05), steep(len(again) / n, 0.1), steep((len(lines) - len(set(lines))) / max(1, len(lines)), 0.2), steep(upper / max(1, letters), 0.3),
            steep(text.count("|") / n, 0.1), steep("".join(word).count("!!") / n, 0.1), steep(sum(a == b for a, b in zip(word, word[1:])) / n, 0.1), min(length, 20) / 20, float(length > 12), math.log1p(len(word)) / 10, math.log1p(len(lines)) / 10, float(len(word) < 10),
        ]
        return 1 / (1 + math.exp(-((sum(a * b for a, b in zip(x, w)) - cut) / scale + math.log(0.3 / 0.7))))

    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in Q.score(docs, (w, cut, scale)).collect():
        assert abs(r.score - plain(texts[r.doc_id])) < 1e-9


def test_ranking_weights_are_the_least_loss():
    r = np.random.default_rng(3)
    x, good = r.random((60, 4)), r.random(60) < 0.5
    x[good, 0] += 0.4
    w = Q.fit_pairs(x, good)

    def loss(v):
        margins = [(a - b) @ v for a in x[good] for b in x[~good]]
        return np.mean(np.logaddexp(0, -np.array(margins))) + 0.5e-4 * v @ v

    for i in range(4):
        for step in (-0.05, 0.05):
            moved = w.copy()
            moved[i] += step
            assert loss(moved) > loss(w)


def test_toxicity_scores_match_a_plain_version(spark, words):
    docs, labels = corpus(spark, words, 150)
    chosen, w, b = T.learn(docs, labels)
    assert chosen
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in T.score(docs, (chosen, w, b)).collect():
        has = {f for x in texts[r.doc_id].lower().split() for f in T._forms(x.encode())}
        raw = b + sum(w[i] for f, i in chosen.items() if f in has)
        assert abs(r.score - 1 / (1 + np.exp(-raw))) < 1e-5


def test_models_take_repeated_null_and_missing_labels(spark, words, odd_docs):
    docs, labels = corpus(spark, words, 120)
    more = spark.createDataFrame([(1, None, None), (None, 1, 1), (99_999, 0, 1), (5, 0, None)], "doc_id long, quality int, toxic int")
    labels = labels.union(labels).union(more)
    assert Q.score(docs, Q.learn(docs, labels)).count() == 120
    assert T.score(docs, T.learn(docs, labels)).count() == 120
    long = make(spark, [(1, "漢字" * 5000, "a"), (2, "word " * 50_000, "a")])
    assert T.score(long, T.learn(docs, labels)).count() == 2 and T._forms(("漢字" * 40).encode())


def test_risk_matches_a_plain_one():
    """One step from the start goes down the estimated risk, as differences of it show."""
    r = np.random.default_rng(5)
    p, u = (r.random((40, 3)) < 0.6).astype(float), (r.random((80, 3)) < 0.3).astype(float)
    w, b = T.fit_nnpu(p, u, 0.2, rounds=600, slack=0.0)

    def risk(w, b):
        on_p = np.logaddexp(0, -(p @ w + b)).mean() * 0.2
        rest = np.logaddexp(0, u @ w + b).mean() - 0.2 * np.logaddexp(0, p @ w + b).mean()
        return on_p + max(rest, 0) + 1.5e-4 * w @ w

    assert risk(w, b) < risk(np.zeros(3), np.log(0.2 / 0.8))
    assert all(risk(w, b) < risk(w + d, b) + 1e-4 for d in 0.3 * np.vstack([np.eye(3), -np.eye(3)]))


def test_quality_model_learns_from_all_labelled_rows(spark, words):
    """More labels than a task takes: weights, threshold and scale are those of all rows and all pairs."""
    r = random.Random(12)
    rows, labels = [], []
    for i in range(30_000):
        w = [r.choice(words) for _ in range(r.randint(3, 30))]
        marks = r.randint(0, 3) if r.random() < 0.4 else 0  # kinds overlap
        rows.append((i, " ".join(w + ["#$%"] * marks), "a"))
        labels.append((i, int(r.random() < (0.95, 0.6, 0.4, 0.2)[marks])))
    docs, marked = make(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int")
    w, cut, scale = Q.learn(docs, marked)
    used = [(t, y == 1) for (i, t, _), (_, y) in zip(rows, labels) if zlib.crc32(str(i).encode()) % 5]
    x, good = Q.features(np.array([Q_statistics(t.encode()) for t, _ in used])), np.array([y for _, y in used])
    raw = x @ w
    grad = 1e-4 * w
    pairs = int(good.sum()) * int((~good).sum())
    for part in np.array_split(np.flatnonzero(good), 200):
        p = 1 / (1 + np.exp(raw[part][:, None] - raw[~good]))
        grad += (p.sum(0) @ x[~good] - p.sum(1) @ x[part]) / pairs
    assert len(used) > 20_000 and np.abs(grad).max() < 1e-6  # the least mean loss over all pairs
    raw.sort()
    bad, near = int((~good).sum()), len(raw) // 200
    lo = bad - 1 - near
    k = lo + int(np.diff(raw[lo : bad + near + 1]).argmax())
    assert abs(cut - (raw[k] + raw[k + 1]) / 2) < 1e-9 and abs(scale - raw.std() / 4) < 1e-9


def test_quality_model_over_tasks_is_the_same(spark, words, monkeypatch):
    docs, labels = corpus(spark, words, 400)
    docs = docs.union(docs.where("doc_id % 3 = 0"))  # rows that are alike count each
    one = Q.learn(docs, labels)
    monkeypatch.setattr(Q, "TASK", 30)
    two = Q.learn(docs, labels)
    assert all(np.allclose(a, b, rtol=1e-9) for a, b in zip(one, two))
    again = Q.learn(docs.repartition(7), labels)
    assert all(np.array_equal(a, b) for a, b in zip(two, again))
    none = Q.learn(docs, labels.where("quality = 1"))
    assert not none[0].any() and none[1:] == (0.0, 1.0)


def test_widest_gap_with_ties_and_parts():
    r = np.random.default_rng(8)
    for turn in range(200):
        raw = np.sort(r.integers(0, r.integers(1, 40), r.integers(2, 60)) / 7)
        bad = int(r.integers(1, len(raw)))
        lo, hi = Q._window(len(raw), bad)
        k = lo + int(np.diff(raw[lo : hi + 1]).argmax())
        values, count = np.unique(raw, return_counts=True)
        [(_, _, middle)] = Q._widest(values, count, 0, (lo, hi))
        assert abs(middle - (raw[k] + raw[k + 1]) / 2) < 1e-12
