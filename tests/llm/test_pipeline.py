import random

import corpus_pipeline as P
from roadloom.llm import bpe, near_dedup, quality_rules
from tests.llm.conftest import make
from tests.llm.test_dedup import brute_components, brute_lines


def test_stages_one_by_one(spark, words):
    r = random.Random(21)
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage = "\n".join(text(9) for _ in range(3))
    rows = [(i, "\n".join(text(12) for _ in range(4)), f"s{i % 4}") for i in range(60)]
    rows += [(100 + i, text(30) + "\n" + passage + "\n" + text(20), "s1") for i in range(5)]
    near = rows[0][1].split(" ")
    rows += [(200 + i, " ".join(near[:20] + [words[i]] + near[21:]), "s2") for i in range(3)]
    rows += [(300, "junk### " * 60, "s3"), (301, "few words", "s3"), (302, None, "s3")]
    docs = make(spark, rows)
    stages = dict(P.STAGES)
    assert list(stages) == ["quality_rules", "line_dedup", "near_dedup", "mixing", "encoding"]

    one = stages["quality_rules"](spark, docs, "")
    assert one.columns == docs.columns
    kept = {x.doc_id: x.text for x in one.collect()}
    assert not kept.keys() & {300, 301, 302} and len(kept) == 68

    two = stages["line_dedup"](spark, one, "")
    left = brute_lines(list(kept.items()))
    got = {x.doc_id: x for x in two.collect()}
    assert {i: x.text for i, x in got.items()} == {i: left[(i, t)] for i, t in kept.items()}
    assert all(x.n_chars == len(x.text) for x in got.values())
    assert sum(passage in x.text for x in got.values()) == 1

    three = stages["near_dedup"](spark, two, "")
    pairs = [(i, x.text) for i, x in got.items()]
    _, groups = brute_components(pairs, 5, 80)
    stays = {x.doc_id for x in three.collect()}
    assert stays == {min(pairs[i][0] for i in g) for g in groups.values()}

    four = stages["mixing"](spark, three, "")
    assert four.columns == docs.columns
    counts = {}
    for x in four.collect():
        counts[x.doc_id] = counts.get(x.doc_id, 0) + 1
    assert max(counts.values()) <= 2 and counts.keys() <= stays

    five = stages["encoding"](spark, four, "").collect()
    coder = bpe.Encoder(bpe.PerfectHash(bpe.read_ranks(bpe.default_path())), bpe.default_pattern())
    assert len(five) == sum(counts.values())
    texts = {i: x.text for i, x in got.items()}
    assert all(list(x.ids) == coder.encode(texts[x.doc_id]) for x in five)


def test_stages_take_an_empty_table(spark, empty_docs):
    docs = empty_docs
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == empty_docs.columns and docs.count() == 0, name
    assert P.STAGES[-1][1](spark, docs, "").count() == 0


def test_stages_take_odd_rows(spark, clashing):
    docs = clashing
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == clashing.columns, name
        docs.count()
    assert P.STAGES[-1][1](spark, docs, "").count() == docs.count()
    assert quality_rules.RULES and near_dedup.BANDS
