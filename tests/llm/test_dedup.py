import hashlib
import random
import re

import numpy as np
import pytest

from roadloom.llm import exact_dedup as X
from roadloom.llm import line_dedup as L
from roadloom.llm import near_dedup as N
from tests.llm.conftest import make


def brute_components(rows, width, percent):
    """doc id lists by set comparison of all pairs; rows of (id, text)."""
    sets = [N.shingles_of(t.encode() if t else None, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                c = len(sets[i] & sets[j])
                if 100 * c >= percent * len(sets[i] | sets[j]):
                    a, b = sorted((find(i), find(j)))
                    root[b] = a
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    return [len(s) for s in sets], groups


def family(words, n, seed, size=120, most=0.2):
    r = random.Random(seed)
    base = [r.choice(words) for _ in range(size)]
    out = []
    for _ in range(n):
        t = list(base)
        for _ in range(r.randint(0, int(size * most * 0.5))):
            t[r.randrange(size)] = r.choice(words)
        out.append(" ".join(t))
    return out


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_match_brute_force(spark, words, width):
    r = random.Random(width)
    texts = family(words, 80, 1) + family(words, 40, 2, 300, 0.1) + [" ".join(r.choice(words) for _ in range(r.randint(1, 90))) for _ in range(40)]
    chain = [r.choice(words) for _ in range(100)]
    for k in range(25):  # each near to the next only
        chain = chain[4:] + [r.choice(words) for _ in range(4)] if k else chain
        texts.append(" ".join(chain))
    rows = list(enumerate(texts))
    r.shuffle(rows)
    got = {x.doc_id: x for x in N.near_duplicates(make(spark, [(i, t, "a") for i, t in rows]), width, 80).collect()}
    sizes, groups = brute_components(rows, width, 80)
    for members in groups.values():
        least = min(rows[i][0] for i in members)
        for i in members:
            x = got[rows[i][0]]
            assert (x.component_id, x.n_shingles, x.kept) == (least, sizes[i], rows[i][0] == least)


def test_near_duplicates_odd_rows(odd_docs, clashing, empty_docs):
    for docs in (odd_docs, clashing):
        rows = N.near_duplicates(docs, 2, 80).collect()
        assert len(rows) == 17
        by = {}
        for x in rows:
            by.setdefault(x.doc_id, []).append(x)
        assert all(x.n_shingles == 0 and x.component_id == x.doc_id for i in (1, 2, 3) for x in by[i])
        assert {x.component_id for i in (4, 5, 6) for x in by[i]} == {4}
        assert by[14][0].component_id == 13 and not by[14][0].kept
        assert sorted(str(x.component_id) for x in by[None]) == ["4", "None"]
        kept = N.drop_near_duplicates(docs, 2, 80)
        assert kept.columns == docs.columns
        ids = sorted(str(r[0]) for r in kept.collect())
        assert ids == sorted(["1", "2", "3", "None", "4", "7", "8", "9", "10", "11", "12", "13"])
    assert N.near_duplicates(empty_docs).count() == 0
    assert N.drop_near_duplicates(empty_docs).count() == 0


def test_registers_keep_zeros_and_mantissa():
    x = np.array([1 << 63, 1, (1 << 63) | (1 << 62), 0b101 << 40], np.uint64)
    got = N._registers(x)
    assert [int(g) >> 10 for g in got] == [0, 63, 0, 21]
    assert [int(g) & 1023 for g in got] == [0, 0, 512, 256]


def test_exact_duplicates_match_brute_force(spark, odd_docs, clashing, empty_docs, odd_rows, words):
    r = random.Random(3)
    rows = odd_rows + [(100 + i, r.choice(["same", "twice ", "twice", None, words[i]]), "z") for i in range(300)]
    want = {}
    for i, t, _ in rows:
        want.setdefault(t or "", []).append(i)
    for docs, source in ((make(spark, rows), rows), (clashing, odd_rows)):
        group = {}
        for i, t, _ in source:
            group.setdefault(t or "", []).append(i)
        expect = []
        for i, t, _ in source:
            g = group[t or ""]
            top = max((x for x in g if x is not None), default=None)
            expect.append((i, top, len(g), i == top, hashlib.sha256((t or "").encode()).hexdigest()))
        got = [tuple(x) for x in X.exact_duplicates(docs, capacity=5).collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, expect))
    assert X.exact_duplicates(empty_docs).count() == 0


def test_directory_doubles_and_splits():
    counts = np.zeros(1 << X.DEPTH, np.int64)
    counts[:100] = 10
    d = X.Directory(counts, 100)
    assert d.depth == 16 or d.depth >= 12
    covered = sum(1 << (X.DEPTH - local) for _, local in d.buckets)
    assert covered == 1 << X.DEPTH  # buckets share the key space out
    for prefix, local in d.buckets:
        step = 1 << (X.DEPTH - local)
        assert counts[prefix * step : (prefix + 1) * step].sum() <= 100 or local == X.DEPTH


def test_chain_keeps_collisions_apart():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([1, 1, 1, 2]), pa.array([b"a", b"b", b"a", b"c"]), pa.array([5, 6, 9, 7]), pa.array([1, 2, 3, 4]), pa.array([b"x", b"y", b"x", b"z"])], names=list("abcde"))
    rows = [tuple(r.values()) for b in X._own(iter([batch])) for r in b.to_pylist()]
    assert sorted(rows) == [(1, b"a", 9, 4), (1, b"b", 6, 2), (2, b"c", 7, 4)]


def split_lines(text):
    return re.split(r"(?<=\n)|(?<=[.!?] )", text)


def brute_lines(rows, width=3):
    """(id, text) -> what is left; the later occurrences of windows go."""
    first, out = {}, {}
    uniq = sorted({(i is None, i or 0, t) for i, t in rows if t is not None})
    gone = {k: set() for k in uniq}
    for k in uniq:
        lines = split_lines(k[2])
        for p in range(len(lines) - width + 1):
            win = tuple(x.rstrip(" \n") for x in lines[p : p + width])
            ends = [x.endswith("\n") for x in lines[max(0, p - 1) : p + width]]
            ends[-1] |= p + width == len(lines)
            letters = sum(c not in " \t\n\x0b\x0c\r" for x in win for c in x)
            if letters < (1 if all(ends) else L.LETTERS):
                continue
            if win in first:
                gone[k] |= set(range(p, p + width))
            else:
                first[win] = k
    for k in uniq:
        out[(None if k[0] else k[1], k[2])] = "".join(x for i, x in enumerate(split_lines(k[2])) if i not in gone[k])
    return out


def test_line_dedup_matches_brute_force(spark, odd_docs, clashing, empty_docs, odd_rows):
    r = random.Random(9)
    lines = [f"line {i}" for i in range(40)] + ["", " ", "A sentence of some length. Then a second one follows it! And a third?", "Yes. No. Yes."]
    rows = [(i, "\n".join(r.choice(lines[:12] if i % 3 else lines) for _ in range(r.randint(1, 25))), "a") for i in range(150)]
    want = brute_lines([(i, t) for i, t, _ in rows])
    got = L.line_report(make(spark, rows)).collect()
    assert len(got) == 150
    texts = dict((i, t) for i, t, _ in rows)
    for x in got:
        left = want[(x.doc_id, texts[x.doc_id])]
        assert x.text == left
        assert len(split_lines(texts[x.doc_id])) >= x.n_removed >= (left != texts[x.doc_id])
    out = L.drop_lines(clashing)
    assert out.columns == clashing.columns and out.count() == len(odd_rows)
    by = {r[0]: r[1] for r in out.collect()}
    assert by[1] is None and by[2] == "" and by[9] == "x\n"
    assert L.line_report(empty_docs).count() == 0


def test_passages_within_lines_go(spark, words):
    r = random.Random(12)
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    said = lambda n: " ".join(f"{text(r.randint(5, 9))}." for _ in range(n))
    passage = said(8)
    rows = [(1, f"{said(3)} {passage} {said(2)}", "a"), (2, f"{text(7)}\n{said(4)} {passage} {said(5)}", "a"), (3, said(30), "a"), (4, "Yes. No. Yes.", "a"), (5, "Yes. No. Yes.", "a")]
    got = {x.doc_id: x.text for x in L.line_report(make(spark, rows)).collect()}
    assert [got[i] for i in (1, 3, 4, 5)] == [rows[0][1], rows[2][1], "Yes. No. Yes.", "Yes. No. Yes."]
    assert got[2] == rows[1][1].replace(passage + " ", "")


@pytest.mark.parametrize("strays", [32, 0])
def test_no_link_is_lost_between_hub_families(spark, words, monkeypatch, strays):
    """x and y are just linked; many larger families are like x or y, but linked to neither.
    Without strays, everything goes through new pivots and the index of differences."""
    monkeypatch.setattr(N, "STRAYS", strays)
    monkeypatch.setattr(N, "ROUNDS", 2)
    r = random.Random(77)
    vocabulary = [f"w{i}" for i in range(20_000)]
    x = r.sample(vocabulary, 400)
    y = x[:356] + r.sample(vocabulary[15_000:], 43)
    texts = [x, y]
    for _ in range(8):  # hubs at a similarity of about 0.55 to x
        hub = x[:280] + r.sample(vocabulary, 110)
        r.shuffle(hub)
        for _ in range(12):
            near = list(hub)
            for _ in range(r.randint(0, 12)):
                near[r.randrange(len(near))] = r.choice(vocabulary)
            texts.append(near)
    for _ in range(25):  # alike by a common half, not linked
        texts.append(x[:300] + r.sample(vocabulary, 120))
    rows = [(i, " ".join(t), "a") for i, t in enumerate(texts)]
    sizes, groups = brute_components([(i, t) for i, t, _ in rows], 1, 80)
    assert any(set(g) >= {0, 1} for g in groups.values())
    got = {d.doc_id: d.component_id for d in N.near_duplicates(make(spark, rows), 1, 80).collect()}
    for members in groups.values():
        assert {got[i] for i in members} == {min(members)}


def test_hot_keys_dealt_over_tasks_change_nothing(spark, words, monkeypatch, odd_rows):
    """With tiny limits every join goes through parts."""
    from roadloom.llm import common as C

    monkeypatch.setattr(C, "FEW", 0)
    monkeypatch.setattr(C, "LEAST", 2)
    monkeypatch.setattr(C, "SHARE", 8)
    monkeypatch.setattr(N, "EDGES_A_TASK", 20)
    texts = family(words, 40, 6) + ["equal text here"] * 30
    rows = [(i, t, "a") for i, t in enumerate(texts)]
    assert C.hot_keys(make(spark, rows), ["source"]) and not C.hot_keys(make(spark, rows), ["doc_id"])
    _, groups = brute_components([(i, t) for i, t, _ in rows], 2, 80)
    got = {d.doc_id: d.component_id for d in N.near_duplicates(make(spark, rows), 2, 80).collect()}
    assert all({got[i] for i in g} == {min(g)} for g in groups.values())
    kept = {d.doc_id: (d.keep_id, d.group_size) for d in X.exact_duplicates(make(spark, rows), capacity=5).collect()}
    assert all(kept[i] == (max(g), len(g)) for g in ([j for j, t in enumerate(texts) if t == texts[i]] for i in range(len(texts))) for i in g)
    lined = [(i, "\n".join([words[0]] * 3 + [words[i]]), "a") for i in range(30)]
    want = brute_lines([(i, t) for i, t, _ in lined])
    assert all(d.text == want[(d.doc_id, lined[d.doc_id][1])] for d in L.line_report(make(spark, lined)).collect())


def hub_with_strays(members=80, strays=24):
    """A family of linked texts, and texts that share most of its words but are linked to none."""
    r = random.Random(78)
    vocabulary = [f"w{i}" for i in range(20_000)]
    base = r.sample(vocabulary, 400)
    texts = [base[:i] + [f"m{i}"] + base[i + 1 :] for i in range(members)] + [base[:310] + r.sample(vocabulary, 90) for _ in range(strays)]
    return [(i, " ".join(t), "a") for i, t in enumerate(texts)]


def test_strays_make_no_row_for_each_pair(spark, monkeypatch):
    """24 strays beside 80 members: pairs that aren't linked must not be joined one by one."""
    rows, joined, alike = hub_with_strays(), [], N._alike

    def counted(pairs, *more):
        joined.append(pairs.count())
        return alike(pairs, *more)

    monkeypatch.setattr(N, "_alike", counted)
    _, groups = brute_components([(i, t) for i, t, _ in rows], 1, 80)
    got = {d.doc_id: d.component_id for d in N.near_duplicates(make(spark, rows), 1, 80).collect()}
    assert all({got[i] for i in g} == {min(g)} for g in groups.values())
    assert sum(joined) <= 6 * len(rows)


def test_met_deals_members_and_confirms(spark, monkeypatch):
    """Members of one bucket in several parts: every link between a hub and another label, once."""
    from roadloom.llm import common as C

    monkeypatch.setattr(C, "LEAST", 7)
    r = random.Random(79)
    base = [f"w{i}" for i in range(100)]
    texts = []
    for _ in range(60):
        t = list(base)
        for i in r.sample(range(100), r.randint(2, 14)):
            t[i] = f"x{r.randrange(10_000)}"
        texts.append(t)
    texts[5] = base + [f"long{i}" for i in range(400)]
    sets = [N.shingles_of(" ".join(t).encode(), 1) for t in texts]
    label, hubs = [i % 5 for i in range(60)], set(range(0, 60, 9))
    groups = spark.createDataFrame([(b, bytes([i]), bytes([label[i]]), 60, i in hubs) for b in (3, 4) for i in range(60)], "band long, fp binary, label binary, held long, hub boolean")
    shown = spark.createDataFrame([(bytes([i]), " ".join(t).encode()) for i, t in enumerate(texts)], "fp binary, text binary")
    got = sorted((d.a[0], d.b[0]) for d in N._met(groups, shown, 1, 80).collect())
    want = [(i, j) for i in range(60) for j in range(i + 1, 60) if (i in hubs or j in hubs) and label[i] != label[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    assert got == want and 50 < len(want) < 300


def test_near_duplicates_broadcast_nothing(spark, words):
    """The driver builds no table by Spark's own choice, in any of the many steps."""
    rows = hub_with_strays(20, 6) + [(100 + i, t, "a") for i, t in enumerate(family(words, 12, 8))]
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100m")
    try:
        N.near_duplicates(make(spark, rows), 1, 80).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    new = store.executionsList(int(before), int(store.executionsCount() - before))
    plans = [new.apply(i).physicalPlanDescription() for i in range(new.size())]
    assert any("SortMergeJoin" in p for p in plans)
    assert not any("BroadcastHashJoin" in p or "BroadcastExchange" in p for p in plans)


def test_index_of_differences_makes_a_row_for_each_member_and_slot(spark, monkeypatch):
    """A family of many strays: no row for each difference of a prefix, and no link is lost over slots."""
    monkeypatch.setattr(N, "STRAYS", 0)
    monkeypatch.setattr(N, "ROUNDS", 1)
    monkeypatch.setattr(N, "SLOT", 2_000)
    rows, seen, candidates = hub_with_strays(60, 40), [], N._candidates

    def counted(members):
        kind = "b binary, slot bigint, a binary, part binary, kind int, own int, ends array<int>, items array<bigint>, places array<int>"
        sent = members.mapInArrow(N._posted, kind).collect()
        seen.append((members.count(), sum(max(m.own, m.ends[0]) for m in members.collect()), sent, max(m.slots for m in members.collect())))
        return candidates(members)

    monkeypatch.setattr(N, "_candidates", counted)
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    _, groups = brute_components([(i, t) for i, t, _ in rows], 1, 80)
    got = {d.doc_id: d.component_id for d in N.near_duplicates(make(spark, rows), 1, 80).collect()}
    assert all({got[i] for i in g} == {min(g)} for g in groups.values())
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    new = store.executionsList(int(before), int(store.executionsCount() - before))
    assert not any("explode(slice(" in new.apply(i).physicalPlanDescription() for i in range(new.size()))
    [(members, posted, sent, slots)] = seen
    assert slots > 1 and len(sent) <= members * slots < posted / 2
    assert sum(len(r["items"]) for r in sent) == posted  # all differences of all prefixes


def test_shared_differences_match_all_pairs(monkeypatch):
    monkeypatch.setattr(N, "CHUNK", 50)
    r = np.random.default_rng(9)
    rows = []
    for i in range(50):
        items = r.choice(200, r.integers(1, 30), replace=False).astype(np.int64)
        ends = np.sort(r.integers(0, len(items) + 1, N.CLASSES))[::-1]
        rows.append((bytes([i % 6]), int(r.integers(N.CLASSES)), int(r.integers(0, len(items) + 1)) * (i % 3 > 0), ends.tolist(), items, np.arange(len(items), dtype=np.int32)))
    got = {tuple(p) for found in N._sharing(rows) for p in found.tolist()}
    want = {(min(i, j), max(i, j)) for i, x in enumerate(rows) for j, y in enumerate(rows) if x[0] != y[0] and set(x[4][: x[2]]) & set(y[4][: y[3][x[1]]])}
    assert got == want and len(want) > 100


def alike_not_linked(members, pairs=6):
    """Texts that share most words with one another, rare ones too, but of which only pairs are linked."""
    r = random.Random(80)
    base, pool = [f"w{i}" for i in range(310)], [f"p{i}" for i in range(400)]
    texts = [base + r.sample(pool, 90) for _ in range(members)]
    texts += [t[:-20] + [f"q{i}x{j}" for j in range(20)] for i, t in enumerate(texts[:pairs])]
    return [(i, " ".join(t), "a") for i, t in enumerate(texts)]


@pytest.mark.parametrize("slot", [100_000, 1_500])
def test_index_of_differences_makes_no_row_for_each_pair_that_shares_one(spark, monkeypatch, slot):
    """Nearly all pairs of the family share a difference of their prefixes; only linked ones become rows."""
    monkeypatch.setattr(N, "STRAYS", 0)
    monkeypatch.setattr(N, "ROUNDS", 1)
    monkeypatch.setattr(N, "SLOT", slot)
    rows, made, candidates = alike_not_linked(90), [], N._candidates

    def counted(members):
        found = candidates(members)
        made.append(found.count())
        return found

    monkeypatch.setattr(N, "_candidates", counted)
    _, groups = brute_components([(i, t) for i, t, _ in rows], 1, 80)
    assert sum(len(g) > 1 for g in groups.values()) == 6
    got = {d.doc_id: d.component_id for d in N.near_duplicates(make(spark, rows), 1, 80).collect()}
    assert all({got[i] for i in g} == {min(g)} for g in groups.values())
    assert len(made) == 1 and 1 <= made[0] <= 2 * len(rows)


def test_parities_drop_no_pair_that_may_be_linked(monkeypatch):
    """Whatever the words, a pair stays if its sets differ in no more than both have room for."""
    monkeypatch.setattr(N, "CHUNK", 64)
    r = np.random.default_rng(10)
    sets = [r.choice(120, r.integers(0, 60), replace=False).astype(np.int64) - 60 for _ in range(60)]
    room = r.integers(0, 30, 60) / 2
    found = np.array([(i, j) for i in range(60) for j in range(i + 1, 60)])
    gap = np.array([len(np.setxor1d(sets[i], sets[j])) for i, j in found])
    linked = {tuple(p) for p in found[gap <= room[found].sum(axis=1)].tolist()}
    for words, most in ((1, 60 * 60), (40, 2 * len(linked))):
        bits = np.frombuffer(b"".join(N._parities(s, words) for s in sets), np.uint64).reshape(60, -1)
        assert bits.shape == (60, words)
        kept = {tuple(p) for p in N._near_enough(found, bits, room).tolist()}
        assert linked <= kept and 20 < len(linked) and len(kept) < most
    assert N._near_enough(found[:0], bits, room).shape == (0, 2)
