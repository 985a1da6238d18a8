"""Secret scans by a trigram inverted index over the texts.

Each rule's regular expression is parsed, and a Boolean query over trigrams is derived from
it: a text can only match if it has, for one of the alternatives, all of the trigrams that
the alternative forces. The index holds postings (trigram, document key) for the trigrams
that occur in such queries, over lower-cased text; postings are intersected per document,
the query is evaluated, and the regular expression runs on the candidates only. A rule that
forces no trigram scans all texts.

Base rules (assign, access, hex) and further ones are all found leftmost and without
overlaps within a rule; matches that fail a rule's length test are dropped. Offsets are code
points, the end is exclusive.

All of it is DataFrame expressions: offsets come from the lengths of what split() leaves
between the matches and of the matches themselves, added up in chunks, so that a text with
very many matches takes time in proportion to them.

Defined results: a null text counts as empty and has no spans (the base digest is then that
of the empty string). Rows are judged one by one; repeated rows get the same spans. Extra
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

MOST_STRINGS = 64
#: Matches whose places are added up in one array.
CHUNK = 256
SPANS = "array<struct<start:int,ord:int,kind:string,stop:int>>"


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0  # whose length is tested
    least: int = 1
    base: bool = False

    @property
    def sql_pattern(self) -> str:
        """The same for RE2, where ignoring case would also fold letters beyond ASCII."""
        if not self.pattern.startswith("(?i)"):
            return self.pattern
        out, depth = "", 0
        for i, c in enumerate(p := self.pattern[4:]):
            depth += (c == "[") - (c == "]")
            escaped = i and p[i - 1] == "\\" or re.search(r"\\x.?$", p[:i])
            out += f"[{c.lower()}{c.upper()}]" if c.isascii() and c.isalpha() and not depth and not escaped else c
        return out


#: For access and hex, a match is a run to its end, so a least length within the pattern gives
#: the same matches as the unbounded run with a test afterwards. For assign it would not.
RULES = [
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", "AKIA[A-Z0-9]{14,}", 0, 18, True),
    Rule("hex", "[0-9a-f]{16,}", 0, 16, True),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("bearer", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    Rule("prefixed", "(ghp|gho|ghs|glpat|xoxb|xoxp|sk_live|rk_live)[_-][A-Za-z0-9_-]+", 0, 24),
]


# --- trigram queries ------------------------------------------------------------------


def _strings(node, most: int = MOST_STRINGS) -> set[str] | None:
    """All strings that a parsed node can match, lower-cased, if they are few."""
    op, arg = node
    op = str(op)
    if op == "LITERAL":
        return {chr(arg).lower()}
    if op == "IN":
        out = set()
        for kind, x in arg:
            if str(kind) == "LITERAL":
                out.add(chr(x).lower())
            elif str(kind) == "RANGE" and x[1] - x[0] < 8:
                out |= {chr(i).lower() for i in range(x[0], x[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if op == "SUBPATTERN":
        return _sequence_strings(arg[3], most)
    if op == "BRANCH":
        parts = [_sequence_strings(x, most) for x in arg[1]]
        return set().union(*parts) if all(p is not None for p in parts) else None
    if op in ("MAX_REPEAT", "MIN_REPEAT") and arg[1] <= 2 and (one := _sequence_strings(arg[2], most)) is not None:
        out = {"".join(x) for n in range(arg[0], int(arg[1]) + 1) for x in product(one, repeat=n)}
        return out if len(out) <= most else None
    return None


def _sequence_strings(nodes, most: int) -> set[str] | None:
    out = {""}
    for node in nodes:
        one = _strings(node, most)
        if one is None or len(out) * len(one) > most:
            return None
        out = {a + b for a in out for b in one}
    return out


def _any(options: list[frozenset]) -> list[frozenset]:
    """Alternatives of trigram sets without those that another one implies."""
    least = []
    for x in sorted(set(options), key=lambda x: (len(x), sorted(x))):
        if not any(y <= x for y in least):
            least.append(x)
    return least


def _all(a: list[frozenset], b: list[frozenset]) -> list[frozenset]:
    both = [x | y for x in a for y in b]
    return _any(both) if len(both) <= MOST_STRINGS else a


def _of(strings: set[str]) -> list[frozenset]:
    return _any([frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings])


def _query(nodes) -> list[frozenset]:
    need, run = [frozenset()], {""}
    for node in nodes:
        one = _strings(node)
        if one is not None and len(run) * len(one) <= MOST_STRINGS:
            run = {a + b for a in run for b in one}
            continue
        need, run = _all(need, _of(run)), {""}
        op, arg = str(node[0]), node[1]
        if one is not None:
            run = one
        elif op == "SUBPATTERN":
            need = _all(need, _query(arg[3]))
        elif op == "BRANCH":
            need = _all(need, _any([x for part in arg[1] for x in _query(part)]))
        elif op in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] >= 1:
            need = _all(need, _query(arg[2]))
    return _all(need, _of(run))


def trigram_query(pattern: str) -> list[frozenset]:
    """Alternatives, each a set of trigrams that must all occur in the lower-cased text.

    A single empty set means that no trigram is forced. The set of any matching text's
    trigrams includes one of the alternatives.
    """
    return _query(list(re._parser.parse(pattern)))


# --- the index ------------------------------------------------------------------------

_A, _Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """(gram, k1, k2): which documents have which of the trigrams. docs: k1, k2, text."""
    low = docs.select("k1", "k2", F.translate("text", _A, _Z).alias("low"))
    has = F.filter(F.lit(list(range(len(trigrams)))), lambda i: F.contains(F.col("low"), F.get(F.lit(trigrams), i)))
    return low.select(F.explode(has).alias("gram"), "k1", "k2")


def candidates(index: DataFrame, rules: list[Rule], trigrams: list[str]) -> DataFrame:
    """(k1, k2, rules): bit i is set if rule i's trigram query holds for the document."""
    at = {t: i for i, t in enumerate(trigrams)}
    words = range(len(trigrams) // 62 + 1)
    masks = [F.bit_or(F.when(F.floor(F.col("gram") / 62) == w, F.expr("shiftleft(1L, gram % 62)")).otherwise(F.lit(0).cast("bigint"))).alias(f"m{w}") for w in words]
    met = index.groupBy("k1", "k2").agg(*masks)
    bits = F.lit(0).cast("bigint")
    for n, rule in enumerate(rules):
        options = trigram_query(rule.pattern)
        if options == [frozenset()]:
            continue
        hit = F.lit(False)
        for x in options:
            part = F.lit(True)
            for w in words:
                if need := sum(1 << at[t] % 62 for t in x if at[t] // 62 == w):
                    part &= F.col(f"m{w}").bitwiseAND(F.lit(need)) == F.lit(need)
            hit |= part
        bits = bits.bitwiseOR(F.when(hit, F.lit(1 << n)).otherwise(F.lit(0)).cast("bigint"))
    return met.select("k1", "k2", bits.alias("rules")).where("rules <> 0")


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """array<struct<start, ord, kind, stop>> of a rule's matches that pass its test."""
    found, between = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), F.split(text, rule.pattern, -1)
    tested = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    facts = F.zip_with(F.zip_with(between, found, lambda g, m: F.struct(F.length(g).alias("g"), F.length(m).alias("m"))), tested, lambda x, t: F.struct(x.g.alias("g"), x.m.alias("m"), F.length(t).alias("t")))
    facts = F.filter(facts, lambda x: x.m.isNotNull())
    return _let(facts, lambda f: _let(_parts(f, rule, order), _shifted))


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _parts(facts: Column, rule: Rule, order: int) -> Column:
    """array<struct<at, got>>: for each CHUNK matches the length of text they take and their
    spans from its start. Appending to arrays is quadratic, so only short ones are appended to."""
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(facts) - 1) / CHUNK).cast("int")), lambda c: F.slice(facts, c * CHUNK + 1, CHUNK))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("got"))

    def step(a: Column, x: Column) -> Column:
        own = F.struct((a.at + x.g).alias("start"), F.lit(order).alias("ord"), F.lit(rule.kind).alias("kind"), (a.at + x.g + x.m).alias("stop"))
        return F.struct((a.at + x.g + x.m).alias("at"), F.when(x.t >= rule.least, F.concat(a.got, F.array(own))).otherwise(a.got).alias("got"))

    return F.when(F.size(facts) > 0, F.transform(chunks, lambda part: F.aggregate(part, start, step)))


def _shifted(parts: Column) -> Column:
    """The spans of all parts, from the text's start."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("got"))
    begins = F.aggregate(parts, start, lambda a, x: F.struct((a.at + x.at).alias("at"), F.concat(a.got, F.array(a.at)).alias("got")), lambda a: a.got)
    moved = F.zip_with(parts, begins, lambda x, b: F.transform(x.got, lambda s: F.struct((s.start + b).alias("start"), s.ord.alias("ord"), s.kind.alias("kind"), (s.stop + b).alias("stop"))))
    return F.coalesce(F.flatten(moved), F.array().cast(SPANS))


def scan(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """One row per document: doc_id, n_<kind> for base kinds, base_sha256, spans."""
    slim = C.pick(docs, "doc_id", "text")
    k1, k2 = C.hash2("doc_id", "text")
    keyed = slim.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), k1.alias("k1"), k2.alias("k2"))
    trigrams = sorted({t for r in rules for x in trigram_query(r.pattern) for t in x})
    possible = candidates(postings(keyed, trigrams), rules, trigrams)
    joined = keyed.join(possible, ["k1", "k2"], "left")
    none = F.array().cast(SPANS)
    text, cols = F.col("text"), []
    for n, rule in enumerate(rules):
        if trigram_query(rule.pattern) == [frozenset()]:
            may = text.rlike(rule.pattern)
        else:
            may = F.coalesce(F.col("rules").bitwiseAND(F.lit(1 << n)) != 0, F.lit(False))
        cols.append(F.when(may, _spans(text, rule, n)).otherwise(none).alias(f"s{n}"))
    each = joined.select("doc_id", *cols)

    def listed(columns: list[str]) -> Column:
        return F.array_join(F.transform(F.array_sort(F.concat(*columns)), lambda x: F.concat_ws(":", x.kind, x.start, x.stop)), ",")

    base = [f"s{n}" for n, r in enumerate(rules) if r.base]
    counts = [F.size(f"s{n}").cast("bigint").alias(f"n_{r.kind}") for n, r in enumerate(rules) if r.base]
    return each.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed([f"s{n}" for n in range(len(rules))]).alias("spans"))


# --- queries --------------------------------------------------------------------------


def op6_secret_scan(spark, sf_dir: str) -> DataFrame:
    """All documents, three base rules and three further ones."""
    return scan(C.table(spark, sf_dir, "documents"))


QUERIES = {"op6_secret_scan": op6_secret_scan}


def _sql() -> str:
    parts = []
    for n, r in enumerate(RULES):
        p = r.sql_pattern.replace("'", "''")
        parts.append(f"""
            SELECT doc_id, {n} AS ord, '{r.kind}' AS kind, i,
                   list_sum([length(x) for x in g[1:i]]) + coalesce(list_sum([length(x) for x in m[1:i-1]]), 0) AS start, length(m[i]) AS n, length(t[i]) AS tested
            FROM (SELECT doc_id, unnest(range(1, len(m) + 1)) AS i, m, g, t FROM (
                SELECT doc_id, regexp_extract_all(text, '{p}', 0) AS m, string_split_regex(text, '{p}') AS g, regexp_extract_all(text, '{p}', {r.group}) AS t
                FROM documents WHERE text IS NOT NULL))
            WHERE length(t[i]) >= {r.least}""")
    base = [n for n, r in enumerate(RULES) if r.base]
    counts = ", ".join(f"count(s.kind) FILTER (s.kind = '{RULES[n].kind}') AS n_{RULES[n].kind}" for n in base)
    listed = "string_agg(s.kind || ':' || s.start::BIGINT || ':' || (s.start + s.n)::BIGINT, ',' ORDER BY s.start, s.ord)"
    return f"""
        WITH s AS ({" UNION ALL ".join(parts)})
        SELECT d.doc_id, {counts}, sha256(coalesce({listed} FILTER (s.ord <= {max(base)}), '')) AS base_sha256, coalesce({listed}, '') AS spans
        FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id GROUP BY d.doc_id
    """


SQL = {"op6_secret_scan": _sql()}
