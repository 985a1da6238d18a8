"""Quality rules as weak supervision: rules vote, EM weighs them, a posterior decides.

Each rule looks at a document's statistics and votes bad, good, or abstains. Which vote a
rule gives is counted over all documents as patterns of votes; there are at most
3 ** len(RULES) patterns, however large the table is, and only their counts reach the
driver. Expectation-maximisation over the pattern counts estimates the share of good
documents and for each rule how often it votes bad on good and on bad documents when it
votes. It starts from the share of good votes in each pattern, so a rule earns its weight by
agreeing with others: kinds of bad text are seen by two rules or more, and a bad vote that
all others contradict is outvoted. A document is kept when its posterior probability of being
good reaches ``least``.

Defined results: null counts as the empty text; all of its statistics are 0. Documents
with fewer than 10 words, or with over 20 % of their words in repeated five-word windows,
fail the base rules whatever the posterior says. Rows are judged one by one, so repeated
rows get the same verdict. Extra columns are ignored (or kept, by ``keep_good``). An empty
table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

WINDOW = 5
FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_bars", "n_bangs", "n_twice", "n_distinct", "n_marked", "n_stops"]
SCHEMA = ", ".join(f"{x} bigint" for x in FIELDS)

_WHITE, _SYMBOLS = b" \t\n\r\x0b\x0c", b"#*$%&|<>"
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_PLAIN = bytes(set(range(256)) - set(_WHITE) - set(b"#*$%&|<>@=_\\^~{}[]0123456789"))
_STOP = re.compile(rb"[.,;:!?](?=[\x20\x09-\x0D]|\Z)")


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def repeated_words(words: list[bytes], width: int = WINDOW) -> tuple[int, int, int]:
    """Words within windows that are found twice or more; words equal to the one before;
    different words."""
    if len(words) < 2:
        return 0, 0, len(words)
    numbers = _Numbers()
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    twice = int((ids[1:] == ids[:-1]).sum())
    n = len(ids) - width + 1
    if n < 2:
        return 0, twice, len(numbers)
    # exact window numbers: pair numbers are made dense after each word
    code = ids[:n]
    for i in range(1, width):
        code = np.unique(code * len(numbers) + ids[i : i + n], return_inverse=True)[1]
        if i < width - 1 and int(code.max()) + 1 == n:
            return 0, twice, len(numbers)  # all windows differ already
    again = np.bincount(code)[code] > 1
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(again), 1)
    np.add.at(edge, np.flatnonzero(again) + width, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum()), twice, len(numbers)


def statistics(text: bytes | None) -> tuple[int, ...]:
    """The FIELDS of one text."""
    if not text:
        return (0,) * len(FIELDS)
    words = text.split()
    dense = text.translate(None, _WHITE)
    chars = len(dense) if dense.isascii() else int((np.frombuffer(dense, np.uint8) & 0xC0 != 0x80).sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeated, twice, distinct = repeated_words(words)
    upper = len(dense) - len(dense.translate(None, _UPPER))
    return (
        len(words), chars, len(dense) - len(dense.translate(None, _SYMBOLS)), len(lines) - len(set(lines)), repeated, len(lines),
        upper, upper + len(dense) - len(dense.translate(None, _LOWER)), dense.count(b"|"), dense.count(b"!!"), twice,
        distinct, len(text.translate(None, _PLAIN).split()), len(_STOP.findall(text)),
    )


def _stats(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([statistics(t) for t in texts], columns=FIELDS, dtype=np.int64)


def stats_of(text: Column) -> Column:
    return F.pandas_udf(_stats, SCHEMA)(text.cast("binary"))


def _ratio(top: str, under: str) -> str:
    return f"{top} / greatest(1, {under})"


#: (name, SQL condition of a bad vote, of a good vote); else the rule abstains.
RULES = [
    ("symbols", f"{_ratio('n_symbols', 'word_chars')} > 0.05", f"{_ratio('n_symbols', 'word_chars')} < 0.01"),
    ("repeats", f"{_ratio('n_repeat_words', 'n_words')} > 0.1", f"{_ratio('n_repeat_words', 'n_words')} < 0.05"),
    ("word_length", f"{_ratio('word_chars', 'n_words')} not between 2 and 16", f"{_ratio('word_chars', 'n_words')} between 3 and 12"),
    ("capitals", f"n_letters > 20 and {_ratio('n_upper', 'n_letters')} > 0.4", f"n_letters > 20 and {_ratio('n_upper', 'n_letters')} < 0.2"),
    ("bars", f"{_ratio('n_bars', 'n_words')} > 0.1", f"{_ratio('n_bars', 'n_words')} < 0.02"),
    ("bangs", f"{_ratio('n_bangs', 'n_words')} > 0.1", f"{_ratio('n_bangs', 'n_words')} < 0.02"),
    ("stutter", f"n_words >= 10 and {_ratio('n_twice', 'n_words')} > 0.2", f"{_ratio('n_twice', 'n_words')} < 0.1"),
    ("duplicate_lines", f"n_lines >= 4 and {_ratio('n_dup_lines', 'n_lines')} > 0.5", f"n_lines >= 4 and {_ratio('n_dup_lines', 'n_lines')} < 0.1"),
    ("length", "n_words < 20", "n_words >= 40"),
    ("marked_words", f"n_words >= 5 and {_ratio('n_marked', 'n_words')} > 0.3", f"n_words >= 5 and {_ratio('n_marked', 'n_words')} < 0.1"),
    ("variety", f"n_words between 20 and 2000 and {_ratio('n_distinct', 'n_words')} < 0.35", f"n_words between 20 and 2000 and {_ratio('n_distinct', 'n_words')} > 0.55"),
    ("stops", f"n_words >= 20 and {_ratio('n_stops', 'n_words')} not between 0.03 and 0.4", f"n_words >= 20 and {_ratio('n_stops', 'n_words')} between 0.06 and 0.3"),
]


def votes() -> Column:
    """The pattern of votes: one character a rule, b, g or - in the order of RULES."""
    return F.concat(*[F.expr(f"case when {bad} then 'b' when {good} then 'g' else '-' end") for _, bad, good in RULES])


def fit(patterns: list[str], counts: np.ndarray, rounds: int = 200) -> dict[str, float]:
    """Posterior of good for each pattern, by EM over the counts."""
    if not patterns:
        return {}
    bad = np.array([[c == "b" for c in p] for p in patterns], float)
    voted = np.array([[c != "-" for c in p] for p in patterns], float)
    w = np.asarray(counts, float)
    good = 1 - (bad.sum(1) + 0.5) / (voted.sum(1) + 1)  # start: the share of good votes
    for _ in range(rounds):
        prior = np.clip((good * w).sum() / w.sum(), 0.01, 0.99)
        log = []
        for share, mass in ((prior, good * w), (1 - prior, (1 - good) * w)):
            # a pseudo-count of each keeps rates off 0 and 1
            rate = (mass @ bad + 1) / (mass @ voted + 2)
            log.append(np.log(share) + bad @ np.log(rate) + (voted - bad) @ np.log(1 - rate))
        new = 1 / (1 + np.exp(np.clip(log[1] - log[0], -500, 500)))
        if np.abs(new - good).max() < 1e-9:
            good = new
            break
        good = new
    return dict(zip(patterns, good.tolist(), strict=True))


def base_failed() -> Column:
    return F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words")



def _posteriors(rated: DataFrame) -> DataFrame:
    """(pattern, posterior) from rows with a pattern; at most 3 ** len(RULES) rows."""
    found = rated.groupBy("pattern").count().collect()
    found.sort(key=lambda r: r["pattern"])
    made = fit([r["pattern"] for r in found], np.array([r["count"] for r in found]))
    return rated.sparkSession.createDataFrame(list(made.items()), "pattern string, posterior double")


def rate(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, posterior."""
    C.small_batches(docs.sparkSession)
    slim = C.pick(docs, "doc_id", "text").select("doc_id", stats_of(F.col("text")).alias("s")).select("doc_id", "s.*")
    rated = C.cut(slim.withColumn("pattern", votes()))
    out = rated.join(F.broadcast(_posteriors(rated)), "pattern", "left")
    return out.select("doc_id", *FIELDS[:5], base_failed().alias("base_failed"), (~base_failed() & (F.col("posterior") >= least)).alias("kept"), "posterior")


def keep_good(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of docs that are kept, with all their columns.

    The text is read twice: for the counts of patterns, and for the verdict on each row.
    So neither texts nor verdicts are shuffled.
    """
    C.small_batches(docs.sparkSession)
    flat, names = C.positional(docs)
    text = F.col(f"__c{C.place(names, 'text')}")
    stats = flat.select("*", stats_of(text).alias("__s"))
    rated = stats.select(*flat.columns, "__s.*").withColumn("pattern", votes())
    known = _posteriors(rated.select("pattern"))
    kept = rated.join(F.broadcast(known), "pattern", "left").where(~base_failed() & (F.col("posterior") >= least))
    return kept.select(*flat.columns).toDF(*names)


# --- queries --------------------------------------------------------------------------


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    """All documents, rated by twelve voting rules."""
    return rate(C.table(spark, sf_dir, "documents")).drop("posterior")


QUERIES = {"op10_quality_rules": op10_quality_rules}
SQL: dict[str, str] = {}
