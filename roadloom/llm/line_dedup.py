"""Repeated passages by overlapping windows of three lines.

A line ends with a newline or, within a line of prose, with a sentence: after '.', '!' or '?'
and a blank. So passages count that stand in the middle of longer lines, or are wrapped
otherwise. Lines make overlapping windows of three. A window's key is a 128-bit hash of its
lines without the blanks and newlines at their ends. Windows that occur more than once
anywhere are found by one aggregation; every occurrence but the first by (doc_id, text key,
line number) marks its three lines. Marked lines of a document are merged and removed. Lines
of a first occurrence go too where another window's later occurrence covers them; by induction
over that order, each line that is removed is still present where its text occurs first, so no
line is lost from the corpus. Of forty equal lines in a text, the first one stays.

Defined results: windows of whole lines (of newlines) count if they have a word. Windows with
a sentence's end inside need LETTERS characters beside white space, so that short phrases
('Yes. No. Yes.', initials) aren't passages. Texts of fewer than three lines stay as they
are. A null text stays null. A null doc_id comes after all others. Rows that repeat with the
same doc_id and text count as one occurrence and get the same result. Extra columns are
ignored (or kept, by ``drop_lines``). An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

WIDTH = 3
LETTERS = 40
#: The places between two lines, as a regular expression without width.
BREAK = "(?<=\\n|[.!?] )"


def lines_of(text: Column) -> Column:
    """The lines with what ends them; joined, they are the text."""
    return F.split(text, BREAK, -1)


def _windows(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, text_key, pos, h1, h2) for each window that counts. docs: doc_id, text."""
    split = docs.where(F.col("text").isNotNull()).select("doc_id", C.text_key(F.col("text")).alias("text_key"), lines_of(F.col("text")).alias("lines"))
    split = split.where(F.size("lines") >= width)

    def facts(line: Column, i: Column) -> Column:
        bare = F.rtrim(line, F.lit(" \n"))
        h1, h2 = C.hash2(bare)
        ends = F.endswith(line, F.lit("\n")) | (i == F.size("lines") - 1)
        return F.struct(h1.alias("h1"), h2.alias("h2"), F.length(F.translate(bare, " \t\n\x0b\x0c\r", "")).alias("n"), ends.alias("ends"))

    made = split.select("doc_id", "text_key", F.transform("lines", facts).alias("x"))
    at = F.sequence(F.lit(0), F.size("x") - width)

    def window(i: Column) -> Column:
        own = [F.get("x", i + k) for k in range(width)]
        letters = sum((o.n for o in own[1:]), own[0].n)
        whole = F.coalesce(F.get("x", i - 1).ends, F.lit(True))
        for o in own:
            whole = whole & o.ends
        counts = letters >= F.when(whole, 1).otherwise(LETTERS)
        return F.struct(i.alias("pos"), F.when(counts, F.xxhash64(*[o.h1 for o in own])).alias("h1"), F.xxhash64(F.lit(1), *[o.h2 for o in own]).alias("h2"))

    return made.select("doc_id", "text_key", F.inline(F.transform(at, window))).where("h1 is not null")


def repeated_lines(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, text_key, gone): the line numbers to remove, for documents that have any.

    Windows are computed once, into a table in the shared folder that goes at the end. A
    window that very many documents share is dealt over many tasks.
    """
    seen, place = C.stored(_windows(docs, width))
    key = ["h1", "h2"]
    often = C.cut(seen.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    again = C.cut(C.spread_join(seen, often, key, F.xxhash64("text_key", "pos"), hot := C.hot_keys(often, key, "n")))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key", "pos")
    first = C.cut(again.groupBy(*key).agg(F.min(order).alias("first")))
    later = C.spread_join(again, first, key, F.xxhash64("text_key", "pos"), hot).where(order > F.col("first"))
    places = later.groupBy("doc_id", "text_key").agg(F.collect_set("pos").alias("at"))
    covered = F.array_distinct(F.flatten(F.transform("at", lambda p: F.sequence(p, p + (width - 1)))))
    out = C.cut(places.select("doc_id", "text_key", covered.alias("gone")))
    C.removed(docs.sparkSession, place)
    del seen, often, again, first, later, places
    C.tidy(docs.sparkSession)
    return out


def _joined(flat: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """flat with __text (the text without its repeated lines) and __at, the lines removed."""
    found = repeated_lines(flat.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), width)
    found = found.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("gone").alias("__at"))
    keyed = flat.withColumn("__mine", C.text_key(F.col(text)))
    both = keyed.join(found, F.col(doc_id).eqNullSafe(F.col("__id")) & (F.col("__mine") == F.col("__key")), "left")
    split = both.withColumn("__split", F.when(F.col("__at").isNotNull(), lines_of(F.col(text))))
    left = F.array_except(F.sequence(F.lit(0), F.size("__split") - 1), F.col("__at"))
    cut = F.when(F.col("__at").isNull(), F.col(text)).otherwise(F.array_join(F.transform(left, lambda i: F.get("__split", i)), ""))
    return split.withColumn("__text", cut)


def line_report(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per document: doc_id, n_removed (lines), text (what is left)."""
    out = _joined(C.pick(docs, "doc_id", "text"), "doc_id", "text", width)
    gone = F.when(F.col("__at").isNull(), 0).otherwise(F.size("__at")).cast("bigint")
    return out.select("doc_id", gone.alias("n_removed"), F.col("__text").alias("text"))


def drop_lines(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """docs with the texts that are left; a column n_chars gets their length."""
    flat, names = C.positional(docs)
    doc_id, text = (f"__c{C.place(names, n)}" for n in ("doc_id", "text"))
    out = _joined(flat, doc_id, text, width)
    cols = [F.col("__text") if c == text else F.when(F.col("__at").isNull(), F.col(c)).otherwise(F.length("__text").cast("bigint")) if n == "n_chars" else F.col(c) for c, n in zip(flat.columns, names, strict=True)]
    return out.select(*[c.alias(f"__o{i}") for i, c in enumerate(cols)]).toDF(*names)


# --- queries --------------------------------------------------------------------------


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents without the later occurrences of repeated three-line windows."""
    return line_report(C.table(spark, sf_dir, "documents"))


QUERIES = {"op2_line_dedup": op2_line_dedup}

_LINES = "string_split(regexp_replace(replace(text, chr(10), chr(10) || chr(1)), '([.!?] )', '\\1' || chr(1), 'g'), chr(1))"

SQL = {
    "op2_line_dedup": f"""
        WITH d AS (SELECT DISTINCT doc_id, text, {_LINES} AS ls FROM documents WHERE text IS NOT NULL),
        l AS (SELECT doc_id, text, i, line, rtrim(line, chr(32) || chr(10)) AS bare, ends_with(line, chr(10)) OR i = n - 1 AS ends
              FROM (SELECT doc_id, text, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS i, len(ls) AS n FROM d)),
        w AS (SELECT doc_id, text, i, {{'a': bare, 'b': lead(bare) OVER o, 'c': lead(bare, 2) OVER o}} AS win, lead(bare, 2) OVER o IS NOT NULL AS entire,
                     coalesce(lag(ends) OVER o, true) AND ends AND lead(ends) OVER o AND lead(ends, 2) OVER o AS whole FROM l WINDOW o AS (PARTITION BY doc_id, text ORDER BY i)),
        c AS (SELECT *, length(regexp_replace(win.a || win.b || win.c, '[\\x20\\x09-\\x0D]', '', 'g')) AS letters FROM w WHERE entire),
        again AS (SELECT doc_id, text, i, dense_rank() OVER (PARTITION BY win ORDER BY doc_id NULLS LAST, text, i) AS nth FROM c WHERE letters >= CASE WHEN whole THEN 1 ELSE {LETTERS} END),
        gone AS (SELECT DISTINCT doc_id, text, i + k AS i FROM again, (SELECT unnest([0, 1, 2]) AS k) WHERE nth > 1),
        kept AS (SELECT doc_id, text, string_agg(line, '' ORDER BY i) AS left_text FROM l ANTI JOIN gone USING (doc_id, text, i) GROUP BY doc_id, text),
        cnt AS (SELECT doc_id, text, count(*) AS n FROM gone GROUP BY doc_id, text)
        SELECT d.doc_id, coalesce(c.n, 0) AS n_removed, CASE WHEN d.text IS NOT NULL THEN coalesce(k.left_text, '') END AS text
        FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id AND d.text = k.text LEFT JOIN cnt c ON d.doc_id = c.doc_id AND d.text = c.text
    """,
}
