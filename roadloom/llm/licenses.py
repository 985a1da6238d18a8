"""License scans by canonical digests.

A text is brought to a canonical form: ASCII letters lower-cased; copyright lines dropped;
spellings that license texts use side by side made one; punctuation and white space squeezed
to single blanks. The MD5 of the whole canonical text, and of each of its canonical lines, is
looked up by a hash join among the digests of known license texts and notices, which went
through the same function. A whole text that is a known license is reported as such; lines
that are known notices are reported as notices of the document.

The known texts are a parameter, a table (license_id, text). It is broadcast when it has at
most BROADCAST_ROWS rows, else it is joined by a shuffle on the digest.

Defined results: a null text counts as empty; the empty canonical text is never a license.
If a digest has several ids, the least one is reported. Rows that repeat with the same
doc_id and text get the same result. Extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

BROADCAST_ROWS = 10_000

#: Spellings that are treated as equal when licenses are compared.
SPELLINGS = [
    ("licence", "license"), ("acknowledgement", "acknowledgment"), ("sub-license", "sublicense"), ("sub license", "sublicense"), ("non-commercial", "noncommercial"),
    ("per cent", "percent"), ("copyright holder", "copyright owner"), ("https", "http"), ("whilst", "while"), ("fulfilment", "fulfillment"), ("merchantibility", "merchantability"), ("&", "and"),
]

#: Short notices by license.
NOTICES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0", "SPDX-License-Identifier: Apache-2.0"],
    "MIT": ["Released under the MIT License", "Licensed under the MIT License", "SPDX-License-Identifier: MIT"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3", "SPDX-License-Identifier: GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "SPDX-License-Identifier: CC-BY-4.0"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License", "SPDX-License-Identifier: BSD-3-Clause"],
}

#: Whole license texts.
TEXTS = {
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
}

#: Title lines that stand before a text in license files.
TITLES = {
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "ISC License (ISCL)"],
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "Expat License", "MIT"],
    "Zlib": ["zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License", "zlib License (Zlib)"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The 2-Clause BSD License", "The BSD 2-Clause License", "Simplified BSD License", 'BSD 2-Clause "Simplified" License', "BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The 3-Clause BSD License", "The BSD 3-Clause License", "New BSD License", 'BSD 3-Clause "New" or "Revised" License', "BSD License"],
}

_BSD = [
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
]


def full_texts() -> list[tuple[str, str]]:
    """(license_id, text): the whole texts in license_texts and above, with and without the
    lines that license files put before or after them, and clauses with numbers or marks."""
    out = [(p.stem, p.read_text()) for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))]
    for name, text in list(out):
        at = text.find("APPENDIX: How to apply")
        at = at if at > 0 else text.find("How to Apply These Terms to Your New")
        if at > 0:
            out.append((name, text[:at]))
    for name, clauses in (("BSD-2-Clause", _BSD[1:3]), ("BSD-3-Clause", _BSD[1:4])):
        for mark in ("{}. ", "* "):
            out.append((name, "\n\n".join([_BSD[0], *[mark.format(i) + c for i, c in enumerate(clauses, 1)], _BSD[4]])))
    out += TEXTS.items()
    return out + [(name, f"{title}\n\n{text}") for name, text in out for title in TITLES.get(name, [])]


_A, _Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_COPYRIGHT = "(^|\\n)[\\x20\\t/*#;-]*(copyright|\\(c\\)|all rights reserved)[^\\n]*"
_PUNCTUATION = "[\\x00-\\x09\\x0B-\\x2F\\x3A-\\x60\\x7B-\\x7F\\x{A0}\\x{A9}\\x{AE}\\x{2010}-\\x{2027}]+"


def canonical_lines(text: Column) -> Column:
    """The canonical lines of a text that have anything left."""
    out = F.translate(F.coalesce(text, F.lit("")), _A, _Z)
    out = F.regexp_replace(out, _COPYRIGHT, "$1")
    for one, other in SPELLINGS:
        out = F.replace(out, F.lit(one), F.lit(other))
    out = F.regexp_replace(out, _PUNCTUATION, " ")
    return F.filter(F.transform(F.split(out, "\n", -1), lambda x: F.trim(x)), lambda x: x != "")


def known_digests(spark, texts: DataFrame | None = None) -> DataFrame:
    """(digest, license_id) of the known texts, by default those listed here."""
    if texts is None:
        rows = [(k, t) for k, v in NOTICES.items() for t in v] + full_texts()
        texts = spark.createDataFrame(rows, "license_id string, text string")
    whole = C.pick(texts, "license_id", "text").select("license_id", F.array_join(canonical_lines(F.col("text")), " ").alias("canon"))
    out = whole.where("canon <> ''").groupBy(F.md5("canon").alias("digest")).agg(F.min("license_id").alias("license_id"))
    return F.broadcast(out) if texts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else out


def license_scan(docs: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, text_digest (of the whole canonical text), license_id
    (null if it is none), n_notices (canonical lines that are notices), notices (their ids)."""
    known = known_digests(docs.sparkSession, texts)
    slim = C.pick(docs, "doc_id", "text")
    k1, k2 = C.hash2("doc_id", "text")
    lined = slim.select("doc_id", k1.alias("k1"), k2.alias("k2"), canonical_lines(F.col("text")).alias("lines"))
    digests = lined.select("doc_id", "k1", "k2", F.md5(F.array_join("lines", " ")).alias("text_digest"))
    lines = lined.select("k1", "k2", F.posexplode(F.transform("lines", lambda x: F.md5(x))).alias("pos", "digest"))
    hits = lines.join(known, "digest").groupBy("k1", "k2").agg(F.collect_set("pos").alias("at"), F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("notices"))
    hits = hits.select("k1", "k2", F.size("at").cast("bigint").alias("n_notices"), "notices")
    out = digests.join(known.withColumnRenamed("digest", "text_digest"), "text_digest", "left").join(hits, ["k1", "k2"], "left")
    return out.select("doc_id", "text_digest", "license_id", F.coalesce("n_notices", F.lit(0)).cast("bigint").alias("n_notices"), F.coalesce("notices", F.lit("")).alias("notices"))


# --- queries --------------------------------------------------------------------------


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    """All documents against the known texts and notices."""
    return license_scan(C.table(spark, sf_dir, "documents"))


QUERIES = {"op1_license_scan": op1_license_scan}


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _lines_sql(text: str) -> str:
    out = f"regexp_replace(translate(coalesce({text}, ''), '{_A}', '{_Z}'), {_quoted(_COPYRIGHT)}, '\\1', 'g')"
    for one, other in SPELLINGS:
        out = f"replace({out}, {_quoted(one)}, {_quoted(other)})"
    return f"list_filter(list_transform(string_split(regexp_replace({out}, {_quoted(_PUNCTUATION)}, ' ', 'g'), chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '')"


SQL = {
    "op1_license_scan": f"""
        WITH known AS (SELECT md5(array_to_string(l, ' ')) AS digest, min(id) AS license_id FROM (
                SELECT id, {_lines_sql("t")} AS l FROM (VALUES {", ".join(f"({_quoted(k)}, {_quoted(t)})" for k, v in [*NOTICES.items(), *((a, [b]) for a, b in TEXTS.items())] for t in v)}) v(id, t))
            GROUP BY 1),
        d AS (SELECT doc_id, text, {_lines_sql("text")} AS l FROM documents),
        hit AS (SELECT doc_id, text, count(DISTINCT i) AS n, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS ids
            FROM (SELECT doc_id, text, md5(unnest(l)) AS digest, generate_subscripts(l, 1) AS i FROM d) JOIN known USING (digest) GROUP BY doc_id, text)
        SELECT d.doc_id, md5(array_to_string(d.l, ' ')) AS text_digest, k.license_id, coalesce(h.n, 0) AS n_notices, coalesce(h.ids, '') AS notices
        FROM d LEFT JOIN known k ON k.digest = md5(array_to_string(d.l, ' '))
        LEFT JOIN hit h ON h.doc_id IS NOT DISTINCT FROM d.doc_id AND h.text IS NOT DISTINCT FROM d.text
    """,
}
