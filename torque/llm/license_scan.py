"""Operator 2: license scans by canonical digest lookup.

A text is brought to a canonical form (case, punctuation, copyright lines and
equivalent spellings), and its SHA-256 digest is hash-joined with the digests
of known licence texts. The known table is fixed and small, so it is broadcast
and the documents are never shuffled. Each line is looked up the same way,
for one-line licence notices inside longer texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from torque.llm.columns import let
from torque.llm.known_licenses import notices, whole_texts

# ---- fixed values: known licences and notices ---------------------------------
_NO_WARRANTY = """
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_START = """Redistribution and use in source and binary forms, with or without modification,
are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with
the distribution."""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to
endorse or promote products derived from this software without specific prior written permission."""
_BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER
IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
KNOWN = [
    ("MIT", """MIT License
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute,
sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.""" + _NO_WARRANTY),
    ("ISC", """ISC License
Permission to use, copy, modify, and/or distribute this software for any purpose with or without
fee is hereby granted, provided that the above copyright notice and this permission notice appear
in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE
OF THIS SOFTWARE."""),
    ("BSD-2-Clause", "BSD 2-Clause License\n" + _BSD_START + _BSD_END),
    ("BSD-3-Clause", "BSD 3-Clause License\n" + _BSD_START + _BSD_THIRD + _BSD_END),
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
]
KNOWN = list(dict.fromkeys(
    KNOWN + whole_texts([x for x in KNOWN if "\n" in x[1]]) + notices()))
# Patterns that Spark's and DuckDB's regular expressions read alike.
COPYRIGHT_LINE = (r"(?m)^[ \t*#/;-]*(copyright[ \t]*(\(c\)|©|:|[0-9<\[{])|\(c\)[ \t]|©"
                  r"|all rights reserved)[^\n]*$")
MARKUP = r"[^\p{L}\p{N}\n]+"
SPELLINGS = [
    ("licence", "license"), ("sublicence", "sublicense"), ("favour", "favor"),
    ("organisation", "organization"), ("judgement", "judgment"), ("whilst", "while"),
    ("acknowledgement", "acknowledgment"), ("fulfil", "fulfill"), ("wilful", "willful"),
    ("non commercial", "noncommercial"), ("sub license", "sublicense"),
    ("copyright owner", "copyright holder"), ("https", "http"),
]
START_CHARS = 8
# -------------------------------------------------------------------------------


def canonical(text: Column) -> Column:
    """Canonical form with one line per kept line; blanks collapsed."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    out = F.regexp_replace(out, MARKUP, " ")
    for seen, meant in SPELLINGS:
        out = F.regexp_replace(out, rf"\b{seen}\b", meant)
    return out


def _one_line(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[ \n]+", " "))


def digest(text: Column) -> Column:
    return F.sha2(F.encode(_one_line(text), "UTF-8"), 256)


def known_digests(spark, known=None) -> DataFrame:
    """(digest, license_id, length, start) of known texts; one row per digest, with the
    length and the first characters of its canonical form."""
    rows = spark.createDataFrame(list(known or KNOWN), "license_id string, text string")
    form = _one_line(F.col("form"))
    return (rows.select(canonical(F.col("text")).alias("form"), "license_id")
            .select(digest(F.col("form")).alias("digest"), "license_id",
                    F.char_length(form).alias("length"),
                    F.substring(form, 1, START_CHARS).alias("start"))
            .groupBy("digest").agg(*[F.min(c).alias(c) for c in ("license_id", "length", "start")]))


def license_scan(docs: DataFrame, known=None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Look whole texts and single lines up among known licences.

    Returns doc_id, ``text_digest`` (of the whole canonical text),
    ``license_id`` (the licence that the whole text is, or null),
    ``line_licenses`` (sorted distinct licences whose notice is a line of the
    text) and ``n_license_lines``. ``known`` is a list of (licence, text); it
    is broadcast, so it must stay a small curated list. The canonical form drops
    every mark, so an id with a plus sign (GPL-2.0+) reads as the plain one, and
    compound SPDX expressions are found only if they are entered.

    Null texts count as empty; an empty or punctuation-only text matches
    nothing. Null and repeated ids pass through row by row. An empty table
    gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    found = known_digests(spark, known).filter("length > 0").collect()
    table = [(r["digest"], r["license_id"]) for r in found]
    # Licences as bytes: their names (Python-2.0) then do not read like nodes of the plan.
    lookup_line = F.create_map(*[F.lit(x) for d, name in table for x in (d, name.encode())])
    # Only lines of a known length that begin like a known text can be one; within a line
    # the canonical form has single blanks already.
    lengths, starts = ({r[c] for r in found} for c in ("length", "start"))
    lines = F.filter(F.transform(F.split("form", "\n"), lambda x: F.trim(x)), lambda x: (
        F.char_length(x).isin(lengths) & F.substring(x, 1, START_CHARS).isin(starts)))
    hits = F.filter(F.transform(lines, lambda x: F.element_at(lookup_line, digest(x)).cast("string")),
                    lambda x: x.isNotNull())
    forms = (docs.select(F.col(id_col).alias("doc_id"),
                         canonical(F.coalesce(F.col(text_col), F.lit(""))).alias("form"))
             .select("doc_id", digest(F.col("form")).alias("text_digest"),
                     let(hits, lambda h: F.struct(
                         F.array_sort(F.array_distinct(h)).alias("ids"),
                         F.size(h).cast("long").alias("n"))).alias("lines")))
    lookup = F.broadcast(spark.createDataFrame(table, "text_digest string, license_id string"))
    return forms.join(lookup, "text_digest", "left").select(
        "doc_id", "text_digest", "license_id", F.col("lines.ids").alias("line_licenses"),
        F.col("lines.n").alias("n_license_lines"))


def oracle() -> str:
    """DuckDB SQL for ``license_scan`` over ``documents``."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"

    def form(x: str) -> str:
        out = f"regexp_replace(lower({x}), {quote(COPYRIGHT_LINE)}, '', 'g')"
        out = f"regexp_replace({out}, {quote(MARKUP)}, ' ', 'g')"
        for seen, meant in SPELLINGS:
            out = f"regexp_replace({out}, {quote(rf'\b{seen}\b')}, {quote(meant)}, 'g')"
        return out

    one = lambda x: rf"sha256(trim(regexp_replace({x}, '[ \n]+', ' ', 'g')))"
    rows = ", ".join(f"({quote(i)}, {quote(t)})" for i, t in KNOWN)
    return f"""
WITH raw(license_id, t) AS (VALUES {rows}),
known AS (SELECT {one(form('t'))} AS digest, min(license_id) AS license_id FROM raw GROUP BY 1),
f AS (SELECT doc_id, {form("coalesce(text, '')")} AS form FROM documents),
l AS (SELECT doc_id, unnest(string_split(form, chr(10))) AS line FROM f),
h AS (SELECT doc_id, list_sort(list(DISTINCT license_id)) AS ids, count(*) AS n
      FROM l JOIN known ON {one('line')} = digest GROUP BY doc_id)
SELECT f.doc_id, {one('form')} AS text_digest, known.license_id,
       coalesce(h.ids, []::VARCHAR[]) AS line_licenses,
       coalesce(h.n, 0)::BIGINT AS n_license_lines
FROM f LEFT JOIN known ON {one('form')} = digest LEFT JOIN h USING (doc_id)
"""
