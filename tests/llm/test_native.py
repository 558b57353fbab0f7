"""Operators 2, 6 and 10: SQL functions only, checked by brute force."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from tests.llm import corpus
from torque.llm import fingerprints as fp
from torque.llm import known_licenses
from torque.llm import license_scan as lic
from torque.llm import quality_ledger as ql


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_on_the_main_path(spark):
    docs = corpus.documents(spark)
    for df in (lic.license_scan(docs), fp.document_fingerprints(docs), ql.quality_ledger(docs)):
        assert not any(x in plan(df) for x in ("Python", "Pandas", "Arrow"))


# ---- licences ------------------------------------------------------------------
def test_license_variants_match(spark):
    mit = next(t for i, t in lic.KNOWN if i == "MIT")
    texts = ["Copyright (c) 2020 Somebody\n\n" + mit, mit.upper().replace(",", " ;"),
             mit.replace("sublicense", "sub-licence"), "* " + mit.replace("\n", "\n * "),
             mit + " Really.", "words\nreleased under the  MIT licence\nmore",
             "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in lic.license_scan(df).collect()}
    assert [got[i].license_id for i in range(5)] == ["MIT"] * 4 + [None]
    assert got[5].license_id is None and got[5].line_licenses == ["MIT"]
    assert got[6].line_licenses == ["CC-BY-NC-4.0", "MIT"] and got[6].n_license_lines == 3


def test_license_common_texts_and_notices(spark):
    filed = {p.stem: p.read_text() for p in known_licenses.FOLDER.glob("*.txt")}
    mit = next(t for i, t in lic.KNOWN if i == "MIT").split("\n", 1)[1]
    gpl2 = filed["GPL-2"].replace("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA",
                                  "59 Temple Place, Suite 330, Boston, MA  02111-1307  USA")
    whole = [("Apache-2.0", filed["Apache-2.0"]),
             ("Apache-2.0", filed["Apache-2.0"].split("APPENDIX")[0].replace("http:", "https:")),
             ("GPL-2.0", gpl2), ("GPL-2.0", filed["GPL-2"][filed["GPL-2"].index("Preamble"):]),
             ("GPL-3.0", filed["GPL-3"]), ("LGPL-2.1", filed["LGPL-2.1"]),
             ("LGPL-3.0", filed["LGPL-3"].upper()), ("MPL-2.0", filed["MPL-2.0"]),
             ("MPL-2.0", filed["MPL-2.0"][filed["MPL-2.0"].index("1. Definitions"):]),
             ("CC0-1.0", filed["CC0-1.0"]), ("Unlicense", filed["Unlicense"]),
             ("MIT", "Copyright (c) 2020 Somebody\n\n" + mit),
             ("MIT", "The MIT License (MIT)\n\nCopyright (c) 2020 Somebody\n\n" + mit),
             ("BSD-3-Clause", filed["BSD"]), (None, filed["GPL-3"].replace("freedom", "feedom"))]
    lines = [("GPL-2.0", "# SPDX-License-Identifier: GPL-2.0"),
             ("GPL-3.0-or-later", "SPDX-License-Identifier: GPL-3.0-or-later"),
             ("LGPL-2.1", "Released under the GNU Lesser General Public License, version 2.1."),
             ("MPL-2.0", "// SPDX-License-Identifier: MPL-2.0"),
             ("CC-BY-4.0", "This work is licensed under CC BY 4.0"),
             ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
             ("CC-BY-SA-4.0", "This work is licensed under a thing\nLicense: CC BY-SA 4.0")]
    texts = [t for _, t in whole] + [f"some words\n{t}\nmore words" for _, t in lines]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = [r for r in lic.license_scan(df).orderBy("doc_id").collect()]
    assert [r.license_id for r in got[:len(whole)]] == [i for i, _ in whole]
    assert [r.line_licenses for r in got[len(whole):]] == [[i] for i, _ in lines]


def test_license_notices_without_the_word(spark):
    known = [("PD", "This work is in the public domain"), ("CC0-1.0", "All code is CC0 1.0"),
             ("BLANK", " -- ")]
    df = spark.createDataFrame([(1, "a\n * This work is in the PUBLIC domain.\nAll code is CC0"),
                                (2, "x\n\n--\nall code is CC0-1.0"), (3, "All code is CC0 1.1")],
                               "doc_id bigint, text string")
    got = {r.doc_id: r.line_licenses for r in lic.license_scan(df, known).collect()}
    assert got == {1: ["PD"], 2: ["CC0-1.0"], 3: []}


def test_license_odd_rows(spark):
    assert lic.license_scan(corpus.nothing(spark)).count() == 0
    rows = lic.license_scan(corpus.odd_documents(spark)).collect()
    assert len(rows) == 8
    assert all(r.license_id is None and r.line_licenses == [] and r.n_license_lines == 0
               for r in rows)


# ---- fingerprints ----------------------------------------------------------------
def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_against_exact_sets(spark):
    docs = corpus.documents(spark)
    got = {r.doc_id: r for r in fp.document_fingerprints(docs).collect()}
    texts = {i: t or "" for i, t, *_ in corpus.rows(corpus.texts())}
    ids = sorted(texts, reverse=True)
    by_text: dict[str, set] = {}
    for k, i in enumerate(ids):
        text, nxt = texts[i], texts[ids[(k + 1) % len(ids)]]
        third = len(text) // 3
        edited = text[:len(text) - third] + nxt[:third]
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own, other, after = (corpus.shingles(t, 5) for t in (text, edited, nxt))
        exact = len(own | other) <= fp.SKETCH_SIZE
        assert got[i].near_edited == pytest.approx(jaccard(own, other), abs=1e-9 if exact else 0.2)
        assert got[i].near_next == pytest.approx(jaccard(own, after), abs=0.2)
        by_text.setdefault(text, set()).add(got[i].fingerprint)
        assert len(got[i].fingerprint) == 16 * min(len(own), fp.SKETCH_SIZE)
    assert all(len(v) == 1 for v in by_text.values())


def test_sketches_merge_and_estimate(spark):
    # 600 and 400 distinct one-word changes: three thirds with known overlaps
    a, b = set(range(0, 3000)), set(range(1000, 5000))
    df = spark.createDataFrame([(sorted(a), sorted(b), sorted(a | b))],
                               "a array<int>, b array<int>, u array<int>")
    hashed = df.select(*[fp.bottom_k(F.transform(c, lambda v: F.xxhash64(v)), 256).alias(c)
                         for c in ("a", "b", "u")])
    ca, cb = F.col("a"), F.col("b")
    r = hashed.select(
        (fp.merge(ca, cb, 256) == F.col("u")).alias("same"),
        (fp.merge(ca, cb, 256) == fp.merge(cb, ca, 256)).alias("either"),
        fp.resemblance(ca, cb, 256).alias("r"), fp.containment(ca, cb, 256).alias("c"),
        fp.distinct_shingles(ca, 256).alias("n")).first()
    assert r.same and r.either
    assert r.r == pytest.approx(2000 / 5000, abs=0.1)
    assert r.c == pytest.approx(2000 / 3000, abs=0.15)
    assert r.n == pytest.approx(3000, rel=0.2)


def test_fingerprints_odd_rows(spark):
    assert fp.document_fingerprints(corpus.nothing(spark)).count() == 0
    rows = fp.document_fingerprints(corpus.odd_documents(spark)).collect()
    assert len(rows) == 8
    assert all(r.near_next is None for r in rows if r.doc_id is None)
    one = spark.createDataFrame([(5, "a b c")], "doc_id bigint, text string")
    row = fp.document_fingerprints(one).first()
    assert row.edited_sha256 == hashlib.sha256(b"a b a").hexdigest() and row.near_next == 1.0


def test_next_id_across_ranges(spark):
    ids = [3, 4, 10, 11, 12, 50, 51, -4, 7, 7]
    got = dict(fp.following(spark.createDataFrame([(i,) for i in ids], "doc_id bigint")).collect())
    order = sorted(set(ids), reverse=True)
    assert got == {d: order[(k + 1) % len(order)] for k, d in enumerate(order)}


# ---- quality rules ------------------------------------------------------------------
def measured(text: str | None) -> dict:
    w, t = corpus.words(text), text or ""
    count: dict = {}
    for i in range(len(w) - 2):
        count[tuple(w[i:i + 3])] = count.get(tuple(w[i:i + 3]), 0) + 1
    covered = {i + k for i in range(len(w) - 2) if count[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if corpus.words(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)),
            "n_symbols": sum(c in "#*$%&|<>" for c in t),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}


def test_ledger_measurements(spark):
    values = corpus.texts() + ["a b c " * 40, "x | y | " * 60, "For For For For " * 30,
                               "aa\naa\nbb\n aa\n\n\naa", "# $ % " * 30]
    got = {r.doc_id: r for r in ql.quality_ledger(corpus.documents(spark, values)).collect()}
    for i, text, *_ in corpus.rows(values):
        m = measured(text)
        assert {k: got[i][k] for k in m} == m
        failed = m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"]
        assert got[i].base_failed == failed
        assert not (failed and got[i].kept)
        assert got[i].kept == (got[i].failed_mask == 0)


def test_long_texts_take_the_paired_sort(spark, monkeypatch):
    values = corpus.texts()
    usual = ql.quality_ledger(corpus.documents(spark, values)).orderBy("doc_id").collect()
    monkeypatch.setattr(ql, "POSITION_BITS", 4)     # every text above 14 windows is "long"
    assert ql.quality_ledger(corpus.documents(spark, values)).orderBy("doc_id").collect() == usual


def test_windows_with_equal_upper_bits(spark):
    a, b = 5 << 40, (5 << 40) + 1                   # differ only where the position rides
    df = spark.createDataFrame([([a, b, a],), ([b, 7, a, 9, b, a],), ([a, b],), ([7, 7, 8],), ([],)],
                               "h array<bigint>")
    got = [r.at for r in df.select(ql._repeated_positions(F.col("h")).alias("at")).collect()]
    assert got == [[0, 2], [0, 2, 4, 5], [], [0, 1], []]


def test_policies_and_ablations(spark):
    values = corpus.texts() + ["## " * 60 + "many words " * 40] * 3
    docs = corpus.documents(spark, values)
    first, last = ql.quality_ledger(docs, 1), ql.quality_ledger(docs, 3)
    assert first.filter("kept").count() >= last.filter("kept").count()
    assert first.filter("kept <> (NOT base_failed)").count() == 0
    rows = last.select("failed_mask").collect()
    table = {r.rule: r for r in ql.ablations(last, 3).collect()}
    for rule in ql.RULES:
        bit = ql.BIT[rule.name]
        masks = [r.failed_mask for r in rows]
        assert table[rule.name].n_failed == sum(m & bit != 0 for m in masks)
        assert table[rule.name].n_only == sum(m == bit for m in masks)
        assert table[rule.name].n_kept_without == sum(m & ~bit == 0 for m in masks)


def test_ledger_odd_rows(spark):
    assert ql.quality_ledger(corpus.nothing(spark)).count() == 0
    assert ql.ablations(ql.quality_ledger(corpus.nothing(spark))).filter("n_failed > 0").count() == 0
    rows = ql.quality_ledger(corpus.odd_documents(spark)).collect()
    assert len(rows) == 8 and all(r.base_failed and not r.kept for r in rows)
