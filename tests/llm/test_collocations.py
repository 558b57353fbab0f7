"""Operator 12 against brute force."""

from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import corpus
from torque.llm import collocations as co

SCHEMA = "doc_id bigint, text string, lang string, gram string, a int, mark int, k int"


def brute(rows, least, top, inside=100):
    counts: Counter = Counter()
    total: Counter = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(corpus.LOWER)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            total[lang] += len(w)
            for k in range(1, 6):
                counts.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    often = {g: a for g, a in counts.items() if len(g[1]) > 1 and a >= least}
    out = []
    for (lang, g), a in often.items():
        if any(x == lang and len(h) > len(g) and 100 * b >= inside * a
               and any(h[i:i + len(g)] == g for i in range(len(h) - len(g) + 1))
               for (x, h), b in often.items()):
            continue
        cuts = []
        for k in range(1, len(g)):
            left, right = counts[lang, g[:k]], counts[lang, g[k:]]
            cuts.append((1000 * a * total[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.append((lang, " ".join(g), a, left, right, total[lang], score))
    result = []
    for lang in {x[0] for x in out}:
        own = sorted((x for x in out if x[0] == lang),
                     key=lambda x: (-x[6], -x[2], x[1].encode()))[:top]
        result += [(lang, rank, *x[1:]) for rank, x in enumerate(own, 1)]
    return sorted(result)


def texts(n=150, seed=4):
    rnd = random.Random(seed)
    vocabulary = ["the", "of", "New", "York", "é", "漢字", "a\x1cb", "x" * 40, "in", "state"]
    marks = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\r\n", "!", "\x0b"]
    out = []
    for i in range(n):
        w = "".join(rnd.choice(vocabulary) + rnd.choice(marks) for _ in range(rnd.randint(0, 40)))
        out.append((rnd.choice(["en", "en", "de", None, "und"]), w + " state of the art " * (i % 3)))
    return out + [("en", None), ("en", ""), (None, " . "), ("en", "the the the the the the the"),
                  ("fr", "the of " * 400), ("en", "." * 50), ("en", "York"), ("", "of the " * 30)]


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, text, lang, "g", 1, 2, 3) for i, (lang, text) in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize("least,top,inside", [(5, 2000, 100), (20, 7, 100), (5, 2000, 60), (1, 50, 100)])
def test_equals_brute_force(spark, least, top, inside):
    rows = texts(150 if least > 1 else 30)
    got = co.collocations(frame(spark, rows), least=least, top=top, inside_percent=inside,
                          filter_bits=16, shard_entries=300)
    assert sorted(map(tuple, got.collect())) == brute(rows, least, top, inside)


def test_small_filters_bitmaps_and_tasks(spark, monkeypatch):
    """Saturated bitmaps, filters that are handed on at once, rows in many partitions."""
    monkeypatch.setattr(co, "HELD_ENTRIES", 50)
    monkeypatch.setattr(co, "WAITING", 10)
    rows = texts(60)
    docs = frame(spark, rows + rows[:20]).repartition(5)
    got = co.collocations(docs, least=4, filter_bits=15, shard_entries=50)
    assert sorted(map(tuple, got.collect())) == brute(rows + rows[:20], 4, 2000)


def test_odd_tables(spark):
    assert co.collocations(corpus.nothing(spark), least=1).count() == 0
    odd = corpus.odd_documents(spark).selectExpr("*", "'en' AS lang")
    want = brute([("en", r.text) for r in odd.select("text").collect()], 2, 2000)
    assert sorted(map(tuple, co.collocations(odd, least=2, filter_bits=15).collect())) == want


@pytest.mark.parametrize("words,size,slice_bytes", [
    (400_000, 32_000_000, 2_000_000), (30, 32_000_000, 64), (400_000, 500, 64)])
def test_words_are_counted_before_they_reach_spark(spark, monkeypatch, words, size, slice_bytes):
    """Tasks hand on counted words, within a bound, however the texts are sliced; no
    text is exploded into rows of words."""
    monkeypatch.setattr(co, "HELD_WORDS", words)
    monkeypatch.setattr(co, "HELD_BYTES", size)
    monkeypatch.setattr(co, "WORD_ROWS", 7)
    slices = co.text_slices
    monkeypatch.setattr(co, "text_slices", lambda column: slices(column, slice_bytes))
    rows = [(lang or "und", text or "") for lang, text in texts(80)] + [("É", "ÀB aB AB\u2028x Ab")]
    want = Counter((lang, w) for lang, text in rows
                   for w in re.split(r"[\x20\x09.,;:!?\x0A-\x0D]+", text.translate(corpus.LOWER)) if w)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = co.word_counts(docs)
    assert {(r.lang, r.word): r.a for r in got.collect()} == want
    assert "Generate" not in got._jdf.queryExecution().toString()
    assert co.word_counts(docs.limit(0)).count() == 0


def test_a_salt_that_mixes_words_up_is_left(spark, monkeypatch):
    """Codes that collide are found out on all words, and another salt is taken."""
    monkeypatch.setattr(co, "coded", collide(co.coded))
    rows = texts(40)
    got = co.collocations(frame(spark, rows), least=4, filter_bits=15)
    assert sorted(map(tuple, got.collect())) == brute(rows, 4, 2000)


def collide(real):
    def coded(words, salt):
        out = real(words, salt)
        return out.selectExpr("lang", "word", "a", "1L AS mark", "gram") if salt < 2 else out
    return coded


def test_permutation_is_inverted():
    rng = np.random.default_rng(1)
    for width in range(1, 6):
        rows = rng.integers(0, 1 << 63, (500, width)).astype(np.uint64)
        rows[:50] = rows[0]
        spread = co.permute(rows)
        assert np.array_equal(co.restore(spread), rows)
        assert len(np.unique(spread, axis=0)) == len(np.unique(rows, axis=0))


@pytest.mark.parametrize("quotient", [2, 4])
@pytest.mark.parametrize("width", [1, 2, 5])
def test_filters_count_pack_and_merge(width, quotient):
    rng = np.random.default_rng(width)
    rows = co.permute(rng.integers(0, 40, (3000, width)).astype(np.uint64))
    want = Counter(map(tuple, rows.tolist()))
    whole = co.CountingFilter(width)
    for part in np.array_split(rows, 7):
        own = co.CountingFilter(width)
        own.add(part)
        for shard, data in own.shards(quotient, 3):
            got, counts = co.unpack(data, width, quotient)
            assert set((got[:, 0] >> np.uint64(61)).tolist()) == {shard}
            whole.add(got, counts * 300)
    whole.merge()
    assert {tuple(r): c for r, c in zip(whole.rows.tolist(), whole.counts.tolist())} == {
        r: 300 * c for r, c in want.items()}
    # rows that share their first word only are told apart
    alike = np.array([[7] * width] * 3 + [[7] * (width - 1) + [8]] * 2, np.uint64)
    odd = co.CountingFilter(width)
    odd.add(alike)
    odd.add(alike[::-1].copy())
    odd.merge()
    assert sorted(odd.counts.tolist()) == ([4, 6] if width > 1 else [4, 6])


@pytest.mark.parametrize("quotient", [2, 4])
def test_pairs_travel_as_short_marks(spark, monkeypatch, quotient):
    """The first pass hands on a few bytes of a pair, not its words' codes."""
    spare = 8 - co.MARK_BYTES
    rng = np.random.default_rng(2)
    marks = rng.integers(0, 1 << 63, (70_000, 1)).astype(np.uint64)
    marks = np.unique(marks >> np.uint64(8 * spare) << np.uint64(8 * spare), axis=0)
    counts = rng.integers(1, 9, len(marks))
    data = co.pack(marks, counts, quotient, spare)
    got, n = co.unpack(data, 1, quotient, spare)
    assert np.array_equal(got, marks) and np.array_equal(n, counts)
    pairs = co.pack(np.hstack([marks, marks]), counts, quotient)
    assert len(pairs) - len(data) == (8 + spare) * len(marks)
    # marks that most pairs share let pairs through, but lose none
    monkeypatch.setattr(co, "MARK_BYTES", 2)
    rows = texts(60)
    got = co.collocations(frame(spark, rows), least=4, filter_bits=15, shard_entries=50)
    assert sorted(map(tuple, got.collect())) == brute(rows, 4, 2000)


def test_words_and_pieces_like_the_patterns():
    values = [t or "" for _, t in texts()]
    langs = ["en" if i % 2 else "de" for i in range(len(values))]
    split = co.Pieces(pa.array(values, pa.large_string()), langs, 3)
    want = [(lang, i, p, w) for i, (lang, t) in enumerate(zip(langs, values))
            for p, piece in enumerate(re.split(r"[.,;:!?\x0A-\x0D]", t.translate(corpus.LOWER)))
            for w in re.split(r"[\x20\x09]+", piece) if w]
    assert len(split.code) == len(want)
    by_code: dict = {}
    for code, (lang, _, _, w) in zip(split.code.tolist(), want):
        assert by_code.setdefault(code, (lang, w)) == (lang, w)
    assert len(by_code) == len({(x[0], x[3]) for x in want})
    pieces = [x[1:3] for x in want]
    same = [a == b for a, b in zip(pieces, pieces[1:])]
    assert same == (split.piece[1:] == split.piece[:-1]).tolist()


def test_only_what_is_frequent_is_stored_and_in_few_files(spark, monkeypatch):
    """No file per task, no rare words, and nothing is left cached."""
    written = []
    monkeypatch.setattr(co, "FILES", 3)
    monkeypatch.setattr(co, "stored", lambda df, real=co.stored: written.append(real(df)) or written[-1])
    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    rows = texts(60) + [("en", f"rare{i} words{i}") for i in range(200)]
    docs = frame(spark, rows).repartition(7)
    got = co.collocations(docs, least=4, filter_bits=15, shard_entries=50)
    assert all(df.filter("a < 4").isEmpty() for df in written)
    assert len(written) == 2 and all(len(df.inputFiles()) <= 3 for df in written)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= cached
    assert sorted(map(tuple, got.collect())) == brute(rows, 4, 2000)
    assert co.frequent_words(docs.selectExpr("'x' AS lang", "coalesce(text, '') AS text"), 0, 4).filter(
        "kind = 'size'").count() == 1


def test_a_merge_holds_no_spare_copies():
    """Sorting a filter's entries takes a bounded multiple of their own size."""
    rng = np.random.default_rng(3)
    tracemalloc.start()
    try:
        own = co.CountingFilter(5)
        for _ in range(2):
            own.add(rng.integers(0, 1 << 63, (250_000, 5)).astype(np.uint64))
            tracemalloc.reset_peak()
            own.merge()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(own) == 500_000
    assert peak < 2.5 * 500_000 * 6 * 8
