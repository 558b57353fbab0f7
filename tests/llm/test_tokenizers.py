"""Operators 1 and 9 against the tokenizer libraries."""

from __future__ import annotations

import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import corpus
from torque.llm.sentencepiece_codec import (BLOCK, MARK, PAIR_BYTES, Codec,
                                            sentencepiece_round_trip)
from torque.llm.token_counts import FRESH, MOVE, STATES, Counter, compose_scan, token_counts
from torque.llm.worker_memory import Memo

COUNTS, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ALPHABET = st.sampled_from(list(" \n\t\r 　'''strevmldaBéß1²½٣#!😀漢字xyz▁<|>\0")
                           + ["<|endoftext|>", "'s", "'ll", "  ", "the", " ing"])


@pytest.fixture(scope="module")
def counter():
    return Counter(open(COUNTS, "rb").read())


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(COUNTS)


@pytest.fixture(scope="module")
def codec():
    return Codec(open(PIECES, "rb").read())


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_prefix_scan_equals_one_by_one():
    rng = np.random.default_rng(1)
    maps = rng.integers(0, len(STATES), (37, len(STATES))).astype(np.int8)
    state, scanned = FRESH, compose_scan(maps)
    for i, m in enumerate(maps):
        state = m[state]
        assert scanned[i, FRESH] == state


def test_cutter_is_total():
    assert MOVE.min() >= 0 and MOVE.max() < len(STATES)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=40).map("".join), min_size=1, max_size=5))
def test_counts_equal_the_library(counter, tokenizer, values):
    expected = [len(e.ids) for e in tokenizer.encode_batch(values, add_special_tokens=False)]
    assert counter.count_texts(values).tolist() == expected


def test_counts_across_chunk_borders(counter, tokenizer):
    values = ["x" * 255 + " 's " + "y" * 700, " " * 1000, "ab " * 400 + "\n\n", "é" * 513]
    expected = [len(e.ids) for e in tokenizer.encode_batch(values, add_special_tokens=False)]
    assert counter.count_texts(values).tolist() == expected


def test_counter_survives_a_restart(counter, tokenizer, monkeypatch):
    monkeypatch.setattr(Counter, "MAX_STATES", 50)
    values = [t or "" for t in corpus.texts()]
    expected = [len(e.ids) for e in tokenizer.encode_batch(values, add_special_tokens=False)]
    assert counter.count_texts(values).tolist() == expected


def test_token_count_rows(spark, tokenizer):
    docs = corpus.documents(spark)
    got = {r.doc_id: r for r in token_counts(docs, COUNTS, limit=100).collect()}
    for i, text, *_ in corpus.rows(corpus.texts()):
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].over_limit) == (n, n > 100)
        assert got[i].n_bytes == len((text or "").encode())
    assert len(got) == docs.count()
    assert token_counts(corpus.odd_documents(spark), COUNTS).count() == 8
    assert token_counts(corpus.nothing(spark), COUNTS).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=40).map("".join), min_size=1, max_size=5))
def test_ids_equal_the_library(codec, library, values):
    ids, bounds = codec.encode(values)
    expected = library.encode(values)
    for i, want in enumerate(expected):
        got = ids[bounds[i]:bounds[i + 1]]
        assert got.tolist() == want
        assert codec.decode(got) == library.decode(want)


def test_invalid_bytes_decode_like_the_library(codec, library):
    byte = codec.byte_ids
    for raw in (b"\xff", b"\xc3", b"\xe2\x82", b"a\x80b", b"\xf0\x9f\x98\x80"):
        ids = [byte[b] for b in raw]
        assert codec.decode(np.array(ids)) == library.decode(ids)


def test_stream_commits_before_the_end(codec, library):
    """Ids come out block by block, whatever paths are still open."""
    for unit in ("thethe", "a", "xyzzy漢", "\x01é"):
        text = unit * (5 * BLOCK // len(unit))
        parts = list(codec.stream(MARK + text))
        assert len(parts) >= 5
        assert [i for p in parts for i in p] == library.encode(text)


def test_long_blank_free_text_needs_a_small_window(codec):
    draw = random.Random(5)
    text = "".join(draw.choice("etaoinshrdlu") for _ in range(300_000))
    tracemalloc.start()
    n = sum(len(ids) for ids in codec.stream(text))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 100_000 and peak < PAIR_BYTES * 1.3


def test_memo_is_bounded_and_keeps_what_is_used():
    made = []
    memo = Memo(lambda key: made.append(key) or key * 2, 1000, lambda key, value: 10)
    for i in range(1, 2000):
        assert memo[i] == 2 * i
        assert memo[-1] == -2
    assert made.count(-1) == 1
    assert len(memo) + len(memo.old) <= 100


def test_round_trip_rows(spark, library):
    docs = corpus.documents(spark)
    got = {r.doc_id: r for r in sentencepiece_round_trip(docs, PIECES).collect()}
    for i, text, *_ in corpus.rows(corpus.texts()):
        assert got[i].ids == library.encode(text or "")
        assert got[i].round_trip and got[i].n_ids == len(got[i].ids)
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert sentencepiece_round_trip(corpus.odd_documents(spark), PIECES).count() == 8
    assert sentencepiece_round_trip(corpus.nothing(spark), PIECES).count() == 0
