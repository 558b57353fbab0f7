"""Operators 7 and 8 against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tests.llm import corpus
from torque.llm import ngram_join as nj
from torque.llm.components import components
from torque.llm.ngram_join import Bitmaps, linked_roots, ngram_jaccard_join, part_hashes, size_bands
from torque.llm.substring_dedup import substring_dedup
from torque.llm.wordhash import Words

import pyarrow as pa


# ---- components ------------------------------------------------------------------
def test_components_of_paths_stars_and_rings(spark):
    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    edges += [(200 + i, 200 + (i + 1) % 7) for i in range(7)] + [(300, 300)]
    edges = [(a, b) if rnd.random() < 0.5 else (b, a) for a, b in edges]
    rnd.shuffle(edges)
    got = dict(components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert got == ({i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
                   | {200 + i: 200 for i in range(7)})
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# ---- word hashes -------------------------------------------------------------------
def test_words_like_the_pattern():
    values = [t or "" for t in corpus.texts()]
    split = Words(pa.array(values, pa.large_string()))
    hashes = split.hashes()
    by_hash: dict[int, str] = {}
    for i, text in enumerate(values):
        own = corpus.words(text)
        assert split.bounds[i + 1] - split.bounds[i] == len(own)
        for h, w in zip(hashes[split.bounds[i]:split.bounds[i + 1]].tolist(), own):
            assert by_hash.setdefault(h, w) == w
    assert len(by_hash) == len({w for t in values for w in corpus.words(t)})


# ---- n-gram join ---------------------------------------------------------------------
def brute_components(values: list[tuple], size: int, percent: int) -> dict:
    sets = {i: corpus.shingles(t, size) for i, t, *_ in values}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80), (2, 60)])
def test_join_equals_brute_force(spark, size, percent):
    got = {r.doc_id: r for r in ngram_jaccard_join(corpus.documents(spark), percent, size).collect()}
    values = corpus.rows(corpus.texts())
    want = brute_components(values, size, percent)
    assert {i: r.component_id for i, r in got.items()} == want
    assert len(set(want.values())) < len(want)
    assert all(got[i].n_shingles == len(corpus.shingles(t, size)) for i, t, *_ in values)


def near_copies(n: int, words: int, seed: int) -> list[str]:
    """A drifting chain of near copies: neighbours are alike, ends are not."""
    rnd = random.Random(seed)
    w = [f"w{rnd.randrange(10 ** 6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = w[:]
        w[rnd.randrange(words)] = f"n{rnd.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def test_join_of_chains_over_many_bands(spark, monkeypatch):
    """Tiny bands: a group of near copies is cut into many tiles."""
    monkeypatch.setattr(nj, "BAND_SHINGLES", 300)
    values = near_copies(40, 90, 1) + near_copies(25, 30, 2) + corpus.texts(n=20)
    want = brute_components(corpus.rows(values), 4, 85)
    got = ngram_jaccard_join(corpus.documents(spark, values)).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_join_with_common_elements_left_out(spark, monkeypatch):
    """With nearly every element on the list, the second level of parts must do."""
    monkeypatch.setattr(nj, "COMMON_LOCAL", 1)
    values = near_copies(30, 60, 4) + corpus.texts(n=20)
    want = brute_components(corpus.rows(values), 4, 85)
    got = ngram_jaccard_join(corpus.documents(spark, values)).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_linked_sets_share_a_part():
    rng = np.random.default_rng(5)
    none = np.zeros(0, np.uint64)
    for percent in (60, 80, 85, 95):
        lows, differ, parts = size_bands(percent)
        assert (parts > differ).all()
        for n in [*range(1, 40), 100, 333, 1000]:
            for _ in range(3):
                a = np.unique(rng.integers(0, 2 ** 63, n, dtype=np.uint64))
                lost = int((100 - percent) * n // 100)
                b = np.sort(a[rng.permutation(len(a))[lost:]])
                if 100 * len(b) >= percent * len(a) and len(b):
                    common = np.sort(a[:len(a) // 2]) if n % 2 else none
                    assert set(part_hashes(a, common, percent)) & set(part_hashes(b, common, percent))


def shared_by_all(percent: int, n: int, times: int) -> int:
    """Sets of n elements that send their own band's hash for too many empty parts or
    one of the next band."""
    rng = np.random.default_rng(n)
    lows = size_bands(percent)[0]
    own = int(np.searchsorted(lows, n, "right")) - 1
    hashes = {int(nj.mix(np.array([b * 4 + 2], np.uint64))[0]) for b in (own, own + 1)}
    return sum(bool(hashes & set(part_hashes(np.unique(rng.integers(
        0, 2 ** 63, n, dtype=np.uint64)), np.zeros(0, np.uint64), percent).tolist()))
        for _ in range(times))


def tied_by_chance(percent: int, n: int) -> int:
    """Of 300 unlike sets that each hold ten elements of a pool of 300, those that share
    a part hash with another one."""
    rng = np.random.default_rng(n)
    pool = rng.integers(0, 2 ** 63, 300, dtype=np.uint64)
    owners: dict[int, set[int]] = {}
    for i in range(300):
        own = np.concatenate((pool[rng.permutation(300)[:10]],
                              rng.integers(0, 2 ** 63, n - 10, dtype=np.uint64)))
        for h in part_hashes(np.unique(own), np.zeros(0, np.uint64), percent).tolist():
            owners.setdefault(h, set()).add(i)
    return len(set().union(*(x for x in owners.values() if len(x) > 1)))


def test_few_unlike_sets_are_tied_by_a_shared_element():
    assert all(tied_by_chance(80, n) < 30 for n in (100, 400, 1000))


def test_marks_let_all_linked_sets_pass():
    rng = np.random.default_rng(11)
    sets, pairs = [], []
    for n in (1, 2, 63, 64, 65, 128, 400, 3000):
        a = np.unique(rng.integers(0, 2 ** 63, n, dtype=np.uint64))
        more = rng.integers(0, 2 ** 63, n // 7, dtype=np.uint64)
        sets += [a, a[n // 9:], np.unique(np.concatenate((a, more))),
                 np.unique(rng.integers(0, 2 ** 63, n, dtype=np.uint64))]
    marks = np.empty(len(sets), object)
    marks[:] = [nj.parity_marks(s) for s in sets]
    sizes = np.array([len(s) for s in sets])
    x, y = (v.ravel() for v in np.meshgrid(range(len(sets)), range(len(sets))))
    got = nj.may_link([sizes[x], sizes[y]], [marks[x], marks[y]], 85)
    for i, j, passed in zip(x, y, got):
        both = len(np.intersect1d(sets[i], sets[j]))
        linked = 100 * both >= 85 * (sizes[i] + sizes[j] - both)
        assert passed or not linked
        assert not passed or both or sizes[i] < 63
    none = np.zeros(0, np.int64)
    assert len(nj.may_link([none, none], [marks[none], marks[none]], 85)) == 0


def test_ties_by_pairs_and_by_the_smallest():
    """Few documents with a hash are tied pair by pair; if there are many, in a batch or in
    all, each is tied surely to the smallest."""
    rnd = random.Random(8)
    for sizes in ([(2, 1)], [(3, 4), (1, 2)], [(5, 5)], [(30, 2)], [(2, 1), (9, 1), (8, 0)]):
        packed, of_hash = [], []
        texts = [f"alike {k}" for k in range(len(sizes))]
        ids = iter(rnd.sample(range(1000), 100))
        for batch in (0, 1):
            rows = [(next(ids), k) for k, s in enumerate(sizes) for _ in range(s[batch])]
            of_hash += rows
            # texts of a batch differ, as equal sets send once; the hash stands for a part
            known = {f"{texts[k]} {i}": k for i, k in rows}
            docs, column = np.array([i for i, _ in rows], np.int64), pa.array(list(known))
            hashes = [np.array([1000 + k], np.uint64) for k in known.values()]
            real, nj.part_hashes = nj.part_hashes, lambda *_: hashes.pop(0)
            try:
                packed += nj._packed_parts(column, docs, 4, 85, np.zeros(0, np.uint64), 1)
            finally:
                nj.part_hashes = real
        names = ["bucket", "docs", "places", "keys", "found"]
        got = nj._part_ties(pa.Table.from_pylist([dict(zip(names, r)) for r in packed])).to_pylist()
        for k in range(len(sizes)):
            members = sorted(i for i, of in of_hash if of == k)
            own = {(r["a"], r["b"]): r["sure"] for r in got if r["a"] in members}
            if len(members) <= nj.PAIRED:
                assert own == {(a, b): False for a in members for b in members if a > b}
            else:
                assert all(own.values()) and all(b in members and b < a for a, b in own)
                assert {members[0]} | {a for a, _ in own} == set(members)


def test_unlike_texts_with_a_common_passage_reach_no_tile(spark, monkeypatch):
    tied = []
    tiles = nj._tiles

    def kept(rows, profiles, groups, *more):
        tied.extend(r.node for r in groups.collect())
        return tiles(rows, profiles, groups, *more)

    monkeypatch.setattr(nj, "_tiles", kept)
    rnd = random.Random(6)
    values = []
    for i in range(12):
        passage = [f"p{i}x{rnd.randrange(10 ** 6)}" for _ in range(150)]
        for _ in range(2):
            values.append(" ".join(passage + [f"w{rnd.randrange(10 ** 6)}" for _ in range(90)]))
    values += near_copies(3, 100, 5)
    rows = [(i, t, "en", "a", len(t)) for i, t in enumerate(values)]
    got = {r.doc_id: r.component_id for r in ngram_jaccard_join(
        spark.createDataFrame(rows, corpus.SCHEMA), percent=80, words_each=5).collect()}
    assert got == brute_components(rows, 5, 80)
    assert sorted(tied) == [24, 25, 26]


def test_few_sets_send_the_hash_for_empty_parts():
    assert sum(shared_by_all(80, n, 100) for n in range(13, 60)) < 47


def test_roots_in_a_tile_equal_brute_force():
    rng = np.random.default_rng(9)
    base = [np.unique(rng.integers(0, 2 ** 63, 80, dtype=np.uint64)) for _ in range(4)]
    sets = []
    for _ in range(60):
        s = base[rng.integers(4)]
        s = s[rng.random(len(s)) > 0.06]
        sets.append(np.unique(np.concatenate((s, rng.integers(0, 2 ** 63, rng.integers(0, 6),
                                                              dtype=np.uint64)))))
    roots = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                both = len(np.intersect1d(a, b))
                if 100 * both >= 85 * (len(a) + len(b) - both):
                    roots[i] = roots[j] = min(roots[i], roots[j])
    assert linked_roots(sets, 85).tolist() == roots


def test_roots_among_sets_of_all_sizes():
    """Bitmaps of unlike width: folded ones lose no link, a wide one costs the others nothing."""
    rng = random.Random(8)
    sets = [np.unique(np.array([rng.getrandbits(63) for _ in range(n)], np.uint64))
            for n in [1, 2, 3, 100, 127, 128, 129, 140, 255, 256, 257, 300, 513, 20_000]]
    for s in list(sets):                      # a near copy of each that is a little larger
        more = np.array([rng.getrandbits(63) for _ in range(len(s) // 8)], np.uint64)
        sets.append(np.unique(np.concatenate((s, more))))
    half = len(sets) // 2
    assert linked_roots(sets, 85).tolist() == list(range(half)) * 2
    for n, other in ((half - 1, 0), (4, half + 4)):       # bits never exceed what they bound
        mine, theirs = Bitmaps(sets).only(n, np.array([other]))
        a, b = set(sets[n].tolist()), set(sets[other].tolist())
        assert mine[0] <= len(a - b) and theirs[0] <= len(b - a)


def test_hot_sets_beside_many_others(spark):
    """Hot sets meet their rows by broadcast, the others by a shuffle; no row is lost."""
    rows = [(i, " ".join(f"h{k}" for k in range(12))) for i in range(300)]
    rows += [(1000 + i, " ".join(f"u{i}x{k}" for k in range(6))) for i in range(3000)]
    rows += [(9000, None), (9001, "  ")]
    got = {r.doc_id: r for r in ngram_jaccard_join(spark.createDataFrame(
        rows, "doc_id bigint, text string")).collect()}
    assert len(got) == len(rows)
    assert all(r.component_id == (0 if i < 300 else i) for i, r in got.items())


def brute_links(values: list[tuple], size: int, percent: int) -> list[int]:
    """Per row, the other rows with an id whose sets are equal to its own or link with it."""
    sets = [corpus.shingles(t, size) for _, t, *_ in values]
    out = []
    for i, a in enumerate(sets):
        near = 0
        for j, b in enumerate(sets):
            if i != j and a and values[j][0] is not None and (a == b or values[i][0] is not None):
                near += 100 * len(a & b) >= percent * len(a | b)
        out.append(near)
    return out


@pytest.mark.parametrize("band", [nj.BAND_SHINGLES, 300])
def test_link_counts_equal_brute_force(spark, monkeypatch, band):
    """Drifting chains, copies and all odd texts, in one band and in many."""
    monkeypatch.setattr(nj, "BAND_SHINGLES", band)
    chain = near_copies(40, 90, 1)
    values = corpus.rows(chain + near_copies(25, 30, 2) + chain[5:9] * 3 + corpus.texts(n=30))
    want = {v[0]: n for v, n in zip(values, brute_links(values, 4, 85))}
    rows = ngram_jaccard_join(spark.createDataFrame(values, corpus.SCHEMA), count_links=True).collect()
    assert {r.doc_id: r.n_links for r in rows} == want
    assert {r.doc_id: r.component_id for r in rows} == brute_components(values, 4, 85)
    # within a chain, documents are in one component without all being linked
    sizes = {r.component_id: sum(s.component_id == r.component_id for s in rows) for r in rows}
    assert any(0 < r.n_links < sizes[r.component_id] - 1 for r in rows)


def test_link_counts_of_odd_rows(spark):
    assert ngram_jaccard_join(corpus.nothing(spark), count_links=True).count() == 0
    text = "alpha beta gamma delta epsilon zeta"
    values = [(1, text), (1, text), (1, None), (2, ""), (3, text), (None, text), (None, "alone"),
              (4, "alone"), (4, "other words"), (5, "other words")]
    df = spark.createDataFrame(values, "doc_id bigint, text string")
    key = lambda r: (r[0] or 0, r[1])
    want = sorted(zip((v[0] for v in values), brute_links(values, 4, 85)), key=key)
    rows = ngram_jaccard_join(df, count_links=True).collect()
    assert sorted(((r.doc_id, r.n_links) for r in rows), key=key) == want
    odd = corpus.odd_documents(spark)
    assert len(ngram_jaccard_join(odd, count_links=True).collect()) == 8


def test_many_links_in_a_tile():
    """Counts and roots of a tile, of which a band is at home elsewhere."""
    rng = np.random.default_rng(4)
    base = np.unique(rng.integers(0, 2 ** 63, 60, dtype=np.uint64))
    sets = [base[rng.random(len(base)) > 0.08] for _ in range(80)]
    sets += [np.unique(rng.integers(0, 2 ** 63, 50, dtype=np.uint64)) for _ in range(20)]
    copies, bands = rng.integers(1, 5, 100), rng.integers(0, 2, 100)
    home = bands == 1
    roots, links = nj.link_counts(sets, copies, bands, home, 85)
    want, same = np.zeros(100, np.int64), list(range(100))
    for i in range(100):
        for j in range(100):
            both = len(np.intersect1d(sets[i], sets[j]))
            if i != j and (home[i] or bands[i] != bands[j]) and (
                    100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both)):
                want[i] += copies[j]
                x, y = sorted((same[i], same[j]))
                same = [x if r == y else r for r in same]
    assert links.tolist() == want.tolist() and roots.tolist() == same


def test_join_odd_rows(spark):
    assert ngram_jaccard_join(corpus.nothing(spark)).count() == 0
    rows = ngram_jaccard_join(corpus.odd_documents(spark)).collect()
    assert len(rows) == 8
    assert {r.component_id for r in rows if r.doc_id == 1} == {1}
    assert [r.component_id for r in rows if r.doc_id == 2 and r.n_shingles == 0] == [2]
    assert all(r.component_id is None for r in rows if r.doc_id is None)


# ---- substring dedup ---------------------------------------------------------------------
def brute_cut(values: list[tuple], window: int) -> dict:
    first: dict = {}
    for i, t, *_ in sorted(values):
        w = corpus.words(t)
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k:k + window]), i)
    out = {}
    for i, t, *_ in values:
        w = corpus.words(t)
        gone = {k + j for k in range(len(w) - window + 1)
                if first[tuple(w[k:k + window])] < i for j in range(window)}
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


@pytest.mark.parametrize("window", [13, 5, 1])
def test_cut_equals_brute_force(spark, window):
    values = corpus.rows(corpus.texts(n=40))
    want = brute_cut(values, window)
    got = substring_dedup(corpus.documents(spark, corpus.texts(n=40)), window=window).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == {
        i: (n, g, hashlib.sha256(k.encode()).hexdigest()) for i, (n, g, k) in want.items()}
    assert any(g for _, g, _ in want.values())


def test_cut_carries_columns_and_text(spark):
    docs = corpus.documents(spark)
    want = brute_cut(corpus.rows(corpus.texts()), 13)
    got = substring_dedup(docs, carry=docs.columns).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert {r.doc_id: r.kept_text for r in got} == {
        i: k if gone else texts[i] for i, (_, gone, k) in want.items()}
    assert {r.carried for r in got} == set(docs.collect())


def test_cut_odd_rows(spark):
    assert substring_dedup(corpus.nothing(spark)).count() == 0
    rows = substring_dedup(corpus.odd_documents(spark), window=3).collect()
    assert len(rows) == 8 and all(r.n_removed == 0 for r in rows)
    long = " ".join(f"w{i}" for i in range(20))
    df = spark.createDataFrame([(5, long), (5, long), (3, long), (None, long)],
                               "doc_id bigint, text string")
    got = sorted((r.doc_id or 99, r.n_removed) for r in substring_dedup(df).collect())
    assert got == [(3, 0), (5, 20), (5, 20), (99, 0)]
