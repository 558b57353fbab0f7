"""Operators 11 and 13 against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from torque.llm import hard_negatives as hn
from torque.llm import topk_search as ts
from torque.llm import vector_blocks as vb

SCHEMA = "vec_id bigint, label int, embedding array<double>"


def vectors(n=230, dims=6, seed=3, spread=0.4):
    """Points around four centres, with ties, copies and all-zero rows."""
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    out = []
    for i in range(n):
        c = centres[i % 4]
        v = [x + rnd.gauss(0, spread) for x in c]
        if i % 13 == 0:
            v = [0.25 * round(4 * x) for x in v]
        if i % 17 == 0 and out:
            v = list(out[-1][2])
        out.append((i, (i % 4 + (rnd.random() < 0.2)) % 4, [0.0] * dims if i % 41 == 40 else v))
    return out


def takes_part(row, labelled):
    return (row[0] is not None and row[2] is not None and (row[1] is not None or not labelled)
            and all(x is not None and math.isfinite(x) for x in row[2])
            and sum(x * x for x in row[2]) * 65536 < 2 ** 61)


def whole(rows, labelled):
    """Integer vectors by id, filled up with zeros; the first row of an id."""
    kept: dict = {}
    width = max([len(r[2]) for r in rows if r[2] is not None], default=0)
    for i, label, v in rows:
        if takes_part((i, label, v), labelled):
            ints = [math.floor(256 * x) for x in v] + [0] * (width - len(v))
            entry = (label if labelled else 0, ints)
            kept[i] = min(kept.get(i, entry), entry)
    return kept


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def brute_top(rows, k, every):
    kept, out = whole(rows, False), []
    for q in sorted(i for i in kept if i % every == 0):
        best = sorted((-dot(kept[q][1], v), i) for i, (_, v) in kept.items() if i != q)[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    return out


def brute_negatives(rows, positives, negatives, every):
    kept, out = whole(rows, True), []
    for a in sorted(i for i in kept if i % every == 0):
        scored = sorted((-dot(kept[a][1], v), i, label) for i, (label, v) in kept.items() if i != a)
        for s, p, _ in [x for x in scored if x[2] == kept[a][0]][:positives]:
            ps = -s
            fits = [(i, -t) for t, i, label in scored
                    if label != kept[a][0] and 50 * ps <= -100 * t <= 95 * ps][:negatives]
            out += [(a, p, rank, i, ps, t) for rank, (i, t) in enumerate(fits, 1)]
    return sorted(out)


ODD = [(None, 1, [1.0] * 6), (300, None, [1.0] * 6), (301, 1, None), (302, 2, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
       (303, 2, [float("nan")] * 6), (304, 2, [float("inf")] * 6), (305, 3, [1.0, 2.0]), (306, 1, []),
       (10, 2, [0.5] * 6), (10, 2, [0.5] * 6), (20, 0, [9.0] * 6), (307, 1, [1e10] * 6),
       (308, 1, [3e6] * 6), (309, 2, [-3e6, 3e6, 1.0, 0.0, 0.0, 0.5])]


def frame(spark, rows):
    """Rows with columns whose names the operators use themselves."""
    return spark.createDataFrame(
        [(*r, 1, "x", 2.0, 3) for r in rows],
        SCHEMA + ", id int, a string, vector double, score int")


@pytest.mark.parametrize("rows", [vectors(), vectors() + ODD, vectors(7), []])
def test_top_k_equals_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(vb, "BLOCK_ROWS", 60)
    got = ts.exact_top_k(frame(spark, rows), k=4, query_every=5)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 4, 5)


@pytest.mark.parametrize("rows", [vectors(), vectors() + ODD, vectors(7), []])
def test_hard_negatives_equal_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(vb, "BLOCK_ROWS", 60)
    got = hn.hard_negatives(frame(spark, rows), positives=3, negatives=2, anchor_every=5)
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows, 3, 2, 5)


@pytest.mark.parametrize("scale", [1, 1 << 20])
@pytest.mark.parametrize("seeds", [1, 7, 64])
def test_max_score_keeps_the_best(scale, seeds):
    """Whatever the first threshold, and with scores beyond exact doubles."""
    rng = np.random.default_rng(seeds)
    x = np.floor(rng.normal(size=(90, 8)) * 90)
    x[::9] = x[1]
    x = (x * scale).astype(np.int64) if scale > 1 else x
    q = x[:30]
    query, row, score = ts.max_score(q, x, np.arange(30), 5, seeds)
    best = ts.first_ranks(query, score, row, 5)
    got = [(int(query[b]), int(row[b]), int(score[b])) for b in best]
    want = []
    for i in range(30):
        all_ = sorted((-dot(q[i].tolist(), v.tolist()), j) for j, v in enumerate(x) if j != i)
        want += [(i, j, int(-s)) for s, j in all_[:5]]
    assert got == want


def test_max_score_prunes_where_terms_differ_in_weight():
    """Rows that only weak terms find are never probed to the end."""
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(size=(4000, 32)) * 10)
    x[:8, 0] = 900
    q = np.zeros((1, 32))
    q[0] = 1
    q[0, 0] = 50
    _, row, _ = ts.max_score(q, x, np.array([-1]), 5)
    assert set(row) <= set(range(8))


def test_spanning_tree():
    rng = np.random.default_rng(5)
    for points in (rng.normal(size=(40, 3)), np.zeros((5, 3)), rng.normal(size=(1, 3))):
        order, parent, length = hn.spanning_tree(points)
        assert sorted(order) == list(range(len(points)))
        seen = set()
        for node in order:
            assert parent[node] == -1 and not seen or parent[node] in seen
            if parent[node] >= 0:
                assert np.isclose(length[node], np.linalg.norm(points[node] - points[parent[node]]))
            seen.add(node)
    # Kruskal gives the same total
    points = rng.normal(size=(40, 3))
    edges = sorted((np.linalg.norm(points[i] - points[j]), i, j)
                   for i in range(40) for j in range(i))
    root = list(range(40))

    def find(i):
        return i if root[i] == i else find(root[i])

    total = 0.0
    for w, i, j in edges:
        if find(i) != find(j):
            root[find(i)] = find(j)
            total += w
    assert np.isclose(total, hn.spanning_tree(points)[2].sum())


def test_bounds_hold_and_spare_scores():
    """Every score lies in its interval, and close anchors leave most rows unscored."""
    rng = np.random.default_rng(2)
    rows = np.floor(rng.normal(size=(600, 16)) * 60)
    anchors = np.floor(rng.normal(size=(1, 16)) * 60 + rng.normal(size=(40, 16)))
    bounds = hn.Bounds(anchors, rows, hn.spanning_tree(anchors))
    true = anchors @ rows.T
    windows = {i: [(int(np.sort(true[i])[-6]), int(np.sort(true[i])[-3]))] for i in range(40)}
    found = list(hn.in_windows(bounds, lambda a: np.ones(600, bool), windows, 3))
    assert np.all(bounds.low <= true + 1e-6) and np.all(true - 1e-6 <= bounds.high)
    assert bounds.scored < 0.3 * true.size
    for node, _, row, score in found:
        assert true[node, row] == score and windows[node][0][0] <= score <= windows[node][0][1]
    assert len(found) >= 3 * 40


def test_operators_survive_a_range_of_block_sizes(spark, monkeypatch):
    rows = vectors(150)
    want = brute_negatives(rows, 3, 2, 5)
    for size, anchors in ((1000, 1000), (20, 4)):
        monkeypatch.setattr(vb, "BLOCK_ROWS", size)
        monkeypatch.setattr(hn, "ANCHORS", anchors)
        got = hn.hard_negatives(frame(spark, rows), positives=3, negatives=2, anchor_every=5)
        assert sorted(map(tuple, got.collect())) == want
