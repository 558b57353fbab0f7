"""Operator 13: hard negatives under anchor spanning-tree bounds.

The anchors of a block form a minimum spanning tree of Euclidean distances. The
score of a row with a child anchor differs from its score with the parent by
at most edge length times the row's norm. So the root scores all rows of a
shard, every other anchor inherits an interval per row, and scores only rows
whose interval reaches what it looks for: the k-th best row of its own label
(first pass), or the windows of its positives (second pass). Rows it has
scored hand exact values down the tree, the others their wider intervals.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from torque.llm.columns import stored
from torque.llm.topk_search import PRODUCT, VECTORS, first_ranks
from torque.llm.vector_blocks import block_count, blocks, exact, matrix, paired, same_width, taking_part
from torque.llm.worker_memory import release

ANCHORS = 512                    # anchors of a tree on average
PARTS = ("n", "dims", "ids", "labels", "data")


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, length): nodes with parents first, and each node's edge to its
    parent; the root has parent -1."""
    n = len(points)
    order, parent, length = [], np.full(n, -1), np.zeros(n)
    near, best = np.full(n, -1), np.full(n, np.inf)
    open_ = np.ones(n, bool)
    node = 0
    for _ in range(n):
        order.append(node)
        open_[node] = False
        parent[node], length[node] = near[node], best[node]
        gap = np.sqrt(np.sum((points - points[node]) ** 2, axis=1))
        closer = open_ & (gap < best)
        near[closer], best[closer] = node, gap[closer]
        node = int(np.argmin(np.where(open_, best, np.inf)))
        if not open_[node] and open_.any():
            node = int(np.flatnonzero(open_)[0])
    return np.array(order, np.int64), parent, np.where(np.isfinite(length), length, 0)


class Bounds:
    """Scores of a shard's rows, known exactly or within an interval, down a tree."""

    def __init__(self, anchors: np.ndarray, rows: np.ndarray, tree):
        self.anchors, self.rows = exact(*same_width(anchors, rows))
        self.order, self.parent, self.length = tree
        self.norms = np.sqrt(np.sum(rows * rows, axis=1)) * (1 + 1e-9)
        self.own = np.sqrt(np.sum(anchors * anchors, axis=1)) * (1 + 1e-9)
        self.low = np.full((len(anchors), len(rows)), -np.inf)
        self.high = np.full((len(anchors), len(rows)), np.inf)
        self.scored = 0

    def inherit(self, node: int) -> None:
        widest = self.own[node] * self.norms + 1
        if self.parent[node] < 0:
            self.low[node], self.high[node] = -widest, widest
            return
        up = self.parent[node]
        reach = self.length[node] * (1 + 1e-9) * self.norms
        reach += 1e-9 * widest + 1                 # rounding of the bounds themselves
        self.low[node] = np.maximum(self.low[up] - reach, -widest)
        self.high[node] = np.minimum(self.high[up] + reach, widest)

    def score(self, node: int, which: np.ndarray) -> np.ndarray:
        """Exact scores of the rows ``which`` with an anchor."""
        rows = self.rows if len(which) == len(self.rows) else self.rows[which]
        exactly = rows @ self.anchors[node]
        self.low[node, which] = self.high[node, which] = exactly
        self.scored += len(which)
        return exactly.astype(np.int64)


def best_alike(bounds: Bounds, alike, k: int):
    """(anchor, row, score) of rows that may be among an anchor's k best of its label.
    ``alike(anchor)`` marks the rows that may be its positives."""
    every = np.arange(len(bounds.rows))
    for node in bounds.order:
        bounds.inherit(node)
        mine = np.flatnonzero(alike(node))
        if bounds.parent[node] < 0:
            score = bounds.score(node, every)[mine]
        else:
            # the rows with the highest bounds give the score to beat
            high = bounds.high[node, mine]
            if len(mine) > k:
                lead = mine[np.argpartition(-high, k)[:k]]
                least = bounds.score(node, lead).min()
                mine = mine[high >= least]
            score = bounds.score(node, mine) if len(mine) else np.zeros(0, np.int64)
        yield node, mine, score


def in_windows(bounds: Bounds, unlike, windows: dict[int, list[tuple[int, int]]], k: int):
    """(anchor, window, row, score) of the k best rows of other labels in each window."""
    every = np.arange(len(bounds.rows))
    for node in bounds.order:
        bounds.inherit(node)
        own = windows.get(node, [])
        least, most = min([w[0] for w in own], default=0), max([w[1] for w in own], default=-1)
        if bounds.parent[node] < 0:
            bounds.score(node, every)
        overlap = (bounds.high[node] >= least) & (bounds.low[node] <= most) & unlike(node)
        mine = np.flatnonzero(overlap) if least <= most else every[:0]
        if not len(mine):
            continue
        score = bounds.score(node, mine)
        order = np.lexsort((mine, -score))
        mine, falling = mine[order], -score[order]
        for w, (low, high) in enumerate(own):
            a, b = np.searchsorted(falling, -high), np.searchsorted(falling, -low, "right")
            for i in range(a, min(b, a + k)):
                yield node, w, mine[i], -falling[i]


def hard_negatives(rows: DataFrame, positives: int = 5, negatives: int = 3,
                   low_percent: int = 50, high_percent: int = 95, anchor_every: int = 50,
                   label: Column | None = None, id_col: str = "vec_id",
                   vector_col: str = "embedding") -> DataFrame:
    """For every anchor and positive, the best rows of other labels within a window.

    Components count as floor(256 x); a row's score is its inner product with
    the anchor, higher first, ties by smaller id. Anchors are the rows whose id
    is divisible by ``anchor_every``; positives are an anchor's first other rows of
    its ``label`` (a column or expression). Negatives are the first rows of other
    labels with low_percent * positive <= 100 * negative <= high_percent * positive
    (none where the positive's score is negative). Returns anchor_id, positive_id,
    rank, negative_id, positive_score, negative_score.

    Rows with a null id or label, or a vector that is null or holds null or
    non-finite components, take no part, nor do vectors of a squared norm (of
    256 x) from 2 ** 61 on. Short vectors count as filled up with zeros. Of rows
    that share an id one takes part, the first by label and vector, so repeated
    rows change nothing. Where there are fewer positives or negatives all are
    taken; an empty table gives an empty result. Other columns are not read.
    """
    rows = taking_part(rows, id_col, vector_col, F.col("label") if label is None else label)
    anchors = rows.filter(F.col("id") % anchor_every == 0)
    n_shards, n_trees = block_count(rows), block_count(anchors, ANCHORS)
    shards = stored(blocks(rows, n_shards, "b"))

    def grown(batches):
        for batch in batches:
            trees = [spanning_tree(matrix(*(r[c] for c in PARTS))[2]) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array([t[i].tobytes() for t in trees], pa.binary())
                                   for i in range(3)]],
                names=[*batch.schema.names, "order", "parent", "length"])

    trees = blocks(anchors, n_trees, "a")
    trees = stored(trees.mapInArrow(grown, ", ".join(
        [f"{f.name} {f.dataType.simpleString()}" for f in trees.schema]
        + ["order binary", "parent binary", "length binary"])))

    def opened(r):
        ids, labels, points = matrix(*(r["l_" + c] for c in PARTS))
        other, kinds, data = matrix(*(r["r_" + c] for c in PARTS))
        tree = (np.frombuffer(r["l_order"], np.int64), np.frombuffer(r["l_parent"], np.int64),
                np.frombuffer(r["l_length"], np.float64))
        return ids, labels, other, kinds, Bounds(*same_width(points, data), tree)

    def find_positives(batches):
        release()
        for batch in batches:
            for r in batch.to_pylist():
                ids, labels, other, kinds, bounds = opened(r)
                found = list(best_alike(
                    bounds, lambda a: (kinds == labels[a]) & (other != ids[a]), positives))
                anchor = np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(int)
                row, score = (np.concatenate([f[i] for f in found]).astype(np.int64)
                              for i in (1, 2))
                best = first_ranks(anchor, score, row, positives)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[anchor[best]]), pa.array(other[row[best]]),
                     pa.array(score[best])], names=["anchor_id", "positive_id", "positive_score"])

    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    alike = stored(
        paired(trees, shards, n_trees, n_shards)
        .mapInArrow(find_positives, "anchor_id bigint, positive_id bigint, positive_score bigint")
        .withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives))
    sought = (alike.groupBy(F.pmod(F.xxhash64("anchor_id"), F.lit(n_trees)).cast("int").alias("a"))
              .agg(F.collect_list(F.struct("anchor_id", "positive_id", "positive_score"))
                   .alias("sought")))

    def find_negatives(batches):
        release()
        for batch in batches:
            for r in batch.to_pylist():
                ids, labels, other, kinds, bounds = opened(r)
                windows, seen = {}, {}
                place = {i: n for n, i in enumerate(ids.tolist())}
                for s in r["l_sought"]:
                    node, score = place[s["anchor_id"]], s["positive_score"]
                    windows.setdefault(node, []).append(
                        (-(-low_percent * score // 100), high_percent * score // 100))
                    seen.setdefault(node, []).append((s["positive_id"], score))
                found = list(in_windows(bounds, lambda a: kinds != labels[a], windows, negatives))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(ids[f[0]]) for f in found], pa.int64()),
                     pa.array([seen[f[0]][f[1]][0] for f in found], pa.int64()),
                     pa.array([int(other[f[2]]) for f in found], pa.int64()),
                     pa.array([seen[f[0]][f[1]][1] for f in found], pa.int64()),
                     pa.array([int(f[3]) for f in found], pa.int64())],
                    names=["anchor_id", "positive_id", "negative_id", "positive_score",
                           "negative_score"])

    order = Window.partitionBy("anchor_id", "positive_id").orderBy(
        F.desc("negative_score"), "negative_id")
    return (paired(trees.join(sought, "a"), shards, n_trees, n_shards)
            .mapInArrow(find_negatives, "anchor_id bigint, positive_id bigint, negative_id bigint, "
                                        "positive_score bigint, negative_score bigint")
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                    "negative_score"))


ORACLE = f"""
WITH {VECTORS.format(label="CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")},
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, {PRODUCT} AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
      WHERE a.label IS NOT NULL AND b.label IS NOT NULL),
p AS (SELECT * FROM s WHERE alike QUALIFY row_number() OVER (
        PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id,
             p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.vec_id
                                ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.alike
        AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 3"""
