"""Operator 11: exact top-k inner products by MaxScore.

A query's terms are its dimensions; the postings of a term are the rows with
a component of the query's sign there, and a term's bound is the most it can
add to any score of a shard. Terms whose bounds together stay below the score
of the k-th best row so far are non-essential: a row found by them alone cannot
enter. The essential postings are traversed (as one product of the essential
parts of many queries with the shard's rows), then rows are probed in one
non-essential term after another, largest bound first, while what they have
and what is left can still reach the k-th best score. The best of each shard
are merged by Spark.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from torque.llm.vector_blocks import block_count, blocks, exact, matrix, paired, same_width, taking_part
from torque.llm.worker_memory import release

SEEDS = 512                      # rows of a shard that give the first k-th best score
QUERIES_AT_ONCE = 256
NOTHING = -(1 << 62)             # below every score


def max_score(queries: np.ndarray, vectors: np.ndarray, own: np.ndarray, k: int,
              seeds: int = SEEDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of every row that may be among the k best of a query, the
    k best among them. ``own[q]`` is the row that is the query itself, or -1."""
    at = np.arange(len(queries))
    head = queries @ vectors[:seeds].T
    inside = (own >= 0) & (own < head.shape[1])
    head[at[inside], own[inside]] = NOTHING
    least = (np.partition(head, -k, axis=1)[:, -k] if head.shape[1] >= k
             else np.full(len(queries), NOTHING, head.dtype))
    first, row = np.nonzero((head >= least[:, None]) & (head > NOTHING))
    found = [(first, row, head[first, row])]
    rest = vectors[seeds:]
    if len(rest):
        floor = least.astype(np.float64)
        high, low = np.maximum(rest.max(0), 0), np.minimum(rest.min(0), 0)
        bound = np.maximum(queries * high.astype(np.float64), queries * low.astype(np.float64))
        # bounds of rows in 64-bit integers are rounded: leave room for that
        room = 0.0 if rest.dtype == np.float64 else 1e-9 * (bound.sum(1) + np.abs(floor)) + 1
        floor = floor - room
        order = np.argsort(bound, axis=1)
        total = np.cumsum(np.take_along_axis(bound, order, 1), axis=1)
        minor = total < floor[:, None]                 # a prefix of the terms by bound
        n_minor = minor.sum(1)
        left = np.where(n_minor > 0, total[at, n_minor - 1], 0)
        essential = np.ones(bound.shape, bool)
        np.put_along_axis(essential, order, ~minor, 1)
        score = np.where(essential, queries, 0) @ rest.T
        inside = own >= seeds
        score[at[inside], own[inside] - seeds] = NOTHING
        query, row = np.nonzero((score + left[:, None] >= floor[:, None]) & (score > NOTHING))
        score = score[query, row]
        for step in range(int(n_minor.max(initial=0))):
            term = n_minor - 1 - step
            dim = order[at, np.maximum(term, 0)]
            weight = np.where(term >= 0, queries[at, dim], 0)
            left = np.where(term > 0, total[at, np.maximum(term - 1, 0)], 0)
            score = score + weight[query] * rest[row, dim[query]]
            keep = score + left[query] >= floor[query]
            query, row, score = query[keep], row[keep], score[keep]
        found.append((query, row + seeds, score))
    return tuple(np.concatenate(x) for x in zip(*found))


def first_ranks(group: np.ndarray, score: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k entries of each group by score (descending) and row."""
    order = np.lexsort((row, -score, group))
    group = group[order]
    start = np.searchsorted(group, group)
    return order[np.arange(len(order)) - start < k]


def exact_top_k(rows: DataFrame, k: int = 5, query_every: int = 50, id_col: str = "vec_id",
                vector_col: str = "embedding") -> DataFrame:
    """The k rows of highest integer inner product with every query row.

    Components count as floor(256 x). Queries are the rows whose id is divisible
    by ``query_every``, candidates all rows but the query's own; ties go to the
    smaller id. Returns query_id, rank, vec_id, score.

    Rows with a null id, or a vector that is null or holds null or non-finite
    components, take no part, nor do vectors of a squared norm (of 256 x) from
    2 ** 61 on, whose scores could leave 64 bits. Short vectors count as filled up
    with zeros. Of rows that share an id one takes part, the one whose vector is
    smallest, so repeated rows change nothing. With fewer than k candidates all
    are returned; an empty table gives an empty result. Other columns are not read.
    """
    rows = taking_part(rows, id_col, vector_col)
    queries = rows.filter(F.col("id") % query_every == 0)
    n_shards, n_queries = block_count(rows), block_count(queries)
    pairs = paired(blocks(queries, n_queries, "a"), blocks(rows, n_shards, "b"),
                   n_queries, n_shards)

    def search(batches):
        release()
        for batch in batches:
            for r in batch.to_pylist():
                q_ids, _, q = matrix(*(r["l_" + x] for x in ("n", "dims", "ids", "labels", "data")))
                ids, _, x = matrix(*(r["r_" + x] for x in ("n", "dims", "ids", "labels", "data")))
                q, x = exact(*same_width(q, x))
                own = np.searchsorted(ids, q_ids)
                own = np.where(ids[np.minimum(own, len(ids) - 1)] == q_ids, own, -1)
                for a in range(0, len(q), QUERIES_AT_ONCE):
                    query, row, score = max_score(q[a:a + QUERIES_AT_ONCE], x,
                                                  own[a:a + QUERIES_AT_ONCE], k)
                    best = first_ranks(query, score, row, k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(q_ids[a + query[best]]), pa.array(ids[row[best]]),
                         pa.array(score[best].astype(np.int64))],
                        names=["query_id", "vec_id", "score"])

    best = pairs.mapInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


VECTORS = """v AS (
  SELECT vec_id, {label} AS label, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS c
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)"""
PRODUCT = "list_sum([a.c[i] * b.c[i] FOR i IN range(1, len(a.c) + 1)])::BIGINT"

ORACLE = f"""
WITH {VECTORS.format(label="0")},
s AS (SELECT a.vec_id AS query_id, b.vec_id, {PRODUCT} AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT query_id, row_number() OVER (
        PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""
