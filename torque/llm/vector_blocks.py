"""Vectors as blocks of integer rows, shared by the vector operators.

Each component x becomes floor(256 x). Rows are dealt by a hash of their id to
blocks of a bounded number of rows, one Spark row each; a stated set of queries
meets all rows block by block, never row by row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 2048                # rows of a block on average
MOST_PARTITIONS = 20_000
FIELDS = "n int, dims int, ids binary, labels binary, data binary"


def taking_part(df: DataFrame, id_col: str, vector_col: str, label=None) -> DataFrame:
    """(id, label, vector) of the rows that can be scored.

    Rows go whose id is null or no whole number, whose label is null, or whose
    vector is null or holds null or non-finite components, or whose squared
    norm reaches 2 ** 61 (below that, every score fits 64 bits).
    """
    label = F.lit(0) if label is None else label
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x) * 65536.0
    return (df.select(F.col(id_col).try_cast("bigint").alias("id"), label.cast("bigint").alias("label"),
                      F.col(vector_col).cast("array<double>").alias("vector"))
            .filter(F.col("id").isNotNull() & F.col("label").isNotNull()
                    & F.col("vector").isNotNull() & (norm < float(1 << 61))))


def block_count(rows: DataFrame, size: int | None = None) -> int:
    return max(1, -(-rows.count() // (size or BLOCK_ROWS)))


def blocks(rows: DataFrame, n: int, name: str) -> DataFrame:
    """``rows`` (id, label, vector) as ``n`` blocks: (``name``, n, dims, ids, labels, data).

    Within a block rows are sorted by id; of rows with one id the first by
    label and vector stays. Short vectors are filled up with zeros.
    """
    def pack(key, table):
        ids = table.column("id").to_numpy()
        labels = table.column("label").to_numpy()
        vectors = table.column("vector").combine_chunks()
        lengths = vectors.value_lengths().to_numpy()
        data = np.zeros((len(ids), int(lengths.max(initial=0))))
        flat = np.floor(256 * vectors.flatten().to_numpy())
        data[np.arange(data.shape[1])[None, :] < lengths[:, None]] = flat
        order = np.lexsort((*data.T[::-1], labels, ids))
        order = order[np.concatenate(([True], np.diff(ids[order]) != 0))]
        ids, labels, data = ids[order], labels[order], data[order]
        small = not data.size or np.abs(data).max() < 1 << 15
        data = data.astype(np.int16 if small else np.int64)
        return pa.Table.from_pydict({
            name: pa.array([key[0].as_py()], pa.int32()), "n": pa.array([len(ids)], pa.int32()),
            "dims": pa.array([data.shape[1]], pa.int32()), "ids": [ids.tobytes()],
            "labels": [labels.tobytes()], "data": [data.tobytes()]})

    return (rows.withColumn(name, F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))
            .groupBy(name).applyInArrow(pack, f"{name} int, {FIELDS}"))


def matrix(n: int, dims: int, ids: bytes, labels: bytes, data: bytes):
    """ids, labels and float64 rows of a block."""
    kind = np.int16 if len(data) == 2 * n * dims else np.int64
    return (np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64),
            np.frombuffer(data, kind).reshape(n, dims).astype(np.float64))


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fill the narrower of two sets of rows up with zeros."""
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, width - x.shape[1]))) if x.shape[1] < width else x
                 for x in (a, b))


def exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows in a type in which all their inner products are exact."""
    largest = np.max(np.sum(a * a, 1), initial=0) * np.max(np.sum(b * b, 1), initial=0)
    return (a, b) if largest < float(1 << 92) else (a.astype(np.int64), b.astype(np.int64))


def paired(left: DataFrame, right: DataFrame, n_left: int, n_right: int) -> DataFrame:
    """Every block of ``left`` (column a) beside every block of ``right`` (column b), as
    an equi-join on both numbers; other columns get the prefixes l_ and r_.

    Tasks are bound by work, not bytes, so their number is given and not left to
    the planner, which would put small blocks into one task.
    """
    tasks = max(1, min(2 * n_left * n_right, MOST_PARTITIONS))

    def side(df, own, other, n, prefix):
        return (df.select(*[F.col(c).alias(c if c == own else prefix + c) for c in df.columns])
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
                .repartition(tasks, "a", "b"))

    return side(left, "a", "b", n_right, "l_").join(side(right, "b", "a", n_left, "r_"), ["a", "b"])
