"""G1 — dense, ordered surrogate keys without a single-task window.

``row_number().over(Window.orderBy(...))`` moves every row into one task.
Instead, whatever the input's size:

1. range-partition the rows on the natural key and sort inside each
   partition; ``monotonically_increasing_id`` then encodes
   (partition id << 33) + position;
2. materialise that once (reliable checkpoint), so range sampling and ids
   are never recomputed differently by a later job or a retried task;
3. count the rows per partition with one built-in aggregate;
4. running offsets of those counts (one row per partition, a bounded
   broadcast) give key = start + offset(partition) + position + 1.

Keys are 1-step, start after ``start`` and follow the natural-key order, so
they equal ``start + row_number() OVER (ORDER BY natural key)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from torque.operators.joins import materialize

_POS_BITS = 33


class DuplicateKeyError(ValueError):
    pass


def check_unique(df: DataFrame, key: str) -> None:
    """Raise if ``key`` is NULL or repeated: one aggregation over the keys alone."""
    bad = (df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
           .filter((F.col("_n") > 1) | F.col(key).isNull()).limit(1).collect())
    if bad:
        raise DuplicateKeyError(f"NULL or repeated {key}: {bad[0][key]!r}")


def assign_surrogate_keys(df: DataFrame, key_name: str, order_cols: list[str],
                          start: int = 0, num_partitions: int | None = None) -> DataFrame:
    """Add ``key_name`` = start + rank of ``order_cols`` (dense, 1-step).

    ``num_partitions`` range partitions, by default as many as the session's
    shuffle partitions (AQE may merge neighbouring small ones; ids are read
    from the exchange output in the same job, so either is exact).
    """
    ranged = (df.repartitionByRange(num_partitions, *order_cols) if num_partitions
              else df.repartitionByRange(*order_cols))
    ranged = materialize(ranged.sortWithinPartitions(*order_cols)
                         .withColumn("_mid", F.monotonically_increasing_id()))
    part = F.shiftright(F.col("_mid"), _POS_BITS)
    # one row per partition reaches the driver; sorted there (no shuffle)
    counts = sorted((r["_pid"], r["_n"]) for r in ranged.groupBy(part.alias("_pid"))
                    .agg(F.count(F.lit(1)).alias("_n")).collect())
    offsets, running = [], start
    for pid, n in counts:
        offsets.append((pid, running))
        running += n
    off = df.sparkSession.createDataFrame(offsets or [(0, start)], "_pid long, _off long")
    position = F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    return (ranged.withColumn("_pid", part).join(F.broadcast(off), "_pid")
            .withColumn(key_name, (F.col("_off") + position + 1).cast("long"))
            .drop("_mid", "_pid", "_off"))
