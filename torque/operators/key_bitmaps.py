"""Q16 by exact bitmaps of keys: on clean data no child row leaves its map task.

The values of a foreign key and of the key it refers to are marked in bitmaps of
32,768 neighbouring keys. Where the bits of both together are no more than the
parent's own, no child row of that bucket lacks a parent, and nothing but two
bitmaps per bucket and map task has been shuffled. Only rows of the other buckets
go through the exact anti join. NULL foreign keys, and those outside the range of
the parent's keys, have no parent; they are counted and never marked.

A bitmap costs 4 kB however few keys it holds, so a parent whose keys lie far
apart (more than ``SPARSE`` values of the range per key) and keys that are not
integers take the anti join on all rows. Every way counts the same rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from torque.operators.joins import materialize, small_enough

SPARSE = 64        # values of the parent's range per key, beyond which bitmaps do not pay
SALTS = 64         # groups of map tasks whose bitmaps of a bucket are merged first

ForeignKey = tuple[str, str, str, str]


def orphans_per_value(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Per orphan ``fk`` value (NULL included): ``_n`` child rows without a parent.

    Child rows are counted per key value first — a partial aggregate that
    folds a hot or low-cardinality key (billions of sales, thousands of cars)
    to one row per map task — and only those counts meet the parent keys in
    the anti join.
    """
    keys = parent.select(F.col(pk).alias("_pk"))
    per_value = child.groupBy(F.col(fk).alias("_fk")).agg(F.count(F.lit(1)).alias("_n"))
    return per_value.join(keys, F.col("_fk") == F.col("_pk"), "left_anti")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def parent_ranges(tables: dict[str, DataFrame], foreign_keys: list[ForeignKey]) -> dict:
    """(parent, key) -> (least, greatest, number of keys), for integer keys that lie
    densely enough. One row per parent reaches the driver."""
    wanted = sorted({(p, pk) for c, fk, p, pk in foreign_keys
                     if isinstance(tables[p].schema[pk].dataType, IntegralType)
                     and isinstance(tables[c].schema[fk].dataType, IntegralType)})
    if not wanted:
        return {}
    rows = _union([tables[p].agg(F.lit(i).alias("i"), F.min(pk).cast("long").alias("low"),
                                 F.max(pk).cast("long").alias("high"), F.count(pk).alias("n"))
                   for i, (p, pk) in enumerate(wanted)]).collect()
    return {wanted[r["i"]]: (r["low"], r["high"], r["n"]) for r in rows
            if r["n"] == 0 or r["high"] - r["low"] < SPARSE * max(r["n"], 32_768)}


def _inside(column: Column, bounds: tuple) -> Column:
    low, high, n = bounds
    return F.coalesce(column.between(low, high), F.lit(False)) if n else F.lit(False)


def bucket_marks(tables: dict[str, DataFrame], foreign_keys: dict[int, ForeignKey],
                 ranges: dict) -> DataFrame:
    """(_rel, _bucket, _both, _own, _loose) per foreign key and bucket: the number of keys
    marked by child or parent, by the parent alone, and, in the row without a
    bucket, the child rows that cannot have a parent.

    Map tasks send a bitmap per bucket to one of ``SALTS`` merges, whose results meet
    in a second one: a bucket that all tasks know is not read by a single task.
    """
    frames = []
    for i, (c, fk, p, pk) in foreign_keys.items():
        for table, name, own in ((c, fk, False), (p, pk, True)):
            key = F.col(name).cast("long")
            inside = _inside(key, ranges[p, pk])
            rows = tables[table].filter(inside) if own else tables[table]
            frames.append(rows.select(
                F.lit(i).alias("_rel"), F.lit(own).alias("_parent"),
                F.when(inside, F.bitmap_bucket_number(key)).alias("_bucket"),
                F.when(inside, F.bitmap_bit_position(key)).alias("_bit")))
    salted = _union(frames).withColumn("_salt", F.spark_partition_id() % SALTS)
    parts = salted.groupBy("_rel", "_bucket", "_salt").agg(
        F.bitmap_construct_agg("_bit").alias("_both"),
        F.bitmap_construct_agg(F.when(F.col("_parent"), F.col("_bit"))).alias("_own"),
        F.count_if(F.col("_bucket").isNull()).alias("_loose"))
    return parts.groupBy("_rel", "_bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("_both")).alias("_both"),
        F.bitmap_count(F.bitmap_or_agg("_own")).alias("_own"),
        F.sum("_loose").alias("_loose"))


def orphan_counts(tables: dict[str, DataFrame],
                  foreign_keys: list[ForeignKey]) -> list[DataFrame]:
    """Per foreign key a frame of ``_n``, whose sum is the number of child rows without a
    parent (NULL counts as without). Keys may repeat on both sides."""
    ranges = parent_ranges(tables, foreign_keys)
    marked = {i: r for i, r in enumerate(foreign_keys) if (r[2], r[3]) in ranges
              and isinstance(tables[r[0]].schema[r[1]].dataType, IntegralType)}
    suspects, counts = None, {}
    if marked:
        suspects = materialize(bucket_marks(tables, marked, ranges)
                               .filter("_bucket is null or _both > _own"))
        counts = {r["_rel"]: r["n"] for r in
                  suspects.groupBy("_rel").agg(F.count("_bucket").alias("n")).collect()}
    out = []
    for i, (c, fk, p, pk) in enumerate(foreign_keys):
        if i not in marked:
            out.append(orphans_per_value(tables[c], fk, tables[p], pk).select("_n"))
            continue
        mine = suspects.filter(F.col("_rel") == i)
        loose = mine.filter("_bucket is null").select(F.col("_loose").alias("_n"))
        if not counts.get(i):
            out.append(loose)
            continue
        buckets = mine.filter("_bucket is not null").select("_bucket")
        child = tables[c].select(fk).filter(_inside(F.col(fk).cast("long"), ranges[p, pk]))
        parent = tables[p].select(pk).filter(F.col(pk).isNotNull())
        if small_enough(buckets, counts[i]):
            child, parent = (
                t.join(F.broadcast(buckets),
                       F.bitmap_bucket_number(F.col(k).cast("long")) == F.col("_bucket"), "left_semi")
                for t, k in ((child, fk), (parent, pk)))
        out.append(loose.unionByName(orphans_per_value(child, fk, parent, pk).select("_n")))
    return out
