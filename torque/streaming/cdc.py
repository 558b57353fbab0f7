"""E2 — change-driven loads with Structured Streaming.

A change feed (files of row versions) is read with ``readStream``; every
micro-batch keeps the latest version per key (partially aggregated, so a hot
key costs one row per task before the shuffle) and MERGEs it into the target
table, which is written as a new snapshot version. The target keeps the
version columns, and a row is only overwritten by a greater version, so late
and repeated changes do no harm in any order of batches. The batch id of
every applied batch is recorded in a commit table next to the target, so a
batch replayed after a failure is usually skipped; if the failure fell
between the two writes, applying it again changes nothing. Old snapshots are
expired after each batch.

With a ``PartTable`` as target the rows lie in buckets by a hash of the key: a
batch reads and replaces only the buckets of its keys, and its id is committed
with them in one manifest, so it is applied once or not at all.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from torque.operators.joins import materialize_counted
from torque.operators.merge import merge_upsert
from torque.sources.parts import PartTable, bucket_of
from torque.sources.sinks import SnapshotStore


def latest_per_key(changes: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """One row per ``key``: the version with the greatest (order_cols...)."""
    cols = [c for c in changes.columns]
    best = F.max_by(F.struct(*cols), F.struct(*order_cols))
    return changes.groupBy(key).agg(best.alias("_v")).select(*[F.col(f"_v.{c}").alias(c) for c in cols])


def _applied(store: SnapshotStore, table: str) -> int:
    commits = store.read_or_none(f"{table}__commits")
    if commits is None:
        return -1
    v = commits.agg(F.max("batch_id")).first()[0]
    return -1 if v is None else v


def apply_batch(spark: SparkSession, store: SnapshotStore, table: str, batch: DataFrame,
                batch_id: int, key: str, order_cols: list[str], surrogate: str,
                now: dt.datetime | None = None) -> bool:
    """MERGE one micro-batch; returns False when the batch was already applied."""
    if batch_id <= _applied(store, table):
        return False
    latest = latest_per_key(batch, key, order_cols)
    merged = merge_upsert(store.read_or_none(table), latest, key, surrogate,
                          now or dt.datetime.now(), version=order_cols)
    store.write(table, merged)
    store.write(f"{table}__commits",
                spark.range(1).select(F.lit(batch_id).cast("long").alias("batch_id")))
    for name in (table, f"{table}__commits"):
        store.expire(name, keep=2)
    return True


def apply_batch_to_buckets(table: PartTable, batch: DataFrame, batch_id: int, key: str,
                           order_cols: list[str], buckets: int,
                           now: dt.datetime | None = None) -> list[int]:
    """MERGE one micro-batch into the buckets of its keys; returns these buckets (none
    when the batch was already applied). The number of buckets is fixed when the
    table is first written; their list is bounded and comes to the driver."""
    state = table.manifest()
    if state is not None and batch_id <= state["note"]["batch_id"]:
        return []
    if state is not None and buckets != state["note"]["buckets"]:
        raise ValueError(f"the table has {state['note']['buckets']} buckets")
    source, rows = materialize_counted(
        latest_per_key(batch, key, order_cols).withColumn(table.column, bucket_of(key, buckets)))
    touched = sorted(r[0] for r in source.select(table.column).distinct().collect())
    target = None if state is None else table.read(touched).drop(table.column)
    merged = merge_upsert(target, source.drop(table.column), key, table.key,
                          now or dt.datetime.now(), materialize_source=False, source_rows=rows,
                          start_key=state["last_key"] if state else 0, version=order_cols)
    table.write(merged.withColumn(table.column, bucket_of(key, buckets)), touched,
                note={"batch_id": batch_id, "buckets": buckets})
    table.expire(keep=2)
    return touched


def run_change_feed(spark: SparkSession, source_path: str, schema: StructType,
                    store: SnapshotStore | PartTable, table: str | None, key: str,
                    order_cols: list[str], surrogate: str, checkpoint_location: str,
                    now: dt.datetime | None = None, max_files_per_trigger: int | None = None,
                    buckets: int = 64):
    """Process every change file available now, then stop (``availableNow``). The target
    is ``table`` in a snapshot store, or a ``PartTable`` of ``buckets`` buckets."""
    def apply(df: DataFrame, batch_id: int) -> None:
        if isinstance(store, PartTable):
            apply_batch_to_buckets(store, df, batch_id, key, order_cols, buckets, now)
        else:
            apply_batch(spark, store, table, df, batch_id, key, order_cols, surrogate, now)

    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_path)
    query = (stream.writeStream
             .foreachBatch(apply)
             .option("checkpointLocation", checkpoint_location)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    return query
