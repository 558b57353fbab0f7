"""E1/E3 — extensions the reference names but does not implement.

E1 ``scd2_merge``: type-2 history for a dimension. A change in a tracked
column closes the current version (``valid_to`` = day before ``as_of``,
``is_current`` false) and opens a new version with a new surrogate key;
untracked columns are overwritten in place (type 1). Comparison is
column-by-column and NULL-safe (``<=>``), so no hash collision can hide a
change. ``load_scd2_buckets`` keeps the history in hash buckets of the key: a
load reads and replaces only the buckets of its keys.

``version_as_of`` looks a row's version up by date.

E3 ``merge_fact_months``: incremental fact load. Only the months a load
touches are rewritten — the months of the incoming sales plus the old months
of sales that move — in a month table (``sources/parts.py``), which switches to
them at once. ``sales_to_relink`` finds the loaded sales that late deliveries
link anew.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from torque.operators.asof import supplier_by_day
from torque.operators.joins import (broadcast_bounded, materialize, materialize_counted,
                                    small_enough)
from torque.operators.keys import assign_surrogate_keys
from torque.operators.merge import check_source_keys, merge_upsert
from torque.sources.parts import MONTH, MonthTable, PartTable, bucket_of


def _same(a: str, b: str, cols: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols],
                  F.lit(True))


def scd2_merge(history: DataFrame | None, source: DataFrame, key: str, surrogate: str,
               tracked: list[str], as_of: dt.date, now: dt.datetime,
               last: tuple[int, dt.date] | None = None,
               source_rows: int | None = None) -> DataFrame:
    """Return the history after applying ``source`` as of ``as_of``.

    A repeated load of the same day replaces the versions that day opened, in
    place. A load dated before a version that is already there is refused.
    ``last``: the greatest surrogate key and the day of the last load, if known
    (then the history is not read for them). ``source_rows``: the rows of a
    source that is materialised already.
    """
    attrs = [c for c in source.columns if c != key]
    ts = F.lit(now).cast("timestamp_ntz")
    rows = source_rows
    if rows is None:
        source, rows = materialize_counted(source)
    check_source_keys(source, key)
    # a small source (the changes) is broadcast into one pass over the history
    small = small_enough(source, rows)

    def versions(df: DataFrame, start: int) -> DataFrame:
        keyed = assign_surrogate_keys(df, surrogate, [key], start)
        return keyed.select(surrogate, key, *attrs, F.lit(as_of).alias("valid_from"),
                            F.lit(None).cast("date").alias("valid_to"),
                            F.lit(True).alias("is_current"), ts.alias("load_ts"))

    if history is None:
        return versions(source, 0)
    last_key, last_day = last or history.agg(F.max(surrogate), F.max("valid_from")).first()
    if last_day is not None and as_of < last_day:
        raise ValueError(f"load of {as_of} is older than the load of {last_day}")
    src = source.withColumn("_hit", F.lit(True))
    src = (F.broadcast(src) if small else src).alias("s")
    # every version meets its source row once; what becomes of it is decided here
    joined = history.alias("c").join(src, F.col(f"c.{key}") == F.col(f"s.{key}"), "left")
    live = F.col("c.is_current") & F.col("s._hit").isNotNull()
    changed = live & ~_same("c", "s", tracked)
    same_day = F.col("c.valid_from") == F.lit(as_of)
    fate = (F.when(~live, "keep").when(~changed, "refresh").when(same_day, "replace")
            .otherwise("close"))
    taken = lambda a: F.col("_fate").isin("replace", *([] if a in tracked else ["refresh"]))
    kept = materialize(joined.select(
        F.col(f"c.{surrogate}").alias(surrogate), F.col(f"c.{key}").alias(key),
        *[F.col(f"c.{a}").alias(a) for a in attrs], *[F.col(f"s.{a}").alias(f"_{a}") for a in attrs],
        F.col("c.valid_from").alias("valid_from"), F.col("c.valid_to").alias("valid_to"),
        F.col("c.is_current").alias("is_current"), F.col("c.load_ts").alias("load_ts"),
        F.col("s._hit").alias("_hit"), fate.alias("_fate")))
    closing = F.col("_fate") == "close"
    rewritten = kept.select(
        surrogate, key, *[F.when(taken(a), F.col(f"_{a}")).otherwise(F.col(a)).alias(a)
                          for a in attrs],
        "valid_from",
        F.when(closing, F.date_sub(F.lit(as_of), 1)).otherwise(F.col("valid_to")).alias("valid_to"),
        (F.col("is_current") & ~closing).alias("is_current"),
        F.when(F.col("_fate") == "keep", F.col("load_ts")).otherwise(ts).alias("load_ts"))
    # a source row opens a version unless its key has a current version that stays
    settled = kept.filter("_hit AND is_current AND _fate <> 'close'").select(key)
    opened = source.join(F.broadcast(settled) if small else settled, key, "left_anti")
    return rewritten.unionByName(versions(opened, last_key or 0))


def load_scd2_buckets(table: PartTable, source: DataFrame, key: str, tracked: list[str],
                      as_of: dt.date, now: dt.datetime, buckets: int = 64) -> list[int]:
    """E1 into hash buckets: apply ``source`` as of ``as_of`` to the history in ``table``,
    whose ``key`` names the surrogate key. Returns the replaced buckets.

    All versions of a key lie in its bucket, so a load reads and replaces the buckets of
    the keys it brings; the greatest surrogate key and the day of the last load are in
    the manifest and committed with the rows. A load without rows changes nothing. The
    number of buckets is fixed when the table is first written.
    """
    state = table.manifest()
    if state is not None and buckets != state["note"]["buckets"]:
        raise ValueError(f"the table has {state['note']['buckets']} buckets")
    source, rows = materialize_counted(source.withColumn(table.column, bucket_of(key, buckets)))
    touched = sorted(r[0] for r in source.select(table.column).distinct().collect())
    source = source.drop(table.column)
    history, last = None, None
    if state is not None:
        last = state["last_key"], dt.date.fromisoformat(state["note"]["as_of"])
        if not touched:
            return []
        history = table.read(touched).drop(table.column)
    merged = scd2_merge(history, source, key, table.key, tracked, as_of, now, last=last,
                        source_rows=rows)
    table.write(merged.withColumn(table.column, bucket_of(key, buckets)),
                None if state is None else touched,
                note={"as_of": as_of.isoformat(), "buckets": buckets})
    return touched


def sale_month(time_id: Column) -> Column:
    return (time_id / 100).cast("int")


def merge_fact_months(table: MonthTable, source: DataFrame, now: dt.datetime) -> list[int]:
    """E3 — MERGE ``source`` (fact rows without sale_key/load_ts) into a month table,
    rewriting only the touched months. Returns the rewritten months.

    New rows are numbered after the greatest key of the table's manifest, so the
    table is scanned for nothing but the old months of the incoming sales. The
    touched-month list has one entry per calendar month (bounded), so it is
    collected; all row work stays on the executors. Rows without a time_id are
    refused before anything is written.
    """
    source, rows = materialize_counted(
        source.withColumn(MONTH, sale_month(F.col("time_id"))))
    ids = source.select("sale_id")
    moved = table.read().select("sale_id", MONTH).join(
        F.broadcast(ids) if small_enough(ids, rows) else ids, "sale_id").select(MONTH)
    months = [r[0] for r in source.select(MONTH).union(moved).distinct().collect()]
    if None in months:
        raise ValueError("a fact row has no time_id")
    # every matched row's old month is in ``months``, so the touched
    # partitions hold all rows the MERGE can change
    merged = merge_upsert(table.read(months).drop(MONTH), source.drop(MONTH), "sale_id", "sale_key",
                          now, start_key=table.manifest()["last_key"], materialize_source=False,
                          source_rows=rows)
    table.write(merged.withColumn(MONTH, sale_month(F.col("time_id"))), months)
    return sorted(months)


def relinked_days(before: DataFrame, after: DataFrame, sale_days: DataFrame) -> DataFrame:
    """(day) of the sale days whose latest supplier differs between two states of the
    deliveries. One row per date at most, as in the as-of link itself."""
    old = supplier_by_day(before, sale_days).select("day", F.col("supplier_id").alias("_before"))
    new = supplier_by_day(after, sale_days).select("day", "supplier_id")
    return (new.join(old, "day", "left")
            .filter(~F.col("supplier_id").eqNullSafe(F.col("_before"))).select("day"))


def sales_to_relink(sales: DataFrame, before: DataFrame, after: DataFrame,
                    dates: DataFrame | None = None) -> DataFrame:
    """The sales whose as-of supplier a late batch of deliveries changes: a delivery
    dated d moves the sales from d up to the next delivery day, whatever was loaded
    since. ``dates``: where to take the sale days from, if they are cheaper there."""
    days = ((sales if dates is None else dates).filter(F.col("sale_date").isNotNull())
            .select("sale_date").distinct())
    changed = relinked_days(before, after, days).withColumnRenamed("day", "_day")
    return sales.join(broadcast_bounded(changed), F.col("sale_date") == F.col("_day"), "left_semi")


def version_as_of(rows: DataFrame, key: str, day: str, history: DataFrame,
                  columns: list[str]) -> DataFrame:
    """``rows`` with the ``columns`` of the type-2 version of ``key`` that was valid on
    ``day``, and ``in_history``: false where the day lies before the key's first version,
    which then stands in. Rows whose key or day is NULL, or whose key has no
    history, drop (an inner join, like the other keys of the fact).

    A key's versions (one per load at most) travel as one sorted array, so this
    is an equi-join with one row per key: there is no range join, and a key with
    many rows is split by AQE like in any other shuffle join.
    """
    versions = (history.groupBy(key).agg(F.sort_array(F.collect_list(
        F.struct("valid_from", "valid_to", *columns))).alias("_versions")))
    on = F.col(day)
    valid = F.filter("_versions", lambda v: (v["valid_from"] <= on)
                     & (v["valid_to"].isNull() | (v["valid_to"] >= on)))
    first = F.col("_versions")[0]
    return (rows.filter(on.isNotNull()).join(versions, key)
            .withColumn("in_history", F.col("_versions")[0]["valid_from"] <= on)
            .withColumn("_version", F.when(F.col("in_history"), F.get(valid, F.lit(0)))
                        .otherwise(first))
            .select(*rows.columns, "in_history", *[F.col("_version")[c].alias(c) for c in columns]))
