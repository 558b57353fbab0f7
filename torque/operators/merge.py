"""M1 — idempotent upsert (MERGE) with stable surrogate keys, as DataFrames.

Semantics preserved from the reference's five MERGE statements:

* match on one natural key;
* matched: every non-key column is overwritten (SCD1), ``load_ts`` refreshed,
  surrogate key kept;
* not matched: inserted with a fresh surrogate key after the current maximum;
* target rows without a source row persist (no delete clause);
* duplicate or NULL source keys are rejected before anything is written.

The target is scanned twice: two columns of it for the keys that exist and the
greatest surrogate key, and once for the update join. A source too large to
broadcast has its new keys numbered apart from its rows, so that whole rows of
source and target are shuffled once. An initial load writes its rows once before
the snapshot, in the order that numbers them.

The result is a new DataFrame (the next table snapshot); sinks write it as a
new version (``torque.sources.sinks``), never over the files being read.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from torque.operators.joins import (materialize, materialize_counted, observed, same_session,
                                    small_enough)
from torque.operators.keys import DuplicateKeyError as MergeKeyError
from torque.operators.keys import assign_surrogate_keys, check_unique

__all__ = ["MergeKeyError", "check_source_keys", "merge_upsert"]


def check_source_keys(source: DataFrame, key: str) -> None:
    """Raise if ``key`` is NULL or repeated in ``source`` (one partial aggregate)."""
    check_unique(source, key)


def merge_upsert(target: DataFrame | None, source: DataFrame, key: str, surrogate: str,
                 now: dt.datetime, check: bool = True,
                 num_partitions: int | None = None, start_key: int | None = None,
                 materialize_source: bool = True, source_rows: int | None = None,
                 version: list[str] | None = None) -> DataFrame:
    """Return ``target`` after ``MERGE ... USING source ON key``.

    ``target`` columns: surrogate, key, the source's other columns, load_ts.
    ``target=None`` is an empty table (initial load). ``start_key``: the
    largest key already used, when ``target`` is only a slice of the table.
    ``materialize_source=False`` for sources that are cheap, deterministic
    scans (dimension sources over bronze tables): they are re-read instead;
    ``source_rows`` is their row count where the caller knows it.
    ``version``: columns that order the versions of a row; a matched row is
    only overwritten by a greater version (a late or repeated change is not).
    """
    ts = F.lit(now).cast("timestamp_ntz")
    cols = [c for c in source.columns if c != key]
    if target is None:
        # the numbering cuts the source's lineage; its rows are checked there
        keyed = assign_surrogate_keys(source, surrogate, [key], start_key or 0, num_partitions)
        if check:
            check_unique(keyed, key)
        return keyed.select(surrogate, key, *cols, ts.alias("load_ts"))
    # The source feeds the key check, the update join and the anti join:
    # compute it once so none of them recomputes its lineage (for the fact:
    # the as-of link and all joins).
    rows = source_rows
    if materialize_source:
        source, rows = materialize_counted(source)
    if check:
        check_unique(source, key)
    rows = source.count() if rows is None else rows
    # An incremental source (the changes) is usually small next to the
    # target: below the broadcast limits (rows and bytes) it is broadcast into
    # one streaming pass over the target, so the target is never shuffled.
    small = small_enough(source, rows)
    # without the key check, keys of new rows may repeat and rows are numbered themselves
    whole = small or not check
    # one narrow scan of the target finds the keys that are there already and, on
    # the way, the greatest surrogate key. Metrics only reach the session that they
    # were asked for in: a stream's batch belongs to a session of its own, and
    # there the key takes a scan of one column
    seen = None
    known = target.select(key)
    if start_key is None and same_session(target, source):
        seen = Observation()
        known = target.select(surrogate, key).observe(
            seen, F.max(surrogate).alias("last")).select(key)
    if small:
        known = F.broadcast(known.join(F.broadcast(source.select(key)), key))   # <= ``rows``
    new = materialize((source if whole else source.select(key)).join(known, key, "left_anti"))
    if start_key is None:
        last = ((seen and observed(seen))
                or target.agg(F.max(surrogate).alias("last")).first().asDict())
        start_key = last["last"] or 0
    numbered = assign_surrogate_keys(new, surrogate, [key], start_key, num_partitions)
    src = source.withColumn("_matched", F.lit(True))
    if not whole:
        src = src.join(numbered.select(key, F.col(surrogate).alias("_new")), key, "left")
    t, s = target.alias("t"), (F.broadcast(src) if small else src).alias("s")
    # explicit match marker, not coalesce: a NULL in the source must
    # overwrite the target value
    hit = F.col("s._matched").isNotNull()
    if version:
        hit = hit & (F.struct(*[F.col(f"s.{c}") for c in version])
                     > F.struct(*[F.col(f"t.{c}") for c in version]))
    ids = [F.col(f"t.{surrogate}"), F.col(f"t.{key}")]
    if not whole:
        # a row of the source that meets no row of the target is inserted
        fresh = F.col("s._new").isNotNull()
        hit = fresh | hit
        ids = [F.when(fresh, F.col(f"s.{own}")).otherwise(old)
               for own, old in zip(("_new", key), ids)]
    merged = (t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "left" if whole else "full")
              .select(ids[0].alias(surrogate), ids[1].alias(key),
                      *[F.when(hit, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
                        for c in cols],
                      F.when(hit, ts).otherwise(F.col("t.load_ts")).alias("load_ts")))
    if not whole:
        return merged
    return merged.unionByName(numbered.select(surrogate, key, *cols, ts.alias("load_ts")))
