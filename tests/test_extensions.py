"""Extensions E1 (SCD2), E2 (streaming change feed), E3 (incremental fact months)."""

from __future__ import annotations

import datetime as dt
import os
import random
import tempfile
from decimal import Decimal as Dec

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)

from tests.fixtures import plan_of, rows_of
from torque.operators import partials, reports
from torque.operators.history import (load_scd2_buckets, merge_fact_months, sales_to_relink,
                                      scd2_merge, version_as_of)
from torque.operators.joins import materialize
from torque.operators.partials import refresh_partials
from torque.plans.warehouse import (build_silver, load_fact_incremental, load_gold,
                                    load_late_deliveries, write_fact_by_month)
from torque.sources.bindings import Sources
from torque.sources.parts import MonthTable, PartTable
from torque.sources.sinks import SnapshotStore
from torque.streaming.cdc import (apply_batch, apply_batch_to_buckets, latest_per_key,
                                  run_change_feed)

NOW = dt.datetime(2024, 1, 1)


def test_scd2_closes_and_opens_versions(spark):
    src1 = spark.createDataFrame([(1, "Ana", "Madrid"), (2, "Bo", "Girona")],
                                 "id long, name string, city string")
    h1 = scd2_merge(None, src1, "id", "k", ["city"], dt.date(2024, 1, 1), NOW)
    # id 1 moves (tracked), id 2 renames (untracked, type 1), id 3 is new
    src2 = spark.createDataFrame([(1, "Ana", "Bilbao"), (2, "Bob", "Girona"), (3, "Cy", None)],
                                 "id long, name string, city string")
    h2 = scd2_merge(h1, src2, "id", "k", ["city"], dt.date(2024, 6, 1), NOW)
    assert rows_of(h2, "k", "id", "name", "city", "valid_from", "valid_to", "is_current") == [
        (1, 1, "Ana", "Madrid", dt.date(2024, 1, 1), dt.date(2024, 5, 31), False),
        (2, 2, "Bob", "Girona", dt.date(2024, 1, 1), None, True),
        (3, 1, "Ana", "Bilbao", dt.date(2024, 6, 1), None, True),
        (4, 3, "Cy", None, dt.date(2024, 6, 1), None, True)]
    # a NULL -> NULL tracked value is not a change (NULL-safe comparison)
    h3 = scd2_merge(h2, src2, "id", "k", ["city"], dt.date(2024, 7, 1), NOW)
    assert h3.count() == 4


SCHEMA = StructType([StructField("event_id", LongType()), StructField("ts", TimestampNTZType()),
                     StructField("user_id", LongType()), StructField("event_type", StringType()),
                     StructField("value", DoubleType())])


def _ts(h):
    return dt.datetime(2024, 1, 1, h)


def test_change_feed_latest_version_and_replay(spark):
    src_dir = tempfile.mkdtemp(prefix="torque-feed-")
    store = SnapshotStore(spark, tempfile.mkdtemp(prefix="torque-cdc-wh-"))
    ckpt = tempfile.mkdtemp(prefix="torque-cdc-ckpt-")
    batch1 = [(1, _ts(1), 10, "view", 1.0), (2, _ts(2), 10, "click", 2.0), (3, _ts(1), 20, "view", 3.0)]
    spark.createDataFrame(batch1, SCHEMA).coalesce(1).write.parquet(f"{src_dir}/b1")
    run_change_feed(spark, f"{src_dir}/*", SCHEMA, store, "latest", "user_id", ["ts", "event_id"],
                    "user_key", ckpt, NOW)
    assert rows_of(store.read("latest"), "user_id", "user_key", "event_id") == [(10, 1, 2), (20, 2, 3)]
    batch2 = [(4, _ts(3), 10, "buy", 4.0), (5, _ts(1), 30, "view", 5.0)]
    spark.createDataFrame(batch2, SCHEMA).coalesce(1).write.parquet(f"{src_dir}/b2")
    run_change_feed(spark, f"{src_dir}/*", SCHEMA, store, "latest", "user_id", ["ts", "event_id"],
                    "user_key", ckpt, NOW)
    assert rows_of(store.read("latest"), "user_id", "user_key", "event_id") == \
        [(10, 1, 4), (20, 2, 3), (30, 3, 5)]
    # replaying an applied batch id changes nothing
    assert not apply_batch(spark, store, "latest", spark.createDataFrame(batch1, SCHEMA), 0,
                           "user_id", ["ts", "event_id"], "user_key", NOW)


def test_change_feed_into_buckets(spark, monkeypatch):
    """A batch reads and replaces the buckets of its keys only, once or not at all."""
    table = PartTable(spark, tempfile.mkdtemp(prefix="torque-cdc-buckets-") + "/t", "bucket", "k")
    order = ["ts", "event_id"]
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    first = frame([(i, _ts(1), i, "a", 1.0) for i in range(100)] + [(200, _ts(0), 5, "old", 0.0)])
    assert apply_batch_to_buckets(table, first, 0, "user_id", order, 8, NOW) == list(range(8))
    versions = table.manifest()["parts"]
    read = []
    monkeypatch.setattr(table, "read", lambda parts=None, real=table.read: read.append(parts)
                        or real(parts))
    change = frame([(300, _ts(2), 5, "b", 2.0), (301, _ts(0), 6, "late", 3.0),
                    (302, _ts(1), 1000, "new", 4.0)])
    touched = apply_batch_to_buckets(table, change, 1, "user_id", order, 8, NOW)
    assert 1 <= len(touched) <= 3 and read == [touched]
    now = table.manifest()
    assert {p for p in versions if now["parts"][p] != versions[p]} == set(touched)
    out = rows_of(table.read().filter("user_id in (5, 6, 1000)"), "user_id", "k", "event_type")
    assert out == [(5, 6, "b"), (6, 7, "a"), (1000, 101, "new")]
    assert table.read().count() == 101 and now["note"] == {"batch_id": 1, "buckets": 8}
    # a batch that was applied is skipped, whatever it holds
    assert apply_batch_to_buckets(table, first, 1, "user_id", order, 8, NOW) == []
    # one that dies before its manifest is applied in full when it comes again
    more = frame([(400, _ts(3), 7, "c", 5.0)])
    with monkeypatch.context() as patch:
        patch.setattr(PartTable, "_commit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            apply_batch_to_buckets(table, more, 2, "user_id", order, 8, NOW)
    assert table.read().filter("event_type = 'c'").count() == 0
    assert apply_batch_to_buckets(table, more, 2, "user_id", order, 8, NOW) != []
    assert rows_of(table.read().filter("user_id = 7"), "event_type") == [("c",)]
    with pytest.raises(ValueError):
        apply_batch_to_buckets(table, more, 3, "user_id", order, 9, NOW)


def test_late_batch_does_not_overwrite(spark):
    store = SnapshotStore(spark, tempfile.mkdtemp(prefix="torque-cdc-late-"))
    for batch_id, row in enumerate([(2, _ts(5), 10, "b", 2.0), (1, _ts(1), 10, "a", 1.0)]):
        apply_batch(spark, store, "t", spark.createDataFrame([row], SCHEMA), batch_id, "user_id",
                    ["ts", "event_id"], "k", NOW)
    assert rows_of(store.read("t"), "user_id", "event_id") == [(10, 2)]


def test_scd2_same_day_load_replaces_and_older_load_is_refused(spark):
    rows = lambda v: spark.createDataFrame(v, "id long, city string")
    day = dt.date(2024, 6, 1)
    h = scd2_merge(None, rows([(1, "A"), (2, "B")]), "id", "k", ["city"], dt.date(2024, 1, 1), NOW)
    h = scd2_merge(h, rows([(1, "C"), (2, "B")]), "id", "k", ["city"], day, NOW)
    h = scd2_merge(h, rows([(1, "D"), (2, "E")]), "id", "k", ["city"], day, NOW)
    assert rows_of(h, "k", "id", "city", "valid_from", "valid_to") == [
        (1, 1, "A", dt.date(2024, 1, 1), dt.date(2024, 5, 31)),
        (2, 2, "B", dt.date(2024, 1, 1), dt.date(2024, 5, 31)),
        (3, 1, "D", day, None), (4, 2, "E", day, None)]
    with pytest.raises(ValueError):
        scd2_merge(h, rows([(1, "F")]), "id", "k", ["city"], dt.date(2024, 5, 1), NOW)


def bucket_files(table):
    """Names and times of the files of every bucket."""
    out = {}
    for part, version in table.manifest()["parts"].items():
        folder = f"{table.root}/data/v={version}/{table.column}={part}"
        out[part] = {f: os.stat(f"{folder}/{f}").st_mtime_ns for f in os.listdir(folder)}
    return out


def history_table(spark):
    return PartTable(spark, tempfile.mkdtemp(prefix="torque-scd2-") + "/t", "bucket", "k")


HISTORY = ["k", "id", "city", "name", "valid_from", "valid_to", "is_current", "load_ts"]


def test_scd2_in_buckets_equals_the_whole_history(spark):
    """Loads of many, few, repeated and no rows; buckets of other keys keep their files."""
    frame = lambda rows: spark.createDataFrame(rows, "id long, city string, name string")
    day = lambda m: dt.date(2024, m, 1)
    loads = [(frame([(i, f"c{i % 5}", f"n{i}") for i in range(60)]), day(1)),
             (frame([(7, "moved", "n7"), (8, "c3", "renamed"), (900, None, "new")]), day(3)),
             (frame([(7, "moved", "n7"), (8, "c3", "renamed"), (900, None, "new")]), day(3)),
             (frame([(7, "again", "n7"), (9, "moved", None)]), day(3)),
             (frame([]), day(4)),
             (frame([(900, "known", "new")]), day(5))]
    table, whole = history_table(spark), None
    for source, at in loads:
        before = bucket_files(table) if table.manifest() else {}
        touched = load_scd2_buckets(table, source, "id", ["city"], at, NOW, buckets=8)
        whole = materialize(scd2_merge(whole, source, "id", "k", ["city"], at, NOW))
        assert rows_of(table.read(), *HISTORY) == rows_of(whole, *HISTORY)
        assert all(bucket_files(table)[b] == f for b, f in before.items() if b not in touched)
        assert touched == sorted({r[0] for r in source.select(
            F.pmod(F.xxhash64("id"), F.lit(8))).collect()})
    with pytest.raises(ValueError):
        load_scd2_buckets(table, frame([(1, "x", "y")]), "id", ["city"], day(4), NOW, buckets=8)
    with pytest.raises(ValueError):
        load_scd2_buckets(table, frame([(1, "x", "y")]), "id", ["city"], day(6), NOW, buckets=4)


def test_scd2_load_into_buckets_reads_only_them_and_survives_a_crash(spark, monkeypatch):
    frame = lambda rows: spark.createDataFrame(rows, "id long, city string")
    table, cols = history_table(spark), [c for c in HISTORY if c != "name"]
    load_scd2_buckets(table, frame([(i, "a") for i in range(40)]), "id", ["city"],
                      dt.date(2024, 1, 1), NOW, buckets=8)
    old, read = rows_of(table.read(), *cols), []
    change, day = frame([(3, "b"), (77, "c")]), dt.date(2024, 2, 1)

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(table, "_commit", dies)
        m.setattr(table, "read", lambda parts=None, real=table.read: read.append(parts) or real(parts))
        with pytest.raises(RuntimeError):
            load_scd2_buckets(table, change, "id", ["city"], day, NOW, buckets=8)
    assert rows_of(table.read(), *cols) == old
    touched = load_scd2_buckets(table, change, "id", ["city"], day, NOW, buckets=8)
    assert read == [touched] and len(touched) <= 2
    assert rows_of(table.read().filter("id in (3, 77)"), "k", "id", "city", "is_current") == [
        (4, 3, "a", False), (41, 3, "b", True), (42, 77, "c", True)]


def test_latest_per_key_ties_broken_by_event_id(spark):
    df = spark.createDataFrame([(1, _ts(1), 10, "a", 1.0), (2, _ts(1), 10, "b", 1.0)], SCHEMA)
    assert rows_of(latest_per_key(df, "user_id", ["ts", "event_id"]), "event_id") == [(2,)]


# ---- E3: month table -------------------------------------------------------------------
def month_table(fact):
    return write_fact_by_month(fact, tempfile.mkdtemp(prefix="torque-fact-") + "/fact")


def files(table, month):
    version = table.manifest()["parts"][month]
    folder = f"{table.root}/data/v={version}/sale_month={month}"
    return {f"{folder}/{f}": os.stat(f"{folder}/{f}").st_mtime_ns for f in os.listdir(folder)}


def fact_rows(fact):
    """Source rows of a fact: what a load brings."""
    return fact.select(*[c for c in fact.columns if c not in ("sale_key", "load_ts")])


def two_month_change(gold):
    """Sale 6 moves from April to July, sale 11 is new in August."""
    fact = gold.fact_sales
    moved = fact_rows(fact.filter("sale_id = 6")).withColumn("time_id", F.lit(20230715))
    new = (fact_rows(fact.filter("sale_id = 10"))
           .withColumn("sale_id", F.lit(11).cast("long")).withColumn("time_id", F.lit(20230801)))
    return moved.unionByName(new)


def test_incremental_fact_rewrites_only_touched_months(spark, gold):
    table = month_table(gold.fact_sales)
    before = {m: files(table, m) for m in table.manifest()["parts"]}
    months = merge_fact_months(table, two_month_change(gold), NOW)
    assert months == [202304, 202307, 202308]
    held = table.manifest()["parts"]
    assert 202304 not in held                              # emptied by the moved sale
    for month in set(before) - set(months):
        assert files(table, month) == before[month]
    out = table.read()
    assert rows_of(out.filter("sale_id in (6, 11)"), "sale_id", "sale_key", "sale_month") == \
        [(6, 4, 202307), (11, 7, 202308)]
    assert out.count() == gold.fact_sales.count() + 1
    assert out.filter("sale_id = 2").first().sale_price == Dec("500.00")
    assert table.manifest()["last_key"] == 7
    # rows that are gone keep their number: the next key follows the greatest ever given
    table.write(table.read([202307]), [202307, 202308])
    late = fact_rows(gold.fact_sales.filter("sale_id = 10")).withColumn(
        "sale_id", F.lit(12).cast("long"))
    merge_fact_months(table, late, NOW)
    assert rows_of(table.read().filter("sale_id = 12"), "sale_key") == [(8,)]


def test_a_load_that_dies_changes_nothing(spark, gold, monkeypatch):
    """Between the write of the months and the manifest readers see the old table,
    and the load can be repeated."""
    table = month_table(gold.fact_sales)
    old = rows_of(table.read(), "sale_key", "sale_id", "time_id")
    with monkeypatch.context() as patch:
        patch.setattr(MonthTable, "_commit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            merge_fact_months(table, two_month_change(gold), NOW)
    assert rows_of(table.read(), "sale_key", "sale_id", "time_id") == old
    merge_fact_months(table, two_month_change(gold), NOW)
    assert table.read().count() == len(old) + 1
    # what the dead load left goes with the versions that no manifest names
    stray = set(table._versions()) - set(table.manifest()["parts"].values())
    assert stray and set(table.expire(keep=1)) == stray
    assert table.read().count() == len(old) + 1


def test_two_loads_at_once_are_noticed(spark, gold):
    table = month_table(gold.fact_sales)
    state = table.manifest()
    table._commit(state["number"] + 1, {k: state[k] for k in ("schema", "parts", "last_key")})
    with pytest.raises(RuntimeError):
        table._commit(state["number"] + 1, {})


def test_undated_rows_and_strange_months_are_refused(spark, gold):
    table = month_table(gold.fact_sales)
    old = table.manifest()
    undated = two_month_change(gold).withColumn("time_id", F.lit(None).cast("int"))
    with pytest.raises(ValueError):
        merge_fact_months(table, undated, NOW)
    with pytest.raises(ValueError):
        table.write(table.read(), [202304])
    assert table.manifest() == old
    empty = month_table(gold.fact_sales.limit(0))
    assert empty.read().count() == 0 and "sale_month" in empty.read().columns


def test_incremental_fact_load_matches_full_merge(spark, clean, cfg, gold):
    """A second load of changed sales through the month table gives the same fact as
    a full MERGE."""
    table = month_table(gold.fact_sales)
    changed = clean.sales.withColumn(
        "sale_date", F.when(F.col("sale_id") == 3, F.lit(dt.date(2023, 9, 9)))
        .otherwise(F.col("sale_date")))
    silver2 = build_silver(Sources(**{**clean.as_dict(), "sales": changed}))
    months = load_fact_incremental(table, silver2, gold, NOW)
    assert 202302 in months and 202309 in months
    full = load_gold(spark, silver2, cfg, current=gold).fact_sales
    cols = ["sale_key", "sale_id", "time_id", "supplier_key", "gross_margin_pct"]
    assert rows_of(table.read(), *cols) == rows_of(full, *cols)


# ---- E3: late deliveries ------------------------------------------------------------------
@pytest.mark.parametrize("seed", range(4))
def test_relinked_days_are_those_whose_supplier_changes(spark, seed):
    rnd = random.Random(seed)
    day = lambda n: dt.date(2023, 1, 1) + dt.timedelta(days=n)
    deliveries = [(i, rnd.randint(1, 3), day(rnd.randint(0, 40))) for i in range(12)]
    early = [d for d in deliveries if rnd.random() < 0.6]
    sales = [(i, day(rnd.randint(-2, 45))) for i in range(40)] + [(99, None)]

    def link(have, d):
        have = [x for x in have if x[2] <= d]
        return max(have, key=lambda x: (x[2], x[0]))[1] if have else None

    frame = lambda rows: spark.createDataFrame(
        rows, "delivery_id long, supplier_id long, delivery_date date")
    got = sales_to_relink(spark.createDataFrame(sales, "sale_id long, sale_date date"),
                          frame(early), frame(deliveries))
    want = [s for s, d in sales if d and link(early, d) != link(deliveries, d)]
    assert [r[0] for r in rows_of(got, "sale_id")] == sorted(want)


def test_late_deliveries_touch_only_their_months(spark, clean, cfg, gold):
    """A fact linked without the last delivery, brought up to date when it comes."""
    silver = build_silver(clean)
    last = silver.final_delivery.agg(F.max("delivery_date")).first()[0]
    before = silver.final_delivery.filter(F.col("delivery_date") < F.lit(last))
    first = load_gold(spark, build_silver(Sources(**{
        **clean.as_dict(), "final_delivery": clean.final_delivery.filter(
            F.col("delivery_date") < F.lit(last))})), cfg)
    table = month_table(first.fact_sales)
    old = {m: files(table, m) for m in table.manifest()["parts"]}
    months = load_late_deliveries(table, silver, before, gold, NOW)
    since = last.year * 100 + last.month
    assert months and all(m >= since for m in months)
    for month in set(old) - set(months):
        assert files(table, month) == old[month]
    cols = ["sale_id", "time_id", "supplier_key", "gross_margin"]
    assert rows_of(table.read(), *cols) == rows_of(gold.fact_sales, *cols)
    # nothing comes: nothing is written
    assert load_late_deliveries(table, silver, silver.final_delivery, gold, NOW) == []


# ---- E3: partial aggregates ----------------------------------------------------------------
def test_partials_are_shuffled_once(spark, gold, monkeypatch):
    """The aggregation's shuffle is the only one: its rows are written as they lie."""
    table = month_table(gold.fact_sales)
    kept = MonthTable(spark, table.root + "-once", key=None)
    hints = []
    kind = type(gold.fact_sales)
    real = kind.hint
    monkeypatch.setattr(kind, "hint", lambda df, name, *a: hints.append(name) or real(df, name, *a))
    assert refresh_partials(kept, table)
    assert "rebalance" not in hints
    want = partials.month_partials(table.read())
    assert rows_of(kept.read(), *want.columns) == rows_of(want, *want.columns)


def test_partials_follow_the_fact(spark, gold):
    table = month_table(gold.fact_sales)
    kept = MonthTable(spark, table.root + "-partials", key=None)
    assert refresh_partials(kept, table) == sorted(table.manifest()["parts"])
    assert refresh_partials(kept, table) == []
    old = {m: files(kept, m) for m in kept.manifest()["parts"]}
    months = merge_fact_months(table, two_month_change(gold), NOW)
    assert refresh_partials(kept, table) == months
    for month in set(old) - set(months):
        assert files(kept, month) == old[month]
    fact, rows = table.read(), kept.read()
    for got, want in (
            (partials.revenue_by_brand(rows, gold.dim_car, gold.dim_time),
             reports.rpt_revenue_by_brand(fact, gold.dim_car, gold.dim_time)),
            (partials.model_profitability(rows, gold.dim_car),
             reports.rpt_model_profitability(fact, gold.dim_car)),
            (partials.supplier_performance(rows, gold.dim_supplier, gold.dim_time),
             reports.rpt_supplier_performance(fact, gold.dim_supplier, gold.dim_time)),
            (partials.monthly_trend(rows, gold.dim_time),
             reports.rpt_monthly_trend(fact, gold.dim_time))):
        assert got.dtypes == want.dtypes
        assert rows_of(got, *want.columns) == rows_of(want, *want.columns)
    with pytest.raises(ValueError):
        partials.monthly_trend(rows, gold.dim_time.filter("time_id > 20230105"))


# ---- E1: version as of a day ---------------------------------------------------------------
def test_version_as_of_a_day(spark):
    day = dt.date
    history = None
    for rows, at in (([(1, "A"), (2, "B"), (4, None)], day(2023, 3, 1)),
                     ([(1, "C"), (2, "B"), (4, "D")], day(2023, 6, 1)),
                     ([(1, "E")], day(2023, 6, 2))):
        history = materialize(scd2_merge(history, spark.createDataFrame(rows, "id long, city string"),
                                         "id", "k", ["city"], at, NOW))
    facts = [(10, 1, day(2023, 1, 1)), (11, 1, day(2023, 3, 1)), (12, 1, day(2023, 5, 31)),
             (13, 1, day(2023, 6, 1)), (14, 1, day(2023, 6, 2)), (15, 1, day(2030, 1, 1)),
             (16, 2, day(2023, 6, 1)), (17, 3, day(2023, 6, 1)), (18, None, day(2023, 6, 1)),
             (19, 1, None), (20, 4, day(2023, 4, 1)), (21, 4, day(2023, 7, 1))]
    out = version_as_of(spark.createDataFrame(facts, "sale long, id long, on date"), "id", "on",
                        history, ["k", "city"])
    assert rows_of(out, "sale", "city", "in_history") == [
        (10, "A", False), (11, "A", True), (12, "A", True), (13, "C", True), (14, "E", True),
        (15, "E", True), (16, "B", True), (20, None, True), (21, "D", True)]
    plan = plan_of(out)
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Window" not in plan


def test_scd2_broadcast_and_shuffle_paths_agree(spark):
    hist = scd2_merge(None, spark.range(0, 500).select(
        F.col("id"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"),
        (F.col("id") % 7).cast("string").alias("city")), "id", "k", ["city"], dt.date(2024, 1, 1), NOW)
    changes = spark.createDataFrame([(3, "n3", "moved"), (4, "renamed", "4"), (900, "new", "x")],
                                    "id long, name string, city string")
    cols = ["k", "id", "name", "city", "valid_from", "valid_to", "is_current"]
    small = rows_of(scd2_merge(hist, changes, "id", "k", ["city"], dt.date(2024, 6, 1), NOW), *cols)
    old = spark.conf.get("torque.broadcast.maxRows", None)
    try:
        spark.conf.set("torque.broadcast.maxRows", "0")
        big = rows_of(scd2_merge(hist, changes, "id", "k", ["city"], dt.date(2024, 6, 1), NOW), *cols)
    finally:
        if old is None:
            spark.conf.unset("torque.broadcast.maxRows")
        else:
            spark.conf.set("torque.broadcast.maxRows", old)
    assert small == big and len(small) == 502          # 500 + new version of 3 + new key 900
