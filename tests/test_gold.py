"""Keys (G1), MERGE (M1), as-of link (F2), dimensions and the fact (D2-D5, F1/F3)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as Dec

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.fixtures import fixture_config, plan_of, rows_of
from torque.operators import dims, staging
from torque.operators.asof import supplier_as_of
from torque.operators.fact import fact_source, load_fact
from torque.operators.keys import assign_surrogate_keys
from torque.operators.merge import MergeKeyError, merge_upsert

NOW1 = dt.datetime(2024, 1, 1, 8, 0)
NOW2 = dt.datetime(2024, 2, 1, 8, 0)


def test_surrogate_keys_equal_row_number_any_partitioning(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 100003).alias("nk"), "id")
    expected = df.select("nk", F.row_number().over(Window.orderBy("nk")).alias("k"))
    for parts in (1, 3, 17):
        got = assign_surrogate_keys(df.repartition(parts), "k", ["nk"], start=0, num_partitions=parts)
        assert rows_of(got, "nk", "k") == rows_of(expected, "nk", "k")
    shifted = assign_surrogate_keys(df, "k", ["nk"], start=100)
    assert shifted.agg(F.min("k"), F.max("k")).first() == (101, 5100)


def _src(spark, rows):
    return spark.createDataFrame(rows, "id long, name string, city string")


def test_merge_insert_update_null_overwrite_and_persist(spark):
    load1 = _src(spark, [(2, "b", "x"), (4, "d", "y"), (6, "f", "z")])
    t1 = merge_upsert(None, load1, "id", "k", NOW1)
    assert rows_of(t1, "k", "id", "name") == [(1, 2, "b"), (2, 4, "d"), (3, 6, "f")]
    # changed (2), NULL-overwrite (4.city), new (1, 9), missing (6 persists)
    load2 = _src(spark, [(2, "B", "x"), (4, "d", None), (9, "i", "q"), (1, "a", "p")])
    t2 = merge_upsert(t1, load2, "id", "k", NOW2)
    assert rows_of(t2, "id", "k", "name", "city") == [
        (1, 4, "a", "p"), (2, 1, "B", "x"), (4, 2, "d", None), (6, 3, "f", "z"), (9, 5, "i", "q")]
    ts = {r.id: r.load_ts for r in t2.collect()}
    assert ts[6] == NOW1 and ts[2] == NOW2 and ts[9] == NOW2
    # idempotent: the same load again changes only load_ts
    t3 = merge_upsert(t2, load2, "id", "k", NOW2)
    assert rows_of(t3, "id", "k", "name", "city") == rows_of(t2, "id", "k", "name", "city")


def test_merge_rejects_duplicate_or_null_keys(spark):
    with pytest.raises(MergeKeyError):
        merge_upsert(None, _src(spark, [(1, "a", None), (1, "b", None)]), "id", "k", NOW1)
    with pytest.raises(MergeKeyError):
        merge_upsert(None, _src(spark, [(None, "a", None)]), "id", "k", NOW1)


def test_supplier_as_of_rules(spark, clean):
    linked = supplier_as_of(staging.stg_sales(clean.sales, clean.parts_car, clean.parts),
                            staging.stg_final_delivery(clean.final_delivery))
    got = dict(rows_of(linked, "sale_id", "supplier_id"))
    assert 1 not in got                    # before the first delivery
    assert got[2] == 1                     # same-day delivery counts (<=)
    assert got[3] == 3                     # two deliveries that day: greatest delivery_id
    assert got[6] == 1                     # latest earlier delivery: 103 -> supplier 1
    assert got[7] == 2 and got[10] == 2    # 104 on 2023-05-20 -> supplier 2


def test_supplier_as_of_equals_brute_force_and_is_linear(spark):
    # random-ish sales / deliveries; compare to the reference's ranked theta join
    sales = spark.range(0, 400).select(
        F.col("id").alias("sale_id"),
        F.date_add(F.lit(dt.date(2023, 1, 1)), (F.col("id") * 37 % 200).cast("int")).alias("sale_date"))
    dels = spark.range(0, 300).select(
        (F.col("id") + 1000).alias("delivery_id"), (F.col("id") * 13 % 17).alias("supplier_id"),
        F.date_add(F.lit(dt.date(2023, 1, 15)), (F.col("id") * 11 % 180).cast("int")).alias("delivery_date"))
    fast = supplier_as_of(sales, dels)
    w = Window.partitionBy("sale_id").orderBy(F.desc("delivery_date"), F.desc("delivery_id"))
    brute = (sales.join(dels, dels["delivery_date"] <= sales["sale_date"])
             .withColumn("rn", F.row_number().over(w)).filter("rn = 1"))
    assert rows_of(fast, "sale_id", "supplier_id") == rows_of(brute, "sale_id", "supplier_id")
    plan = plan_of(fast)
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_dimensions(gold):
    cars = rows_of(gold.dim_car, "car_key", "car_id", "brand_model", "segment", "unique_parts",
                   "total_parts_qty")
    assert cars == [(1, 1, "SEAT Ibiza", "Subcompact", 3, 4), (2, 2, "VW Golf", "Compact", 2, 3),
                    (3, 4, "Cupra Born", "Electric", 1, 1)]
    regions = dict(rows_of(gold.dim_customer, "customer_id", "region"))
    assert regions == {1: "Catalonia", 2: "Madrid", 3: "Other"}
    assert gold.dim_part.count() == 5


def test_fact_rows_and_measures(gold):
    f = gold.fact_sales
    assert [r[0] for r in rows_of(f, "sale_id")] == [2, 3, 4, 6, 7, 10]
    assert [r[0] for r in rows_of(f, "sale_key")] == [1, 2, 3, 4, 5, 6]
    by_id = {r.sale_id: r for r in f.collect()}
    assert by_id[4].gross_margin_pct is None                   # price 0
    assert by_id[6].gross_margin_pct == Dec("-0.3333")         # (150-200)/150
    assert by_id[2].total_parts_cost == Dec("280.00") and by_id[2].time_id == 20230110
    assert by_id[7].time_id == 20300101                        # loads though outside calendar


def test_fact_margin_overflow_raises(spark, clean):
    cfg = fixture_config()
    silver_sales = staging.stg_sales(
        clean.sales.withColumn("sale_price", F.when(F.col("sale_id") == 6, F.lit(Dec("1.00")))
                               .otherwise(F.col("sale_price")).cast("decimal(12,2)")),
        clean.parts_car, clean.parts)
    d_car = dims.load_dim(None, dims.dim_car_source(staging.stg_cars(clean.cars),
                                                    clean.parts_car, cfg.segment_by_model),
                          "car_id", "car_key", NOW1)
    d_cus = dims.load_dim(None, dims.dim_customer_source(staging.stg_customers(clean.customers),
                                                         cfg.region_by_province),
                          "customer_id", "customer_key", NOW1)
    d_sup = dims.load_dim(None, dims.dim_supplier_source(staging.stg_supplier(clean.supplier)),
                          "supplier_id", "supplier_key", NOW1)
    src = fact_source(silver_sales, staging.stg_final_delivery(clean.final_delivery),
                      clean.parts_car, d_car, d_cus, d_sup)
    with pytest.raises(Exception) as e:   # (1 - 200) / 1 = -199 does not fit DECIMAL(6,4)
        load_fact(None, src, NOW1).collect()
    assert "DECIMAL" in str(e.value).upper() or "OVERFLOW" in str(e.value).upper()


def test_fact_plan_has_no_nested_loops(gold, clean, cfg):
    from torque.plans.warehouse import build_silver
    silver = build_silver(clean)
    src = fact_source(silver.sales, silver.final_delivery, silver.parts_car, gold.dim_car,
                      gold.dim_customer, gold.dim_supplier)
    plan = plan_of(src)
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


def test_shuffle_join_fallback_gives_same_gold(spark, clean, cfg, gold):
    """Beyond the broadcast limits every data-sized join becomes a shuffle
    join; the gold tables must not change."""
    from torque.plans.warehouse import build_silver, load_gold
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "torque.broadcast.maxRows": "1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        shuffled = load_gold(spark, build_silver(clean), cfg)
        plan = plan_of(shuffled.fact_sales) + plan_of(
            fact_source(build_silver(clean).sales, build_silver(clean).final_delivery,
                        clean.parts_car, shuffled.dim_car, shuffled.dim_customer,
                        shuffled.dim_supplier))
        cols = ["sale_key", "sale_id", "car_key", "customer_key", "supplier_key", "time_id",
                "gross_margin_pct"]
        assert rows_of(shuffled.fact_sales, *cols) == rows_of(gold.fact_sales, *cols)
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_keys_are_dense_for_any_partition_count(spark):
    df = spark.range(0, 5000).select(F.col("id").alias("nk"))
    for n in (None, 1, 50):
        got = assign_surrogate_keys(df, "k", ["nk"], num_partitions=n)
        assert got.agg(F.min("k"), F.max("k"), F.countDistinct("k")).first() == (1, 5000, 5000)
        assert rows_of(got.filter("nk in (0, 4999)"), "nk", "k") == [(0, 1), (4999, 5000)]
    plan = plan_of(assign_surrogate_keys(df, "k", ["nk"]))
    assert "MapInPandas" not in plan and "SinglePartition" not in plan


def test_merge_small_source_is_broadcast(spark):
    target = merge_upsert(None, spark.range(0, 2000).select(
        F.col("id"), (F.col("id") * 2).cast("string").alias("name"),
        F.lit("c").alias("city")), "id", "k", NOW1)
    changes = _src(spark, [(5, "five", None), (2500, "new", "n"), (7, "seven", "x")])
    broadcast_path = merge_upsert(target, changes, "id", "k", NOW2)
    old = spark.conf.get("torque.broadcast.maxRows", None)
    try:
        spark.conf.set("torque.broadcast.maxRows", "0")
        shuffle_path = merge_upsert(target, changes, "id", "k", NOW2)
        cols = ["k", "id", "name", "city"]
        assert rows_of(shuffle_path, *cols) == rows_of(broadcast_path, *cols)
    finally:
        if old is None:
            spark.conf.unset("torque.broadcast.maxRows")
        else:
            spark.conf.set("torque.broadcast.maxRows", old)
    got = dict((r.id, (r.k, r.name, r.city)) for r in broadcast_path.filter("id in (5, 7, 2500)").collect())
    assert got == {5: (6, "five", None), 7: (8, "seven", "x"), 2500: (2001, "new", "n")}
    plan = plan_of(broadcast_path)
    # the target side of the update join is streamed: no exchange on its key
    assert "BroadcastHashJoin" in plan


def test_merge_large_source_shuffles_rows_once(spark, monkeypatch):
    """Above the broadcast limits new keys are numbered apart from their rows: whole
    rows meet the target in one join, whatever becomes of them."""
    from torque.operators import merge
    numbered = []
    real = merge.assign_surrogate_keys
    monkeypatch.setattr(merge, "assign_surrogate_keys",
                        lambda df, *a: numbered.append(df.columns) or real(df, *a))
    rows = lambda v: spark.createDataFrame(v, "id long, v int, name string")
    target = merge_upsert(None, rows([(1, 5, "new"), (2, 1, "old"), (9, 1, "stays")]), "id", "k", NOW1)
    late = rows([(1, 4, "late"), (2, 2, None), (7, None, "seventh"), (3, 1, None)])
    spark.conf.set("torque.broadcast.maxRows", "0")
    try:
        cols = ["id", "k", "v", "name", "load_ts"]
        got = merge_upsert(target, late, "id", "k", NOW2)
        assert got.columns == ["k", "id", "v", "name", "load_ts"]
        assert rows_of(got, *cols) == [(1, 1, 4, "late", NOW2), (2, 2, 2, None, NOW2),
                                       (3, 4, 1, None, NOW2), (7, 5, None, "seventh", NOW2),
                                       (9, 3, 1, "stays", NOW1)]
        assert "Union" not in plan_of(got)
        got = merge_upsert(target, late, "id", "k", NOW2, version=["v"], start_key=50)
        assert rows_of(got, *cols) == [(1, 1, 5, "new", NOW1), (2, 2, 2, None, NOW2),
                                       (3, 51, 1, None, NOW2), (7, 52, None, "seventh", NOW2),
                                       (9, 3, 1, "stays", NOW1)]
        with pytest.raises(MergeKeyError):
            merge_upsert(target, late.union(late), "id", "k", NOW2)
    finally:
        spark.conf.unset("torque.broadcast.maxRows")
    assert numbered[1:] == [["id"], ["id"]]


def test_repeated_source_key_is_refused(spark):
    with pytest.raises(MergeKeyError):
        merge_upsert(None, _src(spark, [(1, "a", None), (1, "b", None)]), "id", "k", NOW1)


def test_merge_keeps_greater_version(spark):
    rows = lambda v: spark.createDataFrame(v, "id long, v int, name string")
    target = merge_upsert(None, rows([(1, 5, "new"), (2, 1, "old")]), "id", "k", NOW1)
    late = rows([(1, 4, "late"), (2, 2, "newer"), (3, 1, "first")])
    got = merge_upsert(target, late, "id", "k", NOW2, version=["v"])
    assert rows_of(got, "id", "k", "v", "name") == [(1, 1, 5, "new"), (2, 2, 2, "newer"),
                                                    (3, 3, 1, "first")]


def test_wide_rows_are_not_a_small_side(spark):
    from torque.operators.joins import small_enough
    wide = spark.range(10).select("id", F.repeat(F.lit("x"), 5000).alias("text"))
    assert small_enough(wide, 10)
    spark.conf.set("torque.broadcast.maxBytes", "20000")
    try:
        assert not small_enough(wide, 10)
    finally:
        spark.conf.unset("torque.broadcast.maxBytes")
