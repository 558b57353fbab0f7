"""Sources: test-data binding, snapshot store, loader, summaries."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from torque.schemas import GOLD
from torque.sources import sinks
from torque.sources.bindings import bind_sources

# FIXTURES §2, measured at sf0.001
EXPECTED_SF0001 = {"supplier": 10, "customers": 150, "category": 8, "parts": 200, "cars": 17,
                   "parts_car": 200, "sales": 1500, "final_delivery": 5334, "lot_delivery": 5996}


def test_binding_row_counts(spark):
    src = bind_sources(spark, "/root/testdata/sf0.001")
    summary = {r.table_name: r.row_count for r in sinks.load_summary(src.as_dict()).collect()}
    assert summary == EXPECTED_SF0001


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_every_part_is_in_one_bill_of_materials(spark, size):
    src = bind_sources(spark, f"/root/testdata/sf{size}")
    n = spark.read.parquet(f"/root/testdata/sf{size}/part.parquet").count()
    assert src.parts_car.count() == n
    assert src.parts_car.select("part_id").distinct().count() == n
    assert src.parts_car.groupBy("car_id").count().agg(F.max("count")).first()[0] <= 12


def test_snapshot_versions_ignore_uncommitted(spark, store):
    df = spark.range(3).select(F.col("id").alias("x"))
    assert store.write("t", df) == 1
    assert store.write("t", df.union(df)) == 2
    # a crashed write leaves a version folder without _SUCCESS: readers skip it
    os.makedirs(store.path("t", 3))
    assert store.latest("t") == 2 and store.read("t").count() == 6
    assert store.write("t", df) == 4 and store.latest("t") == 4


def test_load_truncate_insert_maps_by_name(spark, store):
    df = spark.createDataFrame([(2.5, 7, "extra")], "unit_price double, part_id long, junk string")
    df = (df.withColumn("part_name", F.lit("p")).withColumn("color", F.lit(None).cast("string"))
          .withColumn("category_id", F.lit(1)))
    assert sinks.load_truncate_insert(store, "parts", df) == 1
    out = store.read("parts")
    assert out.columns == ["part_id", "part_name", "color", "unit_price", "category_id"]
    assert str(out.schema["unit_price"].dataType) == "DecimalType(10,2)"
    # a second load replaces the content (new version), it does not append
    assert sinks.load_truncate_insert(store, "parts", df) == 1 and store.read("parts").count() == 1


def test_init_tables(spark, store):
    sinks.init_tables(store)
    for name, schema in GOLD.items():
        t = store.read(name)
        assert t.count() == 0 and [f.name for f in t.schema] == [f.name for f in schema]


def test_run_end_to_end(spark, store, clean, cfg):
    import pytest
    from torque.operators.quality import QualityGateError
    from torque.plans.warehouse import run
    from torque.sources.sinks import read_source
    with pytest.raises(QualityGateError):          # the fixture has QC failures
        run(spark, clean, cfg, store)
    gold, failed = run(spark, clean, cfg, store, warn_only=True)
    assert failed and gold.fact_sales.count() == 6
    assert read_source(store, "sales").count() == 10
    # a second run MERGEs into the first: keys stay, no duplicates
    gold2, _ = run(spark, clean, cfg, store, current=gold, warn_only=True, keep_versions=2)
    assert gold2.fact_sales.count() == 6
    assert sorted(r.sale_key for r in gold2.fact_sales.collect()) == [1, 2, 3, 4, 5, 6]
    # three loads of the sales role so far (one failed the gate after loading): two kept
    assert store._versions("sales") == [2, 3] and store._versions("fact_sales")[-1] == 2


def test_snapshot_expire_keeps_newest(spark, store):
    df = spark.range(2)
    for _ in range(4):
        store.write("e", df)
    assert store.expire("e", keep=2) == [1, 2]
    assert store.latest("e") == 4 and store.read("e", 3).count() == 2
    assert store.expire("e", keep=2) == []
