"""Generators S4-S9: distribution contracts and partition independence."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as Dec

from pyspark.sql import functions as F

from tests.fixtures import rows_of
from torque.sources import generators as G


def test_suppliers_customers_deterministic(spark):
    ids = spark.range(1, 51)
    a = G.gen_customers(ids)
    b = G.gen_customers(ids.repartition(7))
    assert rows_of(a, *a.columns) == rows_of(b, *b.columns)
    provinces = {p for (p,) in rows_of(a, "province")}
    assert provinces <= {p for _, p in G.PLACES}
    s = G.gen_suppliers(spark.range(1, 11))
    assert s.count() == 10 and s.filter(F.col("supplier_name").isNull()).count() == 0


def test_deliveries_contract(spark):
    parts = spark.range(1, 21).select(F.col("id").alias("part_idx"), (F.col("id") + 100).alias("part_id"))
    final, lots = G.gen_deliveries(spark.range(1001, 1051), 10, parts, 20)
    assert final.count() == 50
    per = lots.groupBy("delivery_id").agg(F.count("*").alias("n"), F.countDistinct("part_id").alias("d"))
    stats = per.agg(F.min("n"), F.max("n"), F.sum(F.col("n") - F.col("d"))).first()
    assert stats[0] >= 2 and stats[1] <= 5 and stats[2] == 0      # 2-5 distinct parts
    q = lots.agg(F.min("quantity"), F.max("quantity")).first()
    assert 20 <= q[0] and q[1] <= 200
    d = final.agg(F.min("delivery_date"), F.max("delivery_date"), F.min("supplier_id"),
                  F.max("supplier_id")).first()
    assert d[0] >= dt.date(2023, 1, 1) and d[1] <= dt.date(2024, 6, 30) and 1 <= d[2] and d[3] <= 10
    same_date = (lots.alias("l").join(final.alias("f"), "delivery_id")
                 .filter(F.col("l.delivery_date") != F.col("f.delivery_date")))
    assert same_date.count() == 0


def test_delivery_parts_are_a_real_sample(spark):
    """Every pair of 20 parts is drawn together by some of 3,000 deliveries."""
    parts = spark.range(1, 21).select(F.col("id").alias("part_idx"), F.col("id").alias("part_id"))
    _, lots = G.gen_deliveries(spark.range(3000), 10, parts, 20)
    pairs = lots.alias("a").join(lots.alias("b"), "delivery_id").filter("a.part_id < b.part_id")
    assert pairs.select("a.part_id", "b.part_id").distinct().count() == 190


def test_sales_contract(spark):
    prices = spark.createDataFrame([(1, 11, Dec("20000.00")), (2, 12, Dec("30000.00"))],
                                   "car_idx long, car_id long, base_price decimal(12,2)")
    sales = G.gen_sales(spark.range(1, 501), 50, prices, 2)
    assert sales.count() == 500
    bad = sales.join(prices, "car_id").filter(
        (F.col("sale_price") < F.col("base_price") * 0.9) | (F.col("sale_price") > F.col("base_price") * 1.1))
    assert bad.count() == 0
    c = sales.agg(F.min("customer_id"), F.max("customer_id")).first()
    assert 1 <= c[0] and c[1] <= 50


def test_bom_explode(spark):
    m = spark.createDataFrame([(1, [(101, 1), (102, 2)]), (2, [(103, 1)])],
                              "car_id long, parts array<struct<part_id:long, quantity:int>>")
    assert rows_of(G.bom_explode(m), "car_id", "part_id", "quantity") == [(1, 101, 1), (1, 102, 2), (2, 103, 1)]


def test_key_range_form(spark):
    s = G.gen_suppliers(G.key_range(spark, 10))
    assert [r[0] for r in rows_of(s, "supplier_id")] == list(range(1, 11))
    final, lots = G.gen_deliveries(G.key_range(spark, 50, 1001), 10,
                                   spark.range(1, 21).select(F.col("id").alias("part_idx"),
                                                             (F.col("id") + 100).alias("part_id")), 20)
    assert final.agg(F.min("delivery_id"), F.max("delivery_id")).first() == (1001, 1050)
