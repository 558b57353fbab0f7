"""Scalar helpers (exact rounding, dates) and silver views V1-V9, B1/B2."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as Dec

from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructField, StructType

from tests.fixtures import rows_of
from torque.functions.dates import calendar_columns, date_key
from torque.functions.money import round_div
from torque.operators import staging
from torque.operators.calendar import dim_time


def _ratio(spark, pairs, **kw):
    schema = StructType([StructField("n", DecimalType(20, 2)), StructField("d", DecimalType(20, 2))])
    df = spark.createDataFrame(pairs, schema)
    return [r[0] for r in df.select(round_div(F.col("n"), F.col("d"), **kw)).collect()]


def test_round_div_half_up_away_from_zero(spark):
    got = _ratio(spark, [(Dec("2.34"), Dec("1")), (Dec("1"), Dec("8")), (Dec("-1"), Dec("8")),
                         (Dec("1"), Dec("0")), (None, Dec("1"))],
                 num_scale=2, den_scale=2, out_scale=2)
    # 2.34 / 1 ; 1/8 = 0.125 -> 0.13 ; -0.125 -> -0.13 ; /0 -> NULL ; NULL -> NULL
    assert got == [Dec("2.34"), Dec("0.13"), Dec("-0.13"), None, None]


def test_round_div_no_double_rounding_on_wide_operands(spark):
    # 1/3 * 100 = 33.333.. -> 33.33; 2/3 -> 66.67 with factor 100, exact for huge operands
    big = Dec("123456789012345678.00")
    got = _ratio(spark, [(big, big * 3), (big * 2, big * 3)],
                 num_scale=2, den_scale=2, out_scale=2, factor=100)
    assert got == [Dec("33.33"), Dec("66.67")]


def test_margin_pct_rounds_once(spark):
    # 0.01 / 200 = 0.00005 exactly, a tie at the 4th decimal: HALF_UP away from zero
    got = _ratio(spark, [(Dec("0.01"), Dec("200.00")), (Dec("-0.01"), Dec("200.00"))],
                 num_scale=2, den_scale=2, out_scale=4, out_type=DecimalType(6, 4))
    assert got == [Dec("0.0001"), Dec("-0.0001")]


def test_calendar_columns(spark):
    cal = dim_time(spark, dt.date(2024, 1, 6), dt.date(2024, 1, 8))
    rows = rows_of(cal, "time_id", "day_of_week", "day_name", "is_weekend", "month_name",
                   "month_short", "quarter_name", "week_of_year")
    assert rows == [
        (20240106, 6, "Saturday", True, "January", "Jan", "Q1", 1),
        (20240107, 0, "Sunday", True, "January", "Jan", "Q1", 1),
        (20240108, 1, "Monday", False, "January", "Jan", "Q1", 2),
    ]
    assert dim_time(spark, dt.date(2022, 1, 1), dt.date(2025, 12, 31)).count() == 1461


def test_date_key(spark):
    df = spark.createDataFrame([(dt.date(2001, 2, 3),)], "d date")
    assert df.select(date_key(F.col("d"))).first()[0] == 20010203
    assert len(calendar_columns(F.col("d"))) == 13


def test_trim_coalesce_keeps_blank(clean):
    rows = rows_of(staging.stg_customers(clean.customers), "customer_id", "customer_name",
                   "address", "city")
    assert rows[0] == (1, "Ana", "Unknown", "Unknown")
    assert rows[1] == (2, "Bo", "Main St 1", "")        # blank stays blank


def test_stg_parts_drops_orphan_category(clean):
    parts = staging.stg_parts(clean.parts, clean.category)
    ids = [r[0] for r in rows_of(parts, "part_id")]
    assert 13 not in ids and len(ids) == 5
    assert rows_of(parts.filter("part_id = 11"), "part_name", "color", "category_name") == \
        [("door", "Unknown", "Body")]


def test_stg_sales_eager_aggregation_equals_grouped_join(clean):
    fast = staging.stg_sales(clean.sales, clean.parts_car, clean.parts)
    s, pc, p = clean.sales, clean.parts_car, clean.parts
    naive = (s.join(pc, "car_id").join(p.select("part_id", "unit_price"), "part_id")
             .groupBy("sale_id", "customer_id", "car_id", "sale_date", "sale_price")
             .agg(F.sum(F.col("unit_price") * F.col("quantity")).cast("decimal(12,2)")
                  .alias("total_parts_cost"))
             .withColumn("gross_margin",
                         (F.col("sale_price") - F.col("total_parts_cost")).cast("decimal(12,2)")))
    cols = ["sale_id", "customer_id", "car_id", "sale_date", "sale_price", "total_parts_cost",
            "gross_margin"]
    assert rows_of(fast, *cols) == rows_of(naive, *cols)
    ids = [r[0] for r in rows_of(fast, "sale_id")]
    assert 5 not in ids and 9 not in ids                # car without BOM / NULL car
    # the orphan-category part 13 is still costed: car 1 = 280
    assert rows_of(fast.filter("sale_id = 2"), "total_parts_cost") == [(Dec("280.00"),)]


def test_bom_counts(clean):
    assert rows_of(staging.bom_counts(clean.parts_car), "car_id", "unique_parts_count",
                   "total_parts_qty") == [(1, 3, 4), (2, 2, 3), (4, 1, 1)]


def test_broadcast_checked_respects_row_limit(spark):
    from tests.fixtures import plan_of
    from torque.operators.joins import broadcast_checked
    big = spark.range(0, 1000).withColumnRenamed("id", "k")
    small = spark.range(0, 10).withColumnRenamed("id", "k")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # only our hint may broadcast
        hinted = big.join(broadcast_checked(small, max_rows=10), "k")
        plain = big.join(broadcast_checked(small, max_rows=9), "k")
        assert "BroadcastHashJoin" in plan_of(hinted)
        assert "BroadcastHashJoin" not in plan_of(plain)
        assert hinted.count() == plain.count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
