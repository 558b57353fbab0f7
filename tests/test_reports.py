"""Reports R1-R6a, R5b and insights X1-X4 on the fixture gold layer."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as Dec

from pyspark.sql import functions as F

from tests.fixtures import plan_of, rows_of
from torque.operators import insights, reports


def test_revenue_by_brand_excludes_out_of_calendar(gold):
    r1 = reports.rpt_revenue_by_brand(gold.fact_sales, gold.dim_car, gold.dim_time, ordered=True)
    total = r1.agg(F.sum("total_revenue")).first()[0]
    in_cal = gold.fact_sales.filter("time_id < 20240000").agg(F.sum("sale_price")).first()[0]
    assert total == in_cal == Dec("1950.00")                 # sale 7 (2030) is absent
    first = r1.first()
    assert (first.year, first.quarter_name) == (2023, "Q1")


def test_revenue_equal_across_reports(gold):
    f, c, t = gold.fact_sales, gold.dim_car, gold.dim_time
    r1 = reports.rpt_revenue_by_brand(f, c, t).agg(F.sum("total_revenue")).first()[0]
    r4 = reports.rpt_supplier_performance(f, gold.dim_supplier, t).agg(
        F.sum("revenue_enabled")).first()[0]
    r5 = reports.rpt_monthly_trend(f, t).agg(F.sum("total_revenue")).first()[0]
    r2 = reports.rpt_sales_by_region(f, gold.dim_customer, t).agg(F.sum("total_revenue")).first()[0]
    assert r1 == r4 == r5 == r2


def test_supplier_performance_merges_same_name_and_city(gold):
    r4 = reports.rpt_supplier_performance(gold.fact_sales, gold.dim_supplier, gold.dim_time)
    names = rows_of(r4, "supplier_name", "supplier_city", "quarter_name", "sales_linked")
    # sale 6 links supplier 1, sale 10 supplier 2: both 'Acme'/'Madrid', one row
    assert ("Acme", "Madrid", "Q2", 2) in names
    assert len([n for n in names if n[2] == "Q2"]) == 1


def test_monthly_trend_lag_spans_gap_and_filled_variant(gold):
    trend = {r.year_month: r for r in reports.rpt_monthly_trend(gold.fact_sales, gold.dim_time).collect()}
    assert sorted(trend) == ["2023-01", "2023-02", "2023-04", "2023-06"]
    assert trend["2023-01"].prev_month_revenue is None
    assert trend["2023-06"].prev_month_revenue == Dec("150.00")          # April, not May
    filled = {r.year_month: r for r in
              reports.rpt_monthly_trend_filled(gold.fact_sales, gold.dim_time).collect()}
    assert len(filled) == 12
    assert filled["2023-05"].total_revenue == Dec("0.00") and filled["2023-05"].total_sales == 0
    assert filled["2023-06"].prev_month_revenue == Dec("0.00")
    assert filled["2023-06"].mom_revenue_growth_pct is None             # NULLIF(prev, 0)
    assert filled["2023-02"].mom_revenue_growth_pct == Dec("-40.00")    # 300 vs 500


def test_parts_cost_by_segment_equals_naive_pairs(gold, clean):
    fast = reports.rpt_parts_cost_by_segment(gold.fact_sales, gold.dim_car, gold.dim_part,
                                             clean.parts_car)
    f, dc, dp = gold.fact_sales, gold.dim_car, gold.dim_part
    seg_parts = reports.segment_parts(dc, clean.parts_car, dp)
    pairs = (f.select("sale_key", "car_key").join(dc.select("car_key", "segment", "total_parts_qty"), "car_key")
             .join(seg_parts, "segment").join(dp.select("part_key", "category_name", "unit_price"), "part_key"))
    naive = (pairs.groupBy("segment", "category_name")
             .agg(F.countDistinct("sale_key").alias("units_sold"),
                  F.sum(F.col("unit_price") * F.col("total_parts_qty")).cast("decimal(38,2)")
                  .alias("estimated_category_cost")))
    cols = ["segment", "category_name", "units_sold", "estimated_category_cost"]
    assert rows_of(fast, *cols) == rows_of(naive, *cols)
    sums = fast.groupBy("segment").agg(F.sum("pct_of_segment_cost").alias("s")).collect()
    assert all(abs(r.s - 100) <= Dec("0.05") for r in sums)
    plan = plan_of(fast)
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_model_profitability_and_top(gold):
    r3 = reports.rpt_model_profitability(gold.fact_sales, gold.dim_car)
    golf = r3.filter("brand_model = 'VW Golf'").first()
    assert golf.units_sold == 3 and golf.margin_per_unit == Dec("283.33")  # (100-50+800)/3
    top = insights.top_models(r3, 2).collect()
    assert [r.brand_model for r in top] == ["SEAT Ibiza", "VW Golf"]


def test_trend_one_year_and_region(gold):
    year = insights.trend_one_year(reports.rpt_monthly_trend(gold.fact_sales, gold.dim_time), 2023,
                                   ordered=True)
    assert [r.year_month for r in year.collect()] == ["2023-01", "2023-02", "2023-04", "2023-06"]
    reg = dict(rows_of(insights.revenue_by_region(
        reports.rpt_sales_by_region(gold.fact_sales, gold.dim_customer, gold.dim_time)),
        "region", "revenue"))
    assert reg == {"Catalonia": Dec("650.00"), "Madrid": Dec("300.00"), "Other": Dec("1000.00")}


def test_margin_alert_needs_three_adjacent_falling_months(spark):
    cars = spark.createDataFrame([(1, 1, "A x"), (2, 2, "B y")], "car_key long, car_id long, brand_model string")
    cal = spark.range(1).select(F.explode(F.sequence(F.lit(dt.date(2023, 1, 1)), F.lit(dt.date(2023, 12, 31)))).alias("d")) \
        .select((F.year("d") * 10000 + F.month("d") * 100 + F.dayofmonth("d")).cast("int").alias("time_id"),
                F.year("d").alias("year"), F.month("d").alias("month"))
    # car 1 falls Feb..May (4 deltas < 0 from Feb); car 2 falls only Feb, Mar
    pct = {1: ["0.50", "0.40", "0.30", "0.20", "0.10"], 2: ["0.50", "0.40", "0.30", "0.35", "0.36"]}
    rows = [(car, 20230101 + m * 100, Dec(p)) for car, ps in pct.items() for m, p in enumerate(ps)]
    fact = spark.createDataFrame(rows, "car_key long, time_id int, gross_margin_pct decimal(6,4)")
    alerts = insights.model_margin_alert(fact, cars, cal).collect()
    assert [(a.brand_model, a.start_month, a.end_month, a.months) for a in alerts] == \
        [("A x", "2023-02", "2023-05", 4)]


def test_results_invariant_under_partitioning(spark, gold, clean):
    def snapshot():
        f = gold.fact_sales.repartition(5)
        return (rows_of(reports.rpt_revenue_by_brand(f, gold.dim_car, gold.dim_time),
                        "year", "quarter_name", "brand", "total_revenue", "avg_margin_pct"),
                rows_of(reports.rpt_monthly_trend(f, gold.dim_time), "year_month",
                        "mom_revenue_growth_pct"),
                rows_of(reports.rpt_parts_cost_by_segment(f, gold.dim_car, gold.dim_part,
                                                          clean.parts_car),
                        "segment", "category_name", "pct_of_segment_cost"))
    before = snapshot()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = snapshot()
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        many = snapshot()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert before == one == many


def test_ordered_reports_follow_view_order(gold, clean):
    f, c, t = gold.fact_sales, gold.dim_car, gold.dim_time

    def keys(df, *cols):
        return [tuple(r[k] for k in cols) for r in df.collect()]

    r1 = keys(reports.rpt_revenue_by_brand(f, c, t, ordered=True), "year", "quarter_name", "total_revenue")
    assert r1 == sorted(r1, key=lambda x: (x[0], x[1], -x[2]))
    r3 = [r.avg_margin_pct for r in reports.rpt_model_profitability(f, c, ordered=True).collect()]
    assert r3[:-1] == sorted(r3[:-1], reverse=True) and r3[-1] is None      # NULLs last
    r5 = keys(reports.rpt_monthly_trend(f, t, ordered=True), "year", "month")
    assert r5 == sorted(r5)
    r6 = keys(reports.rpt_parts_cost_by_segment(f, c, gold.dim_part, clean.parts_car, ordered=True),
              "segment", "estimated_category_cost")
    assert r6 == sorted(r6, key=lambda x: (x[0], -x[1]))
    # R2 sorts by the month number, which it does not output
    r2 = [r.month_name for r in reports.rpt_sales_by_region(f, gold.dim_customer, t, ordered=True).collect()]
    months = ["January", "February", "March", "April", "May", "June"]
    assert r2 == sorted(r2, key=months.index) and r2 == ["January", "February", "April", "June"]


def test_sales_by_region_over_buckets_moves_no_fact_row(spark, gold):
    """Customers that are too many to broadcast meet the fact bucket by bucket, also in
    a table that an earlier session wrote."""
    import tempfile
    from torque.sources.bucketed import open_bucketed, write_bucketed
    root = tempfile.mkdtemp(prefix="torque-buckets-")
    for name, df in (("fact", gold.fact_sales), ("customers", gold.dim_customer)):
        write_bucketed(df, f"bucketed_{name}", f"{root}/{name}", "customer_key", 4)
        spark.sql(f"DROP TABLE bucketed_{name}")                      # its files stay
    fact, customers = (open_bucketed(spark, f"again_{name}", f"{root}/{name}", df, "customer_key", 4)
                       for name, df in (("fact", gold.fact_sales), ("customers", gold.dim_customer)))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = reports.rpt_sales_by_region(fact, customers, gold.dim_time)
        plan = plan_of(out)
        want = reports.rpt_sales_by_region(gold.fact_sales, gold.dim_customer, gold.dim_time)
        assert rows_of(out, *out.columns) == rows_of(want, *want.columns)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan
    # the only exchange of rows is that of the aggregated groups; the calendar is broadcast
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Exchange hashpartitioning(region" in plan and "partial_sum" in plan.split(
        "Exchange hashpartitioning(region")[1]
    spark.sql("DROP TABLE again_fact")
    spark.sql("DROP TABLE again_customers")
