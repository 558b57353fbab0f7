"""R1-R6a — reporting views over the star schema.

Conventions:

* totals: ``SUM`` as DECIMAL(22,2); rounded averages / percentages: exact
  HALF_UP as DECIMAL(18,2) (``torque.functions.money``);
* ``COUNT(DISTINCT sale_key)`` is ``count(*)`` (SURVEY W4): sale_key is the
  fact's unique key and every join is N:1 on a unique dimension key, so
  each group sees each sale once; this avoids a distinct-aggregation shuffle;
* dimension sides are broadcast: the calendar because it is keyed by date
  (domain-bounded), the others after a row-count check;
* ordering is presentation: ``ordered=True`` applies the view's ORDER BY.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from torque.functions.money import MONEY_SUM, RATIO2, WIDE_MONEY, avg_round, round_div
from torque.operators.calendar import calendar_months
from torque.operators.joins import broadcast_bounded


def _sum_money(col: str):
    return F.sum(col).cast(MONEY_SUM)


def _sales_count():
    return F.count(F.lit(1)).cast("long")


def _avg_margin_pct():
    return avg_round(F.col("gross_margin_pct"), col_scale=4, factor=100)


def _avg_sale_price():
    return avg_round(F.col("sale_price"), col_scale=2)


def _time(dim_time: DataFrame, *cols: str) -> DataFrame:
    return broadcast_bounded(dim_time.select("time_id", *cols))


def rpt_revenue_by_brand(fact: DataFrame, dim_car: DataFrame, dim_time: DataFrame,
                         ordered: bool = False) -> DataFrame:
    """R1 — year, quarter, brand -> sales, revenue, cost, margin, averages."""
    car = dim_car.select("car_key", "brand")
    out = (fact.join(car, "car_key").join(_time(dim_time, "year", "quarter_name"), "time_id")
           .groupBy("year", "quarter_name", "brand")
           .agg(_sales_count().alias("total_sales"),
                _sum_money("sale_price").alias("total_revenue"),
                _sum_money("total_parts_cost").alias("total_parts_cost"),
                _sum_money("gross_margin").alias("total_gross_margin"),
                _avg_margin_pct().alias("avg_margin_pct"),
                _avg_sale_price().alias("avg_sale_price")))
    if ordered:
        out = out.orderBy("year", "quarter_name", F.desc_nulls_last("total_revenue"))
    return out


def rpt_sales_by_region(fact: DataFrame, dim_customer: DataFrame, dim_time: DataFrame,
                        ordered: bool = False) -> DataFrame:
    """R2 — region, province, year, month -> sales, revenue, margin, avg price.

    Groups by the month number too (not output) and sorts by it.
    """
    cust = dim_customer.select("customer_key", "region", "province")
    out = (fact.join(cust, "customer_key")
           .join(_time(dim_time, "year", "month", "month_name"), "time_id")
           .groupBy("region", "province", "year", "month_name", "month")
           .agg(_sales_count().alias("total_sales"),
                _sum_money("sale_price").alias("total_revenue"),
                _sum_money("gross_margin").alias("total_gross_margin"),
                _avg_sale_price().alias("avg_sale_price")))
    if ordered:
        out = out.orderBy("year", "month", F.desc_nulls_last("total_revenue"))
    return out.drop("month")


def rpt_model_profitability(fact: DataFrame, dim_car: DataFrame,
                            ordered: bool = False) -> DataFrame:
    """R3 — per car model: units, revenue, cost, margin, avg pct, margin per unit."""
    car = dim_car.select("car_key", "brand", "model", "brand_model", "segment",
                                           "manufacture_year")
    out = (fact.join(car, "car_key")
           .groupBy("brand", "model", "brand_model", "segment", "manufacture_year")
           .agg(_sales_count().alias("units_sold"),
                _sum_money("sale_price").alias("total_revenue"),
                _sum_money("total_parts_cost").alias("total_parts_cost"),
                _sum_money("gross_margin").alias("total_gross_margin"),
                _avg_margin_pct().alias("avg_margin_pct"),
                round_div(F.sum("gross_margin"), F.count(F.lit(1)), num_scale=2, den_scale=0,
                          out_scale=2).alias("margin_per_unit")))
    if ordered:
        out = out.orderBy(F.desc_nulls_last("avg_margin_pct"))
    return out


def rpt_supplier_performance(fact: DataFrame, dim_supplier: DataFrame, dim_time: DataFrame,
                             ordered: bool = False) -> DataFrame:
    """R4 — supplier name + city, year, quarter -> linked sales, value, revenue, ratio.

    Groups by name and city, not by key, as the reference does: suppliers
    sharing both merge into one row.
    """
    supp = dim_supplier.select("supplier_key", "supplier_name",
                                    F.col("city").alias("supplier_city"))
    # Eager aggregation: a fact row's supplier is the winner of its sale day,
    # so (supplier_key, time_id) has at most one value per day. Counting and
    # summing per pair first (partial aggregates, exact: sums are
    # associative) shrinks the fact to that many rows before it meets the
    # supplier dimension, which is large at scale and would otherwise force a
    # shuffle of the whole fact.
    per_day = (fact.groupBy("supplier_key", "time_id")
               .agg(F.count(F.lit(1)).alias("_n"), F.sum("total_parts_cost").alias("_cost"),
                    F.sum("sale_price").alias("_price")))
    out = (per_day.join(supp, "supplier_key")
           .join(_time(dim_time, "year", "quarter_name"), "time_id")
           .groupBy("supplier_name", "supplier_city", "year", "quarter_name")
           .agg(F.sum("_n").cast("long").alias("sales_linked"),
                F.sum("_cost").cast(MONEY_SUM).alias("parts_value_supplied"),
                F.sum("_price").cast(MONEY_SUM).alias("revenue_enabled"),
                round_div(F.sum("_cost"), F.sum("_price"), num_scale=2,
                          den_scale=2, out_scale=2, factor=100).alias("cost_to_revenue_pct")))
    if ordered:
        out = out.orderBy("year", "quarter_name", F.desc_nulls_last("parts_value_supplied"))
    return out


def _monthly(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    return (fact.join(_time(dim_time, "year", "month", "month_short"), "time_id")
            .groupBy("year", "month", "month_short")
            .agg(_sales_count().alias("total_sales"),
                 _sum_money("sale_price").alias("total_revenue"),
                 _sum_money("gross_margin").alias("total_gross_margin"),
                 _avg_margin_pct().alias("avg_margin_pct")))


def with_growth(monthly: DataFrame) -> DataFrame:
    # One row per month: the unpartitioned window is bounded by the calendar.
    w = Window.orderBy("year", "month")
    prev = F.lag("total_revenue").over(w)
    return (monthly
            .withColumn("year_month", F.concat(F.col("year").cast("string"), F.lit("-"),
                                               F.lpad(F.col("month").cast("string"), 2, "0")))
            .withColumn("prev_month_revenue", prev)
            .withColumn("mom_revenue_growth_pct",
                        round_div(F.col("total_revenue") - F.col("prev_month_revenue"),
                                  F.col("prev_month_revenue"), num_scale=2, den_scale=2,
                                  out_scale=2, factor=100))
            .select("year", "month", "month_short", "year_month", "total_sales", "total_revenue",
                    "total_gross_margin", "avg_margin_pct", "prev_month_revenue",
                    "mom_revenue_growth_pct"))


def rpt_monthly_trend(fact: DataFrame, dim_time: DataFrame, ordered: bool = False) -> DataFrame:
    """R5 — monthly totals and month-over-month growth.

    As in the reference, months without sales are absent, so LAG refers to
    the previous month *present* (it spans gaps); see the gap-filled R5b.
    """
    out = with_growth(_monthly(fact, dim_time))
    return out.orderBy("year", "month") if ordered else out


def rpt_monthly_trend_filled(fact: DataFrame, dim_time: DataFrame,
                             ordered: bool = False) -> DataFrame:
    """R5b — R5 over every calendar month: empty months show 0 sales and
    revenue, NULL average, and growth after an empty month is NULL."""
    months = calendar_months(dim_time)
    agg = _monthly(fact, dim_time).drop("month_short")
    filled = (months.join(broadcast_bounded(agg), ["year", "month"], "left")
              .select("year", "month", "month_short",
                      F.coalesce("total_sales", F.lit(0).cast("long")).alias("total_sales"),
                      F.coalesce("total_revenue", F.lit(0).cast(MONEY_SUM)).alias("total_revenue"),
                      F.coalesce("total_gross_margin", F.lit(0).cast(MONEY_SUM))
                      .alias("total_gross_margin"),
                      "avg_margin_pct"))
    out = with_growth(filled)
    return out.orderBy("year", "month") if ordered else out


def segment_parts(dim_car: DataFrame, parts_car: DataFrame, dim_part: DataFrame) -> DataFrame:
    """R6a — DISTINCT (segment, part_key): parts used by any car of a segment."""
    car = dim_car.select("car_id", "segment")
    part = dim_part.select("part_id", "part_key")
    return (parts_car.select("car_id", "part_id").join(car, "car_id").join(part, "part_id")
            .select("segment", "part_key").distinct())


def rpt_parts_cost_by_segment(fact: DataFrame, dim_car: DataFrame, dim_part: DataFrame,
                              parts_car: DataFrame, ordered: bool = False) -> DataFrame:
    """R6 — estimated parts cost per segment and part category.

    The reference joins every fact row to every part of its segment (a
    correlated IN inside the join condition) and sums
    ``unit_price * car.total_parts_qty``. That sum factorises:

        SUM_{sale, part} price * qty = (SUM_sales qty) * (SUM_parts price)

    so the plan aggregates the fact per segment and the distinct segment
    parts per (segment, category), then joins the two small results on the
    segment: no pair of sale x part is ever formed. units_sold is the number
    of the segment's sales. The share is a window over the (segment,
    category) rows, partitioned by segment.
    """
    car = dim_car.select("car_key", "segment", "total_parts_qty")
    # the car's BOM quantity comes from the dimension (as in the reference)
    per_segment = (fact.select("car_key").join(car, "car_key").groupBy("segment")
                   .agg(_sales_count().alias("units_sold"),
                        F.sum("total_parts_qty").cast("long").alias("_qty")))
    prices = (segment_parts(dim_car, parts_car, dim_part)
              .join(dim_part.select("part_key", "category_name", "unit_price"), "part_key")
              .groupBy("segment", "category_name")
              .agg(F.sum("unit_price").alias("_price")))
    est = (prices.join(per_segment, "segment")
           .select("segment", "category_name", "units_sold",
                   (F.col("_price") * F.col("_qty")).cast(WIDE_MONEY)
                   .alias("estimated_category_cost")))
    seg_total = F.sum("estimated_category_cost").over(Window.partitionBy("segment"))
    out = est.withColumn("pct_of_segment_cost",
                         round_div(F.col("estimated_category_cost"), seg_total, num_scale=2,
                                   den_scale=2, out_scale=2, factor=100, out_type=RATIO2))
    if ordered:
        out = out.orderBy("segment", F.desc_nulls_last("estimated_category_cost"))
    return out
