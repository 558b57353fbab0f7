"""X1-X4 — the README's analytical queries over the reporting layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from torque.functions.money import MONEY_SUM, RATIO2, avg_round
from torque.operators.joins import broadcast_bounded


def _model_months(fact: DataFrame, dim_car: DataFrame, dim_time: DataFrame) -> DataFrame:
    car = dim_car.select("car_key", "brand_model")
    cal = broadcast_bounded(dim_time.select("time_id", "year", "month"))
    return (fact.join(car, "car_key").join(cal, "time_id")
            .groupBy("brand_model", "year", "month")
            .agg(avg_round(F.col("gross_margin_pct"), col_scale=4, factor=100)
                 .alias("avg_margin_pct"))
            .withColumn("year_month", F.concat(F.col("year").cast("string"), F.lit("-"),
                                               F.lpad(F.col("month").cast("string"), 2, "0"))))


def _with_delta(mm: DataFrame) -> DataFrame:
    w = Window.partitionBy("brand_model").orderBy("year_month")
    return mm.withColumn("margin_delta_pct",
                         (F.col("avg_margin_pct") - F.lag("avg_margin_pct").over(w)).cast(RATIO2))


def model_margin_trend(fact: DataFrame, dim_car: DataFrame, dim_time: DataFrame) -> DataFrame:
    """X1 — month-over-month change of each model's average margin %.

    The reference's query reads a month column the profitability view does
    not have; its intent is computed from the fact: per model and month
    'YYYY-MM', ROUND(AVG(pct)*100, 2) and its difference to the model's
    previous month present (NULL for the first). The window is partitioned
    by model and holds one row per month.
    """
    return (_with_delta(_model_months(fact, dim_car, dim_time))
            .select("brand_model", "year_month", "avg_margin_pct", "margin_delta_pct"))


def model_margin_alert(fact: DataFrame, dim_car: DataFrame, dim_time: DataFrame,
                       min_months: int = 3) -> DataFrame:
    """X1b — runs of >= ``min_months`` calendar-adjacent months of falling margin.

    Gaps and islands: among a model's months with a negative delta,
    ``month_index - row_number`` is constant along a run of consecutive
    calendar months.
    """
    neg = (_with_delta(_model_months(fact, dim_car, dim_time))
           .filter(F.col("margin_delta_pct") < 0)
           .withColumn("_m", F.col("year") * 12 + F.col("month")))
    w = Window.partitionBy("brand_model").orderBy("_m")
    runs = (neg.withColumn("_island", F.col("_m") - F.row_number().over(w))
            .groupBy("brand_model", "_island")
            .agg(F.min("_m").alias("_start"), F.max("_m").alias("_end"),
                 F.count(F.lit(1)).alias("months")))
    return (runs.filter(F.col("months") >= min_months)
            .select("brand_model", _label(F.col("_start")).alias("start_month"),
                    _label(F.col("_end")).alias("end_month"), "months"))


def _label(m):
    """'YYYY-MM' of a month index year * 12 + month (integer aggregates stay
    hash aggregates; strings would force a sort aggregate)."""
    year = F.floor((m - 1) / 12).cast("int")
    month = (m - year * 12).cast("int")
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


def top_models(profitability: DataFrame, k: int = 3) -> DataFrame:
    """X2 — top ``k`` models by avg_margin_pct (ties by brand_model).

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each task keeps
    its own top k, only k rows per task reach the driver-side merge.
    """
    return (profitability.orderBy(F.desc_nulls_last("avg_margin_pct"), F.asc("brand_model"))
            .limit(k).select("brand_model", "avg_margin_pct", "units_sold", "total_gross_margin"))


def trend_one_year(monthly_trend: DataFrame, year: int, ordered: bool = False) -> DataFrame:
    """X3 — one year of the monthly trend. The filter applies after the LAG,
    so January keeps the previous December as its reference month."""
    out = (monthly_trend.filter(F.col("year") == year)
           .select("month", "year_month", "total_revenue", "mom_revenue_growth_pct"))
    out = out.orderBy("month") if ordered else out
    return out.drop("month")


def revenue_by_region(sales_by_region: DataFrame, ordered: bool = False) -> DataFrame:
    """X4 — revenue per region, re-aggregated from the region report."""
    out = (sales_by_region.groupBy("region")
           .agg(F.sum("total_revenue").cast(MONEY_SUM).alias("revenue")))
    return out.orderBy(F.desc_nulls_last("revenue")) if ordered else out
