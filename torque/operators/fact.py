"""F1/F3 — the sales fact: natural keys resolved to surrogate keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from torque.functions.dates import date_key
from torque.functions.money import MARGIN_PCT, MONEY, round_div
from torque.operators.asof import supplier_by_day
from torque.operators.joins import broadcast_bounded, broadcast_checked
from torque.operators.merge import merge_upsert
from torque.operators.staging import bom_counts


def gross_margin_pct(margin: Column, price: Column) -> Column:
    """F3 — ``ROUND(margin / NULLIF(price, 0), 4)`` as DECIMAL(6,4).

    Both operands are DECIMAL(12,2) and the ratio is rounded exactly, so no
    intermediate 6-digit rounding can flip the 4th decimal. A value beyond
    +-99.9999 does not fit the declared type and raises (ANSI cast).
    """
    return round_div(margin, price, num_scale=2, den_scale=2, out_scale=4, out_type=MARGIN_PCT)


def fact_source(stg_sales: DataFrame, stg_final_delivery: DataFrame, stg_parts_car: DataFrame,
                dim_car: DataFrame, dim_customer: DataFrame, dim_supplier: DataFrame,
                sales_dates: DataFrame | None = None) -> DataFrame:
    """Rows to MERGE into FACT_SALES (without sale_key / load_ts).

    All joins are inner, as in the reference: a sale without a car, customer
    or supplier in the dimensions, without BOM, or dated before the first
    delivery does not load. The calendar is not joined here, so sales outside
    it load and only vanish from calendar-based reports.

    Small sides are broadcast after a size check; above the limit they stay
    shuffle joins on the dimension key (AQE splits skewed keys).
    ``sales_dates`` (default: the staged sales) gives the days to link; the
    raw sales are the cheaper source, a scan of one column.
    """
    # The supplier depends only on the sale day: resolve day -> supplier_key
    # on the per-day table (one row per distinct date, domain-bounded) so the
    # sales stream never joins the supplier dimension. The forward fill runs
    # before the dimension join, so a winner missing from the dimension drops
    # its sales, as the reference's inner join does.
    dates = stg_sales if sales_dates is None else sales_dates
    sale_days = dates.filter(F.col("sale_date").isNotNull()).select("sale_date").distinct()
    per_day = supplier_by_day(stg_final_delivery, sale_days).select("day", "supplier_id")
    day_key = (broadcast_bounded(per_day)
               .join(dim_supplier.select("supplier_id", "supplier_key"), "supplier_id")
               .select(F.col("day").alias("_day"), "supplier_key"))
    # dimensions arrive as file-backed gold tables: Spark's planner sizes them
    # from file statistics (broadcast below the threshold, else a shuffle
    # join with AQE skew splitting); the derived BOM counts are checked
    car = dim_car.select("car_id", "car_key")
    cust = dim_customer.select("customer_id", "customer_key")
    counts = broadcast_checked(bom_counts(stg_parts_car))
    joined = (stg_sales.join(broadcast_bounded(day_key), F.col("sale_date") == F.col("_day"))
              .join(car, "car_id").join(cust, "customer_id").join(counts, "car_id"))
    return joined.select(
        "car_key", "customer_key", "supplier_key",
        date_key(F.col("sale_date")).alias("time_id"), "sale_id",
        F.col("sale_price").cast(MONEY).alias("sale_price"),
        F.col("total_parts_cost").cast(MONEY).alias("total_parts_cost"),
        F.col("gross_margin").cast(MONEY).alias("gross_margin"),
        gross_margin_pct(F.col("gross_margin"), F.col("sale_price")).alias("gross_margin_pct"),
        "unique_parts_count", "total_parts_qty")


def load_fact(target: DataFrame | None, source: DataFrame, now: dt.datetime) -> DataFrame:
    """MERGE the fact source on sale_id; columns in the declared order."""
    merged = merge_upsert(target, source, "sale_id", "sale_key", now)
    return merged.select("sale_key", "car_key", "customer_key", "supplier_key", "time_id",
                         "sale_id", "sale_price", "total_parts_cost", "gross_margin",
                         "gross_margin_pct", "unique_parts_count", "total_parts_qty", "load_ts")
