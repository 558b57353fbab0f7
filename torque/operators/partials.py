"""R1, R3, R4, R5 kept up month by month.

A month table of partial aggregates, one row per (month, car, supplier), stands
beside the fact. Its manifest remembers which version of each of the fact's
months it was made from, so a refresh reads and replaces exactly the months
that loads have rewritten since. Reports add the partials up: sums and counts
are additive, averages and ratios are worked out from them at the end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from torque.functions.money import MONEY_SUM, round_div
from torque.operators.joins import broadcast_bounded
from torque.operators.reports import with_growth
from torque.sources.parts import MONTH, MonthTable

_SUMS = ("sale_price", "total_parts_cost", "gross_margin", "gross_margin_pct")


def month_partials(fact: DataFrame) -> DataFrame:
    """One row per (sale_month, car_key, supplier_key): rows, sums and counts."""
    return fact.groupBy(MONTH, "car_key", "supplier_key").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"sum_{c}") for c in _SUMS],
        F.count("sale_price").alias("n_price"), F.count("gross_margin_pct").alias("n_pct"))


def refresh_months(kept: MonthTable, fact: MonthTable,
                   make: Callable[[DataFrame], DataFrame], rebalance: bool = True) -> list[int]:
    """Bring a table made month by month from ``fact`` up to its newest manifest; returns
    the months that were worked out anew or ended. Only their files are read and written."""
    now = fact.manifest()["parts"]
    state = kept.manifest()
    made_from = {} if state is None else {int(m): v for m, v in state["note"].items()}
    stale = sorted(m for m in now.keys() | made_from.keys() if now.get(m) != made_from.get(m))
    if stale or state is None:
        kept.write(make(fact.read(stale)), stale, note=now, rebalance=rebalance)
    return stale


def refresh_partials(partials: MonthTable, fact: MonthTable) -> list[int]:
    """``refresh_months`` of the partials, which are written as the aggregation deals them."""
    return refresh_months(partials, fact, month_partials, rebalance=False)


def _added(column: str):
    return F.sum(f"sum_{column}")


def _total(column: str):
    return _added(column).cast(MONEY_SUM)


def _sales():
    return F.sum("n").cast("long")


def _margin_pct():
    return round_div(_added("gross_margin_pct"), F.sum("n_pct"), num_scale=4, den_scale=0,
                     out_scale=2, factor=100)


def _calendar(dim_time: DataFrame, *columns: str) -> DataFrame:
    """The months of a calendar, which must hold them whole: partials do not know days."""
    months = dim_time.groupBy("year", "month", *columns).agg(F.count(F.lit(1)).alias("_days"))
    whole = F.day(F.last_day(F.make_date("year", "month", F.lit(1))))
    if not months.filter(F.col("_days") != whole).isEmpty():
        raise ValueError("the calendar begins or ends within a month")
    return broadcast_bounded(months.select(
        "year", "month", *columns, (F.col("year") * 100 + F.col("month")).alias(MONTH)))


def revenue_by_brand(partials: DataFrame, dim_car: DataFrame, dim_time: DataFrame) -> DataFrame:
    """R1 from the partials."""
    return (partials.join(dim_car.select("car_key", "brand"), "car_key")
            .join(_calendar(dim_time, "quarter_name"), MONTH)
            .groupBy("year", "quarter_name", "brand")
            .agg(_sales().alias("total_sales"), _total("sale_price").alias("total_revenue"),
                 _total("total_parts_cost").alias("total_parts_cost"),
                 _total("gross_margin").alias("total_gross_margin"),
                 _margin_pct().alias("avg_margin_pct"),
                 round_div(_added("sale_price"), F.sum("n_price"), num_scale=2, den_scale=0,
                           out_scale=2).alias("avg_sale_price")))


def model_profitability(partials: DataFrame, dim_car: DataFrame) -> DataFrame:
    """R3 from the partials."""
    group = ["brand", "model", "brand_model", "segment", "manufacture_year"]
    return (partials.join(dim_car.select("car_key", *group), "car_key").groupBy(*group)
            .agg(_sales().alias("units_sold"), _total("sale_price").alias("total_revenue"),
                 _total("total_parts_cost").alias("total_parts_cost"),
                 _total("gross_margin").alias("total_gross_margin"),
                 _margin_pct().alias("avg_margin_pct"),
                 round_div(_added("gross_margin"), F.sum("n"), num_scale=2, den_scale=0,
                           out_scale=2).alias("margin_per_unit")))


def supplier_performance(partials: DataFrame, dim_supplier: DataFrame,
                         dim_time: DataFrame) -> DataFrame:
    """R4 from the partials."""
    supplier = dim_supplier.select("supplier_key", "supplier_name",
                                   F.col("city").alias("supplier_city"))
    return (partials.join(supplier, "supplier_key").join(_calendar(dim_time, "quarter_name"), MONTH)
            .groupBy("supplier_name", "supplier_city", "year", "quarter_name")
            .agg(_sales().alias("sales_linked"),
                 _total("total_parts_cost").alias("parts_value_supplied"),
                 _total("sale_price").alias("revenue_enabled"),
                 round_div(_added("total_parts_cost"), _added("sale_price"), num_scale=2,
                           den_scale=2, out_scale=2, factor=100).alias("cost_to_revenue_pct")))


def monthly_trend(partials: DataFrame, dim_time: DataFrame) -> DataFrame:
    """R5 from the partials."""
    return with_growth(
        partials.join(_calendar(dim_time, "month_short"), MONTH)
        .groupBy("year", "month", "month_short")
        .agg(_sales().alias("total_sales"), _total("sale_price").alias("total_revenue"),
             _total("gross_margin").alias("total_gross_margin"),
             _margin_pct().alias("avg_margin_pct")))
