"""F2 — link each sale to the latest delivery on or before its date.

The reference ranks, for every sale, all deliveries with
``delivery_date <= sale_date`` (a theta join: O(sales x deliveries); Spark
plans it as a broadcast nested-loop join). Only the date order matters, so
the plan here is linear (SURVEY W2):

1. one winner per delivery day: the delivery with the greatest
   delivery_id (deterministic tie-break for same-day deliveries);
   ``max_by`` is partially aggregated before the shuffle, so a hot day
   costs one row per map task;
2. the distinct sale days (also partially aggregated);
3. full outer join of the two on the day, then carry the last winner
   forward in date order (``last(..., ignorenulls)`` over a running frame);
4. equi-join the sales to that per-day table.

Steps 1-3 produce one row per distinct DATE, so the per-day table is
bounded by the date domain and is broadcast; the sales never shuffle.
Sales dated before the first delivery get no supplier and drop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from torque.operators.joins import broadcast_bounded


def supplier_by_day(deliveries: DataFrame, sale_days: DataFrame) -> DataFrame:
    """(day, supplier_id, delivery_date, delivery_id) of the latest delivery <= day."""
    # two fixed-width aggregates (long, long) keep this a partial + final
    # hash aggregate; a struct-valued max_by would force a sort aggregate
    winners = (deliveries.filter(F.col("delivery_date").isNotNull())
               .groupBy(F.col("delivery_date").alias("day"))
               .agg(F.max_by("supplier_id", "delivery_id").alias("w_supplier"),
                    F.max("delivery_id").alias("w_delivery")))
    days = winners.join(sale_days.select(F.col("sale_date").alias("day")), "day", "full_outer")
    running = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = days.select(
        "day",
        F.last(F.when(F.col("w_delivery").isNotNull(),
                      F.struct(F.col("w_supplier").alias("supplier_id"),
                               F.col("day").alias("delivery_date"),
                               F.col("w_delivery").alias("delivery_id"))),
               ignorenulls=True).over(running).alias("link"))
    return (filled.filter(F.col("link").isNotNull())
            .select("day", "link.supplier_id", "link.delivery_date", "link.delivery_id"))


def supplier_as_of(sales: DataFrame, deliveries: DataFrame,
                   with_delivery: bool = False, dates: DataFrame | None = None) -> DataFrame:
    """``sales`` + supplier_id of the latest delivery with date <= sale_date
    (+ that delivery's date and id with ``with_delivery``). ``dates``: where to
    take the sale days from, if they are cheaper to read elsewhere."""
    sale_days = ((sales if dates is None else dates).filter(F.col("sale_date").isNotNull())
                 .select("sale_date").distinct())
    extra = ["delivery_date", "delivery_id"] if with_delivery else []
    per_day = broadcast_bounded(supplier_by_day(deliveries, sale_days)
                                .select(F.col("day").alias("_day"), "supplier_id", *extra))
    return sales.join(per_day, sales["sale_date"] == per_day["_day"]).drop("_day")
