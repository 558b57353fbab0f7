"""Silver staging views V1-V9 and the shared BOM sub-aggregates B1/B2.

Each view is a pure ``DataFrame -> DataFrame`` function (zero copy, like the
reference's views). ``now`` adds the audit column ``load_ts``; omit it to get
a deterministic frame.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from torque.functions.money import MONEY, UNIT_PRICE
from torque.operators.joins import broadcast_checked

UNKNOWN = "Unknown"


def _clean(col: str) -> Column:
    """``TRIM(COALESCE(col, 'Unknown'))``: NULL -> 'Unknown', blank stays ''."""
    return F.trim(F.coalesce(F.col(col), F.lit(UNKNOWN)))


def _audit(df: DataFrame, now: dt.datetime | None) -> DataFrame:
    if now is None:
        return df
    return df.withColumn("load_ts", F.lit(now).cast("timestamp_ntz"))


def stg_supplier(supplier: DataFrame, now=None) -> DataFrame:
    """V1."""
    return _audit(supplier.select("supplier_id", F.trim("supplier_name").alias("supplier_name"),
                                  _clean("address").alias("address"), _clean("city").alias("city"),
                                  _clean("province").alias("province")), now)


def stg_customers(customers: DataFrame, now=None) -> DataFrame:
    """V2."""
    return _audit(customers.select("customer_id", F.trim("customer_name").alias("customer_name"),
                                   _clean("address").alias("address"), _clean("city").alias("city"),
                                   _clean("province").alias("province")), now)


def stg_cars(cars: DataFrame, now=None) -> DataFrame:
    """V3."""
    return _audit(cars.select("car_id", F.trim("brand").alias("brand"), F.trim("model").alias("model"),
                              F.col("manufacture_year").cast("int").alias("manufacture_year")), now)


def stg_category(category: DataFrame, now=None) -> DataFrame:
    """V4."""
    return _audit(category.select("category_id", F.trim("category_name").alias("category_name")), now)


def stg_parts(parts: DataFrame, category: DataFrame, now=None) -> DataFrame:
    """V5 — parts with their category; the inner join drops orphan parts."""
    cat = category.select(F.col("category_id").alias("c_id"),
                          F.trim("category_name").alias("category_name"))
    return _audit(parts.join(cat, parts["category_id"] == cat["c_id"])
                  .select("part_id", F.trim("part_name").alias("part_name"),
                          _clean("color").alias("color"),
                          F.col("unit_price").cast(UNIT_PRICE).alias("unit_price"),
                          "category_id", "category_name"), now)


def bom_cost(parts_car: DataFrame, parts: DataFrame) -> DataFrame:
    """B1 — car_id -> SUM(unit_price * quantity) over its bill of materials.

    Uses the raw parts (a part without category still costs), as the
    reference's staging view does.
    """
    return (parts_car.join(parts.select("part_id", "unit_price"), "part_id")
            .groupBy("car_id")
            .agg(F.sum(F.col("unit_price") * F.col("quantity")).cast(MONEY)
                 .alias("total_parts_cost")))


def bom_counts(parts_car: DataFrame) -> DataFrame:
    """B2 — car_id -> COUNT(DISTINCT part_id), SUM(quantity)."""
    return (parts_car.groupBy("car_id")
            .agg(F.countDistinct("part_id").cast("int").alias("unique_parts_count"),
                 F.sum("quantity").cast("int").alias("total_parts_qty")))


def stg_sales(sales: DataFrame, parts_car: DataFrame, parts: DataFrame, now=None) -> DataFrame:
    """V6 — sales costed by their car's BOM (eager aggregation, SURVEY W1).

    The BOM is summed per car first (one row per car) and then joined N:1 to
    the sales, instead of fanning every sale out to its parts and regrouping.
    Equal to the reference's grouped join when sale_id is unique (QC-05;
    ``merge_upsert`` also rejects duplicate keys). Sales whose car has no BOM
    drop (inner join). The per-car table is broadcast only when its counted
    size allows; otherwise it is a shuffle join and AQE splits hot cars.
    """
    cost = broadcast_checked(bom_cost(parts_car, parts))
    return _audit(sales.join(cost, "car_id")
                  .select("sale_id", "customer_id", "car_id",
                          F.col("sale_date").cast("date").alias("sale_date"),
                          F.col("sale_price").cast(MONEY).alias("sale_price"),
                          "total_parts_cost",
                          (F.col("sale_price").cast(MONEY) - F.col("total_parts_cost"))
                          .cast(MONEY).alias("gross_margin")), now)


def stg_parts_car(parts_car: DataFrame, now=None) -> DataFrame:
    """V7."""
    return _audit(parts_car.select("car_id", "part_id", "quantity"), now)


def stg_final_delivery(final_delivery: DataFrame, now=None) -> DataFrame:
    """V8."""
    return _audit(final_delivery.select("delivery_id", "supplier_id",
                                        F.col("delivery_date").cast("date").alias("delivery_date")),
                  now)


def stg_lot_delivery(lot_delivery: DataFrame, now=None) -> DataFrame:
    """V9 (no downstream consumer in the model; kept for completeness of silver)."""
    return _audit(lot_delivery.select("delivery_id", "part_id",
                                      F.col("delivery_date").cast("date").alias("delivery_date"),
                                      F.col("quantity").alias("quantity_delivered")), now)
