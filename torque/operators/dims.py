"""D2-D5 — dimension sources and their MERGE loads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from torque.operators.joins import broadcast_checked
from torque.operators.merge import merge_upsert
from torque.operators.staging import bom_counts

OTHER = "Other"


def map_or_other(df: DataFrame, col: str, mapping, out: str,
                 map_key: str | None = None, map_value: str | None = None) -> DataFrame:
    """Add ``out`` = label of ``col`` under ``mapping``, else 'Other'.

    ``mapping`` is either ``{label: [values...]}`` (a searched CASE, first
    matching label wins, as in the reference) or a DataFrame of
    (value, label) rows for large maps; the latter is deduplicated per value
    (smallest label) and joined after a size check.
    """
    if isinstance(mapping, dict):
        expr: Column | None = None
        for label, values in mapping.items():
            cond = F.col(col).isin(*values)
            expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
        return df.withColumn(out, F.lit(OTHER) if expr is None else expr.otherwise(F.lit(OTHER)))
    k, v = map_key or mapping.columns[0], map_value or mapping.columns[1]
    lookup = (mapping.groupBy(F.col(k).alias("_mk")).agg(F.min(v).alias("_mv")))
    lookup = broadcast_checked(lookup, checkpoint=False)
    return (df.join(lookup, df[col] == lookup["_mk"], "left")
            .withColumn(out, F.coalesce(F.col("_mv"), F.lit(OTHER))).drop("_mk", "_mv"))


def dim_customer_source(stg_customers: DataFrame, region_by_province) -> DataFrame:
    """D2 source rows: staged customers + region derived from province."""
    base = stg_customers.select("customer_id", "customer_name", "address", "city", "province")
    return map_or_other(base, "province", region_by_province, "region")


def dim_supplier_source(stg_supplier: DataFrame) -> DataFrame:
    """D3 source rows."""
    return stg_supplier.select("supplier_id", "supplier_name", "address", "city", "province")


def dim_part_source(stg_parts: DataFrame) -> DataFrame:
    """D4 source rows (category denormalised into the part)."""
    return stg_parts.select("part_id", "part_name", "color", "unit_price", "category_id",
                            "category_name")


def dim_car_source(stg_cars: DataFrame, stg_parts_car: DataFrame, segment_by_model) -> DataFrame:
    """D5 source rows: cars with BOM counts and segment; cars without BOM drop."""
    counts = bom_counts(stg_parts_car).select(
        "car_id", F.col("unique_parts_count").alias("unique_parts"), "total_parts_qty")
    cars = (stg_cars.join(counts, "car_id")
            .withColumn("brand_model", F.concat(F.col("brand"), F.lit(" "), F.col("model"))))
    cars = map_or_other(cars, "model", segment_by_model, "segment")
    return cars.select("car_id", "brand", "model", "manufacture_year", "brand_model", "segment",
                       "unique_parts", "total_parts_qty")


def load_dim(target: DataFrame | None, source: DataFrame, key: str, surrogate: str,
             now: dt.datetime) -> DataFrame:
    """MERGE a dimension source into its current table (None = empty).

    Dimension sources are scans of the bronze tables plus column
    expressions, cheap to re-read, so they are not checkpointed first.
    """
    return merge_upsert(target, source, key, surrogate, now, materialize_source=False)
