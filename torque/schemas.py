"""Declared schemas of the source roles, silver views and gold tables."""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, DateType, IntegerType, LongType,
                               StringType, StructField, StructType,
                               TimestampNTZType)

from torque.functions.money import MARGIN_PCT, MONEY, UNIT_PRICE


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


L, I, S, D = LongType(), IntegerType(), StringType(), DateType()

# ---- bronze / source roles -------------------------------------------------
SOURCE = {
    "supplier": _s(("supplier_id", L, True), ("supplier_name", S, True), ("address", S, True),
                   ("city", S, True), ("province", S, True)),
    "final_delivery": _s(("delivery_id", L, True), ("supplier_id", L, True),
                         ("delivery_date", D, True)),
    "category": _s(("category_id", L, True), ("category_name", S, True)),
    "parts": _s(("part_id", L, True), ("part_name", S, True), ("color", S, True),
                ("unit_price", UNIT_PRICE, True), ("category_id", L, True)),
    "lot_delivery": _s(("delivery_id", L, True), ("part_id", L, True), ("delivery_date", D, True),
                       ("quantity", I, True)),
    "cars": _s(("car_id", L, True), ("brand", S, True), ("model", S, True),
               ("manufacture_year", I, True)),
    "parts_car": _s(("car_id", L, True), ("part_id", L, True), ("quantity", I, True)),
    "customers": _s(("customer_id", L, True), ("customer_name", S, True), ("address", S, True),
                    ("city", S, True), ("province", S, True)),
    "sales": _s(("sale_id", L, True), ("customer_id", L, True), ("car_id", L, True),
                ("sale_date", D, True), ("sale_price", MONEY, True)),
}

# Parents before children: the load order of the reference loader.
LOAD_ORDER = ["supplier", "customers", "category", "parts", "cars", "parts_car",
              "final_delivery", "lot_delivery", "sales"]

# Primary keys and declared foreign keys of the source schema.
PRIMARY_KEYS = {
    "supplier": ["supplier_id"], "final_delivery": ["delivery_id"], "category": ["category_id"],
    "parts": ["part_id"], "lot_delivery": ["delivery_id", "part_id"], "cars": ["car_id"],
    "parts_car": ["car_id", "part_id"], "customers": ["customer_id"], "sales": ["sale_id"],
}
FOREIGN_KEYS = [  # (child, fk column, parent, parent key)
    ("final_delivery", "supplier_id", "supplier", "supplier_id"),
    ("parts", "category_id", "category", "category_id"),
    ("lot_delivery", "delivery_id", "final_delivery", "delivery_id"),
    ("lot_delivery", "part_id", "parts", "part_id"),
    ("parts_car", "car_id", "cars", "car_id"),
    ("parts_car", "part_id", "parts", "part_id"),
    ("sales", "customer_id", "customers", "customer_id"),
    ("sales", "car_id", "cars", "car_id"),
]

TS = TimestampNTZType()

# ---- gold ------------------------------------------------------------------
DIM_TIME = _s(("time_id", I, False), ("full_date", D, False), ("year", I, False),
              ("quarter", I, False), ("quarter_name", S, False), ("month", I, False),
              ("month_name", S, False), ("month_short", S, False), ("week_of_year", I, False),
              ("day_of_month", I, False), ("day_of_week", I, False), ("day_name", S, False),
              ("is_weekend", BooleanType(), False))

DIM_CUSTOMER = _s(("customer_key", L, False), ("customer_id", L, False), ("customer_name", S, True),
                  ("address", S, True), ("city", S, True), ("province", S, True),
                  ("region", S, True), ("load_ts", TS, False))
DIM_SUPPLIER = _s(("supplier_key", L, False), ("supplier_id", L, False), ("supplier_name", S, True),
                  ("address", S, True), ("city", S, True), ("province", S, True),
                  ("load_ts", TS, False))
DIM_PART = _s(("part_key", L, False), ("part_id", L, False), ("part_name", S, True),
              ("color", S, True), ("unit_price", UNIT_PRICE, True), ("category_id", L, True),
              ("category_name", S, True), ("load_ts", TS, False))
DIM_CAR = _s(("car_key", L, False), ("car_id", L, False), ("brand", S, True), ("model", S, True),
             ("manufacture_year", I, True), ("brand_model", S, True), ("segment", S, True),
             ("unique_parts", I, True), ("total_parts_qty", I, True), ("load_ts", TS, False))
FACT_SALES = _s(("sale_key", L, False), ("car_key", L, False), ("customer_key", L, False),
                ("supplier_key", L, False), ("time_id", I, False), ("sale_id", L, False),
                ("sale_price", MONEY, False), ("total_parts_cost", MONEY, False),
                ("gross_margin", MONEY, False), ("gross_margin_pct", MARGIN_PCT, True),
                ("unique_parts_count", I, False), ("total_parts_qty", I, False),
                ("load_ts", TS, False))

GOLD = {"dim_time": DIM_TIME, "dim_customer": DIM_CUSTOMER, "dim_supplier": DIM_SUPPLIER,
        "dim_part": DIM_PART, "dim_car": DIM_CAR, "fact_sales": FACT_SALES}

# (surrogate key, natural key) of each keyed gold table
GOLD_KEYS = {"dim_customer": ("customer_key", "customer_id"),
             "dim_supplier": ("supplier_key", "supplier_id"),
             "dim_part": ("part_key", "part_id"), "dim_car": ("car_key", "car_id"),
             "fact_sales": ("sale_key", "sale_id")}


def conform(df, schema: StructType):
    """Select ``schema``'s columns by name, cast to the declared types."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
