"""Binding of the driver's test tables to the nine source roles (FIXTURES §2).

An order is a sale; a car is a run of twelve neighbouring part keys, which
are its bill of materials (so every part belongs to exactly one car, and cars
grow with the parts); a delivery is one supplier on one ship date. Every role is a lazy DataFrame over the test tables, so all work
grows with the data and Catalyst prunes columns down to the Parquet scans.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from torque.functions.money import MONEY, UNIT_PRICE
from torque.operators.keys import assign_surrogate_keys
from torque.schemas import SOURCE, conform

TEST_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations"]

# ---- fixed values of the bound configuration (FIXTURES §2) -------------------
# Segment of a car model (plays the reference's CASE over model names).
SEGMENT_BY_MODEL = {
    "Electric": ["PROMO"],
    "SUV": ["LARGE"],
    "Subcompact": ["ECONOMY"],
    "Compact": ["SMALL"],
}
# Region names kept as customer regions; nations of any other region -> 'Other'.
KEPT_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE"]
# calendar: the whole years spanned by the sales (1995-01-01 .. 2001-12-31 here)
AS_OF = dt.date(2001, 6, 30)           # QC-04 "current date"
NOW = dt.datetime(2001, 6, 30, 12, 0)  # load_ts of bound loads
PART_KEYS_PER_CAR = 12                 # part keys k with equal k div 12 make up one car
COLOR_WORDS = ["red", "blue"]
# ----------------------------------------------------------------------------


@dataclass
class Sources:
    """The nine source roles (bronze)."""
    supplier: DataFrame
    final_delivery: DataFrame
    category: DataFrame
    parts: DataFrame
    lot_delivery: DataFrame
    cars: DataFrame
    parts_car: DataFrame
    customers: DataFrame
    sales: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {k: getattr(self, k) for k in SOURCE}


@dataclass
class ModelConfig:
    """Parameters of the model: CASE lists, calendar range, clock values."""
    segment_by_model: dict[str, list[str]] | DataFrame
    region_by_province: dict[str, list[str]] | DataFrame
    calendar_start: dt.date | None       # None: span the years of the sales dates
    calendar_end: dt.date | None
    as_of: dt.date
    now: dt.datetime
    extra: dict = field(default_factory=dict)


def read_test_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _word(col: str, i: int):
    return F.split_part(F.col(col), F.lit(" "), F.lit(i))


def _car_of(part_key: str):
    return (F.floor(F.col(part_key) / PART_KEYS_PER_CAR) + 1).cast("long")


def bind_sources(spark: SparkSession, sf_dir: str) -> Sources:
    t = {n: read_test_table(spark, sf_dir, n)
         for n in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]}
    nation, region = t["nation"], t["region"]

    supplier = (t["supplier"]
                .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
                .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
                .select(F.col("s_suppkey").alias("supplier_id"),
                        F.col("s_name").alias("supplier_name"),
                        F.lit(None).cast("string").alias("address"),
                        F.col("n_name").alias("city"), F.col("r_name").alias("province")))

    customers = (t["customer"]
                 .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
                 .select(F.col("c_custkey").alias("customer_id"),
                         F.col("c_name").alias("customer_name"),
                         F.lit(None).cast("string").alias("address"),
                         F.lit(None).cast("string").alias("city"),
                         F.col("n_name").alias("province")))

    part = t["part"]
    # Category vocabulary: second word of the part name, numbered in name
    # order by the distributed key assignment (G1).
    category = assign_surrogate_keys(
        part.select(_word("p_name", 2).alias("category_name")).distinct(),
        "category_id", ["category_name"]).select("category_id", "category_name")

    parts = (part.join(category, _word("p_name", 2) == F.col("category_name"))
             .select(F.col("p_partkey").alias("part_id"), F.col("p_name").alias("part_name"),
                     F.when(_word("p_name", 1).isin(*COLOR_WORDS), _word("p_name", 1))
                     .alias("color"),
                     F.col("p_retailprice").cast(UNIT_PRICE).alias("unit_price"),
                     "category_id"))

    # A car takes brand and type of its first part.
    first = F.min(F.struct("p_partkey", "p_brand", "p_type")).alias("first")
    cars = (part.groupBy(_car_of("p_partkey").alias("car_id")).agg(first)
            .select("car_id", F.col("first.p_brand").alias("brand"),
                    F.col("first.p_type").alias("model"),
                    (F.lit(1995) + F.col("car_id") % 7).cast("int").alias("manufacture_year")))
    parts_car = part.select(_car_of("p_partkey").alias("car_id"), F.col("p_partkey").alias("part_id"),
                            (F.lit(1) + F.col("p_size") % 2).cast("int").alias("quantity"))

    li = t["lineitem"]
    lead_part = li.groupBy("l_orderkey").agg(F.min("l_partkey").alias("lead_part"))
    sales = (t["orders"]
             .join(lead_part, F.col("o_orderkey") == F.col("l_orderkey"), "left")
             .select(F.col("o_orderkey").alias("sale_id"), F.col("o_custkey").alias("customer_id"),
                     _car_of("lead_part").alias("car_id"),
                     F.col("o_orderdate").cast("date").alias("sale_date"),
                     F.col("o_totalprice").cast(MONEY).alias("sale_price")))

    ship = F.col("l_shipdate")

    def delivery_id(day):
        return (F.col("l_suppkey") * 100000000 + F.year(day) * 10000
                + F.month(day) * 100 + F.dayofmonth(day))
    # the id follows from supplier and day, so only these two are shuffled
    final_delivery = (li.select("l_suppkey", ship.cast("date").alias("delivery_date")).distinct()
                      .select(delivery_id(F.col("delivery_date")).alias("delivery_id"),
                              F.col("l_suppkey").alias("supplier_id"), "delivery_date"))
    lot_delivery = (li.groupBy("l_suppkey", "l_partkey", "l_shipdate")
                    .agg(F.sum("l_quantity").alias("q"))
                    .select(delivery_id(ship).alias("delivery_id"), F.col("l_partkey").alias("part_id"),
                            ship.cast("date").alias("delivery_date"),
                            F.col("q").cast("int").alias("quantity")))

    roles = dict(supplier=supplier, final_delivery=final_delivery, category=category,
                 parts=parts, lot_delivery=lot_delivery, cars=cars, parts_car=parts_car,
                 customers=customers, sales=sales)
    return Sources(**{k: conform(v, SOURCE[k]) for k, v in roles.items()})


def bind_config(spark: SparkSession, sf_dir: str) -> ModelConfig:
    """Bound configuration: region map derived from nation x region."""
    nation = read_test_table(spark, sf_dir, "nation")
    region = read_test_table(spark, sf_dir, "region")
    region_map = (nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
                  .filter(F.col("r_name").isin(*KEPT_REGIONS))
                  .select(F.col("n_name").alias("province"), F.col("r_name").alias("region")))
    return ModelConfig(segment_by_model=SEGMENT_BY_MODEL, region_by_province=region_map,
                       calendar_start=None, calendar_end=None,
                       as_of=AS_OF, now=NOW)
