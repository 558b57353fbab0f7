"""Scale-out check: generated 10^6 .. 10^7 sales through the whole model.

    python tools/scale_bench.py SCRATCH_DIR [n_sales ...]

Sources come from the torque generators (deliveries = sales / 20,
customers = sales / 10, 1,000 suppliers, 20,000 parts, 150 cars with 12 BOM
lines each), are loaded as bronze snapshots, then timed: the costed sales
(W1), the as-of link (F2), the full gold build, and two reports. Prints one
JSON line per size; near-linear growth is the expectation.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from torque.config import SEGMENT_BY_MODEL, default_config  # noqa: E402
from torque.functions.hashing import pick, uniform_int  # noqa: E402
from torque.operators import reports  # noqa: E402
from torque.operators.asof import supplier_as_of  # noqa: E402
from torque.plans.warehouse import build_silver, load_bronze, load_gold  # noqa: E402
from torque.schemas import SOURCE, conform  # noqa: E402
from torque.session import get_session  # noqa: E402
from torque.sources import generators as G  # noqa: E402
from torque.sources.bindings import Sources  # noqa: E402
from torque.sources.sinks import SnapshotStore  # noqa: E402

N_PARTS, N_CARS, BOM_LINES, N_SUPPLIERS, SEED = 20000, 150, 12, 1000, 7
MODELS = sorted(m for models in SEGMENT_BY_MODEL.values() for m in models)
BRANDS = ["North", "Meridian", "Alba"]
CATEGORIES = ["Drive", "Shell", "Wiring", "Cabin", "Frame"]


def sources(spark, n_sales: int) -> Sources:
    k = F.col("id")
    category = spark.createDataFrame(list(enumerate(CATEGORIES, 1)), "category_id long, category_name string")
    parts = spark.range(1, N_PARTS + 1).select(
        k.alias("part_id"), F.concat(F.lit("part "), k.cast("string")).alias("part_name"),
        F.lit(None).cast("string").alias("color"),
        (uniform_int(SEED, k, "price", 500, 200000) / 100).cast("decimal(10,2)").alias("unit_price"),
        uniform_int(SEED, k, "cat", 1, len(CATEGORIES)).alias("category_id"))
    cars = spark.range(1, N_CARS + 1).select(
        k.alias("car_id"), pick(BRANDS, SEED, k, "brand").alias("brand"),
        F.concat(pick(MODELS, SEED, k, "model"), F.lit(" "), k.cast("string")).alias("model"),
        uniform_int(SEED, k, "year", 2015, 2024).cast("int").alias("manufacture_year"))
    parts_car = (spark.range(1, N_CARS + 1)
                 .select(k.alias("car_id"), F.explode(F.sequence(F.lit(0), F.lit(BOM_LINES - 1))).alias("j"))
                 .select("car_id", uniform_int(SEED, F.concat_ws("|", "car_id", "j"), "bom", 1, N_PARTS).alias("part_id"))
                 .distinct()
                 .withColumn("quantity", uniform_int(SEED, F.concat_ws("|", "car_id", "part_id"), "qty", 1, 2).cast("int")))
    final, lots = G.gen_deliveries(spark.range(1001, 1001 + max(n_sales // 20, 1)), N_SUPPLIERS,
                                   parts.select(F.col("part_id").alias("part_idx"), "part_id"), N_PARTS,
                                   seed=SEED)
    prices = (parts_car.join(parts, "part_id").groupBy("car_id")
              .agg((F.sum(F.col("unit_price") * F.col("quantity")) * 2).cast("decimal(12,2)").alias("base_price"))
              .withColumn("car_idx", F.col("car_id")))
    sales = G.gen_sales(spark.range(1, n_sales + 1), max(n_sales // 10, 1), prices, N_CARS, seed=SEED)
    raw = dict(supplier=G.gen_suppliers(spark.range(1, N_SUPPLIERS + 1), SEED),
               customers=G.gen_customers(spark.range(1, max(n_sales // 10, 1) + 1), SEED),
               category=category, parts=parts, cars=cars, parts_car=parts_car,
               final_delivery=final, lot_delivery=lots, sales=sales)
    return Sources(**{t: conform(df, SOURCE[t]) for t, df in raw.items()})


def timed(out: dict, name: str, fn):
    t = time.time()
    r = fn()
    out[name] = round(time.time() - t, 2)
    return r


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    scratch = sys.argv[1]
    sizes = [int(x) for x in sys.argv[2:]] or [1_000_000, 10_000_000]
    spark = get_session("local[8]", shuffle_partitions=16, extra={"spark.driver.memory": "16g"},
                        checkpoint_dir=tempfile.mkdtemp(prefix="torque-tool-"))
    cfg = default_config()
    for n in sizes:
        t: dict = {}
        store = SnapshotStore(spark, f"{scratch}/wh_{n}")
        src = timed(t, "generate_load", lambda: load_bronze(spark, sources(spark, n), store))
        silver = build_silver(src)
        timed(t, "stg_sales", lambda: noop(silver.sales))
        timed(t, "supplier_as_of", lambda: noop(supplier_as_of(silver.sales, silver.final_delivery)))
        gold = timed(t, "gold_build", lambda: load_gold(spark, silver, cfg, store=store))
        timed(t, "rpt_parts_cost_by_segment", lambda: noop(reports.rpt_parts_cost_by_segment(
            gold.fact_sales, gold.dim_car, gold.dim_part, silver.parts_car)))
        timed(t, "rpt_monthly_trend", lambda: noop(reports.rpt_monthly_trend(gold.fact_sales, gold.dim_time)))
        print(json.dumps({"n_sales": n, "fact_rows": gold.fact_sales.count(), "sec": t}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
