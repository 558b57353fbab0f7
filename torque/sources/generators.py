"""S4-S9 — deterministic synthetic source data, generated on the executors.

Every generator takes a DataFrame of row keys (column ``id``) instead of a
count, so the key set can be ``spark.range(...)`` or the keys of an existing
table; attributes are hash draws of (seed, key, tag) (``torque.functions
.hashing``), so output does not depend on partitioning or task retries and
no row is built on the driver. The *distribution contract* is the reference generator's:

* suppliers / customers: name, street address, (city, province) from fixed lists;
* deliveries: date uniform on a range, supplier uniform, 2-5 distinct parts
  per delivery, lot quantity 20-200, lot date = delivery date;
* sales: car uniform over a price list, price = base x (1 +- 10 %) rounded to
  cents, date uniform on the range, customer uniform.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from torque.config import GENERATOR_END, GENERATOR_START
from torque.functions.hashing import draw, pick, uniform_int
from torque.functions.money import MONEY
from torque.operators.joins import broadcast_checked

# Own vocabularies. The provinces are those that the default region map knows.
TRADES = ["Bearings", "Castings", "Harnesses", "Springs", "Gaskets", "Mouldings", "Sensors",
          "Fasteners"]
FORMS = ["Works", "Group", "Brothers", "Partners", "Union"]
PLACES = [("Reus", "Tarragona"), ("Ronda", "Malaga"), ("Elche", "Alicante"), ("Getafe", "Madrid"),
          ("Irun", "Guipuzcoa"), ("Motril", "Granada"), ("Figueres", "Girona"), ("Jerez", "Cadiz"),
          ("Getxo", "Vizcaya"), ("Teruel", "Teruel"), ("Gandia", "Valencia"), ("Balaguer", "Lleida")]
STREETS = ["Calle Mayor", "Avenida del Puerto", "Calle del Sol", "Paseo de la Ribera",
           "Calle Nueva", "Avenida de la Estacion", "Calle del Mar", "Plaza Central"]
FIRST_NAMES = ["Ana", "Luis", "Marta", "Jordi", "Lucia", "Pablo", "Elena", "Diego", "Nuria",
               "Javier", "Carmen", "Pau"]
LAST_NAMES = ["Garcia", "Martinez", "Lopez", "Sanchez", "Puig", "Ferrer", "Romero", "Navarro",
              "Vidal", "Torres"]


MOST_PARTS = 5    # of a delivery


def key_range(spark, n: int, start: int = 1) -> DataFrame:
    """Keys ``start .. start + n - 1`` as the ``id`` column, generated on the
    executors: ``gen_suppliers(key_range(spark, 10))`` is the reference's
    ``n=10`` form; deliveries use ``key_range(spark, n, 1001)``."""
    return spark.range(start, start + n)


def _place(seed: int, key, tag: str):
    idx = (draw(seed, key, tag) % len(PLACES) + 1).cast("int")
    arr = F.array(*[F.struct(F.lit(c).alias("city"), F.lit(p).alias("province")) for c, p in PLACES])
    return F.element_at(arr, idx)


def _street(seed: int, key, tag: str, max_number: int):
    return F.concat(uniform_int(seed, key, f"{tag}.no", 1, max_number).cast("string"), F.lit(" "),
                    pick(STREETS, seed, key, f"{tag}.street"))


def gen_suppliers(ids: DataFrame, seed: int = 42) -> DataFrame:
    """S4 — suppliers for the keys in ``ids.id``."""
    k = F.col("id")
    place = _place(seed, k, "supplier.place")
    return ids.select(k.cast("long").alias("supplier_id"),
                      F.concat(pick(TRADES, seed, k, "supplier.trade"), F.lit(" "),
                               pick(FORMS, seed, k, "supplier.form")).alias("supplier_name"),
                      _street(seed, k, "supplier.address", 200).alias("address"),
                      place["city"].alias("city"), place["province"].alias("province"))


def gen_customers(ids: DataFrame, seed: int = 42) -> DataFrame:
    """S5 — customers for the keys in ``ids.id``."""
    k = F.col("id")
    place = _place(seed, k, "customer.place")
    return ids.select(k.cast("long").alias("customer_id"),
                      F.concat(pick(FIRST_NAMES, seed, k, "customer.first"), F.lit(" "),
                               pick(LAST_NAMES, seed, k, "customer.last")).alias("customer_name"),
                      _street(seed, k, "customer.address", 300).alias("address"),
                      place["city"].alias("city"), place["province"].alias("province"))


def bom_explode(bom_map: DataFrame) -> DataFrame:
    """S7 — (car_id, parts array<struct<part_id, quantity>>) -> one row per BOM line."""
    return (bom_map.select("car_id", F.explode("parts").alias("p"))
            .select("car_id", F.col("p.part_id").cast("long").alias("part_id"),
                    F.col("p.quantity").cast("int").alias("quantity")))


def _day(seed, key, tag, start: dt.date, end: dt.date):
    return F.date_add(F.lit(start), uniform_int(seed, key, tag, 0, (end - start).days).cast("int"))


def gen_deliveries(ids: DataFrame, n_suppliers: int, parts: DataFrame, n_parts: int,
                   seed: int = 42, start: dt.date = GENERATOR_START,
                   end: dt.date = GENERATOR_END) -> tuple[DataFrame, DataFrame]:
    """S8 — (final_delivery, lot_delivery) for the delivery keys in ``ids.id``.

    ``parts`` is the catalogue with a dense index ``part_idx`` 1..``n_parts``
    (e.g. a part dimension's surrogate key) and ``part_id``. The 2-5 parts of
    a delivery are a uniform sample without replacement, drawn by Floyd's
    method: step j of n-k..n-1 draws from 0..j and takes j itself if the draw
    is taken already. At most five steps, whatever the catalogue's size.
    """
    k = F.col("id")
    final = ids.select(k.cast("long").alias("delivery_id"),
                       uniform_int(seed, k, "delivery.supplier", 1, n_suppliers).alias("supplier_id"),
                       _day(seed, k, "delivery.date", start, end).alias("delivery_date"))
    d = F.col("delivery_id")
    n_pick = F.least(uniform_int(seed, d, "delivery.k", 2, MOST_PARTS), F.lit(n_parts).cast("long"))
    # written out step by step, as plain columns: a lambda over an array is interpreted,
    # and an exploded expression is worked out again for its inferred filter
    lots = final.withColumn("_picks", n_pick)
    taken: list[str] = []
    for i in range(MOST_PARTS):
        j = F.lit(n_parts) - F.col("_picks") + i
        lots = lots.withColumn("_at", uniform_int(seed, d, f"delivery.part.{i}", 0, j))
        known = reduce(lambda x, y: x | y, [F.col("_at") == F.col(p) for p in taken], F.lit(False))
        lots = lots.withColumn(f"_p{i}", F.when(F.col("_picks") > i,
                                                F.when(known, j).otherwise(F.col("_at"))))
        taken.append(f"_p{i}")
    lots = (lots.select("delivery_id", "delivery_date", F.explode(F.array(*taken)).alias("_at"))
            .filter(F.col("_at").isNotNull())
            .select("delivery_id", "delivery_date", (F.col("_at") + 1).alias("part_idx")))
    catalogue = broadcast_checked(parts.select(F.col("part_idx").cast("long").alias("part_idx"),
                                               "part_id"))
    lots = (lots.join(catalogue, "part_idx")
            .select("delivery_id", "part_id", "delivery_date",
                    uniform_int(seed, F.concat_ws("|", "delivery_id", "part_id"), "lot.qty", 20, 200)
                    .cast("int").alias("quantity")))
    return final, lots


def gen_sales(ids: DataFrame, n_customers: int, price_list: DataFrame, n_cars: int,
              seed: int = 42, start: dt.date = GENERATOR_START,
              end: dt.date = GENERATOR_END) -> DataFrame:
    """S9 — sales for the keys in ``ids.id``.

    ``price_list``: (car_idx 1..``n_cars``, car_id, base_price decimal). The
    price variation is drawn in 1/100000 steps on [-10 %, +10 %] and applied
    in decimal arithmetic, then rounded half-up to cents.
    """
    k = F.col("id")
    prices = broadcast_checked(price_list.select(F.col("car_idx").cast("long").alias("car_idx"),
                                                 "car_id", "base_price"))
    v = uniform_int(seed, k, "sale.variation", -10000, 10000).cast("decimal(6,0)")
    factor = (F.lit(1).cast("decimal(7,5)") + v / F.lit(100000)).cast("decimal(7,5)")
    sales = ids.select(k.cast("long").alias("sale_id"),
                       uniform_int(seed, k, "sale.customer", 1, n_customers).alias("customer_id"),
                       uniform_int(seed, k, "sale.car", 1, n_cars).alias("car_idx"),
                       _day(seed, k, "sale.date", start, end).alias("sale_date"),
                       factor.alias("_f"))
    return (sales.join(prices, "car_idx")
            .select("sale_id", "customer_id", "car_id", "sale_date",
                    F.round(F.col("base_price").cast("decimal(12,2)") * F.col("_f"), 2)
                    .cast(MONEY).alias("sale_price")))
