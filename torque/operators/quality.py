"""Q1-Q18 — data-quality checks, each a frame of (check_id, description, failures).

A check passes iff ``failures = 0``. All branches over one table are folded
into a single aggregate (one scan per table, SURVEY W5) and unpivoted with
``inline``; orphan checks are anti joins (a NULL foreign key has no match
and counts as an orphan, as with the reference's LEFT JOIN ... IS NULL).
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from torque.operators.joins import broadcast_checked
from torque.operators.key_bitmaps import orphan_counts, orphans_per_value
from torque.operators.staging import bom_cost
from torque.schemas import FOREIGN_KEYS, PRIMARY_KEYS

# ---- fixed values: check ids and descriptions of the reference's assertions ----
QC01_NULL_PK = [
    ("supplier", "supplier_id", "NULL PK in SUPPLIER"),
    ("customers", "customer_id", "NULL PK in CUSTOMERS"),
    ("cars", "car_id", "NULL PK in CARS"),
    ("parts", "part_id", "NULL PK in PARTS"),
    ("sales", "sale_id", "NULL PK in SALES"),
]
QC02_PRICE = [
    ("parts", "unit_price", "Zero/negative price in PARTS"),
    ("sales", "sale_price", "Zero/negative price in SALES"),
]
QC03_ORPHANS = [
    ("sales", "car_id", "cars", "car_id", "SALES referencing missing Car_ID"),
    ("sales", "customer_id", "customers", "customer_id", "SALES referencing missing Cliente_ID"),
    ("parts", "category_id", "category", "category_id", "PARTS referencing missing Category_ID"),
]
QC04_FUTURE = [
    ("sales", "sale_date", "Future dates in SALES"),
    ("final_delivery", "delivery_date", "Future dates in FINAL_DELIVERY"),
]
QC05_DUPLICATES = [
    ("sales", "sale_id", "Duplicate Venta_ID in SALES"),
    ("cars", "car_id", "Duplicate Car_ID in CARS"),
]
QC06_DESCRIPTION = "Sale price below parts cost (potential data error)"
# -------------------------------------------------------------------------------

def _rows(df: DataFrame, checks: list[tuple[str, str, Column]]) -> DataFrame:
    """One aggregate over ``df`` -> one (check_id, description, failures) row per check."""
    agg = df.agg(*[expr.cast("long").alias(f"_c{i}") for i, (_, _, expr) in enumerate(checks)])
    structs = [F.struct(F.lit(cid).alias("check_id"), F.lit(desc).alias("description"),
                        F.col(f"_c{i}").alias("failures"))
               for i, (cid, desc, _) in enumerate(checks)]
    return agg.select(F.inline(F.array(*structs)))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _count_if(cond: Column) -> Column:
    return F.count_if(cond)


def qc01_null_pk(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([_rows(tables[t], [("QC-01", d, _count_if(F.col(c).isNull()))])
                   for t, c, d in QC01_NULL_PK])


def qc02_nonpositive_price(tables: dict[str, DataFrame]) -> DataFrame:
    # a NULL price is not a failure (NULL <= 0 is not true)
    return _union([_rows(tables[t], [("QC-02", d, _count_if(F.col(c) <= 0))])
                   for t, c, d in QC02_PRICE])


def _orphans() -> Column:
    return F.coalesce(F.sum("_n"), F.lit(0))


def qc03_orphan_fk(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([_rows(orphans_per_value(tables[c], fk, tables[p], pk), [("QC-03", d, _orphans())])
                   for c, fk, p, pk, d in QC03_ORPHANS])


def qc04_future_dates(tables: dict[str, DataFrame], as_of: dt.date) -> DataFrame:
    return _union([_rows(tables[t], [("QC-04", d, _count_if(F.col(c) > F.lit(as_of)))])
                   for t, c, d in QC04_FUTURE])


def qc05_duplicate_pk(tables: dict[str, DataFrame]) -> DataFrame:
    # COUNT(*) - COUNT(DISTINCT pk): a NULL key counts as a duplicate
    return _union([_rows(tables[t], [("QC-05", d,
                                      F.count(F.lit(1)) - F.countDistinct(F.col(c)))])
                   for t, c, d in QC05_DUPLICATES])


def qc06_price_below_cost(tables: dict[str, DataFrame]) -> DataFrame:
    """Sales priced below their BOM cost; sales without BOM are not counted.

    The BOM is costed per car first; grouping the costed sales by
    (sale_id, sale_price) keeps the reference's result even for duplicated
    sales rows (their costs add up, as in its grouped fan-out join).
    """
    cost = broadcast_checked(bom_cost(tables["parts_car"], tables["parts"]))
    per_sale = (tables["sales"].select("sale_id", "sale_price", "car_id").join(cost, "car_id")
                .groupBy("sale_id", "sale_price")
                .agg(F.sum("total_parts_cost").alias("_cost")))
    return _rows(per_sale, [("QC-06", QC06_DESCRIPTION,
                             _count_if(F.col("sale_price") < F.col("_cost")))])


def sales_key_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """QC-05 on sales and QC-06 together. The first grouping, by sale_id and price, is
    partially aggregated where the rows are read, so a repeated or NULL sale_id
    leaves a map task once per price; the grouping by sale_id works on its result."""
    cost = broadcast_checked(bom_cost(tables["parts_car"], tables["parts"]))
    dealt = (tables["sales"].select("sale_id", "sale_price", "car_id")
             .join(cost, "car_id", "left"))
    priced = dealt.groupBy("sale_id", "sale_price").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum("total_parts_cost").alias("_cost"))
    per_sale = priced.groupBy("sale_id").agg(
        F.sum("_rows").alias("_rows"),
        F.count_if(F.col("sale_price") < F.col("_cost")).alias("_low"))
    none = F.lit(0)
    duplicate = next(d for t, _, d in QC05_DUPLICATES if t == "sales")
    return _rows(per_sale, [
        ("QC-05", duplicate, F.coalesce(F.sum("_rows"), none) - F.count("sale_id")),
        ("QC-06", QC06_DESCRIPTION, F.coalesce(F.sum("_low"), none))])


def qc_orphans_all(tables: dict[str, DataFrame]) -> DataFrame:
    """Q16 — every declared foreign key of the source schema, by key bitmaps."""
    return _union([_rows(counts, [("QC-FK", f"{c}.{fk} -> {p}.{pk}", _orphans())])
                   for counts, (c, fk, p, pk)
                   in zip(orphan_counts(tables, FOREIGN_KEYS), FOREIGN_KEYS)])


def duplicate_key_check(df: DataFrame, keys: list[str], description: str) -> DataFrame:
    """Q17 — surplus rows per key value: SUM(count - 1) over GROUP BY keys.

    Partial aggregation folds a hot key to one row per map task before the
    shuffle, so a skewed key costs no more than any other.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return _rows(per_key, [("QC-PK", description, F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)))])


def qc_duplicates_all(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([duplicate_key_check(tables[t], keys, f"{t}({', '.join(keys)})")
                   for t, keys in PRIMARY_KEYS.items()])


def qc_report(tables: dict[str, DataFrame], as_of: dt.date) -> DataFrame:
    """Q18 — the reference's fifteen assertion rows (QC-01 .. QC-06).

    The single-table checks (QC-01, -02, -04, -05) of each table are folded
    into one aggregate, so every table is scanned once for all of them; the
    two checks that group the sales share one exchange.
    """
    per_table: dict[str, list] = {}
    for t, c, d in QC01_NULL_PK:
        per_table.setdefault(t, []).append(("QC-01", d, _count_if(F.col(c).isNull())))
    for t, c, d in QC02_PRICE:
        per_table.setdefault(t, []).append(("QC-02", d, _count_if(F.col(c) <= 0)))
    for t, c, d in QC04_FUTURE:
        per_table.setdefault(t, []).append(("QC-04", d, _count_if(F.col(c) > F.lit(as_of))))
    for t, c, d in [x for x in QC05_DUPLICATES if x[0] != "sales"]:
        per_table.setdefault(t, []).append(
            ("QC-05", d, F.count(F.lit(1)) - F.countDistinct(F.col(c))))
    fused = [_rows(tables[t], checks) for t, checks in per_table.items()]
    return _union(fused + [qc03_orphan_fk(tables), sales_key_checks(tables)])


class QualityGateError(RuntimeError):
    pass


def run_quality_gate(tables: dict[str, DataFrame], as_of: dt.date,
                     warn_only: bool = False) -> list:
    """Run Q18 before a gold load; raise on any failure unless ``warn_only``.

    Collects only the fifteen result rows.
    """
    failed = qc_report(tables, as_of).filter(F.col("failures") > 0).collect()
    if failed and not warn_only:
        raise QualityGateError("; ".join(f"{r.check_id} {r.description}: {r.failures}"
                                         for r in failed))
    return failed
