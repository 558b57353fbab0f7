"""Registered queries against their SQL, over small tables built here."""

from __future__ import annotations

import ast
import datetime as dt
import inspect
import threading

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.fixtures import plan_of, rows_of
from torque.operators.merge import merge_upsert
from torque.plans import catalog
from torque.plans.catalog import ORACLES, QUERIES
from torque.plans.warehouse import forget
from torque.sources import generators as G
from torque.sources.bindings import bind_sources

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


@pytest.fixture(scope="module")
def tiny(spark, tmp_path_factory):
    """A folder of small tables: 40 customers, 6 suppliers, 30 parts, 60 orders."""
    folder = tmp_path_factory.mktemp("tiny")
    day = lambda n: dt.datetime(1995, 1, 1) + dt.timedelta(days=n)
    rows = {
        "region": ([(0, "AFRICA"), (1, "ASIA"), (2, "MIDDLE EAST")],
                   "r_regionkey int, r_name string"),
        "nation": ([(0, "KENYA", 0), (1, "JAPAN", 1), (2, "IRAN", 2)],
                   "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(k, f"Customer {k}", k % 3) for k in range(1, 41)],
                     "c_custkey long, c_name string, c_nationkey int"),
        "supplier": ([(k, f"Supplier {k}", k % 3) for k in range(1, 7)],
                     "s_suppkey long, s_name string, s_nationkey int"),
        "part": ([(k, f"{('red', 'hot')[k % 2]} {('ring', 'bolt', 'cap')[k % 3]}",
                   f"Brand#{k // 12}", ("PROMO", "LARGE", "TIN")[k // 12 % 3], k % 5, 900.0 + k)
                  for k in range(30)],
                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
                 "p_retailprice double"),
        "orders": ([(k, k % 40 + 1, 1000.0 + 37 * k, day(11 * k)) for k in range(60)],
                   "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp"),
        "lineitem": ([(k, (7 * k + 5 * n) % 30, (k + n) % 6 + 1, n, 1.0 + n, day(11 * k + 4 * n))
                      for k in range(60) for n in range(1, 4)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                     "l_quantity double, l_shipdate timestamp"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    yield str(folder)
    forget(spark)


def check_against_sql(spark, folder, name):
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet/*.parquet')")
    wanted = db.sql(ORACLES[name])
    found = QUERIES[name](spark, folder)
    order = [found.columns.index(c) for c in wanted.columns]
    text = lambda rows: sorted(tuple(map(str, r)) for r in rows)
    assert sorted(found.columns) == sorted(wanted.columns)
    assert text([tuple(r[i] for i in order) for r in found.collect()]) == text(wanted.fetchall())


def test_no_function_of_the_catalogue_replaces_another():
    names = [n.name for n in ast.parse(inspect.getsource(catalog)).body
             if isinstance(n, ast.FunctionDef)]
    assert sorted(set(names)) == sorted(names)


@pytest.mark.parametrize("name", ["merge_update", "merge_idempotent", "scd2_customer"])
def test_customer_loads(spark, tiny, name):
    check_against_sql(spark, tiny, name)


def test_merge_of_a_batch_from_another_session(spark):
    """A stream's batch belongs to a session of its own, where metrics that were asked
    for in the target's session never arrive."""
    now = dt.datetime(2024, 1, 1)
    target = merge_upsert(None, spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string"),
                          "id", "k", now)
    batch = spark.newSession().createDataFrame([(2, "c"), (3, "d")], "id long, v string")
    found = []

    def merge():
        found.extend(rows_of(merge_upsert(target, batch, "id", "k", now), "k", "id", "v"))
    worker = threading.Thread(target=merge, daemon=True)
    worker.start()
    worker.join(60)
    assert found == [(1, 1, "a"), (2, 2, "c"), (3, 3, "d")]


@pytest.mark.parametrize("name", ["gen_deliveries", "stg_final_delivery", "stg_lot_delivery"])
def test_deliveries(spark, tiny, name):
    check_against_sql(spark, tiny, name)


def test_parts_of_a_delivery_are_drawn_in_plain_columns(spark):
    """A lambda is interpreted, and an exploded expression is worked out twice."""
    parts = spark.range(1, 4).select(F.col("id").alias("part_idx"), F.col("id").alias("part_id"))
    _, lots = G.gen_deliveries(spark.range(50), 6, parts, 3)
    assert "lambda" not in plan_of(lots)
    seen = rows_of(lots.groupBy("delivery_id").agg(F.count("part_id").alias("n"),
                                                   F.countDistinct("part_id").alias("d")),
                   "delivery_id", "n", "d")
    assert len(seen) == 50 and {n for _, n, _ in seen} == {2, 3}
    assert all(n == d for _, n, d in seen)


def test_deliveries_are_told_apart_by_supplier_and_day(spark, tiny):
    """Their id follows from these two and need not be shuffled."""
    plan = plan_of(bind_sources(spark, tiny).final_delivery)
    moved = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert moved and not any("delivery_id" in line for line in moved)
