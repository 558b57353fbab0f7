"""Hand-written rows for the nine source roles (FIXTURES §3), <= 12 rows each."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as Dec

from pyspark.sql import functions as F

from torque.schemas import SOURCE
from torque.sources.bindings import ModelConfig, Sources

D = dt.date

SUPPLIER = [
    (1, "Acme", None, "Madrid", "Madrid"),
    (2, "Acme", None, "Madrid", "Madrid"),        # same name + city as 1: R4 merges them
    (3, " Beta ", "  Dock 4 ", "Bilbao", "Vizcaya"),
]
FINAL_DELIVERY = [
    (100, 1, D(2023, 1, 10)),
    (101, 2, D(2023, 2, 1)),
    (102, 3, D(2023, 2, 1)),                      # same day as 101: greatest id wins
    (103, 1, D(2023, 3, 15)),
    (104, 2, D(2023, 5, 20)),                     # supplier 2 ('Acme' too) links June
]
CATEGORY = [(1, "Engine"), (2, " Body ")]
PARTS = [
    (10, "piston", "red", Dec("100.00"), 1),
    (11, " door ", None, Dec("50.00"), 2),
    (12, "mirror", "", Dec("0.00"), 2),           # price 0
    (13, "orphan part", "x", Dec("30.00"), 99),   # no category: V5 drops, V6 still costs
    (14, "clip", None, Dec("-5.00"), 1),          # negative price
    (15, "spring", None, None, 1),                # NULL price: not a QC-02 failure
]
LOT_DELIVERY = [(100, 10, D(2023, 1, 10), 20), (101, 11, D(2023, 2, 1), 40)]
CARS = [
    (1, " SEAT ", "Ibiza ", 2020),
    (2, "VW", "Golf", 2021),
    (3, "Audi", "Q3", 2022),                       # no BOM: absent from V6 / D5
    (4, "Cupra", "Born", 2023),
]
PARTS_CAR = [(1, 10, 2), (1, 11, 1), (1, 13, 1),  # car 1 costs 200 + 50 + 30 = 280
             (2, 10, 1), (2, 11, 2),              # car 2 costs 200
             (4, 10, 1)]                          # car 4 costs 100
CUSTOMERS = [
    (1, " Ana ", None, None, "Barcelona"),
    (2, "Bo", "  Main St 1 ", "", "Madrid"),
    (3, "Cy", None, "Zaragoza", "Zaragoza"),      # province outside the CASE: 'Other'
]
SALES = [
    (1, 1, 1, D(2023, 1, 5), Dec("500.00")),      # before the first delivery: not in fact
    (2, 1, 1, D(2023, 1, 10), Dec("500.00")),     # same day as delivery 100 (inclusive)
    (3, 2, 2, D(2023, 2, 1), Dec("300.00")),      # tie day: supplier 3
    (4, 2, 4, D(2023, 2, 20), Dec("0.00")),       # price 0: pct NULL
    (5, 3, 3, D(2023, 3, 20), Dec("400.00")),     # car without BOM: dropped
    (6, 1, 2, D(2023, 4, 10), Dec("150.00")),     # price below cost 200
    (7, 1, 1, D(2030, 1, 1), Dec("900.00")),      # future; outside the calendar
    (8, 99, 1, D(2023, 5, 5), Dec("600.00")),     # dangling customer
    (9, 1, None, D(2023, 5, 6), Dec("600.00")),   # NULL car FK
    (10, 3, 2, D(2023, 6, 1), Dec("1000.00")),    # June; May has no fact row (gap)
]
# Rows only in the dirty set (quality checks): duplicate and NULL keys.
DIRTY_EXTRA = {
    "sales": [(10, 3, 2, D(2023, 6, 2), Dec("1000.00")), (None, 1, 1, D(2023, 6, 3), Dec("1.00"))],
    "cars": [(2, "VW", "Golf", 2021), (None, "X", "Y", 2000)],
    "supplier": [(None, "Ghost", None, None, None)],
    "customers": [(None, "Nobody", None, None, None)],
    "parts": [(None, "nothing", None, Dec("1.00"), 1)],
}

ROWS = dict(supplier=SUPPLIER, final_delivery=FINAL_DELIVERY, category=CATEGORY, parts=PARTS,
            lot_delivery=LOT_DELIVERY, cars=CARS, parts_car=PARTS_CAR, customers=CUSTOMERS,
            sales=SALES)

SEGMENTS = {"Electric": ["Born"], "SUV": ["Q3"], "Subcompact": ["Ibiza"], "Compact": ["Golf"]}
REGIONS = {"Catalonia": ["Barcelona", "Girona"], "Madrid": ["Madrid"]}


def _frames(spark, rows: dict) -> Sources:
    return Sources(**{t: spark.createDataFrame(r, SOURCE[t]) for t, r in rows.items()})


def clean_sources(spark) -> Sources:
    return _frames(spark, ROWS)


def dirty_sources(spark) -> Sources:
    rows = {t: list(r) + DIRTY_EXTRA.get(t, []) for t, r in ROWS.items()}
    return _frames(spark, rows)


def fixture_config(**kw) -> ModelConfig:
    base = dict(segment_by_model=SEGMENTS, region_by_province=REGIONS,
                calendar_start=D(2023, 1, 1), calendar_end=D(2023, 12, 31),
                as_of=D(2024, 1, 1), now=dt.datetime(2024, 1, 1, 8, 0))
    base.update(kw)
    return ModelConfig(**base)


def rows_of(df, *cols, order=None):
    order = order or cols
    return [tuple(r) for r in df.select(*cols).orderBy(*order).collect()]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


__all__ = ["F", "clean_sources", "dirty_sources", "fixture_config", "rows_of", "plan_of"]
