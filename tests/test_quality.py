"""Quality checks Q1-Q18 on the dirty fixture."""

from __future__ import annotations

import datetime as dt

import pytest

from tests.fixtures import plan_of
from torque.operators import quality


def _by_desc(df):
    return {r.description: r.failures for r in df.collect()}


def test_qc01_null_pk(dirty):
    got = _by_desc(quality.qc01_null_pk(dirty.as_dict()))
    assert got == {"NULL PK in SUPPLIER": 1, "NULL PK in CUSTOMERS": 1, "NULL PK in CARS": 1,
                   "NULL PK in PARTS": 1, "NULL PK in SALES": 1}


def test_qc02_price_null_is_not_failure(dirty):
    got = _by_desc(quality.qc02_nonpositive_price(dirty.as_dict()))
    assert got == {"Zero/negative price in PARTS": 2, "Zero/negative price in SALES": 1}


def test_qc03_orphans_count_null_fk(dirty):
    got = _by_desc(quality.qc03_orphan_fk(dirty.as_dict()))
    assert got["SALES referencing missing Car_ID"] == 1          # NULL car
    assert got["SALES referencing missing Cliente_ID"] == 1      # customer 99
    assert got["PARTS referencing missing Category_ID"] == 1     # category 99


def test_qc04_future_dates(dirty):
    got = _by_desc(quality.qc04_future_dates(dirty.as_dict(), dt.date(2024, 1, 1)))
    assert got == {"Future dates in SALES": 1, "Future dates in FINAL_DELIVERY": 0}


def test_qc05_duplicates_count_null_keys(dirty):
    got = _by_desc(quality.qc05_duplicate_pk(dirty.as_dict()))
    # sales: 12 rows, 10 distinct ids (NULL not counted) -> 2 ; cars: 6 rows, 4 distinct -> 2
    assert got == {"Duplicate Venta_ID in SALES": 2, "Duplicate Car_ID in CARS": 2}


def test_qc06_price_below_cost(clean, dirty):
    assert quality.qc06_price_below_cost(clean.as_dict()).first().failures == 2  # sales 4 and 6
    # duplicated sale 10 (two rows, price 1000, car 2): cost doubles to 400, still above
    assert quality.qc06_price_below_cost(dirty.as_dict()).first().failures == 3


def test_generic_checks(dirty):
    dup = _by_desc(quality.qc_duplicates_all(dirty.as_dict()))
    assert dup["sales(sale_id)"] == 1 and dup["parts_car(car_id, part_id)"] == 0
    fk = _by_desc(quality.qc_orphans_all(dirty.as_dict()))
    assert fk["sales.car_id -> cars.car_id"] == 1
    assert fk["lot_delivery.part_id -> parts.part_id"] == 0
    assert len(fk) == 8 and len(dup) == 9


def test_report_and_gate(clean, dirty):
    assert quality.qc_report(dirty.as_dict(), dt.date(2024, 1, 1)).count() == 15
    with pytest.raises(quality.QualityGateError):
        quality.run_quality_gate(dirty.as_dict(), dt.date(2024, 1, 1))
    failed = quality.run_quality_gate(clean.as_dict(), dt.date(2024, 1, 1), warn_only=True)
    assert {r.check_id for r in failed} <= {"QC-02", "QC-03", "QC-04", "QC-06"}


def test_sales_key_checks_aggregate_before_they_shuffle(clean):
    """Repeated and NULL sale ids are folded where the rows are read."""
    plan = plan_of(quality.sales_key_checks(clean.as_dict()))
    below = plan[plan.index("hashpartitioning(sale_id"):]
    assert below.index("partial_") < below.index("Scan")
    assert "REPARTITION" not in plan
