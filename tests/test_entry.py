"""Driver contract: entry() smoke, catalogue and oracle keys line up."""

from __future__ import annotations

import __spark_entry__ as entry
from torque.plans.catalog import QUERIES

MODEL_KEYS = set("""
    bom_cost bom_counts bom_explode cdc_bucket_merge cdc_latest cdc_stream_merge co_located_sales_by_region dim_car dim_customer dim_part
    dim_supplier dim_time dim_time_fixed fact_as_of_customer fact_incremental_months
    fact_late_deliveries fact_month_sketches fact_sales gen_customers gen_deliveries gen_sales gen_suppliers
    init_tables load_summary load_truncate_insert merge_car merge_fact merge_idempotent
    merge_insert merge_part merge_supplier merge_update model_margin_alert model_margin_trend
    partials_model_profitability partials_monthly_trend partials_revenue_by_brand
    partials_supplier_performance qc01_null_pk qc02_nonpositive_price qc03_orphan_fk
    qc04_future_dates qc05_duplicate_pk qc06_price_below_cost qc_duplicates_all
    qc_duplicates_lineitem qc_duplicates_sketched qc_duplicates_spoilt qc_orphans_all qc_orphans_spoilt qc_report
    qc_report_spoilt revenue_by_region rpt_model_profitability rpt_monthly_trend scd2_buckets
    rpt_monthly_trend_filled rpt_parts_cost_by_segment rpt_revenue_by_brand rpt_sales_by_region
    rpt_supplier_performance scd2_customer scd2_same_day segment_parts stg_cars stg_category
    stg_customers stg_final_delivery stg_lot_delivery stg_parts stg_parts_car stg_sales
    stg_supplier supplier_as_of top_models trend_one_year
""".split())


def test_entry_runs_on_smoke_data(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["year", "quarter_name", "brand", "total_sales", "total_revenue",
                          "total_parts_cost", "total_gross_margin", "avg_margin_pct",
                          "avg_sale_price"]


def test_every_oracle_has_a_query():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) <= set(q)
    unchecked = {k for k in QUERIES if k not in o}
    assert not unchecked, f"keys of the sales model without an oracle: {unchecked}"
    assert not MODEL_KEYS - set(QUERIES), f"keys that went: {MODEL_KEYS - set(QUERIES)}"


def test_every_query_runs_on_smoke_data(spark):
    """All registered queries execute over the whole sf0.001 tables."""
    failures = {}
    for name, fn in entry.queries().items():
        try:
            rows = fn(spark, entry.SMOKE_DIR).collect()
            assert isinstance(rows, list)
        except Exception as e:  # noqa: BLE001 - report every failing key at once
            failures[name] = f"{type(e).__name__}: {str(e)[:200]}"
    assert not failures, failures
