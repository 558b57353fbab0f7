"""Query catalogue: one Spark callable (spark, sf_dir) and one oracle per key.

Keys are those of SURVEY §2. Every callable reads the whole test tables of
``sf_dir`` through the FIXTURES binding (or the gold layer Spark derives
from them); ``load_ts`` is left out so results are deterministic.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from torque.operators import reports, staging
from torque.plans import oracles as O
from torque.operators.fact import fact_source, load_fact
from torque.operators.history import merge_fact_months, version_as_of
from torque.operators import key_sketches, partials
from torque.operators.partials import refresh_partials
from torque.plans.warehouse import (bound, gold_for, load_late_deliveries, remembered,
                                    warehouse_root, write_fact_by_month)
from torque.sources.bucketed import write_bucketed
from torque.sources.parts import MONTH, MonthTable, PartTable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = O.with_ctes(oracle)
        return fn
    return deco


def _no_ts(df: DataFrame) -> DataFrame:
    return df.drop("load_ts")


# ---- silver (V1-V9, B1, B2) ---------------------------------------------------
def _silver(name):
    def fn(spark, sf_dir):
        _, _, silver = bound(spark, sf_dir)
        return getattr(silver, name)
    return fn


for _key, _attr in [("stg_supplier", "supplier"), ("stg_customers", "customers"),
                    ("stg_cars", "cars"), ("stg_category", "category"), ("stg_parts", "parts"),
                    ("stg_sales", "sales"), ("stg_parts_car", "parts_car"),
                    ("stg_final_delivery", "final_delivery"),
                    ("stg_lot_delivery", "lot_delivery")]:
    register(_key, f"select * from {_key}")(_silver(_attr))


@register("bom_cost", "select * from bom_cost")
def q_bom_cost(spark, sf_dir):
    src, _, _ = bound(spark, sf_dir)
    return staging.bom_cost(src.parts_car, src.parts)


@register("bom_counts", "select * from bom_counts")
def q_bom_counts(spark, sf_dir):
    _, _, silver = bound(spark, sf_dir)
    return staging.bom_counts(silver.parts_car)


# ---- gold (D1-D5, F1/F2) -------------------------------------------------------
@register("dim_time", "select * from dim_time")
def q_dim_time(spark, sf_dir):
    """The bound calendar: every day of the years spanned by the sales."""
    return _no_ts(gold_for(spark, sf_dir).dim_time)


CALENDAR_DAYS = 1461   # four years


@register("dim_time_fixed", f"""
select * from dim_time where full_date < (select min(full_date) from dim_time) + {CALENDAR_DAYS}""")
def q_dim_time_fixed(spark, sf_dir):
    """The fixed-range form: a start day (New Year of the first sale's year) and a length."""
    from torque.operators.calendar import dim_time
    src, _, _ = bound(spark, sf_dir)
    first = src.sales.agg(F.min("sale_date")).first()[0]
    start = dt.date(first.year, 1, 1)
    return dim_time(spark, start, start + dt.timedelta(days=CALENDAR_DAYS - 1))


def _gold(name):
    def fn(spark, sf_dir):
        return _no_ts(getattr(gold_for(spark, sf_dir), name))
    return fn


for _key in ["dim_customer", "dim_supplier", "dim_part", "dim_car", "fact_sales"]:
    register(_key, f"select * from {_key}")(_gold(_key))


@register("supplier_as_of", "select * from linked_supplier")
def q_supplier_as_of(spark, sf_dir):
    from torque.operators.asof import supplier_as_of
    src, _, silver = bound(spark, sf_dir)
    return (supplier_as_of(silver.sales, silver.final_delivery, with_delivery=True, dates=src.sales)
            .select("sale_id", "supplier_id", "delivery_date"))


# ---- reports (R1-R6a) ---------------------------------------------------------------
# Every sale once, with what it refers to as structs: the report statements are
# generated from this one relation by naming their groups and measures.
O.cte("sold", """
select sale, car, client, vendor, day
from fact_sales sale
left join dim_car car using (car_key) left join dim_customer client using (customer_key)
left join dim_supplier vendor using (supplier_key) left join dim_time day using (time_id)""")


def _sum(measure: str) -> str:
    return f"cast(sum(sale.{measure}) as decimal(22,2))"


SALES = "cast(count(distinct sale.sale_key) as bigint)"
PERCENT = O.ravg("sale.gross_margin_pct", 4, 100)
PRICE = O.ravg("sale.sale_price", 2)
REVENUE = {"total_revenue": _sum("sale_price")}
COST = {"total_parts_cost": _sum("total_parts_cost")}
MARGIN = {"total_gross_margin": _sum("gross_margin")}


def _sold_by(groups: str, measures: dict[str, str], apart: str = "") -> str:
    """Measures of the sales by ``groups`` (struct.field, blank-separated, name after a
    colon where it differs) and, without showing it, by ``apart``. A sale needs every
    row that a group is taken from."""
    named = [(g.split(":")[0], g.split(":")[-1].split(".")[-1]) for g in groups.split()]
    needed = sorted({path.split(".")[0] for path, _ in named})
    present = {"car": "car.car_key", "client": "client.customer_key",
               "vendor": "vendor.supplier_key", "day": "day.time_id"}
    shown = [f"{path} as {name}" for path, name in named]
    shown += [f"{formula} as {name}" for name, formula in measures.items()]
    by = [path for path, _ in named] + apart.split()
    return (f"select {', '.join(shown)}\nfrom sold where "
            + " and ".join(f"{present[n]} is not null" for n in needed)
            + f"\ngroup by {', '.join(by)}")


@register("rpt_revenue_by_brand", _sold_by(
    "day.year day.quarter_name car.brand",
    {"total_sales": SALES, **REVENUE, **COST, **MARGIN, "avg_margin_pct": PERCENT,
     "avg_sale_price": PRICE}))
def q_rpt_revenue_by_brand(spark, sf_dir):
    g = gold_for(spark, sf_dir)
    return reports.rpt_revenue_by_brand(g.fact_sales, g.dim_car, g.dim_time)


@register("rpt_sales_by_region", _sold_by(
    "client.region client.province day.year day.month_name",
    {"total_sales": SALES, **REVENUE, **MARGIN, "avg_sale_price": PRICE}, apart="day.month"))
def q_rpt_sales_by_region(spark, sf_dir):
    g = gold_for(spark, sf_dir)
    return reports.rpt_sales_by_region(g.fact_sales, g.dim_customer, g.dim_time)


O.cte("model_profitability", _sold_by(
    "car.brand car.model car.brand_model car.segment car.manufacture_year",
    {"units_sold": SALES, **REVENUE, **COST, **MARGIN, "avg_margin_pct": PERCENT,
     "margin_per_unit": O.rdiv("sum(sale.gross_margin)", "count(distinct sale.sale_key)", 2, 0, 2)}))


@register("rpt_model_profitability", "select * from model_profitability")
def q_rpt_model_profitability(spark, sf_dir):
    g = gold_for(spark, sf_dir)
    return reports.rpt_model_profitability(g.fact_sales, g.dim_car)


@register("rpt_supplier_performance", _sold_by(
    "vendor.supplier_name vendor.city:supplier_city day.year day.quarter_name",
    {"sales_linked": SALES, "parts_value_supplied": _sum("total_parts_cost"),
     "revenue_enabled": _sum("sale_price"),
     "cost_to_revenue_pct": O.rdiv("sum(sale.total_parts_cost)", "sum(sale.sale_price)", 2, 2, 2,
                                   100)}))
def q_rpt_supplier_performance(spark, sf_dir):
    g = gold_for(spark, sf_dir)
    return reports.rpt_supplier_performance(g.fact_sales, g.dim_supplier, g.dim_time)


O.cte("monthly_agg", _sold_by(
    "day.year day.month day.month_short",
    {"total_sales": SALES, **REVENUE, **MARGIN, "avg_margin_pct": PERCENT}))
_GROWTH = f"""
select year, month, month_short, cast(year as varchar) || '-' || lpad(cast(month as varchar), 2, '0') as year_month,
       total_sales, total_revenue, total_gross_margin, avg_margin_pct, prev_month_revenue,
       {O.rdiv('total_revenue - prev_month_revenue', 'prev_month_revenue', 2, 2, 2, 100)} as mom_revenue_growth_pct
from (select *, lag(total_revenue) over (order by year, month) as prev_month_revenue from {{src}}) g"""
O.cte("monthly_trend", _GROWTH.format(src="monthly_agg"))
O.cte("monthly_filled", """
select m.year, m.month, m.month_short,
       coalesce(a.total_sales, cast(0 as bigint)) as total_sales,
       coalesce(a.total_revenue, cast(0 as decimal(22,2))) as total_revenue,
       coalesce(a.total_gross_margin, cast(0 as decimal(22,2))) as total_gross_margin,
       a.avg_margin_pct
from (select distinct year, month, month_short from dim_time) m
left join monthly_agg a on a.year = m.year and a.month = m.month""")
O.cte("monthly_trend_filled", _GROWTH.format(src="monthly_filled"))


@register("rpt_monthly_trend", "select * from monthly_trend")
def q_rpt_monthly_trend(spark, sf_dir):
    g = gold_for(spark, sf_dir)
    return reports.rpt_monthly_trend(g.fact_sales, g.dim_time)


@register("rpt_monthly_trend_filled", "select * from monthly_trend_filled")
def q_rpt_monthly_trend_filled(spark, sf_dir):
    g = gold_for(spark, sf_dir)
    return reports.rpt_monthly_trend_filled(g.fact_sales, g.dim_time)


O.cte("parts_in_segment", """
select segment, part_key
from (select distinct segment, part_id from bom_lines join dim_car using (car_id)) lines
join dim_part using (part_id)""")


@register("segment_parts", "select * from parts_in_segment")
def q_segment_parts(spark, sf_dir):
    g = gold_for(spark, sf_dir)
    _, _, silver = bound(spark, sf_dir)
    return reports.segment_parts(g.dim_car, silver.parts_car, g.dim_part)


# every sale meets every part of its segment, one row each
O.cte("sold_parts", """
select sold.sale_key, sold.segment, parts.category_name, parts.unit_price * sold.total_parts_qty as cost
from (select sale_key, segment, dim_car.total_parts_qty from fact_sales join dim_car using (car_key)) sold
join parts_in_segment used on used.segment = sold.segment
join dim_part parts on parts.part_key = used.part_key""")


@register("rpt_parts_cost_by_segment", f"""
with per_category as (
  select segment, category_name, cast(count(distinct sale_key) as bigint) as units_sold, sum(cost) as est
  from sold_parts group by segment, category_name),
per_segment as (select segment, sum(est) as seg_total from per_category group by segment)
select segment, category_name, units_sold, cast(est as decimal(38,2)) as estimated_category_cost,
       {O.rdiv('est', 'seg_total', 2, 2, 2, 100)} as pct_of_segment_cost
from per_category join per_segment using (segment)""")
def q_rpt_parts_cost_by_segment(spark, sf_dir):
    g = gold_for(spark, sf_dir)
    _, _, silver = bound(spark, sf_dir)
    return reports.rpt_parts_cost_by_segment(g.fact_sales, g.dim_car, g.dim_part, silver.parts_car)


# ---- insights (X1-X4) --------------------------------------------------------------
from torque.operators import insights  # noqa: E402

O.cte("model_months", "select *, year || '-' || lpad(month::varchar, 2, '0') as year_month from ("
      + _sold_by("car.brand_model day.year day.month", {"avg_margin_pct": PERCENT}) + ") m")
O.cte("model_margin_trend", """
select brand_model, year, month, year_month, avg_margin_pct,
       cast(avg_margin_pct - lag(avg_margin_pct) over (partition by brand_model order by year_month)
            as decimal(18,2)) as margin_delta_pct
from model_months""")


@register("model_margin_trend",
          "select brand_model, year_month, avg_margin_pct, margin_delta_pct from model_margin_trend")
def q_model_margin_trend(spark, sf_dir):
    g = gold_for(spark, sf_dir)
    return insights.model_margin_trend(g.fact_sales, g.dim_car, g.dim_time)


@register("model_margin_alert", """
select brand_model, min(year_month) as start_month, max(year_month) as end_month,
       cast(count(*) as bigint) as months
from (select *, year * 12 + month - row_number() over (partition by brand_model order by year * 12 + month) as isl
      from model_margin_trend where margin_delta_pct < 0) x
group by brand_model, isl
having count(*) >= 3""")
def q_model_margin_alert(spark, sf_dir):
    g = gold_for(spark, sf_dir)
    return insights.model_margin_alert(g.fact_sales, g.dim_car, g.dim_time)


@register("top_models", """
select brand_model, avg_margin_pct, units_sold, total_gross_margin from model_profitability
order by avg_margin_pct desc nulls last, brand_model limit 3""")
def q_top_models(spark, sf_dir):
    g = gold_for(spark, sf_dir)
    return insights.top_models(reports.rpt_model_profitability(g.fact_sales, g.dim_car))


TREND_YEAR = 1998  # a year of the bound calendar; its January lags into 1997


@register("trend_one_year", f"""
select year_month, total_revenue, mom_revenue_growth_pct from monthly_trend
where year = {TREND_YEAR}""")
def q_trend_one_year(spark, sf_dir):
    g = gold_for(spark, sf_dir)
    return insights.trend_one_year(reports.rpt_monthly_trend(g.fact_sales, g.dim_time), TREND_YEAR)


@register("revenue_by_region", """
select region, cast(sum(total_revenue) as decimal(22,2)) as revenue from (
  select cu.region, cu.province, t.year, t.month_name, sum(f.sale_price) as total_revenue
  from fact_sales f join dim_customer cu on f.customer_key = cu.customer_key
  join dim_time t on f.time_id = t.time_id
  group by cu.region, cu.province, t.year, t.month_name, t.month) r
group by region""")
def q_revenue_by_region(spark, sf_dir):
    g = gold_for(spark, sf_dir)
    return insights.revenue_by_region(
        reports.rpt_sales_by_region(g.fact_sales, g.dim_customer, g.dim_time))


# ---- quality (Q1-Q18) ----------------------------------------------------------------
from torque.operators import quality  # noqa: E402
from torque.sources.bindings import AS_OF  # noqa: E402

def _line(check: str, description: str, count: str, rest: str) -> str:
    return (f"select '{check}' as check_id, '{description}' as description, "
            f"cast({count} as bigint) as failures from {rest}")


def _qc_sql(role: str = "src_{}") -> dict[str, list[str]]:
    """Oracle lines of every check over the roles named by ``role``."""
    t = role.format
    lacks = lambda c, fk, p, pk: (
        f"{t(c)} where {fk} is null or {fk} not in (select {pk} from {t(p)} where {pk} is not null)")
    late = f"> date '{AS_OF.isoformat()}'"
    below = f"""(select sum(cost) > sale_price as low from {t('sales')}
        join (select car_id, sum(unit_price * quantity) as cost
              from {t('parts_car')} join {t('parts')} using (part_id) group by car_id) using (car_id)
        group by sale_id, sale_price) priced where low"""
    return {
        "qc01": [_line("QC-01", d, f"count(*) - count({c})", t(x)) for x, c, d in quality.QC01_NULL_PK],
        "qc02": [_line("QC-02", d, "count(*)", f"{t(x)} where {c} <= 0") for x, c, d in quality.QC02_PRICE],
        "qc03": [_line("QC-03", d, "count(*)", lacks(c, fk, p, pk))
                 for c, fk, p, pk, d in quality.QC03_ORPHANS],
        "qc04": [_line("QC-04", d, "count(*)", f"{t(x)} where {c} {late}")
                 for x, c, d in quality.QC04_FUTURE],
        "qc05": [_line("QC-05", d, f"count(*) - count(distinct {c})", t(x))
                 for x, c, d in quality.QC05_DUPLICATES],
        "qc06": [_line("QC-06", quality.QC06_DESCRIPTION, "count(*)", below)],
        "fk": [_line("QC-FK", f"{c}.{fk} -> {p}.{pk}", "count(*)", lacks(c, fk, p, pk))
               for c, fk, p, pk in quality.FOREIGN_KEYS],
        "pk": [_line("QC-PK", f"{x}({', '.join(k)})", "count(*) - "
                     f"(select count(*) from (select distinct {', '.join(k)} from {t(x)}) d)", t(x))
               for x, k in quality.PRIMARY_KEYS.items()],
    }


def _all_of(*lines: list[str]) -> str:
    return "\nunion all\n".join(x for group in lines for x in group)


_QC = _qc_sql()
_REPORT = ["qc01", "qc02", "qc03", "qc04", "qc05", "qc06"]


def _src_tables(spark, sf_dir):
    src, _, _ = bound(spark, sf_dir)
    return src.as_dict()


for _key, _part, _fn in [
        ("qc01_null_pk", "qc01", quality.qc01_null_pk),
        ("qc02_nonpositive_price", "qc02", quality.qc02_nonpositive_price),
        ("qc03_orphan_fk", "qc03", quality.qc03_orphan_fk),
        ("qc04_future_dates", "qc04", lambda t: quality.qc04_future_dates(t, AS_OF)),
        ("qc05_duplicate_pk", "qc05", quality.qc05_duplicate_pk),
        ("qc06_price_below_cost", "qc06", quality.qc06_price_below_cost),
        ("qc_orphans_all", "fk", quality.qc_orphans_all),
        ("qc_duplicates_all", "pk", quality.qc_duplicates_all)]:
    register(_key, _all_of(_QC[_part]))(lambda s, d, fn=_fn: fn(_src_tables(s, d)))
register("qc_report", _all_of(*[_QC[k] for k in _REPORT]))(
    lambda s, d: quality.qc_report(_src_tables(s, d), AS_OF))

# The same checks over spoilt roles, so that every one of them has failures to
# count: the whole roles with the columns below changed by a rule on their keys,
# and the rows whose first key column is divisible by REPEATED a second time.
REPEATED = 31
SPOILT = {
    "supplier": {"supplier_id": "case when supplier_id % 7 <> 0 then supplier_id end"},
    "customers": {"customer_id": "case when customer_id % 11 <> 0 then customer_id end"},
    "category": {},
    "cars": {"car_id": "case when car_id % 13 <> 0 then car_id end"},
    "parts": {"part_id": "case when part_id % 17 <> 0 then part_id end",
              "unit_price": "case when part_id % 5 = 0 then -unit_price else unit_price end",
              "category_id": "case when part_id % 9 = 0 then category_id + 1000 else category_id end"},
    "parts_car": {"car_id": "case when part_id % 47 = 0 then -car_id else car_id end",
                  "part_id": "case when part_id % 53 = 0 then -part_id else part_id end"},
    "final_delivery": {"supplier_id": "case when delivery_id % 37 = 0 then -supplier_id else supplier_id end"},
    "lot_delivery": {"delivery_id": "case when part_id % 41 = 0 then -delivery_id else delivery_id end",
                     "part_id": "case when part_id % 43 = 0 then null else part_id end"},
    "sales": {"sale_id": "case when sale_id % 19 <> 0 then sale_id end",
              "sale_price": "case when sale_id % 23 = 0 then 0 else sale_price end",
              "customer_id": "case when sale_id % 29 = 0 then -customer_id else customer_id end",
              "car_id": "case when sale_id % 59 = 0 then -car_id else car_id end"},
}
# one category is enough to be repeated: there are only a few
_AGAIN = {t: f"{k[0]} % {2 if t == 'category' else REPEATED} = 0"
          for t, k in quality.PRIMARY_KEYS.items()}


def spoilt_tables(spark, sf_dir) -> dict[str, DataFrame]:
    from torque.schemas import SOURCE, conform
    out = {}
    for name, df in _src_tables(spark, sf_dir).items():
        rows = df.unionByName(df.filter(_AGAIN[name]))
        out[name] = conform(rows.selectExpr(
            *[f"{SPOILT[name].get(c, c)} as {c}" for c in df.columns]), SOURCE[name])
    return out


for _name, _changes in SPOILT.items():
    from torque.schemas import SOURCE as _SOURCE
    _cols = ", ".join(f"{_changes.get(c, c)} as {c}" for c in _SOURCE[_name].names)
    O.cte(f"bad_{_name}", f"""
select {_cols} from (select * from src_{_name} union all select * from src_{_name} where {_AGAIN[_name]}) twice""")
_BAD = _qc_sql("bad_{}")
register("qc_report_spoilt", _all_of(*[_BAD[k] for k in _REPORT]))(
    lambda s, d: quality.qc_report(spoilt_tables(s, d), AS_OF))
register("qc_orphans_spoilt", _all_of(_BAD["fk"]))(
    lambda s, d: quality.qc_orphans_all(spoilt_tables(s, d)))
register("qc_duplicates_spoilt", _all_of(_BAD["pk"]))(
    lambda s, d: quality.qc_duplicates_all(spoilt_tables(s, d)))


@register("qc_duplicates_sketched", f"""
select description, failures, true as in_range from ({_all_of(_BAD["pk"])})""")
def q_qc_duplicates_sketched(spark, sf_dir):
    """Q17 by sketches over the spoilt roles, held against the exact counts."""
    tables = spoilt_tables(spark, sf_dir)
    ranges = key_sketches.duplicates_sketched(tables, quality.PRIMARY_KEYS)
    return (quality.qc_duplicates_all(tables).join(ranges, "description")
            .select("description", "failures",
                    F.col("failures").between(F.col("failures_low"), F.col("failures_high"))
                    .alias("in_range")))


@register("qc_duplicates_lineitem", """
select 'QC-PK' as check_id, 'lineitem(l_orderkey, l_linenumber)' as description,
       cast(coalesce(sum(n - 1), 0) as bigint) as failures
from (select count(*) as n from lineitem group by l_orderkey, l_linenumber) g""")
def q_qc_duplicates_lineitem(spark, sf_dir):
    from torque.sources.bindings import read_test_table
    li = read_test_table(spark, sf_dir, "lineitem")
    return quality.duplicate_key_check(li, ["l_orderkey", "l_linenumber"],
                                       "lineitem(l_orderkey, l_linenumber)")


# ---- MERGE scenarios (M1, G1) -------------------------------------------------------
# Two loads of DIM_CUSTOMER: load 1 = the customers with an even id,
# load 2 = every customer, names suffixed where id % 3 = 0. Load 2 covers the
# whole table: it updates every load-1 row and inserts every other one.
from torque.operators import dims  # noqa: E402
from torque.operators.joins import materialize  # noqa: E402
from torque.operators.merge import merge_upsert  # noqa: E402

NAME_SUFFIX = " (v2)"


def _customer_loads(spark, sf_dir):
    _, cfg, silver = bound(spark, sf_dir)
    full = dims.dim_customer_source(silver.customers, cfg.region_by_province)
    load1 = full.filter(F.col("customer_id") % 2 == 0)
    load2 = full.withColumn("customer_name",
                            F.when(F.col("customer_id") % 3 == 0,
                                   F.concat("customer_name", F.lit(NAME_SUFFIX)))
                            .otherwise(F.col("customer_name")))
    return cfg, load1, load2


def _merge(target, source, cfg):
    return materialize(merge_upsert(target, source, "customer_id", "customer_key", cfg.now))


O.cte("cust_src", """
select customer_id, customer_name, address, city, province, region from dim_customer""")
O.cte("cust_load1", """
select cast(row_number() over (order by customer_id) as bigint) as customer_key, *
from cust_src where customer_id % 2 = 0""")
O.cte("cust_load2", f"""
select customer_id,
       case when customer_id % 3 = 0 then customer_name || '{NAME_SUFFIX}' else customer_name end as customer_name,
       address, city, province, region
from cust_src""")
O.cte("cust_after_load2", """
select cast(case when l1.customer_key is not null then l1.customer_key
                 else (select max(customer_key) from cust_load1)
                      + row_number() over (partition by l1.customer_key is null order by l2.customer_id)
            end as bigint) as customer_key,
       l2.customer_id, l2.customer_name, l2.address, l2.city, l2.province, l2.region
from cust_load2 l2 left join cust_load1 l1 on l1.customer_id = l2.customer_id""")


@register("merge_insert", "select * from dim_customer")
def q_merge_insert(spark, sf_dir):
    """First load: every customer into an empty table."""
    _, cfg, silver = bound(spark, sf_dir)
    full = dims.dim_customer_source(silver.customers, cfg.region_by_province)
    return _no_ts(_merge(None, full, cfg))


@register("merge_update", "select * from cust_after_load2")
def q_merge_update(spark, sf_dir):
    cfg, load1, load2 = _customer_loads(spark, sf_dir)
    return _no_ts(_merge(_merge(None, load1, cfg), load2, cfg))


@register("merge_idempotent", "select * from cust_after_load2")
def q_merge_idempotent(spark, sf_dir):
    cfg, load1, load2 = _customer_loads(spark, sf_dir)
    once = _merge(_merge(None, load1, cfg), load2, cfg)
    return _no_ts(_merge(once, load2, cfg))


# Second loads of the other gold tables: first the rows of even id, then every
# row, with one column changed where id % 3 = 0.
SECOND_LOADS = {  # key: (table, natural key, surrogate, changed column, its new value)
    "merge_supplier": ("dim_supplier", "supplier_id", "supplier_key", "city", "concat(city, '*')"),
    "merge_part": ("dim_part", "part_id", "part_key", "color", "concat(color, '*')"),
    "merge_car": ("dim_car", "car_id", "car_key", "segment", "concat(segment, '*')"),
    "merge_fact": ("fact_sales", "sale_id", "sale_key", "total_parts_qty", "total_parts_qty + 1"),
}


def _second_load_sql(table: str, key: str, surrogate: str, column: str, value: str) -> str:
    return f"""
with old as (select {key}, row_number() over (order by {key}) as n from {table} where {key} % 2 = 0),
numbered as (
  select {table}.*, old.n, row_number() over (partition by old.n is null order by {table}.{key}) as late
  from {table} left join old using ({key}))
select * exclude (n, late) replace (
  cast(coalesce(n, (select count(*) from old) + late) as bigint) as {surrogate},
  case when {key} % 3 = 0 then {value} else {column} end as {column})
from numbered"""


def _two_loads(spark, sf_dir, name):
    """(first load, second load, configuration) of a gold table."""
    table, key, surrogate, column, value = SECOND_LOADS[name]
    _, cfg, _ = bound(spark, sf_dir)
    full = getattr(gold_for(spark, sf_dir), table).drop(surrogate, "load_ts")
    kind = full.schema[column].dataType
    changed = full.withColumn(column, F.expr(
        f"case when {key} % 3 = 0 then {value} else {column} end").cast(kind))
    return full.filter(f"{key} % 2 = 0"), changed, cfg


def _register_second_load(name):
    table, key, surrogate, column, value = SECOND_LOADS[name]

    def run(spark, sf_dir):
        first, second, cfg = _two_loads(spark, sf_dir, name)
        target = materialize(merge_upsert(None, first, key, surrogate, cfg.now))
        return _no_ts(merge_upsert(target, second, key, surrogate, cfg.now))
    register(name, _second_load_sql(table, key, surrogate, column, value))(run)


for _key in SECOND_LOADS:
    _register_second_load(_key)


@register("fact_incremental_months",
          f"select *, time_id // 100 as sale_month from ({_second_load_sql(*SECOND_LOADS['merge_fact'])}) f")
def q_fact_incremental_months(spark, sf_dir):
    """E3: the second load of the fact through its month partitions."""
    first, second, cfg = _two_loads(spark, sf_dir, "merge_fact")
    table = write_fact_by_month(merge_upsert(None, first, "sale_id", "sale_key", cfg.now),
                                f"{warehouse_root(spark)}/fact")
    merge_fact_months(table, second, cfg.now)
    return _no_ts(table.read())


def _kept_up(spark, sf_dir):
    """Gold tables and the partial aggregates of a fact that was loaded twice, refreshed
    after each load; built once per session."""
    def build():
        first, second, cfg = _two_loads(spark, sf_dir, "merge_fact")
        root = warehouse_root(spark)
        fact = write_fact_by_month(merge_upsert(None, first, "sale_id", "sale_key", cfg.now),
                                   f"{root}/fact")
        kept = MonthTable(spark, f"{root}/partials", key=None)
        refresh_partials(kept, fact)
        merge_fact_months(fact, second, cfg.now)
        refresh_partials(kept, fact)
        return kept
    return gold_for(spark, sf_dir), remembered(spark, sf_dir, "partials", build).read()


@register("partials_revenue_by_brand", ORACLES["rpt_revenue_by_brand"])
def q_partials_revenue_by_brand(spark, sf_dir):
    gold, kept = _kept_up(spark, sf_dir)
    return partials.revenue_by_brand(kept, gold.dim_car, gold.dim_time)


@register("partials_model_profitability", ORACLES["rpt_model_profitability"])
def q_partials_model_profitability(spark, sf_dir):
    gold, kept = _kept_up(spark, sf_dir)
    return partials.model_profitability(kept, gold.dim_car)


@register("partials_supplier_performance", ORACLES["rpt_supplier_performance"])
def q_partials_supplier_performance(spark, sf_dir):
    gold, kept = _kept_up(spark, sf_dir)
    return partials.supplier_performance(kept, gold.dim_supplier, gold.dim_time)


@register("partials_monthly_trend", ORACLES["rpt_monthly_trend"])
def q_partials_monthly_trend(spark, sf_dir):
    gold, kept = _kept_up(spark, sf_dir)
    return partials.monthly_trend(kept, gold.dim_time)


@register("fact_month_sketches", """
select time_id // 100 as sale_month, count(*) as n_rows, true as in_range
from fact_sales group by time_id // 100""")
def q_fact_month_sketches(spark, sf_dir):
    """Q13 kept up by month: sketches of sale_id beside the fact, brought up to date after
    a second load; no sale is in the fact twice."""
    src, cfg, silver = bound(spark, sf_dir)
    gold = gold_for(spark, sf_dir)

    def build():
        source = fact_source(silver.sales, silver.final_delivery, silver.parts_car,
                             gold.dim_car, gold.dim_customer, gold.dim_supplier, src.sales)
        root = warehouse_root(spark)
        fact = write_fact_by_month(
            load_fact(None, source.filter("sale_id % 2 = 0"), cfg.now), f"{root}/fact")
        kept = MonthTable(spark, f"{root}/sketches", key=None)
        key_sketches.refresh_sketches(kept, fact, ["sale_id"])
        merge_fact_months(fact, source, cfg.now)
        key_sketches.refresh_sketches(kept, fact, ["sale_id"])
        return kept
    ranges = key_sketches.duplicate_range(remembered(spark, sf_dir, "sketches", build).read(),
                                          MONTH)
    return ranges.select(MONTH, "n_rows",
                         (F.col("failures_low") == 0).alias("in_range"))


# a batch of deliveries that comes after the sales it concerns were loaded
LATE = "year(delivery_date) = 1995 and delivery_id % 3 = 0"


@register("fact_late_deliveries", "select *, time_id // 100 as sale_month from fact_sales")
def q_fact_late_deliveries(spark, sf_dir):
    """E3: a fact loaded without a batch of deliveries, whose sales are linked anew
    when it comes; the result is the fact with all deliveries."""
    src, cfg, silver = bound(spark, sf_dir)
    gold = gold_for(spark, sf_dir)
    before = silver.final_delivery.filter(f"not ({LATE})")
    first = fact_source(silver.sales, before, silver.parts_car, gold.dim_car, gold.dim_customer,
                        gold.dim_supplier, src.sales)
    table = write_fact_by_month(load_fact(None, first, cfg.now), f"{warehouse_root(spark)}/fact")
    load_late_deliveries(table, silver, before, gold, cfg.now, src.sales)
    return _no_ts(table.read())


# ---- loads and summaries (S2, S12) ----------------------------------------------------
from torque.sources import sinks  # noqa: E402
from torque.schemas import GOLD, LOAD_ORDER  # noqa: E402

O.cte("load_counts", "\nunion all\n".join(
    f"select '{t}' as table_name, cast(count(*) as bigint) as row_count from src_{t}"
    for t in LOAD_ORDER))


@register("load_summary", "select * from load_counts")
def q_load_summary(spark, sf_dir):
    src, _, _ = bound(spark, sf_dir)
    return sinks.load_summary(src.as_dict())


@register("init_tables", """
select 'dim_customer' as table_name, cast(0 as bigint) as rows_before, cast(count(*) as bigint) as rows_after from dim_customer
union all select 'dim_supplier', 0, count(*) from dim_supplier
union all select 'dim_part', 0, count(*) from dim_part
union all select 'dim_car', 0, count(*) from dim_car
union all select 'fact_sales', 0, count(*) from fact_sales""")
def q_init_tables(spark, sf_dir):
    """S10: empty gold tables are created, then loaded; row counts of both states."""
    from torque.plans.warehouse import warehouse_root
    store = sinks.SnapshotStore(spark, warehouse_root(spark))
    sinks.init_tables(store)
    before = {t: store.read(t) for t in GOLD if t != "dim_time"}
    out = None
    for name, empty in before.items():
        version = store.latest(name)
        store.write(name, getattr(gold_for(spark, sf_dir), name))
        loaded = store.read(name, version + 1)
        row = (empty.select(F.lit(False).alias("loaded"))
               .unionByName(loaded.select(F.lit(True).alias("loaded")))
               .agg(F.count_if(~F.col("loaded")).alias("rows_before"),
                    F.count_if("loaded").alias("rows_after"))
               .select(F.lit(name).alias("table_name"), "rows_before", "rows_after"))
        out = row if out is None else out.unionByName(row)
    return out


@register("load_truncate_insert", "select * from src_sales")
def q_load_truncate_insert(spark, sf_dir):
    """Round trip: load the sales role into a snapshot table and read it back."""
    import uuid
    from torque.session import ensure_checkpoint_dir
    src, _, _ = bound(spark, sf_dir)
    # a fresh table under the shared warehouse folder (default: inside the
    # session's checkpoint folder, never a machine-local temp folder)
    base = spark.conf.get("torque.warehouse.dir", None) or f"{ensure_checkpoint_dir(spark)}/warehouse"
    root = f"{base}/{uuid.uuid4().hex}"
    store = sinks.SnapshotStore(spark, root)
    sinks.load_truncate_insert(store, "sales", src.sales)
    return store.read("sales")


# ---- generators (S4-S9): keyed by the test tables' own ids ---------------------------
# Draws are bits of an MD5 digest, which the oracles restate.
from torque.config import GENERATOR_END, GENERATOR_START  # noqa: E402
from torque.sources import generators as G  # noqa: E402
from torque.sources.bindings import read_test_table  # noqa: E402


SEED = 42


def _draw(key: str, tag: str) -> str:
    return f"cast('0x' || substr(md5(concat_ws('|', '{SEED}', {key}, {tag})), 1, 15) as bigint)"


def _between(key: str, tag: str, lo, hi) -> str:
    return f"({lo} + {_draw(key, tag)} % (({hi}) - ({lo}) + 1))"


def _one_of(values: list[str], key: str, tag: str) -> str:
    return f"[{', '.join(repr(v) for v in values)}][{_draw(key, tag)} % {len(values)} + 1]"


def _person(role: str, name: str, first, last, highest: int, source: str, key: str) -> str:
    cities, provinces = zip(*G.PLACES)
    place = f"'{role}.place'"
    return f"""
select {key} as {name}_id,
       {_one_of(first[0], key, f"'{role}.{first[1]}'")} || ' ' || {_one_of(last[0], key, f"'{role}.{last[1]}'")} as {name}_name,
       cast({_between(key, f"'{role}.address.no'", 1, highest)} as varchar) || ' '
         || {_one_of(G.STREETS, key, f"'{role}.address.street'")} as address,
       {_one_of(list(cities), key, place)} as city, {_one_of(list(provinces), key, place)} as province
from {source}"""


def _date(key: str, tag: str) -> str:
    days = (GENERATOR_END - GENERATOR_START).days
    return f"cast(date '{GENERATOR_START}' + cast({_between(key, tag, 0, days)} as integer) as date)"


@register("gen_suppliers", _person("supplier", "supplier", (G.TRADES, "trade"), (G.FORMS, "form"),
                                   200, "supplier", "s_suppkey"))
def q_gen_suppliers(spark, sf_dir):
    ids = read_test_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    return G.gen_suppliers(ids, SEED)


@register("gen_customers", _person("customer", "customer", (G.FIRST_NAMES, "first"),
                                   (G.LAST_NAMES, "last"), 300, "customer", "c_custkey"))
def q_gen_customers(spark, sf_dir):
    ids = read_test_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return G.gen_customers(ids, SEED)


@register("bom_explode", """
select p_partkey // 12 + 1 as car_id, p_partkey as part_id, cast(1 + p_size % 2 as int) as quantity
from part""")
def q_bom_explode(spark, sf_dir):
    """Nested bills of materials, gathered from the part table (twelve neighbouring
    keys a car, so each list is short by construction), flattened again."""
    part = read_test_table(spark, sf_dir, "part")
    bom_map = (part.groupBy((F.floor(F.col("p_partkey") / 12) + 1).alias("car_id"))
               .agg(F.collect_list(F.struct(F.col("p_partkey").alias("part_id"),
                                            (1 + F.col("p_size") % 2).alias("quantity")))
                    .alias("parts")))
    return G.bom_explode(bom_map)


_steps = ""
for _i in range(5):
    _at = _between("delivery_id", f"'delivery.part.{_i}'", 0, f"n - k + {_i}")
    _steps += f""",
s{_i + 1} as (select delivery_id, delivery_date, n, k, case when {_i} >= k then taken
      when list_contains(taken, {_at}) then list_append(taken, n - k + {_i})
      else list_append(taken, {_at}) end as taken from s{_i})"""


@register("gen_deliveries", f"""
with s0 as (
  select delivery_id, {_date('delivery_id', "'delivery.date'")} as delivery_date, n,
         least({_between('delivery_id', "'delivery.k'", 2, 5)}, n) as k, []::bigint[] as taken
  from src_final_delivery, (select count(*) as n from dim_part) c){_steps},
lots as (select delivery_id, delivery_date, unnest(taken) + 1 as part_key from s5)
select delivery_id, part_id, delivery_date,
       cast({_between("concat_ws('|', delivery_id, part_id)", "'lot.qty'", 20, 200)} as integer) as quantity
from lots join dim_part using (part_key)""")
def q_gen_deliveries(spark, sf_dir):
    src, _, _ = bound(spark, sf_dir)
    g = gold_for(spark, sf_dir)
    ids = src.final_delivery.select(F.col("delivery_id").alias("id"))
    parts = g.dim_part.select(F.col("part_key").alias("part_idx"), "part_id")
    _, lots = G.gen_deliveries(ids, src.supplier.count(), parts, g.dim_part.count(), SEED)
    return lots


@register("gen_sales", f"""
with drawn as (
  select sale_id, {_between('sale_id', "'sale.customer'", 1, '(select count(*) from src_customers)')} as customer_id,
         {_between('sale_id', "'sale.car'", 1, '(select count(*) from dim_car)')} as car_key,
         {_date('sale_id', "'sale.date'")} as sale_date,
         cast(1 + cast({_between('sale_id', "'sale.variation'", -10000, 10000)} as decimal(9,0))
              * cast(0.00001 as decimal(6,5)) as decimal(9,5)) as factor
  from src_sales)
select sale_id, customer_id, car_id, sale_date,
       cast(round(cast(2 * total_parts_cost as decimal(12,2)) * factor, 2) as decimal(12,2)) as sale_price
from drawn join dim_car using (car_key) join bom_cost using (car_id)""")
def q_gen_sales(spark, sf_dir):
    src, _, _ = bound(spark, sf_dir)
    g = gold_for(spark, sf_dir)
    ids = src.sales.select(F.col("sale_id").alias("id"))
    prices = (g.dim_car.select(F.col("car_key").alias("car_idx"), "car_id")
              .join(staging.bom_cost(src.parts_car, src.parts), "car_id")
              .select("car_idx", "car_id",
                      (F.col("total_parts_cost") * F.lit(2)).cast("decimal(12,2)").alias("base_price")))
    return G.gen_sales(ids, src.customers.count(), prices, g.dim_car.count(), SEED)


# ---- extensions (E1, E2) -----------------------------------------------------------------
from torque.operators.history import load_scd2_buckets, scd2_merge  # noqa: E402
from torque.streaming.cdc import latest_per_key, run_change_feed  # noqa: E402

SCD_LOAD1, SCD_LOAD2 = dt.date(2001, 1, 1), dt.date(2001, 6, 30)
MOVED = " (moved)"
TRACKED = ["address", "city", "province", "region"]


O.cte("scd_l1", """
select cast(row_number() over (order by customer_id) as bigint) as customer_key, * from cust_src""")


@register("scd2_customer", f"""
select customer_key, customer_id, customer_name, address, city, province, region,
       date '{SCD_LOAD1}' as valid_from,
       case when customer_id % 10 = 0 then date '{SCD_LOAD2 - dt.timedelta(days=1)}' end as valid_to,
       customer_id % 10 <> 0 as is_current
from scd_l1
union all
select cast((select max(customer_key) from scd_l1) + row_number() over (order by customer_id) as bigint),
       customer_id, customer_name, address, city, province || '{MOVED}', 'Other',
       date '{SCD_LOAD2}', cast(null as date), true
from cust_src where customer_id % 10 = 0""")
def q_scd2_customer(spark, sf_dir):
    """Two loads of a type-2 customer history: every customer, then the same
    customers with the province changed for every tenth id."""
    load1, load2, cfg = _history_loads(spark, sf_dir)
    h1 = materialize(scd2_merge(None, load1, "customer_id", "customer_key", TRACKED, SCD_LOAD1, cfg.now))
    h2 = scd2_merge(h1, load2, "customer_id", "customer_key", TRACKED, SCD_LOAD2, cfg.now)
    return _no_ts(h2)


def _history_loads(spark, sf_dir):
    """All customers as they are and with every tenth id moved, and the configuration."""
    _, cfg, silver = bound(spark, sf_dir)
    moved = silver.customers.withColumn(
        "province", F.when(F.col("customer_id") % 10 == 0, F.concat("province", F.lit(MOVED)))
        .otherwise(F.col("province")))
    return (*[dims.dim_customer_source(c, cfg.region_by_province) for c in (silver.customers, moved)],
            cfg)


@register("scd2_buckets", ORACLES["scd2_customer"])
def q_scd2_buckets(spark, sf_dir):
    """The loads of ``scd2_customer`` into a history in hash buckets of the customer."""
    load1, load2, cfg = _history_loads(spark, sf_dir)
    table = PartTable(spark, f"{warehouse_root(spark)}/customer_history", "bucket", "customer_key")
    for load, day in ((load1, SCD_LOAD1), (load2, SCD_LOAD2)):
        load_scd2_buckets(table, load, "customer_id", TRACKED, day, cfg.now, buckets=16)
    return _no_ts(table.read()).drop("bucket")


EARLY, LATER = dt.date(1993, 3, 1), dt.date(1996, 1, 1)


@register("fact_as_of_customer", f"""
with versions as (
  select customer_key, customer_id, province, region, date '{EARLY}' as valid_from from scd_l1
  union all
  select cast((select count(*) from scd_l1) + row_number() over (order by customer_id) as bigint),
         customer_id, province || '{MOVED}', 'Other', date '{LATER}'
  from cust_src where customer_id % 10 = 0)
select s.sale_id, s.customer_id, s.sale_date, s.sale_date >= date '{EARLY}' as in_history,
       v.customer_key, v.province, v.region
from stg_sales s asof join versions v
  on s.customer_id = v.customer_id and greatest(s.sale_date, date '{EARLY}') >= v.valid_from""")
def q_fact_as_of_customer(spark, sf_dir):
    """E1: every sale with the customer version that was valid on its day."""
    _, cfg, silver = bound(spark, sf_dir)
    moved = silver.customers.withColumn(
        "province", F.when(F.col("customer_id") % 10 == 0, F.concat("province", F.lit(MOVED)))
        .otherwise(F.col("province")))
    history = None
    for customers, day in ((silver.customers, EARLY), (moved, LATER)):
        load = dims.dim_customer_source(customers, cfg.region_by_province)
        history = materialize(scd2_merge(history, load, "customer_id", "customer_key", TRACKED, day,
                                         cfg.now))
    return version_as_of(silver.sales.select("sale_id", "customer_id", "sale_date"), "customer_id",
                         "sale_date", history, ["customer_key", "province", "region"])


O.cte("scd_after_2", ORACLES["scd2_customer"][ORACLES["scd2_customer"].rindex("\nselect customer_key"):])
AGAIN = " (again)"


@register("scd2_same_day", f"""
with top as (select max(customer_key) as k from scd_after_2),
third as (select customer_id from cust_src where customer_id % 15 = 0)
select h.customer_key, h.customer_id, h.customer_name, h.address, h.city,
       case when h.is_current and h.valid_from = date '{SCD_LOAD2}' and h.customer_id % 15 = 0
            then h.province || '{AGAIN}' else h.province end as province,
       h.region, h.valid_from,
       case when h.is_current and h.valid_from < date '{SCD_LOAD2}' and h.customer_id % 15 = 0
            then date '{SCD_LOAD2 - dt.timedelta(days=1)}' else h.valid_to end as valid_to,
       h.is_current and not (h.valid_from < date '{SCD_LOAD2}' and h.customer_id % 15 = 0) as is_current
from scd_after_2 h
union all
select cast(k + row_number() over (order by h.customer_id) as bigint), h.customer_id, h.customer_name,
       h.address, h.city, h.province || '{AGAIN}', 'Other', date '{SCD_LOAD2}', cast(null as date), true
from scd_after_2 h, top
where h.is_current and h.valid_from < date '{SCD_LOAD2}' and h.customer_id % 15 = 0""")
def q_scd2_same_day(spark, sf_dir):
    """A third load dated like the second: every fifteenth id changes again. Ids
    that the second load changed are replaced in place, others get a version."""
    _, cfg, silver = bound(spark, sf_dir)
    moved = F.when(F.col("customer_id") % 10 == 0, F.concat("province", F.lit(MOVED))).otherwise(
        F.col("province"))
    again = F.when(F.col("customer_id") % 15 == 0, F.concat(moved, F.lit(AGAIN))).otherwise(moved)
    h = None
    for province, day in ((F.col("province"), SCD_LOAD1), (moved, SCD_LOAD2), (again, SCD_LOAD2)):
        load = dims.dim_customer_source(silver.customers.withColumn("province", province),
                                        cfg.region_by_province)
        h = materialize(scd2_merge(h, load, "customer_id", "customer_key", TRACKED, day, cfg.now))
    return _no_ts(h)


@register("cdc_latest", """
select event_id, ts, user_id, event_type, value, props from (
  select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) x
where rn = 1""")
def q_cdc_latest(spark, sf_dir):
    """Latest change per key of a change feed (the events table: key user_id,
    version order (ts, event_id))."""
    events = read_test_table(spark, sf_dir, "events")
    return latest_per_key(events, "user_id", ["ts", "event_id"])


FEED_BATCHES = 3   # events reach the feed in three deliveries, by event_id % 3


@register("cdc_stream_merge", f"""
select cast(row_number() over (order by first_batch, user_id) as bigint) as user_key, user_id,
       event_id, ts, event_type, value, props
from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn,
             min(event_id % {FEED_BATCHES}) over (partition by user_id) as first_batch
      from events) x
where rn = 1""")
def q_cdc_stream_merge(spark, sf_dir):
    """E2 end to end: the events table as a change feed read with Structured
    Streaming. It arrives in several deliveries, each full of changes that are
    older than ones already merged; the result is the latest version per user."""
    import uuid
    from torque.plans.warehouse import warehouse_root
    from torque.session import ensure_checkpoint_dir
    from torque.sources.bindings import NOW
    from torque.sources.sinks import SnapshotStore
    events = read_test_table(spark, sf_dir, "events")
    root = warehouse_root(spark)
    store, feed = SnapshotStore(spark, root), f"{root}/feed"
    ckpt = f"{ensure_checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}"
    for k in range(FEED_BATCHES):
        (events.filter(F.col("event_id") % FEED_BATCHES == k)
         .write.mode("append").parquet(feed))
        run_change_feed(spark, feed, events.schema, store, "user_latest", "user_id",
                        ["ts", "event_id"], "user_key", ckpt, now=NOW)
    return _no_ts(store.read("user_latest"))


@register("cdc_bucket_merge", ORACLES["cdc_stream_merge"])
def q_cdc_bucket_merge(spark, sf_dir):
    """E2 into hash buckets: the same feed, each delivery replacing the buckets of its users."""
    from torque.sources.bindings import NOW
    events, root = read_test_table(spark, sf_dir, "events"), warehouse_root(spark)
    table = PartTable(spark, f"{root}/user_latest", "bucket", "user_key")
    for k in range(FEED_BATCHES):
        events.filter(F.col("event_id") % FEED_BATCHES == k).write.mode("append").parquet(
            f"{root}/feed")
        run_change_feed(spark, f"{root}/feed", events.schema, table, None, "user_id",
                        ["ts", "event_id"], "user_key", f"{root}/stream", now=NOW, buckets=16)
    return _no_ts(table.read()).drop("bucket")


CUSTOMER_BUCKETS = 16


def _co_located(spark, sf_dir):
    """(fact, customers) in buckets of the customer key; written once per session."""
    def build():
        import uuid
        gold, root, tag = gold_for(spark, sf_dir), warehouse_root(spark), uuid.uuid4().hex
        return [write_bucketed(df, f"{name}_{tag}", f"{root}/{name}_bucketed", "customer_key",
                               CUSTOMER_BUCKETS)
                for name, df in (("fact_sales", gold.fact_sales), ("dim_customer", gold.dim_customer))]
    return remembered(spark, sf_dir, "co_located", build)


@register("co_located_sales_by_region", ORACLES["rpt_sales_by_region"])
def q_co_located_sales_by_region(spark, sf_dir):
    """R2 over tables bucketed by customer: no fact row moves to meet its customer."""
    fact, customers = _co_located(spark, sf_dir)
    return reports.rpt_sales_by_region(fact, customers, gold_for(spark, sf_dir).dim_time)
