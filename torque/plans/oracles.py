"""Independent SQL oracles (DuckDB dialect) for the query catalogue.

Written naively from the reference's semantics — grouped fan-out joins,
``ROW_NUMBER`` keys, a native ``ASOF JOIN``, a sale-by-part expansion of the
segment report — so the Spark rewrites are checked against un-rewritten forms. Each
oracle is one statement: the FIXTURES binding and the model layers are
inlined as a ``WITH`` prefix assembled from the named CTEs below.

Rounded ratios use exact integer arithmetic (DuckDB turns decimal division
and AVG into DOUBLE): ``sign * ((2|N|M + |D|) // (2|D|))``.
"""

from __future__ import annotations

# ---- exact rounding ---------------------------------------------------------


def rdiv(num: str, den: str, num_scale: int, den_scale: int, out_scale: int,
         factor: int = 1, out_type: str = "decimal(18,2)") -> str:
    """SQL for ROUND(factor * num / NULLIF(den, 0), out_scale), exact."""
    n = f"cast(({num}) * {10 ** num_scale} as hugeint)" if num_scale else f"cast(({num}) as hugeint)"
    d = f"cast(({den}) * {10 ** den_scale} as hugeint)" if den_scale else f"cast(({den}) as hugeint)"
    e = out_scale + den_scale - num_scale
    if e >= 0:
        n = f"({n} * {factor * 10 ** e})"
    else:
        n = f"({n} * {factor})"
        d = f"({d} * {10 ** (-e)})"
    q = f"((2 * abs({n}) + abs({d})) // (2 * abs({d})))"
    signed = f"(case when ({n} < 0) <> ({d} < 0) then -{q} else {q} end)"
    scaled = f"cast({signed} as decimal(20,0))"
    if out_scale:
        scaled = f"({scaled} * {1 / 10 ** out_scale:.{out_scale}f})"
    return f"(case when {d} <> 0 then cast({scaled} as {out_type}) end)"


def ravg(col: str, col_scale: int, factor: int = 1) -> str:
    return rdiv(f"sum({col})", f"count({col})", col_scale, 0, 2, factor)


# ---- CTE library ----------------------------------------------------------------

CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql.strip()


# FIXTURES §2 binding
cte("src_supplier", """
select s_suppkey as supplier_id, s_name as supplier_name, cast(null as varchar(10)) as address,
       n_name as city, r_name as province
from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""")
cte("src_customers", """
select c_custkey as customer_id, c_name as customer_name, cast(null as varchar(10)) as address,
       cast(null as varchar(10)) as city, n_name as province
from customer join nation on c_nationkey = n_nationkey""")
cte("src_category", """
select cast(row_number() over (order by nm) as bigint) as category_id, nm as category_name
from (select distinct split_part(p_name, ' ', 2) as nm from part) x""")
cte("src_parts", """
select p_partkey as part_id, p_name as part_name,
       case when split_part(p_name, ' ', 1) in ('red', 'blue') then split_part(p_name, ' ', 1) end as color,
       cast(p_retailprice as decimal(10,2)) as unit_price, category_id
from part join src_category on category_name = split_part(p_name, ' ', 2)""")
cte("src_cars", """
select car_id, brand, model, cast(1995 + car_id % 7 as int) as manufacture_year
from (select p_partkey // 12 + 1 as car_id, arg_min(p_brand, p_partkey) as brand,
             arg_min(p_type, p_partkey) as model
      from part group by p_partkey // 12) firsts""")
cte("src_parts_car", """
select p_partkey // 12 + 1 as car_id, p_partkey as part_id, cast(1 + p_size % 2 as int) as quantity
from part""")
cte("src_sales", """
select o_orderkey as sale_id, o_custkey as customer_id, lead_part // 12 + 1 as car_id,
       cast(o_orderdate as date) as sale_date, cast(o_totalprice as decimal(12,2)) as sale_price
from orders
left join (select l_orderkey, min(l_partkey) as lead_part from lineitem group by l_orderkey) l
       on o_orderkey = l_orderkey""")
cte("src_final_delivery", """
select distinct l_suppkey * 100000000 + year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) as delivery_id,
       l_suppkey as supplier_id, cast(l_shipdate as date) as delivery_date
from lineitem""")
cte("src_lot_delivery", """
select l_suppkey * 100000000 + year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) as delivery_id,
       l_partkey as part_id, cast(l_shipdate as date) as delivery_date, cast(sum(l_quantity) as int) as quantity
from lineitem
group by l_suppkey, l_partkey, l_shipdate""")

# ---- silver --------------------------------------------------------------------
cte("stg_supplier", """
select supplier_id, trim(supplier_name) as supplier_name, trim(coalesce(address, 'Unknown')) as address,
       trim(coalesce(city, 'Unknown')) as city, trim(coalesce(province, 'Unknown')) as province
from src_supplier""")
cte("stg_customers", """
select customer_id, trim(customer_name) as customer_name, trim(coalesce(address, 'Unknown')) as address,
       trim(coalesce(city, 'Unknown')) as city, trim(coalesce(province, 'Unknown')) as province
from src_customers""")
cte("stg_cars", """
select car_id, trim(brand) as brand, trim(model) as model, cast(manufacture_year as integer) as manufacture_year
from src_cars""")
cte("stg_category", """
select category_id, trim(category_name) as category_name from src_category""")
cte("stg_parts", """
select p.part_id, trim(p.part_name) as part_name, trim(coalesce(p.color, 'Unknown')) as color,
       cast(p.unit_price as decimal(10,2)) as unit_price, p.category_id, trim(c.category_name) as category_name
from src_parts p join src_category c on p.category_id = c.category_id""")
cte("bom_lines", """
select lines.car_id, lines.part_id, lines.quantity, priced.unit_price * lines.quantity as line_cost
from src_parts_car lines, src_parts priced where priced.part_id = lines.part_id""")
cte("stg_sales", """
with costed as (
  select src_sales.*, (select sum(line_cost) from bom_lines where bom_lines.car_id = src_sales.car_id) as cost
  from src_sales)
select sale_id, customer_id, car_id, sale_date, sale_price,
       cast(cost as decimal(12,2)) as total_parts_cost,
       cast(sale_price - cost as decimal(12,2)) as gross_margin
from costed where cost is not null""")
cte("stg_parts_car", "select car_id, part_id, quantity from src_parts_car")
cte("stg_final_delivery", """
select delivery_id, supplier_id, cast(delivery_date as date) as delivery_date from src_final_delivery""")
cte("stg_lot_delivery", """
select delivery_id, part_id, cast(delivery_date as date) as delivery_date, quantity as quantity_delivered
from src_lot_delivery""")
cte("bom_cost", """
select car_id, cast(sum(line_cost) as decimal(12,2)) as total_parts_cost from bom_lines group by car_id""")
cte("bom_counts", """
select car_id, cast(count(distinct part_id) as integer) as unique_parts_count,
       cast(sum(quantity) as integer) as total_parts_qty
from stg_parts_car group by car_id""")

# ---- gold ------------------------------------------------------------------------
cte("dim_time", """
select cast(year(d) * 10000 + month(d) * 100 + day(d) as integer) as time_id, cast(d as date) as full_date,
       cast(year(d) as integer) as year, cast(quarter(d) as integer) as quarter,
       'Q' || cast(quarter(d) as varchar) as quarter_name, cast(month(d) as integer) as month,
       strftime(d, '%B') as month_name, strftime(d, '%b') as month_short,
       cast(week(d) as integer) as week_of_year, cast(day(d) as integer) as day_of_month,
       cast(dayofweek(d) as integer) as day_of_week, strftime(d, '%A') as day_name,
       dayofweek(d) in (0, 6) as is_weekend
from (select unnest(generate_series(make_date(year(min(sale_date)), 1, 1),
                                    make_date(year(max(sale_date)), 12, 31), interval 1 day)) as d
      from src_sales) s""")
cte("region_map", """
select n_name as province, r_name as region from nation join region on n_regionkey = r_regionkey
where r_name in ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE')""")
cte("dim_customer", """
select cast(row_number() over (order by customer_id) as bigint) as customer_key, customer_id, customer_name,
       address, city, province,
       case when province in (select province from region_map where region = 'AFRICA') then 'AFRICA'
            when province in (select province from region_map where region = 'AMERICA') then 'AMERICA'
            when province in (select province from region_map where region = 'ASIA') then 'ASIA'
            when province in (select province from region_map where region = 'EUROPE') then 'EUROPE'
            else 'Other' end as region
from stg_customers""")
cte("dim_supplier", """
select cast(row_number() over (order by supplier_id) as bigint) as supplier_key, supplier_id, supplier_name,
       address, city, province
from stg_supplier""")
cte("dim_part", """
select cast(row_number() over (order by part_id) as bigint) as part_key, part_id, part_name, color, unit_price,
       category_id, category_name
from stg_parts""")
cte("segment_names", """
select * from (values ('PROMO', 'Electric'), ('LARGE', 'SUV'), ('ECONOMY', 'Subcompact'),
                      ('SMALL', 'Compact')) v(model_name, segment_name)""")
cte("dim_car", """
with known as (
  select stg_cars.*, bom_counts.unique_parts_count, bom_counts.total_parts_qty as qty
  from bom_counts join stg_cars using (car_id))
select cast(row_number() over (order by car_id) as bigint) as car_key, car_id, brand, model, manufacture_year,
       concat(brand, ' ', model) as brand_model, coalesce(segment_name, 'Other') as segment,
       unique_parts_count as unique_parts, qty as total_parts_qty
from known left join segment_names on model_name = model""")
cte("day_winner", """
select delivery_date, supplier_id from (
  select delivery_date, supplier_id,
         row_number() over (partition by delivery_date order by delivery_id desc) as rn
  from stg_final_delivery) x where rn = 1""")
cte("linked_supplier", """
select s.sale_id, w.supplier_id, w.delivery_date
from stg_sales s asof join day_winner w on s.sale_date >= w.delivery_date""")
cte("linked_sales", """
select stg_sales.*, (select customer_key from dim_customer where dim_customer.customer_id = stg_sales.customer_id) as customer_key,
       (select car_key from dim_car where dim_car.car_id = stg_sales.car_id) as car_key,
       (select supplier_key from dim_supplier join linked_supplier using (supplier_id)
        where linked_supplier.sale_id = stg_sales.sale_id) as supplier_key
from stg_sales""")
cte("fact_src", f"""
select car_key, customer_key, supplier_key, cast(strftime(sale_date, '%Y%m%d') as integer) as time_id,
       sale_id, sale_price, total_parts_cost, gross_margin,
       {rdiv('gross_margin', 'sale_price', 2, 2, 4, out_type='decimal(6,4)')} as gross_margin_pct,
       unique_parts_count, total_parts_qty
from linked_sales join bom_counts using (car_id)
where customer_key is not null and car_key is not null and supplier_key is not null""")
cte("fact_sales", """
select cast(row_number() over (order by sale_id) as bigint) as sale_key, * from fact_src""")


def _deps(name: str, seen: list[str]) -> None:
    if name in seen:
        return
    body = CTES[name]
    for other in CTES:
        if other != name and _mentions(body, other):
            _deps(other, seen)
    seen.append(name)


def _mentions(body: str, name: str) -> bool:
    import re
    return re.search(rf"(?<![A-Za-z0-9_]){name}(?![A-Za-z0-9_])", body) is not None


def with_ctes(final: str) -> str:
    """Prefix ``final`` with every CTE it (transitively) references."""
    order: list[str] = []
    for name in CTES:
        if _mentions(final, name):
            _deps(name, order)
    if not order:
        return final.strip()
    if final.strip().startswith("with "):
        final = f"select * from (\n{final.strip()}\n) final"
    parts = ",\n".join(f"{n} as (\n{CTES[n]}\n)" for n in order)
    return f"with {parts}\n{final.strip()}"
