"""Reference SQL of the dated features (as-of mapping, currencies, merges, history, positions), for DuckDB.

Written by other means than the Spark code: range joins and correlated counts where Spark reduces to points, and
islands of equal neighbours where Spark compares each snapshot with the open versions.
"""

from __future__ import annotations

from .oracle import best, lp, model_sql, rnd, with_chain, xsum

DAY = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"


def iso(x: str) -> str:
    return f"try_cast(case when regexp_full_match({x}, '{DAY}') then {x} end as date)"


MAPPING_HISTORY = f"""(
  select raw_value, std || suffix as value, {iso('s')} as s, {iso('e')} as e, active
  from (select p_partkey k, 'SKU-' || {lp('p_partkey', 7)} std,
               unnest(['SKU-' || {lp('p_partkey', 7)}, 'SKU' || {lp('p_partkey', 7)}, ' sku_' || {lp('p_partkey', 7)}]) raw_value
        from part)
  join (values (0, '-A', null, '1997-12-31', 1), (0, '', '1998-01-01', null, 1), (1, '', '1992-01-01', null, 1),
               (1, '-PROMO', '1998-01-01', '1998-06-30', 1), (2, '', '1998-01-01', '2000-06-30', 1),
               (3, '-B', '1996-01-01', null, 1), (3, '', '1996-01-01', 'not a day', 1), (4, '', null, null, 1),
               (5, '', null, null, 1), (5, '-OFF', '1999-01-01', null, 0)) t(kind, suffix, s, e, active) on k % 6 = kind
  where not (k % 6 = 4 and raw_value like 'SKU0%'))"""

ASOF = f"""
, lines as (select *, row_number() over () r, lower(trim(product_sku)) k, {iso('ship_date')} d from sales_orders_raw),
versions as (select distinct lower(trim(raw_value)) k, s, e, value from {MAPPING_HISTORY} where active = 1),
valid as (
  select l.r, v.value from lines l join versions v on v.k = l.k and coalesce(v.s, date '0001-01-01') <= l.d
                                                 and coalesce(v.e, date '9999-12-31') >= l.d
  qualify row_number() over (partition by l.r order by v.s desc nulls last, v.value) = 1)
select trim(l.order_id) as order_id, l.order_line_id, l.ship_date, l.product_sku as raw_sku,
       coalesce(w.value, trim(l.product_sku)) as standard_sku,
       case when w.value is not null then 'valid' when l.k not in (select k from versions) then 'unknown'
            when l.d is null then 'undated' else 'outside' end as standard_sku_mapping
from lines l left join valid w using (r)"""

CODE = "case when regexp_full_match(upper(trim(currency)), '[A-Z]{3}') then upper(trim(currency)) else '???' end"

TOTALS = f"""
select product_sku, {CODE} as currency, count(*) as n_rows, {xsum('gross_revenue')} as total from fct_sales_orders group by all"""

RATES = """(
  select m as s, 0.5 + (month(m) + year(m) % 4) / 64 as rate
  from (select distinct date_trunc('month', o_orderdate)::date m from orders) where m >= date '1996-01-01')"""

REVENUE = f"""
, totals as ({TOTALS}),
texts as (select product_sku, string_agg(currency || '=' || cast(cast(total as decimal(38,2)) as varchar), ';' order by currency) t
          from totals group by product_sku),
lines as (select product_sku, gross_revenue g, {CODE} c, {iso('order_date')} d from fct_sales_orders),
based as (
  select l.product_sku, case l.c when 'USD' then g when 'CAD' then {rnd('(g * r.rate)', 6)} end b
  from lines l asof left join {RATES} r on l.d >= r.s),
sums as (select product_sku, {xsum('b')} s, count(*) filter (b is null) n from based group by product_sku)
select t.product_sku, t.t as revenue_by_currency, s.s as revenue_in_base, s.n as n_unconverted
from texts t join sums s on s.product_sku is not distinct from t.product_sku"""

DIVISIONS = f"""
select coalesce(p.division, 'Unknown product') as division, {CODE} as currency, {xsum('gross_revenue')} as total
from fct_sales_orders f left join dim_product p on p.product_sku = f.product_sku group by all"""

HISTORY = """
, days(n, day) as (values (0, date '2024-01-01'), (1, date '2024-02-01'), (2, date '2024-03-01'), (3, date '2024-04-01')),
digits as (select *, substr(md5(product_sku), 1, 1) x from dim_product),
snaps as (
  select n, day, product_sku, product_name, case when x = '9' and n = 1 then null else brand_family end as brand_family,
         case when x = 'a' then category || ' ' || n else category end as category,
         case when x = '2' and n >= 2 then 'discontinued' else lifecycle_status end as lifecycle_status
  from digits, days where not ((x = '3' and n = 1) or (x = '5' and n >= 2) or (x = '7' and n = 0))),
starts as (
  select *, case when lag(n) over w is distinct from n - 1 or lag(product_name) over w is distinct from product_name
                   or lag(brand_family) over w is distinct from brand_family or lag(category) over w is distinct from category
                   or lag(lifecycle_status) over w is distinct from lifecycle_status then 1 else 0 end b
  from snaps window w as (partition by product_sku order by n)),
islands as (select *, sum(b) over (partition by product_sku order by n) i from starts),
spans as (
  select product_sku, product_name, brand_family, category, lifecycle_status, min(day) f, max(n) z from islands
  group by product_sku, i, product_name, brand_family, category, lifecycle_status)
select product_sku, product_name, brand_family, category, lifecycle_status, cast(f as varchar) as valid_from,
       cast(cast(d.day - interval 1 day as date) as varchar) as valid_to
from spans left join days d on d.n = z + 1"""

READINGS = f"""
  select warehouse_id, product_sku, {iso('snapshot_date')} d, max(on_hand_qty) q from fct_inventory_snapshots
  where on_hand_qty is not null and {iso('snapshot_date')} is not null group by all"""

POSITION = f"""
, readings as ({READINGS}),
held as (select *, lead(d) over (partition by warehouse_id, product_sku order by d) z from readings),
edges as (select warehouse_id, d, sum(q) q from (select warehouse_id, d, q from held union all
          select warehouse_id, z, -q from held where z is not null) group by all),
spine as (
  select warehouse_id, unnest(generate_series(f, (select max(d) from edges), interval 1 day))::date d
  from (select warehouse_id, min(d) f from edges group by warehouse_id)),
flows as (select warehouse_id, {iso('ship_date')} d, sum(shipped_units) f from fct_shipments group by all),
moving as (
  select s.warehouse_id, s.d, coalesce(sum(f.f), 0) f from spine s
  left join flows f on f.warehouse_id is not distinct from s.warehouse_id and f.d between s.d - 27 and s.d group by all),
standing as (
  select s.warehouse_id, s.d, sum(coalesce(e.q, 0)) over (partition by s.warehouse_id order by s.d) p
  from spine s left join edges e on e.warehouse_id is not distinct from s.warehouse_id and e.d = s.d)
select p.warehouse_id, cast(p.d as varchar) as day, cast(p.p as bigint) as on_hand, cast(m.f as bigint) as shipped_28d,
       case when m.f > 0 and p.p > 0 then {rnd('(cast(p.p as double) * 28 / m.f)', 2)} end as days_of_supply
from standing p join moving m on m.warehouse_id is not distinct from p.warehouse_id and m.d = p.d"""

RECONCILED = f"""
, readings as (select *, lag(d) over w pd, lag(q) over w pq from ({READINGS})
               window w as (partition by warehouse_id, product_sku order by d)),
moves as (
  select warehouse_id, product_sku, {iso('received_date')} d, received_qty x from fct_purchase_orders
  union all select warehouse_id, product_sku, {iso('ship_date')}, -shipped_units from fct_shipments),
sums as (
  select r.warehouse_id w, r.product_sku p, r.d rd, coalesce(sum(m.x), 0) x from readings r
  left join moves m on m.warehouse_id is not distinct from r.warehouse_id and m.product_sku is not distinct from r.product_sku
                       and m.d > r.pd and m.d <= r.d where r.pd is not null group by all)
select r.warehouse_id, r.product_sku, cast(r.d as varchar) as day, r.q as reading, r.pq as previous, cast(s.x as bigint) as moved,
       cast(r.pq + s.x as bigint) as expected, cast(r.q - r.pq - s.x as bigint) as difference
from readings r left join sums s on s.w is not distinct from r.warehouse_id and s.p is not distinct from r.product_sku and s.rd = r.d"""

EVENT_ORDER = """
, e as (
  select *, row_number() over () r, case event_type when 'VIEW' then 1 when 'SIGNUP' then 2 when 'CLICK' then 3
                                     when 'ERROR' then 4 when 'PURCHASE' then 5 end as step from stg_shipment_events),
late as (select distinct a.r from e a join e b on b.shipment_id is not distinct from a.shipment_id and b.step > a.step
                                               and b.event_timestamp < a.event_timestamp)
select shipment_id, event_timestamp, event_type, step,
       case when event_timestamp is not null and step is not null then (case when r in (from late) then 1 else 0 end) end
         as is_out_of_order
from e"""

SURROGATES = """
select product_sku, row_number() over (order by case when is_in_plm = 1 then 0 else 1 end, product_sku nulls first) as surrogate_key
from dim_product"""

RETAILERS = """
select substr(week_start_date, 1, 4) as year, count(distinct retailer_id) as n_retailers, 1 as is_within_error
from fct_retail_pos group by 1"""

_MODELS = ["fct_sales_orders", "fct_retail_pos", "fct_inventory_snapshots", "fct_purchase_orders", "fct_shipments",
           "stg_shipment_events", "fct_marketing_performance", "stg_marketing_campaigns", "stg_product_hierarchy"]
_SIZES = " union all ".join(f"select '{m}' m, count(*) n from {m}" for m in _MODELS)


def _thresholds() -> str:
    """The second run's counts against a limit table keyed by domain and policy ('*': any domain)."""
    from .oracle import FOCUSED
    by_policy = FOCUSED["dq_findings_by_policy"][0]
    early = by_policy
    for report in ("dq_orphan_records", "dq_date_violations", "dq_value_violations"):
        early = early.replace(f"from {report}", f"from (select * from {report} where substr(md5(coalesce(record_id, '')), 1, 1) < '8') x")
    return f"""
, sizes as ({_SIZES}), late as ({by_policy}), early as ({early}),
domains(d, m) as (values ('sales', 'fct_sales_orders'), ('sales', 'fct_retail_pos'), ('supply', 'fct_inventory_snapshots'),
  ('supply', 'fct_purchase_orders'), ('logistics', 'fct_shipments'), ('logistics', 'stg_shipment_events'),
  ('marketing', 'fct_marketing_performance'), ('marketing', 'stg_marketing_campaigns'), ('product', 'stg_product_hierarchy')),
limits(d, p, x) as (values ('*', 'quarantine', 0.02::double), ('*', 'preserve_and_flag', 0.05), ('*', 'coerce_and_flag', 0.05),
  ('*', 'flag_dont_resolve', 0.0), ('supply', 'preserve_and_flag', 0.25), ('logistics', 'quarantine', 0.05)),
shares as (
  select l.*, s.n, d.d, {rnd('(l.n_findings / s.n)', 6)} share, {rnd('(e.n_findings / s.n)', 6)} before
  from late l join sizes s on s.m = l.source_model join domains d on d.m = l.source_model
  left join early e using (policy, source_model, issue_type)),
limited as (select s.*, coalesce(o.x, a.x) x from shares s left join limits o on o.d = s.d and o.p = s.policy
            left join limits a on a.d = '*' and a.p = s.policy)
select '2024-01-02' as run, d as domain, policy, source_model, issue_type, n_findings, n as n_rows, share, x as "limit",
       before as previous_share, (share > x)::int as is_over_limit, coalesce(share > before * 1.5, false)::int as is_growing
from limited"""


LATEST = best(["shipment_id", "event_type"], ["event_timestamp desc nulls last"],
              "shipment_id event_timestamp event_timestamp_raw event_type event_location event_status".split(),
              "stg_shipment_events", "shipment_id, event_timestamp, event_timestamp_raw, event_type, event_location, event_status")

_FACT = ["fct_sales_orders"]
_STOCK = ["fct_inventory_snapshots", "fct_shipments"]
SQL = {
    "asof_order_skus": (ASOF, ["sales_orders_raw"]),
    "currency_sales_totals": (TOTALS, _FACT),
    "currency_product_revenue": (REVENUE, _FACT),
    "currency_division_revenue": (DIVISIONS, [*_FACT, "dim_product"]),
    "product_history": (HISTORY, ["dim_product"]),
    "warehouse_daily_position": (POSITION, _STOCK),
    "inventory_reconciliation": (RECONCILED, [*_STOCK, "fct_purchase_orders"]),
    "shipment_event_order": (EVENT_ORDER, ["stg_shipment_events"]),
    "surrogate_product_keys": (SURROGATES, ["dim_product"]),
    "distinct_retailers_by_year": (RETAILERS, ["fct_retail_pos"]),
    "finding_thresholds": (_thresholds(), [*_MODELS, "dq_orphan_records", "dq_date_violations", "dq_value_violations"]),
    "streamed_latest_events": (LATEST, ["stg_shipment_events"]),
}


def dated_sql(name: str) -> str:
    if name.startswith("incremental_fct_"):
        return model_sql(name.removeprefix("incremental_"))
    sql, needs = SQL[name]
    return with_chain(sql.strip("\n"), needs)
