"""Expected results as SQL over the supplied tables.

`VIEWS` holds named steps, each a SELECT over tables or other steps. A statement is
its final SELECT with the steps it uses, in order of definition, as a WITH clause.
Money is summed as decimal and cast to double last, as in the jobs. `desc` orderings
say where nulls go, since engines differ.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}
QUERIES: dict[str, str] = {}

# --- sources ------------------------------------------------------------------------

VIEWS["raw_customers"] = """
select c_custkey as customer_id, n_name as city, r_name as state, c_mktsegment as segment,
  cast(timestamp '2000-01-01 00:00:00' + interval '1' day * cast(c_custkey % 700 as int) as date) as registration_date
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""

VIEWS["raw_products"] = """
select p_partkey as product_id, p_type as category, p_brand as brand,
  p_retailprice - 300 - (p_partkey % 97) as cost,
  case when p_partkey % 211 = 5 then cast(0 as double) else p_retailprice end as selling_price,
  'S' || cast(p_partkey % 40 as string) as supplier_id
from part"""

VIEWS["raw_orders"] = """
select 'O' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as order_id,
  case when l_orderkey % 97 = 3 then null when l_orderkey % 89 = 4 then cast(-1 as bigint) else o_custkey end as customer_id,
  l_partkey as product_id, 'WH0' || cast(l_suppkey % 6 + 1 as string) as warehouse_id,
  case when l_partkey % 83 = 6 then 'not-a-date' else substr(cast(l_shipdate as string), 1, 10) || ' 00:00:00' end as "timestamp",
  cast(l_quantity as int) as quantity,
  case when l_orderkey % 79 = 7 then -l_extendedprice else l_extendedprice end as amount,
  case when o_orderstatus = 'F' then 'completed' when o_orderstatus = 'O' then 'pending'
       when l_returnflag = 'R' then 'returned' else 'cancelled' end as status
from lineitem join orders on l_orderkey = o_orderkey"""

VIEWS["raw_inventory"] = """
select 'WH0' || cast(l_suppkey % 6 + 1 as string) as warehouse_id, l_partkey as product_id,
  cast(l_quantity as int) * 3 - 6 as available_qty, l_linenumber * 5 as reserved_qty,
  cast(20 + l_partkey % 81 as int) as reorder_level, l_shipdate as updated_at
from lineitem"""

VIEWS["raw_delivery"] = """
select order_id, partner, pickup_time, expected_delivery,
  expected_delivery + interval '1' hour * cast(k as int) as actual_delivery, status
from (
  select 'O' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as order_id,
    'partner_' || cast(l_suppkey % 5 as string) as partner,
    l_shipdate + interval '1' hour * cast(l_orderkey % 24 as int) as pickup_time,
    l_shipdate + interval '1' hour * cast(l_orderkey % 24 + 24 * (1 + l_partkey % 5) as int) as expected_delivery,
    (l_orderkey * 7 + l_partkey) % 60 - 48 as k,
    case when l_orderkey % 14 = 0 then 'in_transit' else 'delivered' end as status
  from lineitem where l_orderkey % 10 <> 0) d"""

VIEWS["raw_support"] = """
select 'T' || cast(event_id as string) as ticket_id, user_id as customer_id, event_id % 6 as issue_type,
  event_id % 4 as priority, ts as created_at,
  case when event_id % 7 = 0 then null else ts + interval '1' hour * cast(1 + event_id % 120 as int) end as resolved_at
from events where event_type = 'error'"""

VIEWS["raw_marketing"] = """
select 'CMP_' || channel || '_' || cast(year(d) * 100 + month(d) as string) as campaign_id, d as "date", channel,
  cast(sum(case when event_type = 'click' then cast(value as decimal(18,2)) else 0 end) as double) as spend,
  cast(sum(case when event_id % 5 <> 0 then 1 else 0 end) as int) as impressions,
  cast(sum(case when event_type = 'click' and event_id % 5 = 1 then 1 else 0 end) as int) as clicks,
  cast(sum(case when event_type = 'purchase' and event_id % 5 = 2 then 1 else 0 end) as int) as conversions
from (select cast(ts as date) as d, 'ch_' || cast(user_id % 6 as string) as channel, event_id, event_type, value from events) e
group by d, channel"""

VIEWS["raw_events"] = """
select event_id,
  case event_type when 'purchase' then 'order_created' when 'click' then 'payment_processed'
    when 'view' then 'delivery_update' when 'signup' then 'inventory_adjustment' else 'unknown' end as event_type,
  'EV' || cast(event_id as string) as order_id, user_id as customer_id, event_id % 200 as product_id,
  'WH0' || cast(user_id % 6 + 1 as string) as warehouse_id, cast(1 + event_id % 4 as int) as quantity, value as amount,
  case when event_id % 17 = 0 then 'cancelled' else 'completed' end as status,
  case when event_id % 12 = 0 then 'failed' else 'success' end as result,
  'partner_' || cast(event_id % 5 as string) as partner, event_id % 8 = 0 as sla_breach,
  cast(event_id % 21 - 15 as int) as delta_qty, ts as event_ts
from events"""

COLUMNS = {
    "customers": ["customer_id", "city", "state", "segment", "registration_date"],
    "products": ["product_id", "category", "brand", "cost", "selling_price", "supplier_id"],
    "orders": [
        "order_id", "customer_id", "product_id", "warehouse_id", '"timestamp"', "quantity", "amount", "status",
    ],
    "inventory": ["warehouse_id", "product_id", "available_qty", "reserved_qty", "reorder_level", "updated_at"],
    "delivery": ["order_id", "partner", "pickup_time", "expected_delivery", "actual_delivery", "status"],
    "support": ["ticket_id", "customer_id", "issue_type", "priority", "created_at", "resolved_at"],
    "marketing": ["campaign_id", '"date"', "channel", "spend", "impressions", "clicks", "conversions"],
}


def latest(name: str, keys: list[str], by: str, where: str = "true") -> str:
    """Rows of a raw source that rank first per key by `by`, ties settled by the other columns ascending."""
    rest = [c for c in COLUMNS[name] if c not in keys and c != by]
    order = ", ".join([f"{by} desc nulls last", *[f"{c} asc nulls last" for c in rest]])
    return (
        f"select * from raw_{name} where {where} "
        f"qualify row_number() over (partition by {', '.join(keys)} order by {order}) = 1"
    )


# --- silver -------------------------------------------------------------------------

VIEWS["silver_customers"] = latest("customers", ["customer_id"], "registration_date", "customer_id is not null")
VIEWS["kept_products"] = latest("products", ["product_id"], "selling_price", "product_id is not null")
VIEWS["silver_products"] = "select * from kept_products where selling_price > 0"
VIEWS["complete_orders"] = """
select * from raw_orders
where order_id is not null and customer_id is not null and product_id is not null and amount is not null"""
VIEWS["kept_orders"] = latest(
    "orders", ["order_id"], 'try_cast("timestamp" as timestamp) desc nulls last, "timestamp"',
    "order_id is not null and customer_id is not null and product_id is not null and amount is not null",
)
VIEWS["checked_orders"] = """
select order_id, customer_id, product_id, warehouse_id, try_cast("timestamp" as timestamp) as "timestamp",
  quantity, amount, status,
  case when customer_id not in (select customer_id from silver_customers)
         or product_id not in (select product_id from silver_products)
       then 'referential_integrity_customer_or_product'
       when amount < 0 then 'negative_amount'
       when try_cast("timestamp" as timestamp) is null then 'invalid_timestamp' end as reject_reason
from kept_orders"""
VIEWS["silver_orders"] = "select * exclude (reject_reason) from checked_orders where reject_reason is null"
VIEWS["kept_inventory"] = latest(
    "inventory", ["warehouse_id", "product_id"], "updated_at", "warehouse_id is not null and product_id is not null"
)
VIEWS["silver_inventory"] = """
select * from kept_inventory where not coalesce(available_qty < 0, false) and not coalesce(reserved_qty < 0, false)"""
VIEWS["silver_delivery"] = latest("delivery", ["order_id"], "actual_delivery", "order_id is not null")
VIEWS["silver_support"] = latest("support", ["ticket_id"], "created_at", "ticket_id is not null")
VIEWS["silver_marketing"] = latest(
    "marketing", ["campaign_id", '"date"', "channel"], "spend", 'campaign_id is not null and "date" is not null'
)

for _name in COLUMNS:
    QUERIES[f"silver_{_name}"] = f"select * from silver_{_name}"


def _dropped(name: str) -> str:
    return f"(select count(*) from raw_{name}) - (select count(*) from silver_{name})"


_DQ = {
    ("silver_customers", "null_or_dup_customer_id"): _dropped("customers"),
    ("silver_products", "non_positive_selling_price"): "(select count(*) from kept_products where selling_price <= 0)",
    ("silver_products", "null_or_dup_product_id"):
        _dropped("products") + " - (select count(*) from kept_products where selling_price <= 0)",
    ("silver_orders", "duplicate_order_id"):
        "(select count(*) from complete_orders) - (select count(*) from kept_orders)",
    **{
        ("silver_orders", rule): f"(select count(*) from checked_orders where reject_reason = '{rule}')"
        for rule in ("referential_integrity_customer_or_product", "negative_amount", "invalid_timestamp")
    },
    ("silver_orders", "rows_dropped_total"): _dropped("orders"),
    ("silver_inventory", "negative_quantity"):
        "(select count(*) from kept_inventory where available_qty < 0 or reserved_qty < 0)",
    **{
        (f"silver_{name}", "rows_dropped_total"): _dropped(name)
        for name in ("inventory", "delivery", "support", "marketing")
    },
}
QUERIES["dq_report"] = " union all ".join(
    f"select '{table}' as table_name, '{rule}' as rule, {count} as failed_rows" for (table, rule), count in _DQ.items()
)
QUERIES["quality_checks"] = QUERIES["dq_report"]
QUERIES["rejected_orders"] = "select * from checked_orders where reject_reason is not null"
QUERIES["duplicate_orders"] = "select order_id, count(*) as copies from raw_orders group by order_id having count(*) > 1"
QUERIES["orphan_customers_in_orders"] = """
select o.customer_id, count(*) as copies from raw_orders o left join silver_customers c on o.customer_id = c.customer_id
where o.customer_id is not null and c.customer_id is null group by o.customer_id"""

# --- staging ------------------------------------------------------------------------

VIEWS["kept_stg_orders"] = latest("orders", ["order_id"], '"timestamp"', "order_id is not null")
VIEWS["stg_orders"] = """
select order_id, customer_id, product_id, warehouse_id, try_cast("timestamp" as timestamp) as order_ts,
  quantity, amount, status from kept_stg_orders where amount >= 0"""
VIEWS["stg_customers"] = "select * from silver_customers"
VIEWS["stg_products"] = "select * from kept_products where selling_price > 0"
VIEWS["kept_stg_inventory"] = latest("inventory", ["warehouse_id", "product_id"], "updated_at")
VIEWS["stg_inventory"] = "select * from kept_stg_inventory where available_qty >= 0 and reserved_qty >= 0"
VIEWS["stg_delivery"] = "select * from silver_delivery"
VIEWS["stg_support"] = "select * from silver_support"
VIEWS["kept_stg_marketing"] = latest("marketing", ["campaign_id", '"date"', "channel"], "spend")
VIEWS["stg_marketing"] = """
select campaign_id, "date" as campaign_date, channel, spend, impressions, clicks, conversions from kept_stg_marketing"""

for _name in COLUMNS:
    QUERIES[f"stg_{_name}"] = f"select * from stg_{_name}"

# --- sources as files ------------------------------------------------------------------

QUERIES["csv_quarantine"] = """
select 'orders' as source, order_id as key, 'timestamp' as column_name, 'timestamp_ntz' as declared_type, "timestamp" as value, true as placed
from raw_orders where "timestamp" = 'not-a-date'
union all select 'orders', order_id, 'amount', 'double', '12.5x', true from raw_orders where product_id % 101 = 9"""
QUERIES["stg_orders_from_csv"] = """
select order_id, cast(customer_id as varchar) as customer_id, cast(product_id as varchar) as product_id, warehouse_id,
  cast("timestamp" as timestamp) as order_ts, quantity, amount, status
from (select * from raw_orders where order_id is not null and "timestamp" <> 'not-a-date'
  qualify row_number() over (partition by order_id order by "timestamp" desc, cast(customer_id as varchar) nulls last,
    cast(product_id as varchar), warehouse_id, cast(quantity as varchar), cast(amount as varchar), status) = 1) o
where amount >= 0"""
QUERIES["silver_orders_by_arrival"] = """
select * replace (cast(customer_id as varchar) as customer_id, cast(product_id as varchar) as product_id) from silver_orders"""
QUERIES["silver_inventory_by_arrival"] = """
select * from (select warehouse_id, cast(product_id as varchar) as product_id, max(available_qty) as available_qty,
    min(reserved_qty) as reserved_qty, max(reorder_level) as reorder_level, '1990-01-01 00:00:00' as updated_at
  from raw_inventory group by warehouse_id, product_id) i where available_qty >= 0 and reserved_qty >= 0"""

# --- star schema --------------------------------------------------------------------


def date_key(column: str) -> str:
    return f"cast(year({column}) * 10000 + month({column}) * 100 + day({column}) as int)"


def calendar(source: str, column: str) -> str:
    return f"""
select {date_key("d")} as date_key, d as full_date, cast(year(d) as int) as year, cast(quarter(d) as int) as quarter,
  cast(month(d) as int) as month, monthname(d) as month_name, cast(day(d) as int) as day, dayname(d) as day_of_week,
  isodow(d) >= 6 as is_weekend
from (select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as d
      from (select cast(min({column}) as date) as lo, cast(max({column}) as date) as hi from {source}) b) s"""


VIEWS["dim_customer"] = "select customer_id as customer_key, city, state, segment, registration_date from silver_customers"
VIEWS["dim_product"] = """
select product_id as product_key, category, brand, cost, selling_price, supplier_id,
  round_even(((selling_price - cost) / nullif(selling_price, 0)) * 1e4, 0) / 1e4 as margin_pct from silver_products"""
VIEWS["dim_warehouse"] = "select distinct warehouse_id as warehouse_key from silver_inventory"
VIEWS["dim_date"] = calendar("silver_orders", '"timestamp"')
VIEWS["fixed_calendar"] = calendar("(select unnest([date '1995-01-01', date '1996-12-31']) as d) f", "d")
VIEWS["fact_orders"] = f"""
select order_id as order_key, customer_id as customer_key, o.product_id as product_key, warehouse_id as warehouse_key,
  {date_key('"timestamp"')} as date_key, "timestamp", quantity, amount,
  coalesce(cost, 0) * quantity as cost_total, round_even((amount - coalesce(cost, 0) * quantity) * 1e2, 0) / 1e2 as margin_amount, status
from silver_orders o left join silver_products p on o.product_id = p.product_id"""


def fact_inventory(source: str) -> str:
    return f"""
select warehouse_id as warehouse_key, product_id as product_key, available_qty, reserved_qty, reorder_level, updated_at,
  available_qty - reserved_qty as stock_position,
  coalesce(available_qty - reserved_qty < reorder_level, false) as below_reorder_level, {date_key("updated_at")} as date_key
from {source}"""


def fact_delivery(delivery: str, orders: str, hours: str) -> str:
    return f"""
select d.order_id as order_key, o.warehouse_id as warehouse_key, partner, {date_key("pickup_time")} as date_key,
  pickup_time, expected_delivery, actual_delivery, {hours} as delivery_hours,
  coalesce(actual_delivery > expected_delivery, false) as sla_breached, d.status
from {delivery} d left join {orders} o on d.order_id = o.order_id"""


VIEWS["fact_inventory"] = fact_inventory("silver_inventory")
VIEWS["fact_delivery"] = fact_delivery(
    "silver_delivery",
    "silver_orders",
    "round_even(cast(date_diff('microsecond', pickup_time, actual_delivery) as double) / 3600000000 * 1e2, 0) / 1e2",
)
VIEWS["fact_marketing"] = f"""
select campaign_id, {date_key('"date"')} as date_key, channel, spend, impressions, clicks, conversions,
  round_even((cast(clicks as double) / nullif(impressions, 0)) * 1e4, 0) / 1e4 as ctr,
  round_even((cast(conversions as double) / nullif(clicks, 0)) * 1e4, 0) / 1e4 as conversion_rate,
  round_even((spend / nullif(conversions, 0)) * 1e2, 0) / 1e2 as cac
from silver_marketing"""

GOLD = [
    "dim_customer", "dim_product", "dim_warehouse", "dim_date",
    "fact_orders", "fact_inventory", "fact_delivery", "fact_marketing",
]
for _name in GOLD:
    QUERIES[_name] = f"select * from {_name}"

QUERIES["orders_on_calendar"] = """
select c.*, coalesce(orders, 0) as orders
from fixed_calendar c left join (select date_key, count(*) as orders from fact_orders group by 1) o using (date_key)"""
VIEWS["orders_enriched"] = """
select o.*, p.category, p.brand, p.cost as unit_cost, p.cost * o.quantity as cost_total,
  o.amount - p.cost * o.quantity as margin_amount, c.segment as customer_segment, c.city as customer_city
from stg_orders o left join stg_products p on o.product_id = p.product_id
left join stg_customers c on o.customer_id = c.customer_id"""
QUERIES["dim_customer_staged"] = (
    "select customer_id as customer_key, city, state, segment, registration_date from stg_customers"
)
QUERIES["dim_product_staged"] = """
select product_id as product_key, category, brand, cost, selling_price, supplier_id,
  round((selling_price - cost) / nullif(selling_price, 0), 4) as margin_pct from stg_products"""
QUERIES["dim_warehouse_staged"] = "select distinct warehouse_id as warehouse_key from stg_inventory"
QUERIES["dim_date_staged"] = calendar("stg_orders", "order_ts")
QUERIES["orders_enriched"] = "select * from orders_enriched"
QUERIES["fact_orders_staged"] = f"""
select order_id as order_key, customer_id as customer_key, product_id as product_key, warehouse_id as warehouse_key,
  {date_key("order_ts")} as date_key, order_ts, quantity, amount, cost_total, margin_amount, status from orders_enriched"""
QUERIES["fact_inventory_staged"] = fact_inventory("stg_inventory")
QUERIES["fact_delivery_boundary_hours"] = fact_delivery(
    "stg_delivery", "stg_orders", "date_diff('hour', pickup_time, actual_delivery)"
)
QUERIES["fact_marketing_zero_default"] = f"""
select campaign_id, {date_key("campaign_date")} as date_key, channel, spend, impressions, clicks, conversions,
  case when impressions > 0 then round(cast(clicks as double) / impressions, 4) else 0 end as ctr,
  case when clicks > 0 then round(cast(conversions as double) / clicks, 4) else 0 end as conversion_rate,
  case when conversions > 0 then round(spend / conversions, 2) end as cac
from stg_marketing"""

# --- expectations -------------------------------------------------------------------

_CHECKS = [
    *[("unique", t, c) for t, c in [
        ("dim_customer", "customer_key"), ("dim_product", "product_key"), ("dim_warehouse", "warehouse_key"),
        ("dim_date", "date_key"), ("fact_orders", "order_key"), ("fact_delivery", "order_key")]],
    *[("not_null", t, c) for t, c in [
        ("dim_customer", "customer_key"), ("dim_product", "product_key"), ("dim_warehouse", "warehouse_key"),
        ("dim_date", "date_key"), ("fact_orders", "order_key"), ("fact_orders", "customer_key"),
        ("fact_orders", "product_key"), ("fact_orders", "amount"), ("fact_inventory", "warehouse_key"),
        ("fact_inventory", "product_key"), ("fact_delivery", "order_key"), ("fact_marketing", "campaign_id")]],
    ("relationships", "fact_orders", "customer_key"),
    ("relationships", "fact_orders", "product_key"),
]
_FAILURES = {
    "unique": "(select count(*) from (select {c} from {t} where {c} is not null group by {c} having count(*) > 1) u)",
    "not_null": "(select count(*) from {t} where {c} is null)",
    "relationships": "(select count(*) from {t} f left join {p} d on f.{c} = d.{c} where f.{c} is not null and d.{c} is null)",
}
QUERIES["expectation_report"] = " union all ".join(
    f"select '{t}' as table_name, '{c}' as column_name, '{k}' as check_name, "
    + _FAILURES[k].format(t=t, c=c, p="dim_" + c.removesuffix("_key"))
    + " as failures"
    for k, t, c in _CHECKS
)

# --- KPIs ---------------------------------------------------------------------------

MONEY = "cast({} as decimal(18,2))"


def total(column: str) -> str:
    return f"cast(sum({MONEY.format(column)}) as double)"


VIEWS["completed"] = "select * from fact_orders where status = 'completed'"
VIEWS["monthly"] = f"""
select cast(date_trunc('month', "timestamp") as date) as month, {total("amount")} as revenue, count(*) as orders,
  cast(sum(quantity) as bigint) as units, {total("margin_amount")} as margin from completed group by 1"""
VIEWS["growth"] = """
select month, revenue, orders, units, (revenue - before) / nullif(before, 0) * 100 as growth_pct
from (select *, lag(revenue) over (order by month) as before from monthly) m"""
QUERIES["kpi_monthly_growth"] = "select * from growth"

VIEWS["sales_totals"] = f"""
select coalesce({total("amount")}, 0) as revenue, cast(count(*) as double) as orders,
  coalesce(cast(sum(quantity) as double), 0) as units, coalesce({total("margin_amount")}, 0) as margin from completed"""
VIEWS["customer_orders"] = "select customer_key, count(*) as orders from completed group by customer_key"
VIEWS["stock_by_product"] = """
select product_key, sum(stock_position) as stock, count(stock_position) as known from fact_inventory group by product_key"""
VIEWS["units_by_product"] = "select product_key, sum(quantity) as units from completed group by product_key"
VIEWS["turnover"] = """
select cast(coalesce(sum(r), 0) as double) / nullif(cast(count(r) as double), 0) as t from (
  select cast(cast(units as double) / nullif(cast(stock as double) / nullif(known, 0), 0) as decimal(28,10)) as r
  from stock_by_product join units_by_product using (product_key)) x"""
VIEWS["deliveries"] = f"""
select count(*) as n, count(*) filter (where sla_breached) as late,
  {total("delivery_hours")} / nullif(count(delivery_hours), 0) as hours from fact_delivery"""
VIEWS["campaigns"] = f"""
select {total("spend")} as spend, cast(sum(impressions) as double) as impressions, cast(sum(clicks) as double) as clicks,
  cast(sum(conversions) as double) as conversions from fact_marketing"""


def kpi(domain: str, metric: str, value: str, source: str, dims: str = "''") -> str:
    return (
        f"select '{domain}' as domain, '{metric}' as metric, cast({value} as double) as value, {dims} as dims from {source}"
    )


_KPIS = {
    "sales": [
        kpi("sales", "total_revenue", "revenue", "sales_totals"),
        kpi("sales", "total_orders", "orders", "sales_totals"),
        kpi("sales", "average_order_value", "coalesce(revenue / nullif(orders, 0), 0)", "sales_totals"),
        kpi("sales", "total_units_sold", "units", "sales_totals"),
        kpi("sales", "total_margin", "margin", "sales_totals"),
        kpi("sales", "margin_pct", "coalesce(margin / nullif(revenue, 0) * 100, 0)", "sales_totals"),
        kpi("sales", "mom_revenue_growth_pct", "growth_pct", "growth where month = (select max(month) from growth)"),
    ],
    "customers": [
        kpi("customers", "total_customers", "count(*)", "dim_customer"),
        kpi(
            "customers", "new_customers_last_30d", "count(*)",
            "dim_customer where registration_date >= (select max(registration_date) from dim_customer) - 30",
        ),
        kpi(
            "customers", "repeat_customer_rate_pct",
            "cast(count(*) filter (where orders >= 2) as double) / count(*) * 100", "customer_orders",
        ),
        kpi(
            "customers", "orders_by_segment", "count(*)",
            "completed join dim_customer using (customer_key) where segment is not null group by segment",
            "'segment=' || segment",
        ),
    ],
    "inventory": [
        kpi("inventory", "stockout_risk_item_count", "count(*) filter (where stock_position <= 0)", "fact_inventory"),
        kpi("inventory", "items_below_reorder_level", "count(*) filter (where below_reorder_level)", "fact_inventory"),
        kpi("inventory", "avg_stock_position", "cast(sum(stock_position) as double) / count(stock_position)", "fact_inventory"),
        kpi("inventory", "inventory_turnover_ratio", "coalesce(t, 0)", "turnover"),
        kpi("inventory", "days_of_inventory", "365.0 / nullif(t, 0)", "turnover"),
    ],
    "delivery": [
        kpi("delivery", "on_time_delivery_pct", "coalesce(cast(n - late as double) / nullif(n, 0) * 100, 0)", "deliveries"),
        kpi("delivery", "sla_breach_pct", "100 - coalesce(cast(n - late as double) / nullif(n, 0) * 100, 0)", "deliveries"),
        kpi("delivery", "avg_delivery_hours", "hours", "deliveries"),
        kpi(
            "delivery", "partner_sla_breach_pct",
            "cast(count(*) filter (where sla_breached) as double) / count(*) * 100",
            "fact_delivery where partner is not null group by partner", "'partner=' || partner",
        ),
    ],
    "marketing": [
        kpi("marketing", "total_spend", "coalesce(spend, 0)", "campaigns"),
        kpi("marketing", "ctr_pct", "coalesce(clicks / nullif(impressions, 0) * 100, 0)", "campaigns"),
        kpi("marketing", "conversion_rate_pct", "coalesce(conversions / nullif(clicks, 0) * 100, 0)", "campaigns"),
        kpi("marketing", "cac", "spend / nullif(conversions, 0)", "campaigns"),
        kpi(
            "marketing", "estimated_roas",
            "conversions * (select coalesce(revenue / nullif(orders, 0), 0) from sales_totals) / nullif(spend, 0)", "campaigns",
        ),
        kpi(
            "marketing", "channel_cac", f"{total('spend')} / nullif(cast(sum(conversions) as double), 0)",
            "fact_marketing where channel is not null group by channel", "'channel=' || channel",
        ),
    ],
}
for _domain, _parts in _KPIS.items():
    VIEWS[f"kpi_{_domain}"] = " union all ".join(_parts)
    QUERIES[f"kpi_{_domain}"] = f"select * from kpi_{_domain}"
VIEWS["kpi_snapshot"] = " union all ".join(f"select * from kpi_{d}" for d in _KPIS)
QUERIES["kpi_snapshot"] = "select * from kpi_snapshot"
QUERIES["kpis_of_domain"] = "select * from kpi_sales"
QUERIES["executive_summary"] = "select " + ", ".join(
    f"max(value) filter (where metric = '{m}') as {m}"
    for m in (
        "total_revenue", "total_orders", "average_order_value", "on_time_delivery_pct",
        "stockout_risk_item_count", "estimated_roas", "total_customers", "repeat_customer_rate_pct",
    )
) + " from kpi_snapshot"

# --- dashboard ----------------------------------------------------------------------

QUERIES["revenue_daily"] = f"""
select * from (select cast("timestamp" as date) as day, {total("amount")} as revenue, count(*) as orders
  from completed group by 1 order by 1 desc limit 90) d order by day"""
QUERIES["revenue_by_category"] = f"""
select category, {total("amount")} as revenue, cast(sum(quantity) as bigint) as units, count(*) as orders
from completed join dim_product using (product_key) group by category"""
QUERIES["revenue_by_warehouse"] = f"""
select warehouse_key as warehouse, {total("amount")} as revenue, count(*) as orders from completed group by 1"""
QUERIES["recent_orders"] = 'select * from fact_orders order by "timestamp" desc nulls last, order_key limit 50'
QUERIES["recent_completed_orders"] = 'select * from completed order by "timestamp" desc nulls last, order_key limit 50'
QUERIES["inventory_status"] = """
select * from fact_inventory
order by below_reorder_level desc, stock_position asc nulls first, warehouse_key, product_key limit 200"""
QUERIES["at_risk_items"] = "select * from fact_inventory where below_reorder_level"
QUERIES["inventory_by_warehouse"] = """
select warehouse_key, count(*) as sku_count, count(*) filter (where below_reorder_level) as skus_below_reorder,
  cast(sum(stock_position) as double) / count(stock_position) as avg_stock_position
from fact_inventory group by warehouse_key"""
QUERIES["customer_list"] = "select * from dim_customer order by customer_key limit 50"
QUERIES["customers_by_segment"] = f"""
select segment, count(distinct customer_key) as customers, {total("amount")} as revenue, count(*) as orders
from completed join dim_customer using (customer_key) group by segment"""
QUERIES["top_cities"] = f"""
select city, count(distinct customer_key) as customers, {total("amount")} as revenue
from completed join dim_customer using (customer_key) group by city order by revenue desc, city limit 15"""
QUERIES["partner_performance"] = f"""
select partner, count(*) as deliveries, {total("delivery_hours")} / count(delivery_hours) as avg_delivery_hours,
  100.0::double * count(*) filter (where sla_breached) / count(*) as sla_breach_pct
from fact_delivery group by partner"""
QUERIES["sla_trend"] = """
select cast(pickup_time as date) as day, 100.0::double * count(*) filter (where sla_breached) / count(*) as sla_breach_pct,
  count(*) as deliveries from fact_delivery group by 1"""
QUERIES["sla_records"] = """
select '{"day":"' || cast(cast(pickup_time as date) as varchar) || '","sla_breach_pct":' || coalesce(cast(nullif(
    100.0::double * count(*) filter (where sla_breached) / count(*), 0) as varchar), 'null') || ',"deliveries":' || count(*) || '}' as record
from fact_delivery group by cast(pickup_time as date)"""
QUERIES["recent_deliveries"] = "select * from fact_delivery order by pickup_time desc nulls last, order_key limit 50"
QUERIES["marketing_by_channel"] = f"""
select channel, {total("spend")} as spend, cast(sum(impressions) as bigint) as impressions,
  cast(sum(clicks) as bigint) as clicks, cast(sum(conversions) as bigint) as conversions,
  100.0::double * sum(clicks) / nullif(sum(impressions), 0) as ctr_pct,
  100.0::double * sum(conversions) / nullif(sum(clicks), 0) as conversion_rate_pct,
  {total("spend")} / nullif(sum(conversions), 0) as cac
from fact_marketing group by channel"""
QUERIES["marketing_daily"] = f"""
select date_key, {total("spend")} as spend, cast(sum(clicks) as bigint) as clicks,
  cast(sum(conversions) as bigint) as conversions from fact_marketing group by date_key order by date_key desc limit 90"""

# --- time series --------------------------------------------------------------------


def panel(by: str = "") -> str:
    lead = f"{by}, " if by else ""
    using = f"({lead}day)"
    return f"""
select {lead}day, revenue, orders, coalesce(rate, 0) as sla_breach_rate, revenue / orders as aov
from (select {lead}cast("timestamp" as date) as day, {total("amount")} as revenue, count(*) as orders
      from completed group by {lead}cast("timestamp" as date)) r
left join (select {lead}cast(pickup_time as date) as day,
             cast(count(*) filter (where sla_breached) as double) / count(*) as rate
           from fact_delivery group by {lead}cast(pickup_time as date)) s using {using}"""


VIEWS["daily_panel"] = panel()
QUERIES["daily_panel"] = "select * from daily_panel"
QUERIES["daily_panel_by_warehouse"] = panel("warehouse_key")


def zscore(threshold: float, frame: str = "rows between 6 preceding and current row") -> str:
    """Sample deviation from exact sums: (n * sum of squares - square of sum) / (n * (n - 1))."""
    m = "cast(revenue as decimal(38,2))"
    return f"""
select day, revenue, orders, sla_breach_rate, aov, z as revenue_zscore, coalesce(abs(z) > {threshold}, false) as is_anomaly_statistical
from (select *, case when n >= 3 then (revenue - s / n) / sqrt(nullif(v, 0)) end as z
  from (select *, cast(n * q - cast(s2 * s2 as decimal(38,4)) as double) / nullif(n * (n - 1), 0) as v
    from (select *, cast(s2 as double) as s
      from (select *, count(revenue) over w as n, cast(sum({m}) over w as decimal(38,2)) as s2,
              sum(cast({m} * {m} as decimal(38,4))) over w as q
            from daily_panel window w as (order by day {frame})) a) b) c) d"""


QUERIES["zscore_report"] = zscore(2.5)
QUERIES["zscore_sensitive"] = zscore(1.8)
QUERIES["zscore_prior_days"] = zscore(2.5, "rows between 7 preceding and 1 preceding")

_DRIVER_COLUMNS = [
    ("revenue", "revenue"), ("orders", "order volume"), ("aov", "average order value"), ("sla_breach_rate", "SLA breach rate"),
]
VIEWS["baseline"] = f"""
select *, cast(sum({MONEY.format("revenue")}) over w as double) / nullif(count(revenue) over w, 0) as b_revenue,
  avg(orders) over w as b_orders, avg(aov) over w as b_aov, avg(sla_breach_rate) over w as b_sla_breach_rate,
  count(*) over w as history
from daily_panel window w as (order by day rows between 7 preceding and 1 preceding)"""
VIEWS["changes"] = " union all ".join(
    f"select day, '{label}' as label, ({c} - b_{c}) / abs(nullif(b_{c}, 0)) * 100 as pct from baseline"
    for c, label in _DRIVER_COLUMNS
)
VIEWS["drivers"] = """
select day, label, pct, label || ' was ' || case when pct > 0 then 'up' else 'down' end || ' '
  || printf('%.1f', abs(pct)) || '% vs. the trailing 7-day average' as txt
from changes where abs(pct) > 15"""
VIEWS["driver_texts"] = """
select day, string_agg(txt, '; ' order by abs(pct) desc, txt desc) filter (where k <= 3) as txt, bool_or(label like '%SLA%') as sla
from (select *, row_number() over (partition by day order by abs(pct) desc, txt desc) as k from drivers) r group by day"""
VIEWS["explained"] = """
select b.day, revenue, orders, sla_breach_rate, aov, b_revenue as baseline_avg_revenue,
  case when history = 0 then 'Insufficient history to compute baseline.'
       else coalesce(txt, 'no single dimension moved sharply; likely broad-based fluctuation') end as explanation,
  case when history = 0 then ''
       when revenue < b_revenue and coalesce(sla, false) then 'Investigate delivery partner performance on this date and escalate to operations; SLA breaches likely suppressed repeat purchases/completions.'
       when revenue < b_revenue then 'Escalate to the business-anomaly alert queue and cross-check for marketing spend pauses, payment gateway issues, or inventory stockouts on the affected date.'
       else 'Positive anomaly — flag to marketing/growth to identify and replicate the driver (e.g. a successful campaign or promo).' end as recommended_action
from baseline b left join driver_texts t on b.day = t.day"""
QUERIES["anomaly_drivers"] = "select * from explained"
VIEWS["sensitive"] = zscore(1.8)
QUERIES["anomaly_explanations"] = """
select cast(place as int) as place, day, e.revenue, baseline_avg_revenue, explanation, recommended_action
from (select *, row_number() over (order by severity = 1 desc, day) as place
      from (select *, row_number() over (order by abs(revenue_zscore) desc nulls last, day) as severity
            from sensitive where is_anomaly_statistical) s) p
join explained e using (day) where place <= 3"""


def forecast(by: str = "", until: str = "true") -> str:
    """Textbook form: deviations from weekday means give the slope, weekday means the levels."""
    lead, on = (f"{by}, ", f"partition by {by} ") if by else ("", "")
    group = f"group by {by}" if by else "group by all"
    same = f" and l.{by} = f.{by}" if by else ""
    same_model = f" and l.{by} = m.{by}" if by else ""
    return f"""
with series as (
  select {lead}day, revenue, cast(row_number() over ({on}order by day) - 1 as double) as t, isodow(day) - 1 as dow
  from (select {lead}cast("timestamp" as date) as day, {total("amount")} as revenue from completed
        group by {lead}cast("timestamp" as date)) d where {until}),
centred as (
  select *, avg(t) over (partition by {lead}dow) as tm, avg(revenue) over (partition by {lead}dow) as ym from series),
slope as (
  select {lead}sum((t - tm) * (revenue - ym)) / sum((t - tm) * (t - tm)) as b, count(*) as n, max(t) as last_t, max(day) as last_day
  from centred {group}),
level as (
  select c.{by or "dow"}, c.dow, any_value(ym) - any_value(b) * any_value(tm) as a
  from centred c join slope s on {f"c.{by} = s.{by}" if by else "true"} group by c.{by or "dow"}, c.dow),
spread as (
  select {f"c.{by}, " if by else ""}sqrt(avg(power(revenue - ym - b * (t - tm), 2))) as sigma
  from centred c join slope s on {f"c.{by} = s.{by}" if by else "true"} {f"group by c.{by}" if by else ""}),
ahead as (
  select f.*, last_day + cast(h as int) as forecast_day, h from slope f, (select unnest(range(1, 8)) as h) x where n >= 14),
point as (
  select {f"f.{by}, " if by else ""}forecast_day, sigma, greatest(coalesce(
    (select a from level l where l.dow = isodow(forecast_day) - 1{same}),
    (select a from level l where true{same} order by dow limit 1)) + b * (last_t + h), 0) as p
  from ahead f join spread m on {f"f.{by} = m.{by}" if by else "true"})
select {lead}forecast_day, round(p, 2) as predicted_revenue, round(greatest(p - 1.28 * sigma, 0), 2) as lower_bound_80pct,
  round(p + 1.28 * sigma, 2) as upper_bound_80pct from point"""


VIEWS["revenue_forecast"] = forecast()
VIEWS["earlier_forecast"] = forecast(
    until='day <= (select cast(max("timestamp") as date) - 2 from completed)'
)
QUERIES["revenue_forecast"] = "select * from revenue_forecast"
QUERIES["forecast_by_warehouse"] = "select * from forecast_warehouses"
VIEWS["forecast_warehouses"] = forecast("warehouse_key")
VIEWS["forecast_products"] = forecast("product_key")
QUERIES["forecast_by_product"] = "select * from forecast_products"
QUERIES["forecast_stored"] = """
select *, timestamp '2025-03-01 06:30:00' as generated_at, 'linear_trend_plus_dow_seasonality' as model from revenue_forecast"""

# --- isolation forest ----------------------------------------------------------------

# fixed values of the forest: features, trees, rows per tree, levels, seed, prime, share of outliers
_FEATURES = ["revenue", "orders", "aov", "sla_breach_rate"]
_TREES, _SAMPLE, _LEVELS, _SEED, _PRIME, _SHARE = 200, 256, 8, 42, 2147483647, 0.08


def number(*parts: str) -> str:
    text = " || '|' || ".join(f"coalesce(cast({p} as varchar), '')" for p in (str(_SEED), *parts))
    return f"cast('0x' || substr(md5({text}), 1, 13) as bigint)"


def mean_path(n: str) -> str:
    deep = f"2.0::double * (ln({n} - 1.0::double) + 0.5772156649015329::double) - 2.0::double * ({n} - 1.0::double) / {n}"
    return f"case when {n} > 2 then {deep} when {n} = 2 then 1.0::double else 0.0::double end"


_X = ", ".join(f"cast({c} as double)" for c in _FEATURES)
VIEWS["forest_rows"] = f"select day, [{_X}] as x, {number(chr(39) + 'row' + chr(39), 'day')} % {_PRIME} as k from daily_panel"
VIEWS["forest_family"] = f"""
select tree, {number("'a'", "tree")} % ({_PRIME} - 1) + 1 as a, {number("'b'", "tree")} % {_PRIME} as b
from (select unnest(range({_TREES})) as tree) t"""
VIEWS["forest_drawn"] = f"""
select tree, x, day, (a * k + b) % {_PRIME} as draw from forest_rows cross join forest_family
where (a * k + b) % {_PRIME} < ceil(least(1.0::double, {_SAMPLE + 8 * _SAMPLE**0.5!r}::double
  / (select cast(count(*) as double) from forest_rows)) * {_PRIME})"""
VIEWS["forest_level_0"] = f"""
select tree, x, cast(1 as bigint) as node, 0 as depth, cast([] as struct(node bigint, feature integer, threshold double)[]) as path,
  ceil(log2(greatest(cast(count(*) over (partition by tree) as double), 2.0::double))) as most
from (select * from forest_drawn qualify row_number() over (partition by tree order by draw, cast(day as varchar), x) <= {_SAMPLE}) d"""
for _level in range(_LEVELS):
    _bounds = ", ".join(
        f"{f}(x[{i}]) over (partition by tree, node) as {n}{i}" for i in range(1, 5) for f, n in (("min", "lo"), ("max", "hi"))
    )
    VIEWS[f"forest_level_{_level + 1}"] = f"""
select tree, x, 2 * node + case when x[feature + 1] > cut then 1 else 0 end as node,
  depth + case when feature is null then 0 else 1 end as depth, most,
  case when feature is null then path
       else list_append(path, {{'node': node, 'feature': feature, 'threshold': cut}}) end as path
from (select *, case when lo + way * (hi - lo) >= hi then lo else lo + way * (hi - lo) end as cut
  from (select *, lows[feature + 1] as lo, highs[feature + 1] as hi,
      cast({number("'threshold'", "tree", "node")} as double) / 4503599627370496.0::double as way
    from (select *, case when n > 1 and most > {_level} and len(open) > 0
          then cast(open[1 + {number("'feature'", "tree", "node")} % greatest(len(open), 1)] as integer) end as feature
      from (select *, [lo1, lo2, lo3, lo4] as lows, [hi1, hi2, hi3, hi4] as highs,
          list_filter([0, 1, 2, 3], lambda i: [hi1, hi2, hi3, hi4][i + 1] > [lo1, lo2, lo3, lo4][i + 1]) as open
        from (select *, count(*) over (partition by tree, node) as n, {_bounds} from forest_level_{_level}) a) b) c) d) e"""
VIEWS["forest_splits"] = f"select distinct tree, s.* from (select tree, unnest(path) as s from forest_level_{_LEVELS}) p"
VIEWS["forest_leaves"] = f"""
select tree, node, cast(round_even((depth + {mean_path("n")}) * 1000000000, 0) as bigint) as length
from (select tree, node, max(depth) as depth, cast(count(*) as double) as n from forest_level_{_LEVELS} group by tree, node) l"""
VIEWS["forest_walk_0"] = f"select day, x, tree, cast(1 as bigint) as node from forest_rows, (select unnest(range({_TREES})) as tree) t"
for _level in range(_LEVELS):
    VIEWS[f"forest_walk_{_level + 1}"] = f"""
select w.day, w.x, w.tree, 2 * w.node + case when coalesce(x[s.feature + 1] > s.threshold, false) then 1 else 0 end as node
from forest_walk_{_level} w left join forest_splits s on w.tree = s.tree and w.node = s.node"""
VIEWS["forest_scores"] = f"""
select day, round_even(-pow(2.0::double, -(cast(sum(length) as double) / 1000000000.0::double / {_TREES}.0::double
  / (select {mean_path("n")} from (select cast(least(count(*), {_SAMPLE}) as double) as n from forest_rows) c))) * 1e10, 0) / 1e10 as raw
from forest_walk_{_LEVELS} join forest_leaves using (tree, node) group by day"""
VIEWS["forest_cut"] = f"""
select lo + (hi - lo) * ((n - 1) * {_SHARE}::double - floor((n - 1) * {_SHARE}::double)) as cut, n
from (select max(raw) filter (where k = floor((n - 1) * {_SHARE}::double)) as lo,
        max(raw) filter (where k = ceil((n - 1) * {_SHARE}::double)) as hi, any_value(n) as n
      from (select raw, row_number() over (order by raw) - 1 as k, count(*) over () as n from forest_scores) r) s"""
VIEWS["forest_flags"] = """
select day, case when n >= 10 then raw - cut else 0 end as iforest_score, n >= 10 and raw - cut < 0 as is_anomaly_iforest
from forest_scores cross join forest_cut"""
QUERIES["iforest_report"] = "select * from daily_panel join forest_flags using (day)"
VIEWS["detector_report"] = f"""
select z.*, iforest_score, is_anomaly_iforest, is_anomaly_statistical or is_anomaly_iforest as is_anomaly
from ({zscore(2.5)}) z join forest_flags using (day)"""
QUERIES["anomaly_timeline"] = "select * from detector_report order by day desc limit 120"
QUERIES["flagged_anomalies"] = "select * from detector_report where is_anomaly order by day desc limit 60"
# steps that others read many times over
STORED = {"daily_panel", "forest_rows", "forest_drawn", "forest_splits", "forest_leaves"} | {
    f"forest_level_{k}" for k in range(_LEVELS + 1)
}

# --- rules --------------------------------------------------------------------------

VIEWS["demand"] = """
select product_key, cast(sum(quantity) as double) / 7.0::double as rate from completed
where "timestamp" >= (select max("timestamp") from completed) - interval 7 day group by product_key"""
VIEWS["rule_stockout"] = """
select 'inventory_stockout_risk' as rule, 'HIGH' as severity, 'OPEN' as status,
  warehouse_key || ':' || cast(product_key as string) as entity,
  printf('Product %s at warehouse %s is below reorder level (%s units) with ~%.1f units/day demand (~%.1f days of cover left).',
    cast(product_key as string), warehouse_key, cast(stock_position as string), rate, stock_position / rate) as message
from fact_inventory join demand using (product_key)
where below_reorder_level and rate > 0 and stock_position / rate < 3"""
VIEWS["rule_sla"] = """
select 'delivery_sla_breach' as rule, 'HIGH' as severity, 'OPEN' as status, 'delivery_network' as entity,
  printf('Overall delivery SLA breach rate is %.1f%%, above the %.0f%% threshold. Operations team notified.', pct, 15.0::double) as message
from (select cast(count(*) filter (where sla_breached) as double) / nullif(count(*), 0) * 100 as pct from fact_delivery) x
where pct > 15"""
VIEWS["last_day"] = f"""
select cast("timestamp" as date) as day, {total("amount")} as revenue from completed
where cast("timestamp" as date) = (select cast(max("timestamp") as date) from completed) group by 1"""


def rule_revenue(source: str, threshold: str = "20") -> str:
    return f"""
select 'revenue_anomaly' as rule, 'CRITICAL' as severity, 'OPEN' as status, cast(day as string) as entity,
  printf('Revenue on %s was %s, %.1f%% below the forecast of %s.', cast(day as string),
    format('{{:,}}', cast(round_even(revenue, 0) as bigint)), (predicted_revenue - revenue) / predicted_revenue * 100,
    format('{{:,}}', cast(round_even(predicted_revenue, 0) as bigint))) as message
from last_day join {source} on day = forecast_day
where predicted_revenue > 0 and (predicted_revenue - revenue) / predicted_revenue * 100 > {threshold}"""


VIEWS["rule_revenue_earlier"] = rule_revenue("earlier_forecast")
VIEWS["live_totals"] = f"""
select 'live_revenue_total' as metric_key, {total("amount")} as metric_value from raw_events
  where event_type = 'order_created' and status = 'completed' having count(*) > 0
union all select 'live_orders_total', cast(count(*) as double) from raw_events
  where event_type = 'order_created' and status = 'completed' having count(*) > 0
union all select 'live_payments_total', cast(count(*) as double) from raw_events
  where event_type = 'payment_processed' having count(*) > 0
union all select 'live_payment_failures_total', cast(count(*) as double) from raw_events
  where event_type = 'payment_processed' and result = 'failed' having count(*) > 0
union all select 'live_delivery_events_total', cast(count(*) as double) from raw_events
  where event_type = 'delivery_update' having count(*) > 0
union all select 'live_sla_breaches_total', cast(count(*) as double) from raw_events
  where event_type = 'delivery_update' and sla_breach having count(*) > 0"""
VIEWS["rule_payments"] = """
select 'payment_failure_rate' as rule, 'HIGH' as severity, 'OPEN' as status, 'payments_platform' as entity,
  printf('Payment failure rate is %.1f%% (%d/%d payments), above the %.0f%% threshold. Payments/engineering team notified.',
    failed / total * 100, cast(failed as bigint), cast(total as bigint), 5.0::double) as message
from (select coalesce(max(metric_value) filter (where metric_key = 'live_payment_failures_total'), 0) as failed,
        max(metric_value) filter (where metric_key = 'live_payments_total') as total from live_totals) x
where failed / nullif(total, 0) * 100 > 5"""
VIEWS["alerts"] = """
select * from rule_stockout union all select * from rule_sla
union all select * from rule_revenue_earlier union all select * from rule_payments"""
QUERIES["rule_stockout"] = "select * from rule_stockout"
QUERIES["rule_sla"] = "select * from rule_sla"
QUERIES["rule_revenue"] = rule_revenue("revenue_forecast")
QUERIES["rule_revenue_earlier_forecast"] = "select * from rule_revenue_earlier"
QUERIES["rule_revenue_any_difference"] = rule_revenue("earlier_forecast", "-1000000")
QUERIES["rule_payments"] = "select * from rule_payments"
QUERIES["alerts_listing"] = "select * from alerts where status = 'OPEN' and severity = 'HIGH'"
QUERIES["alert_outbox"] = """
select rule, entity, '[Retail operations] ' || severity || ' alert: ' || rule as subject, message
from alerts where severity in ('HIGH', 'CRITICAL')"""
QUERIES["alert_numbers"] = """
select row_number() over (order by rule, entity) as number, severity in ('HIGH', 'CRITICAL') as notified from alerts"""
QUERIES["alerts_stored"] = """
select 'ALRT-n-1740810600' as alert_id, *, timestamp '2025-03-01 06:30:00' as created_at,
  severity in ('HIGH', 'CRITICAL') as notified from alerts"""
VIEWS["status_events"] = """
select warehouse_id || ':' || cast(product_id as string) as alert_id,
  case when event_id % 10 = 0 then 'IGNORED' when delta_qty < 0 then 'ACKNOWLEDGED' else 'RESOLVED' end as status,
  event_ts as changed_at from raw_events where event_type = 'inventory_adjustment'"""
QUERIES["alert_current_status"] = """
select a.entity as alert_id, a.rule, coalesce(e.status, a.status) as status
from rule_stockout a left join (
  select * from status_events where status in ('OPEN', 'ACKNOWLEDGED', 'RESOLVED')
  qualify row_number() over (partition by alert_id order by changed_at desc, status desc) = 1) e on a.entity = e.alert_id"""
QUERIES["alert_status_refused"] = """
select e.alert_id, e.status, e.changed_at,
  case when e.status not in ('OPEN', 'ACKNOWLEDGED', 'RESOLVED') then 'invalid status' else 'alert not found' end as refused_because
from status_events e left join (select distinct entity from rule_stockout) a on e.alert_id = a.entity
where e.status not in ('OPEN', 'ACKNOWLEDGED', 'RESOLVED') or a.entity is null"""
QUERIES["operations_summary"] = """
select (select count(*) from fact_inventory where below_reorder_level) as skus_below_reorder,
  (select count(*) from partners) as delivery_partners, (select max(pct) from partners) as worst_partner_breach_pct,
  (select count(*) from alerts where status = 'OPEN') as open_alerts"""
VIEWS["partners"] = """
select partner, 100.0::double * count(*) filter (where sla_breached) / count(*) as pct from fact_delivery group by partner"""
VIEWS["live_orders"] = """
select order_id, cast(customer_id as string) as customer_id, cast(product_id as string) as product_id, warehouse_id,
  quantity, amount, status, cast(event_ts as string) as event_ts from raw_events where event_type = 'order_created'"""
QUERIES["live_metrics"] = "select * from live_totals"
QUERIES["live_totals"] = "select * from live_totals"
QUERIES["live_orders_recent"] = "select * from live_orders order by event_ts desc, order_id limit 25"
QUERIES["live_route_counts"] = """
select case when event_type = 'unknown' then 'unrouted' else event_type end as route, count(*) as events
from raw_events group by 1"""

QUERIES["live_totals_over_restart"] = "select * from live_totals"
VIEWS["feed_parts"] = """
select *, event_id * files // n as part
from raw_events cross join (select max(event_id) + 1 as n, greatest(4, cast(ceil((max(event_id) + 1) / 1000000.0) as bigint)) as files
  from raw_events) c"""
QUERIES["live_progress"] = """
select cast(part as bigint) as batch_id, count(*) as input_rows, cast(0 as bigint) as late_rows from feed_parts group by 1"""
# an hour is closed when the latest event is ten minutes beyond its end
QUERIES["live_revenue_by_hour"] = f"""
select date_trunc('hour', event_ts) as hour, {total("amount")} as revenue, count(*) as orders
from raw_events where event_type = 'order_created' and status = 'completed'
group by 1 having date_trunc('hour', any_value(event_ts)) + interval 1 hour <= (select max(event_ts) from raw_events) - interval 10 minute"""
QUERIES["live_payments"] = """
select order_id, amount, result, cast(event_ts as string) as event_ts from raw_events where event_type = 'payment_processed'"""
QUERIES["live_deliveries"] = """
select order_id, partner, status, sla_breach, cast(event_ts as string) as event_ts from raw_events where event_type = 'delivery_update'"""
QUERIES["live_stock_movements"] = """
select warehouse_id, cast(product_id as string) as product_id, delta_qty, cast(event_ts as string) as event_ts
from raw_events where event_type = 'inventory_adjustment'"""

# --- assertions ---------------------------------------------------------------------

QUERIES["quality_assertions"] = " union all ".join(
    f"select '{t}' as table_name, '{c}' as column_name, '{k}' as check_name, cast({f} as bigint) as failures"
    for t, c, k, f in [
        *[(f"silver_{n}", "*", "not_empty", f"(select count(*) = 0 from silver_{n})") for n in COLUMNS],
        ("fact_orders", "amount", "at_least", "(select count(*) from fact_orders where amount < 0)"),
        ("dim_product", "selling_price", "greater_than", "(select count(*) from dim_product where selling_price <= 0)"),
        ("revenue_forecast", "lower_bound_80pct", "ordered",
         "(select count(*) from revenue_forecast where lower_bound_80pct > predicted_revenue or predicted_revenue > upper_bound_80pct)"),
        ("alerts", "severity", "accepted_values",
         "(select count(*) from alerts where severity not in ('LOW', 'MEDIUM', 'HIGH', 'CRITICAL'))"),
        ("alerts", "rule", "accepted_values",
         "(select count(*) from alerts where rule not in ('inventory_stockout_risk', 'delivery_sla_breach', 'revenue_anomaly', 'payment_failure_rate'))"),
        ("alerts", "entity", "not_null", "(select count(*) from alerts where entity is null)"),
        ("alerts", "message", "not_null", "(select count(*) from alerts where message is null)"),
        ("revenue_forecast", "predicted_revenue", "at_least", "(select count(*) from revenue_forecast where predicted_revenue < 0)"),
        *[(t, "*", "not_empty", f"(select count(*) = 0 from {t})") for t in GOLD],
        ("revenue_forecast", "*", "row_count", "(select abs(count(*) - 7) from revenue_forecast)"),
        ("anomaly_explanations", "explanation", "not_blank",
         "(select count(*) from explained join sensitive using (day) where is_anomaly_statistical and coalesce(trim(explanation), '') = '')"),
        ("kpi_snapshot", "domain", "required_values",
         "5 - (select count(distinct domain) from kpi_snapshot where domain in ('sales', 'customers', 'inventory', 'delivery', 'marketing'))"),
    ]
)


def _used(sql: str, found: set[str]) -> set[str]:
    for name in VIEWS:
        if name not in found and re.search(rf"\b(from|join) {name}\b", sql):
            found.add(name)
            _used(VIEWS[name], found)
    return found


def _order(names: set[str]) -> list[str]:
    done: list[str] = []

    def place(name: str) -> None:
        if name not in done:
            for other in sorted(_used(VIEWS[name], {name}) - {name}):
                place(other)
            done.append(name)

    for name in sorted(names):
        place(name)
    return done


def statement(sql: str) -> str:
    """`sql` with the steps it needs in front."""
    steps = _order(_used(sql, set()))
    body = sql.strip()
    if not steps:
        return body
    kept = {name: " materialized" if name in STORED and "forest_flags" in steps else "" for name in steps}
    return (
        "with " + ",\n".join(f"{name} as{kept[name]} ({VIEWS[name].strip()})" for name in steps) + f"\nselect * from ({body}) result"
    )


def statements() -> dict[str, str]:
    return {name: statement(sql) for name, sql in QUERIES.items()}
