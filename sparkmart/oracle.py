"""The expected result of each query as ANSI SQL over the test tables, for DuckDB.

Written from what a result means, in DuckDB's own idiom, not from the Spark plans:
newest rows by DISTINCT ON, history in closed form, joins fact by fact.
"""

from __future__ import annotations

import re

from sparkmart.plans.dimensions import CALENDAR_END, CALENDAR_START
from sparkmart.plans.warehouse import CHECKS
from sparkmart.registry import LOGGED, MARK, NATURAL_CHECKS
from sparkmart.sources import driver_tables as dt
from sparkmart.sources.schemas import RAW_SCHEMAS


def _columns(expressions: dict[str, str]) -> str:
    return ", ".join(f"{e} as {n}" for n, e in expressions.items())


_DUCK_TYPE = {"string": "varchar", "timestamp_ntz": "timestamp"}


def _typed(entity: str, renames: dict[str, str], computed: dict[str, str] | None = None) -> str:
    computed = computed or {}
    parts = []
    for f in RAW_SCHEMAS[entity].fields:
        kind = f.dataType.simpleString()
        name = renames.get(f.name, f.name)
        if name not in computed:
            parts.append(f"cast({f.name} as {_DUCK_TYPE.get(kind, kind)}) as {name}")
    parts += [f"{e} as {n}" for n, e in computed.items()]
    return f"select {', '.join(parts)} from raw_{entity}"


_NAME = "coalesce(first_name, '') || ' ' || coalesce(last_name, '')"
_STAGED = {
    "customers": ({"id": "customer_id"}, {"full_name": _NAME, "phone": "regexp_replace(phone, '[/-]', '', 'g')"}),
    "products": ({"id": "product_id", "name": "product_name"}, {}),
    "stores": ({"id": "store_id", "name": "store_name"}, {}),
    "employees": ({"id": "employee_id"}, {"full_name": _NAME}),
    "orders": ({"id": "order_id"}, {}),
    "order_items": ({"id": "order_item_id"}, {}),
    "payments": ({"id": "payment_id"}, {}),
    "payment_methods": ({"id": "payment_method_id", "name": "method_name"}, {}),
}


def _key(*parts: str) -> str:
    return "md5(" + " || '|' || ".join(f"coalesce(cast({p} as varchar), '')" for p in parts) + ")"


def _history(key: str, first: str, second: str) -> str:
    """Two batches: a row of the first one was valid until the second had a newer one."""
    return f"""
    with changed as (select n.* from {second} n join {first} f using ({key}) where n.updated_at > f.updated_at)
    select b.*, {_key(f'b.{key}', 'b.updated_at')} as dbt_scd_id, b.updated_at as dbt_updated_at,
           b.updated_at as dbt_valid_from, c.updated_at as dbt_valid_to
    from {first} b left join changed c using ({key})
    union all by name
    select c.*, {_key(f'c.{key}', 'c.updated_at')} as dbt_scd_id, c.updated_at as dbt_updated_at,
           c.updated_at as dbt_valid_from, cast(null as timestamp) as dbt_valid_to
    from changed c"""


_SHIPPED = "select l_orderkey, min(l_shipdate) as first_ship, max(l_shipdate) as last_ship from lineitem group by 1"
_LATEST_CUSTOMER = "(select * from dim_customers where valid_to is null)"
_LATEST_PRODUCT = "(select * from dim_products where valid_to is null)"

# Name -> SQL of every relation the oracles build on.
VIEWS: dict[str, str] = {
    "raw_customers": f"select {_columns(dt.CUSTOMERS)} from customer",
    "raw_customers_2": f"select {_columns(dt.CUSTOMERS_2)} from customer",
    "raw_products": f"select {_columns(dt.PRODUCTS)} from part",
    "raw_products_2": f"select {_columns(dt.PRODUCTS_2)} from part",
    "raw_stores": f"select {_columns(dt.STORES)} from nation left join region on n_regionkey = r_regionkey",
    "raw_employees": f"select {_columns(dt.EMPLOYEES)} from supplier",
    "raw_orders": f"select {_columns(dt.ORDERS)} from orders left join ({_SHIPPED}) s on o_orderkey = l_orderkey",
    "raw_order_items": f"select {_columns(dt.ORDER_ITEMS)} from lineitem",
    "raw_payments": f"select {_columns(dt.PAYMENTS)} from events",
    "raw_payment_methods": f"select {_columns(dt.PAYMENT_METHODS)} from region",
    "raw_inventory_movements": f"select {_columns(dt.INVENTORY_MOVEMENTS)} from lineitem",
    **{f"stg_{e}": _typed(e, *spec) for e, spec in _STAGED.items()},
    **{
        f"stg_{e}_2": _typed(e, *_STAGED[e]).replace(f"raw_{e}", f"raw_{e}_2") for e in ("customers", "products")
    },
    "customer_history": _history("customer_id", "stg_customers", "stg_customers_2"),
    "product_history": _history("product_id", "stg_products", "stg_products_2"),
    "dim_customers": f"""
        select {_key('customer_id', 'dbt_valid_from')} as customer_key, customer_id, team_id, first_name, last_name,
               full_name, email, phone, segment, tier, address, city, state, registered_at, effective_from,
               dbt_valid_from as valid_from, dbt_valid_to as valid_to, dbt_valid_to is null as is_current
        from customer_history""",
    "dim_products": f"""
        select * exclude (effective_from, is_deleted, created_at, updated_at, dbt_scd_id, dbt_updated_at, dbt_valid_from, dbt_valid_to),
               {_key('product_id', 'dbt_valid_from')} as product_key, dbt_valid_from as valid_from,
               dbt_valid_to as valid_to, dbt_valid_to is null as is_current
        from product_history""",
    "dim_stores": f"select *, {_key('store_id')} as store_key from stg_stores",
    "dim_employees": f"select * exclude (full_name), {_key('employee_id')} as employee_key from stg_employees",
    "dim_payment_method": f"select *, {_key('payment_method_id')} as payment_method_key from stg_payment_methods",
    "dim_date": """
        with bounds as (
            select least(min(created_at), min(updated_at)) as a, greatest(max(created_at), max(updated_at)) as b
            from stg_order_items
        ), days as (
            select cast(unnest(generate_series(cast(cast(a as date) as timestamp), cast(cast(b as date) as timestamp), interval 1 day)) as date) as date_day
            from bounds
        )
        select cast(strftime(date_day, '%Y%m%d') as integer) as date_key, date_day,
               cast(year(date_day) as integer) as year, cast(quarter(date_day) as integer) as quarter,
               cast(month(date_day) as integer) as month, cast(weekofyear(date_day) as integer) as week,
               dayname(date_day) as day_of_week, isodow(date_day) >= 6 as is_weekend
        from days""",
    "newest_lines": """
        select distinct on (order_item_id) * from stg_order_items
        order by order_item_id, updated_at desc nulls first, order_id desc, product_id desc, quantity desc, unit_price desc, created_at desc""",
    "fct_sales": f"""
        select md5(order_item_id) as sales_key, order_item_id, s.order_id, c.customer_key, p.product_key, st.store_key,
               e.employee_key, s.created_at, s.updated_at, s.quantity, s.unit_price as price,
               cast(s.quantity * s.unit_price as decimal(18,2)) as gross_revenue
        from newest_lines s
        left join stg_orders o using (order_id)
        left join {_LATEST_CUSTOMER} c on c.customer_id = o.customer_id
        left join {_LATEST_PRODUCT} p on p.product_id = s.product_id
        left join dim_stores st on st.store_id = o.store_id
        left join dim_employees e on e.employee_id = o.employee_id""",
    "newest_payments": """
        select distinct on (payment_id) * from stg_payments
        order by payment_id, updated_at desc nulls first, order_id desc, payment_method_id desc, amount_paid desc""",
    "fct_payments": f"""
        select p.payment_id, p.order_id, c.customer_key, st.store_key, m.payment_method_key, p.paid_at, p.created_at,
               p.updated_at, p.amount_paid
        from (select * from newest_payments where amount_paid > 0) p
        left join stg_orders o using (order_id)
        left join {_LATEST_CUSTOMER} c on c.customer_id = o.customer_id
        left join dim_stores st on st.store_id = o.store_id
        left join dim_payment_method m on m.payment_method_id = p.payment_method_id""",
    "flagged_payments": "select * from stg_payments where not amount_paid > 0",
    "fct_inventory_daily": """
        select cast(moved_at as date) as inventory_date, product_id, store_id,
               cast(sum(quantity) as bigint) as net_quantity_moved, count(*) as movement_count
        from raw_inventory_movements group by all""",
    "fct_order_lifecycle": """
        select order_id, customer_id, store_id, employee_id, ordered_at, paid_at, shipped_at, delivered_at,
               date_diff('microsecond', ordered_at, paid_at) / 3.6e9 as hours_to_payment,
               date_diff('microsecond', paid_at, shipped_at) / 3.6e9 as hours_to_ship,
               date_diff('microsecond', shipped_at, delivered_at) / 3.6e9 as hours_to_delivery
        from stg_orders""",
    # Events as the records of the landed pages.
    "records": """
        select cast(user_id as varchar) || '-' || event_type as id, event_id as "eventId", event_type as "eventType",
               value, value > 50 as "large", replace(props, ' ', '') as props,
               replace(cast(ts as varchar), ' ', 'T') || case when event_id % 2 = 0 then 'Z' else '+00:00' end as "updatedAt",
               ts, event_id // 100 as page, event_id % 100 as pos
        from events""",
    "marks": """
        select event_type as entity, max(ts) as last_updated_at, timestamp '2024-03-01' as last_run_at, count(*) as rows_extracted
        from events group by 1""",
}
_MENTIONED = {name: re.compile(rf"\b{name}\b") for name in VIEWS}


def _with(body: str) -> str:
    """The body after the views it needs, in the order they are defined above."""
    needed: set[str] = set()
    open_texts = [body]
    while open_texts:
        text = open_texts.pop()
        for name, pattern in _MENTIONED.items():
            if name not in needed and pattern.search(text):
                needed.add(name)
                open_texts.append(VIEWS[name])
    views = ", ".join(f"{n} as ({VIEWS[n]})" for n in VIEWS if n in needed)
    return f"with {views} {body}" if views else body


def _failures(check) -> str:
    t, c = check.table, check.column
    if check.kind == "unique":
        return f"select count(*) from (select {c} from {t} where {c} is not null group by {c} having count(*) > 1)"
    if check.kind == "not_null":
        return f"select count(*) from {t} where {c} is null"
    return f"select count(*) from {t} x where x.{c} is not null and not exists (select 1 from {check.to} y where y.{check.field} = x.{c})"


def _report(checks) -> str:
    rows = " union all ".join(f"select '{c.name}' as check_name, ({_failures(c)}) as failures" for c in checks)
    return f"select check_name, failures, case failures when 0 then 'pass' else 'fail' end as status from ({rows})"


_RECORD = 'id, "eventId", "eventType", value, "large", props, "updatedAt"'
_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_ANSWER = "case when l_returnflag in ('R') then true when l_returnflag = 'A' then false else l_linenumber = 1 end"
_MONEY = "cast(sum({}) as decimal(38,2))"
_RATIO = "cast({} as double) / nullif(cast({} as double), 0)"


def _line(expression: str) -> str:
    return f"select {_LINE}, {expression} from lineitem"


#: What the build's queries add up over each model, after a build over the first batches.
_BUILT = {
    "dim_customers": "select 1 as x from stg_customers",
    "dim_products": "select selling_price as x from stg_products",
    "dim_stores": "select length(store_name) as x from stg_stores",
    "dim_employees": "select length(employee_id) as x from stg_employees",
    "dim_payment_method": "select length(method_name) as x from stg_payment_methods",
    "dim_date": f"""select cast(strftime(d, '%Y%m%d') as integer) as x
        from (select unnest(generate_series(timestamp '{CALENDAR_START}', timestamp '{CALENDAR_END}', interval 1 day)) as d)""",
    # the raw lines are merged first; of equally new ones the largest stays, column by column
    "fct_sales": """
        select cast(quantity * unit_price as decimal(18,2)) as x from (
            select distinct on (order_item_id) * from stg_order_items
            order by order_item_id, updated_at desc nulls first, team_id desc, order_id desc, product_id desc, quantity desc,
                     unit_price desc, discount_pct desc, line_total desc, created_at desc)""",
    "fct_payments": "select amount_paid as x from fct_payments",
    "flagged_payments": "select amount_paid as x from newest_payments where not amount_paid > 0",
    "fct_inventory_daily": """
        select sum(quantity) as x from (
            select distinct on (id) * from raw_inventory_movements order by id, product_id desc, store_id desc, quantity desc, moved_at desc
        ) group by cast(moved_at as date), product_id, store_id""",
    "fct_order_lifecycle": "select case when delivered_at > ordered_at then 1 else 0 end as x from stg_orders",
    "snapshot_customers": "select 1 as x from stg_customers",
    "snapshot_products": "select selling_price as x from stg_products",
}
_TOTAL = "coalesce(cast(sum(x) as decimal(38,2)), 0)"


BODIES: dict[str, str] = {
    # ---- landed pages
    "unwrap_pages": 'select page, pos, id, "eventId", value from records',
    "infer_arrival_schema": """
        select unnest(['id', 'eventId', 'eventType', 'value', 'large', 'props', 'updatedAt']) as column_name,
               unnest(['string', 'bigint', 'string', case when bool_or(value <> floor(value)) then 'decimal(38,18)' else 'bigint' end,
                       'boolean', 'string', 'string']) as arrival_type
        from records""",
    "serialize_nested": """
        select event_id, replace(props, ' ', '') as props, '[' || user_id || ',' || event_id || ']' as pair from events""",
    "conform_columns": """
        select cast(event_id as varchar) as event_id, user_id, cast(value as decimal(12,2)) as value,
               cast(null as varchar) as channel, ts from events""",
    "snake_case_columns": "select o_orderkey as order_id, o_custkey as customer_id, o_orderdate as updated_at, o_orderstatus as status from orders",
    "read_watermark": "select event_type as entity, max(ts) as mark from events where event_type = 'purchase' group by 1",
    "filter_updated_after": f"""select "eventId", "updatedAt" from records where ts >= timestamp '{MARK[:-1]}'""",
    "advance_watermark": f"select greatest(max(ts), timestamp '{MARK[:-1]}') as mark, count(*) as rows from events",
    "save_watermark": """
        select * from marks where entity <> 'purchase'
        union all select 'purchase', timestamp '2030-01-01', timestamp '2030-01-02', 7
        union all select 'refund', timestamp '2030-01-01', timestamp '2030-01-02', 1""",
    # ---- upsert, merge, extract
    "upsert_by_id": f"""
        select {_RECORD.replace('value', """case "eventType" when 'error' then value * 2 else value end as value""")}
        from (select distinct on (id) * from records order by id, page desc, pos desc)""",
    "merge_by_key": """
        select id, segment, case when c_acctbal >= 9000 then 'vip' else tier end as tier,
               case when c_acctbal >= 9000 then '2024-02-01 00:00:00' else updated_at end as updated_at
        from raw_customers join customer on id = cast(c_custkey as varchar)""",
    "extract_entity": f"""
        select distinct on (id) {_RECORD} from records order by id, page % 2 desc, page desc, pos desc""",
    "extract_rerun_is_noop": """
        select cast(run as integer) as run, cast(rows as bigint) as rows, cast(batches as bigint) as batches from (values (1, (select count(*) from records where page % 2 = 0), 1),
          (2, 0, 1), (3, (select count(*) from records where page % 2 = 1), 2), (4, 0, 2)) t(run, rows, batches)""",
    "extract_summary": """
        select 'event_type=' || event_type as entity, 'success' as status, count(*) as rows, max(ts) as mark from events group by event_type
        union all select 'not_landed', 'failed', cast(null as bigint), cast(null as timestamp)""",
    "stream_ingest": f"select distinct on (id) {_RECORD} from records order by id, page % 2 desc, page desc, pos desc",
    "write_table": "select * from supplier",
    "source_table": " union all ".join(
        f"select '{e}' as source, count({'distinct id' if e in LOGGED else '*'}) as rows from raw_{e}" for e in RAW_SCHEMAS
    ),
    "materialize": """
        select *, cast(year(inventory_date) * 100 + month(inventory_date) as integer) as month from fct_inventory_daily""",
    "model_ref": """
        select f.payment_method_id, count(*) as flagged, m.method_name
        from stg_payments f left join dim_payment_method m using (payment_method_id)
        where f.amount_paid <= 0 group by 1, 3""",
    # ---- staging and marts
    **{f"stg_{e}": f"select * from stg_{e}" for e in _STAGED},
    **{
        m: f"select * from {m}" for m in (
            "dim_customers", "dim_products", "dim_stores", "dim_employees", "dim_payment_method", "dim_date",
            "fct_sales", "fct_payments", "flagged_payments", "fct_inventory_daily", "fct_order_lifecycle",
        )
    },
    # ---- columns
    "cast_text": _line("cast(l_orderkey as varchar) as key_text, cast(l_shipdate as varchar) as ship_text"),
    "cast_int": _line("cast(round(l_quantity) as integer) as quantity, cast(round(cast(l_extendedprice as decimal(12,2))) as integer) as price"),
    "cast_money": _line("cast(l_extendedprice as decimal(12,2)) as price"),
    "cast_pct": _line("cast(l_discount as decimal(8,2)) as discount_pct"),
    "cast_bool": _line(f"{_ANSWER} as answer"),
    "cast_date": _line("cast(l_shipdate as date) as ship_date"),
    "cast_ts": "select event_id, ts as at from events",
    "full_name": """
        select s_suppkey, case when s_suppkey % 3 > 0 then s_name else '' end || ' '
               || case when s_suppkey % 5 > 0 then cast(s_acctbal as varchar) else '' end as full_name from supplier""",
    "clean_phone": "select c_custkey, '555' || c_nationkey || c_custkey as phone from customer",
    "coalesce_empty": "select c_custkey, case when c_mktsegment = 'BUILDING' then '' else c_mktsegment end as segment from customer",
    "md5_key": _line("md5(l_orderkey || '-' || l_linenumber) as line_key"),
    "surrogate_key": """
        select o_orderkey, md5(o_orderkey || '|' || case o_orderstatus when 'P' then '' else o_orderstatus end || '|' || cast(o_orderdate as varchar)) as order_key
        from orders""",
    "is_current": "select customer_id, dbt_valid_from, dbt_valid_to is null as is_current from customer_history",
    "date_key": _line("cast(strftime(l_shipdate, '%Y%m%d') as integer) as date_key"),
    "date_parts": """
        select o_orderkey, cast(year(o_orderdate) as integer) as year, cast(quarter(o_orderdate) as integer) as quarter,
               cast(month(o_orderdate) as integer) as month from orders""",
    "iso_week": "select o_orderkey, cast(weekofyear(o_orderdate) as integer) as week from orders",
    "day_name": "select o_orderkey, dayname(o_orderdate) as day_of_week from orders",
    "is_weekend": "select o_orderkey, isodow(o_orderdate) in (6, 7) as is_weekend from orders",
    "to_day": "select event_id, cast(ts as date) as day from events",
    "hours_between": "select order_id, date_diff('microsecond', ordered_at, delivered_at) / 3.6e9 as hours from stg_orders",
    "gross_revenue": _line("cast(cast(l_quantity as integer) * cast(l_extendedprice as decimal(12,2)) as decimal(18,2)) as gross_revenue"),
    "predicates": """
        select order_id, status, total_amount, delivered_at > ordered_at as later from stg_orders
        where status in ('F', 'O') and discount_amount <= 0 and discount_code is null and total_amount > 100000 and team_id = '1'""",
    # ---- relational operators
    "left_join_lookup": "select order_id, store_id, store_key from stg_orders left join (select store_id, store_key from dim_stores) using (store_id)",
    "current_dim_join": f"""
        select order_id, c.customer_key, c.tier from stg_orders o left join {_LATEST_CUSTOMER} c on c.customer_id = o.customer_id""",
    "dedup_latest": """
        select distinct on (order_item_id) * from stg_order_items
        order by order_item_id, updated_at desc nulls first, team_id desc, order_id desc, product_id desc, quantity desc,
                 unit_price desc, discount_pct desc, line_total desc, created_at desc""",
    "group_sum_count": """
        select cast(l_shipdate as date) as ship_day, l_returnflag as flag, cast(sum(l_partkey) as bigint) as total, count(*) as lines
        from lineitem group by all""",
    "date_spine": """
        select cast(unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day)) as date) as date_day from orders""",
    "cte": "select order_id, count(distinct order_item_id) as lines, max(updated_at) as newest from stg_order_items group by 1",
    "filter_positive": "select payment_id, amount_paid, updated_at from newest_payments where amount_paid > 0",
    # ---- history
    "scd2_apply": f"""
        with kept as (
            select cast(user_id as varchar) as user_id, event_type, value, ts as updated_at from events
            qualify ts = max(ts) over (partition by user_id)
                 or ts = max(ts) filter (where event_type <> 'error') over (partition by user_id)
        )
        select *, {_key('user_id', 'updated_at')} as dbt_scd_id, updated_at as dbt_updated_at, updated_at as dbt_valid_from,
               lead(updated_at) over (partition by user_id order by updated_at) as dbt_valid_to
        from kept""",
    "snapshot_customers": "select * from customer_history",
    "snapshot_products": "select * from product_history",
    "scd2_from_log": f"""
        select cast(user_id as varchar) as user_id, event_id, event_type, ts, {_key('user_id', 'ts')} as dbt_scd_id,
               ts as dbt_updated_at, ts as dbt_valid_from, lead(ts) over (partition by user_id order by ts) as dbt_valid_to
        from events""",
    "fact_date_key": """
        select order_id, a.date_key as ordered_date_key, b.date_key as shipped_date_key, c.date_key as delivered_date_key
        from fct_order_lifecycle f
        left join dim_date a on a.date_day = cast(f.ordered_at as date)
        left join dim_date b on b.date_day = cast(f.shipped_at as date)
        left join dim_date c on c.date_day = cast(f.delivered_at as date)""",
    # ---- reports
    "kpi_summary": f"""
        select *, {_RATIO.format('revenue', 'orders')} as average_order_value from (
            select {_MONEY.format('gross_revenue')} as revenue, count(distinct order_id) as orders, count(distinct customer_key) as customers
            from fct_sales)""",
    "revenue_by_store": f"""
        select store_name, {_MONEY.format('gross_revenue')} as revenue, count(distinct order_id) as orders
        from fct_sales left join dim_stores using (store_key) group by 1""",
    "revenue_by_product": f"""
        select product_id, product_name, category, {_MONEY.format('gross_revenue')} as revenue, cast(sum(quantity) as bigint) as quantity
        from fct_sales left join dim_products using (product_key) group by 1, 2, 3""",
    "revenue_trend": f"""
        select d.date_key, cast(year(sold_on) as integer) as year, cast(month(sold_on) as integer) as month, revenue,
               {_MONEY.format('revenue')} over (partition by year(sold_on), month(sold_on)) as month_revenue
        from (select cast(created_at as date) as sold_on, {_MONEY.format('gross_revenue')} as revenue from fct_sales group by 1)
        left join dim_date d on d.date_day = sold_on""".replace(
            "cast(sum(revenue) as decimal(38,2)) over (partition by year(sold_on), month(sold_on))",
            "cast(sum(revenue) over (partition by year(sold_on), month(sold_on)) as decimal(38,2))"),
    "top_customers": f"""
        select t.*, c.customer_id, c.full_name from (
            select customer_key, {_MONEY.format('gross_revenue')} as revenue, count(distinct order_id) as orders
            from fct_sales where customer_key is not null group by 1 order by revenue desc, customer_key limit 10
        ) t left join dim_customers c using (customer_key)""",
    "customer_growth": """
        select month, new_customers, cast(sum(new_customers) over (order by month) as bigint) as total_customers from (
            select strftime(first_at, '%Y-%m') as month, count(*) as new_customers
            from (select customer_key, min(created_at) as first_at from fct_sales where customer_key is not null group by 1) group by 1)""",
    "payment_method_mix": f"""
        select *, {_RATIO.format('amount', 'sum(amount) over ()')} as amount_share from (
            select method_name, count(*) as payments, {_MONEY.format('amount_paid')} as amount
            from fct_payments left join dim_payment_method using (payment_method_key) group by 1)""",
    "payment_performance": f"""
        select m.payment_method_id, m.method_name, a.amount, a.mean_hours_to_payment, coalesce(f.flagged, 0) as flagged
        from dim_payment_method m
        left join (
            select payment_method_key, {_MONEY.format('amount_paid')} as amount, avg(hours_to_payment) as mean_hours_to_payment
            from fct_payments left join fct_order_lifecycle using (order_id) group by 1
        ) a using (payment_method_key)
        left join (select payment_method_id, count(*) as flagged from flagged_payments group by 1) f using (payment_method_id)""",
    "inventory_monitor": """
        select inventory_date, product_id, store_id, net_quantity_moved,
               cast(sum(net_quantity_moved) over (partition by product_id, store_id order by inventory_date) as bigint) as net_stock
        from fct_inventory_daily""",
    "store_performance": f"""
        select st.store_id, st.store_name, a.revenue, coalesce(a.orders, 0) as orders, d.mean_hours_to_delivery
        from dim_stores st
        left join (select store_key, {_MONEY.format('gross_revenue')} as revenue, count(distinct order_id) as orders from fct_sales group by 1) a using (store_key)
        left join (select store_id, avg(hours_to_delivery) as mean_hours_to_delivery from fct_order_lifecycle group by 1) d using (store_id)""",
    # ---- quality and builds
    "check_unique": "select order_item_id, count(*) as failures from stg_order_items group by 1 having count(*) > 1",
    "check_not_null": "select order_id, status, ordered_at from stg_orders where delivered_at is null",
    "check_relationships": "select store_id, count(*) as failures from stg_orders where store_id not in (select store_id from stg_stores) group by 1",
    "quality_report": _report(CHECKS + NATURAL_CHECKS),
    "warehouse_build": f"select *, cast(null as decimal(38,2)) as total from ({_report(CHECKS)})" + "".join(
        f" union all select 'rows_{name}', count(*), 'rows', {_TOTAL} from ({rows})" for name, rows in _BUILT.items()
    ),
    "rerun_is_noop": " union all ".join(
        f"select '{name}' as model, count(*) as rows, {_TOTAL} as total, false as changed from ({rows})" for name, rows in _BUILT.items()
    ),
}
BODIES |= {
    "merge_parts": BODIES["merge_by_key"],
    "fold_log": BODIES["extract_entity"],
    "hot_key_lookup": BODIES["left_join_lookup"],
    "scd2_from_hot_log": f"""
        select event_type, user_id, ts, {_key('event_type', 'ts')} as dbt_scd_id, ts as dbt_updated_at, ts as dbt_valid_from,
               lead(ts) over (partition by event_type order by ts) as dbt_valid_to
        from (select distinct on (event_type, ts) event_type, user_id, ts from events order by event_type, ts, user_id desc)""",
    "stream_schema_growth": """
        select distinct on (id) id, "eventId", "eventType", "large", case when page % 2 = 1 then cast(7 as bigint) end as "channelNo"
        from records order by id, page % 2 desc, page desc, pos desc""",
}

ORACLES = {name: _with(body) for name, body in BODIES.items()}
