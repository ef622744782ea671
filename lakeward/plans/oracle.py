"""DuckDB oracle SQL for the registered queries.

Each query is the same computation written independently in plain SQL over
the driver's pre-registered tables. Common table expressions are declared
once here and pulled in (with their prerequisites) by ``with_ctes``.
"""

from __future__ import annotations

KEY_FILTER = (
    "event_id is not null and order_id is not null and customer_id is not null "
    "and region is not null and status is not null"
)
BRONZE_COLS = "source_file, event_id, order_id, customer_id, region, status, order_amount, event_ts, ingestion_ts"
SILVER_COLS = ("event_id, order_id, customer_id, region, status, order_amount, event_ts, ingestion_ts, "
               "event_date, ingestion_date, source_file")
LATEST_COLS = ("order_id, customer_id, region, status, order_amount, event_ts, ingestion_ts, "
               "event_date, ingestion_date")
DEDUPE_RANK = (
    "row_number() over (partition by event_id order by ingestion_ts desc nulls last, event_ts desc nulls last, "
    "order_amount desc nulls last, status desc nulls last, customer_id desc nulls last, "
    "source_file desc nulls last, order_id desc nulls last, region desc nulls last)"
)
LATEST_RANK = (
    "row_number() over (partition by order_id order by event_ts desc nulls last, "
    "ingestion_ts desc nulls last, event_id desc nulls last)"
)

# name -> (prerequisites, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "oe": ((), """
select concat('evt-', l_orderkey, '-', l_linenumber) as event_id,
       concat('ord-', l_orderkey) as order_id,
       case when l_partkey % 101 = 0 then null else concat('cust-', o_custkey) end as customer_id,
       r_name as region,
       case when l_returnflag = 'R' then 'CANCELLED' when l_linestatus = 'F' then 'Delivered' else 'created' end as status,
       cast(l_extendedprice as decimal(12,2)) as order_amount,
       l_shipdate as event_ts,
       l_shipdate + to_minutes(l_suppkey % 1440) as ingestion_ts,
       concat('batch_', l_suppkey % 4) as source_file
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
     join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""),
    "bronze": (("oe",), f"select {BRONZE_COLS} from oe"),
    "keyed": (("bronze",), f"select * from bronze where {KEY_FILTER}"),
    "deduped": (("keyed",), f"select {BRONZE_COLS} from (select *, {DEDUPE_RANK} as rn from keyed) where rn = 1"),
    "silver": (("deduped",), """
select event_id, order_id, customer_id, lower(region) as region, lower(status) as status, order_amount,
       event_ts, ingestion_ts, cast(event_ts as date) as event_date, cast(ingestion_ts as date) as ingestion_date,
       source_file
from deduped"""),
    "latest": (("silver",), f"select {LATEST_COLS} from (select *, {LATEST_RANK} as rn from silver) where rn = 1"),
    "daily": (("latest",), """
select event_date, region, count(*) as delivered_orders,
       cast(sum(order_amount) as decimal(12,2)) as delivered_revenue
from latest where status = 'delivered' group by 1, 2"""),
    "customer_metrics": (("latest",), """
select customer_id, count(*) as active_orders,
       cast(sum(case when status = 'delivered' then 1 else 0 end) as bigint) as delivered_orders,
       cast(sum(case when status = 'delivered' then order_amount else cast(0 as decimal(12,2)) end)
            as decimal(12,2)) as delivered_revenue,
       max(event_ts) as latest_order_event_ts
from latest group by 1"""),
    "metrics": (("bronze", "silver", "latest", "daily", "customer_metrics"), """
select
  (select count(*) from bronze) as bronze_rows,
  (select count(*) from silver) as silver_rows,
  (select count(*) from (select event_id from silver group by 1 having count(*) > 1)) as duplicate_event_ids,
  (select count(*) from latest) as latest_state_rows,
  (select count(*) from customer_metrics) as gold_customer_metric_rows,
  (select coalesce(cast(sum(order_amount) as decimal(12,2)), cast(0 as decimal(12,2)))
     from latest where status = 'delivered') as delivered_revenue_from_silver,
  (select coalesce(cast(sum(delivered_revenue) as decimal(12,2)), cast(0 as decimal(12,2)))
     from daily) as delivered_revenue_from_gold_daily,
  (select coalesce(cast(sum(delivered_revenue) as decimal(12,2)), cast(0 as decimal(12,2)))
     from customer_metrics) as delivered_revenue_from_gold_customer,
  (select count(*) from latest where status = 'delivered') as delivered_orders_from_latest_state,
  (select cast(coalesce(sum(delivered_orders), 0) as bigint) from customer_metrics) as delivered_orders_from_gold_customer,
  (select count(distinct customer_id) from latest) as distinct_customers_from_latest_state,
  (select max(ingestion_ts) from bronze) as source_max_ingestion_ts,
  (select max(event_ts) from latest) as source_max_event_ts,
  (select max(event_date) from latest) as source_max_event_date,
  (select max(ingestion_ts) from bronze) as bronze_max_ingestion_ts,
  (select max(ingestion_ts) from silver) as silver_max_ingestion_ts,
  (select max(ingestion_ts) from latest) as latest_state_max_ingestion_ts,
  (select max(latest_order_event_ts) from customer_metrics) as customer_metrics_max_event_ts,
  (select max(event_date) from daily) as gold_daily_max_event_date"""),
    "freshness": (("metrics",), """
select * from (
  select 1 as position, 'bronze_orders' as layer,
         coalesce(strftime(source_max_ingestion_ts, '%Y-%m-%d %H:%M:%S'), '') as source_timestamp,
         coalesce(strftime(bronze_max_ingestion_ts, '%Y-%m-%d %H:%M:%S'), '') as layer_timestamp,
         cast(floor(epoch(source_max_ingestion_ts - bronze_max_ingestion_ts) / 60) as bigint) as lag_minutes,
         cast(null as bigint) as lag_days, cast(5 as bigint) as sla_minutes, cast(null as bigint) as sla_days
  from metrics
  union all
  select 2, 'silver_orders',
         coalesce(strftime(source_max_ingestion_ts, '%Y-%m-%d %H:%M:%S'), ''),
         coalesce(strftime(silver_max_ingestion_ts, '%Y-%m-%d %H:%M:%S'), ''),
         cast(floor(epoch(source_max_ingestion_ts - silver_max_ingestion_ts) / 60) as bigint),
         null, 10, null
  from metrics
  union all
  select 3, 'silver_latest_order_state',
         coalesce(strftime(source_max_ingestion_ts, '%Y-%m-%d %H:%M:%S'), ''),
         coalesce(strftime(latest_state_max_ingestion_ts, '%Y-%m-%d %H:%M:%S'), ''),
         cast(floor(epoch(source_max_ingestion_ts - latest_state_max_ingestion_ts) / 60) as bigint),
         null, 10, null
  from metrics
  union all
  select 4, 'gold_customer_order_metrics',
         coalesce(strftime(source_max_event_ts, '%Y-%m-%d %H:%M:%S'), ''),
         coalesce(strftime(customer_metrics_max_event_ts, '%Y-%m-%d %H:%M:%S'), ''),
         cast(floor(epoch(source_max_event_ts - customer_metrics_max_event_ts) / 60) as bigint),
         null, 15, null
  from metrics
  union all
  select 5, 'gold_daily_region_sales',
         coalesce(strftime(source_max_event_date, '%Y-%m-%d'), ''),
         coalesce(strftime(gold_daily_max_event_date, '%Y-%m-%d'), ''),
         null, cast(source_max_event_date - gold_daily_max_event_date as bigint), null, 0
  from metrics
)"""),
    "freshness_status": (("freshness",), """
select *, case when lag_minutes is not null and sla_minutes is not null
                 then case when lag_minutes <= sla_minutes then 'healthy' else 'breach' end
               when lag_days is not null and sla_days is not null
                 then case when lag_days <= sla_days then 'healthy' else 'breach' end
               else 'unknown' end as status
from freshness"""),
    "checks": (("metrics",), """
select * from (
  select 1 as position, 'bronze_non_empty' as check_name, coalesce(bronze_rows > 0, false) as passed,
         cast(bronze_rows as varchar) as observed, '> 0' as expected, 'bronze layer is empty' as message from metrics
  union all select 2, 'silver_non_empty', coalesce(silver_rows > 0, false), cast(silver_rows as varchar), '> 0',
         'silver layer is empty' from metrics
  union all select 3, 'silver_unique_events', coalesce(duplicate_event_ids = 0, false), cast(duplicate_event_ids as varchar),
         '0', 'silver layer still contains duplicate event_id values' from metrics
  union all select 4, 'latest_non_empty', coalesce(latest_state_rows > 0, false), cast(latest_state_rows as varchar), '> 0',
         'latest state table is empty' from metrics
  union all select 5, 'customer_coverage', coalesce(gold_customer_metric_rows = distinct_customers_from_latest_state, false),
         cast(gold_customer_metric_rows as varchar), cast(distinct_customers_from_latest_state as varchar),
         'gold customer metrics does not cover every latest-state customer' from metrics
  union all select 6, 'daily_revenue_reconciles',
         coalesce(delivered_revenue_from_gold_daily = delivered_revenue_from_silver, false),
         cast(delivered_revenue_from_gold_daily as varchar), cast(delivered_revenue_from_silver as varchar),
         'daily gold revenue does not reconcile with silver latest state' from metrics
  union all select 7, 'customer_revenue_reconciles',
         coalesce(delivered_revenue_from_gold_customer = delivered_revenue_from_silver, false),
         cast(delivered_revenue_from_gold_customer as varchar), cast(delivered_revenue_from_silver as varchar),
         'customer gold revenue does not reconcile with silver latest state' from metrics
  union all select 8, 'delivered_orders_reconcile',
         coalesce(delivered_orders_from_gold_customer = delivered_orders_from_latest_state, false),
         cast(delivered_orders_from_gold_customer as varchar), cast(delivered_orders_from_latest_state as varchar),
         'customer gold delivered order counts do not reconcile' from metrics
)"""),
}


def _order(names: tuple[str, ...]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for dep in CTES[n][0]:
            visit(dep)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_ctes(names: tuple[str, ...] | str, body: str, extra: dict[str, str] | None = None) -> str:
    """``with <needed ctes> <body>``; ``extra`` adds query-local CTEs last."""
    if isinstance(names, str):
        names = (names,)
    parts = [f"{n} as ({CTES[n][1]}\n)" for n in _order(names)]
    for n, sql in (extra or {}).items():
        parts.append(f"{n} as ({sql}\n)")
    return "with " + ",\n".join(parts) + "\n" + body
