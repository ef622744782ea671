"""Registered queries: quality checks, freshness and validation reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeward import config as C
from lakeward.functions import columns as X
from lakeward.operators import freshness as FR
from lakeward.operators import layers as L
from lakeward.operators import quality as Q
from lakeward.plans import validate as V
from lakeward.plans.catalog import _silver, as_sql_money, built_layers, oe_layers, register
from lakeward.plans.oracle import with_ctes
from lakeward.sources.fixtures import order_events


WATERMARKS = tuple({m for source, mark, _ in FR.WATERMARKS.values() for m in (source, mark)})


def _metrics(spark, sf, only=tuple(Q.METRIC_TYPES)):
    """The metrics in ``only``. One layer is derived as the query runs; of several each
    is built once and read back."""
    used = Q.metric_layers(only)
    layers = oe_layers(spark, sf) if len(used) == 1 else built_layers(spark, sf, used)
    return Q.metrics(layers, only=only)


def _check(name: str):
    def run(spark, sf):
        return Q.checks(_metrics(spark, sf, Q.CHECK_METRICS[name])).where(F.col("check_name") == name)
    return run


for _key, _name in (
    ("check_bronze_non_empty", "bronze_non_empty"),
    ("check_silver_non_empty", "silver_non_empty"),
    ("check_latest_non_empty", "latest_non_empty"),
    ("check_silver_unique_events", "silver_unique_events"),
    ("check_customer_coverage", "customer_coverage"),
    ("reconcile_daily_revenue", "daily_revenue_reconciles"),
    ("reconcile_customer_revenue", "customer_revenue_reconciles"),
    ("reconcile_delivered_orders", "delivered_orders_reconcile"),
):
    register(_key, with_ctes("checks", f"select * from checks where check_name = '{_name}'"))(_check(_name))


def _freshness(layer: str):
    def run(spark, sf):
        return FR.layer_freshness(_metrics(spark, sf, FR.WATERMARKS[layer][:2])).where(F.col("layer") == layer)
    return run


for _key, _layer in (
    ("freshness_bronze", "bronze_orders"),
    ("freshness_silver", "silver_orders"),
    ("freshness_latest_state", "silver_latest_order_state"),
    ("freshness_customer_metrics", "gold_customer_order_metrics"),
    ("freshness_daily_sales", "gold_daily_region_sales"),
):
    register(_key, with_ctes("freshness_status", f"select * from freshness_status where layer = '{_layer}'"))(
        _freshness(_layer))


@register("layer_freshness", with_ctes("freshness_status", "select * from freshness_status"))
def q_layer_freshness(spark, sf):
    return FR.layer_freshness(_metrics(spark, sf, WATERMARKS))


@register("validation_metrics", with_ctes("metrics", "select * from metrics"))
def q_validation_metrics(spark, sf):
    return as_sql_money(_metrics(spark, sf), *[k for k, t in Q.METRIC_TYPES.items() if t == "money"])


@register("fn_sla_status", with_ctes("silver", """
select event_id, lag_minutes, lag_days,
       case when lag_minutes <= 10 then 'healthy' else 'breach' end as minute_status,
       case when lag_days <= 0 then 'healthy' else 'breach' end as day_status,
       case when customer_id like '%7' then 'unknown'
            when lag_minutes <= 10 then 'healthy' else 'breach' end as mixed_status
from (select event_id, customer_id,
             cast(floor(epoch(ingestion_ts - event_ts) / 60) as bigint) as lag_minutes,
             cast(ingestion_date - event_date as bigint) as lag_days from silver)"""))
def q_sla_status(spark, sf):
    s = _silver(spark, sf).select(
        "event_id", "customer_id",
        X.lag_minutes("ingestion_ts", "event_ts").alias("lag_minutes"),
        X.lag_days("ingestion_date", "event_date").alias("lag_days"))
    none = F.lit(None).cast("bigint")
    unknown = F.col("customer_id").endswith("7")
    return s.select(
        "event_id", "lag_minutes", "lag_days",
        X.sla_status("lag_minutes", none, F.lit(10), none).alias("minute_status"),
        X.sla_status(none, "lag_days", none, F.lit(0)).alias("day_status"),
        X.sla_status(F.when(~unknown, F.col("lag_minutes")), none, F.lit(10), none).alias("mixed_status"))


FRESHNESS_GATE_SQL = """
select count(*) filter (where status = 'breach') = 0 as passed,
       coalesce(string_agg(case when status = 'breach' then layer end, ', ' order by layer), '') as breached_layers,
       case when count(*) filter (where status = 'breach') > 0
            then 'freshness SLA violated for layers: '
                 || string_agg(case when status = 'breach' then layer end, ', ' order by layer) end as message
from {src}"""


@register("freshness_gate", with_ctes("freshness_status", FRESHNESS_GATE_SQL.format(src="freshness_status")))
def q_freshness_gate(spark, sf):
    return FR.freshness_gate(FR.layer_freshness(_metrics(spark, sf, WATERMARKS)))


@register("freshness_gate_tight_sla", with_ctes("freshness_status", FRESHNESS_GATE_SQL.format(src="""(
  select layer, case when lag_minutes is not null then
                  case when lag_minutes <= -1 then 'healthy' else 'breach' end
                else case when lag_days <= -1 then 'healthy' else 'breach' end end as status
  from freshness_status)""")))
def q_freshness_gate_tight(spark, sf):
    """The same gate under SLAs no layer can meet (every layer breaches)."""
    from lakeward.config import Settings
    tight = Settings(sla_minutes={k: -1 for k in C.SLA_MINUTES}, sla_days={k: -1 for k in C.SLA_DAYS})
    return FR.freshness_gate(FR.layer_freshness(_metrics(spark, sf, WATERMARKS), tight))


@register("validation_checks", with_ctes(("freshness_status", "checks"), """
select * from checks
union all
select 9, 'freshness_sla', passed, breached_layers, '', coalesce(message, '')
from (""" + FRESHNESS_GATE_SQL.format(src="freshness_status") + ")"))
def q_validation_checks(spark, sf):
    m = V.metrics_row(spark, built_layers(spark, sf))
    gate = FR.freshness_gate(FR.layer_freshness(m)).select(
        F.lit(9).alias("position"), F.lit("freshness_sla").alias("check_name"), "passed",
        F.col("breached_layers").alias("observed"), F.lit("").alias("expected"),
        F.coalesce("message", F.lit("")).alias("message"))
    return Q.checks(m).unionByName(gate)


# ------------------------------------------------------------ column tests

NOT_NULL_SQL = """
select * , failures = 0 as passed from (
  select 'order_events' as table_name, 'event_id' as column_name, 'not_null' as test,
         count(*) filter (where event_id is null) as failures from oe
  union all select 'order_events', 'order_id', 'not_null', count(*) filter (where order_id is null) from oe
  union all select 'order_events', 'customer_id', 'not_null', count(*) filter (where customer_id is null) from oe
  union all select 'bronze_orders', 'event_id', 'not_null', count(*) filter (where event_id is null) from bronze
  union all select 'bronze_orders', 'order_id', 'not_null', count(*) filter (where order_id is null) from bronze
  union all select 'silver_orders', 'event_id', 'not_null', count(*) filter (where event_id is null) from silver
  union all select 'silver_latest_order_state', 'order_id', 'not_null',
                   count(*) filter (where order_id is null) from latest
  union all select 'gold_daily_region_sales', 'event_date', 'not_null',
                   count(*) filter (where event_date is null) from daily
  union all select 'gold_daily_region_sales', 'region', 'not_null', count(*) filter (where region is null) from daily
  union all select 'gold_customer_order_metrics', 'customer_id', 'not_null',
                   count(*) filter (where customer_id is null) from customer_metrics)"""

UNIQUE_SQL = """
select *, failures = 0 as passed from (
  select 'silver_orders' as table_name, 'event_id' as column_name, 'unique' as test, count(*) as failures
    from (select event_id from silver where event_id is not null group by 1 having count(*) > 1)
  union all select 'silver_latest_order_state', 'order_id', 'unique', count(*)
    from (select order_id from latest where order_id is not null group by 1 having count(*) > 1)
  union all select 'gold_customer_order_metrics', 'customer_id', 'unique', count(*)
    from (select customer_id from customer_metrics where customer_id is not null group by 1 having count(*) > 1))"""


def _test_tables(spark, sf):
    return {"order_events": order_events(spark, sf), **built_layers(spark, sf)}


@register("test_not_null", with_ctes(("oe", "bronze", "silver", "latest", "daily", "customer_metrics"), NOT_NULL_SQL))
def q_not_null(spark, sf):
    tests = [t for t in C.COLUMN_TESTS if t[2] == "not_null"]
    return Q.column_tests(_test_tables(spark, sf), tests)


@register("test_unique", with_ctes(("silver", "latest", "customer_metrics"), UNIQUE_SQL))
def q_unique(spark, sf):
    tests = [t for t in C.COLUMN_TESTS if t[2] == "unique"]
    return Q.column_tests(_test_tables(spark, sf), tests)


@register("test_bronze_event_id_unique", with_ctes("bronze", """
select 'bronze_orders' as table_name, 'event_id' as column_name, 'unique' as test, count(*) as failures,
       count(*) = 0 as passed
from (select event_id from bronze where event_id is not null group by 1 having count(*) > 1)"""))
def q_bronze_unique(spark, sf):
    """The unique test failing as it should: bronze keeps duplicate deliveries."""
    return Q.column_tests({"bronze_orders": L.bronze(order_events(spark, sf))},
                          [("bronze_orders", "event_id", "unique")])
