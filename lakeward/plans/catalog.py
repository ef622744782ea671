"""Registered queries: one per operator of the inventory.

Every query reads the driver's tables (through the order-event view of
``lakeward.sources.fixtures``) or data Spark derives from them, so its work
grows with the input. ``ORACLE`` holds the independent DuckDB SQL for the
same result; queries without an oracle entry are checked on rows only.
"""

from __future__ import annotations

from collections.abc import Callable, Collection
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward import config as C
from lakeward.functions import columns as X
from lakeward.operators import keyed as K
from lakeward.operators import layers as L
from lakeward.operators import quality as Q
from lakeward.plans.build import build_layers
from lakeward.plans.oracle import with_ctes
from lakeward.session import scratch_path
from lakeward.sources.fixtures import order_events
from lakeward.sources.layout import read_footers, read_layer, write_layer

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


# ---------------------------------------------------------------- lineage

def oe_layers(spark: SparkSession, sf_dir: str, strategy: str = "window") -> dict[str, DataFrame]:
    """The five layers over the order-event view, lazily (no writes)."""
    b = L.bronze(order_events(spark, sf_dir))
    s = L.silver(b, strategy=strategy)
    lt = L.latest_state(s, strategy=strategy)
    return {
        C.BRONZE: b, C.SILVER: s, C.LATEST: lt,
        C.GOLD_DAILY: L.daily_region_sales(lt),
        C.GOLD_CUSTOMER: L.customer_metrics(lt),
    }


def built_layers(spark: SparkSession, sf_dir: str, wanted: Collection[str] = C.LAYERS) -> dict[str, DataFrame]:
    """The wanted layers, each written once and read back: for queries that read more
    than one, which would otherwise derive the lower layers again for each. Layers that only one of
    these is made from, and that no query reads, aren't written."""
    paths = build_layers(spark, order_events(spark, sf_dir), scratch_path(spark, "warehouse"), wanted=wanted, only_wanted=True)
    return {layer: read_layer(spark, path) for layer, path in paths.items() if layer in wanted}


def as_sql_money(df: DataFrame, *totals: str) -> DataFrame:
    """A small report, worked out once and kept: its totals as the SQL types them where all of them
    fit, else, where the SQL's cast raises, as wide as they were summed."""
    path = scratch_path(df.sparkSession, "totals")
    write_layer(df, path)
    kept = read_layer(df.sparkSession, path)
    wide = reduce(lambda a, b: a | b, [F.col(c).isNotNull() & F.col(c).try_cast(C.MONEY_TYPE).isNull() for c in totals])
    return kept if kept.where(wide).limit(1).count() else kept.withColumns({c: F.col(c).cast(C.MONEY_TYPE) for c in totals})


def _keyed(spark, sf):
    return L.required_keys_present(L.bronze(order_events(spark, sf)))


def _silver(spark, sf):
    return L.silver(L.bronze(order_events(spark, sf)))


def _latest(spark, sf):
    return L.latest_state(_silver(spark, sf))


# ---------------------------------------------------------------- B1-B4, layers

@register("bronze_orders", with_ctes("bronze", "select * from bronze"))
def q_bronze(spark, sf):
    return L.bronze(order_events(spark, sf))


@register("silver_orders", with_ctes("silver", "select * from silver"))
def q_silver(spark, sf):
    return _silver(spark, sf)


@register("silver_latest_order_state", with_ctes("latest", "select * from latest"))
def q_latest(spark, sf):
    return _latest(spark, sf)


@register("gold_daily_region_sales", with_ctes("daily", "select * from daily"))
def q_daily(spark, sf):
    return L.daily_region_sales(_latest(spark, sf))


@register("gold_customer_order_metrics", with_ctes("customer_metrics", "select * from customer_metrics"))
def q_customer(spark, sf):
    return L.customer_metrics(_latest(spark, sf))


# ---------------------------------------------------------------- P: projections, filters

@register("bronze_projection", with_ctes("bronze", "select * from bronze"))
def q_bronze_projection(spark, sf):
    # An additive upstream column is present and must not reach bronze.
    raw = order_events(spark, sf).withColumn(
        "source_system", F.concat(F.lit("erp-"), F.length("event_id") % 3))
    return L.bronze(raw)


@register("project_alias", with_ctes("oe", """
select event_id as event_key, order_id as order_key, lower(region) as region_name,
       lower(status) as order_status, cast(event_ts as date) as event_day from oe"""))
def q_project_alias(spark, sf):
    return order_events(spark, sf).select(
        F.col("event_id").alias("event_key"), F.col("order_id").alias("order_key"),
        X.lower("region").alias("region_name"), X.lower("status").alias("order_status"),
        X.to_date("event_ts").alias("event_day"))


@register("project_star_plus", with_ctes("keyed", "select * from (select *, "
                                         "row_number() over (partition by event_id order by ingestion_ts desc nulls last, "
                                         "event_ts desc nulls last, order_amount desc nulls last, status desc nulls last, "
                                         "customer_id desc nulls last, source_file desc nulls last, order_id desc nulls last, "
                                         "region desc nulls last) as dedupe_rank from keyed) where dedupe_rank = 1"))
def q_star_plus(spark, sf):
    return K.rank_column(_keyed(spark, sf), ["event_id"], L.DEDUPE_ORDER, "dedupe_rank")


@register("filter_required_keys", with_ctes("keyed", "select * from keyed"))
def q_filter_keys(spark, sf):
    return _keyed(spark, sf)


@register("filter_delivered", with_ctes("latest", "select * from latest where status = 'delivered'"))
def q_filter_delivered(spark, sf):
    return L.delivered(_latest(spark, sf))


@register("filter_rank_one", with_ctes("silver", """
select event_id, order_id, customer_id, region, status, order_amount, event_ts, ingestion_ts,
       event_date, ingestion_date, source_file
from (select *, row_number() over (partition by order_id order by event_ts desc nulls last,
      ingestion_ts desc nulls last, event_id desc nulls last) as latest_rank from silver)
where latest_rank = 1"""))
def q_rank_one(spark, sf):
    return K.rank_column(_silver(spark, sf), ["order_id"], L.LATEST_ORDER, "latest_rank").drop("latest_rank")


@register("silver_projection", with_ctes("keyed", """
select event_id, order_id, customer_id, lower(region) as region, lower(status) as status, order_amount,
       event_ts, ingestion_ts, cast(event_ts as date) as event_date, cast(ingestion_ts as date) as ingestion_date,
       source_file from keyed"""))
def q_silver_projection(spark, sf):
    return L.silver_projection(_keyed(spark, sf))


@register("latest_projection", with_ctes("silver", """
select order_id, customer_id, region, status, order_amount, event_ts, ingestion_ts, event_date, ingestion_date
from silver"""))
def q_latest_projection(spark, sf):
    return _silver(spark, sf).select(*C.LATEST_COLUMNS)


@register("case_delivered_value", with_ctes("latest", """
select order_id, case when status = 'delivered' then 1 else 0 end as delivered_flag,
       case when status = 'delivered' then order_amount else cast(0 as decimal(12,2)) end as delivered_amount
from latest"""))
def q_case_value(spark, sf):
    d = X.is_status("status", C.DELIVERED)
    return _latest(spark, sf).select(
        "order_id",
        F.when(d, F.lit(1)).otherwise(F.lit(0)).alias("delivered_flag"),
        F.when(d, F.col("order_amount")).otherwise(X.decimal_literal(0)).alias("delivered_amount"))


@register("cte_chain", with_ctes("silver", "select * from silver"))
def q_cte_chain(spark, sf):
    # The silver model written in the SQL API: CTE + window + filter.
    name = "oe_" + spark.sparkContext.applicationId.replace("-", "_")
    L.bronze(order_events(spark, sf)).createOrReplaceTempView(name)
    return spark.sql(f"""
        with deduped as (
          select *, row_number() over (
              partition by event_id
              order by ingestion_ts desc nulls last, event_ts desc nulls last, order_amount desc nulls last,
                       status desc nulls last, customer_id desc nulls last, source_file desc nulls last,
                       order_id desc nulls last, region desc nulls last) as dedupe_rank
          from {name}
          where event_id is not null and order_id is not null and customer_id is not null
            and region is not null and status is not null)
        select event_id, order_id, customer_id, lower(region) as region, lower(status) as status,
               order_amount, event_ts, ingestion_ts, cast(event_ts as date) as event_date,
               cast(ingestion_ts as date) as ingestion_date, source_file
        from deduped where dedupe_rank = 1""")


# ---------------------------------------------------------------- W: windows

@register("window_dedupe_rank", with_ctes("keyed", """
select * from (
select event_id, ingestion_ts, event_ts, row_number() over (partition by event_id order by ingestion_ts desc nulls last,
       event_ts desc nulls last, order_amount desc nulls last, status desc nulls last, customer_id desc nulls last,
       source_file desc nulls last, order_id desc nulls last, region desc nulls last) as dedupe_rank from keyed)
where dedupe_rank = 1"""))
def q_window_dedupe(spark, sf):
    return K.rank_column(_keyed(spark, sf), ["event_id"], L.DEDUPE_ORDER, "dedupe_rank").select(
        "event_id", "ingestion_ts", "event_ts", "dedupe_rank")


@register("window_latest_rank", with_ctes("silver", """
select * from (
select order_id, event_id, event_ts, ingestion_ts, row_number() over (partition by order_id order by
       event_ts desc nulls last, ingestion_ts desc nulls last, event_id desc nulls last) as latest_rank from silver)
where latest_rank = 1"""))
def q_window_latest(spark, sf):
    return K.rank_column(_silver(spark, sf), ["order_id"], L.LATEST_ORDER, "latest_rank").select(
        "order_id", "event_id", "event_ts", "ingestion_ts", "latest_rank")


@register("dedupe_events", with_ctes("deduped", "select * from deduped"))
def q_dedupe_events(spark, sf):
    return K.keep_latest(_keyed(spark, sf), ["event_id"], L.DEDUPE_ORDER)


@register("latest_order_state", with_ctes("latest", "select * from latest"))
def q_latest_order_state(spark, sf):
    return L.latest_state(_silver(spark, sf))


# ---------------------------------------------------------------- A: aggregations

@register("agg_group_count", with_ctes("latest", "select region, status, count(*) as n_orders from latest group by 1, 2"))
def q_group_count(spark, sf):
    return _latest(spark, sf).groupBy("region", "status").agg(F.count(F.lit(1)).alias("n_orders"))


@register("agg_decimal_sum", with_ctes("latest", """
select region, cast(sum(order_amount) as decimal(12,2)) as total_amount from latest group by 1"""))
def q_decimal_sum(spark, sf):
    return as_sql_money(_latest(spark, sf).groupBy("region").agg(F.sum("order_amount").alias("total_amount")), "total_amount")


@register("agg_conditional_count", with_ctes("latest", """
select customer_id, cast(sum(case when status = 'delivered' then 1 else 0 end) as bigint) as delivered_orders
from latest group by 1"""))
def q_cond_count(spark, sf):
    d = X.is_status("status", C.DELIVERED)
    return _latest(spark, sf).groupBy("customer_id").agg(
        F.sum(F.when(d, F.lit(1)).otherwise(F.lit(0))).cast("bigint").alias("delivered_orders"))


@register("agg_conditional_sum", with_ctes("latest", """
select customer_id, cast(sum(case when status = 'delivered' then order_amount else cast(0 as decimal(12,2)) end)
       as decimal(12,2)) as delivered_revenue from latest group by 1"""))
def q_cond_sum(spark, sf):
    d = X.is_status("status", C.DELIVERED)
    return _latest(spark, sf).groupBy("customer_id").agg(
        F.sum(F.when(d, F.col("order_amount")).otherwise(X.decimal_literal(0))).cast(C.MONEY_TYPE)
        .alias("delivered_revenue"))


@register("agg_max_event_ts", with_ctes("latest", """
select customer_id, max(event_ts) as latest_order_event_ts from latest group by 1"""))
def q_max_ts(spark, sf):
    return _latest(spark, sf).groupBy("customer_id").agg(F.max("event_ts").alias("latest_order_event_ts"))


@register("agg_layer_row_counts", with_ctes(("bronze", "silver", "latest", "customer_metrics"), """
select 'bronze_orders' as layer, count(*) as row_count from bronze
union all select 'silver_orders', count(*) from silver
union all select 'silver_latest_order_state', count(*) from latest
union all select 'gold_customer_order_metrics', count(*) from customer_metrics"""))
def q_layer_counts(spark, sf):
    """Rows of four built layers, from their footers."""
    wanted = (C.BRONZE, C.SILVER, C.LATEST, C.GOLD_CUSTOMER)
    paths = build_layers(spark, order_events(spark, sf), scratch_path(spark, "warehouse"), wanted=wanted)
    return Q.layer_row_counts({layer: read_footers(spark, paths[layer]) for layer in wanted})


@register("agg_layer_last_dates", with_ctes(("latest", "daily"), """
select 'silver_latest_order_state' as layer, max(event_date) as last_date, count(*) as row_count from latest
union all select 'gold_daily_region_sales', max(event_date), count(*) from daily"""))
def q_layer_last_dates(spark, sf):
    """Last day and rows of the two layers with an event date, from their footers."""
    wanted = (C.LATEST, C.GOLD_DAILY)
    paths = build_layers(spark, order_events(spark, sf), scratch_path(spark, "warehouse"), wanted=wanted)
    frames = [read_footers(spark, paths[layer]).agg(F.max("event_date").alias("last_date"), F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(layer).alias("layer"), "last_date", "row_count") for layer in wanted]
    return frames[0].unionByName(frames[1])


@register("agg_filtered_count", with_ctes("latest", """
select count(*) as delivered_orders_from_latest_state from latest where status = 'delivered'"""))
def q_filtered_count(spark, sf):
    return _latest(spark, sf).agg(F.count_if(X.is_status("status", C.DELIVERED))
                                  .alias("delivered_orders_from_latest_state"))


@register("agg_having_duplicates", with_ctes(("bronze", "silver"), """
select 'bronze_orders' as layer, count(*) as duplicate_event_ids
  from (select event_id from bronze group by 1 having count(*) > 1)
union all
select 'silver_orders', count(*) from (select event_id from silver group by 1 having count(*) > 1)"""))
def q_having(spark, sf):
    b = L.bronze(order_events(spark, sf))
    s = L.silver(b)
    return Q.duplicate_key_count(b, ["event_id"]).select(
        F.lit(C.BRONZE).alias("layer"), F.col("duplicates").alias("duplicate_event_ids")
    ).unionByName(Q.duplicate_key_count(s, ["event_id"]).select(
        F.lit(C.SILVER).alias("layer"), F.col("duplicates").alias("duplicate_event_ids")))


@register("agg_count_distinct", with_ctes("latest", """
select count(distinct customer_id) as distinct_customers from latest"""))
def q_count_distinct(spark, sf):
    return _latest(spark, sf).agg(F.count_distinct("customer_id").alias("distinct_customers"))


@register("agg_coalesced_revenue", with_ctes(("latest", "daily", "customer_metrics"), """
select 'silver_latest_order_state' as source,
       coalesce(cast(sum(order_amount) as decimal(12,2)), cast(0 as decimal(12,2))) as delivered_revenue
  from latest where status = 'delivered'
union all select 'gold_daily_region_sales',
       coalesce(cast(sum(delivered_revenue) as decimal(12,2)), cast(0 as decimal(12,2))) from daily
union all select 'gold_customer_order_metrics',
       coalesce(cast(sum(delivered_revenue) as decimal(12,2)), cast(0 as decimal(12,2))) from customer_metrics"""))
def q_coalesced_revenue(spark, sf):
    layers = built_layers(spark, sf)
    a = L.delivered(layers[C.LATEST]).agg(Q.coalesced_sum("order_amount").alias("delivered_revenue"))
    b = layers[C.GOLD_DAILY].agg(Q.coalesced_sum("delivered_revenue").alias("delivered_revenue"))
    c = layers[C.GOLD_CUSTOMER].agg(Q.coalesced_sum("delivered_revenue").alias("delivered_revenue"))
    out = (a.select(F.lit(C.LATEST).alias("source"), "delivered_revenue")
           .unionByName(b.select(F.lit(C.GOLD_DAILY).alias("source"), "delivered_revenue"))
           .unionByName(c.select(F.lit(C.GOLD_CUSTOMER).alias("source"), "delivered_revenue")))
    return as_sql_money(out, "delivered_revenue")


@register("agg_coalesced_orders", with_ctes("customer_metrics", """
select cast(coalesce(sum(delivered_orders), 0) as bigint) as delivered_orders_from_gold_customer
from customer_metrics"""))
def q_coalesced_orders(spark, sf):
    return L.customer_metrics(_latest(spark, sf)).agg(
        X.coalesce_zero(F.sum("delivered_orders"), "bigint").alias("delivered_orders_from_gold_customer"))


WATERMARK_COLS = ("source_max_ingestion_ts", "source_max_event_ts", "source_max_event_date",
                  "bronze_max_ingestion_ts", "silver_max_ingestion_ts", "latest_state_max_ingestion_ts",
                  "customer_metrics_max_event_ts", "gold_daily_max_event_date")


@register("agg_watermarks", with_ctes("metrics", "select " + ", ".join(WATERMARK_COLS) + " from metrics"))
def q_watermarks(spark, sf):
    return Q.metrics(built_layers(spark, sf), only=WATERMARK_COLS).select(*WATERMARK_COLS)


# ---------------------------------------------------------------- O: sorts

@register("sort_daily_sales", with_ctes("daily", "select * from daily order by event_date, region"))
def q_sort_daily(spark, sf):
    return L.sort_daily_sales(L.daily_region_sales(_latest(spark, sf)))


@register("sort_customer_metrics", with_ctes("customer_metrics", "select * from customer_metrics order by customer_id"))
def q_sort_customer(spark, sf):
    return L.sort_customer_metrics(L.customer_metrics(_latest(spark, sf)))


@register("group_by_ordinal", with_ctes("daily", "select * from daily"))
def q_group_ordinal(spark, sf):
    name = "latest_" + spark.sparkContext.applicationId.replace("-", "_")
    _latest(spark, sf).createOrReplaceTempView(name)
    return spark.sql(f"""
        select event_date, region, count(*) as delivered_orders,
               cast(sum(order_amount) as decimal(12, 2)) as delivered_revenue
        from {name} where status = 'delivered' group by 1, 2""")


# ---------------------------------------------------------------- F: scalar functions

@register("fn_as_decimal_money", with_ctes("oe", """
select event_id, cast(order_amount as varchar) as amount_text,
       cast(cast(order_amount as varchar) as decimal(12,2)) as order_amount from oe"""))
def q_fn_money(spark, sf):
    oe = order_events(spark, sf).select("event_id", F.col("order_amount").cast("string").alias("amount_text"))
    return oe.select("event_id", "amount_text", X.as_decimal_money("amount_text").alias("order_amount"))


@register("fn_to_timestamp", with_ctes("oe", """
select event_id,
       case minute(ingestion_ts) % 3
         when 0 then strftime(event_ts, '%Y-%m-%d %H:%M:%S')
         when 1 then strftime(event_ts, '%Y-%m-%dT%H:%M:%S')
         else strftime(event_ts, '%Y-%m-%dT%H:%M:%S') || '+02:00' end as ts_text,
       case when minute(ingestion_ts) % 3 = 2 then event_ts - interval 2 hour else event_ts end as parsed_ts
from oe"""))
def q_fn_ts(spark, sf):
    oe = order_events(spark, sf)
    style = F.minute("ingestion_ts") % 3
    text = (F.when(style == 0, F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss"))
            .when(style == 1, F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss"))
            .otherwise(F.concat(F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))))
    return oe.select("event_id", text.alias("ts_text")).select(
        "event_id", "ts_text", X.to_wall_clock("ts_text").alias("parsed_ts"))


@register("fn_to_date", with_ctes("oe", """
select event_id, cast(event_ts as date) as event_date, cast(ingestion_ts as date) as ingestion_date from oe"""))
def q_fn_date(spark, sf):
    return order_events(spark, sf).select(
        "event_id", X.to_date("event_ts").alias("event_date"), X.to_date("ingestion_ts").alias("ingestion_date"))


@register("fn_lower", with_ctes("oe", "select event_id, lower(region) as region, lower(status) as status from oe"))
def q_fn_lower(spark, sf):
    return order_events(spark, sf).select("event_id", X.lower("region").alias("region"),
                                          X.lower("status").alias("status"))


@register("fn_coalesce_zero", with_ctes("latest", """
select customer_id, coalesce(cast(sum(case when status = 'delivered' then order_amount end) as decimal(12,2)),
       cast(0 as decimal(12,2))) as delivered_revenue from latest group by 1"""))
def q_fn_coalesce(spark, sf):
    d = X.is_status("status", C.DELIVERED)
    return _latest(spark, sf).groupBy("customer_id").agg(
        X.coalesce_zero(F.sum(F.when(d, F.col("order_amount"))).cast(C.MONEY_TYPE)).alias("delivered_revenue"))


@register("fn_decimal_literal", with_ctes("latest", """
select order_id, cast(0 as decimal(12,2)) as zero_amount,
       case when status = 'cancelled' then cast(0 as decimal(12,2)) else order_amount end as billable_amount
from latest"""))
def q_fn_literal(spark, sf):
    return _latest(spark, sf).select(
        "order_id", X.decimal_literal(0).alias("zero_amount"),
        F.when(F.col("status") == "cancelled", X.decimal_literal(0)).otherwise(F.col("order_amount"))
        .alias("billable_amount"))


@register("fn_lag_minutes", with_ctes("silver", """
select event_id,
       cast(floor(epoch(ingestion_ts - event_ts) / 60) as bigint) as lag_minutes,
       cast(floor(epoch((event_ts + interval 30 second) - ingestion_ts) / 60) as bigint) as lag_minutes_back
from silver"""))
def q_fn_lag_minutes(spark, sf):
    s = _silver(spark, sf)
    return s.select(
        "event_id",
        X.lag_minutes("ingestion_ts", "event_ts").alias("lag_minutes"),
        X.lag_minutes(F.col("event_ts") + F.expr("interval 30 seconds"), F.col("ingestion_ts"))
        .alias("lag_minutes_back"))


@register("fn_lag_days", with_ctes("silver", """
select event_id, cast(ingestion_date - event_date as bigint) as lag_days from silver"""))
def q_fn_lag_days(spark, sf):
    return _silver(spark, sf).select("event_id", X.lag_days("ingestion_date", "event_date").alias("lag_days"))


@register("fn_iso_timestamp", with_ctes("oe", """
select event_id,
       coalesce(strftime(ingestion_ts, '%Y-%m-%d %H:%M:%S'), '') as ingestion_text,
       strftime(ingestion_ts + to_microseconds(minute(ingestion_ts) * 1234), '%Y-%m-%d %H:%M:%S.%f') as fine_text,
       coalesce(strftime(case when customer_id is null then null else event_ts end, '%Y-%m-%d %H:%M:%S'), '')
         as nullable_text
from oe where minute(ingestion_ts) > 0
union all
select event_id,
       coalesce(strftime(ingestion_ts, '%Y-%m-%d %H:%M:%S'), ''),
       strftime(ingestion_ts, '%Y-%m-%d %H:%M:%S'),
       coalesce(strftime(case when customer_id is null then null else event_ts end, '%Y-%m-%d %H:%M:%S'), '')
from oe where minute(ingestion_ts) = 0"""))
def q_fn_iso_ts(spark, sf):
    oe = order_events(spark, sf)
    fine = F.col("ingestion_ts") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (F.minute("ingestion_ts") * 1234).cast("decimal(18,6)") / 1_000_000)
    return oe.select(
        "event_id",
        X.iso_timestamp("ingestion_ts").alias("ingestion_text"),
        X.iso_timestamp(fine).alias("fine_text"),
        X.iso_timestamp(F.when(F.col("customer_id").isNotNull(), F.col("event_ts"))).alias("nullable_text"))


@register("fn_iso_date", with_ctes("oe", """
select event_id, coalesce(strftime(cast(event_ts as date), '%Y-%m-%d'), '') as event_day,
       coalesce(strftime(case when customer_id is null then null else cast(event_ts as date) end, '%Y-%m-%d'), '')
         as nullable_day
from oe"""))
def q_fn_iso_date(spark, sf):
    oe = order_events(spark, sf)
    return oe.select("event_id", X.iso_date(X.to_date("event_ts")).alias("event_day"),
                     X.iso_date(F.when(F.col("customer_id").isNotNull(), X.to_date("event_ts")))
                     .alias("nullable_day"))


@register("fn_decimal_text", with_ctes("daily", """
select event_date, region, cast(delivered_revenue as varchar) as revenue_text from daily"""))
def q_fn_decimal_text(spark, sf):
    return L.daily_region_sales(_latest(spark, sf)).select(
        "event_date", "region", X.decimal_text("delivered_revenue").alias("revenue_text"))
