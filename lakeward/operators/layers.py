"""The five medallion layers as pure ``DataFrame -> DataFrame`` functions.

No I/O here: ``lakeward.plans.build`` writes each layer and reads it back
before the next one, which cuts lineage and lets the Parquet scan prune and
push filters for the following step.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward import config as C
from lakeward.config import DEFAULT, Settings
from lakeward.functions import columns as X
from lakeward.operators.keyed import keep_latest

# Dedupe order: latest delivery first, then a total tie-breaker over the
# remaining projected columns, so duplicates that tie on time resolve the
# same way on every engine and every run.
DEDUPE_ORDER: tuple[str, ...] = (
    "ingestion_ts", "event_ts",
    "order_amount", "status", "customer_id", "source_file", "order_id", "region",
)
# Latest-state order: newest business time wins; a late-arriving older event
# can never displace it. event_id is unique after dedupe, so the order is total.
LATEST_ORDER: tuple[str, ...] = ("event_ts", "ingestion_ts", "event_id")


def _timestamp(raw: DataFrame, name: str):
    """Text goes through the offset-aware parse; typed input is only cast."""
    if isinstance(raw.schema[name].dataType, T.StringType):
        return X.to_wall_clock(name)
    return F.col(name).cast("timestamp_ntz")


def bronze(raw: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Contract columns only, fixed order, typed. Additive columns are dropped."""
    return raw.select(
        F.col("source_file"),
        F.col("event_id"),
        F.col("order_id"),
        F.col("customer_id"),
        F.col("region"),
        F.col("status"),
        X.as_decimal_money("order_amount", settings.money_type).alias("order_amount"),
        _timestamp(raw, "event_ts").alias("event_ts"),
        _timestamp(raw, "ingestion_ts").alias("ingestion_ts"),
    )


def required_keys_present(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Rows whose key columns are all non-null. Written as a conjunction of
    ``IS NOT NULL`` (not ``dropna``) so it reaches the Parquet scan as
    pushed filters."""
    cond = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in settings.required_keys])
    return df.where(cond)


def silver_projection(deduped: DataFrame) -> DataFrame:
    return deduped.select(
        "event_id",
        "order_id",
        "customer_id",
        X.lower("region").alias("region"),
        X.lower("status").alias("status"),
        "order_amount",
        "event_ts",
        "ingestion_ts",
        X.to_date("event_ts").alias("event_date"),
        X.to_date("ingestion_ts").alias("ingestion_date"),
        "source_file",
    )


def silver(bronze_df: DataFrame, settings: Settings = DEFAULT, strategy: str = "window") -> DataFrame:
    """Standardised events, one row per ``event_id`` (the last delivery).

    The NOT NULL filter runs before ranking, so a newer row with a missing key
    cannot displace an older good one."""
    keyed = required_keys_present(bronze_df.select(*C.BRONZE_COLUMNS), settings)
    deduped = keep_latest(keyed, ["event_id"], DEDUPE_ORDER, strategy=strategy)
    return silver_projection(deduped)


def latest_state(silver_df: DataFrame, strategy: str = "window") -> DataFrame:
    """One row per ``order_id``: its newest event by business time."""
    top = keep_latest(
        silver_df.select(*C.SILVER_COLUMNS), ["order_id"], LATEST_ORDER, strategy=strategy
    )
    return top.select(*C.LATEST_COLUMNS)


def delivered(df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    return df.where(X.is_status("status", settings.delivered))


def daily_region_sales(latest_df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Delivered orders and revenue per (event_date, region).

    Partial aggregation runs before the shuffle; the output is small
    (days x regions) and written unsorted — see ``sort_daily_sales``."""
    return (
        delivered(latest_df, settings)
        .groupBy("event_date", "region")
        .agg(
            F.count(F.lit(1)).alias("delivered_orders"),
            F.sum("order_amount").cast(settings.money_total_type).alias("delivered_revenue"),
        )
    )


def customer_metrics(latest_df: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Per customer: all latest states, delivered count and revenue, newest event."""
    is_delivered = X.is_status("status", settings.delivered)
    return latest_df.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("active_orders"),
        F.sum(F.when(is_delivered, F.lit(1)).otherwise(F.lit(0))).cast("bigint").alias("delivered_orders"),
        F.sum(
            F.when(is_delivered, F.col("order_amount")).otherwise(X.decimal_literal(0, settings.money_type))
        ).cast(settings.money_total_type).alias("delivered_revenue"),
        F.max("event_ts").alias("latest_order_event_ts"),
    )


def sort_daily_sales(daily: DataFrame) -> DataFrame:
    """Presentation order (event_date, region), NULLs last as in the reference."""
    return daily.orderBy(F.col("event_date").asc_nulls_last(), F.col("region").asc_nulls_last())


def sort_customer_metrics(customers: DataFrame) -> DataFrame:
    return customers.orderBy(F.col("customer_id").asc_nulls_last())
