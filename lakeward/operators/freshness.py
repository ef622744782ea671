"""Per-layer freshness against service levels.

Input is the one-row metrics frame of ``quality.metrics`` (it already holds
every watermark); output is the five-row freshness table in report order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.config import DEFAULT, FRESHNESS_ORDER, Settings
from lakeward.functions import columns as X

# layer -> (source watermark, layer watermark, unit)
WATERMARKS: dict[str, tuple[str, str, str]] = {
    "bronze_orders": ("source_max_ingestion_ts", "bronze_max_ingestion_ts", "minutes"),
    "silver_orders": ("source_max_ingestion_ts", "silver_max_ingestion_ts", "minutes"),
    "silver_latest_order_state": ("source_max_ingestion_ts", "latest_state_max_ingestion_ts", "minutes"),
    "gold_customer_order_metrics": ("source_max_event_ts", "customer_metrics_max_event_ts", "minutes"),
    "gold_daily_region_sales": ("source_max_event_date", "gold_daily_max_event_date", "days"),
}


def _record(position: int, layer: str, settings: Settings):
    source, mark, unit = WATERMARKS[layer]
    src, lay = F.col(source), F.col(mark)
    if unit == "minutes":
        src_text, lay_text = X.iso_timestamp(src), X.iso_timestamp(lay)
        lag_m, lag_d = X.lag_minutes(src, lay), F.lit(None).cast("bigint")
    else:
        src_text, lay_text = X.iso_date(src), X.iso_date(lay)
        lag_m, lag_d = F.lit(None).cast("bigint"), X.lag_days(src, lay)
    sla_m = settings.sla_minutes.get(layer)
    sla_d = settings.sla_days.get(layer)
    sla_m_col = F.lit(sla_m).cast("bigint")
    sla_d_col = F.lit(sla_d).cast("bigint")
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(layer).alias("layer"),
        src_text.alias("source_timestamp"),
        lay_text.alias("layer_timestamp"),
        lag_m.alias("lag_minutes"),
        lag_d.alias("lag_days"),
        sla_m_col.alias("sla_minutes"),
        sla_d_col.alias("sla_days"),
        X.sla_status(lag_m, lag_d, sla_m_col, sla_d_col).alias("status"),
    )


def layer_freshness(metrics_row: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Five rows: position, layer, source_timestamp, layer_timestamp,
    lag_minutes, lag_days, sla_minutes, sla_days, status."""
    recs = [_record(i + 1, layer, settings) for i, layer in enumerate(FRESHNESS_ORDER)]
    return metrics_row.select(F.inline(F.array(*recs)))


def freshness_gate(freshness: DataFrame) -> DataFrame:
    """One row: passed, breached layers (sorted, comma-joined), message."""
    breached = F.sort_array(F.collect_list(F.when(F.col("status") == "breach", F.col("layer"))))
    return freshness.agg(breached.alias("_b")).select(
        (F.size("_b") == 0).alias("passed"),
        F.array_join("_b", ", ").alias("breached_layers"),
        F.when(F.size("_b") > 0, F.concat(F.lit("freshness SLA violated for layers: "),
                                          F.array_join("_b", ", "))).alias("message"),
    )
