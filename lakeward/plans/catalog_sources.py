"""Registered queries that go through files: CSV batches, Parquet layers,
the schema contract and the full build/validate run.

Inputs are written from the driver's tables to a fresh folder under the
cluster's checkpoint directory first (``lakeward.session.scratch_path``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward import config as C
from lakeward.config import Settings
from lakeward.functions import columns as X
from lakeward.operators import contract as CT
from lakeward.operators import freshness as FR
from lakeward.operators import layers as L
from lakeward.plans import validate as V
from lakeward.plans.build import build_all, build_layers
from lakeward.plans.catalog import _latest, _silver, as_sql_money, built_layers, register
from lakeward.plans.oracle import with_ctes
from lakeward.session import scratch_path
from lakeward.sources import batches as B
from lakeward.sources.fixtures import STAGED, order_events, write_csv_batches
from lakeward.sources.layout import (BUCKET_KEY, current_buckets, current_paths, drop_folder, layer_exists, read_bucketed, read_layer, read_layers,
                                     relative_paths, write_layer)


def _csv(spark: SparkSession, sf: str, variant: str = "clean") -> str:
    root = scratch_path(spark, f"csv-{variant.replace(' ', '-')}")
    glob = write_csv_batches(spark, sf, root, variant)
    drop_folder(spark, f"{root}/{STAGED}")
    return glob


def _view(spark: SparkSession, df: DataFrame, base: str) -> str:
    name = f"{base}_{spark.sparkContext.applicationId}".replace("-", "_")
    df.createOrReplaceTempView(name)
    return name


# ------------------------------------------------------------------ oracle CTEs

TEXT_CTE = """
select source_file || '.csv' as source_batch, event_id, order_id, customer_id, region, status,
       cast(order_amount as varchar) as order_amount,
       strftime(event_ts, '%Y-%m-%d %H:%M:%S') as event_ts,
       strftime(ingestion_ts, '%Y-%m-%d %H:%M:%S') as ingestion_ts,
       case when source_file = 'batch_2' then concat('erp-', length(event_id) % 3) end as source_system
from oe"""

BREAKING_CELLS = """
select source_batch as file_name, 'event_id' as column_name, event_id as value from csv_text
union all select source_batch, 'order_id', order_id from csv_text
union all select source_batch, 'customer_id', customer_id from csv_text
union all select source_batch, 'region', region from csv_text
union all select source_batch, case when source_batch = 'batch_3.csv' then 'state' else 'status' end, status from csv_text
union all select source_batch, 'order_amount',
       case when source_batch = 'batch_3.csv' and minute(cast(ingestion_ts as timestamp)) % 7 = 3
            then 'not-a-decimal' else order_amount end from csv_text
union all select source_batch, 'event_ts', event_ts from csv_text
union all select source_batch, 'ingestion_ts', ingestion_ts from csv_text
union all select source_batch, 'source_system', source_system from csv_text where source_batch = 'batch_2.csv'"""

CLEAN_CELLS = "\nunion all ".join(
    f"select source_batch as file_name, '{c}' as column_name, {c} as value from csv_text" for c in C.RAW_COLUMNS
) + "\nunion all select source_batch, 'source_system', source_system from csv_text where source_batch = 'batch_2.csv'"

# Class bits: BOOLEAN 1, BIGINT 2, HUGEINT 4, DOUBLE 8, TIME 16, DATE 32, TIMESTAMP 64, TIMESTAMPTZ 128, VARCHAR 256
OBSERVED_CTE = """
select file_name, column_name as "column",
  case when m = 0 or (m & 256) <> 0 then 'VARCHAR'
       when m = 1 then 'BOOLEAN' when m = 2 then 'BIGINT' when m = 4 then 'HUGEINT' when m = 8 then 'DOUBLE'
       when m = 16 then 'TIME' when m = 32 then 'DATE' when m = 64 then 'TIMESTAMP'
       when m = 128 then 'TIMESTAMP WITH TIME ZONE'
       when (m & ~6) = 0 then 'HUGEINT' when (m & ~14) = 0 then 'DOUBLE'
       when m = 192 then 'TIMESTAMP WITH TIME ZONE' else 'VARCHAR' end as observed_type
from (
  select file_name, column_name, coalesce(bit_or(bit), 0) as m from (
    select file_name, column_name,
      case when value is null then null
           when regexp_full_match(trim(value), '(?i)(true|false)') then 1
           when regexp_full_match(trim(value), '-?(0|[1-9][0-9]*)') then
                case when try_cast(trim(value) as bigint) is not null then 2 else 4 end
           when regexp_full_match(trim(value), '-?(([0-9]+\\.[0-9]*|\\.[0-9]+)([eE][-+]?[0-9]+)?|[0-9]+[eE][-+]?[0-9]+)|NaN') then 8
           when regexp_full_match(trim(value), '([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]') then 16
           when regexp_full_match(trim(value), '[0-9]{4}-[0-9]{2}-[0-9]{2}')
                and try_cast(trim(value) as date) is not null then 32
           when regexp_full_match(trim(value), '[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\\.[0-9]+)?)?')
                and try_cast(trim(value) as timestamp) is not null then 64
           when regexp_full_match(trim(value),
                '[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\\.[0-9]+)?)?(Z|[+-][0-9]{2}(:?[0-9]{2})?)')
                and try_cast(trim(value) as timestamptz) is not null then 128
           else 256 end as bit
    from cells) group by 1, 2)"""

CONTRACT_CTE = """
select * from (values
  ('event_id', 'VARCHAR', 0), ('order_id', 'VARCHAR', 1), ('customer_id', 'VARCHAR', 2),
  ('region', 'VARCHAR', 3), ('status', 'VARCHAR', 4),
  ('order_amount', 'BIGINT, DECIMAL, DOUBLE, FLOAT, HUGEINT, INTEGER', 5),
  ('event_ts', 'DATE, TIMESTAMP, TIMESTAMP WITH TIME ZONE', 6),
  ('ingestion_ts', 'DATE, TIMESTAMP, TIMESTAMP WITH TIME ZONE', 7)) as t(column_name, expected, ord)"""

ISSUES_CTE = """
select f.file_name, c.column_name as "column", 'missing_required_column' as issue, c.expected,
       'missing' as observed, 0 as kind, 0 as rnk
from (select distinct file_name from observed) f cross join contract c
where not exists (select 1 from observed o where o.file_name = f.file_name and o."column" = c.column_name)
union all
select o.file_name, o."column", 'incompatible_column_type', c.expected, o.observed_type, 1, c.ord
from observed o join contract c on o."column" = c.column_name
where not list_contains(string_split(c.expected, ', '), o.observed_type)"""


def contract_sql(body: str, cells: str = BREAKING_CELLS) -> str:
    return with_ctes("oe", body, extra={"csv_text": TEXT_CTE, "cells": cells, "observed": OBSERVED_CTE,
                                        "contract": CONTRACT_CTE, "issues": ISSUES_CTE})


# ------------------------------------------------------------------ S: sources

@register("scan_csv_batches", with_ctes("oe", "select * from csv_text", extra={"csv_text": TEXT_CTE}))
def q_scan_csv(spark, sf):
    glob = _csv(spark, sf)
    raw = B.read_batches(spark, glob, with_label=True)
    return raw.select("source_batch", *C.RAW_COLUMNS, "source_system")


@register("source_file_lineage", with_ctes("oe", """
select source_file || '.csv' as source_batch, count(*) as row_count from oe group by 1"""))
def q_lineage(spark, sf):
    glob = _csv(spark, sf)
    bronze = L.bronze(B.read_batches(spark, glob))
    return bronze.groupBy(B.batch_label(F.col("source_file")).alias("source_batch")).agg(
        F.count(F.lit(1)).alias("row_count"))


@register("parquet_sink_roundtrip", with_ctes("silver", "select * from silver"))
def q_parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "silver")
    write_layer(_silver(spark, sf), path)
    return read_layer(spark, path)


@register("parquet_layer_scan", with_ctes("bronze", "select * from bronze"))
def q_parquet_scan(spark, sf):
    path = scratch_path(spark, "bronze")
    write_layer(L.bronze(order_events(spark, sf)), path)
    view = f"bronze_orders_{spark.sparkContext.applicationId}".replace("-", "_")
    read_layer(spark, path, view)
    return spark.table(view)


@register("layer_as_table", with_ctes("daily", "select * from daily"))
def q_layer_as_table(spark, sf):
    path = scratch_path(spark, "latest")
    write_layer(_latest(spark, sf), path)
    view = f"latest_state_{spark.sparkContext.applicationId}".replace("-", "_")
    read_layer(spark, path, view)
    return spark.sql(f"""
        select event_date, region, count(*) as delivered_orders,
               cast(sum(order_amount) as decimal(12, 2)) as delivered_revenue
        from {view} where status = 'delivered' group by 1, 2""")


@register("source_table_ref", with_ctes("bronze", "select * from bronze"))
def q_source_ref(spark, sf):
    name = _view(spark, order_events(spark, sf), "raw_order_events")
    return L.bronze(spark.table(name))


@register("layer_ref_chain", with_ctes("customer_metrics", "select * from customer_metrics"))
def q_ref_chain(spark, sf):
    bronze = _view(spark, L.bronze(order_events(spark, sf)), "ref_bronze")
    silver = _view(spark, L.silver(spark.table(bronze)), "ref_silver")
    latest = _view(spark, L.latest_state(spark.table(silver)), "ref_latest")
    return L.customer_metrics(spark.table(latest))


LAYOUT_SQL = """
select 'bronze_orders' as layer, 'bronze/bronze_orders.parquet' as relative_path, (select count(*) from bronze) as row_count
union all select 'silver_orders', 'silver/silver_orders.parquet', (select count(*) from silver)
union all select 'silver_latest_order_state', 'silver/silver_latest_order_state.parquet', (select count(*) from latest)
union all select 'gold_daily_region_sales', 'gold/gold_daily_region_sales.parquet', (select count(*) from daily)
union all select 'gold_customer_order_metrics', 'gold/gold_customer_order_metrics.parquet',
                 (select count(*) from customer_metrics)"""


def _layout_counts(spark: SparkSession, root: str, present: set[str] | None = None) -> DataFrame:
    paths = current_paths(spark, root)
    rel = relative_paths(root, paths)
    frames = []
    for layer in C.LAYERS:
        if present is None or layer in present:
            cnt = read_layer(spark, paths[layer]).agg(F.count(F.lit(1)).alias("row_count"))
        else:
            cnt = spark.range(1).select(F.lit(None).cast("bigint").alias("row_count"))
        frames.append(cnt.select(F.lit(layer).alias("layer"), F.lit(rel[layer]).alias("relative_path"), "row_count"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@register("layer_layout", with_ctes(("bronze", "silver", "latest", "daily", "customer_metrics"), LAYOUT_SQL))
def q_layer_layout(spark, sf):
    root = scratch_path(spark, "warehouse")
    build_layers(spark, order_events(spark, sf), root)
    return _layout_counts(spark, root)


@register("layer_summary", with_ctes(("bronze", "silver", "latest", "daily", "customer_metrics"),
                                     "select layer, relative_path, row_count > 0 as has_rows from (" + LAYOUT_SQL + ")"))
def q_layer_summary(spark, sf):
    root = scratch_path(spark, "warehouse")
    build_layers(spark, order_events(spark, sf), root)
    return _layout_counts(spark, root).select("layer", "relative_path", (F.col("row_count") > 0).alias("has_rows"))


@register("missing_layer_check", with_ctes(("bronze", "silver", "latest"), """
select 'bronze_orders' as layer, true as layer_exists, (select count(*) from bronze) as row_count
union all select 'silver_orders', true, (select count(*) from silver)
union all select 'silver_latest_order_state', true, (select count(*) from latest)
union all select 'gold_daily_region_sales', false, cast(null as bigint)
union all select 'gold_customer_order_metrics', false, cast(null as bigint)"""))
def q_missing_layers(spark, sf):
    """Only bronze, silver and latest are built; the gate sees the golds missing."""
    root = scratch_path(spark, "warehouse-partial")
    build_layers(spark, order_events(spark, sf), root, wanted=(C.LATEST,))
    paths = current_paths(spark, root)
    present = {layer for layer in C.LAYERS if layer_exists(spark, paths[layer])}
    counts = _layout_counts(spark, root, present)
    return counts.select("layer", F.col("layer").isin(*sorted(present)).alias("layer_exists"), "row_count")


@register("bucketed_silver_keys", with_ctes("silver", """
select count(*) as silver_rows, count(distinct event_id) as keys,
       (select count(*) from (select event_id from silver group by 1 having count(*) > 1)) as duplicate_keys
from silver"""))
def q_bucketed_silver(spark, sf):
    """Silver written in buckets of its key: rows, keys and duplicate keys from one scan without a shuffle of rows."""
    root = scratch_path(spark, "warehouse-bucketed")
    build_layers(spark, order_events(spark, sf), root, Settings(silver_buckets=8), wanted=(C.SILVER,))
    silver = read_bucketed(spark, current_paths(spark, root)[C.SILVER], BUCKET_KEY, current_buckets(spark, root))
    keys = silver.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))
    return keys.agg(F.sum("n").alias("silver_rows"), F.count(F.lit(1)).alias("keys"), F.count_if(F.col("n") > 1).alias("duplicate_keys"))


# ------------------------------------------------------------------ C: contract

def _profile(spark, sf):
    glob = _csv(spark, sf, "breaking")
    return CT.profile(spark, glob)


@register("infer_file_schema", contract_sql('select file_name, "column", observed_type from observed'))
def q_infer(spark, sf):
    return CT.observed_types(spark, _csv(spark, sf, "breaking")).select("file_name", "column", "observed_type")


@register("contract_missing_columns", contract_sql("""
select file_name, "column", issue, expected, observed from issues where kind = 0"""))
def q_missing_cols(spark, sf):
    return CT.missing_columns(_profile(spark, sf))


@register("contract_type_mismatch", contract_sql("""
select file_name, "column", issue, expected, observed from issues where kind = 1"""))
def q_type_mismatch(spark, sf):
    return CT.type_mismatches(_profile(spark, sf))


@register("contract_additive_columns", contract_sql("""
select file_name, coalesce(string_agg(case when "column" not in (select column_name from contract) then "column" end,
       ',' order by "column"), '') as additive_columns
from observed group by 1"""))
def q_additive(spark, sf):
    return CT.additive_columns(_profile(spark, sf)).select(
        "file_name", F.array_join("additive_columns", ",").alias("additive_columns"))


@register("contract_files_checked", contract_sql("select count(distinct file_name) as files_checked from observed"))
def q_files_checked(spark, sf):
    return CT.files_checked(_profile(spark, sf))


@register("contract_issue_report", contract_sql("""
select file_name, "column", issue, expected, observed from issues order by file_name, kind, rnk, "column" """))
def q_issue_report(spark, sf):
    return CT.ordered_issues(_profile(spark, sf))


GATE_SQL = """
select count(*) = 0 as passed, count(*) as issue_count,
       coalesce(string_agg(file_name || ':' || "column" || ':' || issue || ' expected ' || expected || ' observed '
                           || observed, '; ' order by file_name, kind, rnk, "column"), '') as detail
from issues"""


@register("contract_gate", contract_sql(GATE_SQL))
def q_gate(spark, sf):
    return CT.gate_row(_profile(spark, sf))


@register("contract_gate_clean", contract_sql(GATE_SQL, CLEAN_CELLS))
def q_gate_clean(spark, sf):
    """The gate on the clean batches (reordered and additive columns only): passes."""
    glob = _csv(spark, sf, "clean")
    return CT.gate_row(CT.profile(spark, glob))


@register("fn_type_name", contract_sql("""
select file_name, "column", regexp_replace(upper(trim(observed_type)), '^DECIMAL *[(].*[)]$', 'DECIMAL') as type_name
from observed""", CLEAN_CELLS))
def q_type_name(spark, sf):
    """Normalised type names of the columns of the clean batches."""
    seen = CT.observed_types(spark, _csv(spark, sf, "clean"))
    return seen.select("file_name", "column", X.type_name("observed_type").alias("type_name"))


# ------------------------------------------------------------------ B / V: build and validate

BUILD_COUNTS_SQL = """
select 'bronze_orders' as layer, count(*) as row_count from bronze
union all select 'silver_orders', count(*) from silver
union all select 'silver_latest_order_state', count(*) from latest
union all select 'gold_daily_region_sales', count(*) from daily
union all select 'gold_customer_order_metrics', count(*) from customer_metrics"""


@register("build_all_row_counts", with_ctes(("bronze", "silver", "latest", "daily", "customer_metrics"),
                                            BUILD_COUNTS_SQL))
def q_build_all(spark, sf):
    glob = _csv(spark, sf)
    root = scratch_path(spark, "warehouse")
    build_all(spark, glob, root)
    layers = read_layers(spark, root)
    frames = [layers[n].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("layer"), "row_count")
              for n in C.LAYERS]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@register("csv_quoted_line_breaks", with_ctes("oe", """
select source_file || '.csv' as source_batch, event_id, order_amount,
       case when source_file = 'batch_1' and length(event_id) % 2 = 0 then customer_id || chr(10) || 'second line' else customer_id end as customer_id
from oe"""))
def q_line_breaks(spark, sf):
    """A build over batches of which one has quoted line breaks: its bronze rows."""
    glob = _csv(spark, sf, "line breaks")
    root = scratch_path(spark, "warehouse-line-breaks")
    build_all(spark, glob, root)
    bronze = read_layers(spark, root)[C.BRONZE]
    return bronze.select(B.batch_label(F.col("source_file")).alias("source_batch"), "event_id", "order_amount", "customer_id")


SUMMARY_CTES = {"csv_text": TEXT_CTE, "adds": """
select source_batch, max(case when source_system is not null then 'source_system' end) as added
from csv_text group by 1"""}

SUMMARY_FLAT_SQL = """
select (select count(*) from adds) as schema_files_checked,
       (select coalesce(string_agg(source_batch || ':' || added, ',' order by source_batch), '')
        from adds where added is not null) as schema_additive_columns,
       bronze_rows, silver_rows, duplicate_event_ids, latest_state_rows, gold_customer_metric_rows,
       delivered_revenue_from_silver, delivered_revenue_from_gold_daily, delivered_revenue_from_gold_customer,
       delivered_orders_from_latest_state, delivered_orders_from_gold_customer,
       (select string_agg(layer || ':' || status, ',' order by position) from freshness_status) as layer_freshness
from metrics"""

SUMMARY_JSON_SQL = """
select '{"schema_files_checked":' || (select count(*) from adds)
  || ',"schema_additive_columns":{' || (select string_agg('"' || source_batch || '":['
       || coalesce('"' || added || '"', '') || ']', ',' order by source_batch) from adds) || '}'
""" + "".join(
    f"  || ',\"{k}\":" + (f"\"' || {k} || '\"'" if k.startswith("delivered_revenue") else f"' || {k}") + "\n"
    for k in V.SUMMARY_SCALARS[1:]) + """
  || ',"layer_freshness":[' || (select string_agg('{"layer":"' || layer || '","source_timestamp":"' || source_timestamp
       || '","layer_timestamp":"' || layer_timestamp
       || '","lag_minutes":' || coalesce(cast(lag_minutes as varchar), 'null')
       || ',"lag_days":' || coalesce(cast(lag_days as varchar), 'null')
       || ',"sla_minutes":' || coalesce(cast(sla_minutes as varchar), 'null')
       || ',"sla_days":' || coalesce(cast(sla_days as varchar), 'null')
       || ',"status":"' || status || '"}', ',' order by position) from freshness_status) || ']}' as validation
from metrics"""


def flatten_summary(summary_df: DataFrame) -> DataFrame:
    adds = F.transform(
        F.filter(F.sort_array(F.map_entries("schema_additive_columns")), lambda e: F.size(e["value"]) > 0),
        lambda e: F.concat(e["key"], F.lit(":"), F.array_join(e["value"], "|")))
    fresh = F.transform("layer_freshness", lambda f: F.concat(f["layer"], F.lit(":"), f["status"]))
    flat = summary_df.select(
        "schema_files_checked", F.array_join(adds, ",").alias("schema_additive_columns"),
        *V.SUMMARY_SCALARS[1:], F.array_join(fresh, ",").alias("layer_freshness"))
    return as_sql_money(flat, *[k for k in V.SUMMARY_SCALARS if k.startswith("delivered_revenue")])


def _summary(spark, sf):
    glob = _csv(spark, sf)
    profiles = CT.profile(spark, glob)
    m = V.metrics_row(spark, built_layers(spark, sf))
    return V.summary_from_frames(m, FR.layer_freshness(m), CT.files_checked(profiles),
                                 CT.additive_columns(profiles))


@register("validation_summary", with_ctes(("metrics", "freshness_status"), SUMMARY_FLAT_SQL, SUMMARY_CTES))
def q_summary(spark, sf):
    """Summary from frames: contract over the CSV batches, metrics over layers built once."""
    return flatten_summary(_summary(spark, sf))


@register("validation_summary_json", with_ctes(("metrics", "freshness_status"), SUMMARY_JSON_SQL, SUMMARY_CTES))
def q_summary_json(spark, sf):
    return V.summary_json(_summary(spark, sf))


@register("validate_layers", with_ctes(("metrics", "freshness_status"), SUMMARY_FLAT_SQL, SUMMARY_CTES))
def q_validate(spark, sf):
    """Build from the CSV batches, then the read-only validation run."""
    glob = _csv(spark, sf)
    root = scratch_path(spark, "warehouse")
    build_all(spark, glob, root)
    summary = V.validate(spark, root, glob)
    return flatten_summary(V.summary_frame(spark, summary))


@register("pipeline_snapshot", with_ctes("metrics", """
select 'ready' as status, cast(null as varchar) as error, bronze_rows, silver_rows,
       cast(delivered_revenue_from_silver as varchar) as delivered_revenue_from_silver,
       'bronze/bronze_orders.parquet' as bronze_artifact
from metrics"""))
def q_snapshot(spark, sf):
    glob = _csv(spark, sf)
    snap = V.snapshot(spark, glob, scratch_path(spark, "warehouse"))
    v = snap["validation"] or {}
    row = (snap["status"], snap["error"], v.get("bronze_rows"), v.get("silver_rows"),
           v.get("delivered_revenue_from_silver"), snap["artifacts"][C.BRONZE])
    return spark.createDataFrame([row], "status string, error string, bronze_rows bigint, silver_rows bigint, "
                                        "delivered_revenue_from_silver string, bronze_artifact string")
