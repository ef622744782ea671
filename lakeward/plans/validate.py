"""Read-only validation of built layers, and the reports built from it.

The run changes nothing under the warehouse: contract re-check of the raw files that the
build's ledger doesn't know unchanged, existence of all five layers, one fused metrics job (one aggregate per layer), then the
ordered gates and the freshness gate on the driver from that one small row.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward import config as C
from lakeward.config import DEFAULT, Settings
from lakeward.functions import columns as X
from lakeward.operators import contract as CT
from lakeward.operators import freshness as FR
from lakeward.operators import quality as Q
from lakeward.sources.layout import assert_layers_exist, layer_paths, read_layer, read_layers, read_ledger, relative_paths, shuffles_dropped

SUMMARY_SCALARS: tuple[str, ...] = (
    "schema_files_checked", "bronze_rows", "silver_rows", "duplicate_event_ids", "latest_state_rows",
    "gold_customer_metric_rows", "delivered_revenue_from_silver", "delivered_revenue_from_gold_daily",
    "delivered_revenue_from_gold_customer", "delivered_orders_from_latest_state",
    "delivered_orders_from_gold_customer",
)
FRESHNESS_FIELDS: tuple[str, ...] = ("layer", "source_timestamp", "layer_timestamp", "lag_minutes", "lag_days",
                                     "sla_minutes", "sla_days", "status")


@dataclass(frozen=True)
class ValidationSummary:
    schema_files_checked: int
    schema_additive_columns: dict[str, list[str]]
    bronze_rows: int
    silver_rows: int
    duplicate_event_ids: int
    latest_state_rows: int
    gold_customer_metric_rows: int
    delivered_revenue_from_silver: Decimal
    delivered_revenue_from_gold_daily: Decimal
    delivered_revenue_from_gold_customer: Decimal
    delivered_orders_from_latest_state: int
    delivered_orders_from_gold_customer: int
    layer_freshness: list[dict] = field(default_factory=list)

    def to_dict(self) -> dict:
        d = {k: getattr(self, k) for k in ("schema_files_checked", "schema_additive_columns") + SUMMARY_SCALARS[1:]}
        for k in ("delivered_revenue_from_silver", "delivered_revenue_from_gold_daily",
                  "delivered_revenue_from_gold_customer"):
            d[k] = str(d[k])
        d["layer_freshness"] = [dict(x) for x in self.layer_freshness]
        return d


def metrics_row(spark: SparkSession, layers: dict[str, DataFrame], settings: Settings = DEFAULT) -> DataFrame:
    """The metrics computed once and held as a one-row local frame."""
    with shuffles_dropped(spark):
        m = Q.metrics(layers, settings)
        row = m.collect()[0]
    return spark.createDataFrame([row], m.schema)


def first_failed_gate(checks_df: DataFrame) -> str | None:
    return Q.first_failure(checks_df.collect())


def validate(spark: SparkSession, output_root: str, input_paths: str | Sequence[str] | None = None,
             settings: Settings = DEFAULT) -> ValidationSummary:
    """Validate built layers; raises ``FileNotFoundError``/``ValueError`` on failure.
    Without ``input_paths`` only the layers are checked; the job always gives them."""
    if input_paths is not None:
        schema = CT.enforce(spark, input_paths, settings.contract, multiline=settings.multiline_csv,
                            ledger=read_ledger(spark, output_root))
    else:
        schema = CT.ContractSummary(0, {}, [])
    assert_layers_exist(spark, output_root)
    return judged(metrics_row(spark, read_layers(spark, output_root), settings), schema, settings)


def judged(m: DataFrame, schema: CT.ContractSummary, settings: Settings = DEFAULT) -> ValidationSummary:
    """The gates and the freshness gate over one metrics row; raises on the first that fails."""
    failure = first_failed_gate(Q.checks(m))
    if failure:
        raise ValueError(failure)
    fresh = [r.asDict() for r in FR.layer_freshness(m, settings).orderBy("position").collect()]
    breached = sorted(r["layer"] for r in fresh if r["status"] == "breach")
    if breached:
        raise ValueError("freshness SLA violated for layers: " + ", ".join(breached))
    row = m.collect()[0]
    return ValidationSummary(
        schema_files_checked=schema.files_checked,
        schema_additive_columns=schema.additive_columns,
        bronze_rows=row["bronze_rows"],
        silver_rows=row["silver_rows"],
        duplicate_event_ids=row["duplicate_event_ids"],
        latest_state_rows=row["latest_state_rows"],
        gold_customer_metric_rows=row["gold_customer_metric_rows"],
        delivered_revenue_from_silver=row["delivered_revenue_from_silver"],
        delivered_revenue_from_gold_daily=row["delivered_revenue_from_gold_daily"],
        delivered_revenue_from_gold_customer=row["delivered_revenue_from_gold_customer"],
        delivered_orders_from_latest_state=row["delivered_orders_from_latest_state"],
        delivered_orders_from_gold_customer=row["delivered_orders_from_gold_customer"],
        layer_freshness=[{k: r[k] for k in FRESHNESS_FIELDS} for r in fresh],
    )


# --------------------------------------------------------------------- reports

FRESHNESS_TYPE = T.StructType([
    T.StructField("layer", T.StringType()),
    T.StructField("source_timestamp", T.StringType()),
    T.StructField("layer_timestamp", T.StringType()),
    T.StructField("lag_minutes", T.LongType()),
    T.StructField("lag_days", T.LongType()),
    T.StructField("sla_minutes", T.LongType()),
    T.StructField("sla_days", T.LongType()),
    T.StructField("status", T.StringType()),
])


def summary_schema(money_type: str = DEFAULT.grand_total_type) -> T.StructType:
    money = T._parse_datatype_string(money_type)
    fields = [T.StructField("schema_files_checked", T.LongType()),
              T.StructField("schema_additive_columns", T.MapType(T.StringType(), T.ArrayType(T.StringType())))]
    for k in SUMMARY_SCALARS[1:]:
        fields.append(T.StructField(k, money if k.startswith("delivered_revenue") else T.LongType()))
    fields.append(T.StructField("layer_freshness", T.ArrayType(FRESHNESS_TYPE)))
    return T.StructType(fields)


def summary_frame(spark: SparkSession, summary: ValidationSummary, settings: Settings = DEFAULT) -> DataFrame:
    """The 13-field summary as a one-row frame (map + array of structs)."""
    values = [summary.schema_files_checked, summary.schema_additive_columns] + [
        getattr(summary, k) for k in SUMMARY_SCALARS[1:]
    ] + [[Row(**{k: f[k] for k in FRESHNESS_FIELDS}) for f in summary.layer_freshness]]
    return spark.createDataFrame([tuple(values)], summary_schema(settings.grand_total_type))


def summary_from_frames(metrics_df: DataFrame, freshness_df: DataFrame, files_checked: DataFrame,
                        additive: DataFrame) -> DataFrame:
    """The same summary row built lazily from DataFrames (no collect).

    Every input is one row, or one row per batch/layer; they are stitched by
    a union on a constant key followed by ``max``/``collect_list`` — no join."""
    fields = [F.col(k) for k in SUMMARY_SCALARS[1:]]
    fresh = freshness_df.select(F.struct("position", *[F.col(k) for k in FRESHNESS_FIELDS]).alias("f"))
    parts = [
        metrics_df.select(*fields).withColumn("_part", F.lit(0)),
        files_checked.select(F.col("files_checked").cast("bigint").alias("schema_files_checked"))
        .withColumn("_part", F.lit(1)),
        additive.select(F.struct("file_name", "additive_columns").alias("_add")).withColumn("_part", F.lit(2)),
        fresh.withColumn("_part", F.lit(3)),
    ]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    ordered = F.sort_array(F.collect_list("f"))
    return u.agg(
        F.coalesce(F.max("schema_files_checked"), F.lit(0).cast("bigint")).alias("schema_files_checked"),
        F.map_from_entries(F.sort_array(F.collect_list("_add"))).alias("schema_additive_columns"),
        *[F.max(k).alias(k) for k in SUMMARY_SCALARS[1:]],
        F.transform(ordered, lambda s: s.dropFields("position")).alias("layer_freshness"),
    )


def summary_json(summary_df: DataFrame) -> DataFrame:
    """Serialised summary: decimals as text, nested JSON."""
    cols = []
    for f in summary_df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = X.decimal_text(c)
        cols.append(c.alias(f.name))
    return summary_df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("validation"))


def snapshot(spark: SparkSession, input_paths: str | Sequence[str], output_root: str,
             settings: Settings = DEFAULT) -> dict:
    """Build, then judge the build by the contract summary and the metrics it observed while it
    wrote; ``ready`` with the summary or ``degraded`` with the error. Only silver and latest state are
    read again, once, one column each; ``validate`` is the check that reads all anew."""
    from lakeward.plans.build import build_with_report

    paths = layer_paths(output_root)
    try:
        report = build_with_report(spark, input_paths, output_root, settings)
        layers = {layer: read_layer(spark, path) for layer, path in report.paths.items()}
        with shuffles_dropped(spark):
            rest = Q.metrics_with(report.observed, layers, settings)
            m = spark.createDataFrame(rest.collect(), rest.schema)
        summary = judged(m, report.contract, settings)
    except Exception as exc:  # noqa: BLE001 - surfaced in the snapshot
        return {"status": "degraded", "error": str(exc), "artifacts": relative_paths(output_root, paths),
                "validation": None}
    return {"status": "ready", "error": None, "artifacts": relative_paths(output_root, paths),
            "validation": summary.to_dict()}


def snapshot_json(snap: dict) -> str:
    return json.dumps(snap, indent=2, default=str)
