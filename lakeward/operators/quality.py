"""Layer metrics, reconciliation checks and declarative column tests.

Every metric of the validation run is computed with at most one aggregate
per layer (plus the duplicate-key aggregate on silver). The one-row
per-layer results are stitched into a single row by ``union`` + ``max``
(each frame fills its own columns, NULL elsewhere) — no cross join.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from decimal import localcontext

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward import config as C
from lakeward.config import DEFAULT, Settings
from lakeward.functions import columns as X

# metric name -> SQL type, in report order
METRIC_TYPES: dict[str, str] = {
    "bronze_rows": "bigint",
    "silver_rows": "bigint",
    "duplicate_event_ids": "bigint",
    "latest_state_rows": "bigint",
    "gold_customer_metric_rows": "bigint",
    "delivered_revenue_from_silver": "money",
    "delivered_revenue_from_gold_daily": "money",
    "delivered_revenue_from_gold_customer": "money",
    "delivered_orders_from_latest_state": "bigint",
    "delivered_orders_from_gold_customer": "bigint",
    "distinct_customers_from_latest_state": "bigint",
    "source_max_ingestion_ts": "timestamp_ntz",
    "source_max_event_ts": "timestamp_ntz",
    "source_max_event_date": "date",
    "bronze_max_ingestion_ts": "timestamp_ntz",
    "silver_max_ingestion_ts": "timestamp_ntz",
    "latest_state_max_ingestion_ts": "timestamp_ntz",
    "customer_metrics_max_event_ts": "timestamp_ntz",
    "gold_daily_max_event_date": "date",
}


def _typed(settings: Settings) -> dict[str, str]:
    return {k: (settings.grand_total_type if t == "money" else t) for k, t in METRIC_TYPES.items()}


def _one_row(df: DataFrame, exprs: Mapping[str, Column], settings: Settings) -> DataFrame:
    """A one-row frame with every metric column; only ``exprs`` are filled."""
    types = _typed(settings)
    out = df.agg(*[e.alias(k) for k, e in exprs.items()])
    return out.select(*[
        (F.col(k) if k in exprs else F.lit(None)).cast(types[k]).alias(k) for k in METRIC_TYPES
    ])


def coalesced_sum(c: str | Column) -> Column:
    """The sum, 0 for none, as wide as Spark sums decimals: a cast here could raise, and an observed
    metric that raises is never delivered."""
    return F.coalesce(F.sum(c), F.lit(0))


def duplicate_key_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``count(*)`` of key groups having more than one row (one row, ``duplicates``)."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1)
        .agg(F.count(F.lit(1)).alias("duplicates"))
    )


def _parts(settings: Settings) -> list[tuple[str, Callable[[DataFrame], DataFrame], dict[str, Column]]]:
    """(layer, what is aggregated, metrics) for each pass over a layer."""
    delivered = X.is_status("status", settings.delivered)

    def whole(df: DataFrame) -> DataFrame:
        return df

    return [
        (C.BRONZE, whole, {
            "bronze_rows": F.count(F.lit(1)),
            "source_max_ingestion_ts": F.max("ingestion_ts"),
            "bronze_max_ingestion_ts": F.max("ingestion_ts"),
        }),
        (C.SILVER, whole, {
            "silver_rows": F.count(F.lit(1)),
            "silver_max_ingestion_ts": F.max("ingestion_ts"),
        }),
        (C.SILVER, lambda df: duplicate_key_count(df, ["event_id"]), {
            "duplicate_event_ids": F.max("duplicates"),
        }),
        (C.LATEST, whole, {
            "latest_state_rows": F.count(F.lit(1)),
            "delivered_revenue_from_silver": coalesced_sum(F.when(delivered, F.col("order_amount"))),
            "delivered_orders_from_latest_state": F.count_if(delivered),
            "distinct_customers_from_latest_state": F.count_distinct("customer_id"),
            "source_max_event_ts": F.max("event_ts"),
            "source_max_event_date": F.max("event_date"),
            "latest_state_max_ingestion_ts": F.max("ingestion_ts"),
        }),
        (C.GOLD_DAILY, whole, {
            "delivered_revenue_from_gold_daily": coalesced_sum("delivered_revenue"),
            "gold_daily_max_event_date": F.max("event_date"),
        }),
        (C.GOLD_CUSTOMER, whole, {
            "gold_customer_metric_rows": F.count(F.lit(1)),
            "delivered_revenue_from_gold_customer": coalesced_sum("delivered_revenue"),
            "delivered_orders_from_gold_customer": X.coalesce_zero(F.sum("delivered_orders"), "bigint"),
            "customer_metrics_max_event_ts": F.max("latest_order_event_ts"),
        }),
    ]


def layer_row_counts(footers: Mapping[str, DataFrame]) -> DataFrame:
    """(layer, row_count) of layers as ``layout.read_footers`` reads them: no row is scanned."""
    frames = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(layer).alias("layer"), "row_count") for layer, df in footers.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


#: Metrics that one pass of plain aggregates over the written rows can't give.
NOT_OBSERVED: tuple[str, ...] = ("duplicate_event_ids", "distinct_customers_from_latest_state")


def observable(layer: str, settings: Settings = DEFAULT) -> list[Column]:
    """The metrics of a layer that can be observed while it is written."""
    return [expr.alias(name) for of, _, exprs in _parts(settings) for name, expr in exprs.items() if of == layer and name not in NOT_OBSERVED]


def together(parts: Sequence[Mapping[str, object]]) -> dict[str, object]:
    """The metrics of a layer from those observed over parts of it: numbers add up, of times the last counts."""
    out: dict[str, object] = {}
    with localcontext(prec=38):  # Python's own 28 digits are fewer than Spark's decimals have
        for name in parts[0]:
            values = [p[name] for p in parts if p[name] is not None]
            last = METRIC_TYPES[name] in ("timestamp_ntz", "date")
            out[name] = None if not values else max(values) if last else sum(values[1:], values[0])
    return out


def metrics_with(values: Mapping[str, object], layers: Mapping[str, DataFrame], settings: Settings = DEFAULT) -> DataFrame:
    """The metrics row of a build from what its writes observed; only the metrics that can't be
    observed read their layers."""
    rest = metrics(layers, settings, only=[k for k in METRIC_TYPES if k not in values])
    types = _typed(settings)
    return rest.select(*[(F.lit(values[k]).cast(types[k]) if k in values else F.col(k)).alias(k) for k in METRIC_TYPES])


def metric_layers(only: Collection[str]) -> set[str]:
    """The layers that the named metrics read."""
    return {layer for layer, _, exprs in _parts(DEFAULT) if not exprs.keys().isdisjoint(only)}


def metrics(layers: Mapping[str, DataFrame], settings: Settings = DEFAULT,
            only: Collection[str] = tuple(METRIC_TYPES)) -> DataFrame:
    """The 19 scalar metrics of a validation run as one row; those not in ``only``
    are NULL, and layers that none of the others needs aren't read."""
    parts = []
    for layer, prepared, exprs in _parts(settings):
        wanted = {k: e for k, e in exprs.items() if k in only}
        if wanted:
            parts.append(_one_row(prepared(layers[layer]), wanted, settings))
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.agg(*[F.max(k).alias(k) for k in METRIC_TYPES])


# check name -> the metrics it compares
CHECK_METRICS: dict[str, tuple[str, ...]] = {
    "bronze_non_empty": ("bronze_rows",),
    "silver_non_empty": ("silver_rows",),
    "silver_unique_events": ("duplicate_event_ids",),
    "latest_non_empty": ("latest_state_rows",),
    "customer_coverage": ("gold_customer_metric_rows", "distinct_customers_from_latest_state"),
    "daily_revenue_reconciles": ("delivered_revenue_from_gold_daily", "delivered_revenue_from_silver"),
    "customer_revenue_reconciles": ("delivered_revenue_from_gold_customer", "delivered_revenue_from_silver"),
    "delivered_orders_reconcile": ("delivered_orders_from_gold_customer", "delivered_orders_from_latest_state"),
}


# (position, name, predicate over the metrics row, observed, expected)
def _check_specs() -> list[tuple[int, str, Column, Column, Column]]:
    m = F.col
    return [
        (1, "bronze_non_empty", m("bronze_rows") > 0, m("bronze_rows"), F.lit("> 0")),
        (2, "silver_non_empty", m("silver_rows") > 0, m("silver_rows"), F.lit("> 0")),
        (3, "silver_unique_events", m("duplicate_event_ids") == 0, m("duplicate_event_ids"), F.lit("0")),
        (4, "latest_non_empty", m("latest_state_rows") > 0, m("latest_state_rows"), F.lit("> 0")),
        (5, "customer_coverage", m("gold_customer_metric_rows") == m("distinct_customers_from_latest_state"),
         m("gold_customer_metric_rows"), m("distinct_customers_from_latest_state")),
        (6, "daily_revenue_reconciles",
         m("delivered_revenue_from_gold_daily") == m("delivered_revenue_from_silver"),
         m("delivered_revenue_from_gold_daily"), m("delivered_revenue_from_silver")),
        (7, "customer_revenue_reconciles",
         m("delivered_revenue_from_gold_customer") == m("delivered_revenue_from_silver"),
         m("delivered_revenue_from_gold_customer"), m("delivered_revenue_from_silver")),
        (8, "delivered_orders_reconcile",
         m("delivered_orders_from_gold_customer") == m("delivered_orders_from_latest_state"),
         m("delivered_orders_from_gold_customer"), m("delivered_orders_from_latest_state")),
    ]


def checks(metrics_row: DataFrame) -> DataFrame:
    """One row per gate: position, check_name, passed, observed, expected, message."""
    rows = [
        F.struct(
            F.lit(pos).alias("position"),
            F.lit(name).alias("check_name"),
            F.coalesce(pred, F.lit(False)).alias("passed"),
            observed.cast("string").alias("observed"),
            expected.cast("string").alias("expected"),
            F.lit(C.GATE_MESSAGES[name]).alias("message"),
        )
        for pos, name, pred, observed, expected in _check_specs()
    ]
    return metrics_row.select(F.inline(F.array(*rows)))


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """dbt-style ``not_null``: one aggregate per table, one row per column."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = [F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"),
                     F.lit("not_null").alias("test"), F.col(c).alias("failures")) for c in columns]
    return agg.select(F.inline(F.array(*rows)))


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """dbt-style ``unique``: number of non-null values appearing more than once."""
    dup = duplicate_key_count(df.where(F.col(column).isNotNull()), [column])
    return dup.select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
                      F.lit("unique").alias("test"), F.col("duplicates").alias("failures"))


def column_tests(tables: Mapping[str, DataFrame],
                 tests: Sequence[tuple[str, str, str]] = C.COLUMN_TESTS) -> DataFrame:
    """All declared column tests over the given tables; each tested table must be given."""
    absent = sorted({t[0] for t in tests} - tables.keys())
    if absent:
        raise KeyError(f"column tests name tables that aren't given: {', '.join(absent)}")
    frames: list[DataFrame] = []
    by_table: dict[str, list[str]] = {}
    for table, column, test in tests:
        if test == "not_null":
            by_table.setdefault(table, []).append(column)
    for table, cols in by_table.items():
        frames.append(not_null(tables[table], table, cols))
    for table, column, test in tests:
        if test == "unique":
            frames.append(unique(tables[table], table, column))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.withColumn("passed", F.col("failures") == 0)


def first_failure(check_rows: list) -> str | None:
    """Message of the lowest-position failed check (rows from ``checks``)."""
    failed = sorted((r["position"], r["message"]) for r in check_rows if not r["passed"])
    return failed[0][1] if failed else None
