"""Contract, layer names and service levels.

Every value in the "fixed values" block below must equal the reference's
for results to match; everything is a default that callers may override.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must match the reference for identical results)
# ---------------------------------------------------------------------------

# Raw file contract: column -> accepted inferred type names.
RAW_CONTRACT: dict[str, tuple[str, ...]] = {
    "event_id": ("VARCHAR",),
    "order_id": ("VARCHAR",),
    "customer_id": ("VARCHAR",),
    "region": ("VARCHAR",),
    "status": ("VARCHAR",),
    "order_amount": ("DECIMAL", "DOUBLE", "FLOAT", "INTEGER", "BIGINT", "HUGEINT"),
    "event_ts": ("TIMESTAMP", "TIMESTAMP WITH TIME ZONE", "DATE"),
    "ingestion_ts": ("TIMESTAMP", "TIMESTAMP WITH TIME ZONE", "DATE"),
}

# Keys that must be non-null for an event to enter silver.
REQUIRED_KEYS: tuple[str, ...] = ("event_id", "order_id", "customer_id", "region", "status")

# Money is fixed-point with two decimals.
MONEY_TYPE = "decimal(12,2)"

# Status literal that counts as revenue.
DELIVERED = "delivered"

# Layer names, in build order.
BRONZE = "bronze_orders"
SILVER = "silver_orders"
LATEST = "silver_latest_order_state"
GOLD_DAILY = "gold_daily_region_sales"
GOLD_CUSTOMER = "gold_customer_order_metrics"
LAYERS: tuple[str, ...] = (BRONZE, SILVER, LATEST, GOLD_DAILY, GOLD_CUSTOMER)

# Layer location relative to the warehouse root.
LAYER_DIRS: dict[str, str] = {
    BRONZE: "bronze/bronze_orders.parquet",
    SILVER: "silver/silver_orders.parquet",
    LATEST: "silver/silver_latest_order_state.parquet",
    GOLD_DAILY: "gold/gold_daily_region_sales.parquet",
    GOLD_CUSTOMER: "gold/gold_customer_order_metrics.parquet",
}

# Freshness service levels.
SLA_MINUTES: dict[str, int] = {
    "bronze_orders": 5,
    "silver_orders": 10,
    "silver_latest_order_state": 10,
    "gold_customer_order_metrics": 15,
}
SLA_DAYS: dict[str, int] = {
    "gold_daily_region_sales": 0,
}

# Order of the five freshness records in a report.
FRESHNESS_ORDER: tuple[str, ...] = (
    "bronze_orders",
    "silver_orders",
    "silver_latest_order_state",
    "gold_customer_order_metrics",
    "gold_daily_region_sales",
)

# Gate messages, in evaluation order.
GATE_MESSAGES: dict[str, str] = {
    "bronze_non_empty": "bronze layer is empty",
    "silver_non_empty": "silver layer is empty",
    "silver_unique_events": "silver layer still contains duplicate event_id values",
    "latest_non_empty": "latest state table is empty",
    "customer_coverage": "gold customer metrics does not cover every latest-state customer",
    "daily_revenue_reconciles": "daily gold revenue does not reconcile with silver latest state",
    "customer_revenue_reconciles": "customer gold revenue does not reconcile with silver latest state",
    "delivered_orders_reconcile": "customer gold delivered order counts do not reconcile",
}

# Declarative column tests: (table, column, test).
COLUMN_TESTS: tuple[tuple[str, str, str], ...] = (
    ("order_events", "event_id", "not_null"),
    ("order_events", "order_id", "not_null"),
    ("order_events", "customer_id", "not_null"),
    ("bronze_orders", "event_id", "not_null"),
    ("bronze_orders", "order_id", "not_null"),
    ("silver_orders", "event_id", "not_null"),
    ("silver_orders", "event_id", "unique"),
    ("silver_latest_order_state", "order_id", "not_null"),
    ("silver_latest_order_state", "order_id", "unique"),
    ("gold_daily_region_sales", "event_date", "not_null"),
    ("gold_daily_region_sales", "region", "not_null"),
    ("gold_customer_order_metrics", "customer_id", "not_null"),
    ("gold_customer_order_metrics", "customer_id", "unique"),
)

# ---------------------------------------------------------------------------
# Derived layouts (ours)
# ---------------------------------------------------------------------------

RAW_COLUMNS: tuple[str, ...] = tuple(RAW_CONTRACT)

BRONZE_COLUMNS: tuple[str, ...] = ("source_file",) + RAW_COLUMNS

SILVER_COLUMNS: tuple[str, ...] = (
    "event_id", "order_id", "customer_id", "region", "status", "order_amount",
    "event_ts", "ingestion_ts", "event_date", "ingestion_date", "source_file",
)

LATEST_COLUMNS: tuple[str, ...] = (
    "order_id", "customer_id", "region", "status", "order_amount",
    "event_ts", "ingestion_ts", "event_date", "ingestion_date",
)


@dataclass(frozen=True)
class Settings:
    """Knobs of one pipeline run; defaults are the reference's values."""

    money_type: str = MONEY_TYPE
    # Type of the gold tables' revenue, a total for each key; raise it to decimal(38,2) for hot keys.
    money_total_type: str = MONEY_TYPE
    delivered: str = DELIVERED
    required_keys: tuple[str, ...] = REQUIRED_KEYS
    sla_minutes: dict[str, int] = field(default_factory=lambda: dict(SLA_MINUTES))
    sla_days: dict[str, int] = field(default_factory=lambda: dict(SLA_DAYS))
    contract: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(RAW_CONTRACT))
    # Accept quoted line breaks in CSV input; each file is then read by one task.
    multiline_csv: bool = False
    # Least buckets of silver by event_id, more for more rows; 0 writes it without. Keys are then counted without a shuffle.
    silver_buckets: int = 0

    @property
    def grand_total_type(self) -> str:
        """Of totals over a whole layer, which grow with it: as wide as decimals go, with the scale of gold's."""
        scale = re.search(r",\s*(\d+)", self.money_total_type)
        return f"decimal(38,{scale[1] if scale else 0})"


DEFAULT = Settings()
