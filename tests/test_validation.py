"""Validation run, gates and freshness."""

from __future__ import annotations

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeward import config as C
from lakeward.config import Settings
from lakeward.operators import layers as L
from lakeward.plans.build import build_all, build_layers
from lakeward.plans.validate import summary_frame, summary_json, validate
from lakeward.sources.layout import current_paths, read_layer, write_layer
from tests.conftest import GOLDEN_HEADER, write_csv


def _golden(spark, golden_dir, tmp_path):
    root = str(tmp_path / "warehouse")
    glob = str(golden_dir / "*.csv")
    build_all(spark, glob, root)
    return root, glob


def test_validation_summary_reconciles(spark, golden_dir, tmp_path):
    root, glob = _golden(spark, golden_dir, tmp_path)
    s = validate(spark, root, glob)
    assert s.schema_files_checked == 2
    assert s.schema_additive_columns == {"orders_batch_1.csv": [], "orders_batch_2.csv": []}
    assert (s.bronze_rows, s.silver_rows, s.duplicate_event_ids) == (11, 10, 0)
    assert (s.latest_state_rows, s.gold_customer_metric_rows) == (6, 5)
    assert s.delivered_revenue_from_silver == Decimal("604.75")
    assert s.delivered_revenue_from_gold_daily == Decimal("604.75")
    assert s.delivered_revenue_from_gold_customer == Decimal("604.75")
    assert (s.delivered_orders_from_latest_state, s.delivered_orders_from_gold_customer) == (5, 5)
    assert [f["layer"] for f in s.layer_freshness] == list(C.FRESHNESS_ORDER)
    assert all(f["status"] == "healthy" for f in s.layer_freshness)
    assert s.layer_freshness[0]["lag_minutes"] == 0
    assert s.layer_freshness[-1]["lag_days"] == 0
    assert s.to_dict()["delivered_revenue_from_silver"] == "604.75"
    frame = summary_frame(spark, s)
    assert frame.count() == 1
    assert '"delivered_revenue_from_silver":"604.75"' in summary_json(frame).first()[0]


def test_validate_does_not_write(spark, golden_dir, tmp_path):
    root, glob = _golden(spark, golden_dir, tmp_path)
    path = current_paths(spark, root)[C.GOLD_DAILY].replace("file:", "")
    before = sorted((f, os.stat(os.path.join(path, f)).st_mtime_ns) for f in os.listdir(path))
    validate(spark, root, glob)
    after = sorted((f, os.stat(os.path.join(path, f)).st_mtime_ns) for f in os.listdir(path))
    assert before == after


def test_missing_layer_raises(spark, golden_dir, tmp_path):
    root, glob = _golden(spark, golden_dir, tmp_path)
    bad_root = str(tmp_path / "elsewhere")
    with pytest.raises(FileNotFoundError, match="missing built artifacts"):
        validate(spark, bad_root, glob)


def _tamper(spark, root, layer, fn):
    # Write the tampered copy elsewhere first: a plan never overwrites its own input.
    path = current_paths(spark, root)[layer]
    write_layer(fn(read_layer(spark, path)), path + "_tampered")
    write_layer(read_layer(spark, path + "_tampered"), path)


@pytest.mark.parametrize("layer,fn,message", [
    (C.SILVER, lambda d: d.unionByName(d.limit(1)), "silver layer still contains duplicate event_id values"),
    (C.LATEST, lambda d: d.limit(0), "latest state table is empty"),
    (C.GOLD_CUSTOMER, lambda d: d.where("customer_id <> 'cust-005'"),
     "gold customer metrics does not cover every latest-state customer"),
    (C.GOLD_DAILY, lambda d: d.withColumn("delivered_revenue", F.col("delivered_revenue") + F.lit(1)
                                          ).withColumn("delivered_revenue", F.col("delivered_revenue").cast("decimal(12,2)")),
     "daily gold revenue does not reconcile with silver latest state"),
    (C.GOLD_CUSTOMER, lambda d: d.withColumn("delivered_revenue", F.lit(0).cast("decimal(12,2)")),
     "customer gold revenue does not reconcile with silver latest state"),
    (C.GOLD_CUSTOMER, lambda d: d.withColumn("delivered_orders", F.lit(0).cast("bigint")),
     "customer gold delivered order counts do not reconcile"),
])
def test_each_gate_fails_on_its_input(spark, golden_dir, tmp_path, layer, fn, message):
    root, glob = _golden(spark, golden_dir, tmp_path)
    _tamper(spark, root, layer, fn)
    with pytest.raises(ValueError, match=message):
        validate(spark, root, glob)


def test_empty_bronze_gate(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    empty = spark.createDataFrame([], "source_file string, " + ", ".join(f"{c} string" for c in C.RAW_COLUMNS))
    build_layers(spark, empty, root)
    with pytest.raises(ValueError, match="bronze layer is empty"):
        validate(spark, root)


def test_empty_silver_gate(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    raw = spark.createDataFrame(
        [("f", "evt-1", None, "c", "east", "created", "1.00", "2026-04-20 09:00:00", "2026-04-20 09:00:00")],
        "source_file string, " + ", ".join(f"{c} string" for c in C.RAW_COLUMNS))
    build_layers(spark, raw, root)
    with pytest.raises(ValueError, match="silver layer is empty"):
        validate(spark, root)


def test_latest_state_breach_and_empty_daily_unknown(spark, tmp_path):
    raw_dir = tmp_path / "raw"
    raw_dir.mkdir()
    # The newest ingestion (12:00) is superseded by event time, so latest-state
    # lags by 55 min; nothing is delivered, so the daily layer is empty (unknown).
    write_csv(raw_dir, "b.csv", GOLDEN_HEADER, [
        "evt-1,ord-1,cust-1,east,created,10.00,2026-04-20 10:00:00,2026-04-20 12:00:00",
        "evt-2,ord-1,cust-1,east,cancelled,10.00,2026-04-20 11:00:00,2026-04-20 11:05:00",
    ])
    root = str(tmp_path / "warehouse")
    glob = str(raw_dir / "*.csv")
    build_all(spark, glob, root)
    with pytest.raises(ValueError, match="freshness SLA violated for layers: silver_latest_order_state"):
        validate(spark, root, glob)
    relaxed = Settings(sla_minutes={**C.SLA_MINUTES, "silver_latest_order_state": 60})
    s = validate(spark, root, glob, relaxed)
    daily = s.layer_freshness[-1]
    assert daily["status"] == "unknown" and daily["lag_days"] is None and daily["layer_timestamp"] == ""
    assert s.layer_freshness[2]["lag_minutes"] == 55
    assert s.delivered_revenue_from_gold_daily == Decimal("0.00")


def test_every_layer_can_breach(spark, golden_dir, tmp_path):
    root, glob = _golden(spark, golden_dir, tmp_path)
    tight = Settings(sla_minutes={k: -1 for k in C.SLA_MINUTES}, sla_days={k: -1 for k in C.SLA_DAYS})
    with pytest.raises(ValueError) as err:
        validate(spark, root, glob, tight)
    assert str(err.value) == "freshness SLA violated for layers: " + ", ".join(sorted(C.FRESHNESS_ORDER))


def test_daily_breach_when_newest_day_has_no_delivery(spark, tmp_path):
    raw_dir = tmp_path / "raw"
    raw_dir.mkdir()
    write_csv(raw_dir, "b.csv", GOLDEN_HEADER, [
        "evt-1,ord-1,cust-1,east,delivered,10.00,2026-04-20 10:00:00,2026-04-20 10:00:00",
        "evt-2,ord-2,cust-1,east,created,10.00,2026-04-21 11:00:00,2026-04-21 11:00:00",
    ])
    root = str(tmp_path / "warehouse")
    glob = str(raw_dir / "*.csv")
    build_all(spark, glob, root)
    with pytest.raises(ValueError, match="freshness SLA violated for layers: gold_daily_region_sales"):
        validate(spark, root, glob)


def test_layers_are_pure_functions(spark):
    raw = spark.createDataFrame(
        [("f", "evt-1", "ord-1", "cust-1", "EAST", "Delivered", "10.005", "2026-04-20 09:00:00+02:00",
          "2026-04-20 09:00:00")],
        "source_file string, " + ", ".join(f"{c} string" for c in C.RAW_COLUMNS))
    b = L.bronze(raw).first()
    assert b["order_amount"] == Decimal("10.01")  # three decimals round half up
    assert str(b["event_ts"]) == "2026-04-20 07:00:00"  # zoned text -> UTC wall clock
    s = L.silver(L.bronze(raw)).first()
    assert (s["region"], s["status"]) == ("east", "delivered")
