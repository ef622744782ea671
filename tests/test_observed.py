"""Metrics observed while layers are written equal those read back from them."""

from __future__ import annotations

import contextlib
import io
import os

import pytest
from pyspark.sql import functions as F

from lakeward import config as C
from lakeward.operators import quality as Q
from lakeward.plans.build import build_layers, build_with_report
from lakeward.plans.validate import snapshot, validate
from lakeward.sources.fixtures import order_events
from lakeward.sources.layout import read_layers

SF = "/root/testdata/sf0.001"


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_observed_metrics_equal_the_metrics_of_a_validation(spark, tmp_path):
    if not os.path.exists(SF):
        pytest.skip("driver test data not present")
    root, observed = str(tmp_path / "wh"), {}
    build_layers(spark, order_events(spark, SF), root, observed=observed)
    layers = read_layers(spark, root)
    assert set(observed) == set(Q.METRIC_TYPES) - set(Q.NOT_OBSERVED)
    assert Q.metrics_with(observed, layers).collect() == Q.metrics(layers).collect()


def test_an_empty_build_observes_zeros(spark, tmp_path):
    root, observed = str(tmp_path / "wh"), {}
    empty = spark.createDataFrame([], ", ".join(f"{c} string" for c in C.BRONZE_COLUMNS))
    build_layers(spark, empty, root, observed=observed)
    layers = read_layers(spark, root)
    assert Q.metrics_with(observed, layers).collect() == Q.metrics(layers).collect()
    assert observed["bronze_rows"] == 0 and observed["source_max_event_ts"] is None


def test_a_report_reads_two_columns_of_two_layers(spark, golden_dir, tmp_path):
    report = build_with_report(spark, str(golden_dir / "*.csv"), str(tmp_path / "wh"))
    text = plan_text(Q.metrics_with(report.observed, read_layers(spark, str(tmp_path / "wh"))))
    assert text.count("\nLocation:") == 2
    assert "ReadSchema: struct<event_id:string>" in text and "ReadSchema: struct<customer_id:string>" in text


def test_the_snapshot_equals_an_independent_validation(spark, golden_dir, tmp_path):
    root, pattern = str(tmp_path / "wh"), str(golden_dir / "*.csv")
    snap = snapshot(spark, pattern, root)
    assert snap["status"] == "ready"
    assert snap["validation"] == validate(spark, root, pattern).to_dict()


def test_the_snapshot_is_degraded_by_a_failing_gate(spark, golden_dir, tmp_path, monkeypatch):
    from lakeward.operators import layers as L

    whole = L.customer_metrics
    monkeypatch.setattr(L, "customer_metrics", lambda df, settings: whole(df, settings).where(F.col("customer_id") != "cust-005"))
    snap = snapshot(spark, str(golden_dir / "*.csv"), str(tmp_path / "wh"))
    assert snap["status"] == "degraded" and snap["error"] == C.GATE_MESSAGES["customer_coverage"]
