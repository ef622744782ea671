"""The spark-submit entry point, run in-process on the golden batches."""

from __future__ import annotations

import contextlib
import io
import json

from lakeward.plans.job import main


def _run(argv):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        assert main(argv) == 0
    return json.loads(buf.getvalue())


def test_build_then_validate_then_snapshot(spark, golden_dir, tmp_path):
    glob, root = str(golden_dir / "*.csv"), str(tmp_path / "wh")
    built = _run(["build", "--input-glob", glob, "--output-root", root])
    assert built["artifacts"]["bronze_orders"] == "bronze/bronze_orders.parquet"
    v = _run(["validate", "--input-glob", glob, "--output-root", root])["validation"]
    assert (v["bronze_rows"], v["silver_rows"], v["latest_state_rows"]) == (11, 10, 6)
    assert v["delivered_revenue_from_gold_customer"] == "604.75"
    assert v["layer_freshness"][-1]["layer"] == "gold_daily_region_sales"
    snap = _run(["snapshot", "--input-glob", glob, "--output-root", str(tmp_path / "wh2")])
    assert snap["status"] == "ready" and snap["error"] is None
    # the caller's session is still usable
    assert spark.range(3).count() == 3


def test_snapshot_reports_degraded_on_contract_failure(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "bad.csv").write_text("event_id,order_id\nevt-1,ord-1\n", encoding="utf-8")
    snap = _run(["snapshot", "--input-glob", str(raw / "*.csv"), "--output-root", str(tmp_path / "wh")])
    assert snap["status"] == "degraded" and "raw schema compatibility failed" in snap["error"]
    assert snap["validation"] is None
