"""Benchmark: full build and validation at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=4 python bench.py

Prints one JSON line. ``value`` is the sum of the headline timings:
contract, full build from CSV, validation, then each operator alone from the
layer it reads (dedupe by window and by max_by, latest state, both golds,
the fused validation metrics). The CSV landing step (writing the test
batches from the driver tables) is reported separately and not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakeward import config as C  # noqa: E402
from lakeward.operators import contract as CT  # noqa: E402
from lakeward.operators import layers as L  # noqa: E402
from lakeward.operators import quality as Q  # noqa: E402
from lakeward.plans.build import build_all  # noqa: E402
from lakeward.plans.validate import validate  # noqa: E402
from lakeward.session import local_session, scratch_path  # noqa: E402
from lakeward.sources.fixtures import write_csv_batches  # noqa: E402
from lakeward.sources.layout import read_layers  # noqa: E402


def _timed(fn):
    t0 = time.perf_counter()
    out = fn()
    return time.perf_counter() - t0, out


def _noop(df):
    df.write.format("noop").mode("overwrite").save()


def run_all(spark, sf_dir: str) -> tuple[dict[str, float], object, object]:
    times: dict[str, float] = {}
    times["csv_landing"], glob = _timed(lambda: write_csv_batches(spark, sf_dir, scratch_path(spark, "bench-csv")))
    times["contract"], summary = _timed(lambda: CT.inspect(spark, glob))
    root = scratch_path(spark, "bench-warehouse")
    times["build_all"], _ = _timed(lambda: build_all(spark, glob, root))
    times["validate"], result = _timed(lambda: validate(spark, root, glob))
    # Each operator again, alone, from the layer it reads in the pipeline.
    layers = read_layers(spark, root)
    steps = {
        "silver_dedupe": lambda: L.silver(layers[C.BRONZE]),
        "silver_dedupe_max_by": lambda: L.silver(layers[C.BRONZE], strategy="aggregate"),
        "latest_state": lambda: L.latest_state(layers[C.SILVER]),
        "gold_daily_region_sales": lambda: L.daily_region_sales(layers[C.LATEST]),
        "gold_customer_order_metrics": lambda: L.customer_metrics(layers[C.LATEST]),
        "validation_metrics": lambda: Q.metrics(layers),
    }
    for key, make in steps.items():
        times[key], _ = _timed(lambda make=make: _noop(make()))
    return times, summary, result


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    spark = local_session(cores=cpus, memory=os.environ.get("BENCH_MEM", "6g"))
    spark.conf.set("spark.sql.shuffle.partitions", str(max(cpus * 2, 4)))

    # Warm session: one full pass on a smaller scale first (JVM, JIT, codegen caches).
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.01")
    if os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(sf_dir):
        run_all(spark, warm)

    times, summary, result = run_all(spark, sf_dir)
    headline = {k: round(v, 3) for k, v in times.items()}
    total = sum(v for k, v in times.items() if k != "csv_landing")
    print(json.dumps({
        "metric": "build_validate_total",
        "value": round(total, 3),
        "unit": "sec",
        "queries": headline,
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "cpus": cpus,
        "bronze_rows": result.bronze_rows,
        "silver_rows": result.silver_rows,
        "files_checked": summary.files_checked,
    }))


if __name__ == "__main__":
    main()
