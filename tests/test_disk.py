"""What a build keeps on disk besides its layers."""

from __future__ import annotations

import glob
import os
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeward import config as C
from lakeward.operators import quality as Q
from lakeward.plans.build import build_layers
from lakeward.plans.catalog_sources import _csv as batches_of
from lakeward.plans.validate import metrics_row, snapshot, validate
from lakeward.sources import batches as B
from lakeward.sources import layout as W
from lakeward.sources.fixtures import order_events
from tests.test_totals import tables


def shuffle_files(spark) -> set[str]:
    tops = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for top in tops for _, _, names in os.walk(top.getPath()) for f in names if f.startswith("shuffle_")}


def left_of(spark, before: set[str]) -> set[str]:
    """Shuffle files that weren't there before; they are deleted in the background."""
    until = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


def rows(df) -> list:
    return sorted(map(repr, df.collect()))


def counted(spark):
    return spark.range(1000).groupBy((F.col("id") % 10).alias("k")).agg(F.count(F.lit(1)).alias("n"))


def test_a_written_layer_leaves_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    W.write_layer(counted(spark), str(tmp_path / "a"))
    W.add_to_layer(counted(spark), str(tmp_path / "a"))
    W.write_bucketed(counted(spark), str(tmp_path / "b"), "k", 2)
    assert left_of(spark, before) == set()
    assert (spark.read.parquet(str(tmp_path / "a")).count(), spark.read.parquet(str(tmp_path / "b")).count()) == (20, 10)


def test_written_batches_leave_the_batches_alone_gzipped(spark, tmp_path):
    sf, before = tables(spark, tmp_path, Decimal("1.50")), shuffle_files(spark)
    pattern = batches_of(spark, sf)
    assert left_of(spark, before) == set()
    assert sorted(os.listdir(os.path.dirname(pattern).removeprefix("file:"))) == [f"batch_{k}.csv" for k in range(4)]
    parts = glob.glob(f"{pattern.removeprefix('file:')}/part-*")
    assert parts and all(p.endswith(".csv.gz") for p in parts)
    of = ("event_id", "order_id", "customer_id", "region", "status")
    assert rows(B.read_batches(spark, pattern).select(*of)) == rows(order_events(spark, sf).select(*of))


def test_shares_have_every_row_once_and_no_key_in_common(spark):
    df = spark.createDataFrame([(f"k{i % 7}" if i % 5 else None, i) for i in range(50)], "k string, v int")
    shares = [W.share_of(df, "k", n, 3).collect() for n in range(3)]
    assert sorted(r["v"] for share in shares for r in share) == list(range(50))
    keys = [{r["k"] for r in share} for share in shares]
    assert sum(map(len, keys)) == len(set().union(*keys)) == 8


def test_layers_made_in_passes_are_the_same(spark, golden_dir, tmp_path, monkeypatch):
    raw, add, added = B.read_batches(spark, str(golden_dir / "*.csv")), W.add_to_layer, []
    whole = build_layers(spark, raw, str(tmp_path / "whole"))
    monkeypatch.setattr(W, "PASS_BYTES", 1)
    monkeypatch.setattr(W, "add_to_layer", lambda df, path: added.append(os.path.basename(path)) or add(df, path))
    root, observed = str(tmp_path / "passes"), {}
    paths = build_layers(spark, raw, root, observed=observed)
    assert added == [f"{layer}.parquet" for layer in (C.SILVER, C.LATEST) for _ in range(W.MOST_PASSES - 1)]
    for layer, path in paths.items():
        assert rows(W.read_layer(spark, path)) == rows(W.read_layer(spark, whole[layer]))
    layers = W.read_layers(spark, root)
    assert Q.metrics_with(observed, layers).collect() == Q.metrics(layers).collect()


def test_a_validation_leaves_no_shuffle_files(spark, golden_dir, tmp_path):
    root = str(tmp_path / "wh")
    build_layers(spark, B.read_batches(spark, str(golden_dir / "*.csv")), root)
    layers, before = W.read_layers(spark, root), shuffle_files(spark)
    assert metrics_row(spark, layers).first()["bronze_rows"] == 11
    assert left_of(spark, before) == set()


def test_the_snapshot_of_a_build_in_passes_equals_a_validation(spark, golden_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "PASS_BYTES", 1)
    root, pattern = str(tmp_path / "wh"), str(golden_dir / "*.csv")
    snap = snapshot(spark, pattern, root)
    assert snap["status"] == "ready" and snap["validation"] == validate(spark, root, pattern).to_dict()
    assert (snap["validation"]["silver_rows"], snap["validation"]["delivered_revenue_from_silver"]) == (10, "604.75")


@pytest.mark.parametrize("size,passes", [(0, 1), (1, 1), (100, 1), (101, 2), (300, 3), (99_999, 3)])
def test_passes_go_by_size_and_are_bounded(spark, tmp_path, monkeypatch, size, passes):
    monkeypatch.setattr(W, "PASS_BYTES", 100)
    (tmp_path / "file").write_bytes(b"x" * size)
    assert W.passes_for(spark, str(tmp_path)) == passes


def test_observed_parts_add_up_exactly():
    most = Decimal("9" * 28 + ".99")
    parts = [{"silver_rows": 2, "gold_daily_max_event_date": None, "delivered_revenue_from_silver": most}, {
        "silver_rows": 3, "gold_daily_max_event_date": None, "delivered_revenue_from_silver": Decimal("0.01")}]
    assert Q.together(parts) == {"silver_rows": 5, "gold_daily_max_event_date": None, "delivered_revenue_from_silver": Decimal("1" + "0" * 28 + ".00")}
