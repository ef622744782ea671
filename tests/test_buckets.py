"""Silver in buckets of its key: no shuffle of rows where keys are counted."""

from __future__ import annotations

import contextlib
import io
import os
import re

from pyspark.sql import functions as F

from lakeward import config as C
from lakeward.config import Settings
from lakeward.operators import quality as Q
from lakeward.plans.build import build_all
from lakeward.plans.validate import snapshot, validate
from lakeward.sources import layout as W

BUCKETED = Settings(silver_buckets=5)


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_key_counts_need_no_shuffle_of_rows(spark, golden_dir, tmp_path):
    root = str(tmp_path / "wh")
    build_all(spark, str(golden_dir / "*.csv"), root, BUCKETED)
    silver = W.read_layers(spark, root)[C.SILVER]
    for frame in (Q.duplicate_key_count(silver, ["event_id"]), Q.unique(silver, C.SILVER, "event_id")):
        text = plan_text(frame)
        assert "Bucketed: true" in text and "Exchange hashpartitioning" not in text
        assert text.count("Exchange") == 1 and "Exchange SinglePartition" in text  # of one number a task
    plain = str(tmp_path / "plain")
    build_all(spark, str(golden_dir / "*.csv"), plain)
    assert "Exchange hashpartitioning" in plan_text(Q.duplicate_key_count(W.read_layers(spark, plain)[C.SILVER], ["event_id"]))


def test_bucketed_builds_hold_the_same_rows_in_one_file_a_bucket(spark, golden_dir, tmp_path):
    rows = {}
    for name, settings in (("plain", C.DEFAULT), ("bucketed", BUCKETED)):
        root = str(tmp_path / name)
        build_all(spark, str(golden_dir / "*.csv"), root, settings)
        rows[name] = {layer: sorted(map(repr, df.collect())) for layer, df in W.read_layers(spark, root).items()}
        assert validate(spark, root, settings=settings).silver_rows == 10
    assert rows["plain"] == rows["bucketed"]
    files = [f for f in os.listdir(W.current_paths(spark, str(tmp_path / "bucketed"))[C.SILVER].replace("file:", "")) if f.endswith(".parquet")]
    buckets = [re.search(r"_(\d{5})\.", f)[1] for f in files]
    assert len(set(buckets)) == len(buckets) <= 5
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_duplicates_in_buckets_are_found(spark, golden_dir, tmp_path):
    root = str(tmp_path / "wh")
    build_all(spark, str(golden_dir / "*.csv"), root, BUCKETED)
    silver = W.read_layers(spark, root)[C.SILVER]
    path = str(tmp_path / "doubled")
    W.write_bucketed(silver.unionByName(silver.where(F.col("event_id") == "evt-1003")), path, "event_id", 5)
    doubled = W.read_bucketed(spark, path, "event_id", 5)
    assert Q.duplicate_key_count(doubled, ["event_id"]).first()["duplicates"] == 1


def test_versions_change_their_buckets_and_tables_go(spark, golden_dir, tmp_path):
    root, pattern = str(tmp_path / "wh"), str(golden_dir / "*.csv")
    for settings in (BUCKETED, C.DEFAULT, Settings(silver_buckets=3)):
        assert snapshot(spark, pattern, root, settings)["validation"]["silver_rows"] == 10
        assert W.read_layers(spark, root)[C.SILVER].count() == 10
    left = [t.name for t in spark.catalog.listTables() if t.name.endswith("_writer")]
    assert left == []


def test_buckets_grow_with_the_rows(spark, golden_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "BUCKET_ROWS", 2, raising=False)
    root = str(tmp_path / "wh")
    build_all(spark, str(golden_dir / "*.csv"), root, Settings(silver_buckets=3))
    silver = W.read_layers(spark, root)[C.SILVER]
    assert W.current_buckets(spark, root) == 6 and "Bucketed: true" in plan_text(silver.groupBy("event_id").count())
    assert silver.count() == 10 and silver.select("event_id").distinct().count() == 10
