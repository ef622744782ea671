"""What layers cost on disk and what a task sorts of them."""

from __future__ import annotations

import glob

import pyarrow.parquet as pq

from lakeward.plans.build import build_layers
from lakeward.sources import batches as B
from lakeward.sources import layout as W

SPLIT = "spark.sql.files.maxPartitionBytes"


def test_splits_are_small_within_the_block_only(spark):
    before = spark.conf.get(SPLIT)
    with W.small_splits(spark):
        assert int(spark.conf.get(SPLIT)) == W.SORTED_SPLIT < 128 << 20
    assert spark.conf.get(SPLIT) == before
    with W.session_conf(spark, spark__sql__files__maxPartitionBytes="1m"), W.small_splits(spark):
        assert int(spark.conf.get(SPLIT)) == 1 << 20  # a smaller one of the session stays


def test_layers_are_written_with_zstd(spark, golden_dir, tmp_path):
    before = spark.conf.get(SPLIT)
    paths = build_layers(spark, B.read_batches(spark, str(golden_dir / "*.csv")), str(tmp_path / "wh"))
    assert spark.conf.get(SPLIT) == before
    for path in paths.values():
        files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{path}/part-*")]
        assert {m.row_group(0).column(0).compression for m in files if m.num_row_groups} == {"ZSTD"}
