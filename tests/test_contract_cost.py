"""The cost of the contract scan and of its test input."""

from __future__ import annotations

import contextlib
import datetime
import io
import os
import re

from pyspark.sql import functions as F

from lakeward.operators import contract as CT
from lakeward.sources.fixtures import order_events, write_csv_batches


def test_the_scan_is_compiled(spark):
    # A generated method of 8,000 bytes or more runs interpreted, many times slower.
    cells = spark.createDataFrame([("a", "b", "f")], "c0 string, c1 string, file string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with contextlib.redirect_stdout(io.StringIO()) as told:
            cells.groupBy("file").agg(*[F.expr(f"bit_or({CT.value_class_bit(c)})") for c in ("c0", "c1")]).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", told.getvalue())]
    assert sizes and max(sizes) < 6000


def test_batches_are_staged_with_numbers_for_ids(spark, tmp_path):
    at = datetime.datetime(2026, 5, 3, 7)
    tables = {
        "lineitem": ([(1, 101, 4, 1, 2.5, "R", "F", at), (1, 7, 4, 2, 3.5, "N", "F", at), (2, None, 5, 1, None, "N", "O", None), (None, 1, 5, 1, 1.0, "N", "O", at),
                      (2, 3, None, 1, 1.0, "N", "O", at)],
                     "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        "orders": ([(1, 11), (2, 12)], "o_orderkey bigint, o_custkey bigint"), "customer": ([(11, 0), (12, 0)], "c_custkey bigint, c_nationkey bigint"),
        "nation": ([(0, 0)], "n_nationkey bigint, n_regionkey bigint"), "region": ([(0, "ASIA")], "r_regionkey bigint, r_name string")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    ids = order_events(spark, str(tmp_path)).select("event_id", "order_id", "customer_id", "source_file")
    assert {tuple(r) for r in ids.collect()} == {("evt-1-1", "ord-1", None, "batch_0"), ("evt-1-2", "ord-1", "cust-11", "batch_0"), ("evt-2-1", "ord-2", "cust-12", "batch_1"),
                                                 ("evt-2-1", "ord-2", "cust-12", None)}
    root = str(tmp_path / "csv")
    write_csv_batches(spark, str(tmp_path), root)
    staged = dict(spark.read.parquet(os.path.join(root, "staged_order_events")).dtypes)
    assert staged["l_orderkey"] == staged["custkey"] == "bigint" and not any(c.endswith("_id") for c in staged)
    landed = spark.read.option("header", "true").csv(os.path.join(root, "batch_0.csv"))
    assert {(r["event_id"], r["customer_id"]) for r in landed.collect()} == {("evt-1-1", None), ("evt-1-2", "cust-11")}
