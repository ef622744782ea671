"""Physical-plan properties the engine relies on at scale."""

from __future__ import annotations

import contextlib
import io
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from lakeward import config as C
from lakeward.operators import contract as CT
from lakeward.operators import layers as L
from lakeward.operators.keyed import rank_column
from lakeward.plans.build import build_all
from lakeward.sources.layout import read_layers


SF = "/root/testdata/sf0.001"


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _hot_bronze(spark, n=30_000):
    # One event_id carries a third of all rows (duplicate deliveries of one event).
    hot = F.col("id") % 3 == 0
    return spark.range(n).select(
        F.lit("batch").alias("source_file"),
        F.when(hot, F.lit("evt-hot")).otherwise(F.concat(F.lit("evt-"), F.col("id").cast("string"))).alias("event_id"),
        F.when(hot, F.lit("ord-hot")).otherwise(F.concat(F.lit("ord-"), (F.col("id") % 97).cast("string")))
        .alias("order_id"),
        F.lit("cust-1").alias("customer_id"),
        F.lit("east").alias("region"),
        F.lit("created").alias("status"),
        F.lit("1.00").alias("order_amount"),
        F.lit("2026-04-20 10:00:00").alias("event_ts"),
        F.date_format(F.timestamp_seconds(F.col("id") + 1_700_000_000), "yyyy-MM-dd HH:mm:ss").alias("ingestion_ts"),
    )


def test_hot_key_is_cut_to_one_row_per_task_before_the_shuffle(spark):
    silver = L.silver(L.bronze(_hot_bronze(spark)))
    text = plan_text(silver)
    assert "WindowGroupLimit" in text and "Partial" in text and "Final" in text
    # the partial limit sits below (before) the exchange on event_id
    assert text.index("Exchange") < text.rindex("WindowGroupLimit")
    rows = silver.where("event_id = 'evt-hot'").collect()
    assert len(rows) == 1
    assert str(rows[0]["ingestion_ts"]) == "2023-11-15 06:33:17"  # id 29997, the newest hot delivery
    assert silver.count() == 1 + 20_000


def test_layer_reads_push_filters_and_prune_columns(spark, golden_dir, tmp_path):
    root = str(tmp_path / "wh")
    build_all(spark, str(golden_dir / "*.csv"), root)
    layers = read_layers(spark, root)
    silver_plan = plan_text(L.silver(layers[C.BRONZE]))
    assert "PushedFilters: [IsNotNull(event_id), IsNotNull(order_id), IsNotNull(customer_id)" in silver_plan
    daily_plan = plan_text(L.daily_region_sales(layers[C.LATEST]))
    assert "EqualTo(status,delivered)" in daily_plan
    assert "ReadSchema: struct<region:string,status:string,order_amount:decimal(12,2),event_date:date>" in daily_plan


def test_gold_aggregations_are_partial_then_final(spark, golden_dir, tmp_path):
    root = str(tmp_path / "wh")
    build_all(spark, str(golden_dir / "*.csv"), root)
    latest = read_layers(spark, root)[C.LATEST]
    for df in (L.daily_region_sales(latest), L.customer_metrics(latest)):
        text = plan_text(df)
        assert "partial_sum" in text and "HashAggregate" in text


def test_contract_aggregates_per_batch_before_the_shuffle(spark, golden_dir):
    obs = CT.observed_types(spark, str(golden_dir / "*.csv"))
    text = plan_text(obs)
    assert "partial_bit_or" in text
    # no per-value explode before the first aggregation: the explode works on per-batch rows
    first_partial = text.index("partial_bit_or")
    assert "Generate" not in text[first_partial:] or text.index("Generate") < first_partial


def test_hot_key_ranks_are_cut_before_the_shuffle(spark):
    keyed = L.required_keys_present(L.bronze(_hot_bronze(spark)))
    ranked = rank_column(keyed, ["event_id"], L.DEDUPE_ORDER, "dedupe_rank")
    text = plan_text(ranked)
    assert text.index("Exchange") < text.rindex("WindowGroupLimit") and "Partial" in text
    assert {r["dedupe_rank"] for r in ranked.select("dedupe_rank").distinct().collect()} == {1}


def test_a_check_reads_only_its_layers(spark):
    if not os.path.exists(SF):
        pytest.skip("driver test data not present")
    queries = E.queries()
    # The five source tables once each; a check on two layers reads just those two.
    assert plan_text(queries["check_bronze_non_empty"](spark, SF)).count("\nLocation:") == 5
    assert plan_text(queries["check_customer_coverage"](spark, SF)).count("\nLocation:") == 2
    assert plan_text(queries["freshness_silver"](spark, SF)).count("\nLocation:") == 2


def test_row_counts_come_from_footers(spark, golden_dir, tmp_path):
    from lakeward.operators import quality as Q
    from lakeward.sources.layout import current_paths, read_footers

    root = str(tmp_path / "wh")
    build_all(spark, str(golden_dir / "*.csv"), root)
    paths = current_paths(spark, root)
    counts = Q.layer_row_counts({layer: read_footers(spark, paths[layer]) for layer in C.LAYERS})
    assert plan_text(counts).count("PushedAggregation: [COUNT(*)]") == 5
    assert {r["layer"]: r["row_count"] for r in counts.collect()} == dict(zip(C.LAYERS, (11, 10, 6, 5, 5)))
    last = read_footers(spark, paths[C.GOLD_DAILY]).agg(F.max("event_date").alias("d"))
    assert "PushedAggregation: [MAX(event_date)]" in plan_text(last) and str(last.first()["d"]) == "2026-04-22"
    # The usual reader is as before.
    assert "PushedAggregation" not in plan_text(read_layers(spark, root)[C.BRONZE].agg(F.count(F.lit(1))))


def test_fifty_headers_make_one_scan(spark, tmp_path):
    from lakeward.sources.batches import headers, read_batches, read_columns
    from tests.conftest import GOLDEN_HEADER, write_csv

    for i in range(50):
        write_csv(tmp_path, f"b{i:02d}.csv", f"{GOLDEN_HEADER},extra{i}", [f"e{i},o{i},c,north,created,{i}.50,2026-05-03 07:00:00,2026-05-03 07:30:00,x"])
    hs = headers(spark, str(tmp_path / "*.csv"))
    raw = read_columns(spark, hs, C.RAW_COLUMNS)
    assert plan_text(raw).count("Scan csv") == plan_text(raw.groupBy("region").count()).count("Scan csv") == 2  # in the tree and in the list
    assert sorted(raw.collect()) == sorted(read_batches(spark, "", hs).select(*raw.columns).collect())
    assert plan_text(CT._measured(spark, hs, False)).count("Scan csv") == 2
    # Other places of the contract's columns, or another width, make one scan more each.
    write_csv(tmp_path, "c.csv", ",".join(reversed(GOLDEN_HEADER.split(","))) + ",more", ["2026-05-03 07:30:00,2026-05-03 07:00:00,9.50,created,north,c,o9,e99,x"])
    write_csv(tmp_path, "d.csv", "event_id", ["e100"])
    more = read_columns(spark, headers(spark, str(tmp_path / "*.csv")), C.RAW_COLUMNS)
    rows = {r["event_id"]: r for r in more.collect()}
    assert plan_text(more).count("Scan csv") == 6 and rows["e99"]["order_amount"] == "9.50" and rows["e100"]["region"] is None
