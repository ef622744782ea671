"""Registered queries against their DuckDB oracle on sf0.001 (a fast subset),
plus the driver contract shape."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as E
from lakeward.plans import catalog
from lakeward.sources.fixtures import TABLES
from scripts.check_oracle import digest

SF = "/root/testdata/sf0.001"
FAST = ["bronze_orders", "silver_orders", "silver_latest_order_state", "gold_daily_region_sales",
        "gold_customer_order_metrics", "dedupe_events", "validation_metrics", "layer_freshness",
        "validation_checks", "validation_summary_json", "check_silver_unique_events", "reconcile_daily_revenue",
        "freshness_customer_metrics", "agg_layer_row_counts", "contract_gate_clean", "fn_type_name", "test_not_null", "fn_iso_timestamp", "fn_to_timestamp", "agg_having_duplicates"]


@pytest.fixture(scope="module")
def con():
    if not os.path.exists(SF):
        pytest.skip("driver test data not present")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def test_contract_shape():
    q, o = E.queries(), E.oracle_sql()
    assert len(q) >= 91
    assert set(o) <= set(q)
    assert set(catalog.QUERIES) == set(catalog.ORACLE)


def test_entry_runs(spark):
    if not os.path.exists(SF):
        pytest.skip("driver test data not present")
    df = E.entry(spark)
    assert df.columns == ["event_date", "region", "delivered_orders", "delivered_revenue"]
    assert df.count() == 473


@pytest.mark.parametrize("key", FAST)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[key])
    c1, _, h1 = digest(df.columns, rows)
    c2, _, h2 = digest([d[0] for d in res.description], res.fetchall())
    assert (c1, h1) == (c2, h2)
