"""Revenue whose total over a layer is beyond decimal(12,2), though no amount and no gold row is."""

from __future__ import annotations

import datetime as dt
import json
import signal
from decimal import Decimal

import pytest
from conftest import GOLDEN_HEADER, write_csv

import __spark_entry__ as E
from lakeward import config as C
from lakeward.plans.validate import snapshot, validate

MOST = Decimal("9999999999.99")
SUMS = {"agg_coalesced_revenue": [4 * MOST], "reconcile_customer_revenue": [str(4 * MOST)], "reconcile_daily_revenue": [str(4 * MOST)],
        "validate_layers": [4 * MOST], "validation_checks": [str(4 * MOST)], "validation_metrics": [4 * MOST], "validation_summary": [4 * MOST],
        "agg_decimal_sum": [4 * MOST], "pipeline_snapshot": [str(4 * MOST)]}
DECIMALS = ("agg_coalesced_revenue", "agg_decimal_sum", "validate_layers", "validation_metrics", "validation_summary")


@pytest.fixture(autouse=True)
def ends_in_time():
    def late(*_):
        raise TimeoutError("a metric that was never delivered")

    before = signal.signal(signal.SIGALRM, late)
    signal.alarm(150)
    yield
    signal.alarm(0)
    signal.signal(signal.SIGALRM, before)


def tables(spark, folder, amount: Decimal) -> str:
    """Four delivered orders of ``amount``, each of its own customer and day, all of one region."""
    day = dt.datetime(2026, 4, 20)
    for name, schema, rows in (
        ("region", "r_regionkey int, r_name string", [(1, "EAST")]),
        ("nation", "n_nationkey int, n_regionkey int", [(1, 1)]),
        ("customer", "c_custkey long, c_nationkey int", [(k, 1) for k in range(4)]),
        ("orders", "o_orderkey long, o_custkey long", [(k, k) for k in range(4)]),
        ("lineitem", "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice decimal(12,2), "
                     "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
         [(k, 1, k, 1, amount, "N", "F", day + dt.timedelta(days=k)) for k in range(4)]),
    ):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("key", SUMS)
def test_totals_beyond_the_money_type_are_whole(spark, tmp_path, key):
    rows = E.queries()[key](spark, tables(spark, tmp_path, MOST)).collect()
    assert all(any(total in tuple(r) for r in rows) for total in SUMS[key])


def test_the_summary_as_json_has_the_whole_total(spark, tmp_path):
    text = E.queries()["validation_summary_json"](spark, tables(spark, tmp_path, MOST)).first()[0]
    assert json.loads(text)["delivered_revenue_from_gold_daily"] == str(4 * MOST)


@pytest.mark.parametrize("key", DECIMALS)
def test_totals_that_fit_have_the_type_of_the_sql(spark, tmp_path, key):
    df = E.queries()[key](spark, tables(spark, tmp_path, Decimal("1.50")))
    money = [f for f in df.schema if f.dataType.simpleString().startswith("decimal")]
    assert money and {f.dataType.simpleString() for f in money} == {C.MONEY_TYPE}
    assert all(r[f.name] == Decimal("6.00") for r in df.collect() for f in money)


def test_a_snapshot_observes_a_total_beyond_the_money_type(spark, tmp_path):
    rows = [f"evt-{k},ord-{k},cust-{k},east,delivered,{MOST},2026-04-2{k} 09:00:00,2026-04-2{k} 09:00:00" for k in range(4)]
    path = write_csv(tmp_path, "batch.csv", GOLDEN_HEADER, rows)
    snap = snapshot(spark, path, str(tmp_path / "wh"))
    assert snap["status"] == "ready" and snap["validation"]["delivered_revenue_from_silver"] == str(4 * MOST)
    assert validate(spark, str(tmp_path / "wh"), path).to_dict() == snap["validation"]
