"""The golden batches through one build, layer by layer in the order they are made."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from lakeward import config as C
from lakeward.plans.build import build_all
from lakeward.sources.layout import read_layers
from tests.conftest import GOLDEN_BATCH_1, GOLDEN_BATCH_2, GOLDEN_HEADER, write_csv


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """(input pattern, warehouse root) of a build that the tests only read."""
    raw = tmp_path_factory.mktemp("raw")
    write_csv(raw, "orders_batch_1.csv", GOLDEN_HEADER, GOLDEN_BATCH_1)
    write_csv(raw, "orders_batch_2.csv", GOLDEN_HEADER, GOLDEN_BATCH_2)
    pattern, root = str(raw / "*.csv"), str(tmp_path_factory.mktemp("warehouse"))
    build_all(spark, pattern, root)
    return pattern, root


@pytest.fixture()
def layers(spark, built):
    return read_layers(spark, built[1])


def by_key(df, key: str) -> dict:
    rows = {r[key]: r for r in df.collect()}
    assert len(rows) == df.count(), f"{key} repeats"
    return rows


def test_bronze_has_every_row_of_its_batches(layers):
    rows = [tuple(r) for r in layers[C.BRONZE].groupBy("source_file").count().collect()]
    assert sorted((path.rsplit("/", 1)[-1], n) for path, n in rows) == [("orders_batch_1.csv", 6), ("orders_batch_2.csv", 5)]
    assert tuple(layers[C.BRONZE].columns) == C.BRONZE_COLUMNS


def test_silver_has_one_row_an_event_the_last_delivered(layers):
    events = by_key(layers[C.SILVER], "event_id")
    assert sorted(events) == [f"evt-{n}" for n in range(1001, 1011)]
    # Delivered twice, four minutes apart.
    assert events["evt-1005"]["ingestion_ts"] == dt.datetime(2026, 4, 21, 12, 5)
    assert tuple(layers[C.SILVER].columns) == C.SILVER_COLUMNS


def test_latest_state_goes_by_event_time(layers):
    orders = by_key(layers[C.LATEST], "order_id")
    assert {k: r["status"] for k, r in orders.items()} == {
        "ord-001": "delivered", "ord-002": "delivered", "ord-003": "delivered", "ord-004": "cancelled", "ord-005": "delivered", "ord-006": "delivered"}
    # The delivery of ord-002 came in two days late and is still its newest event.
    assert orders["ord-002"]["ingestion_ts"] == dt.datetime(2026, 4, 22, 9, 15)
    assert tuple(layers[C.LATEST].columns) == C.LATEST_COLUMNS


def test_gold_sums_delivered_orders_by_customer(layers):
    got = {k: tuple(r)[1:] for k, r in by_key(layers[C.GOLD_CUSTOMER], "customer_id").items()}
    at = lambda day, hour, minute=0: dt.datetime(2026, 4, day, hour, minute)
    assert got == {
        "cust-001": (2, 2, Decimal("330.50"), at(22, 11)), "cust-002": (1, 1, Decimal("89.00"), at(20, 16, 45)),
        "cust-003": (1, 1, Decimal("140.25"), at(21, 17, 10)), "cust-004": (1, 0, Decimal("0.00"), at(21, 13, 10)),
        "cust-005": (1, 1, Decimal("45.00"), at(22, 18, 20))}


def test_gold_sums_delivered_orders_by_day_and_region(layers):
    got = {(r["event_date"].day, r["region"]): (r["delivered_orders"], r["delivered_revenue"]) for r in layers[C.GOLD_DAILY].collect()}
    assert got == {(20, "east"): (1, Decimal("120.50")), (20, "west"): (1, Decimal("89.00")), (21, "central"): (1, Decimal("140.25")),
                   (22, "east"): (1, Decimal("210.00")), (22, "west"): (1, Decimal("45.00"))}


def test_building_again_changes_no_row(spark, built, layers):
    before = {layer: sorted(map(repr, df.collect())) for layer, df in layers.items()}
    build_all(spark, *built)
    assert {layer: sorted(map(repr, df.collect())) for layer, df in read_layers(spark, built[1]).items()} == before
