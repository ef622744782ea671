"""keep_latest: window and aggregate strategies against brute force."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from lakeward.operators import layers as L
from lakeward.operators.keyed import keep_latest

ROW = st.tuples(st.sampled_from(["k1", "k2", "k3"]),
                st.one_of(st.none(), st.integers(0, 3)),
                st.one_of(st.none(), st.integers(0, 3)),
                st.integers(0, 1000))


def brute(rows):
    # desc NULLS LAST on (a, b, c): NULL ranks below every value
    def key(r):
        return tuple((0, 0) if v is None else (1, v) for v in r[1:])
    best = {}
    for r in rows:
        if r[0] not in best or key(r) > key(best[r[0]]):
            best[r[0]] = r
    return sorted(best.values())


@settings(max_examples=15, deadline=None)
@given(st.lists(ROW, min_size=1, max_size=25, unique_by=lambda r: r[3]))
def test_strategies_match_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, a int, b int, c int")
    want = brute(rows)
    for strategy in ("window", "aggregate"):
        got = sorted(tuple(r) for r in keep_latest(df, ["k"], ["a", "b", "c"], strategy=strategy).collect())
        assert got == want, strategy


def test_ties_on_both_time_keys_resolve_deterministically(spark):
    cols = "source_file string, event_id string, order_id string, customer_id string, region string, " \
           "status string, order_amount string, event_ts string, ingestion_ts string"
    same = ("evt-1", "ord-1", "cust-1", "east")
    rows = [("b1", *same, "created", "5.00", "2026-04-20 10:00:00", "2026-04-20 10:00:00"),
            ("b2", *same, "delivered", "5.00", "2026-04-20 10:00:00", "2026-04-20 10:00:00")]
    for order in (rows, rows[::-1]):
        s = L.silver(L.bronze(spark.createDataFrame(order, cols))).collect()
        assert len(s) == 1 and s[0]["status"] == "delivered" and s[0]["source_file"] == "b2"


def test_late_older_event_does_not_replace_newer_state(spark):
    cols = "source_file string, event_id string, order_id string, customer_id string, region string, " \
           "status string, order_amount string, event_ts string, ingestion_ts string"
    rows = [("b1", "evt-2", "ord-1", "c", "east", "delivered", "5.00", "2026-04-21 10:00:00", "2026-04-21 10:01:00"),
            ("b2", "evt-1", "ord-1", "c", "east", "created", "5.00", "2026-04-20 10:00:00", "2026-04-22 10:00:00")]
    latest = L.latest_state(L.silver(L.bronze(spark.createDataFrame(rows, cols)))).collect()
    assert [r["status"] for r in latest] == ["delivered"]


def test_null_keys_never_enter_silver_nor_displace_good_rows(spark):
    cols = "source_file string, event_id string, order_id string, customer_id string, region string, " \
           "status string, order_amount string, event_ts string, ingestion_ts string"
    good = ("b1", "evt-1", "ord-1", "c", "east", "created", "5.00", "2026-04-20 10:00:00", "2026-04-20 10:00:00")
    rows = [good]
    for i in range(1, 6):  # each key column NULL in turn, on a newer delivery of the same event
        r = list(good)
        r[8] = "2026-04-20 11:00:00"
        if i != 1:
            r[i] = None
            rows.append(tuple(r))
    nulled = list(good)
    nulled[1] = None
    rows.append(tuple(nulled))
    s = L.silver(L.bronze(spark.createDataFrame(rows, cols))).collect()
    assert len(s) == 1 and str(s[0]["ingestion_ts"]) == "2026-04-20 10:00:00"


def test_null_amount_and_null_event_ts(spark):
    cols = "source_file string, event_id string, order_id string, customer_id string, region string, " \
           "status string, order_amount string, event_ts string, ingestion_ts string"
    rows = [("b", "evt-1", "ord-1", "c", "east", "delivered", None, "2026-04-20 10:00:00", "2026-04-20 10:00:00"),
            ("b", "evt-2", "ord-2", "c", "east", "delivered", "3.00", None, "2026-04-20 10:00:00"),
            ("b", "evt-3", "ord-2", "c", "east", "created", "3.00", "2026-04-19 10:00:00", "2026-04-20 09:00:00")]
    latest = L.latest_state(L.silver(L.bronze(spark.createDataFrame(rows, cols))))
    by_order = {r["order_id"]: r for r in latest.collect()}
    # NULL event time ranks last, so the dated event is the latest state of ord-2
    assert by_order["ord-2"]["status"] == "created"
    daily = L.daily_region_sales(latest).collect()
    assert len(daily) == 1 and daily[0]["delivered_revenue"] is None and daily[0]["delivered_orders"] == 1
    # customer revenue: the NULL delivered amount is skipped, the created order adds 0.00
    cust = L.customer_metrics(latest).collect()[0]
    assert cust["delivered_orders"] == 1 and str(cust["delivered_revenue"]) == "0.00"
