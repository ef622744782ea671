"""Column functions."""

from __future__ import annotations

import datetime as dt

import pytest

from pyspark.sql import functions as F

from lakeward.functions import columns as X


def test_lag_minutes_is_floored(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 1, 10, 0, 0), dt.datetime(2026, 1, 1, 10, 0, 1))],
                               "src timestamp_ntz, lay timestamp_ntz")
    r = df.select(X.lag_minutes("src", "lay").alias("a"), X.lag_minutes("lay", "src").alias("b")).first()
    assert (r["a"], r["b"]) == (-1, 0)


def test_iso_text(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 4, 22, 18, 21), dt.datetime(2026, 4, 22, 18, 21, 0, 120),
                                 dt.date(2026, 4, 22))], "a timestamp_ntz, b timestamp_ntz, d date")
    r = df.select(X.iso_timestamp("a"), X.iso_timestamp("b"), X.iso_date("d"),
                  X.iso_timestamp(F.lit(None).cast("timestamp_ntz")), X.iso_date(F.lit(None).cast("date"))).first()
    assert tuple(r) == ("2026-04-22 18:21:00", "2026-04-22 18:21:00.000120", "2026-04-22", "", "")


def test_sla_status_precedence(spark):
    df = spark.createDataFrame([(5, None, 10, None), (11, 0, 10, 0), (None, 1, None, 0), (None, None, 5, 0)],
                               "lm bigint, ld bigint, sm bigint, sd bigint")
    got = [r[0] for r in df.select(X.sla_status("lm", "ld", "sm", "sd")).collect()]
    assert got == ["healthy", "breach", "breach", "unknown"]


def test_type_name(spark):
    df = spark.createDataFrame([("decimal(12, 2)",), ("varchar",), ("timestamp with time zone",)], "t string")
    assert [r[0] for r in df.select(X.type_name("t")).collect()] == ["DECIMAL", "VARCHAR", "TIMESTAMP WITH TIME ZONE"]


def test_money_overflow_raises(spark):
    import pytest
    df = spark.createDataFrame([("12345678901.00",)], "a string")
    with pytest.raises(Exception):
        df.select(X.as_decimal_money("a")).collect()


@pytest.fixture(params=[("false", "America/New_York"), ("true", "Asia/Tokyo")])
def other_session(spark, request):
    old = spark.conf.get("spark.sql.ansi.enabled"), spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.ansi.enabled", request.param[0])
    spark.conf.set("spark.sql.session.timeZone", request.param[1])
    yield spark
    spark.conf.set("spark.sql.ansi.enabled", old[0])
    spark.conf.set("spark.sql.session.timeZone", old[1])


@pytest.mark.parametrize("text,wall", [
    ("2026-03-08 02:30:00", "2026-03-08 02:30:00"), ("2026-03-08T02:30:00.25", "2026-03-08 02:30:00.25"),
    ("2026-03-08 02:30:00+02:00", "2026-03-08 00:30:00"), ("2026-03-08 02:30:00Z", "2026-03-08 02:30:00"),
    ("1969-12-31 23:00:00.5-0100", "1970-01-01 00:00:00.5"), ("2026-03-08", "2026-03-08 00:00:00"), (None, None)])
def test_wall_clock_ignores_the_session_zone(other_session, text, wall):
    df = other_session.createDataFrame([(text,)], "t string")
    assert df.select(X.to_wall_clock("t").cast("string")).first()[0] == wall


@pytest.mark.parametrize("cast,text", [(X.as_decimal_money, "99999999999.00"), (X.as_decimal_money, "x"),
                                       (X.to_wall_clock, "2026-02-30 09:00:00"), (X.to_wall_clock, "2026-02-30 09:00:00Z")])
def test_bad_text_raises_in_any_mode(other_session, cast, text):
    with pytest.raises(Exception, match="not a"):
        other_session.createDataFrame([(text,)], "t string").select(cast("t")).collect()
