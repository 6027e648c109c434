from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from hourloom.functions import time as t
from hourloom.functions import values as v
from tests.conftest import at


def one(spark, column, **values):
    """Evaluate a column over one row of timestamps or texts."""
    row = [(k, x) for k, x in values.items()]
    df = spark.range(1).select(
        *[t.ntz(x).alias(k) if hasattr(x, "year") else F.lit(x).alias(k) for k, x in row]
    )
    return df.select(column.alias("x")).first().x


def test_floors_ignore_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ts = at("2024-03-10T02:30:15")  # an hour that New York skips
        assert one(spark, t.floor_hour("ts"), ts=ts) == at("2024-03-10T02:00:00")
        assert one(spark, t.floor_day("ts"), ts=ts) == at("2024-03-10")
        assert one(spark, t.floor_quarter("ts"), ts=ts) == at("2024-01-01")
        assert one(spark, t.compact_ts("ts"), ts=ts) == "2024-03-10_02"
        assert one(spark, t.epoch_seconds("ts"), ts=ts) == 1710037815
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    ("ts", "rounded"),
    [
        ("2024-01-01T00:30:00", "2024-01-01T00:00:00"),
        ("2024-01-01T01:30:00", "2024-01-01T02:00:00"),
        ("2024-01-01T01:30:00.000001", "2024-01-01T02:00:00"),
        ("2024-01-01T02:30:00.000001", "2024-01-01T03:00:00"),
        ("2024-01-01T23:59:59", "2024-01-02T00:00:00"),
        ("2024-01-01T05:29:59.999999", "2024-01-01T05:00:00"),
    ],
)
def test_round_hour_is_half_even(spark, ts, rounded):
    assert one(spark, t.round_hour("ts"), ts=at(ts)) == at(rounded)
    assert one(spark, t.usable_until("ts", 72), ts=at(ts)) == at(rounded) - timedelta(hours=72)


def test_quantized_range(spark):
    assert one(spark, t.quantize_start("ts"), ts=at("2024-01-01T05:00")) == at("2024-01-01")
    assert one(spark, t.quantize_end("ts"), ts=at("2024-01-01T05:00")) == at("2024-01-02")
    assert one(spark, t.quantize_end("ts"), ts=at("2024-01-01")) == at("2024-01-02")


def test_range_key_and_compact_form(spark):
    key = one(
        spark, t.range_key("demand", "a", "b"), a=at("2019-01-01"), b=at("2024-08-18T07:00")
    )
    assert key == "demand_2019-01-01_00_2024-08-18_07.parquet"
    assert one(spark, t.parse_compact_ts("x"), x="2024-08-18_07") == at("2024-08-18T07:00")


def test_plus_years_clips_leap_day(spark):
    assert one(spark, t.plus_years("ts", 3), ts=at("2016-02-29T05:00")) == at("2019-02-28T05:00")
    assert one(spark, t.plus_years("ts", 3), ts=at("2015-07-01T05:00")) == at("2018-07-01T05:00")


@pytest.mark.parametrize(
    ("ts", "good"),
    [
        ("2023-01-01T00:00:00", True),
        ("2023-01-01T02:00:00.5", True),
        ("2023-01-01T00:01:00", False),
        ("2023-01-01T01:30:00", False),
        ("2023-01-01T00:00:07", False),
    ],
)
def test_on_step(spark, ts, good):
    assert one(spark, t.on_step("ts"), ts=at(ts)) is good


def test_numbers(spark):
    assert one(spark, v.strict_numeric("x"), x="12.5") == 12.5
    assert one(spark, v.strict_numeric("x"), x="NaN") is None
    assert one(spark, v.comma_numeric("x"), x="1,234,567.5") == 1234567.5
    assert one(spark, v.comma_numeric("x"), x="") is None
    assert one(spark, v.tolerant_numeric("x"), x="n/a") is None
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        with pytest.raises(Exception, match="not a number: n/a"):
            one(spark, v.strict_numeric("x"), x="n/a")
    spark.conf.set("spark.sql.ansi.enabled", "true")


def test_capping_keeps_null(spark):
    rows = spark.createDataFrame([(None,), (1.0,), (5.0,), (99.0,)], "d double")
    assert [r.d for r in rows.select(v.capped("d", 2.0, 10.0).alias("d")).collect()] == [None, 2.0, 5.0, 10.0]


def test_feature_codes(spark):
    def code(*columns):
        return spark.range(1).select(
            v.detected_feature_code(F.array(*[F.lit(c) for c in columns])).alias("x")
        ).first().x

    lags, weather = ("lag_1y", "lag_2y", "lag_3y"), ("temp", "cloud_cover", "precip")
    assert code("hour") == "fB___"
    assert code("hour", *lags) == "fBL__"
    assert code("hour", *lags[:2]) == "fB___"
    assert code("hour", "is_holiday") == "fB__H"
    assert code("hour", *lags, *weather, "is_holiday") == "fBLWH"
