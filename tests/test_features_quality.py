from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from hourloom.consts import DAY
from hourloom.operators import clean, features as f, quality as q
from hourloom.schemas import FeatureFlags
from hourloom.sources import holidays as h
from tests.conftest import at, collected, hours, ordered


def test_lag_is_the_value_364_days_before(series):
    start = at("2021-01-01")
    rows = [(start + k * timedelta(hours=12), k) for k in range(2 * 1095)]
    got = {r.ts: r for r in f.add_lag_features(series(rows)).collect()}
    last, values = got[rows[-1][0]], dict(rows)
    for name, days in (("lag_1y", 364), ("lag_2y", 728), ("lag_3y", 1092)):
        before = last.ts - timedelta(days=days)
        assert last[name] == values[before]
        assert before.weekday() == last.ts.weekday()
    first = got[start]
    assert (first.lag_1y, first.lag_2y, first.lag_3y) == (None, None, None)


def test_lags_with_gaps_nulls_and_odd_periods(series):
    rnd = random.Random(5)
    days, names = (6, 9, 30), ("x", "y", "z")
    data = {
        name: [(t, rnd.choice([None, rnd.randint(0, 9)])) for t in rnd.sample(hours("1969-11-01", 24 * 90), 800)]
        for name in "ab"
    }
    got = f.add_lag_features(series(data), days, names)
    want = []
    for name, rows in data.items():
        values = dict(rows)
        for t, _ in rows:
            lagged = [values.get(t - timedelta(days=d)) for d in days]
            want.append((name, t, *[None if v is None else float(v) for v in lagged]))
    assert collected(got, "series_id", "ts", *names) == ordered(want)


def test_calendar_counts_weekdays_from_monday(series):
    row = f.add_calendar_features(series([(at("2024-12-30T17:00"), 1)])).first()
    assert (row.hour, row.month, row.year, row.quarter) == (17, 12, 2024, 4)
    assert (row.dayofweek, row.dayofmonth, row.dayofyear) == (0, 30, 365)


def test_holiday_flag_covers_exactly_christmas(spark, series):
    ts = hours("2024-12-24", 72)
    got = f.add_holiday_flag(series([(t, 1) for t in ts]), h.us_holidays(spark))
    assert [r[0] for r in collected(got.orderBy("ts").select("ts", "is_holiday"), "is_holiday", "ts")] == [0] * 48 + [1] * 24
    assert {r.ts for r in got.filter("is_holiday = 1").collect()} == set(ts[24:48])
    assert dict(got.dtypes)["is_holiday"] == "int"


def test_holiday_dimension(spark):
    rows = h.us_holidays(spark).collect()
    dates = {r.holiday_date for r in rows}
    assert (len(rows), len(dates)) == (280, 279)
    assert (min(dates), max(dates)) == (date(2018, 1, 1), date(2039, 12, 26))
    assert date(2024, 12, 25) in dates and date(2030, 12, 25) in dates
    assert date(2024, 10, 22) not in dates
    names = {r.name for r in rows if r.holiday_date == date(2025, 1, 20)}
    assert names == {"Martin Luther King Jr. Day", "Inauguration Day"}
    assert {r.name for r in rows if r.holiday_date == date(2021, 12, 31)} == {"New Year's Day (substitute)"}
    assert sum(r.name == "Juneteenth" for r in rows) == 19
    assert sum(r.name == "Christmas Eve" for r in rows) == 3


def test_holidays_from_files(spark, tmp_path):
    (tmp_path / "h.csv").write_text("date,name\n2024-07-04,Independence Day\n2024-12-25,Christmas Day\n")
    assert h.load_holidays(spark, str(tmp_path / "h.csv")).count() == 2
    page = '{"response": {"holidays": [{"name": "X", "date": {"iso": "2024-07-04T00:00:00"}}]}}'
    pages = spark.createDataFrame([(page,), ('{"response": {"holidays": []}}',)], "body string")
    assert collected(h.holidays_from_json(pages)) == [(date(2024, 7, 4), "X")]
    assert h.holidays_between(spark, 2000, 2018).count() == 12


@pytest.mark.parametrize(
    ("flags", "extra"),
    [
        (FeatureFlags(), []),
        (FeatureFlags(lag=True), ["lag_1y", "lag_2y", "lag_3y"]),
        (FeatureFlags(weather=True), ["temp", "cloud_cover", "precip"]),
        (FeatureFlags(holidays=True), ["is_holiday"]),
        (
            FeatureFlags(True, True, True),
            ["lag_1y", "lag_2y", "lag_3y", "temp", "cloud_cover", "precip", "is_holiday"],
        ),
    ],
)
def test_feature_columns(flags, extra):
    base = ["hour", "month", "year", "quarter", "dayofweek", "dayofmonth", "dayofyear"]
    assert f.feature_columns(flags) == base + extra
    assert f.detect_groups(base + extra) == flags


def test_missing_feature_columns_are_an_error(series):
    frame = f.add_calendar_features(series([(at("2024-01-01"), 1)]))
    assert f.select_features(frame).columns[:3] == ["series_id", "ts", "d"]
    with pytest.raises(ValueError, match="temp"):
        f.select_features(frame, FeatureFlags(weather=True))


def test_capping_and_imputation(series):
    rows = [(at("2024-01-01T05:00"), 10), (at("2024-01-02T05:00"), 500), (at("2024-01-03T05:00"), None),
            (at("2024-01-01T06:00"), None), (at("2024-02-01T05:00"), 77)]
    got = dict(collected(clean.clean(series(rows), 20, 100), "ts", "d"))
    assert got[at("2024-01-03T05:00")] == 60.0  # mean of the capped 20 and 100
    assert got[at("2024-01-01T06:00")] is None  # nothing to learn from
    assert got[at("2024-02-01T05:00")] == 77.0
    capped = clean.cap_outliers(series(rows).withColumn("e", F.col("d")), "e", 20, 100)
    assert collected(capped, "d") == collected(series(rows), "d")
    only_low = series(rows[:1])
    got = dict(collected(clean.impute_month_hour(series(rows), fit_on=only_low), "ts", "d"))
    assert got[at("2024-01-03T05:00")] == 10.0


def report_of(result):
    return {r.expectation: r for r in result.collect()}


def test_on_step_examples(spark):
    rows = [("2023-01-01T00:00:00", "2023-01-01T00:01:00"), ("2023-01-01T01:00:00", "2023-01-01T01:30:00"),
            ("2023-01-01T02:00:00", "2023-01-01T02:45:00")]
    df = spark.createDataFrame([(at(a), at(b)) for a, b in rows], "good timestamp_ntz, bad timestamp_ntz")
    suite = [q.expect_on_step("good"), q.expect_on_step("bad")]
    good, bad = q.report(df, "examples", suite).collect()
    assert (good.success, good.n, good.n_unexpected) == (True, 3, 0)
    assert (bad.success, bad.n_unexpected, bad.unexpected_pct) == (False, 3, 100.0)


def test_not_null_with_a_required_share(series, caplog):
    ts = hours("2024-01-01", 10)
    nine = series([(t, None if k == 0 else 1) for k, t in enumerate(ts)])
    eight = series([(t, None if k < 2 else 1) for k, t in enumerate(ts)])
    assert report_of(q.validate(nine, "w", q.warehouse_suite()))["not_null"].success
    failed = report_of(q.validate(eight, "w", q.warehouse_suite()))["not_null"]
    assert (failed.success, failed.n_unexpected, failed.unexpected_pct) == (False, 2, 20.0)
    q.validate(eight, "w", q.warehouse_suite(), on_fail="warn")
    assert "not_null" in caplog.text
    with pytest.raises(ValueError, match="on_fail"):
        q.validate(eight, "w", q.warehouse_suite(), on_fail="ignore")
    with pytest.raises(q.ValidationFailed, match="not_null"):
        q.validate(eight, "w", q.warehouse_suite(), on_fail="raise")


def test_several_unique_keys_take_one_shuffle(spark):
    rows = [("a", 1, 1.0, "x"), ("a", 1, 2.0, "x"), ("b", 1, 2.0, None), ("b", 2, 2.0, "y"), (None, 2, None, "y"), (None, 2, 3.0, "z")]
    df = spark.createDataFrame(rows, "series_id string, ts int, d double, k string")
    suite = [q.expect_unique("ts"), q.expect_unique("d"), q.expect_unique("k", within=()), q.expect_not_null("k"), q.expect_between("d", 2, 9)]
    result = q.report(df, "s", suite)
    got = [(r.expectation, r.column, r.n, r.n_unexpected) for r in result.collect()]
    assert got == [("unique", "ts", 6, 4), ("unique", "d", 5, 2), ("unique", "k", 5, 4), ("not_null", "k", 6, 1), ("between", "d", 5, 1)]
    alone = [(r.n, r.n_unexpected) for e in suite for r in q.report(df, "s", [e]).collect()]
    assert [g[2:] for g in got] == alone
    plan = q.report(df, "s", suite)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Expand") == 1
    assert [r.n for r in q.report(df.limit(0), "s", suite).collect()] == [0] * 5


def test_model_input_suite(series, spark):
    ts = hours("2024-01-01", 5)
    frame = f.add_features(series([(ts[0], 50), (ts[0], 60), (ts[1], None), (ts[2], 500), (ts[3], 100)]), h.us_holidays(spark))
    suite = q.model_input_suite(low=60, high=100)
    got = report_of(q.validate(frame, "m", suite))
    assert got["columns_match_set"].success
    assert (got["unique"].n, got["unique"].n_unexpected, got["unique"].success) == (5, 2, False)
    assert (got["between"].n, got["between"].n_unexpected) == (4, 2)
    assert (got["in_set"].success, got["on_step"].success) == (True, True)
    wider = report_of(q.validate(frame.withColumn("temp", F.lit(1)), "m", suite))
    assert not wider["columns_match_set"].success
    absent = report_of(q.validate(frame.drop("is_holiday"), "m", suite))
    assert not absent["in_set"].success


def test_empty_frame_passes_row_checks(series):
    got = report_of(q.validate(series([(at("2024-01-01"), 1)]).limit(0), "w", q.warehouse_suite()))
    assert got["not_null"].success and got["not_null"].n == 0


def test_leak_guard(spark):
    schema = "series_id string, ts timestamp_ntz"
    end = spark.createDataFrame([("a", at("2024-01-02"))], schema)
    q.assert_no_leak(end, spark.createDataFrame([("a", at("2024-01-02"))], schema))
    with pytest.raises(q.LeakError):
        q.assert_no_leak(end, spark.createDataFrame([("a", at("2024-01-01T23:00"))], schema))


def test_assert_full_index(series):
    from hourloom.operators.series import full_index_check

    ts = [at("2024-01-01"), at("2024-01-02"), at("2024-01-04")]
    q.assert_full_index(full_index_check(series([(t, 1) for t in ts[:2]]), DAY))
    with pytest.raises(q.ValidationFailed):
        q.assert_full_index(full_index_check(series([(t, 1) for t in ts]), DAY))
