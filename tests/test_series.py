from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from hourloom.consts import DAY, HOUR
from hourloom.operators import folds, series as s
from hourloom.operators.numbering import missing_ranges, number_rows
from hourloom.sources.paged import PAGED_RECORD
from tests.conftest import at, collected, hours, ordered


def test_grid_includes_both_ends(series):
    df = series([(at("2024-01-01T03:00"), 1), (at("2024-01-01T08:00"), 2)])
    assert [r[0] for r in collected(s.make_grid(s.time_bounds(df)), "ts")] == hours("2024-01-01T03:00", 6)


@pytest.mark.parametrize("step", [timedelta(minutes=7), HOUR, DAY, timedelta(days=3)])
def test_grid_over_several_blocks(series, step):
    start = at("2023-12-31T22:10:05")
    for n in (1, 1024, 1025, 2500):
        df = series([(start, 1), (start + (n - 1) * step + step / 2, 2)])
        got = [r[0] for r in collected(s.make_grid(s.time_bounds(df), step), "ts")]
        assert got == [start + k * step for k in range(n)]


def test_fill_grid_keeps_every_step_and_drops_rows_off_the_grid(series):
    ts = hours("2024-01-01T00:00", 5)
    df = series([(ts[0], 1), (ts[1] + timedelta(minutes=5), 7), (ts[2], None), (ts[4], 5)])
    assert collected(s.fill_grid(df), "ts", "d") == list(zip(ts, [1.0, None, None, None, 5.0]))


def test_fill_grid_with_request_bounds(spark, series):
    ts = hours("2024-01-01T00:00", 4)
    bounds = spark.createDataFrame([("a", ts[0], ts[3])], "series_id string, start_ts timestamp_ntz, end_ts timestamp_ntz")
    got = s.fill_grid(series([(ts[1], 1)]), bounds=bounds)
    assert collected(got, "ts", "d") == list(zip(ts, [None, 1.0, None, None]))


def test_dedupe_keeps_first_by_priority_even_when_null(spark):
    df = spark.createDataFrame(
        [("a", 1, 2, 5.0, "x"), ("a", 1, 1, None, "y"), ("b", 1, 1, 1.0, "z")],
        "k string, n int, p int, d double, note string",
    )
    assert collected(s.dedupe_first(df, ["k", "n"], "p"), "k", "d", "note") == [
        ("a", None, "y"), ("b", 1.0, "z"),
    ]
    one = s.dedupe_first(df.drop("note"), ["k", "n"], "p")
    assert collected(one, "k", "d") == [("a", None), ("b", 1.0)]
    again = s.dedupe_first(one.withColumn("p", F.lit(0)), ["k", "n"], "p")
    assert collected(again) == collected(one)


def test_concat_of_overlapping_and_disjoint_series(series):
    first = series([(t, 1) for t in hours("2023-12-31T14:00", 11)])
    second = series([(t, 2) for t in hours("2023-12-31T19:00", 11)])
    both = s.concat_series([second, first])
    assert len(collected(both)) == 16
    assert {d for t, d in collected(both, "ts", "d") if t >= at("2023-12-31T19:00")} == {2.0}
    apart = s.concat_series([series([(t, 1) for t in hours("2024-01-01", 3)]),
                             series([(t, 1) for t in hours("2024-02-01", 3)])])
    assert len(collected(apart)) == 6


def test_concat_prefers_a_stored_null_unless_told_otherwise(series):
    t = at("2024-01-01")
    stored, fresh = series([(t, None)]), series([(t, 3)])
    assert collected(s.concat_series([stored, fresh]), "d") == [(None,)]
    assert collected(s.concat_series([stored, fresh], fill_stored_nulls=True), "d") == [(3.0,)]


def test_concat_is_associative(series):
    ts = hours("2024-01-01", 6)
    a, b, c = (series([(t, k) for t in ts[k : k + 4]]) for k in range(3))
    left = s.concat_series([s.concat_series([a, b]), c])
    right = s.concat_series([a, s.concat_series([b, c])])
    assert collected(left) == collected(right)


def test_full_index_check(series):
    ts = hours("2024-01-01", 101)
    frames = {
        "full": ts,
        "gap": ts[:3] + ts[5:],
        "copy": [*ts, ts[4]],
        "copy_and_gap": [*ts[:50], *ts[51:], ts[4]],
        "off": [t + timedelta(minutes=5) * (k == 7) for k, t in enumerate(ts)],
        "shifted": [t + timedelta(minutes=5) for t in ts],
        "one": ts[:1],
    }
    df = series({k: [(t, 1) for t in v] for k, v in frames.items()})
    got = dict(collected(s.full_index_check(df), "series_id", "full_index"))
    assert got == {k: k in ("full", "shifted", "one") for k in frames}


def test_facet_is_chosen_before_deduplication(spark):
    rows = [
        ("2024-01-01T00", "a", "DF", "9", 0),
        ("2024-01-01T00", "a", "D", "1", 1),
        ("2024-01-01T00", "a", "D", "2", 2),
        ("2024-01-01T03", "a", "DF", "8", 3),
    ]
    raw = spark.createDataFrame(rows, PAGED_RECORD)
    got = s.to_warehouse(raw)
    assert collected(got, "ts", "d") == list(zip(hours("2024-01-01", 4), [1.0, None, None, None]))
    wide = s.facets_wide(s.typed_raw(raw))
    assert collected(wide, "ts", "d", "df")[0] == (at("2024-01-01"), 1.0, 9.0)


def test_bad_number_stops_the_transform(spark):
    raw = spark.createDataFrame([("2024-01-01T00", "a", "D", "x", 0)], PAGED_RECORD)
    with pytest.raises(Exception, match="not a number"):
        s.to_warehouse(raw).collect()


def random_series(seed):
    rnd = random.Random(seed)
    out = {}
    for name in "abc":
        ts = sorted(rnd.sample(hours("2023-11-20", 24 * 120), 300))
        out[name] = [(t, rnd.randint(0, 50)) for t in ts]
    return out


def test_missing_ranges_against_brute_force(series):
    data = random_series(1)
    want = []
    for name, rows in data.items():
        for (a, _), (b, _) in zip(rows, rows[1:]):
            if b - a > HOUR:
                want.append((name, a + HOUR, b - HOUR, (b - a) // HOUR - 1))
    got = missing_ranges(series(data), HOUR)
    assert collected(got, "series_id", "start_ts", "end_ts", "n_missing") == ordered(want)


@pytest.mark.parametrize("from_end", [False, True])
def test_row_numbers_against_brute_force(series, from_end):
    data = random_series(2)
    want = []
    for name, rows in data.items():
        in_order = rows[::-1] if from_end else rows
        want += [(name, t, k) for k, (t, _) in enumerate(in_order, start=1)]
    got = number_rows(series(data), from_end=from_end)
    assert collected(got, "series_id", "ts", "row_no") == ordered(want)


def test_holdout_by_time_equals_holdout_by_rows_on_a_full_grid(series):
    df = series({"a": [(t, 1) for t in hours("2024-01-01", 200)], "b": [(t, 1) for t in hours("2024-01-20", 900)]})
    assert collected(folds.holdout_split(df, 48)) == collected(folds.holdout_split(df, 48, HOUR))
    assert folds.holdout_split(df, 48).filter("not is_train").count() == 96


def test_trailing_window_includes_its_first_moment(series):
    df = series([(t, 1) for t in hours("2024-01-01", 24 * 10)])
    got = folds.trailing_window(df, 7)
    assert got.count() == 24 * 7 + 1


def test_folds_expand_and_do_not_leak(series):
    df = series({"a": [(t, 1) for t in hours("2024-01-01", 60)], "b": [(t, 1) for t in hours("2024-01-01", 41)]})
    by_step = collected(folds.ts_folds(df, 4, 10, HOUR))
    assert by_step == collected(folds.ts_folds(df, 4, 10, None))
    for row in folds.ts_folds(df, 4, 10, HOUR).collect():
        n = 60 if row.series_id == "a" else 41
        assert (row.n_train, row.n_test) == (n - (5 - row.fold) * 10, 10)
        assert row.train_end + HOUR == row.test_start
        assert row.train_start == at("2024-01-01")


@pytest.mark.parametrize("step", [HOUR, None])
def test_too_short_a_series_is_an_error(series, step):
    df = series([(t, 1) for t in hours("2024-01-01", 40)])
    with pytest.raises(Exception, match="too short"):
        folds.with_segment(df, 4, 10, step).collect()
