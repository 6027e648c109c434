from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from hourloom.consts import DAY
from hourloom.operators import chunks as c
from hourloom.operators import intervals as iv
from hourloom.schemas import CHUNK_INDEX, SchemaMismatch, assert_schema
from tests.conftest import at, collected, ordered

SPAN = "series_id string, start_ts timestamp_ntz, end_ts timestamp_ntz"


@pytest.fixture
def spans(spark):
    return lambda rows: spark.createDataFrame([r if len(r) == 3 else ("a", *r) for r in rows], SPAN)


@pytest.mark.parametrize(
    ("given", "merged"),
    [
        ([(1, 2), (3, 4), (5, 6)], [(1, 2), (3, 4), (5, 6)]),
        ([(0, 10), (7, 8), (1, 9), (2, 8)], [(0, 10)]),
        ([(9, 10), (0, 5), (2, 7)], [(0, 7), (9, 10)]),
        ([(0, 3), (3, 5)], [(0, 5)]),
        ([], []),
    ],
)
def test_merge_cases(spark, spans, given, merged):
    # As numbers, with one bucket, and as days that cross months.
    numbers = spark.createDataFrame(
        [("a", float(s), float(e)) for s, e in given], "series_id string, start_ts double, end_ts double"
    )
    got = iv.merge_intervals(numbers, bucket=F.floor(F.col("start_ts") / 4))
    assert collected(got, "start_ts", "end_ts") == [(float(s), float(e)) for s, e in merged]
    day = lambda k: at("2024-01-27") + k * DAY
    got = iv.merge_intervals(spans([(day(s), day(e)) for s, e in given]))
    assert collected(got, "start_ts", "end_ts") == [(day(s), day(e)) for s, e in merged]


def test_merge_against_brute_force(spans):
    rnd = random.Random(3)
    for n, longest in ((40, 100), (200, 20), (150, 400), (300, 2)):
        rows = []
        for name in "ab":
            for _ in range(n):
                start = at("2023-01-01") + timedelta(days=rnd.randint(0, 700))
                rows.append((name, start, start + timedelta(days=rnd.randint(0, longest))))
        want = []
        for name in "ab":
            current = None
            for _, start, end in sorted(r for r in rows if r[0] == name):
                if current and current[2] >= start:
                    current = (name, current[1], max(current[2], end))
                else:
                    want += [current] if current else []
                    current = (name, start, end)
            want.append(current)
        assert collected(iv.merge_intervals(spans(rows))) == ordered(want)


def test_intersections(spans):
    day = lambda k: at("2024-01-01") + k * DAY
    cases = [((0, 10), (5, 15), (5, 10)), ((0, 10), (2, 3), (2, 3)), ((2, 3), (0, 100), (2, 3)),
             ((0, 5), (5, 9), (5, 5)), ((0, 4), (5, 9), None)]
    for a, b, want in cases:
        got = iv.intersect_intervals(spans([tuple(map(day, a))]), spans([tuple(map(day, b))]))
        assert collected(got, "start_ts", "end_ts") == ([tuple(map(day, want))] if want else [])
    with pytest.raises(Exception, match="ends before"):
        iv.intersect_intervals(spans([(day(3), day(1))]), spans([(day(0), day(1))])).collect()


def test_intersections_against_brute_force(spans):
    rnd = random.Random(4)

    def some(n):
        out = set()
        for _ in range(n):
            start = at("2023-01-01") + timedelta(hours=rnd.randint(0, 9000))
            out.add((rnd.choice("ab"), start, start + timedelta(hours=rnd.randint(0, 3000))))
        return sorted(out)

    a, b = some(40), some(50)
    want = [
        (x[0], max(x[1], y[1]), min(x[2], y[2]))
        for x in a for y in b if x[0] == y[0] and max(x[1], y[1]) <= min(x[2], y[2])
    ]
    got = iv.intersect_intervals(spans(a + a[:3]), spans(b))
    assert collected(got, "series_id", "start_ts", "end_ts") == ordered(want)


def test_intersections_of_very_uneven_lengths(spans):
    """Ten years, a day and many seconds: slots as wide as the shortest would make hundreds of millions of pieces."""
    second = timedelta(seconds=1)
    long = [("a", at("2014-01-01"), at("2024-01-01")), ("a", at("2016-02-29"), at("2016-03-01")), ("b", at("2014-01-01"), at("2014-01-01"))]
    short = [("a", at("2013-12-31T23:00") + k * 7 * DAY, at("2013-12-31T23:00") + k * 7 * DAY + (k % 3) * second) for k in range(600)]
    short += [("b", at("2014-01-01") - second, at("2014-01-01")), ("b", at("2014-01-01") + second, at("2015-01-01")), ("c", *long[0][1:])]
    want = [
        (x[0], x[1], y[1], max(x[1], y[1]), min(x[2], y[2]))
        for x in long for y in short if x[0] == y[0] and max(x[1], y[1]) <= min(x[2], y[2])
    ]
    got = iv.intersect_intervals(spans(long), spans(short))
    assert collected(got, "series_id", "a_start", "b_start", "start_ts", "end_ts") == ordered(want)
    back = iv.intersect_intervals(spans(short), spans(long))
    assert back.count() == len(want)
    assert iv.intersect_intervals(spans(long), spans(short).limit(0)).count() == 0


def test_backfill_of_a_short_span_is_three_ranges(spans):
    start, end = at("2024-10-01T05:00"), at("2024-10-29T05:00")
    got = collected(iv.backfill_ranges(spans([(start, end)])), "start_ts", "end_ts")
    assert got == [(start - k * DAY, end - k * DAY) for k in (1092, 728, 364)]
    assert {s.weekday() for s, _ in got} == {start.weekday()}


def test_backfill_of_a_long_span_is_one_range(spans):
    start = at("2021-10-29T05:00")
    got = collected(iv.backfill_ranges(spans([(start, start + 1095 * DAY)])), "start_ts", "end_ts")
    assert got == [(start - 1092 * DAY, start)]


def test_chunk_index_rows(spans):
    index = c.chunk_index(spans([(at("2023-12-24T05:00"), at("2024-10-29T20:00"))]))
    rows = {(r.year, r.quarter): r for r in index.collect()}
    assert len(rows) == 5
    first, second, last = rows[2023, 4], rows[2024, 1], rows[2024, 4]
    assert (first.start_ts, first.end_ts) == (at("2023-10-01"), at("2023-12-31T23:00"))
    assert (first.data_start_ts, first.data_end_ts) == (at("2023-12-24T05:00"), at("2023-12-31T23:00"))
    assert first.name == "2023_Q4_from_2023-10-01-00_to_2023-12-31-23"
    assert second.name == "2024_Q1_from_2024-01-01-00_to_2024-03-31-23"
    assert (last.data_start_ts, last.data_end_ts) == (at("2024-10-01"), at("2024-10-29T20:00"))
    assert [r.complete for r in (first, second, last)] == [False, True, False]
    assert_schema(index, CHUNK_INDEX)
    with pytest.raises(SchemaMismatch):
        assert_schema(index.drop("name"), CHUNK_INDEX)


def test_a_full_last_or_only_chunk_is_complete(spans):
    index = c.chunk_index(spans([(at("2024-01-01"), at("2024-03-31T23:00"))]))
    assert [r.complete for r in index.collect()] == [True]


def test_hit_and_miss(spans):
    index = c.chunk_index(spans([(at("2015-07-01T05:00"), at("2016-12-20T23:00"))]))
    start = at("2016-01-15T10:00")

    def split(a, b, sid="a"):
        r = c.hit_miss(index, spans([(sid, a, b)])).first()
        return (r.hit_start, r.hit_end), (r.miss_start, r.miss_end)

    none = (None, None)
    end = at("2024-10-30")
    assert split(start, end) == ((start, at("2016-12-20T23:00")), (at("2016-12-21"), end))
    assert split(start, at("2016-10-30")) == ((start, at("2016-10-30")), none)
    # After the stored end the miss still starts right behind it.
    assert split(at("2017-02-01"), end) == (none, (at("2016-12-21"), end))
    assert split(start, end, "new") == (none, (start, end))
    with pytest.raises(Exception, match="before the stored range"):
        split(at("2014-01-01"), end)


@pytest.fixture
def old_and_new(spans):
    old = c.chunk_index(spans([(at("2015-07-01T05:00"), at("2016-12-20T23:00"))]))
    new = c.chunk_index(spans([(at("2016-07-15T08:00"), at("2017-06-15T10:00"))]))
    return old, new


def test_chunk_diff(old_and_new):
    got = collected(c.chunk_diff(*old_and_new), "action", "start_ts")
    assert got == [
        ("append", at("2017-01-01")), ("append", at("2017-04-01")), ("update", at("2016-10-01")),
    ]
    report = collected(
        c.chunk_diff_report(*old_and_new), "action", "n_chunks", "year", "quarter", "complete"
    )
    assert report == [
        ("append", 2, 2017, 1, True), ("append", 2, 2017, 2, False), ("update", 1, 2016, 4, False),
    ]


def test_chunk_diff_broadcasts_no_index(old_and_new, spark, tmp_path):
    read = []
    for name, index in zip(("old", "new"), old_and_new, strict=True):
        index.write.parquet(str(tmp_path / name))
        read.append(spark.read.parquet(str(tmp_path / name)))
    diff = c.chunk_diff(*read)
    assert "Broadcast" not in diff._jdf.queryExecution().executedPlan().toString()
    assert collected(diff) == collected(c.chunk_diff(*old_and_new)) != []


def test_index_update_extends_and_rejects_gaps(spans, old_and_new):
    old, _ = old_and_new
    merged = c.update_chunk_index(old, spans([(at("2016-12-21"), at("2017-06-15T10:00"))]))
    assert collected(c.index_bounds(merged), "start_ts", "end_ts") == [
        (at("2015-07-01T05:00"), at("2017-06-15T10:00"))
    ]
    with pytest.raises(Exception, match="gap"):
        c.update_chunk_index(old, spans([(at("2016-12-21T01:00"), at("2017-06-15T10:00"))])).collect()
    shorter = c.update_chunk_index(old, spans([(at("2016-07-01"), at("2016-08-01"))]))
    assert collected(shorter) == collected(old)


def test_intervals_are_placed_only_on_levels_of_the_other_set(spark):
    """Days of many lengths against quarters: own levels below the quarters' are not joined at all."""
    def made(spans):
        rows = [("a", at("2024-01-01") + timedelta(days=x), at("2024-01-01") + timedelta(days=y)) for x, y in spans]
        return spark.createDataFrame(rows, "series_id string, start_ts timestamp_ntz, end_ts timestamp_ntz")

    days, quarters = made([(k, k + n) for k in range(0, 300, 3) for n in (0, 1, 2, 9, 30)]), made([(0, 90), (91, 181), (182, 365)])
    got = iv.intersect_intervals(days, quarters)
    want = days.alias("a").join(quarters.alias("b"), F.expr("a.start_ts <= b.end_ts and b.start_ts <= a.end_ts")).count()
    assert got.count() == want == got.distinct().count()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("explode([12])") == 1 and plan.count("explode([0,9,10,11])") == 1  # each set on the other's levels
    assert iv.intersect_intervals(days, quarters.limit(0)).count() == iv.intersect_intervals(days.limit(0), quarters).count() == 0
