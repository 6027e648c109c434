from __future__ import annotations

import json
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hourloom.consts import DAY
from hourloom.operators.series import typed_raw
from hourloom.plans import pipelines as pl
from hourloom.session import work_path
from hourloom.sources import files, paged, store as st
from hourloom.sources.holidays import us_holidays
from tests.conftest import at, collected, hours


def days(start, n, value):
    return [(t, value) for t in hours(start, n, DAY)]


@pytest.fixture
def stored(spark, series):
    """A store with one series from mid 2016 to 2016-12-20."""
    path = work_path(spark, "store")
    st.write_store(series(days("2016-02-10", 315, 1)), path, DAY)
    return path


def contents(spark, path):
    return dict(collected(st.read_chunks(spark, path), "ts", "d"))


def test_append_over_several_quarters_loses_none(spark, series, stored):
    diff = st.upsert_chunks(series(days("2016-12-21", 300, 2)), stored, DAY)
    got = contents(spark, stored)
    assert len(got) == 615 and sum(v == 2.0 for v in got.values()) == 300
    assert collected(diff, "action", "year", "quarter") == [
        ("append", 2017, 1), ("append", 2017, 2), ("append", 2017, 3), ("append", 2017, 4), ("update", 2016, 4),
    ]
    index = st.read_chunk_index(spark, stored)
    assert index.count() == 8
    assert index.filter("complete").count() == 6


def test_stored_rows_win_and_complete_chunks_stay(spark, series, stored):
    st.upsert_chunks(series(days("2016-05-01", 300, 9)), stored, DAY)
    got = contents(spark, stored)
    assert all(got[t] == 1.0 for t, _ in days("2016-02-10", 315, 1))
    assert all(got[t] == 9.0 for t, _ in days("2016-12-21", 66, 9))


def files_by_part(path):
    """(version, quarter, bucket) of every data file."""
    return {tuple(p.relative_to(path).parts[1:-1]) for p in Path(path).glob("data/*/*/*/*/part-*")}


def test_refreshing_one_series_rewrites_its_bucket_only(spark, series):
    path = work_path(spark, "store")
    ids = [f"s{k}" for k in range(12)]
    st.write_store(series({sid: days("2016-01-01", 400, k) for k, sid in enumerate(ids)}), path, DAY, buckets=5)
    before = files_by_part(path)
    assert len({part[3] for part in before}) == 5
    st.upsert_chunks(series({"s3": days("2017-02-04", 30, 99)}), path, DAY)
    new = files_by_part(path) - before
    bucket = spark.range(1).select(st.bucket_of(F.lit("s3"), 5)).first()[0]
    assert new == {("version=2", "year=2017", "quarter=1", f"bucket={bucket}")}
    rows = st.read_chunks(spark, path).groupBy("series_id").agg(F.count("*").alias("n"), F.max("d").alias("d"))
    assert {r.series_id: (r.n, r.d) for r in rows.collect()} == {
        sid: (430, 99.0) if sid == "s3" else (400, float(k)) for k, sid in enumerate(ids)
    }


def test_history_is_read_from_the_parts_of_its_series(spark, series):
    path = work_path(spark, "store")
    ids = [f"s{k}" for k in range(12)]
    st.write_store(series({sid: days("2016-01-01", 800, k) for k, sid in enumerate(ids)}), path, DAY, buckets=5)
    ranges = spark.createDataFrame(
        [("s3", at("2016-03-30"), at("2016-04-02")), ("s7", at("2017-02-01"), at("2017-02-02")), ("s8", at("2017-05-02"), at("2017-05-01"))],
        "series_id string, start_ts timestamp_ntz, end_ts timestamp_ntz",
    )
    where = {r.s: r.b for r in spark.createDataFrame([(s,) for s in ids], "s string").select("s", st.bucket_of("s", 5).alias("b")).collect()}
    parts = st.touched_parts(spark, path, ranges)
    assert parts == {(2016, 1, where["s3"]), (2016, 2, where["s3"]), (2017, 1, where["s7"])}
    got = st.read_ranges(spark, path, ranges, DAY, at("2016-03-30"), at("2017-05-02"))
    assert collected(got, "series_id", "ts") == [("s3", t) for t in hours("2016-03-30", 4, DAY)] + [("s7", t) for t in hours("2017-02-01", 2, DAY)]
    read = st.read_chunks(spark, path, parts).select(F.input_file_name().alias("f")).distinct().collect()
    assert {tuple(Path(r.f).parts[-4:-1]) for r in read} == {(f"year={y}", f"quarter={q}", f"bucket={b}") for y, q, b in parts}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_sketches_merge_follow_updates_and_stay_within_their_error(spark, series):
    from hourloom.sources import sketches as sk

    rnd = __import__("random").Random(1)
    path = work_path(spark, "store")
    values = {sid: [(t, None if k % 50 == 3 else rnd.lognormvariate(3, 2)) for k, (t, _) in enumerate(days("2015-01-01", 2500, 0))] for sid in "abc"}
    values["d"] = days("2015-01-01", 5, 2.5)
    values["e"] = days("2015-01-01", 5, None)
    st.write_store(series({sid: rows[:2000] for sid, rows in values.items()}), path, DAY, buckets=3)
    assert sk.write_sketches(spark, path) == [1] and sk.write_sketches(spark, path) == []
    st.upsert_chunks(series({"a": values["a"][1990:]}), path, DAY)
    stored = {sid: [v for _, v in (rows if sid == "a" else rows[:2000]) if v is not None] for sid, rows in values.items()}
    probs = (0.0, 0.01, 0.3, 0.5, 0.9, 1.0)
    got = {r.series_id: r for r in sk.stored_quantiles(spark, path, probs).collect()}
    assert set(got) == set("abcd") and {s: r.n for s, r in got.items()} == {s: len(stored[s]) for s in "abcd"}
    assert (got["d"].q0, got["d"].q3, got["d"].q5) == (2.5, 2.5, 2.5)
    for sid in "abc":
        own = sorted(stored[sid])
        assert (got[sid].q0, got[sid].q5) == (own[0], own[-1])
        for k, p in enumerate(probs):
            below, upto = sum(v < got[sid][f"q{k}"] for v in own), sum(v <= got[sid][f"q{k}"] for v in own)
            assert below / len(own) <= p + sk.RANK_ERROR and upto / len(own) >= p - sk.RANK_ERROR
    bucket = spark.range(1).select(st.bucket_of(F.lit("a"), 3)).first()[0]
    assert {r.bucket for r in spark.read.parquet(f"{path}/sketches/version=2").select("bucket").collect()} == {bucket}


def test_upserting_twice_changes_nothing(spark, series, stored):
    fresh = series(days("2016-12-01", 60, 2))
    st.upsert_chunks(fresh, stored, DAY)
    once, index = contents(spark, stored), collected(st.read_chunk_index(spark, stored))
    st.upsert_chunks(fresh, stored, DAY)
    assert contents(spark, stored) == once
    assert collected(st.read_chunk_index(spark, stored)) == index
    assert st.read_chunks(spark, stored).count() == len(once)


def test_gap_and_ragged_rows_leave_the_store_alone(spark, series, stored):
    before = contents(spark, stored)
    with pytest.raises(Exception, match="gap"):
        st.upsert_chunks(series(days("2017-02-01", 10, 2)), stored, DAY)
    with pytest.raises(ValueError, match="missing or repeated"):
        st.upsert_chunks(series(days("2016-12-21", 3, 2) + days("2017-01-01", 3, 2)), stored, DAY)
    assert contents(spark, stored) == before


def test_stored_nulls(spark, series):
    for fill, want in ((False, None), (True, 5.0)):
        path = work_path(spark, "store")
        st.write_store(series([(at("2016-01-01"), None), (at("2016-01-02"), 1)]), path, DAY)
        st.upsert_chunks(series(days("2016-01-01", 3, 5)), path, DAY, fill_stored_nulls=fill)
        assert contents(spark, path) == {at("2016-01-01"): want, at("2016-01-02"): 1.0, at("2016-01-03"): 5.0}


def test_a_new_series_joins_a_store(spark, series, stored):
    st.upsert_chunks(series({"b": days("2016-11-01", 20, 3)}), stored, DAY)
    rows = st.read_chunks(spark, stored)
    assert rows.groupBy("series_id").count().collect() and rows.filter("series_id = 'b'").count() == 20
    assert rows.filter("series_id = 'a'").count() == 315
    assert collected(pl.stored_bounds(spark, stored), "series_id") == [("a",), ("b",)]


def test_range_scan_opens_only_its_quarters(spark, stored):
    got = st.read_range(spark, stored, at("2016-06-29"), at("2016-07-02"))
    assert [r[0] for r in collected(got, "ts")] == hours("2016-06-29", 4, DAY)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "PushedFilters: [IsNotNull(ts)" in plan


def raw_rows(spark, rows, respondent="a"):
    data = [(t.strftime("%Y-%m-%dT%H"), respondent, "D", str(v), k) for k, (t, v) in enumerate(rows)]
    return spark.createDataFrame(data, paged.PAGED_RECORD)


def request(spark, start, end, sid="a"):
    return spark.createDataFrame([(sid, at(start), at(end))], "series_id string, start_ts timestamp_ntz, end_ts timestamp_ntz")


def test_fetch_combines_store_and_raw(spark, stored):
    raw = raw_rows(spark, days("2016-10-01", 150, 7))
    got = dict(collected(st.fetch_range(spark, stored, raw, request(spark, "2016-12-10", "2017-01-05"), DAY), "ts", "d"))
    assert got == {t: 1.0 if t <= at("2016-12-20") else 7.0 for t in hours("2016-12-10", 27, DAY)}
    only_raw = st.fetch_range(spark, stored, raw, request(spark, "2016-12-10", "2017-01-05"), DAY, use_store=False)
    assert {d for _, d in collected(only_raw, "ts", "d")} == {7.0}
    only_store = st.fetch_range(spark, stored, raw, request(spark, "2016-03-01", "2016-03-04"), DAY)
    assert len(collected(only_store)) == 4
    with pytest.raises(st.DataUnavailable):
        st.fetch_range(spark, stored, raw, request(spark, "2017-06-01", "2017-07-01"), DAY, use_store=False)


def test_a_series_without_raw_rows_is_an_error_unless_allowed(spark, stored):
    raw = raw_rows(spark, days("2016-10-01", 150, 7))
    both = request(spark, "2016-12-10", "2017-01-05").unionByName(request(spark, "2016-12-10", "2017-01-05", "b"))
    with pytest.raises(st.DataUnavailable, match="b"):
        st.fetch_range(spark, stored, raw, both, DAY)
    got = st.fetch_range(spark, stored, raw, both, DAY, allow_missing=True)
    assert {r[0] for r in collected(got, "series_id")} == {"a"} and got.count() == 27


def test_no_request_gives_no_row(spark, stored):
    none = request(spark, "2016-12-10", "2017-01-05").filter("false")
    assert st.fetch_range(spark, stored, raw_rows(spark, []), none, DAY).count() == 0


def test_forecasts_do_not_stretch_the_demand(spark, stored):
    ahead = raw_rows(spark, days("2016-12-21", 15, 9)).withColumn("type", F.lit("DF"))
    raw = raw_rows(spark, days("2016-12-21", 5, 7)).unionByName(ahead)
    wanted = request(spark, "2016-12-10", "2017-01-05")
    pl.refresh(spark, raw, stored, wanted, DAY)
    assert max(contents(spark, stored)) == at("2016-12-25")
    pl.refresh(spark, raw_rows(spark, days("2016-12-21", 20, 7)), stored, wanted, DAY)
    got = contents(spark, stored)
    assert max(got) == at("2017-01-05") and None not in got.values()


def test_raw_filters_reach_the_scan(spark, stored, tmp_path):
    raw_rows(spark, days("2016-10-01", 150, 7)).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    plan = st.fetch_raw(raw, request(spark, "2016-12-10", "2017-01-05"), DAY)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(period,2016-12-09)" in plan and "EqualTo(type,D)" in plan


def test_data_from_before_the_stored_start_is_refused(spark, stored, series):
    early = series(days("2015-01-01", 3, 5))
    before = contents(spark, stored)
    with pytest.raises(Exception, match="before the stored range"):
        st.upsert_chunks(early, stored, DAY)
    assert contents(spark, stored) == before


def test_a_writer_that_dies_leaves_the_old_store(spark, stored, series, monkeypatch):
    before, index = contents(spark, stored), collected(st.read_chunk_index(spark, stored))
    more = series(days("2016-12-01", 60, 9))

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(st, "write_chunk_index", dies)
        with pytest.raises(RuntimeError, match="lost"):
            st.upsert_chunks(more, stored, DAY)
    assert contents(spark, stored) == before and collected(st.read_chunk_index(spark, stored)) == index
    st.upsert_chunks(more, stored, DAY)
    got = contents(spark, stored)
    assert max(got) == at("2017-01-29") and {t: got[t] for t in before} == before


def test_of_two_writers_one_fails(spark, stored):
    index = st.read_chunk_index(spark, stored)
    st.write_chunk_index(index, stored, 7, {}, 4)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        st.write_chunk_index(index, stored, 7, {}, 4)


def test_refresh_is_idempotent(spark, stored):
    raw = raw_rows(spark, days("2016-10-01", 150, 7))
    pl.refresh(spark, raw, stored, request(spark, "2016-12-10", "2017-01-05"), DAY)
    assert len(contents(spark, stored)) == 315 + 16
    with pytest.raises(pl.RedundantExtraction):
        pl.refresh(spark, raw, stored, request(spark, "2016-12-10", "2017-01-05"), DAY)


def test_refresh_starts_an_empty_store(spark):
    path = work_path(spark, "store")
    raw = raw_rows(spark, days("2016-10-01", 150, 7))
    assert st.read_chunks(spark, path).count() == 0
    diff = pl.refresh(spark, raw, path, request(spark, "2016-10-01", "2017-01-05"), DAY)
    assert {r.action for r in diff.collect()} == {"append"}
    assert contents(spark, path) == {t: 7.0 for t in hours("2016-10-01", 97, DAY)}
    with pytest.raises(pl.RedundantExtraction):
        pl.refresh(spark, raw, path, request(spark, "2016-10-01", "2017-01-05"), DAY)


def test_a_late_first_record_is_a_gap_unless_closed(spark, stored):
    raw = raw_rows(spark, days("2016-12-25", 20, 7))
    wanted = request(spark, "2016-12-10", "2017-01-05")
    with pytest.raises(Exception, match="gap"):
        pl.refresh(spark, raw, stored, wanted, DAY)
    pl.refresh(spark, raw, stored, wanted, DAY, close_gap=True)
    got = contents(spark, stored)
    assert [got[t] for t in hours("2016-12-20", 6, DAY)] == [1.0, None, None, None, None, 7.0]


def test_model_input_has_history_and_strips_it(spark, series):
    path = work_path(spark, "store")
    st.write_store(series([(t, 100 + k) for k, (t, _) in enumerate(days("2015-01-01", 1500, 0))]), path, DAY)
    frame = pl.model_input(
        spark, path, raw_rows(spark, []), request(spark, "2018-06-01", "2018-06-30"), us_holidays(spark), DAY, 0, 5000, on_fail="raise"
    )
    assert frame.count() == 30
    row = frame.filter(F.col("ts") == F.lit("2018-06-15").cast("timestamp_ntz")).first()
    assert (row.d - row.lag_1y, row.d - row.lag_2y, row.d - row.lag_3y) == (364, 728, 1092)


def test_training_window_leaves_buffer_and_test_hours(spark):
    bounds = request(spark, "2015-07-01T05:00", "2024-12-31T00:00")
    row = pl.training_window(bounds, at("2024-11-10T10:31:00")).first()
    assert row.start_ts == at("2018-07-01T05:00")
    assert row.end_ts == at("2024-11-10T11:00") - timedelta(hours=72 + 672)
    start, end = spark.range(1).select(*pl.eval_window(at("2024-11-10T10:31:00"))).first()
    assert (start, end) == (row.end_ts, at("2024-11-07T11:00"))


def test_default_refresh_request(spark, series):
    row = pl.refresh_requests(series(days("2016-01-01", 2, 1)), at("2024-11-10T10:31:00")).first()
    assert (row.start_ts, row.end_ts) == (at("2015-07-01T05:00"), at("2024-11-07T11:00"))


def test_evaluation_refuses_a_leak_and_logs_runs(spark, tmp_path):
    from hourloom.operators.quality import LeakError

    rows = [("m", 1, ["hour"], "a", t, float(k), float(k) + k % 2) for k, t in enumerate(hours("2024-01-02", 10))]
    predictions = spark.createDataFrame(
        rows, "model_name string, model_version int, input_columns array<string>, series_id string, "
        "ts timestamp_ntz, d double, pred double"
    )
    ends = spark.createDataFrame([("a", at("2024-01-01T23:00"))], "series_id string, ts timestamp_ntz")
    path = str(tmp_path / "runs")
    for day in ("2024-02-01", "2024-02-02"):
        got = pl.compare(spark, predictions, ends, path, at(day))
    assert collected(got.filter("metric = 'mean_squared_error'"), "label", "start_time", "metric_value") == [
        ("m-v1-fB___", at("2024-02-01"), 0.5), ("m-v1-fB___", at("2024-02-02"), 0.5),
    ]
    late = spark.createDataFrame([("a", at("2024-01-02T01:00"))], "series_id string, ts timestamp_ntz")
    with pytest.raises(LeakError):
        pl.evaluate_models(predictions, late, path, at("2024-02-03"))


def test_training_needs_stored_data(spark, stored):
    with pytest.raises(ValueError, match="must be stored"):
        pl.train(spark, stored, raw_rows(spark, []), request(spark, "2016-03-01", "2017-01-05"), us_holidays(spark), "unused", step=DAY)


def test_page_plan(spark):
    totals = spark.createDataFrame([("a", 12000), ("b", 10000), ("c", 3), ("d", 0)], "series_id string, total bigint")
    assert collected(paged.page_plan(totals, 5000), "series_id", "offset", "length") == [
        ("a", 0, 5000), ("a", 5000, 5000), ("a", 10000, 2000), ("b", 0, 5000), ("b", 5000, 5000), ("c", 0, 3),
    ]


class Letters:
    """A page source that needs no files: hourly records of two facets, and a log of the requests it got."""

    answers_queries = True

    def __init__(self, options):
        self.n, self.log = int(options["n"]), options["log"]

    def _noted(self, *request):
        with open(self.log, "a") as log:
            log.write(json.dumps(request) + "\n")

    def _answer(self, series_id, query):
        records = [
            {"period": f"2024-01-{k // 24 + 1:02d}T{k % 24:02d}", "respondent": series_id, "type": t, "value": str(k)}
            for k in range(self.n)
            for t in ("D", "DF")
        ]
        return [
            r for r in records
            if (query.types is None or r["type"] in query.types)
            and (query.start is None or r["period"] >= query.start) and (query.end is None or r["period"] <= query.end)
        ]

    def series(self):
        return ["x", "y"]

    def total(self, series_id, query):
        self._noted("total", series_id, query.types, query.start, query.end)
        return len(self._answer(series_id, query))

    def page(self, series_id, offset, length, query):
        self._noted("page", series_id, offset, length)
        return self._answer(series_id, query)[offset : offset + length]


@pytest.fixture
def letters(spark, tmp_path):
    log = tmp_path / "requests"
    options = {"fetcher": "tests.test_store_sources:Letters", "n": "30", "page_size": "7", "log": str(log)}
    return (
        lambda **more: paged.read_paged(spark, **options, **more),
        lambda: [json.loads(line) for line in log.read_text().splitlines()] if log.exists() else [],
    )


@pytest.mark.parametrize("tasks", ["1", "3"])
def test_paged_source_with_another_client(letters, tasks):
    read, requests = letters
    df = read(tasks_per_series=tasks)
    assert df.rdd.getNumPartitions() == 2 * int(tasks) and requests() == []  # planned, and nothing asked
    got = collected(df, "respondent", "position", "type", "value")
    assert got == [(s, 2 * k + j, t, str(k)) for s in "xy" for k in range(30) for j, t in enumerate(("D", "DF"))]
    pages = sorted(r for r in requests() if r[0] == "page")
    assert pages == sorted(["page", s, o, min(7, 60 - o)] for s in "xy" for o in range(0, 60, 7))


def test_filters_reach_the_requests(letters):
    read, requests = letters
    df = read().filter("type = 'D' and respondent = 'y' and period >= '2024-01-01T20' and period < '2024-01-02T02'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert requests() == [] and "2024-01-02T02" in plan and "= D" not in plan and "= y" not in plan  # periods are left to Spark as well
    assert collected(df, "respondent", "period", "type") == [
        ("y", f"2024-01-{d}", "D") for d in ("01T20", "01T21", "01T22", "01T23", "02T00", "02T01")
    ]
    totals = [r for r in requests() if r[0] == "total"]
    assert totals and all(r == ["total", "y", ["D"], "2024-01-01T20", "2024-01-02T02"] for r in totals)
    assert sorted(r for r in requests() if r[0] == "page") == [["page", "y", 0, 7]]
    assert read().filter("type in ('D', 'X') and type in ('X', 'Y')").count() == 0
    assert read().filter("respondent = 'nobody'").count() == 0


def test_a_refresh_asks_the_source_for_its_range_only(spark, letters):
    read, requests = letters
    wanted = request(spark, "2024-01-01T05", "2024-01-01T10").withColumn("series_id", F.lit("x"))
    got = st.fetch_raw(read(), wanted)
    assert got.count() == 6
    assert {tuple(r[2] or ()) for r in requests() if r[0] == "total"} == {("D",)}
    assert all(r[3] == "2023-12-31" and r[4] == "2024-01-04" for r in requests() if r[0] == "total")


def test_paged_files_and_json_parsing_agree(spark, tmp_path):
    records = [{"period": f"2024-01-01T{k:02d}", "respondent": "a b", "type": "D", "value": str(k)} for k in range(7)]
    pages = []
    for offset in (0, 3, 6):
        folder = tmp_path / "respondent=a%20b" / f"offset={offset}"
        folder.mkdir(parents=True)
        body = json.dumps({"response": {"total": "7", "data": records[offset : offset + 3]}})
        (folder / "part-0.txt").write_text(body)
        pages.append((body, offset))
    from_files = paged.read_paged(spark, path=f"file:{tmp_path}", page_size="3")
    parsed = paged.parse_pages(spark.createDataFrame(pages, "body string, at bigint"), offset="at")
    assert collected(from_files) == collected(parsed.select(*from_files.columns))
    assert collected(typed_raw(parsed), "ts")[0] == (at("2024-01-01"),)


def test_csv_and_published_files(spark, series, tmp_path):
    df = series([(at("2024-01-01T05:00"), 1.5), (at("2024-01-01T06:00"), None)])
    files.write_series_csv(df, str(tmp_path / "csv"))
    assert collected(files.read_series_csv(spark, str(tmp_path / "csv"))) == collected(df)
    (tmp_path / "bad.csv").write_text("series_id,ts,d\na,2024-01-01 05:00:00,oops\n")
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        files.read_series_csv(spark, str(tmp_path / "bad.csv")).collect()
    header = ",".join(f'"{f.name}"' for f in files.PUBLISHED.fields)
    row = '"X","01JUL2015 05:00:00","","","","EST","N","12,345","","","","","","","1,234.5","",""'
    (tmp_path / "pub.csv").write_text(f"{header}\n{row}\n")
    got = files.read_published_csv(spark, str(tmp_path / "pub.csv"))
    assert collected(got) == [("X", at("2015-07-01T05:00"), "EST", 12345.0, None, 1234.5)]


def test_runs_are_appended(spark, tmp_path):
    from hourloom.schemas import RUNS

    path = str(tmp_path / "runs")
    for k in (1, 2):
        row = ("m", k, at("2024-01-01T00:00:01"), "fB___", 0.1 + k, 1 / 3, 2.0, 1e-17)
        files.append_run(spark.createDataFrame([row], RUNS), path)
    got = files.read_runs(spark, path)
    assert got.schema.simpleString() == RUNS.simpleString()
    assert collected(got, "model_version", "r2_score", "root_mean_squared_error") == [(1, 1.1, 1 / 3), (2, 2.1, 1 / 3)]


def test_work_path_needs_a_shared_folder_on_a_cluster(spark):
    assert work_path(spark, "x") != work_path(spark, "x")
