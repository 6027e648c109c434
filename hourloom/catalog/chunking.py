"""Chunk operators, back-fill, and the pipelines that read and write the store."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from hourloom.catalog import inputs as i
from hourloom.catalog.inputs import CALENDAR_SQL, with_tables
from hourloom.catalog.reading import CHUNK_SQL, HYBRID_SQL, NEW_START, OLD_END
from hourloom.catalog.registry import query
from hourloom.catalog.shaping import HIGH, HOLIDAY_SQL, LAGS_SQL, LOW, rounded
from hourloom.consts import DAY, HOUR
from hourloom.operators.chunks import (
    chunk_diff,
    chunk_diff_report,
    chunk_index,
    chunk_stats,
    coverage_report,
    hit_miss,
)
from hourloom.operators.clean import clean
from hourloom.operators.features import add_calendar_features, add_holiday_flag
from hourloom.operators.intervals import backfill_ranges
from hourloom.operators.series import fill_grid, time_bounds
from hourloom.plans.pipelines import (
    model_input,
    refresh,
    requests_for,
    training_window,
    with_backfill,
)
from hourloom.sources.holidays import us_holidays
from hourloom.sources.store import read_chunks


@query("demand_features", with_tables("hu_full", f"""
    select series_id, ts, round(d, 6) as d, {CALENDAR_SQL}, {HOLIDAY_SQL}
    from ({i.clean_sql("hu_full", LOW, HIGH)}) c"""))
def demand_features(spark, sf_dir):
    """The flagship: grid, cap, impute, calendar features, holiday flag."""
    series = i.hourly_users(spark, sf_dir)
    cleaned = clean(fill_grid(series), LOW, HIGH, fit_on=series)
    return rounded(add_holiday_flag(add_calendar_features(cleaned), us_holidays(spark)), "d")


@query("chunk_index", with_tables("ds_bounds", CHUNK_SQL.format(bounds="ds_bounds")))
def chunk_index_query(spark, sf_dir):
    return chunk_index(time_bounds(i.daily_parts(spark, sf_dir)), DAY)


def _old_and_new(spark, sf_dir):
    filled = fill_grid(i.daily_parts(spark, sf_dir), DAY)
    old = chunk_index(time_bounds(i.until(filled, OLD_END)), DAY)
    return old, chunk_index(time_bounds(i.since(filled, NEW_START)), DAY)


DIFF_SQL = f"""
ob as (select series_id, min(ts) as start_ts, max(ts) as end_ts from ds_full where ts <= timestamp '1999-05-15' group by 1),
nb as (select series_id, min(ts) as start_ts, max(ts) as end_ts from ds_full where ts >= timestamp '1999-03-01' group by 1),
old as ({CHUNK_SQL.format(bounds="ob")}), new as ({CHUNK_SQL.format(bounds="nb")}),
diff as (select 'update' as action, * from old where not complete
           and exists (select 1 from new where new.series_id = old.series_id and new.start_ts = old.start_ts)
         union all select 'append', * from new
           where not exists (select 1 from old where new.series_id = old.series_id and new.start_ts = old.start_ts))
"""


@query("chunk_diff", with_tables("ds_full", "with " + DIFF_SQL + "select * from diff"))
def chunk_diff_query(spark, sf_dir):
    return chunk_diff(*_old_and_new(spark, sf_dir))


@query("chunk_diff_report", with_tables("ds_full", "with " + DIFF_SQL + """
    select series_id, action, year, quarter, start_ts, end_ts, complete,
      count(*) over (partition by series_id, action) as n_chunks from diff"""))
def chunk_diff_report_query(spark, sf_dir):
    return chunk_diff_report(*_old_and_new(spark, sf_dir))


@query("chunk_stats", with_tables("ds", """
    select series_id, cast(year(ts) as integer) as year, cast(quarter(ts) as integer) as quarter,
      min(ts) as data_start_ts, max(ts) as data_end_ts, count(*) as n_rows from ds group by 1, 2, 3"""))
def chunk_stats_query(spark, sf_dir):
    return chunk_stats(i.daily_parts(spark, sf_dir))


@query("hit_miss", with_tables("ds_full", """
    with stored as (select series_id, max(ts) as e from ds_full where ts <= timestamp '2000-06-30' group by 1),
    req(request_start, request_end) as (values
      (timestamp '1999-02-01', timestamp '1999-12-31'), (timestamp '1999-07-01', timestamp '2000-12-31'),
      (timestamp '2000-10-01', timestamp '2000-12-31'))
    select series_id, request_start, request_end,
      case when request_start <= e then request_start end as hit_start,
      case when request_start <= e then least(request_end, e) end as hit_end,
      case when request_end > e then e + interval 1 day end as miss_start,
      case when request_end > e then request_end end as miss_end
    from stored cross join req"""))
def hit_miss_query(spark, sf_dir):
    stored = i.until(fill_grid(i.daily_parts(spark, sf_dir), DAY), datetime(2000, 6, 30))
    bounds = time_bounds(stored)
    requests = requests_for(bounds, datetime(1999, 2, 1), datetime(1999, 12, 31))
    for start in (datetime(1999, 7, 1), datetime(2000, 10, 1)):
        requests = requests.unionByName(requests_for(bounds, start, datetime(2000, 12, 31)))
    return hit_miss(chunk_index(bounds, DAY), requests, DAY)


@query("backfill_ranges", with_tables("hu_bounds ds_bounds", """
    with b as (select 'user ' || series_id as series_id, start_ts, end_ts from hu_bounds
               union all select 'part ' || series_id, start_ts, end_ts from ds_bounds),
    lagged as (select series_id, start_ts - to_days(k * 364) as s, least(start_ts, end_ts - to_days(k * 364)) as e
               from b, (values (1), (2), (3)) v(k)),
    reached as (select *, max(e) over (partition by series_id order by s rows between unbounded preceding and 1 preceding) as r
                from lagged),
    islands as (select *, sum(case when r >= s then 0 else 1 end)
                over (partition by series_id order by s rows unbounded preceding) as island from reached)
    select series_id, min(s) as start_ts, max(e) as end_ts from islands group by series_id, island"""))
def backfill_ranges_query(spark, sf_dir):
    """Short spans keep one range per lag, long ones merge into one."""
    short = time_bounds(i.hourly_users(spark, sf_dir))
    long = time_bounds(i.daily_parts(spark, sf_dir))
    named = [
        bounds.withColumn("series_id", F.concat_ws(" ", F.lit(kind), "series_id"))
        for kind, bounds in (("user", short), ("part", long))
    ]
    return backfill_ranges(named[0].unionByName(named[1]))


@query("lag_backfill", with_tables("ds_full", """
    with base as (select * from ds_full where ts >= timestamp '2001-03-01'),
    b as (select series_id, min(ts) as s, max(ts) as e from base group by 1),
    lagged as (select series_id, s - to_days(k * 364) as s, least(s, e - to_days(k * 364)) as e
               from b, (values (1), (2), (3)) v(k))
    select series_id, ts, d from ds_full f where ts >= timestamp '2001-03-01'
      or exists (select 1 from lagged l where l.series_id = f.series_id and f.ts between l.s and l.e)"""))
def lag_backfill(spark, sf_dir):
    filled = fill_grid(i.daily_parts(spark, sf_dir), DAY)
    store = i.new_store(filled, DAY)
    base = i.since(read_chunks(spark, store).select("series_id", "ts", "d"), datetime(2001, 3, 1))
    return with_backfill(spark, base, store, DAY)


@query("coverage_report", with_tables("hu", """
    select series_id, cast(719 as bigint) as requested, count(*) as available, count(*) filter (d is null) as n_null,
      min(ts) as first_ts, max(ts) as last_ts, count(*) <= 719 as short from hu group by 1"""))
def coverage_report_query(spark, sf_dir):
    series = i.hourly_users(spark, sf_dir)
    requests = requests_for(series, datetime(2024, 1, 1), datetime(2024, 1, 30, 23))
    return coverage_report(series, requests)


@query("training_window", with_tables("dord_bounds", """
    select series_id, timestamp '1998-01-01 05:00:00' as start_ts,
      least(end_ts, timestamp '2001-06-15 11:00:00' - interval 72 hour - interval 672 hour) as end_ts from dord_bounds"""))
def training_window_query(spark, sf_dir):
    bounds = time_bounds(i.daily_orders(spark, sf_dir))
    return training_window(bounds, datetime(2001, 6, 15, 10, 40), earliest=datetime(1995, 1, 1, 5))


MODEL_INPUT_SQL = f"""
stored as (select * from ds_full where ts <= timestamp '2000-06-30'),
last as (select series_id, max(ts) as last_ts from stored group by 1),
raw as (select r.respondent as series_id, r.ts, r.type, r.value, r.position from ds_raw r join last on respondent = series_id
  where r.ts between last_ts + interval 1 day and timestamp '2000-12-31'),
grid as (select series_id, unnest(generate_series(min(ts), max(ts), interval 1 day)) as ts from raw where type = 'D' group by 1),
demand as (select series_id, ts, cast(value as double) as d,
  row_number() over (partition by series_id, ts order by position) as rn from raw where type = 'D'),
base as (select * from stored where ts >= timestamp '1999-07-01'
  union all select g.series_id, g.ts, m.d from grid g left join (select * from demand where rn = 1) m using (series_id, ts)),
b as (select series_id, min(ts) as s, max(ts) as e from base group by 1),
lagged as (select series_id, s - to_days(k * 364) as s, least(s, e - to_days(k * 364)) as e from b, (values (1), (2), (3)) v(k)),
history as (select f.* from stored f join lagged l on l.series_id = f.series_id and f.ts between l.s and l.e),
whole as (select distinct * from (select * from history union all select * from base) u),
cleaned as ({i.clean_sql("whole", i.DAILY_LOW, i.DAILY_HIGH)})
"""


@query("model_input", with_tables("ds_full ds_raw", "with " + MODEL_INPUT_SQL + f"""
    , lags as (select *, {LAGS_SQL} from cleaned)
    select series_id, ts, round(d, 8) as d, {CALENDAR_SQL},
      round(lag_1y, 8) as lag_1y, round(lag_2y, 8) as lag_2y, round(lag_3y, 8) as lag_3y, 0 as is_holiday
    from lags where ts >= timestamp '1999-07-01'"""))
def model_input_query(spark, sf_dir):
    series = i.daily_parts(spark, sf_dir)
    store = i.new_store(i.until(fill_grid(series, DAY), datetime(2000, 6, 30)), DAY)
    requests = requests_for(series, datetime(1999, 7, 1), datetime(2000, 12, 31))
    frame = model_input(
        spark,
        store,
        i.raw_records(series),
        requests,
        us_holidays(spark),
        DAY,
        i.DAILY_LOW,
        i.DAILY_HIGH,
    )
    # Means of 32 or 64 values end in a 5 at the seventh or eighth decimal.
    return rounded(frame, "d", "lag_1y", "lag_2y", "lag_3y", places=8)


@query("refresh_pipeline", with_tables("he_full he_raw", "with " + HYBRID_SQL + """
    , closed as (select series_id, unnest(generate_series(last_ts + interval 1 hour, m, interval 1 hour)) as ts
      from last join (select series_id, max(ts) as m from missing where type = 'D' group by 1) x using (series_id))
    select series_id, ts, d from stored
    union all select c.series_id, c.ts, f.d from closed c left join fetched f using (series_id, ts)"""))
def refresh_pipeline(spark, sf_dir):
    """The gap between stored and fetched rows is closed: sparse tables have one."""
    series = i.hourly_types(spark, sf_dir)
    store = i.new_store(i.until(fill_grid(series), datetime(2024, 1, 20, 23)), HOUR)
    requests = requests_for(series, datetime(2024, 1, 5), datetime(2024, 1, 28, 12))
    refresh(spark, i.raw_records(series), store, requests, close_gap=True)
    return read_chunks(spark, store).select("series_id", "ts", "d")
