"""Projections, filters, joins, set operations and windows on series."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from hourloom.catalog import inputs as i
from hourloom.catalog.inputs import CALENDAR_SQL, clean_sql, with_tables
from hourloom.catalog.registry import query
from hourloom.consts import DAY, HOUR
from hourloom.functions.time import (
    compact_ts,
    hours_between,
    parse_compact_ts,
    quantize_end,
    quantize_start,
    usable_until,
)
from hourloom.functions.values import detected_feature_code
from hourloom.operators.clean import cap_outliers, impute_month_hour
from hourloom.operators.features import (
    add_calendar_features,
    add_holiday_flag,
    add_lag_features,
    feature_columns,
    select_features,
)
from hourloom.operators.folds import holdout_split, trailing_window, ts_folds
from hourloom.operators.intervals import intersect_intervals, merge_intervals
from hourloom.sources.store import staged
from hourloom.operators.numbering import missing_ranges
from hourloom.operators.profile import list_duplicates, reconcile, reconcile_counts
from hourloom.operators.chunks import chunk_index
from hourloom.operators.series import (
    concat_series,
    dedupe_first,
    drop_duplicates,
    facets_wide,
    fill_grid,
    first_last,
    make_grid,
    sort_series,
    time_bounds,
    to_warehouse,
    typed_raw,
)
from hourloom.schemas import FeatureFlags
from hourloom.sources.holidays import us_holidays

LOW, HIGH = i.HOURLY_LOW, i.HOURLY_HIGH
LAGS_SQL = ", ".join(
    f"max(d) over (partition by series_id order by ts range between interval {364 * k} day preceding"
    f" and interval {364 * k} day preceding) as lag_{k}y"
    for k in (1, 2, 3)
)
HOLIDAY_SQL = "cast(cast(ts as date) in (date '2024-01-01', date '2024-01-15') as integer) as is_holiday"
TYPED_SQL = "select respondent as series_id, ts, type, cast(value as double) as value, position from {raw}"


def rounded(df, *columns, places: int = 6):
    return df.withColumns({c: F.round(c, places) for c in columns})


@query("calendar_features", with_tables("hu", f"select *, {CALENDAR_SQL} from hu"))
def calendar_features(spark, sf_dir):
    return add_calendar_features(i.hourly_users(spark, sf_dir))


@query("cap_outliers", with_tables("hu_full", f"""
    select series_id, ts, case when d < {LOW} then {LOW} when d > {HIGH} then {HIGH} else d end as d from hu_full"""))
def cap_outliers_query(spark, sf_dir):
    return cap_outliers(fill_grid(i.hourly_users(spark, sf_dir)), "d", LOW, HIGH)


@query("holiday_flag", with_tables("hu_full", f"select *, {HOLIDAY_SQL} from hu_full"))
def holiday_flag(spark, sf_dir):
    return add_holiday_flag(fill_grid(i.hourly_users(spark, sf_dir)), us_holidays(spark))


@query("feature_projection", with_tables("ds_full", f"""
    select series_id, ts, d, {CALENDAR_SQL}, {LAGS_SQL}, 0 as is_holiday from ds_full"""))
def feature_projection(spark, sf_dir):
    frame = add_calendar_features(fill_grid(i.daily_parts(spark, sf_dir), DAY))
    frame = add_holiday_flag(add_lag_features(frame), us_holidays(spark))
    return select_features(frame, FeatureFlags(lag=True, holidays=True))


@query("feature_group_code", with_tables("runs", """
    select model_name, model_version, any_value(feature_flags) as feature_code from runs group by 1, 2"""))
def feature_group_code(spark, sf_dir):
    """The registry of models lists their input columns; the code is detected from them."""
    inputs = [feature_columns(FeatureFlags(lag=v >= 1, holidays=v == 2)) for v in range(3)]
    columns = F.array(*[F.array(*[F.lit(c) for c in names]) for names in inputs])
    registry = i.runs(spark, sf_dir).select("model_name", "model_version").distinct()
    return registry.select(
        "model_name",
        "model_version",
        detected_feature_code(F.element_at(columns, F.col("model_version") + 1)).alias("feature_code"),
    )


@query("compact_ts_roundtrip", with_tables("hu", """
    select series_id, ts, strftime(ts, '%Y-%m-%d_%H') as compact, ts as parsed from hu"""))
def compact_ts_roundtrip(spark, sf_dir):
    series = i.hourly_users(spark, sf_dir).select("series_id", "ts", compact_ts("ts").alias("compact"))
    return series.withColumn("parsed", parse_compact_ts("compact"))


@query("quantize_range", with_tables("hu_raw", """
    select respondent as series_id, min(ts) as start_ts, max(ts) as end_ts,
      cast(date_trunc('day', min(ts)) as timestamp) as fetch_start,
      cast(date_trunc('day', max(ts) + interval 1 day) as timestamp) as fetch_end,
      date_diff('hour', cast(date_trunc('day', min(ts)) as timestamp),
        cast(date_trunc('day', max(ts) + interval 1 day) as timestamp)) as hours
    from hu_raw group by 1"""))
def quantize_range(spark, sf_dir):
    bounds = time_bounds(typed_raw(i.raw_records(i.hourly_users(spark, sf_dir))))
    return bounds.select(
        "series_id",
        "start_ts",
        "end_ts",
        quantize_start("start_ts").alias("fetch_start"),
        quantize_end("end_ts").alias("fetch_end"),
        hours_between(quantize_start("start_ts"), quantize_end("end_ts")).alias("hours"),
    )


@query("usable_until", """
    select event_id, make_timestamp(cast((us // 3600000000
        + case when us % 3600000000 > 1800000000
            or (us % 3600000000 = 1800000000 and (us // 3600000000) % 2 = 1) then 1 else 0 end) * 3600000000 as bigint))
      - interval 72 hour as usable_until
    from (select event_id, epoch_us(ts) as us from events) e""")
def usable_until_query(spark, sf_dir):
    """Every event time taken as `now`."""
    now = F.col("ts").cast("timestamp_ntz")
    return i.table(spark, sf_dir, "events").select("event_id", usable_until(now, 72).alias("usable_until"))


@query("lag_features", with_tables("ds_full", f"""
    select series_id, ts, d, {LAGS_SQL} from ds_full"""))
def lag_features(spark, sf_dir):
    return add_lag_features(fill_grid(i.daily_parts(spark, sf_dir), DAY))


@query("impute_month_hour", with_tables("hu_full", f"""
    select series_id, ts, round(d, 6) as d from ({clean_sql("hu_full", LOW, HIGH)}) c"""))
def impute_month_hour_query(spark, sf_dir):
    filled = cap_outliers(fill_grid(i.hourly_users(spark, sf_dir)), "d", LOW, HIGH)
    return rounded(impute_month_hour(filled), "d")


@query("holdout_split", with_tables("ds", """
    select *, row_number() over (partition by series_id order by ts desc) > 28 as is_train from ds"""))
def holdout_split_query(spark, sf_dir):
    return holdout_split(i.daily_parts(spark, sf_dir), 28)


@query("trailing_window", with_tables("hu", """
    select series_id, ts, d from hu join (select series_id, max(ts) as e from hu group by 1) m using (series_id)
    where ts >= e - interval 7 day"""))
def trailing_window_query(spark, sf_dir):
    return trailing_window(i.hourly_users(spark, sf_dir), 7)


@query("fill_grid", with_tables("hu_full", "select * from hu_full"))
def fill_grid_query(spark, sf_dir):
    return fill_grid(i.hourly_users(spark, sf_dir))


@query("time_grid", with_tables("hu_grid", "select * from hu_grid"))
def time_grid(spark, sf_dir):
    return make_grid(time_bounds(i.hourly_users(spark, sf_dir)))


WIDE_SQL = f"""
typed as ({TYPED_SQL.format(raw="hu_raw")}),
firsts as (select *, row_number() over (partition by series_id, ts, type order by position) as rn from typed),
grid as (select series_id, unnest(generate_series(min(ts), max(ts), interval 1 hour)) as ts from typed group by 1),
wide as (select g.series_id, g.ts, a.value as d, b.value as df from grid g
  left join (select * from firsts where rn = 1 and type = 'D') a using (series_id, ts)
  left join (select * from firsts where rn = 1 and type = 'DF') b using (series_id, ts))
"""


@query("facets_wide", with_tables("hu_raw", "with " + WIDE_SQL + "select * from wide"))
def facets_wide_query(spark, sf_dir):
    return facets_wide(typed_raw(i.raw_records(i.hourly_users(spark, sf_dir))))


@query("eia_to_warehouse", with_tables("hu_raw", "with " + WIDE_SQL + "select series_id, ts, d from wide"))
def raw_to_warehouse(spark, sf_dir):
    return to_warehouse(i.raw_records(i.hourly_users(spark, sf_dir)))


@query("dedupe_first", with_tables("hu_raw", f"""
    select series_id, ts, type, value from (select *, row_number() over (partition by series_id, ts, type order by position) as rn
      from ({TYPED_SQL.format(raw="hu_raw")}) t) f where rn = 1"""))
def dedupe_first_query(spark, sf_dir):
    typed = typed_raw(i.raw_records(i.hourly_users(spark, sf_dir)))
    return dedupe_first(typed, ["series_id", "ts", "type"], "position")


@query("drop_duplicates_subset", with_tables("hu_raw", f"""
    select series_id, ts, type, value, min(position) as position
    from ({TYPED_SQL.format(raw="hu_raw")}) t group by 1, 2, 3, 4"""))
def drop_duplicates_subset(spark, sf_dir):
    typed = typed_raw(i.raw_records(i.hourly_users(spark, sf_dir)))
    return drop_duplicates(typed, ["series_id", "ts", "type", "value"], "position")


@query("list_duplicates", with_tables("hu_raw", f"""
    select * from (select *, count(*) over (partition by series_id, ts, type, value) as n_copies
      from ({TYPED_SQL.format(raw="hu_raw")}) t) c where n_copies > 1"""))
def list_duplicates_query(spark, sf_dir):
    typed = typed_raw(i.raw_records(i.hourly_users(spark, sf_dir)))
    return list_duplicates(typed, ["series_id", "ts", "type", "value"])


@query("concat_series", with_tables("ds", """
    select series_id, ts, case when ts <= timestamp '1999-05-15' then d else d * 2 end as d from ds"""))
def concat_series_query(spark, sf_dir):
    series = i.daily_parts(spark, sf_dir)
    stored = i.until(series, datetime(1999, 5, 15))
    fresh = i.since(series, datetime(1999, 3, 1)).withColumn("d", F.col("d") * 2)
    return sort_series(concat_series([stored, fresh]))


@query("reconcile_counts", with_tables("ds", """
    with a as (select series_id, ts, case when day(ts) % 10 = 1 then d + 1 else d end as d, case when d >= 20000 then d end as adjusted_d from ds),
    b as (select series_id, ts, case when d >= 40000 then d end as d from ds where day(ts) <> 5)
    select series_id, count(*) as n_shared, count(*) filter (a.d is distinct from b.d) as n_different,
      count(*) filter (b.d is null) as n_null_raw, count(*) filter (b.d is null and adjusted_d is null) as n_not_adjusted
    from a join b using (series_id, ts) group by 1"""))
def reconcile_counts_query(spark, sf_dir):
    """A published extract with adjusted values against raw values: days missing on one side, nulls and differing values."""
    series, d = i.daily_parts(spark, sf_dir), F.col("d")
    published = series.select(
        "series_id", "ts", F.when(F.dayofmonth("ts") % 10 == 1, d + 1).otherwise(d).alias("d"), F.when(d >= 20000, d).alias("adjusted_d")
    )
    raw = series.filter(F.dayofmonth("ts") != 5).withColumn("d", F.when(d >= 40000, d))
    return reconcile_counts(published, raw)


@query("reconcile_sources", with_tables("hu_raw", f"""
    select a.series_id, a.ts, a.value as d, b.value as other_d
    from ({TYPED_SQL.format(raw="hu_raw")}) a join ({TYPED_SQL.format(raw="hu_raw")}) b
      on a.series_id = b.series_id and a.ts = b.ts and a.type = 'D' and b.type = 'D' and b.position = a.position + 1
    where a.value is distinct from b.value"""))
def reconcile_sources(spark, sf_dir):
    """First against last report of every hour."""
    demand = typed_raw(i.raw_records(i.hourly_users(spark, sf_dir))).filter("type = 'D'")
    rows = demand.select("series_id", "ts", F.col("value").alias("d"), "position")
    first = dedupe_first(rows, ["series_id", "ts"], "position")
    last = dedupe_first(rows.withColumn("position", -F.col("position")), ["series_id", "ts"], "position")
    return reconcile(first, last)


@query("first_last", with_tables("hu", """
    select series_id, min(ts) as first_ts, arg_min(d, ts) as first_d, max(ts) as last_ts, arg_max(d, ts) as last_d
    from hu group by 1"""))
def first_last_query(spark, sf_dir):
    return first_last(i.hourly_users(spark, sf_dir))


GAPS_SQL = """select series_id, ts + interval {step} as start_ts, nxt - interval {step} as end_ts,
      date_diff('{unit}', ts, nxt) - 1 as n_missing
    from (select series_id, ts, lead(ts) over (partition by series_id order by ts) as nxt from {t}) n
    where nxt > ts + interval {step}"""


@query("missing_ranges", with_tables("hu", GAPS_SQL.format(step="1 hour", unit="hour", t="hu")))
def missing_ranges_query(spark, sf_dir):
    return missing_ranges(i.hourly_users(spark, sf_dir), HOUR)


# Every line item occupies its supplier from shipment for quantity / 10 days. Distinct,
# so that the order of equal spans cannot matter to the windows of the SQL.
SPANS_SQL = """select distinct cast(l_suppkey as varchar) as series_id, cast(l_shipdate as timestamp) as start_ts,
    cast(l_shipdate as timestamp) + to_days(cast(floor(l_quantity / 10) as integer)) as end_ts from lineitem"""


def _spans(spark, sf_dir):
    start = F.col("l_shipdate").cast("timestamp_ntz")
    return i.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("series_id"),
        start.alias("start_ts"),
        (start + F.make_dt_interval(F.floor(F.col("l_quantity") / 10).cast("int"))).alias("end_ts"),
    )


@query("merge_intervals", f"""
    with spans as ({SPANS_SQL}),
    reached as (select *, max(end_ts) over (partition by series_id order by start_ts, end_ts
        rows between unbounded preceding and 1 preceding) as r from spans),
    islands as (select *, sum(case when r >= start_ts then 0 else 1 end)
        over (partition by series_id order by start_ts, end_ts rows unbounded preceding) as island from reached)
    select series_id, min(start_ts) as start_ts, max(end_ts) as end_ts from islands group by series_id, island""")
def merge_intervals_query(spark, sf_dir):
    return merge_intervals(_spans(spark, sf_dir))


@query("interval_intersect", with_tables("ds ds_bounds", f"""
    with gaps as ({GAPS_SQL.format(step="1 day", unit="day", t="ds")}),
    q as (select series_id, q as qs, q + interval 3 month - interval 1 day as qe from
      (select series_id, unnest(generate_series(cast(date_trunc('quarter', start_ts) as timestamp),
        cast(date_trunc('quarter', end_ts) as timestamp), interval 3 month)) as q from ds_bounds) x)
    select series_id, start_ts as a_start, end_ts as a_end, qs as b_start, qe as b_end,
      greatest(start_ts, qs) as start_ts, least(end_ts, qe) as end_ts
    from gaps join q using (series_id) where start_ts <= qe and qs <= end_ts"""))
def interval_intersect(spark, sf_dir):
    """Gaps of the series against the calendar quarters they fall in."""
    series = i.daily_parts(spark, sf_dir)
    gaps = staged(missing_ranges(series, DAY), "gaps")  # both sides are read for their levels and their rows
    return intersect_intervals(gaps, staged(chunk_index(time_bounds(series), DAY), "quarters"))


@query("ts_folds", with_tables("ds", """
    with n as (select *, row_number() over (partition by series_id order by ts) as rn,
        count(*) over (partition by series_id) as size from ds),
    f as (select series_id, ts, rn, size, fold, size - (9 - fold) * 28 as cut from n, generate_series(1, 8) as g(fold))
    select series_id, cast(fold as integer) as fold,
      min(ts) filter (rn <= cut) as train_start, max(ts) filter (rn <= cut) as train_end,
      count(*) filter (rn <= cut) as n_train,
      min(ts) filter (rn > cut and rn <= cut + 28) as test_start, max(ts) filter (rn > cut and rn <= cut + 28) as test_end,
      count(*) filter (rn > cut and rn <= cut + 28) as n_test
    from f group by 1, 2"""))
def ts_folds_query(spark, sf_dir):
    return ts_folds(i.daily_parts(spark, sf_dir), 8, 28, step=None)
