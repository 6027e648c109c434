"""Data checks and descriptive reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourloom.catalog import inputs as i
from hourloom.catalog.inputs import with_tables
from hourloom.catalog.registry import query
from hourloom.catalog.shaping import HIGH, LOW, WIDE_SQL, rounded
from hourloom.consts import DAY
from hourloom.operators.features import add_features
from hourloom.operators.profile import (
    describe_series,
    histogram,
    hour_profile,
    null_map,
    null_pattern,
    outlier_report,
    profile,
    skew_report,
    table_summary,
    within,
)
from hourloom.operators.quality import (
    expect_not_null,
    expect_unique,
    model_input_suite,
    validate,
    warehouse_suite,
)
from hourloom.operators.series import facets_wide, fill_grid, full_index_check, typed_raw
from hourloom.sources.holidays import us_holidays

SKEW_SQL = "avg(power({c} - {m}, 3)) / power(avg(power({c} - {m}, 2)), 1.5)"


@query("dq_suite_warehouse", with_tables("hu_full", """
    with c as (select count(*) as n, count(*) filter (d is null) as u,
        count(*) filter (minute(ts) <> 0 or second(ts) <> 0) as off from hu_full)
    select 'warehouse' as suite, 'column_exists' as expectation, 'd' as "column", cast(null as bigint) as n,
      cast(null as bigint) as n_unexpected, cast(null as double) as unexpected_pct, true as success
    union all select 'warehouse', 'not_null', 'd', n, u, round(u * 100.0 / n, 6), n - u >= 0.9 * n from c
    union all select 'warehouse', 'on_step', 'ts', n, off, round(off * 100.0 / n, 6), off = 0 from c"""))
def dq_suite_warehouse(spark, sf_dir):
    frame = fill_grid(i.hourly_users(spark, sf_dir))
    return rounded(validate(frame, "warehouse", warehouse_suite()), "unexpected_pct")


@query("dq_suite_model_input", with_tables("ds_full", f"""
    with c as (select count(*) as n, count(d) as nd, count(*) filter (d is null) as nulls,
        count(*) filter (d not between {i.DAILY_LOW} and {i.DAILY_HIGH}) as outside from ds_full)
    select 'model_input' as suite, 'columns_match_set' as expectation, '*' as "column", cast(null as bigint) as n,
      cast(null as bigint) as n_unexpected, cast(null as double) as unexpected_pct, true as success
    union all select 'model_input', 'not_null', 'd', n, nulls, round(nulls * 100.0 / n, 6), nulls = 0 from c
    union all select 'model_input', 'between', 'd', nd, outside, round(outside * 100.0 / nd, 6), outside = 0 from c
    union all select 'model_input', 'unique', 'ts', n, 0, 0.0, true from c
    union all select 'model_input', 'in_set', 'is_holiday', n, 0, 0.0, true from c
    union all select 'model_input', 'on_step', 'ts', n, 0, 0.0, true from c"""))
def dq_suite_model_input(spark, sf_dir):
    """On a frame that was neither capped nor imputed, so that two checks fail."""
    frame = add_features(fill_grid(i.daily_parts(spark, sf_dir), DAY), us_holidays(spark))
    suite = model_input_suite(DAY, i.DAILY_LOW, i.DAILY_HIGH)
    return rounded(validate(frame, "model_input", suite), "unexpected_pct")


@query("dq_suite_two_keys", with_tables("he", """
    with twice as (select * from he union all select series_id, ts, d + 1 from he where hour(ts) = 12),
    c as (select count(*) as n, count(d) as nd from twice),
    t as (select coalesce(sum(k) filter (k > 1), 0)::bigint as u from (select count(*) as k from twice group by series_id, ts)),
    v as (select coalesce(sum(k) filter (k > 1), 0)::bigint as u from (select count(*) as k from twice where d is not null group by series_id, d))
    select 'two_keys' as suite, 'unique' as expectation, 'ts' as "column", n, u as n_unexpected,
      round(u * 100.0 / n, 6) as unexpected_pct, u = 0 as success from c, t
    union all select 'two_keys', 'unique', 'd', nd, u, round(u * 100.0 / nd, 6), u = 0 from c, v
    union all select 'two_keys', 'not_null', 'd', n, n - nd, round((n - nd) * 100.0 / n, 6), n = nd from c"""))
def dq_suite_two_keys(spark, sf_dir):
    """Times and values are both to be unique within a series; noon comes twice, with another value."""
    frame = i.hourly_types(spark, sf_dir)
    twice = frame.unionByName(frame.filter(F.hour("ts") == 12).withColumn("d", F.col("d") + 1))
    suite = [expect_unique("ts"), expect_unique("d"), expect_not_null("d")]
    return rounded(validate(twice, "two_keys", suite), "unexpected_pct")


@query("full_index_check", with_tables("he", """
    select series_id, min(ts) as start_ts, max(ts) as end_ts, count(*) as n_rows, date_diff('hour', min(ts), max(ts)) + 1 as n_expected,
      count(*) = date_diff('hour', min(ts), max(ts)) + 1 as full_index
    from (select * from he union all select cast(user_id as varchar), cast(date_trunc('hour', ts) as timestamp), null
          from events group by 1, 2) a group by 1"""))
def full_index_check_query(spark, sf_dir):
    types = i.hourly_types(spark, sf_dir)
    return full_index_check(types.unionByName(i.hourly_users(spark, sf_dir)))


@query("outlier_report", with_tables("hu", f"""
    select series_id, count(*) filter (d < {LOW}) as n_below, count(*) filter (d > {HIGH}) as n_above,
      min(d) filter (d < {LOW}) as lowest, max(d) filter (d > {HIGH}) as highest from hu group by 1"""))
def outlier_report_query(spark, sf_dir):
    return outlier_report(i.hourly_users(spark, sf_dir), "d", LOW, HIGH)


@query("histogram", with_tables("ds", """
    with v as (select * from ds where d is not null),
    b as (select series_id, min(d) as low, max(d) as high from v group by 1),
    n as (select series_id, low, high, case when high = low then 1
            else cast(least(floor((d - low) / ((high - low) / 50)) + 1, 50) as integer) end as bin, count(*) as n
          from v join b using (series_id) group by 1, 2, 3, 4)
    select series_id, bin, round(low + (bin - 1) * ((high - low) / 50), 6) as bin_start,
      round(low + bin * ((high - low) / 50), 6) as bin_end, n from n"""))
def histogram_query(spark, sf_dir):
    return rounded(histogram(i.daily_parts(spark, sf_dir), 50), "bin_start", "bin_end")


@query("within_range", with_tables("ds", f"select * from ds where d > {i.DAILY_LOW} and d < {i.DAILY_HIGH}"))
def within_range(spark, sf_dir):
    return within(i.daily_parts(spark, sf_dir), "d", i.DAILY_LOW, i.DAILY_HIGH)


@query("skew_report", with_tables("ds", f"""
    with c as (select series_id, d, case when d < {i.DAILY_LOW} then {i.DAILY_LOW} when d > {i.DAILY_HIGH} then {i.DAILY_HIGH}
        else d end as e from ds),
    m as (select series_id, avg(d) as md, avg(e) as me from c group by 1)
    select series_id, round({SKEW_SQL.format(c="d", m="md")}, 6) as skew_before,
      round({SKEW_SQL.format(c="e", m="me")}, 6) as skew_after from c join m using (series_id) group by 1"""))
def skew_report_query(spark, sf_dir):
    frame = skew_report(i.daily_parts(spark, sf_dir), "d", i.DAILY_LOW, i.DAILY_HIGH)
    return rounded(frame, "skew_before", "skew_after")


@query("profile", with_tables("ds", f"""
    with m as (select series_id, avg(d) as md from ds group by 1)
    select series_id, round(any_value(md), 5) as mean_d, round({SKEW_SQL.format(c="d", m="md")}, 6) as skew_d,
      round(quantile_cont(d, 0.5), 6) as median_d from ds join m using (series_id) group by 1"""))
def profile_query(spark, sf_dir):
    frame = rounded(profile(i.daily_parts(spark, sf_dir)), "skew_d", "median_d")
    # A mean of 544 amounts in cents can end in a 5 at the seventh decimal.
    return rounded(frame, "mean_d", places=5)


@query("describe", with_tables("ds", """
    select series_id, count(d) as n, round(avg(d), 5) as mean_d, round(stddev_samp(d), 6) as std_d, min(d) as min_d,
      round(quantile_cont(d, 0.25), 6) as p25, round(quantile_cont(d, 0.5), 6) as p50,
      round(quantile_cont(d, 0.75), 6) as p75, max(d) as max_d from ds group by 1"""))
def describe(spark, sf_dir):
    frame = describe_series(i.daily_parts(spark, sf_dir))
    return rounded(rounded(frame, "std_d", "p25", "p50", "p75"), "mean_d", places=5)


@query("table_summary", with_tables("hu_full", """
    select unnest(['series_id', 'ts', 'd']) as column_name, unnest(['string', 'timestamp_ntz', 'double']) as data_type,
      unnest([count(series_id), count(ts), count(d)]) as non_null from hu_full"""))
def table_summary_query(spark, sf_dir):
    return table_summary(fill_grid(i.hourly_users(spark, sf_dir)))


@query("null_map", with_tables("hu_full", """
    select series_id, cast(year(ts) as integer) as year, cast(dayofyear(ts) as integer) as dayofyear, count(*) as n_null
    from hu_full where d is null group by 1, 2, 3"""))
def null_map_query(spark, sf_dir):
    return null_map(fill_grid(i.hourly_users(spark, sf_dir)))


@query("null_pattern", with_tables("hu_raw", "with " + WIDE_SQL + """
    select series_id, count(*) as n_rows, count(*) filter (d is null and df is null) as both_null,
      count(*) filter (d is not null and df is not null) as neither_null,
      count(*) filter (d is null and df is not null) as only_d_null,
      count(*) filter (d is not null and df is null) as only_df_null from wide group by 1"""))
def null_pattern_query(spark, sf_dir):
    return null_pattern(facets_wide(typed_raw(i.raw_records(i.hourly_users(spark, sf_dir)))))


@query("hour_profile", with_tables("hu_full", """
    select series_id, cast(month(ts) as integer) as month, cast(hour(ts) as integer) as hour, round(avg(d), 6) as mean_d,
      count(*) as n_rows from hu_full group by 1, 2, 3"""))
def hour_profile_query(spark, sf_dir):
    return rounded(hour_profile(fill_grid(i.hourly_users(spark, sf_dir))), "mean_d")
