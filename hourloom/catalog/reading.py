"""Sources and sinks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from hourloom.catalog import inputs as i
from hourloom.catalog.inputs import with_tables
from hourloom.catalog.registry import query
from hourloom.consts import DAY, HOUR
from hourloom.operators.chunks import chunk_index, update_chunk_index
from hourloom.operators.features import holidays_hit
from hourloom.operators.lookup import lookup
from hourloom.operators.series import concat, fill_grid, time_bounds, typed_raw
from hourloom.plans.pipelines import requests_for, training_params
from hourloom.functions.time import range_key
from hourloom.session import work_path
from hourloom.sources import files, paged
from hourloom.sources.holidays import holidays_from_json, load_holidays, us_holidays
from hourloom.sources.sketches import RANK_ERROR, stored_quantiles, write_sketches
from hourloom.sources.store import (
    fetch_range,
    read_chunk_index,
    read_chunks,
    read_range,
    staged,
    upsert_chunks,
)

PAGE = 50

# One row per series and quarter, from bounds (series_id, start_ts, end_ts).
CHUNK_SQL = """
select series_id, cast(year(q) as integer) as year, cast(quarter(q) as integer) as quarter,
  q as start_ts, q + interval 3 month - interval 1 day as end_ts,
  greatest(start_ts, q) as data_start_ts, least(end_ts, q + interval 3 month - interval 1 day) as data_end_ts,
  year(q) || '_Q' || quarter(q) || '_from_' || strftime(q, '%Y-%m-%d-%H') || '_to_'
    || strftime(q + interval 3 month - interval 1 day, '%Y-%m-%d-%H') as name,
  (start_ts <= q and end_ts >= q + interval 3 month - interval 1 day) as complete
from (select series_id, start_ts, end_ts, unnest(generate_series(cast(date_trunc('quarter', start_ts) as timestamp),
        cast(date_trunc('quarter', end_ts) as timestamp), interval 3 month)) as q from {bounds}) b
"""


@query("chunks_roundtrip", with_tables("ds", "select series_id, ts, d, cast(year(ts) as integer) as year, "
       "cast(quarter(ts) as integer) as quarter from ds"))
def chunks_roundtrip(spark, sf_dir):
    return read_chunks(spark, i.new_store(i.daily_parts(spark, sf_dir), DAY))


@query("scan_range", with_tables("ds", "select * from ds where ts between timestamp '1996-02-15' and timestamp '1997-08-10'"))
def scan_range(spark, sf_dir):
    store = i.new_store(i.daily_parts(spark, sf_dir), DAY)
    return read_range(spark, store, datetime(1996, 2, 15), datetime(1997, 8, 10))


@query("chunk_index_roundtrip", with_tables("ds_bounds", CHUNK_SQL.format(bounds="ds_bounds")))
def chunk_index_roundtrip(spark, sf_dir):
    return read_chunk_index(spark, i.new_store(i.daily_parts(spark, sf_dir), DAY))


@query("page_plan", with_tables("hu_raw", f"""
    select series_id, page_no, page_no * {PAGE} as "offset", least({PAGE}, total - page_no * {PAGE}) as length
    from (select respondent as series_id, count(*) as total,
            unnest(generate_series(0, (count(*) + {PAGE - 1}) // {PAGE} - 1)) as page_no
          from hu_raw group by 1) p"""))
def page_plan(spark, sf_dir):
    raw = i.raw_records(i.hourly_users(spark, sf_dir))
    totals = raw.groupBy(F.col("respondent").alias("series_id")).agg(F.count("*").alias("total"))
    return paged.page_plan(totals, PAGE)


NUMBERED = """select period, respondent, type, value,
    row_number() over (partition by respondent order by position) - 1 as position from {raw}"""


@query("paged_read", with_tables("he_raw", NUMBERED.format(raw="he_raw")))
def paged_read(spark, sf_dir):
    path = work_path(spark, "pages")
    pages = i.json_pages(i.raw_records(i.hourly_types(spark, sf_dir)), 500)
    pages.write.partitionBy("respondent", "offset").text(path)
    return paged.read_paged(spark, path=path, page_size="500")


@query("parse_pages", with_tables("hu_raw", f"""
    select respondent as series_id, type, cast(value as double) as value, position,
      strptime(period, '%Y-%m-%dT%H') as ts from ({NUMBERED.format(raw="hu_raw")}) n"""))
def parse_pages(spark, sf_dir):
    pages = staged(i.json_pages(i.raw_records(i.hourly_users(spark, sf_dir)), PAGE), "json-pages")
    first, later = F.col("offset") == 0, F.col("offset") > 0
    return concat(
        [typed_raw(paged.parse_pages(pages.filter(part), offset="offset")) for part in (first, later)]
    )


@query("csv_roundtrip", with_tables("hu", "select * from hu"))
def csv_roundtrip(spark, sf_dir):
    path = work_path(spark, "csv")
    files.write_series_csv(i.hourly_users(spark, sf_dir), path)
    return files.read_series_csv(spark, path)


@query("normalize_published", with_tables("ds", """
    select series_id, ts, 'UTC' as time_zone, round(d * 2, 2) as df, d, case when d >= 20000 then d end as adjusted_d from ds"""))
def normalize_published(spark, sf_dir):
    series = i.daily_parts(spark, sf_dir)
    text = {
        "BA": F.col("series_id"),
        "UTC time": F.upper(F.date_format("ts", "ddMMMyyyy HH:mm:ss")),
        "Time zone": F.lit("UTC"),
        "DF": F.format_number(F.round(F.col("d") * 2, 2), 2),
        "D": F.format_number("d", 2),
        "Adjusted D": F.when(F.col("d") >= 20000, F.format_number("d", 2)),
    }
    columns = [
        text.get(f.name, F.lit(None).cast("string")).alias(f.name) for f in files.PUBLISHED.fields
    ]
    path = work_path(spark, "published")
    series.select(*columns).write.option("header", True).csv(path)
    return files.read_published_csv(spark, path)


@query("holiday_dim", """
    with days as (select cast(unnest(generate_series(timestamp '2018-01-01', timestamp '2039-12-31', interval 1 day)) as date) as d),
    fixed(name, m, dom, since) as (values ('New Year''s Day', 1, 1, 2018), ('Juneteenth', 6, 19, 2021),
      ('Independence Day', 7, 4, 2018), ('Veterans Day', 11, 11, 2018), ('Christmas Day', 12, 25, 2018)),
    floating(name, m, dow, low, high) as (values ('Martin Luther King Jr. Day', 1, 1, 15, 21),
      ('Presidents'' Day', 2, 1, 15, 21), ('Memorial Day', 5, 1, 25, 31), ('Labor Day', 9, 1, 1, 7),
      ('Columbus Day', 10, 1, 8, 14), ('Thanksgiving Day', 11, 4, 22, 28)),
    dim as (
      select d as holiday_date, name from days join fixed on month(d) = m and day(d) = dom and year(d) >= since
      union all select d, name || ' (substitute)' from days join fixed
        on (isodow(d) = 5 and month(d + 1) = m and day(d + 1) = dom and year(d + 1) >= since)
        or (isodow(d) = 1 and month(d - 1) = m and day(d - 1) = dom and year(d - 1) >= since)
      union all select d, name from days join floating on month(d) = m and isodow(d) = dow and day(d) between low and high
      union all select d, 'Inauguration Day' from days where month(d) = 1 and year(d) % 4 = 1
        and ((day(d) = 20 and isodow(d) <> 7) or (day(d) = 21 and isodow(d) = 1))
      union all select d, 'Christmas Eve' from days where month(d) = 12 and day(d) = 24 and year(d) <= 2020)
    select holiday_date, name, count(event_id) as n_events
    from dim left join events on cast(ts as date) = holiday_date group by 1, 2""")
def holiday_dim(spark, sf_dir):
    """The whole dimension, with the number of events on each holiday."""
    days = i.table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("holiday_date")).agg(
        F.count("*").alias("n_events")
    )
    return (
        us_holidays(spark)
        .join(days, "holiday_date", "left")
        .select("holiday_date", "name", F.coalesce("n_events", F.lit(0)).alias("n_events"))
    )


@query("holiday_files", """
    with dim(holiday_date, name) as (values (date '2024-01-01', 'New Year''s Day'), (date '2024-01-15', 'Martin Luther King Jr. Day'))
    select source, holiday_date, name, count(event_id) as n_events
    from dim cross join (values ('csv'), ('json')) t(source) left join events on cast(ts as date) = holiday_date
    group by all having count(event_id) > 0""")
def holiday_files(spark, sf_dir):
    """The dimension written as a CSV file and as yearly JSON answers and loaded from both, with the events of each holiday."""
    path = work_path(spark, "holidays")
    dim = us_holidays(spark)
    dim.select(F.col("holiday_date").alias("date"), "name").write.option("header", True).csv(path)
    entry = F.struct("name", F.struct(F.col("holiday_date").cast("string").alias("iso")).alias("date"))
    years = dim.groupBy(F.year("holiday_date")).agg(F.collect_list(entry).alias("holidays"))
    pages = years.select(F.to_json(F.struct(F.struct("holidays").alias("response"))).alias("body"))
    loaded = {"csv": load_holidays(spark, path), "json": holidays_from_json(pages)}
    both = concat([rows.select(F.lit(source).alias("source"), "holiday_date", "name") for source, rows in loaded.items()])
    days = i.table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("holiday_date")).agg(F.count("*").alias("n_events"))
    return both.join(days, "holiday_date").select("source", "holiday_date", "name", "n_events")


@query("holidays_hit", """
    with dim(holiday_date, name) as (values (date '2024-01-01', 'New Year''s Day'),
      (date '2024-01-15', 'Martin Luther King Jr. Day'))
    select distinct name from dim where holiday_date in (select cast(ts as date) from events)""")
def holidays_hit_query(spark, sf_dir):
    return holidays_hit(i.hourly_users(spark, sf_dir), us_holidays(spark))


@query("runs_roundtrip", with_tables("runs", "select * from runs"))
def runs_roundtrip(spark, sf_dir):
    path = work_path(spark, "runs")
    files.append_run(i.runs(spark, sf_dir), path)
    return files.read_runs(spark, path)


# Stored until the 20th, the rest of the request comes from the raw records.
HYBRID_SQL = """
stored as (select * from he_full where ts <= timestamp '2024-01-20 23:00:00'),
last as (select series_id, max(ts) as last_ts from stored group by 1),
missing as (select r.respondent as series_id, r.ts, r.type, r.value, r.position
    from he_raw r join last on respondent = series_id
    where r.ts between last_ts + interval 1 hour and timestamp '2024-01-28 12:00:00'),
grid as (select series_id, unnest(generate_series(min(ts), max(ts), interval 1 hour)) as ts from missing where type = 'D' group by 1),
demand as (select series_id, ts, cast(value as double) as d,
    row_number() over (partition by series_id, ts order by position) as rn from missing where type = 'D'),
fetched as (select g.series_id, g.ts, m.d from grid g
    left join (select * from demand where rn = 1) m using (series_id, ts))
"""


@query("hybrid_fetch", with_tables("he_full he_raw", "with " + HYBRID_SQL + """
    select * from stored where ts between timestamp '2024-01-05 00:00:00' and timestamp '2024-01-28 12:00:00'
    union all select * from fetched"""))
def hybrid_fetch(spark, sf_dir):
    series = i.hourly_types(spark, sf_dir)
    store = i.new_store(i.until(fill_grid(series), datetime(2024, 1, 20, 23)), HOUR)
    requests = requests_for(series, datetime(2024, 1, 5), datetime(2024, 1, 28, 12))
    return fetch_range(spark, store, i.raw_records(series), requests)


OLD_END, NEW_START = datetime(1999, 5, 15), datetime(1999, 3, 1)


@query("upsert_result", with_tables("ds_full", """
    select series_id, ts, case when ts <= timestamp '1999-05-15' then d else d * 2 end as d from ds_full"""))
def upsert_result(spark, sf_dir):
    filled = fill_grid(i.daily_parts(spark, sf_dir), DAY)
    store = i.new_store(i.until(filled, OLD_END), DAY)
    upsert_chunks(i.since(filled, NEW_START).withColumn("d", F.col("d") * 2), store, DAY)
    return read_chunks(spark, store).select("series_id", "ts", "d")


QUANTILES = (0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0)


@query("sketch_quantiles", with_tables("ds_full", f"""
    select series_id, p, count(d) as n, true as within_error from ds_full, (values {", ".join(f"({p:.2f}::double)" for p in QUANTILES)}) t(p)
    group by all having count(d) > 0"""))
def sketch_quantiles(spark, sf_dir):
    """Quantiles from the chunk sketches of a store that was updated once, and whether their true rank among the stored
    rows is as near as promised."""
    filled = fill_grid(i.daily_parts(spark, sf_dir), DAY)
    store = i.new_store(i.until(filled, OLD_END), DAY)
    write_sketches(spark, store)
    upsert_chunks(i.since(filled, NEW_START), store, DAY)
    wide = staged(stored_quantiles(spark, store, QUANTILES), "quantiles")
    pairs = F.array(*[F.struct(F.lit(p).alias("p"), F.col(f"q{k}").alias("q")) for k, p in enumerate(QUANTILES)])
    rows = read_chunks(spark, store).filter("d is not null").select("series_id", "d")
    # A row per series that is seven pairs wide: never sent through the driver.
    ranked = lookup(rows, wide.select("series_id", "n", pairs.alias("_pairs")).hint("merge"), ["series_id"], how="inner")
    counts = [
        F.struct(F.count_if(F.col("d") < F.col("_pairs")[k]["q"]).alias("below"), F.count_if(F.col("d") <= F.col("_pairs")[k]["q"]).alias("upto"))
        for k in range(len(QUANTILES))
    ]
    sums = ranked.groupBy("series_id", "n").agg(*[c.alias(f"c{k}") for k, c in enumerate(counts)])
    each = F.array(*[F.struct(F.lit(p).alias("p"), F.col(f"c{k}").alias("c")) for k, p in enumerate(QUANTILES)])
    p, n = F.col("x.p"), F.col("n")
    near = (F.col("x.c.below") / n <= p + RANK_ERROR) & (F.col("x.c.upto") / n >= p - RANK_ERROR)
    return sums.select("series_id", "n", F.explode(each).alias("x")).select("series_id", p.alias("p"), "n", near.alias("within_error"))


@query("chunk_index_update", with_tables("ds_bounds", CHUNK_SQL.format(bounds="ds_bounds")))
def chunk_index_update(spark, sf_dir):
    filled = fill_grid(i.daily_parts(spark, sf_dir), DAY)
    old = chunk_index(time_bounds(i.until(filled, OLD_END)), DAY)
    return update_chunk_index(old, time_bounds(i.since(filled, NEW_START)), DAY)


@query("range_keys", with_tables("ds_bounds", """
    select series_id, 'demand_' || strftime(start_ts, '%Y-%m-%d_%H') || '_' || strftime(end_ts, '%Y-%m-%d_%H')
      || '.parquet' as range_key from ds_bounds"""))
def range_keys(spark, sf_dir):
    return time_bounds(i.daily_parts(spark, sf_dir)).select(
        "series_id", range_key("demand", "start_ts", "end_ts").alias("range_key")
    )


@query("training_params", with_tables("dord_bounds", """
    select series_id, strftime(start_ts, '%Y-%m-%d_%H') as train_start, strftime(end_ts, '%Y-%m-%d_%H') as train_end
    from dord_bounds"""))
def training_params_query(spark, sf_dir):
    return training_params(i.daily_orders(spark, sf_dir))
