"""Time series derived from the given tables, as DataFrames and as SQL text.

All of them cover their whole table:
hourly_users   events, one series per user, hourly sums (many gappy series)
hourly_types   events, one series per event type, hourly sums (few dense series)
daily_parts    lineitem, one series per supplier, daily sums over 6.8 years
daily_orders   orders, one series per priority, daily sums
raw records    an hourly or daily series as text records with a demand and a
               day-ahead forecast facet and repeated rows, as a paged API returns them
runs           events as evaluation runs of models
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.consts import DAY
from hourloom.functions.time import epoch_seconds, floor_day, floor_hour, ntz
from hourloom.operators.numbering import number_rows
from hourloom.sources.store import write_store
from hourloom.session import work_path

# Caps for the two value ranges.
HOURLY_LOW, HOURLY_HIGH = 10.0, 300.0
DAILY_LOW, DAILY_HIGH = 20_000.0, 60_000.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _series(df: DataFrame, series: Column, ts: Column, value: str) -> DataFrame:
    total = F.sum(F.col(value).cast("decimal(18,2)")).cast("double")
    return df.groupBy(series.cast("string").alias("series_id"), ts.alias("ts")).agg(total.alias("d"))


def hourly_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = floor_hour(F.col("ts").cast("timestamp_ntz"))
    return _series(table(spark, sf_dir, "events"), F.col("user_id"), ts, "value")


def hourly_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = floor_hour(F.col("ts").cast("timestamp_ntz"))
    return _series(table(spark, sf_dir, "events"), F.col("event_type"), ts, "value")


def daily_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = floor_day(F.col("l_shipdate").cast("timestamp_ntz"))
    return _series(table(spark, sf_dir, "lineitem"), F.col("l_suppkey"), ts, "l_extendedprice")


def daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = floor_day(F.col("o_orderdate").cast("timestamp_ntz"))
    return _series(table(spark, sf_dir, "orders"), F.col("o_orderpriority"), ts, "o_totalprice")


def raw_records(series: DataFrame) -> DataFrame:
    """Text records of a series: (period, respondent, type, value, position).

    Each value is reported as demand and, a day later, as that day's forecast. The
    records of midnight come twice, those of noon come again with another value.
    """
    facets = series.select(
        F.col("series_id").alias("respondent"),
        "d",
        F.explode(
            F.array(
                F.struct(F.lit("D").alias("type"), F.col("ts").alias("ts")),
                F.struct(F.lit("DF").alias("type"), (F.col("ts") + F.lit(DAY)).alias("ts")),
            )
        ).alias("f"),
    ).select("respondent", "f.type", "f.ts", "d")
    hour = F.hour("ts")
    copies = F.sequence(F.lit(0), F.when(hour.isin(0, 12), 1).otherwise(0))
    repeated = facets.withColumn("copy", F.explode(copies))
    value = F.col("d") + F.when((hour == 12) & (F.col("copy") == 1), 1.0).otherwise(0.0)
    position = epoch_seconds("ts") / 3600 * 4 + F.when(F.col("type") == "DF", 2).otherwise(0) + F.col("copy")
    return repeated.select(
        F.concat(F.to_date("ts").cast("string"), F.lit("T"), F.lpad(hour.cast("string"), 2, "0")).alias("period"),
        "respondent",
        "type",
        value.cast("decimal(18,2)").cast("string").alias("value"),
        position.cast("bigint").alias("position"),
    )


def dense_positions(raw: DataFrame) -> DataFrame:
    """The same records numbered 0, 1, 2, ... per respondent."""
    keyed = raw.withColumn("series_id", F.col("respondent"))
    numbered = number_rows(keyed, "_no", order_by="position", bucket=F.floor(F.col("position") / 4096))
    return numbered.select(
        "period", "respondent", "type", "value", (F.col("_no") - 1).alias("position")
    )


def json_pages(raw: DataFrame, page_size: int) -> DataFrame:
    """(respondent, offset, body): records packed into JSON answers of `page_size` rows."""
    dense = dense_positions(raw)
    totals = raw.groupBy("respondent").agg(F.count("*").cast("string").alias("total"))
    record = F.struct("period", "respondent", "type", "value")
    pages = dense.groupBy(
        "respondent", (F.floor(F.col("position") / page_size) * page_size).alias("offset")
    ).agg(F.sort_array(F.collect_list(F.struct("position", record.alias("r")))).alias("rows"))
    data = F.transform("rows", lambda row: row["r"])
    return pages.join(totals, "respondent").select(
        "respondent",
        "offset",
        F.to_json(F.struct(F.struct("total", data.alias("data")).alias("response"))).alias("body"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    version = F.pmod(F.col("user_id"), F.lit(3)).cast("int")
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            F.col("event_type").alias("model_name"),
            version.alias("model_version"),
            floor_day(F.col("ts").cast("timestamp_ntz")).alias("start_time"),
        )
        .agg(
            F.count("*").cast("double").alias("r2_score"),
            F.max("value").alias("root_mean_squared_error"),
            F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("mean_squared_error"),
            F.min("value").alias("mean_absolute_percentage_error"),
        )
        .withColumn(
            "feature_flags",
            F.element_at(F.array(F.lit("fB___"), F.lit("fBL__"), F.lit("fBL_H")), F.col("model_version") + 1),
        )
    )


def until(df: DataFrame, end: datetime) -> DataFrame:
    return df.filter(F.col("ts") <= ntz(end))


def since(df: DataFrame, start: datetime) -> DataFrame:
    return df.filter(F.col("ts") >= ntz(start))


def new_store(df: DataFrame, step) -> str:
    """A store in the work folder that holds `df`."""
    path = work_path(df.sparkSession, "store")
    write_store(df, path, step)
    return path


# The same inputs as SQL, to be put together with `with_tables`.
SQL = {
    "hu": """select cast(user_id as varchar) as series_id, cast(date_trunc('hour', ts) as timestamp) as ts,
        cast(sum(cast(value as decimal(18,2))) as double) as d from events group by 1, 2""",
    "he": """select event_type as series_id, cast(date_trunc('hour', ts) as timestamp) as ts,
        cast(sum(cast(value as decimal(18,2))) as double) as d from events group by 1, 2""",
    "ds": """select cast(l_suppkey as varchar) as series_id, cast(date_trunc('day', l_shipdate) as timestamp) as ts,
        cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as d from lineitem group by 1, 2""",
    "dord": """select o_orderpriority as series_id, cast(date_trunc('day', o_orderdate) as timestamp) as ts,
        cast(sum(cast(o_totalprice as decimal(18,2))) as double) as d from orders group by 1, 2""",
    "runs": """select event_type as model_name, cast(user_id % 3 as integer) as model_version,
        cast(date_trunc('day', ts) as timestamp) as start_time,
        case user_id % 3 when 0 then 'fB___' when 1 then 'fBL__' else 'fBL_H' end as feature_flags,
        cast(count(*) as double) as r2_score,
        max(value) as root_mean_squared_error,
        cast(sum(cast(value as decimal(18,2))) as double) as mean_squared_error,
        min(value) as mean_absolute_percentage_error
        from events group by 1, 2, 3, 4""",
}
for _name, _step in (("hu", "1 hour"), ("he", "1 hour"), ("ds", "1 day"), ("dord", "1 day")):
    SQL[f"{_name}_bounds"] = (
        f"select series_id, min(ts) as start_ts, max(ts) as end_ts, count(*) as n from {_name} group by 1"
    )
    SQL[f"{_name}_grid"] = (
        f"select series_id, unnest(generate_series(start_ts, end_ts, interval {_step})) as ts from {_name}_bounds"
    )
    SQL[f"{_name}_full"] = (
        f"select g.series_id, g.ts, s.d from {_name}_grid g left join {_name} s using (series_id, ts)"
    )
    SQL[f"{_name}_raw"] = f"""
        select strftime(ts, '%Y-%m-%dT%H') as period, series_id as respondent, type,
          cast(cast(d + case when hour(ts) = 12 and copy = 1 then 1 else 0 end as decimal(18,2)) as varchar) as value,
          cast(epoch(ts) // 3600 as bigint) * 4 + case when type = 'DF' then 2 else 0 end + copy as position,
          ts, copy
        from (select series_id, ts, d, 'D' as type from {_name}
              union all select series_id, ts + interval 1 day, d, 'DF' from {_name}) f
        join (select 0 as copy union all select 1) c on copy = 0 or hour(ts) in (0, 12)"""


_NEEDS = {
    **{f"{n}_bounds": (n,) for n in ("hu", "he", "ds", "dord")},
    **{f"{n}_grid": (f"{n}_bounds",) for n in ("hu", "he", "ds", "dord")},
    **{f"{n}_full": (f"{n}_grid",) for n in ("hu", "he", "ds", "dord")},
    **{f"{n}_raw": (n,) for n in ("hu", "he", "ds", "dord")},
}


def with_tables(names: str, body: str) -> str:
    """`body` preceded by the named inputs and what they are made from."""
    order: list[str] = []

    def visit(name: str) -> None:
        for needed in _NEEDS.get(name, ()):
            visit(needed)
        if name not in order:
            order.append(name)

    for name in names.split():
        visit(name)
    ctes = ",\n".join(f"{name} as materialized ({SQL[name]})" for name in order)
    extra = body.lstrip()
    if extra.startswith("with "):
        return f"with {ctes},\n{extra[5:]}"
    return f"with {ctes}\n{extra}"


def clean_sql(source: str, low: float, high: float) -> str:
    """Capping and imputation of `source` (series_id, ts, d) as a subquery."""
    return f"""select series_id, ts, coalesce(c, avg(c) over (partition by series_id, month(ts), hour(ts))) as d
        from (select series_id, ts, case when d < {low} then {low} when d > {high} then {high} else d end as c
              from {source}) capped"""


CALENDAR_SQL = """cast(hour(ts) as integer) as hour, cast(month(ts) as integer) as month,
    cast(year(ts) as integer) as year, cast(quarter(ts) as integer) as quarter,
    cast(isodow(ts) - 1 as integer) as dayofweek, cast(day(ts) as integer) as dayofmonth,
    cast(dayofyear(ts) as integer) as dayofyear"""
