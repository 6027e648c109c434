"""Calendar-quarter chunks: index, hit/miss, diff and statistics."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourloom.consts import HOUR
from hourloom.functions.time import compact_ts, steps_between
from hourloom.schemas import CHUNK_INDEX


def chunk_index(bounds: DataFrame, step: timedelta = HOUR) -> DataFrame:
    """One row per series and calendar quarter touched by (start_ts, end_ts).

    A chunk is complete when the data reaches from its first to its last step.
    """
    first_day = F.trunc(F.to_date("data_start"), "quarter")
    last_day = F.trunc(F.to_date("data_end"), "quarter")
    chunks = bounds.select(
        "series_id", F.col("start_ts").alias("data_start"), F.col("end_ts").alias("data_end")
    ).select(
        "*",
        F.explode(F.sequence(first_day, last_day, F.expr("interval 3 months"))).alias("_day"),
    )
    start = F.col("_day").cast("timestamp_ntz")
    end = F.add_months("_day", 3).cast("timestamp_ntz") - F.lit(step)
    name = F.concat(
        F.year("_day").cast("string"),
        F.lit("_Q"),
        F.quarter("_day").cast("string"),
        F.lit("_from_"),
        compact_ts("start_ts", "-"),
        F.lit("_to_"),
        compact_ts("end_ts", "-"),
    )
    return (
        chunks.withColumns({"start_ts": start, "end_ts": end})
        .withColumns(
            {
                "year": F.year("_day"),
                "quarter": F.quarter("_day"),
                "data_start_ts": F.greatest("data_start", "start_ts"),
                "data_end_ts": F.least("data_end", "end_ts"),
                "name": name,
            }
        )
        .withColumn(
            "complete",
            (F.col("data_start_ts") == F.col("start_ts")) & (F.col("data_end_ts") == F.col("end_ts")),
        )
        .select(*[f.name for f in CHUNK_INDEX])
    )


def index_bounds(index: DataFrame) -> DataFrame:
    """The contiguous range each series' chunks cover."""
    return index.groupBy("series_id").agg(
        F.min("data_start_ts").alias("start_ts"), F.max("data_end_ts").alias("end_ts")
    )


def update_chunk_index(old: DataFrame, new_bounds: DataFrame, step: timedelta = HOUR) -> DataFrame:
    """Index over the old start to the new end of each series; a gap is an error, and so is new data from
    before the stored start, which the index could not name.

    Series known to only one side keep that side's range, and data ending before the
    stored end leaves the stored range as it is.
    """
    stored = index_bounds(old)
    fresh = new_bounds.select(
        "series_id", F.col("start_ts").alias("new_start"), F.col("end_ts").alias("new_end")
    )
    gap = F.col("new_start") > F.col("end_ts") + F.lit(step)
    early = F.col("new_start") < F.col("start_ts")
    merged = stored.join(fresh, "series_id", "full").select(
        "series_id",
        F.when(gap, F.raise_error(F.concat(F.lit("data gap after the stored range of "), "series_id")))
        .when(early, F.raise_error(F.concat(F.lit("data from before the stored range of "), "series_id")))
        .otherwise(F.coalesce("start_ts", "new_start"))
        .alias("start_ts"),
        F.greatest("end_ts", "new_end").alias("end_ts"),
    )
    return chunk_index(merged, step)


def hit_miss(index: DataFrame, requests: DataFrame, step: timedelta = HOUR) -> DataFrame:
    """Split each requested (series_id, start_ts, end_ts) into a stored and a missing range.

    The missing part starts one step after the stored end, also when the request
    starts later, so that fetching it can never leave a hole. A request that starts
    before the stored range is an error. A series without chunks is all missing.
    """
    stored = index_bounds(index).select(
        "series_id", F.col("start_ts").alias("_first"), F.col("end_ts").alias("_last")
    )
    too_early = F.col("start_ts") < F.col("_first")
    checked = F.when(
        too_early, F.raise_error(F.lit("the request starts before the stored range"))
    ).otherwise(F.col("start_ts"))
    hit = F.col("request_start") <= F.col("_last")
    known = F.col("_last").isNotNull()
    return (
        requests.join(stored, "series_id", "left")
        .withColumns({"request_start": checked, "request_end": F.col("end_ts")})
        .select(
            "series_id",
            "request_start",
            "request_end",
            F.when(hit, F.col("request_start")).alias("hit_start"),
            F.when(hit, F.least("request_end", "_last")).alias("hit_end"),
            F.when(~known, F.col("request_start"))
            .when(F.col("request_end") > F.col("_last"), F.col("_last") + F.lit(step))
            .alias("miss_start"),
            F.when(~known | (F.col("request_end") > F.col("_last")), F.col("request_end")).alias(
                "miss_end"
            ),
        )
    )


def chunk_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Chunks to write: `update` = partial in old and present in new, `append` = only in new.

    Both have a row per series and quarter. Their files are so small for their rows that Spark would broadcast millions of
    rows through the driver, so they are sort-merged.
    """
    key = ["series_id", "start_ts"]
    update = old.filter(~F.col("complete")).join(new.hint("merge"), key, "left_semi")
    append = new.join(old.hint("merge"), key, "left_anti")
    return (
        update.withColumn("action", F.lit("update"))
        .unionByName(append.withColumn("action", F.lit("append")))
        .select("action", *old.columns)
    )


def chunk_diff_report(old: DataFrame, new: DataFrame) -> DataFrame:
    """The chunks of the diff with their bounds and how many share their action."""
    rows = chunk_diff(old, new).select(
        "series_id", "action", "year", "quarter", "start_ts", "end_ts", "complete"
    )
    # A group holds the chunks of one series, four per year.
    same_action = Window.partitionBy("series_id", "action")
    return rows.withColumn("n_chunks", F.count("*").over(same_action))


def chunk_stats(df: DataFrame) -> DataFrame:
    """Data bounds and row count per series and quarter."""
    return df.groupBy("series_id", F.year("ts").alias("year"), F.quarter("ts").alias("quarter")).agg(
        F.min("ts").alias("data_start_ts"),
        F.max("ts").alias("data_end_ts"),
        F.count("*").alias("n_rows"),
    )


def coverage_report(df: DataFrame, requests: DataFrame, step: timedelta = HOUR) -> DataFrame:
    """Requested and available steps per series; `short` when no more came than was asked for."""
    have = df.groupBy("series_id").agg(
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.count("*").alias("available"),
        F.count_if(F.col("d").isNull()).alias("n_null"),
    )
    return (
        requests.join(have, "series_id", "left")
        .withColumn("requested", steps_between("start_ts", "end_ts", step))
        .withColumn("available", F.coalesce("available", F.lit(0)))
        .withColumn("short", F.col("available") <= F.col("requested"))
        .select("series_id", "requested", "available", "n_null", "first_ts", "last_ts", "short")
    )
