"""Ordered operators over one series, computed bucket by bucket.

A window over a whole series would put a series that holds a third of all rows
into one task. Here rows are ordered inside (series, stretch of time) buckets, and
only one summary row per bucket meets in the per-series window.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.functions.time import epoch_seconds, steps_between
from hourloom.operators.lookup import lookup

#: Steps of a grid that are ordered in one group.
BUCKET_STEPS = 4096


def with_bucket(df: DataFrame, ts: str, bucket: Column | None = None) -> DataFrame:
    """Add ``_bucket``: `bucket`, or else stretches of a series' time that hold BUCKET_STEPS rows on average.

    The stretch follows from the row count and the first and last `ts` of the series, so a month of second
    rows is cut as finely as years of daily ones.
    """
    if bucket is not None:
        return df.withColumn("_bucket", bucket)
    seconds = epoch_seconds(ts)
    spans = df.groupBy("series_id").agg(
        F.min(seconds).alias("_first"),
        F.greatest(F.lit(1.0), (F.max(seconds) - F.min(seconds)) / F.count("*") * BUCKET_STEPS).alias("_width"),
    )
    cut = F.floor((seconds - F.col("_first")) / F.col("_width"))
    return lookup(df, spans, ["series_id"]).withColumn("_bucket", cut).drop("_first", "_width")


def number_rows(
    df: DataFrame,
    name: str = "row_no",
    from_end: bool = False,
    order_by: str = "ts",
    bucket: Column | None = None,
) -> DataFrame:
    """1-based position of each row within its series by `order_by` (unique per series).

    `bucket` must not decrease with `order_by`, which may be anything then; see `with_bucket` for the default.
    """
    order = F.desc if from_end else F.asc
    bucketed = with_bucket(df, order_by, bucket)
    before = (
        Window.partitionBy("series_id")
        .orderBy(order("_bucket"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        bucketed.groupBy("series_id", "_bucket")
        .agg(F.count("*").alias("_n"))
        .select(
            "series_id", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
        )
    )
    within = Window.partitionBy("series_id", "_bucket").orderBy(order(order_by))
    return (
        bucketed.withColumn("_pos", F.row_number().over(within))
        .join(offsets, ["series_id", "_bucket"])
        .select(*df.columns, (F.col("_before") + F.col("_pos")).cast("bigint").alias(name))
    )


def missing_ranges(df: DataFrame, step: timedelta) -> DataFrame:
    """Maximal runs of missing steps between the first and last row of each series.

    A bucket spans BUCKET_STEPS steps, so that no group of ordered rows is larger.
    """
    seconds = int(step.total_seconds()) * BUCKET_STEPS
    rows = df.select("series_id", "ts", F.floor(epoch_seconds("ts") / seconds).alias("_bucket"))
    within = Window.partitionBy("series_id", "_bucket").orderBy("ts")
    inside = rows.select("series_id", "ts", F.lead("ts").over(within).alias("next_ts"))
    across = (
        rows.groupBy("series_id", "_bucket")
        .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("ts"))
        .select(
            "series_id",
            "ts",
            F.lead("first_ts")
            .over(Window.partitionBy("series_id").orderBy("_bucket"))
            .alias("next_ts"),
        )
    )
    width = F.lit(step)
    return (
        inside.unionByName(across)
        .filter(F.col("next_ts") > F.col("ts") + width)
        .select(
            "series_id",
            (F.col("ts") + width).alias("start_ts"),
            (F.col("next_ts") - width).alias("end_ts"),
            (steps_between("ts", "next_ts", step) - 1).alias("n_missing"),
        )
    )
