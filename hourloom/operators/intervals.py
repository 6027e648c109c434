"""Closed intervals per series: merge, intersection, lag back-fill ranges."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.consts import LAG_DAYS
from hourloom.functions.time import epoch_seconds
from hourloom.operators.numbering import with_bucket


def merge_intervals(df: DataFrame, bucket: Column | None = None) -> DataFrame:
    """Merge overlapping or touching intervals (series_id, start_ts, end_ts).

    Intervals that start together collapse to the longest before any ordering. The
    running maximum is taken inside (series, bucket) groups, where it starts from how
    far the earlier buckets reach, and gives partial islands. Only the first and the
    last island of a bucket can go on across a border, so only those meet in one group
    per series. `bucket` must not decrease with start_ts; see `with_bucket` for the default.
    """
    longest = df.groupBy("series_id", "start_ts").agg(F.max("end_ts").alias("end_ts"))
    starts = with_bucket(longest, "start_ts", bucket)
    earlier = (
        Window.partitionBy("series_id")
        .orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = (
        starts.groupBy("series_id", "_bucket")
        .agg(F.max("end_ts").alias("_end"))
        .select("series_id", "_bucket", F.max("_end").over(earlier).alias("_carry"))
    )
    inside = Window.partitionBy("series_id", "_bucket").orderBy("start_ts")
    reached = F.greatest(
        "_carry", F.max("end_ts").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    )
    islands = (
        starts.join(carry, ["series_id", "_bucket"])
        .withColumn("_opens", F.when(reached >= F.col("start_ts"), 0).otherwise(1))
        .withColumn("_local", F.sum("_opens").over(inside))
        .groupBy("series_id", "_bucket", "_local")
        .agg(
            F.min("start_ts").alias("start_ts"),
            F.max("end_ts").alias("end_ts"),
            F.max("_opens").alias("_opens"),
        )
        .withColumn("_last", F.max("_local").over(Window.partitionBy("series_id", "_bucket")))
    )
    # Islands inside a bucket are final; each is a group of its own.
    inner = (F.col("_opens") == 1) & (F.col("_local") < F.col("_last"))
    grouped = islands.withColumn("_inner", F.when(inner, F.struct("_bucket", "_local")))
    along = Window.partitionBy("series_id", "_inner").orderBy("_bucket", "_local")
    return (
        grouped.withColumn("_island", F.sum("_opens").over(along))
        .groupBy("series_id", "_inner", "_island")
        .agg(F.min("start_ts").alias("start_ts"), F.max("end_ts").alias("end_ts"))
        .select("series_id", "start_ts", "end_ts")
    )


def check_intervals(df: DataFrame) -> DataFrame:
    """Fail on an interval that ends before it starts."""
    bad = F.col("start_ts") > F.col("end_ts")
    return df.withColumn(
        "start_ts",
        F.when(bad, F.raise_error(F.lit("interval ends before it starts"))).otherwise(F.col("start_ts")),
    )


def intersect_intervals(a: DataFrame, b: DataFrame) -> DataFrame:
    """Non-empty intersections of the intervals of two sets, series by series.

    Touching ends intersect; equal intervals of one set count once. An interval lives on the level whose slots, 4 ** level
    seconds wide, are as long as it is, so that it lies in two of them at most, and two intervals meet on the level of the longer
    one: each set's intervals, on their own level, are equi-joined on (series_id, level, slot) with the other set's shorter ones,
    placed in the slots of that level. So ten years among seconds are two rows, and seconds are one or two rows for each
    level above theirs that the other set has. A pair is kept in the slot in which its intersection starts.
    """
    seconds = epoch_seconds("end_ts") - epoch_seconds("start_ts")
    level = F.ceil(F.log2(seconds + 1) / 2).cast("int")

    def levelled(df: DataFrame) -> DataFrame:
        distinct = check_intervals(df).select("series_id", "start_ts", "end_ts").distinct()
        return distinct.withColumn("_own", level)

    sides = {"a": levelled(a), "b": levelled(b)}
    found = [check_intervals(df).select(F.lit(side).alias("side"), level.alias("own")) for side, df in (("a", a), ("b", b))]
    used = found[0].unionByName(found[1]).filter("own is not null").distinct().collect()  # about twenty a side at most
    levels = {side: sorted(row.own for row in used if row.side == side) for side in sides}

    def slot(ts: Column | str) -> Column:
        return F.floor(epoch_seconds(ts) / F.pow(F.lit(4.0), F.col("_level")))

    def placed(side: str, rows: DataFrame) -> DataFrame:
        return rows.select(
            "series_id",
            F.col("start_ts").alias(f"{side}_start"),
            F.col("end_ts").alias(f"{side}_end"),
            "_level",
            F.explode(F.sequence(slot("start_ts"), slot("end_ts"))).alias("_slot"),
        )

    def on_own(side: str, meets: Column) -> DataFrame:
        return placed(side, sides[side].withColumn("_level", F.col("_own")).filter(meets))

    def on_levels(side: str, other: str, meets: Column) -> DataFrame:
        theirs = F.array(*[F.lit(x) for x in levels[other]]).cast("array<int>")
        return placed(side, sides[side].withColumn("_level", F.explode(theirs)).filter(meets))

    def least(side: str) -> Column:
        return F.lit(min(levels[side], default=None)).cast("int")

    own = F.col("_own")
    key = ["series_id", "_level", "_slot"]
    # Only levels on which the other set can have a row: a's own ones not below b's lowest, b's own ones above a's lowest.
    meetings = on_own("a", own >= least("b")).join(on_levels("b", "a", F.col("_level") >= own), key)
    columns = [*key, "a_start", "a_end", "b_start", "b_end"]
    others = on_own("b", own > least("a")).join(on_levels("a", "b", F.col("_level") > own), key)
    meetings = meetings.select(*columns).unionByName(others.select(*columns))
    start = F.greatest("a_start", "b_start")
    return (
        meetings.filter("a_start <= b_end and b_start <= a_end")
        .filter(slot(start) == F.col("_slot"))
        .select(
            "series_id",
            "a_start",
            "a_end",
            "b_start",
            "b_end",
            start.alias("start_ts"),
            F.least("a_end", "b_end").alias("end_ts"),
        )
    )


def backfill_ranges(bounds: DataFrame, lag_days: Sequence[int] = LAG_DAYS) -> DataFrame:
    """Which history the lag features of (start_ts, end_ts) need, as merged ranges."""
    shift = F.make_dt_interval(F.col("_days"))
    lagged = bounds.select(
        "series_id",
        "start_ts",
        "end_ts",
        F.explode(F.array(*[F.lit(d) for d in sorted(lag_days, reverse=True)])).alias("_days"),
    ).select(
        "series_id",
        (F.col("start_ts") - shift).alias("start_ts"),
        F.least("start_ts", F.col("end_ts") - shift).alias("end_ts"),
    )
    return merge_intervals(lagged)
