"""Train/test splits over time."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.consts import CV_SPLITS, HOUR, TEST_SET_HOURS
from hourloom.functions.time import steps_between
from hourloom.operators.lookup import lookup
from hourloom.operators.numbering import number_rows
from hourloom.operators.series import time_bounds


def with_bounds(df: DataFrame) -> DataFrame:
    """Add the first and last ts of its series to every row."""
    return lookup(df, time_bounds(df).drop("n_rows"), ["series_id"])


def holdout_split(
    df: DataFrame, n_rows: int = TEST_SET_HOURS, step: timedelta | None = None
) -> DataFrame:
    """Add ``is_train``: false on the last `n_rows` rows of each series.

    On a full grid, `step` turns the row count into a cut-off time; without it rows
    are counted, which also suits ragged series.
    """
    if step is not None:
        return (
            with_bounds(df)
            .withColumn("is_train", F.col("ts") <= F.col("end_ts") - F.lit(step * n_rows))
            .drop("start_ts", "end_ts")
        )
    return (
        number_rows(df, "_from_end", from_end=True)
        .withColumn("is_train", F.col("_from_end") > n_rows)
        .drop("_from_end")
    )


def trailing_window(df: DataFrame, days: int = 7) -> DataFrame:
    """Rows of the last `days` days of each series, first moment included."""
    return (
        with_bounds(df)
        .filter(F.col("ts") >= F.col("end_ts") - F.lit(timedelta(days=days)))
        .drop("start_ts", "end_ts")
    )


def with_segment(
    df: DataFrame,
    n_splits: int = CV_SPLITS,
    test_size: int = TEST_SET_HOURS,
    step: timedelta | None = HOUR,
) -> DataFrame:
    """Add ``segment``: 0 before all test parts, i inside the test part of fold i (from 1).

    Fold i trains on the segments below i and is tested on segment i. A series
    with no training rows left is an error.
    """
    if step is not None:
        bounded = with_bounds(df)
        cut = F.col("end_ts") - F.lit(step * (n_splits * test_size))
        # Steps past the cut, 1 for the first row of the first test part.
        past = steps_between(cut, F.col("ts"), step)
        too_short = F.col("start_ts") > cut
        rows = bounded.withColumn("_past", past).withColumn("_short", too_short)
    else:
        numbered = number_rows(df, "_from_end", from_end=True)
        sizes = df.groupBy("series_id").agg(F.count("*").alias("_size"))
        rows = (
            lookup(numbered, sizes, ["series_id"])
            .withColumn("_past", F.lit(n_splits * test_size + 1) - F.col("_from_end"))
            .withColumn("_short", F.col("_size") <= n_splits * test_size)
        )
    segment = F.when(
        F.col("_short"), F.raise_error(F.lit("a series is too short for this many test parts"))
    ).otherwise(F.when(F.col("_past") <= 0, 0).otherwise(F.floor((F.col("_past") - 1) / test_size) + 1))
    return rows.select(*df.columns, segment.cast("int").alias("segment"))


def ts_folds(
    df: DataFrame,
    n_splits: int = CV_SPLITS,
    test_size: int = TEST_SET_HOURS,
    step: timedelta | None = HOUR,
) -> DataFrame:
    """Per series and fold: bounds and sizes of the training and test parts.

    Expanding windows: the test parts are the last n_splits blocks of `test_size`
    steps and each fold trains on everything before its block.
    """
    segments = (
        with_segment(df, n_splits, test_size, step)
        .groupBy("series_id", "segment")
        .agg(F.min("ts").alias("low"), F.max("ts").alias("high"), F.count("*").alias("n"))
    )
    # At most n_splits + 1 rows per series from here on.
    packed = segments.groupBy("series_id").agg(
        F.sort_array(F.collect_list(F.struct("segment", "low", "high", "n"))).alias("_s")
    )
    folds = packed.select(
        "series_id", "_s", F.explode(F.sequence(F.lit(1), F.lit(n_splits))).alias("fold")
    )
    return folds.select(
        "series_id",
        "fold",
        F.expr("array_min(transform(filter(_s, s -> s.segment < fold), s -> s.low))").alias("train_start"),
        F.expr("array_max(transform(filter(_s, s -> s.segment < fold), s -> s.high))").alias("train_end"),
        F.expr("aggregate(filter(_s, s -> s.segment < fold), 0L, (a, s) -> a + s.n)").alias("n_train"),
        F.expr("filter(_s, s -> s.segment = fold)[0].low").alias("test_start"),
        F.expr("filter(_s, s -> s.segment = fold)[0].high").alias("test_end"),
        F.expr("filter(_s, s -> s.segment = fold)[0].n").alias("n_test"),
    )
