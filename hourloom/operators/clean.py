"""Outlier capping and imputation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.consts import MAX_DEMAND, MIN_DEMAND
from hourloom.functions.values import capped
from hourloom.operators.lookup import lookup


def cap_outliers(
    df: DataFrame, col: str = "d", low: float = MIN_DEMAND, high: float = MAX_DEMAND
) -> DataFrame:
    return df.withColumn(col, capped(col, low, high))


def month_hour_means(df: DataFrame, col: str = "d") -> DataFrame:
    """Null-skipping mean per series, month and hour, with the row count of the group."""
    return df.groupBy("series_id", F.month("ts").alias("month"), F.hour("ts").alias("hour")).agg(
        F.avg(col).alias("mean_d"), F.count("*").alias("n_rows")
    )


def impute_month_hour(df: DataFrame, col: str = "d", fit_on: DataFrame | None = None) -> DataFrame:
    """Replace nulls by the mean of the same month and hour.

    Means come from the whole frame, later rows included, unless `fit_on` names the
    rows to learn from. A group with no value at all stays null.
    """
    keyed = df.withColumn("_month", F.month("ts")).withColumn("_hour", F.hour("ts"))
    means = month_hour_means(df if fit_on is None else fit_on, col).select(
        "series_id",
        F.col("month").alias("_month"),
        F.col("hour").alias("_hour"),
        "mean_d",
    )
    return (
        lookup(keyed, means, ["series_id", "_month", "_hour"])
        .withColumn(col, F.coalesce(col, "mean_d"))
        .select(*df.columns)
    )


def clean(
    df: DataFrame,
    low: float = MIN_DEMAND,
    high: float = MAX_DEMAND,
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Cap, then impute from the capped values.

    `fit_on` may name the rows that carry the values when `df` is a filled grid over
    them: nulls do not count in a mean, so the grid need not be built twice.
    """
    learned = None if fit_on is None else cap_outliers(fit_on, "d", low, high)
    return impute_month_hour(cap_outliers(df, "d", low, high), fit_on=learned)
