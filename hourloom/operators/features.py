"""Calendar, lag and holiday features."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import gcd

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourloom.consts import (
    HOLIDAY_FEATURES,
    LAG_DAYS,
    LAG_FEATURES,
    TIME_FEATURES,
    WEATHER_FEATURES,
)
from hourloom.schemas import FeatureFlags


def add_calendar_features(df: DataFrame) -> DataFrame:
    """UTC calendar fields; dayofweek counts from Monday = 0."""
    return df.withColumns(
        {
            "hour": F.hour("ts"),
            "month": F.month("ts"),
            "year": F.year("ts"),
            "quarter": F.quarter("ts"),
            "dayofweek": F.weekday("ts"),
            "dayofmonth": F.dayofmonth("ts"),
            "dayofyear": F.dayofyear("ts"),
        }
    )


def add_lag_features(
    df: DataFrame,
    days: Sequence[int] = LAG_DAYS,
    names: Sequence[str] = LAG_FEATURES,
    col: str = "d",
) -> DataFrame:
    """Value of the same series exactly `days` earlier, null where there is none.

    All lags are multiples of a common period (364 days by default), so rows that
    can see each other share (series_id, ts modulo period). One shuffle on that key
    serves every lag, with no join, and splits even a single huge series into one
    tiny group per step of the period. Needs unique (series_id, ts).
    """
    period = reduce(gcd, days)
    day = F.unix_date(F.to_date("ts")).cast("bigint")
    cycle = F.floor(day / period).cast("bigint")
    # The clock time is the rest of the phase, kept exact by taking ts itself
    # shifted to the first cycle.
    phase = F.col("ts") - F.make_dt_interval((cycle * period).cast("int"))
    same_phase = Window.partitionBy("series_id", "_phase").orderBy("_cycle")
    lagged = {
        name: F.first(col).over(same_phase.rangeBetween(-(d // period), -(d // period)))
        for name, d in zip(names, days, strict=True)
    }
    return (
        df.withColumn("_cycle", cycle)
        .withColumn("_phase", phase)
        .withColumns(lagged)
        .drop("_cycle", "_phase")
    )


def add_holiday_flag(df: DataFrame, holidays: DataFrame) -> DataFrame:
    """1 on rows whose UTC date is a holiday, else 0."""
    dates = holidays.select(F.col("holiday_date").alias("_date")).distinct()
    return (
        df.withColumn("_ts_date", F.to_date("ts"))
        .join(dates, F.col("_ts_date") == F.col("_date"), "left")
        .withColumn("is_holiday", F.col("_date").isNotNull().cast("int"))
        .drop("_ts_date", "_date")
    )


def holidays_hit(df: DataFrame, holidays: DataFrame) -> DataFrame:
    """Distinct names of the holidays that occur in the data."""
    dates = df.select(F.to_date("ts").alias("holiday_date")).distinct()
    return dates.join(holidays, "holiday_date").select("name").distinct()


def add_features(df: DataFrame, holidays: DataFrame) -> DataFrame:
    return add_holiday_flag(add_lag_features(add_calendar_features(df)), holidays)


def feature_columns(flags: FeatureFlags = FeatureFlags()) -> list[str]:
    """Calendar features, then the lag, weather and holiday groups that are switched on."""
    columns = list(TIME_FEATURES)
    for wanted, group in (
        (flags.lag, LAG_FEATURES),
        (flags.weather, WEATHER_FEATURES),
        (flags.holidays, HOLIDAY_FEATURES),
    ):
        if wanted:
            columns.extend(group)
    return columns


def select_features(
    df: DataFrame, flags: FeatureFlags = FeatureFlags(), keep: Sequence[str] = ("series_id", "ts", "d")
) -> DataFrame:
    columns = feature_columns(flags)
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"the frame has no column {', '.join(absent)}")
    return df.select(*keep, *columns)


def detect_groups(columns: Sequence[str]) -> FeatureFlags:
    """Feature groups that a list of input columns covers completely."""
    have = set(columns)
    return FeatureFlags(
        lag=have.issuperset(LAG_FEATURES),
        weather=have.issuperset(WEATHER_FEATURES),
        holidays=have.issuperset(HOLIDAY_FEATURES),
    )
