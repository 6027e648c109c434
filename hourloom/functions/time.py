"""Timestamp expressions.

Everything works on TIMESTAMP_NTZ through dates, clock fields and day-time
intervals, none of which look at the session time zone.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(value: datetime) -> Column:
    """A TIMESTAMP_NTZ literal."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def ceil_div(num: Column, den: Column) -> Column:
    """Integer division rounding up, for `num` >= 0."""
    return F.floor((num + den - 1) / den).cast("bigint")


def to_utc(text: Column | str, fmt: str = "yyyy-MM-dd'T'HH") -> Column:
    return F.to_timestamp_ntz(_col(text), F.lit(fmt))


def floor_day(ts: Column | str) -> Column:
    return F.to_date(_col(ts)).cast("timestamp_ntz")


def floor_hour(ts: Column | str) -> Column:
    return floor_day(ts) + F.make_dt_interval(F.lit(0), F.hour(_col(ts)))


def floor_quarter(ts: Column | str) -> Column:
    return F.trunc(F.to_date(_col(ts)), "quarter").cast("timestamp_ntz")


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970-01-01 00:00:00 as BIGINT."""
    ts = _col(ts)
    day = F.unix_date(F.to_date(ts)).cast("bigint")
    return day * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def steps_between(start: Column | str, end: Column | str, step: timedelta) -> Column:
    """How many whole steps fit between two timestamps (BIGINT)."""
    seconds = int(step.total_seconds())
    return F.floor((epoch_seconds(end) - epoch_seconds(start)) / F.lit(seconds)).cast("bigint")


def hours_between(start: Column | str, end: Column | str) -> Column:
    return steps_between(start, end, timedelta(hours=1))


def compact_ts(ts: Column | str, day_hour_sep: str = "_") -> Column:
    """``yyyy-MM-dd_HH``."""
    ts = _col(ts)
    hour = F.lpad(F.hour(ts).cast("string"), 2, "0")
    return F.concat(F.to_date(ts).cast("string"), F.lit(day_hour_sep), hour)


def parse_compact_ts(text: Column | str) -> Column:
    return to_utc(text, "yyyy-MM-dd_HH")


def range_key(prefix: str, start: Column | str, end: Column | str) -> Column:
    """Dataset name that carries its time range."""
    return F.concat(F.concat_ws("_", F.lit(prefix), compact_ts(start), compact_ts(end)), F.lit(".parquet"))


def quantize_start(ts: Column | str) -> Column:
    """Midnight at or before `ts`."""
    return floor_day(ts)


def quantize_end(ts: Column | str) -> Column:
    """The first midnight after `ts` (one day later when `ts` is midnight)."""
    return floor_day(_col(ts) + F.lit(timedelta(days=1)))


def round_hour(ts: Column | str) -> Column:
    """Nearest hour; exact halves go to the even hour of the epoch count."""
    ts = _col(ts)
    within = F.minute(ts) * 60 + F.extract(F.lit("SECOND"), ts)
    hours = F.unix_date(F.to_date(ts)).cast("bigint") * 24 + F.hour(ts)
    up = (within > 1800) | ((within == 1800) & (F.pmod(hours, F.lit(2)) == 1))
    return floor_hour(ts) + F.make_dt_interval(F.lit(0), F.when(up, 1).otherwise(0))


def usable_until(now: Column | str, buffer_hours: int) -> Column:
    """Newest hour that is complete given the reporting delay."""
    return round_hour(now) - F.lit(timedelta(hours=buffer_hours))


def plus_years(ts: Column | str, years: int) -> Column:
    """Calendar-year offset (Feb 29 clips to Feb 28), keeping the clock time."""
    ts = _col(ts)
    return F.add_months(F.to_date(ts), 12 * years).cast("timestamp_ntz") + (ts - floor_day(ts))


def on_step(ts: Column | str, step: timedelta = timedelta(hours=1)) -> Column:
    """On a whole step; for the hour: minute and second are zero, sub-seconds ignored."""
    return F.pmod(epoch_seconds(ts), F.lit(int(step.total_seconds()))) == 0
