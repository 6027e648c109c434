"""The US national holiday dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.schemas import HOLIDAY_PAGE, HOLIDAYS

# Names, calendar rules and years of the holidays.
FIRST_YEAR, LAST_YEAR = 2018, 2039
# name, month, day, first year; with a substitute when it falls on a weekend
FIXED_DATE = (
    ("New Year's Day", 1, 1, 2018),
    ("Juneteenth", 6, 19, 2021),
    ("Independence Day", 7, 4, 2018),
    ("Veterans Day", 11, 11, 2018),
    ("Christmas Day", 12, 25, 2018),
)
# name, month, weekday (Monday = 0), first and last possible day of the month
FLOATING = (
    ("Martin Luther King Jr. Day", 1, 0, 15, 21),
    ("Presidents' Day", 2, 0, 15, 21),
    ("Memorial Day", 5, 0, 25, 31),
    ("Labor Day", 9, 0, 1, 7),
    ("Columbus Day", 10, 0, 8, 14),
    ("Thanksgiving Day", 11, 3, 22, 28),
)
CHRISTMAS_EVE_YEARS = (2018, 2019, 2020)
INAUGURATION = "Inauguration Day"
CHRISTMAS_EVE = "Christmas Eve"
SATURDAY, SUNDAY, MONDAY, FRIDAY = 5, 6, 0, 4


def us_holidays(spark: SparkSession, first: int = FIRST_YEAR, last: int = LAST_YEAR) -> DataFrame:
    """(holiday_date, name) of the given years, from calendar rules.

    A date with two holidays has two rows.
    """
    day = F.col("holiday_date")
    weekday = F.weekday(day)

    def falls_on(d: Column, month: int, dom: int) -> Column:
        return (F.month(d) == month) & (F.dayofmonth(d) == dom)

    rules = []
    for name, month, dom, since in FIXED_DATE:
        rules.append((name, falls_on(day, month, dom) & (F.year(day) >= since)))
        saturday_next, sunday_before = F.date_add(day, 1), F.date_sub(day, 1)
        substitute = (
            (weekday == FRIDAY) & falls_on(saturday_next, month, dom) & (F.year(saturday_next) >= since)
        ) | ((weekday == MONDAY) & falls_on(sunday_before, month, dom) & (F.year(sunday_before) >= since))
        rules.append((f"{name} (substitute)", substitute))
    for name, month, on, low, high in FLOATING:
        rules.append(
            (name, (F.month(day) == month) & (weekday == on) & F.dayofmonth(day).between(low, high))
        )
    swears_in = (falls_on(day, 1, 20) & (weekday != SUNDAY)) | (falls_on(day, 1, 21) & (weekday == MONDAY))
    rules.append((INAUGURATION, swears_in & (F.year(day) % 4 == 1)))
    rules.append((CHRISTMAS_EVE, falls_on(day, 12, 24) & F.year(day).isin(*CHRISTMAS_EVE_YEARS)))

    days = spark.range(0, 1, 1, 1).select(
        F.explode(
            F.sequence(F.make_date(F.lit(first), F.lit(1), F.lit(1)), F.make_date(F.lit(last), F.lit(12), F.lit(31)))
        ).alias("holiday_date")
    )
    names = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules]))
    return days.select("holiday_date", F.explode(names).alias("name"))


def holidays_between(spark: SparkSession, first: int, last: int) -> DataFrame:
    """The dimension of the given years from 2018 on; the calendar rules go on after 2039."""
    return us_holidays(spark, max(first, FIRST_YEAR), last)


def load_holidays(spark: SparkSession, path: str) -> DataFrame:
    """CSV of (date, name)."""
    return spark.read.schema(HOLIDAYS).option("header", True).option("mode", "FAILFAST").csv(path)


def holidays_from_json(pages: DataFrame, body: str = "body") -> DataFrame:
    """Yearly JSON answers, one per row, to one holiday table."""
    return (
        pages.select(F.explode(F.from_json(body, HOLIDAY_PAGE)["response"]["holidays"]).alias("h"))
        .select(F.to_date(F.substring("h.date.iso", 1, 10)).alias("holiday_date"), F.col("h.name").alias("name"))
    )
