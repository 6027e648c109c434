"""Declarative data checks.

A suite is one aggregation over the frame. Checking uniqueness groups by the key
first, which costs the one shuffle that it needs; all other counts ride along.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourloom.consts import (
    HOLIDAY_FEATURES,
    HOUR,
    LAG_FEATURES,
    MAX_DEMAND,
    MIN_DEMAND,
    TIME_FEATURES,
)
from hourloom.functions.time import on_step


log = logging.getLogger(__name__)


class ValidationFailed(ValueError):
    pass


class LeakError(ValueError):
    pass


@dataclass(frozen=True)
class Expectation:
    """A check on one column.

    `unexpected` maps the column to a boolean; rows where it is true count against
    the check. Nulls are left out of the count unless `count_nulls`. Schema checks
    have `schema_test` instead, uniqueness has `unique_on`.
    """

    name: str
    column: str
    mostly: float = 1.0
    unexpected: Callable[[Column], Column] | None = None
    count_nulls: bool = False
    schema_test: Callable[[Sequence[str]], bool] | None = None
    unique_on: tuple[str, ...] = field(default=())


def expect_column(column: str) -> Expectation:
    return Expectation("column_exists", column, schema_test=lambda have: column in have)


def expect_columns_exactly(columns: Sequence[str]) -> Expectation:
    wanted = set(columns)
    return Expectation("columns_match_set", "*", schema_test=lambda have: set(have) == wanted)


def expect_not_null(column: str, mostly: float = 1.0) -> Expectation:
    return Expectation("not_null", column, mostly, lambda c: c.isNull(), count_nulls=True)


def expect_between(column: str, low: float, high: float, mostly: float = 1.0) -> Expectation:
    return Expectation("between", column, mostly, lambda c: ~c.between(low, high))


def expect_in_set(column: str, values: Sequence, mostly: float = 1.0) -> Expectation:
    return Expectation("in_set", column, mostly, lambda c: ~c.isin(*values))


def expect_on_step(column: str, step: timedelta = HOUR, mostly: float = 1.0) -> Expectation:
    return Expectation("on_step", column, mostly, lambda c: ~on_step(c, step))


def expect_unique(column: str, within: Sequence[str] = ("series_id",)) -> Expectation:
    """Unique inside each series; every member of a repeated group counts as unexpected."""
    return Expectation("unique", column, unique_on=(*within, column))


def warehouse_suite(step: timedelta = HOUR) -> list[Expectation]:
    return [expect_column("d"), expect_not_null("d", mostly=0.9), expect_on_step("ts", step)]


def model_input_suite(
    step: timedelta = HOUR, low: float = MIN_DEMAND, high: float = MAX_DEMAND
) -> list[Expectation]:
    """Checks on the feature frame; the weather group is not part of it."""
    columns = ["series_id", "ts", *TIME_FEATURES, *LAG_FEATURES, *HOLIDAY_FEATURES, "d"]
    return [
        expect_columns_exactly(columns),
        expect_not_null("d"),
        expect_between("d", low, high),
        expect_unique("ts"),
        expect_in_set("is_holiday", (0, 1)),
        expect_on_step("ts", step),
    ]


REPORT = T.StructType(
    [
        T.StructField("suite", T.StringType()),
        T.StructField("expectation", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("n_unexpected", T.LongType()),
        T.StructField("unexpected_pct", T.DoubleType()),
        T.StructField("success", T.BooleanType()),
    ]
)


def report(df: DataFrame, suite: str, expectations: Sequence[Expectation]) -> DataFrame:
    """One result row per expectation.

    All counts come from one pass and one shuffle: rows are grouped by the columns of a unique check, or, if the suite has
    unique checks on several keys, by grouping sets over all of them; other checks count the groups of the first key.
    """
    checks = [e for e in expectations if e.schema_test is None and e.column in df.columns]
    keys = list(dict.fromkeys(tuple(sorted(set(e.unique_on))) for e in checks if e.unique_on))

    firsts = [F.count("*").alias("_n")]
    for i, e in enumerate(checks):
        if e.unexpected is not None:
            column = F.col(e.column)
            counted = F.lit(True) if e.count_nulls else column.isNotNull()
            firsts.append(F.count_if(counted).alias(f"_n{i}"))
            firsts.append(F.count_if(counted & e.unexpected(column)).alias(f"_u{i}"))
    if len(keys) > 1:
        columns = sorted({c for key in keys for c in key})
        first = df.groupingSets([[F.col(c) for c in key] for key in keys], *columns).agg(
            F.grouping_id().alias("_set"), *firsts
        )
        # The bits of grouping_id are the columns that a set leaves out, the last column lowest.
        sets = [sum(1 << k for k, c in enumerate(reversed(columns)) if c not in key) for key in keys]
    else:
        first = df.groupBy(*next(iter(keys), ())).agg(F.lit(0).alias("_set"), *firsts)
        sets = [0]

    def own(number: int, value: Column) -> Column:
        return F.when(F.col("_set") == number, value)

    totals = [F.coalesce(F.sum(own(sets[0], F.col("_n"))), F.lit(0)).alias("_n")]
    for i, e in enumerate(checks):
        if e.unique_on:
            group = own(sets[keys.index(tuple(sorted(set(e.unique_on))))], F.col("_n"))
            present = F.col(e.column).isNotNull()
            n = F.sum(F.when(present, group))
            u = F.sum(F.when(present & (F.col("_n") > 1), group))
        else:
            n, u = F.sum(own(sets[0], F.col(f"_n{i}"))), F.sum(own(sets[0], F.col(f"_u{i}")))
        totals.append(F.coalesce(n, F.lit(0)).alias(f"_n{i}"))
        totals.append(F.coalesce(u, F.lit(0)).alias(f"_u{i}"))
    total = first.agg(*totals)

    rows = []
    for e in expectations:
        if e in checks:
            i = checks.index(e)
            n, u = F.col(f"_n{i}"), F.col(f"_u{i}")
            pct = F.when(n > 0, u * 100.0 / n)
            passed = (n == 0) | ((n - u) >= F.lit(e.mostly) * n)
        else:
            # A schema test, or a check on a column that is not there.
            n, u, pct = F.lit(None), F.lit(None), F.lit(None)
            passed = F.lit(bool(e.schema_test and e.schema_test(df.columns)))
        values = (F.lit(suite), F.lit(e.name), F.lit(e.column), n, u, pct, passed)
        rows.append(
            F.struct(*[v.cast(f.dataType).alias(f.name) for v, f in zip(values, REPORT, strict=True)])
        )
    return total.select(F.inline(F.array(*rows)))


def validate(
    df: DataFrame, suite: str, expectations: Sequence[Expectation], on_fail: str = "report"
) -> DataFrame:
    """The report of a suite; it is lazy unless failures are to be acted on.

    ``on_fail='warn'`` logs failed expectations, ``'raise'`` turns them into an error.
    """
    if on_fail not in ("report", "warn", "raise"):
        raise ValueError(f"on_fail must be report, warn or raise, not {on_fail}")
    result = report(df, suite, expectations)
    if on_fail != "report":
        failed = [row.asDict() for row in result.filter("not success").collect()]
        if failed and on_fail == "raise":
            raise ValidationFailed(f"{suite}: {failed}")
        for row in failed:
            log.warning("validation failure: %s", row)
    return result


def assert_full_index(checked: DataFrame) -> None:
    """Raise if any row of a full_index_check result is not full."""
    bad = checked.filter("not full_index").take(5)
    if bad:
        raise ValidationFailed(f"series with missing or repeated steps: {[r.asDict() for r in bad]}")


def assert_no_leak(train_end: DataFrame, eval_start: DataFrame) -> None:
    """Training must end at or before the evaluation start, series by series.

    Both frames carry (series_id, ts).
    """
    leaks = (
        train_end.alias("t")
        .join(eval_start.alias("e"), "series_id")
        .filter(F.col("t.ts") > F.col("e.ts"))
        .take(1)
    )
    if leaks:
        raise LeakError(f"training data reaches into the evaluation window: {leaks[0].asDict()}")
