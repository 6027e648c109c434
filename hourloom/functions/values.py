"""Value expressions: casts, capping, null tests, feature codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourloom.consts import HOLIDAY_FEATURES, LAG_FEATURES, WEATHER_FEATURES


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def tolerant_numeric(text: Column | str) -> Column:
    return nan_to_null(_col(text).try_cast("double"))


def strict_numeric(text: Column | str) -> Column:
    """Double, or an error on text that is not a number, whatever the ANSI setting."""
    text = _col(text)
    value = text.try_cast("double")
    bad = text.isNotNull() & value.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit("not a number: "), text))).otherwise(
        nan_to_null(value)
    )


def comma_numeric(text: Column | str) -> Column:
    """``1,234`` as a double; blank text is null."""
    return strict_numeric(F.nullif(F.replace(_col(text), F.lit(","), F.lit("")), F.lit("")))


def capped(value: Column | str, low: float, high: float) -> Column:
    """Clip to [low, high]; null stays null (greatest/least would skip it)."""
    value = _col(value)
    return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)


def same_or_both_null(a: Column | str, b: Column | str) -> Column:
    return _col(a).eqNullSafe(_col(b))


def contains_all(columns: Column | str, names: Sequence[str]) -> Column:
    """True when the array column holds every name."""
    wanted = F.array(*[F.lit(n) for n in names])
    return F.size(F.array_except(wanted, _col(columns))) == 0


def feature_code(lag: Column, weather: Column, holidays: Column) -> Column:
    """``fB`` plus L, W, H for each group present and ``_`` for each one absent."""

    def mark(flag: Column, letter: str) -> Column:
        return F.when(flag, F.lit(letter)).otherwise(F.lit("_"))

    return F.concat(F.lit("fB"), mark(lag, "L"), mark(weather, "W"), mark(holidays, "H"))


def detected_feature_code(input_columns: Column | str) -> Column:
    """Feature code of a model from the array of its input column names."""
    return feature_code(
        contains_all(input_columns, LAG_FEATURES),
        contains_all(input_columns, WEATHER_FEATURES),
        contains_all(input_columns, HOLIDAY_FEATURES),
    )
