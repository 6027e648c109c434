"""Fixed schemas of the data model and the schema check."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

SERIES = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("d", T.DoubleType()),
    ]
)

STORED_SERIES = T.StructType(
    SERIES.fields + [T.StructField("year", T.IntegerType()), T.StructField("quarter", T.IntegerType())]
)

RAW_RECORD = T.StructType(
    [
        T.StructField("period", T.StringType()),
        T.StructField("respondent", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

RAW_PAGE = T.StructType(
    [
        T.StructField(
            "response",
            T.StructType(
                [
                    T.StructField("total", T.StringType()),
                    T.StructField("data", T.ArrayType(RAW_RECORD)),
                ]
            ),
        )
    ]
)

CHUNK_INDEX = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("quarter", T.IntegerType()),
        T.StructField("start_ts", T.TimestampNTZType()),
        T.StructField("end_ts", T.TimestampNTZType()),
        T.StructField("data_start_ts", T.TimestampNTZType()),
        T.StructField("data_end_ts", T.TimestampNTZType()),
        T.StructField("name", T.StringType()),
        T.StructField("complete", T.BooleanType()),
    ]
)

HOLIDAYS = T.StructType(
    [T.StructField("holiday_date", T.DateType()), T.StructField("name", T.StringType())]
)

HOLIDAY_PAGE = T.StructType(
    [
        T.StructField(
            "response",
            T.StructType(
                [
                    T.StructField(
                        "holidays",
                        T.ArrayType(
                            T.StructType(
                                [
                                    T.StructField("name", T.StringType()),
                                    T.StructField(
                                        "date", T.StructType([T.StructField("iso", T.StringType())])
                                    ),
                                ]
                            )
                        ),
                    )
                ]
            ),
        )
    ]
)

PUBLISHED = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "BA",
            "UTC time",
            "Local date",
            "Hour",
            "Local time",
            "Time zone",
            "Generation only?",
            "DF",
            "D",
            "NG",
            "TI",
            "Imputed D",
            "Imputed NG",
            "Imputed TI",
            "Adjusted D",
            "Adjusted NG",
            "Adjusted TI",
        )
    ]
)

RUN_METRICS = (
    "r2_score",
    "root_mean_squared_error",
    "mean_squared_error",
    "mean_absolute_percentage_error",
)

RUNS = T.StructType(
    [
        T.StructField("model_name", T.StringType()),
        T.StructField("model_version", T.IntegerType()),
        T.StructField("start_time", T.TimestampNTZType()),
        T.StructField("feature_flags", T.StringType()),
    ]
    + [T.StructField(m, T.DoubleType()) for m in RUN_METRICS]
)


@dataclass(frozen=True)
class FeatureFlags:
    """Which feature groups a model takes besides the calendar features."""

    lag: bool = False
    weather: bool = False
    holidays: bool = False


class SchemaMismatch(ValueError):
    pass


def assert_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Raise unless `df` has exactly the columns and types of `schema` (in any order)."""
    have = {f.name: f.dataType for f in df.schema}
    want = {f.name: f.dataType for f in schema}
    if have != want:
        wrong = {
            name: (have.get(name), want.get(name))
            for name in have.keys() | want.keys()
            if have.get(name) != want.get(name)
        }
        raise SchemaMismatch(f"schema differs (have, want): {wrong}")
    return df.select(*[f.name for f in schema])
