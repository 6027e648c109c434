"""CSV series, the published wide extract, and the table of evaluation runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourloom.functions.values import comma_numeric, strict_numeric
from hourloom.schemas import PUBLISHED, RUN_METRICS, RUNS, SERIES

CSV_TIMESTAMP = "yyyy-MM-dd HH:mm:ss"


def write_series_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("timestampNTZFormat", CSV_TIMESTAMP).csv(path)


def read_series_csv(spark: SparkSession, path: str, schema: T.StructType = SERIES) -> DataFrame:
    """CSV with a header and a fixed schema; a value that does not fit is an error."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("timestampNTZFormat", CSV_TIMESTAMP)
        .csv(path)
    )


def read_published_csv(spark: SparkSession, path: str) -> DataFrame:
    return normalize_published(spark.read.schema(PUBLISHED).option("header", True).csv(path))


def normalize_published(df: DataFrame) -> DataFrame:
    """The columns of the published extract that are used, with proper types.

    Times look like ``01JUL2015 05:00:00`` and numbers like ``1,234``.
    """
    return df.select(
        F.col("BA").alias("series_id"),
        F.to_timestamp_ntz(F.initcap(F.lower("UTC time")), F.lit("ddMMMyyyy HH:mm:ss")).alias("ts"),
        F.col("Time zone").alias("time_zone"),
        comma_numeric(F.col("DF")).alias("df"),
        comma_numeric(F.col("D")).alias("d"),
        comma_numeric(F.col("`Adjusted D`")).alias("adjusted_d"),
    )


def append_run(df: DataFrame, path: str) -> None:
    """Add evaluation runs to the run table, which keeps every parameter as text."""
    df.select(*[F.col(f.name).cast("string") for f in RUNS]).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The run table with its times and numbers cast back."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in RUNS])
    return spark.read.schema(text).parquet(path).select(
        "model_name",
        strict_numeric("model_version").cast("int").alias("model_version"),
        F.col("start_time").cast("timestamp_ntz").alias("start_time"),
        "feature_flags",
        *[strict_numeric(m).alias(m) for m in RUN_METRICS],
    )
