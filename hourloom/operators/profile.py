"""Reports that describe a series: moments, quantiles, histogram, null maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourloom.consts import HISTOGRAM_BINS, MAX_DEMAND, MIN_DEMAND
from hourloom.functions.values import capped, same_or_both_null
from hourloom.operators.clean import month_hour_means
from hourloom.operators.lookup import lookup


def outlier_report(
    df: DataFrame, col: str = "d", low: float = MIN_DEMAND, high: float = MAX_DEMAND
) -> DataFrame:
    """How many values lie below and above the caps, and their extremes."""
    value = F.col(col)
    return df.groupBy("series_id").agg(
        F.count_if(value < low).alias("n_below"),
        F.count_if(value > high).alias("n_above"),
        F.min(F.when(value < low, value)).alias("lowest"),
        F.max(F.when(value > high, value)).alias("highest"),
    )


def outliers(
    df: DataFrame, col: str = "d", low: float = MIN_DEMAND, high: float = MAX_DEMAND
) -> DataFrame:
    """The rows outside the caps."""
    value = F.col(col)
    side = F.when(value > high, F.lit("above")).when(value < low, F.lit("below"))
    return df.withColumn("side", side).filter("side is not null")


def within(df: DataFrame, col: str, low: float, high: float) -> DataFrame:
    """Rows strictly between the caps."""
    return df.filter((F.col(col) > low) & (F.col(col) < high))


def skew_report(
    df: DataFrame, col: str = "d", low: float = MIN_DEMAND, high: float = MAX_DEMAND
) -> DataFrame:
    """Population skewness before and after capping, in one pass."""
    return df.groupBy("series_id").agg(
        F.skewness(col).alias("skew_before"), F.skewness(capped(col, low, high)).alias("skew_after")
    )


def exact_quantiles(df: DataFrame, probs: Sequence[float], col: str = "d") -> DataFrame:
    """Exact quantiles with linear interpolation, as columns q0, q1, ... per series.

    Values are counted in ever finer slots: powers of two cut in 64, then 4096 equal parts of the slots that
    hold a wanted rank. Only rows of such slots are shuffled by value, equal values as one row, and only the
    values of a wanted part are put in order. No series is held by one task. Nulls do not count; infinite
    values do, and NaN is the largest of all.
    """
    valued = df.filter(F.col(col).isNotNull()).select("series_id", F.col(col).cast("double").alias("_v"))
    magnitude = F.floor(F.log2(F.abs("_v")) * 64)
    offset = 1_000_000  # keeps slots of values below 1 on their side of zero
    slotted = valued.withColumn(
        "_slot",
        F.when(F.isnan("_v"), F.lit(3 * offset))
        .when(F.abs("_v") == float("inf"), F.signum("_v").cast("int") * 2 * offset)
        .when(F.col("_v") > 0, magnitude + offset)
        .when(F.col("_v") < 0, -(magnitude + offset))
        .otherwise(F.lit(0)),
    )

    def before(*by: str):
        earlier = Window.partitionBy(*by[:-1]).orderBy(by[-1])
        counted = F.sum("_n").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
        return F.coalesce(counted, F.lit(0))

    slots = (
        slotted.groupBy("series_id", "_slot")
        .agg(F.count("*").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        .withColumn("_start", before("series_id", "_slot"))
        .withColumn("_total", F.sum("_n").over(Window.partitionBy("series_id")))
    )
    # Two ranks per quantile with their weights in the result.
    ranks, in_slot = [], F.lit(False)
    for i, p in enumerate(probs):
        at = F.lit(float(p)) * (F.col("_total") - 1)
        lower = F.floor(at).cast("bigint")
        upper = F.least(lower + 1, F.col("_total") - 1)
        in_slot = in_slot | ((upper >= F.col("_start")) & (lower < F.col("_start") + F.col("_n")))
        for rank, weight in ((lower, 1 - (at - lower)), (upper, at - lower)):
            ranks.append(F.struct(F.lit(i).alias("i"), rank.alias("rank"), weight.alias("weight")))
    held = "filter({0}, r -> r.weight > 0 and r.rank >= _start and r.rank < _start + _n)"
    targets = (
        slots.filter(in_slot)
        .withColumn("_ranks", F.array(*ranks))
        .withColumn("_ranks", F.expr(held.format("_ranks")))
        .filter(F.size("_ranks") > 0)
        .select("series_id", "_slot", "_low", "_high", "_start", "_ranks")
    )
    spread = (F.col("_v") - F.col("_low")) / (F.col("_high") - F.col("_low"))
    part = F.when(F.col("_high") > F.col("_low"), F.floor(spread * 4096)).otherwise(F.lit(0))
    fine = (
        lookup(slotted, targets, ["series_id", "_slot"], how="inner")
        .groupBy("series_id", "_slot", part.alias("_part"), "_v")
        .agg(F.count("*").alias("_n"), F.first("_start").alias("_base"), F.first("_ranks").alias("_ranks"))
    )
    parts = (
        fine.groupBy("series_id", "_slot", "_part")
        .agg(
            F.sum("_n").alias("_n"),
            F.first("_base").alias("_base"),
            F.first("_ranks").alias("_ranks"),
        )
        .withColumn("_start", F.col("_base") + before("series_id", "_slot", "_part"))
        .withColumn("_wanted", F.expr(held.format("_ranks")))
        .filter(F.size("_wanted") > 0)
        .select("series_id", "_slot", "_part", F.col("_start").alias("_from"), "_wanted")
    )
    in_part = Window.partitionBy("series_id", "_slot", "_part").orderBy("_v")
    found = (
        fine.select("series_id", "_slot", "_part", "_v", "_n")
        .join(parts, ["series_id", "_slot", "_part"])
        .withColumn("_start", F.col("_from") + F.sum("_n").over(in_part) - F.col("_n"))
        .withColumn("_rank", F.explode(F.expr(held.format("_wanted"))))
    )
    weighted = F.col("_v") * F.col("_rank.weight")
    return found.groupBy("series_id").agg(
        *[F.sum(F.when(F.col("_rank.i") == i, weighted)).alias(f"q{i}") for i in range(len(probs))]
    )


def profile(df: DataFrame, col: str = "d", approximate: bool = False) -> DataFrame:
    """Median, mean and skewness per series; `approximate` takes the median from a sketch."""
    moments = [F.avg(col).alias("mean_d"), F.skewness(col).alias("skew_d")]
    if approximate:
        return df.groupBy("series_id").agg(F.percentile_approx(col, 0.5).alias("median_d"), *moments)
    median = exact_quantiles(df, [0.5], col).withColumnRenamed("q0", "median_d")
    return df.groupBy("series_id").agg(*moments).join(median, "series_id", "left")


def describe_series(df: DataFrame, col: str = "d") -> DataFrame:
    """Count, mean, sample standard deviation, min, quartiles and max per series."""
    quartiles = exact_quantiles(df, [0.25, 0.5, 0.75], col)
    basics = df.groupBy("series_id").agg(
        F.count(col).alias("n"),
        F.avg(col).alias("mean_d"),
        F.stddev_samp(col).alias("std_d"),
        F.min(col).alias("min_d"),
        F.max(col).alias("max_d"),
    )
    return basics.join(quartiles, "series_id", "left").select(
        "series_id",
        "n",
        "mean_d",
        "std_d",
        "min_d",
        F.col("q0").alias("p25"),
        F.col("q1").alias("p50"),
        F.col("q2").alias("p75"),
        "max_d",
    )


def table_summary(df: DataFrame) -> DataFrame:
    """Column name, type and non-null count of every column."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f.name).alias("non_null"),
        )
        for f in df.schema
    ]
    return counts.select(F.inline(F.array(*rows)))


def histogram(df: DataFrame, bins: int = HISTOGRAM_BINS, col: str = "d") -> DataFrame:
    """Equal-width bins between the minimum and maximum of each series; the last is closed."""
    valued = df.filter(F.col(col).isNotNull())
    bounds = valued.groupBy("series_id").agg(
        F.min(col).alias("low"), F.max(col).alias("high")
    )
    width = (F.col("high") - F.col("low")) / bins
    bin_no = F.when(F.col("high") == F.col("low"), F.lit(1)).otherwise(
        F.least(F.floor((F.col(col) - F.col("low")) / width) + 1, F.lit(bins))
    )
    return (
        lookup(valued.select("series_id", "ts", col), bounds, ["series_id"])
        .groupBy("series_id", "low", "high", bin_no.cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
        .select(
            "series_id",
            "bin",
            (F.col("low") + (F.col("bin") - 1) * width).alias("bin_start"),
            (F.col("low") + F.col("bin") * width).alias("bin_end"),
            "n",
        )
    )


def null_map(df: DataFrame, col: str = "d") -> DataFrame:
    """Null count by series, year and day of the year."""
    return (
        df.filter(F.col(col).isNull())
        .groupBy("series_id", F.year("ts").alias("year"), F.dayofyear("ts").alias("dayofyear"))
        .agg(F.count("*").alias("n_null"))
    )


def null_pattern(df: DataFrame, a: str = "d", b: str = "df") -> DataFrame:
    """Rows with both, neither or just one of two columns null; the four add up to all rows."""
    a_null, b_null = F.col(a).isNull(), F.col(b).isNull()
    return df.groupBy("series_id").agg(
        F.count("*").alias("n_rows"),
        F.count_if(a_null & b_null).alias("both_null"),
        F.count_if(~a_null & ~b_null).alias("neither_null"),
        F.count_if(a_null & ~b_null).alias(f"only_{a}_null"),
        F.count_if(~a_null & b_null).alias(f"only_{b}_null"),
    )


def null_counts(df: DataFrame, col: str = "d") -> DataFrame:
    return df.groupBy("series_id").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col(col).isNull()).alias("n_null")
    )


def hour_profile(df: DataFrame, col: str = "d") -> DataFrame:
    """Mean by hour of the day within each month."""
    return month_hour_means(df, col)


def list_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose key occurs more than once."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("n_copies")).filter("n_copies > 1")
    return lookup(df, repeated, keys, how="inner")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def reconcile(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of two sources (series_id, ts, d) that share a ts but not the value.

    Two nulls count as the same value.
    """
    other = b.select("series_id", "ts", F.col("d").alias("other_d"))
    return (
        a.join(other, ["series_id", "ts"])
        .filter(~same_or_both_null("d", "other_d"))
        .select("series_id", "ts", "d", "other_d")
    )


def reconcile_counts(a: DataFrame, b: DataFrame, adjusted: str = "adjusted_d") -> DataFrame:
    """Per series: shared rows, differing rows, null raw values, and nulls left unadjusted."""
    other = b.select("series_id", "ts", F.col("d").alias("_other"))
    raw_null = F.col("_other").isNull()
    return (
        a.join(other, ["series_id", "ts"])
        .groupBy("series_id")
        .agg(
            F.count("*").alias("n_shared"),
            F.count_if(~same_or_both_null("d", "_other")).alias("n_different"),
            F.count_if(raw_null).alias("n_null_raw"),
            F.count_if(raw_null & F.col(adjusted).isNull()).alias("n_not_adjusted"),
        )
    )
