"""Baseline model, regression metrics, cross-validation tables and run comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.consts import CV_SPLITS, HOUR, TEST_SET_HOURS
from hourloom.operators.folds import with_segment
from hourloom.operators.lookup import lookup
from hourloom.schemas import RUN_METRICS

#: Smallest |target| that the percentage error divides by (double epsilon).
MAPE_FLOOR = 2.220446049250313e-16

#: Baseline variants: the calendar columns whose group mean is the prediction.
BASELINE_VARIANTS: Mapping[str, tuple[str, ...]] = {
    "hour": ("hour",),
    "hour_month": ("hour", "month"),
    "hour_dayofweek": ("hour", "dayofweek"),
}


def fit_baseline(df: DataFrame, by: Sequence[str] = ("hour", "month")) -> DataFrame:
    """The baseline model: mean demand per series and calendar group, with the group's row count."""
    return df.groupBy("series_id", *by).agg(F.avg("d").alias("pred"), F.count("*").alias("n_rows"))


def predict_baseline(
    df: DataFrame, model: DataFrame, by: Sequence[str] = ("hour", "month"), strict: bool = False
) -> DataFrame:
    """Add ``pred``; with `strict` a row whose group the model has not seen is an error."""
    table = model.drop("n_rows").withColumn("_seen", F.lit(True))
    rows = lookup(df, table, ["series_id", *by])
    if strict:
        unseen = F.raise_error(F.lit("the baseline has no value for a calendar group"))
        rows = rows.withColumn("pred", F.when(F.col("_seen"), F.col("pred")).otherwise(unseen))
    return rows.drop("_seen")


def regression_metrics(
    df: DataFrame, by: Sequence[str] = ("series_id",), y: str = "d", pred: str = "pred"
) -> DataFrame:
    """Error measures per group in one aggregation; rows without target or prediction are left out.

    The total sum of squares is n times the population variance, which Spark merges
    in its numerically stable form, so no second pass over the rows is needed.
    """
    target, guess = F.col(y), F.col(pred)
    error = target - guess
    squared = error * error
    counted = df.filter(target.isNotNull() & guess.isNotNull())
    sums = counted.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.sum(squared).alias("_sse"),
        F.var_pop(target).alias("_var"),
        F.avg(F.abs(error)).alias("mean_absolute_error"),
        F.avg(F.abs(error) / F.greatest(F.abs(target), F.lit(MAPE_FLOOR))).alias(
            "mean_absolute_percentage_error"
        ),
        F.max(F.abs(error)).alias("max_error"),
        F.avg(target).alias("mean_on_target"),
        F.sum(target).alias("sum_on_target"),
    )
    mse = F.col("_sse") / F.col("n")
    # Undefined for a single row; for a constant target 1 if every guess is right, else 0.
    r2 = F.when(F.col("_var") > 0, 1 - mse / F.col("_var")).when(
        F.col("n") > 1, F.when(F.col("_sse") == 0, 1.0).otherwise(0.0)
    )
    return sums.select(
        *by,
        F.col("n").alias("example_count"),
        r2.alias("r2_score"),
        mse.alias("mean_squared_error"),
        F.sqrt(mse).alias("root_mean_squared_error"),
        "mean_absolute_error",
        "mean_absolute_percentage_error",
        "max_error",
        "mean_on_target",
        "sum_on_target",
    )


def fold_predictions(
    df: DataFrame,
    by: Sequence[str] = ("hour", "month"),
    n_splits: int = CV_SPLITS,
    test_size: int = TEST_SET_HOURS,
    step: timedelta | None = HOUR,
) -> DataFrame:
    """Baseline predictions for the test part of every fold.

    The rows are summed once per (group, segment); the model of fold i is then the
    running total over the segments below i, so rows are not copied into folds.
    """
    segmented = with_segment(df, n_splits, test_size, step)
    key = ["series_id", *by]
    sums = segmented.groupBy(*key, "segment").agg(F.sum("d").alias("sum"), F.count("d").alias("n"))
    # At most n_splits + 1 segments for every group, so the running totals fit into one row.
    packed = sums.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("segment", "sum", "n"))).alias("_s"))
    folds = packed.select(*key, "_s", F.explode(F.sequence(F.lit(1), F.lit(n_splits))).alias("segment"))
    total = "aggregate(filter(_s, x -> x.segment < segment and x.n > 0), {zero}, (a, x) -> a + x.{field})"
    models = folds.select(
        *key,
        "segment",
        (F.expr(total.format(zero="0D", field="sum")) / F.nullif(F.expr(total.format(zero="0L", field="n")), F.lit(0))).alias("pred"),
    )
    tests = segmented.filter("segment > 0")
    return lookup(tests, models, [*key, "segment"]).withColumnRenamed("segment", "fold")


def baseline_cv(
    df: DataFrame,
    by: Sequence[str] = ("hour", "month"),
    n_splits: int = CV_SPLITS,
    test_size: int = TEST_SET_HOURS,
    step: timedelta | None = HOUR,
) -> DataFrame:
    """Metrics of the baseline per series and fold; each fold scores its own test part."""
    return regression_metrics(
        fold_predictions(df, by, n_splits, test_size, step), by=("series_id", "fold")
    )


def fold_rmse(scores: DataFrame) -> DataFrame:
    """RMSE per fold next to the mean over the folds of the series."""
    rmse = F.col("root_mean_squared_error")
    own_folds = Window.partitionBy("series_id").orderBy("fold").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    return scores.select(
        "series_id", "fold", rmse.alias("rmse"), F.avg(rmse).over(own_folds).alias("mean_rmse")
    )


def baseline_variant_scores(
    df: DataFrame,
    variants: Mapping[str, Sequence[str]] = BASELINE_VARIANTS,
    n_splits: int = CV_SPLITS,
    test_size: int = TEST_SET_HOURS,
    step: timedelta | None = HOUR,
) -> DataFrame:
    """R² per series, baseline variant and fold."""
    parts = [
        baseline_cv(df, by, n_splits, test_size, step).select(
            "series_id", F.lit(name).alias("param_set"), "fold", F.col("r2_score").alias("score")
        )
        for name, by in variants.items()
    ]
    scores = parts[0]
    for part in parts[1:]:
        scores = scores.unionByName(part)
    return scores


def cv_results(scores: DataFrame, key: str = "series_id") -> DataFrame:
    """Mean and population deviation over the folds and the rank of each parameter set.

    Equal means share the lowest rank. The window sees one row per parameter set.
    """
    table = scores.groupBy(key, "param_set").agg(
        F.avg("score").alias("mean_score"), F.stddev_pop("score").alias("std_score")
    )
    best_first = Window.partitionBy(key).orderBy(F.desc_nulls_last("mean_score"))
    return table.withColumn("rank", F.rank().over(best_first))


def best_params(results: DataFrame, key: str = "series_id") -> DataFrame:
    """The first-ranked parameter set; ties go to the first name."""
    row = F.struct("rank", "param_set")
    return results.groupBy(key).agg(F.min(row)["param_set"].alias("param_set"))


def model_label(name: Column, version: Column, features: Column) -> Column:
    return F.concat_ws("-", name, F.concat(F.lit("v"), version.cast("string")), features)


def select_runs(runs: DataFrame, specs: DataFrame) -> DataFrame:
    """Runs of the given (model_name, model_version)."""
    key = ["model_name", "model_version"]
    return runs.join(specs.select(*key).distinct(), key, "left_semi")


def compare_runs(runs: DataFrame, specs: DataFrame) -> DataFrame:
    """Metrics over time of the chosen (model_name, model_version), one row per metric.

    The label carries the feature code of the model version's newest run.
    """
    key = ["model_name", "model_version"]
    chosen = select_runs(runs, specs)
    newest = chosen.groupBy(*key).agg(
        F.max_by("feature_flags", "start_time").alias("_code")
    )
    labelled = lookup(chosen, newest, key).withColumn(
        "label", model_label(F.col("model_name"), F.col("model_version"), F.col("_code"))
    )
    return labelled.unpivot(
        [*key, "label", "start_time"], list(RUN_METRICS), "metric", "metric_value"
    )


def run_rows(metrics: DataFrame, now: Column) -> DataFrame:
    """Metric rows with model_name, model_version and feature_flags as evaluation runs."""
    return metrics.select(
        "model_name",
        F.col("model_version").cast("int").alias("model_version"),
        now.alias("start_time"),
        "feature_flags",
        *RUN_METRICS,
    )
