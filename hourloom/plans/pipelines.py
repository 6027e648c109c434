"""User-level pipelines: model input, refresh, train, register the baseline, compare."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.consts import (
    CV_SPLITS,
    EARLIEST_DATA_HOUR,
    GBT_PARAMS,
    HOUR,
    MAX_DEMAND,
    MIN_DEMAND,
    REPORTING_BUFFER_HOURS,
    TEST_SET_HOURS,
)
from hourloom.functions.time import compact_ts, ntz, plus_years, usable_until
from hourloom.functions.values import detected_feature_code
from hourloom.operators import boosting, evaluate
from hourloom.operators.chunks import hit_miss, index_bounds
from hourloom.operators.clean import clean
from hourloom.operators.features import (
    add_calendar_features,
    add_features,
    feature_columns,
    select_features,
)
from hourloom.operators.folds import holdout_split
from hourloom.operators.intervals import backfill_ranges
from hourloom.operators.lookup import lookup
from hourloom.operators.quality import assert_no_leak, model_input_suite, validate
from hourloom.operators.series import concat_series, time_bounds
from hourloom.schemas import FeatureFlags
from hourloom.sources.files import append_run, read_runs
from hourloom.sources.models import (
    ModelSpec,
    SavedModel,
    find_model,
    load_model,
    predictions_of,
    register_model,
    save_model,
)
from hourloom.sources.store import (
    fetch_range,
    read_chunk_index,
    read_ranges,
    staged,
    upsert_chunks,
)


class RedundantExtraction(RuntimeError):
    """Everything that was asked for is already stored."""


def requests_for(series: DataFrame, start, end) -> DataFrame:
    """The same (start, end) for every series_id of `series`."""
    def as_column(value):
        return ntz(value) if isinstance(value, datetime) else value

    return series.select("series_id").distinct().select(
        "series_id", as_column(start).alias("start_ts"), as_column(end).alias("end_ts")
    )


def refresh_requests(
    series: DataFrame,
    now: datetime,
    start: datetime | None = None,
    end: datetime | None = None,
    buffer_hours: int = REPORTING_BUFFER_HOURS,
) -> DataFrame:
    """What a refresh asks for: by default everything up to the newest usable hour."""
    return requests_for(
        series, start or EARLIEST_DATA_HOUR, end or usable_until(ntz(now), buffer_hours)
    )


def training_window(
    bounds: DataFrame,
    now: datetime,
    earliest: datetime = EARLIEST_DATA_HOUR,
    history_years: int = 3,
    buffer_hours: int = REPORTING_BUFFER_HOURS,
    test_hours: int = TEST_SET_HOURS,
) -> DataFrame:
    """Default training range of each stored series.

    It starts late enough to have `history_years` of lags and leaves the reporting
    buffer and one evaluation window untouched at the end.
    """
    newest = usable_until(ntz(now), buffer_hours) - F.lit(timedelta(hours=test_hours))
    return bounds.select(
        "series_id",
        plus_years(ntz(earliest), history_years).alias("start_ts"),
        F.least("end_ts", newest).alias("end_ts"),
    )


def eval_window(
    now: datetime, buffer_hours: int = REPORTING_BUFFER_HOURS, test_hours: int = TEST_SET_HOURS
):
    """(start, end) columns of the evaluation window that `now` allows."""
    end = usable_until(ntz(now), buffer_hours)
    return end - F.lit(timedelta(hours=test_hours)), end


def training_params(df: DataFrame) -> DataFrame:
    """Start and end of the training rows in compact form."""
    return time_bounds(df).select(
        "series_id",
        compact_ts("start_ts").alias("train_start"),
        compact_ts("end_ts").alias("train_end"),
    )


def with_backfill(spark: SparkSession, df: DataFrame, store: str, step: timedelta = HOUR) -> DataFrame:
    """Prefix each series with the stored history its lag features need; `df` is read twice."""
    ranges = staged(backfill_ranges(time_bounds(df)), "backfill")
    span = ranges.agg(F.min("start_ts").alias("low"), F.max("end_ts").alias("high")).first()
    if span.low is None:
        return df
    history = read_ranges(spark, store, ranges, step, span.low, span.high)
    return concat_series([history, df])


def model_input(
    spark: SparkSession,
    store: str,
    raw: DataFrame,
    requests: DataFrame,
    holidays: DataFrame,
    step: timedelta = HOUR,
    low: float = MIN_DEMAND,
    high: float = MAX_DEMAND,
    on_fail: str | None = "warn",
) -> DataFrame:
    """Fetch, back-fill, clean, add features, strip the history again and validate.

    ``on_fail=None`` leaves the validation out and the frame lazy.
    """
    base = staged(fetch_range(spark, store, raw, requests, step), "model-base")
    # Cleaning reads its input more than once.
    whole = staged(with_backfill(spark, base, store, step), "model-history")
    featured = add_features(clean(whole, low, high), holidays)
    starts = requests.select("series_id", F.col("start_ts").alias("_from"))
    frame = (
        lookup(featured, starts, ["series_id"], how="inner")
        .filter(F.col("ts") >= F.col("_from"))
        .drop("_from")
    )
    if on_fail is None:
        return frame
    frame = staged(frame, "model-input")
    validate(frame, "model_input", model_input_suite(step, low, high), on_fail)
    return frame


def refresh(
    spark: SparkSession,
    raw: DataFrame,
    store: str,
    requests: DataFrame,
    step: timedelta = HOUR,
    on_fail: str = "warn",
    close_gap: bool = False,
) -> DataFrame:
    """Fetch what the store lacks of the requested ranges and merge it in.

    Returns the applied chunk diff; raises RedundantExtraction when nothing is missing.
    If the first missing steps are absent from the source as well, the new rows do not
    join the stored ones, which is an error unless `close_gap` fills them with nulls.
    """
    split = hit_miss(read_chunk_index(spark, store), requests, step)
    misses = staged(
        split.filter("miss_start is not null").select(
            "series_id", F.col("miss_start").alias("start_ts"), F.col("miss_end").alias("end_ts")
        ),
        "misses",
    )
    if misses.isEmpty():
        raise RedundantExtraction("the requested ranges are already stored")
    rows = fetch_range(spark, store, raw, misses, step, use_store=False, close_gap=close_gap)
    return upsert_chunks(rows, store, step, on_fail=on_fail)


def fit_baseline(
    df: DataFrame,
    path: str,
    step: timedelta = HOUR,
    test_rows: int = TEST_SET_HOURS,
    low: float = MIN_DEMAND,
    high: float = MAX_DEMAND,
) -> DataFrame:
    """Clean, hold out the last `test_rows` steps, fit the baseline, save and reload it."""
    frame = add_calendar_features(clean(df, low, high))
    train = holdout_split(frame, test_rows, step).filter("is_train")
    evaluate.fit_baseline(train).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def train(
    spark: SparkSession,
    store: str,
    raw: DataFrame,
    windows: DataFrame,
    holidays: DataFrame,
    model_path: str,
    flags: FeatureFlags = FeatureFlags(),
    candidates: Sequence[Mapping[str, float]] = (GBT_PARAMS,),
    n_splits: int = CV_SPLITS,
    test_size: int = TEST_SET_HOURS,
    step: timedelta = HOUR,
    low: float = MIN_DEMAND,
    high: float = MAX_DEMAND,
    encode: bool = True,
) -> tuple[SavedModel, DataFrame]:
    """Train on stored data only: cross-validate, refit the best and save the model with its training parameters.

    With `encode` the trees know the series by the mean and deviation of its training rows. The cross-validation table
    goes next to the model, to ``<model_path>-cv``. Returns the reloaded model and that table.
    """
    beyond = hit_miss(read_chunk_index(spark, store), windows, step).filter("miss_start is not null")
    if not beyond.isEmpty():
        raise ValueError("training data must be stored; refresh the store first")
    frame = model_input(spark, store, raw, windows, holidays, step, low, high)
    columns = select_features(frame, flags)
    features = feature_columns(flags)
    model, results = boosting.grid_search(columns, features, candidates, n_splits, test_size, step, encode=encode)
    results.write.mode("overwrite").parquet(f"{model_path}-cv")
    results = spark.read.parquet(f"{model_path}-cv")
    best = evaluate.best_params(results.withColumn("_all", F.lit("all")), "_all").first().param_set
    series = boosting.series_encoding(columns) if encode else None
    save_model(model, model_path, features, training_params(frame), {"param_set": best}, series=series)
    return load_model(spark, model_path), results


def register_trained(spark: SparkSession, registry: str, name: str, saved: SavedModel) -> ModelSpec:
    """Give a trained model a name and the next version of it in the registry."""
    return register_model(spark, registry, name, saved.model, saved.input_columns, saved.training, saved.params, saved.series)


def register_baseline(
    frame: DataFrame, registry: str, name: str, by: Sequence[str] = ("hour", "month")
) -> ModelSpec:
    """Fit the baseline of the calendar columns `by` on a model input frame and register it."""
    spark = frame.sparkSession
    return register_model(spark, registry, name, evaluate.fit_baseline(frame, by), by, training_params(frame))


def refresh_and_train(
    spark: SparkSession,
    raw: DataFrame,
    store: str,
    requests: DataFrame,
    close_gap: bool = False,
    **options,
):
    """Make sure the data is stored, then train on it.

    Where the source has nothing up to the requested end, training stops at the stored end.
    """
    step = options.get("step", HOUR)
    try:
        refresh(spark, raw, store, requests, step, close_gap=close_gap)
    except RedundantExtraction:
        pass
    stored = stored_bounds(spark, store).select("series_id", F.col("end_ts").alias("_stored_end"))
    windows = requests.join(stored, "series_id").select(
        "series_id", "start_ts", F.least("end_ts", "_stored_end").alias("end_ts")
    )
    return train(spark, store, raw, windows, **options)


def evaluate_models(
    predictions: DataFrame, train_ends: DataFrame, runs_path: str, now: datetime, starts: DataFrame | None = None
) -> DataFrame:
    """Score the predictions of one or more models, append the runs and return them.

    `predictions` holds (model_name, model_version, input_columns, series_id, ts, d,
    pred) of every model, so that all of them are scored by one aggregation.
    `train_ends` holds the last training ts per series; it may not lie behind the
    first evaluated one, which `starts` has or the predictions show.
    """
    starts = predictions.groupBy("series_id").agg(F.min("ts").alias("ts")) if starts is None else starts
    assert_no_leak(train_ends, starts)
    key = ("model_name", "model_version", "feature_flags")
    scored = evaluate.regression_metrics(
        predictions.withColumn("feature_flags", detected_feature_code("input_columns")), by=key
    )
    runs = staged(evaluate.run_rows(scored, ntz(now)), "runs")
    append_run(runs, runs_path)
    return runs


def eval_frame(
    spark: SparkSession,
    store: str,
    raw: DataFrame,
    holidays: DataFrame,
    now: datetime,
    step: timedelta = HOUR,
    low: float = MIN_DEMAND,
    high: float = MAX_DEMAND,
    buffer_hours: int = REPORTING_BUFFER_HOURS,
    test_hours: int = TEST_SET_HOURS,
    on_fail: str | None = "warn",
) -> DataFrame:
    """Model input of every stored series for the newest evaluation window that `now` allows."""
    requests = requests_for(stored_bounds(spark, store), *eval_window(now, buffer_hours, test_hours))
    return model_input(spark, store, raw, requests, holidays, step, low, high, on_fail)


def evaluate_saved(
    spark: SparkSession, registry: str, specs: Sequence[ModelSpec], frame: DataFrame, runs_path: str, now: datetime
) -> DataFrame:
    """Load registered models, score them on one evaluation frame, append the runs and return them.

    Every model's stored training end must not lie behind the first evaluated step of a series that it was trained on;
    a model for which it does is refused before anything is scored or logged.
    """
    models = [find_model(spark, registry, spec) for spec in specs]
    starts = frame.groupBy("series_id").agg(F.min("ts").alias("ts"))
    ends = [
        m.train_ends().select(F.lit(f"{m.spec.name}/{m.spec.version}").alias("model"), "series_id", "ts") for m in models
    ]
    return evaluate_models(predictions_of(models, frame), reduce(DataFrame.unionByName, ends), runs_path, now, starts)


def compare_saved(
    spark: SparkSession,
    registry: str,
    eval_specs: Sequence[ModelSpec],
    runs_path: str,
    now: datetime,
    frame: DataFrame,
    plot_specs: Sequence[ModelSpec] | None = None,
) -> DataFrame:
    """Evaluate registered models on `frame`, then the metrics over time of `plot_specs`, by default of the same models."""
    evaluate_saved(spark, registry, eval_specs, frame, runs_path, now)
    chosen = [(s.name, s.version) for s in (eval_specs if plot_specs is None else plot_specs)]
    specs = spark.createDataFrame(chosen, "model_name string, model_version int")
    return evaluate.compare_runs(read_runs(spark, runs_path), specs)


def compare(
    spark: SparkSession,
    predictions: DataFrame,
    train_ends: DataFrame,
    runs_path: str,
    now: datetime,
    specs: DataFrame | None = None,
) -> DataFrame:
    """Evaluate models, then compare the chosen ones (all evaluated ones by default) over time."""
    runs = evaluate_models(predictions, train_ends, runs_path, now)
    return evaluate.compare_runs(read_runs(spark, runs_path), runs if specs is None else specs)


def stored_bounds(spark: SparkSession, store: str) -> DataFrame:
    return index_bounds(read_chunk_index(spark, store))
