"""Gradient-boosted trees on feature frames: fit, cross-validate, search, stop early."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import timedelta
from itertools import product

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from hourloom.consts import CV_SPLITS, GBT_EARLY_STOP, GBT_PARAMS, HOUR, TEST_SET_HOURS
from hourloom.operators.evaluate import best_params, cv_results
from hourloom.operators.folds import with_segment
from hourloom.operators.lookup import lookup

SERIES_FEATURES = ("series_mean", "series_dev")
ENCODING_FOLDS = 5
PATIENCE = 50  # trees without a better validation error


def _missing_filler(df: DataFrame, features: Sequence[str], with_flags: bool) -> SQLTransformer:
    """Fill nulls with the training mean and mark where that happened.

    The tree learner takes neither null nor NaN. The means are one row, one value
    per feature.
    """
    means = df.agg(*[F.avg(f).alias(f) for f in features]).first()
    parts = []
    for f in features:
        fill = means[f] if means[f] is not None else 0.0
        parts.append(f"coalesce(cast({f} as double), {fill!r}D) as {f}_filled")
        if with_flags:
            parts.append(f"cast({f} is null as double) as {f}_missing")
    return SQLTransformer(statement=f"select *, {', '.join(parts)} from __THIS__")


def train_gbt(
    df: DataFrame,
    features: Sequence[str],
    params: Mapping[str, float] = GBT_PARAMS,
    nullable: Sequence[str] = ("lag_1y", "lag_2y", "lag_3y", "series_mean", "series_dev"),
    seed: int = 7,
) -> PipelineModel:
    """Squared-error boosted trees for ``d``. Features in `nullable` may be missing and get an indicator."""
    known = df.filter(F.col("d").isNotNull())
    gaps = [f for f in features if f in nullable]
    plain = [f for f in features if f not in nullable]
    stages = []
    if gaps:
        stages.append(_missing_filler(known, gaps, with_flags=True))
    columns = [*plain, *[f"{f}_filled" for f in gaps], *[f"{f}_missing" for f in gaps]]
    stages.append(VectorAssembler(inputCols=columns, outputCol="features"))
    learner = GBTRegressor(
        featuresCol="features", labelCol="d", predictionCol="pred", lossType="squared", seed=seed, **params
    )
    return Pipeline(stages=[*stages, learner]).fit(known)


def predict_gbt(model: PipelineModel, df: DataFrame, series: DataFrame | None = None) -> DataFrame:
    """`df` with ``pred``; `series` is the encoding of a model that was fitted with one."""
    known = df if series is None else with_series_encoding(df, series)
    return model.transform(known).select(*df.columns, "pred")


def series_encoding(df: DataFrame) -> DataFrame:
    """(series_id, series_mean, series_dev) of the known values, and a row of the null series_id for series not seen.

    The last is the mean over all series' rows.
    """
    each = df.groupBy("series_id").agg(F.avg("d").alias("series_mean"), F.stddev_pop("d").alias("series_dev"))
    whole = df.agg(F.avg("d").alias("series_mean"), F.stddev_pop("d").alias("series_dev"))
    return each.where("series_id is not null and series_mean is not null").unionByName(
        whole.select(F.lit(None).cast("string").alias("series_id"), "series_mean", "series_dev")
    )


def with_series_encoding(df: DataFrame, series: DataFrame) -> DataFrame:
    """Add each series' training mean and deviation; a series that training has not seen gets those of all rows."""
    whole = series.where("series_id is null").first()
    rows = lookup(df, series.where("series_id is not null"), ["series_id"])
    unseen = {c: F.lit(whole[c] if whole and whole[c] is not None else 0.0) for c in SERIES_FEATURES}
    return rows.withColumns({c: F.coalesce(c, unseen[c]) for c in SERIES_FEATURES})


def out_of_fold_encoding(df: DataFrame, folds: int = ENCODING_FOLDS) -> DataFrame:
    """Add series_mean and series_dev of the series' known values in the other folds of time, never of the row's own.

    A row's own value would tell the learner the target. Folds are drawn by the hash of ts; sums per (series,
    fold) are one aggregation, and what the other folds hold is the series' total less the fold's.
    """
    fold = F.pmod(F.xxhash64("ts"), F.lit(folds))
    rows = df.withColumn("_fold", fold)
    centre = df.groupBy("series_id").agg(F.avg("d").alias("_centre"))  # sums of squares about it keep their digits
    shifted = lookup(rows.select("series_id", "_fold", "d"), centre, ["series_id"]).withColumn("_x", F.col("d") - F.col("_centre"))
    parts = shifted.groupBy("series_id", "_fold").agg(
        F.count("d").alias("n"), F.sum("_x").alias("s"), F.sum(F.col("_x") * F.col("_x")).alias("q"), F.first("_centre").alias("c")
    )
    own = Window.partitionBy("series_id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # `folds` rows
    rest = {k: F.sum(k).over(own) - F.coalesce(k, F.lit(0)) for k in ("n", "s", "q")}
    n, s, q = rest["n"], rest["s"], rest["q"]
    known = parts.select(
        "series_id",
        "_fold",
        F.when(n > 0, F.col("c") + s / n).alias("series_mean"),
        F.when(n > 0, F.sqrt(F.greatest(F.lit(0.0), q / n - (s / n) * (s / n)))).alias("series_dev"),
    )
    return lookup(rows, known, ["series_id", "_fold"]).drop("_fold")


def feature_importances(model: PipelineModel) -> DataFrame:
    """One row per model input, most important first."""
    columns = model.stages[-2].getInputCols()
    weights = model.stages[-1].featureImportances.toArray()
    rows = [Row(feature=c, importance=float(w)) for c, w in zip(columns, weights, strict=True)]
    spark = SparkSession.active()
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def param_grid(grid: Mapping[str, Sequence[float]]) -> list[dict[str, float]]:
    names = list(grid)
    return [dict(zip(names, values, strict=True)) for values in product(*grid.values())]


def param_name(params: Mapping[str, float]) -> str:
    return ",".join(f"{k}={v}" for k, v in params.items())


def prefix_errors(model: PipelineModel, df: DataFrame) -> list[float]:
    """Mean squared error on the rows of `df` with a known d of the first 1, 2, ... trees of `model`, in one pass over them."""
    for stage in model.stages[:-1]:
        df = stage.transform(df)
    return list(model.stages[-1].evaluateEachIteration(df.filter(F.col("d").isNotNull()), "squared"))


def _r2(error: float, variance: float | None, n: int) -> float | None:
    """As in `regression_metrics`: undefined for less than two rows, 1 or 0 for a constant target."""
    if n < 2:
        return None
    return 1 - error / variance if variance > 0 else float(error == 0)


def cross_validate(
    df: DataFrame,
    features: Sequence[str],
    candidates: Sequence[Mapping[str, float]] = (GBT_PARAMS,),
    n_splits: int = CV_SPLITS,
    test_size: int = TEST_SET_HOURS,
    step: timedelta | None = HOUR,
    parallelism: int = 4,
    encode: bool = False,
) -> DataFrame:
    """R² and fit time of every parameter set on every expanding-window fold.

    Boosting adds trees to the ones it has, so the first 100 trees of 1,000 are the model of 100 trees: candidates
    that differ in maxIter alone are one fit of the largest, whose prefixes are all scored by one pass over the test
    rows. Their fit time is that of the common fit. Each fit is a distributed job on a filtered view of one persisted
    frame; a few of them run side by side, and only scores come to the driver. With `encode` the series encoding is
    fitted on the training rows of each fold.
    """
    spark = df.sparkSession
    needed = list(dict.fromkeys(["series_id", "ts", "d", *features]))
    frame = with_segment(df.select(*needed), n_splits, test_size, step).persist()
    groups: dict[tuple, list[Mapping[str, float]]] = {}
    for params in candidates:
        groups.setdefault(tuple((k, v) for k, v in params.items() if k != "maxIter"), []).append(params)

    def score(task: tuple[list[Mapping[str, float]], int]) -> list[tuple]:
        alike, fold = task
        train, test = frame.filter(F.col("segment") < fold), frame.filter(F.col("segment") == fold)
        started = time.perf_counter()
        model, series = fit(train, features, max(alike, key=lambda p: p.get("maxIter", 0)), encode)
        seconds = time.perf_counter() - started
        known = test if series is None else with_series_encoding(test, series)
        spread = known.agg(F.var_pop("d").alias("v"), F.count("d").alias("n")).first()
        errors = prefix_errors(model, known) if spread.n else []
        return [
            (param_name(p), fold, _r2(errors[int(p.get("maxIter", len(errors))) - 1], spread.v, spread.n) if errors else None, seconds)
            for p in alike
        ]

    tasks = list(product(groups.values(), range(1, n_splits + 1)))
    try:
        with ThreadPoolExecutor(parallelism) as pool:
            scores = [row for rows in pool.map(inheritable_thread_target(spark)(score), tasks) for row in rows]
    finally:
        frame.unpersist()
    return spark.createDataFrame(scores, "param_set string, fold int, score double, fit_seconds double")


def fold_sizes(
    df: DataFrame, n_splits: int = CV_SPLITS, test_size: int = TEST_SET_HOURS, step: timedelta | None = HOUR
) -> DataFrame:
    """(series_id, fold, n_train, n_test): the rows of each series that every fold trains on and is scored on."""
    segments = with_segment(df, n_splits, test_size, step).groupBy("series_id", "segment").agg(F.count("*").alias("n_test"))
    # At most n_splits + 1 rows a series.
    before = Window.partitionBy("series_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    sized = segments.withColumn("n_train", F.coalesce(F.sum("n_test").over(before), F.lit(0)))
    return sized.filter("segment > 0").select("series_id", F.col("segment").alias("fold"), "n_train", "n_test")


def search_results(scores: DataFrame) -> DataFrame:
    """The cross-validation table over parameter sets, best first, with mean fit time."""
    times = scores.groupBy("param_set").agg(F.avg("fit_seconds").alias("mean_fit_seconds"))
    ranked = cv_results(scores.withColumn("_all", F.lit("all")), "_all").drop("_all")
    return ranked.join(times, "param_set").orderBy("rank", "param_set")


def grid_search(
    df: DataFrame,
    features: Sequence[str],
    candidates: Sequence[Mapping[str, float]],
    n_splits: int = CV_SPLITS,
    test_size: int = TEST_SET_HOURS,
    step: timedelta | None = HOUR,
    parallelism: int = 4,
    encode: bool = False,
) -> tuple[PipelineModel, DataFrame]:
    """Refit the best parameter set on all rows; also return the result table."""
    scores = cross_validate(df, features, candidates, n_splits, test_size, step, parallelism, encode)
    results = search_results(scores)
    best = best_params(results.withColumn("_all", F.lit("all")), "_all").first().param_set
    params = next(p for p in candidates if param_name(p) == best)
    return fit(df, features, params, encode)[0], results


def fit(
    df: DataFrame, features: Sequence[str], params: Mapping[str, float] = GBT_PARAMS, encode: bool = False
) -> tuple[PipelineModel, DataFrame | None]:
    """A model, and with `encode` the encoding that its predictions need; the model is fitted on out-of-fold encodings."""
    if not encode:
        return train_gbt(df, features, params), None
    return train_gbt(out_of_fold_encoding(df), [*features, *SERIES_FEATURES], params), series_encoding(df)


@dataclass(frozen=True)
class EarlyStop:
    """A model cut behind its best tree, the number of its trees, and the validation error of each prefix that was fitted."""

    model: PipelineModel
    trees: int
    errors: list[float]
    stopped: bool

    def curve(self, spark: SparkSession) -> DataFrame:
        """(trees, error, is_best) of each prefix."""
        rows = [(k, error, k == self.trees) for k, error in enumerate(self.errors, start=1)]
        return spark.createDataFrame(rows, "trees int, error double, is_best boolean")


def best_prefix(errors: Sequence[float], patience: int) -> tuple[int, bool]:
    """(trees, stopped): the prefix with the least error when `patience` further trees brought nothing better, or the best of all."""
    best = 0
    for k, error in enumerate(errors):
        if error < errors[best]:
            best = k
        elif k - best >= patience:
            return best + 1, True
    return best + 1, False


def train_early_stop(
    df: DataFrame,
    features: Sequence[str],
    validation: str,
    params: Mapping[str, float] = GBT_EARLY_STOP,
    patience: int = PATIENCE,
) -> EarlyStop:
    """Boost until `patience` trees in a row have not lowered the error on the rows where `validation` is true.

    ``maxIter`` of `params` is the limit. The learner cannot go on from a fitted model, so ensembles of doubling length
    are fitted until one shows the stop; its first trees, fitted again, are the model. That is less than four times the work
    of the trees looked at, whatever the limit.
    """
    limit = int(params["maxIter"])
    train, held_back = df.filter(~F.col(validation)), df.filter(F.col(validation))
    size = min(limit, 2 * patience)
    while True:
        model = train_gbt(train, features, {**params, "maxIter": size})
        errors = prefix_errors(model, held_back)
        trees, stopped = best_prefix(errors, patience)
        if stopped or size == limit:
            break
        size = min(limit, 2 * size)
    if trees < size:
        model = train_gbt(train, features, {**params, "maxIter": trees})
    return EarlyStop(model, trees, errors[: trees + patience] if stopped else errors, stopped)
