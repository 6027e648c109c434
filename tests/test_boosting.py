from __future__ import annotations

import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from hourloom.consts import HOUR, TIME_FEATURES
from hourloom.operators import boosting as b
from hourloom.operators import evaluate as e
from hourloom.operators.features import add_calendar_features
from hourloom.operators.folds import holdout_split
from hourloom.session import work_path
from tests.conftest import hours

PARAMS = {"stepSize": 0.3, "maxDepth": 3, "maxIter": 5}


@pytest.fixture(scope="module")
def frame(spark):
    ts = hours("2024-01-01", 24 * 20)
    rows = [("a", t, 100 + 30 * math.sin(t.hour / 24 * 2 * math.pi) + (5 if t.weekday() > 4 else 0)) for t in ts]
    df = add_calendar_features(spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, d double"))
    lag = F.when(F.dayofmonth("ts") > 10, F.col("d"))
    return df.withColumns({"lag_1y": lag, "lag_2y": F.lit(None).cast("double")}).persist()


def test_model_learns_saves_and_takes_missing_values(spark, frame):
    features = [*TIME_FEATURES, "lag_1y", "lag_2y"]
    model = b.train_gbt(frame, features, PARAMS)
    path = work_path(spark, "gbt")
    model.write().save(path)
    scored = b.predict_gbt(PipelineModel.load(path), frame)
    assert scored.filter("pred is null").count() == 0
    assert e.regression_metrics(scored).first().r2_score > 0.8
    table = b.feature_importances(model).collect()
    assert {r.feature for r in table} == {*TIME_FEATURES, "lag_1y_filled", "lag_1y_missing", "lag_2y_filled", "lag_2y_missing"}
    weights = [r.importance for r in table]
    assert weights == sorted(weights, reverse=True) and sum(weights) == pytest.approx(1)


def test_grid_search_ranks_and_refits(frame):
    grid = b.param_grid({"stepSize": (0.3,), "maxDepth": (1, 3), "maxIter": (4,)})
    assert [p["maxDepth"] for p in grid] == [1, 3]
    model, results = b.grid_search(frame, list(TIME_FEATURES), grid, 2, 48, HOUR)
    rows = results.collect()
    assert [r["rank"] for r in rows] == [1, 2]
    assert "maxDepth=3" in rows[0].param_set and rows[0].mean_score > rows[1].mean_score
    assert rows[0].mean_fit_seconds > 0
    assert model.stages[-1].getMaxDepth() == 3


def test_early_stop_shows_the_best_prefix(spark, frame):
    rows = holdout_split(frame, 48, HOUR).withColumn("held_back", ~F.col("is_train"))
    params = {"stepSize": 1.0, "maxDepth": 4, "maxIter": 1000}
    stop = b.train_early_stop(rows, list(TIME_FEATURES), "held_back", params, patience=4)
    assert stop.stopped and len(stop.errors) == stop.trees + 4 < 40
    assert min(stop.errors) == stop.errors[stop.trees - 1]
    assert stop.model.stages[-1].getNumTrees == stop.trees
    again = b.prefix_errors(stop.model, rows.filter("held_back"))
    assert again == pytest.approx(stop.errors[: stop.trees])
    assert [r.trees for r in stop.curve(spark).filter("is_best").collect()] == [stop.trees]


@pytest.mark.parametrize(
    "errors, patience, want",
    [([5, 4, 3], 2, (3, False)), ([5, 3, 4, 3, 2], 2, (2, True)), ([5, 3, 4, 2, 4, 4], 2, (4, True)), ([1], 1, (1, False)), ([2, 2, 2], 2, (1, True))],
)
def test_best_prefix(errors, patience, want):
    assert b.best_prefix(errors, patience) == want


def test_prefixes_score_like_separate_fits(frame):
    features = list(TIME_FEATURES)
    grid = b.param_grid({"stepSize": (0.3,), "maxDepth": (2,), "maxIter": (1, 3, 6)})
    together = {(r.param_set, r.fold): r.score for r in b.cross_validate(frame, features, grid, 2, 48, HOUR).collect()}
    assert len(together) == 6
    for params in grid:
        alone = b.cross_validate(frame, features, [params], 2, 48, HOUR).collect()
        assert {(r.param_set, r.fold): r.score for r in alone} == pytest.approx(
            {k: v for k, v in together.items() if k[0] == b.param_name(params)}
        )
    rows = holdout_split(frame, 48, HOUR)
    model, _ = b.fit(rows.filter("is_train"), features, grid[-1])
    test = rows.filter("not is_train")
    scored = e.regression_metrics(b.predict_gbt(model, test), by=()).first()
    assert b.prefix_errors(model, test)[-1] == pytest.approx(scored.mean_squared_error)


def test_trees_know_the_series(spark, frame):
    low = frame.filter("d is not null").select("series_id", "ts", "d", *TIME_FEATURES)
    high = low.withColumns({"series_id": F.lit("b"), "d": F.col("d") * 10})
    both = low.unionByName(high)
    model, series = b.fit(both, list(TIME_FEATURES), PARAMS, encode=True)
    scored = b.predict_gbt(model, both, series).groupBy("series_id").agg(F.avg("pred").alias("p"), F.avg("d").alias("d"))
    means = {r.series_id: (r.p, r.d) for r in scored.collect()}
    assert means["a"][0] == pytest.approx(means["a"][1], rel=0.3) and means["b"][0] == pytest.approx(means["b"][1], rel=0.1)
    unseen = b.predict_gbt(model, low.withColumn("series_id", F.lit("new")), series)
    assert unseen.filter("pred is null").count() == 0


def test_encoding_never_uses_the_own_fold(spark):
    rows = [("a", t, float(k * k)) for k, t in enumerate(hours("2024-01-01", 40))] + [("b", hours("2024-01-01", 1)[0], 5.0)]
    df = spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, d double")
    got = b.out_of_fold_encoding(df, 5).withColumn("fold", F.pmod(F.xxhash64("ts"), F.lit(5))).collect()
    assert len(got) == 41
    for r in got:
        others = [x.d for x in got if x.series_id == r.series_id and x.fold != r.fold]
        if not others:
            assert r.series_mean is None and r.series_dev is None
            continue
        mean = sum(others) / len(others)
        assert r.series_mean == pytest.approx(mean)
        assert r.series_dev == pytest.approx(math.sqrt(sum((x - mean) ** 2 for x in others) / len(others)), rel=1e-6)
    table = {r.series_id: (r.series_mean, r.series_dev) for r in b.series_encoding(df).collect()}
    assert table["b"] == (5.0, 0.0) and set(table) == {"a", "b", None}
