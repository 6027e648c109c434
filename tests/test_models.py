from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hourloom.consts import DAY
from hourloom.operators import boosting as b
from hourloom.operators import evaluate as e
from hourloom.operators.quality import LeakError
from hourloom.plans import pipelines as pl
from hourloom.schemas import FeatureFlags
from hourloom.session import work_path
from hourloom.sources import files, models as m
from hourloom.sources import store as st
from hourloom.sources.holidays import us_holidays
from tests.conftest import at, collected, hours

RAW = "period string, respondent string, type string, value string, position long"


@pytest.fixture(scope="module")
def stored(spark):
    """Two daily series of other levels over four and a half years."""
    rows = [
        (sid, t, level + 10.0 * t.weekday() + k % 3)
        for sid, level in (("a", 100), ("b", 500))
        for k, t in enumerate(hours("2014-01-01", 1640, DAY))
    ]
    path = work_path(spark, "store")
    st.write_store(spark.createDataFrame(rows, "series_id string, ts timestamp_ntz, d double"), path, DAY)
    return path


def model_frame(spark, store, start, end):
    bounds = pl.requests_for(pl.stored_bounds(spark, store), at(start), at(end))
    raw = spark.createDataFrame([], RAW)
    return pl.model_input(spark, store, raw, bounds, us_holidays(spark), DAY, 0, 9999, on_fail="raise")


def test_specs_are_read_from_text():
    assert m.ModelSpec.parse("a/b/12") == m.ModelSpec("a/b", 12)
    for text in ("name", "name/", "/3", "name/x", "name/-1"):
        with pytest.raises(ValueError):
            m.ModelSpec.parse(text)


def test_versions_count_up_and_unfinished_ones_are_no_models(spark, stored, tmp_path):
    frame, registry = model_frame(spark, stored, "2017-02-01", "2017-12-31"), str(tmp_path)
    assert m.versions(spark, registry, "base line/x") == [] and m.registry_table(spark, registry, "x").count() == 0
    assert pl.register_baseline(frame, registry, "base line/x", ("month",)).version == 1
    (tmp_path / "base%20line%2Fx" / "version=2" / "model").mkdir(parents=True)
    spec = pl.register_baseline(frame, registry, "base line/x", ("dayofweek",))
    assert spec == m.ModelSpec("base line/x", 3) and m.versions(spark, registry, spec.name) == [1, 3]
    saved = m.find_model(spark, registry, spec)
    assert (saved.spec, saved.kind, saved.input_columns) == (spec, "baseline", ("dayofweek",))
    assert collected(saved.training) == [(s, "2017-02-01_00", "2017-12-31_00") for s in "ab"]
    assert collected(saved.train_ends()) == [(s, at("2017-12-31")) for s in "ab"]
    table = collected(m.registry_table(spark, registry, spec.name), "model_version", "kind", "series_id", "train_end")
    assert table == [(v, "baseline", s, "2017-12-31_00") for v in (1, 3) for s in "ab"]
    with pytest.raises(m.UnknownModel):
        m.find_model(spark, registry, m.ModelSpec(spec.name, 2))


def test_trained_trees_are_saved_with_parameters_and_scored_beside_a_baseline(spark, stored, tmp_path):
    registry, runs = str(tmp_path / "registry"), str(tmp_path / "runs")
    windows = pl.requests_for(pl.stored_bounds(spark, stored), at("2017-02-01"), at("2017-12-31"))
    raw = spark.createDataFrame([], RAW)
    saved, cv = pl.train(
        spark, stored, raw, windows, us_holidays(spark), str(tmp_path / "trees"), FeatureFlags(lag=True),
        ({"stepSize": 0.3, "maxDepth": 3, "maxIter": 4}, {"stepSize": 0.3, "maxDepth": 3, "maxIter": 2}), 2, 28, DAY, 0, 9999,
    )
    assert cv.count() == 2 and saved.kind == "trees" and "maxIter=4" in saved.params["param_set"]
    trees = pl.register_trained(spark, registry, "trees", saved)
    base = pl.register_baseline(model_frame(spark, stored, "2017-02-01", "2017-12-31"), registry, "baseline", ("dayofweek",))
    frame = pl.eval_frame(spark, stored, raw, us_holidays(spark), at("2018-02-01T10:31"), DAY, 0, 9999, test_hours=24 * 20)
    # 72 hours before the rounded now, 20 days back, on the daily grid
    assert collected(frame.groupBy("series_id").agg(F.min("ts").alias("s"), F.max("ts").alias("e"))) == [
        (s, at("2018-01-10"), at("2018-01-29")) for s in "ab"
    ]
    table = pl.compare_saved(spark, registry, [trees, base], runs, at("2018-02-01T10:31"), frame)
    labels = {r.label for r in table.collect()}
    assert labels == {"trees-v1-fBL__", "baseline-v1-fB___"} and table.count() == 8
    # The same numbers as scoring by hand.
    by_hand = e.regression_metrics(b.predict_gbt(saved.model, frame, saved.series), by=()).first()
    logged = files.read_runs(spark, runs).filter("model_name = 'trees'").first()
    assert logged.r2_score == pytest.approx(by_hand.r2_score) and logged.r2_score > 0.95
    again = pl.compare_saved(spark, registry, [base], runs, at("2018-02-02T10:31"), frame, plot_specs=[trees, base])
    assert again.groupBy("label").count().collect().__len__() == 2 and again.count() == 12


def test_a_stored_training_end_behind_the_window_is_refused_after_reload(spark, stored, tmp_path):
    registry, runs = str(tmp_path / "registry"), str(tmp_path / "runs")
    good = pl.register_baseline(model_frame(spark, stored, "2017-02-01", "2018-01-10"), registry, "baseline", ("month",))
    late = pl.register_baseline(model_frame(spark, stored, "2017-02-01", "2018-01-11"), registry, "baseline", ("month",))
    raw = spark.createDataFrame([], RAW)
    frame = pl.eval_frame(spark, stored, raw, us_holidays(spark), at("2018-02-01T10:31"), DAY, 0, 9999, test_hours=24 * 20)
    with pytest.raises(LeakError, match="baseline/2"):
        pl.evaluate_saved(spark, registry, [good, late], frame, runs, at("2018-02-01"))
    assert not (tmp_path / "runs").exists()
    assert pl.evaluate_saved(spark, registry, [good], frame, runs, at("2018-02-01")).count() == 1
