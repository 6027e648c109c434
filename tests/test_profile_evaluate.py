from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourloom.consts import HOUR
from hourloom.operators import evaluate as e
from hourloom.operators import profile as p
from hourloom.operators.features import add_calendar_features
from hourloom.operators.lookup import lookup
from tests.conftest import at, collected, hours, ordered

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def shapes():
    rnd = random.Random(6)
    return {
        "normal": [rnd.gauss(0, 5) for _ in range(500)],
        "narrow": [50 + rnd.random() / 1000 for _ in range(700)],
        "outlier": [rnd.randint(60, 165) for _ in range(300)] + [1e12, -1e12],
        "ties": [float(rnd.choice([0, 0, 0, 1, -1])) for _ in range(400)],
        "tiny": [rnd.choice([-1, 1]) * 10.0 ** rnd.randint(-300, 300) for _ in range(200)],
        "one": [3.25],
        "same": [7.0] * 50,
    }


def test_exact_quantiles(series):
    data = shapes()
    df = series({k: list(zip(hours("2024-01-01", len(v)), v)) + [(at("2023-01-01"), None)] for k, v in data.items()})
    for row in p.exact_quantiles(df, PROBS).collect():
        want = np.quantile(np.array(data[row.series_id]), PROBS)
        got = [row[f"q{k}"] for k in range(len(PROBS))]
        assert got == pytest.approx(list(want), rel=1e-9, abs=1e-12), row.series_id


def test_quantiles_with_infinities(series):
    inf = float("inf")
    data = {"a": [1.0, 2.0, 3.0, inf], "b": [-inf, 0.0, inf], "c": [inf, inf], "d": [1.0, float("nan")]}
    df = series({k: list(zip(hours("2024-01-01", len(v)), v)) for k, v in data.items()})
    got = {r.series_id: (r.q0, r.q1) for r in p.exact_quantiles(df, [0.0, 0.5]).collect()}
    assert got["a"] == (1.0, 2.5) and got["b"] == (-inf, 0.0) and got["c"] == (inf, inf)
    assert got["d"][0] == 1.0 and np.isnan(got["d"][1])


def test_describe_and_profile(series):
    values = shapes()["normal"]
    df = series(list(zip(hours("2024-01-01", len(values)), values)))
    row, prof, a = p.describe_series(df).first(), p.profile(df).first(), np.array(values)
    assert (row.n, row.min_d, row.max_d) == (500, a.min(), a.max())
    assert row.std_d == pytest.approx(a.std(ddof=1))
    assert prof.skew_d == pytest.approx(((a - a.mean()) ** 3).mean() / a.std() ** 3)
    assert prof.median_d == pytest.approx(np.median(a))
    near = p.profile(df, approximate=True).first()
    assert abs(near.median_d - np.median(a)) < 0.5


def test_histogram_matches_numpy(series):
    rnd = random.Random(7)
    values = [float(rnd.randint(0, 1000)) for _ in range(600)]
    df = series({"a": list(zip(hours("2024-01-01", 600), values)), "flat": [(at("2024-01-01"), 5.0)]})
    got = {r.bin: r for r in p.histogram(df, 20).filter("series_id = 'a'").collect()}
    counts, edges = np.histogram(values, 20)
    for k in range(20):
        assert (got[k + 1].n if k + 1 in got else 0) == counts[k]
        if k + 1 in got:
            assert got[k + 1].bin_start == pytest.approx(edges[k])
    flat = p.histogram(df, 20).filter("series_id = 'flat'").first()
    assert (flat.bin, flat.n) == (1, 1)


def test_outliers_and_nulls(spark, series):
    rows = list(zip(hours("2024-01-01", 6), [1, 5, None, 9, 20, 30]))
    r = p.outlier_report(series(rows), "d", 4, 15).first()
    assert (r.n_below, r.n_above, r.lowest, r.highest) == (1, 2, 1.0, 30.0)
    assert p.outliers(series(rows), "d", 4, 15).count() == 3
    assert p.within(series(rows), "d", 5, 20).count() == 1
    assert collected(p.null_map(series(rows))) == [("a", 2024, 1, 1)]
    assert collected(p.null_counts(series(rows))) == [("a", 6, 1)]
    pairs = spark.createDataFrame(
        [("a", 1.0, None), ("a", None, None), ("a", None, 2.0), ("a", 1.0, 1.0)], "series_id string, d double, df double"
    )
    assert collected(p.null_pattern(pairs)) == [("a", 4, 1, 1, 1, 1)]
    both_null = p.reconcile(series([(rows[2][0], None)]), series([(rows[2][0], None)]))
    assert both_null.count() == 0
    adjusted = series([(rows[2][0], None)]).withColumn("adjusted_d", F.lit(None).cast("double"))
    counts = p.reconcile_counts(adjusted, series([(rows[2][0], None)])).first()
    assert (counts.n_shared, counts.n_different, counts.n_null_raw, counts.n_not_adjusted) == (1, 0, 1, 1)


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_with_a_hot_key(spark, threshold, how):
    rnd = random.Random(8)
    rows = [("hot" if k % 3 == 0 else f"k{rnd.randint(0, 30)}", k) for k in range(200)] + [(None, 500)]
    df = spark.createDataFrame(rows, "k string, v int")
    table = df.filter("k is not null and k <> 'k3'").groupBy("k").agg(
        F.max("v").alias("top"), F.max(F.when(F.col("k") == "hot", None).otherwise(1)).alias("opt")
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = collected(lookup(df, table, ["k"], how=how))
        per_key = {r.k: (r.top, r.opt) for r in table.collect()}
        found = [(k, v, *per_key.get(k, (None, None))) for k, v in rows if how == "left" or k in per_key]
        want = ordered(found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == want


def test_list_duplicates(spark):
    df = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3)], "k string, position int")
    assert collected(p.list_duplicates(df, ["k"])) == [("x", 1, 2), ("x", 2, 2)]


def test_metrics_against_numpy(series):
    rnd = random.Random(9)
    y = [rnd.uniform(60000, 165000) for _ in range(400)]
    guess = [v + rnd.gauss(0, 3000) for v in y]
    rows = list(zip(hours("2024-01-01", 400), y))
    preds = {t: g for (t, _), g in zip(rows, guess)}
    df = series([*rows, (at("2025-01-01"), None)])
    lookup_pred = df.sparkSession.createDataFrame(list(preds.items()), "ts timestamp_ntz, pred double")
    m = e.regression_metrics(df.join(lookup_pred, "ts", "left")).first()
    a, b = np.array(y), np.array(guess)
    assert m.example_count == 400
    assert m.mean_squared_error == pytest.approx(((a - b) ** 2).mean())
    assert m.root_mean_squared_error == pytest.approx(math.sqrt(((a - b) ** 2).mean()))
    assert m.r2_score == pytest.approx(1 - ((a - b) ** 2).sum() / ((a - a.mean()) ** 2).sum())
    assert m.mean_absolute_percentage_error == pytest.approx((abs(a - b) / abs(a)).mean())
    assert (m.max_error, m.sum_on_target) == (pytest.approx(abs(a - b).max()), pytest.approx(a.sum()))


def test_r2_of_a_constant_target(spark):
    rows = [("wrong", 1.0, 2.0), ("wrong", 1.0, 1.0), ("right", 1.0, 1.0), ("right", 1.0, 1.0), ("single", 1.0, 2.0)]
    df = spark.createDataFrame(rows, "series_id string, d double, pred double")
    assert dict(collected(e.regression_metrics(df), "series_id", "r2_score")) == {
        "wrong": 0.0, "right": 1.0, "single": None,
    }


def test_baseline(series):
    ts = hours("2024-01-01", 72)
    frame = add_calendar_features(series([(t, t.hour + (100 if t.day == 2 else 0)) for t in ts]))
    model = e.fit_baseline(frame.filter("dayofmonth < 3"))
    got = e.predict_baseline(frame.filter("dayofmonth = 3"), model, strict=True)
    assert {r.pred - r.hour for r in got.collect()} == {50.0}
    with pytest.raises(Exception, match="no value"):
        e.predict_baseline(add_calendar_features(series([(at("2024-05-01"), 1)])), model, strict=True).collect()


def test_fold_predictions_use_only_earlier_rows(series):
    rnd = random.Random(10)
    ts = hours("2024-01-29", 24 * 8)
    values = [float(rnd.randint(0, 100)) if rnd.random() > 0.2 else None for _ in ts]
    frame = add_calendar_features(series(list(zip(ts, values))))
    got = e.fold_predictions(frame, ("hour",), 3, 24, HOUR)
    want = []
    for fold in (1, 2, 3):
        cut = len(ts) - (4 - fold) * 24
        for k in range(cut, cut + 24):
            seen = [v for t, v in zip(ts[:cut], values[:cut]) if t.hour == ts[k].hour and v is not None]
            want.append((ts[k], fold, sum(seen) / len(seen) if seen else None))
    rows = collected(got, "ts", "fold", "pred")
    assert [r[:2] for r in rows] == [w[:2] for w in ordered(want)]
    assert [r[2] for r in rows] == pytest.approx([w[2] for w in ordered(want)])


def test_cv_table_ranks_ties_together(spark):
    scores = spark.createDataFrame(
        [("s", "a", 0.5), ("s", "a", 0.7), ("s", "b", 0.7), ("s", "b", 0.5), ("s", "c", 0.1), ("s", "c", 0.3)],
        "series_id string, param_set string, score double",
    )
    got = collected(e.cv_results(scores), "param_set", "rank", "std_score")
    assert [(n, r) for n, r, _ in got] == [("a", 1), ("b", 1), ("c", 3)]
    assert [s for *_, s in got] == pytest.approx([0.1] * 3)
    assert collected(e.best_params(e.cv_results(scores))) == [("s", "a")]


def test_compare_runs_labels_with_the_newest_features(spark):
    rows = [("m", 1, at("2024-01-01"), "fB___", 0.1, 1.0, 1.0, 0.5), ("m", 1, at("2024-01-02"), "fBL__", 0.2, 1.0, 1.0, 0.5),
            ("m", 2, at("2024-01-01"), "fB___", 0.3, 1.0, 1.0, 0.5)]
    from hourloom.schemas import RUNS

    runs = spark.createDataFrame(rows, RUNS)
    specs = spark.createDataFrame([("m", 1)], "model_name string, model_version int")
    got = e.compare_runs(runs, specs)
    assert {r.label for r in got.collect()} == {"m-v1-fBL__"}
    assert got.count() == 8
    r2 = collected(got.filter("metric = 'r2_score'"), "start_time", "metric_value")
    assert r2 == [(at("2024-01-01"), 0.1), (at("2024-01-02"), 0.2)]
