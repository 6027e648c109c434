"""Baseline model, cross-validation, boosted trees, comparison."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from hourloom.catalog import inputs as i
from hourloom.catalog.inputs import with_tables
from hourloom.catalog.registry import query
from hourloom.catalog.shaping import HIGH, LOW, rounded
from hourloom.consts import DAY, HOUR, LAG_FEATURES, TIME_FEATURES
from hourloom.operators import boosting, evaluate
from hourloom.operators.clean import clean
from hourloom.operators.features import add_calendar_features, add_features
from hourloom.operators.folds import holdout_split
from hourloom.operators.quality import assert_no_leak
from hourloom.operators.series import fill_grid
from hourloom.plans import pipelines
from hourloom.schemas import FeatureFlags
from hourloom.session import work_path
from hourloom.sources.files import append_run, read_runs
from hourloom.sources.holidays import holidays_between, us_holidays
from hourloom.sources.models import ModelSpec, load_model, registry_table, save_model
from hourloom.sources.store import staged

TEST_HOURS, SPLITS = 48, 8

# HE on its grid with a held-out end and the calendar group columns.
SPLIT_SQL = f"""
marked as (select f.series_id, f.ts, d, hour(f.ts) as hour, month(f.ts) as month, isodow(f.ts) - 1 as dow,
    f.ts <= e - interval {TEST_HOURS} hour as is_train
  from he_full f join (select series_id, max(ts) as e from he_full group by 1) m on m.series_id = f.series_id),
fitted as (select series_id, hour, month, avg(d) as pred, count(*) as n_rows from marked where is_train group by 1, 2, 3)
"""
R2_SQL = """case when var_pop(d) > 0 then 1 - avg(power(d - p, 2)) / var_pop(d)
  when count(*) > 1 then case when sum(power(d - p, 2)) = 0 then 1.0 else 0.0 end end"""
METRICS_SQL = f"""count(*) as example_count,
  round({R2_SQL}, 6) as r2_score,
  round(avg(power(d - p, 2)), 6) as mean_squared_error,
  round(sqrt(avg(power(d - p, 2))), 6) as root_mean_squared_error,
  round(avg(abs(d - p)), 6) as mean_absolute_error,
  round(avg(abs(d - p) / greatest(abs(d), 2.220446049250313e-16)), 6) as mean_absolute_percentage_error,
  round(max(abs(d - p)), 6) as max_error, round(avg(d), 6) as mean_on_target, round(sum(d), 4) as sum_on_target"""
METRICS = (
    "r2_score",
    "mean_squared_error",
    "root_mean_squared_error",
    "mean_absolute_error",
    "mean_absolute_percentage_error",
    "max_error",
    "mean_on_target",
)


def _split(spark, sf_dir):
    frame = add_calendar_features(fill_grid(i.hourly_types(spark, sf_dir)))
    return holdout_split(frame, TEST_HOURS, HOUR)


def _predicted(spark, sf_dir):
    rows = _split(spark, sf_dir)
    model = evaluate.fit_baseline(rows.filter("is_train"))
    return evaluate.predict_baseline(rows.filter("not is_train"), model)


@query("baseline_fit", with_tables("he_full", "with " + SPLIT_SQL + """
    select series_id, cast(hour as integer) as hour, cast(month as integer) as month, round(pred, 6) as pred, n_rows
    from fitted"""))
def baseline_fit(spark, sf_dir):
    return rounded(evaluate.fit_baseline(_split(spark, sf_dir).filter("is_train")), "pred")


@query("predict_baseline", with_tables("he_full", "with " + SPLIT_SQL + """
    select series_id, ts, d, round(pred, 6) as pred from marked left join fitted using (series_id, hour, month)"""))
def predict_baseline(spark, sf_dir):
    rows = _split(spark, sf_dir)
    model = evaluate.fit_baseline(rows.filter("is_train"))
    return rounded(evaluate.predict_baseline(rows, model).select("series_id", "ts", "d", "pred"), "pred")


@query("pred_vs_target", with_tables("he_full", "with " + SPLIT_SQL + """
    select series_id, ts, d, round(pred, 6) as pred from marked left join fitted using (series_id, hour, month)
    where not is_train"""))
def pred_vs_target(spark, sf_dir):
    return rounded(_predicted(spark, sf_dir).select("series_id", "ts", "d", "pred"), "pred")


@query("regression_metrics", with_tables("he_full", "with " + SPLIT_SQL + f"""
    select series_id, {METRICS_SQL} from (select series_id, d, pred as p from marked left join fitted
      using (series_id, hour, month) where not is_train and d is not null and pred is not null) x group by 1"""))
def regression_metrics(spark, sf_dir):
    rows = _split(spark, sf_dir)
    train, test = rows.filter("is_train"), rows.filter("not is_train")
    assert_no_leak(
        train.groupBy("series_id").agg(F.max("ts").alias("ts")),
        test.groupBy("series_id").agg(F.min("ts").alias("ts")),
    )
    scored = evaluate.regression_metrics(evaluate.predict_baseline(test, evaluate.fit_baseline(train)))
    return rounded(rounded(scored, *METRICS), "sum_on_target", places=4)


def folds_sql(groups: str) -> str:
    """Baseline predictions of every fold, with models fitted on all earlier rows."""
    return f"""
    seg as (select f.series_id, f.ts, f.d, hour(f.ts) as hour, month(f.ts) as month, isodow(f.ts) - 1 as dayofweek,
        cast(case when f.ts <= cut then 0 else (date_diff('hour', cut, f.ts) - 1) // {TEST_HOURS} + 1 end as integer) as fold
      from he_full f join (select series_id, max(ts) - interval {SPLITS * TEST_HOURS} hour as cut from he_full group by 1) b
        on b.series_id = f.series_id),
    preds as (select t.series_id, t.fold, t.ts, any_value(t.d) as d, avg(s.d) as p from seg t
      left join seg s on s.series_id = t.series_id and s.fold < t.fold
        and {" and ".join(f"s.{g} = t.{g}" for g in groups.split())}
      where t.fold > 0 group by 1, 2, 3),
    known as (select * from preds where d is not null and p is not null)"""


@query("baseline_cv", with_tables("he_full", "with " + folds_sql("hour month") + """,
    scores as (select series_id, fold, sqrt(avg(power(d - p, 2))) as rmse from known group by 1, 2)
    select series_id, fold, round(rmse, 6) as rmse, round(avg(rmse) over (partition by series_id), 6) as mean_rmse
    from scores"""))
def baseline_cv(spark, sf_dir):
    # Folds and their bounds read the frame four times, so it is written once.
    frame = staged(add_calendar_features(fill_grid(i.hourly_types(spark, sf_dir))), "cv")
    scores = evaluate.baseline_cv(frame, ("hour", "month"), SPLITS, TEST_HOURS)
    return rounded(evaluate.fold_rmse(scores), "rmse", "mean_rmse")


def _variants_sql() -> str:
    parts, ctes = [], []
    for name, groups in evaluate.BASELINE_VARIANTS.items():
        sql = folds_sql(" ".join(groups))
        for cte in ("seg", "preds", "known"):
            sql = sql.replace(f"{cte} as (", f"{cte}_{name} as (").replace(f"from {cte} ", f"from {cte}_{name} ")
            sql = sql.replace(f"join {cte} ", f"join {cte}_{name} ")
        ctes.append(sql)
        parts.append(
            f"select series_id, '{name}' as param_set, fold, {R2_SQL} as score "
            f"from known_{name} group by 1, 2, 3"
        )
    return "with " + ",".join(ctes) + ", scores as (" + " union all ".join(parts) + ")"


CV_TABLE_SQL = _variants_sql() + """,
    t as (select series_id, param_set, avg(cast(score as decimal(20,9))) as mean_score, stddev_pop(score) as std_score from scores group by 1, 2),
    ranked as (select *, cast(rank() over (partition by series_id order by mean_score desc) as integer) as rank from t)"""


def _cv_table(spark, sf_dir):
    frame = staged(add_calendar_features(fill_grid(i.hourly_types(spark, sf_dir))), "cv")
    scores = evaluate.baseline_variant_scores(frame, n_splits=SPLITS, test_size=TEST_HOURS)
    path = work_path(spark, "cv-results")
    # Decimals have exact means, so that equal scores stay equal in either engine.
    evaluate.cv_results(scores.withColumn("score", F.col("score").cast("decimal(20,9)"))).write.parquet(path)
    return spark.read.parquet(path)


@query("cv_rank", with_tables("he_full", CV_TABLE_SQL + """
    select series_id, param_set, round(mean_score, 6) as mean_score, round(std_score, 6) as std_score, rank from ranked"""))
def cv_rank(spark, sf_dir):
    table = _cv_table(spark, sf_dir)
    return rounded(table.withColumn("mean_score", F.col("mean_score").cast("double")), "mean_score", "std_score")


@query("best_params", with_tables("he_full", CV_TABLE_SQL + """
    select series_id, min(param_set) as param_set from ranked where rank = 1 group by 1"""))
def best_params(spark, sf_dir):
    """The baseline variant that wins the cross-validation of each series."""
    return evaluate.best_params(_cv_table(spark, sf_dir))


@query("compare_runs", with_tables("runs", """
    with labelled as (select *, model_name || '-v' || model_version || '-' || feature_flags as label from runs
      where model_version <= 1)
    unpivot (select model_name, model_version, label, start_time, r2_score, root_mean_squared_error, mean_squared_error,
      mean_absolute_percentage_error from labelled) on r2_score, root_mean_squared_error, mean_squared_error,
      mean_absolute_percentage_error into name metric value metric_value"""))
def compare_runs(spark, sf_dir):
    path = work_path(spark, "runs")
    append_run(i.runs(spark, sf_dir), path)
    history = read_runs(spark, path)
    specs = history.filter("model_version <= 1").select("model_name", "model_version")
    return evaluate.compare_runs(history, specs)


CLEAN_SPLIT_SQL = f"""
cleaned as ({i.clean_sql("he_full", LOW, HIGH)}),
marked as (select f.series_id, f.ts, d, hour(f.ts) as hour, month(f.ts) as month, isodow(f.ts) - 1 as dayofweek,
    f.ts <= e - interval {TEST_HOURS} hour as is_train
  from cleaned f join (select series_id, max(ts) as e from cleaned group by 1) m on m.series_id = f.series_id)
"""


@query("baseline_pipeline", with_tables("he_full", "with " + CLEAN_SPLIT_SQL + """,
    fitted as (select series_id, hour, month, avg(d) as pred from marked where is_train group by 1, 2, 3)
    select series_id, ts, round(d, 6) as d, round(pred, 6) as pred from marked left join fitted using (series_id, hour, month)"""))
def baseline_pipeline(spark, sf_dir):
    """Register the baseline (saved and reloaded), then predict the cleaned series."""
    series = i.hourly_types(spark, sf_dir)
    filled = fill_grid(series)
    model = pipelines.fit_baseline(filled, work_path(spark, "baseline"), HOUR, TEST_HOURS, LOW, HIGH)
    frame = add_calendar_features(clean(filled, LOW, HIGH, fit_on=series))
    predicted = evaluate.predict_baseline(frame, model, strict=True)
    return rounded(predicted.select("series_id", "ts", "d", "pred"), "d", "pred")


VARIANT_VERSIONS = tuple(evaluate.BASELINE_VARIANTS.items())
# `now` and the evaluation window that follows from it, and where training starts.
COMPARED_AT, TRAINED_FROM = datetime(2024, 2, 1, 8, 40), datetime(2024, 1, 2)
WINDOW_START, WINDOW_END = datetime(2024, 1, 27, 9), datetime(2024, 1, 29, 9)


def _compare_sql() -> str:
    parts = []
    for version, (_, groups) in enumerate(VARIANT_VERSIONS, start=1):
        using = ", ".join(("series_id", *groups))
        parts.append(
            f"select {version} as v, d, p from marked join (select {using}, avg(d) as p from trained "
            f"group by {using}) f using ({using}) where d is not null and p is not null"
        )
    calendar = "hour(ts) as hour, month(ts) as month, isodow(ts) - 1 as dayofweek"
    return f"""
    train_rows as (select * from he_full where ts between timestamp '{TRAINED_FROM}' and timestamp '{WINDOW_START}'),
    eval_rows as (select * from he_full where ts between timestamp '{WINDOW_START}' and timestamp '{WINDOW_END}'),
    trained as (select *, {calendar} from ({i.clean_sql("train_rows", LOW, HIGH)})),
    marked as (select *, {calendar} from ({i.clean_sql("eval_rows", LOW, HIGH)})),
    preds as ({" union all ".join(parts)}),
    scored as (select v, {R2_SQL} as r2_score, sqrt(avg(power(d - p, 2))) as root_mean_squared_error,
      avg(power(d - p, 2)) as mean_squared_error,
      avg(abs(d - p) / greatest(abs(d), 2.220446049250313e-16)) as mean_absolute_percentage_error from preds group by 1)
    unpivot (select 'baseline' as model_name, v as model_version, 'baseline-v' || v || '-fB___' as label,
      timestamp '{COMPARED_AT}' as start_time, round(r2_score, 6) as r2_score,
      round(root_mean_squared_error, 6) as root_mean_squared_error, round(mean_squared_error, 6) as mean_squared_error,
      round(mean_absolute_percentage_error, 6) as mean_absolute_percentage_error from scored)
    on r2_score, root_mean_squared_error, mean_squared_error, mean_absolute_percentage_error
    into name metric value metric_value"""


def _registered(spark, sf_dir) -> tuple[str, str]:
    """A store of all hours, and a registry with the baseline variants trained on what precedes the evaluation window."""
    series = i.hourly_types(spark, sf_dir)
    store, registry = i.new_store(fill_grid(series), HOUR), work_path(spark, "registry")
    windows = pipelines.requests_for(pipelines.stored_bounds(spark, store), TRAINED_FROM, WINDOW_START)
    frame = pipelines.model_input(spark, store, i.raw_records(series), windows, us_holidays(spark), HOUR, LOW, HIGH)
    for _, groups in VARIANT_VERSIONS:
        pipelines.register_baseline(frame, registry, "baseline", groups)
    return store, registry


def _eval_frame(spark, sf_dir, store):
    raw, holidays = i.raw_records(i.hourly_types(spark, sf_dir)), us_holidays(spark)
    return pipelines.eval_frame(spark, store, raw, holidays, COMPARED_AT, HOUR, LOW, HIGH, test_hours=TEST_HOURS)


@query("compare_pipeline", with_tables("he_full", "with " + _compare_sql()))
def compare_pipeline(spark, sf_dir):
    """Three registered models are loaded by name and version, scored on the window that `now` allows, logged and compared."""
    store, registry = _registered(spark, sf_dir)
    specs = [ModelSpec.parse(f"baseline/{k}") for k, _ in enumerate(VARIANT_VERSIONS, start=1)]
    result = pipelines.compare_saved(
        spark, registry, specs, work_path(spark, "runs"), COMPARED_AT, _eval_frame(spark, sf_dir, store)
    )
    return rounded(result, "metric_value")


@query("registered_models", with_tables("he_full", f"""
    select 'baseline' as model_name, v as model_version, series_id, 'baseline' as kind, cols as input_columns,
      strftime(min(ts), '%Y-%m-%d_%H') as train_start, strftime(max(ts), '%Y-%m-%d_%H') as train_end
    from he_full, (values {", ".join(f"({k}, '{','.join(g)}')" for k, (_, g) in enumerate(VARIANT_VERSIONS, start=1))}) t(v, cols)
    where ts between timestamp '{TRAINED_FROM}' and timestamp '{WINDOW_START}' group by all"""))
def registered_models(spark, sf_dir):
    """What the registry knows of every version after a reload: its inputs and the training range of each series."""
    _, registry = _registered(spark, sf_dir)
    return registry_table(spark, registry, "baseline").select(
        "model_name", "model_version", "series_id", "kind", F.array_join("input_columns", ",").alias("input_columns"), "train_start", "train_end"
    )


# Trees: daily orders, one series a priority, long enough for the lags of one, two and three years.
TREE_LOW, TREE_HIGH, TREE_TEST_DAYS = 200_000.0, 2_000_000.0, 28
GBT_FEATURES = [*TIME_FEATURES, *LAG_FEATURES, "is_holiday"]
# The reference's depth and grid shape with fewer, larger steps: README has what 500 trees take.
QUERY_GBT = {"stepSize": 0.2, "maxDepth": 5, "maxIter": 15}
QUERY_GRID = {"stepSize": (0.1, 0.2, 0.4), "maxDepth": (3, 5), "maxIter": (2, 4, 8)}
QUERY_EARLY_STOP = {"stepSize": 0.3, "maxDepth": 4, "maxIter": 1000}
QUERY_PATIENCE = 10


def _gbt_frame(spark, sf_dir):
    series = i.daily_orders(spark, sf_dir)
    cleaned = clean(fill_grid(series, DAY), TREE_LOW, TREE_HIGH, fit_on=series)
    frame = add_features(cleaned, holidays_between(spark, 1990, 2039))
    return staged(holdout_split(frame, TREE_TEST_DAYS, DAY), "gbt")


@query("gbt_predict")
def gbt_predict(spark, sf_dir):
    """Fit on the training rows, save, reload, predict every row."""
    rows = _gbt_frame(spark, sf_dir)
    train = rows.filter("is_train")
    model, series = boosting.fit(train, GBT_FEATURES, QUERY_GBT, encode=True)
    path = work_path(spark, "gbt")
    save_model(model, path, GBT_FEATURES, pipelines.training_params(train), QUERY_GBT, series=series)
    return load_model(spark, path).predict(rows).select("series_id", "ts", "d", "pred")


@query("feature_importances")
def feature_importances(spark, sf_dir):
    model, _ = boosting.fit(_gbt_frame(spark, sf_dir).filter("is_train"), GBT_FEATURES, QUERY_GBT, encode=True)
    return boosting.feature_importances(model)


@query("gbt_cv")
def gbt_cv(spark, sf_dir):
    """18 parameter sets on 8 folds; sets that differ in the number of trees are one fit."""
    grid = boosting.param_grid(QUERY_GRID)
    frame = _gbt_frame(spark, sf_dir)
    return boosting.search_results(
        boosting.cross_validate(frame, GBT_FEATURES, grid, SPLITS, TREE_TEST_DAYS, DAY, encode=True)
    )


@query("gbt_folds", with_tables("dord_full", f"""
    with cut as (select series_id, max(ts) - interval {SPLITS * TREE_TEST_DAYS} day as cut from dord_full group by 1),
    seg as (select f.series_id, case when ts <= cut then 0 else (date_diff('day', cut, ts) - 1) // {TREE_TEST_DAYS} + 1 end as s
      from dord_full f join cut c on c.series_id = f.series_id),
    sized as (select series_id, s, count(*) as n from seg group by 1, 2)
    select series_id, cast(s as integer) as fold,
      cast(sum(n) over (partition by series_id order by s rows between unbounded preceding and 1 preceding) as bigint) as n_train, n as n_test
    from sized qualify s > 0"""))
def gbt_folds(spark, sf_dir):
    """How many rows each of the folds of `gbt_cv` and `train_pipeline` trains on and is scored on."""
    return boosting.fold_sizes(_gbt_frame(spark, sf_dir), SPLITS, TREE_TEST_DAYS, DAY)


@query("gbt_early_stop")
def gbt_early_stop(spark, sf_dir):
    """The validation error of every number of trees up to the stop, with the best one."""
    rows = _gbt_frame(spark, sf_dir).withColumn("held_back", ~F.col("is_train"))
    stop = boosting.train_early_stop(rows, GBT_FEATURES, "held_back", QUERY_EARLY_STOP, QUERY_PATIENCE)
    return stop.curve(spark)


def _train_options(spark):
    return {
        "holidays": holidays_between(spark, 1990, 2039),
        "model_path": work_path(spark, "model"),
        "flags": FeatureFlags(lag=True, holidays=True),
        "candidates": (QUERY_GBT,),
        "n_splits": SPLITS,
        "test_size": TREE_TEST_DAYS,
        "step": DAY,
        "low": TREE_LOW,
        "high": TREE_HIGH,
    }


@query("train_pipeline")
def train_pipeline(spark, sf_dir):
    """Train on the stored days that have lags; the result is the cross-validation table."""
    series = i.daily_orders(spark, sf_dir)
    store = i.new_store(fill_grid(series, DAY), DAY)
    windows = pipelines.requests_for(series, datetime(1998, 1, 1), datetime(2001, 6, 30))
    _, results = pipelines.train(spark, store, i.raw_records(series), windows, **_train_options(spark))
    return results


@query("refresh_and_train")
def refresh_and_train(spark, sf_dir):
    series = i.daily_orders(spark, sf_dir)
    store = i.new_store(i.until(fill_grid(series, DAY), datetime(2000, 12, 31)), DAY)
    requests = pipelines.requests_for(series, datetime(1998, 1, 1), datetime(2001, 6, 30))
    _, results = pipelines.refresh_and_train(
        spark, i.raw_records(series), store, requests, close_gap=True, **_train_options(spark)
    )
    return results
