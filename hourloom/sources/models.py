"""Saved models, and a registry of them by name and version.

A saved model is a folder: ``model`` holds the fitted pipeline or the baseline's table, ``series`` the series encoding of
a pipeline that has one, ``training`` the training range of each series, and ``entry``, written last, one row with
what the model is and takes. A registry keeps them at ``<registry>/<name>/version=N``; a folder without a finished
entry is no model, so a writer that dies leaves nothing behind that a reader could take for one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import quote

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.functions.time import parse_compact_ts
from hourloom.operators import boosting, evaluate
from hourloom.operators.lookup import lookup
from hourloom.session import version_folders

TREES, BASELINE = "trees", "baseline"
ENTRY = "model_name string, model_version int, kind string, input_columns array<string>, params map<string,string>"
TRAINING = "series_id string, train_start string, train_end string"


class UnknownModel(LookupError):
    """No finished model of that name and version is registered."""


@dataclass(frozen=True)
class ModelSpec:
    name: str
    version: int

    @classmethod
    def parse(cls, text: str) -> ModelSpec:
        """``name/3``, the form that specs have on a command line."""
        name, slash, version = text.rpartition("/")
        if not (slash and name and version.isdecimal()):
            raise ValueError(f"a model is given as name/version, not {text!r}")
        return cls(name, int(version))

    def folder(self, registry: str) -> str:
        return f"{_folder(registry, self.name)}/version={self.version}"


def _folder(registry: str, name: str) -> str:
    return f"{registry.rstrip('/')}/{quote(name, safe='')}"


@dataclass(frozen=True)
class SavedModel:
    spec: ModelSpec
    kind: str
    input_columns: tuple[str, ...]
    model: PipelineModel | DataFrame
    training: DataFrame
    params: Mapping[str, str] = field(default_factory=dict)
    series: DataFrame | None = None

    def predict(self, df: DataFrame) -> DataFrame:
        """`df` with ``pred``."""
        if self.kind == BASELINE:
            return evaluate.predict_baseline(df, self.model, self.input_columns)
        return boosting.predict_gbt(self.model, df, self.series)

    def train_ends(self) -> DataFrame:
        """(series_id, ts): the last training step of each series."""
        return self.training.select("series_id", parse_compact_ts("train_end").alias("ts"))


def save_model(
    model: PipelineModel | DataFrame,
    path: str,
    input_columns: Sequence[str],
    training: DataFrame,
    params: Mapping[str, object] | None = None,
    spec: ModelSpec | None = None,
    series: DataFrame | None = None,
) -> None:
    """Write a model and its training parameters (series_id, train_start, train_end) to `path`, which must not hold one."""
    spark = training.sparkSession
    kind = BASELINE if isinstance(model, DataFrame) else TREES
    if kind == BASELINE:
        model.write.parquet(f"{path}/model")
    else:
        model.write().save(f"{path}/model")
    if series is not None:
        series.write.parquet(f"{path}/series")
    spec = spec or ModelSpec(path.rstrip("/").rsplit("/", 1)[-1], 1)
    named = (F.lit(spec.name).alias("model_name"), F.lit(spec.version).cast("int").alias("model_version"))
    training.select(*named, "series_id", "train_start", "train_end").write.parquet(f"{path}/training")
    texts = {k: str(v) for k, v in (params or {}).items()} | {"series_encoding": str(series is not None).lower()}
    row = (spec.name, spec.version, kind, list(input_columns), texts)
    spark.createDataFrame([row], ENTRY).coalesce(1).write.parquet(f"{path}/entry")


def load_model(spark: SparkSession, path: str) -> SavedModel:
    entry = spark.read.schema(ENTRY).parquet(f"{path}/entry").first()
    if entry.kind == BASELINE:
        model = spark.read.parquet(f"{path}/model")
    else:
        model = PipelineModel.load(f"{path}/model")
    series = spark.read.parquet(f"{path}/series") if entry.params["series_encoding"] == "true" else None
    training = spark.read.schema(TRAINING).parquet(f"{path}/training")
    spec = ModelSpec(entry.model_name, entry.model_version)
    return SavedModel(spec, entry.kind, tuple(entry.input_columns), model, training, entry.params, series)


def versions(spark: SparkSession, registry: str, name: str) -> list[int]:
    """The finished versions of a model, oldest first."""
    return version_folders(spark, _folder(registry, name), "entry/_SUCCESS")[0]


def registry_table(spark: SparkSession, registry: str, name: str) -> DataFrame:
    """(model_name, model_version, kind, input_columns, params, series_id, train_start, train_end) of all finished versions."""
    folders = [ModelSpec(name, v).folder(registry) for v in versions(spark, registry, name)]
    if not folders:
        return spark.createDataFrame([], f"{ENTRY}, {TRAINING}")
    key = ["model_name", "model_version"]
    entries = spark.read.schema(ENTRY).parquet(*[f"{f}/entry" for f in folders])
    ranges = spark.read.schema(f"model_name string, model_version int, {TRAINING}").parquet(*[f"{f}/training" for f in folders])
    return lookup(ranges, entries, key, how="inner").select(*entries.columns, "series_id", "train_start", "train_end")


def register_model(
    spark: SparkSession,
    registry: str,
    name: str,
    model: PipelineModel | DataFrame,
    input_columns: Sequence[str],
    training: DataFrame,
    params: Mapping[str, object] | None = None,
    series: DataFrame | None = None,
) -> ModelSpec:
    """Save a model as the next version of `name`. Versions are never written over: of two writers of one version the second fails."""
    finished, started = version_folders(spark, _folder(registry, name), "entry/_SUCCESS")
    spec = ModelSpec(name, max([0, *finished, *started]) + 1)
    save_model(model, spec.folder(registry), input_columns, training, params, spec, series)
    return spec


def find_model(spark: SparkSession, registry: str, spec: ModelSpec) -> SavedModel:
    if spec.version not in versions(spark, registry, spec.name):
        raise UnknownModel(f"{registry} has no {spec.name} of version {spec.version}")
    return load_model(spark, spec.folder(registry))


def predictions_of(models: Sequence[SavedModel], frame: DataFrame) -> DataFrame:
    """(model_name, model_version, input_columns, series_id, ts, d, pred) of every model for every row of `frame`.

    Each model adds a column to the same rows, which become one row a model at the end, so that the frame is read once
    however many models there are.
    """
    wide = frame
    for k, saved in enumerate(models):
        wide = saved.predict(wide).withColumnRenamed("pred", f"_pred_{k}")
    each = [
        F.struct(
            F.lit(saved.spec.name).alias("model_name"),
            F.lit(saved.spec.version).cast("int").alias("model_version"),
            F.array(*[F.lit(c) for c in saved.input_columns]).alias("input_columns"),
            F.col(f"_pred_{k}").cast("double").alias("pred"),
        )
        for k, saved in enumerate(models)
    ]
    rows = wide.select("series_id", "ts", "d", F.explode(F.array(*each)).alias("m"))
    return rows.select("m.model_name", "m.model_version", "m.input_columns", "series_id", "ts", "d", "m.pred")
