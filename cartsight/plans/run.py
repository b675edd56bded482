"""Stages of a whole run, and the run itself.

Each stage takes and returns DataFrames. With an output folder every stage is stored as Parquet and
the next one reads it back, so a stage can be run again alone and a lost executor never costs more
than the current stage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartsight.operators.features import build_features
from cartsight.operators.sessions import sessions_by_gap
from cartsight.operators.split import SplitEnds, assert_no_leakage, ends_of, temporal_split
from cartsight.params import Params
from cartsight.plans import training
from cartsight.sources.tables import read_table, run_folder, settle, write_table

SPLIT_KEYS = ("split", "user_id")


@dataclass
class RunResult:
    sessions: DataFrame
    split: DataFrame
    features: DataFrame
    metrics: DataFrame | None = None
    models: dict[str, PipelineModel] | None = None


def _stored(df: DataFrame, out_dir: str | None, name: str, partition_by: tuple = ()) -> DataFrame:
    if out_dir is None:
        return settle(df)
    path = f"{out_dir}/{name}"
    write_table(df, path, partition_by=partition_by)
    return read_table(df.sparkSession, path)


def sessionize_stage(events: DataFrame, params: Params, out_dir: str | None = None) -> DataFrame:
    return _stored(
        sessions_by_gap(events, params.session, params.skew), out_dir, "sessionized_events"
    )


def split_stage(
    sessions: DataFrame, params: Params, out_dir: str | None = None, ends: SplitEnds | None = None
) -> DataFrame:
    ends = ends or ends_of(sessions, params.split)
    split = _stored(temporal_split(sessions, ends), out_dir, "split_events", ("split",))
    assert_no_leakage(split, ends)
    return split


def feature_stage(
    split: DataFrame, catalog: DataFrame, params: Params, out_dir: str | None = None
) -> DataFrame:
    """Features of all splits in one pass; each split sees only its own events."""
    features = build_features(split, catalog, SPLIT_KEYS, params.feature, params.skew)
    return _stored(features, out_dir, "features", ("split",))


def part(features: DataFrame, name: str) -> DataFrame:
    return features.where(F.col("split") == name).drop("split")


def train_stage(
    features: DataFrame, params: Params, out_dir: str | None = None
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """Both models fitted on train, measured on every split; models and predictions stored."""
    train, val = part(features, "train"), part(features, "val")
    models = {
        "logistic": training.fit_linear(train, params.model),
        "boosted": training.fit_boosted(train, val, params.model),
    }
    metrics = None
    for name, model in models.items():
        if out_dir:
            training.save_model(model, f"{out_dir}/models/{name}")
        for split in ("train", "val", "test"):
            scored = _stored(
                training.predict(model, part(features, split)),
                out_dir,
                f"predictions/{name}/{split}",
            )
            rows = training.evaluate(scored, name, params.score).withColumn("split", F.lit(split))
            metrics = rows if metrics is None else metrics.unionByName(rows)
    return models, metrics


def run(
    spark: SparkSession,
    events: DataFrame,
    catalog: DataFrame,
    params: Params = Params(),
    out_dir: str | None = None,
    train: bool = True,
    ends: SplitEnds | None = None,
) -> RunResult:
    """Events and catalog to sessions, split, features and, on request, models and metrics.

    With an output folder the intermediate tables go to a folder of the run's own, which is removed at the end.
    """

    def stages() -> RunResult:
        sessions = sessionize_stage(events, params, out_dir)
        split = split_stage(sessions, params, out_dir, ends)
        result = RunResult(sessions, split, feature_stage(split, catalog, params, out_dir))
        if train:
            result.models, result.metrics = train_stage(result.features, params, out_dir)
        return result

    if out_dir is None:
        return stages()
    with run_folder(spark):
        result = stages()
        if result.metrics is not None:
            result.metrics = _stored(result.metrics, out_dir, "metrics")
    return result
