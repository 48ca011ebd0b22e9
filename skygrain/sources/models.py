"""Saved models: one pipeline per horizon and the ordered feature columns."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from skygrain.sources.schemas import HORIZONS
from skygrain.sources.tables import read_if_there


def _model_path(directory: str, horizon: int) -> str:
    return f"{directory.rstrip('/')}/weather_model_{horizon}h"


def save_models(spark: SparkSession, models: Mapping[int, PipelineModel], features: Sequence[str], directory: str,
                kind: str = "random_forest") -> None:
    for horizon, model in models.items():
        model.write().overwrite().save(_model_path(directory, horizon))
    line = json.dumps({"feature_columns": list(features), "model_type": kind})
    spark.createDataFrame([(line,)], "value STRING").coalesce(1).write.mode("overwrite").text(
        f"{directory.rstrip('/')}/model_metadata")


def load_models(spark: SparkSession, directory: str) -> dict[int, tuple[PipelineModel, list[str]]]:
    """Models by horizon with their columns. A horizon that was never saved is left out.

    No model at all, no columns, or a model that is there but cannot be read is an error.
    """
    metadata = read_if_there(spark, f"{directory.rstrip('/')}/model_metadata", "text")
    if metadata is None:
        raise FileNotFoundError(f"no model metadata in {directory}")
    features = json.loads(metadata.first()["value"]).get("feature_columns", [])
    if not features:
        raise ValueError("the model metadata names no feature columns")
    models = {}
    for horizon in HORIZONS:
        if read_if_there(spark, f"{_model_path(directory, horizon)}/metadata", "text") is not None:
            models[horizon] = (PipelineModel.load(_model_path(directory, horizon)), features)
    if not models:
        raise FileNotFoundError(f"no models in {directory}")
    return models
