"""Batch jobs: build or recover a dataset, train and store the models."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from skygrain.operators import dataset as D
from skygrain.operators.features import engineer_features_batch
from skygrain.operators.filters import physical_range_filter
from skygrain.operators.samples import feature_completeness
from skygrain.operators.topics import bounded_read
from skygrain.operators.training import train_all_horizons, training_frame
from skygrain.plans.durable import fresh_path, freed, remove
from skygrain.sources.models import save_models
from skygrain.sources.schemas import OBSERVED
from skygrain.sources.tables import PARQUET_NAME, load_existing, save_dataset, save_metrics_json

PLACE = ("latitude", "longitude")


def build_dataset(messages: DataFrame, output: str, horizon: int = 3, existing: str | None = None,
                  max_messages: int | None = None,
                  order: Sequence[str] = ("timestamp", "partition", "offset")) -> tuple[str, DataFrame]:
    """Feature messages to a saved dataset with a target: (folder written, report).

    ``existing`` is the folder of an earlier dataset to merge with. The result goes to a new folder below ``output``
    because a job must not overwrite what it reads. Every message is read unless ``max_messages`` limits them.
    """
    records = bounded_read(messages, "features", max_messages, order)
    return _finish(records, output, horizon, existing)


def recover_dataset(messages: DataFrame, output: str, horizon: int = 3, existing: str | None = None) -> tuple[str, DataFrame]:
    """The same from every retained message, with the period covered."""
    folder, _ = build_dataset(messages, output, horizon, existing, None)
    return folder, D.dataset_period(_saved(messages.sparkSession, folder))


def _saved(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{PARQUET_NAME}")


def _finish(records: DataFrame, output: str, horizon: int, existing: str | None) -> tuple[str, DataFrame]:
    spark = records.sparkSession
    # Written once: the checks and the merge below must not parse the messages again.
    path, frame = fresh_path(spark, "dataset"), D.build_dataset_frame(records.select("record.*"))
    with freed(spark):
        frame.write.option("compression", "zstd").parquet(path)
    new = spark.read.schema(frame.schema).parquet(path)
    if new.isEmpty():
        remove(spark, path)
        raise ValueError("no valid feature message to build a dataset from")
    old = load_existing(spark, f"{existing}/{PARQUET_NAME}") if existing else None
    merged = D.merge_datasets(old, new, tie=PLACE)
    done = D.add_target(merged, horizon, PLACE, ["timestamp", *OBSERVED])
    folder = f"{output.rstrip('/')}/{uuid.uuid4().hex}"
    with freed(spark):
        save_dataset(done, folder)
    remove(spark, path)
    saved = _saved(spark, folder)
    report = D.target_validity(saved, f"target_temperature_horizon_{horizon}h")
    return folder, report.withColumn(
        "unreadable_times", saved.agg(F.count_if(F.col("timestamp").isNull()).alias("n")).scalar())


def train_models(hourly: DataFrame, directory: str, keys: Sequence[str], order: Sequence[str], time: str,
                 kind: str = "random_forest", **overrides) -> DataFrame:
    """Hourly rows to saved models, scores and completeness; returns the scores."""
    featured = engineer_features_batch(physical_range_filter(hourly), keys, order, time, targets=True)
    frame, features = training_frame(featured, keys, order)
    models, scores = train_all_horizons(frame, features, kind, **overrides)
    save_models(hourly.sparkSession, models, features, directory, kind)
    save_metrics_json(scores, feature_completeness(featured, features), directory)
    return scores
