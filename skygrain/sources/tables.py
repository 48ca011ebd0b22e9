"""Batch tables: landed hourly archives, datasets, metrics and exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

# File names of a saved dataset.
PARQUET_NAME, CSV_NAME = "weather_features.parquet", "weather_features.csv"
HOURLY_NAMES = {
    "temperature": "temperature_2m", "humidity": "relative_humidity_2m", "wind_speed": "wind_speed_10m",
    "pressure": "pressure_msl", "cloud_cover": "cloud_cover", "precipitation": "precipitation",
}


def explode_hourly(df: DataFrame, keep: Sequence[str] = (), sort: bool = False) -> DataFrame:
    """A struct of parallel arrays to one row per hour, renamed, with a parsed time (null where it cannot be read)."""
    arrays = [F.coalesce(F.col(f"hourly.{c}"), F.array()).alias(c) for c in HOURLY_NAMES.values()]
    zipped = F.arrays_zip(F.col("hourly.time"), *arrays)
    rows = df.select(*keep, F.inline(zipped).alias("time", *HOURLY_NAMES.values()))
    out = rows.select(
        *keep, F.col("time").try_cast("timestamp_ntz").alias("timestamp"),
        *[F.col(c).alias(n) for n, c in HOURLY_NAMES.items()],
    )
    return out.orderBy("timestamp") if sort else out


def read_if_there(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame | None:
    """What is stored at ``path``, or None where nothing is. A store that cannot be read is an error."""
    try:
        return spark.read.format(kind).load(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def load_existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The saved Parquet dataset, or None where there is none."""
    df = read_if_there(spark, path)
    if df is None:
        return None
    if "timestamp" in df.columns and dict(df.dtypes)["timestamp"] not in ("timestamp", "timestamp_ntz"):
        df = df.withColumn("timestamp", F.col("timestamp").try_cast("timestamp"))
    return df


def save_dataset(df: DataFrame, directory: str) -> tuple[str, str]:
    """Write the rows as snappy Parquet and as CSV with a header; returns both paths."""
    parquet, csv = f"{directory.rstrip('/')}/{PARQUET_NAME}", f"{directory.rstrip('/')}/{CSV_NAME}"
    df.write.mode("overwrite").option("compression", "snappy").parquet(parquet)
    # The CSV is written from the saved rows, so the plan runs once.
    saved = df.sparkSession.read.schema(df.schema).parquet(parquet)
    saved.write.mode("overwrite").option("header", True).csv(csv)
    return parquet, csv


def save_metrics_json(performance: DataFrame, completeness: DataFrame, directory: str) -> None:
    """Model scores and feature completeness as JSON (one row per horizon, one per feature)."""
    performance.coalesce(1).write.mode("overwrite").json(f"{directory.rstrip('/')}/model_performance")
    pct = completeness.withColumn("completeness_pct", F.bround("completeness_pct", 2))
    pct.coalesce(1).write.mode("overwrite").json(f"{directory.rstrip('/')}/data_quality")


def load_performance(spark: SparkSession, directory: str) -> DataFrame:
    schema = "horizon STRING, train_mae DOUBLE, train_rmse DOUBLE, train_r2 DOUBLE, test_mae DOUBLE, test_rmse DOUBLE, test_r2 DOUBLE"
    return spark.read.schema(schema).json(f"{directory.rstrip('/')}/model_performance")


def export_window_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
