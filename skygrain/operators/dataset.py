"""Training datasets: flatten feature records, merge with what exists, keep the last duplicate, add targets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from skygrain.functions import series as S
from skygrain.operators.features import over_history
from skygrain.sources.schemas import OBSERVED

# Column names of the flat dataset and decimals of the documented rounding.
FLAT_BASE = {
    "temperature": "temp_current", "humidity": "humidity_current", "wind_speed": "wind_current",
    "pressure": "pressure_current", "cloud_cover": "cloud_cover_current", "precipitation": "precipitation_current",
}
ROUNDING = {
    "temperature": 2, "humidity": 1, "wind_speed": 2, "pressure": 1, "cloud_cover": 1, "precipitation": 3,
}
SOURCE, EXISTING, NEW = "_source", 0, 1


def _leaves(root: str, names: Mapping[str, str]) -> list[Column]:
    return [F.col(f"{root}.{leaf}").alias(name) for name, leaf in names.items()]


def flatten_features(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Nested feature records to the 39 flat dataset columns; a null group gives null columns."""
    h = "historical_features"
    stats = ("mean", "std", "min", "max")
    cols = [
        F.col("timestamp"),
        *_leaves("location", {n: n for n in ("latitude", "longitude", "elevation")}),
        *_leaves("base_features", FLAT_BASE),
        *_leaves("cyclical_features", {n: n for n in
                                       ("hour_sin", "hour_cos", "day_sin", "day_cos", "is_day", "is_weekend")}),
    ]
    for n in (3, 6):
        cols += _leaves(f"{h}.temp_rolling_{n}h", {f"temp_{s}_{n}h": f"{s}_{n}h" for s in stats})
    cols += _leaves(f"{h}.temp_deltas", {f"temp_delta_{n}h": f"delta_{n}h" for n in (1, 3, 6, 12)})
    cols += _leaves(h, {n: n for n in ("temp_roc_3h", "temp_roc_6h")})
    cols += _leaves(f"{h}.temp_lags", {f"temp_lag_{n}h": f"lag_{n}h" for n in (1, 2, 3, 6, 12)})
    cols += _leaves(h, {"temp_volatility_6h": "temp_volatility_6h"})
    cols += _leaves("target_labels", {f"target_temp_{n}h": f"temp_target_{n}h" for n in (1, 3, 6)})
    return records.select(*keep, *cols)


def build_dataset_frame(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Flat rows with a parsed timestamp, sorted by it. A time that cannot be read gives null and does not stop the job."""
    flat = flatten_features(records, keep)
    return flat.withColumn("timestamp", F.col("timestamp").try_cast("timestamp")).orderBy("timestamp", *keep)


def add_target(df: DataFrame, horizon: int, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Temperature ``horizon`` rows later as ``target_temperature_horizon_{h}h``."""
    if "temperature" not in df.columns:
        raise ValueError("a temperature column is needed to build targets")
    name = f"target_temperature_horizon_{int(horizon)}h"

    def columns(w):
        return {name: S.lead(F.col("temperature"), int(horizon), w)}

    return over_history(df.drop(name), keys, order, columns, 0, int(horizon))


def target_validity(df: DataFrame, target: str) -> DataFrame:
    return df.agg(
        F.count(target).alias("valid_targets"), (F.count(F.lit(1)) - F.count(target)).alias("null_targets")
    )


def union_datasets(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    """Existing and new rows by column name; a column that one side lacks is null there."""
    tagged = new.withColumn(SOURCE, F.lit(NEW))
    if existing is None:
        return tagged
    return existing.withColumn(SOURCE, F.lit(EXISTING)).unionByName(tagged, allowMissingColumns=True)


def dedup_keep_last(df: DataFrame, order: Sequence[str], columns: Sequence[str] = OBSERVED,
                    rounding: Mapping[str, int] | None = None, extra_keys: Sequence[str] = ()) -> DataFrame:
    """One row per distinct combination of the compared columns: the last by ``order``.

    Only the first row of each group leaves an input partition, so many copies of one row do not pile up in a task.
    """
    present = [c for c in columns if c in df.columns] or ["timestamp"]
    key = [F.round(c, rounding[c]) if rounding and c in rounding else F.col(c) for c in present]
    w = Window.partitionBy(*key, *extra_keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def merge_datasets(existing: DataFrame | None, new: DataFrame, time: str = "timestamp", tie: Sequence[str] = (),
                   rounding: Mapping[str, int] | None = None, extra_keys: Sequence[str] = ()) -> DataFrame:
    """Union, keep the last duplicate (new beats old), sort by time. If one side is empty the other passes as is."""
    if existing is None or existing.isEmpty():
        return new
    if new.isEmpty():
        return existing
    both = union_datasets(existing, new)
    order = [SOURCE, time, *tie]
    return dedup_keep_last(both, order, rounding=rounding, extra_keys=extra_keys).drop(SOURCE).orderBy(time, *tie)


def dataset_period(df: DataFrame, time: str = "timestamp") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.min(time).alias("period_start"), F.max(time).alias("period_end"))
