"""Model input: ordered features, time-ordered splits, scaling and sequences."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec, functions as F

from skygrain.plans.prefix import running_totals
from skygrain.plans.skew import GROUP_ROWS, ROW_NO, ordered_rows
from skygrain.sources.schemas import HORIZONS, MODEL_FEATURES


def prepare_features(df: DataFrame, keep: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """(rows without nulls in features or targets, the model features present in their fixed order)."""
    features = [c for c in MODEL_FEATURES if c in df.columns]
    targets = [f"target_temperature_{h}h" for h in HORIZONS if f"target_temperature_{h}h" in df.columns]
    return df.select(*keep, *features, *targets).na.drop("any", subset=[*features, *targets]), features


def temporal_split(df: DataFrame, keys: Sequence[str], order: Sequence[str], fraction: float = 0.8) -> DataFrame:
    """Add ``is_train``: the first ⌊fraction·n⌋ rows by time, per key, or over all rows when ``keys`` is empty."""
    if not keys:
        ranked = running_totals(df.withColumn("_one", F.lit(1)), [], order, ["_one"])
        train = F.col("_one_before") < F.floor(F.col("_one_total") * F.lit(fraction))
        return ranked.withColumn("is_train", train).drop("_one", "_one_before", "_one_total")

    def build(rows: DataFrame, _: WindowSpec) -> DataFrame:
        return rows.withColumn("is_train", F.col(ROW_NO) <= F.floor(F.col(GROUP_ROWS) * F.lit(fraction)))

    return ordered_rows(df, keys, order, build, numbered=True)


# Scaling -------------------------------------------------------------------------------------------------------


def minmax_fit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the smallest and largest value of each column."""
    return df.agg(
        *[F.min(c).cast("double").alias(f"{c}_min") for c in columns],
        *[F.max(c).cast("double").alias(f"{c}_max") for c in columns],
    )


def _span(fit: DataFrame, column: str) -> tuple[Column, Column]:
    low = fit.select(f"{column}_min").scalar()
    high = fit.select(f"{column}_max").scalar()
    return low, F.when(high > low, high - low).otherwise(F.lit(1.0))


def minmax_transform(df: DataFrame, fit: DataFrame, columns: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """(x − min) / (max − min), and 0 for a constant column. The fit is read as scalars: no join, no collect.

    A mapping names the fitted column for each column to scale.
    """
    sources = columns if isinstance(columns, Mapping) else {c: c for c in columns}
    scaled = {}
    for c, source in sources.items():
        low, span = _span(fit, source)
        scaled[c] = (F.col(c) - low) / span
    return df.withColumns(scaled)


def minmax_inverse(df: DataFrame, fit: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Undo the scaling; ``columns`` maps a scaled column to the fitted column it came from."""
    back = {}
    for c, source in columns.items():
        low, span = _span(fit, source)
        back[c] = F.col(c) * span + low
    return df.withColumns(back)


# Sequences -----------------------------------------------------------------------------------------------------


def sequences(df: DataFrame, keys: Sequence[str], order: Sequence[str], features: Sequence[str], target: str,
              timesteps: int = 24, horizons: Sequence[int] = (1,)) -> DataFrame:
    """Per key: ``timesteps`` consecutive rows as ``x`` and the target ``h`` rows after the last as ``y``.

    ``y`` is an array over ``horizons``. ``sequence_no`` counts from 0 and ``sequence_count`` is the key's number of
    sequences. The rows stay in arrays, so the data grows by ``timesteps`` only once.
    """
    far = max(horizons)

    def build(rows: DataFrame, w: WindowSpec) -> DataFrame:
        frame = w.rowsBetween(-(timesteps - 1), 0)
        out = rows.withColumns(
            {
                "x": F.collect_list(F.struct(*features)).over(frame),
                "y": F.array(*[F.lead(target, h).over(w) for h in horizons]),
                "sequence_no": F.col(ROW_NO) - timesteps,
                "sequence_count": F.greatest(F.col(GROUP_ROWS) - timesteps - far + 1, F.lit(0)),
            }
        )
        return out.filter((F.col("sequence_no") >= 0) & (F.col("sequence_no") < F.col("sequence_count")))

    done = ordered_rows(df, keys, order, build, timesteps - 1, far, numbered=True)
    return done.select(*keys, *order, "sequence_no", "sequence_count", "x", "y")


def sequence_split(seqs: DataFrame, fraction: float = 0.8) -> DataFrame:
    """Add ``is_train``: the first ⌊fraction·n⌋ sequences of each key."""
    return seqs.withColumn("is_train", F.col("sequence_no") < F.floor(F.col("sequence_count") * F.lit(fraction)))


def require_sequences(seqs: DataFrame) -> DataFrame:
    if seqs.isEmpty():
        raise ValueError("not enough rows for a sequence")
    return seqs


# Metrics -------------------------------------------------------------------------------------------------------


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE and R² in one pass; the spread of the actual values is accumulated around the mean."""
    y, p = F.col(actual), F.col(predicted)
    both = y.isNotNull() & p.isNotNull()
    sse = F.sum((y - p) * (y - p))
    sst = F.var_pop(y) * F.count(F.lit(1))
    r2 = F.when(sst > 0, 1 - sse / sst).otherwise(F.when(sse == 0, 1.0).otherwise(0.0))
    return df.filter(both).groupBy(*by).agg(
        F.avg(F.abs(y - p)).alias("mae"), F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"), r2.alias("r2")
    )


def feature_completeness(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Per feature: non-null values, rows and percentage; one pass, then one row per feature."""
    present = [c for c in features if c in df.columns]
    counts = df.agg(F.count(F.lit(1)).alias("total"), *[F.count(c).alias(c) for c in present])
    long = counts.unpivot(["total"], present, "feature", "non_null").filter(F.col("total") > 0)
    return long.select("feature", "non_null", "total", (F.col("non_null") * 100.0 / F.col("total")).alias("completeness_pct"))
