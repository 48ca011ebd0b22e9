"""Monitoring reports over observations, predictions and stored scores. Each is one or two aggregations."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from skygrain.functions.values import PHYSICAL_LIMITS, outside
from skygrain.plans.durable import materialize
from skygrain.plans.prefix import exact_quantiles, running_totals

# Goals drawn beside the stored scores.
R2_TARGET = 0.85
MAE_TARGETS = (("1", 2.0), ("3", 3.0))
MAE_TARGET_OTHER = 4.0
KS_SERIES_TERMS = 100
KS_EXACT_ROWS = 10_000  # samples of at most this size each get the exact p-value


# Drift and outliers --------------------------------------------------------------------------------------------


def ks_drift(current: DataFrame, reference: DataFrame, value: str, exact_rows: int = KS_EXACT_ROWS) -> DataFrame:
    """Two-sample Kolmogorov–Smirnov statistic and p-value."""
    return ks_drifts(current, reference, [value], exact_rows).drop("feature")


def ks_drifts(current: DataFrame, reference: DataFrame, values: Sequence[str], exact_rows: int = KS_EXACT_ROWS) -> DataFrame:
    """The statistic and p-value of several features, one row per feature, from one scan and one sort.

    The p-value is exact where neither sample has more than ``exact_rows`` values, else that of the limit distribution.

    Equal values are counted per feature and side first. The two distribution functions are then running totals over
    the distinct values, summed range by range, so no task sees a whole sorted sample. A feature without values on one
    side has null scores.
    """

    def side(df: DataFrame, a: int, b: int) -> DataFrame:
        each = F.inline(F.array(*[
            F.struct(F.lit(v).alias("feature"), F.col(v).cast("double").alias("_v")) for v in values]))
        return df.select(each).filter(F.col("_v").isNotNull()).select(
            "feature", "_v", F.lit(a).alias("_a"), F.lit(b).alias("_b"))

    counts = (
        side(current, 1, 0).unionByName(side(reference, 0, 1))
        .groupBy("feature", "_v").agg(F.sum("_a").alias("a"), F.sum("_b").alias("b"))
    )
    ranked = running_totals(counts, ["feature"], ["_v"], ["a", "b"], unique=True)
    gap = F.abs(
        F.try_divide(F.col("a_before") + F.col("a"), F.col("a_total"))
        - F.try_divide(F.col("b_before") + F.col("b"), F.col("b_total"))
    )
    of = lambda v, x: F.max(F.when(F.col("feature") == v, x))
    stats = ranked.agg(*[
        F.struct(F.lit(v).alias("feature"), of(v, gap).alias("ks_score"), of(v, F.col("a_total")).alias("current_rows"),
                 of(v, F.col("b_total")).alias("reference_rows")).alias(f"_{i}")
        for i, v in enumerate(values)
    ]).select(F.inline(F.array(*[f"_{i}" for i in range(len(values))])))
    n, m = F.col("current_rows"), F.col("reference_rows")
    small = F.greatest(n, m) <= exact_rows
    exact = ks_exact(F.when(small, n), F.when(small, m), F.when(small, F.col("ks_score")))
    scored = F.when(F.col("ks_score").isNotNull(), F.when(small, exact).otherwise(ks_p_value()) if exact_rows else ks_p_value())
    return stats.withColumn("p_value", scored).withColumn("method", F.lit("ks_test"))


def ks_p_value() -> Column:
    """Kolmogorov's limit series at the effective sample size."""
    n, m = F.col("current_rows"), F.col("reference_rows")
    x2 = F.col("ks_score") * F.col("ks_score") * n * m / (n + m)
    terms = F.sequence(F.lit(1), F.lit(KS_SERIES_TERMS))
    series = F.aggregate(
        terms, F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * x2),
    )
    return F.when(x2 < 0.04, 1.0).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))


def ks_exact_p(n: int, m: int, score: float) -> float:
    """Chance that two samples of one distribution differ by ``score`` or more, by counting lattice paths.

    A merged order of both samples is a path from (0, 0) to (n, m); its distance is below the score if it stays where
    ``abs(i m - j n)`` is below the score times n m. Paths that do are counted row by row as running sums over the band's
    columns, with each row scaled by its largest count.
    """
    limit = round(score * n * m)  # the score is a difference of fractions with these denominators
    if limit <= 0:
        return 1.0
    row, log_scale = np.zeros(m + 1), 0.0
    row[0] = 1.0
    for i in range(n + 1):
        low = max(0, -(-(i * m - limit + 1) // n))
        high = min(m, (i * m + limit - 1) // n)
        if low > high:
            return 1.0
        inside = np.cumsum(row[low : high + 1])
        top = inside[-1]
        if top == 0:
            return 1.0
        row[:] = 0.0
        row[low : high + 1] = inside / top
        log_scale += math.log(top)
    paths = math.log(row[m]) + log_scale if row[m] > 0 else -math.inf
    orders = math.lgamma(n + m + 1) - math.lgamma(n + 1) - math.lgamma(m + 1)
    return min(1.0, max(0.0, -math.expm1(min(0.0, paths - orders))))


@F.pandas_udf(T.DoubleType())
def ks_exact(n: pd.Series, m: pd.Series, score: pd.Series) -> pd.Series:
    """``ks_exact_p`` of each row (one row per feature); null where an argument is null."""
    return pd.Series([None if pd.isna(s) or pd.isna(a) or pd.isna(b) else ks_exact_p(int(a), int(b), float(s))
                      for a, b, s in zip(n, m, score)], dtype="float64")


def mean_drift(current: DataFrame, reference: DataFrame, value: str) -> DataFrame:
    """Absolute difference of the means, as a stand-in for the test statistic."""
    a = current.select(F.col(value).cast("double").alias("a"), F.lit(None).cast("double").alias("b"))
    b = reference.select(F.lit(None).cast("double").alias("a"), F.col(value).cast("double").alias("b"))
    return a.unionByName(b).agg(
        F.abs(F.avg("a") - F.avg("b")).alias("ks_score"),
        F.lit(0.0).alias("p_value"),
        F.lit("mean_diff_fallback").alias("method"),
    )


def zscore_outliers(df: DataFrame, value: str, threshold: float = 3.0) -> DataFrame:
    """Rows further than ``threshold`` population standard deviations from the mean: count and percentage."""
    x = F.col(value)
    stats = df.agg(F.avg(x).alias("m"), F.stddev_pop(x).alias("s"))
    mean, std = stats.select("m").scalar(), stats.select("s").scalar()
    out = F.count_if((std > 0) & (F.abs((x - mean) / std) > threshold))
    return df.agg(
        out.alias("outlier_count"),
        F.coalesce(out * 100.0 / F.nullif(F.count(x), F.lit(0)), F.lit(0.0)).alias("outlier_pct"),
        F.lit(float(threshold)).alias("threshold"),
    )


# Completeness and ranges ---------------------------------------------------------------------------------------


def schema_check(messages: DataFrame, expected: Sequence[str], value: str = "value") -> DataFrame:
    """Which expected fields occur in any of the JSON messages: missing list, valid flag, percentage present."""
    want = F.array(*[F.lit(f) for f in expected])
    found = (
        messages.select(F.explode(F.array_intersect(F.json_object_keys(value), want)).alias("field"))
        .groupBy("field").agg(F.count(F.lit(1)).alias("n"))
        .agg(F.collect_set("field").alias("present"), F.coalesce(F.max("n"), F.lit(0)).alias("most_common"))
    )
    missing = F.array_except(want, "present")
    return found.select(
        (F.size(missing) == 0).alias("is_valid"),
        F.array_join(missing, ",").alias("missing_fields"),
        ((1 - F.size(missing) / F.lit(float(max(len(expected), 1)))) * 100).alias("completeness"),
        "most_common",
    )


def missing_rates(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """Share of nulls per column, one pass."""
    rates = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns])
    long = rates.withColumn("_k", F.lit(0)).unpivot(["_k"], df.columns, "column_name", "missing_rate").drop("_k")
    return long.filter(F.col("missing_rate") > 0) if only_missing else long


def range_violations(df: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    """Rows outside the physical range, for temperature, humidity and wind speed where present.

    ``columns`` maps a variable to the column that holds it (for example temperature to temperature_prediction).
    """
    at = columns or {v: v for v in ("temperature", "humidity", "wind_speed")}
    present = {v: c for v, c in at.items() if c in df.columns and v in PHYSICAL_LIMITS}
    counts = df.agg(*[F.count_if(outside(F.col(c), v)).alias(v) for v, c in present.items()])
    return counts.withColumn("_k", F.lit(0)).unpivot(["_k"], list(present), "variable", "violations").drop("_k")


# Predictions ---------------------------------------------------------------------------------------------------


def main_prediction(df: DataFrame) -> DataFrame:
    """Point forecast, else the median forecast, else null."""
    source = next((c for c in ("temperature_prediction", "temperature_p50") if c in df.columns), None)
    return df.withColumn("main_prediction", F.col(source) if source else F.lit(None).cast("double"))


def stability(df: DataFrame, value: str = "main_prediction") -> DataFrame:
    """Population standard deviation of the predictions, 0 for fewer than two."""
    return df.agg(F.when(F.count(value) < 2, 0.0).otherwise(F.stddev_pop(value)).alias("stability"))


def cross_horizon_consistency(df: DataFrame, keys: Sequence[str], recency: str, limit: float = 10.0,
                              value: str = "main_prediction") -> DataFrame:
    """Per event: do neighbouring horizons differ by at most ``limit``? The newest prediction of a horizon counts.

    Predictions are first reduced to one per (event, horizon), so a group is as small as its number of horizons.
    """
    newest = df.groupBy(*keys, "horizon_hours").agg(F.max_by(value, recency).alias("_p"))
    step = F.abs(F.col("_p") - F.lag("_p").over(Window.partitionBy(*keys).orderBy("horizon_hours")))
    return newest.withColumn("_step", step).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("horizons"),
        F.coalesce(F.bool_and(F.col("_step") <= limit), F.lit(True)).alias("is_consistent"),
    )


def confidence_intervals(df: DataFrame, value: str = "main_prediction") -> DataFrame:
    """P10, P50 and P90 with linear interpolation, zeros for an empty sample."""
    q = exact_quantiles(df, value, {"p10": 0.1, "p50": 0.5, "p90": 0.9})
    return q.select(*[F.coalesce(c, F.lit(0.0)).alias(c) for c in q.columns])


def throughput(df: DataFrame, minutes: int = 15) -> DataFrame:
    n = F.count(F.lit(1))
    return df.agg(n.alias("message_count"), (n / F.lit(float(minutes))).alias("per_minute"))


def stream_status(df: DataFrame) -> DataFrame:
    return df.agg(F.when(F.count(F.lit(1)) > 0, "OK").otherwise("STOP").alias("status"))


def per_minute_counts(df: DataFrame, time: str = "created_at", since: Column | None = None,
                      until: Column | None = None) -> DataFrame:
    """Messages per minute from the first to the last minute, with zeros for empty minutes.

    ``since`` and ``until`` (included) bound the report, so that a stray time cannot stretch it over centuries. One
    scan: the counts per minute are combined, written, and also give the two ends; the minutes come from a distributed
    range.
    """
    minute = F.floor(F.unix_micros(F.col(time).cast("timestamp")) / F.lit(60_000_000)).cast("long")
    rows = df.filter(F.col(time).isNotNull())
    if since is not None:
        rows = rows.filter(F.col(time) >= since)
    if until is not None:
        rows = rows.filter(F.col(time) <= until)
    counts = materialize(
        rows.groupBy(minute.alias("minute_no")).agg(F.count(F.lit(1)).alias("n")), "minute-counts")
    ends = counts.agg(F.min("minute_no").alias("lo"), F.max("minute_no").alias("hi")).first()
    if ends["lo"] is None:
        return counts.select(F.lit(None).cast("timestamp").alias("minute"), "n").limit(0)
    every = df.sparkSession.range(ends["lo"], ends["hi"] + 1).withColumnRenamed("id", "minute_no")
    return every.join(counts, "minute_no", "left").select(
        F.timestamp_seconds(F.col("minute_no") * 60).alias("minute"), F.coalesce("n", F.lit(0)).alias("message_count")
    )


def median_latency(df: DataFrame, event: str = "event_time", created: str = "created_at") -> DataFrame:
    """Median seconds from event to prediction."""

    def seconds(c: str) -> Column:
        return F.unix_micros(F.col(c).cast("timestamp")) / F.lit(1e6)

    lat = df.select((seconds(created) - seconds(event)).alias("_lat"))
    return exact_quantiles(lat, "_lat", {"median_latency_sec": 0.5})


def horizon_distribution(df: DataFrame, value: str = "main_prediction") -> DataFrame:
    """Box-plot figures of the predictions per horizon."""
    probs = {"minimum": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "maximum": 1.0}
    return exact_quantiles(df, value, probs, by=["horizon_hours"])


def distribution_histogram(current: DataFrame, reference: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Counts per bin of equal width for both samples, over their common range."""
    both = current.select(F.lit("current").alias("side"), F.col(value).alias("v")).unionByName(
        reference.select(F.lit("reference").alias("side"), F.col(value).alias("v"))
    ).filter(F.col("v").isNotNull())
    ends = both.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    span = F.when(hi > lo, hi - lo).otherwise(F.lit(1.0))
    slot = F.least(F.floor((F.col("v") - lo) / span * bins), F.lit(bins - 1)).cast("int")
    return both.groupBy("side", slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


# Stored scores -------------------------------------------------------------------------------------------------


def offline_scores(performance: DataFrame) -> DataFrame:
    return performance.select("horizon", "test_mae", "test_r2")


def r2_vs_target(performance: DataFrame) -> DataFrame:
    r2 = F.greatest(F.least(F.coalesce("test_r2", F.lit(0.0)), F.lit(1.0)), F.lit(-1.0))
    return performance.select("horizon", r2.alias("r2_test"), F.lit(R2_TARGET).alias("target"))


def mae_vs_target(performance: DataFrame) -> DataFrame:
    target = F.lit(MAE_TARGET_OTHER)
    for prefix, goal in reversed(MAE_TARGETS):
        target = F.when(F.col("horizon").startswith(prefix), goal).otherwise(target)
    return performance.select("horizon", F.coalesce("test_mae", F.lit(0.0)).alias("mae"), target.alias("target"))


def compare_models(left: DataFrame, right: DataFrame, names: tuple[str, str]) -> DataFrame:
    """Test MAE of two models by horizon; the second is null where it has no such horizon."""
    a = left.select("horizon", F.coalesce("test_mae", F.lit(0.0)).alias(names[0]))
    return a.join(right.select("horizon", F.col("test_mae").alias(names[1])), "horizon", "left")
