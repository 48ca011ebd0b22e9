"""Tumbling windows per location, and their joins into hourly features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from skygrain.plans.durable import materialize

PLACE = ("latitude", "longitude")


def first_last(value: str, arrival: str) -> tuple[Column, Column]:
    """First and last value by arrival, nulls ignored."""
    has = F.col(value).isNotNull()
    at = F.when(has, F.col(arrival))
    return F.min_by(value, at), F.max_by(value, at)


def window_aggregates(hours: int, arrival: str, extras: bool) -> list[Column]:
    first, last = first_last("temperature", arrival)
    h = f"{hours}h"
    aggs = [
        F.avg("temperature").alias(f"temp_mean_{h}"),
        F.stddev_samp("temperature").alias(f"temp_std_{h}"),
        F.min("temperature").alias(f"temp_min_{h}"),
        F.max("temperature").alias(f"temp_max_{h}"),
    ]
    if extras:
        aggs += [F.avg("humidity").alias(f"humidity_mean_{h}"), F.avg("wind_speed").alias(f"wind_mean_{h}")]
    return [*aggs, last.alias("temp_last"), first.alias("temp_first")]


def tumbling(df: DataFrame, hours: int, keys: Sequence[str] = PLACE, time: str = "event_time", arrival: str = "id",
             watermark: str | None = None, keep_window: bool = False) -> DataFrame:
    """Temperature aggregates per place and window; the 1-hour window adds humidity and wind means.

    Sums are combined before the shuffle, so a hot place costs no more than its number of windows. Pass ``watermark``
    on a stream (required for append output).
    """
    src = watermarked(df, time, watermark) if watermark else df
    agg = src.groupBy(*keys, F.window(time, f"{hours} hours")).agg(*window_aggregates(hours, arrival, hours == 1))
    rest = [c for c in agg.columns if c not in (*keys, "window")]
    bounds = [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]
    return agg.select(*keys, *(["window"] if keep_window else []), *bounds, *rest)


def watermarked(df: DataFrame, time: str, watermark: str) -> DataFrame:
    """Set the watermark; Spark wants an instant there, so a wall-clock time is read in the session time zone."""
    return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, watermark)


def containing(time: Column, hours: int) -> Column:
    """Start of the epoch-aligned window of ``hours`` that holds ``time``."""
    return F.window(time, f"{hours} hours")["start"]


def join_windows_containing(one: DataFrame, three: DataFrame, six: DataFrame, keys: Sequence[str] = PLACE) -> DataFrame:
    """Each 1-hour row with the 3-hour and 6-hour window that contain it (left equi-joins on place and start)."""

    def side(df: DataFrame, h: int) -> DataFrame:
        kept = [c for c in df.columns if c.endswith(f"_{h}h")]
        return df.select(
            *keys,
            F.col("window_start").alias(f"start_{h}h"),
            F.col("window_end").alias(f"end_{h}h"),
            F.col("temp_last").alias(f"temp_last_{h}h"),
            F.col("temp_first").alias(f"temp_first_{h}h"),
            *kept,
        )

    out = one
    for h, df in ((3, three), (6, six)):
        out = out.withColumn(f"start_{h}h", containing(F.col("window_start"), h)).join(
            side(df, h), [*keys, f"start_{h}h"], "left"
        )
    return out


def join_windows_within(one: DataFrame, three: DataFrame, six: DataFrame, keys: Sequence[str] = PLACE) -> DataFrame:
    """Each 1-hour row with every 3-hour window ending within 3 hours and every 6-hour window within 6 hours.

    Ends are dealt into blocks of the reach and a coarse row is offered to its own block and the two beside it, so the
    range join becomes a left equi-join on (place, block). Both sides grow with the readings and Spark sizes an exploded
    table like its source, so the join is asked to sort and merge: a broadcast would put all offers into the driver.
    """
    out = one
    for h, df in ((3, three), (6, six)):
        seconds = h * 3600
        block = F.floor(F.unix_seconds(F.col("window_end").cast("timestamp")) / seconds)
        kept = [c for c in df.columns if c.endswith(f"_{h}h")]
        offered = df.select(
            *[F.col(k).alias(f"_{k}") for k in keys],
            F.explode(F.array(block - 1, block, block + 1)).alias("_offered"),
            F.col("window_end").alias(f"end_{h}h"),
            F.col("temp_last").alias(f"temp_last_{h}h"),
            F.col("temp_first").alias(f"temp_first_{h}h"),
            *kept,
        )
        reach = F.expr(f"INTERVAL {h} HOURS")
        cond = F.col("_block") == F.col("_offered")
        for k in keys:
            cond = cond & (F.col(k) == F.col(f"_{k}"))
        cond = cond & F.col(f"end_{h}h").between(F.col("window_end") - reach, F.col("window_end") + reach)
        out = out.withColumn("_block", block).join(offered.hint("merge"), cond, "left").drop(
            "_block", "_offered", *[f"_{k}" for k in keys])
    return out


def _hourly_parts(df: DataFrame, keys: Sequence[str], time: str, arrival: str) -> DataFrame:
    """1-hour windows with what coarser windows need: readings, variance, arrival of the first and last, their starts."""
    at = F.when(F.col("temperature").isNotNull(), F.col(arrival))
    return (
        df.groupBy(*keys, F.window(time, "1 hour"))
        .agg(
            *window_aggregates(1, arrival, True),
            F.count("temperature").alias("_n"),
            F.var_pop("temperature").alias("_var"),
            F.min(at).alias("_first_at"),
            F.max(at).alias("_last_at"),
        )
        .withColumn("window_start", F.col("window.start"))
        .withColumn("window_end", F.col("window.end"))
        .drop("window")
        .withColumn("start_6h", containing(F.col("window_start"), 6))
        .withColumn("start_3h", containing(F.col("window_start"), 3))
    )


def tumbling_from_hourly(df: DataFrame, keys: Sequence[str] = PLACE, time: str = "event_time",
                         arrival: str = "id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """The 1-, 3- and 6-hour tables of ``tumbling`` from one scan: the 1-hour rows are written, the others merge them."""
    hourly = materialize(_hourly_parts(df, keys, time, arrival), "hourly-windows")
    coarse = []
    for h in (3, 6):
        n, mean = F.sum("_n"), F.sum(F.col("_n") * F.col("temp_mean_1h"))
        merged = hourly.groupBy(*keys, F.col(f"start_{h}h").alias("window_start")).agg(
            n.alias("_n"), F.try_divide(mean, n).alias(f"temp_mean_{h}h"),
            F.collect_list(F.struct("_n", "_var", "temp_mean_1h")).alias("_parts"),  # at most h entries
            F.min("temp_min_1h").alias(f"temp_min_{h}h"), F.max("temp_max_1h").alias(f"temp_max_{h}h"),
            F.max_by("temp_last", "_last_at").alias("temp_last"), F.min_by("temp_first", "_first_at").alias("temp_first"),
        )
        apart = F.aggregate("_parts", F.lit(0.0), lambda total, x: total + F.coalesce(
            x["_n"] * (x["_var"] + F.pow(x["temp_mean_1h"] - F.col(f"temp_mean_{h}h"), 2)), F.lit(0.0)))
        coarse.append(merged.select(
            *keys, "window_start", (F.col("window_start") + F.expr(f"INTERVAL {h} HOURS")).alias("window_end"),
            f"temp_mean_{h}h", F.when(F.col("_n") > 1, F.sqrt(apart / (F.col("_n") - 1))).alias(f"temp_std_{h}h"),
            f"temp_min_{h}h", f"temp_max_{h}h", "temp_last", "temp_first",
        ))
    one = hourly.drop("_n", "_var", "_first_at", "_last_at", "start_3h", "start_6h")
    return one, coarse[0], coarse[1]


def rolled_up_windows(df: DataFrame, keys: Sequence[str] = PLACE, time: str = "event_time",
                      arrival: str = "id") -> DataFrame:
    """The result of ``join_windows_containing`` from one scan of the observations.

    3- and 6-hour figures are merged from the 1-hour rows. Both window partitions are satisfied by one shuffle on
    (place, 6-hour start), and a group holds at most six rows.
    """
    hourly = _hourly_parts(df, keys, time, arrival)
    six = Window.partitionBy(*keys, "start_6h")
    three = Window.partitionBy(*keys, "start_6h", "start_3h")
    out = hourly
    for h, w in ((6, six), (3, three)):
        n = F.sum("_n").over(w)
        out = out.withColumn("_mean", F.sum(F.col("_n") * F.col("temp_mean_1h")).over(w) / F.nullif(n, F.lit(0)))
        drift = F.col("_n") * (F.col("_var") + F.pow(F.col("temp_mean_1h") - F.col("_mean"), 2))
        out = out.withColumns(
            {
                f"end_{h}h": F.col(f"start_{h}h") + F.expr(f"INTERVAL {h} HOURS"),
                f"temp_mean_{h}h": F.col("_mean"),
                f"temp_std_{h}h": F.when(n > 1, F.sqrt(F.sum(drift).over(w) / (n - 1))),
                f"temp_min_{h}h": F.min("temp_min_1h").over(w),
                f"temp_max_{h}h": F.max("temp_max_1h").over(w),
                f"temp_first_{h}h": F.min_by("temp_first", "_first_at").over(w),
                f"temp_last_{h}h": F.max_by("temp_last", "_last_at").over(w),
            }
        )
    return out.drop("_n", "_var", "_first_at", "_last_at", "_mean")


def hourly_enriched(joined: DataFrame, keys: Sequence[str] = PLACE) -> DataFrame:
    """Joined windows as nested hourly features; the values the source does not fill are typed nulls."""
    none = F.lit(None).cast("double")

    def change(h: int) -> Column:
        suffix = "" if h == 1 else f"_{h}h"
        return F.col(f"temp_last{suffix}") - F.col(f"temp_first{suffix}")

    def stats(h: int) -> Column:
        return F.struct(*[F.col(f"temp_{s}_{h}h").alias(f"{s}_{h}h") for s in ("mean", "std", "min", "max")])

    empty = ("humidity_current", "wind_current", "pressure_current", "cloud_cover_current", "precipitation_current")
    return joined.select(
        *keys,
        F.col("window_end").alias("feature_time"),
        F.struct(F.col("temp_last").alias("temp_current"), *[none.alias(n) for n in empty]).alias("base_features"),
        F.struct(
            stats(3).alias("temp_rolling_3h"),
            stats(6).alias("temp_rolling_6h"),
            F.struct(*[change(h).alias(f"delta_{h}h") for h in (1, 3, 6)], none.alias("delta_12h")).alias("temp_deltas"),
            (change(3) / 3.0).alias("temp_roc_3h"),
            (change(6) / 6.0).alias("temp_roc_6h"),
            F.struct(
                F.col("temp_first").alias("lag_1h"),
                none.alias("lag_2h"),
                F.col("temp_first_3h").alias("lag_3h"),
                F.col("temp_first_6h").alias("lag_6h"),
                none.alias("lag_12h"),
            ).alias("temp_lags"),
            F.col("temp_std_6h").alias("temp_volatility_6h"),
        ).alias("historical_features"),
    )
