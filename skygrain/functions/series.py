"""Column builders for features over a key's ordered rows. ``w`` is a window partitioned by key and ordered by time.

All builders of one call share ``w``, so Spark plans one shuffle and one sort for the lot.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, WindowSpec, functions as F

# The feature groups of the streaming engineer and of the offline feature set.
ROLLING_ROWS = (3, 6, 12, 24)
ROLLING_SERIES = ("temp", "humidity", "wind")
DELTA_ROWS = {"temp": (1, 3, 6, 12), "humidity": (1, 3, 6), "wind": (1, 3, 6)}
RATE_ROWS = (("temp", 3), ("temp", 6), ("wind", 3))
LAG_ROWS = {"temp": (1, 2, 3, 6, 12), "humidity": (1, 3, 6), "wind": (1, 3, 6)}
VOLATILITY_ROWS = 6
TARGET_POSITIONS = {1: 1, 3: 3, 6: 6}
DAY_HOURS = (6, 20)
STREAM_BACK = 23


def last_rows(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), 0)


def rolling_stats(x: Column, n: int, w: WindowSpec, min_rows: int | None = None) -> dict[str, Column]:
    """mean, population std, min and max of the last ``n`` rows (nulls skipped), null until ``min_rows`` rows exist."""
    frame = last_rows(w, n)
    enough = F.count(F.lit(1)).over(frame) >= (n if min_rows is None else min_rows)
    stats = {"mean": F.avg(x), "std": F.stddev_pop(x), "min": F.min(x), "max": F.max(x)}
    return {f"{name}_{n}h": F.when(enough, agg.over(frame)) for name, agg in stats.items()}


def mergeable(x: Column, frame: WindowSpec) -> dict[str, Column]:
    """Aggregates of a frame from which those of two neighbouring frames together follow."""
    n = F.count(x).over(frame)
    return {"n": n, "sum": F.sum(x).over(frame), "m2": F.var_pop(x).over(frame) * n, "min": F.min(x).over(frame),
            "max": F.max(x).over(frame)}


def merged(a: Column, b: Column) -> Column:
    """The aggregates of two neighbouring frames as those of one; ``b`` is null where there are no such rows."""
    zero = F.lit(0.0)
    n, m = a["n"], F.coalesce(b["n"], F.lit(0).cast("long"))
    apart = F.try_divide(b["sum"], m) - F.try_divide(a["sum"], n)
    between = F.coalesce(F.try_divide(apart * apart * n * m, n + m), zero)
    return F.struct(
        (n + m).alias("n"), (F.coalesce(a["sum"], zero) + F.coalesce(b["sum"], zero)).alias("sum"),
        (F.coalesce(a["m2"], zero) + F.coalesce(b["m2"], zero) + between).alias("m2"),
        F.least(a["min"], b["min"]).alias("min"), F.greatest(a["max"], b["max"]).alias("max"))


def merged_stats(frame: Column) -> dict[str, Column]:
    """mean, population std, min and max as ``rolling_stats`` has them."""
    n = frame["n"]
    return {"mean": F.try_divide(frame["sum"], n), "std": F.sqrt(F.try_divide(frame["m2"], n)),
            "min": frame["min"], "max": frame["max"]}


def rolling_mean(x: Column, n: int, w: WindowSpec) -> Column:
    """Mean of the last ``n`` rows, from the first row on."""
    return F.avg(x).over(last_rows(w, n))


def lag(x: Column, n: int, w: WindowSpec) -> Column:
    return F.lag(x, n).over(w)


def lead(x: Column, n: int, w: WindowSpec) -> Column:
    return F.lead(x, n).over(w)


def delta(x: Column, n: int, w: WindowSpec) -> Column:
    return x - F.lag(x, n).over(w)


def rate(x: Column, n: int, w: WindowSpec) -> Column:
    return delta(x, n, w) / n


def volatility(x: Column, w: WindowSpec, n: int = VOLATILITY_ROWS) -> Column:
    """Population std of the last ``n`` rows, null before ``n`` rows exist."""
    return rolling_stats(x, n, w)[f"std_{n}h"]


def time_rolling_stats(x: Column, hours: int, w: WindowSpec) -> dict[str, Column]:
    """The same statistics over the last ``hours`` of time; ``w`` must be ordered by epoch seconds alone."""
    frame = w.rangeBetween(-(hours * 3600) + 1, 0)
    stats = {"mean": F.avg(x), "std": F.stddev_pop(x), "min": F.min(x), "max": F.max(x)}
    return {f"{name}_{hours}h": agg.over(frame) for name, agg in stats.items()}


def cycle(position: Column, period: int) -> tuple[Column, Column]:
    angle = position * F.lit(2 * math.pi) / period
    return F.sin(angle), F.cos(angle)


def cyclical(time: Column) -> dict[str, Column]:
    """sin/cos of the wall-clock hour and of the weekday (Monday = 0)."""
    hour_sin, hour_cos = cycle(F.hour(time), 24)
    day_sin, day_cos = cycle(F.weekday(time), 7)
    return {"hour_sin": hour_sin, "hour_cos": hour_cos, "day_sin": day_sin, "day_cos": day_cos}


def day_flags(time: Column) -> dict[str, Column]:
    return {
        "is_day": F.hour(time).between(*DAY_HOURS).cast("int"),
        "is_weekend": (F.weekday(time) >= 5).cast("int"),
    }


def wall_clock(text: Column) -> Column:
    """Time as written in the text: an offset such as +02:00 does not move the hour. Unparsable text gives null."""
    return text.try_cast("timestamp_ntz")


def positional_targets(forecast: Column) -> dict[str, Column]:
    """Forecast values at fixed positions; null when the forecast is too short."""
    return {f"temp_target_{h}h": F.get(forecast, i) for h, i in TARGET_POSITIONS.items()}
