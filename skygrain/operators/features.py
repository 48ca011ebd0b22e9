"""Historical features of observations: the streaming feature record and the offline feature set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from skygrain.functions import series as S
from skygrain.functions.values import now_iso
from skygrain.plans.skew import ROW_NO, ordered_rows
from skygrain.sources.schemas import FEATURES, HISTORY_SIZE, HORIZONS

# Observation columns behind each feature series.
SERIES = {"temp": "temperature", "humidity": "humidity", "wind": "wind_speed"}
BASE = {
    "temp_current": "temperature", "humidity_current": "humidity", "wind_current": "wind_speed",
    "pressure_current": "pressure", "cloud_cover_current": "cloud_cover", "precipitation_current": "precipitation",
}


def rolling_columns(series: str, w: WindowSpec, windows: Sequence[int] = S.ROLLING_ROWS,
                    min_rows: int | None = None) -> dict[str, Column]:
    x = F.col(SERIES[series])
    cols = {}
    for n in windows:
        for name, col in S.rolling_stats(x, n, w, min_rows).items():
            cols[f"{series}_{name}"] = col
    return cols


def delta_columns(w: WindowSpec) -> dict[str, Column]:
    return {f"{s}_delta_{n}h": S.delta(F.col(SERIES[s]), n, w) for s, ns in S.DELTA_ROWS.items() for n in ns}


def rate_columns(w: WindowSpec) -> dict[str, Column]:
    return {f"{s}_roc_{n}h": S.rate(F.col(SERIES[s]), n, w) for s, n in S.RATE_ROWS}


def lag_columns(w: WindowSpec) -> dict[str, Column]:
    return {f"{s}_lag_{n}h": S.lag(F.col(SERIES[s]), n, w) for s, ns in S.LAG_ROWS.items() for n in ns}


def historical_columns(w: WindowSpec) -> dict[str, Column]:
    """All 73 historical values, flat, on one window."""
    cols: dict[str, Column] = {}
    for s in S.ROLLING_SERIES:
        cols |= rolling_columns(s, w)
    cols |= delta_columns(w) | rate_columns(w) | lag_columns(w)
    cols["temp_volatility_6h"] = S.volatility(F.col("temperature"), w)
    return cols


def with_history(df: DataFrame, w: WindowSpec) -> DataFrame:
    """``df`` with the values of ``historical_columns``, the rolling ones merged from shorter frames.

    Each frame of 6, 12 and 24 rows is two neighbouring halves, so the aggregates run over 3 rows only and the rest are
    lags: a row costs 3 updates instead of 45. All steps share ``w``, hence its one shuffle and sort.
    """
    least = S.ROLLING_ROWS[0]
    frame = S.last_rows(w, least)
    given = {s: F.col(SERIES[s]).cast("double") for s in S.ROLLING_SERIES}
    whole = delta_columns(w) | rate_columns(w) | lag_columns(w) | {"_rows": F.row_number().over(w)}
    out = df.withColumns(whole | {
        f"_{s}_{least}": F.struct(*[agg.alias(n) for n, agg in S.mergeable(x, frame).items()]) for s, x in given.items()})
    for half, n in zip(S.ROLLING_ROWS, S.ROLLING_ROWS[1:]):
        out = out.withColumns({f"_{s}_back": F.lag(f"_{s}_{half}", half).over(w) for s in given})
        out = out.withColumns({f"_{s}_{n}": S.merged(F.col(f"_{s}_{half}"), F.col(f"_{s}_back")) for s in given})
    stats = {}
    for s in given:
        for n in S.ROLLING_ROWS:
            of = S.merged_stats(F.col(f"_{s}_{n}"))
            stats |= {f"{s}_{name}_{n}h": F.when(F.col("_rows") >= n, c) for name, c in of.items()}
    stats["temp_volatility_6h"] = stats[f"temp_std_{S.VOLATILITY_ROWS}h"]
    spare = [f"_{s}_{n}" for s in given for n in (*S.ROLLING_ROWS, "back")]
    return out.withColumns(stats).drop("_rows", *spare)


def over_history(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns, back: int = S.STREAM_BACK,
                 ahead: int = 0) -> DataFrame:
    """Add ``columns(window)`` for each key's ordered rows; hot keys are cut into ranges."""
    return ordered_rows(df, keys, order, lambda rows, w: rows.withColumns(columns(w)), back, ahead)


def with_time_windows(df: DataFrame, keys: Sequence[str], time: str, hours: Sequence[int]) -> DataFrame:
    """Rolling temperature statistics over hours of time instead of rows (opt-in; rows are the default meaning).

    A key is cut into time buckets, and a row near the end of a bucket also goes to the next one, whose first rows
    reach back to it. So a long history of one key is spread over many tasks. A row without a time has null statistics.
    """
    reach = max(hours) * 3600
    width = max(24 * 3600, 4 * reach)
    rows = df.filter(F.col(time).isNotNull()).withColumn("_t", F.unix_seconds(F.col(time).cast("timestamp")))
    home, last = F.floor(F.col("_t") / width), F.floor((F.col("_t") + reach) / width)
    rows = rows.withColumn("_bucket", F.explode(F.array_distinct(F.array(home, last)))).withColumn("_home", home)
    w = Window.partitionBy(*keys, "_bucket").orderBy("_t")
    cols = {}
    for h in hours:
        for name, col in S.time_rolling_stats(F.col("temperature"), h, w).items():
            cols[f"temp_{name}"] = col
    dated = rows.withColumns(cols).filter(F.col("_bucket") == F.col("_home")).drop("_t", "_bucket", "_home")
    return dated.unionByName(df.filter(F.col(time).isNull()), allowMissingColumns=True)


def _group(prefix: str, names: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"{prefix}_{n}").cast("double").alias(n) for n in names])


def nested_history() -> Column:
    """The flat historical columns as the nested ``historical_features`` record (wide form)."""
    parts = []
    for n in S.ROLLING_ROWS:
        for s in S.ROLLING_SERIES:
            parts.append(_group(s, [f"{stat}_{n}h" for stat in ("mean", "std", "min", "max")]).alias(f"{s}_rolling_{n}h"))
    parts += [_group(s, [f"delta_{n}h" for n in ns]).alias(f"{s}_deltas") for s, ns in S.DELTA_ROWS.items()]
    parts += [F.col(f"{s}_roc_{n}h") for s, n in S.RATE_ROWS]
    parts += [_group(s, [f"lag_{n}h" for n in ns]).alias(f"{s}_lags") for s, ns in S.LAG_ROWS.items()]
    parts.append(F.col("temp_volatility_6h"))
    return F.struct(*parts)


def base_features() -> Column:
    return F.struct(*[F.col(c).cast("double").alias(name) for name, c in BASE.items()])


def cyclical_features(time: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in (S.cyclical(time) | S.day_flags(time)).items()])


def count_present(columns: Sequence[str]) -> Column:
    return sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))


def historical_names() -> list[str]:
    w = Window.partitionBy(F.lit(0)).orderBy(F.lit(0))
    return list(historical_columns(w))


def assemble_features(df: DataFrame) -> DataFrame:
    """Rows with flat history, ``_row_no`` and observation columns to nested feature records.

    Expects latitude, longitude, elevation, time_text, forecast (array) and the observation columns. A row whose time
    cannot be read stays in the history of later rows but gives no record itself. The fields of ``input_metadata``, if
    there is such a column, are part of the record's metadata.
    """
    time = S.wall_clock(F.col("time_text"))
    names = historical_names()
    own = ("feature_engineered_at", "history_size", "samples_accumulated", "feature_count")
    given = df.schema["input_metadata"].dataType.fieldNames() if "input_metadata" in df.columns else []
    extra = [c for c in ("location_key", "id") if c in df.columns]
    return df.filter(time.isNotNull()).select(
        *extra,
        F.struct("latitude", "longitude", "elevation").alias("location"),
        F.col("time_text").alias("timestamp"),
        base_features().alias("base_features"),
        nested_history().alias("historical_features"),
        cyclical_features(time).alias("cyclical_features"),
        F.struct(*[c.cast("double").alias(n) for n, c in S.positional_targets(F.col("forecast")).items()]).alias(
            "target_labels"
        ),
        F.struct(
            *[F.col(f"input_metadata.{n}") for n in given if n not in own],
            now_iso().alias("feature_engineered_at"),
            F.least(F.col("samples"), F.lit(HISTORY_SIZE)).cast("int").alias("history_size"),
            F.col("samples").cast("int").alias("samples_accumulated"),
            (count_present([*BASE.values(), *names]) + 6).cast("int").alias("feature_count"),
        ).alias("metadata"),
    )


def engineer_features(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Feature records of a batch of observations (see ``assemble_features`` for the columns expected)."""

    def build(rows: DataFrame, w: WindowSpec) -> DataFrame:
        return with_history(rows, w).withColumn("samples", F.col(ROW_NO))

    return assemble_features(ordered_rows(df, keys, order, build, S.STREAM_BACK, 0, numbered=True))


def contract_features(features: DataFrame) -> DataFrame:
    """Wide feature records cut to the fields of the features contract."""
    h = "historical_features"
    wanted = FEATURES[h].dataType.fieldNames()
    return features.withColumn(h, F.struct(*[F.col(f"{h}.{n}") for n in wanted]))


def observations_of(cleaned: DataFrame, metadata: bool = False) -> DataFrame:
    """Cleaned records to the flat columns that feature engineering reads, on request with their ``input_metadata``."""
    extra = [c for c in cleaned.columns if c not in ("location", "event_time", "current", "hourly", "metadata")]
    return cleaned.select(
        *extra, *([F.col("metadata").alias("input_metadata")] if metadata else []),
        F.col("location.latitude"), F.col("location.longitude"), F.col("location.elevation"),
        F.col("current.time").alias("time_text"),
        F.col("current.temperature_2m").alias("temperature"),
        F.col("current.relative_humidity_2m").alias("humidity"),
        F.col("current.wind_speed_10m").alias("wind_speed"),
        F.col("current.pressure_msl").alias("pressure"),
        F.col("current.cloud_cover").alias("cloud_cover"),
        F.col("current.precipitation").alias("precipitation"),
        F.col("hourly.temperature_2m").alias("forecast"),
    )


def history_summary(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int = HISTORY_SIZE) -> DataFrame:
    """Per key: samples held (at most ``size``), capacity, temperature range and time range of the held rows.

    The row limit is applied before the shuffle too, so a hot key sends at most ``size`` rows per input partition.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    held = df.withColumn("_r", F.row_number().over(newest)).filter(F.col("_r") <= size)
    return held.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("samples"),
        F.lit(size).alias("max_capacity"),
        F.min("temperature").alias("temp_min"),
        F.max("temperature").alias("temp_max"),
        F.max_by(order[0], "_r").alias("oldest"),
        F.min_by(order[0], "_r").alias("newest"),
    )


# Offline feature set -------------------------------------------------------------------------------------------

BATCH_LAGS = {"temperature": (1, 3, 6), "pressure": (1, 3), "humidity": (1, 3)}
BATCH_MEANS = {"temperature": (3, 6), "pressure": (3, 6)}
BATCH_DIFFS = {"temperature": (1, 3), "pressure": (1, 3)}
BATCH_BACK = 6


def _named(column: str, name: str) -> str:
    return name if column == "temperature" else f"{column}_{name}"


def batch_lag_columns(columns: Sequence[str], w: WindowSpec) -> dict[str, Column]:
    return {_named(c, f"lag_{n}h"): S.lag(F.col(c), n, w) for c, ns in BATCH_LAGS.items() if c in columns for n in ns}


def batch_mean_columns(columns: Sequence[str], w: WindowSpec) -> dict[str, Column]:
    return {
        _named(c, f"rolling_mean_{n}h"): S.rolling_mean(F.col(c), n, w)
        for c, ns in BATCH_MEANS.items() if c in columns for n in ns
    }


def batch_diff_columns(columns: Sequence[str], w: WindowSpec) -> dict[str, Column]:
    return {_named(c, f"delta_{n}h"): S.delta(F.col(c), n, w) for c, ns in BATCH_DIFFS.items() if c in columns for n in ns}


def target_columns(w: WindowSpec, horizons: Sequence[int] = HORIZONS) -> dict[str, Column]:
    return {f"target_temperature_{h}h": S.lead(F.col("temperature"), h, w) for h in horizons}


def engineer_features_batch(df: DataFrame, keys: Sequence[str], order: Sequence[str], time: str,
                            targets: bool = False) -> DataFrame:
    """The offline feature set (and the future targets) on one shared window."""

    def columns(w: WindowSpec) -> dict[str, Column]:
        cols = batch_lag_columns(df.columns, w) | batch_mean_columns(df.columns, w) | batch_diff_columns(df.columns, w)
        return cols | (target_columns(w) if targets else {})

    out = over_history(df, keys, order, columns, BATCH_BACK, max(HORIZONS) if targets else 0)
    return out.withColumns(S.cyclical(F.col(time)))


def create_targets(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Temperature 1, 3 and 6 rows later."""
    return over_history(df, keys, order, target_columns, 0, max(HORIZONS))
