"""Record contracts as Spark types. ``nullable=False`` marks a field that a valid record must carry."""

from __future__ import annotations

from pyspark.sql import types as T

# Topic names, unit defaults, expected fields and feature orders of the data this library exchanges.
TOPICS = {
    "raw": "data.raw.stream",
    "cleaned": "data.cleaned.stream",
    "features": "data.features.hourly",
    "predictions": "data.predictions.weather",
    "predictions_quantiles": "data.predictions.weather.quantiles",
}
UNIT_DEFAULTS = {
    "temperature_2m": "°C",
    "relative_humidity_2m": "%",
    "precipitation": "mm",
    "wind_speed_10m": "km/h",
    "wind_direction_10m": "°",
    "cloud_cover": "%",
    "pressure_msl": "hPa",
}
HISTORY_SIZE = 168
HORIZONS = (1, 3, 6)
RAW_REQUIRED_KEYS = ("latitude", "longitude", "current", "hourly", "metadata", "current_units")
OBSERVED = ("temperature", "humidity", "wind_speed", "pressure", "cloud_cover", "precipitation")
MODEL_FEATURES = (
    "temperature", "humidity", "wind_speed", "pressure", "cloud_cover", "precipitation",
    "lag_1h", "lag_3h", "lag_6h",
    "pressure_lag_1h", "pressure_lag_3h", "humidity_lag_1h", "humidity_lag_3h",
    "rolling_mean_3h", "rolling_mean_6h", "pressure_rolling_mean_3h", "pressure_rolling_mean_6h",
    "delta_1h", "delta_3h", "pressure_delta_1h", "pressure_delta_3h",
    "hour_sin", "hour_cos", "day_sin", "day_cos",
)
SEQUENCE_FEATURES = OBSERVED + ("hour_sin", "hour_cos", "day_sin", "day_cos")
POINT_FIELDS = ("event_time", "horizon_hours", "created_at", "temperature_prediction")
QUANTILE_FIELDS = ("event_time", "horizon_hours", "created_at", "temperature_p10", "temperature_p50", "temperature_p90")

D, I, S = T.DoubleType(), T.IntegerType(), T.StringType()


def _record(*fields: tuple) -> T.StructType:
    """(name, type) is optional, (name, type, True) is required."""
    return T.StructType([T.StructField(f[0], f[1], not (len(f) > 2 and f[2])) for f in fields])


def _doubles(*names: str) -> T.StructType:
    return _record(*[(n, D) for n in names])


def _list(item: T.DataType, nulls: bool = True) -> T.ArrayType:
    return T.ArrayType(item, containsNull=nulls)


_CURRENT = [
    ("temperature_2m", D), ("relative_humidity_2m", I), ("precipitation", D), ("wind_speed_10m", D),
    ("wind_direction_10m", I), ("cloud_cover", I), ("pressure_msl", D),
]

HOURLY = _record(
    ("time", _list(S, nulls=False), True),
    ("temperature_2m", _list(D), True),
    ("relative_humidity_2m", _list(I), True),
    ("precipitation_probability", _list(I), True),
    ("precipitation", _list(D), True),
    ("wind_speed_10m", _list(D), True),
    ("cloud_cover", _list(I), True),
    ("pressure_msl", _list(D), True),
)

RAW = _record(
    ("latitude", D, True),
    ("longitude", D, True),
    ("elevation", D),
    ("current", _record(("time", S, True), *_CURRENT), True),
    ("current_units", _record(*[(n, S) for n in UNIT_DEFAULTS]), True),
    ("hourly", HOURLY, True),
    ("metadata", _record(("source", S, True), ("location", S, True), ("timestamp", S, True), ("fetch_time", S)), True),
)

LOCATION = _record(("latitude", D, True), ("longitude", D, True), ("elevation", D))

CLEANED = _record(
    ("location", LOCATION, True),
    ("event_time", S),
    ("current", _record(
        ("time", S), *_CURRENT,
        ("units", _record(*[(n, S, True) for n in ("temperature", "humidity", "precipitation", "wind_speed", "pressure")]),
         True)), True),
    ("hourly", HOURLY, True),
    ("metadata", _record(
        ("source", S, True), ("location", S, True), ("timestamp", S), ("normalized_at", S, True),
        ("data_quality", _record(
            ("completeness", D, True), ("has_anomalies", T.BooleanType(), True),
            ("validation_errors", _list(S, nulls=False), True)), True)), True),
)


def rolling(hours: int) -> T.StructType:
    return _doubles(*[f"{stat}_{hours}h" for stat in ("mean", "std", "min", "max")])


FEATURES = _record(
    ("location", LOCATION, True),
    ("timestamp", S, True),
    ("base_features", _doubles("temp_current", "humidity_current", "wind_current", "pressure_current",
                               "cloud_cover_current", "precipitation_current"), True),
    ("historical_features", _record(
        ("temp_rolling_3h", rolling(3)),
        ("temp_rolling_6h", rolling(6)),
        ("temp_deltas", _doubles("delta_1h", "delta_3h", "delta_6h", "delta_12h"), True),
        ("temp_roc_3h", D),
        ("temp_roc_6h", D),
        ("temp_lags", _doubles("lag_1h", "lag_2h", "lag_3h", "lag_6h", "lag_12h"), True),
        ("temp_volatility_6h", D)), True),
    ("cyclical_features", _record(("hour_sin", D), ("hour_cos", D), ("day_sin", D), ("day_cos", D), ("is_day", I),
                                  ("is_weekend", I)), True),
    ("target_labels", _doubles("temp_target_1h", "temp_target_3h", "temp_target_6h"), True),
    ("metadata", _record(("feature_engineered_at", S, True), ("history_size", I, True),
                         ("samples_accumulated", I, True), ("feature_count", I, True)), True),
)

_MODEL = [("model_name", S, True), ("model_version", S, True), ("created_at", S, True)]
PREDICTION = _record(("event_time", S, True), ("horizon_hours", I, True), ("temperature_prediction", D, True), *_MODEL)
PREDICTION_QUANTILES = _record(
    ("event_time", S, True), ("horizon_hours", I, True),
    ("temperature_p10", D, True), ("temperature_p50", D, True), ("temperature_p90", D, True), *_MODEL)

CONTRACTS = {
    "raw": RAW,
    "cleaned": CLEANED,
    "features": FEATURES,
    "predictions": PREDICTION,
    "predictions_quantiles": PREDICTION_QUANTILES,
}

# Fields that may be absent (an absent field takes the default, an explicit null is invalid).
DEFAULTED = {"raw": ("hourly.pressure_msl",), "cleaned": ("hourly.pressure_msl",)}

ENVELOPE = _record(("topic", S), ("partition", I), ("offset", T.LongType()), ("key", S), ("value", S),
                   ("timestamp", T.TimestampType()))


def nullable(dtype: T.DataType) -> T.DataType:
    """The same type with every field nullable, as parsers return it."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType), True) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(nullable(dtype.elementType), True)
    return dtype
