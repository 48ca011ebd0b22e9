"""Raw observations to cleaned ones: unit conversion, casts, completeness and anomaly flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from skygrain.functions import values as V
from skygrain.sources.contracts import conforms, parse_once, parse_plain, parsed_plainly
from skygrain.sources.schemas import RAW, RAW_REQUIRED_KEYS, UNIT_DEFAULTS, nullable


def has_required_keys(value: Column) -> Column:
    """True when the JSON object names every required key; a key with a null value counts as present."""
    # One expression over the keys: a conjunction of tests would walk through the message once for each of them.
    missing = F.array_except(F.array(*[F.lit(key) for key in RAW_REQUIRED_KEYS]), F.json_object_keys(value))
    return F.coalesce(F.size(missing) == 0, F.lit(False))


def unit(name: str) -> Column:
    return F.coalesce(F.col(f"current_units.{name}"), F.lit(UNIT_DEFAULTS[name]))


def clean_current() -> Column:
    def c(name: str) -> Column:
        return F.col(f"current.{name}")

    return F.struct(
        c("time").alias("time"),
        V.convert_temperature(c("temperature_2m"), unit("temperature_2m")).alias("temperature_2m"),
        V.to_int(c("relative_humidity_2m")).alias("relative_humidity_2m"),
        V.to_float(c("precipitation")).alias("precipitation"),
        V.convert_speed(c("wind_speed_10m"), unit("wind_speed_10m")).alias("wind_speed_10m"),
        V.to_int(c("wind_direction_10m")).alias("wind_direction_10m"),
        V.to_int(c("cloud_cover")).alias("cloud_cover"),
        V.convert_pressure(c("pressure_msl"), unit("pressure_msl")).alias("pressure_msl"),
        F.struct(
            F.lit("°C").alias("temperature"),
            F.lit("%").alias("humidity"),
            unit("precipitation").alias("precipitation"),
            F.lit("km/h").alias("wind_speed"),
            F.lit("hPa").alias("pressure"),
        ).alias("units"),
    )


def clean_hourly(given: T.StructType | None = None) -> Column:
    """Lists converted and cast; a list that ``given``, the type of ``hourly``, has as it must be is taken as it is."""
    def cast(name: str, to: T.DataType):
        def apply(values: Column, convert) -> Column:
            typed = given is not None and convert in (V.to_int, V.to_float) and given[name].dataType.elementType == to
            return values if typed else F.transform(values, convert)

        return apply

    def each(name: str, to: T.DataType, convert) -> Column:
        done = convert(F.col(f"hourly.{name}"), cast(name, to))
        return F.coalesce(done, F.array().cast(T.ArrayType(to))).alias(name)

    def whole(values: Column, apply) -> Column:
        return apply(values, V.to_int)

    def number(values: Column, apply) -> Column:
        return apply(values, V.to_float)

    d, i = T.DoubleType(), T.IntegerType()
    return F.struct(
        F.coalesce(F.col("hourly.time"), F.array().cast("array<string>")).alias("time"),
        each("temperature_2m", d, lambda x, apply: V.convert_temperature(x, unit("temperature_2m"), apply)),
        each("relative_humidity_2m", i, whole),
        each("precipitation_probability", i, whole),
        each("precipitation", d, number),
        each("wind_speed_10m", d, lambda x, apply: V.convert_speed(x, unit("wind_speed_10m"), apply)),
        each("cloud_cover", i, whole),
        each("pressure_msl", d, lambda x, apply: V.convert_pressure(x, unit("pressure_msl"), apply)),
    )


def normalize(raw: DataFrame) -> DataFrame:
    """Typed raw rows to cleaned rows; rows that miss a required field are dropped. Works on batches and streams.

    Columns beyond the raw record (a message key, an offset) are carried along.
    """
    extra = [c for c in raw.columns if c not in RAW.fieldNames()]
    staged = raw.select("*", clean_current().alias("_current"), clean_hourly(raw.schema["hourly"].dataType).alias("_hourly"))
    errors = V.anomaly_codes(F.col("_current.temperature_2m"), F.col("_current.relative_humidity_2m"))
    cleaned = staged.select(
        *extra,
        F.struct(
            "latitude", "longitude", F.coalesce(F.col("elevation"), F.lit(0.0)).alias("elevation")
        ).alias("location"),
        F.coalesce(F.col("metadata.timestamp"), F.col("_current.time")).alias("event_time"),
        F.col("_current").alias("current"),
        F.col("_hourly").alias("hourly"),
        F.struct(
            F.col("metadata.source").alias("source"),
            F.col("metadata.location").alias("location"),
            F.col("metadata.timestamp").alias("timestamp"),
            V.now_iso().alias("normalized_at"),
            F.struct(
                V.completeness("_current").alias("completeness"),
                (F.size(errors) > 0).alias("has_anomalies"),
                errors.alias("validation_errors"),
            ).alias("data_quality"),
        ).alias("metadata"),
    )
    return conforms(cleaned, "cleaned")


MEASURED = ("current", "hourly")


def _as_sent(dtype: T.DataType) -> T.DataType:
    """The type with its numbers as variants, which keep text and fractions as the message has them."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _as_sent(f.dataType)) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_as_sent(dtype.elementType))
    return T.VariantType() if isinstance(dtype, (T.DoubleType, T.IntegerType)) else dtype


def _measured(col: Column, dtype: T.DataType) -> Column:
    """A column parsed by ``_as_sent`` in its contract type; what is no number becomes null."""
    if isinstance(dtype, T.StructType):
        fields = [_measured(col[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType) and not isinstance(dtype.elementType, T.StringType):
        return F.transform(col, lambda x: _measured(x, dtype.elementType))
    if isinstance(dtype, (T.DoubleType, T.IntegerType)):
        return F.try_variant_get(col, "$", dtype.simpleString())
    return col


def parse_raw(messages: DataFrame, value: str = "value") -> DataFrame:
    """Keyed JSON messages to typed raw rows; messages without the required keys are dropped.

    Measured values may come as text, and whole numbers with a fraction, which is cut. Coordinates must be numbers.
    A message whose values all have their contract types is read as such; only the others are read again as variants.
    """
    keep = [c for c in messages.columns if c != value]
    present = messages.filter(has_required_keys(F.col(value)))
    schema = nullable(RAW)
    plain = parse_plain(present, "_r", schema, value)
    sent = T.StructType([T.StructField(f.name, _as_sent(f.dataType)) if f.name in MEASURED else f for f in schema.fields])
    again = ~parsed_plainly("_r")
    parsed = parse_once(plain, F.when(again, F.from_json(F.col(value), sent)).alias("_s"))
    typed = parse_once(parsed, *[
        F.when(again, _measured(F.col(f"_s.{f.name}"), f.dataType) if f.name in MEASURED else F.col(f"_s.{f.name}"))
        .otherwise(F.col(f"_r.{f.name}")).alias(f"_{f.name}") for f in schema.fields])
    return typed.select(*keep, *[F.col(f"_{f.name}").alias(f.name) for f in schema.fields])
