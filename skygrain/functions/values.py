"""Casts, unit conversions, quality flags and keys as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Unit spellings, conversion factors, physical limits and change tolerances.
CELSIUS, KELVIN, FAHRENHEIT = ("°C", "celsius", "C"), ("K", "kelvin"), ("°F", "fahrenheit", "F")
METRES_PER_SECOND, MILES_PER_HOUR = ("m/s", "mps"), ("mph",)
PASCAL, KILOPASCAL = ("Pa", "pascal"), ("kPa",)
KELVIN_OFFSET, KMH_PER_MS, KMH_PER_MPH = 273.15, 3.6, 1.60934
PHYSICAL_LIMITS = {
    "temperature": (-50.0, 60.0),
    "humidity": (0.0, 100.0),
    "wind_speed": (0.0, None),
    "pressure": (800.0, 1100.0),
    "cloud_cover": (0.0, 100.0),
    "precipitation": (0.0, None),
}
COMPLETENESS_FIELDS = ("temperature_2m", "relative_humidity_2m", "precipitation", "wind_speed_10m", "pressure_msl")


def to_float(x: Column) -> Column:
    """Double, or null where the text is no number."""
    return x.try_cast("double")


def to_int(x: Column) -> Column:
    """Whole number: numbers are cut toward zero, text must be a whole number, anything else is null."""
    return x.try_cast("int")


def _once(value: Column, convert) -> Column:
    return convert(value)


def convert_temperature(value: Column, unit: Column, apply=_once) -> Column:
    """Degrees Celsius. ``apply`` (``transform`` for a list) converts each value; the unit is told apart before it."""
    return (
        F.when(unit.isin(*KELVIN), apply(value, lambda v: to_float(v) - KELVIN_OFFSET))
        .when(unit.isin(*FAHRENHEIT), apply(value, lambda v: (to_float(v) - 32) * 5 / 9))
        .otherwise(apply(value, to_float))
    )


def convert_speed(value: Column, unit: Column, apply=_once) -> Column:
    return (
        F.when(unit.isin(*METRES_PER_SECOND), apply(value, lambda v: to_float(v) * KMH_PER_MS))
        .when(unit.isin(*MILES_PER_HOUR), apply(value, lambda v: to_float(v) * KMH_PER_MPH))
        .otherwise(apply(value, to_float))
    )


def convert_pressure(value: Column, unit: Column, apply=_once) -> Column:
    return (
        F.when(unit.isin(*PASCAL), apply(value, lambda v: to_float(v) / 100))
        .when(unit.isin(*KILOPASCAL), apply(value, lambda v: to_float(v) * 10))
        .otherwise(apply(value, to_float))
    )


def completeness(current: str) -> Column:
    """Share of the five expected current values that are not null."""
    present = sum((F.col(f"{current}.{f}").isNotNull().cast("int") for f in COMPLETENESS_FIELDS), F.lit(0))
    return present / F.lit(float(len(COMPLETENESS_FIELDS)))


def outside(value: Column, variable: str) -> Column:
    """True when a value breaks the physical limits of its variable, false when it is null."""
    low, high = PHYSICAL_LIMITS[variable]
    broken = value < low if high is None else (value < low) | (value > high)
    return F.coalesce(broken, F.lit(False))


def within_limits(value: Column, variable: str) -> Column:
    low, high = PHYSICAL_LIMITS[variable]
    return value >= low if high is None else value.between(low, high)


def anomaly_codes(temperature: Column, humidity: Column) -> Column:
    """Ordered list of range errors; the row itself is kept."""
    hot, damp = outside(temperature, "temperature"), outside(humidity, "humidity")
    codes = F.lit("temperature_out_of_range"), F.lit("humidity_out_of_range")
    return (
        F.when(hot & damp, F.array(*codes)).when(hot, F.array(codes[0])).when(damp, F.array(codes[1]))
        .otherwise(F.array().cast(T.ArrayType(T.StringType(), containsNull=False)))
    )


def location_text(latitude: Column, longitude: Column) -> Column:
    return F.concat_ws(",", latitude.cast("string"), longitude.cast("string"))


def message_key(location: Column, time: Column) -> Column:
    """``weather:{lat,lon}:{ISO time}``."""
    return F.concat_ws(":", F.lit("weather"), location, iso_time(time))


def iso_time(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def now_iso() -> Column:
    return iso_time(F.current_timestamp())
