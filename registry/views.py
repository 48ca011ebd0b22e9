"""The given tables seen as sensor data. Each view exists twice: as a DataFrame and as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skygrain.sources.schemas import TOPICS

KEY, ORDER = ["location"], ["event_time", "id"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Observations: one reading per event; a reading misses its temperature or humidity now and then.
OBS = """obs AS (
  SELECT event_id AS id, user_id AS location, ts AS event_time,
    CAST(user_id % 90 AS DOUBLE) AS latitude, CAST(user_id // 90 AS DOUBLE) AS longitude,
    CAST(user_id % 500 AS DOUBLE) AS elevation,
    CASE WHEN event_id % 13 = 5 THEN NULL ELSE value END AS temperature,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(props->>'$.k' AS INTEGER) END AS humidity,
    (event_id % 40) / 2.0 AS wind_speed,
    CAST(790 + event_id % 320 AS DOUBLE) AS pressure,
    CAST((CAST(props->>'$.k' AS INTEGER) * 7) % 110 AS INTEGER) AS cloud_cover,
    (event_id % 7) / 10.0 AS precipitation
  FROM events)"""
CLEAN = """clean AS (
  SELECT * FROM obs WHERE temperature BETWEEN -50 AND 60 AND humidity BETWEEN 0 AND 100 AND wind_speed >= 0
    AND pressure BETWEEN 800 AND 1100 AND cloud_cover BETWEEN 0 AND 100 AND precipitation >= 0)"""


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    n = F.col("event_id")
    return e.select(
        n.alias("id"),
        F.col("user_id").alias("location"),
        F.col("ts").alias("event_time"),
        (F.col("user_id") % 90).cast("double").alias("latitude"),
        F.floor(F.col("user_id") / 90).cast("double").alias("longitude"),
        (F.col("user_id") % 500).cast("double").alias("elevation"),
        F.when(n % 13 != 5, F.col("value")).alias("temperature"),
        F.when(n % 11 != 0, k).alias("humidity"),
        ((n % 40) / 2.0).alias("wind_speed"),
        (790 + n % 320).cast("double").alias("pressure"),
        ((k * 7) % 110).cast("int").alias("cloud_cover"),
        ((n % 7) / 10.0).alias("precipitation"),
    )


# Raw records: the same readings in mixed units, with a forecast of 0 to 8 hours.
RAW = """raw AS (
  SELECT id, location, event_time, latitude, longitude,
    CASE WHEN id % 6 = 0 THEN NULL ELSE elevation END AS elevation,
    strftime(event_time, '%Y-%m-%dT%H:%M:%S') AS time_text,
    temperature, humidity, wind_speed, pressure, cloud_cover, precipitation,
    CASE id % 5 WHEN 0 THEN '°C' WHEN 1 THEN 'K' WHEN 2 THEN '°F' WHEN 3 THEN 'celsius' END AS t_unit,
    CASE id % 4 WHEN 0 THEN 'km/h' WHEN 1 THEN 'm/s' WHEN 2 THEN 'mph' END AS w_unit,
    CASE id % 3 WHEN 0 THEN 'hPa' WHEN 1 THEN 'Pa' WHEN 2 THEN 'kPa' END AS p_unit,
    CASE WHEN id % 2 = 0 THEN 'inch' END AS r_unit,
    CAST(id % 9 AS INTEGER) AS hours
  FROM obs)"""


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed raw records with the columns ``id`` and ``location`` beside them."""
    o = observations(spark, sf_dir)
    n = F.col("id")
    time = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss")
    hours = F.when(n % 9 > 0, F.sequence(F.lit(0), (n % 9 - 1).cast("int"))).otherwise(F.array().cast("array<int>"))

    def pick(mod: int, *units: str | None) -> Column:
        out = F.lit(None).cast("string")
        for i, u in enumerate(units):
            out = F.when(n % mod == i, F.lit(u)).otherwise(out)
        return out

    def hourly(value, kind: str) -> Column:
        return F.transform(hours, lambda i: value(i).cast(kind))

    return o.select(
        "id",
        "location",
        "latitude",
        "longitude",
        F.when(n % 6 != 0, F.col("elevation")).alias("elevation"),
        F.struct(
            time.alias("time"),
            F.col("temperature").alias("temperature_2m"),
            F.col("humidity").alias("relative_humidity_2m"),
            "precipitation",
            F.col("wind_speed").alias("wind_speed_10m"),
            (n % 360).cast("int").alias("wind_direction_10m"),
            "cloud_cover",
            F.col("pressure").alias("pressure_msl"),
        ).alias("current"),
        F.struct(
            pick(5, "°C", "K", "°F", "celsius").alias("temperature_2m"),
            F.lit("%").alias("relative_humidity_2m"),
            pick(2, "inch").alias("precipitation"),
            pick(4, "km/h", "m/s", "mph").alias("wind_speed_10m"),
            F.lit("°").alias("wind_direction_10m"),
            F.lit("%").alias("cloud_cover"),
            pick(3, "hPa", "Pa", "kPa").alias("pressure_msl"),
        ).alias("current_units"),
        F.struct(
            hourly(lambda i: F.date_format(F.col("event_time") + F.make_dt_interval(hours=i), "yyyy-MM-dd'T'HH:mm:ss"),
                   "string").alias("time"),
            hourly(lambda i: F.col("temperature") + i * 0.5, "double").alias("temperature_2m"),
            hourly(lambda i: F.col("humidity") + i, "int").alias("relative_humidity_2m"),
            hourly(lambda i: i * 10, "int").alias("precipitation_probability"),
            hourly(lambda i: F.col("precipitation"), "double").alias("precipitation"),
            hourly(lambda i: F.col("wind_speed") + i, "double").alias("wind_speed_10m"),
            hourly(lambda i: F.col("cloud_cover"), "int").alias("cloud_cover"),
            F.when(n % 2 == 0, hourly(lambda i: F.col("pressure") - i, "double")).alias("pressure_msl"),
        ).alias("hourly"),
        F.struct(
            F.lit("sensor").alias("source"),
            F.concat_ws(",", F.col("latitude").cast("string"), F.col("longitude").cast("string")).alias("location"),
            time.alias("timestamp"),
            time.alias("fetch_time"),
        ).alias("metadata"),
    )


# Predictions: one per order, horizon 1, 3 or 6 hours, made some minutes after the event.
PRED = """pred AS (
  SELECT o_orderkey AS id, o_orderdate AS event_time,
    CAST(CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 3 ELSE 6 END AS INTEGER) AS horizon_hours,
    o_totalprice / 25000.0 AS temperature_prediction,
    o_orderdate + to_seconds(CAST((o_custkey * 7 + o_orderkey) % 86400 AS INTEGER)) AS created_at
  FROM orders)"""


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("id"),
        F.col("o_orderdate").alias("event_time"),
        F.when(k % 3 == 0, 1).when(k % 3 == 1, 3).otherwise(6).alias("horizon_hours"),
        (F.col("o_totalprice") / 25000.0).alias("temperature_prediction"),
        (F.col("o_orderdate") + F.make_dt_interval(secs=((F.col("o_custkey") * 7 + k) % 86400))).alias("created_at"),
    )


# Topic messages: one topic per kind of event, three partitions, offsets by event.
TOPIC_OF = {
    "click": TOPICS["raw"], "view": TOPICS["cleaned"], "purchase": TOPICS["features"],
    "error": TOPICS["predictions"],
}
MSG = """msg AS (
  SELECT CASE event_type WHEN 'click' THEN 'data.raw.stream' WHEN 'view' THEN 'data.cleaned.stream'
      WHEN 'purchase' THEN 'data.features.hourly' WHEN 'error' THEN 'data.predictions.weather' ELSE 'other' END AS topic,
    CAST(event_id % 3 AS INTEGER) AS part, event_id // 3 AS off, event_id, user_id, ts, value, props
  FROM events)"""


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic envelope with an observation as JSON value."""
    e = table(spark, sf_dir, "events")
    topic = F.lit("other")
    for kind, name in TOPIC_OF.items():
        topic = F.when(F.col("event_type") == kind, name).otherwise(topic)
    return e.select(
        topic.alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.floor(F.col("event_id") / 3).alias("offset"),
        F.concat_ws(":", F.lit("weather"), F.col("user_id").cast("string")).alias("key"),
        F.to_json(F.struct("event_id", "user_id", "value")).alias("value"),
        F.col("ts").alias("timestamp"),
        "event_id",
    )


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison with the SQL form (adding 0.0 turns -0.0 into 0.0)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        cols.append((F.round(c, digits) + F.lit(0.0)).alias(f.name) if f.dataType.simpleString() == "double" else c)
    return df.select(*cols)


def r(expr: str, name: str, digits: int = 6) -> str:
    """SQL twin of ``rounded`` for one output column."""
    return f"round(CAST({expr} AS DOUBLE), {digits}) + 0.0 AS {name}"
