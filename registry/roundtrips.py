"""Queries that write, replay or stream the given rows through the shared folder and return what came out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from registry.book import ORACLES, QUERIES, query
from registry.observations import P, T, cleaned_observations, with_clean, with_raw
from registry.views import observations, r, raw_records, rounded
from skygrain.operators.filters import select_available
from skygrain.plans.durable import fresh_path
from skygrain.sources import tables
from skygrain.sources.schemas import OBSERVED
from skygrain.sources.streams import (
    as_messages, declare_streams, land, read_topic, read_topic_table, valid_records, write_topic,
)
from skygrain.streaming import chain


def raw_topic(spark, sf_dir) -> str:
    """The raw records as a folder of keyed JSON, with two messages that are not sound."""
    sound = as_messages(raw_records(spark, sf_dir).drop("location").withColumnRenamed("id", "key"))
    bad = spark.createDataFrame([("bad", '{"latitude":1}'), ("worse", "not json")], "key STRING, value STRING")
    path = fresh_path(spark, "raw-topic")
    land(sound.select(F.col("key").cast("string"), "value").unionByName(bad), path)
    return path


def finish(stream: StreamingQuery) -> None:
    stream.awaitTermination()
    if stream.exception() is not None:
        raise stream.exception()


@query("normalize_replay", with_raw(f"""SELECT id, {r(T, 'temperature_2m')}, {r(P, 'pressure_msl')}, humidity, hours AS hourly_rows,
    latitude, longitude, time_text AS event_time FROM raw"""))
def normalize_replay(spark, sf_dir):
    """A raw topic read as a stream, normalised into a cleaned topic, which is replayed against its contract."""
    cleaned = fresh_path(spark, "cleaned-topic")
    stream = chain.normalize_stream(read_topic(spark, raw_topic(spark, sf_dir)))
    finish(write_topic(stream, cleaned, fresh_path(spark, "stream-state")))
    back = valid_records(read_topic_table(spark, cleaned), "cleaned")
    return rounded(back.select(
        F.col("key").cast("long").alias("id"), "current.temperature_2m", "current.pressure_msl",
        F.col("current.relative_humidity_2m").alias("humidity"), F.size("hourly.time").alias("hourly_rows"),
        "location.latitude", "location.longitude", "event_time"))


@query("declared_view", with_raw("SELECT id, latitude, humidity, time_text FROM raw"))
def declared_view(spark, sf_dir):
    """The raw topic as a declared streaming view, selected from by SQL."""
    declare_streams(spark, {"raw_weather": raw_topic(spark, sf_dir)})
    chosen = spark.sql("""SELECT CAST(key AS LONG) AS id, latitude, current.relative_humidity_2m AS humidity,
        current.time AS time_text FROM raw_weather WHERE latitude IS NOT NULL AND metadata IS NOT NULL""")
    path = fresh_path(spark, "view-rows")
    writer = chosen.writeStream.option("checkpointLocation", fresh_path(spark, "stream-state")).trigger(availableNow=True)
    finish(writer.format("parquet").option("path", path).start())
    return spark.read.schema(chosen.schema).parquet(path)


@query("tumbling_changes", ORACLES["tumbling_1h"])
def tumbling_changes(spark, sf_dir):
    """Windows of a stream as changes; the last change of each window is its final state."""
    rows, path = observations(spark, sf_dir), fresh_path(spark, "observations")
    rows.write.parquet(path)
    windows = chain.tumbling_stream(spark.readStream.schema(rows.schema).parquet(path), 1, "60 days")
    out = fresh_path(spark, "window-changes")
    writer = windows.writeStream.option("checkpointLocation", fresh_path(spark, "stream-state")).trigger(availableNow=True)
    finish(writer.outputMode("update").foreachBatch(
        lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch={n}")).start())
    key = ["latitude", "longitude", "window_start"]
    last = spark.read.parquet(out).groupBy(*key).agg(
        F.max_by(F.struct(*[c for c in windows.columns if c not in key]), "batch").alias("last"))
    return rounded(last.select(*key, "last.*").withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}))


@query("window_export", ORACLES["tumbling_1h"])
def window_export(spark, sf_dir):
    """Windows written as CSV with a header and read again."""
    windows, path = QUERIES["tumbling_1h"](spark, sf_dir), fresh_path(spark, "window-export")
    tables.export_window_csv(windows, path)
    return spark.read.schema(windows.schema).option("header", True).csv(path)


@query("dataset_round_trip", with_clean(f"""SELECT id, event_time AS "timestamp", {', '.join(OBSERVED)} FROM clean"""))
def dataset_round_trip(spark, sf_dir):
    """A dataset saved as Parquet and CSV; the Parquet is loaded again and the columns at hand are selected."""
    clean = cleaned_observations(spark, sf_dir).withColumnRenamed("event_time", "timestamp")
    parquet, _ = tables.save_dataset(clean, fresh_path(spark, "dataset"))
    loaded: DataFrame = tables.load_existing(spark, parquet)
    return select_available(loaded, ["id", "timestamp", *OBSERVED, "not_there"])
