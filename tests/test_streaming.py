"""Streams replayed from files give what the batch operators give on the same rows."""

import os

import pytest
from pyspark.sql import functions as F

from registry.observations import feature_input
from registry.views import observations, raw_records
from skygrain.operators import dedup, features as X, normalize as N, windows as W
from skygrain.sources.streams import as_messages, declare_streams, read_topic, write_topic
from skygrain.streaming import chain
from skygrain.streaming.state import with_history
from tests.conftest import assert_same_rows


def land(df, path, parts: int, by: str):
    """Write rows as JSON lines, one file per part in order of ``by``, with modification times in that order."""
    os.makedirs(path, exist_ok=True)
    rows = df.orderBy(by).toJSON().collect()
    size = -(-len(rows) // parts)
    for i in range(parts):
        name = f"{path}/part-{i:03d}.json"
        with open(name, "w", encoding="utf-8") as out:
            out.write("\n".join(rows[i * size:(i + 1) * size]) + "\n")
        os.utime(name, (1_700_000_000 + i, 1_700_000_000 + i))


def replay(stream, name, mode="append"):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(240)
    return stream.sparkSession.table(name)


def raw_messages(spark, sf):
    raw = raw_records(spark, sf).drop("location")
    return as_messages(raw.withColumn("key", F.format_string("%06d", "id")).drop("id"))


def test_normalize_stream_equals_batch(spark, sf, tmp_path):
    messages = raw_messages(spark, sf)
    bad = spark.createDataFrame([("999998", '{"latitude":1}'), ("999999", "not json")], "key STRING, value STRING")
    land(messages.unionByName(bad), f"{tmp_path}/raw", 3, "key")
    got = replay(chain.normalize_stream(read_topic(spark, f"{tmp_path}/raw", per_batch=1)), "cleaned_out")
    expected = N.normalize(raw_records(spark, sf).drop("location").withColumn("key", F.format_string("%06d", "id")).drop("id"))

    def flat(df):
        return df.select("key", "location.*", "event_time", "current.temperature_2m", "current.pressure_msl",
                         F.size("hourly.time").alias("hours"), "metadata.data_quality.completeness")

    assert_same_rows(flat(got), flat(expected), ["key"])


@pytest.mark.parametrize("remove_unchanged", [False, True])
def test_stateful_features_equal_batch(spark, sf, tmp_path, remove_unchanged):
    rows = feature_input(spark, sf).drop("forecast").withColumns(
        {c: F.col(c).cast("double") for c in dedup.TOLERANCES})
    if remove_unchanged:  # make most readings repeat the one before
        rows = rows.withColumns({"temperature": F.floor(F.col("location") / 2).cast("double"), "humidity": F.lit(50.0),
                                 "wind_speed": (F.col("id") % 40 > 19).cast("double"), "pressure": F.lit(1000.0),
                                 "cloud_cover": F.lit(1.0), "precipitation": F.lit(0.0)})
    path = f"{tmp_path}/obs"
    land(rows, path, 4, "id")
    schema = rows.schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(path)
    got = replay(with_history(stream, "location", remove_unchanged), f"history_{remove_unchanged}")
    source = rows
    if remove_unchanged:
        source = dedup.dedup_unchanged(rows, ["location"], ["event_time", "id"])
        assert source.count() < rows.count()
    expected = X.over_history(source, ["location"], ["event_time", "id"], X.historical_columns)
    names = ["id", *X.historical_names()]
    assert_same_rows(got.select(*names), expected.select(*names), ["id"])


def test_feature_stream_records(spark, sf, tmp_path):
    cleaned = N.normalize(raw_records(spark, sf).drop("location").withColumn("key", F.format_string("%06d", "id")).drop("id"))
    land(as_messages(cleaned), f"{tmp_path}/cleaned", 2, "key")
    stream = chain.feature_stream(read_topic(spark, f"{tmp_path}/cleaned", per_batch=1))
    query = write_topic(stream, f"{tmp_path}/features", f"{tmp_path}/ck")
    query.awaitTermination(240)
    out = spark.read.schema("key STRING, value STRING").json(f"{tmp_path}/features")
    from skygrain.sources.contracts import validate_contract

    valid, rejected = validate_contract(out, "features")
    assert rejected.count() == 0 and valid.count() > 0.9 * cleaned.count()
    assert valid.filter("record.metadata.samples_accumulated > 6 AND record.historical_features.temp_lags.lag_6h IS NOT NULL").count() > 0


@pytest.mark.parametrize("hours", [1, 3])
def test_tumbling_stream_updates_end_at_the_batch_result(spark, sf, tmp_path, hours):
    rows = observations(spark, sf)
    path = f"{tmp_path}/obs"
    land(rows, path, 4, "id")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).json(path)
    got = replay(chain.tumbling_stream(stream, hours, "60 days"), f"tumbling_{hours}", "complete")
    assert_same_rows(got, W.tumbling(rows, hours), ["latitude", "longitude", "window_start"])


def test_tumbling_stream_in_update_mode_reaches_the_final_rows(spark, sf, tmp_path):
    rows = observations(spark, sf)
    path = f"{tmp_path}/obs"
    land(rows, path, 3, "id")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).json(path)
    got = replay(chain.tumbling_stream(stream, 6, "60 days"), "tumbling_update", "update")
    names = ["latitude", "longitude", "window_start", "temp_min_6h", "temp_max_6h", "temp_first", "temp_last"]
    final = W.tumbling(rows, 6).withColumn("window_start", F.col("window_start").cast("timestamp")).select(*names)
    assert final.exceptAll(got.select(*names)).count() == 0 and got.count() >= final.count()


def test_final_windows_in_append_mode(spark, tmp_path):
    """A late row is dropped once the watermark has passed, and the last window stays open."""
    schema = "latitude DOUBLE, longitude DOUBLE, event_time TIMESTAMP_NTZ, id INT, temperature DOUBLE, humidity INT, wind_speed DOUBLE"
    path = f"{tmp_path}/late"
    os.makedirs(path)
    times = ["2024-01-01T00:10:00", "2024-01-02T00:10:00", "2024-01-02T00:20:00", "2024-01-01T00:20:00", "2024-01-03T00:10:00",
             "2024-01-03T00:20:00"]
    for i, t in enumerate(times):
        name = f"{path}/{i}.json"
        with open(name, "w") as out:
            out.write(f'{{"latitude":1.0,"longitude":2.0,"event_time":"{t}","id":{i},"temperature":{i}.0,"humidity":1,"wind_speed":1.0}}\n')
        os.utime(name, (1_700_000_000 + i, 1_700_000_000 + i))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(path)
    got = replay(chain.tumbling_stream(stream, 1, "10 minutes"), "late_windows").orderBy("window_start").collect()
    assert [(str(r["window_start"]), r["temp_first"], r["temp_last"]) for r in got] == [
        ("2024-01-01 00:00:00", 0.0, 0.0), ("2024-01-02 00:00:00", 1.0, 2.0)]


def test_windows_joined_on_a_stream(spark, sf, tmp_path):
    rows = observations(spark, sf)
    closing = rows.limit(1).withColumns({"event_time": F.lit("2024-03-01").cast("timestamp_ntz"), "id": F.lit(10**6).cast("long")})
    path = f"{tmp_path}/joined"
    land(rows, path, 2, "id")
    land(closing, f"{tmp_path}/closing", 1, "id")
    os.rename(f"{tmp_path}/closing/part-000.json", f"{path}/part-900.json")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).json(path)
    got = replay(chain.windows_joined_stream(stream), "windows_joined").filter("window_start < '2024-02-28'")
    expected = W.join_windows_containing(*[W.tumbling(rows, h) for h in (1, 3, 6)])
    names = ["latitude", "longitude", "window_start", "temp_mean_1h", "temp_mean_3h", "temp_std_6h", "temp_last_3h", "temp_first_6h"]
    assert_same_rows(got.select(*names), expected.select(*names), names[:3])


def test_declared_views(spark, sf, tmp_path):
    land(raw_messages(spark, sf), f"{tmp_path}/raw", 1, "key")
    declare_streams(spark, {"raw_weather": f"{tmp_path}/raw"})
    view = spark.sql("SELECT key, latitude, current.temperature_2m FROM raw_weather")
    assert view.isStreaming
    assert replay(view, "declared").count() == raw_records(spark, sf).count()
