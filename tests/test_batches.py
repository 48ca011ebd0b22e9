"""Micro-batches with a ledger: restarts, repeats after a failure at any step, hot locations, counts, bounded join state."""

import random

import pytest
from pyspark.sql import functions as F

from registry.replays import BAD, cleaned_messages
from registry.views import observations
from skygrain.operators import features as X
from skygrain.operators.dedup import TOLERANCES, dedup_unchanged
from skygrain.sources.streams import read_topic, valid_records
from skygrain.streaming import batches, chain
from skygrain.streaming.counts import READ, BatchCounts, reported
from skygrain.streaming.ledger import Ledger
from tests.conftest import assert_same_rows


class Kept:
    """A sink that keeps what it was handed, in order."""

    def __init__(self):
        self.calls = []

    def __call__(self, messages, contract, number):
        self.calls.append((number, sorted((r["key"], r["value"]) for r in messages.collect())))


def readings(spark, n, places=2):
    """Drifting readings in four parts by time, many of them unchanged, with nulls."""
    rng = random.Random(4)
    rows, level = [], {}
    for i in range(n):
        place = rng.randrange(places) if i % 3 else 0
        level[place] = level.get(place, 10.0) + rng.choice([0, 0, 0.004, 0.004, 0.02])
        rows.append((f"{i:06d}", float(place), 0.0, 5.0, i // 2, None if rng.random() < 0.05 else level[place]))
    df = spark.createDataFrame(rows, "id string, latitude double, longitude double, elevation double, second int, temperature double")
    text = F.date_format(F.timestamp_seconds(F.col("second") * 60), "yyyy-MM-dd'T'HH:mm:ss")
    return df.withColumns({"time_text": text, "event_time": text.cast("timestamp_ntz"), "part": F.floor(F.col("second") * 8 / n)} | {
        c: F.lit(1.0) for c in TOLERANCES if c != "temperature"}).withColumn("location_key", F.col("latitude"))


def as_topic(rows):
    """The readings as cleaned messages."""
    none = F.array().cast("array<double>")
    record = F.struct(
        F.struct("latitude", "longitude", "elevation").alias("location"), F.col("time_text").alias("event_time"),
        F.struct(
            F.col("time_text").alias("time"), F.col("temperature").alias("temperature_2m"),
            F.col("humidity").cast("int").alias("relative_humidity_2m"), "precipitation",
            F.col("wind_speed").alias("wind_speed_10m"), F.col("cloud_cover").cast("int").alias("cloud_cover"),
            F.col("pressure").alias("pressure_msl"),
            F.struct(*[F.lit("u").alias(c) for c in ("temperature", "humidity", "precipitation", "wind_speed", "pressure")]).alias("units"),
        ).alias("current"),
        F.struct(F.array().cast("array<string>").alias("time"), *[none.alias(c) for c in (
            "temperature_2m", "relative_humidity_2m", "precipitation_probability", "precipitation", "wind_speed_10m",
            "cloud_cover", "pressure_msl")]).alias("hourly"),
        F.struct(F.lit("s").alias("source"), F.lit("l").alias("location"), F.col("time_text").alias("normalized_at"),
                 F.struct(F.lit(1.0).alias("completeness"), F.lit(False).alias("has_anomalies"),
                          F.array().cast("array<string>").alias("validation_errors")).alias("data_quality")).alias("metadata"),
    )
    return rows.select(F.col("id").alias("key"), F.to_json(record).alias("value"), "part")


def values_of(calls, spark):
    rows = [r for _, batch in calls for r in batch]
    back = valid_records(spark.createDataFrame(rows, "key string, value string"), "features")
    h = "historical_features"
    return back.select(F.col("key").alias("id"), "base_features.temp_current", f"{h}.temp_lags.*", f"{h}.temp_deltas.*",
                       f"{h}.temp_rolling_6h.*", f"{h}.temp_roc_3h", "metadata.samples_accumulated")


def expected(rows):
    order = ["event_time", "id"]
    accepted = dedup_unchanged(rows, ["location_key"], order)
    flat = X.engineer_features(accepted.withColumn("forecast", F.array().cast("array<double>")), ["location_key"], order)
    h = "historical_features"
    return flat.select("id", "base_features.temp_current", *[f"{h}.temp_lags.lag_{n}h" for n in (1, 2, 3, 6, 12)],
                       *[f"{h}.temp_deltas.delta_{n}h" for n in (1, 3, 6, 12)],
                       *[f"{h}.temp_rolling_6h.{s}_6h" for s in ("mean", "std", "min", "max")], f"{h}.temp_roc_3h",
                       "metadata.samples_accumulated")


@pytest.mark.parametrize("cut", [False, True])
def test_batches_equal_one_batch_job_also_for_a_hot_location(spark, tmp_path, hot, cut):
    rows = readings(spark, 240)
    want = expected(rows)
    want = spark.createDataFrame(want.collect(), want.schema)
    if cut:
        hot(12, 5)  # every location's share of a micro-batch spans several ranges
    sink, ledger = Kept(), Ledger(spark, f"{tmp_path}/ledger")
    run, topic = batches.feature_batches(ledger, sink), as_topic(rows)
    for part in range(4):
        run(topic.filter(F.col("part") == part).drop("part"), part)
    assert [n for n, _ in sink.calls] == [0, 1, 2, 3]
    assert_same_rows(values_of(sink.calls, spark), want, ["id"])
    counts = ledger.notes("counts", batches.FACTS).orderBy("batch").collect()
    assert sum(c["messages"] for c in counts) == 240 and sum(c["processed"] for c in counts) == want.count()
    assert all(c["processed"] + c["duplicates"] == c["messages"] for c in counts)
    assert ledger.numbers("state") == ledger.numbers("messages") == [3]  # tables of earlier batches are gone


@pytest.mark.parametrize("step", ["state", "published"])
def test_a_batch_that_fails_at_any_step_goes_on_and_publishes_once(spark, tmp_path, monkeypatch, step):
    rows = readings(spark, 60)
    topic = as_topic(rows).drop("part")
    sink, ledger = Kept(), Ledger(spark, f"{tmp_path}/ledger")
    plain_table, plain_note, broken = ledger.table, ledger.note, []

    def fail(name):
        if name == step and not broken:
            broken.append(name)
            raise ConnectionError(name)

    monkeypatch.setattr(ledger, "table", lambda name, *a: (fail(name), plain_table(name, *a))[1])
    monkeypatch.setattr(ledger, "note", lambda name, *a: (fail("note"), plain_note(name, *a))[1])
    send = (lambda *a: (fail("published"), sink(*a))[1])
    run = batches.feature_batches(ledger, send)
    with pytest.raises(ConnectionError):
        run(topic, 0)
    run(topic, 0)
    run(topic, 0)
    assert len(sink.calls) == 1
    assert_same_rows(values_of(sink.calls, spark), expected(rows), ["id"])
    assert ledger.notes("counts", batches.FACTS).first()["messages"] == 60


def test_an_empty_batch_and_bad_messages(spark, tmp_path):
    sink, ledger = Kept(), Ledger(spark, f"{tmp_path}/ledger")
    run = batches.feature_batches(ledger, sink)
    run(spark.createDataFrame([], "key string, value string"), 0)
    run(spark.createDataFrame([*BAD, ("null", None)], "key string, value string"), 1)
    assert [rows for _, rows in sink.calls] == [[], []]
    got = [tuple(c[f] for f in batches.FACTS) for c in ledger.notes("counts", batches.FACTS).orderBy("batch").collect()]
    assert got == [(0, 0, 0, 0, 0), (3, 2, 1, 0, 0)]


def test_a_stream_reports_what_it_drops_to_a_listener(spark, sf, tmp_path):
    fed = cleaned_messages(spark, sf).select("key", "value").limit(50)
    fed.unionByName(spark.createDataFrame(BAD, "key string, value string")).write.json(f"{tmp_path}/topic")
    listener = BatchCounts()
    spark.streams.addListener(listener)
    try:
        rows = valid_records(read_topic(spark, f"{tmp_path}/topic"), "cleaned", counted=READ).select("key")
        q = rows.writeStream.option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).format("noop").start()
        q.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.streams.removeListener(listener)
    total = listener.table(spark).agg(*[F.sum(c) for c in ("messages", "undecodable", "invalid")]).first()
    assert tuple(total) == (52, 1, 1) == tuple(sum(r[k] for r in reported(q).values()) for k in ("messages", "undecodable", "invalid"))


def test_the_interval_join_forgets_windows_that_found_their_partners(spark, sf, tmp_path):
    """Two months of readings, a day a file: the joins never hold more than the windows of a few days."""
    rows = observations(spark, sf)
    days = [r[0] for r in rows.select(F.to_date("event_time")).distinct().orderBy(1).collect()][:12]
    schema, path = rows.schema, f"{tmp_path}/rows"
    for d in days:
        rows.filter(F.to_date("event_time") == F.lit(d)).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    joined = chain.windows_within_stream(stream, "10 minutes")
    q = joined.writeStream.option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).format("noop").start()
    q.awaitTermination()
    assert q.exception() is None
    held = [[o.numRowsTotal for o in p.stateOperators if "Join" in o.operatorName] for p in q.recentProgress]
    whole = rows.filter(F.to_date("event_time") <= F.lit(days[-1])).select("latitude", "longitude", F.window("event_time", "1 hour")).distinct()
    assert held and max(max(h) for h in held if h) < whole.count() / 2


def test_a_forgotten_step_is_gone_and_a_broken_one_is_written_again(spark, tmp_path):
    ledger = Ledger(spark, f"{tmp_path}/ledger")
    rows = spark.range(3)
    assert ledger.numbers("step") == [] and not ledger.done("step", 0)
    rows.write.parquet(ledger.path("step", 0))
    (tmp_path / "ledger/step/batch=0/_SUCCESS").unlink()
    assert ledger.numbers("step") == [] and ledger.table("step", 0, lambda: spark.range(5)).count() == 5
    assert ledger.table("step", 0, lambda: rows).count() == 5 and ledger.table("step", 1, lambda: rows).count() == 3
    ledger.forget("step", 1)
    assert ledger.numbers("step") == [1]


def test_a_finished_batch_keeps_its_messages_and_state_only(spark, tmp_path, monkeypatch):
    """A batch that failed after it gave up its first tables goes on without them, and without reading its messages again."""
    rows = readings(spark, 60)
    topic = as_topic(rows).drop("part")
    sink, ledger = Kept(), Ledger(spark, f"{tmp_path}/ledger")
    plain, broken = ledger.table, []

    def table(name, *a):
        if name == "messages" and not broken:
            broken.append({n: ledger.numbers(n) for n in ("rows", "flagged", "featured", "state")})
            raise ConnectionError(name)
        return plain(name, *a)

    monkeypatch.setattr(ledger, "table", table)
    run = batches.feature_batches(ledger, sink)
    with pytest.raises(ConnectionError):
        run(topic, 0)
    assert broken == [{"rows": [], "flagged": [], "featured": [0], "state": [0]}]
    run(topic.limit(0), 0)
    assert_same_rows(values_of(sink.calls, spark), expected(rows), ["id"])
    assert {n: ledger.numbers(n) for n in ("rows", "flagged", "featured", "messages", "state")} == {
        "rows": [], "flagged": [], "featured": [], "messages": [0], "state": [0]}
    assert ledger.notes("counts", batches.FACTS).first()["messages"] == 60
