"""Queries that replay topics through the streaming chain: features with restart, counts, window joins, serving, datasets."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from registry.book import ORACLES, query
from registry.observations import (
    BASE_SQL, COUNT_SQL, CYCLE_SQL, FLAGS_SQL, HISTORY, JOIN_COLS, SAMPLES_SQL, TARGET_SQL, cleaned_observations, feature_input,
    feature_records, with_obs,
)
from registry.roundtrips import finish, raw_topic
from registry.views import KEY, OBS, ORDER, observations, r, rounded
from skygrain.operators import features as X, training
from skygrain.operators.dedup import TOLERANCES
from skygrain.operators.features import contract_features
from skygrain.operators.samples import feature_completeness
from skygrain.operators.serving import LEAVES, QUANTILES, VECTOR
from skygrain.plans.durable import fresh_path, freed, materialize
from skygrain.plans.jobs import build_dataset
from skygrain.sources.contracts import conforms
from skygrain.sources.models import load_models, save_models
from skygrain.sources.schemas import MODEL_FEATURES, OBSERVED
from skygrain.sources.streams import as_messages, land, read_topic, read_topic_table, valid_records
from skygrain.sources.tables import PARQUET_NAME, load_performance, save_metrics_json
from skygrain.streaming import chain
from skygrain.streaming.batches import FACTS, run_features
from skygrain.streaming.counts import READ_FACTS, reported
from skygrain.streaming.ledger import Ledger

BAD = [("bad", '{"location":1}'), ("worse", "not json")]


# Every third reading arrives twice. Times are to the second, as the messages have them.
_VALUES = ", ".join(TOLERANCES)
_DIFFERS = " OR ".join(f"(s.{c} IS NULL) <> (f.a_{c} IS NULL) OR coalesce(abs(s.{c} - f.a_{c}) > {t}, false)" for c, t in TOLERANCES.items())
FED_SQL = f"""WITH RECURSIVE {OBS.replace('obs AS', 'given AS', 1)},
  fed AS (SELECT id * 2 AS id, id AS oid, location, date_trunc('second', event_time) AS event_time, latitude, longitude, elevation,
      {_VALUES} FROM given
    UNION ALL SELECT id * 2 + 1, id, location, date_trunc('second', event_time), latitude, longitude, elevation, {_VALUES}
      FROM given WHERE id % 3 = 0),
  s AS (SELECT *, row_number() OVER (PARTITION BY location ORDER BY event_time, id) AS k FROM fed),
  f AS (SELECT *, {', '.join(f'{c} AS a_{c}' for c in TOLERANCES)}, true AS accepted FROM s WHERE k = 1 UNION ALL
    SELECT s.*, {', '.join(f'CASE WHEN {_DIFFERS} THEN s.{c} ELSE f.a_{c} END' for c in TOLERANCES)}, {_DIFFERS}
    FROM f JOIN s ON s.location = f.location AND s.k = f.k + 1)"""


def cleaned_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned records of the observations as keyed JSON, every third one twice, beside their ``event_time``."""
    rows = feature_input(spark, sf_dir)
    n, text = F.col("id"), F.col("time_text")
    hours = F.sequence(F.lit(1), F.size("forecast"))
    of_hours = lambda kind, value: F.when(F.size("forecast") > 0, F.transform(hours, lambda i: value.cast(kind))).otherwise(
        F.array().cast(f"array<{kind}>"))
    record = F.struct(
        F.struct("latitude", "longitude", "elevation").alias("location"), text.alias("event_time"),
        F.struct(
            text.alias("time"), F.col("temperature").alias("temperature_2m"), F.col("humidity").alias("relative_humidity_2m"),
            "precipitation", F.col("wind_speed").alias("wind_speed_10m"), "cloud_cover", F.col("pressure").alias("pressure_msl"),
            F.struct(*[F.lit(u).alias(c) for c, u in (("temperature", "°C"), ("humidity", "%"), ("precipitation", "mm"),
                                                      ("wind_speed", "km/h"), ("pressure", "hPa"))]).alias("units"),
        ).alias("current"),
        F.struct(
            of_hours("string", text).alias("time"), F.col("forecast").alias("temperature_2m"),
            *[of_hours(k, F.lit(0)).alias(c) for c, k in (
                ("relative_humidity_2m", "int"), ("precipitation_probability", "int"), ("precipitation", "double"),
                ("wind_speed_10m", "double"), ("cloud_cover", "int"), ("pressure_msl", "double"))],
        ).alias("hourly"),
        F.struct(
            F.concat(F.lit("sensor-"), n % 4).alias("source"), F.concat_ws(",", "latitude", "longitude").alias("location"),
            text.alias("timestamp"), text.alias("normalized_at"),
            F.struct(F.lit(1.0).alias("completeness"), F.lit(False).alias("has_anomalies"),
                     F.array().cast("array<string>").alias("validation_errors")).alias("data_quality"),
        ).alias("metadata"),
    )
    copies = F.when(n % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    fed = rows.select(n, "event_time", F.to_json(record).alias("value")).withColumn("copy", F.explode(copies))
    return fed.select(F.format_string("%016d", F.col("id") * 2 + F.col("copy")).alias("key"), "value", "event_time")


def replayed(spark: SparkSession, sf_dir: str, dedup: bool) -> tuple[Ledger, str]:
    """Feature records of the cleaned topic. The stream is stopped half way and goes on from its checkpoint.

    The earlier half of the time span is landed first, each half with two messages that are not sound.
    """
    fed, topic, out = cleaned_messages(spark, sf_dir), fresh_path(spark, "cleaned-topic"), fresh_path(spark, "feature-topic")
    ledger, checkpoint = Ledger(spark, fresh_path(spark, "feature-ledger")), fresh_path(spark, "stream-state")
    ends = fed.agg(F.min("event_time").alias("a"), F.max("event_time").alias("b")).first()
    half = (ends["a"] + (ends["b"] - ends["a"]) / 2).replace(microsecond=0)
    bad = spark.createDataFrame(BAD, "key STRING, value STRING")
    for rows in (fed.filter(F.col("event_time") < half), fed.filter(F.col("event_time") >= half)):
        land(rows.select("key", "value").unionByName(bad), topic, "append")
        finish(run_features(read_topic(spark, topic), ledger, chain.folder_sink("", "", out), checkpoint, dedup))
    return ledger, out


KEPT_HISTORY = ("temp_mean_3h temp_std_3h temp_min_3h temp_max_3h temp_mean_6h temp_std_6h temp_min_6h temp_max_6h "
                "temp_delta_1h temp_delta_3h temp_delta_6h temp_delta_12h temp_roc_3h temp_roc_6h temp_lag_1h temp_lag_2h "
                "temp_lag_3h temp_lag_6h temp_lag_12h temp_volatility_6h").split()
_FED_TARGETS = [(re.sub(r"\bid % 9", "oid % 9", e), n) for e, n in TARGET_SQL]
_RECORD_SQL = ", ".join(r(e, n) for e, n in BASE_SQL + [h for h in HISTORY if h[1] in KEPT_HISTORY] + CYCLE_SQL + _FED_TARGETS)


@query("feature_replay", f"""{FED_SQL}, obs AS (SELECT * FROM f WHERE accepted)
  SELECT id, latitude, longitude, elevation, strftime(event_time, '%Y-%m-%dT%H:%M:%S') AS time_text, {_RECORD_SQL}, {FLAGS_SQL},
    CAST({SAMPLES_SQL} AS INTEGER) AS samples_accumulated, CAST({COUNT_SQL} AS INTEGER) AS feature_count,
    'sensor-' || (oid % 4) AS source FROM obs""")
def feature_replay(spark, sf_dir):
    """Cleaned topic to feature topic by micro-batches, with dedup and a restart; the topic is read back."""
    _, out = replayed(spark, sf_dir, True)
    h, topic = "historical_features", read_topic_table(spark, out)
    back = valid_records(topic, "features")
    source = topic.select("key", F.get_json_object("value", "$.metadata.source").alias("source"))
    leaves = [F.col(f"{h}.temp_rolling_{n}h.{x}_{n}h").alias(f"temp_{x}_{n}h") for n in (3, 6) for x in ("mean", "std", "min", "max")]
    leaves += [F.col(f"{h}.temp_{kind}s.{kind}_{n}h").alias(f"temp_{kind}_{n}h")
               for kind, ns in (("delta", (1, 3, 6, 12)), ("lag", (1, 2, 3, 6, 12))) for n in ns]
    return rounded(back.join(source, "key").select(
        F.col("key").cast("long").alias("id"), "location.*", F.col("timestamp").alias("time_text"), "base_features.*", *leaves,
        f"{h}.temp_roc_3h", f"{h}.temp_roc_6h", f"{h}.temp_volatility_6h", "cyclical_features.*", "target_labels.*",
        "metadata.samples_accumulated", "metadata.feature_count", "source"))


@query("feature_counts", f"""{FED_SQL} SELECT CAST(count(*) + 4 AS BIGINT) AS messages, CAST(2 AS BIGINT) AS undecodable,
    CAST(2 AS BIGINT) AS invalid, count(*) FILTER (accepted) AS processed, count(*) FILTER (NOT accepted) AS duplicates FROM f""")
def feature_counts(spark, sf_dir):
    """What the feature stream read, could not decode, rejected, accepted and found unchanged, summed over its batches."""
    ledger, _ = replayed(spark, sf_dir, True)
    return ledger.notes("counts", FACTS).agg(*[F.sum(f).alias(f) for f in FACTS])


@query("stream_counts", with_obs("SELECT count(*) + 2 AS messages, 1 AS undecodable, 1 AS invalid FROM obs"))
def stream_counts(spark, sf_dir):
    """The counts that a plain stream over the raw topic reports of each micro-batch, summed."""
    rows = valid_records(read_topic(spark, raw_topic(spark, sf_dir)), "raw", counted="messages_read")
    writer = rows.select("key").writeStream.option("checkpointLocation", fresh_path(spark, "stream-state"))
    stream = writer.trigger(availableNow=True).format("parquet").option("path", fresh_path(spark, "raw-keys")).start()
    finish(stream)
    counts = [(batch, *[found[f] for f in READ_FACTS]) for batch, found in reported(stream).items()]
    per_batch = spark.createDataFrame(counts, "batch long, " + ", ".join(f"{f} long" for f in READ_FACTS))
    return per_batch.agg(*[F.sum(f).alias(f) for f in READ_FACTS])


@query("window_within_replay", ORACLES["window_join_within"])
def window_within_replay(spark, sf_dir):
    """The interval join of windows on a stream. A reading long after the rest closes every window."""
    rows, path = observations(spark, sf_dir), fresh_path(spark, "observations")
    after = rows.agg(F.max("event_time").alias("t")).select((F.date_trunc("day", "t") + F.expr("INTERVAL 40 DAYS")).alias("t")).first()["t"]
    rows.write.parquet(path)
    rows.limit(1).withColumn("event_time", F.lit(after).cast(rows.schema["event_time"].dataType)).write.mode("append").parquet(path)
    joined = chain.windows_within_stream(spark.readStream.schema(rows.schema).parquet(path), "1 hour")
    out = fresh_path(spark, "windows-within")
    writer = joined.writeStream.option("checkpointLocation", fresh_path(spark, "stream-state")).trigger(availableNow=True)
    finish(writer.format("parquet").option("path", out).start())
    back = spark.read.schema(joined.schema).parquet(out)
    ends = {c: F.col(c).cast("timestamp_ntz") for c in ("window_end", "end_3h", "end_6h")}
    return rounded(back.withColumns(ends).filter(F.col("window_end") < F.lit(after)).select(*JOIN_COLS))


class _FailsOnce:
    """A sink that adds to a folder, and breaks down once before the second topic of a batch."""

    def __init__(self, folder: str):
        self.folder, self.failed = folder, False

    def __call__(self, messages: DataFrame, contract: str, number: int) -> None:
        if contract == "predictions_quantiles" and not self.failed:
            self.failed = True
            raise ConnectionError("the topic cannot be reached")
        land(messages, f"{self.folder}/{contract}", "append")


def small_forests(spark, sf_dir):
    full = X.engineer_features_batch(cleaned_observations(spark, sf_dir), KEY, ORDER, "event_time", targets=True)
    used = [c for c in full.columns if c in (*KEY, *ORDER, *MODEL_FEATURES) or c.startswith("target_temperature_")]
    full = materialize(full.select(*used), "engineered")
    frame, names = training.training_frame(full, KEY, ORDER)
    return training.train_all_horizons(frame, names, numTrees=8, maxDepth=4), names, full, frame


@query("serve_replay", with_obs("""SELECT topic, horizon_hours, count(*) AS records, count(DISTINCT id) AS keys, true AS in_order, 1 AS times_made
  FROM obs, (VALUES ('predictions'), ('predictions_quantiles')) AS t (topic), (VALUES (1), (3), (6)) AS h (horizon_hours) GROUP BY ALL"""))
def serve_replay(spark, sf_dir):
    """Feature topic to both prediction topics through saved models; the first attempt fails between the topics.

    ``times_made`` counts the different creation times of a key's records in both topics together, per horizon.
    """
    (models, _), names, _, _ = small_forests(spark, sf_dir)
    store, out, topic = (fresh_path(spark, n) for n in ("models", "predictions", "feature-topic"))
    save_models(spark, models, names, store)
    features = feature_records(spark, sf_dir).drop("location_key").withColumn("id", F.col("id").cast("string"))
    with freed(spark):
        land(as_messages(conforms(contract_features(features.withColumnRenamed("id", "key")), "features")), topic)
    ledger, checkpoint, sink = Ledger(spark, fresh_path(spark, "serve-ledger")), fresh_path(spark, "stream-state"), _FailsOnce(out)
    serve = lambda: chain.serve_stream(
        read_topic(spark, topic), load_models(spark, store), sink, checkpoint, align=True, ledger=ledger)
    try:
        serve().awaitTermination()
    except Exception as exc:  # the planted failure, which Spark wraps
        if "cannot be reached" not in str(exc):
            raise
    finish(serve())
    parts = []
    for contract in ("predictions", "predictions_quantiles"):
        back = valid_records(read_topic_table(spark, f"{out}/{contract}"), contract)
        low, mid, high = (F.col(q) if q in back.columns else F.lit(0) for q in QUANTILES)
        parts.append(back.select(F.lit(contract).alias("topic"), "key", "horizon_hours", "created_at",
                                 ((low <= mid) & (mid <= high)).alias("ordered")))
    both = parts[0].unionByName(parts[1])
    made = both.groupBy("key", "horizon_hours").agg(F.count_distinct("created_at").alias("made"))
    return both.join(made, ["key", "horizon_hours"]).groupBy("topic", "horizon_hours").agg(
        F.count(F.lit(1)).alias("records"), F.count_distinct("key").alias("keys"), F.every("ordered").alias("in_order"),
        F.max("made").cast("int").alias("times_made"))


def same_predictions(rows: DataFrame, models, back) -> DataFrame:
    """Per horizon whether the loaded model predicts for every row exactly what the saved one predicts."""
    parts = []
    for h, model in models.items():
        before = model.transform(rows).select(*rows.columns, F.col("prediction").alias("predicted"))
        after = back[h][0].transform(before).drop(VECTOR, LEAVES)
        parts.append(after.agg(F.every(F.col("predicted").eqNullSafe(F.col("prediction"))).alias("alike"))
                     .withColumn("horizon", F.lit(f"{h}h")))
    return reduce(DataFrame.unionByName, parts)


@query("metrics_round_trip", """SELECT h || 'h' AS horizon, true AS scored, true AS loaded, 3 AS models
  FROM (VALUES (1), (3), (6)) AS t (h)""")
def metrics_round_trip(spark, sf_dir):
    """Models and their scores saved and loaded again: every horizon, the same scores and the same predictions.

    Every score of both sides is compared, and the predictions of the loaded models with those of the saved ones, row by row.
    """
    (models, scores), names, full, frame = small_forests(spark, sf_dir)
    scores, store = materialize(scores, "scores"), fresh_path(spark, "models")
    save_models(spark, models, names, store)
    save_metrics_json(scores, feature_completeness(full, names), store)
    back = load_models(spark, store)
    same = back.keys() == models.keys() and all(
        back[h][1] == names and back[h][0].stages[-1].getNumTrees == m.stages[-1].getNumTrees
        and back[h][0].stages[-1].totalNumNodes == m.stages[-1].totalNumNodes for h, m in models.items())
    saved = load_performance(spark, store)
    left, right = ([F.col(f"{side}.{c}") for c in scores.columns if c != "horizon"] for side in "sb")
    close = reduce(Column.__and__, [
        F.coalesce(F.abs(x - y) < 1e-9, x.isNull() & y.isNull()) for x, y in zip(left, right)])
    alike = same_predictions(frame, models, back) if same else scores.select("horizon", F.lit(False).alias("alike"))
    return scores.alias("s").join(saved.alias("b"), F.col("s.horizon") == F.col("b.horizon")).join(
        alike.alias("p"), F.col("s.horizon") == F.col("p.horizon")).select(
        "s.horizon", close.alias("scored"), F.col("p.alike").alias("loaded"), F.lit(len(back)).alias("models"))


_OBS_DOUBLES = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in OBSERVED)


@query("dataset_job", with_obs(f""", flat AS (SELECT latitude, longitude, date_trunc('second', event_time) AS ts, id % 2 AS is_new,
      {_OBS_DOUBLES} FROM obs),
  kept AS (SELECT * FROM flat QUALIFY row_number() OVER (PARTITION BY {', '.join(OBSERVED)}
      ORDER BY is_new DESC, ts DESC, latitude DESC, longitude DESC) = 1)
  SELECT latitude, longitude, ts AS "timestamp", temperature, humidity, {r(f"""lead(temperature, 3) OVER (PARTITION BY latitude, longitude
      ORDER BY ts, {', '.join(f'{c} NULLS FIRST' for c in OBSERVED)})""", 'target_temperature_horizon_3h')} FROM kept"""))
def dataset_job(spark, sf_dir):
    """Two runs of the dataset job over a feature topic: the even messages, then the odd ones merged with the first result."""
    topic, output = fresh_path(spark, "feature-topic"), fresh_path(spark, "datasets")
    records = contract_features(feature_records(spark, sf_dir).drop("location_key"))
    with freed(spark):
        land(as_messages(records.withColumn("id", F.col("id").cast("string")).withColumnRenamed("id", "key")), topic)
    messages = read_topic_table(spark, topic)
    odd = F.col("key").cast("long") % 2 == 1
    first, _ = build_dataset(messages.filter(~odd), output, order=["key"])
    second, _ = build_dataset(messages.filter(odd), output, order=["key"], existing=first)
    saved = spark.read.parquet(f"{second}/{PARQUET_NAME}").withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    return rounded(saved.select("latitude", "longitude", "timestamp", "temperature", "humidity", "target_temperature_horizon_3h"))
