"""The streaming chain: normalise, engineer features, windows, serve. Each step is one query with its own checkpoint."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from skygrain.functions.values import location_text, now_iso
from skygrain.operators.dataset import flatten_features
from skygrain.operators.features import assemble_features, contract_features, observations_of
from skygrain.operators.normalize import normalize, parse_raw
from skygrain.operators.serving import leaf_tables, prediction_records, score_horizons, with_model_names
from skygrain.operators.windows import PLACE, tumbling, watermarked
from skygrain.sources.contracts import conforms
from skygrain.sources.schemas import TOPICS
from skygrain.sources.streams import WRITER_OPTIONS, as_messages, land, valid_records
from skygrain.streaming.ledger import Ledger
from skygrain.streaming.state import with_history


def normalize_stream(messages: DataFrame) -> DataFrame:
    """Raw messages to cleaned records, keyed as they came; invalid ones are dropped. No state."""
    return normalize(parse_raw(messages))


def feature_stream(messages: DataFrame, dedup: bool = True) -> DataFrame:
    """Cleaned messages to feature records that meet the features contract. State per location."""
    cleaned = valid_records(messages, "cleaned")
    flat = observations_of(cleaned)
    ready = flat.withColumns(
        {
            "location_key": location_text(F.col("latitude"), F.col("longitude")),
            "event_time": F.col("time_text").try_cast("timestamp_ntz"),
            "id": F.col("key"),
        }
    )
    features = assemble_features(with_history(ready, "location_key", dedup))
    return conforms(contract_features(features.withColumnRenamed("id", "key").drop("location_key")), "features")


def tumbling_stream(stream: DataFrame, hours: int, watermark: str = "10 minutes", **names) -> DataFrame:
    """Window aggregates of a stream: ``update`` output refines them, ``append`` emits each once it is final."""
    return tumbling(stream, hours, watermark=watermark, **names)


def windows_joined_stream(stream: DataFrame, watermark: str = "10 minutes", time: str = "event_time",
                          arrival: str = "id") -> DataFrame:
    """Each final 1-hour window beside the 3- and 6-hour windows that contain it (append output).

    Coarse windows are aggregated from the same stream, and the sides meet on place and the 6-hour window, which
    also bounds the join state by the watermark.
    """
    src = watermarked(stream, time, watermark)

    def side(h: int) -> DataFrame:
        t = tumbling(src, h, time=time, arrival=arrival, keep_window=True)
        renamed = [
            F.col(c).alias(f"{c}_{h}h") if h > 1 and c in ("temp_last", "temp_first", "window_start", "window_end")
            else F.col(c)
            for c in t.columns if c not in (*PLACE, "window")
        ]
        grown = t.select(*PLACE, F.window(F.col("window"), f"{h} hours").alias("_w"), *renamed) if h > 1 else t.select(
            *PLACE, "window", *renamed)
        return grown

    one = side(1)
    for h in (3, 6):
        left = one.withColumn("_w", F.window(F.col("window"), f"{h} hours"))
        one = left.join(side(h), [*PLACE, "_w"], "left").drop("_w")
    return one.drop("window")


def windows_within_stream(stream: DataFrame, watermark: str = "10 minutes", time: str = "event_time",
                          arrival: str = "id") -> DataFrame:
    """Each final 1-hour window beside every 3-hour window that ends within 3 hours of it and every 6-hour one within 6.

    Left interval joins of three aggregates of one stream (append output). Each side brings its watermark, and the
    bound on the ends says how long a window can still find a partner, so the state that the joins hold is that of
    the last hours before the watermark. A window without a partner comes out once none can come any more.
    """
    src = watermarked(stream, time, watermark)

    def side(h: int) -> DataFrame:
        t = tumbling(src, h, time=time, arrival=arrival, keep_window=True)
        if h == 1:
            return t.withColumn("_at", F.window_time("window")).drop("window")
        names = {c: f"{c}_{h}h" for c in (*PLACE, "temp_last", "temp_first")} | {"window_end": f"end_{h}h"}
        kept = [F.col(c).alias(names.get(c, c)) for c in t.columns if c not in ("window", "window_start")]
        return t.select(F.window_time("window").alias(f"_at_{h}h"), *kept)

    out = side(1)
    for h in (3, 6):
        reach, at = F.expr(f"INTERVAL {h} HOURS"), F.col(f"_at_{h}h")
        near = (at >= F.col("_at") - reach) & (at <= F.col("_at") + reach)
        same = [F.col(c) == F.col(f"{c}_{h}h") for c in PLACE]
        out = out.join(side(h), near & same[0] & same[1], "left").drop(f"_at_{h}h", *[f"{c}_{h}h" for c in PLACE])
    return out.drop("_at")


Sink = Callable[[DataFrame, str, int], None]


def folder_sink(points: str, quantiles: str, features: str | None = None) -> Sink:
    """Messages to folders. The batch number is part of the path, so a repeated batch overwrites its own output."""
    folders = {"predictions": points, "predictions_quantiles": quantiles, "features": features}

    def write(messages: DataFrame, contract: str, number: int) -> None:
        land(messages, f"{folders[contract]}/batch={number}", "overwrite")

    return write


def topic_sink(servers: str) -> Sink:
    """Messages to the two prediction topics; a repeated batch sends its records, under the same keys, again."""
    def write(messages: DataFrame, contract: str, number: int) -> None:
        options = {"kafka.bootstrap.servers": servers, "topic": TOPICS[contract], **WRITER_OPTIONS}
        messages.write.format("kafka").options(**options).save()

    return write


def noop_sink(messages: DataFrame, contract: str, number: int) -> None:
    """Scores everything and keeps nothing (a dry run)."""
    messages.write.format("noop").mode("overwrite").save()


def prediction_batches(spark: SparkSession, models: Mapping[int, tuple[PipelineModel, Sequence[str]]], sink: Sink,
                       align: bool = False, ledger: Ledger | None = None):
    """A ``foreachBatch`` function: one batch of feature messages to point and quantile records.

    ``align`` maps streaming feature names to those of the models; by default unknown names are served as 0.0.

    Leaf tables are made once, here. A batch is decoded and scored once and kept for both writes. A record without
    quantiles (a boosted model has none) still gives its point; a failing write fails the batch, which is then repeated.

    With a ``ledger`` the scores and the time they were made are written to it first, and each topic is served from
    there once: a repeated batch sends what is still missing, and that with the records of the first attempt.
    """
    tables = leaf_tables(spark, models)
    served = ("predictions", "predictions_quantiles")

    def flat_features(batch: DataFrame) -> DataFrame:
        flat = flatten_features(valid_records(batch, "features"), ["key"])
        return with_model_names(flat) if align else flat

    def both(scored: DataFrame) -> dict[str, DataFrame]:
        records = prediction_records(scored, F.col("horizon_hours"), "timestamp", ["key"])
        return {c: as_messages(conforms(r, c)) for c, r in zip(served, records)}

    def run_once(batch: DataFrame, number: int) -> None:
        if all(ledger.done(f"sent-{c}", number) for c in served):
            return
        scored = ledger.table("scored", number, lambda: score_horizons(
            flat_features(batch), models, tables, keep=["key"]).withColumn("created_at", now_iso()))
        for contract, messages in both(scored).items():
            ledger.once(f"sent-{contract}", number, lambda c=contract, m=messages: sink(m, c, number))
        ledger.forget("scored", number)

    if ledger is not None:
        return run_once

    def run(batch: DataFrame, number: int) -> None:
        flat = flat_features(batch).persist(StorageLevel.MEMORY_AND_DISK)
        scored = score_horizons(flat, models, tables, keep=["key"]).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for contract, messages in both(scored).items():
                sink(messages, contract, number)
        finally:
            scored.unpersist()
            flat.unpersist()

    return run


def serve_stream(messages: DataFrame, models: Mapping[int, tuple[PipelineModel, Sequence[str]]], sink: Sink,
                 checkpoint: str, align: bool = False, every: str | None = None, ledger: Ledger | None = None) -> StreamingQuery:
    """Serve what is there and stop, or keep running with a batch ``every`` so often (as "10 seconds")."""
    writer = messages.writeStream.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.foreachBatch(prediction_batches(messages.sparkSession, models, sink, align, ledger)).start()
