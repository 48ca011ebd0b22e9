"""Topic streams: Kafka where the connector is on the cluster, or folders of JSON lines with the same envelope."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from skygrain.sources.contracts import REASON, check_contract, parse_once
from skygrain.sources.schemas import CLEANED, FEATURES, RAW, nullable

# How a folder of messages is written (a compressed file is read by one task, so each has few rows), delivery
# settings of the topic writer and the view names of the typed streams.
FOLDER_OPTIONS = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "20000"}
WRITER_OPTIONS = {"kafka.acks": "all", "kafka.retries": "3", "kafka.max.in.flight.requests.per.connection": "1"}
VIEWS = {"raw_weather": RAW, "cleaned_weather": CLEANED, "features_hourly": FEATURES}


def read_topic(spark: SparkSession, source: str, servers: str | None = None, per_batch: int | None = None) -> DataFrame:
    """A stream of (key, value) text from the start of a topic.

    With ``servers`` the source is a Kafka topic, else a folder of JSON lines with ``key`` and ``value``. ``per_batch``
    bounds a micro-batch (offsets or files).
    """
    if servers:
        reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        reader = reader.option("subscribe", source).option("startingOffsets", "earliest")
        if per_batch:
            reader = reader.option("maxOffsetsPerTrigger", per_batch)
        return reader.load().select(F.col("key").cast("string"), F.col("value").cast("string"))
    reader = spark.readStream.schema("key STRING, value STRING")
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.json(source)


def read_topic_table(spark: SparkSession, source: str, servers: str | None = None) -> DataFrame:
    """Every retained message of a topic as a bounded table (a full replay that commits nothing)."""
    if servers:
        reader = spark.read.format("kafka").option("kafka.bootstrap.servers", servers)
        rows = reader.option("subscribe", source).option("startingOffsets", "earliest").load()
        return rows.select(F.col("key").cast("string"), F.col("value").cast("string"), "topic", "partition", "offset",
                           "timestamp")
    return spark.read.schema("key STRING, value STRING").json(source)


def valid_records(messages: DataFrame, contract: str, counted: str | None = None) -> DataFrame:
    """Key and record fields of the messages that meet the contract; the rest is dropped.

    ``counted`` names the observation under which a stream reports what was read and dropped, batch by batch.
    """
    checked = check_contract(messages, contract)
    if counted:
        from skygrain.streaming.counts import observed

        checked = observed(checked, counted)
    return checked.filter(F.col(REASON).isNull()).select("key", "record.*")


def declare_streams(spark: SparkSession, sources: dict[str, str], servers: str | None = None) -> None:
    """Register typed temporary views over the raw, cleaned and features topics (keys of ``sources``: view names)."""
    for view, source in sources.items():
        rows = read_topic(spark, source, servers)
        record = F.from_json("value", nullable(VIEWS[view])).alias("record")
        parse_once(rows, record).select("key", "record.*").createOrReplaceTempView(view)


def as_messages(df: DataFrame, key: str = "key") -> DataFrame:
    """Typed rows to keyed JSON."""
    fields = [c for c in df.columns if c != key]
    return df.select(F.col(key), F.to_json(F.struct(*fields)).alias("value"))


def land(messages: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    """Keyed JSON to a folder that stands in for a topic, compressed: the same names in every message take most of its size."""
    messages.write.mode(mode).options(**FOLDER_OPTIONS).json(folder)


def write_topic(df: DataFrame, target: str, checkpoint: str, servers: str | None = None, once: bool = True) -> StreamingQuery:
    """Write keyed JSON to a topic or folder; ``once`` processes what is there and stops."""
    writer = as_messages(df).writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    if once:
        writer = writer.trigger(availableNow=True)
    if servers:
        options = {"kafka.bootstrap.servers": servers, "topic": target, **WRITER_OPTIONS}
        return writer.format("kafka").options(**options).start()
    return writer.format("json").options(**FOLDER_OPTIONS).option("path", target).start()
