"""Queries over topic messages: required keys, contracts, bounded reads, backlog."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from registry.book import query
from registry.views import MSG, RAW, OBS, messages, raw_records
from skygrain.operators import monitoring as Q, normalize as N, topics as K
from skygrain.sources.contracts import check_contract, validate_contract
from skygrain.sources.schemas import RAW as RAW_CONTRACT, TOPICS

FAULTS = ("none", "no latitude", "fraction for int", "extra field", "text for number", "number for text", "cut off",
          "null array")


def json_messages(spark, sf_dir) -> DataFrame:
    """Every raw record as JSON; by its id it is sound, has an extra field, or one of six faults."""
    fault = F.col("id") % len(FAULTS)
    rows = raw_records(spark, sf_dir)
    kept = [F.when(fault != 1, F.col("latitude")).alias("latitude")] + [
        F.col(c) for c in RAW_CONTRACT.fieldNames() if c != "latitude"]
    sound = rows.select("id", "location", F.to_json(F.struct(*kept)).alias("value"))
    value = F.col("value")
    broken = (
        F.when(fault == 2, F.regexp_replace(value, r'"wind_direction_10m":(\d+)', r'"wind_direction_10m":$1.5'))
        .when(fault == 3, F.regexp_replace(value, r"^\{", '{"extra":{"a":1},'))
        .when(fault == 4, F.regexp_replace(value, r'"latitude":([0-9.]+)', r'"latitude":"$1"'))
        .when(fault == 5, F.regexp_replace(value, '"source":"sensor"', '"source":5'))
        .when(fault == 6, F.expr("substring(value, 1, length(value) - 5)"))
        .when(fault == 7, F.regexp_replace(value, r'"hourly":\{', '"hourly":{"pressure_msl":null,'))
        .otherwise(value)
    )
    return sound.select("id", "location", broken.alias("value"))


SOUND = "id % 8 IN (0, 3)"
REASON = """CASE id % 8 WHEN 1 THEN 'missing field' WHEN 2 THEN 'wrong type' WHEN 4 THEN 'wrong type' WHEN 5 THEN 'wrong type'
    WHEN 6 THEN 'not json' WHEN 7 THEN 'wrong type' END"""


@query("require_fields", f"WITH {OBS} SELECT id, id % 8 NOT IN (1, 6) AS has_fields FROM obs")
def require_fields(spark, sf_dir):
    return json_messages(spark, sf_dir).select("id", N.has_required_keys(F.col("value")).alias("has_fields"))


@query("contract_valid", f"""WITH {OBS}, {RAW} SELECT id, latitude, longitude, hours AS hourly_rows,
    CASE WHEN id % 2 = 0 THEN hours ELSE 0 END AS pressure_rows, coalesce(r_unit, 'mm') AS precipitation_unit FROM raw WHERE {SOUND}""")
def contract_valid(spark, sf_dir):
    valid, _ = validate_contract(json_messages(spark, sf_dir), "raw")
    return valid.select("id", "record.latitude", "record.longitude", F.size("record.hourly.time").alias("hourly_rows"),
                        F.size("record.hourly.pressure_msl").alias("pressure_rows"),
                        F.col("record.current_units.precipitation").alias("precipitation_unit"))


@query("contract_rejected", f"WITH {OBS} SELECT id, {REASON} AS reject_reason FROM obs WHERE NOT ({SOUND})")
def contract_rejected(spark, sf_dir):
    _, rejected = validate_contract(json_messages(spark, sf_dir), "raw")
    return rejected.select("id", "reject_reason")


@query("contract_report", f"""WITH {OBS} SELECT coalesce({REASON}, 'valid') AS outcome, count(*) AS n FROM obs GROUP BY 1""")
def contract_report(spark, sf_dir):
    checked = check_contract(json_messages(spark, sf_dir), "raw")
    return checked.groupBy(F.coalesce("reject_reason", F.lit("valid")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query("topic_bounded_read", f"WITH {OBS} SELECT id, location FROM obs WHERE {SOUND} ORDER BY id LIMIT 1000")
def topic_bounded_read(spark, sf_dir):
    return K.bounded_read(json_messages(spark, sf_dir), "raw", 1000, ["id"]).select("id", "location")


BROKEN_ID, IDLE = 504, 6  # with its neighbours one more broken message makes a run of seven invalid ones


@query("topic_stop_read", f"""WITH {OBS}, m AS (SELECT id, location, {SOUND} AND id <> {BROKEN_ID} AS ok FROM obs),
  n AS (SELECT *, coalesce(sum(CAST(ok AS INTEGER)) OVER (ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM m),
  stop AS (SELECT min(before) AS halt FROM (SELECT before FROM n WHERE NOT ok GROUP BY before HAVING count(*) >= {IDLE}))
  SELECT id, location FROM n, stop WHERE ok AND (halt IS NULL OR before < halt)""")
def topic_stop_read(spark, sf_dir):
    """The valid messages up to the first run of six invalid ones."""
    m = json_messages(spark, sf_dir)
    planted = m.withColumn("value", F.when(F.col("id") == BROKEN_ID, F.lit("not json")).otherwise(F.col("value")))
    return K.bounded_read(planted, "raw", None, ["id"], stop_after=IDLE).select("id", "location")


@query("latest_n", f"WITH {MSG} SELECT event_id, topic, ts AS timestamp FROM msg ORDER BY ts DESC, event_id DESC LIMIT 1000")
def latest_n(spark, sf_dir):
    m = messages(spark, sf_dir)
    return K.latest_n(m, 1000, ["timestamp", "event_id"]).select("event_id", "topic", "timestamp")


@query("first_n", f"WITH {MSG} SELECT event_id, topic, ts AS timestamp FROM msg ORDER BY ts, event_id LIMIT 1000")
def first_n(spark, sf_dir):
    m = messages(spark, sf_dir)
    return K.first_n(m, 1000, ["timestamp", "event_id"]).select("event_id", "topic", "timestamp")


BACKLOG = f"""WITH {MSG}, part_log AS (SELECT topic, part, min(off) AS low, max(off) + 1 AS high FROM msg GROUP BY ALL),
  topic_log AS (SELECT topic, CAST(sum(high - low) AS BIGINT) AS total_messages, count(*) AS partition_count FROM part_log GROUP BY topic),
  backlog AS (SELECT w.topic, total_messages, partition_count, CASE WHEN partition_count IS NULL THEN 'Topic not found' END AS error
    FROM (SELECT unnest({list(TOPICS.values())}) AS topic) w LEFT JOIN topic_log USING (topic))"""


def backlog(spark, sf_dir) -> DataFrame:
    return K.topic_backlog(messages(spark, sf_dir), list(TOPICS.values()))


@query("partition_backlog", f"{BACKLOG} SELECT topic, part AS partition, low, high, high - low AS available FROM part_log")
def partition_backlog(spark, sf_dir):
    return K.partition_backlog(messages(spark, sf_dir))


@query("topic_backlog", f"{BACKLOG} SELECT * FROM backlog")
def topic_backlog(spark, sf_dir):
    return backlog(spark, sf_dir)


@query("total_backlog", f"{BACKLOG} SELECT CAST(sum(total_messages) AS BIGINT) AS total_backlog, count(*) AS topics FROM backlog WHERE error IS NULL")
def total_backlog(spark, sf_dir):
    return K.total_backlog(backlog(spark, sf_dir))


@query("schema_check", """WITH k AS (SELECT key, count(*) AS n FROM (SELECT unnest(json_keys(props)) AS key FROM events) WHERE key IN ('k', 'unit') GROUP BY key)
  SELECT count(*) = 2 AS is_valid, CASE WHEN count(*) FILTER (key = 'k') = 0 THEN 'k,unit' ELSE 'unit' END AS missing_fields,
    count(*) * 50.0::DOUBLE AS completeness, max(n) AS most_common FROM k""")
def schema_check(spark, sf_dir):
    from registry.views import table

    return Q.schema_check(table(spark, sf_dir, "events"), ["k", "unit"], "props")
