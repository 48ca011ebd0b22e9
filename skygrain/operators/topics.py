"""Topic reads as bounded tables: backlog, first and newest messages, validated bounded reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from skygrain.plans.prefix import running_totals
from skygrain.sources.contracts import REASON, check_contract, validate_contract


def partition_backlog(messages: DataFrame) -> DataFrame:
    """Low and high offset and retained messages of each topic partition."""
    low, high = F.min("offset"), F.max("offset") + 1
    return messages.groupBy("topic", "partition").agg(
        low.alias("low"), high.alias("high"), (high - low).alias("available")
    )


def topic_backlog(messages: DataFrame, topics: Sequence[str]) -> DataFrame:
    """Retained messages and partitions per requested topic; an unknown topic carries an error.

    Offsets are reduced to one row per partition before anything is joined.
    """
    per_topic = partition_backlog(messages).groupBy("topic").agg(
        F.sum("available").alias("total_messages"), F.count(F.lit(1)).alias("partition_count")
    )
    names = F.array(*[F.lit(t) for t in topics])
    wanted = messages.sparkSession.range(1).select(F.explode(names).alias("topic"))
    return wanted.join(per_topic, "topic", "left").withColumn(
        "error", F.when(F.col("partition_count").isNull(), "Topic not found")
    )


def total_backlog(backlog: DataFrame) -> DataFrame:
    return backlog.filter(F.col("error").isNull()).agg(
        F.coalesce(F.sum("total_messages"), F.lit(0)).alias("total_backlog"), F.count(F.lit(1)).alias("topics")
    )


def bounded_read(messages: DataFrame, contract: str, max_messages: int | None, order: Sequence[str],
                 stop_after: int | None = None) -> DataFrame:
    """The first ``max_messages`` valid records in order (all of them when None).

    With ``stop_after`` reading also ends where so many invalid messages follow one another. A run of invalid messages
    is known by the number of valid ones before it, a running total over sorted ranges, so its length is a count per
    group and no task reads the topic in order.
    """
    if stop_after is None:
        valid, _ = validate_contract(messages, contract)
        return valid.orderBy(*order).limit(max_messages) if max_messages is not None else valid
    checked = check_contract(messages, contract)
    flagged = checked.withColumn("_valid", F.col(REASON).isNull().cast("long"))
    placed = running_totals(flagged, [], list(order), ["_valid"])
    before = F.col("_valid_before")
    runs = placed.filter("_valid = 0").groupBy(before.alias("at")).agg(F.count(F.lit(1)).alias("n"))
    end = runs.filter(F.col("n") >= stop_after).agg(F.min("at").alias("at")).first()["at"]
    kept = placed.filter("_valid = 1")
    for most in (end, max_messages):
        kept = kept.filter(before < most) if most is not None else kept
    return kept.drop("_valid", "_valid_before", "_valid_total", REASON)


def first_n(messages: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The oldest ``n`` decodable messages."""
    return _decodable(messages).orderBy(*order).limit(n)


def latest_n(messages: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The newest ``n`` decodable messages (a top-k: each task keeps at most ``n`` rows)."""
    return _decodable(messages).orderBy(*[F.desc(c) for c in order]).limit(n)


def _decodable(messages: DataFrame) -> DataFrame:
    return messages.filter(F.try_parse_json("value").isNotNull())
