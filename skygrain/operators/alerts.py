"""Alert rules over backlog, drift, completeness and stability reports."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from skygrain.plans.durable import materialize
from skygrain.plans.skew import PART, cut_ranges

# Default thresholds, message texts and list lengths.
THRESHOLDS = {
    "kafka_lag_critical": 1000,
    "kafka_lag_warning": 500,
    "drift_score_critical": 0.3,
    "completeness_warning": 98.0,
    "stability_warning": 5.0,
}
BACKLOG_CRITICAL = "High Kafka lag on %s: %d messages"
BACKLOG_WARNING = "Increased Kafka lag on %s: %d messages"
DRIFT = "Feature drift detected: %s (score: %.2f)"
COMPLETENESS = "Low feature completeness: %s (%.1f%%)"
STABILITY = "High prediction instability detected (std: %.2f)"
RECENT_ALERTS, SHOWN_ALERTS = 5, 15


def _limits(thresholds: dict | None) -> dict:
    return {**THRESHOLDS, **(thresholds or {})}


def _alert(level: Column, category: str, message: Column, value: Column) -> list[Column]:
    return [level.alias("level"), F.lit(category).alias("category"), message.alias("message"),
            value.cast("double").alias("value")]


def backlog_alerts(backlog: DataFrame, thresholds: dict | None = None) -> DataFrame:
    """CRITICAL above the upper limit, WARNING above the lower one."""
    t = _limits(thresholds)
    lag = F.coalesce("total_messages", F.lit(0)).cast("long")
    critical = lag > t["kafka_lag_critical"]
    return backlog.filter(critical | (lag > t["kafka_lag_warning"])).select(
        *_alert(
            F.when(critical, "CRITICAL").otherwise("WARNING"),
            "System",
            F.when(critical, F.format_string(BACKLOG_CRITICAL, "topic", lag)).otherwise(
                F.format_string(BACKLOG_WARNING, "topic", lag)
            ),
            lag,
        )
    )


def drift_alerts(drift: DataFrame, thresholds: dict | None = None) -> DataFrame:
    """``drift`` holds one row per feature with its ``ks_score``."""
    return drift.filter(F.col("ks_score") > _limits(thresholds)["drift_score_critical"]).select(
        *_alert(F.lit("CRITICAL"), "Data Quality", F.format_string(DRIFT, "feature", "ks_score"), F.col("ks_score"))
    )


def completeness_alerts(completeness: DataFrame, thresholds: dict | None = None) -> DataFrame:
    pct = F.col("completeness_pct")
    return completeness.filter(pct < _limits(thresholds)["completeness_warning"]).select(
        *_alert(F.lit("INFO"), "Data Quality", F.format_string(COMPLETENESS, "feature", pct), pct)
    )


def stability_alerts(stability: DataFrame, thresholds: dict | None = None) -> DataFrame:
    std = F.col("stability")
    return stability.filter(std > _limits(thresholds)["stability_warning"]).select(
        *_alert(F.lit("WARNING"), "Model", F.format_string(STABILITY, std), std)
    )


def check_alerts(backlog: DataFrame, drift: DataFrame, completeness: DataFrame, stability: DataFrame,
                 thresholds: dict | None = None) -> DataFrame:
    """All alerts; ``rule_no`` gives the order system, data, model."""
    parts = [
        backlog_alerts(backlog, thresholds),
        drift_alerts(drift, thresholds),
        completeness_alerts(completeness, thresholds),
        stability_alerts(stability, thresholds),
    ]
    numbered = [p.withColumn("rule_no", F.lit(i)) for i, p in enumerate(parts, 1)]
    return reduce(DataFrame.unionByName, numbered)


def _unrepeated(ends_only: bool):
    """Alerts of one range in order, after the messages carried into it: the positions kept, or the messages at its end."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, top, kept = None, deque(maxlen=RECENT_ALERTS), []
        for batch in batches:
            kept = []
            for at, k, message, carried in zip(*(batch.column(n).to_pylist() for n in (PART, "k", "message", "carried"))):
                if at != part:
                    if ends_only and part is not None:
                        yield _end(part, top)
                    part, top = at, deque(carried, maxlen=RECENT_ALERTS)
                if message not in top:
                    top.append(message)
                    kept.append(k)
            if not ends_only:
                yield pa.record_batch({"k": pa.array(kept, pa.int64())})
        if ends_only and part is not None:
            yield _end(part, top)

    return run


def _end(part: int, top: Iterable[str | None]) -> pa.RecordBatch:
    return pa.record_batch({PART: pa.array([part], pa.int32()), "top": pa.array([list(top)], pa.list_(pa.string()))})


def alert_history(history: DataFrame, new: DataFrame, position: str) -> DataFrame:
    """The whole history with the new alerts added, newest first.

    ``position``, a whole number that is unique in each table, orders both. A new alert is skipped when its message is
    among the five newest at that moment, which includes alerts of the same check. That rule is a fold in order whose
    state is five messages. The new alerts are cut into ranges by position and folded at once; a range is folded again
    where the five messages carried in from the range before turn out different, until none does. Five different
    messages in a range usually settle it, whatever was carried in. Of the history, the fold reads the five newest.
    """
    newest = history.select(F.col(position).cast("long").alias("k"), "message").orderBy(F.desc("k")).limit(RECENT_ALERTS)
    before = F.transform(F.array_sort(F.collect_list(F.struct("k", "message"))), lambda x: x["message"])
    first = newest.agg(before.alias("top")).first()["top"]
    rows = new.select(F.col(position).cast("long").alias("k"), "message")
    ranges = cut_ranges(rows, [], ["k"], unique=True, shuffled=True).select("k", "message", PART)
    parts = ranges.groupBy(PART).agg(F.count(F.lit(1)).alias("n"))
    given = F.array(*[F.lit(m) for m in first]).cast("array<string>")

    def fold(starts: DataFrame, ends_only: bool) -> DataFrame:
        dealt = ranges.join(starts, PART).repartition(PART).sortWithinPartitions(PART, "k")
        kind = f"{PART} int, top array<string>" if ends_only else "k long"
        return dealt.select(PART, "k", "message", "carried").mapInArrow(_unrepeated(ends_only), kind)

    starts = materialize(parts.select(PART, given.alias("carried")), "alert-starts")
    ends = materialize(fold(starts, True), "alert-ends")
    while True:
        follows = F.coalesce(F.lag("top").over(Window.orderBy(PART)), given)  # one row per range
        heard = materialize(ends.select(PART, follows.alias("carried")), "alert-starts")
        moved = heard.alias("a").join(starts.alias("b"), PART).filter(~F.col("a.carried").eqNullSafe(F.col("b.carried")))
        moved = materialize(moved.select(PART, "a.carried"), "alert-moved")
        starts = heard
        if moved.isEmpty():
            break
        ends = materialize(ends.join(moved, PART, "left_anti").unionByName(fold(moved, True)), "alert-ends")
    kept = fold(starts, False)
    added = new.join(kept.withColumnRenamed("k", position), position, "left_semi").withColumn("_new", F.lit(1))
    whole = history.withColumn("_new", F.lit(0)).unionByName(added)
    return whole.orderBy(F.desc("_new"), F.desc(position)).drop("_new")


def shown(history: DataFrame, n: int = SHOWN_ALERTS) -> DataFrame:
    """The first ``n`` rows of a history, for display."""
    return history.limit(n)
