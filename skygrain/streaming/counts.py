"""Counts of what a stream read, accepted and dropped, per micro-batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from skygrain.sources.contracts import REASON

READ = "messages_read"
READ_FACTS = ("messages", "undecodable", "invalid")


def read_counts() -> list[Column]:
    """Of messages with their ``reject_reason``: all, those that are not JSON, and those that break the contract."""
    reason = F.col(REASON)
    return [F.count(F.lit(1)).alias("messages"), F.count_if(reason == "not json").alias("undecodable"),
            F.count_if(reason.isNotNull() & (reason != "not json")).alias("invalid")]


def observed(checked: DataFrame, name: str = READ) -> DataFrame:
    """The same rows; every micro-batch reports ``read_counts`` of them under ``name``."""
    return checked.observe(name, *read_counts())


class BatchCounts(StreamingQueryListener):
    """Keeps the counts that streams report under ``name``, by run and batch; register it with ``streams.addListener``.

    It holds three numbers for each batch of the last ``most`` batches.
    """

    def __init__(self, name: str = READ, most: int = 100_000):
        self.name, self.most = name, most
        self.rows: dict[tuple[str, int], tuple[int, ...]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = event.progress.observedMetrics.get(self.name)
        if found is not None:
            self.rows[str(event.progress.runId), event.progress.batchId] = tuple(found[f] for f in READ_FACTS)
            while len(self.rows) > self.most:
                self.rows.pop(next(iter(self.rows)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(run, batch, *counts) for (run, batch), counts in self.rows.items()]
        return spark.createDataFrame(rows, "run string, batch long, " + ", ".join(f"{f} long" for f in READ_FACTS))


def reported(query, name: str = READ) -> dict[int, dict[str, int]]:
    """The counts of a query's recent batches by number, from its own progress."""
    out = {}
    for p in query.recentProgress:
        found = p.observedMetrics.get(name)
        if found is not None:
            out[p.batchId] = {f: found[f] for f in READ_FACTS}
    return out
