"""Feature engineering by micro-batch: each batch meets the last rows of every location as a table.

The batch operators do the work, so a location with a very large share of a micro-batch is cut into ranges like in a
batch job; no task gathers a whole location. State is a table per batch: the rows that later features can reach.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from skygrain.functions import series as S
from skygrain.functions.values import location_text
from skygrain.operators.dedup import ACCEPTED, TOLERANCES, flag_unchanged
from skygrain.operators.features import assemble_features, contract_features, observations_of, with_history
from skygrain.plans.skew import ROW_NO, ordered_rows
from skygrain.sources.contracts import REASON, check_contract, conforms
from skygrain.sources.streams import as_messages
from skygrain.streaming.counts import read_counts
from skygrain.streaming.ledger import Ledger

PLACE = ["location_key"]
ORDER = ["_fresh", "_seq", "event_time", "id"]  # rows kept from earlier batches come first, as they were accepted
FACTS = ("messages", "undecodable", "invalid", "processed", "duplicates")
Sink = Callable[[DataFrame, str, int], None]


def _arrived(batch: DataFrame) -> DataFrame:
    """Messages with their observation, or the reason why there is none."""
    checked = check_contract(batch, "cleaned")
    flat = observations_of(checked.select("key", REASON, "record.*"), metadata=True)
    return flat.withColumns({
        "location_key": location_text(F.col("latitude"), F.col("longitude")),
        "event_time": F.col("time_text").try_cast("timestamp_ntz"), "id": F.col("key"),
        **{c: F.col(c).cast("double") for c in TOLERANCES},
        "_fresh": F.lit(1), "_seq": F.lit(0).cast("long"),
    })


def _read(ledger: Ledger, number: int, batch: DataFrame) -> DataFrame:
    """The batch's valid rows, written once with the counts of what was read."""
    if not ledger.done("read", number):
        seen = Observation()
        valid = _arrived(batch).observe(seen, *read_counts()).filter(F.col(REASON).isNull()).drop(REASON)
        valid.write.mode("overwrite").option("compression", "zstd").parquet(ledger.path("rows", number))
        ledger.note("read", number, seen.get)
    return ledger.spark.read.parquet(ledger.path("rows", number))


def _accepted(rows: DataFrame, kept: DataFrame | None, dedup: bool) -> DataFrame:
    """The batch's rows with ``accepted``: compared with the location's last accepted row, of this batch or before."""
    if not dedup:
        return rows.withColumn(ACCEPTED, F.lit(True))
    both = rows if kept is None else rows.unionByName(kept.filter("last").drop("last", "samples"), allowMissingColumns=True)
    return flag_unchanged(both, PLACE, ORDER, TOLERANCES).filter("_fresh = 1")


def _with_history(rows: DataFrame, kept: DataFrame | None) -> DataFrame:
    """New and kept rows with the flat historical values and ``samples``, the running number of a location's rows."""
    if kept is None:
        both = rows.withColumn("_earlier", F.lit(0).cast("long"))
    else:
        gone = kept.groupBy(*PLACE).agg((F.max("samples") - F.count(F.lit(1))).alias("_earlier"))
        both = rows.unionByName(kept.drop("last", "samples"), allowMissingColumns=True).join(gone, PLACE, "left")

    def build(part: DataFrame, w) -> DataFrame:
        number = F.col(ROW_NO) + F.coalesce(F.col("_earlier"), F.lit(0))
        return with_history(part, w).withColumn("samples", number)

    return ordered_rows(both, PLACE, ORDER, build, S.STREAM_BACK, 0, numbered=True).drop("_earlier")


def _to_keep(featured: DataFrame) -> DataFrame:
    """Each location's newest rows, as far back as a feature looks; the limit applies before the shuffle too."""
    newest = Window.partitionBy(*PLACE).orderBy(F.desc("samples"))
    held = featured.withColumn("_r", F.row_number().over(newest)).filter(F.col("_r") <= S.STREAM_BACK)
    return held.select(*PLACE, "event_time", "id", *TOLERANCES, "samples", (F.col("_r") == 1).alias("last"),
                       F.lit(0).alias("_fresh"), F.col("samples").alias("_seq"))


def feature_batches(ledger: Ledger, sink: Sink, dedup: bool = True):
    """A ``foreachBatch`` function: cleaned messages to feature records that meet their contract.

    Rows of a batch are taken in event-time order, batches in order of arrival. A batch leaves its counts (messages,
    undecodable, invalid, processed, duplicates), its records, which go to ``sink`` once, and the rows that the next
    batch looks back to. A repeated batch goes on behind its last finished step. A table is deleted once the steps that
    read it are done, and the messages and kept rows of earlier batches when the batch is finished; counts stay.
    """

    def run(batch: DataFrame, number: int) -> None:
        if ledger.done("published", number):
            return
        earlier = [n for n in ledger.numbers("state") if n < number]
        kept = ledger.spark.read.parquet(ledger.path("state", earlier[-1])) if earlier else None
        # Each table asks for the one before it only if it is not there yet, so that one may be gone by then.
        flagged = lambda: ledger.table("flagged", number, lambda: _accepted(_read(ledger, number, batch), kept, dedup))
        if not ledger.done("counts", number):
            kinds = flagged().agg(F.count_if(ACCEPTED).alias("processed"), F.count_if(~F.col(ACCEPTED)).alias("duplicates"))
            read = ledger.notes("read", FACTS[:3]).filter(F.col("batch") == number).first().asDict()
            facts = read | kinds.first().asDict()
            ledger.note("counts", number, {f: facts[f] for f in FACTS})
        ledger.forget("rows", number + 1)
        featured = lambda: ledger.table("featured", number, lambda: _with_history(
            flagged().filter(ACCEPTED).drop(ACCEPTED), kept))
        ledger.table("state", number, lambda: _to_keep(featured()))
        ledger.forget("flagged", number + 1)
        messages = ledger.table("messages", number, lambda: as_messages(conforms(contract_features(assemble_features(
            featured().filter("_fresh = 1")).drop(*PLACE)).withColumnRenamed("id", "key"), "features")))
        ledger.forget("featured", number + 1)
        ledger.once("published", number, lambda: sink(messages, "features", number))
        for step in ("messages", "state"):
            ledger.forget(step, number)

    return run


def run_features(messages: DataFrame, ledger: Ledger, sink: Sink, checkpoint: str, dedup: bool = True,
                 every: str | None = None) -> StreamingQuery:
    """Engineer features of what is there and stop, or keep running with a batch ``every`` so often."""
    writer = messages.writeStream.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.foreachBatch(feature_batches(ledger, sink, dedup)).start()
