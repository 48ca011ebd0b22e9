"""Best-fit packing of documents into training sequences, with conflicts between documents of a sequence."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from skygrain.plans.durable import materialize

CAPACITY = 4096
SHARD_ROWS = 20_000  # pieces that one group packs; fixes the number of groups from the number of pieces
SOURCE_BITS, CLUSTER_BITS = 64, 256


class Bins:
    """Open bins by residual, each with a bitmap of its sources and one of its duplicate clusters.

    For every source bit, ``without[s]`` has bit r set where some bin of residual r lacks that source. The successor
    search takes the least such residual that is large enough, then a bin there whose cluster bitmap is free of the
    piece's cluster, else the next residual, until the tightest compatible bin is found. Bits are hashes: two sources
    or clusters that share one are kept apart too, which is never wrong, only stricter.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.without = [0] * SOURCE_BITS
        self.counts = [[0] * (capacity + 1) for _ in range(SOURCE_BITS)]
        self.at: list[dict[int, tuple[int, int]]] = [{} for _ in range(capacity + 1)]
        self.made = 0

    def _file(self, residual: int, number: int, sources: int, clusters: int) -> None:
        self.at[residual][number] = (sources, clusters)
        for s in range(SOURCE_BITS):
            if not sources >> s & 1:
                self.counts[s][residual] += 1
                if self.counts[s][residual] == 1:
                    self.without[s] |= 1 << residual

    def _take(self, residual: int, number: int) -> None:
        sources, _ = self.at[residual].pop(number)
        for s in range(SOURCE_BITS):
            if not sources >> s & 1:
                self.counts[s][residual] -= 1
                if not self.counts[s][residual]:
                    self.without[s] &= ~(1 << residual)

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, offset) of a piece; ``source`` and ``cluster`` are bit numbers, -1 where they never conflict."""
        if source >= 0:
            found = self.without[source] >> size
        else:
            found = 0
            for w in self.without:
                found |= w
            found >>= size
        residual = size
        wanted = 1 << cluster if cluster >= 0 else 0
        mark = 1 << source if source >= 0 else 0
        while found:
            step = (found & -found).bit_length() - 1
            residual += step
            for number, (sources, clusters) in self.at[residual].items():
                if not sources & mark and not clusters & wanted:
                    self._take(residual, number)
                    self._file(residual - size, number, sources | mark, clusters | wanted)
                    return number, self.capacity - residual
            found >>= step + 1
            residual += 1
        number, self.made = self.made, self.made + 1
        self._file(self.capacity - size, number, mark, wanted)
        return number, 0


def _pack(capacity: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, bins, held = None, None, None

        def fresh() -> dict[str, list]:
            return {n: [] for n in ("shard", "bin", "offset")}

        for batch in batches:
            held = fresh()
            for s, size, source, cluster in zip(*(batch.column(n).to_pylist() for n in (
                    "shard", "size", "source_bit", "cluster_bit"))):
                if s != shard:
                    shard, bins = s, Bins(capacity)
                number, offset = bins.place(size, source, cluster)
                held["shard"].append(s)
                held["bin"].append(number)
                held["offset"].append(offset)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "piece": batch.column("piece"), "start": batch.column("start"),
                "n_tokens": batch.column("size"), "shard": pa.array(held["shard"], pa.int64()),
                "bin": pa.array(held["bin"], pa.int64()), "bin_offset": pa.array(held["offset"], pa.int64()),
            })

    return run


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    cluster: Column | None = None,
    source: Column | None = None,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Places of all documents in sequences of ``capacity`` tokens, no two of one source or duplicate cluster together.

    Returns one row per piece: ``doc_id, piece, start, n_tokens, shard, bin, bin_offset``; (shard, bin) names the
    sequence, ``start`` the piece's first token in its document. Tokens are words between white space. A text longer
    than the capacity is cut into full pieces, which fill sequences alone, and a last piece. A text without tokens
    (null, empty) gives one piece of size 0 and is placed like any other. A null source never conflicts. ``cluster``
    is any column that names a duplicate cluster; by default it is the text itself, so copies are kept apart.
    Repeated rows are packed separately. An empty table gives an empty result; other columns are ignored.

    Pieces are dealt by hash into groups of about ``shard_rows``, whatever source or cluster they belong to, and
    each group is packed in order of falling size, so a task holds one group's open bins only.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    name = F.col("source") if source is None else source
    group = F.when(F.length(text) > 0, F.xxhash64(text)) if cluster is None else cluster
    bit = lambda c, bits, n: F.when(c.isNotNull(), F.pmod(F.crc32(c.cast("string")), F.lit(bits))).otherwise(
        F.lit(-1)).cast("int").alias(n)
    sized = materialize(docs.select(
        F.col("doc_id"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("total"),
        bit(name, SOURCE_BITS, "source_bit"), bit(group, CLUSTER_BITS, "cluster_bit"),
    ), "sized")
    last = F.greatest(F.ceil(F.col("total") / capacity).cast("int") - 1, F.lit(0))
    cut = sized.withColumn("piece", F.explode(F.sequence(F.lit(0), last))).withColumn("start", F.col("piece").cast("long") * capacity)
    cut = cut.withColumn("size", F.least(F.col("total") - F.col("start"), F.lit(capacity)).cast("long"))
    shards = max(1, -(-(sized.agg(F.sum(last + 1)).first()[0] or 0) // shard_rows))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (
        cut.withColumn("shard", F.pmod(F.xxhash64("doc_id", "source_bit", "total", "piece"), F.lit(shards)))
        .repartition(shards, "shard")
        .sortWithinPartitions("shard", F.desc("size"), "doc_id", "piece")
        .select("doc_id", "piece", "start", "size", "source_bit", "cluster_bit", "shard")
        .mapInArrow(_pack(capacity), f"doc_id {kind}, piece int, start long, n_tokens long, shard long, bin long, "
                                     "bin_offset long")
    )
