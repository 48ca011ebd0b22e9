"""Near-duplicate documents: min-max signatures, banding, and links confirmed on full shingle sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from skygrain.llm import texts
from skygrain.llm.links import components
from skygrain.plans.durable import materialize, shuffled

BANDS, ROWS = 40, 6  # a pair at similarity 0.8 shares no band with a chance of (1 - 0.8**6)**40 = 5e-6
PERMUTATIONS = BANDS * ROWS // 2  # each gives a minimum and a maximum
SMALL_GROUP, SMALL_SHINGLES = 4096, 1_000_000  # groups up to this size are compared within one task
BLOCK_MEMBERS, BLOCK_SHINGLES = 256, 500_000  # blocks of larger groups
FIRST_PIVOTS, MOST_PIVOTS = 16, 512


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row; a row with fewer words has one shingle of all its words."""
    hashes, row = texts.word_hashes(data, offsets)
    n = len(offsets) - 1
    counts = np.bincount(row, minlength=n)
    first = np.concatenate([[0], np.cumsum(counts)])
    size = max(len(hashes) - width + 1, 0)
    whole = np.full(size, 0x51ED270B, np.uint64)
    for j in range(width):
        whole = texts.mix(whole * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + size])
    out = []
    for i in range(n):
        a, b = first[i], first[i + 1]
        if b - a >= width:
            out.append(np.unique(whole[a : b - width + 1]))
        elif b > a:
            short = np.full(1, b - a, np.uint64)
            for x in hashes[a:b]:
                short = texts.mix(short * np.uint64(0x9E3779B97F4A7C15) + x)
            out.append(short)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """One row of band keys per set, none of the sets empty.

    Every permutation is an affine map of 64-bit hashes and is evaluated once; its minimum and its maximum both enter
    the signature. A band takes minima and maxima of different permutations.
    """
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]]).astype(np.int64)
    flat = np.concatenate(sets)
    a = texts.mix(np.arange(1, PERMUTATIONS + 1, dtype=np.uint64)) | np.uint64(1)
    b = texts.mix(np.arange(1001, PERMUTATIONS + 1001, dtype=np.uint64))
    signature = np.empty((2 * PERMUTATIONS, len(sets)), np.uint64)
    for p in range(PERMUTATIONS):
        x = flat * a[p] + b[p]
        signature[p] = np.minimum.reduceat(x, at)
        signature[PERMUTATIONS + (p + 17) % PERMUTATIONS] = np.maximum.reduceat(x, at)
    keys = np.tile(texts.mix(np.arange(BANDS, dtype=np.uint64))[:, None], (1, len(sets)))
    for j in range(ROWS):
        keys = texts.mix(keys * np.uint64(0x9E3779B97F4A7C15) + signature[j * BANDS : (j + 1) * BANDS])
    return keys.T


def _sign(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in texts.blocks(batch.column("text")):
                sets = shingles(data, offsets, width)
                full = [s for s in sets if len(s)]
                bands = band_keys(full).view(np.int64) if full else np.zeros((0, BANDS), np.int64)
                sizes = np.array([len(s) for s in sets], np.int64)
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(first, end - first),
                    "n_shingles": sizes,
                    "content": pa.array(
                        [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                        pa.binary(),
                    ),
                    "bands": texts.lists(bands.ravel(), np.where(sizes > 0, BANDS, 0), pa.int64()),
                })

    return run


def _sets(width: int):
    """Rows with their shingle set as bytes in place of the text."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in texts.blocks(batch.column("text")):
                part = batch.slice(first, end - first)
                yield pa.record_batch({
                    "component": part.column("component"),
                    "doc_id": part.column("doc_id"),
                    "shingles": pa.array([s.tobytes() for s in shingles(data, offsets, width)], pa.binary()),
                })

    return run


class Group:
    """Shingle sets side by side; compares one set with all of them at once."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.flat = np.concatenate(sets)

    def common(self, one: np.ndarray) -> np.ndarray:
        """How many elements each set shares with ``one`` (sorted)."""
        place = np.minimum(np.searchsorted(one, self.flat), len(one) - 1)
        return np.add.reduceat((one[place] == self.flat).astype(np.int64), self.at)


class Shared:
    """The sets of one group with their elements numbered; elements of a single set are left out of the counting."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        _, number, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        keep = times[number] > 1
        owner = np.repeat(np.arange(len(sets)), self.sizes)[keep]
        self.flat = number[keep].astype(np.int32)
        self.at = np.searchsorted(owner, np.arange(len(sets) + 1))
        self.mark = np.zeros(len(times), np.int8)

    def similar(self, i: int, percent: int) -> np.ndarray:
        """Which sets are similar enough to the i-th."""
        own = self.flat[self.at[i] : self.at[i + 1]]
        self.mark[own] = 1
        run = np.concatenate([[0], np.cumsum(self.mark[self.flat], dtype=np.int32)])
        self.mark[own] = 0
        both = run[self.at[1:]] - run[self.at[:-1]]
        return 100 * both >= percent * (self.sizes + self.sizes[i] - both)


def _root(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def _small_groups(width: int, percent: int):
    """All pairs of each small group, until the group is one component: ``doc_id, linked_to``."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        to: list[int] = []
        for group in texts.by_key(batches, ["component"]):
            sets: list[np.ndarray] = []
            for _, _, data, offsets in texts.blocks(group.column("text").combine_chunks()):
                sets += shingles(data, offsets, width)
            docs = [d for d, s in zip(group.column("doc_id").to_pylist(), sets) if len(s)]
            sets = [s for s in sets if len(s)]
            parent, left = list(range(len(docs))), len(docs) - 1
            side = Shared(sets)
            for i in range(len(docs)):
                if not left:
                    break
                for j in np.flatnonzero(side.similar(i, percent)):
                    a, b = _root(parent, i), _root(parent, int(j))
                    if a != b:
                        parent[max(a, b)] = min(a, b)
                        left -= 1
            ids += docs
            to += [docs[_root(parent, i)] for i in range(len(docs))]
            if len(ids) > 50_000:
                yield pa.record_batch({"doc_id": ids, "linked_to": to})
                ids, to = [], []
        yield pa.record_batch({"doc_id": pa.array(ids, pa.int64()), "linked_to": pa.array(to, pa.int64())})

    return run


def _pivot_blocks(percent: int):
    """Compare every pivot of a group with every member of a block of it.

    Per member: the first pivot linked to it and the pivots that are too far for a link but near enough (distance up
    to twice the limit) that a member of theirs could link to it. Pivots that share a member come out as links too.
    """
    far = 100 - 2 * (100 - percent)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in texts.by_key(batches, ["component", "block"]):
            role = np.array(table.column("pivot").to_pylist(), bool)
            docs = np.array(table.column("doc_id").to_pylist(), np.int64)
            sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
            component = table.column("component")[0].as_py()
            members, pivots = np.flatnonzero(~role), np.flatnonzero(role)
            if not len(members) or not len(pivots):
                continue
            side = Group([sets[i] for i in members])
            linked = np.zeros((len(pivots), len(members)), bool)
            near = np.zeros((len(pivots), len(members)), bool)
            for k, i in enumerate(pivots):
                both = side.common(sets[i])
                union = side.sizes + len(sets[i]) - both
                linked[k] = 100 * both >= percent * union
                near[k] = ~linked[k] & (100 * both >= far * union)
            names, ids = docs[pivots], docs[members]
            first = np.where(linked.any(0), names[linked.argmax(0)], -1)
            a, b = [], []
            parent = list(range(len(pivots)))
            for j in np.flatnonzero(linked.sum(0) > 1):
                hit = np.flatnonzero(linked[:, j])
                for k in hit[1:]:
                    x, y = _root(parent, int(hit[0])), _root(parent, int(k))
                    if x != y:
                        parent[y] = x
                        a.append(int(names[hit[0]]))
                        b.append(int(names[k]))
            near_of = [names[near[:, j]] for j in range(len(members))]
            yield pa.record_batch({
                "component": pa.array([component] * (len(ids) + len(a)), pa.int64()),
                "doc_id": pa.array([*ids.tolist(), *a], pa.int64()),
                "pivot_id": pa.array([x if x >= 0 else None for x in first.tolist()] + b, pa.int64()),
                "member": pa.array([True] * len(ids) + [False] * len(a)),
                "near": texts.lists(
                    np.concatenate([*near_of, np.zeros(0, np.int64)]),
                    np.array([len(x) for x in near_of] + [0] * len(a), np.int64), pa.int64(),
                ),
            })

    return run


def _large_groups(members: DataFrame, percent: int) -> DataFrame:
    """Links of groups that are too large for one task, exact at any size: ``doc_id, linked_to``.

    ``members``: ``component, block, doc_id, shingles``. Pivots of each group are compared with all its members, block
    by block. The Jaccard distance is a metric: two linked members of different clusters imply that each lies within
    twice the limit of the other's pivot. So a member is settled once it is linked to a pivot and all pivots within
    twice the limit belong to its own cluster, or once it has been a pivot itself. Unsettled members become pivots,
    round by round; a round costs (pivots x members), and groups of near copies settle in one or two. What a round
    knows is written, so the plans that the driver holds do not grow from round to round.
    """
    schema = "component long, doc_id long, pivot_id long, member boolean, near array<long>"
    blocks = members.select("component", "block").distinct()
    cluster = near = done = None
    todo = members.select("component", "doc_id")
    count = FIRST_PIVOTS
    while True:
        rank = F.row_number().over(Window.partitionBy("component").orderBy(F.xxhash64("doc_id"), "doc_id"))
        pivots = materialize(
            todo.select("component", "doc_id", rank.alias("r")).filter(F.col("r") <= count).drop("r"), "pivots"
        )
        done = pivots if done is None else materialize(done.unionByName(pivots), "pivots-so-far")
        side = (
            members.join(pivots, ["component", "doc_id"]).select("component", "doc_id", "shingles")
            .join(blocks, "component")
            .select("component", "block", "doc_id", "shingles", F.lit(True).alias("pivot"))
        )
        compared = materialize(
            members.select("component", "block", "doc_id", "shingles", F.lit(False).alias("pivot"))
            .unionByName(side)
            .repartition("component", "block")
            .sortWithinPartitions("component", "block")
            .mapInArrow(_pivot_blocks(percent), schema),
            "pivot-links", free=True,
        )
        links = compared.filter("pivot_id is not null and pivot_id <> doc_id").select(
            F.col("doc_id").alias("a"), F.col("pivot_id").alias("b")
        )
        if cluster is not None:  # the clusters so far stand for all links of earlier rounds
            links = links.unionByName(cluster.filter("node <> component").select(
                F.col("node").alias("a"), F.col("component").alias("b")))
        cluster = components(links)
        own = members.select("component", "doc_id").join(
            shuffled(cluster.withColumnRenamed("node", "doc_id").withColumnRenamed("component", "cluster")), "doc_id", "left"
        )
        others = cluster.select(F.col("node").alias("pivot_id"), F.col("component").alias("pivot_cluster"))
        # Only where the pivots of a group are not all in one cluster can a member lie between two.
        split = done.join(shuffled(others), done["doc_id"] == others["pivot_id"], "left").groupBy("component").agg(
            F.min(F.coalesce("pivot_cluster", "doc_id")).alias("low"),
            F.max(F.coalesce("pivot_cluster", "doc_id")).alias("high"),
        ).filter("low <> high").select("component")
        close = compared.filter("member").select("component", "doc_id", F.explode("near").alias("pivot_id"))
        near = close if near is None else near.unionByName(close)
        # Clusters only ever merge, so a pair inside one is settled for good and need not be kept.
        near = materialize(
            near.join(split, "component", "left_semi").join(shuffled(own.drop("component")), "doc_id")
            .join(shuffled(others), "pivot_id", "left")
            .filter(~F.coalesce(F.col("cluster"), F.col("doc_id")).eqNullSafe(
                F.coalesce(F.col("pivot_cluster"), F.col("pivot_id"))))
            .select("component", "doc_id", "pivot_id"),
            "between-clusters",
        )
        open_ones = own.filter("cluster is null").select("doc_id").unionByName(near.select("doc_id")).distinct()
        todo = materialize(
            own.select("component", "doc_id").join(shuffled(open_ones), "doc_id", "left_semi")
            .join(shuffled(done), ["component", "doc_id"], "left_anti"),
            "unsettled",
        )
        if todo.isEmpty():
            return cluster.select(F.col("node").alias("doc_id"), F.col("component").alias("linked_to"))
        count = min(count * 4, MOST_PIVOTS)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """Groups of documents that are linked by 100 * intersection >= percent * union of their shingle sets.

    Returns one row per input row: ``doc_id, n_shingles, component_id`` (the least id reachable), ``kept``. Words are
    cut at ASCII white space after lower-casing A-Z. A text without words (null and empty ones too) has no shingles
    and is alone. Rows with one id count as one document; rows with a null id are alone, have a null ``component_id``
    and are kept. An empty table gives an empty result; other columns are ignored.

    Documents with equal sets (same 128-bit digest of the whole sorted set) form one class, and only the class's least
    id goes on. Each band bucket points its members at its least member; the components of these pointers bound where
    links can be. Within them all links are confirmed on full sets: small ones whole in one task, large ones by
    ``_large_groups``. No bucket or group is cut off. Tables that grow with the documents are joined by sorting, so that
    the driver's memory does not grow with them; Spark may broadcast the pivots and blocks of large groups only.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = materialize(
        base.mapInArrow(_sign(width), "doc_id long, n_shingles long, content binary, bands array<long>"), "signatures"
    )
    classes = (
        signed.filter("content is not null and doc_id is not null").groupBy("content").agg(F.min("doc_id").alias("rep"))
    )
    reps = classes.select(F.col("rep").alias("doc_id"), "content")
    each = signed.join(shuffled(reps), ["doc_id", "content"], "left_semi").select(
        "doc_id", F.explode("bands").alias("key")
    )
    buckets = each.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    buckets = buckets.filter("first < last").select("key", "first")
    firsts = each.join(shuffled(buckets), "key").groupBy("doc_id").agg(F.collect_set("first").alias("firsts"))  # at most BANDS
    # A document hangs on its least bucket head, and so do its other heads: few edges even in a large group.
    head = firsts.select(
        F.array_min("firsts").alias("a"), F.explode(F.array_union("firsts", F.array("doc_id"))).alias("b"))
    groups = components(head.filter("a <> b").distinct())
    sizes = signed.select("doc_id", "n_shingles").join(shuffled(groups), F.col("doc_id") == F.col("node")).groupBy(
        "component").agg(F.count(F.lit(1)).alias("members"), F.sum("n_shingles").alias("shingles"))
    grouped = materialize(
        groups.join(shuffled(sizes), "component").select(
            F.col("node").alias("doc_id"), "component",
            F.when((F.col("members") <= SMALL_GROUP) & (F.col("shingles") <= SMALL_SHINGLES), 0).otherwise(
                F.greatest(F.ceil(F.col("members") / BLOCK_MEMBERS), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
            ).alias("blocks"),
        ),
        "candidate-groups",
    )
    candidates = base.join(shuffled(grouped), "doc_id")
    small = (
        candidates.filter("blocks = 0").select("component", "doc_id", "text")
        .repartition("component").sortWithinPartitions("component", "doc_id")
        .mapInArrow(_small_groups(width, percent), "doc_id long, linked_to long")
    )
    linked = small
    if not grouped.filter("blocks > 0").isEmpty():
        whole = candidates.filter("blocks > 0").select("component", "doc_id", "text").mapInArrow(
            _sets(width), "component long, doc_id long, shingles binary").filter("length(shingles) > 0")
        placed = whole.join(
            shuffled(grouped.filter("blocks > 0").select("doc_id", "blocks")), "doc_id"
        ).withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")))
        members = materialize(placed.select("component", "block", "doc_id", "shingles"), "group-members", free=True)
        linked = linked.unionByName(_large_groups(members, percent))
    label = linked.groupBy("doc_id").agg(F.min("linked_to").alias("linked_to"))
    named = classes.join(shuffled(label), classes["rep"] == label["doc_id"], "left").select(
        "content", F.coalesce("linked_to", "rep").alias("component_id")
    )
    out = signed.select("doc_id", "n_shingles", "content").join(shuffled(named), "content", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_copies(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one document of each group."""
    lost = near_duplicates(docs, width=width, percent=percent).filter("not kept").select("doc_id").distinct()
    return docs.join(shuffled(lost), "doc_id", "left_anti")
