"""Near-duplicate vectors: cross-polytope hashing after fast Hadamard rotations, multiprobe buckets, exact cosines."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from skygrain.llm import texts
from skygrain.llm.links import components
from skygrain.plans.durable import materialize

TABLES = 16
CORNERS, MOST_CORNERS = 2, 4  # rotations whose corners make a bucket together
MEETINGS = 16  # unrelated vectors that one may meet in all its buckets; a table where it would be more has more corners
BLOCK = 1000  # rows of a bucket that one comparison takes from either side
PAIRS = 200_000  # pairs that are worked on at once


def corners_for(rows: int, width: int) -> int:
    """Corners in a bucket for so many vectors of one label: buckets then grow in number as the table does.

    Each further corner multiplies the buckets by the corners there are, and a vector's own and probed ones by two.
    """
    ends = 2 * _padded(width)
    k = CORNERS
    while k < MOST_CORNERS and rows * TABLES * 2**k > MEETINGS * ends**k and ends ** (k + 1) < 1 << 62:
        k += 1
    return k


def _padded(width: int) -> int:
    return 1 << max(1, (width - 1).bit_length())


def rotate(x: np.ndarray, seed: int) -> np.ndarray:
    """Three rounds of random signs and a fast Hadamard transform; the width must be a power of two."""
    n, d = x.shape
    x = np.array(x.T, order="C")  # a component's values side by side, so that every step runs over whole rows
    for k in range(3):
        signs = texts.mix(np.arange(d, dtype=np.uint64) + np.uint64(1_000_003 * seed + 7919 * k + 1))
        x *= np.where(signs >> np.uint64(63), 1.0, -1.0)[:, None]
        h = 1
        while h < d:
            y = x.reshape(d // (2 * h), 2, h, n)
            less = y[:, 0] - y[:, 1]
            y[:, 0] += y[:, 1]
            y[:, 1] = less
            h *= 2
        x /= np.sqrt(d)
    return x.T


def levelled(x: np.ndarray) -> np.ndarray:
    """Each vector times the power of two that brings its largest component below 1: exact, and no norm over- or underflows."""
    _, exponent = np.frexp(np.abs(x).max(axis=1, keepdims=True))
    return np.ldexp(x, -exponent)


def corners(x: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest and second-nearest corner of the cross-polytope to each rotated vector."""
    y = rotate(x, seed)
    size = np.abs(y, order="C")
    rows = np.arange(len(y))
    first = size.argmax(1)
    held = size[rows, first].copy()
    size[rows, first] = -1
    second = size.argmax(1)
    size[rows, first] = held
    code = lambda at: 2 * at + (y[rows, at] < 0)
    return code(first), code(second)


def all_corners(x: np.ndarray, k: int) -> np.ndarray:
    """[vectors, TABLES, k, 2]: per table and rotation the nearest and second-nearest corner."""
    x = np.pad(x, ((0, 0), (0, _padded(x.shape[1]) - x.shape[1])))
    out = np.empty((len(x), TABLES, k, 2), np.int32)
    for at in range(0, len(x), BLOCK):
        for r in range(TABLES * k):
            out[at : at + BLOCK, r // k, r % k] = np.stack(corners(x[at : at + BLOCK], r), axis=1)
    return out


def codes(found: np.ndarray, width: int) -> np.ndarray:
    """[vectors, TABLES * 2**k]: per table the own bucket, then the probed ones, with second-nearest corners in it."""
    n, _, k, _ = found.shape
    out = np.zeros((n, TABLES, 2**k), np.int64)
    for r in range(k):
        out = out * 2 * _padded(width) + found[:, :, r, (np.arange(2**k) >> r) & 1]
    return out.reshape(n, -1)


def _hash(k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("vector").value_lengths().to_numpy()
            for d in np.unique(size).tolist():
                part = batch.take(pa.array(np.flatnonzero(size == d)))
                n = part.num_rows
                found = all_corners(levelled(part.column("vector").flatten().to_numpy().reshape(n, d)), k)
                yield pa.RecordBatch.from_arrays(
                    [part.column("rep"), part.column("copies"), part.column("label"), part.column("vector"),
                     texts.lists(found.ravel(), np.full(n, found[0].size)),
                     texts.lists(codes(found, d).ravel(), np.full(n, TABLES * 2**k))],
                    ["rep", "copies", "label", "vector", "corners", "codes"])

    return run


def _changes(column: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before it."""
    if pa.types.is_nested(column.type) or pa.types.is_null(column.type):
        values = column.to_pylist()
        return np.array([x != y for x, y in zip(values, values[1:])], bool)
    return pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)


def _buckets(batches: Iterable[pa.RecordBatch], keys: list[str], least: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole runs of equal keys, of about ``least`` rows, and the number of each row's run."""
    held: list[pa.RecordBatch] = []

    def cut(last: bool) -> tuple[pa.Table, np.ndarray] | None:
        table = pa.Table.from_batches(held).combine_chunks()
        new = np.zeros(table.num_rows, bool)
        for key in keys:
            new[1:] |= _changes(table.column(key).combine_chunks())
        run = np.cumsum(new)
        end = table.num_rows if last else int(np.searchsorted(run, run[-1]))
        held[:] = table.slice(end).to_batches()
        return (table.slice(0, end), run[:end]) if end else None

    for batch in batches:
        for at in range(0, batch.num_rows, least):
            held.append(batch.slice(at, least))
            if sum(b.num_rows for b in held) >= least and (out := cut(False)) is not None:
                yield out
    if held:
        yield cut(True)


def _pairs(run: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of the same run, about ``PAIRS`` at a time."""
    rows = np.arange(len(run))
    others = np.searchsorted(run, run, "right") - rows - 1
    total = np.cumsum(others)
    first = 0
    while first < len(run):
        end = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + PAIRS, "right")))
        n = others[first:end]
        a = np.repeat(rows[first:end], n)
        yield a, a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
        first = end


def _cosines(unit: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", unit[a], unit[b])


def _compare(least: float, k: int):
    """Links within sorted buckets: per vector how many others (copies counted), and a spanning forest of links."""
    keys = ["label", "width", "t", "code", "i", "j"]

    def links(rows: pa.Table, run: np.ndarray) -> pa.RecordBatch | None:
        name, copies, block, i_, j_, table, own, width = (
            rows.column(n).to_numpy().astype(np.int64)
            for n in ("rep", "copies", "block", "i", "j", "t", "own", "width"))
        own = own == 1
        found = rows.column("corners").combine_chunks().flatten().to_numpy()
        found = found.reshape(len(name), -1).T.copy().reshape(TABLES, k, 2, len(name))
        vectors = np.zeros((len(name), width.max()))
        vectors[np.arange(width.max()) < width[:, None]] = rows.column("vector").combine_chunks().flatten().to_numpy()
        vectors = levelled(vectors)
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)

        def among(t: int | np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Whether the own bucket of either is one of the other's in table ``t``."""
            a_in, b_in = np.ones(len(a), bool), np.ones(len(a), bool)
            for r in range(k):
                p, q = found[t, r, 0, a], found[t, r, 0, b]
                same = p == q
                a_in &= same | (p == found[t, r, 1, b])
                b_in &= same | (q == found[t, r, 1, a])
            return a_in, b_in

        a_all, b_all = [], []
        for a, b in _pairs(run):
            # A bucket in several blocks: each pair of blocks meets once, pairs inside a block where i = j.
            met = (own[a] | own[b]) & ((i_[a] == j_[a]) | (block[a] != block[b]))
            a, b = a[met], b[met]
            # A pair belongs to the first table where the own bucket of one is among the other's. Most pairs that are
            # close share the first tables, so these few whole numbers spare nearly all of their cosines.
            for t in range(int(table.max())):
                a_in, b_in = among(t, a, b)
                here_first = (table[a] <= t) | ~(a_in | b_in)
                a, b = a[here_first], b[here_first]
            a_in, b_in = among(table[a], a, b)
            mine = np.where(np.where(name[a] < name[b], a_in, ~b_in), own[a], own[b])
            a, b = a[mine], b[mine]
            close = _cosines(vectors, a, b) >= least
            a_all.append(a[close])
            b_all.append(b[close])
        if not a_all or not sum(map(len, a_all)):
            return None
        a, b = np.concatenate(a_all), np.concatenate(b_all)
        ids, at = np.unique(np.concatenate([name[a], name[b]]), return_inverse=True)
        n = np.bincount(at, np.concatenate([copies[b], copies[a]]), len(ids)).astype(np.int64)
        parent = list(range(len(ids)))
        left, right = [], []
        for p, q in zip(at[: len(a)].tolist(), at[len(a) :].tolist()):
            while parent[p] != p:
                p = parent[p] = parent[parent[p]]
            while parent[q] != q:
                q = parent[q] = parent[parent[q]]
            if p != q:
                parent[max(p, q)] = min(p, q)
                left.append(int(ids[p]))
                right.append(int(ids[q]))
        return pa.record_batch({
            "rep": pa.array([*ids.tolist(), *left], pa.int64()),
            "other": pa.array([None] * len(ids) + right, pa.int64()),
            "n": pa.array([*n.tolist(), *[0] * len(left)], pa.int64()),
        })

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, group in _buckets(batches, keys, 8 * BLOCK):
            out = links(rows, group)
            if out is not None:
                yield out

    return run


def near_vectors(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    least: float = 0.93,
) -> DataFrame:
    """Links between vectors of one label whose cosine is at least ``least``, and the components they make.

    Returns one row per input row: ``vec_id, n_links`` (other rows linked directly), ``component_id`` (the least id
    reachable), ``kept``. A row links with nothing if its label or vector is null, or its vector is empty, all zero or
    holds a null or non-finite component; so does a row with a null id, which has a null ``component_id`` and is kept.
    Vectors of different lengths never link. An empty table gives an empty result; other columns are ignored. Rows
    that repeat an id count as rows of their own in ``n_links``.

    Equal vectors of one label are one class, linked without comparing. Each class is hashed into its own and the
    probed buckets in each of ``TABLES`` tables; a pair is a candidate where one's own bucket is among the other's.
    Buckets join two corners, or more in larger tables (``corners_for``), so that unrelated vectors seldom meet
    however many there are; of 64 components, a pair at
    0.93 is missed with a chance of 1e-5 at three corners. Candidates are verified by cosine in double precision, in the one bucket that owns the pair, and leave
    the task as counts and a spanning forest, never as all pairs. Large buckets are compared block by block.
    """
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vector"), F.col(label_col).alias("label"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & ~bad & F.exists("vector", lambda x: x != 0),
        F.lit(False))
    rows = rows.withColumn("content", F.when(sound, F.sha2(F.concat_ws(
        ",", F.transform("vector", lambda x: (x + 0.0).cast("string"))), 256)))
    classes = rows.filter("content is not null").groupBy("label", "content").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.any_value("vector").alias("vector"))
    kind = rows.schema["label"].dataType.simpleString()
    size = table.groupBy(F.col(label_col)).agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vector_col)).alias("width"))
    size = size.filter(F.col(label_col).isNotNull()).agg(F.max("n").alias("n"), F.max("width").alias("width")).first()
    k = corners_for(size["n"] or 0, max(size["width"] or 0, 1))
    hashed = materialize(
        classes.select("rep", "copies", "label", "content", "vector").select("rep", "copies", "label", "vector")
        .mapInArrow(_hash(k), f"rep long, copies long, label {kind}, vector array<double>, corners array<int>, codes array<long>"),
        "vector-codes")
    entries = hashed.select("rep", "label", F.size("vector").alias("width"), F.posexplode("codes").alias("slot", "code"))
    entries = entries.withColumn("t", F.floor(F.col("slot") / 2**k).cast("int")).withColumn(
        "own", (F.col("slot") % 2**k == 0).cast("int"))
    bucket = ["label", "width", "t", "code"]
    full = entries.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n"), F.sum("own").alias("owners")).filter(
        "n > 1 and owners > 0").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("k")
    placed = entries.join(full, bucket).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    tasks = placed.select("rep", "t", "code", "width", "own", "block", other).withColumn(
        "i", F.least("block", "k")).withColumn("j", F.greatest("block", "k"))
    joined = tasks.join(hashed.drop("codes"), "rep")
    keys = ["label", "width", "t", "code", "i", "j"]
    found = materialize(
        joined.select("rep", "copies", *keys, "own", "block", "vector", "corners")
        .repartition(*keys).sortWithinPartitions(*keys)
        .mapInArrow(_compare(least, k), "rep long, other long, n long"),
        "vector-links")
    counts = found.groupBy("rep").agg(F.sum("n").alias("far"))
    tree = components(found.filter("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b")))
    named = (
        classes.select("label", "content", "rep", "copies").join(counts, "rep", "left")
        .join(tree.withColumnRenamed("node", "rep"), "rep", "left")
        .select("label", "content", (F.col("copies") - 1 + F.coalesce("far", F.lit(0))).alias("links"),
                F.coalesce("component", "rep").alias("named"))
    )
    return rows.select("vec_id", "label", "content").join(named, ["label", "content"], "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("named", "vec_id").alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
