"""Vectorised helpers that run inside tasks: tokens and hashes of whole Arrow text columns."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 500_000  # text that is worked on at once; its arrays take tens of times as much

# ASCII white space that separates words: 0x20 and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least ``n`` of each."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        rows = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            rows.append(np.cumprod(p, dtype=np.uint64))
        _powers[:] = rows
    return _powers[0], _powers[1]


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a text column into runs of rows of about ``limit`` bytes: (first row, end row, bytes, row offsets).

    A text longer than the limit makes a run of its own. A null counts as an empty text.
    """
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    raw = column.buffers()
    offsets = np.frombuffer(raw[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(raw[2], np.uint8) if raw[2] is not None and raw[2].size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        at = offsets[first : end + 1]
        yield first, end, data[at[0] : at[-1]], at - at[0]
        first = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte positions (start, end) of the words between white space, and the row of each."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    word = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last[:-1] &= ~word[1:] | edge[1:-1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash of bytes or code points; ``span_hash`` takes the hash of any stretch from it."""
    value = VALUE[data] if data.dtype == np.uint8 else mix(data.astype(np.uint64) * np.uint64(_BASE))
    up, _ = powers(len(data) + 1)
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(value * up[: len(data)], out=run[1:])
    return run


def span_hash(run: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each stretch of bytes; equal stretches have equal hashes at any place."""
    _, down = powers(len(run))
    return mix((run[end] - run[start]) * down[start])


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word, A-Z lower-cased."""
    data = LOWER[data]
    start, end, row = words(data, offsets)
    return span_hash(prefix_hash(data), start, end), row


def text_hash(text: str) -> int:
    """The hash that ``word_hashes`` gives a word, as a signed long."""
    data = LOWER[np.frombuffer(text.encode(), np.uint8)]
    run = prefix_hash(data)
    return int(span_hash(run, np.array([0]), np.array([len(data)])).view(np.int64)[0])


class Tally:
    """Sums of counts by 64-bit keys, folded whenever the pending keys outgrow ``limit``."""

    def __init__(self, measures: int = 1, limit: int = 3_000_000):
        self.limit, self.measures = limit, measures
        self.keys: list[np.ndarray] = []
        self.sums: list[np.ndarray] = []
        self.pending = 0

    def add(self, keys: np.ndarray, *counts: np.ndarray) -> None:
        uniq, at = np.unique(keys, return_inverse=True)
        counts = counts or (None,)
        self.keys.append(uniq)
        self.sums.append(np.stack([np.bincount(at, c, len(uniq)).astype(np.int64) for c in counts]))
        self.pending += len(uniq)

    def full(self) -> bool:
        return self.pending >= self.limit

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        """Everything so far: sorted keys and one row of sums per measure. The tally is empty afterwards."""
        if not self.keys:
            return np.zeros(0, np.uint64), np.zeros((self.measures, 0), np.int64)
        keys, at = np.unique(np.concatenate(self.keys), return_inverse=True)
        sums = np.concatenate(self.sums, axis=1)
        out = np.stack([np.bincount(at, s, len(keys)).astype(np.int64) for s in sums])
        self.keys, self.sums, self.pending = [], [], 0
        return keys, out


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, found) of each wanted value among sorted keys."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """An Arrow list column from flat values and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind) if kind else pa.array(values))


def by_key(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys in batches that are sorted by them, one table per run."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_pylist() for k in keys]
        start = 0
        for i, key in enumerate(zip(*columns)):
            if key != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, last, start = [], key, i
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def remainder(id_col: str, of: int):
    """crc32 of the id as text, modulo ``of``; null for a null id."""
    from pyspark.sql import functions as F

    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(of))
