"""Monotone sequences in Elias-Fano form over flat byte buffers, searched many values at a time."""

from __future__ import annotations

import tempfile

import numpy as np

_BYTE_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_BYTE_SELECT = np.zeros((256, 8), np.uint8)
for _b in range(256):
    for _r, _p in enumerate(p for p in range(8) if _b >> p & 1):
        _BYTE_SELECT[_b, _r] = _p


def encode(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    """Parts of the encoding of sorted values below ``universe``: low bits packed, high bits in unary, ones per word."""
    n = len(values)
    low = max(0, int(universe // max(n, 1)).bit_length() - 1)
    values = values.astype(np.uint64)
    high = (values >> np.uint64(low)).astype(np.int64)
    bits = np.zeros(n + (universe >> low) + 2, np.uint8)
    bits[high + np.arange(n)] = 1
    words = np.packbits(bits, bitorder="little")
    words = np.concatenate([words, np.zeros(-len(words) % 8, np.uint8)]).view(np.uint64)
    ones = np.cumsum([0, *np.bitwise_count(words).tolist()]).astype(np.uint32)
    packed = np.zeros(0, np.uint8)
    if low:
        each = np.empty((n, low), np.uint8)
        for bit in range(low):
            each[:, bit] = (values >> np.uint64(bit)) & np.uint64(1)
        packed = np.packbits(each.ravel(), bitorder="little")
    packed = np.concatenate([packed, np.zeros(-len(packed) % 8 + 16, np.uint8)]).view(np.uint64)
    return {"size": np.array([n, low], np.int64), "high": words, "ones": ones, "low": packed}


class EliasFano:
    """Access and successor search over the parts made by ``encode``; all arguments are arrays."""

    def __init__(self, parts: dict[str, np.ndarray]):
        self.n, self.low_bits = (int(x) for x in parts["size"])
        self.high, self.ones, self.low = parts["high"], parts["ones"], parts["low"]
        self.bytes = self.high.view(np.uint8)
        within = np.cumsum(_BYTE_ONES[self.bytes].reshape(-1, 8), axis=1, dtype=np.int64)
        self.ones_before = (self.ones[:-1, None] + within).ravel()
        self.ones_before = np.concatenate([[0], self.ones_before])[: len(self.bytes)]
        self.zeros_before = np.arange(len(self.bytes)) * 8 - self.ones_before

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Position of the k-th (from 0) one or zero among the high bits."""
        before = self.ones_before if ones else self.zeros_before
        byte = np.searchsorted(before, k, "right") - 1
        value = self.bytes[byte] if ones else ~self.bytes[byte]
        return byte * 8 + _BYTE_SELECT[value, k - before[byte]]

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        bit = i * self.low_bits
        word, off = bit >> 6, (bit & 63).astype(np.uint64)
        first = self.low[word] >> off
        second = np.where(off > 0, self.low[word + 1] << ((np.uint64(64) - off) & np.uint64(63)), np.uint64(0))
        return (first | second) & np.uint64((1 << self.low_bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The i-th values."""
        high = (self._select(i, True) - i).astype(np.uint64)
        return ((high << np.uint64(self.low_bits)) | self._lows(i)).astype(np.int64)

    def find(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first value not below x, whether it equals x). Every x must be below the universe."""
        if not self.n or not len(x):
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        high = x >> self.low_bits
        want = (x & ((1 << self.low_bits) - 1)).astype(np.uint64)
        start = np.where(high > 0, self._select(np.maximum(high - 1, 0), False) + 1 - high, 0)
        end = self._select(high, False) - high
        lo, hi = start.copy(), end.copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) >> 1
            less = self._lows(mid) < want[open_]
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
        found = lo < end
        at = np.flatnonzero(found)
        found[at] = self._lows(lo[at]) == want[at]
        return lo, found


def to_bytes(arrays: dict[str, np.ndarray]) -> tuple[bytes, dict[str, tuple[int, int, str]]]:
    """One buffer of named arrays, and where each lies in it (offset, length, type)."""
    out, places, at = [], {}, 0
    for name, a in arrays.items():
        raw = np.ascontiguousarray(a).tobytes()
        places[name] = (at, len(a), a.dtype.str)
        out.append(raw + b"\0" * (-len(raw) % 8))
        at += len(out[-1])
    return b"".join(out), places


def mapped(raw: bytes, places: dict[str, tuple[int, int, str]]) -> dict[str, np.ndarray]:
    """The arrays of ``to_bytes`` over a memory-mapped file that has no name any more, so nothing is left behind."""
    with tempfile.TemporaryFile() as f:
        f.write(raw or b"\0")
        f.flush()
        whole = np.memmap(f, np.uint8, "r")
    return {k: whole[at : at + n * np.dtype(t).itemsize].view(t) for k, (at, n, t) in places.items()}
