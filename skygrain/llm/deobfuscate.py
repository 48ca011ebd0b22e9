"""Noisy-channel restoration of disguised words: Viterbi over character lattices under a character language model."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skygrain.llm import texts

# What a digit or symbol may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c",
}
SEPARATORS = ".-_*~"
# log10 costs of the channel.
SUBSTITUTE, DROP_NOISE, DROP_REPEAT, DROP_SEPARATOR = -0.3, -2.5, -0.2, -0.2

# Classes of bytes: 0 boundary, 1 to 26 letters, 27 any byte of another script's letters.
SYMBOLS = 32
CLASS = np.zeros(256, np.uint8)
CLASS[97:123] = np.arange(1, 27)
CLASS[65:91] = np.arange(1, 27)
CLASS[128:] = 27
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in LEET if not c.isdigit()]] = True
_SEP = np.zeros(256, bool)
_SEP[[ord(c) for c in SEPARATORS]] = True
_EDGE = np.zeros(256, bool)
_EDGE[[ord(c) for c in ".,;:?!\"'-_*~()[]{}<>"]] = True
_SPLIT = re.compile(r"[^a-z0-9]*([a-z0-9@$!|+(](?:[._*~-]+[a-z0-9@$!|+(])+)[^a-z0-9]*")


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of four-character stretches of words and their edges, a fixed number of them (32**4)."""
    total = np.zeros(SYMBOLS**4, np.int64)
    for batch in batches:
        for first, end, data, offsets in texts.blocks(batch.column("text")):
            n = end - first
            line = np.zeros(len(data) + 3 * n + 3, np.int64)  # every text starts after three boundaries
            line[np.arange(len(data)) + 3 * (1 + np.repeat(np.arange(n), np.diff(offsets)))] = CLASS[data]
            code = ((line[:-3] * SYMBOLS + line[1:-2]) * SYMBOLS + line[2:-1]) * SYMBOLS + line[3:]
            total += np.bincount(code[(line[3:] > 0) | (line[2:-1] > 0)], minlength=SYMBOLS**4)
    at = np.flatnonzero(total)
    yield pa.record_batch({"code": pa.array(at), "n": pa.array(total[at])})


def character_model(docs: DataFrame) -> np.ndarray:
    """log10 of a character after three others, as a table [32**3, 32]; each order backs off to the shorter one."""
    counts = docs.select("text").mapInArrow(_count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    rows = counts.toArrow()
    n4 = np.zeros(SYMBOLS**4)
    n4[rows.column("code").to_numpy()] = rows.column("n").to_numpy()
    p = np.full(SYMBOLS, 1 / 28)
    p[28:] = 1e-9
    cube = n4.reshape([SYMBOLS] * 4)
    for n in (cube.sum((0, 1, 2)), cube.sum((0, 1)), cube.sum(0), cube):
        p = (n + 2.0 * p) / (n.sum(-1, keepdims=True) + 2.0)
    return np.log10(np.maximum(p, 1e-12)).reshape(-1, SYMBOLS).astype(np.float32)


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """Per character: what it may stand for ('' for nothing) and at which cost."""
    out = []
    for i, c in enumerate(token):
        if "a" <= c <= "z":
            arcs = [(c, 0.0)]
            if c * 3 in token[max(0, i - 2) : i + 3] and i and token[i - 1] == c:
                arcs.append(("", DROP_REPEAT))
        elif c in LEET:
            arcs = [(x, SUBSTITUTE) for x in LEET[c]] + [("", DROP_NOISE)]
            if i and token[i - 1] == c:
                arcs.append(("", DROP_REPEAT))
        elif c in SEPARATORS:
            arcs = [("", DROP_SEPARATOR)]
        elif c >= "\x80":
            arcs = [(c, 0.0)]  # another script's letter stays as it is
        else:
            arcs = [(" ", 0.0)]
        out.append(arcs)
    return out


def restore(token: str, model: np.ndarray, spaced: bool = False) -> str:
    """The likeliest clean form of a lower-cased token. ``spaced``: a word edge may fall after any letter."""
    states: dict[int, tuple[float, str]] = {0: (0.0, "")}
    for arcs in lattice(token):
        after: dict[int, tuple[float, str]] = {}

        def offer(state: int, score: float, text: str) -> None:
            held = after.get(state)
            if held is None or score > held[0]:
                after[state] = (score, text)

        for state, (score, text) in states.items():
            for c, cost in arcs:
                if not c:
                    offer(state, score + cost, text)
                    continue
                if c >= "\x80":
                    to = state
                    for _ in c.encode():
                        to = (to * SYMBOLS + 27) % SYMBOLS**3
                    offer(to, score + cost, text + c)
                    continue
                symbol = 0 if c == " " else ord(c) - 96
                here = score + cost + float(model[state, symbol])
                to = (state * SYMBOLS + symbol) % SYMBOLS**3
                offer(to, here, text + c)
                if spaced and symbol:
                    offer(to * SYMBOLS % SYMBOLS**3, here + float(model[to, 0]), text + c + " ")
        states = after
    return max((s + float(model[k, 0]), t) for k, (s, t) in states.items())[1].strip()


class Restorer:
    """Finds disguised stretches of texts and restores them; remembers what it has restored."""

    def __init__(self, model: np.ndarray, held: int = 50_000):
        self.model, self.held, self.known = model, held, {}

    def one(self, token: str, spaced: bool) -> str:
        key = (token, spaced)
        if key not in self.known:
            if len(self.known) >= self.held:
                self.known.clear()
            self.known[key] = restore(token, self.model, spaced)
        return self.known[key]

    def extras(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, str]]:
        """(row, restored words) of every disguised stretch: digits or symbols for letters, letters repeated three
        times or more, letters apart by signs or by spaces."""
        data = texts.LOWER[data]
        start, end, row = texts.words(data, offsets)
        if not len(start):
            return []
        letter = (CLASS[data] > 0) & (data < 128)
        foreign = CLASS[data] == 27
        word = letter | _DIGIT[data] | foreign
        after = np.zeros(len(data), bool)
        after[:-1] = word[1:] | (_SIGN[data[1:]])
        before = np.zeros(len(data), bool)
        before[1:] = word[:-1] | _SIGN[data[:-1]]
        tripled = np.zeros(len(data), bool)
        tripled[2:] = letter[2:] & (data[2:] == data[1:-1]) & (data[2:] == data[:-2])
        joint = _SEP[data] & before & after
        odd = _DIGIT[data] | (_SIGN[data] & after)
        readable = letter | _DIGIT[data] | _SIGN[data] | (data >= 0xC0)  # a foreign letter counts by its first byte
        count = lambda flag: np.add.reduceat(flag.astype(np.int32), start)
        disguised = (count(readable) >= 2) & ((count(odd) >= 1) | (count(joint) >= 1))
        disguised |= (count(tripled) >= 1) & (count(letter) >= 3)
        out = []
        raw = data.tobytes()
        for i in np.flatnonzero(disguised):
            token = raw[start[i] : end[i]].decode("utf-8", "replace")
            inner = _SPLIT.fullmatch(token)
            out.append((int(row[i]), self.one(inner[1] if inner else token.strip(".,;:?!\"'-_*~"), False)))
        # A word of a spaced run is one character once the punctuation at its edges is off.
        edge = _EDGE[data]
        for at in np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x80) & (data[2:] >= 0x90)):
            edge[at : at + 3] = True  # dashes, quotation marks and dots of Unicode
        core = np.maximum.reduceat(np.where(edge | texts.SPACE[data], -1, np.arange(len(data))), start)
        alone = end - start == 1
        core = np.where(alone, start, core)
        single = alone | (count(~edge & ~texts.SPACE[data]) == 1)
        single &= (letter | _DIGIT[data] | (_SIGN[data] & (data != ord("|"))))[core]
        if single.any():
            step = np.diff(np.concatenate([[0], (single).astype(np.int8), [0]]))
            for a, b in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1)):
                for r in np.unique(row[a:b]):
                    own = np.arange(a, b)[row[a:b] == r]
                    if len(own) >= 3 and (~_DIGIT[data[core[own]]]).any():
                        out.append((int(r), self.one(data[core[own]].tobytes().decode(), True)))
        return out
