"""Language-model scores from an Elias-Fano n-gram trie with quantised, smoothed probabilities."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from skygrain.llm import elias, texts
from skygrain.plans.durable import materialize

END = np.uint64(0x454E44)  # the token after the last word of every text
RARE, START, FIRST = 0, 1, 2  # numbers of the class of words outside the trie, of the place before a text, of words
LEAST = 2  # words, bigrams and trigrams that occur so often in the training rows are learned
BLOCK_BYTES = 1_500_000  # text that one block holds
SHARD_TOKENS = 1_600_000  # tokens of the corpus for one shard
QUARTERS = 4  # discounted counts are sent as whole numbers of quarters
LOWEST = -12.0  # log10 of the least of the 256 levels of a block's trie
DISCOUNT = 0.75


def tokens(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, token hashes, row of each): the words of every text, then the end token."""
    for first, end, data, offsets in texts.blocks(column):
        hashes, row = texts.word_hashes(data, offsets)
        n = end - first
        at = np.arange(len(row)) + row
        out = np.full(len(row) + n, END, np.uint64)
        out[at] = hashes
        rows = np.empty(len(out), np.int64)
        rows[at] = row
        rows[np.cumsum(np.bincount(row, minlength=n) + 1) - 1] = np.arange(n)
        yield first, end, out, rows


def _lay(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of texts, one row each: the texts' ids and token numbers, the block's words and the word of each token."""
    made = TaskContext.get().partitionId() << 32
    for batch in batches:
        for first, end, _, _ in texts.blocks(batch.column("text"), BLOCK_BYTES):
            found = [(h, r + at) for at, _, h, r in tokens(batch.column("text").slice(first, end - first))]
            hashes, row = (np.concatenate(x) for x in zip(*found))
            words, code = np.unique(hashes, return_inverse=True)
            part, n = batch.slice(first, end - first), end - first
            yield pa.record_batch({
                "block": pa.array([made], pa.int64()),
                "doc_id": pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), part.column("doc_id")),
                "held_out": pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), part.column("held_out")),
                "n_tokens": texts.lists(np.bincount(row, minlength=n), np.array([n]), pa.int64()),
                "words": pa.array([words.tobytes()], pa.binary()),
                "codes": pa.array([_pack(code)], pa.binary()),
            })
            made += 1


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0, compressed with bytes of the same weight side by side: most high bytes are 0."""
    width = np.min_scalar_type(values.max()).itemsize if len(values) else 1
    planes = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()
    return bytes([width]) + len(values).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def _unpack(raw: bytes) -> np.ndarray:
    width, n = raw[0], int.from_bytes(raw[1:9], "little")
    if not n:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(pa.decompress(raw[9:], n * width, "zstd", asbytes=True), np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.int64)


def _joined(raw: list[bytes]) -> np.ndarray:
    """Answers of all shards, in their order."""
    return np.concatenate([_unpack(x) for x in raw])


def _pack_keys(columns: list[np.ndarray]) -> list[bytes]:
    """Columns of keys that ascend by the first one, which goes as steps."""
    first, *others = columns
    return [_pack(np.diff(first, prepend=np.uint64(0))), *map(_pack, others)]


def _unpack_keys(raw: list[bytes]) -> list[np.ndarray]:
    first, *others = (_unpack(x).view(np.uint64) for x in raw)
    return [np.cumsum(first, dtype=np.uint64), *others]


def _hash(columns: list[np.ndarray]) -> np.ndarray:
    """64-bit hash of each key: of an n-gram, the numbers of its words; of a word, the hash it has already."""
    out = columns[0]
    for column in columns[1:]:
        out = texts.mix(texts.mix(out) * np.uint64(0x9E3779B97F4A7C15) + column)
    return out


class Block:
    """A row of ``_lay`` and what follows from the answers it has: ``in_words``, ``in_pairs``, ``in_triples``.

    Keys go to the shard of their hash; a shard's answers come in the order in which the block holds the keys.
    """

    def __init__(self, row: dict, bits: int):
        self.block, self.doc_id, self.held_out = row["block"].as_py(), row["doc_id"], row["held_out"]
        self.bits = bits
        self.n_tokens = row["n_tokens"].values.to_numpy()
        self.code = _unpack(row["codes"].as_py()).astype(np.int32)
        self.row = np.repeat(np.arange(len(self.n_tokens)), self.n_tokens)
        self.learn = (~np.array(self.held_out.as_py(), bool)[self.row]).astype(float)
        if "words" in row:
            self.words = np.frombuffer(row["words"].as_py(), np.uint64)
        if "in_words" in row:
            self._words(row["in_words"].as_py(), row["in_ids"].as_py())
        if "in_pairs" in row:
            self._pairs(row["in_pairs"].as_py())
        if "in_triples" in row:
            self._triples(row["in_triples"].as_py())

    def shards(self, columns: list[np.ndarray]) -> np.ndarray:
        """In the fewest bytes each, as small whole numbers sort faster."""
        return (_hash(columns) >> np.uint64(64 - self.bits)).astype(np.min_scalar_type((1 << self.bits) - 1))

    def answer(self, raw: list[bytes] | None, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(sum, whether this block is the one that reports it) of each key."""
        out = np.zeros(len(columns[0]), np.int64)
        if len(out):
            out[np.argsort(self.shards(columns), kind="stable")] = _joined(raw)
        return out >> 1, (out & 1) > 0

    def _words(self, raw: list[bytes], ids: list[bytes]) -> None:
        """Local ids: the block's words of the trie by their numbers, the class of all others, the start.

        Words lie by their hashes, and so do shards: their answers need no order of their own.
        """
        self.counts, ids = _joined(raw) >> 1, _joined(ids)
        self.known = np.flatnonzero(ids >= FIRST)
        self.known = self.known[np.argsort(ids[self.known])]
        self.rare = len(self.known)
        self.start, self.size = self.rare + 1, self.rare + 2
        self.ids = np.append(ids[self.known], [RARE, START]).astype(np.uint64)
        local = np.full(len(ids), self.rare)
        local[self.known] = np.arange(self.rare)
        self.w = local[self.code]
        self.before = _before(self.w, self.row, self.start)
        self.fresh = np.ones(len(self.row), bool)
        self.fresh[1:] = self.row[1:] != self.row[:-1]
        self.pairs, self.pair_of = np.unique(self.before * self.size + self.w, return_inverse=True)
        self.pair_keys = [self.ids[self.pairs // self.size], self.ids[self.pairs % self.size]]

    def _pairs(self, raw: list[bytes]) -> None:
        """A trigram can be known only where both of its bigrams are."""
        self.pair_n, self.pair_once = self.answer(raw, self.pair_keys)
        known = (self.pair_n > 0)[self.pair_of]
        self.later = 1 + np.flatnonzero(known[1:] & known[:-1] & ~self.fresh[1:])
        self.triples, self.triple_of = np.unique(
            self.pair_of[self.later - 1] * self.size + self.w[self.later], return_inverse=True)
        pair = self.triples // self.size
        self.triple_keys = [*(k[pair] for k in self.pair_keys), self.ids[self.triples % self.size]]

    def _triples(self, raw: list[bytes] | None) -> None:
        """Contexts are words, followed by 0, and known bigrams, the second number one higher."""
        self.triple_n, self.triple_once = self.answer(raw, self.triple_keys)
        first, second = (k[self.pair_n > 0] for k in self.pair_keys)
        self.context_keys = [np.append(self.ids, first), np.append(np.zeros(self.size, np.uint64), second + np.uint64(1))]

    def asks(self, name: str) -> tuple[list[np.ndarray], np.ndarray]:
        """(keys, what this block adds to the sum of each)"""
        if name == "words":
            return [self.words], np.bincount(self.code, self.learn, len(self.words))
        if name == "pairs":
            return self.pair_keys, np.bincount(self.pair_of, self.learn, len(self.pairs))
        if name == "triples":
            return self.triple_keys, np.bincount(self.triple_of, self.learn[self.later], len(self.triples))
        given = lambda n, once, parent, of: np.bincount(
            parent[once], (n[once] - DISCOUNT) * QUARTERS, of)
        by_word = given(self.pair_n, self.pair_once, self.pairs // self.size, self.size)
        by_pair = given(self.triple_n, self.triple_once, self.triples // self.size, len(self.pairs))
        return self.context_keys, np.append(by_word, by_pair[self.pair_n > 0])


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {n: batch.column(n)[i] for n in batch.schema.names}


def _send(name: str, bits: int):
    """A block's keys and counts, cut by the first bits of the keys' hashes."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            block = Block(row, bits)
            keys, n = block.asks(name)
            shards = block.shards(keys)
            order = np.argsort(shards, kind="stable")
            keys, n = [k[order] for k in keys], n[order].astype(np.int64)
            shard, at = np.unique(shards[order], return_index=True)
            cuts = list(zip(at, [*at[1:], len(n)]))
            yield pa.record_batch({
                "shard": pa.array(shard.astype(np.int64)), "block": pa.array(np.full(len(shard), block.block)),
                "keys": pa.array([_pack_keys([k[i:j] for k in keys]) for i, j in cuts], pa.list_(pa.binary())),
                "n": pa.array([_pack(n[i:j]) for i, j in cuts], pa.binary())})

    return run


def _add_up(name: str, least: int, bits: int):
    """Sums over all blocks of one shard's keys, given back to each block in the order it sent them.

    Bigrams and trigrams below ``least`` are answered with 0. Words of the trie get numbers that differ between shards,
    lower ones the more frequent they are in their shard. The first row carries totals over the different keys: their
    sums, how many are above 0, how many and how much of the sums reach ``least``, how many are 1.
    """
    def run(chunks: pa.Table) -> pa.Table:
        keys = [_hash(_unpack_keys(x)) for x in chunks.column("keys").to_pylist()]
        n = np.concatenate([_unpack(x.as_py()) for x in chunks.column("n")])
        uniq, first, at = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        sums = np.bincount(at, n, len(uniq)).astype(np.int64)
        high = sums >= least
        totals = [sums.sum(), (sums > 0).sum(), high.sum(), sums[high].sum(), (sums == 1).sum()]
        kept = high if name in ("pairs", "triples") else np.ones(len(sums), bool)
        answer = np.where(kept, sums, 0)[at] * 2
        answer[first] += kept
        ends = np.cumsum([len(k) for k in keys])
        cuts = [(j - len(k), j) for k, j in zip(keys, ends)]
        ids: list[bytes | None] = [None] * len(keys)
        if name == "words":
            number = np.full(len(sums), RARE)
            ranked = np.flatnonzero(high)[np.argsort(-sums[high], kind="stable")]
            number[ranked] = FIRST + (np.arange(len(ranked)) << bits) + chunks.column("shard")[0].as_py()
            ids = [_pack(number[at[i:j]]) for i, j in cuts]
        return pa.table({
            "block": chunks.column("block"), "shard": chunks.column("shard"),
            "sums": pa.array([_pack(answer[i:j]) for i, j in cuts], pa.binary()), "ids": pa.array(ids, pa.binary()),
            "totals": pa.array([[int(x) for x in totals], *[[0] * 5] * (len(keys) - 1)], pa.list_(pa.int64()))})

    return run


def _before(ids: np.ndarray, row: np.ndarray, start: int) -> np.ndarray:
    """The id before each token of its text; the start at a text's first token."""
    out = np.empty_like(ids)
    out[1:] = ids[:-1]
    first = np.ones(len(ids), bool)
    first[1:] = row[1:] != row[:-1]
    out[first] = start
    return out


def quantise(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(8-bit codes, code book): 256 bins of equally many values, each read back as its mean."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.float32)
    order = np.argsort(values, kind="stable")
    codes = np.empty(len(values), np.uint8)
    codes[order] = (np.arange(len(values)) * 256) // len(values)
    n = np.bincount(codes, minlength=256)
    return codes, (np.bincount(codes, values, 256) / np.maximum(n, 1)).astype(np.float32)


def to_levels(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(8-bit codes, code book) of log10 values on fixed levels, so that tries of different blocks agree."""
    codes = np.clip(np.rint(values * (255 / LOWEST)), 0, 255).astype(np.uint8)
    return codes, np.linspace(0, LOWEST, 256, dtype=np.float32)


def build_trie(counts: np.ndarray, texts_n: int, pairs: np.ndarray, pair_n: np.ndarray, triples: np.ndarray,
               triple_n: np.ndarray, whole: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
               ) -> dict[str, np.ndarray]:
    """The trie's levels as flat arrays.

    ``counts``: of the trie words, then of the class of all others. ``pairs`` are sorted keys (previous id x size +
    id); ``triples`` are sorted keys (position of the first two among the pairs x size + id). Interpolated absolute
    discounting; what is not kept leaves its mass to the shorter context, so each context's distribution sums to one
    before quantising. Level 3 holds, for the pair (u, v), the words by their place among the successors of v.

    ``whole``, for the part of a trie that a block of texts can meet: probabilities of the words, and the mass left to
    the shorter context by each word and by each pair, as the whole corpus has them.
    """
    size = len(counts) + 1
    code = quantise if whole is None else to_levels
    p1 = np.append((counts + 0.5) / (counts.sum() + 0.5 * len(counts)), 1e-99)
    before, word = pairs // size, pairs % size
    context = np.append(counts, texts_n).astype(float)
    share2 = (pair_n - DISCOUNT) / context[before]
    back1 = np.clip(1 - np.bincount(before, share2, size), 1e-9, None)
    if whole is not None:
        p1, back1 = np.append(whole[0], 1e-99), whole[1]
    p2 = share2 + back1[before] * p1[word]
    starts = np.searchsorted(before, np.arange(size + 1))
    widest = max(1, int(np.diff(starts).max()))
    head, last = triples // size, triples % size
    middle = word[head] if len(head) else head
    tail = np.searchsorted(pairs, middle * size + last)
    share3 = (triple_n - DISCOUNT) / pair_n[head] if len(head) else np.zeros(0)
    back2 = np.clip(1 - np.bincount(head, share3, len(pairs)), 1e-9, None) if whole is None else whole[2]
    p3 = share3 + back2[head] * p2[tail] if len(head) else np.zeros(0)
    place = tail - starts[middle] if len(head) else tail
    third = head * widest + place
    order = np.argsort(third)
    out: dict[str, np.ndarray] = {"widest": np.array([widest], np.int64)}
    for name, parts in (
        ("pairs", elias.encode(pairs, size * size)),
        ("starts", elias.encode(starts, len(pairs) + 1)),
        ("third", elias.encode(third[order], max(1, len(pairs)) * widest)),
    ):
        out |= {f"{name}.{k}": v for k, v in parts.items()}
    for name, values in (("p1", p1), ("b1", back1), ("p2", p2), ("b2", back2), ("p3", p3[order])):
        out[name], out[f"{name}.book"] = code(np.log10(values))
    return out


class Trie:
    def __init__(self, arrays: dict[str, np.ndarray], size: int):
        part = lambda name: {k.split(".")[1]: v for k, v in arrays.items() if k.startswith(f"{name}.")}
        self.pairs, self.starts, self.third = (
            elias.EliasFano(part(k)) for k in ("pairs", "starts", "third"))
        self.arrays, self.size, self.widest = arrays, size, int(arrays["widest"][0])
        self.first = self.starts.get(np.arange(size))

    def log(self, name: str, at: np.ndarray) -> np.ndarray:
        return self.arrays[f"{name}.book"][self.arrays[name][at]].astype(np.float64)

    def score(self, w: np.ndarray, before: np.ndarray, fresh: np.ndarray, pair_of: np.ndarray | None = None,
              triple_of: np.ndarray | None = None) -> np.ndarray:
        """log10 of each token given up to two before it; ``fresh`` marks a text's first token.

        ``pair_of`` and ``triple_of`` number the bigram of each token, and the trigram of each token where both of its
        bigrams are known, by their sorted order: each different one is then looked up once.
        """
        at, known = _find_once(self.pairs, before * self.size + w, pair_of)
        prev_at, prev_known = np.roll(at, 1), np.roll(known, 1) & ~fresh
        out = np.where(known, 0.0, self.log("b1", before) + self.log("p1", w))
        two = np.flatnonzero(known)
        out[two] = self.log("p2", at[two])
        back = np.flatnonzero(prev_known)
        out[back] += self.log("b2", prev_at[back])
        both = np.flatnonzero(known & prev_known)
        place = at[both] - self.first[before[both]]
        third, found = _find_once(self.third, prev_at[both] * self.widest + place, triple_of)
        out[both[found]] = self.log("p3", third[found])
        return out


def _find_once(sequence: elias.EliasFano, keys: np.ndarray, number: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """``find`` of every key, with one search for all keys of the same number."""
    if number is None or not len(keys):
        return sequence.find(keys)
    different = np.empty(number.max() + 1, np.int64)
    different[number] = keys
    at, found = sequence.find(different)
    return at[number], found[number]


def _score(facts: dict):
    """Scores of the texts of blocks that have all their answers."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            yield _score_block(Block(row, facts["bits"]), row["in_contexts"].as_py() if facts["train"] else None, facts)

    return run


def _score_block(b: Block, raw: list[bytes] | None, facts: dict) -> pa.RecordBatch:
    n = len(b.n_tokens)
    c = b.counts[b.code]
    base = score = np.log10((c + 1) / facts["total"])
    if facts["train"]:
        counts = np.append(b.counts[b.known], facts["rare"]).astype(float)
        kept, known = b.pair_n > 0, b.triple_n > 0
        context = np.concatenate([counts, [facts["texts"]], b.pair_n[kept]])
        used = b.answer(raw, b.context_keys)[0] / QUARTERS
        left = np.clip(1 - used / np.maximum(context, 1), 1e-9, None)
        p1 = (counts + 0.5) / (facts["train"] + 0.5 * (facts["words"] + 1))
        triples = b.triples[known]
        triples = (np.cumsum(kept)[triples // b.size] - 1) * b.size + triples % b.size
        trie = Trie(elias.mapped(*elias.to_bytes(build_trie(
            counts, facts["texts"], b.pairs[kept], b.pair_n[kept].astype(float), triples,
            b.triple_n[known].astype(float), (p1, left[: b.size], left[b.size :])))), b.size)
        inside = np.where(c > 0, np.log10(np.maximum(c, 1)) + facts["seen"], facts["new"])
        score = trie.score(b.w, b.before, b.fresh, b.pair_of, b.triple_of) + np.where(b.w == b.rare, inside, 0.0)
    return pa.record_batch({
        "doc_id": b.doc_id.values, "held_out": b.held_out.values, "n_tokens": pa.array(b.n_tokens),
        "n_known": pa.array(np.bincount(b.row[c > 0], minlength=n)),
        "train_tokens": pa.array(np.full(n, facts["train"])),
        "base_score": pa.array(np.bincount(b.row, base, n)), "score": pa.array(np.bincount(b.row, score, n))})


def score_texts(
    docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST
) -> DataFrame:
    """Learn from the rows that are not held out, then score every row.

    Returns one row per input row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` (log10).
    A null text counts as empty: its only token is the end. A null id is a training row. Without training rows both
    scores are 0. Repeated rows count as often as they occur; other columns are ignored.

    Every word, bigram and trigram that occurs ``least`` times in the training rows is learned, however large the
    corpus. Texts are laid out in blocks of about ``BLOCK_BYTES``. A block sends each of its words once, by 64-bit
    hash, to the shard of the hash; the shard adds up the counts of all blocks, numbers the words of the trie and
    answers every block that asked. Bigrams, then trigrams of known bigrams, go the same way as compressed columns of
    those numbers, where frequent words take the least room, and so does the mass that contexts leave to shorter ones.
    From the answers a block makes the part of the trie that its texts can meet. Nothing that grows with the corpus
    passes through the driver or a broadcast, a shard holds the keys of about ``SHARD_TOKENS`` tokens, and a frequent
    n-gram costs its shard one entry a block. A word outside the trie is scored as its class times the word's share of
    the class; words never seen share one event, as in the base.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    laid = f"block long, doc_id array<{kind}>, held_out array<boolean>, n_tokens array<long>, words binary, codes binary"
    blocks = materialize(rows.mapInArrow(_lay, laid), "token-blocks")
    n_all = blocks.select(F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda x, y: x + y))).first()[0] or 0
    bits = max(4, math.ceil(math.log2(max(n_all, 1) / SHARD_TOKENS)))

    def answered(name: str) -> DataFrame:
        sent = having.mapInArrow(_send(name, bits), "shard long, block long, keys array<binary>, n binary")
        return materialize(sent.groupBy("shard").applyInArrow(
            _add_up(name, least, bits), "block long, shard long, sums binary, ids binary, totals array<long>"),
            f"token-{name}", free=True)

    def with_answers(name: str, answers: DataFrame) -> DataFrame:
        given = {"sums": f"in_{name}"} | ({"ids": "in_ids"} if name == "words" else {})
        one = answers.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("shard", *given))).alias("all"))
        one = one.select("block", *[F.col(f"all.{c}").alias(to) for c, to in given.items()])
        return having.drop("words").join(one.hint("merge"), "block", "left")

    having = blocks
    words = answered("words")
    n_train, n_types, n_words, inside, once = (
        int(x) for x in words.agg(*[F.coalesce(F.sum(F.col("totals")[i]), F.lit(0)) for i in range(5)]).first())
    having = with_answers("words", words)
    if n_train:
        for name in ("pairs", "triples", "contexts"):
            having = with_answers(name, answered(name))
    rare = n_train - inside
    new = (min(once, rare) + 0.5) / (rare + 1.0)
    n_texts = blocks.select(F.sum(F.size(F.filter("held_out", lambda x: ~x)))).first()[0] or 0
    facts = {"bits": bits, "total": float(n_train + n_types + 1), "train": n_train, "words": n_words, "rare": rare,
             "texts": float(n_texts), "new": math.log10(new), "seen": math.log10((1 - new) / max(rare, 1))}
    return having.mapInArrow(
        _score(facts), f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double")
