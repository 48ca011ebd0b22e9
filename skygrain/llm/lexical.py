"""Ranked lexical search that scans texts with one automaton of all query terms; there is no index of the documents."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from skygrain.llm.texts import LOWER, blocks, lists
from skygrain.plans.durable import materialize

TOP = 10
BLOCK_ITEMS, BLOCK_TERMS, BLOCK_BYTES = 2_000, 50_000, 4_000_000  # of one automaton; more items go in further scans
SALTS = 256
SCORE_CELLS = 4_000_000  # (documents x items) scored at a time

# A term is a stretch of ASCII letters and digits and of characters beyond ASCII; in UTF-8 those are bytes above 0x7F.
TERM_BYTE = np.zeros(256, bool)
TERM_BYTE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
FOLD = np.where(TERM_BYTE, LOWER, 0x20).astype(np.uint8)  # lower-cased; all else becomes the guard that bounds terms
TERM = re.compile(rb"[^ ]+")

_built: dict[int, ahocorasick.Automaton] = {}


def terms_of(text: str | None) -> list[bytes]:
    return TERM.findall(FOLD[np.frombuffer((text or "").encode(), np.uint8)].tobytes())


@dataclass
class Block:
    """Some items and their different terms: ``postings`` maps a term's number to (item's number, repeats)."""

    items: list
    terms: list[bytes]
    items_of: np.ndarray
    repeats: np.ndarray
    starts: np.ndarray


def item_blocks(items: DataFrame, id_col: str, text_col: str, most: tuple[int, int, int]) -> Iterator[Block]:
    """Cut the items into blocks of bounded size. Rows come to the driver one partition at a time, a block is held.

    An item whose own terms outgrow the bound makes a block by itself.
    """
    held: list[tuple[object, dict[bytes, int]]] = []
    known: set[bytes] = set()
    size = 0
    for ident, text in items.select(id_col, text_col).distinct().toLocalIterator():
        counts: dict[bytes, int] = {}
        for t in terms_of(text):
            counts[t] = counts.get(t, 0) + 1
        if not counts:
            continue
        new = counts.keys() - known
        grown = size + sum(map(len, new))
        if held and (len(held) >= most[0] or len(known) + len(new) > most[1] or grown > most[2]):
            yield _block(held)
            held, known, grown = [], set(), sum(map(len, counts))
            new = counts.keys()
        held.append((ident, counts))
        known |= new
        size = grown
    if held:
        yield _block(held)


def _block(held: list[tuple[object, dict[bytes, int]]]) -> Block:
    terms = sorted({t for _, counts in held for t in counts})
    number = {t: i for i, t in enumerate(terms)}
    flat = sorted((number[t], i, n) for i, (_, counts) in enumerate(held) for t, n in counts.items())
    at, items_of, repeats = (np.array(x, np.int64) for x in zip(*flat))
    return Block([i for i, _ in held], terms, items_of, repeats, np.searchsorted(at, np.arange(len(terms) + 1)))


def automaton(key: int, terms: Sequence[bytes]) -> ahocorasick.Automaton:
    """The automaton of `` term `` for each term: guards on both sides, so that it stops at whole terms only.

    Neighbours share a guard; the automaton reports overlapping hits. Made once in a worker for each block of items.
    """
    if key not in _built:
        _built.clear()
        made = ahocorasick.Automaton()
        for i, t in enumerate(terms):
            made.add_word(f" {t.decode('latin-1')} ", i)
        made.make_automaton()
        _built[key] = made
    return _built[key]


def _scan(shared):
    """Texts to (id, number of terms, numbers of the query terms met, how often each)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, terms = shared.value
        found = automaton(key, terms)
        for batch in batches:
            for first, end, data, offsets in blocks(batch.column("text")):
                inside = TERM_BYTE[data]
                starts = inside.copy()
                starts[1:] &= ~inside[:-1]
                rows = offsets[:-1][offsets[:-1] < len(data)]
                starts[rows] = inside[rows]
                upto = np.zeros(len(data) + 1, np.int64)
                np.cumsum(starts, out=upto[1:])
                raw = FOLD[data].tobytes().decode("latin-1")
                hits, counts, lengths = [], [], []
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    met, n = np.unique(np.fromiter((v for _, v in found.iter(f" {raw[a:b]} ")), np.int32), return_counts=True)
                    hits.append(met)
                    counts.append(n)
                    lengths.append(len(met))
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").slice(first, end - first),
                    "n": pa.array(upto[offsets[1:]] - upto[offsets[:-1]]),
                    "terms": lists(np.concatenate(hits), np.array(lengths), pa.int32()),
                    "tfs": lists(np.concatenate(counts).astype(np.int64), np.array(lengths)),
                })

    return run


def _count(size: int):
    """How many scanned texts hold each term: one partial count per task and term."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size, np.int64)
        for batch in batches:
            sums += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        met = np.flatnonzero(sums)
        yield pa.record_batch({"term": pa.array(met.astype(np.int32)), "df": pa.array(sums[met])})

    return run


def _best(shared, total: int, length: int, top: int):
    """Each task's best documents of each item: the (documents x items) scores are added up in slices."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, items_of, repeats, starts, n_items = shared.value
        rows = max(1, SCORE_CELLS // n_items)
        best_score, best_doc, best_item = (np.zeros(0, np.int64) for _ in range(3))
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                ids = part.column("doc_id").to_numpy()
                held = np.diff(part.column("terms").offsets.to_numpy())
                term = part.column("terms").flatten().to_numpy()
                tf = part.column("tfs").flatten().to_numpy()
                m = 25 + (75 * part.column("n").to_numpy() * total) // length
                doc = np.repeat(np.arange(len(ids)), held)
                gain = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
                fan = starts[term + 1] - starts[term]
                score = np.zeros(len(ids) * n_items, np.int64)
                for a, b in _runs(fan):
                    f = fan[a:b]
                    post = np.repeat(starts[term[a:b]] - np.cumsum(f) + f, f) + np.arange(f.sum())
                    cell = np.repeat(doc[a:b], f) * n_items + items_of[post]
                    order = np.argsort(cell, kind="stable")
                    cell, value = cell[order], (np.repeat(gain[a:b], f) * repeats[post])[order]
                    first = np.flatnonzero(np.diff(cell, prepend=-1))
                    score[cell[first]] += np.add.reduceat(value, first)
                cell = np.flatnonzero(score)
                best_item, best_score, best_doc = _keep(
                    np.concatenate([best_item, cell % n_items]), np.concatenate([best_score, score[cell]]),
                    np.concatenate([best_doc, ids[cell // n_items]]), top)
        yield pa.record_batch({"item": pa.array(best_item.astype(np.int32)), "doc_id": pa.array(best_doc),
                               "score": pa.array(best_score)})

    return run


def _runs(fan: np.ndarray, limit: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Cut entries into runs of about ``limit`` products."""
    done = np.cumsum(fan)
    a = 0
    while a < len(fan):
        b = max(a + 1, int(np.searchsorted(done, (done[a - 1] if a else 0) + limit, "right")))
        yield a, b
        a = b


def _keep(item: np.ndarray, score: np.ndarray, doc: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((doc, -score, item))
    item, score, doc = item[order], score[order], doc[order]
    place = np.arange(len(item)) - np.searchsorted(item, item)
    return item[place < top], score[place < top], doc[place < top]


def _weight(total: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1)))


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    most: tuple[int, int, int] = (BLOCK_ITEMS, BLOCK_TERMS, BLOCK_BYTES),
) -> DataFrame:
    """The ``top`` best documents of each item: ``item_id, rank, doc_id, score``.

    Score: the sum over the item's terms, repeats included, of w * ((10^9 tf) div (1000 tf + 8 m)), with
    w = floor(1000 ln((2 N + 2) / (2 df + 1))) and m = 25 + (75 n N) div L, all integers but the logarithm. N counts
    documents with a term, L all their terms, n one document's. Equal scores go by ascending ``doc_id``.

    Null and empty texts, on either side, have no terms: such documents count nowhere and such items have no rows.
    Documents must have integer ids; a null id is left out of the ranking but counts in N, L and df. Repeated
    document rows are ranked each. A repeated item row counts once; rows of one item id with different texts are
    searched apart and share the id. An empty table on either side gives an empty result. Other columns are ignored.

    Every text is scanned whole, once for each block of items (``most``: items, terms and bytes of terms a block may
    have, which bounds what is broadcast). The scan leaves (id, length, query terms met) per document; document
    frequencies are added up from partial counts, and each task sends its best rows of each item only. These are cut
    down per salt before one group sees all of an item's rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = None
    for number, block in enumerate(item_blocks(items, item_col, item_text_col, most)):
        rows = _search_block(spark, texts, block, top).join(
            F.broadcast(_names(spark, block, items.schema[item_col])), "item").select("item_id", "rank", "doc_id", "score")
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        kind = items.schema[item_col].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return found


def _names(spark: SparkSession, block: Block, field) -> DataFrame:
    return spark.createDataFrame([(i, x) for i, x in enumerate(block.items)], f"item int, item_id {field.dataType.simpleString()}")


def _search_block(spark: SparkSession, texts: DataFrame, block: Block, top: int) -> DataFrame:
    key = hash((tuple(map(str, block.items)), len(block.terms)))
    scan = spark.sparkContext.broadcast((key, block.terms))
    met = materialize(
        texts.mapInArrow(_scan(scan), "doc_id long, n long, terms array<int>, tfs array<long>").filter("n > 0"), "term-hits")
    total, length = met.agg(F.count(F.lit(1)), F.sum("n")).first()
    dfs = dict(met.select("terms").mapInArrow(_count(len(block.terms)), "term int, df long").groupBy("term").agg(F.sum("df")).collect())
    weights = np.array([_weight(total, dfs.get(i, 0)) for i in range(len(block.terms))], np.int64)
    model = spark.sparkContext.broadcast((weights, block.items_of, block.repeats, block.starts, len(block.items)))
    mine = met.filter("doc_id IS NOT NULL").mapInArrow(
        _best(model, total, length or 1, top), "item int, doc_id long, score long")
    order = [F.desc("score"), F.asc("doc_id")]
    salted = mine.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order)))
    last = few.filter(F.col("rank") <= top).drop("salt")
    ranked = last.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return ranked.filter(F.col("rank") <= top)
