"""Language identification: known words first, shorter and shorter character n-grams for the others."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from skygrain.llm import texts
from skygrain.plans.durable import materialize

ORDERS = (5, 4, 3, 2, 1)
LEAST = 2  # words and n-grams that occur so often in the training rows are known, however large the corpus
CARRIED = 500_000  # at most so many of the most frequent words are broadcast; joins find the others
CARRIED_ENTRIES = 4_000_000  # n-grams of a length with at most so many counts are broadcast to their join
ADDED = 0.1  # added to each count
HELD_WORDS = 400_000
HELD_GRAMS = 3_000_000
CELLS = 2_000_000  # scores that a task holds at once: texts x languages

COUNTS = "array<struct<lang:int,n:long>>"
ENTRIES = "array<struct<k:int,g:double>>"

_RUN = re.compile(r"[^\W\d_]+")


def letter_words(text: str) -> list[str]:
    """Runs of letters, lower-cased."""
    found = _RUN.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    return "".join(c if c.isalpha() else " " for c in text.lower()).split()


def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, lang, n), combined within the task."""
    held: dict[int, Counter] = {}
    added = 0

    def flush() -> pa.RecordBatch:
        rows = [(w, lang, n) for lang, c in held.items() for w, n in c.items()]
        held.clear()
        word, lang, n = zip(*rows) if rows else ((), (), ())
        return pa.record_batch({
            "word": pa.array(word, pa.string()), "lang": pa.array(lang, pa.int32()), "n": pa.array(n, pa.int64()),
        })

    for batch in batches:
        for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist()):
            words = letter_words(text.as_py())
            held.setdefault(lang, Counter()).update(words)
            added += len(words)
            if added > HELD_WORDS:
                added = sum(map(len, held.values()))
                if added > HELD_WORDS // 2:
                    yield flush()
                    added = 0
    yield flush()


def _gram_hashes(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(running hash, start, end) of words laid out with one space before and after each."""
    joined = " " + " ".join(words) + " "
    run = texts.prefix_hash(np.frombuffer(joined.encode("utf-32-le"), np.uint32))
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) + 1
    return run, end - length - 2, end


def _grams(run, start, end, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, word) of all n-grams of one length, spaces at both ends of a word counted as characters."""
    per = np.maximum(end - start - order + 1, 0)
    word = np.repeat(np.arange(len(start)), per)
    at = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per) + start[word]
    return texts.span_hash(run, at, at + order), word


def _count_grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(size, gram, lang, n) of the words' n-grams, combined within the task."""
    tallies: dict[tuple[int, int], texts.Tally] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for (order, lang), tally in tallies.items():
            keys, (sums,) = tally.take()
            yield pa.record_batch({
                "size": pa.array(np.full(len(keys), order, np.int32)), "gram": pa.array(keys.view(np.int64)),
                "lang": pa.array(np.full(len(keys), lang, np.int32)), "n": pa.array(sums),
            })
        tallies.clear()

    for batch in batches:
        words = np.array(batch.column("word").to_pylist(), object)
        lang, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("lang", "n"))
        for one in np.unique(lang):
            here = np.flatnonzero(lang == one)
            laid, counts = _gram_hashes(words[here].tolist()), n[here]
            for o in ORDERS:
                keys, word = _grams(*laid, o)
                tallies.setdefault((o, int(one)), texts.Tally()).add(keys, counts[word])
        if sum(t.pending for t in tallies.values()) > HELD_GRAMS:
            yield from flush()
    yield from flush()


def _word_grams(order: int):
    """(word, gram) of one length, repeats included."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word")
            if len(words):
                keys, word = _grams(*_gram_hashes(words.to_pylist()), order)
                yield pa.record_batch({"word": words.take(pa.array(word)), "gram": pa.array(keys.view(np.int64))})

    return run


def _by_lang(counted: DataFrame, keys: list[str]) -> DataFrame:
    """Counts in long form to one row per key with its languages: one shuffle, as tasks have combined already."""
    return (
        counted.repartition(*keys).groupBy(*keys, "lang").agg(F.sum("n").alias("n"))
        .groupBy(*keys).agg(F.sum("n").alias("total"), F.collect_list(F.struct("lang", "n")).cast(COUNTS).alias("counts"))
    )


def _gains(counts: Column) -> Column:
    """What each language's count adds to the log frequency of an entry that the language never has."""
    return F.transform(counts, lambda x: F.struct(
        x["lang"].alias("k"), F.log((x["n"] + F.lit(ADDED)) / F.lit(ADDED)).alias("g"))).cast(ENTRIES)


@dataclass
class LanguageModel:
    """Counts of known words and n-grams as written tables, and what is the same for all entries.

    ``base[0]`` holds, per language, the log frequency of a word that the language never has; ``base[o]`` that of an
    n-gram of length o.
    """

    langs: list[str]
    prior: np.ndarray
    base: dict[int, np.ndarray]
    words: DataFrame | None = None  # word, total, counts
    grams: DataFrame | None = None  # size, gram, total, counts
    entries: dict[int, int] | None = None  # counts in the n-grams of each length

    def carried(self) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(words, start of each one's entries, languages, gains) of the most frequent words; at most ``CARRIED``.

        The least count is the lowest power of two that keeps them within that number, from at most 63 counts.
        """
        power = F.floor(F.log2("total")).cast("int").alias("power")
        least, words = 62, 0
        for r in sorted(self.words.groupBy(power).count().collect(), key=lambda r: -r.power):
            words += r["count"]
            if words > CARRIED:
                break
            least = r.power
        found = self.words.filter(F.col("total") >= F.lit(1 << least)).select("word", "counts").toArrow().combine_chunks()
        if not found.num_rows:
            return [], np.zeros(1, np.int64), np.zeros(0, np.int32), np.zeros(0)
        counts = found.column("counts").combine_chunks()
        lang, n = (counts.flatten().field(f).to_numpy() for f in ("lang", "n"))
        return (found.column("word").to_pylist(), np.append(0, np.cumsum(counts.value_lengths().to_numpy())),
                lang.astype(np.int32), np.log((n + ADDED) / ADDED))

    def backoff(self, words: DataFrame) -> DataFrame:
        """(word, level, entries) of different words that are not known: mean gains over the longest n-grams of which any is known.

        One join per length, from long to short, by broadcast where the table is small by count; a word leaves with the first length that knows it. Words of which
        not even a letter is known give no row.
        """
        open_, found = words.select("word"), None
        for order in ORDERS:
            pairs = open_.mapInArrow(_word_grams(order), "word string, gram long")
            table = self.grams.filter(F.col("size") == order).select("gram", "counts")
            hits = pairs.join(F.broadcast(table) if self.entries[order] <= CARRIED_ENTRIES else table, "gram")
            entries = F.concat(_gains(F.col("counts")), F.array(F.struct(F.lit(-1).alias("k"), F.lit(1.0).alias("g"))))
            sums = (
                hits.select("word", F.explode(entries.cast(ENTRIES)).alias("e"))
                .groupBy("word", "e.k").agg(F.sum("e.g").alias("g"))
                .groupBy("word").agg(
                    F.max(F.when(F.col("k") < 0, F.col("g"))).alias("n"), F.collect_list(F.struct("k", "g")).alias("e"))
            )
            here = materialize(sums.select("word", F.lit(order).alias("level"), F.transform(
                F.filter("e", lambda x: x["k"] >= 0),
                lambda x: F.struct(x["k"].alias("k"), (x["g"] / F.col("n")).alias("g"))).cast(ENTRIES).alias("entries"),
            ), "language-backoff", free=True)
            found = here if found is None else found.unionByName(here)
            open_ = materialize(open_.join(here.select("word"), "word", "left_anti"), "language-open", free=True)
            if open_.isEmpty():
                break
        return found

    def unseen(self, words: list[str]) -> np.ndarray:
        """Scores of the given different words by their n-grams, one row per word and one column per language."""
        out = np.zeros((len(words), len(self.langs)))
        at = {w: i for i, w in enumerate(words)}
        asked = self.grams.sparkSession.createDataFrame([(w,) for w in words], "word string")
        for r in self.backoff(asked).collect():
            out[at[r.word]] = self.base[r.level]
            for e in r.entries:
                out[at[r.word], e.k] += e.g
        return out


def train(docs: DataFrame) -> LanguageModel:
    """Counts of ``docs`` (text, lang, both not null), combined within tasks before the shuffle.

    Every word and n-gram with ``LEAST`` occurrences is known, whatever its language's share. Counts stay in tables;
    the driver sees the languages and a few sums for each.
    """
    rows = docs.filter("text is not null and lang is not null").select("text", F.col("lang").cast("string"))
    langs = sorted(r.lang for r in rows.select("lang").distinct().collect())
    if not langs:
        return LanguageModel([], np.zeros(0), {})
    rows = rows.withColumn("lang", (F.array_position(F.lit(langs), F.col("lang")) - 1).cast("int"))
    counted = rows.mapInArrow(_count_words, "word string, lang int, n long")
    words = materialize(_by_lang(counted, ["word"]), "language-words", free=True)
    long = words.select("word", F.explode("counts").alias("c")).select("word", "c.lang", "c.n")
    grams = _by_lang(long.mapInArrow(_count_grams, "size int, gram long, lang int, n long"), ["size", "gram"])
    grams = materialize(grams.filter(F.col("total") >= LEAST), "language-grams", free=True)
    known = words.filter(F.col("total") >= LEAST)
    totals = np.zeros(len(langs))
    for r in long.groupBy("lang").agg(F.sum("n").alias("n")).collect():
        totals[r.lang] = r.n
    sums = {o: np.zeros(len(langs)) for o in ORDERS}
    for r in grams.select("size", F.explode("counts").alias("c")).groupBy("size", "c.lang").agg(F.sum("c.n").alias("n")).collect():
        sums[r["size"]][r.lang] = r.n
    kinds, entries = dict.fromkeys(ORDERS, 0), dict.fromkeys(ORDERS, 0)
    for r in grams.groupBy("size").agg(F.count(F.lit(1)).alias("kinds"), F.sum(F.size("counts")).alias("entries")).collect():
        kinds[r["size"]], entries[r["size"]] = r.kinds, r.entries
    sums[0], kinds[0] = totals, known.count()
    base = {o: np.log(ADDED / (s + ADDED * max(kinds[o], 1))) for o, s in sums.items()}
    prior = np.log((totals + 1) / (totals + 1).sum())
    return LanguageModel(langs, prior, base, known, grams, entries)


def _first_pass(shared):
    """Each text's scores by the broadcast words, and its other words for the joins."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prior, base, words, starts, lang, gain = shared.value
        index = {w: i for i, w in enumerate(words)}
        width, made = len(prior), TaskContext.get().partitionId() << 33
        most = max(1, CELLS // width)

        def give(part: pa.RecordBatch, found: list[list[int]], rest: list[list[str]], spoken: list[bool]):
            nonlocal made
            n = part.num_rows
            lengths = np.array([len(f) for f in found])
            at, row = np.array([a for f in found for a in f], np.int64), np.repeat(np.arange(n), lengths)
            per = starts[at + 1] - starts[at]
            entry = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per) + np.repeat(starts[at], per)
            sums = np.bincount(np.repeat(row, per) * width + lang[entry], gain[entry], n * width).reshape(n, width)
            sums = sums + lengths[:, None] * base + prior
            made += n
            return pa.record_batch({
                "row": pa.array(np.arange(made - n, made)), "doc_id": part.column("doc_id"),
                "held_out": part.column("held_out"), "spoken": pa.array(spoken, pa.bool_()),
                "sums": texts.lists(sums.ravel(), np.full(n, width), pa.float64()),
                "rest": pa.array(rest, pa.list_(pa.string())),
            })

        for batch in batches:
            first, size, found, rest, spoken = 0, 0, [], [], []
            for i, text in enumerate(batch.column("text")):
                said = letter_words(text.as_py() or "")
                at = list(map(index.get, said))
                found.append([a for a in at if a is not None])
                rest.append([w for w, a in zip(said, at) if a is None])
                spoken.append(bool(said))
                size += len(said)
                if len(found) == most or size > HELD_WORDS:
                    yield give(batch.slice(first, len(found)), found, rest, spoken)
                    first, size, found, rest, spoken = i + 1, 0, [], [], []
            if found:
                yield give(batch.slice(first), found, rest, spoken)

    return run


def _decide(langs: list[str], base: dict[int, np.ndarray]):
    """The best language of each text from both passes."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = max(1, CELLS // len(langs))
        for whole in batches:
            for first in range(0, whole.num_rows, most):
                yield decide(whole.slice(first, most))

    def decide(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, width = batch.num_rows, len(langs)
        sums = batch.column("sums").flatten().to_numpy(zero_copy_only=False).reshape(n, width)
        more = batch.column("more")
        row = np.repeat(np.arange(n), more.value_lengths().fill_null(0).to_numpy())
        level, entries = (more.flatten().field(f) for f in ("level", "entries"))
        level, lengths = level.to_numpy(), entries.value_lengths().to_numpy()
        k, g = (entries.flatten().field(f).to_numpy(zero_copy_only=False) for f in ("k", "g"))
        sums = sums + np.bincount(np.repeat(row, lengths) * width + k, g, n * width).reshape(n, width)
        for one, scores in base.items():
            sums += np.bincount(row[level == one], minlength=n)[:, None] * scores
        best = sums.argmax(1)
        share = 1.0 / np.exp(sums - sums.max(1, keepdims=True)).sum(1)
        spoken = batch.column("spoken").to_pylist()
        return pa.record_batch({
            "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
            "lang_pred": pa.array([langs[b] if s else "und" for b, s in zip(best, spoken)], pa.string()),
            "score": pa.array([float(x) if s else 0.0 for x, s in zip(share, spoken)], pa.float64()),
        })

    return run


def identify(
    docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """Learn from the rows that are not held out, then predict every row from its text alone.

    Returns one row per input row: ``doc_id, held_out, lang_pred, score`` (the share of the best language in the
    posterior). A text that is null, empty or has no letter gives ``und`` with score 0.0; so does everything when no
    row has a language to learn from. A null id is never held out. Ties go to the first language in alphabetical
    order. Repeated rows are predicted alike; other columns are ignored.

    Frequent words (``CARRIED``) are broadcast and scored where the text lies. All other words of the texts are
    looked up by join, once per different word, and those that are not known go on to the n-grams. Which words are
    broadcast changes the plan only, not the scores.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    model = train(rows.filter(~F.col("held_out")))
    if not model.langs:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast((model.prior, model.base[0], *model.carried()))
    passed = materialize(rows.select("doc_id", "held_out", "text").mapInArrow(
        _first_pass(shared),
        f"row long, doc_id {kind}, held_out boolean, spoken boolean, sums array<double>, rest array<string>",
    ), "language-texts", free=True)
    rest = passed.select("row", F.explode("rest").alias("word"))
    asked = materialize(
        rest.select("word").distinct().join(model.words.select("word", "counts"), "word", "left"), "language-asked", free=True)
    by_word = asked.filter("counts is not null").select(
        "word", F.lit(0).alias("level"), _gains(F.col("counts")).alias("entries"))
    answers = by_word.unionByName(model.backoff(asked.filter("counts is null")))
    more = rest.join(answers, "word").groupBy("row").agg(F.collect_list(F.struct("level", "entries")).alias("more"))
    return passed.drop("rest").join(more, "row", "left").mapInArrow(
        _decide(model.langs, model.base), f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    )
