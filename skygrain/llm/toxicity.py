"""Toxicity of texts after disguised words are restored."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from skygrain.llm import deobfuscate, texts
from skygrain.llm.minhash import near_duplicates
from skygrain.plans.durable import materialize

SAMPLE_PER_CLASS = 10_000  # labelled texts of each class that the classifier learns from, taken in order of a hash
LEAST_EVIDENCE = 14.0  # log-likelihood ratio against chance that a feature needs
LEAST_PRECISION = 0.9  # estimated share of toxic texts among those with a feature that it needs
PREFIXES = (3, 4, 5, 6)


def features(data: np.ndarray, offsets: np.ndarray, restorer: deobfuscate.Restorer) -> tuple[np.ndarray, np.ndarray]:
    """(feature, row): hashes of each word and of its beginnings, in the text as it is and in what was restored.

    Words are stretches of letters. A feature's word stands in the same column of the first axis (one row per kind).
    """
    extra = restorer.extras(data, offsets)
    found = _spelled(data, offsets)
    if extra:
        own = np.array([r for r, _ in extra])
        more = pa.array([t for _, t in extra], pa.large_string())
        _, _, d, o = next(texts.blocks(more, 1 << 62))
        again, at = _spelled(d, o)
        found = np.concatenate([found[0], again], axis=1), np.concatenate([found[1], own[at]])
    return found


def _spelled(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = texts.LOWER[data]
    spaced = np.where(deobfuscate.CLASS[data] > 0, data, np.uint8(32)).astype(np.uint8)
    start, end, row = texts.words(spaced, offsets)
    run = texts.prefix_hash(data)
    out = np.empty((1 + len(PREFIXES), len(start)), np.uint64)
    out[0] = texts.span_hash(run, start, end)
    for i, n in enumerate(PREFIXES, 1):
        long = end - start > n
        out[i] = texts.mix(texts.span_hash(run, start, np.minimum(start + n, end)) + np.uint64(i))
        out[i][~long] = out[0][~long]
    return out, row


def apart(sample: DataFrame) -> DataFrame:
    """One text of each class among near copies (``text, toxic``), so that a much copied text is one piece of evidence.

    Near copies are joined by links of a five-word shingle similarity of at least 0.8, confirmed on full sets.
    """
    rows = materialize(
        sample.select("text", "toxic").withColumn("doc_id", F.monotonically_increasing_id()), "toxicity-texts")
    kept = [
        near_duplicates(rows.filter(F.col("toxic") == y), width=5).filter("kept").select("doc_id") for y in (0, 1)]
    return rows.join(kept[0].unionByName(kept[1]), "doc_id", "left_semi").select("text", "toxic")


def _count_features(shared):
    """Texts of each class that hold a feature."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = deobfuscate.Restorer(shared.value)
        tally = texts.Tally(2)

        def flush() -> pa.RecordBatch:
            keys, sums = tally.take()
            return pa.record_batch({
                "feature": pa.array(keys.view(np.int64)), "toxic": pa.array(sums[0]), "clean": pa.array(sums[1])})

        for batch in batches:
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
            for first, end, data, offsets in texts.blocks(batch.column("text")):
                found, row = features(data, offsets, restorer)
                pair = np.empty(found.size, [("row", np.int64), ("f", np.uint64)])
                pair["row"], pair["f"] = np.tile(row, len(found)), found.ravel()
                pair = np.unique(pair)
                y = toxic[first:end][pair["row"]]
                tally.add(pair["f"], (y == 1).astype(float), (y == 0).astype(float))
                if tally.full():
                    yield flush()
        yield flush()

    return run


@dataclass
class Model:
    characters: np.ndarray
    prior: float
    features: np.ndarray
    weights: np.ndarray


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from ``labels`` (doc_id, toxic); the character model learns from all texts of ``docs``.

    The classifier learns from at most ``SAMPLE_PER_CLASS`` labelled texts per class, near copies counted once; the
    prior scales their numbers to all labels. A feature counts if it is far likelier in toxic texts than chance allows,
    and adds its log-odds.
    """
    spark = docs.sparkSession
    texts_only = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"))
    characters = deobfuscate.character_model(texts_only.filter("text is not null"))
    clean_labels = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    order = F.xxhash64("doc_id"), F.col("doc_id")
    parts = [clean_labels.filter(F.col("toxic") == y).orderBy(*order).limit(SAMPLE_PER_CLASS) for y in (0, 1)]
    sample = F.broadcast(parts[0].unionByName(parts[1]))  # at most 2 * SAMPLE_PER_CLASS rows of two numbers
    chosen = materialize(apart(
        texts_only.join(sample, "doc_id").filter("text is not null")
        .groupBy(F.sha2("text", 256)).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
    ), "toxicity-sample")
    sizes = {r.toxic: r.n for r in clean_labels.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    learned = {r.toxic: r.n for r in chosen.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = (learned.get(y, 0) for y in (1, 0))
    none = np.zeros(0)
    if not n_toxic or not n_clean:
        only_toxic = sizes.get(1, 0) and not sizes.get(0, 0)
        return Model(characters, 20.0 if only_toxic else -20.0, none.astype(np.uint64), none)
    labelled = lambda y, n: n * max(1.0, sizes[y] / SAMPLE_PER_CLASS)
    prior = math.log(labelled(1, n_toxic) / labelled(0, n_clean))
    counted = chosen.select("text", "toxic").mapInArrow(
        _count_features(spark.sparkContext.broadcast(characters)), "feature long, toxic long, clean long"
    ).groupBy("feature").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    q = n_toxic / (n_toxic + n_clean)
    both = F.col("t") + F.col("c")
    evidence = F.col("t") * F.log(F.col("t") / (both * q)) + F.when(
        F.col("c") > 0, F.col("c") * F.log(F.col("c") / (both * (1 - q)))).otherwise(0.0)
    weight = F.log((F.col("t") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("c") + 1.0) / (n_clean + 2.0))
    kept = counted.filter("t > 0").select("feature", evidence.alias("e"), weight.alias("w")).filter(
        (F.col("e") >= LEAST_EVIDENCE) & (F.col("w") + prior >= math.log(LEAST_PRECISION / (1 - LEAST_PRECISION)))
    ).toArrow()
    keys = kept.column("feature").to_numpy().view(np.uint64)
    at = np.argsort(keys)
    return Model(characters, prior, keys[at], kept.column("w").to_numpy()[at])


def _score(shared, names: list[str]):
    """The given columns, and the score of each row's text."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        restorer = deobfuscate.Restorer(model.characters)
        for batch in batches:
            odds = np.full(batch.num_rows, model.prior)
            for first, end, data, offsets in texts.blocks(batch.column("_scored_text")):
                if not len(model.features):
                    break
                found, row = features(data, offsets, restorer)
                at, known = texts.find(model.features, found.ravel())
                weight = np.where(known, model.weights[at], 0.0).reshape(found.shape).max(0)
                hit = np.flatnonzero(weight)
                pair = np.empty(len(hit), [("row", np.int64), ("f", np.uint64)])  # a word counts once per text
                pair["row"], pair["f"] = row[hit], found[0][hit]
                _, once = np.unique(pair, return_index=True)
                odds[first:end] += np.bincount(row[hit[once]], weight[hit[once]], end - first)
            score = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(score)], [*names, "_toxicity"])

    return run


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with the column ``_toxicity`` added, in one pass without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.characters, model.prior, model.features, model.weights))
    schema = T.StructType([*docs.schema.fields, T.StructField("_toxicity", T.DoubleType())])
    return docs.withColumn("_scored_text", F.col(text_col).cast("string")).mapInArrow(
        _score(shared, docs.columns), schema)


def toxicity(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text"
             ) -> DataFrame:
    """Score every row's text as the labels mark toxicity, learning only from labels that are not held out.

    Returns one row per input row: ``doc_id, held_out, score, predicted``. ``held_out`` is a condition on
    ``doc_id``; a null id is not held out. Null and empty texts get the prior of the labels. Without labels of both
    classes every text gets a score near 0 (or 1, if all labels are toxic). Repeated rows score alike; null labels
    and labels of unknown documents are ignored, as are other columns.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    held = F.coalesce(held_out, F.lit(False))
    model = train(rows.filter(~held), labels.filter(~held))
    return scored(rows, model).select(
        "doc_id", held.alias("held_out"), F.col("_toxicity").alias("score"),
        (F.col("_toxicity") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    model = train(docs, labels)
    return scored(docs, model).filter("_toxicity < 0.5").drop("_toxicity")
