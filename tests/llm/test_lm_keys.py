"""How n-grams are sent between blocks and shards, and the least count that the model learns from."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from skygrain.llm import elias, lm

NUMBERS = st.integers(0, 2**63 - 1)


@settings(max_examples=80, deadline=None)
@given(st.lists(NUMBERS, max_size=40))
def test_packed_numbers_come_back(values):
    assert lm._unpack(lm._pack(np.array(values, np.uint64))).tolist() == values


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**64 - 1), NUMBERS), min_size=1, max_size=40))
def test_packed_keys_come_back_in_any_order_of_the_first_column(rows):
    columns = [np.array(c, np.uint64) for c in zip(*rows)]
    back = lm._unpack_keys(lm._pack_keys(columns))
    assert [c.tolist() for c in back] == [c.tolist() for c in columns]


def test_hash_tells_order_length_and_place_apart():
    grams = [(a, b) for a in range(60) for b in range(60)]
    assert len(set(lm._hash([np.array(c, np.uint64) for c in zip(*grams)]).tolist())) == len(grams)


@pytest.mark.parametrize("least", [1, 2, 5])
def test_words_below_the_least_count_belong_to_the_class_of_others(spark, least):
    rows = [(i, "seen seen often") for i in range(least)] + [(100, "often seen"), (101, "never said"), (102, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in lm.score_texts(docs, F.col("doc_id") >= 100, least=least).collect()}
    assert len(got) == len(rows) and got[0].train_tokens == 4 * least
    assert (got[100].n_known, got[101].n_known, got[102].n_known) == (3, 1, 1)
    assert got[101].score < got[100].score < 0
    unlearned = {r.doc_id: r for r in lm.score_texts(docs, F.col("doc_id") >= 100, least=2 * least + 1).collect()}
    assert got[0].score > unlearned[0].score
    assert [got[i].base_score for i in got] == [unlearned[i].base_score for i in got]


def test_each_different_ngram_is_looked_up_once_and_scores_stay(monkeypatch):
    """Every token searched the trie, however often its n-gram had been searched before."""
    rng = np.random.default_rng(2)
    size, words = 6, rng.integers(0, 5, 400)  # five words, the last the class of the others; the start is id 5
    row = np.repeat(np.arange(40), 10)
    before = lm._before(words, row, 5)
    fresh = np.arange(400) % 10 == 0
    pairs, pair_of, n = np.unique(before * size + words, return_inverse=True, return_counts=True)
    kept = n >= 13
    later = 1 + np.flatnonzero(kept[pair_of][1:] & kept[pair_of][:-1] & ~fresh[1:])
    place = np.cumsum(kept) - 1
    triples, triple_of, triple_n = np.unique(
        place[pair_of[later - 1]] * size + words[later], return_inverse=True, return_counts=True)
    known = triple_n >= 3
    assert 0 < kept.sum() < len(kept) and 0 < known.sum() < len(known)
    counts = np.bincount(words, minlength=5).astype(float)
    trie = lm.Trie(lm.build_trie(counts, 40.0, pairs[kept], n[kept].astype(float), triples[known], triple_n[known].astype(float)), size)
    one_by_one = trie.score(words, before, fresh)
    asked, find = [], elias.EliasFano.find

    def counted(self, x):
        asked.append(len(x))
        return find(self, x)

    monkeypatch.setattr(elias.EliasFano, "find", counted)
    assert (trie.score(words, before, fresh, pair_of, triple_of) == one_by_one).all()
    assert asked == [len(pairs), len(triples)]
