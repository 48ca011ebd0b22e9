"""What a task holds at once does not grow with the batch that Spark hands it."""

import tracemalloc

import numpy as np
import pyarrow as pa

from skygrain.llm import deobfuscate, links, minhash, texts, toxicity
from skygrain.plans import durable


class _Shared:
    value = (np.full((deobfuscate.SYMBOLS**3, deobfuscate.SYMBOLS), -1.0, np.float32), -2.0,
             np.arange(1, 100, dtype=np.uint64), np.ones(99))


def test_scoring_a_large_batch_holds_little_at_once():
    rng = np.random.default_rng(1)
    words = np.array(["river", "stone", "walk", "evening", "of", "the", "light"])
    column = pa.array([" ".join(rng.choice(words, 4_000)) for _ in range(200)])
    batch = pa.record_batch([column], ["_scored_text"])
    texts.powers(texts.BLOCK_BYTES + 1)
    tracemalloc.start()
    rows = sum(b.num_rows for b in toxicity._score(_Shared, [])([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 200
    assert peak < 60e6, peak


def chain_of_texts(spark, n, step=2):
    """``n`` texts of 44 words, each of them moved on by ``step`` words: neighbours are near copies, far ones are not."""
    rows = [(i, " ".join(f"w{j}" for j in range(step * i, step * i + 44))) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def watched(monkeypatch):
    """(label, executed plan) of every table that near dedup writes."""
    seen = []

    def noted(df, label, free=False):
        out = durable.materialize(df, label, free)
        seen.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return out

    for module in (links, minhash):
        monkeypatch.setattr(module, "materialize", noted)
    return seen


def test_near_dedup_broadcasts_no_table_that_grows_with_the_documents(spark, monkeypatch):
    seen = watched(monkeypatch)
    found = minhash.near_duplicates(chain_of_texts(spark, 12))
    assert {r["component_id"] for r in found.collect()} == {0}
    seen.append(("result", found._jdf.queryExecution().executedPlan().toString()))
    assert len(seen) > 5
    assert [label for label, plan in seen if "Broadcast" in plan] == []


def test_the_plans_of_pivot_rounds_do_not_grow_from_round_to_round(spark, monkeypatch):
    """The driver keeps the plans of past queries, so plans that gather up all earlier rounds fill its memory."""
    for name, value in (("SMALL_GROUP", 1), ("FIRST_PIVOTS", 1), ("MOST_PIVOTS", 1), ("BLOCK_MEMBERS", 8)):
        monkeypatch.setattr(minhash, name, value)
    seen = watched(monkeypatch)
    found = minhash.near_duplicates(chain_of_texts(spark, 8)).collect()
    assert {r["component_id"] for r in found} == {0}
    sizes = {}
    for label, plan in seen:
        sizes.setdefault(label, []).append(plan.count("Scan parquet"))
    rounds = sizes["unsettled"]
    assert len(rounds) > 3 and rounds[-1] <= rounds[1] and sizes["edges"][-1] <= sizes["edges"][2], sizes
