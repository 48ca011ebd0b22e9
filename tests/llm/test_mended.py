"""Cases that earlier rounds got wrong: texts without tokens, long texts, many matches, extreme vectors, tightest bins."""

import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skygrain.llm import mixing, packing, secrets, vectors
from skygrain.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _drawn(spark, rows, mixture):
    """The rows drawn, leaf by leaf: whole epochs, then the longest prefix by key that stays within the budget."""
    n = {r[0]: len(WORD.findall(r[1] or "")) for r in rows}
    leaves = {}
    for r in rows:
        leaves.setdefault((_domain(spark, r[3]), r[2] or "", r[3] or ""), []).append(r)
    have = {k: sum(n[r[0]] for r in v) for k, v in leaves.items()}
    budgets = mixing.allot(mixture.share * sum(have.values()), {k: v * mixture.max_epochs for k, v in have.items()}, mixture)
    out = []
    for k, members in leaves.items():
        whole = min(mixture.max_epochs, int(budgets[k] // have[k])) if have[k] else 0
        left = int(budgets[k] - whole * have[k])
        df = spark.createDataFrame([(r[0], r[1] or "") for r in members], "i long, t string")
        key = F.shiftrightunsigned(F.xxhash64(F.lit(mixture.seed), F.lit(whole), F.col("i"), F.col("t")), 4)
        keys = {r.i: r.k for r in df.select("i", key.alias("k")).collect()}
        taken = set()
        for r in sorted((r for r in members if n[r[0]]), key=lambda r: keys[r[0]]):
            if whole >= mixture.max_epochs or n[r[0]] > left:
                break
            left -= n[r[0]]
            taken.add(r[0])
        for r in members:
            out += [(r[0], e) for e in range(whole + (r[0] in taken) if n[r[0]] else 1)]
    return sorted(out)


_domains: dict = {}


def _domain(spark, source):
    if source not in _domains:
        _domains[source] = spark.createDataFrame([(source,)], "source string").select(
            F.coalesce(mixing.default_domain(F.col("source")), F.lit(""))).first()[0]
    return _domains[source]


@pytest.mark.parametrize("share,epochs", [(0.5, 1), (0.9, 2), (3.0, 2), (0.0, 1)])
def test_mixture_draws_the_rows_that_a_plain_loop_draws(spark, share, epochs):
    rows = [(i, " ".join(["w"] * (i % 7 * 5)) if i % 11 else None, ["en", "fr", None][i % 3], f"s{i % 4}", "x") for i in range(90)]
    rows += [(200 + i, ["", None, " \t"][i % 3], "en", "only-empty", "x") for i in range(7)]
    mixture = mixing.Mixture(share=share, max_epochs=epochs)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, key string").repartition(3)
    got = sorted((r.doc_id, r.epoch) for r in mixing.draws(df, mixture).collect())
    assert got == _drawn(spark, rows, mixture)
    empty = {r[0] for r in rows if not WORD.findall(r[1] or "")}
    assert sorted(i for i, _ in got if i in empty) == sorted(empty)  # each once


def test_few_long_texts_spread_over_shards(spark):
    df = spark.range(20).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), 25_000).alias("text"), F.lit("s").alias("source"))
    got = packing.pack(df, capacity=4, cluster=F.lit(None).cast("string"))
    found = got.agg(F.count(F.lit(1)), F.count_distinct("shard"), F.sum("n_tokens")).first()
    assert found[0] == 125_000 and found[1] >= 6 and found[2] == 500_000


def test_each_piece_goes_to_the_tightest_compatible_bin():
    rng = np.random.default_rng(4)
    bins, plain, capacity = packing.Bins(40), [], 40
    for size in sorted(rng.integers(0, 40, 400).tolist(), reverse=True):
        source, cluster = int(rng.integers(-1, 5)), int(rng.integers(-1, 6))
        number, offset = bins.place(size, source, cluster)
        fitting = [i for i, (room, s, c) in enumerate(plain) if room >= size and source not in s - {-1} and cluster not in c - {-1}]
        if fitting:
            tightest = min(plain[i][0] for i in fitting)
            assert number in fitting and plain[number][0] == tightest
        else:
            assert number == len(plain)
            plain.append((capacity, set(), set()))
        room, s, c = plain[number]
        assert offset == capacity - room
        plain[number] = (room - size, s | {source}, c | {cluster})


def test_many_matches_in_one_text_are_placed_in_good_time(spark):
    piece = "é token=abcdef1 0123456789abcdef01234567 "
    text = piece * 32_000
    df = spark.createDataFrame([(1, text, "a", "en"), (2, piece * 255, "a", "en"), (3, piece * 257, "b", "en")],
                               "doc_id long, text string, source string, lang string")
    start = time.time()
    got = {r.doc_id: r for r in secrets.secret_digest(secrets.find_secrets(df)).collect()}
    assert time.time() - start < 60
    for ident, n in ((1, 32_000), (2, 255), (3, 257)):
        size = len(piece)
        spans = ",".join(f"assign:{i * size + 2}:{i * size + 15},hex:{i * size + 16}:{i * size + 40}" for i in range(n))
        assert got[ident].spans == spans and got[ident].n_assign == got[ident].n_hex == n


def test_repositories_count_in_the_verdict(spark):
    rows = [(i, "token=abc123XYZ", "one", f"r{i}") for i in range(4)] + [(9, "token=zzz999QQQ", "one", "r0"), (10, "none", "two", "r1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = {r.doc_id: r for r in secrets.secret_digest(secrets.find_secrets(df, repo=F.col("lang"))).collect()}
    assert got[0].n_copied == 1 and (got[0].max_owners, got[0].max_repos) == (1, 4)
    assert got[9].n_live == 1 and (got[9].max_owners, got[9].max_repos) == (1, 1) and got[10].max_repos is None


@pytest.mark.parametrize("scale", [1e200, 1e-200, 1e307, 5e-320])
def test_vectors_of_extreme_size_link_by_their_direction(spark, scale):
    rng = np.random.default_rng(1)
    base = rng.integers(-9, 9, size=(6, 16)).astype(float)
    rows = [(i, (base[i % 6] * scale / (1 + i // 6)).tolist(), "a") for i in range(12)]
    got = {r.vec_id: r for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()}
    x = [np.ldexp(np.array(v), -int(np.frexp(np.abs(v).max())[1])) for _, v, _ in rows]
    for i in range(12):
        want = sum(j != i and x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j]) >= 0.93 for j in range(12))
        assert got[i].n_links == want and want >= 1


def test_mixing_and_packing_queries_place_every_document(spark, sf):
    docs = {r.doc_id: len(WORD.findall(r.text or "")) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    packed = QUERIES["op9_best_fit_packing"](spark, sf).collect()
    total, bins = {}, {}
    for r in packed:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.n_tokens
        bins.setdefault((r.shard, r.bin), []).append((r.bin_offset, r.n_tokens))
    assert total == docs
    for held in bins.values():
        at = 0
        for offset, n in sorted(held):
            assert offset >= at
            at = offset + n
        assert at <= packing.CAPACITY


def near_copies(groups: int, each: int, noise: float) -> np.ndarray:
    rng = np.random.default_rng(3)
    x = np.repeat(rng.normal(size=(groups, 64)), each, axis=0)
    return x + noise * rng.normal(size=x.shape)


def test_a_pair_of_vectors_is_compared_once_however_many_buckets_it_shares(spark, monkeypatch):
    """Near copies share most of their buckets; each shared bucket cost a cosine."""
    x = near_copies(1, 40, 0.1)
    found = vectors.all_corners(vectors.levelled(x), 2)
    rows = [{"rep": i, "copies": 1, "label": 0, "width": 64, "t": s // 4, "code": int(c), "i": 0, "j": 0, "own": int(s % 4 == 0),
             "block": 0, "vector": x[i].tolist(), "corners": found[i].ravel().tolist()}
            for i, codes in enumerate(vectors.codes(found, 64)) for s, c in enumerate(codes)]
    rows.sort(key=lambda r: (r["t"], r["code"]))
    compared, cosines = [], vectors._cosines

    def counted(unit, a, b):
        compared.append(len(a))
        return cosines(unit, a, b)

    monkeypatch.setattr(vectors, "_cosines", counted)
    batch = pa.RecordBatch.from_pylist(rows, pa.schema([("corners", pa.list_(pa.int32())) if n == "corners" else (n, t) for n, t in (
        ("rep", pa.int64()), ("copies", pa.int64()), ("label", pa.int32()), ("width", pa.int32()), ("t", pa.int32()), ("code", pa.int64()),
        ("i", pa.int32()), ("j", pa.int32()), ("own", pa.int32()), ("block", pa.int32()), ("vector", pa.list_(pa.float64())), ("corners", None))]))
    out = [r for b in vectors._compare(0.93, 2)([batch]) for r in b.to_pylist()]
    assert sum(compared) <= 40 * 39 // 2
    assert sum(r["n"] for r in out) == 40 * 39


def test_vector_buckets_grow_in_number_with_the_table():
    """Their number was fixed, so unrelated vectors met the more often the more there were."""
    assert vectors.corners_for(1000, 64) == 2
    assert vectors.corners_for(100_000, 64) == 3
    x = np.random.default_rng(4).normal(size=(4000, 64))

    def sharing(k: int) -> int:
        codes = vectors.codes(vectors.all_corners(vectors.levelled(x), k), 64)
        n = np.unique(np.arange(codes.shape[1]) // 2**k * (1 << 40) + codes, return_counts=True)[1]
        return int((n * (n - 1)).sum())

    assert sharing(3) < sharing(2) / 5


@pytest.mark.parametrize("k", [2, 3, 4])
def test_vectors_equal_all_pairs_at_any_number_of_corners(spark, monkeypatch, k):
    monkeypatch.setattr(vectors, "corners_for", lambda rows, width: k)
    monkeypatch.setattr(vectors, "BLOCK", 20)
    x = np.concatenate([near_copies(3, 50, 0.1), near_copies(30, 2, 0.15)])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.93
    table = spark.createDataFrame([(i, v.tolist(), "a") for i, v in enumerate(x)], "vec_id long, embedding array<double>, label string")
    got = {r.vec_id: r for r in vectors.near_vectors(table).collect()}
    assert [got[i].n_links for i in range(len(x))] == (close.sum(1) - 1).tolist()
    reach = np.linalg.matrix_power(close.astype(float), 8) > 0
    assert [got[i].component_id for i in range(len(x))] == reach.argmax(1).tolist()
