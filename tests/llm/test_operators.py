"""The operators against brute force on small fixtures, with nulls, empty and long texts, ties and clashing columns."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skygrain.llm import chat, deobfuscate, elias, exact, langid, lm, minhash, mixing, packing, secrets, toxicity, vectors
from skygrain.llm.texts import remainder

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, component string"
LONG = " ".join(f"w{i % 700}x{i % 31}" for i in range(30_000))


def frame(spark, rows):
    return spark.createDataFrame([(*r, *[None] * (7 - len(r))) for r in rows], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    words = "the cat sat on a warm mat and saw one old dog run far away from home to find its bone".split()
    near = words[:-1] + ["stick"]
    return frame(spark, [
        (1, " ".join(words), "en", "a"), (2, " ".join(words), "en", "b"), (3, " ".join(near), "en", "a"),
        (4, "le chat est sur la table et le chien", "fr", "b"), (5, None, "fr", None), (6, "", None, "a"),
        (7, "der hund und die katze", "de", "c"), (8, LONG, None, "a"), (9, LONG + " tail", None, "a"),
        (10, " ".join(words).upper(), "en", "c"), (None, "le chat", "fr", "b"), (11, "123 ...", "de", "a"),
        (12, "le chat", "fr", "b"), (12, "le chat", "fr", "b"),
    ])


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


@pytest.mark.parametrize("digest", [exact.sha256, lambda t: F.unhex(F.hex(F.length(t) % 3))])
def test_exact_dedup_equals_grouping_by_text_even_when_digests_collide(docs, digest):
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    want = []
    for i, t in texts:
        ids = [j for j, u in texts if u == t]
        keep = max((j for j in ids if j is not None), default=None)
        want.append((i, keep, len(ids), i == keep))
    got = rows_of(exact.exact_dedup(docs, digest=digest, salts=3), "doc_id", "keep_id", "group_size", "kept")
    assert got == sorted(want, key=repr)
    left = exact.drop_copies(docs, digest=digest)
    assert left.columns == docs.columns
    assert left.count() == len({t for _, t in texts})


def shingle_set(text, width):
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(*[words[i:] for i in range(width)]))


@pytest.mark.parametrize("small", [4096, 1])
def test_near_duplicates_equal_all_pairs(docs, small, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL_GROUP", small)
    monkeypatch.setattr(minhash, "BLOCK_MEMBERS", 2)
    monkeypatch.setattr(minhash, "FIRST_PIVOTS", 1)
    known = docs.filter("doc_id is not null")
    sets = {r.doc_id: shingle_set(r.text, 2) for r in known.collect()}
    parent = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            for j in sets:
                if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    parent[i] = parent[j] = min(parent[i], parent[j])
    got = rows_of(minhash.near_duplicates(docs, width=2), "doc_id", "n_shingles", "component_id", "kept")
    want = [(r.doc_id, len(sets[r.doc_id]), parent[r.doc_id], parent[r.doc_id] == r.doc_id) for r in known.collect()]
    assert got == sorted([*want, (None, 1, None, True)], key=repr)


def test_language_words_first_then_shorter_grams(spark, docs):
    got = {r.doc_id: r for r in langid.identify(docs, F.lit(False)).collect()}
    assert got[4].lang_pred == "fr" and got[7].lang_pred == "de" and got[1].lang_pred == "en"
    assert [got[i].lang_pred for i in (5, 6, 11)] == ["und"] * 3 and got[5].score == 0.0
    assert all(0 <= r.score <= 1 for r in got.values())
    model = langid.train(docs)
    unseen = model.unseen(["chatte", "qqqq"])
    assert model.langs[unseen[0].argmax()] == "fr"
    assert {r.lang_pred for r in langid.identify(docs, F.lit(True)).collect()} == {"und"}


def test_elias_fano_gives_back_and_finds_values():
    rng = np.random.default_rng(3)
    for universe, n in ((50, 50), (1000, 10), (10**12, 3000), (5, 0)):
        values = np.unique(rng.integers(0, universe, n)) if n else np.zeros(0, np.int64)
        seq = elias.EliasFano(elias.encode(values, universe))
        assert (seq.get(np.arange(len(values))) == values).all()
        asked = rng.integers(0, universe, 500)
        at, found = seq.find(asked)
        assert (found == np.isin(asked, values)).all()
        assert not n or (at == np.searchsorted(values, asked)).all()


def test_lm_base_scores_and_distribution(docs):
    got = {r.doc_id: r for r in lm.score_texts(docs.filter("doc_id < 12"), remainder("doc_id", 7) == 2).collect()}
    texts = {r.doc_id: (r.text or "").encode().lower().split() + [None] for r in docs.filter("doc_id < 12").collect()}
    counts = {}
    for i, words in texts.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            for w in words:
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for i, words in texts.items():
        base = sum(math.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in words)
        assert math.isclose(got[i].base_score, base, rel_tol=1e-9) and got[i].train_tokens == n
        assert (got[i].n_tokens, got[i].n_known) == (len(words), sum(w in counts for w in words))
        assert got[i].score < 0


def test_trie_probabilities_sum_to_one():
    counts = np.array([5, 4, 3, 2])  # three words, then the class of the others; the start is id 4
    pairs, pair_n = np.array([0 * 5 + 1, 1 * 5 + 0, 4 * 5 + 0]), np.array([3.0, 2.0, 2.0])
    triples, triple_n = np.array([0 * 5 + 0, 2 * 5 + 1]), np.array([2.0, 2.0])
    trie = lm.Trie(elias.mapped(*elias.to_bytes(lm.build_trie(counts, 2.0, pairs, pair_n, triples, triple_n))), 5)
    for before in range(5):
        w = np.arange(4)
        p = 10 ** trie.score(w, np.full(4, before), np.ones(4, bool))
        assert math.isclose(p.sum(), 1, rel_tol=1e-3)


def test_secret_spans_ownership_and_edges(spark):
    text = 'x Api_Key: "abc123XYZ" AKIA' + "A1" * 9 + " " + "0f" * 13 + " token=abc é secret = changeme99"
    docs = frame(spark, [(1, text, "en", "a"), (2, "token=shared12", "en", "a"), (3, "token=shared12", "en", "b"),
                         (4, "token=shared12", "en", None), (5, None), (6, ""), (7, LONG)])
    got = {r.doc_id: r for r in secrets.secret_digest(secrets.find_secrets(docs)).collect()}
    assert (got[1].n_assign, got[1].n_access, got[1].n_hex, got[1].n_live) == (2, 1, 1, 3)
    kind, start, end = got[1].spans.split(",")[0].split(":")
    assert (kind, text[int(start) : int(end)]) == ("assign", 'Api_Key: "abc123XYZ')
    assert got[2].n_copied == got[4].n_copied == 1 and got[5].spans == got[6].spans == got[7].spans == ""


def test_restoring_disguises():
    table = np.full((32**3, 32), -3.0, np.float32)
    word = [0, 0, 0] + [ord(c) - 96 for c in "idiot"] + [0]
    for a, b, c, d in zip(word, word[1:], word[2:], word[3:]):
        table[(a * 32 + b) * 32 + c, d] = -0.1
    for token in ("1d10t", "id!ot", "iiidiot", "i.d.i.o.t", "idiot"):
        assert deobfuscate.restore(token, table) == "idiot"
    assert deobfuscate.restore("idiot", table, spaced=True) == "idiot"


def test_toxicity_learns_and_survives_empty_input(spark):
    rows = [(i, f"calm words number {i} here" + (" vile" if i % 4 == 0 else "")) for i in range(1, 200)]
    docs = frame(spark, [*rows, (500, None), (501, ""), (502, "so v1le"), (503, "v i l e"), (504, "fine words")])
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i, _ in rows] + [(None, 1, 1), (1, 1, None)],
                                   "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels, remainder("doc_id", 5) == 0).collect()}
    assert all(got[i].predicted == int(i % 4 == 0) for i, _ in rows)
    assert (got[502].predicted, got[503].predicted, got[504].predicted, got[500].predicted) == (1, 1, 0, 0)
    left = toxicity.drop_toxic(docs, labels)
    assert left.columns == docs.columns and left.filter("doc_id in (502, 504, 500)").count() == 2
    assert toxicity.toxicity(docs, labels.limit(0), F.lit(False)).filter("predicted = 1").count() == 0


def test_mixture_budgets_and_prefixes(docs):
    room = {("x", "en", "a"): 10.0, ("x", "en", "b"): 100.0, ("y", "fr", "c"): 100.0}
    got = mixing.allot(100, room, mixing.Mixture())
    assert got == {("x", "en", "a"): 10, ("x", "en", "b"): 40, ("y", "fr", "c"): 50}  # the sibling takes the shortage
    mixture = mixing.Mixture(share=0.7, max_epochs=2)
    one, two = (mixing.draws(docs, mixture).collect() for _ in range(2))
    assert sorted(map(repr, one)) == sorted(map(repr, two))
    have = {}
    for r in mixing.draws(docs, mixing.Mixture(share=1.0, max_epochs=1)).collect():
        k = (r.domain, r.lang, r.source)
        have[k] = have.get(k, 0) + r.n_tokens
    budgets = mixing.allot(0.7 * sum(have.values()), {k: 2 * v for k, v in have.items()}, mixture)
    used = {}
    for r in one:
        k = (r.domain, r.lang, r.source)
        used[k] = used.get(k, 0) + r.n_tokens
    assert all(v <= budgets[k] + 1e-6 for k, v in used.items())
    assert mixing.mix(docs, mixture).columns == docs.columns


def test_packing_places_everything_without_conflicts(docs):
    got = packing.pack(docs, capacity=64, shard_rows=5).collect()
    tokens = {r.doc_id: len((r.text or "").split()) for r in docs.collect()}
    placed = {}
    for r in got:
        placed[r.doc_id] = placed.get(r.doc_id, 0) + r.n_tokens
    assert placed[8] == tokens[8] and placed[1] == tokens[1] and placed[5] == 0
    spans, sources = {}, {}
    source = {r.doc_id: r.source for r in docs.collect()}
    for r in got:
        spans.setdefault((r.shard, r.bin), []).append((r.bin_offset, r.bin_offset + r.n_tokens))
        sources.setdefault((r.shard, r.bin), []).append(source[r.doc_id])
    for s in spans.values():
        s.sort()
        assert s[-1][1] <= 64 and all(a[1] <= b[0] for a, b in zip(s, s[1:]))
    assert all(len([x for x in v if x]) == len({x for x in v if x}) for v in sources.values())


def brute_cost(roles):
    cost = {0: 0.0}
    for role in roles:
        after = {}
        for before, c in cost.items():
            for state, given, price, *_ in chat.MOVES[before]:
                own = 0 if role == chat.STATES[given] else 2 if role in chat.STATES[1:] else 1
                after[state] = min(after.get(state, 1e9), c + price + own)
        cost = after
    return min(cost.values())


def test_chat_repair_is_legal_and_cheapest_over_any_ranges(spark, monkeypatch):
    talk = {1: ["user", "user", "assistant"], 2: ["assistant", "system", "user"], 3: [None, "bot", "USER"], None: ["user"],
            4: ["user", "assistant"] * 40 + ["assistant", "assistant", "system"]}
    rows = [(c, i, r, f"t{i}" if i else None, "x") for c, roles in talk.items() for i, r in enumerate(roles)]
    got = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, piece string"))
    found = {}
    for r in got.collect():
        found.setdefault(r.conv_id, []).append(r)
    for c, roles in talk.items():
        mine = sorted(found[c], key=lambda r: r.position)
        assert [r.position for r in mine] == list(range(len(roles)))
        assert sum(r.cost for r in mine) == brute_cost([x.lower() if x else x for x in roles])
        said = [x.split("|>")[0] for x in "".join(r.piece for r in mine).split("<|") if not x.startswith("end")][1:]
        assert all(b in [chat.STATES[s] for s in chat.NEXT[chat.STATES.index(a)]] for a, b in zip(["start", *said], said))
    assert chat.format_chats(got.limit(0).withColumn("text", F.lit("x"))).count() == 0


def test_vectors_equal_all_pairs(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 24))
    rows = []
    for i in range(240):
        v = centres[i % 12] + rng.normal(size=24) * (0.25 if i % 3 else 0.0)
        rows.append((i, [float(x) for x in v], int(i % 12 < 6), "x"))
    rows += [(300, None, 1, "x"), (301, [0.0] * 24, 1, "x"), (302, [float("nan")] * 24, 1, "x"), (303, [1.0] * 24, None, "x"),
             (304, [], 1, "x"), (305, [1.0, None], 1, "x"), (None, [1.0] * 24, 1, "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, rep string")
    got = {r.vec_id: r for r in vectors.near_vectors(table).collect()}
    x = np.array([r[1] for r in rows[:240]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows[:240]])
    links = (x @ x.T >= 0.93) & (label[:, None] == label)
    np.fill_diagonal(links, False)
    found = sum(got[i].n_links for i in range(240))
    assert links.sum() * 0.99 <= found <= links.sum()
    assert all(got[i].n_links == 0 and got[i].kept for i in range(300, 306))


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    assert exact.exact_dedup(none).count() == 0
    assert minhash.near_duplicates(none).count() == 0
    assert langid.identify(none, F.lit(False)).count() == 0
    assert lm.score_texts(none, F.lit(False)).count() == 0
    assert secrets.find_secrets(none).count() == 0
    assert mixing.draws(none).count() == 0
    assert packing.pack(none).count() == 0
    vectors_none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.near_vectors(vectors_none).count() == 0


def test_a_much_copied_toxic_text_is_one_piece_of_evidence(spark):
    words = [f"plain{i % 37} word{i % 11} here{i}" for i in range(1, 100)]
    rows = [(i, f"{w} and more of it" + (" vile" if i % 3 == 0 else "")) for i, w in enumerate(words, 1)]
    body = " ".join(f"body{j}" for j in range(200))
    rows += [(1000 + i, f"{body} oddity tail{i} vile") for i in range(60)]
    docs = frame(spark, [*rows, (3000, "an oddity of nature"), (3001, "so vile")])
    labels = spark.createDataFrame([(i, int("vile" in t)) for i, t in rows], "doc_id long, toxic int")
    assert toxicity.apart(spark.createDataFrame([(t, 1) for _, t in rows], "text string, toxic int")).count() < 110
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels, F.lit(False)).collect()}
    assert (got[3000].predicted, got[3001].predicted) == (0, 1)


def brute_scores(docs, least=2, d=0.75):
    """log10 scores by interpolated absolute discounting over words, bigrams and trigrams of the training texts."""
    learn = [t for t, held in docs if not held]
    c = {}
    for t in learn:
        for w in t:
            c[w] = c.get(w, 0) + 1
    total = sum(c.values())
    inside = {w: n for w, n in c.items() if n >= least}
    rare, once = total - sum(inside.values()), sum(n == 1 for n in c.values())
    new = (min(once, rare) + 0.5) / (rare + 1)
    grams = {2: {}, 3: {}}
    form = lambda t: ["<s>"] + [w if w in inside else "?" for w in t]
    for t in learn:
        w = form(t)
        for size, g in grams.items():
            for i in range(len(w) - size + 1):
                k = tuple(w[i : i + size])
                g[k] = g.get(k, 0) + 1
    counts = {("?",): rare, ("<s>",): len(learn), **{(w,): n for w, n in inside.items()}}
    counts |= {k: n for g in grams.values() for k, n in g.items() if n >= least}
    used = {}
    for k, n in counts.items():
        used[k[:-1]] = used.get(k[:-1], 0) + (n - d if len(k) > 1 else 0)

    def p(gram):
        if len(gram) == 1:
            return (counts[gram] + 0.5) / (total + 0.5 * (len(inside) + 1))
        shorter, context = p(gram[1:]), gram[:-1]
        if context not in counts:
            return shorter
        back = max(1 - used.get(context, 0) / max(counts[context], 1), 1e-9)
        return max(counts.get(gram, 0) - d, 0) / max(counts[context], 1) + back * shorter

    out = []
    for t, _ in docs:
        w, s = form(t), 0.0
        for i in range(1, len(w)):
            s += math.log10(p(tuple(w[max(0, i - 2) : i + 1])))
            if w[i] == "?":
                s += math.log10((1 - new) / rare if t[i - 1] in c else new)
        out.append(s)
    return out


def test_lm_keeps_rare_ngrams_of_a_large_corpus(spark, monkeypatch):
    filler = " ".join(f"f{i % 97}" for i in range(20_000))
    rows = [(i, filler) for i in range(30)]  # 600,000 tokens: a share of 1e-5 of them is 6
    rows += [(100 + i, "zirkon blau leuchtet hell once%d" % i) for i in range(3)]
    rows += [(200, "zirkon blau leuchtet hell"), (201, "hell leuchtet unseen blau"), (202, ""), (203, "zirkon f1 f2 once1")]
    docs = frame(spark, rows)
    monkeypatch.setattr(lm, "BLOCK_BYTES", 300_000, raising=False)
    got = {r.doc_id: r for r in lm.score_texts(docs, F.col("doc_id") >= 200).collect()}
    want = brute_scores([(t.split() + [None], i >= 200) for i, t in rows])
    for (i, t), s in zip(rows, want):
        assert abs(got[i].score - s) <= 0.04 * got[i].n_tokens, (i, got[i].score, s)


def test_only_confirmed_near_copies_are_merged(spark):
    shared = " ".join(f"licence{j}" for j in range(60))
    rows = [(f"{shared} " + " ".join(f"own{i}x{j}" for j in range(60)), i % 2) for i in range(80)]  # similarity about 1/3
    copies = [(f"{' '.join(f'body{j}' for j in range(200))} tail{i}", 1) for i in range(20)]
    left = [r.text for r in toxicity.apart(spark.createDataFrame(rows + copies, "text string, toxic int")).collect()]
    assert sorted(t for t in left if t.startswith("licence")) == sorted(t for t, _ in rows)
    assert sum(t.startswith("body") for t in left) == 1


@pytest.mark.parametrize("text, word", [
    ("you a55 there", "ass"), ("you a$$ there", "ass"), ("you @$$ there", "ass"), ("so 5h17, no", "shit"),
    ("an 1d107 here", "idiot"), ("so v i l e. Yes", "vile"), ('so "v i l e" yes', "vile"), ("so \u201cv i l e\u201d yes", "vile"),
    ("a st.up.id one", "stupid"), ("a st.upid one", "stupid"), ("so n4\u00efve1y", "na\u00efvely"),
])
def test_gate_lets_every_disguise_through(text, word):
    table = np.full((32**3, 32), -3.0, np.float32)
    for w in ("ass", "shit", "idiot", "vile", "stupid", "na\u00efvely"):
        line = [0, 0, 0] + [int(deobfuscate.CLASS[b]) for b in w.encode()] + [0]
        for a, b, c, d in zip(line, line[1:], line[2:], line[3:]):
            table[(a * 32 + b) * 32 + c, d] = -0.1
    data = np.frombuffer(text.encode(), np.uint8)
    found = deobfuscate.Restorer(table).extras(data, np.array([0, len(data)]))
    assert word in [w for _, t in found for w in t.split()]
