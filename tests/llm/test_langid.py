"""Language identification against a plain version: counts in dictionaries, n-grams as strings."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from skygrain.llm import langid
from skygrain.llm.queries import QUERIES
from skygrain.llm.texts import remainder


def plain(rows, held):
    """{position: (language, score)} of rows (id, text, lang)."""
    words, grams = defaultdict(Counter), {o: defaultdict(Counter) for o in langid.ORDERS}
    totals = Counter()
    for i, text, lang in rows:
        if text is not None and lang is not None:
            totals[lang] += 0
            if not held(i):
                for w in langid.letter_words(text):
                    words[w][lang] += 1
                    totals[lang] += 1
    langs = sorted({lang for i, text, lang in rows if text is not None and lang is not None and not held(i)})
    for w, by in words.items():
        for o in langid.ORDERS:
            padded = f" {w} "
            for at in range(len(padded) - o + 1):
                for lang, n in by.items():
                    grams[o][padded[at : at + o]][lang] += n
    known = {w: c for w, c in words.items() if c.total() >= langid.LEAST}
    grams = {o: {g: c for g, c in t.items() if c.total() >= langid.LEAST} for o, t in grams.items()}
    sums = {o: {lang: sum(c[lang] for c in t.values()) for lang in langs} for o, t in grams.items()}
    added = langid.ADDED

    def word_score(w, lang):
        if w in known:
            return math.log((known[w][lang] + added) / (totals[lang] + added * max(len(known), 1)))
        padded = f" {w} "
        for o in langid.ORDERS:
            found = [grams[o][g] for at in range(len(padded) - o + 1) if (g := padded[at : at + o]) in grams[o]]
            if found:
                below = sums[o][lang] + added * max(len(grams[o]), 1)
                return sum(math.log((c[lang] + added) / below) for c in found) / len(found)
        return 0.0

    out, memo = {}, {}
    whole = sum(totals[lang] + 1 for lang in langs)
    for at, (_, text, _) in enumerate(rows):
        said = langid.letter_words(text or "")
        if not said or not langs:
            out[at] = ("und", 0.0)
            continue
        scores = []
        for lang in langs:
            for w in said:
                if (w, lang) not in memo:
                    memo[w, lang] = word_score(w, lang)
            scores.append(math.log((totals[lang] + 1) / whole) + sum(memo[w, lang] for w in said))
        best = max(range(len(langs)), key=lambda k: scores[k])
        out[at] = (langs[best], 1 / sum(math.exp(s - scores[best]) for s in scores))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    letters = {"aa": "abcdefg", "bb": "defghij", "cc": "klmnop", "dd": "абвгд"}
    words = {lang: ["".join(rng.choices(s, k=rng.randint(1, 8))) for _ in range(60)] for lang, s in letters.items()}
    out = []
    for i in range(300):
        lang = rng.choices(["aa", "bb", "cc", "dd"], [90, 60, 30, 2])[0]
        said = rng.choices(words[lang], k=rng.randint(1, 12))
        said += ["".join(rng.choices(letters[lang], k=rng.randint(1, 9))) for _ in range(rng.randint(0, 4))]
        out.append((i, " ".join(said), None if i % 41 == 0 else lang))
    long = " ".join(rng.choices(words["bb"], k=20_000) + ["gggghh"])
    return [*out, (300, None, "aa"), (301, "", "bb"), (302, "12 !?", "cc"), (303, long, "bb"), (303, long, "bb"),
            (304, "漢字", None), (None, "klm nop", "cc"), (305, "K" * 5000, None), (306, "жж", None)]


@pytest.mark.parametrize("carried", [10**6, 50, 0])  # every known word broadcast, some, none
def test_equals_the_plain_version_whatever_is_broadcast(spark, monkeypatch, rows, carried):
    monkeypatch.setattr(langid, "CARRIED", carried)
    monkeypatch.setattr(langid, "CELLS", 100)
    monkeypatch.setattr(langid, "CARRIED_ENTRIES", 20 * carried)
    docs = spark.createDataFrame([(i, t, lang, n, "x", 1) for n, (i, t, lang) in enumerate(rows)],
                                 "doc_id long, text string, lang string, row int, word string, k int")
    got = langid.identify(docs, F.col("doc_id") % 3 == 1).collect()
    want = plain(rows, lambda i: i is not None and i % 3 == 1)
    assert len(got) == len(rows)
    left = defaultdict(list)
    for r in got:
        left[r.doc_id].append(r)
    for at, (i, _, _) in enumerate(rows):
        r = left[i].pop()
        assert (r.lang_pred, r.held_out) == (want[at][0], i is not None and i % 3 == 1), rows[at]
        assert r.score == pytest.approx(want[at][1], abs=1e-9)


def test_a_language_of_a_small_share_keeps_its_words(spark):
    docs = spark.createDataFrame(
        [(1, "common words " * 400_000, "en"), (2, "rarely seen rarely", "xx"), (3, "rarely", None)],
        "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs, F.lit(False)).collect()}
    assert got == {1: "en", 2: "xx", 3: "xx"}


def test_many_languages(spark):
    docs = spark.createDataFrame([(i, f"same {chr(0x4E00 + i)} {chr(0x4E00 + i)}", f"l{i:03}") for i in range(400)],
                                 "doc_id long, text string, lang string")
    got = langid.identify(docs, F.lit(False)).collect()
    assert all(r.lang_pred == f"l{r.doc_id:03}" for r in got) and len(got) == 400


def test_registered_query_equals_the_plain_version(spark, tmp_path, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").filter("doc_id is not null").dropDuplicates(["doc_id"])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    kept = [tuple(r) for r in docs.collect()]
    held = {r.doc_id: r.h for r in docs.select("doc_id", (remainder("doc_id", 3) == 1).alias("h")).collect()}
    want = plain(kept, held.get)
    got = {r.doc_id: r for r in QUERIES["op1_language_id"](spark, str(tmp_path)).collect()}
    for at, (i, _, _) in enumerate(kept):
        assert (got[i].lang_pred, got[i].held_out) == (want[at][0], held[i])
        assert got[i].score == pytest.approx(want[at][1], abs=1e-9)
