"""Page extraction, lexical search and the Merkle manifest against plain Python versions and on awkward input."""

import html as markup
import math
import random
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import pytest

from skygrain.llm import lexical, merkle, pages
from skygrain.llm.queries import QUERIES


# Pages


def test_every_article_of_the_pages_comes_out_whole(spark, sf):
    def article(text):
        inside = re.search(r"<article>(.*?)</article>", text, re.S)[1]
        blocks = [" ".join(markup.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        return "\n\n".join(b for b in blocks if b)

    given = {r.page_id: (r.url, article(r.html)) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = QUERIES["op11_html_extraction"](spark, sf).collect()
    assert {r.page_id: (r.url, r.text) for r in got} == given and all(r.n_chars == len(r.text) for r in got)


def _longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("bits", [pages.LCS_BITS, 8])
def test_alignment_is_a_longest_one(bits):
    rnd = random.Random(1)
    for _ in range(500):
        a, b = ([rnd.randrange(4) for _ in range(rnd.randrange(14))] for _ in range(2))
        pairs = pages.aligned(a, b, bits)
        assert len(pairs) == _longest(a, b) and all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def _page(*lines):
    return "<body>" + "".join(f"<div>{x}</div>" for x in lines) + "</body>"


PAGES = [
    (1, "http://a.org/news/1", _page("Top", "Our site", "First story", "More of it", "Write to us")),
    (2, "http://a.org/news/2", _page("Top", "Our site", "Second story", "Write to us")),
    (3, "http://a.org/news/2?print=1", _page("Top", "Our site", "Second story", "Write to us")),  # a copy
    (4, "http://a.org/shop/9", _page("Shop", "Basket", "A lamp", "Pay")),
    (5, "http://a.org/shop/8", _page("Shop", "Basket", "A chair", "Pay")),
    (6, "http://b.org/news/1", _page("Top", "Our site", "First story")),  # alone on its host
    (7, None, _page("Top", "Our site")),
    (8, "http://a.org/news/3", None),
    (9, "", ""),
]


def _brute(rows):
    """The nearest distinct page by folders, then characters, among both neighbours in path order; then a plain LCS."""
    hosts = {}
    for _, url, text in rows:
        m = re.match(r"https?://([^/?#]*)([^?#]*)", url or "")
        if m:
            seen = hosts.setdefault(m[1], {})
            seen[text or ""] = min(seen.get(text or "", m[2]), m[2])
    out = {}
    for ident, url, text in rows:
        lines = pages.lines_of(text)
        m = re.match(r"https?://([^/?#]*)", url or "")
        options = []
        if m:
            order = sorted((path, sha256(t.encode()).digest(), t) for t, path in hosts[m[1]].items())
            at = [t for *_, t in order].index(text or "")
            for other in order[max(at - 1, 0) : at] + order[at + 1 : at + 2]:
                there = pages.lines_of(other[2])
                match = pages.aligned(*[pages.line_codes(x) for x in (lines, there)])
                sizes = [[len(t) for _, t in x] for x in (lines, there)]
                if any(sum(s) and sum(s[p[k]] for p in match) >= 0.8 * sum(s) for k, s in enumerate(sizes)):
                    match = []
                options.append((bool(match), pages._nearness(order[at][0], other[0]), [i for i, _ in match]))
        gone = max(options)[2] if options else []
        out[ident] = "\n\n".join(t for i, (_, t) in enumerate(lines) if i not in gone)
    return out


def test_lines_shared_with_the_nearest_page_go(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.extract(df).collect()}
    assert got == _brute(PAGES)
    assert got[1] == "First story\n\nMore of it" and got[2] == got[3] == "Second story" and got[4] == "A lamp"
    assert got[6] == "Top\n\nOur site\n\nFirst story" and got[8] == got[9] == "" and got[7] == "Top\n\nOur site"


@pytest.mark.parametrize("ranges", [0, 9])
def test_random_hosts_equal_brute_force(spark, hot, ranges):
    if ranges:
        hot(ranges=ranges)  # many ranges, so that neighbours meet across their borders
    rnd = random.Random(3)
    rows = [(i, f"https://h{rnd.randrange(3)}.org/{rnd.randrange(3)}/{rnd.randrange(30)}",
             _page(*[f"line {rnd.randrange(9)} {'x' * rnd.randrange(20)}" for _ in range(rnd.randrange(8))])) for i in range(120)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)
    assert {r.page_id: r.text for r in pages.extract(df).collect()} == _brute(rows)


@pytest.mark.parametrize("text,lines", [
    ("<nav>Menu</nav><main><h1>T&eacute;l</h1><p>a <b>b</b>\n c<p>d</main><footer>x</footer>", ["Tél", "a b c", "d"]),
    ("<article><header><h1>T</h1></header><p>x</p><div class='comments'><p>Nice!</p></div></article><p>out</p>", ["T", "x"]),
    ("<header>Site</header><article>one<br>two<script>var a='</p>';</script><style>p{}</style></article>", ["one two"]),
    ("<div class=cookie-notice>We use cookies</div><article><p>ok<form>Name <input></form></article>", ["ok"]),
    ("<article><p>cut <a href=\"/some", ["cut"]),
    ("<article><p title=it's>ok</p><!-- no", ["ok"]),
    ("<aside>s</aside><article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", ["a", "b", "c", "d"]),
    ("<article><p>1 &lt; 2 &amp;amp; 3&nbsp; 4</p></article>", ["1 < 2 &amp; 3 4"]),
    ("<article class=advert>buy</article><article>text</article><div role=navigation>n</div>", ["text"]),
    ("<article><b><i>x</b></i></div>y</article>", ["x", "y"]),
    ("no markup at all", ["no markup at all"]), ("<", ["<"]), ("", []), (None, []),
])
def test_blocks_of_awkward_pages(text, lines):
    assert pages.main_text(pages.lines_of(text), ()) == "\n\n".join(lines)


def test_pages_empty_table_extra_columns_and_long_page(spark):
    kind = "page_id long, url string, html string, host string, mark int, shared string"
    assert pages.extract(spark.createDataFrame([], kind)).collect() == []
    long = "<article>" + "".join(f"<p>line {i % 977}</p>" for i in range(60_000)) + "</article>"
    deep = "<b>" * 50_000 + "deep" + "</i>" * 50_000
    rows = [(1, "http://a.org/1", long, "h", 1, "s"), (1, "http://a.org/1", long, "h", 1, "s"), (2, "http://a.org/2", deep, None, None, None)]
    got = sorted((r.page_id, r.text) for r in pages.extract(spark.createDataFrame(rows, kind)).collect())
    assert [x[0] for x in got] == [1, 1, 2] and got[0][1].count("\n\n") == 59_999 and got[2][1] == "deep"


# Lexical search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def _ranked(docs, items, top=10):
    held = [(i, _terms(t)) for i, t in docs]
    n_docs, length = sum(bool(t) for _, t in held), sum(len(t) for _, t in held)
    df = Counter(t for _, terms in held for t in set(terms))
    out = []
    for item, text in set(items):
        scores = []
        for ident, terms in held:
            tf, m = Counter(terms), 25 + (75 * len(terms) * n_docs) // (length or 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
                    for t in _terms(text) if t in tf)
            if s > 0 and ident is not None:
                scores.append((-s, ident))
        out += [(item, k + 1, ident, -s) for k, (s, ident) in enumerate(sorted(scores)[:top])]
    return sorted(out)


DOCS = [
    (5, "Cat dog cat"), (3, "dog-cat;CAT"), (9, "caté cat dog"), (1, None), (2, ""), (4, "?! --"), (7, "dog"), (7, "dog"),
    (None, "dog bird"), (8, "bird " * 3000 + "cat"), (-4, "bird_cat ÀÉ àé"), (6, "𝒳cat 𝒳cat cat"),
]
ITEMS = [(1, "cat dog"), (1, "cat dog"), (2, "BIRD bird ÀÉ"), (3, None), (4, ""), (5, "nothing here"), (1, "𝒳cat"), (6, "é cat dog ca t")]


@pytest.mark.parametrize("most", [(2_000, 50_000, 4_000_000), (1, 50_000, 4_000_000), (9, 2, 4_000_000), (9, 99, 4)])
def test_search_equals_brute_force_in_one_block_or_many(spark, most):
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in DOCS], "doc_id long, text string, n int, terms string").repartition(3)
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, item int")
    got = sorted(tuple(r) for r in lexical.search(docs, items, most=most).collect())
    want = sorted(r for one in set(ITEMS) for r in _ranked(DOCS, [one]))
    assert got == want and got


def test_search_ties_top_and_slices(spark, monkeypatch):
    docs = [(i, "a b" if i % 3 else "b c c") for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    items = [(i, x) for i, x in enumerate(["a", "b", "c a", "b b"])]
    got = sorted(tuple(r) for r in lexical.search(df, spark.createDataFrame(items, "item_id int, text string"), top=7).collect())
    assert got == _ranked(docs, items, 7)


def test_search_of_empty_tables(spark):
    docs, items = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.search(docs.limit(0), items).collect() == []
    none = lexical.search(docs, items.limit(0))
    assert none.collect() == [] and none.columns == ["item_id", "rank", "doc_id", "score"]


def test_products_are_cut_into_runs():
    import numpy as np

    fan = np.array([3, 0, 9, 1, 1, 0, 4])
    runs = list(lexical._runs(fan, 4))
    assert [a for a, _ in runs][0] == 0 and runs[-1][1] == 7 and all(x[1] == y[0] for x, y in zip(runs, runs[1:]))


# Merkle manifest


def _digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def _leaf(row):
    return _digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def _tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([_digest(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def _proof(levels, i):
    """(sibling or None, whether it comes first) from the leaf up."""
    return [(level[j ^ 1] if (j := i >> k) ^ 1 < len(level) else None, j & 1) for k, level in enumerate(levels[:-1])]


def _manifest(rows):
    groups = {}
    for r in rows:  # doc_id, source, lang, n_chars, text
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in langs:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0], _leaf(r)))
        trees[g] = _tree([_leaf(r) for r in groups[g]])
    crown = _tree([trees[g][-1][0] for g in langs])
    out = []
    for k, g in enumerate(langs):
        for i, r in enumerate(groups[g]):
            path = _proof(trees[g], i) + _proof(crown, k)
            hit = r[0] is not None and r[3] is not None and crc32(str(r[0]).encode()) % 7 == 0
            led = _leaf((*r[:3], r[3] + 1, r[4])) if hit else _leaf(r)
            for other, first in path:
                led = _digest(led) if other is None else _digest(other, led) if first else _digest(led, other)
            proof = _digest(*[o for o, _ in path if o is not None])
            root = crown[-1][0]
            out.append((r[0], _leaf(r), trees[g][-1][0], root, proof, led, led == root))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
KIND = "doc_id long, source string, lang string, n_chars long, text string"


def _rows(n, seed=0):
    rnd = random.Random(seed)
    lang = lambda: rnd.choice(["en"] * 6 + ["fr", "", None, "é", "zz"])
    rows = [(i, rnd.choice(["s", None, ""]), lang(), rnd.choice([None, 0, 12]), rnd.choice([None, "", "ü\n", "x" * i])) for i in range(n)]
    return rows + rows[:5] + [(None, None, None, None, None), (3, "other", "en", 1, "tie")]


@pytest.mark.parametrize("n,height", [(150, 2), (150, 1), (40, 10), (0, 3)])
def test_manifest_equals_a_plain_tree(spark, n, height):
    rows = _rows(n) if n else [(7, None, "en", 4, "one")]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], f"{KIND}, grp string, pos int").repartition(6)
    hit = merkle.F.pmod(merkle.F.crc32(merkle.F.col("doc_id").cast("string")), merkle.F.lit(7)) == 0
    fields = [merkle.F.col(c) for c in ("doc_id", "source", "lang")] + [merkle.F.col("n_chars") + 1, merkle.F.col("text")]
    altered = merkle.F.when(hit & merkle.F.col("n_chars").isNotNull(), merkle.record(fields))
    made = merkle.build(df, altered=altered, height=height)
    got = merkle.verify(made.proofs()).withColumnRenamed("id", "doc_id").select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=str) == _manifest(rows)


def test_manifest_query_finds_exactly_the_altered_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = QUERIES["op13_merkle_manifest"](spark, sf).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=str) == _manifest(rows)
    assert {r.doc_id for r in got if not r.verified} == {r[0] for r in rows if crc32(str(r[0]).encode()) % 7 == 0}


def test_manifest_of_an_empty_table(spark):
    assert merkle.tampered(spark.createDataFrame([], KIND)).collect() == []


@pytest.mark.parametrize("levels", range(1, 9))
def test_layout_uses_every_slot_once_and_keeps_subtrees_together(levels):
    slots = merkle.addresses(levels)
    assert sorted(int(a) for d in slots for a in d) == list(range(2**levels - 1))
    top = levels // 2
    if top:
        assert sorted(int(a) for d in slots[:top] for a in d) == list(range(2**top - 1))
        first = [int(a) for k, d in enumerate(slots[top:]) for a in d[: 2**k]]
        assert sorted(first) == list(range(2**top - 1, 2**top - 1 + 2 ** (levels - top) - 1))
