"""Main text of web pages: pages of a host are compared with the page at the nearest URL, and shared lines go."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from hashlib import blake2b
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from skygrain.plans.durable import materialize

COPY_SHARE = 0.8  # pages that share this much of their undecided lines are versions of one page, not of one template
LCS_BITS = 64_000_000  # of the alignment table kept at a time

# Fixed values of the markup language and of common templates.
RAW = ("script", "style", "template", "noscript", "iframe", "svg", "math", "object", "canvas", "audio", "video", "textarea",
       "select", "title", "xmp", "noembed", "noframes")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split())
CUT_TAGS = frozenset("head nav footer aside form button menu dialog fieldset datalist".split())
CUT_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
CUT_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert|adverts|advertisement|advertising|adslot|banner|sponsor|sponsored|promo|promoted|"
    r"nav|navbar|navigation|menu|breadcrumb|breadcrumbs|pager|pagination|sidebar|side-bar|footer|masthead|topbar|"
    r"cookie|cookies|consent|gdpr|notice|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|"
    r"comment|comments|commentlist|disqus|replies|respond|share|sharing|social|related|recommended|widget|skip-link)"
    r"(?:$|[\s_-])", re.I)
PAGE_HEADERS = re.compile(r"(?:^|[\s_-])(?:header|site-header|page-header)(?:$|[\s_-])", re.I)
CLOSED_BY_NEXT = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
                  "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|=)*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")

CUT, OPEN, MAIN, ARTICLE = 0, 1, 2, 3  # what the markup says of a line; OPEN and MAIN are left to the comparison


def _zone(tag: str, attributes: str, zone: int) -> int:
    """The zone inside an element that stands in ``zone``."""
    if zone == CUT or tag in CUT_TAGS or tag in RAW:
        return CUT
    found = {}
    if "=" in attributes:
        found = {a.lower(): b or c or d for a, b, c, d in ATTRIBUTE.findall(attributes)}
        names = f"{found.get('class', '')} {found.get('id', '')}"
        role = found.get("role", "").lower()
        if tag not in ("html", "body", "main") and (role in CUT_ROLES or names != " " and CUT_NAMES.search(names)):
            return CUT
        if zone < MAIN and tag not in ("html", "body") and PAGE_HEADERS.search(names):
            return CUT
        if "hidden" in found or found.get("aria-hidden") == "true":
            return CUT
    if tag == "header" and zone < MAIN:
        return CUT
    if tag == "article" or found.get("itemprop") == "articleBody":
        return ARTICLE
    if zone < MAIN and (tag == "main" or found.get("role") == "main"):
        return MAIN
    return zone


def lines_of(html: str | None) -> list[tuple[int, str]]:
    """(zone, text) of each block of a page that shows text, in page order.

    Tags nest as they come: an end tag closes the nearest open element of its name, an inline one never a block; a
    paragraph, list item or cell closes its unclosed sibling. Character references are decoded, white space becomes
    one space. Elements still open at the end of a page that breaks off end there.
    """
    html = html or ""
    out: list[tuple[int, str]] = []
    pieces: list[str] = []
    stack: list[tuple[str, int]] = [("", OPEN)]
    still: Counter[str] = Counter()  # open elements by name
    at = 0

    def flush() -> None:
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                out.append((stack[-1][1], text))

    def pop_to(i: int) -> None:
        if any(t not in INLINE for t, _ in stack[i:]) or stack[i][1] != stack[i - 1][1]:
            flush()
        still.subtract(t for t, _ in stack[i:])
        del stack[i:]

    while True:
        m = TOKEN.search(html, at)
        if m is None:
            pieces.append(html[at:])
            flush()
            return out
        if m.start() > at:
            pieces.append(html[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            inline = tag in INLINE
            if not inline:
                flush()
            for i in range(len(stack) - 1, 0, -1) if still[tag] > 0 else ():
                if stack[i][0] == tag:
                    pop_to(i)
                    break
                if inline and stack[i][0] not in INLINE:
                    break
            continue
        if tag in VOID:
            if tag == "br":
                pieces.append(" ")
            elif tag not in INLINE:
                flush()
            continue
        if tag in RAW and not m[3].rstrip().endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        if tag not in INLINE:
            flush()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in CLOSED_BY_NEXT.get(tag, ()):
                    pop_to(i)
                    break
                if stack[i][0] not in INLINE:
                    break
        inner = _zone(tag, m[3], stack[-1][1])
        if inner != stack[-1][1]:
            flush()
        if not m[3].rstrip().endswith("/") or tag not in ("svg", "path", "use"):
            stack.append((tag, inner))
            still[tag] += 1


def line_codes(lines: Sequence[tuple[int, str]]) -> list[int]:
    return [int.from_bytes(blake2b(t.encode(), digest_size=8).digest(), "little", signed=True) for _, t in lines]


def _rows(a: list[int], b: list[int], keep: bool) -> list[int]:
    """Bit rows of the alignment of ``a`` (down) with ``b`` (across); a clear bit is a step of the length."""
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v, rows = full, []
    for x in a:
        u = v & places.get(x, 0)
        v = ((v + u) | (v - u)) & full
        if keep:
            rows.append(v)
    return rows if keep else [v]


def _steps(v: int, n: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(v.to_bytes(n // 8 + 1, "little"), np.uint8), bitorder="little")[:n]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def aligned(a: list[int], b: list[int], bits: int = LCS_BITS) -> list[tuple[int, int]]:
    """Pairs of positions of one longest common subsequence of two lists.

    The table is kept as bit rows. Where it would be larger than ``bits``, the first list is halved and the second
    cut where both halves together align best, so memory stays bounded for lists of any length.
    """
    head = 0
    while head < len(a) and head < len(b) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < len(a) - head and tail < len(b) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    pairs = [(i, i) for i in range(head)]
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    if x and y:
        if len(x) * len(y) > bits and len(x) > 1:
            half = len(x) // 2
            left = _steps(_rows(x[:half], y, False)[0], len(y))
            right = _steps(_rows(x[half:][::-1], y[::-1], False)[0], len(y))[::-1]
            cut = int(np.argmax(left + right))
            inner = aligned(x[:half], y[:cut], bits)
            inner += [(half + i, cut + j) for i, j in aligned(x[half:], y[cut:], bits)]
        else:
            rows, inner = _rows(x, y, True), []
            i, j = len(x) - 1, len(y) - 1
            while i >= 0 and j >= 0:
                if rows[i] >> j & 1:  # no step here: the best alignment does without this column
                    j -= 1
                elif i and not rows[i - 1] >> j & 1:  # the step was there a row above
                    i -= 1
                else:
                    inner.append((i, j))
                    i, j = i - 1, j - 1
            inner.reverse()
        pairs += [(head + i, head + j) for i, j in inner]
    return pairs + [(len(a) - tail + k, len(b) - tail + k) for k in range(tail)]


def shared_lines(codes: Sequence[list[int]], zones: Sequence[bytes], lengths: Sequence[list[int]]) -> tuple[list[int], list[int]]:
    """Positions of the lines that two pages share by their template; none where they are versions of one page.

    All lines are aligned. Two pages are versions of one page if the lines that markup leaves undecided agree in
    ``COPY_SHARE`` of their characters: then the comparison cannot tell text from template.
    """
    pairs = aligned(*codes)
    sides = []
    for s in (0, 1):
        undecided = sum(n for z, n in zip(zones[s], lengths[s]) if z in (OPEN, MAIN))
        common = sum(lengths[s][p[s]] for p in pairs if zones[s][p[s]] in (OPEN, MAIN))
        sides.append((undecided, common))
    if any(undecided and common >= COPY_SHARE * undecided for undecided, common in sides):
        return [], []
    return [i for i, _ in pairs], [j for _, j in pairs]


def main_text(lines: Sequence[tuple[int, str]], shared: Iterable[int]) -> str:
    """The blocks of the article, or of the page's undecided lines without the shared ones.

    Markup vouches for an article's own lines, which stay though a neighbour repeats them (quoted passages, licences).
    Other lines of the main part stay beside them unless shared. Without any such line all undecided ones count.
    """
    shared = set(shared)
    own = [(z, t) for i, (z, t) in enumerate(lines) if z == ARTICLE or z in (OPEN, MAIN) and i not in shared]
    least = MAIN if any(z >= MAIN for z, _ in lines) else OPEN
    return "\n\n".join(t for z, t in own if z >= least)


def _lined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages to the codes, zones and lengths of their lines."""
    for batch in batches:
        parsed = [lines_of(h.as_py()) for h in batch.column("html")]
        yield pa.record_batch({
            "host": batch.column("host"), "path": batch.column("path"), "mark": batch.column("mark"),
            "codes": pa.array([line_codes(p) for p in parsed], pa.list_(pa.int64())),
            "zones": pa.array([bytes(z for z, _ in p) for p in parsed], pa.binary()),
            "lengths": pa.array([[len(t) for _, t in p] for p in parsed], pa.list_(pa.int32())),
        })


def _nearness(a: str, b: str) -> tuple[int, int]:
    """Common leading folders and characters of two URL paths."""
    n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    folders = 0
    for x, y in zip(a.split("/"), b.split("/")):
        if x != y:
            break
        folders += 1
    return folders, n


FACTS = ("path", "codes", "zones", "lengths")
SAID = pa.schema([
    ("host", pa.string()), ("mark", pa.binary()), ("folders", pa.int32()), ("chars", pa.int32()),
    ("shared", pa.list_(pa.int32())), ("part", pa.int32()), ("edge", pa.int32()), ("path", pa.string()),
    ("codes", pa.list_(pa.int64())), ("zones", pa.binary()), ("lengths", pa.list_(pa.int32())),
])
SAID_DDL = ("host string, mark binary, folders int, chars int, shared array<int>, part int, edge int, path string, "
            "codes array<long>, zones binary, lengths array<int>")
FIRST, LAST = 1, 2  # of a range of the sorted pages


def _verdicts(a: dict, b: dict) -> list[dict]:
    """What each of two neighbouring pages shares with the other, and how near their paths are."""
    if a["host"] != b["host"]:
        return []
    folders, chars = _nearness(a["path"], b["path"])
    sides = shared_lines(*[(a[n], b[n]) for n in ("codes", "zones", "lengths")])
    return [{"host": x["host"], "mark": x["mark"], "folders": folders, "chars": chars, "shared": s}
            for x, s in zip((a, b), sides)]


def _table(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=SAID)


def _neighbours(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pages of one range, each compared with the one before; the range's first and last page come out whole."""
    last = None
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            out += [row | {"edge": FIRST}] if last is None else _verdicts(last, row)
            last = row
        yield _table(out)
    if last is not None:
        yield _table([last | {"edge": LAST}])


def _at_borders(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _table([v for row in batch.to_pylist() for v in _verdicts(row["a"], row["b"])])


def _written(kind: pa.DataType):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, gone = [], []
            for html, shared in zip(batch.column("html"), batch.column("shared").to_pylist()):
                texts.append(main_text(lines_of(html.as_py()), shared or ()))
                gone.append(len(shared or ()))
            yield pa.record_batch({
                "page_id": batch.column("page_id").cast(kind), "url": batch.column("url"),
                "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                "n_shared": pa.array(gone, pa.int64())})

    return run


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*([^?#]*)", 1)


def shared_by_template(pages: DataFrame) -> DataFrame:
    """``host, mark, shared``: the lines that a page has in common with the page at the nearest URL path.

    ``pages`` has ``host, path, mark, html``. Equal pages of a host count once, at their least path. Pages are sorted
    by (host, path) in ranges, so that a host of any size is spread over the cluster; the page nearest in path is then
    one of a page's two neighbours, the one with more folders and more characters in common. Each task compares the
    neighbours of its range; the last page of a range and the first of the next meet in a small join.
    A neighbour that is a version of the same page is passed over for the other one. A lone page shares nothing.
    """
    lined = pages.filter("host <> ''").mapInArrow(
        _lined, "host string, path string, mark binary, codes array<long>, zones binary, lengths array<int>")
    once = materialize(lined.groupBy("host", "mark").agg(
        F.min("path").alias("path"), *[F.any_value(c).alias(c) for c in FACTS[1:]]), "page-lines")
    in_order = once.repartitionByRange("host", "path", "mark").sortWithinPartitions("host", "path", "mark")
    said = materialize(in_order.select("host", "mark", *FACTS, F.spark_partition_id().alias("part")).mapInArrow(
        _neighbours, SAID_DDL), "neighbours")
    whole = F.struct("host", "mark", *FACTS)
    lasts = said.filter(F.col("edge") == LAST).select("part", whole.alias("a"))
    firsts = said.filter(F.col("edge") == FIRST).select(F.col("part").alias("next"), whole.alias("b"))
    follows = lasts.select("part").withColumn("next", F.lead("part").over(Window.orderBy("part")))  # ranges with rows
    borders = lasts.join(follows, "part").join(firsts, "next").select("a", "b").mapInArrow(_at_borders, SAID_DDL)
    best = F.struct((F.size("shared") > 0).alias("any"), "folders", "chars", "shared")
    told = said.filter("edge IS NULL").unionByName(borders)
    return told.groupBy("host", "mark").agg(F.max(best).alias("best")).select("host", "mark", F.col("best.shared").alias("shared"))


def extract(pages: DataFrame) -> DataFrame:
    """The main text of each page: ``page_id, url, text, n_chars, n_shared``.

    Menus, headers, footers, sidebars, notices, adverts, forms, scripts and reader comments go; the article's blocks
    stay in page order, joined by an empty line, with character references decoded and white space inside a block
    made one space. Lines that a page shares with the page at the nearest URL path of its host, in a longest common
    subsequence of all their lines, are template; see ``main_text`` for lines that markup calls an article's own.
    ``n_shared`` counts the shared lines.

    A null or empty page gives an empty text, as does one without a main part. A page without a URL, or alone on its
    host, is judged by its markup only. Repeated rows give repeated results. An empty table gives an empty result;
    other columns are ignored, whatever their names.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    url = F.coalesce(F.col("url"), F.lit(""))
    own = pages.select("page_id", "url", html.alias("html"), host_of(url).alias("host"), path_of(url).alias("path"),
                       F.unhex(F.sha2(html, 256)).alias("mark"))
    shared = materialize(shared_by_template(own.select("host", "path", "mark", "html")), "shared-lines")
    kind = pages.schema["page_id"].dataType.simpleString()
    rows = own.join(shared.filter(F.size("shared") > 0), ["host", "mark"], "left").select("page_id", "url", "html", "shared")
    return rows.mapInArrow(
        _written(to_arrow_type(pages.schema["page_id"].dataType)),
        f"page_id {kind}, url string, text string, n_chars long, n_shared long")
