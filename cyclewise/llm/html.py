"""Operator 13: main text of web pages by differencing with the page of the nearest URL.

1. Every page is cut into blocks (lines of text) with the part of the page they stand in: outside
   (menus, page headers, footers, sidebars, notices, adverts, forms, comments, by element, role or
   class), main (in an ``article`` or ``main`` element) or plain (neither).
2. The pages of a host are ordered by URL path.  The order is a range sort over (host, path), so a
   host that holds a third of all pages is spread over many tasks; the neighbour with the longest
   common path is a page's partner.  Only line hashes travel for this, never texts.
3. The lines of a page and of its partner are aligned by a longest common subsequence; the lines in
   it are shared.
4. Lines outside go; the text is the main lines and the plain lines that the partner does not share.
   Where a page has no main lines, a partner that shares all its plain lines is a copy and deletes
   nothing; without a partner the main lines are the text, or else the plain ones.

Shared lines that stand in the article are kept: passages and licence lines that several articles
quote are their text.  So every page with a plain line waits for its partner, and the texts of
these pages travel compressed; for a page without one there is nothing to tell.

Results for odd input: null or empty html gives an empty text; a page whose url is null or has no
host, and the only page of a host, have no partner; rows that repeat an id are each extracted, and
pages with the same url are each other's neighbours; unclosed elements end with what holds them;
an empty table gives no rows.  Only the named columns are read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, numbered, slices, tidy

PLAIN, MAIN, OUT = 0, 1, 2
CELLS = 64 << 20  # bits of one alignment table; larger pairs are halved until they fit

# Elements by what they do to the text around them.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
    form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select
    summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
RAW = frozenset("script style template noscript iframe noembed noframes textarea title xmp svg math object select canvas audio video".split())
OUTSIDE = frozenset("nav aside footer form dialog menu search button fieldset label datalist head".split())
ROLES_OUT = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form tablist toolbar".split())
NAMES_OUT = frozenset("""ad ads adbox adslot advert adverts advertisement advertising banner sponsor sponsored promo promotion menu nav navbar
    navigation breadcrumb breadcrumbs sidebar aside widget related recommended notice notices cookie cookies consent gdpr popup modal overlay
    newsletter subscribe signup login share sharing social comment comments commentlist respond reply replies disqus footer masthead
    topbar pagination pager search searchform skip""".split())
NAMES_HEAD = frozenset("header siteheader pageheader".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "option": {"option"}, "optgroup": {"option", "optgroup"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}}

_MARKUP = re.compile(r"""<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|$)""", re.I)
_NAME = re.compile(r"[a-z]+")
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)[^/?#]*([^?#]*)(.*)$", re.S)


def _place(tag: str, attributes: str, place: int) -> int:
    """The part of the page that an element inside ``place`` opens."""
    if place == OUT:
        return OUT
    if tag in OUTSIDE or (tag == "header" and place == PLAIN):
        return OUT
    if tag in ("article", "main"):
        inner = MAIN
    else:
        inner = place
    for name, a, b, c in _ATTRIBUTE.findall(attributes) if attributes else ():
        value, name = (a or b or c).lower(), name.lower()
        if name == "role":
            if value in ROLES_OUT and not (inner == MAIN and value == "banner"):
                return OUT
            if value in ("main", "article"):
                inner = MAIN
        elif name != "hidden" and tag not in ("html", "body"):
            words = _NAME.findall(value)
            if not NAMES_OUT.isdisjoint(words) and tag not in ("article", "main") or "comment" in words or "comments" in words:
                return OUT
            if place == PLAIN and not NAMES_HEAD.isdisjoint(words) and inner == PLAIN:
                return OUT
    return inner


def blocks(page: str) -> tuple[list[str], list[int]]:
    """The non-empty blocks of text of a page, in page order, and the place of each."""
    texts: list[str] = []
    places: list[int] = []
    piece: list[str] = []
    stack: list[tuple[str, int]] = []
    place = PLAIN

    def flush() -> None:
        if piece:
            text = " ".join(html.unescape("".join(piece)).split())
            piece.clear()
            if text:
                texts.append(text)
                places.append(place)

    def pop(n: int) -> None:
        nonlocal place
        del stack[n:]
        place = stack[-1][1] if stack else PLAIN

    at, end = 0, len(page)
    while at < end:
        m = _MARKUP.search(page, at)
        if m is None:
            piece.append(page[at:])
            break
        if m.start() > at:
            piece.append(page[at : m.start()])
        at = m.end()
        tag = (m.group(2) or m.group(5) or "").lower()
        if not tag:
            continue  # comments, doctype
        if m.group(1) or m.group(4):
            if tag in BLOCKS:
                flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    if place != (stack[i - 1][1] if i else PLAIN):
                        flush()
                    pop(i)
                    break
            continue
        attributes = m.group(3) or m.group(6) or ""
        if tag == "br":
            piece.append(" ")
            continue
        if tag in BLOCKS:
            flush()
            closes = CLOSED_BY.get(tag, set()) | {"p"}
            scope = SCOPES.get(tag, {"table", "ul", "ol", "dl"})
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in closes:
                    pop(i)
                elif stack[i][0] in scope or (stack[i][0] in BLOCKS and tag not in CLOSED_BY):
                    break
        if tag in RAW and not attributes.endswith("/"):
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if tag in VOID or attributes.endswith("/") and tag not in BLOCKS:
            continue
        inner = _place(tag, attributes, place)
        if inner != place:
            flush()
        stack.append((tag, inner))
        place = inner
    flush()
    return texts, places


def _table(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Bit rows of the alignment of ``a`` with every prefix of ``b``: bit i is 0 where a[i] lengthens the subsequence."""
    where: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v, rows = full, []
    for y in b.tolist():
        u = v & where.get(y, 0)
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    return rows


def _lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of ``b`` and every prefix of ``a``."""
    if not len(a) or not len(b):
        return np.zeros(len(a) + 1, np.int64)
    bits = _table(a, b)[-1].to_bytes(len(a) // 8 + 1, "little")
    zero = 1 - np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")[: len(a)]
    return np.concatenate([[0], np.cumsum(zero)])


def common(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Places (in a, in b) of a longest common subsequence."""
    n, m = len(a), len(b)
    lead = 0
    while lead < n and lead < m and a[lead] == b[lead]:
        lead += 1
    tail = 0
    while tail < n - lead and tail < m - lead and a[n - 1 - tail] == b[m - 1 - tail]:
        tail += 1
    out = [(i, i) for i in range(lead)]
    x, y = a[lead : n - tail], b[lead : m - tail]
    if len(x) and len(y):
        if len(x) * len(y) > CELLS and len(y) > 1:  # halve b, cut a where both halves together align best
            half = len(y) // 2
            cut = int(np.argmax(_lengths(x, y[:half]) + _lengths(x[::-1], y[half:][::-1])[::-1]))
            inner = common(x[:cut], y[:half]) + [(i + cut, j + half) for i, j in common(x[cut:], y[half:])]
        else:
            rows, inner, i = _table(x, y), [], len(x) - 1
            j = len(y) - 1
            while i >= 0 and j >= 0:
                if rows[j] >> i & 1:
                    i -= 1
                elif j and not rows[j - 1] >> i & 1:
                    j -= 1
                else:
                    inner.append((i, j))
                    i, j = i - 1, j - 1
            inner.reverse()
        out += [(i + lead, j + lead) for i, j in inner]
    return out + [(n - tail + i, m - tail + i) for i in range(tail)]


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every page: the lines that can be its text (main and plain ones), and the hashes of all its lines."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for b in slices(batches, "html"):
        rows: dict[str, list] = {c: [] for c in ("host", "path", "decided", "lines", "places", "hashes")}
        for page, url in zip(b.column("html").to_pylist(), b.column("url").to_pylist()):
            texts, places = blocks(page or "")
            m = _HOST.match(url or "")
            rows["host"].append(m.group(1).lower() if m else None)
            rows["path"].append(m.group(2) + m.group(3) if m else None)
            rows["decided"].append(PLAIN not in places)
            rows["lines"].append(pack("\n".join(t for t, p in zip(texts, places) if p != OUT).encode()))
            rows["places"].append(bytes(places))
            rows["hashes"].append(np.array([xxhash.xxh3_64_intdigest(x) for x in texts], np.uint64).tobytes())
        kinds = {"host": pa.string(), "path": pa.string(), "decided": pa.bool_(), "lines": pa.binary(), "places": pa.binary(), "hashes": pa.binary()}
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("url"), *[pa.array(v, kinds[c]) for c, v in rows.items()]], ["id", "url", *rows])


def closeness(a: str, b: str) -> int:
    """Common leading segments of two paths, then their common leading characters, as one number."""
    lead = 0
    for x, y in zip(a, b):
        if x != y:
            break
        lead += 1
    return (a[:lead].count("/") << 32) + lead


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two rows for each pair of neighbours: what either page shares with the other."""
    for b in batches:
        rows, close, order, flags = [], [], [], []
        for r1, p1, h1, r2, p2, h2 in zip(*(b.column(c).to_pylist() for c in ("row", "path", "hashes", "row2", "path2", "hashes2"))):
            x, y = np.frombuffer(h1, np.uint64), np.frombuffer(h2, np.uint64)
            fx, fy = np.zeros(len(x), np.uint8), np.zeros(len(y), np.uint8)
            for i, j in common(x, y):
                fx[i] = fy[j] = 1
            c = closeness(p1, p2)
            rows += [r1, r2]
            close += [c, c]
            order += [0, 1]  # of two partners as near as each other, the one before
            flags += [fx.tobytes(), fy.tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(close, pa.int64()), pa.array(order, pa.int32()), pa.array(flags, pa.binary())],
                                         ["row", "close", "order", "flags"])


def shared_lines(parsed: DataFrame) -> DataFrame:
    """(row, flags): for every page with a partner, a byte for each line, 1 if the partner shares it."""
    keys = parsed.filter("host is not null").select("row", "host", "path", "hashes")
    order = keys.repartitionByRange("host", "path", "row").sortWithinPartitions("host", "path", "row")
    placed = numbered(order, "pos")
    after = placed.select((F.col("pos") - 1).alias("pos"), F.col("row").alias("row2"), F.col("host").alias("host2"), F.col("path").alias("path2"), F.col("hashes").alias("hashes2"))
    pairs = placed.join(after.hint("merge"), "pos").filter("host = host2").select("row", "path", "hashes", "row2", "path2", "hashes2")
    sides = pairs.mapInArrow(_align, "row long, close long, order int, flags binary")
    return sides.groupBy("row").agg(F.max_by("flags", F.struct("close", "order")).alias("flags"))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for b in slices(batches, "lines", 1 << 20):
        out = []
        for decided, lines, places, flags in zip(*(b.column(c).to_pylist() for c in ("decided", "lines", "places", "flags"))):
            text = unpack(lines).decode() if lines else ""
            if not decided:
                place = np.frombuffer(places, np.uint8)
                keep = place[place != OUT] == MAIN
                if flags is not None:
                    keep |= np.frombuffer(flags, np.uint8)[place != OUT] == 0
                if keep.any():
                    text = "\n".join(t for t, k in zip(text.split("\n"), keep.tolist()) if k)
            out.append(text)
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("url"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                                         ["id", "url", "text", "n_chars"])


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page."""
    kind = pages.schema[id_col].dataType.simpleString()
    named = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    parsed = materialise(named.mapInArrow(
        tidy(_parse), f"id {kind}, url string, host string, path string, decided boolean, lines binary, places binary, hashes binary")
        .withColumn("row", F.monotonically_increasing_id()))
    wanted = ("id", "url", "decided", "lines", "places")
    waiting = parsed.filter("NOT decided").select("row", *wanted).join(shared_lines(parsed).hint("merge"), "row", "left").select(*wanted, "flags")
    ready = parsed.filter("decided").select(*wanted, F.lit(None).cast("binary").alias("flags"))
    out = ready.unionByName(waiting).mapInArrow(_extract, f"id {kind}, url string, text string, n_chars long")
    return out.withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)
