"""Operators 11 to 13 against brute force, with the awkward cases."""

from __future__ import annotations

import collections
import re
import zlib

import numpy as np
import pytest

from cyclewise.llm import html, phrases, variants

SCHEMA = "doc_id long, text string, lang string, word string, n long, key string, shard string, f int"


def _docs(spark, rows):
    """Rows (id, text, lang) with further columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, "w", 1, "k", "s", 2) for r in rows], SCHEMA).repartition(3)


# ---------------------------------------------------------------- spelling variants

def _near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _variants(rows):
    n: collections.Counter = collections.Counter()
    for i, t, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            n[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 31 == 0 else w] += 1
    n = collections.Counter({w: k for w, k in n.items() if len(w) >= 7 and k >= 2})
    near = {w: [x for x in n if _near(w, x)] for w in n}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root)
    return out


def _spelled(seed: int):
    r = np.random.default_rng(seed)
    syllables = ["the", "an", "ing", "er", "é", "ß", "on", "a", "b", "Th"]
    base = ["".join(r.choice(syllables, int(r.integers(3, 7)))) for _ in range(60)]
    rows = []
    for i in range(300):
        ws = list(r.choice(base[: 1 + int(r.integers(1, 60))], 20))
        rows.append((i, " ".join(ws) + ("," if i % 2 else "\x00"), "en"))
    rows += [rows[0], rows[7], (None, rows[3][1], None), (500, None, "en"), (501, "", "en"), (502, "×÷Āabcdefg abcdefg1", "en")]
    rows += [(700, " ".join(["chainword"] * 300 + ["chainwerd"] * 25 + ["chaiwerd"] * 2), "en")]
    long_ = "ab" * 400
    return rows + [(600, f"{long_} {long_}x {long_}", "en"), (601, f"{long_}x {long_[:-1]} {long_[:-1]}", "en")]


@pytest.mark.parametrize("crowd", [variants.CROWD, 5])
def test_spelling_variants_equal_brute_force(spark, crowd):
    rows = _spelled(3)
    want = _variants(rows)
    got = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in variants.variants(_docs(spark, rows), crowd=crowd).collect()}
    assert got == want and sum(v[2] is not None for v in want.values()) > 5
    assert any(v[4] != v[2] for v in want.values() if v[2])  # a chain of two forms


def test_spelling_variants_of_an_empty_table(spark):
    assert variants.variants(_docs(spark, [(1, None, None)]).limit(0)).count() == 0


def test_gram_bound_holds():
    """Grams that an edit leaves, counted by place from the left or the right, are never fewer than the bound says."""
    r = np.random.default_rng(5)
    frequent = np.array(sorted(int.from_bytes(g.ljust(4, b"\0"), "big") for g in (b"ab", b"aba", b"ba", b"bb")), np.int64)
    for _ in range(300):
        w = bytes(r.choice(list(b"abc"), int(r.integers(2, 9))).tolist())
        k, kind = int(r.integers(0, len(w))), int(r.integers(0, 3))
        x = [w[:k] + w[k + 1 :], w[:k] + b"b" + w[k:], w[:k] + b"b" + w[k + 1 :]][kind]
        if not x:
            continue
        gram, want = variants.decompose(np.frombuffer(w, np.uint8)[None], frequent)
        other, _ = variants.decompose(np.frombuffer(x, np.uint8)[None], frequent)
        left = {(p, g) for p, g in enumerate(other[0].tolist())}
        right = {(p - len(x), g) for p, g in enumerate(other[0].tolist())}
        kept = sum((p, g) in left or (p - len(w), g) in right for p, g in enumerate(gram[0].tolist()))
        assert kept >= len(w) - int(variants.most_affected(want)[0])


def test_crowded_groups_are_halved(spark):
    words = spark.createDataFrame([(f"prefix{a}{b}{c}end", 2) for a in "abcde" for b in "abcde" for c in "abcde"], "word string, n long")
    sizes = [r["count"] for r in variants.groups(words, crowd=30).groupBy("key").count().collect()]
    assert max(sizes) <= 30


# ---------------------------------------------------------------- collocations

def _collocations(rows, least, top):
    f: dict = collections.defaultdict(collections.Counter)
    n: collections.Counter = collections.Counter()
    for _, t, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m.group().lower(), t or "")):
            ws = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, 5):
                f[lang].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, c in f.items():
        cands = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside: collections.Counter = collections.Counter()
        for p, a in cands.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        inside[p[i:j]] = max(inside[p[i:j]], a)
        scored = []
        for p, a in cands.items():
            if p in inside and 100 * inside[p] >= 80 * a:
                continue
            s, k = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-s, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


@pytest.mark.parametrize(("shard", "top"), [(2_000_000, 2000), (150, 7)])
def test_collocations_equal_brute_force(spark, shard, top, monkeypatch):
    r = np.random.default_rng(6)
    words = ["the", "The", "of", "new", "york", "city", "é🙂", "a", "b", "c\x1c"]
    rows = []
    for i in range(200):
        ws = [str(w) for w in r.choice(words, 30, p=[0.2, 0.1, 0.2, 0.1, 0.1, 0.1, 0.05, 0.05, 0.05, 0.05])]
        for k in range(0, 28, 9):
            ws[k : k + 3] = ["New", "york", "city"]
        rows.append((i, "".join(w + str(r.choice([" ", " \t", ", ", "\r\n"], p=[0.85, 0.05, 0.05, 0.05])) for w in ws), ["en", None, "und", "de"][i % 4]))
    rows += [rows[0], rows[1], (None, rows[2][1], "en"), (300, None, "en"), (301, "", "fr"), (302, " ,.\n", "fr"), (303, "solo", "fr")]
    monkeypatch.setattr(phrases, "SHARD_WORDS", shard)
    got = phrases.collocations(_docs(spark, rows), top=top).collect()
    want = _collocations(rows, 30, top)
    assert sorted(tuple(x) for x in got) == want and len(want) > 12


def test_collocations_of_an_empty_table(spark):
    assert phrases.collocations(_docs(spark, [(1, None, None)])).count() == 0
    assert phrases.collocations(_docs(spark, [(1, "a b", "en")]).limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_index_enumerates_all_phrases(seed):
    r = np.random.default_rng(seed)
    ids = r.integers(0, 5, 400).astype(np.int32) * 7
    known = {}
    for level in (2, 3, 4):
        c: collections.Counter = collections.Counter()
        for i in range(len(ids) - level + 1):
            p = ids[i : i + level].tolist()
            if 0 not in p:
                c[tuple(p)] += 1
        keys, n = phrases.enumerate_level(ids, known, level)
        got = {(k[0] >> 32, k[0] & 0xFFFFFFFF, k[1] >> 32, k[1] & 0xFFFFFFFF)[:level]: m for k, m in zip(keys.tolist(), n.tolist())}
        assert got == dict(c)
        known[level] = keys


def test_scores_are_exact_beyond_64_bits(spark):
    got = spark.sql("SELECT (CAST(2000000 AS DECIMAL(8, 0)) * CAST(9000000000000000007L AS DECIMAL(19, 0))) DIV (CAST(9000000000000000009L AS DECIMAL(20, 0)) + CAST(9000000000000000011L AS DECIMAL(20, 0))) AS s").first()[0]
    assert got == 2000000 * 9000000000000000007 // (9000000000000000009 + 9000000000000000011)


# ---------------------------------------------------------------- pages

PAGES = "page_id long, url string, html string, text string, host string, row long, lines string"


def _pages(spark, rows):
    return spark.createDataFrame([(*r, "t", "h", 1, "l") for r in rows], PAGES).repartition(3)


ARTICLE = ("<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p><p>x';</script></head><body>"
           "<header><h2>Site</h2></header><nav><ul><li><a href='/'>Home</a><li>About</ul></nav><!-- ad <p>no</p> -->"
           "<div class=\"ad box\">Buy &amp; sell<p>now</div><aside>Side</aside><div id=cookie-notice>We use cookies</div>"
           "<form><p>Mail</p><input></form><article><header><h1>Head &lt;1&gt;</h1></header><p>First&nbsp; \n text<br>goes <b>on<p>Second "
           "<a href=\"x>y\">link</a> &copy; &#233;&#x1F642; &amp;lt;<ul><li>one<li>two</ul><nav>in menu</nav><div class='comments'><p>Me too</p></div>"
           "</article><footer>&copy; <p>F</footer></body>")


def test_article_with_surroundings(spark):
    rows = [(1, "http://a.example.com/x/1", ARTICLE), (2, "http://a.example.com/x/2", ARTICLE), (2, "http://a.example.com/x/2", ARTICLE),
            (3, None, "<p>just this"), (4, "no host", ""), (5, "http://a.example.com/x/3", None), (None, "http://b.example.com/", "plain &lt; text"),
            (6, "http://c.example.com", "<p>a &lt <p class=>b</p></nav> c < d <e")]
    got = html.main_text(_pages(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    want = "Head <1>\nFirst text goes on\nSecond link © é🙂 &lt;\none\ntwo"
    assert by[1]["text"] == by[2]["text"] == want and by[1]["n_chars"] == len(want)
    assert (by[3]["text"], by[4]["text"], by[5]["text"], by[5]["n_chars"], by[None]["text"]) == ("just this", "", "", 0, "plain < text")
    assert by[6]["text"].startswith("a <\nb")
    assert html.main_text(_pages(spark, rows).limit(0)).count() == 0


def test_shared_lines_go_where_no_element_marks_the_article(spark):
    r = np.random.default_rng(2)
    rows, want = [], {}
    for host in range(3):
        for i in range(40):
            own = [f"own {host} {i} {k} {r.integers(10**9)}" for k in range(1 + i % 5)]
            lines = ["Home", "Products", *own[:1], "Read more", *own[1:], f"Imprint {host}"]
            rows.append((100 * host + i, f"https://h{host}.example.com/{'ab'[i % 2]}/{i}?q={i}", "".join(f"<div>{x}</div>" for x in lines)))
            want[100 * host + i] = "\n".join(own)
    rows.append((999, "https://alone.example.com/x", "<div>Home</div><div>only page</div>"))
    want[999] = "Home\nonly page"
    got = {x["page_id"]: x["text"] for x in html.main_text(_pages(spark, rows)).collect()}
    assert got == want


def test_a_copy_deletes_nothing_and_shared_article_lines_stay(spark):
    rows = [(i, f"http://a.example.com/{i}", "<div>same</div><div>text</div>") for i in range(4)]
    rows += [(10 + i, f"http://b.example.com/{i}", f"<main><p>License</p><p>own {i}</p></main><div>Share</div>") for i in range(3)]
    got = {x["page_id"]: x["text"] for x in html.main_text(_pages(spark, rows)).collect()}
    assert {got[i] for i in range(4)} == {"same\ntext"} and got[11] == "License\nown 1"


def test_plain_lines_beside_an_article_are_differenced(spark):
    rows = [(i, f"http://a.example.com/{i}", f"<div>Site</div><div>Note {i}</div><article><p>Quote</p><p>own {i}</p></article><div>Share</div><footer>F {i}</footer>") for i in range(5)]
    rows += [(9, "http://alone.example.com/", "<div>Site</div><main>text</main>"), (10 ** 6, None, "<div>Site</div><main>no host</main><p>after</p>")]
    got = {x["page_id"]: x["text"] for x in html.main_text(_pages(spark, rows)).collect()}
    assert got == {i: f"Note {i}\nQuote\nown {i}" for i in range(5)} | {9: "text", 10 ** 6: "no host"}


def _lcs(a, b):
    t = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1, j + 1] = t[i, j] + 1 if x == y else max(t[i, j + 1], t[i + 1, j])
    return t[-1, -1]


@pytest.mark.parametrize("cells", [html.CELLS, 20])
def test_alignment_is_a_longest_common_subsequence(cells, monkeypatch):
    monkeypatch.setattr(html, "CELLS", cells)
    r = np.random.default_rng(1)
    for _ in range(200):
        a, b = (r.integers(0, 4, int(r.integers(0, 25))).astype(np.uint64) for _ in range(2))
        got = html.common(a, b)
        assert len(got) == _lcs(a.tolist(), b.tolist())
        assert all(a[i] == b[j] for i, j in got)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))


def test_nearest_path():
    assert html.closeness("/a/b/1", "/a/b/2") > html.closeness("/a/b/1", "/a/c/1") > html.closeness("/a/b", "/x")
