"""Each operator against a brute-force version, on a small fixture with the awkward cases."""

from __future__ import annotations

import collections
import hashlib
import math
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cyclewise.llm import ann, components, langid, lm, minhash, mixing, pieces, quality, rans, rules, suffix
from cyclewise.llm.common import fold

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, score double, row string, id string, component string"
EN = "the quick brown fox jumps over the lazy dog and then it runs away from that angry old hound near here "
DE = "der schnelle braune fuchs springt über den faulen hund und läuft dann weg von dem alten hof im tal dort "


def _texts() -> list[str | None]:
    r = np.random.default_rng(4)
    words = (EN + DE).split()
    out: list[str | None] = [None, "", "   \n\t ", "7 + 3", "short one", EN * 3, EN * 3, (EN * 3).replace("quick", "quiet", 1)]
    for _ in range(40):
        out.append(" ".join(r.choice(words, int(r.integers(60, 140)))))
    base = out[10]
    out += [base, base[:-8] + "changed", EN + base + DE, "é漢字🙂\x00 a b ▁ x\x1cy \t z  " * 4, "a" * 400, "ab " * 3000, " ".join(r.choice(words, 30000)), EN.upper()]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    texts = _texts()
    rows = [(i, t, ["en", "de", None][i % 3], [None, "a", "b", "c", "d"][i % 5], 1, 0.5, "r", "i", "c") for i, t in enumerate(texts)]
    rows += [rows[5], rows[12], (None, EN, "en", "a", 1, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(0, 50, 2)] + [(6, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def raw(docs):
    return {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}


def test_language_id(docs, empty):
    net = langid.train(docs.filter(fold("doc_id", 3) != 1))
    got = by_id(langid.identify(docs, net))
    assert len(got) == docs.select("doc_id").distinct().count()
    assert [got[i]["lang_pred"] for i in (0, 1, 2, 3)] == ["und"] * 4
    assert all(0 <= r["score"] <= 1 for r in got.values())
    kept = langid.keep_identified(docs, net)
    assert kept.schema == docs.schema and kept.filter("doc_id < 4").count() == 0 and kept.count() == docs.count() - 4
    assert langid.train(empty) is None and langid.identify(empty, net).count() == 0
    assert langid.identify(docs, None).filter("lang_pred != 'und'").count() == 0


def test_language_network_learns():
    r = np.random.default_rng(0)
    texts = [" ".join(r.choice((EN if i % 2 else DE).split(), 60)).encode() for i in range(200)]
    x, owner, _ = langid.windows(texts)
    net = langid.Network(["de", "en"])
    net.train(x[owner < 150], (owner % 2)[owner < 150], 60)
    late = owner >= 150
    assert (net.log_probs(x[late]).argmax(axis=1) == owner[late] % 2).mean() > 0.95


@pytest.mark.parametrize("seed", range(4))
def test_targets_share_the_excess(seed):
    r = np.random.default_rng(seed)
    sizes, w = r.integers(0, 1000, 9).tolist(), [5.0, 2.0, 1.0] * 3
    out, fixed = [0.0] * 9, set()
    while True:  # the rule as it is stated: cap, share the excess again, until none is above
        left = 1.5 * sum(sizes) - sum(2 * sizes[i] for i in fixed)
        free = [i for i in range(9) if i not in fixed]
        out = [2.0 * sizes[i] if i in fixed else left * w[i] / sum(w[k] for k in free) for i in range(9)]
        over = {i for i in free if out[i] > 2 * sizes[i]}
        if not over:
            break
        fixed |= over
    assert mixing.targets(sizes, w) == pytest.approx(out)


def test_mix(docs, empty):
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count()
    size = {i: len(t.split()) for i, t in raw(docs).items()}
    by_source = collections.defaultdict(list)
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    for r in got:
        assert r["size"] == size[r["doc_id"]] and r["taken"] == r["size"] * r["copies"] and r["copies"] <= 2
        by_source[source[r["doc_id"]]].append(r)
    for rows in by_source.values():
        assert abs(sum(r["taken"] for r in rows) - rows[0]["target"]) <= max(2 * r["size"] for r in rows)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.mix(empty).count() == 0


def test_lm_base_and_probability(docs, empty):
    path = P.path("byte_bpe_50k.json")
    got = lm.score(docs, fold("doc_id", 7) != 2, path).collect()
    count: collections.Counter = collections.Counter()
    for r in docs.collect():
        if r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 7 != 2:
            count.update([*(r["text"] or "").encode().lower().split(), None])
    n, v = sum(count.values()), len(count)
    texts = raw(docs)
    assert len(got) == docs.count()
    for r in got:
        ws = [*texts[r["doc_id"]].lower().split(), None]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(count[w] > 0 for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws))
        assert r["score"] < 0 and math.isfinite(r["score"])
    assert lm.score(empty, F.lit(True), path).count() == 0


def test_lm_is_a_distribution_and_windows_agree():
    r = np.random.default_rng(1)
    counts = r.integers(0, 50, 300)
    sample = [r.integers(0, 300, 80) for _ in range(30)]
    m = lm.Model(counts, sample)
    m.train(sample, 30)
    x, at, ok = m.windows(m.inp[sample[0]], np.array([80]))
    assert ok.sum() == 80 and sorted(at[ok].tolist()) == list(range(80))  # every token once
    z = m.forward(x)
    p = np.exp(z) / np.exp(z).sum(axis=2, keepdims=True)
    inner = np.bincount(m.cls, weights=10.0**m.inner, minlength=m.n_classes)
    some = np.bincount(m.cls, minlength=m.n_classes) > 0
    assert inner[some] == pytest.approx(np.ones(some.sum()))
    direct = sum(math.log10(p.reshape(-1, m.n_classes)[k, m.cls[sample[0][k]]]) for k in range(80)) + m.inner[sample[0]].sum()
    assert m.score(sample[0], np.array([80]))[0] == pytest.approx(direct, rel=1e-4)


def brute_removed(texts: dict) -> dict:
    seen, out = set(), {}
    for i in sorted(texts):
        b = texts[i]
        cover = np.zeros(len(b), bool)
        for k in range(len(b) - 99):
            w = b[k : k + 100]
            if w in seen:
                cover[k : k + 100] = True
            seen.add(w)
        out[i] = cover
    return out


@pytest.mark.parametrize("chunk", [suffix.CHUNK, 3])
def test_exact_substrings(docs, empty, chunk, monkeypatch):
    """With a tiny CHUNK every gram with company is crowded and goes by single windows."""
    find = suffix._find
    monkeypatch.setattr(suffix, "_find", lambda n: _with_chunk(find(n), chunk))
    texts = {i: t for i, t in raw(docs).items() if i is not None}
    want = brute_removed(texts)
    for r in suffix.remove_repeats(docs).select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect():
        if r["doc_id"] is None:
            assert r["n_removed"] == 0
            continue
        c = want[r["doc_id"]]
        kept = bytes(np.frombuffer(texts[r["doc_id"]], np.uint8)[~c])
        spans = int((np.diff(c.astype(int), prepend=0) == 1).sum())
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == (len(c), int(c.sum()), spans, kept)
    assert suffix.remove_repeats(empty).count() == 0
    cut = suffix.without_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count() and cut.filter("doc_id = 0 and text is null").count() == 1


def _with_chunk(run, chunk):
    def inner(batches):
        before, suffix.CHUNK = suffix.CHUNK, chunk
        try:
            yield from run(batches)
        finally:
            suffix.CHUNK = before
    return inner


@pytest.mark.parametrize("seed", range(6))
def test_construction_matches_sorting(seed):
    r = np.random.default_rng(seed)
    segs = list({bytes(r.integers(97, 99 + seed % 2, int(r.integers(1, 14))).astype(np.uint8)) for _ in range(12)})
    bwt, lcp, _ = suffix.build(segs)
    order = sorted((s[k:], s[k - 1] + 1 if k else 0) for s in segs for k in range(len(s) + 1))
    common = [0]
    for (a, _), (b, _) in zip(order, order[1:]):
        common.append(next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b))))
    assert lcp.tolist() == common
    assert sorted(bwt.tolist()) == sorted(x[1] for x in order)


def test_long_text_is_searched_in_pieces(spark, monkeypatch):
    r = np.random.default_rng(2)
    long = bytes(r.integers(97, 123, 5000).astype(np.uint8)).decode()
    monkeypatch.setattr(suffix, "PIECE_BYTES", 700)
    rows = list(suffix._pieces([1], [0], [long.encode()]))
    assert sum(max(len(t[0]) - 99, 0) for _, _, t in rows) == 5000 - 99


def test_quality(docs, empty, labels):
    model = quality.train(docs.filter(fold("doc_id", 3) != 1), labels.filter(fold("doc_id", 3) != 1))
    got = quality.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert quality.train(docs, labels.filter("false")) is None and quality.score(empty, model).count() == 0


def test_positive_unlabelled_learning_separates():
    r = np.random.default_rng(0)
    good = [" ".join(r.choice(EN.split(), 50)).encode() for _ in range(300)]
    junk = [" ".join(w + "###" for w in r.choice(EN.split(), 50)).encode() for _ in range(100)]
    pos, unl = quality.features(good[:150]), quality.features(good[150:250] + junk[:50])
    s = quality.Scorer(unl.mean(axis=0), np.maximum(unl.std(axis=0), 0.02))
    s.train(pos, unl, 2 / 3)
    assert (s.score(quality.features(good[250:])) > 0.5).mean() > 0.9 and (s.score(quality.features(junk[50:])) < 0.5).mean() > 0.9


def brute_measures(t: str) -> tuple:
    ws = t.encode().split()
    lines = [x for x in t.encode().split(b"\n") if x.split()]
    tri = collections.Counter(zip(ws, ws[1:], ws[2:]))
    cover = [any(0 <= k < len(ws) - 2 and tri[tuple(ws[k : k + 3])] > 1 for k in (i - 2, i - 1, i)) for i in range(len(ws))]
    return len(ws), sum(len(w.decode()) for w in ws), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), sum(cover)


def test_quality_rules(docs, empty, labels):
    texts = raw(docs)
    got = rules.judge(docs, labels).collect()
    assert len(got) == docs.count()
    for r in got:
        want = brute_measures(texts[r["doc_id"]].decode())
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r["base_failed"] and r["kept"])
    assert rules.judge(empty, labels).count() == 0


def test_binomial_bound_is_exact_and_limits_risk():
    want = sum(math.comb(40, i) * 0.1**i * 0.9 ** (40 - i) for i in range(4))
    assert rules.binomial_cdf(3, 40, 0.1) == pytest.approx(want)
    assert rules.certified([0, 0, 400], 4000, 0.01, 0.01) == 2 and rules.certified([0], 10, 0.01, 0.01) == 0


def test_token_files(docs, empty, spark):
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    folder = rans.write_files(docs, path)
    got = rans.read_files(spark, folder).collect()
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    assert len(got) == len(rows)
    at = 0
    for r, g in zip(rows, sorted(got, key=lambda g: g["start"])):
        ids = lib.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        assert (g["doc_id"], g["start"], g["n_tokens"], g["ids_crc32"]) == (r["doc_id"], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert rans.read_files(spark, rans.write_files(empty, path)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_rans_round_trip(seed):
    r = np.random.default_rng(seed)
    counts = r.integers(0, 900, 3000) ** 2 * (r.random(3000) > 0.3)
    f = rans.frequencies(counts)
    assert f.sum() == 1 << rans.SCALE and ((f > 0) == (counts > 0)).all()
    coder, some = rans.Coder(f), np.flatnonzero(f)
    blocks = [r.choice(some, int(n)).astype(np.uint32) for n in (1, 63, 64, 65, 20000, 50001)]
    made = coder.encode(blocks)
    for a, b in zip(blocks, coder.decode([(len(a), *m) for a, m in zip(blocks, made)])):
        assert (a == b).all()


def test_nearest(spark):
    r = np.random.default_rng(3)
    v = r.normal(size=(900, 16))
    v[100:140] = v[100]  # ties
    rows = [(i, [float(c) for c in x]) for i, x in enumerate(v)] + [(900, None), (920, [0.0] * 16), (940, [None] + [1.0] * 15), (960, [float("nan")] * 16), (980, [1.0]), (None, [1.0] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(df, df.filter("vec_id % 20 = 0")).collect()
    hits = 0
    for q in range(0, 900, 20):
        s = ann.exact(np.repeat(v[q : q + 1], 900, axis=0), v)
        s[q] = -np.inf
        order = np.lexsort((np.arange(900), -s))[:20]
        mine = sorted((g for g in got if g["query_id"] == q), key=lambda g: g["rank"])
        assert [g["score"] for g in mine] == [s[g["vec_id"]] for g in mine] and [g["rank"] for g in mine] == list(range(1, 21))
        hits += len({g["vec_id"] for g in mine} & set(order.tolist()))
    assert len(got) == 45 * 20 and hits >= 0.9 * len(got)
    assert ann.search(df.filter("false"), df).count() == 0
    few = spark.createDataFrame(rows[:4], df.schema)
    assert ann.search(few, few.filter("vec_id = 0")).count() == 3


def brute_components(texts: dict, percent: int = 85) -> dict:
    sets = {}
    for i, t in texts.items():
        ws = t.lower().split()
        sets[i] = {tuple(ws[k : k + 5]) for k in range(max(1, len(ws) - 4))} if ws else set()
    at = {i: i for i in texts}
    for a in sorted(texts):
        for b in sorted(texts):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                lo, hi = sorted((at[a], at[b]))
                at = {k: lo if c == hi else c for k, c in at.items()}
    return {i: (len(sets[i]), at[i]) for i in texts}


def test_near_duplicates(docs, empty):
    got = minhash.near_duplicates(docs).collect()
    want = brute_components({i: t for i, t in raw(docs).items() if i is not None})
    assert len(got) == docs.count()
    for r in got:
        if r["doc_id"] is not None:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (*want[r["doc_id"]], want[r["doc_id"]][1] == r["doc_id"])
    assert minhash.near_duplicates(empty).count() == 0


def test_near_copies_beyond_the_pivot(spark, monkeypatch):
    """A cluster of copies of one text, most of them not linked to one another; blocks of four."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    r = np.random.default_rng(5)
    base = [f"w{i}" for i in range(200)]
    rows = [(100, " ".join(base))]
    for i in range(60):
        ws = list(base)
        for k in r.choice(200, 3, replace=False):
            ws[k] = f"x{i}_{k}"
        rows.append((i if i < 50 else 200 + i, " ".join(ws)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components({i: t.encode() for i, t in rows})
    assert {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df).collect()} == {i: c for i, (_, c) in want.items()}


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(500, 500 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r["id"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{500 + i: 500 for i in range(30)}}


def test_pieces_equal_the_library(docs, empty):
    import sentencepiece

    path = P.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = raw(docs)
    got = pieces.encode(docs, path).collect()
    assert len(got) == docs.count()
    for r in got:
        want = sp.encode(texts[r["doc_id"]].decode(), add_eos=True)
        assert (r["ids"], r["n_tokens"], r["decoded"]) == (want, len(want), sp.decode(want))
    assert pieces.digests(empty, path).count() == 0


def test_pieces_on_random_strings():
    import sentencepiece

    path = P.path("piece_bpe_32k.model")
    sp, m = sentencepiece.SentencePieceProcessor(model_file=path), pieces.model(path)
    r = np.random.default_rng(6)
    for _ in range(300):
        t = "".join(r.choice(list("aabbcc  ▁ \nthein éß漢🙂<s>0"), int(r.integers(1, 50))))
        ids = " ".join(i for i, _ in m.spell(pieces.split_words(t)))
        assert [int(i) for i in ids.split()] == sp.encode(t), t


def test_pipeline_against_brute_force(spark, tmp_path, docs):
    import sentencepiece

    rows = docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = collections.Counter((r["doc_id"], r["n_tokens"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    texts = {i: t for i, t in raw(rows).items() if any(c.isalpha() for c in t.decode())}  # language ID drops texts without a letter
    texts = {i: texts[i] for i, (_, c) in brute_components(texts, corpus_pipeline.NEAR_PERCENT).items() if c == i}
    gone = brute_removed(texts)
    texts = {i: bytes(np.frombuffer(t, np.uint8)[~gone[i]]).decode(errors="ignore") for i, t in texts.items()}
    mixed = spark.createDataFrame([(i, t, s) for i, t, s in ((r["doc_id"], texts.get(r["doc_id"]), r["source"]) for r in rows.collect()) if t is not None], "doc_id long, text string, source string")
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    want: collections.Counter = collections.Counter()
    for r in mixing.mix(mixed).collect():  # itself held against its rule above
        ids = sp.encode(texts[r["doc_id"]], add_eos=True)
        if r["copies"]:
            want[r["doc_id"], len(ids), hashlib.sha256(sp.decode(ids).encode()).hexdigest()] += r["copies"]
    assert got == want
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "exact_substrings", "mix_sources", "encode_pieces"]
