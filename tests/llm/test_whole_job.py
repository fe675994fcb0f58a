"""Operators and stages do the whole job: each case is one that an earlier form left out."""

from __future__ import annotations

from collections import Counter

import numpy as np

import corpus_pipeline
from cyclewise.llm import ann, minhash, rules, suffix


def _shingles(text: str) -> set:
    ws = text.split()
    return {tuple(ws[k : k + 5]) for k in range(len(ws) - 4)}


def _kept(texts: dict[int, str], percent: int) -> set[int]:
    """Smallest id of every component of links, by brute force."""
    sets, at = {i: _shingles(t) for i, t in texts.items()}, {i: i for i in texts}
    for a in texts:
        for b in texts:
            if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                lo, hi = sorted((at[a], at[b]))
                at = {k: lo if c == hi else c for k, c in at.items()}
    return set(at.values())


def test_near_duplicate_stage_links_from_80_percent(spark):
    """Pairs whose similarity runs from 0.70 to 0.95, many of them between 0.80 and 0.85."""
    r = np.random.default_rng(8)
    texts, between = {}, 0
    for g in range(60):
        base = [f"g{g}w{i}" for i in range(200)]
        other = list(base)
        for k in r.choice(np.arange(5, 195, 6), 1 + g % 7, replace=False):
            other[k] = f"g{g}x{k}"
        texts[2 * g], texts[2 * g + 1] = " ".join(base), " ".join(other)
        x, y = _shingles(texts[2 * g]), _shingles(texts[2 * g + 1])
        between += 0.80 <= len(x & y) / len(x | y) < 0.85
    assert between >= 5
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    assert kept == _kept(texts, 80) and len(kept) < len(_kept(texts, 85))
    at85 = {r["doc_id"] for r in minhash.near_duplicates(docs, percent=85).filter("kept").collect()}
    assert at85 == _kept(texts, 85)


def test_agreement_follows_the_similarity():
    assert minhash.agree(85) == 94 and minhash.agree(80) == 83


def test_junk_is_rejected_in_languages_with_few_labels(spark):
    """Four languages of 260 labelled good documents each, none with a symbol; the junk has one in three words."""
    r = np.random.default_rng(9)
    rows, labels = [], []
    for k, lang in enumerate(["de", "en", "es", "fr"]):
        for j in range(280):
            i = 1000 * k + j
            ws = [f"{lang}{x}word" for x in r.integers(0, 10**6, 80)]
            rows.append((i, " ".join(w + "#" * (j >= 260 and at % 3 == 0) for at, w in enumerate(ws)), lang))
            if j < 270:
                labels.append((i, int(j < 260)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = rules.judge(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert not any(x["base_failed"] for x in got)
    assert {x["doc_id"] for x in got if not x["kept"]} == {i for i, _, _ in rows if i % 1000 >= 260}


def test_rule_vectors():
    """Levels: cutoffs exceeded by a document for each of the five rules (of 8, 8, 8, 7 and 5)."""
    clean, junk = (0, 0, 0, 0, 0), (4, 0, 0, 0, 0)
    way = rules.path(Counter({junk: 10}))
    assert all(sum(b) == sum(a) + 1 and all(x <= y for x, y in zip(a, b)) for a, b in zip(way, way[1:]))
    assert way[4] == (5, 0, 0, 0, 0) and way[-1] == (8, 8, 8, 7, 5)
    assert rules.refused((4, 0, 0, 0, 0), Counter({junk: 10})) == 0 and rules.refused((5, 0, 0, 0, 0), Counter({junk: 10})) == 10
    level = rules.DELTA / 4
    assert rules.choose(Counter({clean: 217}), Counter({junk: 10}), rules.RISK, level)[0] == 8
    assert rules.choose(Counter({clean: 216}), Counter({junk: 10}), rules.RISK, level) == clean
    # good documents with many symbols end the path at once; the other rules are still certified alone
    got = rules.choose(Counter({clean: 3000, (8, 0, 0, 0, 0): 1000}), Counter({junk: 10, (0, 3, 0, 0, 0): 5}), rules.RISK, level)
    assert got == (0, 8, 8, 7, 5)


def test_rules_hold_the_risk():
    """Good documents of which just RISK are refused: certified in no more than the level of samples."""
    r = np.random.default_rng(10)
    wrong = 0
    for _ in range(2000):
        k = int(r.binomial(2000, rules.RISK))
        v = rules.choose(Counter({(0,) * 5: 2000 - k, (8, 0, 0, 0, 0): k}), Counter({(8, 0, 0, 0, 0): 3}), rules.RISK, 0.05)
        wrong += v[0] > 0
    assert wrong <= 0.05 * 2000


def test_rows_of_one_id_with_other_texts_keep_their_own_bytes(spark):
    """A text loses what it repeats itself, never what another text with its id repeats."""
    r = np.random.default_rng(11)
    passage = "".join(r.choice(list("abcdefgh"), 300))
    a, b, c = "".join(r.choice(list("ijkl"), 161)), "".join(r.choice(list("mnop"), 125)), "".join(r.choice(list("qrst"), 200))
    rows = [(1, passage + c), (2, passage + a), (2, b), (2, b), (3, a), (4, b + passage), (None, passage)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(x["row"]["doc_id"], x["n_bytes"]): (x["n_removed"], x["n_spans"], bytes(x["kept"]).decode()) for x in suffix.remove_repeats(df).collect()}
    assert got[1, 500] == (0, 0, passage + c)
    assert got[2, 461] == (300, 1, a) and got[2, 125] == (0, 0, b)
    assert got[3, 161] == (161, 1, "") and got[4, 425] == (425, 1, "") and got[None, 300][0] == 0
    left = suffix.without_repeats(df).collect()
    assert sorted(x["text"] for x in left if x["doc_id"] == 2) == sorted([a, b, b])


def test_language_stage_without_labels_keeps_documents(spark):
    rows = [(i, f"clean document number {i}", None) for i in range(20)] + [(30, "123 !", None), (31, None, None), (32, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(x["doc_id"] for x in corpus_pipeline.language_id(spark, docs, "").collect()) == list(range(20))


def test_a_stray_longer_vector_takes_no_row_away(spark):
    r = np.random.default_rng(12)
    x = r.normal(size=(200, 8))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)] + [(500, [1.0] * 9)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(vectors, vectors.filter("vec_id % 20 = 0")).collect()
    assert len(got) == 200 and {g["query_id"] for g in got} == set(range(0, 200, 20)) and all(g["vec_id"] < 200 for g in got)


def test_nearest_with_crowded_vectors_and_many_shards(spark, monkeypatch):
    """A third of all rows are copies of one vector, another third lies close together; small shards are split."""
    monkeypatch.setattr(ann, "SHARD_ROWS", 200)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 150)
    monkeypatch.setattr(ann, "SAMPLE_ROWS", 1000)
    r = np.random.default_rng(13)
    x = np.concatenate([np.repeat(r.normal(size=(1, 12)), 1500, axis=0), r.normal(size=(1, 12)) + 0.05 * r.normal(size=(1500, 12)), r.normal(size=(1500, 12))])
    ids = r.permutation(len(x))
    vectors = spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    got: dict = {}
    for g in ann.search(vectors, vectors.filter("vec_id % 50 = 0")).collect():
        got.setdefault(g["query_id"], []).append(g)
    assert len(got) == 90
    hits = 0.0
    for i, v in zip(ids, x):
        if i % 50:
            continue
        s = ann.exact(np.repeat(v[None, :], len(x), axis=0), x)
        s[ids == i] = -np.inf
        order = np.lexsort((ids, -s))[:20]
        mine = sorted(got[i], key=lambda g: g["rank"])
        place = dict(zip(ids.tolist(), s.tolist()))
        assert len({g["vec_id"] for g in mine}) == len(mine) == 20 and [g["score"] for g in mine] == [place[g["vec_id"]] for g in mine]
        assert [(-g["score"], g["vec_id"]) for g in mine] == sorted((-g["score"], g["vec_id"]) for g in mine)
        hits += len({g["vec_id"] for g in mine} & set(ids[order].tolist())) / 20
    assert hits >= 0.9 * 90


def test_nearest_visits_a_falling_share():
    """The share of rows that the tables' visited buckets hold falls as rows are added; every found row is in a visited shard."""
    r = np.random.default_rng(14)
    x = r.normal(size=(40_000, 16))
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    shares = []
    for n in (1000, 40_000):
        rows, q = x[:n], np.arange(0, n, n // 40)
        s = x[q] @ rows.T
        s[np.arange(len(q)), q] = -np.inf
        near = np.argpartition(-s, 20, axis=1)[:, :20]
        index = ann.Index(n, 1.0, 16, rows[:2000])
        index.fit(np.repeat(x[q], 20, axis=0), rows[near.reshape(-1)])
        shares.append(index.share)
        qa, xa = index.queries(x[q]), index.rows(rows)
        far = index.far(qa)
        for t in range(ann.TABLES):
            key = index.key(index.cells(xa, t), t)
            went = set(zip(*(a.tolist() for a in index.visits(qa, far, t))))
            seen = index.costs(qa, index.cells(xa, t), t) <= far[:, t, None]
            at, of = np.nonzero(seen)
            assert set(zip(at.tolist(), key[of].tolist())) <= went
            few = np.arange(len(at))[:500]
            assert np.allclose(index.pairs(qa, xa, at[few], of[few], t), index.costs(qa, index.cells(xa, t), t)[at[few], of[few]])
    assert shares[1] < 0.6 * shares[0]


def test_pieces_merge_few_words_at_a_time(monkeypatch):
    import public_tokenizers
    import pyarrow as pa

    from cyclewise.llm import pieces

    path = public_tokenizers.path("piece_bpe_32k.model")
    sizes, spell = [], pieces.Model.spell
    monkeypatch.setattr(pieces.Model, "spell", lambda m, words: sizes.append(sum(map(len, words))) or spell(m, words))
    texts = [" ".join(f"w{i}x{j}" for j in range(3000)) for i in range(20)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(20)), pa.array(texts)], ["row", "text"])
    got = [r for b in pieces._encode(path)(iter([batch])) for r in b.to_pylist()]
    assert max(sizes) <= 150_000 and sum(sizes) > 400_000  # the arrays of a merge grow with these characters
    assert [r["decoded"] for r in got] == texts
