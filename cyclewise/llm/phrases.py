"""Operator 12: collocations from a full-text index over word ids in every shard.

1. Texts are cut into pieces and words; a shard is up to ``SHARD_WORDS`` words of one language in one
   row: word numbers, 0 at the end of every piece, and its own vocabulary.
2. Words with ``min_count`` occurrences over all shards get global numbers; in the shards all other
   words become breaks, as no phrase with one of them can reach ``min_count``.
3. Every shard builds a Burrows-Wheeler transform of its word numbers and of their reverse (suffixes
   sorted by their first ``MAX_WORDS`` words, which is all that the enumeration asks for).  A phrase
   is an interval in both; extending all intervals of a level by one word, to the left or to the
   right, counts the words beside them in one pass and keeps both intervals in step.
4. Level by level, the counts of a shard are dealt by phrase to buckets, summed, and the phrases of
   ``min_count`` and more go back to the shards that hold them.  The next level extends these alone,
   and keeps an extension only if the part without its other end is among them too.
5. The scores, the containment rule and the ranking are joins over the phrases found.

All counts are exact: nothing is dropped that could reach ``min_count``.  A phrase is two 64-bit
numbers (four global word numbers), so keys never collide.  A shard sends a phrase once however often
it holds it, so a frequent phrase weighs no more than the number of shards.

Results for odd input: null or empty texts have no words; a null language is ``und``, together with
documents that carry that name; rows that repeat an id are separate texts; pieces without a word are
skipped; an empty table gives no rows.  Only the text and language columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise, numbered, partitions_for, ragged, slices, tidy, utf8

MIN_COUNT = 30
MAX_WORDS = 4
TOP = 2000
SCALE = 2_000_000
CONTAINED_PERCENT = 80
SHARD_WORDS = 1_500_000
BUCKET_BYTES = 24 << 20
SLICE_PHRASES = 200_000  # phrases that one task ranks at first

# What ends a piece, as bytes of lower-cased text.
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_FOLD = bytes.maketrans(_ENDS, b"." * len(_ENDS))


class _Numbers(dict):
    """Word -> number in the order of first sight; the break comes first, as 0."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _row(part: int, nth: int, lang: str, vocabulary: _Numbers, texts: list[np.ndarray]) -> pa.RecordBatch:
    ids = np.concatenate(texts)
    counts = np.bincount(ids, minlength=len(vocabulary) + 1)[1:]
    return pa.RecordBatch.from_arrays(
        [pa.array([part << 24 | nth], pa.int64()), pa.array([lang]), pa.array([ids.tobytes()], pa.binary()),
         pa.array([[w.decode() for w in vocabulary]], pa.list_(pa.string())), pa.array([counts.tolist()], pa.list_(pa.int64())),
         pa.array([int(counts.sum())], pa.int64())],
        ["shard", "lang", "ids", "words", "counts", "size"])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, nth, held = TaskContext.get().partitionId(), 0, 0
    open_: dict[str, tuple[_Numbers, list[np.ndarray]]] = {}
    for b in slices(batches, "text"):
        for lang, text in zip(b.column("lang").to_pylist(), utf8(b.column("text"))):
            tokens = text.lower().translate(_FOLD).replace(b".", b" . ").split()
            if not tokens:
                continue
            vocabulary, texts = open_.setdefault(lang, (_Numbers({b".": 0}), []))
            ids = np.fromiter(map(vocabulary.__getitem__, tokens), np.int32, len(tokens))
            texts.append(np.append(ids, np.int32(0)))
            held += len(tokens)
            if held >= SHARD_WORDS:
                for key, (v, t) in open_.items():
                    yield _row(part, nth, key, *_closed(v, t))
                    nth += 1
                open_, held = {}, 0
    for key, (v, t) in open_.items():
        yield _row(part, nth, key, *_closed(v, t))
        nth += 1


def _closed(vocabulary: _Numbers, texts: list[np.ndarray]) -> tuple[_Numbers, list[np.ndarray]]:
    """Without the break, which is no word."""
    del vocabulary[b"."]
    return vocabulary, texts


def _order(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of non-negative keys, and the keys in it: one sort of (key, place) as a single number where both fit."""
    bits = len(key).bit_length()
    if len(key) and int(key.max()) < 1 << (63 - bits):
        both = np.sort(key << bits | np.arange(len(key)))
        return both & ((1 << bits) - 1), both >> bits
    order = np.argsort(key, kind="stable")
    return order, key[order]


def _counted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs."""
    key = np.sort(key)
    at = np.flatnonzero(np.diff(key, prepend=-1))
    return key[at], np.diff(np.append(at, len(key)))


class Index:
    """Both Burrows-Wheeler transforms of word numbers; 0 is the break between pieces."""

    def __init__(self, ids: np.ndarray):
        order, sorted_ = _order(np.concatenate([[0], ids, [0]]).astype(np.int64))
        new = np.diff(sorted_, prepend=-1) > 0
        self.gids = sorted_[new]
        t = np.empty(len(order), np.int64)
        t[order] = np.cumsum(new) - 1
        self.n, self.v = len(t), len(self.gids)
        self.first = np.append(np.flatnonzero(new), self.n)
        self.sides = (self._transform(t), self._transform(t[::-1]))

    def _transform(self, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol before every suffix in sorted order, and the (symbol, place) pairs in order."""
        order, sorted_ = _order(t * self.v + np.roll(t, -1))
        two = np.empty(self.n, np.int64)
        two[order] = np.cumsum(np.diff(sorted_, prepend=-1) > 0) - 1
        order, _ = _order(two * (int(two.max()) + 1) + np.roll(two, -2))
        before = t[order - 1]
        return before, np.sort(before * (self.n + 1) + np.arange(self.n))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The intervals of all single words: (phrases, start forward, start backward, size)."""
        w = np.arange(1, self.v)
        return w[:, None], self.first[w], self.first[w], self.first[w + 1] - self.first[w]

    def extend(self, found, left: bool):
        """All extensions of the intervals by one word on one side, both intervals kept in step."""
        phrases, fwd, back, size = found
        before, pairs = self.sides[0 if left else 1]
        here, there = (fwd, back) if left else (back, fwd)
        owner = np.repeat(np.arange(len(size)), size)
        kinds, counts = _counted(owner * self.v + before[ragged(here, size)])
        own, word = np.divmod(kinds, self.v)
        ends = np.cumsum(counts)
        smaller = ends - counts  # occurrences beside smaller words, of this interval and those before it
        start = np.searchsorted(own, own)
        smaller = smaller - smaller[start] if len(own) else smaller
        keep = word > 0
        own, word, counts, smaller = own[keep], word[keep], counts[keep], smaller[keep]
        rank = np.searchsorted(pairs, word * (self.n + 1) + here[own])  # pairs of smaller words are first[word] many
        step, other = rank, there[own] + smaller
        grown = np.concatenate([word[:, None], phrases[own]] if left else [phrases[own], word[:, None]], axis=1)
        return (grown, step, other, counts) if left else (grown, other, step, counts)

    def keys(self, phrases: np.ndarray) -> np.ndarray:
        """Phrases as (n, 2) numbers made of the global word numbers."""
        g = np.zeros((len(phrases), 4), np.int64)
        g[:, : phrases.shape[1]] = self.gids[phrases]
        return np.stack([g[:, 0] << 32 | g[:, 1], g[:, 2] << 32 | g[:, 3]], axis=1)


def _mixed(keys: np.ndarray) -> np.ndarray:
    return (keys[:, 0].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (keys[:, 1].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def _within(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which rows of ``keys`` may be rows of ``known`` (by hash): none of those is missed, and one too many
    is counted for nothing, as its sum decides."""
    if not len(known):
        return np.zeros(len(keys), bool)
    index, probe = np.sort(_mixed(known)), _mixed(keys)
    return index[np.minimum(np.searchsorted(index, probe), len(index) - 1)] == probe


def enumerate_level(ids: np.ndarray, known: dict[int, np.ndarray], level: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of the phrases of ``level`` words; ``known[k]`` are the keys of the frequent ones of k < level."""
    if len(ids) < level:
        return np.zeros((0, 2), np.int64), np.zeros(0, np.int64)
    index = Index(ids)
    found = index.words()
    for n in range(2, level + 1):
        found = index.extend(found, left=n % 2 == 0)
        if n > 2:  # the frequent part that the extension was not made from
            other = found[0][:, :-1] if n % 2 == 0 else found[0][:, 1:]
            keep = _within(index.keys(other), known[n - 1])
            found = tuple(x[keep] for x in found)
        if n < level:
            keep = _within(index.keys(found[0]), known[n])
            found = tuple(x[keep] for x in found)
    return index.keys(found[0]), found[3]


def _renumber(shard: pa.Table, pairs: pa.Table) -> pa.Table:
    """A shard with global word numbers; rare words are breaks, and runs of breaks one."""
    out = []
    for blob in shard.column("ids").to_pylist():
        ids = np.frombuffer(blob, np.int32)
        to = np.zeros(int(ids.max(initial=0)) + 1, np.int32)
        to[pairs.column("local").to_numpy()] = pairs.column("word").to_numpy()
        ids = to[ids]
        out.append(ids[(ids > 0) | (np.concatenate([[1], ids[:-1]]) > 0)].tobytes())
    return pa.table({"shard": shard.column("shard"), "ids": pa.array(out, pa.binary())})


def _numbers(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.int64)


def _counter(level: int, buckets: int):
    """Of a shard and what came back to it: the phrases of ``level`` words with their counts, one row per bucket."""

    def run(shards: pa.Table, back: pa.Table) -> pa.Table:
        known = {}
        for n in range(2, level):
            mine = back.filter(pa.compute.equal(back.column("level"), n))
            known[n] = np.stack([_numbers(mine.column("hi").to_pylist()), _numbers(mine.column("lo").to_pylist())], axis=1)
        rows: dict[str, list] = {"bucket": [], "shard": [], "hi": [], "lo": [], "n": []}
        for shard, blob in zip(shards.column("shard").to_pylist(), shards.column("ids").to_pylist()):
            keys, counts = enumerate_level(np.frombuffer(blob, np.int32), known, level)
            order, bucket = _order(((_mixed(keys) >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64))
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            for at, part in zip([0, *cuts.tolist()], np.split(order, cuts)) if len(order) else ():
                rows["bucket"].append(int(bucket[at]))
                rows["shard"].append(shard)
                rows["hi"].append(keys[part, 0].tobytes())
                rows["lo"].append(keys[part, 1].tobytes() if level > 2 else b"")
                rows["n"].append(counts[part].astype(np.int64).tobytes())
        kinds = {"bucket": pa.int64(), "shard": pa.int64(), "hi": pa.binary(), "lo": pa.binary(), "n": pa.binary()}
        return pa.table({c: pa.array(v, kinds[c]) for c, v in rows.items()})

    return run


def _summer(level: int, least: int):
    """Of a bucket: the frequent phrases with their sums (shard null), and those of every shard."""

    def run(bucket: pa.Table) -> pa.Table:
        shards, blobs = bucket.column("shard").to_pylist(), bucket.column("hi").to_pylist()
        hi, n = _numbers(blobs), _numbers(bucket.column("n").to_pylist())
        lo = _numbers(bucket.column("lo").to_pylist()) if level > 2 else np.zeros(len(hi), np.int64)
        order = np.lexsort((lo, hi)) if level > 2 else np.argsort(hi, kind="stable")
        new = np.ones(len(hi), bool)
        new[1:] = (hi[order][1:] != hi[order][:-1]) | (lo[order][1:] != lo[order][:-1])
        at = np.flatnonzero(new)
        total = np.add.reduceat(n[order], at) if len(at) else n
        good = total >= least
        rows: dict[str, list] = {"shard": [None], "level": [level], "hi": [hi[order][at][good].tobytes()], "lo": [lo[order][at][good].tobytes()],
                                 "n": [total[good].tobytes()]}
        if level < MAX_WORDS:
            of = np.empty(len(hi), np.int64)
            of[order] = np.cumsum(new) - 1
            keep, end = good[of] if len(of) else np.zeros(0, bool), 0
            for shard, blob in zip(shards, blobs):
                part = slice(end, end + len(blob) // 8)
                end = part.stop
                if keep[part].any():
                    for c, v in (("shard", shard), ("level", level), ("hi", hi[part][keep[part]].tobytes()), ("lo", lo[part][keep[part]].tobytes()), ("n", None)):
                        rows[c].append(v)
        kinds = {"shard": pa.int64(), "level": pa.int64(), "hi": pa.binary(), "lo": pa.binary(), "n": pa.binary()}
        return pa.table({c: pa.array(v, kinds[c]) for c, v in rows.items()})

    return run


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for level, hi, lo, n in zip(*(b.column(c).to_pylist() for c in ("level", "hi", "lo", "n"))):
            hi, lo, n = _numbers([hi]), _numbers([lo]), _numbers([n])
            for at in range(0, len(hi), 100_000):
                part = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hi[part]), level), pa.int32()), pa.array(hi[part]), pa.array(lo[part]), pa.array(n[part])],
                                                 ["level", "hi", "lo", "f"])


def counts(df: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words, totals, phrases): (word, lang, text, f) of frequent words, (lang, n), and (level, hi, lo, f) of frequent phrases."""
    spark = df.sparkSession
    named = df.select(F.col(text_col).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    shards = materialise(named.mapInArrow(tidy(_shards), "shard long, lang string, ids binary, words array<string>, counts array<long>, size long"))
    totals = shards.groupBy("lang").agg(F.sum("size").alias("n"))
    entries = shards.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts"))).select(
        "shard", "lang", (F.col("pos") + 1).cast("int").alias("local"), F.col("col.words").alias("text"), F.col("col.counts").alias("n"))
    frequent = entries.groupBy("lang", "text").agg(F.sum("n").alias("f")).filter(F.col("f") >= min_count)
    words = materialise(numbered(frequent, "word", 1))
    pairs = entries.join(words, ["lang", "text"]).select(F.col("shard").alias("of"), "local", F.col("word").cast("int").alias("word"))
    numbers = materialise(shards.select("shard", "ids").groupBy("shard").cogroup(pairs.groupBy("of")).applyInArrow(_renumber, "shard long, ids binary"))
    size = numbers.agg(F.coalesce(F.sum(F.length("ids")), F.lit(0))).first()[0] / 4
    buckets = partitions_for(size * 24, BUCKET_BYTES, spark)
    back = spark.createDataFrame([], "shard long, level long, hi binary, lo binary, n binary")
    phrases = None
    for level in range(2, MAX_WORDS + 1):
        sent = numbers.groupBy("shard").cogroup(back.groupBy("shard")).applyInArrow(_counter(level, buckets), "bucket long, shard long, hi binary, lo binary, n binary")
        got = materialise(sent.groupBy("bucket").applyInArrow(_summer(level, min_count), "shard long, level long, hi binary, lo binary, n binary"))
        found = got.filter("shard is null").mapInArrow(_rows, "level int, hi long, lo long, f long")
        phrases = found if phrases is None else phrases.unionByName(found)
        back = back.unionByName(got.filter("shard is not null"))
    return words, totals, phrases


def _part(first: int, last: int) -> str:
    """SQL of the key made of words first .. last of w1 .. w4, as (hi, lo)."""
    w = [f"w{i}" for i in range(first, last + 1)] + ["0L"] * (4 - (last - first + 1))
    return f"struct(shiftleft({w[0]}, 32) | {w[1]} AS hi, shiftleft({w[2]}, 32) | {w[3]} AS lo)"


def collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the first ``top`` collocations of each language."""
    words, totals, phrases = counts(df, text_col, lang_col, min_count)
    phrases = materialise(phrases)
    mask = "4294967295L"
    found = phrases.selectExpr("level", "hi", "lo", "f AS a", "shiftrightunsigned(hi, 32) AS w1", f"hi & {mask} AS w2", "shiftrightunsigned(lo, 32) AS w3", f"lo & {mask} AS w4")
    # a word more on either side suffices: any longer phrase holds one of those, at least as often
    inner = None
    for level in range(3, MAX_WORDS + 1):
        longer = found.filter(F.col("level") == level).selectExpr(f"explode(array({_part(1, level - 1)}, {_part(2, level)})) AS k", "a AS longest")
        inner = longer if inner is None else inner.unionByName(longer)
    inner = inner.groupBy(F.col("k.hi").alias("hi"), F.col("k.lo").alias("lo")).agg(F.max("longest").alias("longest"))
    left = found.join(inner, ["hi", "lo"], "left").filter(f"longest IS NULL OR 100 * CAST(longest AS DECIMAL(20, 0)) < {CONTAINED_PERCENT} * CAST(a AS DECIMAL(20, 0))").drop("longest")
    cuts = [", ".join(f"struct({k} AS k, {_part(1, k)} AS head, {_part(k + 1, level)} AS tail)" for k in range(1, level)) for level in range(2, MAX_WORDS + 1)]
    cut = left.selectExpr("*", f"explode(CASE level WHEN 2 THEN array({cuts[0]}) WHEN 3 THEN array({cuts[1]}) ELSE array({cuts[2]}) END) AS c")
    parts = phrases.select("hi", "lo", "f").unionByName(words.selectExpr("shiftleft(word, 32) AS hi", "0L AS lo", "f"))
    heads = parts.selectExpr("hi AS hhi", "lo AS hlo", "f AS l")
    tails = parts.selectExpr("hi AS thi", "lo AS tlo", "f AS r")
    scored = cut.join(heads, (F.col("c.head.hi") == F.col("hhi")) & (F.col("c.head.lo") == F.col("hlo"))).join(
        tails, (F.col("c.tail.hi") == F.col("thi")) & (F.col("c.tail.lo") == F.col("tlo")))
    scored = scored.withColumn("score", F.expr(f"(CAST({SCALE} AS DECIMAL(8, 0)) * CAST(a AS DECIMAL(19, 0))) DIV (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))"))
    best = scored.groupBy("hi", "lo", "level", "w1", "w2", "w3", "w4", "a").agg(F.min(F.struct("score", F.col("c.k").alias("k"), "l", "r")).alias("b"))
    # before words are looked up, those that cannot be among the first go: in slices of a language, then in
    # what is left of it; ties at the end stay for the phrases to decide
    slices_ = 1 + phrases.count() // SLICE_PHRASES
    lang_of = words.select(F.col("word").alias("w1"), "lang", F.col("text").alias("t1"))
    ranked = best.join(lang_of, "w1").withColumn("slice", F.pmod(F.xxhash64("hi", "lo"), F.lit(slices_)))
    for keys in (["lang", "slice"], ["lang"]):
        ranked = ranked.withColumn("upto", F.rank().over(Window.partitionBy(*keys).orderBy(F.desc("b.score"), F.desc("a")))).filter(F.col("upto") <= top)
    for i in range(2, MAX_WORDS + 1):
        ranked = ranked.join(words.select(F.col("word").alias(f"w{i}"), F.col("text").alias(f"t{i}")), f"w{i}", "left")
    out = ranked.select("lang", F.concat_ws(" ", "t1", "t2", "t3", "t4").alias("phrase"), "a", "b.l", "b.r", "b.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).join(totals, "lang")
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
