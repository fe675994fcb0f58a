"""Operator 9: near duplicates by min-max hashing.

Each of ``PERMUTATIONS`` hash functions is evaluated once per shingle, and both its minimum and
its maximum are kept: twice the signature for the same work.  Bands of ``ROWS`` values are the
candidate keys.  Documents with one and the same shingle set are one class from the start, so
copies never meet in a bucket.  Within a bucket every class is compared with one pivot, twice;
links join classes into components.  Buckets that still hold several components are compared in
pairs of bounded blocks, and each block pair gives only a spanning forest of its links.  So no
bucket emits all its pairs, and no candidate link between different components is left out.
Links are confirmed on the full sets of 64-bit shingle hashes.

The similarity of a link is an argument.  At 0.85 a pair misses all 24 bands with probability
(1 - 0.85^6)^24 = 1.2e-5, at 0.80 with (1 - 0.80^6)^24 = 6.8e-4.

Results for odd input: null text and text without words have an empty set, link with nothing and
form a component of their own; fewer than five words count as one shingle; rows that repeat an id
each get a row; a null id keeps its row with a null component; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, slices, tidy, utf8
from .components import components

PERMUTATIONS = 72
BANDS = 24
ROWS = 6
WORDS = 5
PERCENT = 85  # the similarity of op9
BLOCK = 512  # members in a block of a large bucket

_rng = np.random.default_rng(20240607)
_MUL = _rng.integers(0, 2**32, PERMUTATIONS, dtype=np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 2**32, PERMUTATIONS, dtype=np.uint32)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def agree(percent: int) -> int:
    """Signature values (of 2 x PERMUTATIONS) that must agree before sets are compared.

    6.6 binomial deviations below the mean of a pair at the threshold: 94 at 85, 83 at 80."""
    n, p = 2 * PERMUTATIONS, percent / 100
    return max(0, math.floor(n * p - 6.6 * math.sqrt(n * p * (1 - p))))


class _WordHash(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _WordHash()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: bytes, words: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the word shingles of a whole text."""
    ws = text.lower().split()
    if not ws:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, ws), np.uint64, len(ws))
    n = min(words, len(ws))
    out = h[: len(h) - n + 1].copy()
    for i in range(1, n):
        out = out * _BASE + h[i : len(h) - n + 1 + i]
    if n < words:  # a short sequence never equals a full shingle
        out = out * _BASE + np.uint64(n)
    return np.unique(mix64(out))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minimum and then maximum of every permutation over the set: 2 x PERMUTATIONS values."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low, high = np.full(PERMUTATIONS, 2**32 - 1, np.uint32), np.zeros(PERMUTATIONS, np.uint32)
    for i in range(0, len(x), 4096):
        v = _MUL[:, None] * x[None, i : i + 4096] + _ADD[:, None]
        np.minimum(low, v.min(axis=1), out=low)
        np.maximum(high, v.max(axis=1), out=high)
    return np.concatenate([low, high])


def bands(sig: np.ndarray) -> np.ndarray:
    """(n, 2 x PERMUTATIONS) signatures -> (n, BANDS) 64-bit keys; the band number is part of a key."""
    v = sig.astype(np.uint64).reshape(len(sig), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), v.shape[:2]).copy()
    for r in range(ROWS):
        key = mix64(key * _BASE + v[:, :, r])
    return key.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text"):
        sets = [shingle_set(t) for t in utf8(b.column("text"))]
        sig = np.stack([signature(s) for s in sets])
        some = np.array([len(s) > 0 for s in sets])
        prints = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
        keys = bands(sig)
        yield pa.RecordBatch.from_arrays([
            b.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints, pa.binary()),
            pa.array([k.tolist() if ok else [] for k, ok in zip(keys, some)], pa.list_(pa.int64())),
            pa.array([(s & np.uint32(255)).astype(np.uint8).tobytes() for s in sig], pa.binary())],
            ["id", "n_shingles", "print", "bands", "sketch"])
    _HASHES.clear()  # a reused worker keeps no words for the stages that follow


def _close(percent: int):
    """Keep the pairs whose sketches agree in enough values and whose set sizes allow a link."""
    least = agree(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                s, t = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(b.num_rows, -1) for c in ("sa", "sb"))
                n, m = (b.column(c).to_numpy() for c in ("na", "nb"))
                ok = ((s == t).sum(axis=1) >= least) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))
                yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(ok))
    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text"):
        found = [shingle_set(t).view(np.int64) for t in utf8(b.column("text"))]
        at = np.cumsum([0, *map(len, found)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([b.column("id"), pa.ListArray.from_arrays(at, pa.array(np.concatenate(found), pa.int64()))], ["id", "s"])
    _HASHES.clear()


def _links(pairs: DataFrame, reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are links: sketches first, then the full sets."""
    side = reps.select("id", "n_shingles", "sketch")
    near = (pairs.join(side.toDF("a", "na", "sa"), "a").join(side.toDF("b", "nb", "sb"), "b")
            .mapInArrow(tidy(_close(percent)), "a long, b long"))
    both = near.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return both.select("a", "b", shared.alias("i"), (F.size("x") + F.size("y") - shared).alias("u")).filter(
        F.col("i") * 100 >= F.col("u") * percent).select("a", "b")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows with one (band, i, j), which arrive sorted; a run is bounded by two blocks."""
    held = None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b] if held is None else [held, b]).combine_chunks().to_batches()[0]
        key = np.stack([t.column(c).to_numpy() for c in ("band", "i", "j")])
        cut = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        for x, y in zip([0, *cut[:-1].tolist()], cut.tolist()):
            yield t.slice(x, y - x)
        held = t.slice(int(cut[-1]) if len(cut) else 0)
    if held is not None:
        yield held


def _across(b: pa.RecordBatch) -> np.ndarray:
    """Pairs of a block pair that are to be compared: different components and, for two blocks, one of each."""
    comp, block = b.column("component").to_numpy(), b.column("block").to_numpy()
    ok = comp[:, None] != comp[None, :]
    if b.column("i")[0].as_py() != b.column("j")[0].as_py():
        ok &= block[:, None] != block[None, :]
    return ok


def _hopeful(percent: int):
    """Members of a block pair whose sketch allows a link to a member of another component."""
    least = agree(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches):
            s = np.frombuffer(b"".join(b.column("sketch").to_pylist()), np.uint8).reshape(b.num_rows, -1)
            n = b.column("n_shingles").to_numpy()
            ok = _across(b)
            ok &= 100 * np.minimum(n[:, None], n[None, :]) >= percent * np.maximum(n[:, None], n[None, :])
            some = np.zeros(len(s), bool)
            for k in np.flatnonzero(ok.any(axis=1)).tolist():
                some[k] = ((s[ok[k]] == s[k]).sum(axis=1) >= least).any()
            if some.any():
                yield b.filter(pa.array(some)).select(["band", "i", "j", "block", "id", "component"])
    return run


def _forest(ok: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric link matrix."""
    seen, out = np.zeros(len(ok), bool), []
    for root in range(len(ok)):
        todo = [] if seen[root] else [root]
        seen[root] = True
        while todo:
            k = todo.pop()
            new = np.flatnonzero(ok[k] & ~seen)
            seen[new] = True
            out += [(k, m) for m in new.tolist()]
            todo += new.tolist()
    return out


def _confirm(percent: int):
    """Exact comparison inside a block pair; a spanning forest of its links goes out, never all of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches):
            n = b.num_rows
            lists = b.column("s")
            size = pc.list_value_length(lists).to_numpy().astype(np.int64)
            owner = np.repeat(np.arange(n), size)
            kinds, col = np.unique(lists.flatten().to_numpy(), return_inverse=True)
            order = np.argsort(col, kind="stable")
            col, owner = col[order], owner[order]
            shared = np.zeros((n, n), np.float32)
            for c in range(0, len(kinds), 4096):
                x, y = np.searchsorted(col, [c, c + 4096])
                m = np.zeros((n, 4096), np.float32)
                m[owner[x:y], col[x:y] - c] = 1
                shared += m @ m.T
            ok = _across(b) & (100 * shared >= percent * (size[:, None] + size[None, :] - shared))
            edges = _forest(ok)
            if edges:
                ids = b.column("id").to_numpy()
                e = np.array(edges)
                yield pa.RecordBatch.from_arrays([pa.array(ids[e[:, 0]]), pa.array(ids[e[:, 1]])], ["a", "b"])
    return run


def _rest(buckets: DataFrame, comp: DataFrame, reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components inside buckets of three or more, by blocks of about BLOCK members.

    Every pair of blocks is one bounded piece of work; a large bucket becomes many of them."""
    now = buckets.filter("n > 2").join(comp, "id", "left").withColumn("component", F.coalesce("component", "id"))
    split = now.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("band")
    nb = F.ceil(F.col("n") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("id", F.lit("block")), nb).cast("int")
    rows = (now.join(split, "band").withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), nb - 1)))
            .select("band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "component"))
    key = ["band", "i", "j"]
    spread = lambda df: df.repartition(*key).sortWithinPartitions(*key)
    near = materialise(spread(rows.join(reps.select("id", "n_shingles", "sketch"), "id")).mapInArrow(
        tidy(_hopeful(percent)), "band long, i int, j int, block int, id long, component long"))
    return spread(near.join(sets, "id")).mapInArrow(tidy(_confirm(percent)), "a long, b long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``df``; ``percent`` is the similarity of a link."""
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = materialise(docs.mapInArrow(tidy(_sign), "id long, n_shingles long, print binary, bands array<long>, sketch binary"))
    full = signed.filter("n_shingles > 0 and id is not null")
    classes = materialise(full.groupBy("print").agg(F.min("id").alias("rep")))  # copies: combined before the shuffle
    reps = materialise(full.join(classes, "print").filter("id = rep").drop("rep").dropDuplicates(["print"]))

    rows = reps.select("id", F.explode("bands").alias("band"))
    pivots = rows.groupBy("band").agg(F.min("id").alias("pivot"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    buckets = materialise(rows.join(pivots, "band").select("band", "id", "pivot", "n"))
    # the sets of all members of buckets, read once more from the texts; a merge join at every size,
    # as the ids grow with the input
    ids = buckets.select("id").distinct().hint("merge")
    sets = materialise(docs.join(ids, "id", "left_semi").mapInArrow(tidy(_sets), "id long, s array<long>").dropDuplicates(["id"]))

    def star(pairs: DataFrame) -> DataFrame:
        pairs = pairs.select(F.greatest("id", "p").alias("a"), F.least("id", "p").alias("b")).filter("a != b").distinct()
        return materialise(_links(pairs, reps, sets, percent))

    links = star(buckets.select("id", F.col("pivot").alias("p")))
    comp = materialise(components(links))
    # once more with another pivot, in buckets that still hold two components
    now = buckets.filter("n > 2").join(comp, "id", "left").withColumn("component", F.coalesce("component", "id"))
    split = now.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                    F.min(F.struct(F.xxhash64("id"), "id", "component")).alias("m")).filter("lo < hi")
    again = now.join(split.select("band", "m.id", "m.component").toDF("band", "p", "pc"), "band").filter("component != pc")
    links = links.union(star(again.select("id", "p")))
    comp = materialise(components(links))
    links = links.union(materialise(_rest(buckets, comp, reps, sets, percent)))
    comp = components(links)
    member = classes.join(comp, classes["rep"] == comp["id"], "left").select("print", F.coalesce("component", "rep").alias("component_id"))
    out = signed.select("id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("print")).alias("print")).join(member, "print", "left")
    cid = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), "n_shingles", F.when(F.col("id").isNotNull(), cid).alias("component_id"),
                      (F.col("id") == cid).alias("kept"))
