"""Operator 11: spelling variants by a variable-length gram index.

1. Words are counted over all texts (an aggregate with map-side sums).
2. The gram dictionary: grams of ``MIN_GRAM`` to ``MAX_GRAM`` code points over the distinct words.  A gram
   is extended while it is frequent (more than 1 in ``RARE`` of all grams of its length); the others
   are leaves.  At most ``RARE`` grams of a length can be frequent, so what is broadcast is bounded.
3. Near words share one half: if the one edit is not in the first half of the shorter word, the first
   halves are equal, else the second ones.  So every word goes to the groups of both its halves, once
   as the shorter and once as the longer of a pair.  Groups of more than ``CROWD`` words are halved
   again inside the part that may differ, as often as needed.
4. In a group the differing parts are decomposed into variable grams, one at every position, each in
   an inverted list of (group, gram, position from the left) and of (.., position from the right).
   An edit affects a run of the grams of a word; the most it can affect (NAG) bounds how many lists
   near words share, so of all lists of a word the NAG + 1 shortest hold all its near words.  A word
   all of whose grams one edit can affect is compared with its group.
5. Candidates of the merged lists are verified on the whole words, code point by code point; a pair
   counts in the one group that holds the place of its edit, so nothing is counted twice.
6. Per word: the number of near words and the one with the largest n; forms are followed to the root
   by doubling (n grows tenfold at every step, so a few joins suffice).

Words are within U+0000 .. U+00FF, so a word is one byte for each code point and code-point order is
byte order.

Results for odd input: null or empty texts have no words; a null id counts as an empty one; rows that
repeat an id are separate texts; words of any length take part; an empty table gives no rows.  Only
the id and text columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, partitions_for, ragged, tidy

MIN_LENGTH, MIN_COUNT, FORM_TIMES, FOLD = 7, 2, 10, 31
MIN_GRAM, MAX_GRAM = 2, 4
RARE = 1000
CROWD = 4096
GROUP_WORDS = 100_000  # words (of all groups) in a partition
PAIRS = 1 << 19  # candidates verified at a time
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def count_words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): distinct results of at least MIN_LENGTH code points, with their occurrences."""
    runs = df.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                     F.explode(F.expr(f"regexp_extract_all({_quoted(text_col)}, '[A-Za-z\\\\u00C0-\\\\u00FF]{{{MIN_LENGTH},}}', 0)")).alias("run"))
    lower = runs.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    hashed = lower.withColumn("h", F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "UTF-8")))
    at = F.col("h") % F.length("run")
    word = F.when(F.col("h") % FOLD == 0, F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))).otherwise(F.col("run"))
    return hashed.select(word.alias("word")).filter(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def frequent_grams(words: DataFrame) -> np.ndarray:
    """The grams (latin-1 bytes as a number, zero-padded on the right to MAX_GRAM) that are extended."""
    out: list[int] = []
    for size in range(MIN_GRAM, MAX_GRAM):
        grams = words.filter(F.length("word") >= size).select(F.explode(F.expr(f"transform(sequence(1, length(word) - {size - 1}), i -> substring(word, i, {size}))")).alias("g"))
        counted = grams.groupBy("g").agg(F.count(F.lit(1)).alias("c"))
        total = words.agg(F.coalesce(F.sum(F.greatest(F.length("word") - (size - 1), F.lit(0))), F.lit(0))).first()[0]
        for r in counted.filter(F.col("c") * RARE > total).collect():
            out.append(int.from_bytes(r["g"].encode("latin-1").ljust(MAX_GRAM, b"\0"), "big"))
    return np.array(sorted(out), np.int64)


def decompose(rest: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Grams of the rows of a matrix of code points: (gram numbers, length wanted at every position).

    A gram that the end cuts wants more than is left of the row; its number is what is left."""
    n, w = rest.shape
    padded = np.zeros((n, w + MAX_GRAM), np.int64)
    padded[:, :w] = rest
    gram = sum(padded[:, i : i + w] << 8 * (MAX_GRAM - 1 - i) for i in range(MIN_GRAM))
    want = np.full((n, w), MIN_GRAM, np.int64)
    for size in range(MIN_GRAM, MAX_GRAM):
        more = (want == size) & np.isin(gram, frequent)
        gram = np.where(more, gram | padded[:, size : size + w] << 8 * (MAX_GRAM - 1 - size), gram)
        want += more
    return gram, want


def most_affected(want: np.ndarray) -> np.ndarray:
    """NAG of every row: the most grams that one inserted, deleted or replaced code point can affect."""
    n, w = want.shape
    at = np.arange(w)
    most = np.zeros(n, np.int64)
    for e in range(w + 1):  # an edit of code point e, or after the last one
        low = max(0, e - MAX_GRAM + 1)
        most = np.maximum(most, (want[:, low : e + 1] + at[low : e + 1] > e).sum(axis=1))
    return most


_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _lists(group: np.ndarray, gram: np.ndarray, position: np.ndarray) -> np.ndarray:
    """Numbers of inverted lists.  Lists that share a number only bring more candidates to verify."""
    h = (group[:, None] ^ gram.astype(np.uint64) * _MIX[0]) * _MIX[1] + position.astype(np.uint64) * _MIX[2]
    return (h ^ (h >> np.uint64(29))).reshape(-1)


def _spans(index: np.ndarray, probe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lo = np.searchsorted(index, probe, "left")
    return lo, np.searchsorted(index, probe, "right") - lo


class _Found:
    """Near words of the entries of a partition: how many, and the best of them as (n, word)."""

    def __init__(self, words: np.ndarray, n: np.ndarray):
        self.words, self.n = words, n
        self.owner: list[np.ndarray] = []
        self.other: list[np.ndarray] = []

    def add(self, owner: np.ndarray, other: np.ndarray) -> None:
        self.owner.append(owner)
        self.other.append(other)

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(entry, near words, best near entry)."""
        owner, other = np.concatenate([[], *self.owner]).astype(np.int64), np.concatenate([[], *self.other]).astype(np.int64)
        by_word = np.argsort(np.array(self.words, object), kind="stable") if len(owner) else np.zeros(0, np.int64)
        place = np.empty(len(self.words), np.int64)
        place[by_word] = np.arange(len(by_word))
        order = np.lexsort((place[other], -self.n[other], owner))
        owner, other = owner[order], other[order]
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        return owner[first], np.diff(np.append(first, len(owner))), other[first]


def _pairs(spans: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(probe, candidate) of spans (probe, start, length, entries), a bounded number at a time."""
    step = max(1, PAIRS * 16 // max(width, 16))
    for probe, start, size, entries in spans:
        upto = np.cumsum(size)
        at, total = 0, int(upto[-1]) if len(upto) else 0
        while at < total:  # a span longer than a step is cut
            end = min(total, at + step)
            a, b = int(np.searchsorted(upto, at, "right")), int(np.searchsorted(upto, end, "left")) + 1
            s, k = start[a:b].copy(), size[a:b].copy()
            over = int(upto[b - 1]) - end
            k[-1] -= over
            skip = at - (int(upto[a - 1]) if a else 0)
            s[0] += skip
            k[0] -= skip
            yield np.repeat(probe[a:b], k), entries[ragged(s, k)]
            at = end


def _merge(mu: int, a: int, c: int, group: np.ndarray, entry: np.ndarray, length: np.ndarray, matrix: np.ndarray, frequent: np.ndarray, found: _Found) -> None:
    """Near pairs of the groups whose shorter words have ``mu`` code points, of which a and c at the ends are shared."""
    rho = mu - a - c
    short, long_ = length == mu, length == mu + 1
    sg, lg, se, le = group[short], group[long_], entry[short], entry[long_]
    if not len(sg) or len(sg) + len(lg) < 2:
        return
    sw, lw = matrix[short][:, :mu], matrix[long_]
    gram, want = decompose(sw[:, a : a + rho], frequent)
    lgram, _ = decompose(lw[:, a : a + rho + 1], frequent)
    at, lat = np.arange(rho), np.arange(rho + 1)
    # positions from the left as 0, 1, .., from the right as -1, -2, ..; words of like length need the first kind alone
    left = np.concatenate([_lists(sg, gram, np.broadcast_to(at, gram.shape)), _lists(lg, lgram, np.broadcast_to(lat, lgram.shape))])
    left_entry = np.concatenate([np.repeat(np.arange(len(sg)), rho), np.repeat(np.arange(len(lg)), rho + 1) + len(sg)])
    right = _lists(lg, lgram, np.broadcast_to(lat - rho - 1, lgram.shape))
    right_entry = np.repeat(np.arange(len(lg)), rho + 1) + len(sg)
    lo, ro = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    left, left_entry, right, right_entry = left[lo], left_entry[lo], right[ro], right_entry[ro]
    ls, ln = _spans(left, _lists(sg, gram, np.broadcast_to(at, gram.shape)))
    rs, rn = _spans(right, _lists(sg, gram, np.broadcast_to(at - rho, gram.shape)))
    affected = most_affected(want)
    cost = (ln + rn).reshape(gram.shape)
    rank = np.empty_like(cost)
    np.put_along_axis(rank, np.argsort(cost, axis=1, kind="stable"), np.broadcast_to(at, cost.shape), axis=1)
    bound = affected < rho  # at least one gram survives any edit
    use = ((rank <= affected[:, None]) & bound[:, None]).reshape(-1)
    probe = np.repeat(np.arange(len(sg)), rho)
    every = np.concatenate([sg, lg])
    order = np.argsort(every, kind="stable")
    gs, gn = _spans(every[order], sg[~bound])
    spans = [(probe[use], ls[use], ln[use], left_entry), (probe[use], rs[use], rn[use], right_entry), (np.flatnonzero(~bound), gs, gn, order)]
    got = []
    for i, j in _pairs(spans, mu):
        like = j < len(sg)
        x, y = i[like], j[like]
        differ = sw[x] != sw[y]
        place = differ.argmax(axis=1) if mu else np.zeros(len(x), np.int64)
        ok = (differ.sum(axis=1) == 1) & (place >= a) & (place < mu - c)
        got.append(x[ok] * len(every) + y[ok])
        x, y = i[~like], j[~like]
        z = lw[y - len(sg)]
        differ = np.concatenate([sw[x] != z[:, :mu], np.ones((len(x), 1), bool)], axis=1)
        place = differ.argmax(axis=1)  # leading code points in common
        moved = sw[x] != z[:, 1:]
        after = np.where(moved.any(axis=1), mu - moved[:, ::-1].argmax(axis=1), 0)  # the rest after it in common
        ok = (after <= place) & (place >= a) & ((place < mu - c) | (c == 0))
        got.append(x[ok] * len(every) + y[ok])
    pair = np.sort(np.concatenate([np.zeros(0, np.int64), *got]))
    pair = pair[np.diff(pair, prepend=-1) > 0]
    x, y = np.divmod(pair, len(every))
    ids = np.concatenate([se, le])
    found.add(ids[x], ids[y])
    longer = y >= len(sg)  # those of like length are found from both sides
    found.add(ids[y[longer]], ids[x[longer]])


def _near(frequent_bytes: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = np.frombuffer(frequent_bytes, np.int64)
        tables = [b for b in batches if b.num_rows]
        if not tables:
            return
        t = pa.Table.from_batches(tables)
        words = [w.encode("latin-1") for w in t.column("word").to_pylist()]
        n = t.column("n").to_numpy()
        key = t.column("key").to_numpy().view(np.uint64)
        mu, a, c = (t.column(x).to_numpy().astype(np.int64) for x in ("mu", "a", "c"))
        found = _Found(words, n)
        kind = np.stack([mu, a, c], axis=1)
        order = np.lexsort((c, a, mu))
        cuts = np.flatnonzero((np.diff(kind[order], axis=0) != 0).any(axis=1)) + 1
        for part in np.split(order, cuts):
            m = int(mu[part[0]])
            length = np.array([len(words[i]) for i in part.tolist()], np.int64)
            matrix = np.frombuffer(b"".join(words[i].ljust(m + 1, b"\0") for i in part.tolist()), np.uint8).reshape(len(part), m + 1)
            _merge(m, int(a[part[0]]), int(c[part[0]]), key[part], part, length, matrix, frequent, found)
        owner, near, best = found.best()
        for at in range(0, len(owner), 50_000):
            o, b = owner[at : at + 50_000].tolist(), best[at : at + 50_000].tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([words[i].decode("latin-1") for i in o]), pa.array(near[at : at + 50_000], pa.int64()),
                 pa.array(n[b], pa.int64()), pa.array([words[i].decode("latin-1") for i in b])], ["word", "n_near", "best_n", "best"])

    return run


_HALVES = """explode(array(
    struct(a + CAST(FLOOR((mu - a - c) / 2) AS INT) AS a, c AS c),
    struct(a AS a, c + mu - a - c - CAST(FLOOR((mu - a - c) / 2) AS INT) AS c)))"""


def groups(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(key, mu, a, c, word, n): every word in the groups it shares a part with; no group of more than ``crowd`` that can be halved."""
    keyed = lambda df: df.select("mu", "h.a", "h.c", "word", "n").withColumn(
        "key", F.expr("xxhash64(mu, a, c, substring(word, 1, a), substring(word, length(word) - c + 1, c))"))
    start = words.select("word", "n", F.expr(f"explode(filter(array(length(word), length(word) - 1), m -> m >= {MIN_LENGTH}))").alias("mu"))
    now = start.selectExpr("mu", "word", "n", "0 AS a", "0 AS c").selectExpr("mu", "word", "n", _HALVES + " AS h")
    now, done = materialise(keyed(now)), None
    while True:
        crowded = materialise(now.groupBy("key").agg(F.count(F.lit(1)).alias("k"), F.max(F.expr("mu - a - c")).alias("rest")).filter((F.col("k") > crowd) & (F.col("rest") > 1)).select("key"))
        if crowded.isEmpty():
            return now if done is None else done.unionByName(now)
        quiet = now.join(crowded, "key", "left_anti")
        done = quiet if done is None else done.unionByName(quiet)
        halved = now.join(crowded, "key", "left_semi").selectExpr("mu", "word", "n", _HALVES + " AS h")
        now = materialise(keyed(halved))


def roots(forms: DataFrame, most: int) -> DataFrame:
    """(word, root) for rows (word, form): the last of the forms followed; ``most`` is the largest n."""
    steps = max(1, math.ceil(math.log(max(most, 2), FORM_TIMES)))
    now = materialise(forms.select("word", F.col("form").alias("root")))
    for _ in range(math.ceil(math.log2(steps)) + 1):
        after = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = materialise(now.join(after, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
    return now


def variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word with at least MIN_COUNT occurrences."""
    words = materialise(count_words(df, id_col, text_col).filter(F.col("n") >= MIN_COUNT))
    frequent = frequent_grams(words)
    grouped = groups(words, crowd)
    parts = partitions_for(4 * words.count(), GROUP_WORDS, df.sparkSession)
    near = grouped.select("key", "mu", "a", "c", "word", "n").repartition(parts, "key").mapInArrow(
        tidy(_near(frequent.tobytes())), "word string, n_near long, best_n long, best string")
    near = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w"))).alias("b"))
    near = materialise(near)
    joined = materialise(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(-F.col("b.m") >= FORM_TIMES * F.col("n"), F.col("b")).alias("b")).selectExpr(
        "word", "n", "n_near", "b.w AS form", "-b.m AS form_n"))
    most = joined.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    root = roots(joined.filter("form IS NOT NULL"), most)
    return joined.join(root, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
