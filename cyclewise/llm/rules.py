"""Operator 6: quality rules with risk-controlled thresholds.

Five surface measures of the whole text are compared with cutoffs that are chosen per stratum
(the ``lang`` column) on labelled documents.  One path of joint cutoff vectors, each at least as
strict as the one before, is tried in every stratum; a vector is certified if the exact binomial
test rejects, at level ``DELTA`` / strata, that all its rules together refuse ``RISK`` or more of
the good documents.  Trying in a fixed order needs no further correction, and the strictest
certified vector is used.  The order of the path comes from the labelled bad documents alone, so
it says nothing of the good ones it is tested on: first the rules that refuse most of them.

On a path, a rule that refuses good documents ends the trial of all.  Where there are enough good
documents to certify every rule alone (``RISK`` / rules each), half the level goes to that, and of
the two vectors the one that refuses more bad documents is used.

So with probability 1 - DELTA the rules together refuse at most RISK of the good documents in
every stratum at once.  With 4 strata, 217 good documents of which none is refused certify a
vector; in a stratum with fewer no vector can be, and only the base rule works there.

Results for odd input: a null or empty text has no word and fails the base rule (fewer than 50
words); a null language is a stratum of its own; rows that repeat an id are each measured; an
empty table gives no rows; without labels only the base rule works.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import flat_bytes, materialise, slices, utf8

RISK = 0.02
DELTA = 0.05
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# rule -> (measure as SQL, cutoffs from lenient to strict); a document fails above the cutoff.
RULES = {
    "symbols_per_word": ("n_symbols / greatest(n_words, 1)", (4.0, 2.0, 1.0, 0.7, 0.5, 0.3, 0.2, 0.1)),
    "dup_line_share": ("n_dup_lines / greatest(n_lines, 1)", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2)),
    "repeat_word_share": ("n_repeat_words / greatest(n_words, 1)", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2)),
    "word_length": ("word_chars / greatest(n_words, 1)", (30.0, 20.0, 16.0, 14.0, 12.0, 11.0, 10.0)),
    "short_word_length": ("-word_chars / greatest(n_words, 1)", (-1.5, -2.0, -2.5, -3.0, -3.5)),
}


# Number of cutoffs exceeded, per rule -> documents
Documents = Counter


def base() -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k), summed exactly from the terms."""
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def certified(refused: Iterable[int], n: int, risk: float, level: float) -> int:
    """How many of the cutoffs, in order, pass the exact test: the last of them is the strictest allowed."""
    passed = 0
    for k in refused:
        if n == 0 or k >= risk * n or binomial_cdf(k, n, risk) > level:
            break
        passed += 1
    return passed


def repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more, the first occurrence included."""
    n = len(words)
    if n < 4:
        return 0
    kinds: dict[bytes, int] = {}
    c = np.array([kinds.setdefault(w, len(kinds)) for w in words], np.int64)
    v = len(kinds)
    if v > 2_000_000:  # keep (v^3) in 64 bits: number the pairs first
        pair = np.unique(c[:-1] * v + c[1:], return_inverse=True)[1]
        key = pair[:-1] * v + c[2:]
    else:
        key = (c[:-2] * v + c[1:-1]) * v + c[2:]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(n - 2, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    cover = np.zeros(n, bool)
    for i in range(3):
        cover[i : n - 2 + i] |= again
    return int(cover.sum())


_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1
_SPACE = np.zeros(256, np.int64)
_SPACE[[32, 9, 10, 11, 12, 13]] = 1
_POINT = np.ones(256, np.int64)
_POINT[128:192] = 0  # continuation bytes


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text", 2 << 20):
        texts = utf8(b.column("text"))
        flat, at = flat_bytes(texts)

        def total(kind, flat=flat, at=at):
            return np.diff(np.concatenate([[0], np.cumsum(kind[flat])])[at])
        words, lines, dup, rep = [], [], [], []
        for t in texts:
            ws = t.split()
            ls = [x for x in t.split(b"\n") if x.strip()]
            words.append(len(ws)), lines.append(len(ls)), dup.append(len(ls) - len(set(ls))), rep.append(repeat_words(ws))
        cols = [words, total(_POINT) - total(_SPACE), total(_SYMBOL), dup, rep, lines]
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("stratum"), *[pa.array(c, pa.int64()) for c in cols]],
                                         ["id", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"])


def measures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """Base measures of every row: (id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines)."""
    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.coalesce(F.concat(F.lit("="), F.col(stratum_col).cast("string")), F.lit("")).alias("stratum"),
                     F.col(text_col).alias("text")).mapInArrow(
        _measure, f"id {kind}, stratum string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long")


def refused(vector: Sequence[int], docs: Documents) -> int:
    """Documents refused when rule i uses its first ``vector[i]`` cutoffs (0: it is off)."""
    return sum(n for over, n in docs.items() if any(v + o > len(c) for v, o, (_, c) in zip(vector, over, RULES.values())))


def path(bad: Documents) -> list[tuple[int, ...]]:
    """Vectors from lenient to strict: the cutoff that refuses most of the bad documents left comes
    first, by way of the more lenient cutoffs of its rule; those that refuse none follow in turn."""
    size = [len(c) for _, c in RULES.values()]
    now, out = [0] * len(size), []
    while any(v < k for v, k in zip(now, size)):
        steps = [(refused([*now[:i], v, *now[i + 1 :]], bad), -v, -i) for i, k in enumerate(size) for v in range(now[i] + 1, k + 1)]
        got, v, i = max(steps)
        if got == refused(now, bad):
            _, v, i = max(x for x in steps if -x[1] == now[-x[2]] + 1)
        while now[-i] < -v:
            now[-i] += 1
            out.append(tuple(now))
    return out


def choose(good: Documents, bad: Documents, risk: float, level: float) -> tuple[int, ...]:
    """The vector of one stratum: certified on its good documents at ``level``."""
    n, k = sum(good.values()), len(RULES)
    off = (0,) * k
    both = (1 - risk / k) ** n <= level / 2 / k  # n alone decides, not what is refused
    level = level / 2 if both else level
    way = path(bad)
    at = certified((refused(v, good) for v in way), n, risk, level)
    found = [way[at - 1] if at else off]
    if both:
        alone = lambda i: (refused([*off[:i], v, *off[i + 1 :]], good) for v in range(1, len(list(RULES.values())[i][1]) + 1))
        found.append(tuple(certified(alone(i), n, risk / k, level / k) for i in range(k)))
    return max(found, key=lambda v: (refused(v, bad), sum(v)))


def thresholds(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
               risk: float = RISK, delta: float = DELTA) -> list[tuple]:
    """(stratum, one cutoff or infinity per rule) from the labelled documents.

    A histogram of how many cutoffs of each rule are exceeded comes to the driver: at most
    34,992 cells for each stratum and label, whatever the number of documents."""
    known = labels.filter(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("good"))
    over = [sum(((F.expr(m) > c).cast("int") for c in cuts), F.lit(0)).alias(r) for r, (m, cuts) in RULES.items()]
    left = (F.col("good") == 1) | ~base()  # of the bad documents, those that the base rule leaves
    cells = measured.join(known, "id").filter(left).select("stratum", "good", *over).groupBy("stratum", "good", *RULES).count().collect()
    good: dict[str, Documents] = {}
    bad: Documents = Counter()
    for row in cells:
        docs = good.setdefault(row["stratum"], Counter()) if row["good"] == 1 else bad
        docs[tuple(row[r] for r in RULES)] += row["count"]
    out = []
    for stratum, docs in good.items():
        vector = choose(docs, bad, risk, delta / len(good))
        out.append((stratum, *(cuts[v - 1] if v else math.inf for v, (_, cuts) in zip(vector, RULES.values()))))
    return out


def judge(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """(id, base measures, base_failed, kept) of every row."""
    measured = materialise(measures(df, id_col, text_col, stratum_col))
    cuts = thresholds(measured, labels, id_col)
    schema = T.StructType([T.StructField("stratum", T.StringType()), *[T.StructField(f"cut_{r}", T.DoubleType()) for r in RULES]])
    table = df.sparkSession.createDataFrame(cuts, schema)
    passed = None
    for r, (m, _) in RULES.items():
        ok = F.expr(m) <= F.coalesce(F.col(f"cut_{r}"), F.lit(math.inf))
        passed = ok if passed is None else passed & ok
    return measured.join(table, "stratum", "left").select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base().alias("base_failed"), (~base() & passed).alias("kept"))
