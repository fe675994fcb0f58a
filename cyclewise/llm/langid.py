"""Operator 1: language identification with a byte convolutional network.

A text is cut into windows of ``WINDOW`` bytes (the last one padded).  Bytes are embedded,
filters of several widths run over them, each filter keeps its maximum over the window, and a
softmax over the languages follows.  The network is trained in numpy on the driver, on windows of a
bounded sample of labelled documents (``SAMPLE_DOCS``); scoring runs over every window of every
text in batches of fixed-length windows inside the tasks.  A document's language has the highest
mean log-probability over its windows, weighted by their bytes; the score is its softmax share.

Results for odd input: null text, empty text and text without a letter give ``und`` with score 1.0;
rows that repeat are scored alike; an empty table gives no rows; without any labelled row every
text is ``und`` with score 0.0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import flat_bytes, ragged, slices, tidy, utf8

WINDOW = 256
EMBED = 4
WIDTHS = (2, 3, 4)
FILTERS = 16
SAMPLE_DOCS = 6000  # bound on the documents that training reads, shared among the languages
DOC_WINDOWS = 3  # windows of one training document, spread over it
STEPS = 400
BATCH = 64
UNKNOWN = "und"

# Bytes as the network sees them: A-Z lower-cased, digits as one symbol, all white space as a space.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[48:58] = 48
_FOLD[[9, 10, 11, 12, 13]] = 32


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n, WINDOW) folded bytes, the text of each window, and its number of bytes."""
    flat, at = flat_bytes(texts)
    size = np.diff(at)
    n = -(-size // WINDOW)
    owner = np.repeat(np.arange(len(texts)), n)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    used = np.minimum(WINDOW, size[owner] - nth * WINDOW)
    out = np.full((len(owner), WINDOW), 32, np.uint8)
    row = np.repeat(np.arange(len(owner)), used)
    out[row, ragged(np.zeros(len(owner), np.int64), used)] = _FOLD[flat]
    return out, owner, used


class Network:
    """Embedding, filters by width, weights of the softmax."""

    def __init__(self, langs: list[str], seed: int = 7) -> None:
        r = np.random.default_rng(seed)
        self.langs = langs
        self.p = {"e": r.normal(0, 0.5, (256, EMBED)).astype(np.float32)}
        for w in WIDTHS:
            self.p[f"f{w}"] = r.normal(0, (w * EMBED) ** -0.5, (w * EMBED, FILTERS)).astype(np.float32)
            self.p[f"c{w}"] = np.zeros(FILTERS, np.float32)
        self.p["o"] = r.normal(0, 0.1, (FILTERS * len(WIDTHS), len(langs))).astype(np.float32)
        self.p["b"] = np.zeros(len(langs), np.float32)

    def pool(self, x: np.ndarray, keep: bool = False):
        """Maximum of every filter over each window (and where it was, for training)."""
        n = len(x)
        v = self.p["e"][x].reshape(n, WINDOW * EMBED)
        top, where = [], []
        for w in WIDTHS:
            span = np.lib.stride_tricks.sliding_window_view(v, w * EMBED, axis=1)[:, ::EMBED]
            resp = (np.ascontiguousarray(span).reshape(-1, w * EMBED) @ self.p[f"f{w}"]).reshape(n, WINDOW - w + 1, FILTERS)
            if keep:
                where.append(resp.argmax(axis=1))
            top.append(resp.max(axis=1) + self.p[f"c{w}"])
        h = np.maximum(np.concatenate(top, axis=1), 0)
        return (h, where) if keep else h

    def log_probs(self, x: np.ndarray) -> np.ndarray:
        z = np.concatenate([self.pool(x[i : i + 256]) for i in range(0, len(x), 256)]) @ self.p["o"] + self.p["b"]
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict:
        n = len(x)
        h, where = self.pool(x, True)
        z = h @ self.p["o"] + self.p["b"]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        d = z / z.sum(axis=1, keepdims=True)
        d[np.arange(n), y] -= 1
        d /= n
        g = {"o": h.T @ d, "b": d.sum(axis=0), "e": np.zeros_like(self.p["e"])}
        dh = (d @ self.p["o"].T) * (h > 0)
        for k, w in enumerate(WIDTHS):
            dk, at = dh[:, k * FILTERS : (k + 1) * FILTERS], where[k]
            spot = at[:, :, None] + np.arange(w)  # window, filter, byte of the filter
            by = x[np.arange(n)[:, None, None], spot]
            seen = self.p["e"][by].reshape(n, FILTERS, w * EMBED)
            g[f"f{w}"] = np.einsum("nf,nfi->if", dk, seen)
            g[f"c{w}"] = dk.sum(axis=0)
            back = dk[:, :, None, None] * self.p[f"f{w}"].T.reshape(1, FILTERS, w, EMBED)
            np.add.at(g["e"], by.reshape(-1), back.reshape(-1, EMBED))
        return g

    def train(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS, seed: int = 11) -> None:
        """Adam over balanced batches."""
        r = np.random.default_rng(seed)
        groups = [np.flatnonzero(y == k) for k in range(len(self.langs))]
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        for t in range(1, steps + 1):
            at = np.array([r.choice(groups[i % len(groups)]) for i in range(BATCH)])
            part = x[at].copy()
            for row in range(0, BATCH, 2):  # every other window is cut short, as short texts and last windows are
                part[row, r.integers(12, WINDOW) :] = 32
            rate = 0.01 * min(1.0, 2 * (1 - t / (steps + 1)))
            for k, g in self.gradients(part, y[at]).items():
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.99 * s[k] + 0.01 * g * g
                self.p[k] -= (rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.99**t)) + 1e-7)).astype(np.float32)


def _sample_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Up to DOC_WINDOWS windows of each document, evenly spread over the whole text."""
    for b in slices(batches, "text"):
        x, owner, _ = windows(utf8(b.column("text")))
        n = np.bincount(owner, minlength=b.num_rows)
        first = np.cumsum(n) - n
        at = np.unique((first[:, None] + (n[:, None] * (2 * np.arange(DOC_WINDOWS) + 1)) // (2 * DOC_WINDOWS))[n > 0].reshape(-1))
        yield pa.RecordBatch.from_arrays([b.column("lang").take(pa.array(owner[at])), pa.array([r.tobytes() for r in x[at]], pa.binary())], ["lang", "x"])


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Network | None:
    """A network learned from rows with a language; None if there is none.

    Counts the rows of each language, then keeps ids below a hash threshold per language so that
    about SAMPLE_DOCS documents in all are read."""
    rows = labelled.filter(F.col(lang_col).isNotNull() & (F.length(text_col) > 0))
    counts = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}
    if not counts:
        return None
    langs = sorted(counts)
    each = SAMPLE_DOCS / len(langs)
    share = F.create_map(*[F.lit(v) for k in langs for v in (k, min(1.0, each / counts[k]))])
    u = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("langid")), F.lit(1_000_003)) / 1_000_003.0
    picked = rows.filter(u < F.element_at(share, F.col(lang_col))).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    got = picked.mapInArrow(_sample_windows, "lang string, x binary").toArrow()
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), np.uint8).reshape(-1, WINDOW)
    order = np.lexsort([*(x[:, i] for i in range(0, 64, 8)), [hash_(r) for r in x]])  # the same order whatever the partitions
    names = {k: i for i, k in enumerate(langs)}
    y = np.array([names[k] for k in got.column("lang").to_pylist()])
    langs = [k for i, k in enumerate(langs) if (y == i).any()]
    y = np.searchsorted(np.unique(y), y)
    net = Network(langs)
    net.train(x[order], y[order])
    return net


def hash_(row: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(row.tobytes())


def _predict(net: Network | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 1 << 20):
            letters = pc.fill_null(pc.match_substring_regex(b.column("text"), r"\pL"), False).to_numpy(zero_copy_only=False)
            langs = [UNKNOWN] * b.num_rows
            score = np.ones(b.num_rows)
            if net is None:
                score[:] = 0.0
            elif letters.any():
                at = np.flatnonzero(letters)
                x, owner, used = windows(utf8(b.column("text").take(pa.array(at))))
                total = np.zeros((len(at), len(net.langs)))
                np.add.at(total, owner, net.log_probs(x) * used[:, None])
                total /= np.bincount(owner, weights=used)[:, None]
                p = np.exp(total - total.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                best = p.argmax(axis=1)
                score[at] = p[np.arange(len(at)), best]
                for i, k in zip(at.tolist(), best.tolist()):
                    langs[i] = net.langs[k]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(langs, pa.string()), pa.array(score)], ["row", "lang_pred", "score"])
    return run


def identify(df: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row."""
    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("row"), F.col(text_col).alias("text")).mapInArrow(
        _predict(net), f"row {kind}, lang_pred string, score double").withColumnRenamed("row", id_col)


def keep_identified(df: DataFrame, net: Network | None, text_col: str = "text") -> DataFrame:
    """The whole rows of ``df`` whose text has a language (is not ``und``), unchanged and unshuffled.

    The network tells languages apart and rejects none of them, so what goes are texts without a letter;
    without a network (no row was labelled) these go all the same, and texts with a letter stay."""
    if net is None:
        return df.filter(F.col(text_col).rlike(r"\p{L}"))
    packed = df.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("row", packed.schema["row"].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return packed.mapInArrow(tidy(_predict(net)), schema).filter(F.col("lang_pred") != UNKNOWN).select("row.*")
