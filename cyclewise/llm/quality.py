"""Operator 5: a quality classifier by positive-unlabelled learning.

A small network over surface features of the whole text (shares of byte classes and marks, word
and line repetition, word length) minimises the non-negative unbiased risk

    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))

with trusted positives (documents labelled 1), unlabelled web text (documents of the same folds
without regard to labels) and a class prior estimated as the share of 1 among the labelled rows.
Features are computed over every byte of every text inside the tasks; training uses a bounded
sample (``SAMPLE_DOCS`` positives and as many unlabelled).

Results for odd input: null and empty texts are scored from all-zero features (the same score for
all of them); rows that repeat are scored alike; an empty table gives no rows; without labelled
positives every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import flat_bytes, slices, utf8

SAMPLE_DOCS = 8000  # bound on positives, and on unlabelled documents, that training reads
HIDDEN = 16
STEPS = 400

# Byte classes: every ASCII mark on its own, then upper case, lower case, digits, space, line ends, the rest.
_CLASS = np.full(256, 5, np.int64)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[32] = 0, 1, 2, 3
_CLASS[[9, 10, 11, 12, 13]] = 4
_MARKS = [c for c in range(33, 127) if not chr(c).isalnum()]
_CLASS[_MARKS] = 6 + np.arange(len(_MARKS))
CLASSES = 6 + len(_MARKS)
FEATURES = CLASSES + 6


def features(texts: list[bytes]) -> np.ndarray:
    """(n, FEATURES) float32 of whole texts."""
    flat, at = flat_bytes(texts)
    size = np.diff(at)
    owner = np.repeat(np.arange(len(texts), dtype=np.int64) * CLASSES, size)
    hist = np.bincount(owner + _CLASS[flat], minlength=len(texts) * CLASSES).reshape(len(texts), CLASSES)
    out = np.zeros((len(texts), FEATURES), np.float32)
    out[:, :CLASSES] = np.sqrt(hist / np.maximum(size, 1)[:, None])
    for i, t in enumerate(texts):
        ws = t.split()
        if ws:
            kinds, lines = len(set(ws)), [x for x in t.split(b"\n") if x.strip()]
            n = len(ws)
            again = sum([a == b for a, b in zip(ws, ws[1:])])
            out[i, CLASSES:] = (np.log1p(n) / 5, kinds / n, np.log1p(kinds) / np.log1p(n), 1 - len(set(lines)) / len(lines),
                                again / n, (len(t) - n) / n / 10)
    return out


class Scorer:
    """One hidden layer over standardised features."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 3) -> None:
        r = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.p = {"w": r.normal(0, FEATURES**-0.5, (FEATURES, HIDDEN)), "c": np.zeros(HIDDEN), "v": r.normal(0, 0.1, HIDDEN), "b": np.zeros(1)}

    def _hidden(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return z, np.tanh(z @ self.p["w"] + self.p["c"])

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self._hidden(x)[1] @ self.p["v"] + self.p["b"][0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))

    def _back(self, z: np.ndarray, h: np.ndarray, d: np.ndarray) -> dict:
        dh = d[:, None] * self.p["v"] * (1 - h * h)
        return {"w": z.T @ dh, "c": dh.sum(axis=0), "v": h.T @ d, "b": np.array([d.sum()])}

    def train(self, pos: np.ndarray, unl: np.ndarray, prior: float, steps: int = STEPS) -> None:
        """Adam on the non-negative risk with the logistic loss; where the negative part falls below
        zero, its gradient is reversed, as in the published method."""
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        for t in range(1, steps + 1):
            (zp, hp), (zu, hu) = self._hidden(pos), self._hidden(unl)
            fp, fu = hp @ self.p["v"] + self.p["b"], hu @ self.p["v"] + self.p["b"]
            sp, su = 1 / (1 + np.exp(-fp)), 1 / (1 + np.exp(-fu))
            negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
            sign = 1.0 if negative >= 0 else -1.0
            positive = 1.0 if negative >= 0 else 0.0
            gp = self._back(zp, hp, (positive * prior * (sp - 1) - sign * prior * sp) / len(pos))
            gu = self._back(zu, hu, sign * su / len(unl))
            for k in self.p:
                g = gp[k] + gu[k] + (1e-4 * self.p[k] if k in "wv" else 0)
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.99 * s[k] + 0.01 * g * g
                self.p[k] = self.p[k] - 0.02 * (1 - t / (steps + 1)) * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.99**t)) + 1e-8)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text", 1 << 20):
        x = features(utf8(b.column("text")))
        yield pa.RecordBatch.from_arrays([b.column("kind"), pa.array([r.tobytes() for r in x], pa.binary())], ["kind", "x"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Scorer | None:
    """A scorer learned from ``docs`` (training rows only) and the labels of some of them."""
    known = labels.filter(F.col(label_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).alias("y"))
    rows = docs.select(id_col).join(known, id_col, "left")  # ids and labels only
    n, pos, lab = rows.agg(F.count(F.lit(1)), F.sum((F.col("y") == 1).cast("long")), F.count("y")).first()
    if not pos:
        return None
    u = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("quality")), F.lit(1_000_003)) / 1_000_003.0
    v = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("unlabelled")), F.lit(1_000_003)) / 1_000_003.0
    kinds = F.array_compact(F.array(
        F.when((F.col("y") == 1) & (u < min(1.0, SAMPLE_DOCS / pos)), 1), F.when(v < min(1.0, SAMPLE_DOCS / n), 0)))
    # the sampled ids are about 2 x SAMPLE_DOCS at any size, so they go to the texts, not the texts to them
    picked = rows.withColumn("kinds", kinds).filter(F.size("kinds") > 0).select(id_col, "kinds").dropDuplicates([id_col])
    got = docs.select(id_col, F.col(text_col).alias("text")).join(F.broadcast(picked), id_col).select(
        F.explode("kinds").alias("kind"), "text").mapInArrow(_extract, "kind int, x binary").toArrow()
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), np.float32).reshape(-1, FEATURES).astype(np.float64)
    kind = got.column("kind").to_numpy()
    order = np.lexsort(x.T)  # the same order whatever the partitions
    x, kind = x[order], kind[order]
    unl = x[kind == 0]
    prior = min(max(pos / lab, 0.05), 0.98)
    s = Scorer(unl.mean(axis=0), np.maximum(unl.std(axis=0), 0.02))
    s.train(x[kind == 1], unl, prior)
    return s


def _score(model: Scorer | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 1 << 20):
            s = np.full(b.num_rows, 0.5) if model is None else model.score(features(utf8(b.column("text"))))
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["row", "score", "predicted"])
    return run


def score(df: DataFrame, model: Scorer | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) of every row."""
    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("row"), F.col(text_col).alias("text")).mapInArrow(
        _score(model), f"row {kind}, score double, predicted int").withColumnRenamed("row", id_col)
