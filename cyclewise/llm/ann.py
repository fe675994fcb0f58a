"""Operator 8: approximate nearest neighbours by multiprobe p-stable hashing.

Largest inner products become least distances when every vector gets one more component that
brings it to the largest norm.  Each of TABLES tables hashes with floor((a.x + b) / W) over
several Gaussian projections.  A query visits the buckets of a table in the order of their
estimated success: the least sum of squared gaps between its projections and the bucket's cells,
its own bucket first, then ever stronger perturbations, until the visited buckets hold the wanted
share of the rows.  Where that ends for a query is read from a bounded sample (SAMPLE_ROWS); every
row is indexed.  The wanted share is set by PILOT queries that are compared with all rows: the least
one at which the tables together hold TARGET of their true neighbours.  Products are computed for the
visited buckets only; a row that an earlier table gives to the query too is reported by that table.

Rows lie in shards of the rows that share the cells of a table's first projections, so a query is
sent only to shards whose cells it can visit.  Crowded shards, as the sample shows them, are split;
a block holds at most BLOCK_ROWS rows.  Copies of one vector beyond the k + 1 smallest ids can be in
no result and are left out before any comparison.

Results for odd input: vectors that are null, zero, hold null or non-finite components or have
another length than most of them (of lengths as frequent as each other, the shorter) take no part, as
queries or candidates; rows with a null id neither; rows that repeat an id are candidates of their own; ties go to the smaller id; a query
without candidates gives no row; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ragged

TABLES = 4
WIDTH = 2.0  # cell width in units of the largest norm
BRANCH = 2.6  # buckets grow by about this factor with each projection
BUCKET_ROWS = 16
SAMPLE_ROWS = 4096
SHARD_ROWS = 8192
BLOCK_ROWS = 2 * SHARD_ROWS
QUERY_ROWS = 512
NEIGHBOURS = 20
PILOT = 64
TARGET = 0.96
SLACK = 1 + 1e-6  # of a cost, for the order of summation
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Index:
    """The hash functions of all tables, fitted to the number of rows, the largest norm and a sample."""

    def __init__(self, rows: int, norm: float, dim: int, sample: np.ndarray, seed: int = 17) -> None:
        r = np.random.default_rng(seed)
        self.norm, self.share = norm, 1.0
        self.m = max(2, round(math.log(max(rows / BUCKET_ROWS, 1)) / math.log(BRANCH)))
        self.first = min(self.m, max(0, math.floor(math.log(max(rows / SHARD_ROWS, 1)) / math.log(BRANCH))))
        self.a = r.normal(size=(TABLES, dim + 1, self.m))
        self.b = r.uniform(0, 1, (TABLES, self.m))
        reach = np.sqrt((self.a * self.a).sum(axis=1)) / WIDTH  # of a projection, in cells
        self.low, self.high = np.floor(self.b - reach).astype(np.int64) - 1, np.floor(self.b + reach).astype(np.int64) + 1
        x = self.rows(sample)
        self.kinds, self.parts = [], {}
        for t in range(TABLES):
            cells = self.cells(x, t)
            self.kinds.append(np.unique(cells, axis=0, return_inverse=True))
            keys, n = np.unique(self.key(cells, t), return_counts=True)
            want = np.ceil((n - 2) / len(x) * rows / SHARD_ROWS).astype(np.int64)
            self.parts |= {int(k): int(w) for k, w in zip(keys, want) if w > 1}

    def rows(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.norm**2 - (x * x).sum(axis=1), 0))
        return np.column_stack([x, rest])

    def queries(self, x: np.ndarray) -> np.ndarray:
        unit = x / np.sqrt((x * x).sum(axis=1))[:, None]
        return np.column_stack([unit * self.norm, np.zeros(len(x))])

    def place(self, x: np.ndarray, t: int) -> np.ndarray:
        """Projections in units of a cell."""
        return (x @ self.a[t]) / (WIDTH * self.norm) + self.b[t]

    def cells(self, x: np.ndarray, t: int) -> np.ndarray:
        return np.floor(self.place(x, t)).astype(np.int64)

    def key(self, cells: np.ndarray, t: int) -> np.ndarray:
        """The shard of rows by the cells of the first projections, before crowded ones are split."""
        out = np.full(len(cells), t + 1, np.uint64)
        for j in range(self.first):
            out = out * _MIX + (cells[:, j] + 1000).astype(np.uint64)
        return out

    def split(self, keys: np.ndarray) -> np.ndarray:
        """Parts of every key's shard."""
        kinds, of = np.unique(keys, return_inverse=True)
        return np.array([self.parts.get(int(k), 1) for k in kinds], np.int64)[of.reshape(-1)]

    def costs(self, q: np.ndarray, kinds: np.ndarray, t: int) -> np.ndarray:
        """(queries, buckets): squared gaps between a query's projections and a bucket's cells."""
        at = self.place(q, t)
        out = np.zeros((len(q), len(kinds)))
        for j in range(self.m):
            edge = np.arange(self.low[t, j], self.high[t, j] + 1)
            gap = np.maximum(np.maximum(edge - at[:, j, None], at[:, j, None] - edge - 1), 0)
            out += (gap * gap)[:, np.clip(kinds[:, j] - self.low[t, j], 0, len(edge) - 1)]
        return out

    def far(self, q: np.ndarray) -> np.ndarray:
        """(queries, tables): the cost at which the visited buckets hold the wanted share of the sample."""
        out = np.full((len(q), TABLES), np.inf)
        for t, (kinds, of) in enumerate(self.kinds if self.share < 1 else ()):
            at = max(0, math.ceil(self.share * len(of.reshape(-1))) - 1)
            out[:, t] = np.partition(self.costs(q, kinds, t)[:, of.reshape(-1)], at, axis=1)[:, at]
        return out * SLACK

    def fit(self, q: np.ndarray, x: np.ndarray) -> None:
        """Set the share by pairs of queries and their true neighbours."""
        need, qa, xa = np.ones(len(q)), self.queries(q), self.rows(x)
        for t, (kinds, of) in enumerate(self.kinds):
            every = self.costs(qa, kinds, t)
            mine = self.pairs(qa, xa, np.arange(len(q)), np.arange(len(q)), t)
            need = np.minimum(need, (every[:, of.reshape(-1)] <= mine[:, None] * SLACK).mean(axis=1))
        self.share = float(np.sort(need)[math.ceil(TARGET * len(need)) - 1]) if len(need) else 1.0

    def pairs(self, q: np.ndarray, x: np.ndarray, at: np.ndarray, of: np.ndarray, t: int) -> np.ndarray:
        """Costs of single (query, row) pairs."""
        p, c = self.place(q, t)[at], self.cells(x, t)[of]
        gap = np.maximum(np.maximum(c - p, p - c - 1), 0)
        return (gap * gap).sum(axis=1)

    def visits(self, q: np.ndarray, far: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, key) of the shards whose cells a query can visit: its perturbations, one projection after another."""
        at, cost, who = self.place(q, t), np.zeros(len(q)), np.arange(len(q))
        key = np.full(len(q), t + 1, np.uint64)
        for j in range(self.first):
            p, left = at[who, j], np.sqrt(np.maximum(far[who, t] - cost, 0))
            lo = np.maximum(np.floor(p - left), self.low[t, j]).astype(np.int64)
            hi = np.minimum(np.floor(p + left), self.high[t, j]).astype(np.int64)
            n = np.maximum(hi - lo + 1, 0)
            cell, again = ragged(lo, n), np.repeat(np.arange(len(who)), n)
            gap = np.maximum(np.maximum(cell - p[again], p[again] - cell - 1), 0)
            cost, who = cost[again] + gap * gap, who[again]
            key = key[again] * _MIX + (cell + 1000).astype(np.uint64)
            near = cost <= far[who, t]
            cost, who, key = cost[near], who[near], key[near]
        return who, key


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of pairs, summed in the order of the components (the same for equal vectors)."""
    out = np.zeros(len(q))
    for j in range(q.shape[1]):
        out += q[:, j] * x[:, j]
    return out


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, dim).astype(np.float64)


def _bytes(x: np.ndarray) -> pa.Array:
    """One binary value for each row of a matrix of doubles."""
    x = np.ascontiguousarray(x, np.float64)
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer((np.arange(len(x) + 1) * 8 * x.shape[1]).astype(np.int32)), pa.py_buffer(x)])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data).reshape(-1, width)


_DEALT = "shard long, t int, id long, x binary"
_PACKED = "shard long, t int, ids binary, x binary"


def _dealt(shard, t, ids, x) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(shard.view(np.int64)), pa.array(np.full(len(shard), t, np.int32)), pa.array(ids), _bytes(x)], ["shard", "t", "id", "x"])


def _part(key: np.ndarray, part: np.ndarray) -> np.ndarray:
    return (key ^ (key >> np.uint64(29))) * _MIX + part.astype(np.uint64)


def _deal_rows(index: Index, dim: int):
    """Every row once a table, with its shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                ids, x = b.column("id").to_numpy(), _vectors(b.column("v"), dim)
                xa, salt = index.rows(x), b.column("salt").to_numpy()
                for t in range(TABLES):
                    key = index.key(index.cells(xa, t), t)
                    yield _dealt(_part(key, salt % index.split(key)), t, ids, x)
    return run


def _deal_queries(index: Index, dim: int):
    """Every query once for each shard that it visits, with its reach in all tables behind the vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, QUERY_ROWS):
                b = whole.slice(i, QUERY_ROWS)
                ids, x = b.column("id").to_numpy(), _vectors(b.column("v"), dim)
                qa = index.queries(x)
                far = index.far(qa)
                for t in range(TABLES):
                    who, key = index.visits(qa, far, t)
                    n = index.split(key)
                    shard = _part(np.repeat(key, n), ragged(np.zeros(len(n), np.int64), n))
                    both = np.unique(np.rec.fromarrays([np.repeat(who, n), shard], names="w,s"))
                    for j in range(0, len(both), 8192):
                        some = both[j : j + 8192]
                        yield _dealt(some["s"].copy(), t, ids[some["w"]], np.column_stack([x, far])[some["w"]])
    return run


def _pack(width: int, most: int):
    """Rows sorted by shard -> blocks of at most ``most`` rows of one shard."""
    def close(held):
        t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        return pa.RecordBatch.from_arrays([t.column("shard").slice(0, 1), t.column("t").slice(0, 1), pa.array([t.column("id").to_numpy().tobytes()], pa.binary()),
                                           pa.array([_matrix(t.column("x"), width).tobytes()], pa.binary())], ["shard", "t", "ids", "x"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now, n = [], None, 0
        for b in batches:
            if not b.num_rows:
                continue
            s = b.column("shard").to_numpy()
            cut = [0, *(np.flatnonzero(s[1:] != s[:-1]) + 1).tolist(), len(s)]
            for a, z in zip(cut, cut[1:]):
                while a < z:
                    if held and (s[a] != now or n >= most):
                        yield close(held)
                        held, n = [], 0
                    take = min(z - a, most - n)
                    held.append(b.slice(a, take))
                    now, n, a = s[a], n + take, a + take
        if held:
            yield close(held)
    return run


def _search(index: Index, dim: int, k: int):
    def block(q_ids, q, far, ids, x, t):
        qa, xa = index.queries(q), index.rows(x)
        kinds, of = np.unique(index.cells(xa, t), axis=0, return_inverse=True)
        by = np.argsort(of.reshape(-1), kind="stable")
        ids, x, xa = ids[by], x[by], xa[by]
        ends = np.cumsum(np.bincount(of.reshape(-1), minlength=len(kinds)))
        seen = index.costs(qa, kinds, t) <= far[:, t, None]
        s = np.full((len(q), len(x)), -np.inf)
        for j, z in enumerate(ends.tolist()):
            a, who = (int(ends[j - 1]) if j else 0), np.flatnonzero(seen[:, j])
            if len(who):
                s[who, a:z] = q[who] @ x[a:z].T
        s[q_ids[:, None] == ids[None, :]] = -np.inf
        n = min(k, len(ids))
        kth = np.partition(s, len(ids) - n, axis=1)[:, len(ids) - n]
        slack = 1e-12 * index.norm * np.sqrt((q * q).sum(axis=1)) * dim
        at, to = np.nonzero((s >= (kth - slack)[:, None]) & (s > -np.inf))  # ties and rounding: the exact order decides
        score = exact(q[at], x[to])
        order = np.lexsort((ids[to], -score, at))
        at, to, score = at[order], to[order], score[order]
        keep = np.arange(len(at)) - np.searchsorted(at, np.arange(len(q)))[at] < k
        at, to, score = at[keep], to[keep], score[keep]
        for earlier in range(t):  # the first table that gives the row reports it
            new = index.pairs(qa, xa, at, to, earlier) > far[at, earlier]
            at, to, score = at[new], to[new], score[new]
        return pa.RecordBatch.from_arrays([pa.array(q_ids[at]), pa.array(ids[to]), pa.array(score)], ["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                q_ids, ids = (np.frombuffer(b.column(c)[i].as_py(), np.int64) for c in ("q_ids", "ids"))
                q = np.frombuffer(b.column("q")[i].as_py()).reshape(-1, dim + TABLES)
                x = np.frombuffer(b.column("x")[i].as_py()).reshape(-1, dim)
                yield block(q_ids, np.ascontiguousarray(q[:, :dim]), q[:, dim:], ids, x, b.column("t")[i].as_py())
    return run


def _pilot(q_ids: np.ndarray, q: np.ndarray, dim: int, k: int):
    """The k nearest rows of each pilot query in a partition, by comparison with every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        who, score, x = np.zeros(0, np.int64), np.zeros(0), np.zeros((0, dim))
        for b in batches:
            if not b.num_rows:
                continue
            more = _vectors(b.column("v"), dim)
            s = np.where(q_ids[:, None] == b.column("id").to_numpy()[None, :], -np.inf, q @ more.T)
            n = min(k, len(more))
            near = np.argpartition(-s, n - 1, axis=1)[:, :n].reshape(-1)
            by = np.repeat(np.arange(len(q)), n)
            fine = s[by, near] > -np.inf
            who, score, x = np.append(who, by[fine]), np.append(score, s[by, near][fine]), np.concatenate([x, more[near[fine]]])
            order = np.lexsort((-score, who))
            who, score, x = who[order], score[order], x[order]
            best = np.arange(len(who)) - np.searchsorted(who, np.arange(len(q)))[who] < k
            who, score, x = who[best], score[best], x[best]
        yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(score), _bytes(x)], ["q", "score", "x"])
    return run


def search(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEIGHBOURS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every query, by the largest inner product."""
    spark = vectors.sparkSession

    def clean(df):
        v = F.col("v")
        fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < math.inf)) & F.exists(v, lambda c: c != 0)
        return df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).filter(
            F.col("id").isNotNull() & F.col("v").isNotNull() & fine)
    data = clean(vectors)
    square = F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c)
    sizes = data.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("norm"))
    usual = sizes.orderBy(F.desc("n"), "dim").limit(1).collect()
    if not usual:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, rows, norm = usual[0]
    data, asked = data.filter(F.size("v") == dim), clean(queries).filter(F.size("v") == dim)
    chance = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1_000_003)) / 1_000_003.0
    picked = data.filter(chance <= min(1.0, SAMPLE_ROWS / rows)).orderBy(F.xxhash64("id"), "id").limit(2 * SAMPLE_ROWS).select("v").toArrow()
    sample = _vectors(picked.column("v").combine_chunks(), dim) if picked.num_rows else np.zeros((1, dim))
    index = Index(rows, math.sqrt(norm), dim, sample)

    # a partial limit on every partition comes before the exchange, so copies of a vector meet in small numbers
    copies = Window.partitionBy("v").orderBy("id")
    data = data.withColumn("nth", F.row_number().over(copies)).filter(F.col("nth") <= k + 1).drop("nth")
    some = asked.orderBy(F.xxhash64("id", F.lit("pilot")), "id").limit(PILOT).toArrow()
    if some.num_rows:
        q_ids, q = some.column("id").to_numpy(), _vectors(some.column("v").combine_chunks(), dim)
        best = Window.partitionBy("q").orderBy(F.desc("score"))
        true = data.mapInArrow(_pilot(q_ids, q, dim, k), "q long, score double, x binary").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).toArrow()
        if true.num_rows:
            index.fit(q[true.column("q").to_numpy()], _matrix(true.column("x"), dim))

    def blocks(df, run, width, most, parts):
        return df.mapInArrow(run, _DEALT).repartition(parts, "shard").sortWithinPartitions("shard").mapInArrow(_pack(width, most), _PACKED)
    parts = max(2 * spark.sparkContext.defaultParallelism, math.ceil(TABLES * rows / BLOCK_ROWS))
    held = blocks(data.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(1 << 30))), _deal_rows(index, dim), dim, BLOCK_ROWS, parts)
    probes = blocks(asked, _deal_queries(index, dim), dim + TABLES, QUERY_ROWS, parts).select("shard", F.col("ids").alias("q_ids"), F.col("x").alias("q"))
    pairs = held.join(probes, "shard").select("t", "q_ids", "q", "ids", "x")
    found = pairs.mapInArrow(_search(index, dim, k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
