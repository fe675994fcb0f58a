"""Shared helpers: reading tables, Arrow slices of bounded bytes, tables in the shared folder.

Only ``doc_id`` / ``text`` / ``source`` / ``lang`` style columns named by an operator are read;
other columns, whatever their names, are never touched.
"""

from __future__ import annotations

import ctypes
import gc
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package

# Bytes of text that one step inside a task holds as Python objects or numpy arrays.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(id_col: str, n: int) -> Column:
    """``crc32(id as text) mod n``; a null id is in fold -1 (part of no fold)."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(n)), F.lit(-1))


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder (spark.checkpoint.dir) and read it back.

    Cuts the lineage with files that every executor can read, so a lost executor costs nothing."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, column: str, first: int = 0) -> DataFrame:
    """``df`` written to the shared folder, its rows numbered first, first + 1, ... in the order of its partitions.

    The rows are numbered within their partitions; only one count for each partition meets the driver."""
    kept = materialise(df.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright(F.col("_at"), 33).cast("long")
    counts = sorted((r["_p"], r["count"]) for r in kept.groupBy(part.alias("_p")).count().collect())
    starts, at = [], first
    for p, n in counts:
        starts.append((p, at))
        at += n
    before = df.sparkSession.createDataFrame(starts, "_p long, _before long")
    joined = kept.join(F.broadcast(before), part == F.col("_p"))
    return joined.withColumn(column, F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at", "_p", "_before")


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``max_bytes`` of ``column`` (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(size + 64) - 1) // max_bytes
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows]):
            yield batch.slice(a, b - a)


def tidy(run):
    """``run`` (a function of record batches), after which the worker gives its free memory back.

    Workers serve many tasks of many stages; what one of them leaves free but mapped counts against
    the next one's executor."""
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()
    return tidied


def give_back() -> None:
    """The worker's free memory, given back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of a string column as UTF-8 bytes; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def flat_bytes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one uint8 array, and the n + 1 offsets of the texts in it."""
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(x) for x in texts], out=at[1:])
    return np.frombuffer(b"".join(texts), np.uint8), at


def partitions_for(total_bytes: float, per_partition: float, spark: SparkSession) -> int:
    """A partition count that keeps a partition near ``per_partition`` bytes, two per core at least."""
    return max(2 * spark.sparkContext.defaultParallelism, math.ceil(total_bytes / per_partition))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every run, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    out = np.ones(total, np.int64)
    keep = lengths > 0
    s, n = starts[keep], lengths[keep]
    first = np.cumsum(n) - n
    out[first] = s
    out[first[1:]] -= s[:-1] + n[:-1] - 1
    return np.cumsum(out)
