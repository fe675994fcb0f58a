"""Operator 7: token ids in a file format coded with a static range asymmetric numeral system.

Texts are cut before every space that another character follows (a place where the tokenizer's own
pattern always cuts); each distinct unit is encoded by the tokenizers library once, many units in
one call.  Documents go to files in ascending id order.  One frequency table over the whole corpus
codes every block: LANES interleaved 64-bit states that share one stream of 32-bit words.  A block
keeps the states and stream place at every CHECK steps, so its parts decode side by side, and a
CRC-32 of its ids.  Blocks are rows of Parquet files, one file per range of ids, in the shared
folder; Spark commits them, and any executor can read any block.

Results for odd input: null and empty texts hold the end id alone; a null id comes first and stays
null; rows that repeat an id are separate documents side by side; an empty table gives no files
and no rows.  A text that holds the string of a special token is encoded whole by the library.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import materialise, partitions_for, ragged, slices

END = 0
LANES = 64
CHECK = 256  # steps between checkpoints
BLOCK_IDS = 1 << 16  # a block is closed when it has so many ids
SCALE = 20  # bits of the frequency table's total
LOW = np.uint64(1 << 31)  # states stay in [2^31, 2^63)
WORD = np.uint64(32)
UNITS = 1_200_000  # distinct units remembered by a worker
TOGETHER = 512  # units in one call of the library
FILE_BYTES = 24 << 20  # text aimed at in a file
TEXT_BYTES = 4 << 20  # text encoded at a time
GROUP = 96  # blocks coded side by side

_CUT = re.compile(r" (?=\S)")
_MARKS = ".,;:!?"
# a space before white space or the end, where cutting at every space would go wrong
_WIDE = r" ([\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|\z)"


@lru_cache(maxsize=2)
def _library(path: str):
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    special = [a.content for a in t.get_added_tokens_decoder().values()]
    size = np.zeros(t.get_vocab_size(), np.int64)  # bytes of a token: every character of its name is one byte
    for name, i in t.get_vocab().items():
        size[i] = len(name)
    return t, special, size


class Units:
    """Ids of units, remembered up to a bound: a unit's number leads to its run in one array of ids."""

    def __init__(self, path: str) -> None:
        self.lib, self.special, self.size = _library(path)
        self.kind = np.dtype("<u2" if len(self.size) <= 1 << 16 else "<u4")
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}  # of units that follow a cut, without its space
        self.start, self.length = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.ids, self.used, self.n = np.zeros(1 << 18, self.kind), 0, 0

    def _room(self, units: int, ids: int) -> None:
        if self.n + units > len(self.start):
            self.start, self.length = (np.resize(x, 2 * (self.n + units)) for x in (self.start, self.length))
        if self.used + ids > len(self.ids):
            self.ids = np.resize(self.ids, 2 * (self.used + ids))

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Numbers of new runs: ``ids`` in a row, cut into ``lengths``."""
        self._room(len(lengths), len(ids))
        out = np.arange(self.n, self.n + len(lengths))
        self.ids[self.used : self.used + len(ids)] = ids
        self.start[out], self.length[out] = self.used + np.cumsum(lengths) - lengths, lengths
        self.used += len(ids)
        self.n += len(lengths)
        return out

    def whole(self, texts: list[str]) -> np.ndarray:
        """Numbers of runs of texts that are encoded as they are."""
        got = [np.array(e.ids, self.kind) for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]
        return self.add(np.concatenate([np.zeros(0, self.kind), *got]), np.array([len(g) for g in got], np.int64))

    def learn(self, units: list[str]) -> None:
        """``units``: new ones, each of what follows a cut, without its space.

        Marks after a letter or digit are a token's start of their own, so a unit that ends in some is its
        stem's run and that of the marks."""
        stems = [u.rstrip(_MARKS) for u in units]
        split = [i for i, (s, u) in enumerate(zip(stems, units)) if len(s) < len(u) and s and s[-1].isalnum()]
        known, apart = self.known, set(split)
        self._call(list(dict.fromkeys(u for i, u in enumerate(units) if i not in apart) | {stems[i]: None for i in split if stems[i] not in known}))
        if split:
            marks = [units[i][len(stems[i]) :] for i in split]
            kinds = list(dict.fromkeys(marks))
            of = dict(zip(kinds, self.whole(kinds).tolist()))
            runs = np.array([[known[stems[i]], of[m]] for i, m in zip(split, marks)], np.int64)
            lengths = self.length[runs]
            ids = self.ids[ragged(self.start[runs].reshape(-1), lengths.reshape(-1))]
            known.update(zip([units[i] for i in split], self.add(ids, lengths.sum(axis=1)).tolist()))

    def _call(self, units: list[str]) -> None:
        """One call of the library for many units."""
        parts = [units[i : i + TOGETHER] for i in range(0, len(units), TOGETHER)]
        for part, e in zip(parts, self.lib.encode_batch_fast([" " + " ".join(p) for p in parts], add_special_tokens=False)):
            ids = np.array(e.ids, np.uint32)
            ends = np.cumsum(np.fromiter(map(len, map(str.encode, part)), np.int64, len(part)) + 1)
            at = np.searchsorted(np.cumsum(self.size[ids]), ends) + 1
            self.known.update(zip(part, self.add(ids.astype(self.kind), np.diff(at, prepend=0)).tolist()))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts in a row, the end id last in each, and the number of ids of each."""
        if len(self.known) > UNITS:
            self.clear()
        n, texts = len(texts), pc.fill_null(texts, "")
        odd = np.zeros(n, bool)
        for name in self.special:
            odd |= pc.match_substring(texts, name).to_numpy(zero_copy_only=False)
        plain = ~odd & ~pc.match_substring_regex(texts, _WIDE).to_numpy(zero_copy_only=False)
        cut = pc.split_pattern(texts.filter(pa.array(plain)), " ")
        kinds = [cut.flatten(), *[pa.array(_CUT.split(t), pa.string()) for t in texts.filter(pa.array(~plain & ~odd)).to_pylist()]]
        units, sizes = pa.concat_arrays(kinds), np.zeros(n, np.int64)
        sizes[plain] = pc.list_value_length(cut).to_numpy()
        sizes[~plain & ~odd] = [len(k) for k in kinds[1:]]
        # units lie by kind of text; the place of every text's first one
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain & ~odd)])
        first = np.zeros(n, np.int64)
        first[order] = np.cumsum(sizes[order]) - sizes[order]
        number = np.zeros(len(units), np.int64)
        head = np.zeros(len(units), bool)
        head[first[order]] = True
        begins = units.filter(pa.array(head)).dictionary_encode()
        number[head] = self.whole(begins.dictionary.to_pylist())[begins.indices.to_numpy()] if len(begins) else 0
        rest = units.filter(pa.array(~head)).dictionary_encode()
        names = rest.dictionary.to_pylist()
        self.learn([u for u in names if u not in self.known])
        numbers = np.fromiter(map(self.known.__getitem__, names), np.int64, len(names))
        number[~head] = numbers[rest.indices.to_numpy()] if len(rest) else 0
        end = self.add(np.array([END], self.kind), np.ones(1, np.int64))
        # every text: its units (an odd one's whole run), then the end id
        sizes[odd] = 1
        at = np.cumsum(sizes + 1) - 1
        runs = np.full(int((sizes + 1).sum()), end[0])
        whole = np.flatnonzero(odd)
        runs[at[whole] - 1] = self.whole(texts.take(pa.array(whole)).to_pylist()) if len(whole) else 0
        runs[ragged(at[order] - sizes[order], sizes[order])] = number
        lengths = self.length[runs]
        total = np.add.reduceat(lengths, at - sizes) if n else np.zeros(0, np.int64)
        return self.ids[ragged(self.start[runs], lengths)], total


_UNITS: dict[str, Units] = {}


def _tokenise(path: str):
    """Documents in file order -> blocks of raw ids: (seq, docs, sizes, ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = _UNITS.setdefault(path, Units(path))
        press = zstandard.ZstdCompressor(level=1)
        docs, sizes, held, total, seq = [], [], [], 0, 0

        def block():
            return pa.RecordBatch.from_arrays([
                pa.array([seq]), pa.array([docs], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())), pa.array([total]),
                pa.array([press.compress(b"".join(held))], pa.binary())], ["seq", "docs", "sizes", "n_ids", "ids"])
        for b in slices(batches, "text", TEXT_BYTES):
            ids, lengths = units.encode(b.column("text"))
            ends = np.cumsum(lengths).tolist()
            for d, n, e in zip(b.column("id").to_pylist(), lengths.tolist(), ends):
                docs.append(d), sizes.append(n), held.append(ids[e - n : e].tobytes())
                total += n
                if total >= BLOCK_IDS:
                    yield block()
                    docs, sizes, held, total, seq = [], [], [], 0, seq + 1
        if docs:
            yield block()
    return run


def _raw_ids(blob: bytes, n: int) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    return np.frombuffer(raw, np.uint16 if len(raw) == 2 * n else np.uint32)


def _count(vocabulary: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for b in batches:
            for blob, n in zip(b.column("ids").to_pylist(), b.column("n_ids").to_pylist()):
                total += np.bincount(_raw_ids(blob, n), minlength=vocabulary)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["id", "n"])
    return run


def frequencies(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Counts scaled to a total of 2^scale; every id that occurs keeps 1 at least."""
    total, some = 1 << scale, counts > 0
    if not some.any():
        return np.zeros(len(counts), np.int64)
    f = np.where(some, np.maximum(1, counts * float(total) / counts.sum()), 0).astype(np.int64)
    over = int(f.sum()) - total
    order = np.argsort(-f, kind="stable")
    while over:  # what rounding left over goes to, or comes from, the most frequent ids
        for i in order.tolist():
            if not over or not f[i]:
                break
            step = max(-abs(over), -(f[i] // 2)) if over > 0 else max(1, -over // 16)
            if over > 0 and step == 0:
                continue
            f[i] += step
            over += step
    return f


class Coder:
    """Encoding and decoding of blocks with one frequency table."""

    def __init__(self, f: np.ndarray) -> None:
        self.f = f.astype(np.uint64)
        self.c = (np.cumsum(f) - f).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(f), dtype=np.uint32), f)

    def encode(self, blocks: list[np.ndarray]) -> list[tuple[bytes, bytes, bytes]]:
        """(words, states at checkpoints, word places of checkpoints) of every block."""
        steps = np.array([-(-len(b) // LANES) for b in blocks])
        order = np.argsort(-steps, kind="stable")
        most = int(steps.max())
        sym = np.zeros((most, len(blocks), LANES), np.uint32)
        for g, k in enumerate(order.tolist()):
            pad = np.full(steps[k] * LANES, blocks[k][-1], np.uint32)  # filled up with the last id
            pad[: len(blocks[k])] = blocks[k]
            sym[: steps[k], g] = pad.reshape(-1, LANES)
        steps = steps[order]
        x = np.full((len(blocks), LANES), LOW, np.uint64)
        words, owner, out = [], [], np.zeros(len(blocks), np.int64)
        marks: list[tuple[int, np.ndarray, np.ndarray]] = []
        full = np.uint64(1 << (63 - SCALE))
        for t in range(most - 1, -1, -1):
            g = int(np.searchsorted(-steps, -t, "left"))  # blocks with more than t steps come first
            s = sym[t, :g]
            f, y = self.f[s], x[:g]
            spill = y >= f * full
            blk, lane = np.nonzero(spill)
            words.append(y[blk, lane].astype(np.uint32))
            owner.append(blk)
            out[:g] += spill.sum(axis=1)
            y = np.where(spill, y >> WORD, y)
            q = y // f
            x[:g] = (q << np.uint64(SCALE)) + (y - q * f) + self.c[s]
            if t % CHECK == 0:
                marks.append((g, x[:g].copy(), out[:g].copy()))
        words, owner = np.concatenate(words[::-1]), np.concatenate(owner[::-1])
        words = words[np.argsort(owner, kind="stable")]
        ends = np.cumsum(out)
        result: list = [None] * len(blocks)
        for g, k in enumerate(order.tolist()):
            mine = [m for m in marks[::-1] if m[0] > g]
            states = np.concatenate([m[1][g] for m in mine])
            places = np.array([out[g] - m[2][g] for m in mine], np.int64)
            result[k] = (words[ends[g] - out[g] : ends[g]].tobytes(), states.tobytes(), places.tobytes())
        return result

    def decode(self, blocks: list[tuple[int, bytes, bytes, bytes]]) -> list[np.ndarray]:
        """Ids of blocks (number of ids, words, states, places); all checkpointed parts run side by side."""
        stream = np.frombuffer(b"".join([b[1] for b in blocks]) + b"\0" * 4, np.uint32)
        base = np.cumsum([0, *[len(b[1]) // 4 for b in blocks]])
        x, at, steps = [], [], []
        for k, (n, _, states, places) in enumerate(blocks):
            x.append(np.frombuffer(states, np.uint64).reshape(-1, LANES))
            p = np.frombuffer(places, np.int64)
            at.append(p + base[k])
            total = -(-n // LANES)
            steps += [min(CHECK, total - i * CHECK) for i in range(len(p))]
        x, at, steps = np.concatenate(x), np.concatenate(at), np.array(steps)
        order = np.argsort(-steps, kind="stable")
        x, at, ordered = x[order], at[order], steps[order]
        got = np.zeros((len(steps), int(ordered[0]), LANES), np.uint32)
        mask = np.uint64((1 << SCALE) - 1)
        for t in range(int(ordered[0])):
            g = int(np.searchsorted(-ordered, -t, "left"))
            y = x[:g]
            slot = y & mask
            s = self.symbol[slot]
            got[:g, t] = s
            y = self.f[s] * (y >> np.uint64(SCALE)) + slot - self.c[s]
            need = y < LOW
            nth = np.cumsum(need, axis=1)
            place = np.minimum(at[:g, None] + nth - 1, len(stream) - 1)
            x[:g] = np.where(need, (y << WORD) | stream[place], y)
            at[:g] += nth[:, -1]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        out, k = [], 0
        for n, _, _, places in blocks:
            parts = len(places) // 8
            ids = np.concatenate([got[back[k + i], : steps[k + i]].reshape(-1) for i in range(parts)])
            out.append(ids[:n])
            k += parts
        return out


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, GROUP):
            yield b.slice(i, GROUP)


def _encode(f: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(f)
        for b in _grouped(batches):
            ids = [_raw_ids(r, n) for r, n in zip(b.column("ids").to_pylist(), b.column("n_ids").to_pylist())]
            words, states, places = zip(*coder.encode(ids))
            crc = [zlib.crc32(i.astype("<u4").tobytes()) for i in ids]
            yield pa.RecordBatch.from_arrays([
                *[b.column(c) for c in ("file", "seq", "docs", "sizes", "n_ids")], pa.array(words, pa.binary()), pa.array(states, pa.binary()),
                pa.array(places, pa.binary()), pa.array(crc, pa.int64())],
                ["file", "seq", "docs", "sizes", "n_ids", "words", "states", "places", "crc"])
    return run


FORMAT = "file int, seq long, docs array<long>, sizes array<long>, n_ids long, words binary, states binary, places binary, crc long"
TABLE = "id long, f long"


def write_files(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> str:
    """Write the documents' ids and the frequency table; returns the folder."""
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = partitions_for(total, FILE_BYTES, spark)
    ordered = docs.repartitionByRange(n, "id").sortWithinPartitions("id")
    blocks = ordered.mapInArrow(_tokenise(tokenizer), "seq long, docs array<long>, sizes array<long>, n_ids long, ids binary")
    # a row's range of ids, so the order of files, is the partition that made it
    raw = materialise(blocks.select(F.spark_partition_id().alias("file"), "*"))
    vocabulary = len(_library(tokenizer)[2])
    rows = raw.select("n_ids", "ids").mapInArrow(_count(vocabulary), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(vocabulary, np.int64)  # bounded by the vocabulary
    for r in rows:
        counts[r["id"]] = r["n"]
    f = frequencies(counts)
    path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/ids-{uuid.uuid4().hex}"
    raw.mapInArrow(_encode(f), FORMAT).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    some = np.flatnonzero(f)
    spark.createDataFrame([(int(i), int(f[i])) for i in some], TABLE).coalesce(1).write.parquet(f"{path}/frequencies")
    return path


def read_table(spark: SparkSession, path: str) -> np.ndarray:
    rows = spark.read.schema(TABLE).parquet(f"{path}/frequencies").collect()
    f = np.zeros(max([r["id"] for r in rows], default=-1) + 1, np.int64)
    for r in rows:
        f[r["id"]] = r["f"]
    return f


def _decode(f: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(f)
        for b in _grouped(batches):
            cols = [b.column(c).to_pylist() for c in ("n_ids", "words", "states", "places")]
            found = coder.decode(list(zip(*cols)))
            base, row = [], {k: [] for k in ("file", "doc", "offset", "n", "crc")}
            for k, ids in enumerate(found):
                raw = ids.astype("<u4").tobytes()
                if zlib.crc32(raw) != b.column("crc")[k].as_py():
                    raise ValueError("a block does not match its checksum")
                at = 0
                docs, sizes = b.column("docs")[k].as_py(), b.column("sizes")[k].as_py()
                for d, n in zip(docs, sizes):
                    row["doc"].append(d), row["offset"].append(at), row["n"].append(n), row["crc"].append(zlib.crc32(raw[4 * at : 4 * (at + n)]))
                    at += n
                row["file"] += [b.column("file")[k].as_py()] * len(docs)
                base += [b.column("seq")[k].as_py()] * len(docs)
            yield pa.RecordBatch.from_arrays([pa.array(row["file"], pa.int32()), pa.array(base, pa.int64()), *[pa.array(row[k], pa.int64()) for k in ("doc", "offset", "n", "crc")]],
                                             ["file", "seq", "doc", "offset", "n", "crc"])
    return run


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files.

    Starts are sums over three levels: files (one row each, in one window), blocks within a file,
    documents within a block."""
    blocks = spark.read.schema(FORMAT).parquet(f"{path}/blocks")
    sizes = blocks.select("file", "seq", "n_ids")
    files = sizes.groupBy("file").agg(F.sum("n_ids").alias("m")).select(
        "file", F.expr("coalesce(sum(m) over (order by file rows between unbounded preceding and 1 preceding), 0)").alias("file_start"))
    inside = sizes.select("file", "seq", F.expr(
        "coalesce(sum(n_ids) over (partition by file order by seq rows between unbounded preceding and 1 preceding), 0)").alias("block_start"))
    starts = inside.join(files, "file").select("file", "seq", (F.col("file_start") + F.col("block_start")).alias("at"))
    docs = blocks.mapInArrow(_decode(read_table(spark, path)), "file int, seq long, doc long, offset long, n long, crc long")
    return docs.join(starts, ["file", "seq"]).select(
        F.col("doc").alias("doc_id"), (F.col("at") + F.col("offset")).cast("long").alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
