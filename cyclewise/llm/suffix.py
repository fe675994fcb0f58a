"""Operator 4: remove byte strings of LENGTH that also start earlier in the corpus.

Equal windows of LENGTH bytes have the same least gram at the same place (the leftmost minimum of
a hash over the window's grams), so a text is cut into segments: the bytes of a run of windows that
share their least gram.  Segments travel by the hash of that gram, compressed, in one row per
bucket and slice; equal segments are collapsed to their first place before and after the shuffle,
and every later place is removed at once.  Segments whose gram occurs in one
segment only, or with other bytes on both sides, are done.

The rest of a partition are the documents of a column-wise construction: every round inserts one
symbol of each document, right to left, and updates the collection's Burrows-Wheeler transform
and its common prefixes, which are read from and written to a sequential spool (task memory up to
SPOOL_BYTES, the task's own scratch beyond; gone when the task ends).  Neighbours in the final
order with LENGTH or more common symbols are equal strings; all but the first place of each are
removed.  A gram with more than CHUNK different segments (the edge of a passage that a large part
of the corpus shares) is taken apart into single windows that travel by their own hash.

Results for odd input: null and empty texts have no bytes and lose none; rows with a null id, or one
that is not a number, are neither searched nor cut; rows that repeat an id and a text are one document
(the same places), rows that repeat an id with other texts are documents of their own, in the order
of their hash; texts shorter than LENGTH stay whole; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import flat_bytes, materialise, partitions_for, slices, tidy, utf8
from .minhash import mix64

LENGTH = 100
GRAM = 24
SPAN = LENGTH - GRAM + 1  # grams in a window
HALF = (LENGTH - GRAM) // 2
CHUNK = 16384  # documents of one construction
FLUSH_BYTES = 10 << 20  # text of one set of bucket rows
PARTITION_BYTES = 12 << 20  # segment bytes aimed at in a partition
GROWTH = 3.4  # segment bytes to a byte of text
SPOOL_BYTES = 64 << 20
PIECE_BYTES = 2 << 20  # a longer text is cut up for the search
PLACE = 22  # low bits of a packed minimum hold the place in the slice
ROOM = 40  # bits of a place in a text; above them the number of the text among those with its id

_rng = np.random.default_rng(20240608)
_LETTER = _rng.integers(0, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of texts: gram hash, text number, start byte, number of bytes, place of the gram in it."""
    flat, at = flat_bytes(texts)
    none = np.zeros(0, np.int64)
    if len(flat) < LENGTH:
        return none.astype(np.uint64), none, none, none, none
    n = len(flat) - GRAM + 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_LETTER[flat] * _powers(_BASE, len(flat)), dtype=np.uint64)])
    gram = mix64((sums[GRAM:] - sums[:-GRAM]) * _powers(_UNBASE, n))
    low = np.uint64((1 << PLACE) - 1)
    least = (gram & ~low) | np.arange(n, dtype=np.uint64)
    width = 1
    while width * 2 <= SPAN:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    least = np.minimum(least[: len(least) - (SPAN - width)], least[SPAN - width :])
    # windows that lie inside one text
    size = np.diff(at)
    room = np.maximum(size - LENGTH + 1, 0)
    owner = np.repeat(np.arange(len(texts)), room)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(room) - room, room) + at[owner]
    least = least[start]
    first = np.flatnonzero((np.diff(least.astype(np.int64), prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0))
    count = np.diff(np.append(first, len(least)))
    gram_at = (least[first] & low).astype(np.int64) - start[first]
    return least[first] >> np.uint64(PLACE), owner[first], start[first] - at[owner[first]], count + LENGTH - 1, gram_at


def _pack(*arrays: np.ndarray, data: bytes = b"") -> bytes:
    head = np.array([len(a) for a in arrays], np.int64).tobytes()
    planes = [a.astype(np.int64).view(np.uint8).reshape(-1, 8).T.tobytes() for a in arrays]  # bytes of like weight side by side
    return zstandard.ZstdCompressor(level=5).compress(head + b"".join(planes) + data)


def _unpack(blob: bytes, n: int) -> tuple[list[np.ndarray], bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    at, out = 8 * n, []
    for k in np.frombuffer(raw[: 8 * n], np.int64).tolist():
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * k, at).reshape(8, k).T).view(np.int64).reshape(-1))
        at += 8 * k
    return out, raw[at:]


class Places:
    """Segments with their first place; every other place is a removed span."""

    def __init__(self) -> None:
        self.first: dict[bytes, tuple[int, int, int, int]] = {}  # segment -> (doc, start, key, place of the gram)
        self.gone: list[tuple[int, int, int]] = []  # (doc, start, end)

    def add(self, seg: bytes, doc: int, start: int, key: int, gram: int = 0) -> None:
        old = self.first.get(seg)
        if old is None:
            self.first[seg] = (doc, start, key, gram)
        elif (doc, start) < old[:2]:
            self.gone.append((old[0], old[1], old[1] + len(seg)))
            self.first[seg] = (doc, start, key, gram)
        elif (doc, start) != old[:2]:
            self.gone.append((doc, start, start + len(seg)))

    def bucket_rows(self, buckets: int) -> pa.RecordBatch:
        """One compressed row for each bucket: keys, places and bytes of its segments, and removed spans."""
        segs = list(self.first)
        place = np.array(list(self.first.values()), np.int64).reshape(-1, 4)
        size = np.array([len(s) for s in segs], np.int64)
        to = (mix64(place[:, 2].astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        gone = np.array(self.gone, np.int64).reshape(-1, 3)
        gone_to = gone[:, 0] % buckets
        gone_order = np.argsort(gone_to, kind="stable")
        ids = np.union1d(to, gone_to)
        a, b = np.searchsorted(to[order], ids), np.searchsorted(to[order], ids, "right")
        c, d = np.searchsorted(gone_to[gone_order], ids), np.searchsorted(gone_to[gone_order], ids, "right")
        rows = []
        for k in range(len(ids)):
            mine, out = order[a[k] : b[k]], gone[gone_order[c[k] : d[k]]]
            rows.append(_pack(place[mine, 2], place[mine, 0], place[mine, 1], place[mine, 3], size[mine], out[:, 0], out[:, 1], out[:, 2],
                              data=b"".join([segs[i] for i in mine.tolist()])))
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(rows, pa.binary())], ["bucket", "blob"])

    def read(self, blob: bytes) -> None:
        (key, doc, start, gram, size, g0, g1, g2), data = _unpack(blob, 8)
        self.gone += zip(g0.tolist(), g1.tolist(), g2.tolist())
        at = 0
        for k, d, s, g, n in zip(key.tolist(), doc.tolist(), start.tolist(), gram.tolist(), size.tolist()):
            self.add(data[at : at + n], d, s, k, g)
            at += n


def _segments(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen = Places(), 0
        for b in slices(batches, "text", 1 << 20):
            base = [n << ROOM for n in b.column("nth").to_pylist()]
            for ids, offsets, texts in _pieces(b.column("id").to_pylist(), base, utf8(b.column("text"))):
                key, owner, start, size, gram = cut(texts)
                for k, o, s, n, g in zip(key.astype(np.int64).tolist(), owner.tolist(), start.tolist(), size.tolist(), gram.tolist()):
                    held.add(texts[o][s : s + n], ids[o], offsets[o] + s, k, g)
                seen += sum(map(len, texts))
            if seen >= FLUSH_BYTES:
                yield held.bucket_rows(buckets)
                held, seen = Places(), 0
        if held.first or held.gone:
            yield held.bucket_rows(buckets)
    return run


def _pieces(ids: list[int], base: list[int], texts: list[bytes]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """The texts of a slice in one run; a text above PIECE_BYTES in pieces that share LENGTH - 1 bytes,
    so that every window lies in one piece."""
    if max(map(len, texts)) <= PIECE_BYTES:
        yield ids, base, texts
        return
    for d, o, t in zip(ids, base, texts):
        for at in range(0, max(len(t) - LENGTH + 1, 1), PIECE_BYTES):
            yield [d], [o + at], [t[at : at + PIECE_BYTES + LENGTH - 1]]


def build(segs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Burrows-Wheeler transform and common prefixes of a collection, and each document's length.

    Symbols are bytes + 1 (byte 255 is in no UTF-8 text), 0 ends a document."""
    m = len(segs)
    size = np.array([len(s) for s in segs], np.int64)
    longest = int(size.max())
    column = np.zeros((longest + 1, m), np.uint8)  # column j: the symbol j places from the right
    flat, at = flat_bytes(segs)
    back = np.repeat(at[1:], size) - 1 - np.arange(len(flat))
    column[back, np.repeat(np.arange(m), size)] = flat + np.uint8(1)
    place = np.arange(m)  # of the suffix each document inserted last
    with tempfile.SpooledTemporaryFile(max_size=SPOOL_BYTES) as spool:
        def write(*arrays):
            spool.seek(0)
            for a in arrays:
                spool.write(a.tobytes())

        def read(n):
            spool.seek(0)
            return np.frombuffer(spool.read(n), np.uint8), np.frombuffer(spool.read(n), np.uint8)

        write(column[0], np.zeros(m, np.uint8))
        n = m
        for j in range(1, longest + 1):
            bwt, lcp = read(n)
            live = np.flatnonzero(size >= j)
            order = np.argsort(bwt, kind="stable")  # the first column: symbol, then place
            ended = m - len(live)
            fresh = np.zeros(n, bool)
            fresh[place[live]] = True
            fresh = fresh[order]
            slot = np.flatnonzero(fresh)
            by_place = live[np.argsort(place[live])]
            who = by_place[np.searchsorted(place[by_place], order[slot])]
            # common prefixes change at the new suffixes and at those right behind them
            edge = np.flatnonzero(fresh[1:] | fresh[:-1]) + 1
            edge = edge[edge > ended]
            lo, hi = order[edge - 1], order[edge]
            same = bwt[lo] == bwt[hi]
            value = np.zeros(len(edge), np.uint8)
            if same.any():
                a, b = lo[same] + 1, hi[same] + 1
                down = np.argsort(-a)  # from right to left no range between two pairs is read
                pairs = np.stack([a[down], b[down]], axis=1).reshape(-1)
                low = np.minimum.reduceat(np.append(lcp, np.uint8(0)), pairs)[::2]
                got = np.empty(len(down), np.uint8)
                got[down] = low + 1
                value[same] = got
            new = m + slot - ended
            total = m + n - ended
            is_new = np.zeros(total, bool)
            is_new[new] = True
            bwt2, lcp2 = np.empty(total, np.uint8), np.zeros(total, np.uint8)
            bwt2[~is_new], bwt2[new] = bwt, column[j][who]
            lcp2[~is_new] = lcp
            lcp2[m + edge - ended] = value
            if slot[0] == ended:  # the first suffix after the document ends has no neighbour before it
                lcp2[m] = 0
            place[who] = new
            n = total
            write(bwt2, lcp2)
        bwt, lcp = read(n)
    return bwt, lcp, size


def repeats(segs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, offset, class) of every LENGTH-byte string; equal strings share their class."""
    bwt, lcp, size = build(segs)
    m = len(segs)
    order = np.argsort(bwt, kind="stable")
    follow = np.empty(len(order), np.int64)
    follow[order] = np.arange(len(order))  # the m zeros come first, as the m empty suffixes do
    kind = np.cumsum(lcp < LENGTH)
    at, doc, off, cls = np.arange(m), [], [], []
    for j in range(1, int(size.max()) + 1):
        live = np.flatnonzero(size >= j)
        at[live] = follow[at[live]]
        if j >= LENGTH:
            doc.append(live), off.append(size[live] - j), cls.append(kind[at[live]])
    return np.concatenate(doc), np.concatenate(off), np.concatenate(cls)


def _company(segs: list[bytes], order: np.ndarray, key: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """Which of the segments (in the order of their gram) can share a window with another one.

    A window is its gram and LENGTH - GRAM bytes around it, so half of those lie on one side: two
    segments that share a window have the same gram with HALF bytes before it, or after it."""
    ok = np.zeros(len(order), bool)
    if not len(order):
        return ok
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    count = np.diff(np.append(first, len(key)))
    for a, n in zip(first[count > 1].tolist(), count[count > 1].tolist()):
        sides: dict[tuple[bool, bytes], int] = {}
        for i in range(a, a + n):
            s, g = segs[order[i]], int(gram[i])
            for side in ((False, s[g - HALF : g + GRAM]) if g >= HALF else None, (True, s[g : g + GRAM + HALF]) if len(s) >= g + GRAM + HALF else None):
                if side is not None:
                    other = sides.setdefault(side, i)
                    if other != i:
                        ok[other] = ok[i] = True
    return ok


def _later(segs: list[bytes], place: np.ndarray) -> np.ndarray:
    """Removed (doc, start, end) at the first places of segments: windows whose string has an earlier place."""
    doc, off, cls = repeats(segs)
    d, s = place[doc, 0], place[doc, 1] + off
    order = np.lexsort((s, d, cls))
    d, s, cls = d[order], s[order], cls[order]
    later = np.flatnonzero(cls[1:] == cls[:-1]) + 1
    later = later[(d[later] != d[later - 1]) | (s[later] != s[later - 1])]
    return np.stack([d[later], s[later], s[later] + LENGTH], axis=1)


def _by_doc(spans: np.ndarray) -> pa.RecordBatch:
    """One row per document: its removed spans, merged, as (start, end) pairs."""
    spans = spans[np.lexsort((spans[:, 2], spans[:, 1], spans[:, 0]))]
    spans = merged(spans)
    first = np.flatnonzero(np.diff(spans[:, 0], prepend=spans[0, 0] - 1))
    ends = np.append(first[1:], len(spans))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(first), -1)), pa.array(spans[first, 0]), pa.array([spans[a:b, 1:].tobytes() for a, b in zip(first, ends)], pa.binary())],
        ["bucket", "id", "blob"])


def merged(spans: np.ndarray) -> np.ndarray:
    """Sorted (doc, start, end) with overlapping and touching spans of a document joined."""
    if len(spans) < 2:
        return spans
    # ends made to grow over texts, so that one running maximum serves all of them
    text = spans[:, 1] >> ROOM
    rank = np.cumsum((np.diff(spans[:, 0], prepend=spans[0, 0]) != 0) | (np.diff(text, prepend=text[0]) != 0))
    start, end = spans[:, 1] - (text << ROOM), spans[:, 2] - (text << ROOM)
    step = int(end.max()) + 1
    reach = np.maximum.accumulate(end + rank * step)
    first = np.flatnonzero(np.append(True, (start[1:] + rank[1:] * step > reach[:-1]) | (rank[1:] != rank[:-1])))
    out = spans[first].copy()
    last = np.append(first[1:], len(spans)) - 1
    out[:, 2] = reach[last] - rank[last] * step + (text[last] << ROOM)
    return out


def _find(buckets: int):
    """Segments of a partition -> removed spans per document, and single windows of crowded grams."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Places()
        for b in batches:
            for blob in b.column("blob").to_pylist():
                held.read(blob)
        if held.gone:
            yield _by_doc(np.array(held.gone, np.int64))
        held.gone = []
        segs = list(held.first)
        place = np.array(list(held.first.values()), np.int64).reshape(-1, 4)
        held.first = {}
        order = np.argsort(place[:, 2], kind="stable")
        order = order[_company(segs, order, place[order, 2], place[order, 3])]
        place = place[order]
        first = np.flatnonzero(np.append(True, place[1:, 2] != place[:-1, 2])) if len(place) else np.zeros(0, np.int64)
        count = np.diff(np.append(first, len(place)))
        todo: list[int] = []
        groups = [*zip(first[count > 1].tolist(), count[count > 1].tolist())]
        for a, n in [*groups, (-1, CHUNK)]:  # the last entry only ends the last chunk
            if todo and len(todo) + n > CHUNK:
                spans = _later([segs[order[i]] for i in todo], place[todo])
                if len(spans):
                    yield _by_doc(spans)
                todo = []
            if n > CHUNK:
                apart = Places()
                for i in range(a, a + n):
                    seg, (doc, start, _, _) = segs[order[i]], place[i].tolist()
                    for o in range(len(seg) - LENGTH + 1):
                        w = seg[o : o + LENGTH]
                        apart.add(w, doc, start + o, int.from_bytes(hashlib.blake2b(w, digest_size=7).digest(), "little"))
                rows = apart.bucket_rows(buckets)
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([None] * len(rows), pa.int64()), rows.column(1)], ["bucket", "id", "blob"])
            elif a >= 0:
                todo += range(a, a + n)
    return run


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Single windows of crowded grams: every place but the first of each is removed."""
    held = Places()
    for b in batches:
        for blob in b.column("blob").to_pylist():
            held.read(blob)
    if held.gone:
        yield _by_doc(np.array(held.gone, np.int64))


def spans_of(parts, nth: int = 0) -> np.ndarray:
    """Maximal removed (start, end) runs of the nth text of an id from the rows found for it."""
    if not parts:
        return np.zeros((0, 2), np.int64)
    s = np.concatenate([np.frombuffer(p, np.int64).reshape(-1, 2) for p in parts])
    s = s[s[:, 0] >> ROOM == nth] - (nth << ROOM)
    s = np.column_stack([np.zeros(len(s), np.int64), s])[np.lexsort((s[:, 1], s[:, 0]))]
    return merged(s)[:, 1:]


def whole_text(raw: bytes) -> bytes:
    """Bytes left of a text, without characters of which only a part is left."""
    return raw.decode(errors="ignore").encode()


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=3)
    for b in slices(batches, "text"):
        packed = [None if t is None else press.compress(t) for t in b.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("row"), b.column("_id"), b.column("nth"), pa.array(packed, pa.binary())], ["row", "_id", "nth", "packed"])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpress = zstandard.ZstdDecompressor()
    for b in slices(batches, "packed", 1 << 20):
        out = []
        for packed, nth, parts in zip(*(b.column(c).to_pylist() for c in ("packed", "nth", "parts"))):
            t = b"" if packed is None else unpress.decompress(packed)
            spans = spans_of(parts, nth)
            keep, at = [], 0
            for a, z in spans.tolist():
                keep.append(t[at:a])
                at = z
            out.append((packed is not None, len(t), int((spans[:, 1] - spans[:, 0]).sum()), len(spans), b"".join([*keep, t[at:]])))
        h, n, r, s, k = zip(*out)
        yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(h), pa.array(n, pa.int64()), pa.array(r, pa.int64()), pa.array(s, pa.int64()), pa.array(k, pa.binary())],
                                         ["row", "has_text", "n_bytes", "n_removed", "n_spans", "kept"])


def texts_of_ids(df: DataFrame, id_col: str, text_col: str) -> DataFrame | None:
    """(_of, _hash, _nth): the place of every text among the different texts of its id, for ids that have
    several; None if there are none (of every row only the id and a hash are shuffled to find out)."""
    pairs = df.select(F.expr(f"try_cast(`{id_col}` AS BIGINT)").alias("_of"), F.xxhash64(text_col).alias("_hash")).filter("_of IS NOT NULL").groupBy("_of", "_hash").count().drop("count")
    pairs = materialise(pairs)
    several = materialise(pairs.groupBy("_of").count().filter("count > 1").select("_of"))
    if several.isEmpty():
        return None
    order = Window.partitionBy("_of").orderBy("_hash")
    return materialise(pairs.join(several, "_of").withColumn("_nth", F.row_number().over(order).cast("long") - 1))


def _placed(df: DataFrame, id_col: str, text_col: str, nth: DataFrame | None) -> DataFrame:
    """``df`` with the id as a number, ``_id``, and the place of its text among those of the id, ``nth``."""
    rows = df.withColumn("_id", F.expr(f"try_cast(`{id_col}` AS BIGINT)"))
    if nth is None:
        return rows.withColumn("nth", F.lit(0).cast("long"))
    joined = rows.withColumn("_h", F.xxhash64(text_col)).join(nth.hint("merge"), (F.col("_id") == F.col("_of")) & (F.col("_h") == F.col("_hash")), "left")
    return joined.withColumn("nth", F.coalesce("_nth", F.lit(0).cast("long"))).drop("_h", "_of", "_hash", "_nth")


def removed_spans(docs: DataFrame) -> DataFrame:
    """Of rows (_id, nth, text): (id, parts), for every id that loses bytes the rows of (start, end) pairs found for it."""
    spark = docs.sparkSession
    docs = docs.select(F.col("_id").alias("id"), "nth", "text").filter("id is not null and octet_length(text) >= 100")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = partitions_for(total * GROWTH, PARTITION_BYTES, spark)
    deal = lambda df: df.repartitionById(n, F.col("bucket").cast("int"))  # noqa: E731  a bucket is a partition
    found = deal(docs.mapInArrow(tidy(_segments(n)), "bucket long, blob binary")).mapInArrow(tidy(_find(n)), "bucket long, id long, blob binary")
    found = materialise(found)
    crowded = deal(found.filter("bucket >= 0").select("bucket", "blob")).mapInArrow(tidy(_windows), "bucket long, id long, blob binary")
    return found.filter("bucket < 0").union(crowded).groupBy("id").agg(F.collect_list("blob").alias("parts"))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``df`` as a struct ``row`` of its columns but the text, with has_text (it was not
    null), n_bytes, n_removed, n_spans and the kept bytes.  Texts travel compressed."""
    named = df.select(F.struct(*[df[c] for c in df.columns if c != text_col]).alias("row"), df[id_col].alias("_key"), df[text_col].alias("text"))
    rows = _placed(named, "_key", "text", texts_of_ids(named, "_key", "text")).drop("_key")
    gone = removed_spans(rows)
    row = rows.schema["row"]
    packed = rows.select("row", "_id", "nth", "text").mapInArrow(tidy(_squeeze), T.StructType([row, *T.StructType.fromDDL("_id long, nth long, packed binary").fields]))
    # a merge join at every size: both sides grow with the corpus
    both = packed.join(gone.select(F.col("id").alias("_id"), "parts").hint("merge"), "_id", "left").select("row", "nth", "packed", "parts")
    schema = T.StructType([row, *T.StructType.fromDDL("has_text boolean, n_bytes long, n_removed long, n_spans long, kept binary").fields])
    return both.mapInArrow(tidy(_kept), schema)


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows and columns of ``df`` with the repeated bytes cut out of the text.

    A character of which only a part is left goes as a whole; a null text stays null."""
    got = remove_repeats(df, id_col, text_col)
    valid = got.mapInArrow(tidy(_valid), T.StructType([got.schema["row"], T.StructField("text", T.StringType())]))
    return valid.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in df.columns])


def _valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "kept"):
        left = [whole_text(x) if some else None for some, x in zip(b.column("has_text").to_pylist(), b.column("kept").to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(left, pa.binary()).cast(pa.string())], ["row", "text"])
