"""Operator 10: SentencePiece (BPE) encoding and decoding by vectorised merge rounds.

A text is normalised as the model says (a space in front, spaces as the mark U+2581) and cut
before every mark that follows another character: no piece of the model crosses such a place, so
each of these words merges on its own.  The distinct words not seen before are laid out as flat
numpy symbol arrays.  In a round every word finds its least pair rank (a segmented minimum) and
merges the leftmost pairs of that rank, all words at once; merged arrays are compacted, and words
without a pair leave.  When a merge would create a pair of the same or a lower rank, that word
merges only its leftmost pair in the round, which is the order of the sequential algorithm.

Results for odd input: null and empty text give the end id alone and decode to an empty text; an
empty table gives no rows; any Unicode text is covered, as unknown characters become byte pieces.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ragged, slices, tidy

MARK = "▁"
NORMAL, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 3, 4, 5, 6  # fixed values: piece types of the model format
CACHE_WORDS = 120_000
TOGETHER = 8_000  # words merged side by side: their arrays stay small
TEXT_BYTES = 512 << 10  # text that a worker holds as words
NO_PAIR = np.int64(2**62)


class Model:
    """Pieces, ranks and byte ids of a SentencePiece BPE model with identity normalisation."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        spec = proto.normalizer_spec
        if spec.name != "identity" or spec.remove_extra_whitespaces or not (spec.add_dummy_prefix and spec.escape_whitespaces):
            raise ValueError("only identity normalisation with a dummy prefix is supported")
        kinds = [p.type for p in proto.pieces]
        if USER_DEFINED in kinds or any(MARK in p.piece.lstrip(MARK) for p in proto.pieces):
            raise ValueError("pieces that cross words are not supported")
        self.end = next(i for i, p in enumerate(proto.pieces) if p.piece == "</s>")
        mergeable = {p.piece: i for i, p in enumerate(proto.pieces) if p.type in (NORMAL, UNUSED)}
        scores = sorted({proto.pieces[i].score for i in mergeable.values()}, reverse=True)
        rank = {s: r for r, s in enumerate(scores)}
        self.ids = mergeable
        self.rank = {w: rank[proto.pieces[i].score] for w, i in mergeable.items()}
        self.bytes_ = [0] * 256
        self.surface: list[bytes] = []
        self.decimal = [str(i) for i in range(len(proto.pieces))]
        for i, p in enumerate(proto.pieces):
            if p.type == BYTE:
                b = int(p.piece[1:-1], 16)
                self.bytes_[b] = i
                self.surface.append(bytes([b]))
            else:
                self.surface.append(b"" if p.type == CONTROL else p.piece.replace(MARK, " ").encode())
        # all splits of a piece into two symbols; a symbol is a piece or a single character
        self.chars = {w for w in mergeable if len(w) == 1}
        self.symbols = dict(mergeable)  # symbol -> number; characters without a piece are numbered behind
        self.size = len(proto.pieces)
        left, right, out = [], [], []
        for w, i in mergeable.items():
            for k in range(1, len(w)):
                a, b = w[:k], w[k:]
                if (a in mergeable or len(a) == 1) and (b in mergeable or len(b) == 1):
                    left.append(self.number(a)), right.append(self.number(b)), out.append(i)
        key = np.array(left, np.int64) << 32 | np.array(right, np.int64)
        order = np.argsort(key)
        self.pair_key, self.pair_out = key[order], np.array(out, np.int64)[order]
        ranks = np.zeros(self.size, np.int64)
        for w, i in mergeable.items():
            ranks[i] = self.rank[w]
        self.pair_rank = ranks[self.pair_out]

    def number(self, symbol: str) -> int:
        """The piece id, or for a character without a piece a number above all ids."""
        i = self.symbols.get(symbol)
        return self.size + ord(symbol) if i is None else i

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of neighbouring symbols (NO_PAIR where they do not merge)."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        hit = self.pair_key[at] == key
        return np.where(hit, self.pair_rank[at], NO_PAIR), self.pair_out[at]

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbol numbers of all words after all merges, in one array, and the symbols of each word."""
        n = np.array([len(w) for w in words], np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        uniq, inv = np.unique(points, return_inverse=True)
        sym = np.array([self.number(chr(c)) for c in uniq.tolist()], np.int64)[inv]
        word = np.repeat(np.arange(len(words)), n)
        rank, out = np.full(len(sym), NO_PAIR), np.zeros(len(sym), np.int64)
        at = np.flatnonzero(word[:-1] == word[1:])
        rank[at], out[at] = self.pairs(sym[at], sym[at + 1])
        done_sym, done_word = [], []
        while len(sym):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            least = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(sym)))
            live = least < NO_PAIR
            if not live.all():  # no pair remains: the word leaves
                keep = np.repeat(live, size)
                done_sym.append(sym[~keep]), done_word.append(word[~keep])
                sym, word, rank, out = sym[keep], word[keep], rank[keep], out[keep]
                if not len(sym):
                    break
                size, least = size[live], least[live]
                first = np.cumsum(size) - size
            cand = rank == np.repeat(least, size)
            # leftmost pairs without overlap: every other one of a run of candidates
            i = np.arange(len(sym))
            start = np.maximum.accumulate(np.where(cand & ~np.concatenate([[False], cand[:-1]]), i, -1))
            take = cand & ((i - start) % 2 == 0)
            now = self._apply(sym, word, rank, out, take)
            # a new pair of the same or a lower rank must go first: such words merge one pair only
            new_least = np.full(len(words), NO_PAIR)
            np.minimum.at(new_least, now[1][now[4]], now[2][now[4]])
            early = new_least[word[first]] <= least
            if early.any():
                lead = np.zeros(len(sym), bool)
                lead[np.minimum.reduceat(np.where(take, i, len(sym)), first)] = True
                now = self._apply(sym, word, rank, out, take & (~np.repeat(early, size) | lead))
            sym, word, rank, out = now[:4]
        if not words:
            return np.zeros(0, np.int64), n
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        return sym[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words))

    def _apply(self, sym, word, rank, out, take):
        """Merge the taken pairs, compact, and look up the pairs beside a merged symbol (the last result)."""
        kept = ~np.concatenate([[False], take[:-1]])
        joined = take[kept]
        sym, word, rank, out = np.where(take, out, sym)[kept], word[kept], rank[kept], out[kept]
        near = joined.copy()
        near[:-1] |= joined[1:]
        inside = np.zeros(len(sym), bool)
        inside[:-1] = word[:-1] == word[1:]
        rank[near] = NO_PAIR
        at = np.flatnonzero(near & inside)
        rank[at], out[at] = self.pairs(sym[at], sym[at + 1])
        return sym, word, rank, out, at

    def spell(self, words: list[str]) -> list[tuple[str, bytes]]:
        """Decimal ids and decoded bytes of every word."""
        sym, n = self.merge(words)
        big = np.flatnonzero(sym >= self.size)
        if len(big):  # characters without a piece become byte pieces
            raw = [[self.bytes_[b] for b in chr(k - self.size).encode()] for k in sym[big].tolist()]
            count = np.ones(len(sym), np.int64)
            count[big] = [len(r) for r in raw]
            n = np.add.reduceat(count, np.cumsum(n) - n)
            at = (np.cumsum(count) - count)[big]
            sym = np.repeat(sym, count)
            sym[ragged(at, count[big])] = [k for r in raw for k in r]
        flat = sym.tolist()
        text, raw = [self.decimal[k] for k in flat], [self.surface[k] for k in flat]
        ends = np.cumsum(n).tolist()
        return [(" ".join(text[a:b]), b"".join(raw[a:b])) for a, b in zip([0, *ends[:-1]], ends)]


@lru_cache(maxsize=2)
def model(path: str) -> Model:
    return Model(path)


_CUT = re.compile(f"(?<=[^{MARK}])(?={MARK})")
_WORDS: dict[str, Words] = {}


def split_words(text: str) -> list[str]:
    """Words of a normalised text: each starts with the marks before it."""
    parts = (MARK + text.replace(" ", MARK)).split(MARK)[1:]
    if "" not in parts:
        return [MARK + p for p in parts]
    return [w for w in _CUT.split(MARK + text.replace(" ", MARK)) if w]


class Words(dict):
    """Decimal ids by word, up to a bound; ``odd`` has the decoded bytes of words that do not decode to themselves."""

    def __init__(self) -> None:
        self.odd: dict[str, bytes] = {}

    def learn(self, m: Model, words: set[str]) -> None:
        new = [w for w in words if w not in self]
        for i in range(0, len(new), TOGETHER):
            part = new[i : i + TOGETHER]
            for w, (ids, raw) in zip(part, m.spell(part)):
                self[w] = ids
                if raw != w.replace(MARK, " ").encode():
                    self.odd[w] = raw

    def decoded(self, words: list[str]) -> str:
        """The decoded text of words: the marks are spaces again, and the one in front goes."""
        if self.odd and not self.odd.keys().isdisjoint(words):
            raw = b"".join([self.odd.get(w) or w.replace(MARK, " ").encode() for w in words]).decode(errors="replace")
        else:
            raw = "".join(words).replace(MARK, " ")
        return raw[1:] if raw[:1] == " " else raw


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in slices(batches, "text", TEXT_BYTES):
            known = _WORDS.setdefault(path, Words())
            if len(known) > CACHE_WORDS:
                known = _WORDS[path] = Words()
            texts = [split_words(t) if t else [] for t in b.column("text").to_pylist()]
            known.learn(m, set().union(*texts))
            end = str(m.end)
            ids = [" ".join([*[known[w] for w in ws], end]) for ws in texts]
            yield pa.RecordBatch.from_arrays([
                b.column("row"), pa.array([x.count(" ") + 1 for x in ids], pa.int64()), pa.array(ids, pa.string()),
                pa.array([known.decoded(ws) for ws in texts], pa.string())], ["row", "n_tokens", "ids", "decoded"])
        _WORDS.clear()  # a reused worker keeps no words for the stages that follow
    return run


def _digest(path: str):
    encode = _encode(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in encode(batches):
            def sha(c, b=b):
                return pa.array([hashlib.sha256(x.encode()).hexdigest() for x in b.column(c).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("n_tokens"), sha("ids"), sha("decoded")],
                                             ["row", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids array<int> with the end id, decoded text) of every row."""
    got = df.select(F.col(id_col).alias("row"), F.col(text_col).alias("text")).mapInArrow(
        _encode(path), _schema(df, id_col, "n_tokens long, ids string, decoded string"))
    return got.select(F.col("row").alias(id_col), "n_tokens", F.split("ids", " ").cast("array<int>").alias("ids"), "decoded")


def digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row, computed where the ids are made."""
    got = df.select(F.col(id_col).alias("row"), F.col(text_col).alias("text")).mapInArrow(
        tidy(_digest(path)), _schema(df, id_col, "n_tokens long, ids_sha256 string, decoded_sha256 string"))
    return got.withColumnRenamed("row", id_col)


def _schema(df: DataFrame, id_col: str, rest: str) -> str:
    return f"row {df.schema[id_col].dataType.simpleString()}, {rest}"
