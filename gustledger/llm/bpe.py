"""Byte-level BPE encoding and decoding by a public rank file.

Texts are cut before single spaces, which the split pattern never crosses; the cuts' ids are kept
by the worker, up to a bound, so a distinct cut is encoded once a worker at best. New pieces are merged in
matrices: pieces of like length are rows, every round merges the leftmost pair of lowest rank in
every row, finished rows leave.

Nulls encode as the empty text. Ties in rank fall to the leftmost pair. Repeated rows are encoded
like any other. A very long text is encoded whole, and so is a piece without spaces, however long.
An empty table stays empty. Other columns are kept; a column that has the name of
the result is replaced.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustledger.llm.common import offsets, ragged, ship, text_of

NO_PAIR = np.int32(2**31 - 1)
LONG = 256        # bytes; longer pieces are merged one by one
CELLS = 1 << 21   # of a matrix
KEPT = 300_000    # distinct cuts that a task remembers before it starts anew
INSIDE_RUN = re.compile(r"\s (?:\s|\Z)")  # only here would a cut before a space change the split


class Ranks:
    """Merge ranks as arrays: a hashed table of pairs, and the bytes of every id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.width = max(ranks.values(), default=0) + 1
        self.bytes = np.full(256, -1, np.int32)
        for b in range(256):
            self.bytes[b] = ranks.get(bytes([b]), -1)
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left * self.width + right)
                    values.append(rank)
        self._hash(np.array(keys, np.int64), np.array(values, np.int32))
        known = [b""] * self.width
        for token, rank in ranks.items():
            known[rank] = token
        self.lengths = np.array([len(t) for t in known], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.blob = np.frombuffer(b"".join(known), np.uint8)

    @classmethod
    def parse(cls, data: bytes) -> Ranks:
        return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a})

    def _hash(self, keys: np.ndarray, values: np.ndarray) -> None:
        bits = max(4, int(len(keys) * 3).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.slot_key, self.slot_rank = np.full(1 << bits, -2, np.int64), np.full(1 << bits, NO_PAIR, np.int32)
        at, left = self._slot(keys), np.arange(len(keys))
        while len(left):  # those that find a free slot first keep it, the others try the next
            free = left[self.slot_key[at[left]] == -2]
            self.slot_key[at[free]] = keys[free]
            self.slot_rank[at[free]] = values[free]
            left = left[self.slot_key[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids; NO_PAIR where they don't merge or an id is padding."""
        shape = left.shape
        keys = np.where((left < 0) | (right < 0), -1, left.astype(np.int64) * self.width + right).ravel()
        at = self._slot(keys)
        out = np.full(len(keys), NO_PAIR, np.int32)
        seen = self.slot_key[at]
        hit = seen == keys
        out[hit] = self.slot_rank[at[hit]]
        left_over = np.flatnonzero(~hit & (seen != -2) & (keys >= 0))
        while len(left_over):
            at[left_over] = (at[left_over] + 1) & self.mask
            seen = self.slot_key[at[left_over]]
            hit = seen == keys[left_over]
            out[left_over[hit]] = self.slot_rank[at[left_over[hit]]]
            left_over = left_over[~hit & (seen != -2)]
        return out.reshape(shape)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece; a piece that is a token itself is one id."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(pieces)
        rest: list[int] = []
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                out[i] = np.array([rank], np.int32)
            elif len(piece) > LONG:
                out[i] = self._merge_long(self.bytes[np.frombuffer(piece, np.uint8)])
            elif piece:
                rest.append(i)
        rest.sort(key=lambda i: len(pieces[i]))
        sizes = np.array([len(pieces[i]) for i in rest], np.int64)
        at = 0
        while at < len(rest):
            width = 1 << int(sizes[at] - 1).bit_length()
            stop = min(int(np.searchsorted(sizes, width, "right")), at + max(1, CELLS // width))
            rows, lengths = rest[at:stop], sizes[at:stop]
            flat = np.frombuffer(b"".join(pieces[i] for i in rows), np.uint8)
            matrix = np.full((len(rows), int(lengths[-1])), -1, np.int32)
            matrix[np.repeat(np.arange(len(rows)), lengths), ragged(np.zeros(len(rows), np.int64), lengths)] = self.bytes[flat]
            for row, ids in self._merge_rows(matrix):
                out[rows[row]] = ids
            at = stop
        return out

    def _merge_rows(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        rows = np.arange(len(ids))
        ranks = self.pairs(ids[:, :-1], ids[:, 1:])
        while len(rows):
            if ids.shape[1] == 1:
                best = np.full(len(rows), NO_PAIR)
            else:
                at = ranks.argmin(1)
                best = ranks[np.arange(len(rows)), at]
            done = best == NO_PAIR
            for row, line in zip(rows[done], ids[done], strict=True):
                yield int(row), line[line >= 0]
            if done.all():
                return
            if done.any():
                rows, ids, ranks, at, best = rows[~done], ids[~done], ranks[~done], at[~done], best[~done]
            each = np.arange(len(rows))
            ids[each, at] = best
            columns = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, columns + (columns > at[:, None]), 1)
            if ids.shape[1] == 1:
                continue
            columns = columns[:-1]
            ranks = np.take_along_axis(ranks, columns + (columns >= at[:, None]), 1)
            for place, ok in ((at - 1, at > 0), (at, at < ids.shape[1] - 1)):
                r, c = each[ok], place[ok]
                ranks[r, c] = self.pairs(ids[r, c], ids[r, c + 1])

    def _merge_long(self, ids: np.ndarray) -> np.ndarray:
        """One long row: all pairs of the lowest rank in a round, unless that makes a lower pair."""
        while len(ids) > 1:
            ranks = self.pairs(ids[:-1], ids[1:])
            low = ranks.min()
            if low == NO_PAIR:
                break
            at = np.flatnonzero(ranks == low)
            first = np.r_[True, np.diff(at) > 1]
            at = at[(np.arange(len(at)) - np.flatnonzero(first)[np.cumsum(first) - 1]) % 2 == 0]
            merged = self._merge_at(ids, at, low)
            places = at - np.arange(len(at))
            near = np.unique(np.r_[places - 1, places])
            near = near[(near >= 0) & (near < len(merged) - 1)]
            if len(at) > 1 and len(near) and self.pairs(merged[near], merged[near + 1]).min() < low:
                merged = self._merge_at(ids, at[:1], low)
            ids = merged
        return ids

    @staticmethod
    def _merge_at(ids: np.ndarray, at: np.ndarray, rank: np.int32) -> np.ndarray:
        ids = ids.copy()
        ids[at] = rank
        return np.delete(ids, at + 1)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the ids, one after the other."""
        return self.blob[ragged(self.starts[ids], self.lengths[ids])]


@functools.lru_cache(maxsize=2)
def _ranks(data: bytes) -> Ranks:
    return Ranks.parse(data)


class Encoder:
    """Encodes texts and remembers the ids of the cuts it has seen, up to a bound."""

    def __init__(self, ranks: Ranks, pattern: str, kept: int = KEPT):
        self.ranks, self.pattern, self.kept = ranks, regex.compile(pattern), kept
        self._forget()

    def _forget(self) -> None:
        self.at: dict[str, int] = {}
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int32)

    def _learn(self, cuts: list[str]) -> None:
        split = [[p.encode() for p in self.pattern.findall(c)] for c in cuts]
        pieces = list(dict.fromkeys(p for s in split for p in s))
        ids = dict(zip(pieces, self.ranks.encode_pieces(pieces), strict=True))
        arrays = [np.concatenate([ids[p] for p in s]) if s else np.zeros(0, np.int32) for s in split]
        sizes = np.array([len(a) for a in arrays], np.int64)
        starts = len(self.pool) + np.cumsum(sizes) - sizes
        for i, cut in enumerate(cuts, len(self.at)):
            self.at[cut] = i
        self.pool = np.concatenate([self.pool, *arrays])
        self.starts, self.sizes = np.r_[self.starts, starts], np.r_[self.sizes, sizes]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and how many each has."""
        if len(self.at) > self.kept:
            self._forget()
        cuts: list[str] = []
        counts = []
        for text in texts:
            if INSIDE_RUN.search(text):
                own = [text]
            else:
                own = text.replace(" ", "\0 ").split("\0") if "\0" not in text else [text]
            cuts += own
            counts.append(len(own))
        found = list(map(self.at.get, cuts))
        if None in found:
            self._learn(list(dict.fromkeys(c for c, f in zip(cuts, found, strict=True) if f is None)))
            found = list(map(self.at.__getitem__, cuts))
        at = np.array(found, np.int64)
        sizes = self.sizes[at]
        ends = np.r_[0, np.cumsum(sizes)][np.cumsum(counts, dtype=np.int64)] if counts else np.zeros(0, np.int64)
        return self.pool[ragged(self.starts[at], sizes)], np.diff(ends, prepend=0)


def _chunks(column: pa.Array, size: int = 4 << 20) -> Iterator[pa.Array]:
    lengths = np.diff(offsets(column)).astype(np.int64)
    part = (np.cumsum(lengths) - lengths) // size
    cuts = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(part)]
    for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
        if stop > start:
            yield column.slice(start, stop - start)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", to: str = "ids") -> DataFrame:
    """Adds ``to``, the ids of the whole text as array<int>, by the rank file at ``path``.

    The file is read on the driver and shipped with the task; it has one line for each token.
    """
    with open(path, "rb") as f:
        data = docs.sparkSession.sparkContext.broadcast(f.read())

    @F.arrow_udf("array<int>")
    def ids_of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(_ranks(data.value), pattern)  # goes with its task: what it remembers would stay beside later stages
        for column in columns:
            parts = []
            for part in _chunks(column):
                ids, counts = encoder.encode(part.to_pylist())
                parts.append(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(ids)))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return ship(docs).withColumn(to, ids_of(text_of(text)))


def decode(df: DataFrame, path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """Adds ``to``, the bytes that the ids stand for; null and empty arrays give no bytes."""
    with open(path, "rb") as f:
        data = df.sparkSession.sparkContext.broadcast(f.read())

    @F.arrow_udf("binary")
    def bytes_of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ranks = _ranks(data.value)
        for column in columns:
            parts = []
            for part in _chunks(column, 1 << 20):
                own = offsets(part).astype(np.int64)
                values = part.values.to_numpy()[own[0] : own[-1]]
                sizes = np.r_[0, np.cumsum(ranks.lengths[values])][own - own[0]].astype(np.int32)
                parts.append(pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(sizes), pa.py_buffer(ranks.decode(values))]))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.binary())

    return ship(df).withColumn(to, bytes_of(F.coalesce(F.col(ids), F.array().cast("array<int>"))))


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document, from the encoded and decoded text."""
    both = decode(encode(docs.select("doc_id", "text"), path, pattern), path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
