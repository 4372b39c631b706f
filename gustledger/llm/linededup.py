"""Line dedup by a sharded minimal perfect hash.

Every long line of a document is known by a 128-bit digest: one half picks the shard and the slot,
the other is the fingerprint that tells whether the slot is really the line's. Distinct digests
with the number of their documents and the largest document id are dealt to shards; each shard
becomes one row of arrays: the levels of a minimal perfect hash, fingerprints, counts, ids. The
(digest, document) probes go to the shards, where they are looked up in the arrays; only lines to
drop come back to the documents. A shard with many probes is repeated for salted parts of them.

A null text is one empty line and stays null when nothing is dropped. Documents of a null id take
no part: their lines neither count nor go. Rows that share an id are one document. A tie can't
arise, as ids of distinct documents differ. A very long text is read some million characters at a
time. An empty table stays empty, other columns are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustledger.llm.common import SPACE, as_binary, mix64, ship, slices, stage

SHARD_KEYS = 1 << 14
SHARD_PROBES = 1 << 15
GAMMA = 2  # slots a key, in every level of the hash


def line_key(line: bytes) -> bytes:
    """The line without white space at its ends, A-Z in lower case."""
    return line.strip(SPACE).lower()


def is_long(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least)


def _digest(key: bytes) -> tuple[int, int]:
    d = xxhash.xxh3_128_intdigest(key)
    return d >> 64, d & 0xFFFFFFFFFFFFFFFF


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def _digests(least: int):
    """Rows (h1, h2, doc_id), each once for a row of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                highs, lows, at = [], [], []
                for i, text in enumerate(as_binary(part.column(1)).to_pylist()):
                    own = {_digest(k) for k in map(line_key, text.split(b"\n")) if is_long(k, least)}
                    for a, b in own:
                        highs.append(a)
                        lows.append(b)
                    at.append(len(own))
                ids = part.column(0).take(pa.array(np.repeat(np.arange(part.num_rows), at)))
                yield pa.RecordBatch.from_arrays([pa.array(_signed(highs)), pa.array(_signed(lows)), ids], ["h1", "h2", "doc_id"])

    return run


class PerfectHash:
    """Levels of bit arrays: a key sits in the first level where its slot was free of other keys."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, rest: np.ndarray):
        self.sizes, self.bits, self.rest = sizes, bits, rest
        self.starts = np.cumsum(sizes) - sizes
        self.before = np.cumsum(bits, dtype=np.int64) - bits

    @staticmethod
    def slots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        salted = mix64(keys.view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF))
        return (salted % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left, sizes, bits = keys, [], []
        for level in range(64):
            if not len(left):
                break
            size = GAMMA * len(left)
            at = cls.slots(left, level, size)
            taken = np.bincount(at, minlength=size)
            sizes.append(size)
            bits.append(taken == 1)
            left = left[taken[at] != 1]
        # Equal first halves never part; they follow in order, found by their place in this list.
        empty = np.zeros(0, bool)
        return cls(np.array(sizes, np.int64), np.concatenate([empty, *bits]), np.sort(left))

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key among all; any place or -1 for a key that wasn't there when built."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (start, size) in enumerate(zip(self.starts, self.sizes, strict=True)):
            at = start + self.slots(keys[left], level, int(size))
            hit = self.bits[at]
            out[left[hit]] = self.before[at[hit]]
            left = left[~hit]
        if len(self.rest) and len(left):
            at = np.searchsorted(self.rest, keys[left])
            ok = at < len(self.rest)
            ok[ok] = self.rest[at[ok]] == keys[left][ok]
            out[left[ok]] = int(self.bits.sum()) + at[ok]
        return out


INDEX = "shard long, sizes binary, bits binary, rest binary, prints binary, counts binary, largest binary"


def _build(key: tuple, table: pa.Table) -> pa.Table:
    keys, prints = (table.column(c).to_numpy() for c in ("h1", "h2"))
    order = np.lexsort((prints, keys))
    keys, prints = keys[order], prints[order]
    counts, largest = (table.column(c).to_numpy()[order] for c in ("n_docs", "last_doc"))
    # Distinct lines that share the first half are very rare; all but one of them go to the sorted rest.
    hashed = PerfectHash.build(keys)
    places = hashed.places(keys)
    same = np.r_[False, keys[1:] == keys[:-1]]
    run = np.arange(len(keys)) - np.maximum.accumulate(np.where(same, 0, np.arange(len(keys))))
    places = places + run
    put = lambda v, kind: v[np.argsort(places)].astype(kind).tobytes()
    row = [key[0].as_py(), hashed.sizes.tobytes(), np.packbits(hashed.bits).tobytes(), hashed.rest.tobytes(),
           put(prints, np.int64), put(counts, np.int64), put(largest, np.int64)]
    kinds = [pa.int64()] + [pa.binary()] * 6
    names = [c.split()[0] for c in INDEX.split(", ")]
    return pa.table({n: pa.array([v], k) for n, v, k in zip(names, row, kinds, strict=True)})


def _probe(least: int):
    def run(key: tuple, probes: pa.Table, index: pa.Table) -> pa.Table:
        out = {"doc_id": pa.array([], pa.int64()), "h1": pa.array([], pa.int64()), "h2": pa.array([], pa.int64())}
        if index.num_rows and probes.num_rows:
            row = {c: index.column(c)[0].as_py() for c in index.column_names if c not in ("shard", "salt")}
            sizes = np.frombuffer(row["sizes"], np.int64)
            bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=int(sizes.sum())).astype(bool)
            hashed = PerfectHash(sizes, bits, np.frombuffer(row["rest"], np.int64))
            prints, counts, largest = (np.frombuffer(row[c], k) for c, k in (("prints", np.int64), ("counts", np.int64), ("largest", np.int64)))
            h1, h2, ids = (probes.column(c).to_numpy() for c in ("h1", "h2", "doc_id"))
            at = hashed.places(h1)
            # Equal first halves stand next to each other: step on while the fingerprint differs.
            for _ in range(len(hashed.rest)):
                off = (at >= 0) & (at + 1 < len(prints)) & (prints[np.minimum(at, len(prints) - 1)] != h2)
                if not off.any():
                    break
                at[off] += 1
            drop = (at >= 0) & (prints[at] == h2) & (counts[at] >= least) & (largest[at] != ids)
            out = {"doc_id": pa.array(ids[drop]), "h1": pa.array(h1[drop]), "h2": pa.array(h2[drop])}
        return pa.table(out)

    return run


def lines_to_drop(docs: DataFrame, min_length: int = 40, min_docs: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and drop, the digests of the lines that leave the document; documents that keep all are not there."""
    rows = ship(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).filter(
        F.col("doc_id").isNotNull() & (F.octet_length("text") >= min_length)
    )
    found = rows.mapInArrow(_digests(min_length), "h1 long, h2 long, doc_id long").distinct()
    found = stage(found, "line-digests")
    keys = stage(found.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc")), "line-keys")
    shards = max(1, math.ceil(keys.count() / SHARD_KEYS))
    shard = F.pmod(F.xxhash64("h1"), F.lit(shards))
    keys, found = keys.withColumn("shard", shard), found.withColumn("shard", shard)
    index = stage(keys.groupBy("shard").applyInArrow(_build, INDEX), "line-index")
    salts = found.groupBy("shard").agg(F.ceil(F.count("*") / SHARD_PROBES).cast("int").alias("salts"))
    parts = index.join(salts, "shard").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    dealt = found.join(salts, "shard").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int"))
    probes = dealt.select("shard", "salt", "doc_id", "h1", "h2").groupBy("shard", "salt").cogroup(parts.groupBy("shard", "salt"))
    dropped = probes.applyInArrow(_probe(min_docs), "doc_id long, h1 long, h2 long")
    return dropped.groupBy("doc_id").agg(F.collect_list(F.struct("h1", "h2")).alias("drop"))


def _cleaned(least: int, changes: bool):
    """Rewrites the text in the second last column by the digests in the last one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, batch.num_columns - 2):
                texts, kept, lines, gone = as_binary(part.column(part.num_columns - 2)).to_pylist(), [], [], []
                for text, drop in zip(texts, part.column(part.num_columns - 1).to_pylist(), strict=True):
                    if not drop or text is None:
                        lines.append(1 if text is None else text.count(b"\n") + 1)
                        gone.append(0)
                        kept.append(text)
                        continue
                    bad = {(d["h1"] & 0xFFFFFFFFFFFFFFFF, d["h2"] & 0xFFFFFFFFFFFFFFFF) for d in drop}
                    own = text.split(b"\n")
                    stay = [x for x in own if not (is_long(k := line_key(x), least) and _digest(k) in bad)]
                    lines.append(len(own))
                    gone.append(len(own) - len(stay))
                    kept.append(b"\n".join(stay))
                columns = [part.column(i) for i in range(part.num_columns - 2)]
                columns += [pa.array(kept, pa.binary()).cast(pa.string()), pa.array(lines, pa.int64()), pa.array(gone, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [f"c{i}" for i in range(len(columns))])

    return run


def dedup_lines(docs: DataFrame, min_length: int = 40, min_docs: int = 5, doc_id: str = "doc_id", text: str = "text", counts: bool = False) -> DataFrame:
    """The documents with their repeated lines gone; with ``counts`` also n_lines and n_dropped."""
    drops = lines_to_drop(docs, min_length, min_docs, doc_id, text)
    names = [c for c in docs.columns if c != text]
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.col(text).cast("string").alias("__text"))
    at = plain[f"c{names.index(doc_id)}"].cast("long")
    joined = plain.join(drops.withColumnRenamed("doc_id", "__id"), at == F.col("__id"), "left").drop("__id")
    kinds = [f"c{i} {f}" for i, f in enumerate(plain.schema[f"c{i}"].dataType.simpleString() for i in range(len(names)))]
    last = len(names)
    schema = ", ".join([*kinds, f"c{last} string", f"c{last + 1} long", f"c{last + 2} long"])
    clean = joined.mapInArrow(_cleaned(min_length, counts), schema)
    back = {c: F.col(f"c{i}").alias(c) for i, c in enumerate([*names, text])}
    if not counts:
        return clean.select(*[back[c] for c in docs.columns])
    rest = [back[c] for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return clean.select(*rest, F.col(f"c{last + 1}").alias("n_lines"), F.col(f"c{last + 2}").alias("n_dropped"))
