"""Documents in blocks of some million characters, each with the list of its distinct words.

A fact about every word of the corpus, such as its count, reaches the documents through one row for
each word of a block instead of one for each word of a text. Blocks and their words are staged as
they are made, so the parts always fit together, whatever is computed again later.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustledger import session
from gustledger.llm.common import as_binary, offsets, ship, stage

BLOCK_BYTES = 6 << 20
SCHEMA = "block long, payload binary, word string, at int, n long"
LISTED = "block long, payload binary, vocab binary, size long"


def pack(table: pa.Table) -> bytes:
    out = io.BytesIO()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table.combine_chunks())
    return out.getvalue()


def unpack(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def list_of(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and values of a list column."""
    column = pa.concat_arrays(table.column(name).chunks) if table.num_rows else pa.array([], table.schema.field(name).type)
    own = offsets(column).astype(np.int64)
    return np.diff(own), column.values.to_numpy()[own[0] : own[-1]]


def _numbered(rows: list[pa.RecordBatch], lower: bool) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """How many words every text has, the numbers of all, and the distinct words in the order of their numbers."""
    import pyarrow.compute as pc

    sizes, parts = [np.zeros(0, np.int64)], []
    for r in rows:
        texts = r.column(1)
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
        ends, words = offsets(lists).astype(np.int64), lists.values  # nothing stands between white space and either end
        full = pc.not_equal(pc.binary_length(words), 0)
        kept = np.r_[0, np.cumsum(full.to_numpy(zero_copy_only=False))]
        sizes.append(np.diff(kept[ends]))
        first, last = int(ends[0]), int(ends[-1])
        own = words.slice(first, last - first).filter(full.slice(first, last - first)).dictionary_encode()
        parts.append(pa.DictionaryArray.from_arrays(own.indices, own.dictionary.cast(pa.binary())))
    words = pa.chunked_array(parts, pa.dictionary(pa.int32(), pa.binary())).unify_dictionaries()
    flat = np.concatenate([np.zeros(0, np.int32), *(c.indices.to_numpy() for c in words.chunks)])
    return np.concatenate(sizes), flat, words.chunk(words.num_chunks - 1).dictionary


def _blocked(size: int, lower: bool, more: list[str], listed: bool = False):
    """Input columns: doc_id, text, counted and more. A payload has them, but the list of word numbers for the text."""

    def made(block: int, rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if listed:
            sizes, flat, at = _numbered(rows, lower)
        else:
            at: dict[bytes, int] = {}
            number, parts = at.setdefault, []
            for r in rows:  # one text's words at a time, so that only the distinct ones stay
                for text in as_binary(r.column(1)):
                    words = text.as_py()
                    parts.append(np.array([number(w, len(at)) for w in (words.lower() if lower else words).split()], np.int32))
            sizes = np.array([len(p) for p in parts], np.int64)
            flat = np.concatenate([np.zeros(0, np.int32), *parts])
        counted = np.concatenate([r.column(2).to_numpy(zero_copy_only=False) for r in rows]).astype(bool)
        n = np.bincount(flat[np.repeat(counted, sizes)], minlength=len(at))
        words = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(flat))
        ids = pa.chunked_array([r.column(0) for r in rows])
        rest = {c: pa.chunked_array([r.column(3 + i) for r in rows]) for i, c in enumerate(more)}
        payload = pack(pa.table({"doc_id": ids, "counted": pa.array(counted), "words": words, **rest}))
        if listed:
            vocab = pack(pa.table({"word": at, "n": pa.array(n.astype(np.int64))}))
            columns = [pa.array([v], k) for v, k in ((block, pa.int64()), (payload, pa.binary()), (vocab, pa.binary()), (len(at), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["block", "payload", "vocab", "size"])
            return
        yield _rows(block, payload=[payload])
        names = [w.decode() for w in at]
        for start in range(0, len(names), 1 << 16):
            stop = min(len(names), start + (1 << 16))
            yield _rows(block, word=names[start:stop], at=np.arange(start, stop, dtype=np.int32), n=n[start:stop])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rows, held = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            ends = np.cumsum(np.diff(offsets(batch.column(1))).astype(np.int64))
            start = 0
            while start < batch.num_rows:
                done = int(ends[start - 1]) if start else 0
                stop = min(batch.num_rows, max(start + 1, int(np.searchsorted(ends, done + size - held, "right"))))
                rows.append(batch.slice(start, stop - start))
                held += int(ends[stop - 1]) - done
                start = stop
                if held >= size or start < batch.num_rows:
                    yield from made(block, rows)
                    block, rows, held = block + 1, [], 0
        if rows:
            yield from made(block, rows)

    return run


def _rows(block: int, payload=None, word=None, at=None, n=None) -> pa.RecordBatch:
    size = len(payload if payload is not None else word)
    fill = lambda v, kind: pa.array(v, kind) if v is not None else pa.nulls(size, kind)
    columns = [pa.array(np.full(size, block), pa.int64()), fill(payload, pa.binary()), fill(word, pa.string()), fill(at, pa.int32()), fill(n, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["block", "payload", "word", "at", "n"])


def word_blocks(docs: DataFrame, size: int | None = None, lower: bool = True) -> DataFrame:
    """Staged rows: one payload for each block, and one (word, at, n) for each distinct word of it.

    ``docs`` has doc_id, text, counted and what else the payload shall hold; words are split at ASCII
    white space, with ``lower`` lower-cased in A-Z, ``at`` is the word's number in the payload, n how often counted documents of the block have it.
    """
    whole, more = _whole(docs)
    return stage(ship(whole).mapInArrow(_blocked(size or BLOCK_BYTES, lower, more), SCHEMA), "word-blocks")


def listed_blocks(docs: DataFrame, size: int | None = None, lower: bool = True) -> DataFrame:
    """Staged rows as of ``word_blocks``, one for each block: its words are a packed list (word, n), ``size`` is their number."""
    whole, more = _whole(docs)
    made = ship(whole).mapInArrow(_blocked(size or BLOCK_BYTES, lower, more, listed=True), LISTED)
    return session.stage(made, "listed-blocks", "uncompressed")  # what is packed doesn't shrink again


def _whole(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    more = [c for c in docs.columns if c not in ("doc_id", "text", "counted")]
    return docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce("counted", F.lit(False)).alias("counted"), *more,
    ), more


def words_of(blocks: DataFrame) -> DataFrame:
    return blocks.filter("word IS NOT NULL").select("block", "word", "at", "n")


def per_block(blocks: DataFrame, valued: DataFrame, fn: Callable[[pa.Table, dict[str, np.ndarray]], pa.Table], schema: str) -> DataFrame:
    """``fn(payload, values)`` for every block; ``valued`` has block, at and the values, which come as arrays by ``at``."""
    names = [c for c in valued.columns if c not in ("block", "at")]

    def run(key: tuple, payloads: pa.Table, values: pa.Table) -> pa.Table:
        order = np.argsort(values.column("at").to_numpy())
        arrays = {c: values.column(c).to_numpy()[order] for c in names}
        return pa.concat_tables([fn(unpack(p.as_py()), arrays) for p in payloads.column("payload")])

    payloads = blocks.filter("payload IS NOT NULL").select("block", "payload")
    valued = valued.select(F.col("block").alias("of_block"), "at", *names)  # both sides may come from the same table
    return ship(payloads).groupBy("block").cogroup(valued.groupBy("of_block")).applyInArrow(run, schema)
