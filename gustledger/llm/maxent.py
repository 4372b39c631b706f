"""Language model scoring by a hashed maximum-entropy model.

A token's probability is that of its class, given the context, times that of the token in its
class. Frequent words sit in classes of equal size, where a second softmax tells them apart; all
other words share classes by their endings, where counts tell them apart. Classes come from a
balanced bisection by what stands before a word. The features are the word before, a hashed pair
of the two before, and the one before those skipped over; their weights start at zero, that is at
the class-factored unigram model, and are learned by gradient steps: every task runs over its part
of the training texts, the steps of all tasks are averaged by their tokens, and the next part goes
on from there. Every training token is used once. These weights and the classes are of fixed size
and tell rare words apart by their endings only.

On that base, every known word takes part in features of its own, as target and as context: the
word before the last, the word before, and the pair of both, each with the word that follows. Their
counts grow with the distinct pairs and triples of the input, stay in sharded tables and reach the
documents by block. They are not learned by gradient steps: each kind moves the probabilities under
it to the discounted counts of its context and leaves the rest of the mass to them, so that all
words together still have the probability one. Words and contexts are known by 64-bit hashes, of
which the tables keep 56 bits.

A null text has only its end token. An end is a token of its own and can't be a word. Rows that
repeat are documents of their own, a null id counts as the empty text when documents are held out.
Without training tokens all scores come from the uniform start. A very long text is read whole, and
is not divided between blocks. An empty table gives an empty result. Frequent words of equal counts go by the text. Other columns are not looked at.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustledger import session
from gustledger.llm.blocks import list_of, listed_blocks, pack, unpack
from gustledger.llm.common import crc_part, mix64, shuffles_removed, stage

HEAD = 256          # the end token and the most frequent words, which features tell apart
ENDINGS = 1024      # buckets of the endings of all other words
CLASSES = 8         # of frequent words, and as many of endings
SIZE = HEAD // CLASSES
END = HEAD - 1                # code of the end token
START = HEAD + ENDINGS        # what stands before the first token
CODES = START + 1
CONTEXTS = 64       # most frequent words that the classes look at
PAIRS = 4096        # buckets of word pairs
ROWS = 2 * CODES + PAIRS
INNER = 8192        # buckets of (feature, class)
PARTS = 4           # rounds, each over a part of the training texts
BATCH = 1 << 14
RATE = 0.4
KINDS = 3           # of counted features: the word before the last, the word before, the pair
WORDS = 2           # level of the counts of words; contexts are of level 1, contexts with their words of level 0
SHARD_TOKENS, SHARD_WORDS = 1 << 21, 1 << 20
END_HASH, START_HASH = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass
class Model:
    """What a task needs: for each code its class and its place in it, the starting logarithms, and the weights."""

    classes: np.ndarray      # (CODES,)
    places: np.ndarray       # (CODES,) place in the class, 0 for endings
    prior: np.ndarray        # (2 * CLASSES,) log probability of each class
    inside: np.ndarray       # (CLASSES, SIZE) log probability of each frequent word in its class
    rest: np.ndarray         # (2 * CLASSES,) log10 of what the counts of an ending's class are divided by
    outer: np.ndarray        # (ROWS, classes)
    inner: np.ndarray        # (INNER, SIZE)


def _context(codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codes one and two places before, START where the text has not begun."""
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(codes)) - np.repeat(starts, sizes)
    one, two = np.full(len(codes), START, np.int64), np.full(len(codes), START, np.int64)
    one[1:], two[2:] = codes[:-1], codes[:-2]
    one[place < 1], two[place < 2] = START, START
    return one, two


def _features(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    pair = mix64((two * CODES + one).astype(np.uint64)) % np.uint64(PAIRS)
    return np.stack([one, CODES + two, 2 * CODES + pair.astype(np.int64)])


def _softmax(scores: np.ndarray) -> np.ndarray:
    most = scores[:, 0].copy()
    for column in scores.T[1:]:  # much faster than the maximum along short rows
        np.maximum(most, column, out=most)
    scores -= most[:, None]
    np.exp(scores, out=scores)
    scores /= scores.sum(1, keepdims=True)
    return scores


def _inner_rows(features: np.ndarray, classes: np.ndarray) -> np.ndarray:
    return (mix64((features * CLASSES + classes).astype(np.uint64)) % np.uint64(INNER)).astype(np.int64)


def _step(weights: np.ndarray, rows: np.ndarray, slope: np.ndarray) -> None:
    """Moves the rows against the slopes summed over their tokens; more tokens of a row count by their root."""
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    sorted_rows = rows[order]
    starts = np.flatnonzero(np.r_[True, sorted_rows[1:] != sorted_rows[:-1]])
    counts = np.diff(np.r_[starts, len(rows)])
    more = counts > 1  # a row of one token needs no sum
    sums = np.empty((len(starts), slope.shape[1]), slope.dtype)
    sums[~more] = slope.take(order[starts[~more]], 0)
    if more.any():
        sums[more] = np.add.reduceat(slope.take(order[np.repeat(more, counts)], 0), np.cumsum(counts[more]) - counts[more], axis=0)
    weights[sorted_rows[starts]] -= (RATE / np.sqrt(counts))[:, None].astype(np.float32) * sums


def probabilities(model: Model, codes: np.ndarray, one: np.ndarray, two: np.ndarray, learn: bool = False) -> np.ndarray:
    """log10 probability of each token's class and, for frequent words, of the word in it; learns from them on request."""
    out = np.zeros(len(codes))
    for at in range(0, len(codes), BATCH):
        c = codes[at : at + BATCH]
        n, features = len(c), _features(one[at : at + BATCH], two[at : at + BATCH])
        each, target = np.arange(n), model.classes[c]
        p = model.outer.take(features[0], 0)
        for f in features[1:]:
            p += model.outer.take(f, 0)
        p += model.prior
        p = _softmax(p)
        logs = np.log10(np.maximum(p[each, target], 1e-30))
        head = np.flatnonzero(target < CLASSES)
        own, place = target[head], model.places[c[head]]
        rows = [_inner_rows(f[head], own) for f in features]
        q = model.inner.take(rows[0], 0)
        for r in rows[1:]:
            q += model.inner.take(r, 0)
        q += model.inside.take(own, 0)
        q = _softmax(q) if len(head) else q
        logs[head] += np.log10(np.maximum(q[np.arange(len(head)), place], 1e-30))
        out[at : at + n] = logs
        if learn:
            p[each, target] -= 1
            for f in features:
                _step(model.outer, f, p)
            if len(head):
                q[np.arange(len(head)), place] -= 1
                for r in rows:
                    _step(model.inner, r, q)
    return out


# --- sums of arrays over tasks ------------------------------------------------------------------

PIECE = 1 << 15


def _pieces(values: np.ndarray) -> Iterator[pa.RecordBatch]:
    """An array as rows (salt, piece, data); pieces of zeros are left out."""
    from pyspark import TaskContext

    flat, salt = values.ravel().astype(np.float32), TaskContext.get().partitionId() % 64
    for i, start in enumerate(range(0, len(flat), PIECE)):
        part = flat[start : start + PIECE]
        if part.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array([salt], pa.int32()), pa.array([i], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["salt", "piece", "data"]
            )


def _added(key: tuple, table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py(), np.float32).astype(np.float64) for x in table.column("data"))
    return pa.table({"piece": pa.array([key[0].as_py()], pa.int32()), "data": pa.array([total.astype(np.float32).tobytes()], pa.binary())})


def _summed(pieces: DataFrame, size: int) -> np.ndarray:
    """The sum of the arrays that the tasks gave as pieces, in two steps; its size is fixed."""
    first = pieces.groupBy("piece", "salt").applyInArrow(_added, "piece int, data binary")
    out = np.zeros(math.ceil(size / PIECE) * PIECE)
    for row in first.groupBy("piece").applyInArrow(_added, "piece int, data binary").collect():
        part = np.frombuffer(row["data"], np.float32)
        out[row["piece"] * PIECE : row["piece"] * PIECE + len(part)] = part
    return out[:size]


# --- classes ------------------------------------------------------------------------------------

def _bisect(rows: np.ndarray, weight: np.ndarray, levels: int, seed: int = 1) -> np.ndarray:
    """2 ** levels classes of equal size, from halves along the first principal axis, again and again."""
    out = np.zeros(len(rows), np.int64)
    for _ in range(levels):
        new = np.zeros(len(rows), np.int64)
        for c in np.unique(out):
            own = np.flatnonzero(out == c)
            x = rows[own] - np.average(rows[own], 0, weights=weight[own] + 1e-9)
            _, axes = np.linalg.eigh((x * (weight[own] + 1e-9)[:, None]).T @ x)
            order = np.argsort(x @ axes[:, -1], kind="stable")
            half = np.zeros(len(own), np.int64)
            half[order[(len(own) + 1) // 2 :]] = 1
            new[own] = 2 * c + half
        out = new
    return out


def _classes(before: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class and place of every code, from how often each frequent word stands before it."""
    rows = np.sqrt(before + 1e-3)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    levels = CLASSES.bit_length() - 1
    classes, places = np.zeros(CODES, np.int64), np.zeros(CODES, np.int64)
    classes[:HEAD] = _bisect(rows[:HEAD], counts[:HEAD], levels)
    classes[HEAD:START] = CLASSES + _bisect(rows[HEAD:START], counts[HEAD:START], levels)
    for c in range(CLASSES):
        own = np.flatnonzero(classes[:HEAD] == c)
        places[own] = np.arange(len(own))
    return classes, places


# --- counts of words ----------------------------------------------------------------------------

ASKED_WORDS = "block long, shard int, size int, words binary, n binary"
WORD_COUNTS = "of_block long, shard int, n binary, word binary, code int, c long, v long"


def _squeezed(values: np.ndarray) -> bytes:
    """Numbers as their bytes by place, the lowest of all first, as many as the largest has, compressed; their count comes first."""
    values = np.ascontiguousarray(values, np.uint64)
    width = (int(values.max(initial=0)).bit_length() + 7) // 8
    planes = values.astype(np.uint8) if width == 1 else values.view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + (pa.compress(planes.tobytes(), "zstd", asbytes=True) if width else b"")


def _loose(data: bytes, size: int) -> np.ndarray:
    width = data[0]
    out = np.zeros((size, 8), np.uint8)
    if width:
        out[:, :width] = np.frombuffer(pa.decompress(data[1:], size * width, "zstd", asbytes=True), np.uint8).reshape(width, size).T
    return out.view(np.uint64)[:, 0]


def _hash_of(words: pa.Array) -> np.ndarray:
    """64-bit hashes of words, the same in every worker."""
    import pandas as pd

    return pd.util.hash_array(words.to_numpy(zero_copy_only=False).astype(object), categorize=False).astype(np.uint64)


def _endings(words: pa.Array) -> np.ndarray:
    """Codes of words by their last two letters."""
    import pyarrow.compute as pc

    last = pc.utf8_slice_codeunits(words.cast(pa.string()), -2).dictionary_encode()
    codes = [HEAD + zlib.crc32(w.encode()) % ENDINGS for w in last.dictionary.to_pylist()]
    return np.array(codes, np.int64)[last.indices.to_numpy()]


def _words(vocab: bytes) -> tuple[pa.Array, np.ndarray]:
    """A block's words, and how often its training texts have them."""
    table = unpack(vocab)
    return pa.concat_arrays([pa.array([], pa.binary()), *table.column("word").chunks]), table.column("n").to_numpy()


def _by_hash(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """The order of hashes, and for each shard that has some, its number and the part of the order that is in it."""
    order = np.argsort(hashes, kind="stable")
    cuts = np.r_[0, np.cumsum(np.bincount((hashes >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits))]
    return order, [(int(i), slice(cuts[i], cuts[i + 1])) for i in np.flatnonzero(np.diff(cuts))]


def _asked_words(bits: int):
    """Every block's words by shard, in the order of their hashes, with how often its training texts have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, vocab in zip(*batch.columns, strict=True):
                words, n = _words(vocab.as_py())
                order, parts = _by_hash(_hash_of(words), bits)
                words, n = words.take(pa.array(order)), n[order]
                rows = [(block.as_py(), i, p.stop - p.start, pack(pa.table({"word": words[p.start : p.stop]})), _squeezed(n[p])) for i, p in parts]
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds, strict=True)], ["block", "shard", "size", "words", "n"])

    return run


def _word_totals(key: tuple, cells: pa.Table) -> pa.Table:
    """The counts of a shard's words for each block that asked, in its order; then training words by ending, and the most frequent ones."""
    sizes, shard = cells.column("size").to_numpy(), key[0].as_py()
    ends = np.cumsum(sizes)
    words = pa.concat_arrays([c for v in cells.column("words") for c in unpack(v.as_py()).column("word").chunks]).dictionary_encode()
    at, words = words.indices.to_numpy(), words.dictionary
    n = np.concatenate([_loose(v.as_py(), s) for v, s in zip(cells.column("n"), sizes, strict=True)])
    c = np.bincount(at, n, len(words)).astype(np.int64)
    answers = [_squeezed(c[at[e - s : e]]) for s, e in zip(sizes, ends, strict=True)]
    trained = np.flatnonzero(c)
    codes = _endings(words.take(pa.array(trained)))
    v = np.bincount(codes, minlength=START)
    sums = np.bincount(codes, c[trained], START).astype(np.int64)
    some = np.flatnonzero(v)
    least = np.partition(c[trained], -END)[-END] if len(trained) > END else 0
    top = np.flatnonzero(c[trained] >= max(least, 1))
    listed = sorted((-int(c[trained[i]]), words[int(trained[i])].as_py(), int(codes[i])) for i in top)[:END]
    a, b, d = len(answers), len(some), len(listed)
    columns = {
        "of_block": [*cells.column("block").to_pylist(), *[None] * (b + d)], "shard": [shard] * (a + b + d), "n": answers + [None] * (b + d),
        "word": [None] * (a + b) + [w for _, w, _ in listed], "code": [None] * a + some.tolist() + [k for *_, k in listed],
        "c": [None] * a + sums[some].tolist() + [-m for m, *_ in listed], "v": [None] * a + v[some].tolist() + [None] * d,
    }
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.int64())
    return pa.table([pa.array(x, k) for x, k in zip(columns.values(), kinds, strict=True)], list(columns))


# --- passes over the documents ------------------------------------------------------------------

def _with_ends(sizes: np.ndarray, inner: np.ndarray, end) -> np.ndarray:
    """Values of all tokens, with that of the end after each document; ``sizes`` count the ends."""
    ends = np.cumsum(sizes)
    out = np.full(int(ends[-1]) if len(ends) else 0, end, inner.dtype)
    inside = np.ones(len(out), bool)
    inside[ends - 1] = False
    out[inside] = inner
    return out


def _text(payload: bytes, vocab: bytes) -> tuple[pa.Table, pa.Array, np.ndarray, np.ndarray]:
    """A block's table, its words, their numbers in the documents, and the tokens of each document."""
    table = unpack(payload)
    sizes, at = list_of(table, "words")
    return table, _words(vocab)[0], at, sizes + 1


def _codes(words: pa.Array, at: np.ndarray, sizes: np.ndarray, top: list[bytes]) -> np.ndarray:
    """The codes of a block's tokens, those of the frequent words ``top`` by their places in it."""
    import pyarrow.compute as pc

    head = pc.fill_null(pc.index_in(words, pa.array(top, pa.binary())), -1).to_numpy(zero_copy_only=False)
    return _with_ends(sizes, np.where(head >= 0, head, _endings(words))[at], END)


def _texts(batches: Iterator[pa.RecordBatch], top: list[bytes], chosen=None) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Each block's table, its codes with the end tokens, and the tokens of each document; of those only that ``chosen`` picks."""
    for batch in batches:
        for payload, vocab in zip(batch.column(0), batch.column(1), strict=True):
            table, words, at, sizes = _text(payload.as_py(), vocab.as_py())
            if chosen:
                mine = chosen(table, sizes)
                at, sizes = at[np.repeat(mine, sizes - 1)], sizes[mine]
            yield table, _codes(words, at, sizes, top), sizes


def _trained(table: pa.Table, sizes: np.ndarray) -> np.ndarray:
    return table.column("counted").combine_chunks().to_numpy(zero_copy_only=False).astype(bool)


def _before(top: list[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CODES * CONTEXTS)
        for table, codes, sizes in _texts(batches, top):
            one, two = _context(codes, sizes)
            use = np.repeat(_trained(table, sizes), sizes)
            for c in (one, two):
                ok = use & (c < CONTEXTS)
                total += np.bincount(codes[ok] * CONTEXTS + c[ok], minlength=CODES * CONTEXTS)
        yield from _pieces(total)

    return run


def _learned(sent, part: int, top: list[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start: Model = sent.value
        model = Model(**{**vars(start), "outer": start.outer.copy(), "inner": start.inner.copy()})
        tokens = 0
        for _, codes, sizes in _texts(batches, top, lambda table, sizes: _trained(table, sizes) & (np.arange(len(sizes)) % PARTS == part)):
            if len(codes):
                probabilities(model, codes, *_context(codes, sizes), learn=True)
                tokens += len(codes)
        if tokens:
            moved = np.concatenate([(model.outer - start.outer).ravel(), (model.inner - start.inner).ravel()]) * tokens
            yield from _pieces(np.r_[moved, tokens])

    return run


# --- counted features of all words ----------------------------------------------------------------

COUNTS = "of_block long, level int, kind int, shard int, n binary, t binary, own binary, once long, twice long"


class Features:
    """A block's tokens by number: words by their place in its list, then the end, then what stands before the first.

    ``one`` and ``two`` are the numbers of the words before and of those before them.
    """

    def __init__(self, words: pa.Array, at: np.ndarray, sizes: np.ndarray) -> None:
        end, start = len(words), len(words) + 1
        own = _with_ends(sizes, at.astype(np.int64), end)
        self.firsts = np.cumsum(sizes) - sizes
        self.one = np.r_[start, own[:-1]]
        self.one[self.firsts] = start
        self.two = np.r_[start, self.one[:-1]]
        self.two[self.firsts] = start
        self.hashes = np.r_[_hash_of(words), END_HASH, START_HASH]
        self.mixed = mix64(self.hashes)
        self.tokens = self.mixed[own]

    def _context(self, kind: int) -> np.ndarray:
        return mix64(mix64(self.hashes + np.uint64(1)) ^ np.uint64(1 << 40)) if kind == 0 else mix64(self.hashes ^ np.uint64(2 << 40))

    def contexts(self, kind: int) -> np.ndarray:
        """For each number its hash as the word before the last, or as the word before; 56 bits."""
        return self._context(kind) >> np.uint64(8)

    @functools.cached_property
    def _pairs(self) -> np.ndarray:
        return mix64(self._context(1)[self.one] + self.tokens)

    def keys(self, kind: int) -> np.ndarray:
        """The hash of every token's context with the token; 56 bits. The context of a triple is the key of the pair before it."""
        if kind == 0:
            return mix64(self._context(0)[self.two] + self.tokens) >> np.uint64(8)
        if kind == 1:
            return self._pairs >> np.uint64(8)
        seen = np.r_[END_HASH, self._pairs[:-1]]
        seen[self.firsts] = mix64(self._context(1)[-1:] + self.mixed[-1:])
        return mix64(mix64(seen ^ np.uint64(3 << 40)) + self.tokens) >> np.uint64(8)


def _before_it(inverse: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each token the number of the pair that stands before it, -1 for the first of a document."""
    out = np.r_[-1, inverse[:-1]]
    out[np.cumsum(sizes) - sizes] = -1
    return out


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where the runs of equal values start."""
    return np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and the number of each key in them."""
    order = np.argsort(keys)
    ordered = keys[order]
    starts = _starts(ordered)
    numbers = np.empty(len(keys), np.int32)
    numbers[order] = np.repeat(np.arange(len(starts), dtype=np.int32), np.diff(np.r_[starts, len(keys)]))
    return ordered[starts], numbers


def _one_of_each(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and for each one a place where it is found."""
    order = np.argsort(keys)
    ordered = keys[order]
    starts = _starts(ordered)
    return ordered[starts], order[starts]


def _cells(block: int, level: int, kind: int, keys: np.ndarray, n: np.ndarray, t: np.ndarray, bits: int) -> pa.RecordBatch:
    """What a block asks of each shard: its sorted keys as differences, and what it adds to their sums."""
    cuts = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(56 - bits))
    cuts = np.r_[0, cuts, len(keys)]
    full = np.flatnonzero(np.diff(cuts))
    parts = [slice(cuts[i], cuts[i + 1]) for i in full]
    fixed = [pa.array(np.full(len(full), v), k) for v, k in ((block, pa.int64()), (level, pa.int32()), (kind, pa.int32()))]
    sizes = pa.array([p.stop - p.start for p in parts], pa.int32())
    packed = [pa.array([_squeezed(v) for v in vs], pa.binary()) for vs in ([np.diff(keys[p], prepend=np.uint64(0)) for p in parts], [n[p] for p in parts], [t[p] for p in parts])]
    return pa.RecordBatch.from_arrays([*fixed, pa.array(full, pa.int32()), sizes, *packed], ["block", "level", "kind", "shard", "size", "keys", "n", "t"])


ASKED = "block long, level int, kind int, shard int, size int, keys binary, n binary, t binary"


def _asked(kinds: tuple[int, ...], bits: int):
    """Every block's distinct features of some kinds, with how often its training texts have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, payload, vocab in zip(*batch.columns, strict=True):
                table, words, at, sizes = _text(payload.as_py(), vocab.as_py())
                use = np.repeat(_trained(table, sizes), sizes)
                use, features = use.astype(np.uint64), Features(words, at, sizes)
                for kind in kinds:
                    flagged = np.sort(features.keys(kind) << np.uint64(1) | use)
                    starts = _starts(flagged >> np.uint64(1))
                    n = np.add.reduceat((flagged & np.uint64(1)).astype(np.int64), starts)
                    yield _cells(block.as_py(), 0, kind, flagged[starts] >> np.uint64(1), n, np.zeros(len(starts)), bits)

    return run


def _totals(key: tuple, cells: pa.Table) -> pa.Table:
    """The sums of a shard for each block that asked, in the order of its keys; the first block that has a key in training owns it."""
    cells = cells.sort_by("block")
    sizes = cells.column("size").to_numpy()
    ends = np.cumsum(sizes)
    read = lambda c: [_loose(v.as_py(), n) for v, n in zip(cells.column(c), sizes, strict=True)]
    keys = np.concatenate([np.cumsum(v, dtype=np.uint64) for v in read("keys")])
    order = np.argsort(keys)
    starts = _starts(keys[order])
    runs = np.diff(np.r_[starts, len(keys)])
    each, owned = [], np.zeros(len(keys), bool)
    for column in ("n", "t"):
        values = np.concatenate(read(column))
        if not values.any():
            each.append((np.zeros(len(starts), np.uint64), values))
            continue
        ordered = values[order]
        if column == "n":
            first = np.minimum.reduceat(np.where(ordered > 0, order, len(keys)), starts)
            owned[first[first < len(keys)]] = True
        sums = np.add.reduceat(ordered, starts)
        values[order] = np.repeat(sums, runs)
        each.append((sums, values))
    n, parts = each[0][0], [slice(e - s, e) for s, e in zip(sizes, ends, strict=True)]
    each = [pa.array([_squeezed(v[p]) for p in parts], pa.binary()) for _, v in each]
    own = pa.array([np.packbits(owned[p]).tobytes() for p in parts], pa.binary())
    some = [pa.array(np.r_[int((n == k).sum()), np.zeros(len(parts) - 1, np.int64)].astype(np.int64)) for k in (1, 2)]
    columns = [cells.column("block"), cells.column("level"), cells.column("kind"), cells.column("shard"), *each, own, *some]
    return pa.table(columns, COUNTS.replace(" long", "").replace(" int", "").replace(" binary", "").split(", "))


def _cells_of(counts: pa.Table, level: int, kind: int, keys: np.ndarray, bits: int) -> tuple[pa.Table, np.ndarray]:
    """The cells that came for a block's sorted keys, in their order, and how many keys each has."""
    import pyarrow.compute as pc

    own = counts.filter(pc.and_(pc.equal(counts.column("level"), level), pc.equal(counts.column("kind"), kind))).sort_by("shard")
    cuts = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(56 - bits))
    sizes = np.diff(np.r_[0, cuts, len(keys)])
    return own, sizes[sizes > 0]


def _joined(cells: pa.Table, sizes: np.ndarray, column: str) -> np.ndarray:
    return np.concatenate([np.zeros(0), *(_loose(v.as_py(), s) for v, s in zip(cells.column(column), sizes, strict=True))]).astype(np.float64)


def _bits_of(cells: pa.Table, sizes: np.ndarray) -> np.ndarray:
    bit = [np.unpackbits(np.frombuffer(v.as_py(), np.uint8), count=s) for v, s in zip(cells.column("own"), sizes, strict=True)]
    return np.concatenate([np.zeros(0), *bit]).astype(np.float64)


def _owned(counts: pa.Table, kind: int, keys: np.ndarray, bits: int) -> np.ndarray:
    """Which of a block's sorted features it owns."""
    return _bits_of(*_cells_of(counts, 0, kind, keys, bits))


def _columns_of(counts: pa.Table, level: int, kind: int, keys: np.ndarray, bits: int, *columns: str) -> list[np.ndarray]:
    """Sums of a block's sorted keys, by their columns."""
    cells, sizes = _cells_of(counts, level, kind, keys, bits)
    return [_joined(cells, sizes, c) for c in columns]


def _sums_of(counts: pa.Table, level: int, kind: int, keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """n, t and the ownership of a block's sorted keys."""
    cells, sizes = _cells_of(counts, level, kind, keys, bits)
    return _joined(cells, sizes, "n"), _joined(cells, sizes, "t"), _bits_of(cells, sizes)


NOTHING = pa.RecordBatch.from_arrays([pa.nulls(0, k) for k in (pa.int64(), *[pa.int32()] * 4, *[pa.binary()] * 3)], [c.split()[0] for c in ASKED.split(", ")])


def _pairs(bits: int):
    """Every block's features of a pair, with their training tokens, and the different words that it owns after each pair."""

    def run(key: tuple, texts: pa.Table, counts: pa.Table) -> pa.Table:
        out = [NOTHING]
        for payload, vocab in zip(texts.column("payload"), texts.column("vocab"), strict=True):
            table, words, at, sizes = _text(payload.as_py(), vocab.as_py())
            use, features = np.repeat(_trained(table, sizes), sizes), Features(words, at, sizes)
            keys, first = _one_of_each(features.keys(2))
            own = _owned(counts, 2, keys, bits)
            keys, inverse = _numbered(features.keys(1))
            after = _before_it(inverse, sizes)[first]
            t = np.bincount(after[after >= 0], own[after >= 0], len(keys))
            out.append(_cells(key[0].as_py(), 0, 1, keys, np.bincount(inverse, use, len(keys)), t, bits))
        return pa.Table.from_batches(out)

    return run


def _contexts(bits: int):
    """Every block's words as contexts, with their training tokens and the different words that it owns after them."""

    def run(key: tuple, texts: pa.Table, counts: pa.Table) -> pa.Table:
        out = [NOTHING]
        for payload, vocab in zip(texts.column("payload"), texts.column("vocab"), strict=True):
            table, words, at, sizes = _text(payload.as_py(), vocab.as_py())
            use, features = np.repeat(_trained(table, sizes), sizes), Features(words, at, sizes)
            for kind, before in enumerate((features.two, features.one)):
                keys, first = _one_of_each(features.keys(kind))
                own, contexts = _owned(counts, kind, keys, bits), features.contexts(kind)
                n, t = np.bincount(before, use, len(contexts)), np.bincount(before[first], own, len(contexts))
                keys, inverse = np.unique(contexts, return_inverse=True)
                out.append(_cells(key[0].as_py(), 1, kind, keys, np.bincount(inverse, n, len(keys)), np.bincount(inverse, t, len(keys)), bits))
        return pa.Table.from_batches(out)

    return run


def interpolated(p: np.ndarray, n: np.ndarray, total: np.ndarray, different: np.ndarray, off: float) -> np.ndarray:
    """The discounted counts of words in their contexts; what is taken off goes to the words by ``p``."""
    known = total > 0
    return np.where(known, (np.maximum(n - off, 0) + off * different * p) / np.where(known, total, 1), p)


def _word_counts(counts: pa.Table, words: pa.Array, bits: int) -> np.ndarray:
    """How often all training texts have each of a block's words."""
    import pyarrow.compute as pc

    own = counts.filter(pc.equal(counts.column("level"), WORDS)).sort_by("shard")
    order, parts = _by_hash(_hash_of(words), bits)
    out = np.zeros(len(words), np.int64)
    for v, (_, p) in zip(own.column("n"), parts, strict=True):
        out[order[p]] = _loose(v.as_py(), p.stop - p.start)
    return out


def _scored(sent, top: list[bytes], offs: list[float], bits: int, word_bits: int):
    def run(key: tuple, texts: pa.Table, counts: pa.Table) -> pa.Table:
        model: Model = sent.value
        out = []
        for payload, vocab in zip(texts.column("payload"), texts.column("vocab"), strict=True):
            table, words, at, sizes = _text(payload.as_py(), vocab.as_py())
            c, codes, rows = _word_counts(counts, words, word_bits), _codes(words, at, sizes, top), np.repeat(np.arange(len(sizes)), sizes - 1)
            n_known = np.bincount(rows, (c > 0)[at], len(sizes)).astype(np.int64)
            all_logs = np.bincount(rows, np.log10(c + 0.1)[at], len(sizes))
            logs = probabilities(model, codes, *_context(codes, sizes))
            logs += np.where(codes >= HEAD, np.log10(_with_ends(sizes, c[at], 0) + 0.1) - model.rest[model.classes[codes]], 0)
            features = Features(words, at, sizes)
            first = len(words) + 1  # what stands before the first token
            facts = []  # of each kind: counts, numbers of the tokens in them, totals and different words of contexts, their numbers
            for kind, before in enumerate((features.two, features.one)):
                keys, numbers = _numbered(features.keys(kind))
                n, t = _columns_of(counts, 0, kind, keys, bits, "n", "t")
                keys, place = np.unique(features.contexts(kind), return_inverse=True)
                total, different = (v[place] for v in _columns_of(counts, 1, kind, keys, bits, "n", "t"))
                facts.append((n, numbers, total, different, before))
            # A pair is followed by a token wherever it stands; nothing stands before the first token, as for the word before.
            after = _before_it(numbers, sizes)
            keys, numbers = _numbered(features.keys(2))
            facts.append((*_columns_of(counts, 0, 2, keys, bits, "n"), numbers, np.r_[n, total[first]], np.r_[t, different[first]], after))
            for start in range(0, len(logs), BATCH):
                own = slice(start, start + BATCH)
                p = 10.0 ** logs[own]
                for (n, numbers, total, different, before), off in zip(facts, offs, strict=True):
                    p = interpolated(p, n[numbers[own]], total[before[own]], different[before[own]], off)
                logs[own] = np.log10(np.maximum(p, 1e-300))
            score = np.bincount(np.repeat(np.arange(len(sizes)), sizes), logs, len(sizes))
            columns = [table.column("doc_id"), table.column("counted"), *map(pa.array, (sizes, n_known, all_logs, score))]
            out.append(pa.table(columns, ["doc_id", "counted", "n_tokens", "n_known", "all_logs", "score"]))
        return pa.concat_tables(out)

    return run


def _counted(asked: DataFrame, name: str) -> DataFrame:
    return session.stage(asked.groupBy("kind", "shard").applyInArrow(_totals, COUNTS), name, "uncompressed")


def _bits(size: int, most: int) -> int:
    return max(2, math.ceil(math.log2(max(1.0, size / most))))


def score(docs: DataFrame, parts: int = 10, held: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    Documents whose crc32(doc_id as text) has the remainder ``held`` of ``parts`` are not learned from.
    """
    with shuffles_removed(docs.sparkSession):
        return _score(docs, parts, held, doc_id, text)


def _score(docs: DataFrame, parts: int, held: int, doc_id: str, text: str) -> DataFrame:
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), (crc_part(F.col(doc_id), parts) != held).alias("counted"))
    texts = listed_blocks(rows)
    n_ends = rows.filter("counted").count()
    word_bits = _bits(texts.agg(F.sum("size")).first()[0] or 0, SHARD_WORDS)
    words = texts.select("block", "vocab").mapInArrow(_asked_words(word_bits), ASKED_WORDS).groupBy("shard").applyInArrow(_word_totals, WORD_COUNTS)
    words = stage(words, "word-counts")
    ends = words.filter("v IS NOT NULL").groupBy("code").agg(F.sum("c").alias("n"), F.sum("v").alias("v")).collect()
    total, distinct = sum(r["n"] for r in ends) + n_ends, sum(r["v"] for r in ends) + (n_ends > 0)
    head = words.filter("word IS NOT NULL").orderBy(F.desc("c"), "word").limit(END).select("word", "code", "c").collect()
    top = [bytes(r["word"]) for r in head]
    read = texts.select("payload", "vocab")

    counts, kinds = np.zeros(CODES), np.zeros(CODES)
    for r in ends:
        counts[r["code"]], kinds[r["code"]] = r["n"], r["v"]
    for i, r in enumerate(head):
        counts[i] = r["c"]
        counts[r["code"]] -= r["c"]
        kinds[r["code"]] -= 1
    counts[END] = n_ends
    before = _summed(read.mapInArrow(_before(top), "salt int, piece int, data binary"), CODES * CONTEXTS)
    classes, places = _classes(before.reshape(CODES, CONTEXTS), counts)
    n_classes = 2 * CLASSES
    sums_c, kinds_c = (np.bincount(classes[:START], v[:START], n_classes) for v in (counts, kinds))
    prior = np.log((sums_c + 0.1 * (kinds_c + 1)) / (sums_c + 0.1 * (kinds_c + 1)).sum())
    inside = np.full((CLASSES, SIZE), -30.0)
    for i in np.flatnonzero(counts[:HEAD]):
        inside[classes[i], places[i]] = math.log(counts[i] / sums_c[classes[i]])
    rest = np.zeros(n_classes)
    rest[CLASSES:] = np.log10(sums_c[CLASSES:] + 0.1 * (kinds_c[CLASSES:] + 1))
    model = Model(classes, places, prior.astype(np.float32), inside.astype(np.float32), rest,
                  np.zeros((ROWS, n_classes), np.float32), np.zeros((INNER, SIZE), np.float32))
    size = model.outer.size + model.inner.size
    for part in range(PARTS):
        sent = spark.sparkContext.broadcast(model)
        moved = _summed(read.mapInArrow(_learned(sent, part, top), "salt int, piece int, data binary"), size + 1)
        if moved[-1]:
            step = (moved[:-1] / moved[-1]).astype(np.float32)
            model.outer = model.outer + step[: model.outer.size].reshape(model.outer.shape)
            model.inner = model.inner + step[model.outer.size :].reshape(model.inner.shape)
        sent.unpersist()
    sent = spark.sparkContext.broadcast(model)
    bits = _bits(total, SHARD_TOKENS)
    blocks = texts.select("block", "payload", "vocab")
    by_block = blocks.groupBy("block")
    # Pairs come later than the other kinds, so that never all keys lie on disk at a time.
    found = _counted(blocks.mapInArrow(_asked((2, 0), bits), ASKED), "feature-counts")
    pairs = _counted(by_block.cogroup(found.filter("kind = 2").groupBy("of_block")).applyInArrow(_pairs(bits), ASKED), "pair-counts")
    found = found.unionByName(pairs)
    after = _counted(by_block.cogroup(found.filter("kind < 2").groupBy("of_block")).applyInArrow(_contexts(bits), ASKED), "context-counts")
    few = {r["kind"]: (r["a"], r["b"]) for r in found.groupBy("kind").agg(F.sum("once").alias("a"), F.sum("twice").alias("b")).collect()}
    offs = [a / (a + 2 * b) if a and b else 0.75 for a, b in (few.get(kind, (0, 0)) for kind in range(KINDS))]
    answers = words.filter("of_block IS NOT NULL").select("of_block", F.lit(WORDS).alias("level"), "shard", "n")
    every = found.unionByName(after).unionByName(answers, allowMissingColumns=True).groupBy("of_block")
    scored = by_block.cogroup(every).applyInArrow(
        _scored(sent, top, offs, bits, word_bits), "doc_id long, counted boolean, n_tokens long, n_known long, all_logs double, score double"
    )
    has_end = 1 if n_ends else 0
    base = F.col("all_logs") + math.log10(n_ends + 0.1) - F.col("n_tokens") * math.log10(total + 0.1 * (distinct + 1))
    return scored.select(
        "doc_id", (~F.col("counted")).alias("held_out"), "n_tokens", (F.col("n_known") + has_end).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), "score",
    )
