"""Similarity join of word n-gram sets by PartEnum signatures.

Sets are put into bands of like size. In a band a similar pair differs in at most k shingles. The
shingle domain is partitioned by hash so that any such pair agrees on whole partitions, or, among
the three parts of a partition, on two of them: the subsets of parts are enumerated, and each
subset's content is a signature. A set is in the band of its size and in the next, so similar sets
of neighbouring sizes meet as well. Long sets have whole partitions as signatures, of which similar
sets share several: every set leaves out one fewer, those of the fewest shingles first. The order is
the same for all sets, so the last signature that two of them share is kept by both, and empty and
nearly empty partitions, which unrelated sets share, are not.

Equal sets are one from the start. Shared signatures make buckets; similarity.py turns them into
links that are checked exactly on the sets, and these into components. Shingles and sets are known
by 64-bit hashes.

Texts without words and null texts have empty sets and link with nothing, so do rows of a null id,
whose component is null. Rows that share an id are one document for the ids of components. A very
long text is one set like any other, whole, which a task holds in memory; pairs of exactly the
least similarity link. An empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustledger.llm.common import as_binary, free_name, mix64, ragged, ship, slices, stage, text_of
from gustledger.llm.similarity import linked_components, with_pivots

KEPT = 500_000   # distinct words that a task remembers before it starts anew
SUBSETS_UP_TO = 12  # differing shingles up to which partitions have three parts
BITS = 4         # of a sketch for each shingle, at least
COARSE = 1       # the same of the sketches that tell only whether two sets may be similar


class Shingles:
    """Hashes of the distinct word n-grams of texts."""

    def __init__(self, words: int):
        self.words, self.at, self.hashes = words, {}, np.zeros(0, np.uint64)
        self.factors = mix64(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)

    def sets(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The sorted hashes of all texts, one text after the other, and how many each has."""
        if len(self.at) > KEPT:
            self.at, self.hashes = {}, np.zeros(0, np.uint64)
        split = [t.lower().split() for t in texts]
        at, known = self.at, len(self.at)
        number = at.setdefault
        order = np.array([number(w, len(at)) for own in split for w in own], np.int64)
        new = [xxhash.xxh3_64_intdigest(w) for w in islice(at, known, None)]
        self.hashes = np.r_[self.hashes, np.array(new, np.uint64)]
        flat = self.hashes[order]
        sizes = np.array([len(s) for s in split], np.int64)
        ends = np.cumsum(sizes)
        # All windows of the joined texts, then those that lie within one text.
        width = self.words
        windows = np.zeros(max(0, len(flat) - width + 1), np.uint64)
        for j in range(width):
            windows += flat[j : j + len(windows)] * self.factors[j]
        counts = np.where(sizes == 0, 0, np.maximum(sizes - width + 1, 1))
        mixed = np.zeros(int(counts.sum()), np.uint64)
        whole = sizes >= width
        stops = np.cumsum(counts)
        inside = np.repeat(whole, counts)
        mixed[inside] = windows[ragged((ends - sizes)[whole], counts[whole])]
        for i in np.flatnonzero((sizes > 0) & ~whole):  # a text of fewer words is one shingle of those it has
            own = flat[ends[i] - sizes[i] : ends[i]]
            mixed[stops[i] - 1] = (own * self.factors[: len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))
        mixed = mix64(mixed)
        for a, b in zip((stops - counts).tolist(), stops.tolist(), strict=True):
            mixed[a:b].sort()
        rows = np.repeat(np.arange(len(texts)), counts)
        new = np.r_[True, (mixed[1:] != mixed[:-1]) | (rows[1:] != rows[:-1])] if len(rows) else np.zeros(0, bool)
        return mixed[new], np.bincount(rows[new], minlength=len(texts))


def _digests(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A number for each set, by its content."""
    ends = np.cumsum(sizes)
    raw = hashes.tobytes()
    return np.array([xxhash.xxh3_64_intdigest(raw[8 * (e - n) : 8 * e]) for e, n in zip(ends, sizes, strict=True)], np.uint64).view(np.int64)


class Bands:
    """Size bands, and how each band's sets are partitioned, for a similarity of ``percent`` / 100."""

    def __init__(self, percent: int):
        self.percent, self.last = percent, [0]

    def of(self, sizes: np.ndarray) -> np.ndarray:
        while self.last[-1] < int(sizes.max(initial=0)):
            least = self.last[-1] + 1
            self.last.append(max(least, least * 100 // self.percent))
        return np.searchsorted(np.array(self.last), sizes)

    def shape(self, band: int) -> tuple[int, int, int]:
        """Partitions, parts of each, and signatures that a similar pair shares at least."""
        self.of(np.array([1]))
        while len(self.last) <= band:
            self.of(np.array([self.last[-1] + 1]))
        k = 2 * self.last[band] * (100 - self.percent) // (100 + self.percent)
        if k == 0:
            return 1, 1, 1
        if k <= SUBSETS_UP_TO:
            return (k + 2) // 2, 3, 1
        spare = 1 + k // 12
        return k + 1 + spare, 1, 1 + spare

    def signatures(self, hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The signatures of the sets but for the lightest that each can spare, and the set each belongs to."""
        found, owners = [], []
        mixed = mix64(hashes ^ np.uint64(0x5851F42D4C957F2D))
        value = mix64(mixed + np.uint64(0x14057B7EF767814F))
        home = self.of(sizes)
        for step in (0, 1):  # the set's own band, and the next as the smaller of a pair
            bands = home + step
            shapes = np.array([self.shape(b) if n else (0, 1, 1) for b, n in zip(bands.tolist(), sizes.tolist(), strict=True)], np.int64).reshape(-1, 3)
            n1, n2 = shapes[:, 0], shapes[:, 1]
            cells = n1 * n2
            base = np.cumsum(cells) - cells
            wide = lambda v: np.repeat(v, sizes).astype(np.uint64)  # noqa: E731, B023
            first = mixed % wide(n1)
            second = (mixed >> np.uint64(41)) % wide(n2)
            at = np.repeat(base, sizes) + (first * wide(n2) + second).astype(np.int64)
            sums, counts = np.zeros(int(cells.sum()), np.uint64), np.bincount(at, minlength=int(cells.sum()))
            np.add.at(sums, at, value)
            owner = np.repeat(np.arange(len(sizes)), cells)
            inside = np.arange(len(owner)) - base[owner]
            three = n2[owner] == 3
            if three.any():  # a subset is the partition without one of its parts
                place = np.flatnonzero(three)
                head = place - inside[place] % 3
                whole = lambda v: v[head] + v[head + 1] + v[head + 2]  # noqa: E731, B023
                rest_s, rest_n = whole(sums) - sums[place], whole(counts) - counts[place]
                sums[place], counts[place] = rest_s, rest_n
            label = mix64(bands[owner].astype(np.uint64) * np.uint64(1 << 32) + inside.astype(np.uint64))
            keys = mix64(sums + label)
            order = np.lexsort((keys, counts, owner))  # inside of each set, as owner ascends
            kept = order[inside >= (shapes[:, 2] - 1)[owner]]
            found.append(keys[kept])
            owners.append(owner[kept])
        return np.concatenate(found).view(np.int64), np.concatenate(owners)


def _sets(words: int, rows: str, percent: int = 0):
    """For each document: its size, digest and sketch, its set, or the signatures of each distinct set of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, bands, seen = Shingles(words), Bands(percent), set()
        for batch in batches:
            for part in slices(batch, 1):
                hashes, sizes = shingles.sets(as_binary(part.column(1)).to_pylist())
                digests = _digests(hashes, sizes)
                if rows == "sizes":
                    keys, fine = pa.array(digests, mask=sizes == 0), _sketches(hashes, sizes)
                    sketches = [pa.array([x.tobytes() for x in each], pa.binary()) for each in (fine, map(_coarse, fine))]
                    columns = [part.column(0), pa.array(sizes, pa.int64()), keys, *sketches]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "id", "sketch", "coarse"])
                    continue
                offsets = np.r_[0, np.cumsum(sizes)]
                if rows == "sets":
                    blobs = [hashes[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(digests), pa.array(blobs, pa.binary())], ["id", "blob"])
                    continue
                new = []
                for i, d in enumerate(digests.tolist()):
                    new.append(bool(sizes[i]) and d not in seen)
                    if new[-1]:
                        seen.add(d)
                new = np.array(new, bool)
                keys, owners = bands.signatures(hashes[np.repeat(new, sizes)], sizes[new])
                for at in range(0, len(keys), 1 << 17):
                    yield pa.RecordBatch.from_arrays([pa.array(keys[at : at + (1 << 17)]), pa.array(digests[new][owners[at : at + (1 << 17)]])], ["key", "id"])

    return run


def _sketches(hashes: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """The size of each set, and for each bucket of its shingles whether they are odd in number.

    Two sets differ by at least as many shingles as their buckets of other parity. The number of
    buckets grows with the set, so unrelated sets of any size are told apart; sketches of different
    lengths are compared at the shorter one, to which the longer folds. Whether sets are within three
    radii takes BITS buckets for each shingle; whether they may link, COARSE of them.
    """
    out, ends = [], np.cumsum(sizes)
    for end, n in zip(ends.tolist(), sizes.tolist(), strict=True):
        width = max(256, BITS << max(0, n - 1).bit_length())
        odd = np.bincount((hashes[end - n : end] & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
        out.append(np.r_[np.uint64(n), np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)])
    return out


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Sketches, the last axis being their words, as they are with ``width`` words."""
    return bits if bits.shape[-1] == width else np.bitwise_xor.reduce(bits.reshape(*bits.shape[:-1], -1, width), axis=-2)


def _coarse(sketch: np.ndarray) -> np.ndarray:
    """A sketch with COARSE instead of BITS buckets for each shingle."""
    return np.r_[sketch[:1], _folded(sketch[1:], max(1, (len(sketch) - 1) * COARSE // BITS))]


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(-1, dtype=np.int64)


def at_least(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """What each pair's distance is at least."""
    out = np.zeros(len(left))
    for i, (a, b) in enumerate(zip(left, right, strict=True)):
        x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
        n, m, width = int(x[0]), int(y[0]), min(len(x), len(y)) - 1
        apart = max(abs(n - m), int(_apart(_folded(x[1:], width), _folded(y[1:], width))))
        out[i] = 2 * apart / max(n + m + apart, 1)
    return out


def may_link(most: float):
    """Whether pairs of a block may be within a distance, from their sketches."""

    def by_width(sketches: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each width: the places, sizes and bits of its sketches."""
        widths = np.array([len(s) // 8 - 1 for s in sketches])
        found = {}
        for width in np.unique(widths).tolist():
            at = np.flatnonzero(widths == width)
            own = np.frombuffer(b"".join(sketches[i] for i in at), np.uint64).reshape(-1, width + 1)
            found[width] = at, own[:, 0].astype(np.int64), own[:, 1:]
        return found

    def blockwise(left: list[bytes], right: list[bytes]) -> np.ndarray:
        out = np.zeros((len(left), len(right)), bool)
        others = by_width(right)
        for w, (at_x, nx, bits_x) in by_width(left).items():
            for v, (at_y, ny, bits_y) in others.items():
                width = min(w, v)
                x, y = _folded(bits_x, width), _folded(bits_y, width)
                for i, n in enumerate(nx):
                    gap = np.abs(ny - n)
                    near = np.flatnonzero(2 * gap <= (most + 1e-9) * (ny + n + gap))  # by their sizes alone
                    apart = np.maximum(gap[near], _apart(y[near], x[i]))
                    out[at_x[i], at_y[near]] = 2 * apart <= (most + 1e-9) * (ny[near] + n + apart)
        return out

    return blockwise


def _measures(percent: int):
    def hits(x: np.ndarray, y: np.ndarray) -> int:
        return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())

    def pairwise(left: list[bytes], right: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        both, union = np.zeros(len(left), np.int64), np.zeros(len(left), np.int64)
        for i, (a, b) in enumerate(zip(left, right, strict=True)):
            x, y = sorted((np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)), key=len)
            both[i] = hits(x, y)
            union[i] = len(x) + len(y) - both[i]
        return 100 * both >= percent * union, 1 - both / union

    def blockwise(left: list[bytes], right: list[bytes]) -> np.ndarray:
        x, y = ([np.frombuffer(b, np.uint64) for b in side] for side in (left, right))
        nx, ny = (np.array([len(s) for s in side], np.int64) for side in (x, y))
        both = _intersections(np.concatenate(x), np.repeat(np.arange(len(x)), nx), np.concatenate(y), np.repeat(np.arange(len(y)), ny), len(x), len(y))
        return 100 * both >= percent * (nx[:, None] + ny[None, :] - both)

    return pairwise, blockwise


def _intersections(hx: np.ndarray, rx: np.ndarray, hy: np.ndarray, ry: np.ndarray, n: int, m: int) -> np.ndarray:
    """Common shingles of every row of x with every row of y."""
    shared = np.intersect1d(hx, hy)
    cx, cy = np.searchsorted(shared, hx), np.searchsorted(shared, hy)
    for_x, for_y = (shared[np.minimum(c, len(shared) - 1)] == h if len(shared) else np.zeros(len(h), bool) for c, h in ((cx, hx), (cy, hy)))
    cx, rx, cy, ry = cx[for_x], rx[for_x], cy[for_y], ry[for_y]
    fx, fy = np.bincount(cx, minlength=len(shared)), np.bincount(cy, minlength=len(shared))
    out = np.zeros(n * m, np.int64)
    rare = fx * fy < 256  # these by their pairs, the others by products of matrices
    ox, oy = np.argsort(cx, kind="stable"), np.argsort(cy, kind="stable")
    sx, sy = np.cumsum(fx) - fx, np.cumsum(fy) - fy
    features = np.flatnonzero(rare)
    for part in np.array_split(features, max(1, int((fx[features] * fy[features]).sum()) >> 22)):
        each = np.repeat(part, fx[part])
        a = rx[ox[ragged(sx[part], fx[part])]]
        b = ry[oy[ragged(sy[each], fy[each])]]
        out += np.bincount(np.repeat(a, fy[each]) * m + b, minlength=n * m)
    out = out.reshape(n, m)
    features = np.flatnonzero(~rare)
    for at in range(0, len(features), 2048):
        part = features[at : at + 2048]
        x, y = np.zeros((n, len(part)), np.float32), np.zeros((m, len(part)), np.float32)
        for matrix, r, o, s, f in ((x, rx, ox, sx, fx), (y, ry, oy, sy, fy)):
            matrix[r[o[ragged(s[part], f[part])]], np.repeat(np.arange(len(part)), f[part])] = 1
        out += np.rint(x @ y.T).astype(np.int64)
    return out


def jaccard_components(docs: DataFrame, words: int = 4, percent: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest id reachable by links, of every document."""
    rows = ship(docs).select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    sized = stage(rows.mapInArrow(_sets(words, "sizes"), "doc_id long, n_shingles long, id long, sketch binary, coarse binary"), "set-sizes")
    known = rows.filter(F.col("doc_id").isNotNull())
    members = stage(with_pivots(known.mapInArrow(_sets(words, "signatures", percent), "key long, id long")), "buckets")
    wanted = members.select("id").distinct()
    owners = sized.filter("doc_id IS NOT NULL").join(wanted, "id").groupBy("id").agg(F.min("doc_id").alias("doc_id"))
    owners = stage(owners, "set-owners")

    def contents(ids: DataFrame) -> DataFrame:
        # An id that several rows share may bring other sets along; equal sets are taken once.
        chosen = stage(owners.join(ids, "id", "left_semi"), "set-owners")
        found = known.join(chosen.select("doc_id"), "doc_id", "left_semi").mapInArrow(_sets(words, "sets"), "id long, blob binary")
        return stage(found.join(chosen.select("id"), "id", "left_semi").withColumn("weight", F.lit(1)), "sets")

    # The sketches come with the sizes of all documents: they move instead of the texts.
    sketches = sized.join(owners, ["id", "doc_id"], "left_semi").select("id", "sketch", "coarse", F.lit(1).alias("weight"))
    sketches = stage(sketches, "sketches")
    t = 1 - percent / 100
    linked = linked_components(members, sketches, contents, t, *_measures(percent), at_least, may_link(t))
    tops = sized.filter("doc_id IS NOT NULL AND id IS NOT NULL").groupBy("id").agg(F.min("doc_id").alias("least"))
    tops = stage(tops.join(linked, "id", "left").select("id", F.coalesce("component", "id").alias("component"), "least"), "tops")
    least = stage(tops.groupBy("component").agg(F.min("least").alias("component_id")), "component-ids")
    named = stage(tops.join(least, "component").select("id", "component_id"), "named")
    joined = sized.join(named, "id", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return joined.select("doc_id", "n_shingles", own.alias("component_id"))


def keep_representatives(docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that have the smallest id of their component, and those of a null id."""
    found = jaccard_components(docs, words, percent, doc_id, text)
    name = free_name(docs, "gone")
    gone = stage(found.filter("doc_id <> component_id").select(F.col("doc_id").alias(name)).distinct(), "linked-away")
    return docs.join(gone, F.col(doc_id).cast("long") == F.col(name), "left_anti")
