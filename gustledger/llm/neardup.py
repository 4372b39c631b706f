"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

A rotation of the centred principal axes is learned on a bounded sample so that the signs of the
rotated values are balanced codes of 64 bits. The codes are cut into substrings, one table for
each; a vector is filed under its substrings and those a bit or two away, so that codes within a
radius of each other meet in some table. Candidates are compared by their original vectors in
double precision. Vectors that are equal within a label are one class from the start. Classes
around a common pivot make clusters whose pairs are counted in blocks. Candidates from different
clusters are joined on the table entry and their Hamming distance where few share the entry;
otherwise the entry is dealt into blocks, whose codes and then vectors are compared inside tasks.
Pairs of different clusters are counted within what the links connect, again in blocks.

Vectors that are null, zero, or hold null or non-finite components, and those of a null label or
id, link with nothing. Vectors of different lengths never link. Every row is a vector of its own,
also where rows repeat; rows that share an id share the id for components. An empty table gives an
empty result; other columns are not looked at. Scores are thresholds, so ties need no rule.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustledger.llm.common import mix64, offsets, ship, stage
from gustledger.llm.components import components
from gustledger.llm.similarity import EPS, compared, mixed_groups, verified
from gustledger.operators import joins

BITS = 64
SAMPLE = 20_000   # vectors that the rotation is learned from
ROUNDS = 30
RADIUS = 8        # bits within which codes are sure to meet in a table
NEAR_BITS = 20    # bits up to which a vector is held against its pivot
PAIR_BITS = 14    # bits up to which a candidate pair is held against its vectors
SMALL = 64        # classes of a table entry up to which each pair of them may be a row


def learn_planes(vectors: np.ndarray, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Mean and (length, 64) planes: rotated principal axes, as many rotations as 64 bits need."""
    n, d = vectors.shape
    rng = np.random.default_rng(seed + d)
    mean = vectors.mean(0) if n else np.zeros(d)
    centred = vectors - mean
    width = min(BITS, d)
    if n > width:
        _, axes = np.linalg.eigh(centred.T @ centred)
        axes = axes[:, ::-1][:, :width]
    else:
        axes = np.linalg.qr(rng.standard_normal((d, d)))[0][:, :width]
    planes, values = [], centred @ axes
    for _ in range(math.ceil(BITS / width)):
        turn = np.linalg.qr(rng.standard_normal((width, width)))[0]
        for _ in range(ROUNDS if n > width else 0):
            u, _, v = np.linalg.svd(values.T @ np.where(values @ turn >= 0, 1.0, -1.0))
            turn = u @ v
        planes.append(axes @ turn)
    return mean, np.concatenate(planes, 1)[:, :BITS]


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of each vector length and their vectors as a matrix."""
    own = offsets(column).astype(np.int64)
    sizes, values = np.diff(own), column.values.to_numpy(zero_copy_only=False)
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        yield rows, values[own[rows][:, None] + np.arange(d)]


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; scaled first, so that extreme values neither overflow nor vanish."""
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def _planes_of(classes: DataFrame, total: int, sample: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    share = min(1.0, sample / max(total, 1))
    some = classes.filter(F.pmod("id", F.lit(1 << 30)) / float(1 << 30) < share).select("vector").toArrow().column("vector")
    found: dict[int, list[np.ndarray]] = {}
    for chunk in some.chunks:
        for _, matrix in _matrices(chunk):
            found.setdefault(matrix.shape[1], []).append(_unit(matrix))
    return {d: learn_planes(np.concatenate(parts)) for d, parts in found.items()}


def _filed(planes: dict[int, tuple[np.ndarray, np.ndarray]], tables: int, flips: int):
    """Rows (key, id, code): every class under its substrings and those up to ``flips`` bits away."""
    cuts = [BITS * t // tables for t in range(tables + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = dict(planes)
        for whole in batches:
            for start in range(0, whole.num_rows, 2048):
                batch = whole.slice(start, 2048)
                ids, spaces = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
                for rows, matrix in _matrices(batch.column(2)):
                    d = matrix.shape[1]
                    if d not in known:
                        known[d] = learn_planes(np.zeros((0, d)))
                    mean, axes = known[d]
                    bits = np.packbits((_unit(matrix) - mean) @ axes >= 0, axis=1, bitorder="little")
                    codes = np.ascontiguousarray(bits).view(np.uint64)[:, 0]
                    space = mix64(spaces[rows] ^ np.uint64(d))
                    for t, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                        sub = (codes >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1)
                        masks = [sum(1 << i for i in c) for f in range(flips + 1) for c in combinations(range(b - a), f)]
                        near = sub[:, None] ^ np.array(masks, np.uint64)[None, :]
                        keys = mix64(space[:, None] + mix64(near ^ np.uint64((t + 1) << 56)))
                        each = [np.repeat(v, len(masks)) for v in (ids[rows], codes.view(np.int64))]
                        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(each[0]), pa.array(each[1])], ["key", "id", "code"])

    return run


def _blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[bytes] = [b""] * batch.num_rows
        for rows, matrix in _matrices(batch.column(1)):
            for i, v in zip(rows, _unit(matrix), strict=True):
                out[i] = v.tobytes()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary()), batch.column(2)], ["id", "blob", "weight"])


def _measures(least: float):
    def matrix(blobs: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1)

    def pairwise(left: list[bytes], right: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        cosine = np.zeros(len(left))
        for n in {len(b) for b in left}:  # a pair's vectors have one length
            rows = [i for i, b in enumerate(left) if len(b) == n]
            cosine[rows] = (matrix([left[i] for i in rows]) * matrix([right[i] for i in rows])).sum(1)
        return cosine >= least, np.arccos(np.clip(cosine, -1, 1))

    def blockwise(left: list[bytes], right: list[bytes]) -> np.ndarray:
        return matrix(left) @ matrix(right).T >= least

    return pairwise, blockwise


def _codes_near(left: list[bytes], right: list[bytes]) -> np.ndarray:
    a, b = (np.frombuffer(b"".join(side), np.uint64) for side in (left, right))
    return np.bitwise_count(a[:, None] ^ b[None, :]) <= PAIR_BITS


def near_links(
    embeddings: DataFrame, least: float = 0.98, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
    sample: int = SAMPLE, radius: int = RADIUS,
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    vector = F.col(embedding).cast("array<double>")
    rows = ship(embeddings).select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), vector.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fit = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    space = F.xxhash64("label")
    rows = stage(rows.select("vec_id", F.when(fit, F.xxhash64("label", "vector")).alias("id"), space.alias("space"), F.when(fit, F.col("vector")).alias("vector")), "vectors")
    classes = rows.filter("id IS NOT NULL").groupBy("id").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("weight"), F.first("space").alias("space"), F.first("vector").alias("vector")
    )
    classes = stage(classes, "classes")
    total = classes.count()
    tables = min(8, max(2, round(BITS / max(1.0, math.log2(max(total, 2))))))
    flips = math.ceil(radius // tables / 2)
    planes = _planes_of(classes, total, sample)
    members = classes.select("id", "space", "vector").mapInArrow(_filed(planes, tables, flips), "key long, id long, code long")
    members = stage(members, "entries")
    pivots = members.groupBy("key").agg(F.min(F.struct("id", "code")).alias("pivot"), F.max("id").alias("top"), F.count("*").alias("size"))
    members = stage(joins.salted_join(members, pivots.filter("pivot.id < top").drop("top"), ["key"]), "table-entries")
    blobs = stage(classes.select("id", "vector", "weight").mapInArrow(_blobs, "id long, blob binary, weight long"), "unit-vectors")
    pairwise, blockwise = _measures(least)
    apart = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b)))

    star = members.filter((F.col("id") != F.col("pivot.id")) & (apart("code", "pivot.code") <= NEAR_BITS))
    star = stage(verified(star.select(F.col("id").alias("a"), F.col("pivot.id").alias("b")).distinct(), blobs, pairwise), "star")
    clusters = components(star.filter(F.col("distance") <= 3 * math.acos(least) + EPS).select("a", "b"))
    inner = mixed_groups(clusters.select(F.col("component").alias("gid"), "id", F.col("id").alias("part")))
    inner = stage(compared(inner, blobs, blockwise, count=True), "cluster-links")

    cluster = F.coalesce("cluster", "id").alias("cluster")
    named = members.select("key", "id", "code", "size").join(clusters.select("id", F.col("component").alias("cluster")), "id", "left")
    named = stage(named.select("key", "id", "code", "size", cluster), "named")
    few, many = named.filter(F.col("size") <= SMALL), named.filter(F.col("size") > SMALL)
    x, y = few.alias("x"), few.alias("y")
    close = (F.col("x.key") == F.col("y.key")) & (F.col("x.cluster") < F.col("y.cluster")) & (apart("x.code", "y.code") <= PAIR_BITS)
    cross = x.join(y, close).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()
    cross = stage(verified(cross, blobs, pairwise).filter("linked").select("a", "b"), "cross-links")
    codes = many.select("id", F.unhex(F.lpad(F.hex("code"), 16, "0")).alias("blob")).distinct().withColumn("weight", F.lit(1))
    able = compared(many.select(F.col("key").alias("gid"), "id", F.col("cluster").alias("part")), codes, _codes_near, members=True)
    outside = stage(compared(stage(able.distinct(), "able"), blobs, blockwise), "bucket-links").select("a", "b")

    linked = components(inner.filter("b IS NOT NULL").select("a", "b").unionByName(cross).unionByName(outside))
    linked = stage(linked, "linked")
    across = linked.select(F.col("component").alias("gid"), "id").join(clusters.select("id", F.col("component").alias("cluster")), "id", "left")
    across = compared(across.select("gid", "id", F.coalesce("cluster", "id").alias("part")), blobs, blockwise, count=True)
    counts = inner.filter("n IS NOT NULL").select("a", "n").unionByName(across.filter("n IS NOT NULL").select("a", "n"))
    counts = counts.groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    found = classes.select("id", "least", "weight").join(linked, "id", "left").join(counts, "id", "left")
    found = stage(found.select("id", "least", F.coalesce("component", "id").alias("component"), (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")), "found")
    tops = stage(found.groupBy("component").agg(F.min("least").alias("component_id")), "component-ids")
    found = stage(found.join(tops, "component").select("id", "n_links", "component_id"), "found")
    joined = rows.select("vec_id", "id").join(found, "id", "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
