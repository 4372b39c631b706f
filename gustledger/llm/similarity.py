"""Linking things by a measure, from candidate buckets, without a row for every pair of a group.

A bucket's members are first held against one of them, its pivot. The measures are metrics, so a
pair within the radius ``t`` that shares a bucket is either in the ball of three radii around the
pivot, or both are more than two radii away from it. The balls join up to clusters, which are
compared in blocks of bounded size inside tasks; what a task returns is bounded by its block, not
by its pairs. Members away from their pivot are compared bucket by bucket in the same way, after
small sketches, which bound distances from below, have ruled out nearly all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gustledger.llm.common import ship, stage
from gustledger.llm.components import components

BLOCK = 512
EPS = 1e-9

# (blobs of one side, blobs of the other) -> for each pair, whether it links and how far it is
Pairwise = Callable[[list[bytes], list[bytes]], tuple[np.ndarray, np.ndarray]]
# (blobs of one block, blobs of another) -> matrix of links
Blockwise = Callable[[list[bytes], list[bytes]], np.ndarray]


def verified(pairs: DataFrame, blobs: DataFrame, measure: Pairwise) -> DataFrame:
    """a, b, linked and distance of every pair, measured on the contents of ``blobs`` (id, blob)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                linked, distance = measure(part.column(2).to_pylist(), part.column(3).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(linked, pa.bool_()), pa.array(distance, pa.float64())],
                    ["a", "b", "linked", "distance"],
                )

    left = blobs.select(F.col("id").alias("a"), F.col("blob").alias("blob_a"))
    right = blobs.select(F.col("id").alias("b"), F.col("blob").alias("blob_b"))
    both = ship(pairs).join(left, "a").join(right, "b").select("a", "b", "blob_a", "blob_b")
    return both.mapInArrow(run, "a long, b long, linked boolean, distance double")


def bounded(pairs: DataFrame, sketches: DataFrame, bound: Callable[[list[bytes], list[bytes]], np.ndarray]) -> DataFrame:
    """a, b and least: what the distance of every pair is at least, from the sketches (id, sketch)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = bound(batch.column(2).to_pylist(), batch.column(3).to_pylist()) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(least, pa.float64())], ["a", "b", "least"])

    left = sketches.select(F.col("id").alias("a"), F.col("sketch").alias("sketch_a"))
    right = sketches.select(F.col("id").alias("b"), F.col("sketch").alias("sketch_b"))
    both = ship(pairs).join(left, "a").join(right, "b").select("a", "b", "sketch_a", "sketch_b")
    return both.mapInArrow(run, "a long, b long, least double")


def _forest(links: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Edges that connect what the links (i, j) connect, at most one fewer than the things."""
    root, kept = list(range(n)), []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, j in links:
        a, b = find(int(i)), find(int(j))
        if a != b:
            root[max(a, b)] = min(a, b)
            kept.append((int(i), int(j)))
    return kept


def compared(groups: DataFrame, blobs: DataFrame, measure: Blockwise, count: bool = False, members: bool = False) -> DataFrame:
    """All pairs of each group (gid, id, part) whose parts differ, in blocks.

    Rows (a, b, null) are links that connect whatever the links connect, rows (a, null, n) how much
    weight a's links within its group have, with ``count``. With ``members`` the rows are those of
    ``groups`` that have any link. The largest part of a group is never held against itself, so it
    costs one pass over it for each block of the others.
    """
    sizes = groups.groupBy("gid", "part").agg(F.count("*").alias("n"))
    main = sizes.groupBy("gid").agg(F.max_by("part", "n").alias("main"), F.max("n").alias("top"), F.sum("n").alias("n"))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    shape = main.select("gid", "main", blocks(F.col("n") - F.col("top")).alias("n_rest"), blocks(F.col("top")).alias("n_main"))
    dealt = stage(groups, "groups").join(stage(shape, "shapes"), "gid")
    h, is_main = F.xxhash64("id"), F.col("part") == F.col("main")
    block = F.when(is_main, F.col("n_rest") + F.pmod(h, "n_main")).otherwise(F.pmod(h, F.greatest(F.col("n_rest"), F.lit(1))))
    others = F.when(is_main, F.col("n_rest")).otherwise(F.col("n_rest") + F.col("n_main"))
    dealt = dealt.withColumn("block", block.cast("int")).filter(others > 0)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), others.cast("int") - 1)))
    dealt = dealt.select(
        "gid", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "id", "part"
    )
    dealt = stage(dealt, "dealt")  # so that few rows are seen to be few, and go to the contents

    def run(key: tuple, table: pa.Table) -> pa.Table:
        lo, hi = key[1].as_py(), key[2].as_py()
        table = table.sort_by("id")
        ids = table.column("id").to_numpy()
        first = np.r_[True, ids[1:] != ids[:-1]]
        at = np.flatnonzero(first)
        ids, block = ids[at], table.column("block").to_numpy()[at]
        parts, weight = table.column("part").to_numpy()[at], table.column("weight").to_numpy()[at]
        data = table.column("blob").take(pa.array(at)).to_pylist()
        x = np.flatnonzero(block == lo)
        y = x if lo == hi else np.flatnonzero(block == hi)
        a, b, n = [], [], []
        if members:
            linked = measure([data[i] for i in x], [data[j] for j in y]) if len(x) and len(y) else np.zeros((len(x), len(y)), bool)
            linked &= parts[x][:, None] != parts[y][None, :]
            own = np.unique(np.r_[x[linked.any(1)], y[linked.any(0)]])
            return pa.table({"gid": pa.array([key[0].as_py()] * len(own), pa.int64()), "id": pa.array(ids[own]), "part": pa.array(parts[own])})
        if len(x) and len(y):
            linked = measure([data[i] for i in x], [data[j] for j in y]) & (parts[x][:, None] != parts[y][None, :])
            edges = _forest(np.stack([x[(w := np.nonzero(linked))[0]], y[w[1]]], 1), len(ids))
            a, b, n = [int(ids[i]) for i, _ in edges], [int(ids[j]) for _, j in edges], [None] * len(edges)
            if count:
                own = (linked * weight[y]).sum(1)
                rows = [(int(ids[i]), int(v)) for i, v in zip(x, own, strict=True) if v]
                if lo != hi:
                    rows += [(int(ids[j]), int(v)) for j, v in zip(y, (linked * weight[x][:, None]).sum(0), strict=True) if v]
                a, b, n = a + [r[0] for r in rows], b + [None] * len(rows), n + [r[1] for r in rows]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})

    filled = ship(dealt).join(blobs.select("id", "blob", "weight"), "id")
    schema = "gid long, id long, part long" if members else "a long, b long, n long"
    return filled.groupBy("gid", "lo", "hi").applyInArrow(run, schema)


def with_pivots(members: DataFrame) -> DataFrame:
    """The rows (key, id, ...) of keys that several ids share, with the smallest of them as pivot."""
    key = Window.partitionBy("key")
    both = members.withColumn("pivot", F.min("id").over(key)).withColumn("top", F.max("id").over(key))
    return both.filter("pivot < top").drop("top")


def mixed_groups(rows: DataFrame) -> DataFrame:
    """Groups (gid, id, part) with several parts; of groups with the same members one stays."""
    gid = Window.partitionBy("gid")
    rows = rows.distinct().withColumn("lo", F.min("part").over(gid)).withColumn("hi", F.max("part").over(gid))
    rows = stage(rows.filter("lo < hi").select("gid", "id", "part"), "mixed")
    marks = rows.groupBy("gid").agg(
        F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"), F.count("*").alias("n")
    )
    kept = marks.groupBy("x", "y", "n").agg(F.min("gid").alias("gid"))
    return rows.join(kept.select("gid"), "gid", "left_semi")


def linked_components(
    members: DataFrame, sketches: DataFrame, contents: Callable[[DataFrame], DataFrame], t: float, pairwise: Pairwise, blockwise: Blockwise,
    bound: Callable[[list[bytes], list[bytes]], np.ndarray], able: Blockwise,
) -> DataFrame:
    """id and component of all that have a link; ``members`` (key, id, pivot) are staged rows of with_pivots().

    ``sketches`` has id, sketch, coarse and weight, and ``contents`` gives id, blob and weight of the ids that
    their sketches can't rule out. ``bound`` gives what distances are at least, from sketches, ``able`` which
    pairs of blocks may be within ``t``, from coarse ones.
    """
    star = members.filter("id <> pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct()
    star = stage(bounded(star, sketches, bound), "star-bounds")
    close = star.filter(F.col("least") <= 3 * t + EPS).select("a", "b")
    blobs = contents(close.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    near = stage(verified(close, blobs, pairwise), "star")
    links = near.filter("linked").select("a", "b")
    found = components(links)
    clusters = components(near.filter(F.col("distance") <= 3 * t + EPS).select("a", "b"))
    inner = clusters.select(F.col("component").alias("gid"), "id").join(found.select("id", F.col("component").alias("part")), "id", "left")
    inner = mixed_groups(inner.select("gid", "id", F.coalesce("part", "id").alias("part")))
    inside = stage(compared(inner, blobs, blockwise), "links").select("a", "b")

    away = star.filter(F.col("least") > 3 * t + EPS).select("a", "b").unionByName(near.filter(F.col("distance") > 2 * t - EPS).select("a", "b"))
    away = away.select(F.col("a").alias("id"), F.col("b").alias("pivot"))
    outer = members.select("key", "id", "pivot").join(away, ["id", "pivot"], "left_semi").select(F.col("key").alias("gid"), "id")
    outer = outer.join(clusters.select("id", F.col("component").alias("part")), "id", "left")
    outer = mixed_groups(outer.select("gid", "id", F.coalesce("part", "id").alias("part")))
    # A thing is in many of these groups and its sketch moves to each, so the coarse one does.
    outer = compared(outer, sketches.withColumnRenamed("coarse", "blob"), able, members=True)
    outer = mixed_groups(stage(outer.distinct(), "able"))
    outside = stage(compared(outer, contents(outer.select("id").distinct()), blockwise), "links").select("a", "b")
    return components(links.unionByName(inside).unionByName(outside))
