"""Exact top-k inner products by vector-approximation files.

Every block of vectors is a file of two parts: the cells that its components fall into, a few bits
each, and the vectors themselves. A search scans the cells for bounds of every score, then reads
vectors in the order of their upper bounds until no other can reach the kth score, ties included.
The best of all blocks are merged in two steps. Queries go out in blocks of bounded size, one pass
over the files for each.

Vectors that are null, hold null or non-finite components, or have a null id take no part, as
queries or candidates. Rows are told apart by a number, not by their id: rows that share an id are queries
and candidates of their own, and of each other. Vectors of other lengths than the query's are no
candidates of it. Equal scores go by the smaller id. An empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gustledger.llm.common import fresh_path, partitions_for, ship, stage
from gustledger.llm.neardup import _matrices

CELLS = 64            # of a component, in its range over all vectors
BLOCK_ROWS = 4096     # vectors of a file
QUERY_ROWS = 2048     # queries of a pass
AT_ONCE = 64          # queries whose bounds a task holds at a time
FILES = "block string, dim int, ids binary, numbers binary, cells binary, vectors binary"


def whole_vectors(rows: DataFrame, scale: int, vec_id: str, embedding: str) -> DataFrame:
    """vec_id, number and v, the components times ``scale`` rounded down, of the rows that take part."""
    value = F.col(embedding).cast("array<double>")
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), value.alias("v")).filter("vec_id IS NOT NULL AND v IS NOT NULL")
    rows = rows.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    return rows.select("vec_id", F.monotonically_increasing_id().alias("number"), F.transform("v", lambda x: F.floor(x * scale)).cast("array<long>").alias("v"))


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    low, high = {}, {}
    for batch in batches:
        for _, m in _matrices(batch.column(0)):
            d = m.shape[1]
            low[d] = np.minimum(low.get(d, m[0]), m.min(0))
            high[d] = np.maximum(high.get(d, m[0]), m.max(0))
    for d in low:
        names = ["dim", "pos", "low", "high"]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(d, d)), pa.array(np.arange(d)), pa.array(low[d]), pa.array(high[d])], names)


def _files(ranges: dict[int, tuple[np.ndarray, np.ndarray]], rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        for whole in batches:
            for start in range(0, whole.num_rows, rows):
                batch = whole.slice(start, rows)
                ids, numbers = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                for at, m in _matrices(batch.column(2)):
                    low, width = ranges[m.shape[1]]
                    cells = ((m - low) // width).astype(np.uint8)
                    row = [f"{part}-{n}", m.shape[1], ids[at].tobytes(), numbers[at].tobytes(), cells.tobytes(), m.tobytes()]
                    kinds = [pa.string(), pa.int32(), *[pa.binary()] * 4]
                    names = ["block", "dim", "ids", "numbers", "cells", "vectors"]
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)
                    n += 1

    return run


def search_file(
    queries: np.ndarray, query_numbers: np.ndarray, ids: np.ndarray, numbers: np.ndarray, cells: np.ndarray, vectors: np.ndarray,
    low: np.ndarray, width: np.ndarray, k: int,
) -> Iterator[tuple[int, int, int]]:
    """(place of the query, id, score) of each query's k best in one file."""
    exact = float(np.abs(queries).max(initial=0)) * float(np.abs(low).max(initial=0) + (width * CELLS).max(initial=0)) * queries.shape[1] < 2**53
    lower = low + cells.astype(np.int64) * width
    lower, upper = lower.astype(np.float64), (lower + width - 1).astype(np.float64)
    for start in range(0, len(queries), AT_ONCE):
        part = queries[start : start + AT_ONCE]
        up, down = np.maximum(part, 0).astype(np.float64), np.minimum(part, 0).astype(np.float64)
        most = up @ upper.T + down @ lower.T
        least = up @ lower.T + down @ upper.T
        if not exact:  # beyond 2^53 sums are rounded; widen the bounds by what that can be
            slack = (np.abs(most) + np.abs(least) + 1) * 1e-12 * queries.shape[1]
            most, least = most + slack, least - slack
        own = query_numbers[start : start + AT_ONCE][:, None] == numbers[None, :]
        most[own], least[own] = -np.inf, -np.inf
        floor = np.partition(least, len(ids) - k, axis=1)[:, len(ids) - k] if len(ids) >= k else np.full(len(part), -np.inf)
        for i, q in enumerate(part):
            able = np.flatnonzero((most[i] >= floor[i]) & ~own[i])
            able = able[np.argsort(-most[i][able], kind="stable")]
            scores, at = np.zeros(0, np.int64), 0
            while at < len(able):
                if len(scores) >= k and most[i][able[at]] < np.partition(scores, len(scores) - k)[len(scores) - k]:
                    break
                step = able[at : at + 4 * k]
                scores = np.r_[scores, vectors[step] @ q]
                at += len(step)
            read = able[:at]
            for j in np.lexsort((ids[read], -scores))[:k]:
                yield start + i, int(ids[read[j]]), int(scores[j])


def _search(sent, ranges: dict[int, tuple[np.ndarray, np.ndarray]], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                d = row["dim"]
                if d not in sent.value:
                    continue
                query_ids, query_numbers, queries = sent.value[d]
                shape = lambda b, kind: np.frombuffer(b, kind).reshape(-1, d)  # noqa: E731, B023
                n = len(row["ids"]) // 8
                cells, vectors = (shape(row["cells"], np.uint8), shape(row["vectors"], np.int64)) if d else (np.zeros((n, 0), np.uint8), np.zeros((n, 0), np.int64))
                ids, numbers = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["numbers"], np.int64)
                found = list(search_file(queries, query_numbers, ids, numbers, cells, vectors, *ranges[d], k))
                place = np.array([f[0] for f in found], np.int64)
                columns = [query_ids[place], query_numbers[place], [f[1] for f in found], [f[2] for f in found]]
                blocks = pa.array([row["block"]] * len(found), pa.string())
                yield pa.RecordBatch.from_arrays([blocks, *[pa.array(c, pa.int64()) for c in columns]], ["block", "query_id", "query", "vec_id", "score"])

    return run


def top_k(
    rows: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id and score: the k best for each row whose vec_id fits ``is_query``, a condition on vec_id."""
    spark = rows.sparkSession
    vectors = stage(whole_vectors(rows, scale, vec_id, embedding), "whole-vectors")
    bounds = ship(vectors).select("v").mapInArrow(_ranges, "dim long, pos long, low long, high long")
    bounds = bounds.groupBy("dim", "pos").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("dim", "pos").toArrow().to_pydict()
    dims = np.array(bounds["dim"], np.int64)
    ranges = {0: (np.zeros(0, np.int64), np.ones(0, np.int64))}
    for d in np.unique(dims):
        low, high = (np.array(bounds[c], np.int64)[dims == d] for c in ("low", "high"))
        ranges[int(d)] = low, (high - low) // CELLS + 1
    n_vectors = vectors.count()
    dealt = vectors.repartition(partitions_for(n_vectors, BLOCK_ROWS), F.xxhash64("number"))
    files = stage(dealt.mapInArrow(_files(ranges, BLOCK_ROWS), FILES), "va-files")
    queries = stage(vectors.filter(is_query), "queries")
    passes = max(1, math.ceil(queries.count() / QUERY_ROWS))
    found = fresh_path(spark, "va-found")
    for i in range(passes):
        some = queries.filter(F.pmod(F.xxhash64("number"), F.lit(passes)) == i).toArrow()
        ids, numbers, matrices = np.array(some.column("vec_id")), np.array(some.column("number")), {}
        at = 0
        for chunk in some.column("v").chunks:
            for own, m in _matrices(chunk):
                matrices.setdefault(m.shape[1], []).append((ids[at + own], numbers[at + own], m))
            at += len(chunk)
        sent = spark.sparkContext.broadcast({d: tuple(map(np.concatenate, zip(*ps, strict=True))) for d, ps in matrices.items()})
        best = files.mapInArrow(_search(sent, ranges, k), "block string, query_id long, query long, vec_id long, score long")
        groups = math.isqrt(partitions_for(n_vectors, BLOCK_ROWS)) + 1
        ranked = Window.partitionBy("query", F.pmod(F.xxhash64("block"), F.lit(groups))).orderBy(F.desc("score"), "vec_id")
        best = best.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k).drop("rank", "block")
        last = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
        best.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k).write.mode("append").parquet(found)
        sent.unpersist()
    return spark.read.schema("query_id long, query long, vec_id long, score long, rank int").parquet(found).select("query_id", "rank", "vec_id", "score")
