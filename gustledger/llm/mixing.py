"""Mixing sources to target weights.

Words are summed per source, targets are shared by weight with a limit per source, and every
document is emitted floor(rate) times, plus once more with the probability of the fraction. The
draw hashes the document and a seed, so reruns agree. Sources stay in tables: ranks come from a
distributed sort, the shares from a few sums over one row per source.

A null text has no words, a null source is a source of its own and sorts last. The draw knows a row
by its id, source and text, so repeated rows share one; rows of a null id have a number of their own in it
as well, which is the same in reruns over the same files. A very long text is only counted and hashed. A
source without words has the target 0 and rate 0, as an empty table has no sources. Names of extra columns
don't matter; columns named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gustledger.llm.common import free_name, stage, text_of

WORD = r"[^\x20\x09-\x0D]+"
RESULTS = ("size", "source_size", "target", "copies")


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def draw(seed: str, *of: Column) -> Column:
    """A number in [0, 1) that depends on the columns and the seed only."""
    parts = [F.coalesce(c.cast("string"), F.lit("\x1e")) for c in of]
    digest = F.md5(F.concat_ws("\x1f", F.lit(seed), *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, limit: float) -> DataFrame:
    """source, source_size and target of every source.

    ``sizes`` has source and size. The weights repeat over the sources by code point, null last.
    All targets add up to ``share`` of all sizes; a target above ``limit`` times its source's size
    stops there and the excess goes to the others by weight, until none is above.
    """
    sums = stage(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    ranked = _ranked(sums)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    weighted = stage(ranked.select("source", "source_size", weight.alias("weight")), "source-weights")
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:  # the level rises until no further source reaches its limit
        full = limit * F.col("source_size") <= F.lit(level) * F.col("weight")
        a, b = weighted.agg(
            F.sum(F.when(full, F.col("source_size")).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))
        ).first()
        if not b:
            break
        new = (share * total - limit * a) / b
        if new <= level:
            break
        level = new
    target = F.least(limit * F.col("source_size"), F.lit(level) * F.col("weight")).cast("double")
    return stage(weighted.select("source", "source_size", target.alias("target")), "source-targets")


def _ranked(sums: DataFrame) -> DataFrame:
    """Adds the source's place in the order of all, from a distributed sort and the row counts of its partitions."""
    placed = sums.sort(F.col("source").asc_nulls_last())
    placed = stage(placed.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "source-order")
    parts = placed.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    # One row for each partition of the sort, so a setting bounds the rows of this window.
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", "first", F.coalesce(before, F.lit(0)).alias("before"))
    return placed.join(parts, "part").select("source", "source_size", (F.col("at") - F.col("first") + F.col("before")).alias("rank"))


def _planned(docs: DataFrame, weights: Sequence[int], share: float, limit: float, seed: str) -> tuple[DataFrame, str]:
    """The documents with one more column, a struct of the results, and its name."""
    sizes = docs.select("source", n_words(text_of()).alias("size"))
    size, at, goal, mix_source, out = (free_name(docs, n) for n in ("mix_size", "mix_draw", "mix_goal", "mix_source", "mix_result"))
    targets = source_targets(sizes, weights, share, limit).select(F.col("source").alias(mix_source), F.struct("source_size", "target").alias(goal))
    # The number of a row is taken where the rows are read; a null number is an empty text in the draw.
    number = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    own = draw(seed, F.col("doc_id"), F.col("source"), F.md5(text_of().cast("binary")), F.coalesce(number.cast("string"), F.lit("")))
    sized = docs.select("*", n_words(text_of()).alias(size), own.alias(at))
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col(mix_source)), "left")
    words, target = F.col(f"{goal}.source_size"), F.col(f"{goal}.target")
    rate = F.when(words > 0, target / words).otherwise(0.0)
    whole = F.floor(rate)
    extra = (F.col(at) < rate - whole).cast("long")
    result = F.struct(F.col(size).alias("size"), words.alias("source_size"), target.alias("target"), (whole + extra).cast("long").alias("copies"))
    return joined.select(*[sized[f"`{c}`"] for c in docs.columns], result.alias(out)), out


def plan(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, limit: float = 2.0, seed: str = "mix") -> DataFrame:
    """The documents with size, source_size, target and copies, the times the mix takes each."""
    planned, out = _planned(docs, weights, share, limit, seed)
    return planned.select(*[F.col(f"`{c}`") for c in docs.columns if c not in RESULTS], f"{out}.*")


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, limit: float = 2.0, seed: str = "mix") -> DataFrame:
    """The mixed documents themselves: every row as often as the plan takes it, with the columns of ``docs``."""
    planned, out = _planned(docs, weights, share, limit, seed)
    taken = planned.filter(F.col(f"{out}.copies") > 0)
    each = taken.withColumn(free_name(taken, "mix_copy"), F.explode(F.sequence(F.lit(1), F.col(f"{out}.copies").cast("int"))))
    return each.select(*[F.col(f"`{c}`") for c in docs.columns])
