"""Exact distribution of metrics, without gathering or ordering a group in one task.

A sketch proposes narrow value bands around the wanted ranks; the rows of every band are counted
exactly where they are read, so only counts are shuffled. A band is a small number, a sum of comparisons
with the edges in generated code. The rows of the bands that hold a wanted
rank, a few in a thousand, are ordered; bands with more rows than a task may order are stored and
banded again first. If a proposal were off, a band would be wider and the result the same.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gustledger.functions import columns as C
from gustledger.operators import joins
from gustledger.operators.cleaning import present
from gustledger.session import stage

ACCURACY = 10_000
# Edges in a band that is banded again. A part's number is that of its band times PARTS, plus its own.
GRID, PARTS = 32, 64
# Rows of one band that a task may order.
BAND_ROWS = 1_000_000
QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def distribution(
    df: DataFrame,
    metrics: list[str],
    by: list[str] | None = None,
    probs: dict[str, float] | None = None,
    digits: int = 4,
) -> DataFrame:
    """Min, percentiles (linear interpolation), max and mean per metric and group.

    Metrics that are NULL everywhere give no row. Infinite and huge values count like others, so
    an infinite cell shows as an infinite minimum or maximum and mean.
    """
    by, probs, metrics = by or [], probs or QUARTILES, present(df, metrics)
    group = [*by, "coluna"]
    numbers = df.select(*by, *[C.no_nan(F.col(m).cast("double")).alias(m) for m in metrics])
    banded = _banded(numbers, metrics, by, _margins(probs))
    bands = stage(
        banded.groupBy(*group, "_band").agg(
            F.count("*").alias("_in_band"),
            F.min("v").alias("_low"),
            F.max("v").alias("_high"),
            F.sum(C.exact(F.col("v"))).alias("_sum"),
            F.sum(C.extreme(F.col("v"))).alias("_sum_x"),
        ),
        "metric_bands",
    )
    ends = _values_at(banded, _wanted_ranks(bands, group, probs), [*group, "_band"], group)
    hits = ends.groupBy(*group).agg(
        *[
            F.min(F.when((F.col("p") == name) & (F.col("end") == end), F.col("v"))).alias(f"_{name}_{end}")
            for name in probs
            for end in ("low", "high")
        ]
    )
    sums = F.sum("_sum").cast("double")
    totals = bands.groupBy(*group).agg(
        F.sum("_in_band").alias("_total"),
        F.min("_low").alias("min"),
        F.max("_high").alias("max"),
        (F.when(F.sum("_sum_x").isNull(), sums).otherwise(F.coalesce(sums, F.lit(0.0)) + F.sum("_sum_x")) / F.sum("_in_band")).alias("media"),
    )

    def interpolated(name: str, p: float) -> Column:
        position = F.lit(p) * (F.col("_total") - 1)
        low, high = F.col(f"_{name}_low"), F.col(f"_{name}_high")
        # equal ends need no step between them, which would be NaN for infinite ones
        return F.when(low == high, low).otherwise(low + (high - low) * (position - F.floor(position)))

    return joins.key_join(totals, hits, group, "inner", null_safe=True).select(
        *group,
        C.round_half_up(F.col("min"), digits).alias("min"),
        *[C.round_half_up(interpolated(name, p), digits).alias(name) for name, p in probs.items()],
        C.round_half_up(F.col("max"), digits).alias("max"),
        C.round_half_up(F.col("media"), digits).alias("media"),
    )


def _margins(probs: dict[str, float]) -> list[float]:
    """Ranks a little below and above every wanted one; the margin covers the sketch's error."""
    margin = 4 / ACCURACY
    return [min(max(p + s, 0.0), 1.0) for p in probs.values() for s in (-margin, margin)]


def _place(v: Column, edges: list[Column]) -> Column:
    """Edges below the value plus edges not above it, so a value that is an edge has a place of its own.

    Thus every banding parts a band of several values, however many rows one of them holds. An
    unknown edge counts as above.
    """
    below = [F.when(e < v, 2).when(e == v, 1).otherwise(0) for e in edges]
    return reduce(lambda a, b: a + b, below).cast("long")


def _banded(numbers: DataFrame, metrics: list[str], by: list[str], ranks: list[float]) -> DataFrame:
    """(by, coluna, v, _band) of all known cells; the edges are the sketch's values at ``ranks``, by group and metric."""
    edges = numbers.groupBy(*by).agg(*[F.percentile_approx(m, ranks, ACCURACY).alias(f"_e_{m}") for m in metrics])
    if by:
        numbers = joins.lookup_join(numbers, stage(edges, "metric_edges"), by, null_safe=True, stored=True)
        at = {m: [F.get(f"_e_{m}", F.lit(i)) for i in range(len(ranks))] for m in metrics}
    else:  # one row: a few numbers for each metric
        row = edges.first()
        at = {m: [F.lit(e) for e in row[f"_e_{m}"] or [None]] for m in metrics}
    cells = [F.struct(F.col(m).alias("v"), _place(F.col(m), at[m]).alias("_band")).alias(m) for m in metrics]
    long = numbers.select(*by, *cells).unpivot(by, metrics, "coluna", "_cell")
    return long.select(*by, "coluna", "_cell.v", "_cell._band").dropna(subset=["v"])


def _placed(bands: DataFrame, key: list[str]) -> DataFrame:
    """Adds the rows before each band of its key; a key has a band for each edge and one more."""
    order = W.partitionBy(*key).orderBy("_low").rowsBetween(W.unboundedPreceding, -1)
    return bands.withColumn("_start", F.coalesce(F.sum("_in_band").over(order), F.lit(0)))


def _wanted_ranks(bands: DataFrame, group: list[str], probs: dict[str, float]) -> DataFrame:
    """Bands that hold a rank next to a wanted one, with the offsets of these ranks in the band."""
    placed = _placed(bands, group).withColumn("_total", F.sum("_in_band").over(W.partitionBy(*group)))

    def rank(name: str, p: float, end: str) -> Column:
        position = F.lit(p) * (F.col("_total") - 1)
        at = (F.floor(position) if end == "low" else F.ceil(position)).cast("long")
        return F.struct(F.lit(name).alias("p"), F.lit(end).alias("end"), (at - F.col("_start")).alias("offset"))

    ranks = F.array(*[rank(name, p, end) for name, p in probs.items() for end in ("low", "high")])
    return _holding(placed.withColumn("_ranks", ranks), group)


def _holding(placed: DataFrame, key: list[str]) -> DataFrame:
    inside = F.filter("_ranks", lambda r: (r["offset"] >= 0) & (r["offset"] < F.col("_in_band")))
    return placed.withColumn("_ranks", inside).filter(F.size("_ranks") > 0).select(*key, "_band", "_in_band", "_low", "_high", "_ranks")


def _rows_of(rows: DataFrame, wanted: DataFrame, key: list[str], group: list[str]) -> tuple[DataFrame, DataFrame]:
    """The wanted bands that hold several values, and their rows; both under new small band numbers.

    Without groups the bands are a few for each metric.
    """
    number = F.row_number().over(W.partitionBy(*group).orderBy("_band")).cast("long")
    several = wanted.filter("_low < _high").withColumn("_no", number)
    side = several.select(*key, "_no")
    if len(group) == 1:
        found = joins.key_join(rows, F.broadcast(side), key, "inner", null_safe=True)
    else:
        found = joins.lookup_join(rows, side, key, "inner", null_safe=True)
    return several.withColumn("_band", F.col("_no")).drop("_no"), found.select(*group, F.col("_no").alias("_band"), "v")


def _values_at(banded: DataFrame, wanted: DataFrame, key: list[str], group: list[str]) -> DataFrame:
    """(group, p, end, v): the values at the wanted offsets of their bands."""
    wanted = stage(wanted, "wanted_bands")
    ready = lambda bands: bands.filter("_low = _high").select(*group, F.explode("_ranks").alias("_rank"), F.col("_low").alias("v"))
    found = [ready(wanted)]  # all rows of such a band are the value
    left, rows = _rows_of(banded.select(*key, "v"), wanted, key, group)
    while (left.agg(F.max("_in_band")).first()[0] or 0) > BAND_ROWS:
        # Bands too large to order are banded again by a grid of their own values.
        rows = stage(rows, "band_rows")
        edges = rows.groupBy(*key).agg(F.percentile_approx("v", [i / GRID for i in range(1, GRID)], ACCURACY).alias("_edges"))
        rows = joins.lookup_join(rows, stage(edges, "band_edges"), key, null_safe=True, stored=True)
        part = F.col("_band") * PARTS + _place(F.col("v"), [F.get("_edges", F.lit(i)) for i in range(GRID - 1)])
        rows = stage(rows.withColumn("_band", part).drop("_edges"), "band_rows")
        parts = rows.withColumn("_parent", F.floor(F.col("_band") / PARTS)).groupBy(*key, "_parent").agg(
            F.count("*").alias("_in_band"), F.min("v").alias("_low"), F.max("v").alias("_high")
        )
        above = left.select(*group, F.col("_band").alias("_parent"), "_ranks")
        placed = joins.key_join(_placed(parts, [*group, "_parent"]), above, [*group, "_parent"], "inner", null_safe=True)
        moved = F.transform("_ranks", lambda r: F.struct(r["p"].alias("p"), r["end"].alias("end"), (r["offset"] - F.col("_start")).alias("offset")))
        wanted = stage(_holding(placed.withColumn("_ranks", moved), group), "wanted_bands")
        found.append(ready(wanted))
        left, rows = _rows_of(rows, wanted, key, group)
    copies = rows.groupBy(*key, "v").agg(F.count("*").alias("_copies"))
    in_order = W.partitionBy(*key).orderBy("v").rowsBetween(W.unboundedPreceding, 0)
    ordered = copies.withColumn("_cum", F.sum("_copies").over(in_order))
    hits = joins.key_join(ordered, left.select(*key, "_ranks"), key, "inner", null_safe=True)
    hits = hits.select(*key, "v", "_cum", F.explode("_ranks").alias("_rank")).filter(F.col("_cum") > F.col("_rank.offset"))
    found.append(hits.groupBy(*key, "_rank").agg(F.min("v").alias("v")).select(*group, "_rank", "v"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select(*group, "_rank.p", "_rank.end", "v")
