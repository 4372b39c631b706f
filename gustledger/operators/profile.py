"""Counts, profiles, traces and health of tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gustledger.functions import columns as C
from gustledger.operators.cleaning import present
from gustledger.session import stage


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


class Counter:
    """Counters of rows on their way to a writer, which need no scan of their own.

    They are taken in the tasks that write, where a repeated task counts once. ``metrics`` are
    aggregates without DISTINCT; one counter serves one write.
    """

    def __init__(self, metrics: dict[str, Column]):
        self.metrics, self._seen = metrics, Observation()

    def on(self, df: DataFrame) -> DataFrame:
        return df.observe(self._seen, *[c.cast("long").alias(n) for n, c in self.metrics.items()])

    def row(self, spark: SparkSession) -> DataFrame:
        """The counters as one row, once the write has ended."""
        found = self._seen.get
        row = tuple(found.get(n, 0) for n in self.metrics)
        return spark.createDataFrame([row], ", ".join(f"`{n}` long" for n in self.metrics))


def stage_counted(df: DataFrame, name: str, metrics: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """The staged table, and its counters as one row."""
    counter = Counter(metrics)
    stored = stage(counter.on(df), name)
    return stored, counter.row(df.sparkSession)


def count_by(df: DataFrame, *keys: str, name: str = "total_linhas", by_count: bool = False) -> DataFrame:
    """Rows per key, ordered by key or by falling count."""
    counts = df.groupBy(*keys).agg(F.count("*").alias(name))
    return counts.orderBy(*([F.desc(name)] if by_count else []), *[F.asc_nulls_last(k) for k in keys])


def count_by_file(df: DataFrame, name: str = "total_linhas") -> DataFrame:
    """Rows per source file of a frame read straight from files."""
    files = df.select(F.col("_metadata.file_name").alias("filename"))
    return count_by(files, "filename", name=name)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, n) of several tables in one job."""
    return union_all(
        [t.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n") for name, t in tables.items()]
    )


def describe(df: DataFrame) -> DataFrame:
    """(column_name, column_type) in column order."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column_name string, column_type string")


def sample_rows(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a stated order (a top-k, not a full sort)."""
    return df.orderBy(*[F.asc_nulls_last(c) for c in order]).limit(n)


def table_profile(df: DataFrame, order: list[str], rows: int = 5) -> dict[str, DataFrame]:
    """Row count, columns, first rows and rows per file of a frame read straight from files."""
    return {
        "count": df.agg(F.count("*").alias("total_linhas")),
        "schema": describe(df),
        "sample": sample_rows(df, order, rows),
        "files": count_by_file(df),
    }


def null_counts(df: DataFrame, names: list[str]) -> DataFrame:
    """(coluna, nulos) of the columns that a join relies on, before the join drops them."""
    return long_metrics(df, {n: F.count_if(F.col(n).isNull()) for n in names}, "coluna", "nulos")


def trace(layers: dict[str, tuple[DataFrame, Column]], key: str | None = None) -> DataFrame:
    """(layer, n) of the rows that satisfy each layer's predicate; with ``key`` also ``example``, the lowest key among them."""
    aggs = [F.count("*").alias("n")] + ([F.min(key).alias("example")] if key else [])
    return union_all(
        [df.filter(cond).agg(*aggs).select(F.lit(layer).alias("layer"), "*") for layer, (df, cond) in layers.items()]
    )


def health(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(table, status, n, detail): UP with its count, DEGRADED if empty or damaged, DOWN if it isn't there.

    Each table is counted by itself, several at a time, so a damaged one does not hide the others.
    """

    def one(name: str) -> tuple:
        try:
            n = spark.read.parquet(paths[name]).count()
        except AnalysisException as e:
            return name, "DOWN", None, e.getCondition()
        except PySparkException as e:
            return name, "DEGRADED", None, e.getCondition() or type(e).__name__
        except Py4JJavaError as e:
            return name, "DEGRADED", None, e.java_exception.getClass().getSimpleName()
        return name, "UP" if n else "DEGRADED", n, None

    with ThreadPoolExecutor(8) as pool:
        rows = list(pool.map(one, paths))
    return spark.createDataFrame(rows, "table string, status string, n long, detail string")


def null_percentages(df: DataFrame, metrics: list[str], name: str) -> DataFrame:
    """(column, percentage of NULL cells), all metrics in one pass."""
    metrics = present(df, metrics)
    row = df.agg(
        *[C.percent(F.count_if(F.col(m).isNull()), F.count("*"), 2).alias(m) for m in metrics]
    )
    return row.unpivot([], metrics, "coluna", name)


def null_profile(before: DataFrame, after: DataFrame, metrics: list[str]) -> DataFrame:
    """(coluna, antes_pct, depois_pct) of the metrics that the treated table has."""
    left = null_percentages(after, metrics, "depois_pct")
    right = null_percentages(before, metrics, "antes_pct")
    return left.join(right, "coluna", "left").select(
        "coluna", F.coalesce("antes_pct", F.lit(0.0)).alias("antes_pct"), "depois_pct"
    )


def long_metrics(df: DataFrame, metrics: dict[str, Column], label: str = "metric", value: str = "n") -> DataFrame:
    """Several aggregates of one pass as rows (metric, n)."""
    row = df.agg(*[c.cast("long").alias(m) for m, c in metrics.items()])
    return row.unpivot([], list(metrics), label, value)


def coverage(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, group_key: str) -> DataFrame:
    """One row: assets in the dimension, with facts, without facts, without a group."""
    seen = fact.select(F.col(fact_key).alias(dim_key)).distinct().withColumn("_seen", F.lit(True))
    return dim.join(seen, dim_key, "left").agg(
        F.count("*").alias("assets"),
        F.count_if("_seen").alias("with_facts"),
        F.count_if(F.col("_seen").isNull()).alias("without_facts"),
        F.count_if(F.col(group_key).isNull()).alias("without_group"),
    )
