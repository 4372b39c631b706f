"""Primary-key checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F


class KeyViolation(ValueError):
    pass


def key_violations(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that repeat or hold a NULL, with their number of rows ``n``."""
    any_null = F.greatest(*[F.col(k).isNull() for k in key]) if len(key) > 1 else F.col(key[0]).isNull()
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter((F.col("n") > 1) | any_null)


def clustered(df: DataFrame, key: list[str], lead: list[str]) -> tuple[DataFrame, Observation]:
    """The rows in ranges of (lead, key), each task's sorted, and how many break the key, as ``broken``.

    Rows of equal keys are neighbours in one task, so the exchange that arranges a table for its
    writer also tells whether its key repeats: rows that follow one of their key, or hold a NULL in it,
    are counted as they pass and are known once the rows are written. ``lead`` has to follow from the key.
    """
    order = [*lead, *key]
    follows = F.row_number().over(Window.partitionBy(*order).orderBy(*order)) > 1
    name = "_follows"
    rows = df.repartitionByRange(*order).withColumn(name, follows)
    seen = Observation()
    null = F.array_contains(F.array(*[F.col(k).isNull() for k in key]), True)
    counted = rows.observe(seen, F.count_if(F.col(name) | null).alias("broken")).drop(name)
    return counted.sortWithinPartitions(*order), seen


def assert_key(df: DataFrame, key: list[str], table: str) -> DataFrame:
    """Return ``df`` if the key is unique and not null, else raise with some offending keys."""
    bad = key_violations(df, key).take(5)
    if bad:
        raise KeyViolation(f"{table}: key {key} is violated, e.g. {[r.asDict() for r in bad]}")
    return df


def assert_not_null(df: DataFrame, key: list[str], table: str) -> DataFrame:
    """Like ``assert_key`` where the rows were grouped by the key, so that it can't repeat."""
    bad = df.filter(F.array_contains(F.array(*[F.col(k).isNull() for k in key]), True)).select(*key).take(5)
    if bad:
        raise KeyViolation(f"{table}: key {key} is violated, e.g. {[r.asDict() for r in bad]}")
    return df
