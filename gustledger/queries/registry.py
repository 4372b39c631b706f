"""Registered queries: a name, a Spark function and, where SQL can say it, the SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gustledger.session import staging_root

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def folder(spark: SparkSession, name: str) -> str:
    """A new folder of the shared ones, for what a query writes."""
    return f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"


def rounded(expr: str, digits: int) -> str:
    """SQL text that rounds on the decimal value and returns a double."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def exact(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(18,8))"
