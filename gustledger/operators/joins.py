"""Joins that stay even when one key holds a large part of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustledger.functions import columns as C
from gustledger.session import stage

# A lookup side up to this many rows and stored bytes is broadcast, a larger one is joined by shuffle.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20
# Rows of one key that a task may have; a key with more is split over several tasks.
HOT_ROWS = 1_000_000
# Keys that a sketch of frequent keys tracks, and the tasks that merge sketches before the last one does.
SKETCH_ITEMS, SKETCH_GROUPS = 1 << 14, 32
# Keys up to which a filter names them.
LISTED_KEYS = 1_000
KINDS = ("inner", "left", "left_semi", "left_anti")

_HASH, _SALTS, _SALT = "_key_hash", "_salts", "_salt"


def fits_broadcast(stored: DataFrame, max_rows: int | None = None) -> bool:
    """Whether a stored table may be broadcast: by its rows, and by the bytes of its needed columns."""
    size = int(str(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size <= BROADCAST_BYTES and stored.count() <= (BROADCAST_ROWS if max_rows is None else max_rows)


def _common_types(left: DataFrame, right: DataFrame, on: list[str]) -> list[str]:
    """The type in which each key is compared; keys that are equal in it must have equal hashes."""
    found = []
    for k in on:
        a, b = left.schema[k].dataType, right.schema[k].dataType
        if a != b:
            both = F.coalesce(F.lit(None).cast(a), F.lit(None).cast(b)).alias("k")
            a = left.sparkSession.range(0).select(both).schema["k"].dataType
        found.append(a.simpleString())
    return found


def _hash(keys: list[str], types: list[str]) -> Column:
    return F.xxhash64(*[F.col(k).cast(t) for k, t in zip(keys, types, strict=True)])


def proposed_keys(hashes: DataFrame, most: int) -> DataFrame:
    """Stored hashes that may have more than ``most`` rows, from a sketch of frequent items.

    Every task sends one sketch of bounded size; they are merged in two steps. Estimates are never below
    the true count, and a hash with more than 4 / SKETCH_ITEMS of all rows is always among them. One that
    isn't has no more rows than each of SKETCH_ITEMS / 4 equal tasks would have.
    """
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_group")
    parts = hashes.groupBy(group).agg(F.expr(f"approx_top_k_accumulate({_HASH}, {SKETCH_ITEMS})").alias("_sketch"))
    merged = F.expr(f"approx_top_k_estimate(approx_top_k_combine(_sketch, {SKETCH_ITEMS}), {SKETCH_ITEMS})")
    # One group, as a grouped aggregate asks nothing of tasks without rows; there combining sketches fails.
    found = parts.groupBy(F.pmod("_group", F.lit(1))).agg(merged.alias("_top")).select(F.explode("_top").alias("_item"))
    return stage(found.filter(F.col("_item.count") > most).select(F.col("_item.item").alias(_HASH)), "hot_proposals")


def hot_keys(df: DataFrame, keys: list[str], rows_per_task: int | None = None, types: list[str] | None = None) -> DataFrame:
    """Hashes of the keys with more rows than a task should have, and over how many to split each.

    A sketch proposes keys, their exact counts decide: only proposed keys are counted, and where the
    sketch proposes none the table is not read again. Both passes read the key columns only. There are
    at most SKETCH_ITEMS such keys, 16 bytes each, so the result can be broadcast.
    """
    most = HOT_ROWS if rows_per_task is None else rows_per_task
    types = types or [df.schema[k].dataType.simpleString() for k in keys]
    hashes = df.select(_hash(keys, types).alias(_HASH))
    proposed = proposed_keys(hashes, most)
    if proposed.isEmpty():
        return proposed.withColumn(_SALTS, F.lit(1))
    counts = hashes.join(F.broadcast(proposed), _HASH, "left_semi").groupBy(_HASH).agg(F.count("*").alias("n"))
    hot = counts.filter(F.col("n") > most).select(_HASH, F.ceil(F.col("n") / most).cast("int").alias(_SALTS))
    return stage(hot, "hot_keys")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    null_safe: bool = False,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Equi join by shuffle whose hot left keys are spread over as many tasks as their rows need.

    ``how`` is inner, left, left_semi or left_anti. Only rows of hot keys carry a salt, and
    only their right rows are repeated. The set of hot keys is stored, so both sides see the
    same one. The salt comes from the row and its input partition, not from a random number,
    so a task that runs again gives the same rows.
    """
    if how not in KINDS:
        raise ValueError(f"how must be one of {KINDS}, not {how!r}: right rows repeat here")
    types = _common_types(left, right, on)
    hot = F.broadcast(hot_keys(left, on, rows_per_task, types))
    salt = F.pmod(F.xxhash64(*left.columns, F.spark_partition_id()), F.col(_SALTS)).cast("int")
    salted = left.withColumn(_HASH, _hash(on, types)).join(hot, _HASH, "left")
    salted = salted.withColumn(_SALT, F.coalesce(salt, F.lit(0))).drop(_HASH, _SALTS)
    copies = F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1)
    spread = right.withColumn(_HASH, _hash(on, types)).join(hot, _HASH, "left")
    spread = spread.withColumn(_SALT, F.explode(copies)).drop(_HASH, _SALTS)
    return key_join(salted, spread, on, how, null_safe, also=[_SALT]).drop(_SALT)


def key_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str, null_safe: bool = False, also: tuple | list = ()
) -> DataFrame:
    """Join on shared column names, optionally with NULL equal to NULL; the left keys are kept."""
    renamed = {k: f"_r_{k}" for k in [*on, *also]}

    def same(k: str) -> Column:
        return F.col(k).eqNullSafe(F.col(renamed[k])) if null_safe else F.col(k) == F.col(renamed[k])

    condition = reduce(lambda a, b: a & b, [same(k) for k in renamed])
    return left.join(right.withColumnsRenamed(renamed), condition, how).drop(*renamed.values())


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    null_safe: bool = False,
    max_rows: int | None = None,
    stored: bool = False,
) -> DataFrame:
    """Join a large side with a lookup side: broadcast if its measured size allows, else salted.

    The lookup side is stored first, so that measuring does not compute it twice; ``stored``
    says that it is a stored table already.
    """
    right = right if stored else stage(right, "lookup")
    if fits_broadcast(right, max_rows):
        return key_join(left, F.broadcast(right), on, how, null_safe)
    return salted_join(left, right, on, how, null_safe)


def filter_by_keys(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key is in the column of the same name of the stored table ``keys``.

    Up to ``LISTED_KEYS`` keys are named in the filter, which the parquet scan sees: row groups whose
    statistics, dictionary or Bloom filter rule them out are not read (up to ten keys one by one,
    more by their range). More keys are a semi join.
    """
    few = keys.select(key).filter(F.col(key).isNotNull()).limit(LISTED_KEYS + 1).collect()
    if len(few) > LISTED_KEYS:
        return lookup_join(df, keys.select(key), [key], "left_semi", stored=True)
    return df.filter(F.col(key).isin(sorted({row[0] for row in few})))


def embedded_key_join(
    facts: DataFrame, registry: DataFrame, code: str, registry_key: str, pattern: str
) -> DataFrame:
    """Keep the fact rows whose code embeds a registered key, with the registry's columns.

    A registry key that repeats gives one row per occurrence. Codes without a match have the
    empty key and leave before the join, where they would all meet in one task.
    """
    key = "_embedded_key"
    lookup = registry.withColumnRenamed(registry_key, key).filter(F.col(key) != "")
    coded = facts.withColumn(key, C.embedded_key(F.col(code), pattern)).filter(F.col(key) != "")
    return lookup_join(coded, lookup, [key]).drop(key)


def semi_filter(df: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column) -> DataFrame:
    """Rows of ``df`` whose upper-cased key occurs, upper-cased, in ``wanted``.

    ``wanted`` may be large: its distinct keys are stored once, then counted and joined.
    """
    name = "_semi_key"
    keys = wanted.select(F.upper(wanted_key).alias(name)).filter(F.col(name).isNotNull()).distinct()
    keys = stage(keys, "semi_keys")
    return lookup_join(df.withColumn(name, F.upper(key)), keys, [name], "left_semi", stored=True).drop(name)


def case_insensitive_left_join(
    left: DataFrame, right: DataFrame, left_key: Column, right_key: Column, extra: list[str]
) -> DataFrame:
    """Left join on an upper-cased computed key and the ``extra`` columns both sides share.

    The right side decides how: a small one is broadcast, otherwise hot keys are salted. Rows
    whose key is NULL stay unmatched.
    """
    name = "_ci_key"
    return lookup_join(
        left.withColumn(name, F.upper(left_key)),
        right.withColumn(name, F.upper(right_key)).dropna(subset=[name, *extra]),
        [name, *extra],
        "left",
    ).drop(name)


def missing_keys(registry: DataFrame, facts: DataFrame, registry_key: str, fact_key: str) -> DataFrame:
    """Registry rows without any fact row; the facts are reduced to their keys first."""
    seen = facts.select(F.col(fact_key).alias(registry_key)).distinct()
    return registry.join(seen, registry_key, "left_anti")


def key_difference(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Drop every row whose key occurs in ``keys`` (a stored table); NULL keys equal NULL keys."""
    return lookup_join(df, keys.select(*on), on, "left_anti", null_safe=True, stored=True)


def key_intersection(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Keep every row whose key occurs in ``keys`` (a stored table); NULL keys equal NULL keys."""
    return lookup_join(df, keys.select(*on), on, "left_semi", null_safe=True, stored=True)
