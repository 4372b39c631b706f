"""Duplicate keys: identical copies collapse, conflicting rows go to quarantine.

No row meets all other rows of its key in one task. Keys are counted first, on the key
columns alone; rows whose key occurs once pass without a shuffle of their own. The repeated
keys are decided by aggregates that combine on the map side, so a key with any number of
rows arrives as a few partial rows. The counts and decisions are stored, each made once;
``df`` is read by several passes, so pass a stored table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustledger.operators import joins
from gustledger.session import stage

DOCUMENTED, REFERENCE, FIRST = "documented", "reference", "first"


@dataclass(frozen=True)
class DuplicateSplit:
    clean: DataFrame  # one row per key that is unique or only has identical rows
    quarantined: DataFrame  # conflicting rows
    counts: DataFrame  # one row: identical_removed, conflicting


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows ``n``."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def split_duplicates(
    df: DataFrame,
    key: list[str],
    ignore: tuple[str, ...] = (),
    policy: str = DOCUMENTED,
    repeated: DataFrame | None = None,
    address: str | None = None,
) -> DuplicateSplit:
    """Separate clean rows from conflicting ones.

    ``documented``: a key whose rows differ is quarantined with all its rows; ``ignore`` names
    columns that do not make rows differ. ``reference``: only the rows of a repeated key that
    have no identical copy are quarantined, the key's other rows leave the data as well, and
    a key whose every row has a copy keeps its lowest row. ``first``: as ``reference``, but such a
    key keeps the row that comes first. What comes first is said by the column ``address``, which
    ``files.read_union`` fills with the place of each row in its files; it stays the same on a
    rerun and on any number of tasks, does not make rows differ, and is a column of the results
    (a quarantined row's own, a kept row's the lowest of its copies). Rows of one address, and rows
    without one, which come last, are told apart by their values, the lowest first. ``repeated`` is the stored result of ``repeated_keys``, if the
    caller has it.
    """
    if (policy == FIRST) != (address is not None):
        raise ValueError(f"the policy {FIRST!r}, and no other, needs an address column")
    repeated = stage(repeated_keys(df, key), "repeated") if repeated is None else repeated
    single = joins.key_difference(df, repeated, key)
    multi = joins.key_intersection(df, repeated, key)
    if policy == DOCUMENTED:
        kept, quarantined, counts = _documented(multi, key, ignore)
    elif policy in (REFERENCE, FIRST):
        kept, quarantined, counts = _reference(multi, key, address)
    else:
        raise ValueError(f"unknown policy {policy!r}")
    return DuplicateSplit(single.unionByName(kept), quarantined, counts)


def _documented(multi: DataFrame, key: list[str], ignore: tuple[str, ...]):
    rest = [c for c in multi.columns if c not in key and c not in ignore]
    row = F.struct(*(rest or [F.lit(1).alias("one")]))
    per_key = multi.groupBy(*key).agg(
        F.count("*").alias("_n"),
        F.min(row).alias("_low"),
        F.max(row).alias("_high"),
        *[F.min(c).alias(c) for c in ignore],
    )
    per_key = stage(per_key, "repeated_rows")
    same = F.col("_low").eqNullSafe(F.col("_high"))
    kept = per_key.filter(same).select(
        *[F.col(c) if c in key or c in ignore else F.col("_low")[c].alias(c) for c in multi.columns]
    )
    quarantined = joins.key_intersection(multi, per_key.filter(~same), key)
    counts = per_key.agg(
        F.coalesce(F.sum(F.when(same, F.col("_n") - 1)), F.lit(0)).alias("identical_removed"),
        F.coalesce(F.sum(F.when(~same, F.col("_n"))), F.lit(0)).alias("conflicting"),
    )
    return kept, quarantined, counts


def _reference(multi: DataFrame, key: list[str], address: str | None):
    rest = [c for c in multi.columns if c not in key and c != address]
    place = [F.min(address).alias(address)] if address else []
    copies = multi.groupBy(*key, *rest).agg(F.count("*").alias("_copies"), *place).select(*multi.columns, "_copies")
    copies = stage(copies, "repeated_rows")
    first = [F.col(address).isNull().alias("_unplaced"), F.col(address)] if address else []
    per_key = copies.groupBy(*key).agg(
        F.min("_copies").alias("_fewest"),
        F.sum("_copies").alias("_n"),
        F.count_if(F.col("_copies") == 1).alias("_lone"),
        F.min(F.struct(*first, *rest)).alias("_low"),
    )
    agreeing = F.col("_fewest") > 1
    kept = per_key.filter(agreeing).select(
        *[F.col(c) if c in key else F.col("_low")[c].alias(c) for c in multi.columns]
    )
    quarantined = copies.filter("_copies = 1").drop("_copies")
    counts = per_key.agg(
        F.coalesce(F.sum(F.when(agreeing, F.col("_n") - 1)), F.lit(0)).alias("identical_removed"),
        F.coalesce(F.sum("_lone"), F.lit(0)).alias("conflicting"),
    )
    return kept, quarantined, counts
