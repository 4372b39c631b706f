"""Merkle manifest of a dataset by concatenated levels.

Every row is a leaf. The leaves of a group (a source) stand in order; an aligned block of them is
one row that keeps each level of its part of the tree as one string of hex digests, 64 characters a
node. The parents are digests of fixed-width substrings of that string, the siblings of a node are
the parts of its run's substring on both sides of it. The blocks' roots are the nodes of the next
tier, which is made in the same way until one node of each group is left; the groups' roots are
joined by one more tree. The strings are kept as bytes, where a substring needs no counting of
characters.

Places come from a distributed sort and row counts of its partitions, so a group of any size is
split; a task holds one block at a time. Siblings travel down as one short list for each block.

Null fields have a mark of their own, a null group is a group and the first. Leaves of one group and
id (null first) are ordered by their digest, so rows that repeat are leaves of their own with the
same digests, and which of them is first doesn't matter. A long text is one field like others. An empty table has no leaves and no root.
Columns of other names are not read; the result has the columns of RESULTS only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gustledger.llm.common import stage
from gustledger.operators import joins

ARITY, DIGITS = 16, 64
RUN = ARITY * DIGITS
DEPTH = 2  # levels of a block; a row of its leaves carries the levels, so they should be short
BLOCK = ARITY**DEPTH
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RESULTS = ("doc_id", "leaf", "claim", "subroot", "root", "siblings")
_SIBLINGS = "array<struct<left:binary,right:binary>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes before it, so that no two rows give one text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def _parents(level: Column) -> Column:
    """The next level: the digests of a level's runs of sixteen nodes, one after the other."""
    runs = F.sequence(F.lit(0), F.floor((F.octet_length(level) - 1) / RUN).cast("int"))
    nodes = F.transform(runs, lambda j: F.sha2(F.substring(level, j * RUN + 1, F.lit(RUN)), 256))
    return F.array_join(nodes, "").cast("binary")


def _placed(nodes: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds each node's place in its group ``g`` and the group's number of nodes.

    The rows' own numbers end the order, so that rows that agree in all else can be split as well.
    """
    numbered = nodes.withColumn("tie", F.monotonically_increasing_id())
    sorted_rows = numbered.sort("g", *order, "tie").drop("tie")
    staged = stage(sorted_rows.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), name)
    # One row for each partition that a group reaches into: the partitions and the groups bound their number.
    parts = staged.groupBy("g", "part").agg(F.count("*").alias("own"), F.min("at").alias("first"))
    earlier = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "g", "part", "first", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("before"),
        F.sum("own").over(Window.partitionBy("g")).alias("n"),
    )
    joined = joins.lookup_join(staged, parts, ["g", "part"])
    return joined.withColumn("place", F.col("at") - F.col("first") + F.col("before")).drop("part", "at", "first", "before")


def _blocks(nodes: DataFrame, name: str) -> DataFrame:
    """Blocks (g, n, block) of nodes (g, n, place, node, more) with their levels and root.

    A group is reduced until one node is left: blocks of a group with more nodes take all DEPTH
    levels, even where their last run holds one node, those of a smaller group as many as it needs.
    """
    more = [c for c in nodes.columns if c not in ("g", "n", "place")]
    block = F.floor(F.col("place") / BLOCK).cast("bigint").alias("block")
    rows = nodes.groupBy("g", "n", block).agg(F.sort_array(F.collect_list(F.struct("place", *more))).alias("nodes"))
    levels = rows.withColumn("l0", F.array_join(F.transform("nodes", lambda x: x["node"]), "").cast("binary"))
    for i in range(DEPTH):
        levels = levels.withColumn(f"l{i + 1}", F.when(F.col("n") > ARITY**i, _parents(F.col(f"l{i}"))))
    top = F.coalesce(*[F.col(f"l{i}") for i in range(DEPTH, -1, -1)])
    return stage(levels.withColumn("top", top.cast("string")), name)


def _tiers(leaves: DataFrame, name: str) -> list[DataFrame]:
    """The blocks of every tier, from the leaves up; in the last one every group is one block."""
    tiers = [_blocks(leaves, f"{name}-blocks")]
    while (tiers[-1].agg(F.max("n")).first()[0] or 0) > BLOCK:
        blocks = tiers[-1].filter(F.col("n") > BLOCK)
        nodes = blocks.select(
            "g", F.ceil(F.col("n") / BLOCK).cast("bigint").alias("n"), F.col("block").alias("place"), F.col("top").alias("node")
        )
        tiers.append(_blocks(nodes, f"{name}-blocks"))
    return tiers


def _segments() -> Column:
    """The siblings on both sides of a node, for each level that its block has."""
    found = []
    for i in range(DEPTH):
        at = F.floor((F.col("x.place") % BLOCK) / ARITY**i).cast("int")
        run = F.substring(F.col(f"l{i}"), F.floor(at / ARITY).cast("int") * RUN + 1, F.lit(RUN))
        inside = (at % ARITY) * DIGITS
        left, right = F.substring(run, F.lit(1), inside), F.substring(run, inside + DIGITS + 1, F.lit(RUN))
        found.append(F.when(F.col("n") > ARITY**i, F.struct(left.alias("left"), right.alias("right"))))
    return F.array_compact(F.array(*found)).cast(_SIBLINGS)


def _down(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """The nodes of the lowest tier with all siblings up to the root.

    ``above`` has for each group g what its root needs: group_root, root and up, the siblings above it.
    """
    paths = None
    for tier in reversed(tiers):
        whole = joins.lookup_join(tier.filter(F.col("n") <= BLOCK), above, ["g"])
        if paths is not None:
            parts = tier.filter(F.col("n") > BLOCK)
            whole = whole.unionByName(joins.lookup_join(parts, paths, ["g", "block"]))
        levels = [f"l{i}" for i in range(DEPTH)]
        nodes = whole.select("g", "n", *levels, "group_root", "root", "up", F.explode("nodes").alias("x"))
        own = nodes.select("g", "x", "group_root", "root", F.concat(_segments(), "up").alias("up"))
        if tier is not tiers[0]:
            paths = own.select("g", F.col("x.place").alias("block"), "group_root", "root", "up")
    return own


def manifest(
    docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "source", key: str = "doc_id", claims: dict[str, Column] | None = None
) -> DataFrame:
    """Per row: key, leaf, claim, subroot of its group, root of all, and siblings from leaf to root.

    ``claims`` replaces columns of a row by expressions and gives the leaf that the row would then
    have, null where they are null for lack of a claim; ``fold`` shows whether the siblings lead it to the root.
    """
    claims = claims or {}
    # Each claim once under a name of its own; what several expressions read is not computed again.
    values = docs.select(
        F.col(group).cast("string").alias("group"), F.col(key).alias("key"), *[F.col(f).alias(f"f{i}") for i, f in enumerate(fields)],
        *[claims[f].alias(f"c{i}") for i, f in enumerate(fields) if f in claims],
    )
    own = [F.col(f"f{i}") for i in range(len(fields))]
    altered = [F.coalesce(f"c{i}", f"f{i}") if f in claims else own[i] for i, f in enumerate(fields)]
    claimed = F.lit(False)
    for i, f in enumerate(fields):
        claimed = claimed | F.col(f"c{i}").isNotNull() if f in claims else claimed
    # A text that is never null and orders like the group, null first.
    g = F.coalesce(F.concat(F.lit("="), F.col("group")), F.lit(""))
    leaves = values.select(g.alias("g"), "key", leaf(*own).alias("node"), F.when(claimed, leaf(*altered)).alias("claim"))
    leaves = stage(leaves, "merkle-digests")  # so that sorting samples digests, not texts
    tiers = _tiers(_placed(leaves, ["key", "node"], "merkle-leaves"), "merkle")
    roots = [t.filter((F.col("n") <= BLOCK) & (F.col("block") == 0)).select("g", "top") for t in tiers]
    groups = roots[0]
    for more in roots[1:]:
        groups = groups.unionByName(more)
    groups = stage(groups, "merkle-groups")
    nodes = groups.select(F.lit("").alias("g"), F.col("g").alias("group"), F.col("top").alias("node"))
    upper = _tiers(_placed(nodes, ["group"], "merkle-subroots"), "merkle-upper")
    root = upper[-1].select("g", F.lit(None).cast("string").alias("group_root"), F.col("top").alias("root"), F.array().cast(_SIBLINGS).alias("up"))
    above = _down(upper, root).select(F.col("x.group").alias("g"), F.col("x.node").alias("group_root"), "root", "up")
    return _down(tiers, above).select(
        F.col("x.key").alias(key), F.col("x.node").alias("leaf"), F.col("x.claim").alias("claim"),
        F.col("group_root").alias("subroot"), "root", F.col("up").alias("siblings"),
    )


def fold(node: Column, siblings: Column) -> Column:
    """The root that a leaf leads to by its siblings."""
    step = lambda at, s: F.sha2(F.concat(s["left"], at.cast("binary"), s["right"]), 256)
    return F.aggregate(siblings, node, step)


def proof(siblings: Column) -> Column:
    """All siblings from leaf to root, left to right, as one text."""
    return F.array_join(F.transform(siblings, lambda s: F.concat(s["left"], s["right"]).cast("string")), "")
