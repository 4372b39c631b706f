import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gustledger.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def brute_tree(nodes):
    """The root of a list of nodes, and for each the siblings (left, right) on its way up."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, at in enumerate(places):
            run = at // 16 * 16
            paths[k].append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + 16])))
        nodes = [sha("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
        places = [at // 16 for at in places]
    return nodes[0], paths


def brute(rows):
    """Sorted (doc_id, leaf, subroot, root, proof) of all rows."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append((r[0] is not None, r[0] or 0, brute_leaf(r), r[0]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: brute_tree([leaf for _, _, leaf, _ in sorted(groups[g])]) for g in names}
    root, above = brute_tree([trees[g][0] for g in names])
    out = []
    for g, up in zip(names, above, strict=True):
        for (_, _, leaf, doc_id), path in zip(sorted(groups[g]), trees[g][1], strict=True):
            out.append((doc_id, leaf, trees[g][0], root, "".join(a + b for a, b in path + up)))
    return sorted(out, key=repr)


def got(found):
    rows = found.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("siblings")).alias("proof")).collect()
    return sorted((tuple(r) for r in rows), key=repr)


def table(sizes, seed=1):
    rng = random.Random(seed)
    rows = []
    for source, n in sizes.items():
        for _ in range(n):
            text = "".join(rng.choices("abÄZ \n", k=rng.randint(0, 9)))
            rows.append((rng.randrange(10**6), source, rng.choice(["en", None]), rng.choice([3, None]), rng.choice([text, text, None])))
    rng.shuffle(rows)
    return rows


ODD = [(None, "a", None, None, None), (None, "a", None, None, None), (3, "a", "", 0, ""), (3, "a", "", 0, ""), (3, "a", "en", 1, "x" * 100_000), (1, None, None, None, None)]


@pytest.mark.parametrize("depth", [3, 2, 1])
def test_equals_brute_force(spark, monkeypatch, depth):
    """Sources of one node, of a last run of one, of three levels; with small blocks, several tiers."""
    monkeypatch.setattr(merkle, "DEPTH", depth)
    monkeypatch.setattr(merkle, "BLOCK", 16**depth)
    sizes = {"b": 1, "a": 16, "é": 17, None: 33, "Z": 257, "zz": 300, **{f"s{i:02d}": 2 for i in range(15)}}
    rows = table(sizes) + ODD
    found = merkle.manifest(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert got(found) == brute(rows)


def test_claims_fold_to_the_root_only_if_unchanged(spark):
    rows = table({"a": 40, None: 3}) + ODD
    claims = {"text": F.when(F.col("doc_id") % 2 == 0, F.upper("text")), "lang": F.when(F.col("doc_id") == 1, F.lit("xx"))}
    found = merkle.manifest(spark.createDataFrame(rows, SCHEMA), claims=claims)
    folded = found.select("*", merkle.fold(F.coalesce("claim", "leaf"), F.col("siblings")).alias("folded")).collect()
    changed = {brute_leaf(r) for r in rows if r[0] is not None and ((r[0] % 2 == 0 and r[4] is not None and r[4].upper() != r[4]) or (r[0] == 1 and r[2] != "xx"))}
    assert len(folded) == len(rows) and changed
    assert all((r["folded"] == r["root"]) == (r["leaf"] not in changed) for r in folded)


def test_one_row_no_rows_and_clashing_names(spark):
    row = (7, "only", "en", 4, "text")
    lone = merkle.manifest(spark.createDataFrame([row], SCHEMA)).collect()
    assert [(r["leaf"], r["subroot"], r["root"], r["siblings"]) for r in lone] == [(brute_leaf(row),) * 3 + ([],)]
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = table({"a": 30, "b": 2})
    df = spark.createDataFrame(rows, SCHEMA)
    wide = df.select("*", *[F.lit("x").alias(c) for c in ("g", "n", "place", "node", "claim", "root", "l0", "group", "key", "f0", "c4", "part", "at", "up")])
    assert got(merkle.manifest(wide)) == brute(rows)


def test_rows_that_agree_are_split(spark):
    """One row many times: places are still a permutation, and every copy has its own siblings."""
    rows = [(1, "s", "en", 1, "x")] * 700
    assert got(merkle.manifest(spark.createDataFrame(rows, SCHEMA).repartition(8))) == brute(rows)
