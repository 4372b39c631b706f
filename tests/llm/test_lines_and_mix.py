import random
from collections import defaultdict

import numpy as np
import pytest

from gustledger.llm import linededup, mixing

LINE = "this line is long enough to count as one of many "


def brute_lines(rows, least=40, docs=5):
    where = defaultdict(set)
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    for i, t in rows:
        if i is not None:
            for x in (t or "").split("\n"):
                if len(key(x)) >= least:
                    where[key(x)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if i is None or len(where[key(x)]) < docs or max(where[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


@pytest.fixture
def lines():
    rng = random.Random(4)
    pool = [LINE + str(k) for k in range(12)] + ["É" * 39, "É" * 40, "short", "", "  " + LINE.upper() + "3\t"]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(1, 8)))) for i in range(60)]
    return rows + [(None, LINE + "1"), (7, LINE + "1\n" + LINE + "1"), (8, None), (9, ""), (9, ""), (70, " " + LINE + "1"), (71, ("x" * 300 + "\n") * 4000)]


@pytest.mark.parametrize("shard", [1 << 14, 2])
def test_lines_equal_brute_force(spark, lines, monkeypatch, shard):
    monkeypatch.setattr(linededup, "SHARD_KEYS", shard)
    monkeypatch.setattr(linededup, "SHARD_PROBES", 2 * shard)
    df = spark.createDataFrame(lines, "doc_id long, text string")
    got = linededup.dedup_lines(df, counts=True).collect()
    assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"] or "") for r in got), key=repr) == brute_lines(lines)


def test_lines_keep_other_columns(spark, lines):
    df = spark.createDataFrame([(t, str(i), i, [1]) for i, t in lines], "text string, n_lines string, doc_id long, c0 array<int>")
    got = linededup.dedup_lines(df)
    assert got.schema.simpleString() == df.schema.simpleString() and got.count() == len(lines)
    assert {r["n_lines"] for r in got.collect()} == {str(i) for i, _ in lines}
    assert linededup.dedup_lines(df.limit(0), counts=True).count() == 0


def test_perfect_hash_gives_every_key_its_own_place():
    keys = np.unique(np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 20_000))
    assert sorted(linededup.PerfectHash.build(keys).places(keys)) == list(range(len(keys)))
    assert len(linededup.PerfectHash.build(keys[:0]).places(keys[:3])) == 3


def test_lines_that_share_half_a_digest(spark, lines, monkeypatch):
    """The fingerprints still tell them apart."""
    import pyarrow as pa

    h1, h2 = np.array([5, 5, 5, 9, -3]), np.array([3, 1, 2, 7, 7])
    index = linededup._build((pa.scalar(0),), pa.table({"h1": h1, "h2": h2, "n_docs": [5, 5, 1, 9, 2], "last_doc": [10, 20, 30, 40, 50]}))
    probes = pa.table({"h1": np.r_[h1, h1], "h2": np.r_[h2, h2], "doc_id": [10, 20, 30, 40, 50, 1, 1, 1, 1, 1]})
    got = linededup._probe(5)((pa.scalar(0), pa.scalar(0)), probes, index).to_pydict()
    assert sorted(zip(got["doc_id"], got["h1"], got["h2"], strict=True)) == [(1, 5, 1), (1, 5, 3), (1, 9, 7)]


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, limit=2.0):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in full]
        if not rest:
            break
        level = (total - sum(limit * sizes[s] for s in full)) / sum(w[s] for s in rest)
        over = {s for s in rest if level * w[s] > limit * sizes[s]}
        if not over:
            break
        full |= over
    return {s: limit * sizes[s] if s in full else level * w[s] for s in names}


def test_mix_targets_and_copies(spark):
    rng = random.Random(2)
    names = ["b", "a", "Z", "é", "big", None, "none"]
    rows = [(i, " ".join("w" * rng.randint(1, 40)) if s != "none" else None, s, "x") for i in range(3000) for s in [rng.choices(names, [1, 2, 1, 1, 6, 1, 1])[0]]]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    sizes = defaultdict(int)
    for _, t, s, _ in rows:
        sizes[s] += len((t or "").split())
    want = brute_targets(sizes)
    got = mixing.plan(df).collect()
    taken = defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["copies"] in (0, 1, 2)
        taken[r["source"]] += r["size"] * r["copies"]
    for s in names:
        assert taken[s] == pytest.approx(want[s], rel=0.15)
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    again = {(r["doc_id"], r["copies"]) for r in mixing.plan(df.repartition(7)).collect()}
    assert again == {(r["doc_id"], r["copies"]) for r in got}
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns and mixed.filter("size <> 'x'").count() == 0
    assert mixed.count() == sum(r["copies"] for r in got)


def test_mix_without_words_or_rows(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", None), (None, " \n", "a")], "doc_id long, text string, source string")
    assert {(r["target"], r["copies"]) for r in mixing.plan(df).collect()} == {(0.0, 0)}
    assert mixing.plan(df.limit(0)).count() == 0 and mixing.mix(df).count() == 0


def test_mix_limits_every_document(spark):
    df = spark.createDataFrame([(i, "one two three", "only") for i in range(10)] * 2, "doc_id long, text string, source string")
    assert all(r["size"] * r["copies"] <= 2 * r["size"] for r in mixing.plan(df).collect())


def test_mix_of_rows_without_an_id(spark):
    """A third of the rows have no id, half of these the same text: their source still comes near its target."""
    rng = random.Random(8)
    rows = [(i, " ".join("w" * rng.randint(5, 15)), rng.choice("abc")) for i in range(2000)]
    rows += [(None, f"some words {i if i % 2 else ''}", "b") for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken, want = defaultdict(int), {}
    for r in mixing.plan(df).collect():
        taken[r["source"]] += r["size"] * r["copies"]
        want[r["source"]] = r["target"]
    for s, t in want.items():
        assert taken[s] == pytest.approx(t, rel=0.05)


def test_mix_keeps_columns_of_any_name(spark):
    names = ["mix_size", "mix_draw", "mix_goal", "mix_source", "mix_result", "mix_copy", "__size", "__mix", "__goal"]
    df = spark.createDataFrame([(i, "one two", "a", *[f"x{i}"] * len(names)) for i in range(20)], "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names))
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns and all(r[n] == f"x{r['doc_id']}" for r in mixed.collect() for n in names)
    assert mixing.plan(df).count() == 20


def test_counts_of_documents_are_wide(spark):
    """A line may be in more documents than a 32-bit number tells."""
    import pyarrow as pa

    index = linededup._build((pa.scalar(0),), pa.table({"h1": np.array([5]), "h2": np.array([3]), "n_docs": [2**31 + 7], "last_doc": [9]}))
    probes = pa.table({"h1": np.array([5]), "h2": np.array([3]), "doc_id": [1]})
    assert linededup._probe(5)((pa.scalar(0), pa.scalar(0)), probes, index).num_rows == 1
