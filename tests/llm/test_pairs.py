import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gustledger.llm import neardup, ngramjoin, similarity, vafile
from gustledger.llm.components import components


def closed(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1100)] + [(2000, i) for i in range(2001, 2100)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = closed({x for e in edges for x in e}, edges)
    assert got == {i: c for i, c in want.items() if i in got}
    assert set(got) == {x for e in edges if e[0] != e[1] for x in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- n-gram join --------------------------------------------------------------------------------

def shingles(text, words):
    w = (text or "").translate({c: c + 32 for c in range(65, 91)}).split()
    return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def brute_join(rows, words, percent):
    sets = [(i, shingles(t, words)) for i, t in rows]
    links = [
        (a, b) for x, (a, s) in enumerate(sets) for b, u in sets[:x]
        if a is not None and b is not None and s and u and 100 * len(s & u) >= percent * len(s | u)
    ]
    found = closed({i for i, _ in sets if i is not None}, links)
    return sorted(((i, len(s), found.get(i)) for i, s in sets), key=repr)


@pytest.fixture(scope="module")
def near_texts():
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(3000)]
    rows, n = [], 0
    for size, copies, edits in [(3, 4, 1), (5, 6, 1), (9, 8, 1), (14, 10, 1), (30, 20, 2), (60, 25, 4), (120, 60, 6), (400, 25, 20), (900, 12, 40)]:
        for _ in range(3):
            base = rng.choices(vocabulary, k=size)
            for _ in range(copies):
                t = list(base)
                for _ in range(rng.randint(0, edits)):
                    t[rng.randrange(len(t))] = rng.choice(vocabulary)
                if rng.random() < 0.3:
                    t = t[rng.randint(0, max(1, size // 10)) :]
                rows.append((n, " ".join(t)))
                n += 1
    passage = " ".join(rng.choices(vocabulary, k=30))
    rows += [(n + i, passage + " " + " ".join(rng.choices(vocabulary, k=rng.randint(0, 40)))) for i in range(60)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("words", "percent"), [(4, 85), (5, 80), (2, 60)])
def test_join_equals_brute_force(spark, near_texts, words, percent, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK", 8)
    df = spark.createDataFrame(near_texts, "doc_id long, text string")
    got = sorted(map(tuple, ngramjoin.jaccard_components(df, words, percent).collect()), key=repr)
    assert got == brute_join(near_texts, words, percent)


def test_join_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n "), (None, "a b c d e"), (None, "a b c d e"), (9, "A b  c d e"), (5, "a b c d e"), (5, "a b c d e"),
            (7, "one"), (8, "ONE"), (6, "two words"), (10, "É b c d"), (11, "é b c d"), (12, "x " * 30_000), (4, "x " * 50)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_shingles int")
    got = sorted(map(tuple, ngramjoin.jaccard_components(df).collect()), key=repr)
    assert got == brute_join(rows, 4, 85)
    kept = ngramjoin.keep_representatives(df, 4, 85)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([1, 2, 3, None, None, 5, 5, 7, 6, 10, 11, 4], key=repr)
    assert ngramjoin.jaccard_components(df.limit(0)).count() == 0


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(3)
    bands = ngramjoin.Bands(85)
    for _ in range(400):
        n = int(rng.integers(1, 500))
        a = rng.integers(0, 2**64, n, dtype=np.uint64)
        drop, add = 0, 0
        while 100 * (n - drop) >= 85 * (n + add):
            if rng.random() < 0.5 and 100 * (n - drop - 1) >= 85 * (n + add):
                drop += 1
            elif 100 * (n - drop) >= 85 * (n + add + 1):
                add += 1
            else:
                break
        b = np.r_[rng.permutation(a)[: n - drop], rng.integers(0, 2**64, add, dtype=np.uint64)]
        sides = [set(bands.signatures(np.sort(s), np.array([len(s)]))[0].tolist()) for s in (a, b)]
        assert sides[0] & sides[1], (n, drop, add)


def test_intersections_of_blocks():
    rng = np.random.default_rng(1)
    x, y = ([np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(n)] for n in (40, 30))
    flat = lambda s: (np.concatenate(s), np.repeat(np.arange(len(s)), [len(v) for v in s]))
    got = ngramjoin._intersections(*flat(x), *flat(y), 40, 30)
    assert (got == [[len(np.intersect1d(a, b)) for b in y] for a in x]).all()


# --- vectors ------------------------------------------------------------------------------------

def brute_vectors(rows, least):
    fit = {}
    for n, (i, v, lab) in enumerate(rows):
        if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            fit[n] = np.array(v, float)
    links, count = [], defaultdict(int)
    for a in fit:
        for b in fit:
            if a < b and rows[a][2] == rows[b][2] and len(fit[a]) == len(fit[b]):
                if fit[a] @ fit[b] / np.sqrt((fit[a] @ fit[a]) * (fit[b] @ fit[b])) >= least:
                    links.append((rows[a][0], rows[b][0]))
                    count[a] += 1
                    count[b] += 1
    found = closed({i for i, _, _ in rows if i is not None}, links)
    return sorted(((i, count[n], found.get(i), i is not None and found[i] == i) for n, (i, _, _) in enumerate(rows)), key=repr)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    rows = []
    for label in (0, 1, 2):
        for group in (1, 1, 1, 1, 2, 3, 40, 90):
            base = rng.standard_normal(64)
            rows += [(len(rows) + j, (base + 0.012 * rng.standard_normal(64) * (1 + j % 6)).tolist(), label) for j in range(group)]
        rows += [(len(rows) + j, rng.standard_normal(64).tolist(), label) for j in range(60)]
    return [(i, [float(np.float32(x)) for x in v], lab) for i, v, lab in rows]


SCHEMA = "vec_id long, embedding array<double>, label int"


def test_near_links_find_the_pairs(spark, vectors, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK", 16)
    got = neardup.near_links(spark.createDataFrame(vectors, SCHEMA)).collect()
    want = {r[0]: r for r in brute_vectors(vectors, 0.98)}
    n_got, n_want = sum(r["n_links"] for r in got), sum(r[1] for r in want.values())
    assert 0.97 * n_want <= n_got <= n_want
    assert all(r["n_links"] <= want[r["vec_id"]][1] for r in got)
    assert sum(r["component_id"] == want[r["vec_id"]][2] for r in got) >= 0.97 * len(got)


def test_a_large_bucket_makes_no_row_for_each_pair(spark, monkeypatch):
    """Close codes, but hardly any cosine of 0.98, so that there are no clusters."""
    monkeypatch.setattr(neardup, "SMALL", 8, raising=False)
    monkeypatch.setattr(neardup, "PAIR_BITS", 30)
    monkeypatch.setattr(similarity, "BLOCK", 64)
    rng = np.random.default_rng(12)
    base = rng.standard_normal(64)
    rows = [(i, (base + 0.6 * rng.standard_normal(64)).tolist(), 0) for i in range(240)]
    rows += [(1000 + i, (np.array(rows[7 * i][1]) + 0.05 * rng.standard_normal(64)).tolist(), 0) for i in range(30)]
    rows += [(2000 + i, rng.standard_normal(64).tolist(), 1) for i in range(400)]
    tried, check = [], neardup.verified
    monkeypatch.setattr(neardup, "verified", lambda pairs, *more: tried.append(pairs.count()) or check(pairs, *more))
    got = {r["vec_id"]: r for r in neardup.near_links(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = {r[0]: r for r in brute_vectors(rows, 0.98)}
    assert sum(r[1] for r in want.values()) >= 50
    assert sum(r["n_links"] for r in got.values()) >= 0.97 * sum(r[1] for r in want.values())
    assert all(r["n_links"] <= want[i][1] for i, r in got.items())
    assert tried[-1] < 270 * 269 / 2, tried  # the pairs of the first label alone


def test_near_links_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [nan, 1.0], 0), (6, [inf, 1.0], 0), (7, [1.0, 2.0], None),
            (None, [1.0, 2.0], 0), (8, [1.0, 2.0], 0), (9, [2.0, 4.0], 0), (9, [2.0, 4.0], 0), (10, [1.0, 2.0], 1), (11, [1.0, 2.0, 0.0], 0),
            (12, [1e200, 2e200], 0), (13, [-1.0, -2.0], 0), (14, [3e-200, 6e-200], 0)]
    df = spark.createDataFrame([(i, v, lab, "x") for i, v, lab in rows], SCHEMA + ", kept string")
    got = {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in neardup.near_links(df).collect()}
    assert (8, 4, 8, True) in got and (9, 4, 8, False) in got and (12, 4, 8, False) in got and (14, 4, 8, False) in got
    alone = {(i, 0, i, i is not None) for i in (1, 2, 3, 4, 5, 6, 7, None, 10, 11, 13)}
    assert alone <= got and len(got) == 15
    assert neardup.near_links(df.limit(0)).count() == 0


def brute_top(rows, k):
    """Every row against every other, rows of one id too."""
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v, *_ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (q, v) in enumerate(whole):
        if q % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for j, (i, w) in enumerate(whole) if j != at and len(w) == len(v))
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_top_k_keeps_rows_that_share_an_id(spark):
    rows = [(100, [1.0, 0.0], 0), (100, [0.0, 1.0], 0), (1, [1.0, 1.0], 0), (1, [2.0, 0.0], 0), (100, [1.0, 0.0], 0)]
    got = sorted(map(tuple, vafile.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0).collect()))
    assert got == brute_top(rows, 10) and len(got) == 3 * 4


@pytest.mark.parametrize("block", [4096, 7])
def test_top_k_equals_brute_force(spark, vectors, monkeypatch, block):
    monkeypatch.setattr(vafile, "BLOCK_ROWS", block)
    monkeypatch.setattr(vafile, "QUERY_ROWS", 2)
    odd = [(1000, None, 0), (1001, [1.0], 0), (1100, [2.0], 0), (1200, [3.0], 1), (1300, [float("nan")] * 64, 0), (1400, [None] * 64, 0), (None, [1.0] * 64, 0),
           (1500, [], 0), (1600, [], 0), (0, vectors[5][1], 0), (7, vectors[7][1], 0), (1700, [1e6] * 64, 0)]
    rows = vectors + odd + [(5000 + i, vectors[3][1], 2) for i in range(14)]
    got = sorted(map(tuple, vafile.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0).collect()))
    assert got == brute_top(rows, 10)


def test_top_k_of_an_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, rank int")
    got = vafile.top_k(df, F.col("vec_id") % 100 == 0)
    assert got.count() == 0 and got.columns == ["query_id", "rank", "vec_id", "score"]


def test_representatives_keep_columns_of_any_name(spark):
    text = "one two three four five six seven eight"
    df = spark.createDataFrame([(1, text, "a", "b"), (2, text, "c", "d")], "doc_id long, text string, gone string, __gone string")
    assert [tuple(r) for r in ngramjoin.keep_representatives(df).collect()] == [(1, text, "a", "b")]


def test_sketches_bound_distances_from_below():
    """Of short and of long sets."""
    rng = np.random.default_rng(7)
    pool = np.unique(rng.integers(0, 1 << 63, 90_000, dtype=np.uint64))
    sets = [np.sort(rng.choice(pool, n, replace=False)) for n in (1, 40, 150, 60_000, 70_000)]
    sets += [np.sort(np.r_[s[: len(s) * 9 // 10], rng.integers(0, 1 << 63, 3, dtype=np.uint64)]) for s in sets]
    sketches = [x.tobytes() for x in ngramjoin._sketches(np.concatenate(sets), np.array([len(s) for s in sets]))]
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            both = len(np.intersect1d(x, y))
            distance = 1 - both / (len(x) + len(y) - both)
            assert ngramjoin.at_least([sketches[i]], [sketches[j]])[0] <= distance + 1e-9
            assert ngramjoin.may_link(distance)([sketches[i]], [sketches[j]])[0, 0]


@pytest.mark.parametrize("n", [30, 550, 1000, 6000, 40_000])
def test_sketches_tell_unrelated_sets_apart(n):
    """Of any size: their bound is beyond three radii, so their contents are not fetched."""
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for _ in range(2)]
    x, y = (s.tobytes() for s in ngramjoin._sketches(np.concatenate(sets), np.array([len(s) for s in sets])))
    assert ngramjoin.at_least([x], [y])[0] > 3 * 0.2
    assert not ngramjoin.may_link(0.2)([x], [y])[0, 0]


@pytest.mark.parametrize("n", [30, 64, 550, 1000, 6000, 40_000])
def test_coarse_sketches_are_smaller_and_rule_out_no_link(n):
    """What moves to every group is a quarter of a sketch; unrelated sets don't pass, similar ones always do."""
    rng = np.random.default_rng(4)
    x, y = (np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for _ in range(2))
    near = np.sort(np.r_[x[: len(x) * 9 // 10], rng.integers(0, 1 << 63, 2, dtype=np.uint64)])
    sets = [x, y, near]
    fine = ngramjoin._sketches(np.concatenate(sets), np.array([len(s) for s in sets]))
    coarse = [ngramjoin._coarse(s) for s in fine]
    assert all(len(c) - 1 == (len(f) - 1) // 4 and c[0] == f[0] for c, f in zip(coarse, fine, strict=True))
    distance = 1 - len(np.intersect1d(x, near)) / len(np.union1d(x, near))
    passed = ngramjoin.may_link(max(0.2, distance))([c.tobytes() for c in coarse[:1]], [c.tobytes() for c in coarse])
    assert passed.tolist() == [[True, False, True]]


def test_links_at_every_distance_from_a_pivot(spark):
    """Chains of sets whose neighbours link, so that members lie on both sides of the balls around their pivot."""
    rng = random.Random(5)
    data, doc = [], 0
    for chain in range(12):
        words = [f"c{chain}w{i}" for i in range(120)]
        for _ in range(14):
            data.append((doc, " ".join(words)))
            doc += 1
            at = rng.randrange(0, 100)
            words = words[:at] + [f"n{doc}x{i}" for i in range(rng.choice([1, 6, 14]))] + words[at + rng.choice([1, 6, 14]) :]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    for words, percent in ((4, 85), (5, 80)):
        got = {r.doc_id: r.component_id for r in ngramjoin.jaccard_components(df, words, percent).collect()}
        sets = {d: shingles(t, words) for d, t in data}
        links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
        assert got == closed(sets, links)
        assert len(set(got.values())) < len(got)


@pytest.mark.parametrize("percent", [60, 80, 85])
def test_least_similar_sets_share_a_kept_signature(percent):
    """Of all sizes, also where a set leaves several of its signatures out."""
    rng = np.random.default_rng(11)
    bands = ngramjoin.Bands(percent)
    for n in np.r_[np.arange(1, 60), rng.integers(60, 3000, 120)].tolist():
        a = rng.integers(0, 2**64, n, dtype=np.uint64)
        gone = n * (100 - percent) // (100 + percent)  # as many shingles go as come: 100 (n - gone) >= percent (n + gone)
        b = np.r_[rng.permutation(a)[: n - gone], rng.integers(0, 2**64, gone, dtype=np.uint64)]
        c = rng.permutation(a)[: -(-n * percent // 100)]
        own, *others = (set(bands.signatures(np.sort(s), np.array([len(s)]))[0].tolist()) for s in (a, b, c))
        assert all(own & other for other in others), n


def test_unrelated_sets_share_no_signature():
    """Not even by partitions without a shingle, which nearly all sets of some size have."""
    rng = np.random.default_rng(13)
    sizes = rng.integers(400, 440, 500)
    hashes = np.concatenate([np.sort(rng.integers(0, 2**64, n, dtype=np.uint64)) for n in sizes])
    keys, owners = ngramjoin.Bands(80).signatures(hashes, sizes)
    rows = np.unique(np.stack([keys, owners], 1), axis=0)
    n = np.unique(rows[:, 0], return_counts=True)[1]
    assert n[n > 1].sum() < len(sizes) / 100
