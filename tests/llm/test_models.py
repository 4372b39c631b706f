import math
import random
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest

from gustledger import session
from gustledger.llm import blocks, common, kneser, maxent

SCHEMA = "doc_id long, text string, n_tokens string"


@pytest.fixture(scope="module")
def texts():
    """Two kinds of text with words of their own, so that what stands before tells a lot."""
    rng = random.Random(6)
    kinds = [[f"{c}{k}{e}" for k in range(60)] for c, e in (("ka", "on"), ("zu", "ik"))]
    rows = []
    for i in range(600):
        words = rng.choice(kinds)
        rows.append((i, " ".join(words[min(59, int(rng.expovariate(0.15)))] for _ in range(rng.randint(5, 60))) + f" rare{i}"))
    return rows + [(600, None), (601, ""), (602, "KA1ON ka1on\tka1on\x0bnever"), (5, "ka1on"), (None, "ka2on"), (603, "ka1on " * 20_000)]


def brute_base(rows):
    split = {n: (zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0, (t or "").translate({c: c + 32 for c in range(65, 91)}).split()) for n, (i, t) in enumerate(rows)}
    counts = Counter()
    for held, words in split.values():
        if not held:
            counts.update([*words, None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for k, (i, _) in enumerate(rows):
        held, words = split[k]
        own = [*words, None]
        out.append((i, held, len(own), sum(counts[w] > 0 for w in own), n, sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)))
    return sorted(out, key=lambda r: (r[0] is None, r[0], r[2]))


@pytest.fixture(scope="module")
def scored(spark, texts):
    small = 4096
    old, blocks.BLOCK_BYTES = blocks.BLOCK_BYTES, small
    df = spark.createDataFrame([(i, t, "x") for i, t in texts], SCHEMA).repartition(3)
    rows = maxent.score(df).collect()
    blocks.BLOCK_BYTES = old
    return sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"], r["n_tokens"]))


def test_counts_and_base_score(scored, texts):
    want = brute_base(texts)
    assert [tuple(r)[:5] for r in scored] == [w[:5] for w in want]
    assert [r["base_score"] for r in scored] == pytest.approx([w[5] for w in want])


def test_model_beats_the_base_on_held_out_texts(scored):
    held = [r for r in scored if r["held_out"] and r["n_tokens"] < 1000]
    assert sum(r["score"] for r in held) > 0.93 * sum(r["base_score"] for r in held)
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in scored)


def test_probabilities_add_up():
    rng = np.random.default_rng(2)
    classes, places = maxent._classes(rng.random((maxent.CODES, maxent.CONTEXTS)), rng.random(maxent.CODES))
    assert (np.bincount(classes[: maxent.START]) == [32] * 8 + [128] * 8).all()
    n = 2 * maxent.CLASSES
    model = maxent.Model(classes, places, rng.random(n).astype("f4"), rng.random((8, 32)).astype("f4"), np.zeros(n),
                         rng.random((maxent.ROWS, n)).astype("f4"), rng.random((maxent.INNER, 32)).astype("f4"))
    every = np.r_[np.arange(maxent.HEAD), [np.flatnonzero(classes == c)[0] for c in range(8, 16)]]
    logs = maxent.probabilities(model, every, np.full(len(every), 9), np.full(len(every), 700))
    assert (10.0**logs).sum() == pytest.approx(1, abs=1e-4)


def test_steps_raise_the_likelihood():
    rng = np.random.default_rng(3)
    codes = rng.choice(40, 4000) * 13 % maxent.HEAD
    classes, places = maxent._classes(rng.random((maxent.CODES, maxent.CONTEXTS)), np.ones(maxent.CODES))
    n = 2 * maxent.CLASSES
    model = maxent.Model(classes, places, np.zeros(n, "f4"), np.zeros((8, 32), "f4"), np.zeros(n), np.zeros((maxent.ROWS, n), "f4"), np.zeros((maxent.INNER, 32), "f4"))
    one, two = maxent._context(codes, np.array([4000]))
    first = maxent.probabilities(model, codes, one, two).sum()
    for _ in range(5):
        maxent.probabilities(model, codes, one, two, learn=True)
    assert maxent.probabilities(model, codes, one, two).sum() > 0.9 * first


def test_context_picks_rare_words(spark):
    """Words beyond the frequent ones share endings, yet each has one word that follows it, also in held-out texts."""
    rng = random.Random(4)
    pairs = [(f"l{k}xon", f"r{(k * 7) % 900}yik") for k in range(900)]
    rows = [(i, " ".join(w for _ in range(20) for w in rng.choice(pairs)), None) for i in range(600)]
    got = {r["doc_id"]: r for r in maxent.score(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > 0.7 * sum(r["base_score"] for r in held)


def test_shards_sum_and_give_every_key_one_owner():
    rng, bits = np.random.default_rng(8), 3
    asked = []
    for block in range(4):
        keys, inverse = np.unique(maxent.mix64(rng.integers(0, 500, 300).astype(np.uint64)) >> np.uint64(8), return_inverse=True)
        asked.append((keys, np.bincount(inverse, rng.integers(0, 2, 300), len(keys))))
    cells = pa.Table.from_batches([maxent._cells(b, 0, 0, keys, n, n * 2, bits) for b, (keys, n) in enumerate(asked)])
    shards = [cells.filter(pa.compute.equal(cells.column("shard"), s)) for s in range(1 << bits)]
    found = pa.concat_tables([maxent._totals((), s) for s in shards if s.num_rows])
    want, owned = Counter(), Counter()
    for keys, n in asked:
        want.update(dict(zip(keys.tolist(), n.tolist(), strict=True)))
    for b, (keys, _) in enumerate(asked):
        n, t, own = maxent._sums_of(found.filter(pa.compute.equal(found.column("of_block"), b)), 0, 0, keys, bits)
        assert n.tolist() == [want[k] for k in keys.tolist()] and (t == 2 * n).all()
        owned.update(dict(zip(keys.tolist(), own.tolist(), strict=True)))
    assert all(owned[k] == (n > 0) for k, n in want.items())


def test_counted_features_add_up():
    rng = np.random.default_rng(5)
    n = np.r_[3.0, 1.0, 0.0, 0.0]
    p = rng.dirichlet(np.ones(4))
    assert maxent.interpolated(p, n, np.full(4, 4.0), np.full(4, 2.0), 0.6).sum() == pytest.approx(1)
    assert (maxent.interpolated(p, np.zeros(4), np.zeros(4), np.zeros(4), 0.6) == p).all()


def test_scores_stage_rows_by_block_and_leave_no_shuffles(spark):
    """What lies on disk is packed by block: no row for each word of a block, and no shuffles of steps that are done."""
    rng = random.Random(11)
    df = spark.createDataFrame([(i, " ".join(f"w{rng.randrange(30_000)}" for _ in range(400)), None) for i in range(100)], SCHEMA).repartition(2)
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before, files = len(session._staged), disk.getAllBlocks().mkString(" ").count("shuffle_")
    scores = maxent.score(df)
    assert disk.getAllBlocks().mkString(" ").count("shuffle_") <= files
    staged = [spark.read.parquet(p).count() for p in session._staged[before:]]
    assert sum(staged) < 10_000 < len({w for r in df.collect() for w in r["text"].split()})
    assert scores.count() == 100
    assert spark.conf.get(common.SHUFFLE_CLEANUP) == "false"


def test_word_counts_by_shard():
    rng, bits = random.Random(12), 2
    blocks_of = [{f"{rng.choice('aé€')}{rng.randrange(400)}": rng.randrange(3) for _ in range(300)} for _ in range(3)] + [{"": 0}]
    pack = lambda words: blocks.pack(pa.table({"word": pa.array([w.encode() for w in words], pa.binary()), "n": pa.array(list(words.values()), pa.int64())}))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(blocks_of)), pa.int64()), pa.array([pack(w) for w in blocks_of])], ["block", "vocab"])
    cells = pa.Table.from_batches(list(maxent._asked_words(bits)([batch])))
    shards = [cells.filter(pa.compute.equal(cells.column("shard"), s)) for s in range(1 << bits)]
    found = pa.concat_tables([maxent._word_totals((pa.scalar(i, pa.int32()),), s) for i, s in enumerate(shards) if s.num_rows])
    want = Counter()
    for words in blocks_of:
        want.update(words)
    for b, words in enumerate(blocks_of):
        own = found.filter(pa.compute.equal(found.column("of_block"), b))
        own = own.append_column("level", pa.array([maxent.WORDS] * own.num_rows, pa.int32()))
        assert maxent._word_counts(own, pa.array([w.encode() for w in words], pa.binary()), bits).tolist() == [want[w] for w in words]
    rows = found.to_pylist()
    assert sum(r["v"] for r in rows if r["v"]) == sum(n > 0 for n in want.values())
    assert sum(r["c"] for r in rows if r["v"]) == sum(want.values())
    assert {r["word"].decode(): r["c"] for r in rows if r["word"] is not None}.items() <= want.items()
    crc = lambda w: maxent.HEAD + zlib.crc32(w[-2:].encode()) % maxent.ENDINGS
    assert all(r["code"] == crc(r["word"].decode()) for r in rows if r["word"] is not None)


@pytest.mark.parametrize("values", [[], [0, 0], [0, 255, 3], [256, 1], [2**56 - 1, 0, 7], [2**64 - 1]])
def test_squeezed_numbers_come_back(values):
    assert maxent._loose(maxent._squeezed(np.array(values, np.uint64)), len(values)).tolist() == values


def test_scores_of_an_empty_table_and_without_training(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert maxent.score(df).count() == 0
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    r = maxent.score(spark.createDataFrame([(only, "a b", None)], SCHEMA)).first()
    assert (r["n_known"], r["train_tokens"], r["n_tokens"]) == (0, 0, 3) and math.isfinite(r["score"])


# --- Kneser-Ney ---------------------------------------------------------------------------------

def brute_perplexity(trusted, text, order=5):
    tables = [Counter() for _ in range(order + 1)]
    for t in trusted:
        for w in (t or "").split():
            tables[order].update(kneser._grams(w))
    for m in range(order - 1, 0, -1):
        tables[m] = Counter(g[1:] for g in tables[m + 1])
    discounts, contexts = [None], [None]
    for m in range(1, order + 1):
        c = Counter(tables[m].values())
        y = c[1] / (c[1] + 2 * c[2]) if c[1] else 0.5
        d = [max(0.0, min(i, i - (i + 1) * y * c[i + 1] / c[i])) if c[i] and c[i + 1] else min(0.5 * i, 0.9) for i in (1, 2, 3)]
        discounts.append(d)
        own = defaultdict(lambda: [0, 0.0])
        for g, n in tables[m].items():
            own[g[:-1]][0] += n
            own[g[:-1]][1] += d[min(n, 3) - 1]
        contexts.append(own)

    def p(g):
        if not g:
            return 1 / (len(tables[1]) + 1)
        m, n = len(g), tables[len(g)][g]
        if g[:-1] not in contexts[m]:
            return p(g[1:])
        total, off = contexts[m][g[:-1]]
        return (n - discounts[m][min(n, 3) - 1] if n else 0) / total + off / total * p(g[1:])

    grams = [g for w in (text or "").split() for g in kneser._grams(w)]
    return math.exp(-sum(math.log(max(p(g), 1e-30)) for g in grams) / len(grams)) if grams else None


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(9)
    syllables = "ka lo mi ra te nu so li ba re po ti ku é".split()
    clean = lambda: " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(5, 30)))
    rows = [(i, clean(), "xx" if i % 3 else None) for i in range(150)]
    junk = [(1000 + i, clean().upper().replace(" ", "!! | "), "xx") for i in range(12)]
    return rows, junk, [(2000, None, "xx"), (2001, "  ", None), (2002, "zz", "yy"), (2003, "kalo " * 20_000, "xx"), (3, "kalo", "xx"), (None, "kalo mira", "xx")]


@pytest.mark.parametrize("max_sent", [1 << 20, 0])
def test_perplexity_equals_brute_force(spark, corpus, max_sent):
    clean, junk, odd = corpus
    docs = spark.createDataFrame([r for part in corpus for r in part], "row_id long, text string, lang string")
    trusted = [t for _, t, _ in clean[:60]]
    got = kneser.perplexities(docs, spark.createDataFrame([(t,) for t in trusted], "text string"), max_sent)
    want = sorted(((i, brute_perplexity(trusted, t)) for part in corpus for i, t, _ in part), key=repr)
    got = sorted(((r["row_id"], r["perplexity"]) for r in got.collect()), key=repr)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert [g[1] for g in got] == [w[1] if w[1] is None else pytest.approx(w[1], rel=1e-6) for w in want]


def test_quality_keeps_clean_texts(spark, corpus):
    clean, junk, odd = corpus
    docs = spark.createDataFrame([(*r, 1) for part in corpus for r in part], "doc_id long, text string, lang string, kept int")
    labels = spark.createDataFrame([(i, 1) for i, _, _ in clean] + [(i, 0) for i, _, _ in junk] + [(3, 0), (None, 1)], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in kneser.quality(docs, labels).collect()}
    assert sum(got[i]["kept"] for i, _, _ in clean) >= 0.93 * len(clean)
    assert not any(got[i]["kept"] for i, _, _ in junk)
    assert not got[2000]["kept"] and got[2001]["perplexity"] is None and got[2002]["kept"]
    assert kneser.quality(docs.limit(0), labels).count() == 0
    assert kneser.quality(docs, labels.limit(0)).count() == docs.count()


def test_quality_counts_trusted_documents_however_many_there_are(spark, corpus):
    """Labels of 60,000 documents that are not there change nothing: no bound makes the counted share smaller."""
    docs = spark.createDataFrame([r for part in corpus for r in part], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i, _, _ in corpus[0]], "doc_id long, quality int")
    others = spark.range(100_000, 160_000).selectExpr("id AS doc_id", "1 AS quality")
    few, many = (sorted(map(tuple, kneser.quality(docs, x).collect()), key=repr) for x in (labels, labels.unionByName(others)))
    for a, b in zip(few, many, strict=True):
        assert a[:2] == b[:2] and a[4] == b[4]
        assert [v if v is None else pytest.approx(v, rel=1e-9) for v in a[2:4]] == list(b[2:4])


WIDE = [chr(c) for c in range(0x4E00, 0x4E00 + 6000)]  # too many characters for numbers of 64 bits


@pytest.mark.parametrize("alphabet", ["abcdeÄß語😀\x02\x03", WIDE])
def test_quality_makes_no_string_for_each_n_gram(monkeypatch, alphabet):
    """What the tasks count, need and score is as with a string for each n-gram, which only wide alphabets take."""
    rng = random.Random(5)
    words = lambda n: ["".join(rng.choices(alphabet, k=rng.randint(1, 9))) for _ in range(n)]
    texts = ["", " \n", "".join(alphabet)] + [rng.choice([" ", "\t\n", "\x0b"]).join(words(rng.choice([1, 3, 40]))) for _ in range(100)]
    own = [[g for w in t.encode().split() for g in kneser._grams(w.decode())] for t in texts]
    want = Counter(g for grams in own for g in grams)
    log = {g: -rng.random() for g in want}
    if alphabet is not WIDE:
        monkeypatch.setattr(kneser, "_grams", lambda word: pytest.fail("a string for each n-gram"))
    monkeypatch.setattr(kneser, "FLUSH", 50)
    monkeypatch.setattr(kneser, "SOME", 16, raising=False)
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[i : i + 20])], ["t"]) for i in range(0, len(texts), 20)]
    got = Counter()
    for part in kneser._word_counts(iter(batches)):
        for g, n in zip(*(c.to_pylist() for c in part.columns), strict=True):
            got[g] += n
    assert got == want
    assert {g for part in kneser._needed(iter(batches)) for g in part.column(0).to_pylist()} == set(want)
    sent = SimpleNamespace(value=(pa.array(list(log)), pa.array(list(log.values()))))
    scored = [r for part in kneser._scores(sent)(b.column(0) for b in batches) for r in part.to_pylist()]
    assert [r["n"] for r in scored] == [len(grams) for grams in own]
    assert [r["logs"] for r in scored] == [pytest.approx(sum(log[g] for g in grams), rel=1e-12) for grams in own]
