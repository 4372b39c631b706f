import random
import re

import pytest
from pyspark.sql import functions as F

from gustledger.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def brute_base(text):
    """(n_words, n_base, first, last, labels) of the base phrases."""
    words, places, labels = split(text), [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        hit = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        places += hit
        labels |= {label} if hit else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def brute_spans(text):
    """Found labels and the best share: every diagonal of every template, merged by their distance."""
    words, labels, best = split(text), set(), 0.0
    for want, label, _, exact in licenses.Templates().listed:
        k = licenses.SHORT if exact else licenses.LONG
        votes = {}
        for t in range(len(want) - k + 1):
            for p in range(len(words) - k + 1):
                if words[p : p + k] == want[t : t + k]:
                    votes.setdefault(p - t, []).append((p, t))
        runs = []
        for diagonal in sorted(votes):
            if runs and diagonal - runs[-1][0] <= (0 if exact else licenses.MERGE):
                runs[-1] = (diagonal, runs[-1][1] + votes[diagonal])
            else:
                runs.append((diagonal, votes[diagonal]))
        for _, found in runs:
            share = len({t + j for _, t in found for j in range(k)}) / len(want)
            best = max(best, share)
            span = max(p for p, _ in found) + k - min(p for p, _ in found)
            if (share == 1) if exact else (share >= licenses.SHARE and span <= len(want) / licenses.SHARE):
                labels.add(label)
    return ",".join(sorted(labels)), best


def noisy(notice, rng, drop=0, put=0):
    words = licenses.plain_words(notice)
    for _ in range(drop):
        words.pop(rng.randrange(len(words)))
    for _ in range(put):
        words.insert(rng.randrange(len(words)), "word")
    return " ".join(words)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(6)
    pool = ["MIT", "license", "License,", "apache", "general", "Public", "LICENSE", "gnu", "cc", "BY-NC", "4.0", "é", "the", "\n", "version 3"]
    out = [" ".join(rng.choices(pool, k=rng.randint(0, 40))) for _ in range(150)]
    for label, notice in licenses.NOTICES.items():
        out += [notice, f"before {label} {notice} after", noisy(notice, rng, 2, 1), noisy(notice, rng, 1, 30), f"{notice}\n{notice}", " ".join(notice.split()[: len(notice.split()) // 2])]
    # The Kelvin sign and a dotted capital are lower-cased into ASCII letters by most libraries, not here.
    out += ["mit license mit license", "MIT\x00LICENSE", "mit licenseé", "mit 9license", "apache Kicense", "MİT license", "mit ſense", "gnu general public license version 3"]
    out += ["x", "", None, " \n ", ("word " * 30_000) + "mit license " + ("word " * 30_000) + "apache license"]
    return out


def test_equals_brute_force(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in licenses.scan(df).collect()}
    assert sorted(found) == list(range(len(texts)))
    for i, t in enumerate(texts):
        r = found[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_base(t), t
        if len(t or "") < 10_000:
            labels, score = brute_spans(t)
            assert r["labels"] == labels and r["score"] == pytest.approx(score), t
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))


def test_words_put_in_and_left_out(spark):
    rng = random.Random(1)
    rows = [(i, f"some text {noisy(n, rng, 3, 3)} more text") for i, n in enumerate(licenses.NOTICES.values()) if len(n.split()) > 60]
    found = licenses.spans(spark.createDataFrame(rows, "doc_id long, text string")).filter("found").collect()
    shares = {(r["doc_id"], r["label"]): r["share"] for r in found}
    labels = list(licenses.NOTICES)
    assert rows and all(0.8 <= shares[i, labels[i]] < 1 for i, _ in rows)


def test_hashes_decide_nothing(spark, texts, monkeypatch):
    """With one hash for all k-grams every pair is compared, and the result is the same."""
    df = spark.createDataFrame(list(enumerate(texts[:40])), "doc_id long, text string")
    want = sorted(map(tuple, licenses.scan(df).collect()))
    monkeypatch.setattr(licenses, "_hash", lambda parts: F.lit(1).cast("bigint") + 0 * F.xxhash64(*parts))
    assert sorted(map(tuple, licenses.scan(df).collect())) == want


def test_beyond_the_broadcast_limit(spark, texts, monkeypatch):
    df = spark.createDataFrame(list(enumerate(texts[:60])), "doc_id long, text string")
    want = sorted(map(tuple, licenses.scan(df).collect()))
    monkeypatch.setattr(licenses.joins, "BROADCAST_ROWS", -1)
    assert sorted(map(tuple, licenses.scan(df).collect())) == want


def test_odd_rows_are_rows(spark):
    rows = [(None, "mit license", "x", 1), (None, "mit license", "x", 1), (5, None, "y", 2), (5, "apache license", "y", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, words string, row int")
    got = sorted(((r["doc_id"], r["n_base"], r["labels"], r["score"]) for r in licenses.scan(df).collect()), key=repr)
    assert got == sorted([(None, 1, "mit", 1.0), (None, 1, "mit", 1.0), (5, 0, "", 0.0), (5, 1, "apache", 1.0)], key=repr)
    assert licenses.scan(df.limit(0)).count() == 0


def test_templates_are_checked(spark):
    df = spark.createDataFrame([(1, "the Acme license, and acme LICENSE")], "doc_id long, text string")
    own = licenses.Templates({"acme license": "acme"}, {}, {})
    assert licenses.scan(df, own).first()["n_base"] == 2
    with pytest.raises(ValueError):
        licenses.Templates({"license": "one word"})
    with pytest.raises(ValueError):
        licenses.Templates(notices={"x": "é " * 9})
