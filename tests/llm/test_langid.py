import random

import numpy as np
import pytest

from gustledger.llm import langid

WORDS = {
    "aa": "kalo mira tenu solika banu rekami polo tiku".split(),
    "bb": "schrung pfach grint wolch strumpf knacht blitz zwerg".split(),
    "cc": "мирок делата словник зимуна рекит полянка вестум книгар".split(),
}


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(3)
    return [(i, " ".join(rng.choices(WORDS[k], k=rng.randint(3, 60))), k) for i in range(300) for k in [rng.choice(list(WORDS))]]


@pytest.fixture(scope="module")
def model(spark, labelled):
    return langid.learn(spark.createDataFrame(labelled + [(900, None, "aa"), (901, "kalo", None)], "doc_id long, text string, lang string"))


def test_learned_languages_and_scripts(model):
    assert model.langs == ["aa", "bb", "cc"]
    assert model.scripts[1].tolist() == [True, True, False] and model.scripts[3].tolist() == [False, False, True]


def test_predicts_unseen_texts(spark, model):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices(WORDS[k], k=6)), k) for i in range(90) for k in [rng.choice(list(WORDS))]]
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, score string"), model).collect()
    want = {i: k for i, _, k in rows}
    assert all(r["lang_pred"] == want[r["doc_id"]] and r["score"] == 1.0 for r in got) and len(got) == 90


def test_spans_of_a_mixed_text(spark, model):
    text = " ".join(WORDS["aa"] * 2 + WORDS["cc"] * 3 + ["123", "--"] + WORDS["bb"] * 2)
    r = langid.identify(spark.createDataFrame([(text,)], "text string"), model, spans=True).first()
    spans = [(s["first"], s["lang"]) for s in r["spans"]]
    assert [s[1] for s in spans] == ["aa", "cc", "bb"] and spans[1][0] == 16 and spans[2][0] in (40, 41, 42)
    assert sum(s["n_words"] for s in r["spans"]) == len(text.split())
    assert r["lang_pred"] in ("cc", "bb") and 0.3 < r["score"] < 0.6


def test_viterbi_equals_brute_force(model):
    from itertools import product

    labeller = langid.Labeller(model, switch=3.0)
    rng = random.Random(5)
    texts = [" ".join(rng.choice(rng.choice(list(WORDS.values()))) for _ in range(rng.randint(1, 6))) for _ in range(30)] + [""]
    _, rows = labeller.words(texts)
    for row, path in zip(rows, labeller.label(rows), strict=True):
        value = lambda p: sum(labeller.scores[w, k] for w, k in zip(row, p, strict=True)) - 3.0 * sum(a != b for a, b in zip(p, p[1:], strict=False))  # noqa: E731, B023
        if len(row):
            assert value(path) == pytest.approx(max(map(value, product(range(3), repeat=len(row)))), abs=1e-3)


def test_no_letters_nulls_and_nothing_learned(spark, model):
    rows = [(1, None), (2, ""), (3, "12 34 --"), (4, "kalo " * 30_000), (4, "kalo " * 30_000), (None, "schrung pfach")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["lang_pred"], r["score"]) for r in langid.identify(df, model).collect())
    assert got == [("aa", 1.0), ("aa", 1.0), ("bb", 1.0), ("und", 0.0), ("und", 0.0), ("und", 0.0)]
    empty = langid.learn(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r["lang_pred"] for r in langid.identify(df, empty).collect()} == {"und"}
    kept = langid.keep_identified(df, model)
    assert kept.count() == 3 and kept.columns == df.columns
    assert langid.identify(df.limit(0), model).count() == 0


def test_sample_bounds_the_texts_read(spark, labelled):
    df = spark.createDataFrame([(i, t, "aa" if i % 3 else k) for i, t, k in labelled * 3], "doc_id long, text string, lang string")
    model = langid.learn(df, sample=50)
    assert np.isfinite(model.scores).all() and len(model.langs) == 3


def test_columns_of_any_name_stay(spark, model):
    df = spark.createDataFrame([(1, "kalo mira tenu", "x", "y", "z")], "doc_id long, text string, found string, keep string, __found string")
    kept = langid.keep_identified(df, model)
    assert kept.columns == df.columns and tuple(kept.first()) == (1, "kalo mira tenu", "x", "y", "z")
    assert langid.identify(df, model).first()["lang_pred"] == "aa"
