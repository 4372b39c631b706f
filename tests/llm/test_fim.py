import hashlib
import random

import pytest
from pyspark.sql import functions as F

from gustledger.llm import fim


def brute(doc_id, text):
    """(n, form, prefix, middle, output), character by character."""
    text = text or ""
    h = [int(hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = sum(1 for _ in text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    head, mid, tail = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{tail}<P>{head}<M>{mid}"
    return n, "psm", a, b - a, f"<P>{head}<S>{tail}<M>{mid}"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    pool = list("ab \n<PSM>é日\U0001f600́\r\t\x00")
    made = [(i, "".join(rng.choices(pool, k=rng.randint(0, 60)))) for i in range(400)]
    odd = [(None, "no id"), (None, None), (5, None), (6, ""), (7, "x<S>y"), (7, "<P"), (7, "<<M"), (8, "S><M"), (9, "same"), (9, "same"), (10, "long é" * 50_000)]
    return made + odd


def got(frame):
    return sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("piece", [fim.PIECE, 7, 1])
def test_equals_brute_force_and_restores(spark, rows, piece):
    short = [r for r in rows if piece > 100 or len(r[1] or "") < 100]
    out = fim.transform(spark.createDataFrame(short, "doc_id long, text string"), piece=piece)
    assert got(out) == sorted(((i, *brute(i, t)) for i, t in short), key=repr)
    back = out.select("text", fim.restored(F.col("output"), F.col("form")).alias("back")).collect()
    assert all(r["back"] == (r["text"] or "") for r in back)
    assert {r["form"] for r in out.collect()} == {"plain", "psm", "spm"}


def test_other_columns_stay_and_results_replace(spark, rows):
    data = [(t, i, "keep", str(i), 1.5) for i, t in rows[:50]]
    df = spark.createDataFrame(data, "text string, doc_id long, body string, form string, cut double")
    out = fim.transform(df)
    assert out.columns == ["text", "doc_id", "body", "cut", *fim.RESULTS]
    assert {(r["body"], r["cut"]) for r in out.collect()} == {("keep", 1.5)}
    assert got(out) == sorted(((i, *brute(i, t)) for i, t in rows[:50]), key=repr)


def test_empty_table_and_other_units(spark):
    df = spark.createDataFrame([(i, "one two  three " * (i + 1)) for i in range(40)] + [(99, " starts with a space")], "doc_id long, text string")
    assert fim.transform(df.limit(0)).count() == 0
    out = {r["doc_id"]: r for r in fim.transform(df, unit=r"\S+\s*", rate=100).collect()}
    assert out[99]["form"] == "plain" and out[99]["n"] is None and out[99]["output"] == " starts with a space"
    for i in range(40):
        r = out[i]
        assert r["n"] == 3 * (i + 1) and r["form"] != "plain"
        cuts = {r["prefix_chars"], r["prefix_chars"] + r["middle_chars"]}
        assert all(c in (0, len(r["text"])) or (r["text"][c - 1] == " " and r["text"][c] != " ") for c in cuts)


def test_same_result_in_any_order(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(fim.transform(df.repartition(7))) == got(fim.transform(df.coalesce(1)))
