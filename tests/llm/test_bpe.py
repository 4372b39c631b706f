import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gustledger.llm import bpe, tokencounts

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
with open(PATH, "rb") as f:
    DATA = f.read()
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, DATA.splitlines())}
TIK = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
OWN = bpe.Encoder(bpe.Ranks.parse(DATA), PATTERN)
TEXTS = [
    "", " ", "  ", "   a", "a  b   c ", "a \n b\n\n c\t\t d  ", "it's we'll 123 4567 -- ???", "naïve Übergröße 漢字かな 🙂👍🏽", "a\0b c",
    "x" * 5000, "ab" * 700 + " " * 900 + "z", "\r\n\r\n  \r\n", "the the the " * 50, "    x", "<|endoftext|> b", "\x1c \x1d a",
]


def ids_of(texts):
    ids, counts = OWN.encode(texts)
    out, at = [], 0
    for n in counts:
        out.append(ids[at : at + n].tolist())
        at += n
    return out


def test_encodes_as_the_library_does():
    assert ids_of(TEXTS) == [TIK.encode_ordinary(t) for t in TEXTS]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\t ab'sé1!漢\x1c\0"), max_size=30) | st.text(max_size=40), max_size=5))
def test_encodes_any_text(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert ids_of(texts) == [TIK.encode_ordinary(t) for t in texts]


def test_long_pieces_merge_like_short_ones(monkeypatch):
    pieces = [("abcabcaab" * 20).encode(), "ééééé".encode() * 9, b"e" * 200, b"tothethe" * 20]
    short = [x.tolist() for x in OWN.ranks.encode_pieces(pieces)]
    monkeypatch.setattr(bpe, "LONG", 1)
    assert [x.tolist() for x in OWN.ranks.encode_pieces(pieces)] == short


def test_ranks_out_of_order():
    """A merge may make a pair of lower rank than its own."""
    ranks = {bytes([b]): i + 10 for i, b in enumerate(b"abcd")} | {b"ab": 5, b"abab": 1, b"cd": 3, b"abcd": 2, b"bc": 4}
    own = bpe.Ranks(ranks)
    lib = tiktoken.Encoding("own", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    for piece in (b"abababcdabcb", b"abcdabcd" * 40, b"bcbcabab" * 50):
        assert own.encode_pieces([piece])[0].tolist() == lib.encode_ordinary(piece.decode())


def test_round_trip_query_columns(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (3, None), (3, None)]
    got = bpe.round_trip(spark.createDataFrame(rows, "doc_id long, text string"), PATH, PATTERN).collect()
    want = []
    for i, t in rows:
        ids = TIK.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_clashing_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b", "x")], "doc_id long, text string, ids string")
    assert bpe.encode(df, PATH, PATTERN).select("ids").first()[0] == TIK.encode_ordinary("a b")
    assert bpe.round_trip(df.limit(0), PATH, PATTERN).count() == 0
    assert bpe.decode(spark.createDataFrame([(None,), ([],)], "ids array<int>"), PATH).select("decoded").distinct().collect()[0][0] == b""


@pytest.fixture
def cache(tmp_path):
    return f"file://{tmp_path}/cache"


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_as_the_library_does(spark, cache, file):
    path = public_tokenizers.path(file)
    texts = [t for t in TEXTS if len(t) < 4000]
    if file.endswith("json"):
        want = [len(x) for x in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    else:
        import sentencepiece

        want = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = dict(tokencounts.token_counts(df, path, cache).select("doc_id", "n_tokens").collect())
    assert [got[i] for i in range(len(texts))] == want


def test_cache_grows_by_distinct_misses_only(spark, cache):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(1, "one two", "a"), (2, "one two", "b"), (2, "one two", "b"), (None, "three", "c"), (4, None, "d"), (5, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_bytes string")
    first = tokencounts.token_counts(df, path, cache)
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in first.collect()) == [(0, 0), (0, 0), (5, 1), (7, 2), (7, 2), (7, 2)]
    assert spark.read.parquet(cache).count() == 3
    more = df.select("doc_id", "text").union(spark.createDataFrame([(7, "four four")], "doc_id long, text string"))
    assert tokencounts.token_counts(more, path, cache).filter("doc_id = 7").first()["n_tokens"] == 2
    assert spark.read.parquet(cache).count() == 4
    tokencounts.token_counts(df, public_tokenizers.path("word_bpe_49k.json"), cache)
    assert spark.read.parquet(cache).select(F.countDistinct("version")).first()[0] == 2
    assert tokencounts.token_counts(df.limit(0), path, cache).count() == 0


def test_repeated_rows_are_one_content(spark, cache):
    """Also where the row that stands for its content is itself repeated, with and without an id, in several tasks."""
    rows = [(1, "one two")] * 20 + [(None, "three four")] * 10 + [(None, None)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = tokencounts.token_counts(df, public_tokenizers.path("byte_bpe_50k.json"), cache)
    assert sorted(r["n_tokens"] for r in got.collect()) == [0] * 3 + [2] * 30
    assert spark.read.parquet(cache).count() == 3


def test_count_columns_may_clash(spark, cache):
    df = spark.createDataFrame([(1, "one two", "x", "y", "z")], "doc_id long, text string, content_key string, content_digest string, CONTENT_TOKENS string")
    got = tokencounts.token_counts(df, public_tokenizers.path("byte_bpe_50k.json"), cache).first()
    assert (got["content_key"], got["content_digest"], got["CONTENT_TOKENS"], got["n_tokens"]) == ("x", "y", "z", 2)


def test_stored_counts_are_used(spark, cache):
    path = public_tokenizers.path("byte_bpe_50k.json")
    df = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    tokencounts.token_counts(df, path, cache)
    stored = [(bytes(r["digest"]), r["version"], 77) for r in spark.read.parquet(cache).collect()]
    spark.createDataFrame(stored, tokencounts.CACHE).write.mode("overwrite").parquet(cache)
    assert tokencounts.token_counts(df, path, cache).first()["n_tokens"] == 77
