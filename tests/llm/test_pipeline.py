"""Every stage of the pipeline on what the stage before kept, against brute force."""

import hashlib
import sys
from collections import Counter
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(ROOT))

import corpus_pipeline  # noqa: E402
from tests.llm.test_bpe import TIK  # noqa: E402
from tests.llm.test_lines_and_mix import brute_lines  # noqa: E402
from tests.llm.test_pairs import brute_join  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before the first stage and after each."""
    out = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = [(900001, None, "en", "src1", None), (900002, "12 34 --", None, None, 8), (900003, "", "en", "src2", 0)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    found = [docs]
    for i, (_, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, found[-1], FOLDER).write.parquet(f"{out}/{i}")
        found.append(spark.read.parquet(f"{out}/{i}"))
    return found


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages_call_the_operators_in_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language id", "line dedup", "n-gram jaccard join", "mixing", "byte-level bpe"]
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_language_id_drops_texts_without_a_language(stages):
    before, after = dict(texts(stages[0])), dict(texts(stages[1]))
    assert not {900001, 900002, 900003} & set(after) and len(after) >= 0.98 * (len(before) - 3)
    assert all(before[i] == t for i, t in after.items())


def test_line_dedup(stages):
    want = {i: t for i, _, _, t in brute_lines(texts(stages[1]))}
    assert {i: t or "" for i, t in texts(stages[2])} == want


def test_one_document_of_each_group_stays(stages):
    before = texts(stages[2])
    kept = {i for i, _, c in brute_join(before, 5, 80) if i == c}
    assert sorted(texts(stages[3])) == sorted(t for t in before if t[0] in kept)


def test_mixing_repeats_whole_documents(stages):
    before, times = dict(texts(stages[3])), Counter(i for i, _ in texts(stages[4]))
    assert set(times.values()) <= {1, 2} and all(before[i] == t for i, t in texts(stages[4]))
    words = {i: len((t or "").split()) for i, t in before.items()}
    assert sum(words[i] * n for i, n in times.items()) == pytest.approx(1.5 * sum(words.values()), rel=0.1)


def test_token_ids(stages):
    want = Counter((i, tuple(TIK.encode_ordinary(t or ""))) for i, t in texts(stages[4]))
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in stages[5].collect()) == want


def test_decoded_digests(stages):
    want = Counter((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in texts(stages[4]))
    assert Counter((r["doc_id"], r["decoded_sha256"]) for r in stages[5].collect()) == want


def test_run_gives_the_same(spark, stages):
    got = Counter((r["doc_id"], tuple(r["ids"])) for r in corpus_pipeline.run(spark, FOLDER).collect())
    assert sum(got.values()) > 0 and {i for i, _ in got} <= {r["doc_id"] for r in stages[0].collect()}


def test_token_ids_take_one_python_worker_a_task(spark):
    """Encoding and decoding in one task would leave an executor with twice as many workers."""
    docs = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
    out = corpus_pipeline.token_ids(spark, docs, "")
    assert str(out._jdf.queryExecution().optimizedPlan()).count("ArrowEvalPython") == 1
    assert {r["doc_id"]: r["decoded_sha256"] for r in out.collect()} == {1: hashlib.sha256(b"one two").hexdigest(), 2: hashlib.sha256(b"").hexdigest()}
