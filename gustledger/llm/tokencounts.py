"""Token counts through a cache of digests.

Every text is known by the SHA-256 of its content, the tokenizer by that of its file. Counts that
the cache holds for both are joined; one text of each digest without a count is encoded and the
count is appended. The cache is a Parquet folder; only (digest, version, count) rows travel
between tasks, besides the texts to encode.

A null text is normalised to the empty text, nothing else is changed since the vocabulary sees every byte.
Repeated rows and texts share one count, so there are no ties; a very long text is encoded whole. An empty
table stays empty and adds nothing to the cache.
Other columns are kept; those named like the results are replaced.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustledger.llm.common import free_name, ship, slices, stage, text_of

KEPT = 800_000  # distinct cuts that a task remembers before it starts anew
INSIDE_RUN = re.compile(r"\s (?:\s|\Z)")
CACHE = "digest binary, version string, n long"


class Counter:
    """Counts tokens as the library gives them. Splits by ByteLevel never cross the start of a single space,
    so there the counts of the text between such cuts are remembered; other tokenizers get whole texts."""

    def __init__(self, model: bytes, kind: str, kept: int = KEPT):
        self.kept, self.known, self.special = kept, {}, None
        if kind == "model":
            import sentencepiece

            self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
            self.whole = lambda texts: [len(x) for x in self.library.encode(texts, num_threads=1)]
            return
        from tokenizers import Tokenizer

        spec = json.loads(model)
        spec["truncation"] = spec["padding"] = None
        self.library = Tokenizer.from_str(json.dumps(spec))
        self.whole = lambda texts: [len(x) for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        split = spec.get("pre_tokenizer") or {}
        if spec.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space"):
            self.special = [x["content"] for x in spec.get("added_tokens", [])]

    def count(self, texts: list[str]) -> list[int]:
        if self.special is None:
            return self.whole(texts)
        if len(self.known) > self.kept:
            self.known = {}
        known, plain, out = self.known, [], [0] * len(texts)
        whole = [i for i, t in enumerate(texts) if "\0" in t or INSIDE_RUN.search(t) or any(s in t for s in self.special)]
        for i, n in zip(whole, self.whole([texts[i] for i in whole]), strict=True):
            out[i] = n
        alone = set(whole)
        for i, text in enumerate(texts):
            if i not in alone:
                plain.append((i, text.replace(" ", "\0 ").split("\0")))
        new = list(dict.fromkeys(c for _, cuts in plain for c in cuts if c not in known))
        known.update(zip(new, self.whole(new), strict=True))
        for i, cuts in plain:
            out[i] = sum(map(known.__getitem__, cuts))
        return out


@functools.lru_cache(maxsize=2)
def _counter(model: bytes, kind: str) -> Counter:
    return Counter(model, kind)


def _counted(misses: DataFrame, model: bytes, kind: str) -> DataFrame:
    data = misses.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        counter, seen = _counter(data.value, kind), set()
        for batch in batches:
            fresh = []
            for d in batch.column(0).to_pylist():  # rows of one id and content come several times
                fresh.append(d not in seen)
                seen.add(d)
            for part in slices(batch.filter(pa.array(fresh, pa.bool_())), 1):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counter.count(part.column(1).to_pylist()), pa.int64())], ["digest", "n"])

    return ship(misses).select("digest", "text").mapInArrow(run, "digest binary, n long")


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts; none where the folder isn't there yet."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.schema(CACHE).parquet(path) if there else spark.createDataFrame([], CACHE)


def token_counts(docs: DataFrame, tokenizer: str, cache: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds n_bytes and n_tokens by the tokenizer file; appends the counts of new contents to ``cache``."""
    spark = docs.sparkSession
    with open(tokenizer, "rb") as f:
        model = f.read()
    version = hashlib.sha256(model).hexdigest()
    digest = F.unhex(F.sha2(text_of(text).cast("binary"), 256))
    keyed = stage(docs.select(F.col(doc_id).alias("id"), digest.alias("digest")), "digests")
    stored = read_cache(spark, cache).filter(F.col("version") == version).select("digest", "n")
    first = keyed.groupBy("digest").agg(F.min("id").alias("id"))
    misses = stage(first.join(stored.select("digest"), "digest", "left_anti"), "misses")
    # The document that stands for its content is found again by id and digest; a null id equals a null id.
    whole = docs.select(F.col(doc_id).alias("id"), text_of(text).alias("text")).withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    m = misses.select(F.col("digest").alias("d"), F.col("id").alias("i"))
    whole = whole.join(m, (F.col("digest") == F.col("d")) & F.col("id").eqNullSafe(F.col("i")), "left_semi")
    counted = _counted(whole, model, "model" if tokenizer.endswith(".model") else "json")
    # Repeated rows in several tasks are counted in each of them, and stored once.
    counted = counted.groupBy("digest").agg(F.min("n").alias("n"))
    counted.select("digest", F.lit(version).alias("version"), "n").write.mode("append").parquet(cache)
    counts = read_cache(spark, cache).filter(F.col("version") == version).groupBy(F.col("digest").alias("content_digest")).agg(F.min("n").alias("content_tokens"))
    kept = [c for c in docs.columns if c not in ("n_bytes", "n_tokens")]
    # Sizes and digests are taken before the join, so the texts only travel where the caller asks for them.
    key, of, found = (free_name(docs, n) for n in ("content_key", "content_digest", "content_tokens"))
    sized = docs.select(*[F.col(f"`{c}`") for c in kept], F.octet_length(text_of(text)).cast("long").alias("n_bytes"), digest.alias(key))
    joined = sized.join(counts.toDF(of, found), F.col(key) == F.col(of), "left")
    return joined.select(*[sized[f"`{c}`"] for c in kept], sized["n_bytes"], F.col(found).alias("n_tokens"))
