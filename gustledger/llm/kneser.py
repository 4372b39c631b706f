"""Quality by the perplexity under an interpolated modified Kneser-Ney model of characters.

The model's n-grams are of characters within words, marks at both ends included. Four
fifths of the trusted documents, by their id, are counted, however many there are; the last fifth
sets the thresholds. N-gram tables of every order, their contexts and discounts
are DataFrames, dealt by n-gram. The distinct n-grams of all documents are joined to the counts of
every order, which gives each its probability. Where these fit the bound of MAX_SENT rows they go
to the tasks that read the documents; beyond it they are joined to the distinct words of blocks of
documents. A document is kept when its perplexity is not above its language's threshold, a
quantile over trusted documents that the model has not seen.

A null text or one without words has no perplexity and is not kept. A null language is a language
of its own. Documents that share an id share their label, trusted if one of its labels is. A
language without trusted documents takes the quantile of all its documents. Without any trusted
text all characters are as likely. Very long texts are read whole. An empty table gives an empty result;
extra columns are not looked at. A perplexity that equals the threshold is kept.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustledger.llm.blocks import list_of, per_block, word_blocks, words_of
from gustledger.llm.common import SPACE, as_binary, offsets, ship, slices, stage, text_of

ORDER = 5
TAUGHT = 0.8           # share of the trusted documents that is counted; the others set the thresholds
MAX_SENT = 4_000_000   # n-grams that are sent to every task at most
QUANTILE = 0.99
FLUSH = 300_000        # distinct words that a task holds
SOME = 1 << 15         # words whose n-grams are made at a time
FIRST, LAST = "\x02", "\x03"


def _grams(word: str) -> list[str]:
    s = FIRST * (ORDER - 1) + word + LAST
    return [s[i : i + ORDER] for i in range(len(s) - ORDER + 1)]


def _points(text: bytes) -> np.ndarray:
    return np.frombuffer(text.decode().encode("utf-32-le"), np.uint32)


class Codes:
    """The n-grams of the highest order over some characters as numbers, each of which is one n-gram."""

    def __init__(self, points: np.ndarray):
        self.alphabet = np.flatnonzero(np.bincount(points)).astype(np.uint32)
        self.bits = max(1, (len(self.alphabet) - 1).bit_length())
        self.fits = ORDER * self.bits <= 64
        self.at = np.zeros(int(self.alphabet[-1]) + 1 if len(self.alphabet) else 1, np.uint64)
        self.at[self.alphabet] = np.arange(len(self.alphabet))

    def rolled(self, points: np.ndarray) -> np.ndarray:
        """The number of the n-gram at every place."""
        own = self.at[points]
        out = own[: len(own) - ORDER + 1].copy()
        for j in range(1, ORDER):
            out <<= np.uint64(self.bits)
            out |= own[j : len(own) - ORDER + 1 + j]
        return out

    def texts(self, keys: np.ndarray) -> list[str]:
        shifts = np.arange(ORDER - 1, -1, -1, dtype=np.uint64) * np.uint64(self.bits)
        own = self.alphabet[(keys[:, None] >> shifts) & np.uint64((1 << self.bits) - 1)]
        joined = own.astype("<u4").tobytes().decode("utf-32-le")
        return [joined[i : i + ORDER] for i in range(0, len(joined), ORDER)]


def _padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The code points of all words with their marks, the places where n-grams begin, and how many each word has."""
    lead, last = (FIRST * (ORDER - 1)).encode(), LAST.encode()
    joined = lead + (last + lead).join(words) + last
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + ORDER)
    chars = np.cumsum((np.frombuffer(joined, np.uint8) & 0xC0) != 0x80)[ends - 1]
    begins = np.ones(int(chars[-1]), bool)  # the last places of a word would reach into the next
    for j in range(1, ORDER):
        begins[chars - j] = False
    return _points(joined), np.flatnonzero(begins), np.diff(chars, prepend=0) - ORDER + 1


def _counted(words: list[bytes], counts: list[int] | None = None) -> dict[str, int]:
    """The distinct n-grams of the words, and how often they are there if each word is there so many times."""
    grams: Counter = Counter()
    for at in range(0, len(words), SOME):
        some = words[at : at + SOME]
        points, begins, sizes = _padded(some)
        codes = Codes(points)
        times = np.array(counts[at : at + SOME], np.int64) if counts else np.ones(len(some), np.int64)
        if codes.fits:
            keys, where = np.unique(codes.rolled(points)[begins], return_inverse=True)
            n = np.bincount(where, np.repeat(times, sizes), len(keys)).astype(np.int64)
            grams.update(dict(zip(codes.texts(keys), n.tolist(), strict=True)))
            continue
        for w, n in zip(some, times.tolist(), strict=True):
            for g in _grams(w.decode()):
                grams[g] += n
    return grams


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of n-grams, as far as the task has seen when it lets go of them."""

    def out(words: Counter) -> pa.RecordBatch:
        grams = _counted(list(words), list(words.values()))
        return pa.RecordBatch.from_arrays([pa.array(list(grams), pa.string()), pa.array(list(grams.values()), pa.int64())], ["g", "n"])

    words: Counter = Counter()
    for batch in batches:
        for part in slices(batch, 0):
            for text in as_binary(part.column(0)).to_pylist():
                words.update(text.split())
            if len(words) > FLUSH:
                yield out(words)
                words = Counter()
    if words:
        yield out(words)


def gram_counts(texts: DataFrame) -> DataFrame:
    """g and n: how often each n-gram of the highest order is in the texts."""
    rows = ship(texts).select(text_of().alias("text")).mapInArrow(_word_counts, "g string, n long")
    return rows.groupBy("g").agg(F.sum("n").alias("n"))


def model_tables(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For orders 1, 2, ...: (g, seen), the discounted share of each n-gram, and (h, back), what its context leaves to the order below."""
    tables, level = [], stage(counts, "gram-counts")
    for order in range(ORDER, 0, -1):
        seen = level.groupBy().agg(*[F.count(F.when(F.col("n") == i, 1)).alias(f"n{i}") for i in (1, 2, 3, 4)]).first()
        n1, n2, n3, n4 = (seen[f"n{i}"] for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        d = [max(0.0, min(i, i - (i + 1) * y * (b / a))) if a and b else min(0.5 * i, 0.9) for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        off = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        h = F.substring("g", 1, order - 1)
        sums = stage(level.groupBy(h.alias("h")).agg(F.sum("n").alias("total"), F.sum(off).alias("off")), "contexts")
        shares = level.withColumn("h", h).join(sums.select("h", "total"), "h").select("g", ((F.col("n") - off) / F.col("total")).alias("seen"))
        tables.append((stage(shares, "shares"), sums.select("h", (F.col("off") / F.col("total")).alias("back"))))
        # The next order counts in how many different contexts an n-gram stands.
        level = stage(level.groupBy(F.substring("g", 2, order).alias("g")).agg(F.count("*").alias("n")), "gram-counts") if order > 1 else level
    return tables[::-1]


def gram_logs(needed: DataFrame, tables: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """g and log, the natural logarithm of its probability, of every n-gram in ``needed`` (g)."""
    symbols = tables[0][0].count() + 1
    p = F.lit(1.0 / symbols)
    rows = needed
    for order, (shares, backs) in enumerate(tables, 1):
        s = shares.select(F.col("g").alias("__g"), F.col("seen"))
        b = backs.select(F.col("h").alias("__h"), F.col("back"))
        rows = rows.withColumn("p", p).withColumn("__k", F.substring("g", ORDER - order + 1, order)).withColumn("__c", F.substring("g", ORDER - order + 1, order - 1))
        rows = rows.join(s, F.col("__k") == F.col("__g"), "left").join(b, F.col("__c") == F.col("__h"), "left")
        p = F.coalesce("seen", F.lit(0.0)) + F.coalesce("back", F.lit(1.0)) * F.col("p")
        rows = rows.select("g", p.alias("q"))
        p = F.col("q")
    return rows.select("g", F.log(F.greatest("q", F.lit(1e-30))).alias("log"))


class Logs:
    """Sums of the logarithms of words' n-grams."""

    def __init__(self, grams: pa.Array, logs: pa.Array):
        own = offsets(grams)
        points = _points(as_binary(grams).buffers()[2].to_pybytes()[own[0] : own[-1]]) if len(grams) else np.zeros(0, np.uint32)
        self.codes = Codes(points)
        if self.codes.fits:
            keys = self.codes.rolled(points)[::ORDER]
            order = np.argsort(keys)
            self.keys, self.logs = keys[order], logs.to_numpy()[order]
        else:
            self.table = dict(zip(grams.to_pylist(), logs.to_pylist(), strict=True))

    def of(self, words: list[bytes]) -> list[float]:
        if not self.codes.fits:
            return [sum(map(self.table.__getitem__, _grams(w.decode()))) for w in words]
        out = []
        for at in range(0, len(words), SOME):
            points, begins, sizes = _padded(words[at : at + SOME])
            found = self.logs[np.searchsorted(self.keys, self.codes.rolled(points)[begins])]
            out += np.add.reduceat(found, np.cumsum(sizes) - sizes).tolist()
        return out


def _scores(sent):
    """Sum of logarithms and number of n-grams of each text."""

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        logs = Logs(*sent.value)
        known: dict[bytes, float] = {}
        for column in columns:
            sums, sizes = [], []
            for part in slices(pa.RecordBatch.from_arrays([column], ["t"]), 0):
                if len(known) > FLUSH:
                    known = {}
                texts = as_binary(part.column(0)).to_pylist()
                split = [t.split() for t in texts]
                new = list(set().union(*split).difference(known))
                known.update(zip(new, logs.of(new), strict=True))
                sums += [sum(map(known.__getitem__, own)) for own in split]
                # A word has one n-gram more than characters.
                chars = pc.utf8_length(part.column(0)).to_pylist()
                sizes += [n - len(t) + len(t.translate(None, SPACE)) + len(own) for n, t, own in zip(chars, texts, split, strict=True)]
            yield pa.StructArray.from_arrays([pa.array(sums, pa.float64()), pa.array(sizes, pa.int64())], ["logs", "n"])

    return run


def _block_scores(payload: pa.Table, values: dict[str, np.ndarray]) -> pa.Table:
    sizes, at = list_of(payload, "words")
    rows = np.repeat(np.arange(len(sizes)), sizes)
    logs, n = (np.bincount(rows, values[c][at] if len(at) else [], len(sizes)) for c in ("logs", "units"))
    return pa.table({"row_id": payload.column("doc_id"), "lang": payload.column("lang"), "logs": pa.array(logs), "n": pa.array(n.astype(np.int64))})


def _needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct n-grams of the texts, as far as the task has seen when it lets go of them."""
    seen: set[bytes] = set()

    def out() -> Iterator[pa.RecordBatch]:
        listed = list(_counted(list(seen)))
        for at in range(0, len(listed), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(listed[at : at + (1 << 16)], pa.string())], ["g"])

    for batch in batches:
        for part in slices(batch, 0):
            seen.update(*(t.split() for t in as_binary(part.column(0)).to_pylist()))
            if len(seen) > FLUSH:
                yield from out()
                seen = set()
    yield from out()


def _by_blocks(docs: DataFrame, tables: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """row_id, lang, logs and n, where the n-grams are too many to be sent to every task."""
    blocks = word_blocks(docs.select(F.col("row_id").alias("doc_id"), "text", F.lit(True).alias("counted"), "lang"), lower=False)
    words = words_of(blocks).select("word").distinct()
    mark = lambda c: F.repeat(F.lit(c), F.lit(ORDER - 1))
    padded = F.concat(mark(FIRST), F.col("word"), F.lit(LAST))
    grams = words.select("word", F.explode(F.transform(F.sequence(F.lit(1), F.length("word") + 1), lambda i: F.substring(padded, i, F.lit(ORDER)))).alias("g"))
    logs = stage(gram_logs(stage(grams.select("g").distinct(), "needed"), tables), "gram-logs")
    valued = grams.join(logs, "g").groupBy("word").agg(F.sum("log").alias("logs"), F.count("*").alias("units"))
    valued = words_of(blocks).select("block", "at", "word").join(valued, "word").select("block", "at", "logs", "units")
    return per_block(blocks, valued, _block_scores, "row_id long, lang string, logs double, n long")


def perplexities(docs: DataFrame, trusted: DataFrame, max_sent: int = MAX_SENT) -> DataFrame:
    """row_id, lang and perplexity of every document (row_id, lang, text), by a model counted on the ``trusted`` texts."""
    spark = docs.sparkSession
    tables = model_tables(gram_counts(trusted))
    needed = ship(docs).select(text_of().alias("text")).mapInArrow(_needed, "g string").distinct()
    needed = stage(needed, "needed")
    if needed.count() <= max_sent:
        logs = gram_logs(needed, tables).toArrow()
        sent = spark.sparkContext.broadcast((logs.column("g").combine_chunks(), logs.column("log").combine_chunks()))
        scored = F.arrow_udf(_scores(sent), "struct<logs:double,n:bigint>")
        found = docs.select("row_id", "lang", scored(text_of()).alias("s")).select("row_id", "lang", "s.logs", "s.n")
    else:
        found = _by_blocks(docs, tables)
    return found.select("row_id", "lang", F.when(F.col("n") > 0, F.exp(-F.col("logs") / F.col("n"))).alias("perplexity"))


def quality(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, max_sent: int = MAX_SENT) -> DataFrame:
    """doc_id, lang, perplexity, threshold and kept of every document.

    ``labels`` has doc_id and quality, 1 for trusted documents. All of these take part: TAUGHT of
    them are counted, the others set the thresholds.
    """
    good = labels.filter("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("id")).distinct()
    taught = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << 30)) / float(1 << 30) < TAUGHT
    good = stage(good.withColumn("taught", taught("id")), "trusted")
    rows = docs.select(F.col("doc_id").cast("long").alias("row_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    # The trusted numbers go to every task where Spark finds them small; else only texts that may be counted move.
    texts = rows.filter(taught("row_id")).join(good.select("id"), F.col("row_id") == F.col("id"), "left_semi")
    found = stage(perplexities(rows, texts, max_sent), "perplexities")
    marked = found.join(good, F.col("row_id") == F.col("id"), "left")
    at = lambda c: F.percentile_approx(F.when(c, F.col("perplexity")), quantile, 10_000)
    limits = marked.groupBy(F.col("lang").alias("of")).agg(
        F.coalesce(at(~F.col("taught")), at(F.col("taught")), at(F.lit(True))).alias("threshold")
    )
    judged = found.join(stage(limits, "thresholds"), F.col("lang").eqNullSafe(F.col("of")), "left")
    kept = F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False))
    return judged.select(F.col("row_id").alias("doc_id"), "lang", "perplexity", "threshold", kept.alias("kept"))
