"""Language of whole texts and of their spans.

The model holds, for each learned language, log probabilities of hashed character trigrams and the
scripts its words are written in. A word's script narrows its candidate languages; Viterbi over the
per-word scores with a penalty for every switch labels the words, runs of one label are the spans.
A text has the language with most letters; the score is its share of them.

The counts come from a bounded sample: about ``sample`` documents a language, those with the lowest
hash of id and text, or all where there are fewer. The model's size is fixed by the number of
buckets and languages. A null text and a text without letters give ``und`` and score 0, as does
any text when nothing was learned. A very long text is read whole, and an empty table gives an empty
result. Equal scores fall to the language first by code point. Repeated
rows get equal results, other columns are kept unless named like the results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustledger.llm.common import free_name, mix64, ragged, ship, slices, text_of

BUCKETS = 1 << 15
SAMPLE = 4000
SWITCH = 12.0   # log units that a change of language costs
NARROW = 1e4    # log units against a language that was never seen in the word's script
KEPT = 300_000
UNKNOWN = "und"

# First code point of each range, and its script. 0 has no letters of its own.
SCRIPTS = [
    (0x0000, 0), (0x0041, 1), (0x005B, 0), (0x0061, 1), (0x007B, 0), (0x00C0, 1), (0x0250, 0), (0x0370, 2), (0x0400, 3),
    (0x0530, 4), (0x0590, 5), (0x0600, 6), (0x0700, 0), (0x0900, 7), (0x0980, 8), (0x0A00, 0), (0x0B80, 9), (0x0C00, 0),
    (0x0E00, 10), (0x0E80, 0), (0x10A0, 11), (0x1100, 12), (0x1200, 0), (0x1E00, 1), (0x1F00, 2), (0x2000, 0),
    (0x3040, 13), (0x3100, 0), (0x3400, 14), (0xA000, 0), (0xAC00, 12), (0xD7B0, 0), (0xF900, 14), (0xFB00, 0),
    (0x20000, 14), (0x30000, 0),
]
_FIRST = np.array([a for a, _ in SCRIPTS], np.uint32)
_SCRIPT = np.array([b for _, b in SCRIPTS], np.int64)
N_SCRIPTS = int(_SCRIPT.max()) + 1


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, each between two marks, and the length of each with its marks."""
    joined = "".join(f"\x02{w}\x03" for w in words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), sizes


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the trigrams of all words, how many each word has, and each word's script."""
    codes, sizes = _codes(words)
    wide = codes.astype(np.uint64)
    mixed = (wide[:-2] << np.uint64(42)) ^ (wide[1:-1] << np.uint64(21)) ^ wide[2:]
    buckets = (mix64(mixed) % np.uint64(BUCKETS)).astype(np.int64)
    counts = np.maximum(sizes - 2, 0)
    starts = np.cumsum(sizes) - sizes
    kinds = _SCRIPT[np.searchsorted(_FIRST, codes, "right") - 1]
    # The script of a word is that of most of its letters, the lower number on a tie.
    votes = np.zeros((len(words), N_SCRIPTS), np.int32)
    np.add.at(votes, (np.repeat(np.arange(len(words)), sizes), kinds), 1)
    votes[:, 0] = 0
    return buckets[ragged(starts, counts)], counts, np.where(votes.any(1), votes.argmax(1), 0)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (language, bucket) and, as negative buckets, of (language, script)."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in slices(batch, 1, 1 << 20):
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                words = text.lower().split()
                if words:
                    buckets, counts, scripts = _grams(words)
                    own = sums.setdefault(lang, np.zeros(BUCKETS + N_SCRIPTS, np.int64))
                    own[:BUCKETS] += np.bincount(buckets, minlength=BUCKETS)
                    own[BUCKETS:] += np.bincount(scripts, minlength=N_SCRIPTS)
    for lang, own in sums.items():
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(own[at])], ["lang", "bucket", "n"])


@dataclass
class Model:
    langs: list[str]
    scores: np.ndarray   # (BUCKETS, languages), log probabilities less their mean
    scripts: np.ndarray  # (N_SCRIPTS, languages), whether the language is written so


def learn(labelled: DataFrame, sample: int = SAMPLE, lang: str = "lang", text: str = "text", key: str = "doc_id") -> Model:
    """The model of all rows with a language; ``sample`` bounds the documents read for each."""
    rows = ship(labelled).select(F.col(lang).alias("lang"), F.col(text).cast("string").alias("text"), F.xxhash64(F.col(key), F.col(text)).alias("h"))
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((N_SCRIPTS, 0), bool))
    # A hash below the language's share is a sample of about the wanted size, without sorting anything.
    share = F.lit(0.0)
    for name, n in sizes.items():
        if n > sample:
            share = F.when(F.col("lang") == name, F.lit(sample / n)).otherwise(share)
        else:
            share = F.when(F.col("lang") == name, F.lit(2.0)).otherwise(share)
    taken = rows.filter(F.pmod(F.col("h"), F.lit(1 << 30)) / float(1 << 30) < share)
    counts = taken.select("lang", "text").mapInArrow(_counted, "lang string, bucket long, n long")
    counts = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(sizes)
    table = np.zeros((BUCKETS + N_SCRIPTS, len(langs)))
    at = {name: i for i, name in enumerate(langs)}
    table[counts.column("bucket").to_numpy(), [at[x] for x in counts.column("lang").to_pylist()]] = counts.column("n").to_numpy()
    grams = table[:BUCKETS] + 0.5
    logs = np.log(grams / grams.sum(0))
    return Model(langs, (logs - logs.mean(1, keepdims=True)).astype(np.float32), table[BUCKETS:] > 0.001 * table[BUCKETS:].sum(0))


class Labeller:
    def __init__(self, model: Model, switch: float = SWITCH):
        self.model, self.switch = model, switch
        self._forget()

    def _forget(self) -> None:
        self.at: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.model.langs)), np.float32)
        self.letters = np.zeros(0, np.int32)

    def _learn(self, words: list[str]) -> None:
        low = [w.lower() for w in words]
        buckets, counts, scripts = _grams(low)
        starts = np.cumsum(counts) - counts
        scores = np.add.reduceat(self.model.scores[buckets], starts, axis=0)
        known = self.model.scripts[scripts]
        scores -= np.where(known.any(1, keepdims=True) & ~known, NARROW, 0).astype(np.float32)
        letters = np.fromiter((len(w) if w.isalpha() else sum(map(str.isalpha, w)) for w in words), np.int32, len(words))
        scores[letters == 0] = 0
        for i, w in enumerate(words, len(self.at)):
            self.at[w] = i
        self.scores, self.letters = np.r_[self.scores, scores], np.r_[self.letters, letters]

    def words(self, texts: list[str]) -> tuple[list[list[str]], list[np.ndarray]]:
        if len(self.at) > KEPT:
            self._forget()
        words = [t.split() for t in texts]
        new = {w for own in words for w in own}.difference(self.at)
        if new:
            self._learn(sorted(new))
        get = self.at.__getitem__
        return words, [np.fromiter(map(get, own), np.int64, len(own)) for own in words]

    def label(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        """Best languages of the words of each text, by number. Texts of like length go together."""
        out = [np.zeros(0, np.int16)] * len(rows)
        order = sorted(range(len(rows)), key=lambda i: len(rows[i]))
        at = 0
        while at < len(order):
            if not len(rows[order[at]]):
                at += 1
                continue
            width = 1 << int(len(rows[order[at]]) - 1).bit_length()
            stop = at
            while stop < len(order) and len(rows[order[stop]]) <= width and (stop - at) * width <= 1 << 20:
                stop += 1
            for i, path in zip(order[at:stop], self._viterbi([rows[j] for j in order[at:stop]]), strict=True):
                out[i] = path
            at = stop
        return out

    def _viterbi(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        sizes = np.array([len(r) for r in rows])
        n, width, k = len(rows), int(sizes.max()), len(self.model.langs)
        steps = np.full((width, n), -1, np.int64)
        for i, r in enumerate(rows):
            steps[: len(r), i] = r
        scores = np.r_[self.scores, np.zeros((1, k), np.float32)]  # padding adds nothing
        best = scores[steps[0]]
        stay = np.ones((width, n, k), bool)
        top = np.zeros((width, n), np.int16)
        for t in range(1, width):
            top[t] = best.argmax(1)
            moved = best[np.arange(n), top[t]] - self.switch
            stay[t] = best >= moved[:, None]
            best = np.maximum(best, moved[:, None])
            best += scores[steps[t]]
            if t % 64 == 0:
                best -= best.max(1, keepdims=True)
        path = np.zeros((width, n), np.int16)
        path[-1] = best.argmax(1)
        each = np.arange(n)
        for t in range(width - 1, 0, -1):
            path[t - 1] = np.where(stay[t, each, path[t]], path[t], top[t])
        return [path[: len(r), i] for i, r in enumerate(rows)]


def _letters(labeller: Labeller, texts: list[str], with_spans: bool) -> tuple[list[str], np.ndarray, list]:
    langs, k = labeller.model.langs, len(labeller.model.langs)
    words, rows = labeller.words(texts) if k else ([], [np.zeros(0, np.int64)] * len(texts))
    paths = labeller.label(rows) if k else rows
    names, shares, spans = [], np.zeros(len(texts)), []
    for i, (row, path) in enumerate(zip(rows, paths, strict=True)):
        weights = labeller.letters[row]
        total = int(weights.sum())
        if not total:
            names.append(UNKNOWN)
            spans.append([])
            continue
        each = np.bincount(path, weights, k)
        names.append(langs[int(each.argmax())])
        shares[i] = each.max() / total
        if with_spans:
            cuts = np.r_[0, np.flatnonzero(np.diff(path)) + 1, len(path)]
            spans.append([{"first": int(a), "n_words": int(b - a), "lang": langs[path[a]]} for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
    return names, shares, spans


def identify(docs: DataFrame, model: Model, text: str = "text", spans: bool = False) -> DataFrame:
    """Adds lang_pred and score; with ``spans`` also the runs of words of one language."""
    sent = ship(docs).sparkSession.sparkContext.broadcast((model.langs, model.scores, model.scripts))
    kind = "struct<lang_pred:string,score:double" + (",spans:array<struct<first:bigint,n_words:bigint,lang:string>>" if spans else "") + ">"

    @F.arrow_udf(kind)
    def found(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        labeller = Labeller(Model(*sent.value))
        for column in columns:
            names, shares, runs = [], [], []
            for part in slices(pa.RecordBatch.from_arrays([column], ["t"]), 0):
                a, b, c = _letters(labeller, part.column(0).to_pylist(), spans)
                names += a
                shares.append(b)
                runs += c
            fields = {"lang_pred": pa.array(names, pa.string()), "score": pa.array(np.concatenate([np.zeros(0), *shares]))}
            if spans:
                fields["spans"] = pa.array(runs, pa.list_(pa.struct([("first", pa.int64()), ("n_words", pa.int64()), ("lang", pa.string())])))
            yield pa.StructArray.from_arrays(list(fields.values()), list(fields))

    results = ["lang_pred", "score", *["spans"] * spans]
    kept, out = [F.col(f"`{c}`") for c in docs.columns if c not in results], free_name(docs, "found")
    return docs.select(*kept, found(text_of(text)).alias(out)).select(*kept, f"{out}.*")


def keep_identified(docs: DataFrame, model: Model, least: float = 0.5, text: str = "text") -> DataFrame:
    """Documents without a language, or whose language holds less than ``least`` of the letters, go."""
    keep = free_name(docs, "keep")
    ident = identify(docs.withColumn(keep, F.struct(*[F.col(f"`{c}`") for c in docs.columns])), model, text)
    return ident.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select(f"{keep}.*")


def held_out(key: Column, parts: int = 4, part: int = 2) -> Column:
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(parts)) == part


__all__ = ["Labeller", "Model", "held_out", "identify", "keep_identified", "learn"]
