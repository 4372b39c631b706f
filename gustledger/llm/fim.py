"""Fill-in-middle transformation by repeated captures.

One fullmatch of ``(unit)*`` keeps the end of every repetition: ``ends(1)`` has as many entries as
the text has units, and the two cut offsets are two of these entries, so no text is walked unit by
unit in Python. A text of more than PIECE characters is matched in successive pieces of PIECE units,
so a task holds the captures of one piece only; the offsets are the same.

Which form a row takes and where it is cut depends on its id alone, so a repeated task or another
order of rows changes nothing; rows that share an id and a text get the same result. A null id counts as
an empty one, a null text as an empty text. An empty text, one that holds a marker and one that
isn't a sequence of units stay plain. An empty table stays empty. Other columns are kept; one named
like a result (RESULTS) is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustledger.llm.common import ship, text_of

CODE_POINT = "."
PIECE = 1 << 20
PLAIN, PSM, SPM = "plain", "psm", "spm"
RESULTS = ("n", "form", "prefix_chars", "middle_chars", "output")
_CUT = "struct<n:bigint,prefix_chars:bigint,middle_chars:bigint,output:string>"


@dataclass(frozen=True)
class Markers:
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def all(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


class Units:
    """A text's units by their ends; ``unit`` must match in one way only where a text is longer than ``piece``."""

    def __init__(self, unit: str, piece: int):
        self.piece = piece
        self.whole = regex.compile(f"({unit})*", regex.S)
        self.part = regex.compile(f"({unit}){{1,{piece}}}", regex.S)

    def cut(self, text: str, first: int, second: int) -> tuple[int, int, int] | None:
        """Number of units n, and the offsets after first % (n + 1) and second % (n + 1) units in rising order."""
        if len(text) <= self.piece:
            match = self.whole.fullmatch(text)
            if match is None:
                return None
            ends = match.ends(1)
            low, high = sorted((first % (len(ends) + 1), second % (len(ends) + 1)))
            return len(ends), ends[low - 1] if low else 0, ends[high - 1] if high else 0
        starts, counts, at = [], [], 0
        while at < len(text):
            match = self.part.match(text, at)
            if match is None or match.end() == at:
                return None
            starts.append(at)
            counts.append(len(match.ends(1)))
            at = match.end()
        n = sum(counts)
        low, high = sorted((first % (n + 1), second % (n + 1)))
        return n, self._end(text, starts, counts, low), self._end(text, starts, counts, high)

    def _end(self, text: str, starts: list[int], counts: list[int], units: int) -> int:
        for start, count in zip(starts, counts, strict=True):
            if units <= count:
                return self.part.match(text, start).ends(1)[units - 1] if units else start
            units -= count
        raise AssertionError("more units than the text has")


def _cutter(unit: str, piece: int, markers: Markers):
    def run(text: pa.Array, first: pa.Array, second: pa.Array, form: pa.Array) -> pa.Array:
        units, rows = Units(unit, piece), []
        for t, a, b, f in zip(text, first, second, form, strict=True):
            body, kind = t.as_py(), f.as_py()
            found = units.cut(body, a.as_py(), b.as_py())
            if found is None or kind == PLAIN:
                rows.append((None if found is None else found[0], None, None, body))
                continue
            n, low, high = found
            head, mid, tail = body[:low], body[low:high], body[high:]
            p, s, m = markers.all()
            out = f"{s}{tail}{p}{head}{m}{mid}" if kind == SPM else f"{p}{head}{s}{tail}{m}{mid}"
            rows.append((n, low, high - low, out))
        n, low, mid, out = zip(*rows, strict=True) if rows else ((), (), (), ())
        return pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), pa.array(low, pa.int64()), pa.array(mid, pa.int64()), pa.array(out, pa.string())],
            ["n", "prefix_chars", "middle_chars", "output"],
        )

    return F.arrow_udf(run, _CUT)


def draws(key: Column, seed: str) -> list[Column]:
    """Four unsigned numbers of 32 bits from the digest of seed and key."""
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def transform(
    docs: DataFrame,
    unit: str = CODE_POINT,
    rate: int = 90,
    spm: int = 20,
    markers: Markers = Markers(),
    seed: str = "1:",
    doc_id: str = "doc_id",
    text: str = "text",
    piece: int = PIECE,
) -> DataFrame:
    """The documents with n, form, prefix_chars, middle_chars and output.

    Of a hundred rows about ``rate`` are rearranged, of a hundred of these about ``spm`` with the
    suffix first. Offsets count code points and are null for plain rows; n is null where the text
    isn't a sequence of units.
    """
    h1, h2, h3, h4 = draws(F.col(doc_id), seed)
    body = text_of(text)
    marked = F.lit(False)
    for m in markers.all():
        marked = marked | F.contains(body, F.lit(m))
    plain = (body == "") | marked | (h3 % 100 >= rate)
    form = F.when(plain, PLAIN).when(h4 % 100 < spm, SPM).otherwise(PSM)
    kept = [c for c in docs.columns if c not in RESULTS]
    inputs = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), body.alias("body"), h1.alias("h1"), h2.alias("h2"), form.alias("form"))
    cut = ship(inputs).withColumn("cut", _cutter(unit, piece, markers)("body", "h1", "h2", "form"))
    low = F.col("cut.prefix_chars")
    return cut.select(
        "row.*", F.col("cut.n").alias("n"), F.when(low.isNull(), PLAIN).otherwise(F.col("form")).alias("form"),
        low.alias("prefix_chars"), F.col("cut.middle_chars").alias("middle_chars"), F.col("cut.output").alias("output"),
    )


def restored(output: Column, form: Column, markers: Markers = Markers()) -> Column:
    """The text that ``transform`` made ``output`` of. Its parts hold no marker, and no two markers overlap."""
    p, s, m = markers.all()
    after = lambda mark: F.substring_index(output, mark, -1)
    between = lambda left, right: F.substring_index(F.substring_index(output, right, 1), left, -1)
    return (
        F.when(form == PSM, F.concat(between(p, s), after(m), between(s, m)))
        .when(form == SPM, F.concat(between(p, m), after(m), between(s, p)))
        .otherwise(output)
    )
