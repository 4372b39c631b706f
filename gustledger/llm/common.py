"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import functools
import math
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import gustledger
from gustledger import session
from gustledger.session import staging_root

SPACE = b" \t\n\x0b\x0c\r"
BATCH_ROWS, TEXTS_AT_ONCE = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
MIXED_AT_ONCE = 1 << 14
TEXT_CHUNK = 4 << 20  # characters that a Python step handles at a time


@functools.lru_cache(maxsize=1)
def _archive() -> str:
    """This package as a zip file of the driver, from where Spark hands it to the executors."""
    folder = tempfile.TemporaryDirectory(prefix="gustledger-")
    atexit.register(folder.cleanup)
    path, package = Path(folder.name, "gustledger.zip"), Path(gustledger.__file__).parent
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    return str(path)


def ship(df: DataFrame) -> DataFrame:
    """Gives the executors this package, once a session, so that Python functions find it there.

    Whole texts are long, so no more than TEXTS_AT_ONCE of them go to Python in one batch.
    """
    context, conf = df.sparkSession.sparkContext, df.sparkSession.conf
    if int(conf.get(BATCH_ROWS, "10000")) > TEXTS_AT_ONCE:
        conf.set(BATCH_ROWS, str(TEXTS_AT_ONCE))
    if not getattr(context, "_gustledger_shipped", False):
        context.addPyFile(_archive())
        context._gustledger_shipped = True
    return df


def stage(df: DataFrame, name: str) -> DataFrame:
    """session.stage with the stronger codec: what these operators stage is large, and mostly read once or twice."""
    return session.stage(df, name, "zstd")


@contextmanager
def shuffles_removed(spark: SparkSession):
    """What runs inside leaves no shuffle files behind; otherwise they stay until the driver's garbage is collected."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def crc_part(key: Column, parts: int) -> Column:
    """Remainder of crc32 of the key as text; a null key counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"


def as_binary(column: pa.Array) -> pa.Array:
    """Strings as their UTF-8 bytes, without a copy."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column if column.type == kind else column.cast(kind)


def slices(batch: pa.RecordBatch, column: int, size: int = TEXT_CHUNK) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts hold about ``size`` bytes; a longer text is a part of its own."""
    lengths = np.diff(offsets(batch.column(column)))
    part = (np.cumsum(lengths) - lengths) // size
    for start, stop in zip(*_runs(part), strict=True):
        yield batch.slice(start, stop - start)


def offsets(column: pa.Array) -> np.ndarray:
    """Value offsets of a string, binary or list column, with its slice applied."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) or pa.types.is_large_list(column.type)
    kind = np.int64 if wide else np.int32
    if len(column) == 0:
        return np.zeros(1, kind)
    return np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1]


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cuts = np.flatnonzero(np.diff(values)) + 1
    return (np.r_[0, cuts], np.r_[cuts, len(values)]) if len(values) else (cuts, cuts)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes start, start+1, ... of every run, one run after the other."""
    lengths = lengths.astype(np.int64)
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function, so that sums and remainders of its values behave like random numbers."""
    x = x.astype(np.uint64, copy=True)
    if x.size > MIXED_AT_ONCE:  # in parts that stay in the processor's cache
        flat = x.ravel("K")
        for start in range(0, x.size, MIXED_AT_ONCE):
            part = flat[start : start + MIXED_AT_ONCE]
            part[:] = mix64(part)
        return x
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def partitions_for(rows: int, rows_per_task: int) -> int:
    return max(1, math.ceil(rows / rows_per_task))


__all__ = [
    "DataFrame", "SPACE", "as_binary", "crc_part", "free_name", "fresh_path", "has_letter", "mix64", "offsets", "partitions_for",
    "ragged", "ship", "shuffles_removed", "slices", "stage", "text_of",
]
