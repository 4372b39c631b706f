"""Readers: monthly file sets whose columns and types drift, registries, constants."""

from __future__ import annotations

import datetime as dt
import json
import logging
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustledger.functions import columns as C
from gustledger.session import stage

log = logging.getLogger(__name__)

FILE_COLUMN = "filename"
# Requests to the driver at a time: months looked for, and schemas that tasks couldn't read.
READERS = 16


def _read(
    spark: SparkSession, fmt: str, paths: list[str], sep: str, root: str = "", schema: T.StructType | None = None, recursive: bool = False
) -> DataFrame:
    """``root`` is given where folders named ``key=value`` lie between it and the files."""
    reader = spark.read.option("header", True).option("sep", sep) if fmt == "csv" else spark.read
    if root:
        reader = reader.option("basePath", root)
    if schema is not None:
        reader = reader.schema(schema)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.format(fmt).load(paths)


def _as_type(name: str, have: T.DataType, want: str):
    c = F.col(name)
    if have.simpleString() == want:
        return C.no_nan(c) if want == "double" else c
    if want == "double":
        return C.to_double(c)
    if want == "int":
        return C.to_int(c)
    if want == "timestamp_ntz":
        return C.to_instant(c)
    return c.try_cast(want)


def _root(path: str) -> str:
    """The part of a path before its first wildcard."""
    parts = path.rstrip("/").split("/")
    plain = next((i for i, p in enumerate(parts) if set(p) & set("*?[{")), len(parts))
    return "/".join(parts[:plain])


def _footers(fmt: str, roots: list[str]):
    """Arrow batches of paths to (path, signature, base): the file's own schema, null where a task can't open it.

    ``base`` is the root below which folders named ``key=value`` lead to the file, empty without such.
    Self-contained, as tasks run it without this package.
    """

    def run(batches):
        import re

        import pyarrow as pa
        import pyarrow.fs
        import pyarrow.parquet

        def signature(uri: str) -> str | None:
            local = re.match(r"file:/+", uri)
            try:
                if local:
                    store, path = pa.fs.LocalFileSystem(), "/" + uri[local.end() :]
                else:
                    store, path = pa.fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))
                if fmt == "csv":
                    with store.open_input_stream(path) as stream:
                        head = b""
                        while b"\n" not in head and (more := stream.read(1 << 16)):
                            head += more
                    return head.split(b"\n")[0].decode("utf-8", "replace").rstrip("\r")
                with store.open_input_file(path) as stream:
                    footer = pa.parquet.read_metadata(stream)
            except (OSError, ValueError, pa.ArrowException):
                return None
            # Spark's own note of the schema decides what Spark reads, else the columns of the file do.
            noted = (footer.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
            return noted.decode("utf-8", "replace") if noted else str(footer.schema).split("\n", 1)[-1]

        def base(uri: str) -> str:
            below = [r for r in roots if "=" in uri and "=" in uri.partition(re.sub(r"^file:/+", "/", r) + "/")[2]]
            return max(below, key=len, default="")

        for batch in batches:
            paths = batch.column(0).to_pylist()
            columns = [paths, list(map(signature, paths)), list(map(base, paths))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["path", "signature", "base"])

    return run


def file_schemas(spark: SparkSession, fmt: str, paths: list[str]) -> DataFrame:
    """(path, signature, base) of all files of files, folders and globs; equal signatures mean equal schemas.

    The listing is a table, and one distributed job opens each file for its footer or header line.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).select("path")
    return listed.mapInArrow(_footers(fmt, sorted({_root(p) for p in paths})), "path string, signature string, base string")


def _scans(spark: SparkSession, fmt: str, paths: list[str], sep: str) -> list[DataFrame]:
    """One scan for each schema among the files; their paths are fetched only if there are several."""
    found = stage(file_schemas(spark, fmt, paths), "footers")
    kind = F.xxhash64("signature", "base").alias("kind")
    kinds = found.groupBy(kind, "base", F.isnotnull("signature").alias("known")).agg(F.min("path").alias("example")).collect()
    if len(kinds) == 1 and kinds[0]["known"] and not kinds[0]["base"]:
        schema = _read(spark, fmt, [kinds[0]["example"]], sep).schema
        return [_read(spark, fmt, paths, sep, schema=schema, recursive=True)]
    members: dict[int, list[str]] = {}
    for row in found.select("path", kind).collect():
        members.setdefault(row["kind"], []).append(row["path"])
    groups: dict[tuple[str, str], list[str]] = {}
    for k in sorted(kinds, key=lambda k: k["example"]):
        files = sorted(members[k["kind"]])
        asked = files[:1] if k["known"] else files
        with ThreadPoolExecutor(READERS) as pool:
            schemas = list(pool.map(lambda f, base=k["base"]: _read(spark, fmt, [f], sep, base).schema.json(), asked))
        for file, schema in zip(files, schemas * len(files) if k["known"] else schemas, strict=False):
            groups.setdefault((schema, k["base"]), []).append(file)
    return [
        _read(spark, fmt, files, sep, base, T.StructType.fromJson(json.loads(schema))) for (schema, base), files in groups.items()
    ]


def row_address() -> Column:
    """(file, row): where a row read straight from parquet files stands."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def read_union(
    spark: SparkSession,
    paths: list[str] | dict[str, list[str]],
    types: dict[str, str] | None = None,
    file_column: str | None = FILE_COLUMN,
    sep: str = ",",
    address_column: str | None = None,
) -> DataFrame:
    """Union files by column name and keep the name of each row's file.

    ``paths`` are parquet paths, or paths per format: files, folders or globs, whose files may
    differ in columns and types. One distributed job reads all footers, and files of equal
    schema share one scan, so jobs and plan grow with the number of schemas, not of files.
    A column in ``types`` is cast per schema to its declared type and bad cells become NULL; a
    missing one is NULL. Any other column whose type differs between schemas becomes text.
    Folders named ``key=value`` below a path are columns, as Spark reads them.

    ``address_column`` is the place of each row: the path of its file and its number in it, as
    Spark's readers know them, so it costs no shuffle and does not depend on tasks. Ordered by it,
    rows stand as in the files, files by path. Only parquet files number their rows; the rows of
    other formats would need a pass in file order, so asking for their place raises ValueError.
    """
    types = types or {}
    by_format = paths if isinstance(paths, dict) else {"parquet": list(paths)}
    if address_column and any(members for fmt, members in by_format.items() if fmt != "parquet"):
        raise ValueError("rows have a place in parquet files only")
    scans = [scan for fmt, members in by_format.items() if members for scan in _scans(spark, fmt, members, sep)]
    if not scans:
        raise ValueError("no files to read")

    seen: dict[str, set[str]] = {}
    for scan in scans:
        for f in scan.schema.fields:
            seen.setdefault(f.name, set()).add(f.dataType.simpleString())
    target = {n: types.get(n) or (t.copy().pop() if len(t) == 1 else "string") for n, t in seen.items()}
    target.update({n: t for n, t in types.items() if n not in target})

    def conform(scan: DataFrame) -> DataFrame:
        have = {f.name: f.dataType for f in scan.schema.fields}
        cols = [
            _as_type(n, have[n], t).alias(n) if n in have else F.lit(None).cast(t).alias(n)
            for n, t in target.items()
        ]
        if file_column:
            cols.append(F.col("_metadata.file_name").alias(file_column))
        if address_column:
            cols.append(row_address().alias(address_column))
        return scan.select(*cols)

    out = conform(scans[0])
    for scan in scans[1:]:
        out = out.unionByName(conform(scan))
    return out


def month_list(reference: dt.date, months: int = 6, lag: int = 1) -> list[str]:
    """The last ``months`` labels ``YYYY_MM``, ending ``lag`` months before the reference date."""
    last = reference.year * 12 + reference.month - 1 - lag
    return [f"{m // 12:04d}_{m % 12 + 1:02d}" for m in range(last - months + 1, last + 1)]


def monthly_paths(
    spark: SparkSession,
    folder: str,
    stem: str,
    months: list[str],
    formats: tuple[str, ...] = ("parquet", "csv"),
    sep: str = ",",
) -> dict[str, list[str]]:
    """Per month the first format that exists; a month with none is skipped with a warning."""

    def first(month: str) -> tuple[str, str] | None:
        for fmt in formats:
            path = f"{folder.rstrip('/')}/{stem}_{month}.{fmt}"
            try:
                spark.read.format("binaryFile").load(path)
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
                continue
            return fmt, path
        log.warning("no file for %s_%s in formats %s", stem, month, formats)
        return None

    found: dict[str, list[str]] = {}
    with ThreadPoolExecutor(READERS) as pool:
        for hit in filter(None, pool.map(first, months)):
            found.setdefault(hit[0], []).append(hit[1])
    return found


def read_monthly(
    spark: SparkSession,
    folder: str,
    stem: str,
    months: list[str],
    types: dict[str, str] | None = None,
    formats: tuple[str, ...] = ("parquet", "csv"),
    sep: str = ",",
) -> DataFrame:
    return read_union(spark, monthly_paths(spark, folder, stem, months, formats, sep), types, sep=sep)


def read_registry(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """CSV with a header and a declared schema, so codes are never taken for numbers or dates."""
    return spark.read.schema(schema).option("header", True).option("sep", sep).csv(path)


def constants(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small relation from literal rows."""
    return spark.createDataFrame(rows, schema)
