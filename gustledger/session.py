"""Session settings for local runs, and the shared folder for staged tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", memory: str = "8g", app: str = "gustledger") -> SparkSession:
    """Session for tests and the bench; on a cluster use the session it gives."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_root: list[str] = []
_staged: list[str] = []


def staging_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``; a temporary one in local mode only.

    Only a master of exactly ``local`` or ``local[...]`` runs everything on this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    if not _local_root:
        _local_root.append(tempfile.mkdtemp(prefix="gustledger-"))
    return _local_root[0]


def stage(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For results that are read more than once: the work above is done once, a lost executor
    does not replay it, and each later pass reads only the columns it needs.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"
    _staged.append(path)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging_scope(spark: SparkSession):
    """Deletes what is staged inside, also when it fails; frames that read it must be written by then."""
    before = len(_staged)
    try:
        yield
    finally:
        drop_staged(spark, _staged[before:])


def drop_staged(spark: SparkSession, paths: list[str] | None = None) -> int:
    """Delete the named staged tables, or all that this process staged, once their readers are done."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    dropped = 0
    for name in list(_staged if paths is None else paths):
        _staged.remove(name)
        path = jvm.org.apache.hadoop.fs.Path(name)
        dropped += bool(path.getFileSystem(conf).delete(path, True))
    return dropped
