"""Writers: parquet tables and JSON records."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustledger.sources.snapshots import Store

# Fixed value: ISO instants of the JSON answers.
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSS"


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Replace the table at ``path`` (snappy parquet) and return it as read back.

    The old rows stay until the new ones are whole, and one version longer for who still reads them;
    ``snapshots.read_table`` finds the current ones.
    """
    store = Store(df.sparkSession, path)
    written = store.write(df, "", partition_by)
    store.publish()
    store.vacuum()
    return written


def register_views(tables: dict[str, DataFrame]) -> None:
    """Make the tables known to ``spark.sql`` under their names, replacing earlier ones."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def save_named(df: DataFrame, name: str) -> DataFrame:
    """Replace the catalog table ``name`` and return it.

    The rows go to a new folder of the warehouse. A table of the same columns is pointed to it in one
    step of the catalog; otherwise its entry, not its rows, is dropped and made anew.
    """
    spark = df.sparkSession
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}-snapshots/{uuid.uuid4().hex}"
    df.write.option("compression", "snappy").parquet(folder)
    known = spark.catalog.tableExists(name)
    external = known and spark.catalog.getTable(name).tableType == "EXTERNAL"
    if external and spark.table(name).schema == spark.read.parquet(folder).schema:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, folder, "parquet")
    return spark.table(name)


def json_records(df: DataFrame, column: str = "json") -> DataFrame:
    """One JSON text per row: NULL fields are kept, NaN becomes null, instants are ISO."""
    cells = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("timestamp_ntz")
        cells.append(c.alias(f.name))
    options = {"ignoreNullFields": "false", "timestampFormat": ISO, "timestampNTZFormat": ISO}
    return df.select(F.to_json(F.struct(*cells), options).alias(column))


def write_json_lines(df: DataFrame, path: str) -> None:
    """Write the rows of ``df`` as JSON lines, one part per task."""
    json_records(df).write.mode("overwrite").text(path)
