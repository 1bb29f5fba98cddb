"""Named result tables: Parquet folders under one root, or tables of a database."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Connections of a writer to a database, unless told otherwise.
CONNECTIONS = 8

SAVE_MODES = ("overwrite", "ignore", "append", "error")


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def write_table(
    df: DataFrame,
    root: str,
    name: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    replace_partitions: bool = False,
) -> None:
    """Write a table. ``ignore`` leaves an existing one as it is; with ``replace_partitions``
    an overwrite touches only the partitions present in ``df``."""
    if mode not in SAVE_MODES:
        raise ValueError(f"unknown save mode {mode!r}; use one of {SAVE_MODES}")
    writer = df.write.mode(mode).option(
        "partitionOverwriteMode", "dynamic" if replace_partitions else "static"
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(table_path(root, name))


def read_table(
    spark: SparkSession, root: str, name: str, schema: StructType | None = None
) -> DataFrame:
    """A table; with a known ``schema``, no file is opened to find it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(table_path(root, name))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share, gone when the session ends: in the folder named by
    ``spark.checkpoint.dir``, or in the warehouse where that is not set."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    hadoop, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    path = hadoop(f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    files = path.getFileSystem(conf)
    files.deleteOnExit(path)
    return files.makeQualified(path).toUri().toString()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in a scratch folder: computed once, safe from lost executors, and of a size
    that Spark knows when it plans a join."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_exists(spark: SparkSession, root: str, name: str) -> bool:
    """Whether there is a folder of that name; a damaged one is there, too."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table_path(root, name))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def drop_folders(spark: SparkSession, paths: Sequence[str]) -> None:
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_jdbc(
    df: DataFrame, url: str, table: str, mode: str = "overwrite",
    properties: dict[str, str] | None = None, connections: int = CONNECTIONS, batch_rows: int = 10_000,
    keep_table: bool = True,
) -> None:
    """Write to a database table. Its driver must be on the class path; credentials belong in
    ``properties`` and come from the caller.

    At most ``connections`` tasks write at once, as each opens a connection; rows go in statements
    of ``batch_rows``. The rows are stored first: what they are computed from runs on all tasks, and
    a task that is tried again sends the same rows. With ``keep_table`` an overwrite empties the
    table in place of dropping it, so its indexes and grants stay.
    """
    if mode not in SAVE_MODES:
        raise ValueError(f"unknown save mode {mode!r}; use one of {SAVE_MODES}")
    if connections < 1:
        raise ValueError("a writer needs a connection")
    writer = stored(df, "jdbc-rows").coalesce(connections).write.options(
        numPartitions=connections, batchsize=batch_rows, truncate=str(keep_table).lower()
    )
    writer.jdbc(url, table, mode=mode, properties=properties or {})


def read_jdbc(
    spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None,
    column: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 1,
) -> DataFrame:
    """Read a database table; Spark passes filters and the choice of columns on to it.

    With a numeric ``column`` and its ``bounds`` the table is read in that many parts, rows outside
    the bounds in the first and the last; without, one task reads all.
    """
    if column is None:
        return spark.read.jdbc(url, table, properties=properties or {})
    low, high = bounds
    return spark.read.jdbc(
        url, table, column=column, lowerBound=low, upperBound=high, numPartitions=parts,
        properties=properties or {},
    )
