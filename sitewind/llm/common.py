"""What several operators need: words, values bound once in an expression, shared tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewind.sources.tables import scratch_path

# The characters between words, and those of words.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def word_array(text: Column) -> Column:
    """The words of a text, in order."""
    return F.array_remove(F.split(text, f"{SPACE_CLASS}+"), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body).getItem(0)


def tasks(spark: SparkSession) -> int:
    """Number of tasks for work whose rows are few and whose cost per row is high. Spark would
    join partitions by their bytes."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Rows of a batch whose ``column`` has about ``size`` bytes, or one longer row."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    at, ends = 0, np.cumsum(lengths, dtype=np.int64)
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
        yield batch.slice(at, end - at)
        at = end


def free_name(name: str, taken: Iterable[str]) -> str:
    """``name``, or one made of it that is not taken."""
    taken = {t.lower() for t in taken}
    while name.lower() in taken:
        name = f"q_{name}"
    return name


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share, gone when the session ends, as a URI."""
    path = scratch_path(spark, name)
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return path


def staged(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and safe from lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """What is written in here takes its shuffle files with it when it is done. Else they stay until the
    driver happens to collect its garbage, which an operator of many steps pays for in disk."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
