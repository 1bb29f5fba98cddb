"""Measurement series: raw files of single sites, and the dataset made from them.

The dataset is partitioned by blocks of site ids and sorted by site and time inside each file, so
that a block filter prunes folders and a site or time filter prunes row groups.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewind import schemas
from sitewind.functions.calendar import utc_literal, utc_time

SITES_PER_BLOCK = 500
FILE_BYTES = 256 * 1024 * 1024

# The period that ingest keeps unless told otherwise, end excluded.
PERIOD_START = "2007-01-01"
PERIOD_END = "2015-01-01"

# Reads the content of one raw file: (path, content) -> frames with the attributes as columns. The
# time is a column "datetime" or the index; the site may be missing, it is then taken from the path.
Decoder = Callable[[str, bytes], Iterable[pd.DataFrame]]


def site_block(site_id: Column) -> Column:
    return F.call_function("div", site_id, F.lit(SITES_PER_BLOCK))


def in_blocks_of(measurements: DataFrame, sites: DataFrame) -> DataFrame:
    """The rows in the blocks of some sites; all rows where there are no blocks.

    The blocks are one array, of a number for each 500 site ids that occur, which Spark has before it
    lists the files to read.
    """
    if "site_block" not in measurements.columns:
        return measurements
    blocks = sites.agg(F.collect_set(site_block(F.col("site_id")))).scalar()
    return measurements.where(F.array_contains(blocks, F.col("site_block")))


def of_site(table: DataFrame, site_id: Column) -> DataFrame:
    """Rows of one site, given as a number or as the result of a subquery. The block filter prunes
    folders, where there are any, the id filter row groups."""
    rows = table.where(F.col("site_id") == site_id)
    if "site_block" in table.columns:
        rows = rows.where(F.col("site_block") == site_block(site_id))
    return rows


def site_blocks(sites: DataFrame) -> DataFrame:
    """Number of sites in every block."""
    return sites.groupBy(site_block(F.col("site_id")).alias("site_block")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _named_site() -> Column:
    """The site that a raw file is named after, NULL if it is not named by a number."""
    return F.substring_index(F.col("_metadata.file_name"), ".", 1).try_cast("bigint")


def _files_of(files: DataFrame, blocks: Sequence[int] | None) -> DataFrame:
    """Files named after sites of some blocks, and files that have other names. The names are known
    from the listing, so of the files left out not a byte is read."""
    if blocks is None:
        return files
    wanted = site_block(_named_site()).isin([int(block) for block in blocks])
    return files.where(_named_site().isNull() | wanted)


def read_raw_parquet(
    spark: SparkSession, path: str, blocks: Sequence[int] | None = None
) -> DataFrame:
    """Raw files named ``<site_id>.parquet``; the id is taken from the name where a file does not
    carry it. With ``blocks``, files named after sites of other blocks are not opened: a file
    named by a number holds that site alone."""
    raw = _files_of(spark.read.schema(schemas.MEASUREMENT).parquet(path), blocks)
    return raw.withColumn("site_id", F.coalesce(F.col("site_id"), _named_site()))


def read_raw_files(
    spark: SparkSession, path: str, decoder: Decoder, blocks: Sequence[int] | None = None
) -> DataFrame:
    """Raw files of a format Spark cannot read, one row of bytes per file, decoded in the tasks.
    With ``blocks``, files named after sites of other blocks are neither read nor decoded.

    A task holds no more than ``spark.sql.files.maxPartitionBytes`` of content, or one file
    where a single one is larger.
    """

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                for frame in decoder(name, content):
                    yield _as_measurements(name, frame)

    files = _files_of(spark.read.format("binaryFile").load(path), blocks)
    return files.select("path", "content").mapInPandas(decode, schemas.MEASUREMENT)


def _as_measurements(path: str, frame: pd.DataFrame) -> pd.DataFrame:
    """A decoded frame with the measurement columns; times without a zone are UTC."""
    if "datetime" not in frame.columns:
        frame = frame.rename_axis("datetime").reset_index()
    times = pd.to_datetime(frame["datetime"], utc=True)
    site = {} if "site_id" in frame.columns else {"site_id": int(_file_stem(path))}
    return frame.assign(datetime=times, **site)[schemas.MEASUREMENT.names]


def _file_stem(path: str) -> str:
    return path.rsplit("/", 1)[-1].split(".", 1)[0]


def decode_pandas_parquet(path: str, content: bytes) -> Iterator[pd.DataFrame]:
    """Decoder for Parquet written by pandas with nanosecond times, which Spark refuses."""
    yield pd.read_parquet(io.BytesIO(content))


def extract_window(
    measurements: DataFrame,
    start: str | None = PERIOD_START,
    end: str | None = PERIOD_END,
    attributes: Sequence[str] = schemas.ATTRIBUTES,
) -> DataFrame:
    """Chosen attributes of all sites with ``start <= datetime < end`` (UTC text, None is open)."""
    unknown = sorted(set(attributes) - set(schemas.ATTRIBUTES))
    if unknown:
        raise ValueError(f"unknown attributes {unknown}")
    window = measurements
    if start is not None:
        window = window.where(F.col("datetime") >= utc_literal(measurements, "datetime", start))
    if end is not None:
        window = window.where(F.col("datetime") < utc_literal(measurements, "datetime", end))
    return window.select("site_id", "datetime", *attributes)


def extract_years(measurements: DataFrame, first: int, last: int) -> DataFrame:
    """Rows of whole years, both ends included, as a time range the files can be pruned by."""
    return extract_window(measurements, f"{first:04d}-01-01", f"{last + 1:04d}-01-01")


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files under a path, from their listing alone."""
    files = spark.read.format("binaryFile").load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def file_count(size: int) -> int:
    """Number of files of a good size that ``size`` bytes make."""
    return max(1, -(-size // FILE_BYTES))


def write_measurements(
    measurements: DataFrame, path: str, blocks: Sequence[int] | None = None
) -> None:
    """Write the dataset, or replace only the given blocks of it, without a shuffle.

    Each task writes the sites it reads: there are no more files than raw files or splits of
    them. Times are stored as UTC clock times, which Parquet keeps as plain integers with
    statistics.
    """
    out = measurements.withColumn("datetime", utc_time(measurements, "datetime")).withColumn(
        "site_block", site_block(F.col("site_id"))
    )
    if blocks is not None:
        out = out.where(F.col("site_block").isin([int(block) for block in blocks]))
    _write_blocks(out, path, "static" if blocks is None else "dynamic")


def compact_measurements(spark: SparkSession, path: str, compacted_path: str) -> None:
    """Rewrite a dataset of many small files into files of a good size.

    The rows are split into ranges of (site, time) of about equal size, even if one site holds
    most rows. All rows cross the network once, and the input is read twice, the first time for
    the bounds of the ranges: worth it for small raw files only.
    """
    stored = read_measurements(spark, path)
    count = file_count(stored_bytes(spark, path))
    ranges = stored.repartitionByRange(count, "site_id", "datetime")
    _write_blocks(ranges, compacted_path, "static")


def _write_blocks(out: DataFrame, path: str, overwrite: str) -> None:
    (
        out.sortWithinPartitions("site_block", "site_id", "datetime")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", overwrite)
        .partitionBy("site_block")
        .parquet(path)
    )


def read_measurements(spark: SparkSession, path: str) -> DataFrame:
    """The dataset, with its partition column."""
    return spark.read.schema(schemas.STORED_MEASUREMENT).parquet(path)


def site_measurements(measurements: DataFrame, site_id: int) -> DataFrame:
    """Series of one site."""
    return of_site(measurements, F.lit(int(site_id)).cast("bigint"))
