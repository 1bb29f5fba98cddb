"""Result tables in folders by block of sites and by year.

What a page asks for is one site: its block's folders are all that is opened, and how many there are
follows from the sites and the years, not from the batches that the results were made in. The
batch of a row is a column. The schema is known, so no file is opened to find it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from sitewind import schemas
from sitewind.sources.measurements import in_blocks_of, site_block
from sitewind.sources.tables import drop_folders, stored, table_exists, table_path, write_table

LAYOUT = ["site_block", "year"]


def result_schema(name: str) -> StructType:
    return StructType([*schemas.RESULT_TABLES[name]]).add("run_id", LongType()).add("site_block", LongType())


def _laid_out(df: DataFrame, name: str) -> DataFrame:
    rows = df.withColumn("site_block", site_block(F.col("site_id")))
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in result_schema(name)])


def _write(rows: DataFrame, root: str, name: str, some: bool) -> None:
    ranges = rows.repartitionByRange(*LAYOUT, "site_id").sortWithinPartitions(*LAYOUT, "site_id")
    write_table(ranges, root, name, partition_by=LAYOUT, replace_partitions=some)


def write_result(df: DataFrame, root: str, name: str) -> None:
    """Write a result table anew. ``df`` has the table's columns and ``run_id``."""
    _write(_laid_out(df, name), root, name, False)


def replace_run(df: DataFrame, root: str, name: str, run_id: int) -> None:
    """Put the rows of one batch in place of those it had; rows of other batches stay.

    The folders of the batch's blocks are written again, with the rows that others have there; the
    rows are stored first, as what is replaced is read.
    """
    spark = df.sparkSession
    new = _laid_out(df.withColumn("run_id", F.lit(run_id)), name)
    if not table_exists(spark, root, name):
        _write(new, root, name, False)
        return
    table = read_result(spark, root, name)
    mine = table.where(F.col("run_id") == run_id)
    new = stored(new, "new-results")
    touched = stored(new.select("site_id").union(mine.select("site_id")).distinct(), "touched-sites")
    others = in_blocks_of(table, touched).where(F.col("run_id") != run_id)
    rows = stored(others.unionByName(new), "results")
    # Folders in which nothing is left; at most those of the batch's blocks.
    gone = mine.select(*LAYOUT).distinct().join(rows.select(*LAYOUT).distinct(), LAYOUT, "left_anti").collect()
    _write(rows, root, name, True)
    drop_folders(spark, [f"{table_path(root, name)}/site_block={r.site_block}/year={r.year}" for r in gone])


def read_result(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A result table with its columns, ``run_id`` and ``site_block``."""
    schema = result_schema(name)
    return spark.read.schema(schema).parquet(table_path(root, name)).select(schema.names)
