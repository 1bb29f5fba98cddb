"""The batch jobs: ingest, site dimension, batches, roll-ups, directions and scores.

All tables live under one root folder. Measurements are scanned once: the roll-up job writes the
daily and the direction facts, and every other table is made from those, step by step.

Fact tables are partitioned by the batch they came from (``run_id``), so a batch can be run again
without touching the others. Batch 0 stands for all sites at once. Result tables are partitioned by
block of sites and by year, for lookups; there the batch is a column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sitewind.functions.calendar import GRAINS
from sitewind.operators import batches, direction, rollup, score, sites
from sitewind.sources import dimensions, measurements
from sitewind.sources.results import replace_run, write_result
from sitewind.sources.tables import read_table, table_exists, write_table

ALL_SITES = 0

FACTS = "site_facts"
COARSER_FACTS = {"monthly": "site_facts_monthly", "yearly": "site_facts_yearly"}
BATCHES = "site_batches"
RUNS = "site_runs"
SITE_INFO = "site_info"
SITE_SCORE = "site_score"
MEAN_TABLES = {
    "daily": "site_avg_daily_capacity",
    "monthly": "site_avg_monthly_capacity",
    "yearly": "site_avg_yearly_capacity",
}
POWER_TABLES = {
    "daily": "site_total_daily_capacity",
    "monthly": "site_total_monthly_capacity",
    "yearly": "site_total_yearly_capacity",
}
SECTOR_MEAN_TABLE = "site_avg_wind_dir"
SECTOR_POWER_TABLE = "site_tot_power_wind_dir"


def ingest(
    spark: SparkSession,
    raw_path: str,
    path: str,
    decoder: measurements.Decoder | None = None,
    start: str | None = measurements.PERIOD_START,
    end: str | None = measurements.PERIOD_END,
    blocks: Sequence[int] | None = None,
    count: bool = False,
) -> dict[str, int] | None:
    """Turn raw files of single sites into the dataset at ``path``.

    Without a decoder the raw files are Parquet. ``blocks`` replaces only those blocks, from the raw
    files named after their sites and those named otherwise. ``start`` and ``end`` bound the times
    that are kept, None leaves a side open. With ``count``, the rows read and those kept are
    returned, counted as they are written: times then no longer filter what the files give.
    """
    if decoder is None:
        raw = measurements.read_raw_parquet(spark, raw_path, blocks)
    else:
        raw = measurements.read_raw_files(spark, raw_path, decoder, blocks)
    seen, kept = Observation("read"), Observation("kept")
    if count:
        raw = raw.observe(seen, F.count(F.lit(1)).alias("n"))
    window = measurements.extract_window(raw, start, end)
    if count:
        window = window.observe(kept, F.count(F.lit(1)).alias("n"))
    measurements.write_measurements(window, path, blocks)
    return {"read": seen.get["n"], "kept": kept.get["n"]} if count else None


def load_site_info(
    spark: SparkSession, timezone_csv: str, site_3tier_csv: str, geo_csv: str, root: str
) -> DataFrame:
    """Join the three site files into ``site_info``; returns the rows lost per file."""
    inputs = (
        dimensions.read_site_timezone(spark, timezone_csv),
        dimensions.read_site_3tier(spark, site_3tier_csv),
        dimensions.read_site_geo(spark, geo_csv),
    )
    write_table(sites.build_site_info(*inputs), root, SITE_INFO)
    return sites.unmatched_sites(*inputs)


def split_batches(
    spark: SparkSession, root: str, size: int = batches.SITES_PER_BATCH
) -> None:
    """Assign the sites of ``site_info`` to batches, each site to one.

    Refused while results of batches are stored: those of an older split would count sites twice.
    Use a new root folder, or remove the results first.
    """
    if table_exists(spark, root, FACTS):
        if not read_table(spark, root, FACTS).where(F.col("run_id") != ALL_SITES).isEmpty():
            raise ValueError(f"{root} has results of another split")
    listed = sites.first_rows(read_table(spark, root, SITE_INFO).select("site_id", "state"))
    assigned = batches.assign_batches(listed, size)
    write_table(assigned, root, BATCHES)


def materialise_batches(
    spark: SparkSession, measurement_path: str, root: str, path: str
) -> None:
    """Write the measurements as one input set per batch, partitioned by ``run_id``.

    Each task writes the sites it reads, so the measurements are not shuffled.
    """
    stored = measurements.read_measurements(spark, measurement_path)
    batched = batches.with_run_id(stored, read_table(spark, root, BATCHES))
    (
        batched.sortWithinPartitions("run_id", "site_id", "datetime")
        .write.mode("overwrite")
        .partitionBy("run_id")
        .parquet(path)
    )


def process_measurements(
    spark: SparkSession, measurement_path: str, root: str, run_id: int = ALL_SITES
) -> None:
    """Scan the measurements of one batch, or of all sites, once and write every roll-up.

    For a batch, the path may also be that of its own input set. To process all batches,
    :func:`process_batches` scans once for all of them.
    """
    _refuse_mixture(spark, root, run_id)
    stored = measurements.read_measurements(spark, measurement_path)
    if run_id != ALL_SITES:
        assigned = read_table(spark, root, BATCHES)
        if assigned.where(F.col("run_id") == run_id).isEmpty():
            raise ValueError(f"there is no batch {run_id}")
        stored = batches.batch_measurements(stored, assigned, run_id)
    # Facts are read whole or by year: they are written by the tasks that finish the aggregation,
    # sorted so that a year is found by row group.
    facts = direction.daily_and_direction_facts(stored).sortWithinPartitions("kind", "year")
    write_table(facts, root, f"{FACTS}/run_id={run_id}", partition_by=["kind"])

    write_rollups(spark, root, run_id)
    write_directions(spark, root, run_id)
    done = spark.range(1).select(F.lit(True).alias("done"))
    write_table(done, root, f"{RUNS}/run_id={run_id}")


def process_batches(spark: SparkSession, measurement_path: str, root: str) -> None:
    """Scan the measurements once and write every roll-up of all batches.

    The batch is joined to the facts, not to the measurements: one row per site and day is moved.
    Sites of no batch are left out. All earlier results of batches are replaced.
    """
    _refuse_mixture(spark, root, None)
    assigned = read_table(spark, root, BATCHES).select("site_id", "run_id")
    stored = measurements.read_measurements(spark, measurement_path)

    def write(df: DataFrame, name: str, by: Sequence[str]) -> None:
        keys = ["run_id", *by]
        rows = df.join(assigned, "site_id").repartitionByRange(*keys, "site_id")
        write_table(rows.sortWithinPartitions(*keys, "site_id"), root, name, partition_by=keys)

    def publish(df: DataFrame, name: str) -> None:
        write_result(df.join(assigned, "site_id"), root, name)

    write(direction.daily_and_direction_facts(stored), FACTS, ["kind"])
    frame = read_facts(spark, root, "daily").drop("run_id")
    for grain in GRAINS:
        if grain != "daily":
            write(rollup.roll(frame, grain), COARSER_FACTS[grain], [])
            frame = read_facts(spark, root, grain).drop("run_id")
        publish(rollup.means(frame, grain, direction=grain != "daily"), MEAN_TABLES[grain])
        publish(rollup.total_power(frame, grain), POWER_TABLES[grain])
    sectors = direction.label_sectors(read_facts(spark, root, "direction").drop("run_id"))
    publish(direction.sector_means(sectors), SECTOR_MEAN_TABLE)
    publish(direction.sector_power(sectors), SECTOR_POWER_TABLE)
    done = assigned.select("run_id").distinct().withColumn("done", F.lit(True))
    write_table(done, root, RUNS, partition_by=["run_id"])


def _refuse_mixture(spark: SparkSession, root: str, run_id: int | None) -> None:
    """Batches next to facts of all sites would count their sites twice."""
    if table_exists(spark, root, FACTS):
        of_all = F.col("run_id") == ALL_SITES
        other = read_table(spark, root, FACTS).where(~of_all if run_id == ALL_SITES else of_all)
        if not other.isEmpty():
            raise ValueError(f"{root} is used for {'batches' if run_id == ALL_SITES else 'all sites'}")


def _write(df: DataFrame, root: str, name: str, run_id: int) -> None:
    """Replace the rows of one batch, or all of them."""
    if run_id == ALL_SITES:
        write_result(df.withColumn("run_id", F.lit(ALL_SITES)), root, name)
    else:
        replace_run(df, root, name, run_id)


def read_facts(spark: SparkSession, root: str, kind: str, run_id: int | None = None) -> DataFrame:
    """Stored facts, ``daily``, ``monthly``, ``yearly`` or ``direction``, of one batch or of all."""
    if kind in COARSER_FACTS:
        rows = read_table(spark, root, COARSER_FACTS[kind])
    else:
        rows = read_table(spark, root, FACTS).where(F.col("kind") == kind)
    return rows if run_id is None else rows.where(F.col("run_id") == run_id)


def write_rollups(spark: SparkSession, root: str, run_id: int = ALL_SITES) -> None:
    """Means and power totals by day, month and year, from the stored daily facts.

    The facts of each grain are stored, too, so that none is aggregated twice.
    """
    frame = read_facts(spark, root, "daily", run_id)
    for grain in GRAINS:
        if grain != "daily":
            coarser = rollup.roll(frame, grain)
            write_table(coarser, root, f"{COARSER_FACTS[grain]}/run_id={run_id}")
            frame = read_facts(spark, root, grain, run_id)
        averages = rollup.means(frame, grain, direction=grain != "daily")
        _write(averages, root, MEAN_TABLES[grain], run_id)
        powers = rollup.total_power(frame, grain)
        _write(powers, root, POWER_TABLES[grain], run_id)


def write_directions(spark: SparkSession, root: str, run_id: int = ALL_SITES) -> None:
    """Means and power totals per wind direction sector, from the stored direction facts."""
    frame = direction.label_sectors(read_facts(spark, root, "direction", run_id))
    _write(direction.sector_means(frame), root, SECTOR_MEAN_TABLE, run_id)
    _write(direction.sector_power(frame), root, SECTOR_POWER_TABLE, run_id)


def score_sites(
    spark: SparkSession,
    root: str,
    first_year: int = score.FIRST_YEAR,
    last_year: int = score.LAST_YEAR,
) -> None:
    """Score all sites, of all batches, relative to each other.

    Refused while batches are missing: the scores of the others would look like those of all.
    """
    if table_exists(spark, root, BATCHES):
        runs = read_table(spark, root, RUNS).select("run_id")
        if runs.where(F.col("run_id") == ALL_SITES).isEmpty():
            missing = read_table(spark, root, BATCHES).join(runs, "run_id", "left_anti")
            n_sites, n_runs = missing.agg(F.count(F.lit(1)), F.count_distinct("run_id")).first()
            if n_runs:
                raise ValueError(f"{n_runs} batches with {n_sites} sites are not processed")
    yearly = read_facts(spark, root, "yearly")
    averages = score.avg_annual_power(yearly, first_year, last_year)
    write_table(score.site_score(averages), root, SITE_SCORE)
