"""Splitting the sites into batches that each hold sites of all states in turn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitewind.operators.ordinal import running_total
from sitewind.operators.sites import first_rows
from sitewind.sources.measurements import in_blocks_of, site_block

SITES_PER_BATCH = 50

# Copies of one site row are spread over tasks in pieces of this many.
_COPIES_PER_PIECE = 65_536


def _numbered(sites: DataFrame, order: Column) -> DataFrame:
    """Rows ``(site_id, state)`` with their ``place`` in the order of their state, from 0."""
    listed = sites.groupBy("state", "site_id").agg(F.count(F.lit(1)).alias("copies"))
    placed = running_total(
        listed.withColumn("order", order), ["state", "order"], F.col("copies"), "place",
        within=["state"],
    )
    # One row per copy, in pieces so that no task makes all copies of a site.
    end = F.col("place") + F.col("copies") - 1
    pieces = placed.select(
        "site_id", "state", end.alias("end"),
        F.explode(F.sequence("place", end, F.lit(_COPIES_PER_PIECE))).alias("start"),
    ).repartition("state", "start")
    piece_end = F.least(F.col("start") + F.lit(_COPIES_PER_PIECE - 1), F.col("end"))
    return pieces.select(
        "site_id", "state", F.explode(F.sequence("start", piece_end)).alias("place")
    )


def state_members(sites: DataFrame) -> DataFrame:
    """The site list of each state as rows ``(state, place, site_id)``, ordered by site id.

    Rows instead of arrays, because a state may hold any number of sites.
    """
    return _numbered(sites, F.col("site_id")).select("state", "place", "site_id")


def assign_batches(sites: DataFrame, size: int = SITES_PER_BATCH) -> DataFrame:
    """Position and batch of every site, as ``(site_id, state, pos, run_id)``.

    States take turns, in the order of their smallest site id, and each gives its remaining site
    with the largest id; a state that has run out is skipped. NULL is a state of its own. The
    sequence counts from 0 and is cut into batches of ``size`` numbered from 1; a site listed
    several times is placed as often.
    """
    if size < 1:
        raise ValueError("a batch needs at least one site")
    first = sites.groupBy("state").agg(F.min("site_id").alias("first_id"))
    turns = _numbered(sites, -F.col("site_id")).withColumnRenamed("place", "turn")
    turns = turns.join(
        first.withColumnRenamed("state", "of_state"), F.col("state").eqNullSafe(F.col("of_state"))
    ).drop("of_state")
    sequence = running_total(turns, ["turn", "first_id", "state"], F.lit(1), "pos")
    return sequence.select(
        "site_id", "state", "pos",
        (F.call_function("div", F.col("pos"), F.lit(size)) + 1).alias("run_id"),
    )


def batch_state_counts(batches: DataFrame, sites: DataFrame) -> DataFrame:
    """Sites of each state within each batch, and the number of states in the batch.

    The state is that of the first row of the site; NULL counts as one state.
    """
    state = first_rows(sites.select("site_id", "state"))
    counts = (
        batches.select("site_id", "run_id")
        .join(state, "site_id")
        .groupBy("run_id", "state")
        .agg(F.count(F.lit(1)).alias("n_sites"))
    )
    # One row per state: a batch has no more of them than sites.
    states = F.count(F.lit(1)).over(Window.partitionBy("run_id"))
    return counts.select("run_id", "state", "n_sites", states.alias("n_states"))


def batch_measurements(measurements: DataFrame, batches: DataFrame, run_id: int) -> DataFrame:
    """Measurements of the sites of one batch.

    Where the measurements come in blocks of sites, only the folders of the batch's blocks are read:
    they are found at run time. Of a stored list Spark knows the size, and sends a small one to the
    tasks that read the measurements.
    """
    sites = batches.where(F.col("run_id") == run_id).select("site_id")
    return in_sites(measurements, sites)


def with_run_id(measurements: DataFrame, batches: DataFrame) -> DataFrame:
    """Measurements with the batch their site belongs to, those of unlisted sites left out."""
    return measurements.join(batches.select("site_id", "run_id").distinct(), "site_id")


def in_sites(measurements: DataFrame, sites: DataFrame) -> DataFrame:
    """Measurements of the sites listed in a frame, from the folders of their blocks alone."""
    pruned, keys = in_blocks_of(measurements, sites), ["site_id"]
    wanted = sites.select("site_id")
    if "site_block" in measurements.columns:
        wanted = wanted.withColumn("site_block", site_block(F.col("site_id")))
        keys = ["site_block", "site_id"]
    return pruned.join(wanted, keys, "left_semi").select(*measurements.columns)
