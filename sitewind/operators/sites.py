"""The site dimension."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewind import schemas


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def build_site_info(
    site_timezone: DataFrame, site_3tier: DataFrame, site_geo: DataFrame
) -> DataFrame:
    """Sites present in all three inputs, with the 21 columns of ``site_info``."""
    renamed = site_timezone.withColumnsRenamed({
        "countryCode": "country_code",
        "nextAbbreviation": "next_abbreviation",
        "dstStart": "dst_start",
        "dstEnd": "dst_end",
        "gmtOffset": "gmt_offset",
    })
    joined = renamed.join(site_3tier, "site_id").join(site_geo, "site_id")
    return joined.select(schemas.SITE_INFO.names)


def unmatched_sites(
    site_timezone: DataFrame, site_3tier: DataFrame, site_geo: DataFrame
) -> DataFrame:
    """Rows of each input that :func:`build_site_info` loses, as ``(source, n_rows)``."""
    inputs = {"site_timezone": site_timezone, "site_3tier": site_3tier, "site_geo": site_geo}
    ids = union_all([
        df.select("site_id", F.lit(name).alias("source")) for name, df in inputs.items()
    ])
    per_site = ids.groupBy("site_id").agg(*[
        F.count_if(F.col("source") == name).alias(name) for name in inputs
    ])
    matched = F.col("site_id").isNotNull()
    for name in inputs:
        matched = matched & (F.col(name) > 0)
    lost = per_site.agg(*[
        F.coalesce(F.sum(F.when(~matched, F.col(name))), F.lit(0)).alias(name) for name in inputs
    ])
    return lost.unpivot([], list(inputs), "source", "n_rows")


def site_countries(site_timezone: DataFrame) -> DataFrame:
    """Distinct pairs of site and country, sites without an id left out."""
    return (
        site_timezone.where(F.col("site_id").isNotNull())
        .select("site_id", F.col("countryName").alias("country_name"))
        .distinct()
    )


def site_count(sites: DataFrame) -> DataFrame:
    return sites.agg(F.count(F.lit(1)).alias("n"))


def first_rows(sites: DataFrame) -> DataFrame:
    """One row per site: the smallest in column order, where a site has several. A known value
    comes before NULL."""
    others = [name for name in sites.columns if name != "site_id"]
    # NULL is the smallest of all, so whether a value is missing is compared first.
    order = [part for name in others for part in (F.isnull(name).alias(f"no_{name}"), F.col(name))]
    smallest = F.struct(*[F.min(F.struct(*order))[name].alias(name) for name in others]).alias("row")
    return sites.groupBy("site_id").agg(smallest).select("site_id", "row.*")


def sites_per_state(sites: DataFrame) -> DataFrame:
    """Number of sites of each state with the first and last id. NULL is a state of its own."""
    return sites.groupBy("state").agg(
        F.count(F.lit(1)).alias("n_sites"),
        F.min("site_id").alias("first_site_id"),
        F.max("site_id").alias("last_site_id"),
    )


def state_extremes(sites: DataFrame) -> DataFrame:
    """States with the most and the fewest sites, the first by name on ties.

    NULL can be neither, but counts in the number of states.
    """
    counts = sites.groupBy("state").agg(F.count(F.lit(1)).alias("n"))
    named = F.col("state").isNotNull()
    return counts.agg(
        F.min(F.when(named, F.struct((-F.col("n")).alias("minus_n"), "state"))).alias("most"),
        F.min(F.when(named, F.struct("n", "state"))).alias("fewest"),
        F.count(F.lit(1)).alias("n_states"),
    ).select(
        F.col("most.state").alias("max_state"),
        (-F.col("most.minus_n")).alias("max_sites"),
        F.col("fewest.state").alias("min_state"),
        F.col("fewest.n").alias("min_sites"),
        "n_states",
    )
