"""Measurements by wind direction sector."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewind.functions import numbers, wind
from sitewind.operators import rollup

_KEYS = ["wind_direction", "month", "year", "site_id"]


def _with_sector(measurements: DataFrame) -> DataFrame:
    found = measurements.where(wind.in_a_sector(F.col("wind_direction")))
    return rollup.scaled_measurements(found)


def sector_counts(measurements: DataFrame) -> DataFrame:
    """Number of measurements in each sector; those outside every sector are left out."""
    counts = (
        _with_sector(measurements)
        .groupBy("sector")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.select(wind.sector_label(F.col("sector")).alias("wind_direction"), "n")


def direction_facts(measurements: DataFrame) -> DataFrame:
    """Totals and counts per sector, month and site: one pass for both tables below."""
    grouped = (
        _with_sector(measurements)
        .groupBy("site_id", "year", "month", "sector")
        .agg(*rollup.measure_totals())
    )
    return label_sectors(grouped)


def label_sectors(grouped: DataFrame) -> DataFrame:
    label = wind.sector_label(F.col("sector")).alias("wind_direction")
    rest = [name for name in grouped.columns if name not in ("sector", *_KEYS)]
    return grouped.select(label, *_KEYS[1:], *rest)


def sector_means(frame: DataFrame) -> DataFrame:
    return frame.select(*_KEYS, *rollup.mean_columns())


def sector_power(frame: DataFrame) -> DataFrame:
    return frame.select(*_KEYS, numbers.total("total_power").alias("total_power"))


def daily_and_direction_facts(measurements: DataFrame) -> DataFrame:
    """Daily facts and direction facts from a single scan, told apart by column ``kind``.

    Rows of kind ``daily`` have a date, rows of kind ``direction`` a sector.
    """
    scaled = rollup.scaled_measurements(measurements)
    by_day = ["site_id", "date"]
    by_sector = ["site_id", "year", "month", "sector"]
    columns = ["site_id", "date", "year", "month", "sector"]
    grouped = scaled.groupingSets(
        [[F.col(name) for name in by_day], [F.col(name) for name in by_sector]], *columns
    ).agg(F.grouping("sector").alias("without_sector"), *rollup.all_totals())
    daily = F.col("without_sector") == 1
    return (
        grouped.where(daily | F.col("sector").isNotNull())
        .withColumn("kind", F.when(daily, F.lit("daily")).otherwise(F.lit("direction")))
        .withColumn("year", F.when(daily, F.year("date")).otherwise(F.col("year")))
        .withColumn("month", F.when(daily, F.month("date")).otherwise(F.col("month")))
        .withColumn("day", F.dayofmonth("date"))
        .drop("without_sector", "date")
    )
