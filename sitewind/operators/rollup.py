"""Measurements rolled up to day, month and year.

A facts frame holds, per site and period, the exact total and the number of values of each
measure. It is made in one pass over the measurements with one shuffle, of rows that were
already aggregated in the scanning tasks, and every mean and total is read off it. Facts of a
coarser grain come from finer facts without going back to the measurements.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewind.functions import numbers, wind
from sitewind.functions.calendar import grain_columns, utc_date
from sitewind.schemas import ATTRIBUTES, MEASURES

_DIRECTION_TOTALS = ["total_sine", "total_cosine"]


def prepare_measurements(measurements: DataFrame) -> DataFrame:
    """Measures rounded to 2 places, with the parts of the UTC calendar day."""
    date = utc_date(measurements, "datetime")
    return measurements.select(
        "site_id",
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        F.dayofmonth(date).alias("day"),
        *[numbers.rounded(F.col(name)).alias(name) for name in ATTRIBUTES],
    )


def scaled_measurements(measurements: DataFrame) -> DataFrame:
    """What the aggregates read: rounded measures, the UTC date, and the sector."""
    date = utc_date(measurements, "datetime")
    rounded = measurements.select(
        "site_id",
        date.alias("date"),
        *[numbers.rounded(F.col(name)).alias(name) for name in ATTRIBUTES],
    )
    scaled = rounded.select(
        "site_id",
        "date",
        *MEASURES,
        numbers.small_hundredths(F.col("wind_direction")).alias("direction"),
    )
    direction = F.col("direction")
    return scaled.select(
        "site_id",
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        *MEASURES,
        wind.sector_index(direction).alias("sector"),
        wind.direction_sine(direction).alias("sine"),
        wind.direction_cosine(direction).alias("cosine"),
    )


def measure_totals() -> list[Column]:
    """Aggregates over :func:`scaled_measurements`: total and count of each measure."""
    return [
        *[part for name in MEASURES for part in numbers.total_parts(F.col(name), f"total_{name}")],
        *[F.count(name).alias(f"count_{name}") for name in MEASURES],
    ]


def all_totals() -> list[Column]:
    """The same, with the summed unit vectors of the direction."""
    return [
        *measure_totals(),
        F.sum("sine").alias("total_sine"),
        F.sum("cosine").alias("total_cosine"),
    ]


def facts(measurements: DataFrame, grain: str) -> DataFrame:
    """Totals and counts per site and period, straight from the measurements."""
    columns = grain_columns(grain)
    scaled = scaled_measurements(measurements)
    aggregates = all_totals()
    if grain != "daily":
        return scaled.groupBy("site_id", *columns).agg(*aggregates)
    # The date is one narrow key instead of three.
    daily = scaled.groupBy("site_id", "date").agg(*aggregates)
    return _split_date(daily)


def _split_date(daily: DataFrame) -> DataFrame:
    rest = [name for name in daily.columns if name not in ("site_id", "date")]
    return daily.select(
        "site_id",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        *rest,
    )


def roll(finer: DataFrame, grain: str) -> DataFrame:
    """Facts of a coarser grain from finer facts."""
    return finer.groupBy("site_id", *grain_columns(grain)).agg(
        *[part for name in MEASURES for part in numbers.sum_of_totals(f"total_{name}")],
        *[F.sum(f"count_{name}").alias(f"count_{name}") for name in MEASURES],
        *[F.sum(name).alias(name) for name in _DIRECTION_TOTALS],
    )


def mean_columns() -> list[Column]:
    return [
        numbers.mean(f"total_{name}", F.col(f"count_{name}")).alias(f"avg_{name}")
        for name in MEASURES
    ]


def _mean_direction() -> Column:
    return wind.mean_direction(F.col("total_sine"), F.col("total_cosine")).alias("mean_direction")


def means(frame: DataFrame, grain: str, direction: bool = False) -> DataFrame:
    """Mean of all samples of the period, per measure; on request with the mean direction."""
    extra = [_mean_direction()] if direction else []
    return frame.select("site_id", *grain_columns(grain), *mean_columns(), *extra)


def mean_directions(frame: DataFrame, grain: str) -> DataFrame:
    """Direction of the summed unit vectors of all samples of the period."""
    return frame.select("site_id", *grain_columns(grain), _mean_direction())


def total_power(frame: DataFrame, grain: str) -> DataFrame:
    """Sum of the power samples of the period, as ``daily_power``, ``monthly_power`` or
    ``yearly_power``."""
    total = numbers.total("total_power").alias(f"{grain}_power")
    return frame.select("site_id", *grain_columns(grain), total)
