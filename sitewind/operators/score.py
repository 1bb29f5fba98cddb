"""Score of a site by its mean yearly power, relative to all sites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewind.functions import numbers

FIRST_YEAR = 2009
LAST_YEAR = 2013
BANDS = 10


def avg_annual_power(
    yearly_facts: DataFrame, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR
) -> DataFrame:
    """Mean of the yearly totals over the years a site has, both ends of the window included."""
    return (
        yearly_facts.where(F.col("year").between(first_year, last_year))
        .groupBy("site_id")
        .agg(*numbers.sum_of_totals("total_power"), F.count_if(numbers.has_total("total_power")).alias("n_years"))
        .select("site_id", numbers.mean("total_power", F.col("n_years")).alias("avg_power"))
    )


def site_score(avg_power: DataFrame, bands: int = BANDS) -> DataFrame:
    """Place of each site between the lowest and the highest mean, in bands of equal width.

    The result runs from 0 to ``bands``: the last value is reached only by sites equal to the
    maximum. All sites score 0 if all are equal; a site without a mean has no score. Score all
    sites at once: scores of different batches do not compare.
    """
    # The means are read for the bounds and for the scores. Both read the same shuffled rows, so
    # what they come from, which may be a scan of all measurements, runs once.
    bounds = avg_power.agg(
        F.struct(F.min("avg_power").alias("low"), F.max("avg_power").alias("high"))
    ).scalar()
    low, high = bounds.getField("low"), bounds.getField("high")
    above = F.col("avg_power") - low
    width = (high - low) / F.lit(float(bands))
    band = F.when(width == 0, above).otherwise(F.try_divide(above, width))
    return avg_power.select("site_id", "avg_power", F.floor(band).alias("site_score"))
