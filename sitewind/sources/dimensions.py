"""Site dimension and forecast files: comma separated text with a header line.

Columns are found by their header and cast one by one, so no pass over the file is spent on
inferring types and the join key has the same type in every file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewind import schemas


def _text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).csv(path)


def read_site_timezone(spark: SparkSession, path: str) -> DataFrame:
    return schemas.typed(_text(spark, path), schemas.SITE_TIMEZONE)


def read_site_3tier(spark: SparkSession, path: str) -> DataFrame:
    return schemas.typed(_text(spark, path), schemas.SITE_3TIER)


def read_site_geo(spark: SparkSession, path: str) -> DataFrame:
    return schemas.typed(_text(spark, path), schemas.SITE_GEO)


def read_forecast(spark: SparkSession, path: str) -> DataFrame:
    return type_forecast(_text(spark, path), schemas.FORECAST_HEADERS)


def type_forecast(text: DataFrame, headers: dict[str, str] | None = None) -> DataFrame:
    """Forecast columns given as text, in their proper types; ``headers`` maps our column names
    to those of ``text`` where they differ."""
    return schemas.typed(text, schemas.FORECAST, headers)


def site_ids_from_gid(site_3tier: DataFrame) -> DataFrame:
    """Site ids count from 0, grid ids from 1."""
    return site_3tier.select((F.col("gid") - 1).alias("site_id"))
