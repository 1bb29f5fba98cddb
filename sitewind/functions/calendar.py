"""Calendar days in UTC, and dates made from their parts."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

# Grain -> calendar columns of its tables.
GRAINS = {
    "daily": ["year", "month", "day"],
    "monthly": ["year", "month"],
    "yearly": ["year"],
}

_UTC_NAMES = {"UTC", "GMT", "Z", "Etc/UTC"}


def grain_columns(grain: str) -> list[str]:
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}; use one of {sorted(GRAINS)}")
    return GRAINS[grain]


def utc_time(df: DataFrame, name: str) -> Column:
    """A timestamp column as UTC clock time without a zone, whatever the session time zone is.
    A column that has no zone is taken to be in UTC already."""
    if isinstance(df.schema[name].dataType, TimestampNTZType):
        return F.col(name)
    if df.sparkSession.conf.get("spark.sql.session.timeZone") in _UTC_NAMES:
        return F.col(name).cast("timestamp_ntz")
    # From the instant's microseconds, because a zone may skip an hour or a day that UTC has.
    micros = F.unix_micros(F.col(name))
    day = F.lit(86_400_000_000)
    of_day = F.pmod(micros, day)
    days = F.call_function("div", micros - of_day, day).cast("int")
    seconds = (of_day.cast("decimal(20,0)") * F.lit(Decimal("0.000001"))).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        days=days, secs=seconds
    )


def utc_date(df: DataFrame, name: str) -> Column:
    """UTC calendar day of a timestamp column."""
    return F.to_date(utc_time(df, name))


def utc_literal(df: DataFrame, name: str, text: str) -> Column:
    """A UTC time as a literal of the type of column ``name``, so that comparing the two needs
    no cast on the column and can be pushed to the files."""
    if isinstance(df.schema[name].dataType, TimestampNTZType):
        return F.lit(text).cast("timestamp_ntz")
    return F.lit(f"{text}Z" if len(text) > 10 else f"{text} 00:00:00Z").cast("timestamp")


def start_date(grain: str) -> Column:
    """First day of the period a row of the given grain stands for."""
    parts = [F.col(name) for name in grain_columns(grain)]
    return F.make_date(*parts, *[F.lit(1)] * (3 - len(parts)))
