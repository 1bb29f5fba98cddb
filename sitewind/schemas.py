"""Column types of inputs and result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

_LONG, _INT, _DOUBLE, _TEXT, _TIME = (
    LongType(), IntegerType(), DoubleType(), StringType(), TimestampType(),
)


def _schema(**columns) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# Measures that are averaged; the direction is an angle and is treated apart.
MEASURES = ["density", "power", "pressure", "temperature", "wind_speed"]
ATTRIBUTES = ["density", "power", "pressure", "temperature", "wind_direction", "wind_speed"]

MEASUREMENT = _schema(site_id=_LONG, datetime=_TIME, **{name: _DOUBLE for name in ATTRIBUTES})

# In the stored dataset, times are UTC clock times.
STORED_MEASUREMENT = _schema(
    site_id=_LONG, datetime=TimestampNTZType(), **{name: _DOUBLE for name in ATTRIBUTES},
    site_block=_LONG,
)

SITE_TIMEZONE = _schema(
    site_id=_LONG, abbreviation=_TEXT, countryCode=_TEXT, countryName=_TEXT,
    nextAbbreviation=_TEXT, timestamp=_TIME, dst=_TEXT, dstStart=_TIME, dstEnd=_TIME,
    gmtOffset=_INT,
)

SITE_3TIER = _schema(
    site_id=_LONG, gid=_LONG, fraction_of_usable_area=_DOUBLE, power_curve=_INT,
    capacity=_DOUBLE, wind_speed=_DOUBLE, capacity_factor=_DOUBLE, city=_TEXT, state=_TEXT,
    country=_TEXT, the_geom=_TEXT,
)

SITE_GEO = _schema(site_id=_LONG, lat=_DOUBLE, lon=_DOUBLE)

SITE_INFO = _schema(
    site_id=_LONG, gid=_LONG, fraction_of_usable_area=_DOUBLE, power_curve=_INT,
    capacity=_DOUBLE, wind_speed=_DOUBLE, capacity_factor=_DOUBLE, city=_TEXT, state=_TEXT,
    country=_TEXT, abbreviation=_TEXT, country_code=_TEXT, next_abbreviation=_TEXT,
    timestamp=_TIME, dst=_TEXT, dst_start=_TIME, gmt_offset=_INT, dst_end=_TIME,
    the_geom=_TEXT, lat=_DOUBLE, lon=_DOUBLE,
)

FORECAST = _schema(
    site_id=_LONG, ts=_TIME, day_ahead_power=_DOUBLE, hour_ahead_power=_DOUBLE,
    h4_ahead_power=_DOUBLE, h6_ahead_power=_DOUBLE, day_ahead_power_p90=_DOUBLE,
)
# Forecast file headers that are renamed: they start with a digit or are mixed case.
FORECAST_HEADERS = {
    "ts": "TimeStamp",
    "h4_ahead_power": "4_hour_ahead_power",
    "h6_ahead_power": "6_hour_ahead_power",
}

_MEANS = {f"avg_{name}": _DOUBLE for name in MEASURES}
_DAY = dict(site_id=_LONG, year=_INT, month=_INT, day=_INT)
_MONTH = dict(site_id=_LONG, year=_INT, month=_INT)
_YEAR = dict(site_id=_LONG, year=_INT)
_SECTOR = dict(wind_direction=_TEXT, month=_INT, year=_INT, site_id=_LONG)

RESULT_TABLES = {
    "site_info": SITE_INFO,
    "site_avg_daily_capacity": _schema(**_DAY, **_MEANS),
    "site_avg_monthly_capacity": _schema(**_MONTH, **_MEANS, mean_direction=_DOUBLE),
    "site_avg_yearly_capacity": _schema(**_YEAR, **_MEANS, mean_direction=_DOUBLE),
    "site_total_daily_capacity": _schema(**_DAY, daily_power=_DOUBLE),
    "site_total_monthly_capacity": _schema(**_MONTH, monthly_power=_DOUBLE),
    "site_total_yearly_capacity": _schema(**_YEAR, yearly_power=_DOUBLE),
    "site_score": _schema(site_id=_LONG, avg_power=_DOUBLE, site_score=_LONG),
    "site_avg_wind_dir": _schema(**_SECTOR, **_MEANS),
    "site_tot_power_wind_dir": _schema(**_SECTOR, total_power=_DOUBLE),
}


_NUMBER = r"^\s*[+-]?\d+(\.\d*)?\s*$"


def _cast(text: Column, kind: DataType) -> Column:
    """Text as a value of the given type, NULL if it cannot be read as one.

    A number is a time in seconds since 1970, and gives its whole part where an integer is
    wanted: a file may hold either form.
    """
    number = F.when(text.rlike(_NUMBER), text.try_cast("double"))
    if isinstance(kind, TimestampType):
        return F.when(number.isNotNull(), number.try_cast(kind)).otherwise(text.try_cast(kind))
    if isinstance(kind, (IntegerType, LongType)):
        return F.coalesce(text.try_cast(kind), number.try_cast(kind))
    return text.try_cast(kind)


def typed(df: DataFrame, schema: StructType, headers: dict[str, str] | None = None) -> DataFrame:
    """Project text columns, matched by name, onto ``schema``; unreadable text becomes NULL."""
    headers = headers or {}
    return df.select(*[
        _cast(F.col(f"`{headers.get(field.name, field.name)}`"), field.dataType).alias(field.name)
        for field in schema
    ])
