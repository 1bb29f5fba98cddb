"""Wind data derived from the tables of the test data.

Each view is one text that Spark and DuckDB both understand; ``{table}`` stands for a table.
Values are not rounded on purpose, some keys and measures are NULL, and directions cover all
sectors and 360.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from sitewind.schemas import SITE_3TIER, SITE_GEO, SITE_TIMEZONE

VIEWS = {
    "raw_measurement": """
        select l_suppkey as site_id, l_shipdate as datetime,
               1e0 + l_discount / 3 as density,
               l_extendedprice * (1 - l_discount) as power,
               9e1 + l_quantity / 7 as pressure,
               28e1 + l_tax * 100 / 3 as temperature,
               cast((l_partkey * 7 + l_linenumber) % 361 as double) as wind_direction,
               case when l_orderkey % 97 = 0 then null
                    else l_quantity * (1 + l_tax) / 3 end as wind_speed
        from {lineitem}""",
    "raw_event_measurement": """
        select user_id as site_id, ts as datetime,
               value / 7 as density, value * 1e2 / 3 as power, value / 3 as pressure,
               value / 11 as temperature,
               cast((event_id * 7) % 361 as double) as wind_direction, value / 9 as wind_speed
        from {events}""",
    "site_timezone": """
        select nullif(s.s_suppkey, 3) as site_id, substr(r.r_name, 1, 3) as abbreviation,
               'C' as countryCode,
               case when s.s_suppkey % 13 = 0 then null else r.r_name end as countryName,
               substr(n.n_name, 1, 3) as nextAbbreviation,
               cast('2007-01-01 00:00:00' as timestamp) as timestamp, '1' as dst,
               cast('2007-03-11 10:00:00' as timestamp) as dstStart,
               cast('2007-11-04 09:00:00' as timestamp) as dstEnd,
               cast(-3600 * (4 + s.s_nationkey % 5) as int) as gmtOffset
        from {supplier} s join {nation} n on s.s_nationkey = n.n_nationkey
             join {region} r on n.n_regionkey = r.r_regionkey""",
    "site_3tier": """
        select s.s_suppkey as site_id, s.s_suppkey + 1 as gid,
               case when s.s_suppkey % 11 = 0 then null
                    else (s.s_suppkey % 100) / 1e2 end as fraction_of_usable_area,
               cast(s.s_suppkey % 4 as int) as power_curve, s.s_acctbal as capacity,
               5e0 + (s.s_suppkey % 50) / 1e1 as wind_speed,
               (s.s_suppkey % 60) / 1e2 as capacity_factor, s.s_name as city,
               case when s.s_suppkey % 19 = 0 then null else n.n_name end as state,
               r.r_name as country, concat('geom', cast(s.s_suppkey as string)) as the_geom
        from {supplier} s join {nation} n on s.s_nationkey = n.n_nationkey
             join {region} r on n.n_regionkey = r.r_regionkey""",
    "site_geo": """
        select s_suppkey as site_id, 25e0 + (s_suppkey * 37 % 2500) / 1e2 as lat,
               -125e0 + (s_suppkey * 91 % 5800) / 1e2 as lon
        from {supplier} where s_suppkey % 17 <> 5""",
    "state_lookup": """
        select concat('S', cast(n_nationkey as string)) as code, n_name as name from {nation}
        union all select 'ALL' as code, 'All' as name""",
    "forecast_text": """
        select cast(o_custkey as string) as site_id, cast(o_orderdate as string) as ts_text,
               cast(o_totalprice as string) as day_ahead_power,
               cast(o_totalprice / 24 as string) as hour_ahead_power,
               cast(o_totalprice / 6 as string) as h4_ahead_power,
               cast(o_totalprice / 4 as string) as h6_ahead_power,
               cast(o_totalprice * 9 / 10 as string) as day_ahead_power_p90
        from {orders}""",
}

# Rows in which a part of the values is 1e16 and more.
VIEWS["large_measurement"] = """
        select l_suppkey as site_id, l_shipdate as datetime, 1e0 as density,
               case when l_orderkey % 5 = 0 then l_extendedprice * 1e13
                    else l_extendedprice * (1 - l_discount) end as power,
               9e1 as pressure, 28e1 as temperature, 1e0 as wind_direction, 1e0 as wind_speed
        from {lineitem}"""


# Sites with the names of real states.
VIEWS["site_us_state"] = """
        select s_suppkey as site_id,
               case s_nationkey % 4 when 0 then 'Iowa' when 1 then 'Texas' when 2 then 'All'
                    else null end as us_state
        from {supplier}"""


def _as_text(name: str, columns: list[str]) -> str:
    texts = ", ".join(f"cast({column} as string) as {column}" for column in columns)
    return f"select {texts} from ({VIEWS[name]}) typed"


# The site files as they are read, all columns text.
VIEWS["site_timezone_text"] = _as_text("site_timezone", SITE_TIMEZONE.names)
VIEWS["site_3tier_text"] = _as_text("site_3tier", SITE_3TIER.names)
VIEWS["site_geo_text"] = _as_text("site_geo", SITE_GEO.names)


def _tables(name: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", VIEWS[name])))


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A view over the Parquet tables in ``folder``."""
    tables = {table: spark.read.parquet(f"{folder}/{table}.parquet") for table in _tables(name)}
    return spark.sql(VIEWS[name], **tables)


def view_sql(name: str) -> str:
    """The same view as SQL over tables of the same names."""
    return VIEWS[name].format(**{table: table for table in _tables(name)})
