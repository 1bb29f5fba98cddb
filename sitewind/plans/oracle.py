"""The queries of the catalogue as SQL, written separately from the DataFrame code.

Each query states the whole computation over the given tables. Two-place rounding goes through
the decimal text of a value, which is what rounding half-up means in the package.
"""

from __future__ import annotations

from sitewind.plans.catalogue import BATCH_SIZE, SCORE_YEARS, SITE_ID, STATE_CODE, WINDOW
from sitewind.plans.views import VIEWS, view_sql

# The measures, and the direction among them, as the tables name them.
MEASURES = ["density", "power", "pressure", "temperature", "wind_speed"]
ATTRIBUTES = ["density", "power", "pressure", "temperature", "wind_direction", "wind_speed"]

_FIRST, _LAST = SCORE_YEARS


def _prepared(raw: str) -> str:
    measures = ", ".join(
        f"cast(cast({name} as varchar) as decimal(18,2)) as {name}" for name in ATTRIBUTES
    )
    return f"""
        select site_id, cast(year(datetime) as integer) as year,
               cast(month(datetime) as integer) as month,
               cast(day(datetime) as integer) as day, {measures}
        from {raw}"""


_MEANS = ", ".join(
    f"cast(sum({name}) as double) / nullif(count({name}), 0) as avg_{name}" for name in MEASURES
)

# Sectors clockwise: exact multiples of 45 degrees, and what lies between two of them.
_SECTOR_NUMBER = """
        case when wind_direction >= 0 and wind_direction < 360
             then 2 * cast(floor(cast(wind_direction as double) / 45) as bigint)
                  + case when wind_direction % 45 = 0 then 0 else 1 end end"""
SECTORS = "N NNE NE ENE E ESE SE SSE S SSW SW WSW W WNW NW NNW".split()
_SECTOR_LABEL = "case sector " + " ".join(
    f"when {number} then '{label}'" for number, label in enumerate(SECTORS)
) + " end"

_INFO_COLUMNS = """
        z.site_id, m.gid, m.fraction_of_usable_area, m.power_curve, m.capacity, m.wind_speed,
        m.capacity_factor, m.city, m.state, m.country, z.abbreviation,
        z.countryCode as country_code, z.nextAbbreviation as next_abbreviation, z.timestamp,
        z.dst, z.dstStart as dst_start, z.gmtOffset as gmt_offset, z.dstEnd as dst_end,
        m.the_geom, g.lat, g.lon"""

# Named pieces the queries below are put together from; each may use those before it.
_PIECES = {
    **{name: view_sql(name) for name in VIEWS},
    "prepared": _prepared("raw_measurement"),
    "prepared_events": _prepared("raw_event_measurement"),
    "daily_power": """
        select site_id, year, month, day, sum(power) as total from prepared_events
        group by site_id, year, month, day""",
    "daily_speed": """
        select site_id, year, month, day,
               cast(sum(wind_speed) as double) / nullif(count(wind_speed), 0) as mean
        from prepared_events group by site_id, year, month, day""",
    "monthly_power": """
        select site_id, year, month, sum(total) as total
        from (select site_id, year, month, day, sum(power) as total from prepared
              group by site_id, year, month, day) group by site_id, year, month""",
    "monthly_speed": """
        select site_id, year, month,
               cast(sum(wind_speed) as double) / nullif(count(wind_speed), 0) as mean
        from prepared group by site_id, year, month""",
    "yearly_power": """
        select site_id, year, sum(total) as total from monthly_power group by site_id, year""",
    "yearly_speed": """
        select site_id, year,
               cast(sum(wind_speed) as double) / nullif(count(wind_speed), 0) as mean
        from prepared group by site_id, year""",
    "annual": f"""
        select site_id, cast(sum(total) as double) / nullif(count(total), 0) as avg_power
        from yearly_power where year between {_FIRST} and {_LAST} group by site_id""",
    "bounds": "select min(avg_power) as low, max(avg_power) as high from annual",
    "score": """
        select site_id, avg_power,
               cast(case when high = low then avg_power - low
                    else floor((avg_power - low) / ((high - low) / 1e1)) end as bigint)
               as site_score
        from annual, bounds""",
    "info": f"""
        select {_INFO_COLUMNS}
        from site_timezone z join site_3tier m on z.site_id = m.site_id
             join site_geo g on z.site_id = g.site_id""",
    "scored": """
        select info.site_id, site_score, state, fraction_of_usable_area, lat, lon
        from info, score where info.site_id = score.site_id""",
    "named": """
        select scored.* exclude (state), us_state as state
        from scored join site_us_state using (site_id)""",
    "sectors": f"select *, {_SECTOR_NUMBER} as sector from prepared",
    "labelled": f"""
        select {_SECTOR_LABEL} as label, * from sectors where sector is not null""",
    "sector_power": """
        select label as wind_direction, month, year, site_id,
               cast(sum(power) as double) as total_power
        from labelled group by label, month, year, site_id""",
    "vectors": """
        select site_id, year, month,
               cast(sum(cast(floor(sin(radians(cast(wind_direction as double))) * 1e6 + 5e-1)
                    as bigint)) as double) as s,
               cast(sum(cast(floor(cos(radians(cast(wind_direction as double))) * 1e6 + 5e-1)
                    as bigint)) as double) as c
        from prepared group by site_id, year, month""",
    "turns": """
        select site_id, state, row_number() over (partition by state order by site_id desc) as k,
               min(site_id) over (partition by state) as first_id
        from site_3tier""",
    "placed": """
        select site_id, state, row_number() over (order by k, first_id) - 1 as pos from turns""",
    "batches": f"""
        select site_id, state, cast(pos as bigint) as pos,
               cast(pos // {BATCH_SIZE} + 1 as bigint) as run_id
        from placed""",
    "state_counts": "select state, count(*) as n from site_3tier group by state",
}

_USES = {
    "prepared": ["raw_measurement"],
    "prepared_events": ["raw_event_measurement"],
    "daily_power": ["prepared_events"],
    "daily_speed": ["prepared_events"],
    "monthly_power": ["prepared"],
    "monthly_speed": ["prepared"],
    "yearly_power": ["monthly_power"],
    "yearly_speed": ["prepared"],
    "annual": ["yearly_power"],
    "bounds": ["annual"],
    "score": ["bounds"],
    "info": ["site_timezone", "site_3tier", "site_geo"],
    "scored": ["info", "score"],
    "named": ["scored", "site_us_state"],
    "sectors": ["prepared"],
    "labelled": ["sectors"],
    "sector_power": ["labelled"],
    "vectors": ["prepared"],
    "turns": ["site_3tier"],
    "placed": ["turns"],
    "batches": ["placed"],
    "state_counts": ["site_3tier"],
}


def _needed(names: list[str]) -> set[str]:
    needed = set()
    for name in names:
        needed |= {name} | _needed(_USES.get(name, []))
    return needed


def _with(names: list[str], body: str) -> str:
    needed = _needed(names)
    pieces = [f"{name} as ({text})" for name, text in _PIECES.items() if name in needed]
    return f"with {', '.join(pieces)} {body}"


def _averages(source: str, columns: str) -> str:
    return _with(
        [source], f"select site_id, {columns}, {_MEANS} from {source} group by site_id, {columns}"
    )


def _totals(piece: str, columns: str, name: str) -> str:
    return _with([piece], f"select site_id, {columns}, cast(total as double) as {name} from {piece}")


def _chart(piece: str, date: str, value: str) -> str:
    return _with(
        [piece],
        f"""select site_id, make_date({date}) as date, {value} as value from {piece}
            where site_id in (select site_id from {piece} where {value} is not null)""",
    )


_ONE_DAY_MONTH = "cast(year as bigint), cast(month as bigint), 1"

_LOST = """
    select '{0}' as source, cast(count(*) as bigint) as n_rows from {0} t
    where t.site_id is null
       or not exists (select 1 from {1} a where a.site_id = t.site_id)
       or not exists (select 1 from {2} b where b.site_id = t.site_id)"""


def oracle_sql() -> dict[str, str]:
    doubles = ", ".join(f"cast({name} as double) as {name}" for name in ATTRIBUTES)
    sql = {
        "prepared_measurements": _with(
            ["prepared"], f"select site_id, year, month, day, {doubles} from prepared"
        ),
        "daily_avg": _averages("prepared_events", "year, month, day"),
        "monthly_avg": _averages("prepared", "year, month"),
        "yearly_avg": _averages("prepared", "year"),
        "daily_power": _totals("daily_power", "year, month, day", "daily_power"),
        "monthly_power": _totals("monthly_power", "year, month", "monthly_power"),
        "yearly_power": _totals("yearly_power", "year", "yearly_power"),
        "monthly_power_rolled": _totals("monthly_power", "year, month", "monthly_power"),
        "yearly_power_rolled": _totals("yearly_power", "year", "yearly_power"),
        "monthly_avg_rolled": _averages("prepared", "year, month"),
        "yearly_power_large": _with(
            ["large_measurement"],
            """select site_id, cast(year(datetime) as integer) as year,
                      -- by its text, as the nearest double
                      cast(cast(sum(
                          case when power >= 1e16 then cast(cast(power as hugeint) as decimal(38,2))
                               else cast(cast(power as varchar) as decimal(38,2)) end
                      ) as varchar) as double) as yearly_power
               from large_measurement group by 1, 2""",
        ),
        "batch_filter": _with(
            ["raw_measurement", "batches"],
            """select * from raw_measurement
               where site_id in (select site_id from batches where run_id = 1)""",
        ),
        "site_power_series": _with(
            ["monthly_power"],
            f"""select site_id, year, month, cast(total as double) as monthly_power
                from monthly_power where site_id = {SITE_ID}""",
        ),
        "power_of_some_sites": _with(
            ["yearly_power"],
            f"""select site_id, year, cast(total as double) as yearly_power
                from yearly_power where site_id in ({SITE_ID}, {SITE_ID + 1})""",
        ),
        "map_has_data": _with(
            ["scored"],
            """select count(*) > 0 as has_data from scored
               where state is not null and lat is not null and lon is not null""",
        ),
        "site_timezone_typed": _with(["site_timezone"], "select * from site_timezone"),
        "site_3tier_typed": _with(["site_3tier"], "select * from site_3tier"),
        "site_geo_typed": _with(["site_geo"], "select * from site_geo"),
        "stored_measurements": _with(
            ["raw_measurement"], "select *, site_id // 500 as site_block from raw_measurement"
        ),
        "stored_site_series": _with(
            ["raw_measurement"],
            f"""select site_id, datetime, power from raw_measurement
                where site_id = {SITE_ID}
                  and datetime >= timestamp '{WINDOW[0]}' and datetime < timestamp '{WINDOW[1]}'""",
        ),
        "saved_twice": _with(
            ["site_3tier"],
            """select site_id, state, 2 as step from site_3tier
               union all select site_id, state, 4 as step from site_3tier where state is null""",
        ),
        "replaced_results": _with(
            ["yearly_power", "batches"],
            """select site_id, year, cast(total as double) as yearly_power, run_id,
                      site_id // 500 as site_block
               from yearly_power join (select distinct site_id, run_id from batches) using (site_id)""",
        ),
        "map_sites_by_name": _with(
            ["named"],
            """select site_id, site_score, lat, lon from named
               where state = 'Texas'
                  or not exists (
                       select 1 from named
                       where state = 'Texas' and site_score is not null
                         and fraction_of_usable_area is not null
                         and lat is not null and lon is not null)""",
        ),
        "avg_annual_power": _with(["annual"], "select * from annual"),
        "site_score": _with(["score"], "select * from score"),
        "flagship": _with(
            ["info", "score"],
            "select info.*, avg_power, site_score from info join score using (site_id)",
        ),
        "wind_sector": _with(
            ["labelled"],
            "select label as wind_direction, count(*) as n from labelled group by label",
        ),
        "wind_dir_avg": _with(
            ["labelled"],
            f"""select label as wind_direction, month, year, site_id, {_MEANS}
                from labelled group by label, month, year, site_id""",
        ),
        "wind_dir_power": _with(["sector_power"], "select * from sector_power"),
        "wind_dir_mean": _with(
            ["vectors"],
            """select site_id, year, month,
                      case when s <> 0 or c <> 0 then
                        round(degrees(atan2(s, c))
                              + case when degrees(atan2(s, c)) < 0 then 360e0 else 0e0 end, 2)
                        % 360e0 end as mean_direction
               from vectors""",
        ),
        "daily_and_direction_totals": _with(
            ["sectors"],
            """select 'daily' as kind, site_id, year, month, day,
                      cast(null as bigint) as sector,
                      cast(sum(power) as double) as total_power,
                      count(wind_speed) as n_wind_speed
               from sectors group by site_id, year, month, day
               union all
               select 'direction', site_id, year, month, cast(null as integer), sector,
                      cast(sum(power) as double), count(wind_speed)
               from sectors where sector is not null group by site_id, year, month, sector""",
        ),
        "site_info_join": _with(["info"], "select * from info"),
        "unmatched_sites": _with(
            ["site_timezone", "site_3tier", "site_geo"],
            " union all ".join(
                _LOST.format(*order)
                for order in (
                    ("site_timezone", "site_3tier", "site_geo"),
                    ("site_3tier", "site_timezone", "site_geo"),
                    ("site_geo", "site_timezone", "site_3tier"),
                )
            ),
        ),
        "site_countries": _with(
            ["site_timezone"],
            """select distinct site_id, countryName as country_name from site_timezone
               where site_id is not null""",
        ),
        "scored_sites": _with(["scored"], "select * from scored"),
        "site_ids_from_gid": _with(["site_3tier"], "select gid - 1 as site_id from site_3tier"),
        "site_blocks": _with(
            ["site_3tier"],
            """select cast(site_id // 500 as bigint) as site_block, count(*) as n
               from site_3tier group by 1""",
        ),
        "site_count": _with(["site_3tier"], "select count(*) as n from site_3tier"),
        "sites_per_state": _with(
            ["site_3tier"],
            """select state, count(*) as n_sites, min(site_id) as first_site_id,
                      max(site_id) as last_site_id
               from site_3tier group by state""",
        ),
        "state_members": _with(
            ["site_3tier"],
            """select state, site_id,
                      row_number() over (partition by state order by site_id) - 1 as place
               from site_3tier""",
        ),
        "state_extremes": _with(
            ["state_counts"],
            """select x.state as max_state, x.n as max_sites, y.state as min_state,
                      y.n as min_sites, (select count(*) from state_counts) as n_states
               from (select * from state_counts where state is not null
                     order by n desc, state limit 1) x,
                    (select * from state_counts where state is not null
                     order by n, state limit 1) y""",
        ),
        "batch_assign": _with(["batches"], "select * from batches"),
        "batch_state_counts": _with(
            ["batches"],
            """select run_id, state, count(*) as n_sites,
                      cast(count(*) over (partition by run_id) as bigint) as n_states
               from batches group by run_id, state""",
        ),
        "batch_measurements": _with(
            ["raw_measurement", "batches"],
            """select run_id, site_id, count(*) as rows
               from raw_measurement
                    join (select distinct run_id, site_id from batches) using (site_id)
               group by run_id, site_id""",
        ),
        "extract_window": _with(
            ["raw_measurement"],
            f"""select site_id, datetime, power, wind_speed from raw_measurement
                where datetime >= timestamp '{WINDOW[0]}' and datetime < timestamp '{WINDOW[1]}'""",
        ),
        "site_measurements": _with(
            ["raw_measurement", "site_3tier"],
            """select * from raw_measurement
               where site_id = (select min(site_id) from site_3tier)""",
        ),
        "sites_subset": _with(
            ["raw_measurement", "score"],
            """select * from raw_measurement
               where site_id in (select site_id from score where site_score = 10)""",
        ),
        "site_card": _with(
            ["scored"],
            """select site_id, site_score, state, fraction_of_usable_area from scored
               where site_id = (select min(site_id) from scored)""",
        ),
        "map_layers": _with(
            ["scored"],
            """select 'Score ' || cast(site_score as varchar) as layer, site_score,
                      count(*) as n_sites, min(lat) as min_lat, max(lat) as max_lat,
                      min(lon) as min_lon, max(lon) as max_lon
               from scored where site_score is not null group by site_score""",
        ),
        "map_points": _with(
            ["scored"],
            """select 'Score ' || cast(site_score as varchar) as layer, site_score, site_id,
                      lon, lat
               from scored where site_score is not null""",
        ),
        "map_sites_by_state": _with(
            ["scored", "state_lookup"],
            f"""select site_id, site_score, lat, lon from scored
                where state = (select name from state_lookup where code = '{STATE_CODE}')
                   or not exists (
                        select 1 from scored
                        where state = (select name from state_lookup where code = '{STATE_CODE}')
                          and site_score is not null and fraction_of_usable_area is not null
                          and lat is not null and lon is not null)""",
        ),
        "chart_daily_power": _chart(
            "daily_power",
            "cast(year as bigint), cast(month as bigint), cast(day as bigint)",
            "cast(total as double)",
        ),
        "chart_daily_speed": _chart(
            "daily_speed",
            "cast(year as bigint), cast(month as bigint), cast(day as bigint)",
            "mean",
        ),
        "chart_monthly_power": _chart("monthly_power", _ONE_DAY_MONTH, "cast(total as double)"),
        "chart_monthly_speed": _chart("monthly_speed", _ONE_DAY_MONTH, "mean"),
        "chart_yearly_power": _chart(
            "yearly_power", "cast(year as bigint), 1, 1", "cast(total as double)"
        ),
        "chart_yearly_speed": _chart("yearly_speed", "cast(year as bigint), 1, 1", "mean"),
        "site_wind_power": _with(
            ["sector_power", "site_3tier"],
            """select * from sector_power
               where site_id = (select min(site_id) from site_3tier)""",
        ),
        "forecast_load": _with(
            ["forecast_text"],
            """select cast(site_id as bigint) as site_id, cast(ts_text as timestamp) as ts,
                      cast(day_ahead_power as double) as day_ahead_power,
                      cast(hour_ahead_power as double) as hour_ahead_power,
                      cast(h4_ahead_power as double) as h4_ahead_power,
                      cast(h6_ahead_power as double) as h6_ahead_power,
                      cast(day_ahead_power_p90 as double) as day_ahead_power_p90
               from forecast_text""",
        ),
    }
    return sql
