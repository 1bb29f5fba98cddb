"""Tables behind the site card, the map and the charts.

Each is built for all sites. Given a site, the same frame is filtered, and Catalyst takes the
filter down to the files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitewind.functions.calendar import grain_columns, start_date
from sitewind.sources.measurements import of_site

# Metric -> value column of the table it is read from.
METRICS = {"power": "{grain}_power", "speed": "avg_wind_speed"}

_MAP_COLUMNS = ["site_id", "site_score", "state", "fraction_of_usable_area", "lat", "lon"]


def value_column(metric: str, grain: str) -> str:
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; use one of {sorted(METRICS)}")
    grain_columns(grain)
    return METRICS[metric].format(grain=grain)


def site_rows(table: DataFrame, site_id: int) -> DataFrame:
    """Rows of one site."""
    return of_site(table, F.lit(int(site_id)).cast("bigint"))


def sites_in(table: DataFrame, site_ids: Sequence[int]) -> DataFrame:
    """Rows of a short list of sites."""
    return table.where(F.col("site_id").isin([int(site_id) for site_id in site_ids]))


def scored_sites(site_info: DataFrame, site_score: DataFrame) -> DataFrame:
    """Sites that have a score row, with what the map shows of them."""
    scores = site_score.select("site_id", "site_score")
    return site_info.join(scores, "site_id").select(_MAP_COLUMNS)


def default_site(scored: DataFrame) -> Column:
    """Id of the site shown before one is chosen, as a scalar subquery."""
    return scored.agg(F.min("site_id")).scalar()


def of_default_site(table: DataFrame, scored: DataFrame) -> DataFrame:
    """Rows of the default site."""
    return of_site(table, default_site(scored))


def site_card(scored: DataFrame, site_id: int | None = None) -> DataFrame:
    """Id, score, state and usable area of a site, by default of the one shown first."""
    chosen = of_default_site(scored, scored) if site_id is None else site_rows(scored, site_id)
    return chosen.select("site_id", "site_score", "state", "fraction_of_usable_area")


def map_sites(
    scored: DataFrame, lookup: DataFrame, state_code: str | Sequence[str] | None
) -> DataFrame:
    """Sites of a state given by its code in ``lookup(code, name)``.

    Of a list the first code counts; an empty text, ``"None"`` or nothing selects all sites. So
    does a code that is unknown, or whose state has no site with all map columns filled.
    """
    if isinstance(state_code, (list, tuple)):
        state_code = state_code[0] if state_code else None
    if state_code in (None, "", "None"):
        return scored
    name = lookup.where(F.col("code") == state_code).agg(F.max("name")).scalar()
    complete = _all_set([column for column in _MAP_COLUMNS if column != "site_id"])
    in_state = F.col("state") == name
    usable = scored.where(in_state & complete).agg(F.count(F.lit(1))).scalar()
    return scored.where((usable == 0) | in_state)


def _all_set(columns: Sequence[str]) -> Column:
    complete = F.lit(True)
    for column in columns:
        complete = complete & F.col(column).isNotNull()
    return complete


def _layer_name() -> Column:
    return F.concat(F.lit("Score "), F.col("site_score").cast("string"))


def map_points(sites: DataFrame) -> DataFrame:
    """Points of the map with the layer each belongs to, lowest score first."""
    return (
        sites.where(F.col("site_score").isNotNull())
        .select(_layer_name().alias("layer"), "site_score", "site_id", "lon", "lat")
        .orderBy("site_score", "site_id")
    )


def map_layers(sites: DataFrame) -> DataFrame:
    """Layers of the map, lowest score first, with their number of sites and extent."""
    return (
        sites.where(F.col("site_score").isNotNull())
        .groupBy("site_score")
        .agg(
            F.count(F.lit(1)).alias("n_sites"),
            F.min("lat").alias("min_lat"),
            F.max("lat").alias("max_lat"),
            F.min("lon").alias("min_lon"),
            F.max("lon").alias("max_lon"),
        )
        .select(
            _layer_name().alias("layer"),
            "site_score", "n_sites", "min_lat", "max_lat", "min_lon", "max_lon",
        )
        .orderBy("site_score")
    )


def has_data(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Whether any row has all the columns filled, as one row ``(has_data)``."""
    found = table.where(_all_set(columns)).limit(1)
    return found.agg((F.count(F.lit(1)) > 0).alias("has_data"))


def chart_series(
    table: DataFrame, grain: str, metric: str, site_id: int | None = None
) -> DataFrame:
    """Points of the bar charts: site, first day of the period, value, in order of time.

    A site none of whose rows is complete has no series; otherwise all its rows are shown, those
    without a value as well. Without ``site_id`` the series of all sites are given, each one in
    order and in one piece.
    """
    value = value_column(metric, grain)
    rows = table if site_id is None else site_rows(table, site_id)
    points = rows.select(
        "site_id", start_date(grain).alias("date"), F.col(value).alias("value")
    )
    # A site has at most one row per period here. The order serves the sort below, too.
    of_site = Window.partitionBy("site_id").orderBy("date").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    shown = (
        points.withColumn("complete", F.max(_all_set(["date", "value"])).over(of_site))
        .where("complete")
        .drop("complete")
    )
    if site_id is not None:
        return shown.orderBy("date")
    return shown.sortWithinPartitions("site_id", "date")
