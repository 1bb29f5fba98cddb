"""Every query of the package, run over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewind import schemas
from sitewind.functions import numbers
from sitewind.functions.states import state_lookup
from sitewind.operators import batches, direction, rollup, score, serving, sites
from sitewind.plans import jobs
from sitewind.plans.views import view
from sitewind.sources import dimensions, measurements, tables
from sitewind.sources.results import read_result, replace_run, write_result
from sitewind.sources.tables import scratch_path, stored

Query = Callable[[SparkSession, str], DataFrame]

# The years of the measurements are 1995..2001; the default score window lies outside them.
SCORE_YEARS = (1997, 2001)
WINDOW = ("1997-01-01", "1999-01-01")
BATCH_SIZE = 7
STATE_CODE = "S4"
SITE_ID = 7
US_STATE_CODE = "TX"

_QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, "raw_measurement")


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, "raw_event_measurement")


def _sites(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, "site_3tier")


@_query
def prepared_measurements(spark, folder):
    return rollup.prepare_measurements(_raw(spark, folder))


@_query
def daily_avg(spark, folder):
    return rollup.means(rollup.facts(_events(spark, folder), "daily"), "daily")


@_query
def daily_power(spark, folder):
    return rollup.total_power(rollup.facts(_events(spark, folder), "daily"), "daily")


@_query
def monthly_avg(spark, folder):
    return rollup.means(rollup.facts(_raw(spark, folder), "monthly"), "monthly")


@_query
def monthly_power(spark, folder):
    return rollup.total_power(rollup.facts(_raw(spark, folder), "monthly"), "monthly")


@_query
def yearly_avg(spark, folder):
    return rollup.means(rollup.facts(_raw(spark, folder), "yearly"), "yearly")


@_query
def yearly_power(spark, folder):
    return rollup.total_power(rollup.facts(_raw(spark, folder), "yearly"), "yearly")


@_query
def yearly_power_large(spark, folder):
    """Totals of values of which many are 1e16 and more."""
    large = view(spark, folder, "large_measurement")
    return rollup.total_power(rollup.facts(large, "yearly"), "yearly")


def _rolled(spark, folder, *grains):
    """Facts as the jobs make them: by day from the measurements, coarser ones from finer ones."""
    frame = rollup.facts(_raw(spark, folder), "daily")
    for grain in grains:
        frame = rollup.roll(frame, grain)
    return frame


@_query
def monthly_power_rolled(spark, folder):
    return rollup.total_power(_rolled(spark, folder, "monthly"), "monthly")


@_query
def yearly_power_rolled(spark, folder):
    return rollup.total_power(_rolled(spark, folder, "monthly", "yearly"), "yearly")


@_query
def monthly_avg_rolled(spark, folder):
    return rollup.means(_rolled(spark, folder, "monthly"), "monthly")


@_query
def avg_annual_power(spark, folder):
    years = measurements.extract_years(_raw(spark, folder), *SCORE_YEARS)
    return score.avg_annual_power(rollup.facts(years, "yearly"), *SCORE_YEARS)


@_query
def site_score(spark, folder):
    return score.site_score(avg_annual_power(spark, folder))


@_query
def wind_sector(spark, folder):
    return direction.sector_counts(_raw(spark, folder))


@_query
def wind_dir_avg(spark, folder):
    return direction.sector_means(direction.direction_facts(_raw(spark, folder)))


@_query
def wind_dir_power(spark, folder):
    return direction.sector_power(direction.direction_facts(_raw(spark, folder)))


@_query
def wind_dir_mean(spark, folder):
    return rollup.mean_directions(rollup.facts(_raw(spark, folder), "monthly"), "monthly")


@_query
def daily_and_direction_totals(spark, folder):
    """Both kinds of facts from one scan, with the power total of each row."""
    frame = direction.daily_and_direction_facts(_raw(spark, folder))
    return frame.select(
        "kind", "site_id", "year", "month", "day",
        F.col("sector").cast("bigint").alias("sector"),
        numbers.total("total_power").alias("total_power"),
        F.col("count_wind_speed").alias("n_wind_speed"),
    )


@_query
def site_info_join(spark, folder):
    return sites.build_site_info(
        view(spark, folder, "site_timezone"),
        _sites(spark, folder),
        view(spark, folder, "site_geo"),
    )


@_query
def unmatched_sites(spark, folder):
    return sites.unmatched_sites(
        view(spark, folder, "site_timezone"),
        _sites(spark, folder),
        view(spark, folder, "site_geo"),
    )


@_query
def site_countries(spark, folder):
    return sites.site_countries(view(spark, folder, "site_timezone"))


@_query
def scored_sites(spark, folder):
    return serving.scored_sites(site_info_join(spark, folder), site_score(spark, folder))


@_query
def flagship(spark, folder):
    """Score of every site with all that is known about it."""
    return site_info_join(spark, folder).join(site_score(spark, folder), "site_id")


@_query
def site_ids_from_gid(spark, folder):
    return dimensions.site_ids_from_gid(_sites(spark, folder))


@_query
def site_blocks(spark, folder):
    return measurements.site_blocks(_sites(spark, folder))


@_query
def site_count(spark, folder):
    return sites.site_count(_sites(spark, folder))


@_query
def sites_per_state(spark, folder):
    return sites.sites_per_state(_sites(spark, folder))


@_query
def state_members(spark, folder):
    return batches.state_members(_sites(spark, folder))


@_query
def state_extremes(spark, folder):
    return sites.state_extremes(_sites(spark, folder))


@_query
def batch_assign(spark, folder):
    return batches.assign_batches(_sites(spark, folder), BATCH_SIZE)


@_query
def batch_state_counts(spark, folder):
    return batches.batch_state_counts(batch_assign(spark, folder), _sites(spark, folder))


def _stored_batches(spark, folder):
    """The batches as the jobs read them, from a table."""
    return stored(batch_assign(spark, folder), "batches")


@_query
def batch_measurements(spark, folder):
    """Size of the input set of every batch, by site."""
    batched = batches.with_run_id(_raw(spark, folder), _stored_batches(spark, folder))
    return batched.groupBy("run_id", "site_id").agg(F.count(F.lit(1)).alias("rows"))


@_query
def batch_filter(spark, folder):
    """Measurements of the first batch, as a run over one batch reads them."""
    return batches.batch_measurements(_raw(spark, folder), _stored_batches(spark, folder), 1)


@_query
def site_power_series(spark, folder):
    """Monthly power of one site, chosen by its id."""
    return serving.site_rows(monthly_power(spark, folder), SITE_ID)


@_query
def power_of_some_sites(spark, folder):
    """Yearly power of a short list of sites."""
    return serving.sites_in(yearly_power(spark, folder), [SITE_ID, SITE_ID + 1])


@_query
def map_has_data(spark, folder):
    return serving.has_data(scored_sites(spark, folder), ["state", "lat", "lon"])


@_query
def site_timezone_typed(spark, folder):
    return schemas.typed(view(spark, folder, "site_timezone_text"), schemas.SITE_TIMEZONE)


@_query
def site_3tier_typed(spark, folder):
    return schemas.typed(view(spark, folder, "site_3tier_text"), schemas.SITE_3TIER)


@_query
def site_geo_typed(spark, folder):
    return schemas.typed(view(spark, folder, "site_geo_text"), schemas.SITE_GEO)


@_query
def stored_measurements(spark, folder):
    """The measurements as written to a dataset by blocks of sites, one block twice, and read back."""
    path = scratch_path(spark, "measurements")
    raw = _raw(spark, folder)
    measurements.write_measurements(raw, path)
    measurements.write_measurements(raw, path, blocks=[0])
    return measurements.read_measurements(spark, path)


@_query
def stored_site_series(spark, folder):
    """Two years of one site, from the dataset."""
    of_site = measurements.site_measurements(stored_measurements(spark, folder), SITE_ID)
    return measurements.extract_window(of_site, *WINDOW, attributes=["power"])


@_query
def saved_twice(spark, folder):
    """A table written in each save mode: replaced, left as it is, added to."""
    root, sites_of = scratch_path(spark, "tables"), _sites(spark, folder).select("site_id", "state")

    def save(step, mode, some=None):
        rows = sites_of if some is None else sites_of.where(some)
        tables.write_table(rows.withColumn("step", F.lit(step)), root, "saved", mode)

    save(1, "error")
    save(2, "overwrite")
    save(3, "ignore")
    save(4, "append", F.col("state").isNull())
    return tables.read_table(spark, root, "saved")


@_query
def replaced_results(spark, folder):
    """Yearly power of all sites as stored batch by batch, the first of them twice."""
    root, name = scratch_path(spark, "results"), jobs.POWER_TABLES["yearly"]
    totals = stored(batches.with_run_id(yearly_power(spark, folder), _stored_batches(spark, folder)), "totals")
    write_result(totals.where(F.col("run_id") != 1), root, name)
    for scale in (2.0, 1.0):
        first = totals.where(F.col("run_id") == 1).drop("run_id")
        replace_run(first.withColumn("yearly_power", F.col("yearly_power") * scale), root, name, 1)
    return read_result(spark, root, name)


@_query
def map_sites_by_name(spark, folder):
    """Map of a state by its postal code."""
    named = view(spark, folder, "site_us_state")
    scored = scored_sites(spark, folder).drop("state").join(named, "site_id").withColumnRenamed("us_state", "state")
    shown = serving.map_sites(scored, state_lookup(spark), US_STATE_CODE)
    return shown.select("site_id", "site_score", "lat", "lon")


@_query
def extract_window(spark, folder):
    return measurements.extract_window(
        _raw(spark, folder), *WINDOW, attributes=["power", "wind_speed"]
    )


@_query
def site_measurements(spark, folder):
    """Series of the default site."""
    return serving.of_default_site(_raw(spark, folder), _sites(spark, folder))


@_query
def sites_subset(spark, folder):
    """Series of the sites of the highest score."""
    best = site_score(spark, folder).where(F.col("site_score") == score.BANDS)
    return batches.in_sites(_raw(spark, folder), stored(best, "best-sites"))


@_query
def site_card(spark, folder):
    return serving.site_card(scored_sites(spark, folder))


@_query
def map_layers(spark, folder):
    return serving.map_layers(scored_sites(spark, folder))


@_query
def map_points(spark, folder):
    return serving.map_points(scored_sites(spark, folder))


@_query
def map_sites_by_state(spark, folder):
    shown = serving.map_sites(
        scored_sites(spark, folder), view(spark, folder, "state_lookup"), STATE_CODE
    )
    return shown.select("site_id", "site_score", "lat", "lon")


@_query
def chart_daily_power(spark, folder):
    return serving.chart_series(daily_power(spark, folder), "daily", "power")


@_query
def chart_daily_speed(spark, folder):
    return serving.chart_series(daily_avg(spark, folder), "daily", "speed")


@_query
def chart_monthly_power(spark, folder):
    return serving.chart_series(monthly_power(spark, folder), "monthly", "power")


@_query
def chart_monthly_speed(spark, folder):
    return serving.chart_series(monthly_avg(spark, folder), "monthly", "speed")


@_query
def chart_yearly_power(spark, folder):
    return serving.chart_series(yearly_power(spark, folder), "yearly", "power")


@_query
def chart_yearly_speed(spark, folder):
    return serving.chart_series(yearly_avg(spark, folder), "yearly", "speed")


@_query
def site_wind_power(spark, folder):
    """Power by sector of the default site."""
    chosen = serving.of_default_site(_raw(spark, folder), _sites(spark, folder))
    return direction.sector_power(direction.direction_facts(chosen))


@_query
def forecast_load(spark, folder):
    return dimensions.type_forecast(view(spark, folder, "forecast_text"), {"ts": "ts_text"})
