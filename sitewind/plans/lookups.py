"""Reading the result tables: what a page about the sites asks for.

Every method returns a DataFrame. A site filter opens the folders of its block, and reaches the
files, which are sorted by site.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from sitewind import schemas
from sitewind.functions.calendar import grain_columns
from sitewind.functions.states import state_lookup
from sitewind.operators import serving
from sitewind.plans import jobs
from sitewind.sources.results import read_result
from sitewind.sources.tables import read_table

_TABLES = {"power": jobs.POWER_TABLES, "speed": jobs.MEAN_TABLES}


class SiteTables:
    """Lookups over the result tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark = spark
        self._root = root

    def _table(self, name: str) -> DataFrame:
        return read_result(self._spark, self._root, name).drop("run_id")

    def _plain(self, name: str) -> DataFrame:
        return read_table(self._spark, self._root, name, schemas.RESULT_TABLES[name])

    def all_sites(self) -> DataFrame:
        return self._plain(jobs.SITE_INFO)

    def scored_sites(self) -> DataFrame:
        return serving.scored_sites(self.all_sites(), self._plain(jobs.SITE_SCORE))

    def speed(self, grain: str, site_id: int) -> DataFrame:
        """Mean wind speed of a site by day, month or year."""
        columns = ["site_id", *grain_columns(grain), serving.value_column("speed", grain)]
        rows = serving.site_rows(self._table(jobs.MEAN_TABLES[grain]), site_id)
        return rows.select(columns).orderBy(grain_columns(grain))

    def power(self, grain: str, site_id: int) -> DataFrame:
        """Total power of a site by day, month or year."""
        columns = ["site_id", *grain_columns(grain), serving.value_column("power", grain)]
        rows = serving.site_rows(self._table(jobs.POWER_TABLES[grain]), site_id)
        return rows.select(columns).orderBy(grain_columns(grain))

    def sector_power(self, site_id: int) -> DataFrame:
        """Total power of a site by month and wind direction sector."""
        return serving.site_rows(self._table(jobs.SECTOR_POWER_TABLE), site_id).drop("site_block")

    def card(self, site_id: int | None = None) -> DataFrame:
        return serving.site_card(self.scored_sites(), site_id)

    def map_points(self, state_code: str | Sequence[str] | None = None) -> DataFrame:
        return serving.map_points(self._on_map(state_code))

    def map_layers(self, state_code: str | Sequence[str] | None = None) -> DataFrame:
        return serving.map_layers(self._on_map(state_code))

    def _on_map(self, state_code: str | Sequence[str] | None) -> DataFrame:
        return serving.map_sites(self.scored_sites(), state_lookup(self._spark), state_code)

    def chart(self, grain: str, metric: str, site_id: int | None = None) -> DataFrame:
        """Series of a site, by default of all sites."""
        serving.value_column(metric, grain)
        return serving.chart_series(self._table(_TABLES[metric][grain]), grain, metric, site_id)
