"""Site card, map and charts."""

import datetime as dt

import pytest

from sitewind.functions.states import state_lookup
from sitewind.operators import serving

SCORED = (
    "site_id bigint, site_score bigint, state string, fraction_of_usable_area double, "
    "lat double, lon double"
)


@pytest.fixture
def scored(spark):
    return spark.createDataFrame([
        (0, 3, "Texas", 0.5, 30.0, -100.0),
        (1, None, "Texas", 0.5, 31.0, -101.0),
        (2, 10, "Iowa", None, 42.0, -93.0),
        (3, 3, None, 0.1, 40.0, -90.0),
    ], SCORED)


def shown(scored, lookup, code):
    return sorted(row.site_id for row in serving.map_sites(scored, lookup, code).collect())


def test_state_filter(spark, scored):
    lookup = state_lookup(spark)
    everything = [0, 1, 2, 3]
    assert shown(scored, lookup, "TX") == [0, 1]
    assert shown(scored, lookup, ["TX", "IA"]) == [0, 1]
    assert shown(scored, lookup, "IA") == everything  # no complete row
    assert shown(scored, lookup, "WY") == everything  # no row
    assert shown(scored, lookup, "ALL") == everything
    assert shown(scored, lookup, "all") == everything  # not a code
    assert shown(scored, lookup, "") == everything
    assert shown(scored, lookup, "None") == everything
    assert shown(scored, lookup, None) == everything


def test_layers(scored):
    layers = [tuple(row)[:3] for row in serving.map_layers(scored).collect()]
    assert layers == [("Score 3", 3, 2), ("Score 10", 10, 1)]
    points = [(row.layer, row.site_id) for row in serving.map_points(scored).collect()]
    assert points == [("Score 3", 0), ("Score 3", 3), ("Score 10", 2)]


def test_site_card(scored):
    assert tuple(serving.site_card(scored).first()) == (0, 3, "Texas", 0.5)
    assert tuple(serving.site_card(scored, 2).first()) == (2, 10, "Iowa", None)
    assert serving.site_card(scored, 99).count() == 0


def test_lookups(scored):
    assert [row.site_id for row in serving.site_rows(scored, 2).collect()] == [2]
    assert sorted(row.site_id for row in serving.sites_in(scored, [0, 3, 77]).collect()) == [0, 3]


def test_scored_sites_need_a_score_row(spark, scored):
    info = scored.drop("site_score")
    scores = spark.createDataFrame(
        [(0, 1.0, 5), (2, 2.0, None)], "site_id bigint, avg_power double, site_score bigint"
    )
    joined = serving.scored_sites(info, scores)
    assert sorted((row.site_id, row.site_score) for row in joined.collect()) == [(0, 5), (2, None)]


@pytest.fixture
def monthly(spark):
    return spark.createDataFrame([
        (0, 2011, 2, 7.0), (0, 2011, 1, None), (0, 2010, 12, 5.0),
        (1, 2011, 1, None), (1, 2011, 2, None),
    ], "site_id bigint, year int, month int, avg_wind_speed double")


def test_chart_of_one_site_is_in_order_of_time(monthly):
    series = [(row.date, row.value) for row in
              serving.chart_series(monthly, "monthly", "speed", 0).collect()]
    assert series == [
        (dt.date(2010, 12, 1), 5.0), (dt.date(2011, 1, 1), None), (dt.date(2011, 2, 1), 7.0),
    ]


def test_sites_without_complete_rows_have_no_chart(monthly):
    assert serving.chart_series(monthly, "monthly", "speed", 1).count() == 0
    assert serving.chart_series(monthly, "monthly", "speed", 5).count() == 0
    every = serving.chart_series(monthly, "monthly", "speed").collect()
    assert [row.site_id for row in every] == [0, 0, 0]
    columns = ["site_id", "year", "month", "avg_wind_speed"]
    assert serving.has_data(monthly, columns).first().has_data
    assert not serving.has_data(serving.site_rows(monthly, 1), columns).first().has_data


def test_dates_of_each_grain(spark):
    daily = spark.createDataFrame([(0, 2011, 2, 3, 1.5)],
                                  "site_id bigint, year int, month int, day int, daily_power double")
    yearly = spark.createDataFrame([(0, 2011, 9.5)], "site_id bigint, year int, yearly_power double")
    assert tuple(serving.chart_series(daily, "daily", "power").first()) == (
        0, dt.date(2011, 2, 3), 1.5)
    assert tuple(serving.chart_series(yearly, "yearly", "power").first()) == (
        0, dt.date(2011, 1, 1), 9.5)


def test_unknown_metric_or_grain(monthly):
    with pytest.raises(ValueError):
        serving.chart_series(monthly, "monthly", "pressure")
    with pytest.raises(ValueError):
        serving.chart_series(monthly, "hourly", "speed")
