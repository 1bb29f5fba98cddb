"""Roll-ups, scores and directions on small frames and on the given tables."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from sitewind import schemas
from sitewind.operators import direction, rollup, score
from sitewind.plans.views import view
from sitewind.sources.measurements import extract_window, extract_years, write_measurements

FOLDER = "/root/testdata/sf0.001"
NAMES = schemas.MEASUREMENT.names


def measurements(spark, rows):
    """Rows given as (site, time, {measure: value}); the times are UTC."""
    full = [
        (site, time, *[float(v) if (v := values.get(name)) is not None else None
                       for name in schemas.ATTRIBUTES])
        for site, time, values in rows
    ]
    text = spark.createDataFrame(
        full, "site_id bigint, datetime string, " + ", ".join(
            f"{name} double" for name in schemas.ATTRIBUTES
        )
    )
    return text.withColumn("datetime", F.to_timestamp(F.concat("datetime", F.lit("Z"))))


@pytest.fixture
def raw(spark):
    return view(spark, FOLDER, "raw_measurement")


def rows(df, *order):
    return [tuple(row) for row in df.orderBy(*(order or df.columns)).collect()]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/Los_Angeles"])
def test_the_day_is_the_utc_day(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    frame = measurements(spark, [
        (1, "2011-01-01 23:30:00", {"power": 1}), (1, "2011-01-01 00:00:00", {"power": 2}),
    ])
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        daily = rollup.total_power(rollup.facts(frame, "daily"), "daily")
        assert rows(daily) == [(1, 2011, 1, 1, 3.0)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("zone, first, hours", [
    ("America/New_York", "2012-03-11 00:00:00", 24),  # 2 o'clock is skipped
    ("America/New_York", "2012-11-04 00:00:00", 24),  # 1 o'clock comes twice
    ("Pacific/Apia", "2011-12-29 00:00:00", 72),  # the 30th is skipped
])
def test_no_hour_or_day_is_lost_where_a_zone_skips_it(spark, tmp_path, zone, first, hours):
    before = spark.conf.get("spark.sql.session.timeZone")
    start = datetime.datetime.fromisoformat(first)
    times = [start + datetime.timedelta(minutes=30 * i) for i in range(2 * hours)]
    frame = measurements(spark, [(1, str(t), {"power": 1}) for t in times])
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        daily = rollup.total_power(rollup.facts(frame, "daily"), "daily")
        days = sorted({(1, t.year, t.month, t.day, 48.0) for t in times})
        assert rows(daily) == days
        write_measurements(frame, str(tmp_path / "stored"))
        stored = spark.read.parquet(str(tmp_path / "stored")).select("datetime")
        assert sorted(r[0] for r in stored.collect()) == times
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_groups_of_nulls_are_kept(spark):
    frame = measurements(spark, [
        (1, "2011-01-01 01:00:00", {"power": None, "wind_speed": math.nan}),
        (1, "2011-01-01 02:00:00", {"power": None, "wind_speed": 4}),
        (2, "2011-01-01 02:00:00", {"power": math.nan}),
    ])
    facts = rollup.facts(frame, "daily")
    assert rows(rollup.total_power(facts, "daily")) == [
        (1, 2011, 1, 1, None), (2, 2011, 1, 1, None),
    ]
    means = rollup.means(facts, "daily").select("site_id", "avg_power", "avg_wind_speed")
    assert rows(means) == [(1, None, 4.0), (2, None, None)]


def test_values_are_rounded_before_they_are_summed(spark):
    frame = measurements(spark, [(1, "2011-01-01 01:00:00", {"power": 1.005})] * 3)
    assert rows(rollup.total_power(rollup.facts(frame, "daily"), "daily")) == [
        (1, 2011, 1, 1, 3.03)
    ]


def test_coarser_facts_are_the_same_from_finer_ones(raw):
    daily = rollup.facts(raw, "daily")
    monthly = rollup.roll(daily, "monthly")
    assert rows(monthly, "site_id", "year", "month") == rows(
        rollup.facts(raw, "monthly"), "site_id", "year", "month"
    )
    assert rows(rollup.roll(monthly, "yearly"), "site_id", "year") == rows(
        rollup.facts(raw, "yearly"), "site_id", "year"
    )


def test_an_unknown_grain_is_refused(raw):
    with pytest.raises(ValueError):
        rollup.facts(raw, "weekly")


def test_every_row_with_a_direction_is_in_one_sector(raw):
    labelled = direction.sector_counts(raw).agg(F.sum("n")).first()[0]
    dropped = raw.where(F.col("wind_direction") >= 360).count()
    assert dropped > 0
    assert labelled + dropped == raw.count()


def test_one_scan_gives_the_same_facts_as_two(raw):
    both = direction.daily_and_direction_facts(raw)
    daily = rollup.facts(raw, "daily")
    assert rows(both.where("kind = 'daily'").select(daily.columns)) == rows(daily)
    sectors = direction.direction_facts(raw)
    again = direction.label_sectors(both.where("kind = 'direction'")).select(sectors.columns)
    assert rows(again) == rows(sectors)


def _scores(spark, means, bands=10):
    frame = spark.createDataFrame(list(enumerate(means)), "site_id bigint, avg_power double")
    scored = score.site_score(frame, bands).orderBy("site_id")
    return [row.site_score for row in scored.collect()]


def test_score_ends(spark):
    assert _scores(spark, [float(p) for p in range(11)]) == list(range(11))
    assert _scores(spark, [0.0, 9.999, 10.0, 99.999, 100.0]) == [0, 0, 1, 9, 10]


def test_score_of_degenerate_inputs(spark):
    assert _scores(spark, [5.0]) == [0]
    assert _scores(spark, [5.0, 5.0, None]) == [0, 0, None]
    assert _scores(spark, [1.0, None, 2.0]) == [0, None, 10]
    assert _scores(spark, [None]) == [None]
    assert _scores(spark, []) == []


def test_scores_span_the_bands(raw):
    averages = score.avg_annual_power(rollup.facts(raw, "yearly"), 1997, 2001)
    found = [row.site_score for row in score.site_score(averages).collect()]
    assert min(found) == 0 and max(found) == 10


def test_means_are_over_the_years_present(spark):
    frame = measurements(spark, [
        (1, f"{year}-06-01 00:00:00", {"power": power})
        for year, power in [(2008, 1000), (2009, 10), (2013, 20), (2014, 1000)]
    ])
    averages = score.avg_annual_power(rollup.facts(frame, "yearly"))
    assert rows(averages) == [(1, 15.0)]


def test_prepared_measurements(spark):
    frame = measurements(spark, [
        (1, "2011-02-03 01:00:00", {"power": 1.005, "density": math.nan, "wind_speed": 2}),
    ])
    found = rollup.prepare_measurements(frame).first().asDict()
    assert found == {
        "site_id": 1, "year": 2011, "month": 2, "day": 3, "density": None, "power": 1.01,
        "pressure": None, "temperature": None, "wind_direction": None, "wind_speed": 2.0,
    }


def test_rows_without_a_time_form_a_group(spark):
    frame = spark.createDataFrame(
        [(1, None, *[1.0] * 6)], schemas.MEASUREMENT
    )
    assert rows(rollup.total_power(rollup.facts(frame, "daily"), "daily")) == [
        (1, None, None, None, 1.0)
    ]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_windows_are_in_utc(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    frame = measurements(spark, [
        (1, time, {"power": 1})
        for time in ("2010-12-31 23:59:59", "2011-01-01 00:00:00", "2011-12-31 23:59:59",
                     "2012-01-01 00:00:00")
    ])
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert extract_years(frame, 2011, 2011).count() == 2
        assert extract_window(frame, "2011-12-31 23:59:59", None).count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
