"""Reading, writing, and the jobs from raw files to result tables."""

import datetime as dt
import glob
import io
import os
import re

import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sitewind import schemas
from sitewind.operators import direction, rollup, score, serving, sites
from sitewind.plans import jobs
from sitewind.plans.lookups import SiteTables
from sitewind.plans.views import view
from sitewind.sources import dimensions, measurements, results, tables

FOLDER = "/root/testdata/sf0.001"


def rows(df, *order):
    return [tuple(row) for row in df.orderBy(*(order or df.columns)).collect()]


def test_dimension_files(spark, tmp_path):
    (tmp_path / "zone.csv").write_text(
        "gmtOffset,site_id,abbreviation,countryCode,countryName,nextAbbreviation,timestamp,dst,"
        "dstStart,dstEnd\n"
        "-21600,7,CST,US,United States,CDT,2007-01-01 00:00:00,1,2007-03-11 08:00:00,bad\n"
        "oops,,CST,US,,CDT,,0,,\n"
    )
    found = rows(dimensions.read_site_timezone(spark, str(tmp_path / "zone.csv")), "abbreviation")
    assert (7, "CST", "US", "United States", "CDT", dt.datetime(2007, 1, 1), "1",
            dt.datetime(2007, 3, 11, 8), None, -21600) in found
    assert (None, "CST", "US", None, "CDT", None, "0", None, None, None) in found

    (tmp_path / "meta.csv").write_text(
        "site_id,gid,fraction_of_usable_area,power_curve,capacity,wind_speed,capacity_factor,"
        "city,state,country,the_geom\n"
        '7,8,0.5,x,16.0,8.25,0.4,"Austin, East",Texas,US,0101\n'
    )
    meta = dimensions.read_site_3tier(spark, str(tmp_path / "meta.csv"))
    assert rows(meta) == [
        (7, 8, 0.5, None, 16.0, 8.25, 0.4, "Austin, East", "Texas", "US", "0101")
    ]
    (tmp_path / "geo.csv").write_text("site_id,lat,lon\n7,30.25,-97.75\n")
    assert rows(dimensions.read_site_geo(spark, str(tmp_path / "geo.csv"))) == [(7, 30.25, -97.75)]

    lost = jobs.load_site_info(
        spark, *(str(tmp_path / f"{name}.csv") for name in ("zone", "meta", "geo")),
        str(tmp_path / "out"),
    )
    info = tables.read_table(spark, str(tmp_path / "out"), "site_info")
    assert info.columns == schemas.SITE_INFO.names and info.count() == 1
    assert dict(map(tuple, lost.collect())) == {
        "site_timezone": 1, "site_3tier": 0, "site_geo": 0
    }


def test_numbers_as_times_and_integers(spark, tmp_path):
    (tmp_path / "zone.csv").write_text(
        "site_id,abbreviation,countryCode,countryName,nextAbbreviation,timestamp,dst,dstStart,"
        "dstEnd,gmtOffset\n"
        "7.0,CST,US,United States,CDT,1167609600,0,1173600000.0,0,-2.16e4\n"
        "9007199254740993,CST,US,United States,CDT,99999999999999999999999,0,NaN,,-21600.5\n"
    )
    found = dimensions.read_site_timezone(spark, str(tmp_path / "zone.csv"))
    columns = ["site_id", "timestamp", "dstStart", "dstEnd", "gmtOffset"]
    assert rows(found.select(columns), "site_id")[0] == (
        7, dt.datetime(2007, 1, 1), dt.datetime(2007, 3, 11, 8), dt.datetime(1970, 1, 1), None
    )
    big = rows(found.select(columns), "site_id")[1]
    assert (big[0], big[2], big[3], big[4]) == (9007199254740993, None, None, -21600)


def test_forecast_file(spark, tmp_path):
    (tmp_path / "f.csv").write_text(
        "site_id,TimeStamp,day_ahead_power,hour_ahead_power,4_hour_ahead_power,"
        "6_hour_ahead_power,day_ahead_power_p90\n3,2010-01-01 01:00:00,1.5,2,3,4,bad\n"
    )
    found = dimensions.read_forecast(spark, str(tmp_path / "f.csv"))
    assert found.schema == schemas.FORECAST
    assert rows(found) == [(3, dt.datetime(2010, 1, 1, 1), 1.5, 2.0, 3.0, 4.0, None)]


def test_save_modes(spark, tmp_path):
    root = str(tmp_path)
    one = spark.createDataFrame([(1, 10), (2, 20)], "k int, v int")
    two = spark.createDataFrame([(2, 21)], "k int, v int")

    def stored(name):
        return sorted((row.k, row.v) for row in tables.read_table(spark, root, name).collect())

    assert not tables.table_exists(spark, root, "a")
    tables.write_table(one, root, "a")
    assert tables.table_exists(spark, root, "a")
    tables.write_table(two, root, "a", mode="ignore")
    assert stored("a") == [(1, 10), (2, 20)]
    tables.write_table(two, root, "a", mode="append")
    assert stored("a") == [(1, 10), (2, 20), (2, 21)]
    tables.write_table(two, root, "a")
    assert stored("a") == [(2, 21)]

    tables.write_table(one, root, "b", partition_by=["k"])
    tables.write_table(two, root, "b", partition_by=["k"], replace_partitions=True)
    assert stored("b") == [(1, 10), (2, 21)]
    tables.write_table(two, root, "b", partition_by=["k"])
    assert stored("b") == [(2, 21)]

    with pytest.raises(ValueError):
        tables.write_table(one, root, "c", mode="merge")


def test_jdbc_sink_passes_its_arguments_on(spark, monkeypatch):
    from pyspark.sql import DataFrameWriter

    calls, options = [], {}
    monkeypatch.setattr(
        DataFrameWriter, "jdbc",
        lambda self, url, table, mode=None, properties=None: calls.append(
            (url, table, mode, properties, self._df.rdd.getNumPartitions(), self._df.count())),
    )
    set_options = DataFrameWriter.options
    monkeypatch.setattr(
        DataFrameWriter, "options", lambda self, **o: options.update(o) or set_options(self, **o)
    )
    df = spark.range(100).repartition(20)
    tables.write_jdbc(df, "jdbc:x://h/db", "site_score", "ignore", {"user": "u"}, connections=3)
    assert calls[0][:4] == ("jdbc:x://h/db", "site_score", "ignore", {"user": "u"})
    assert calls[0][4] <= 3 and calls[0][5] == 100
    assert options == {"numPartitions": 3, "batchsize": 10_000, "truncate": "true"}
    for wrong in ({"mode": "merge"}, {"connections": 0}):
        with pytest.raises(ValueError):
            tables.write_jdbc(spark.range(1), "jdbc:x://h/db", "t", **wrong)


def series(start, hours, power):
    times = pd.date_range(start, periods=hours, freq="h")
    frame = pd.DataFrame({"datetime": times})
    for place, name in enumerate(schemas.ATTRIBUTES):
        frame[name] = float(place)
    frame["power"] = [power + hour for hour in range(hours)]
    frame["wind_direction"] = [(45.0 * hour / 2) % 360 for hour in range(hours)]
    return frame


@pytest.fixture
def raw_files(tmp_path):
    """One file per site, without a site column; the last hours lie past the period."""
    folder = tmp_path / "raw"
    folder.mkdir()
    for site, power in [(0, 1.0), (499, 5.0), (500, 9.0), (1203, 2.0)]:
        for_site = pd.concat([series("2009-12-31 12:00", 24, power), series("2015-01-01", 2, 99.0)])
        for_site.to_parquet(folder / f"{site}.parquet", coerce_timestamps="us")
    return str(folder)


def test_ingest_and_lookups(spark, tmp_path, raw_files):
    path = str(tmp_path / "store")
    jobs.ingest(spark, raw_files, path)
    stored = measurements.read_measurements(spark, path)
    assert rows(stored.groupBy("site_block", "site_id").count()) == [
        (0, 0, 24), (0, 499, 24), (1, 500, 24), (2, 1203, 24)
    ]
    one = measurements.site_measurements(stored, 500)
    assert one.count() == 24
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(site_id,500)" in plan
    assert "PartitionFilters: [isnotnull(site_block" in plan

    window = measurements.extract_window(stored, "2010-01-01", "2010-01-01 06:00:00", ["power"])
    assert window.columns == ["site_id", "datetime", "power"]
    assert window.count() == 4 * 6
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(datetime,2010-01-01T00:00)" in plan
    for file in glob.glob(f"{path}/site_block=0/*.parquet"):
        group = pq.ParquetFile(file).metadata.row_group(0)
        assert group.column(0).statistics.has_min_max and group.column(1).statistics.has_min_max
    with pytest.raises(ValueError):
        measurements.extract_window(stored, attributes=["colour"])


def test_files_are_sorted_by_site_and_time(spark, tmp_path):
    path, compacted = str(tmp_path / "store"), str(tmp_path / "compacted")
    raw = view(spark, FOLDER, "raw_measurement").withColumn("site_id", F.col("site_id") * 100)
    measurements.write_measurements(raw.repartition(3), path)
    measurements.compact_measurements(spark, path, compacted)
    blocks = glob.glob(f"{path}/site_block=*")
    assert len(blocks) == len(glob.glob(f"{compacted}/site_block=*")) > 1
    assert len(glob.glob(f"{path}/*/*.parquet")) == 3 * len(blocks)
    assert len(glob.glob(f"{compacted}/*/*.parquet")) == len(blocks)
    for file in glob.glob(f"{tmp_path}/*/site_block=*/*.parquet"):
        keys = pq.ParquetFile(file).read(["site_id", "datetime"]).to_pylist()
        assert keys == sorted(keys, key=lambda row: (row["site_id"], row["datetime"]))
    one, other = (measurements.read_measurements(spark, p) for p in (path, compacted))
    assert one.exceptAll(other).isEmpty() and one.count() == other.count() == raw.count()


def test_ingest_of_some_blocks_leaves_the_others(spark, tmp_path, raw_files):
    path = str(tmp_path / "store")
    jobs.ingest(spark, raw_files, path)
    jobs.ingest(spark, raw_files, path, end="2010-01-01", blocks=[1])
    stored = measurements.read_measurements(spark, path)
    assert rows(stored.groupBy("site_id").count()) == [(0, 24), (499, 24), (500, 12), (1203, 24)]


def test_ingest_of_some_blocks_opens_their_files_only(spark, tmp_path, raw_files):
    path = str(tmp_path / "store")

    def decode(name, content):
        if not name.endswith("/500.parquet"):
            raise ValueError(f"{name} is not wanted")
        yield pd.read_parquet(io.BytesIO(content))

    jobs.ingest(spark, raw_files, path, decoder=decode, blocks=[1])
    stored = measurements.read_measurements(spark, path)
    assert rows(stored.groupBy("site_id").count()) == [(500, 24)]
    assert scanned(measurements.read_raw_parquet(spark, raw_files, [1]), "numFiles") == 1
    assert scanned(measurements.read_raw_parquet(spark, raw_files, [0, 2]), "numFiles") == 3
    assert scanned(measurements.read_raw_parquet(spark, raw_files), "numFiles") == 4
    os.rename(f"{raw_files}/0.parquet", f"{raw_files}/other.parquet")
    assert scanned(measurements.read_raw_parquet(spark, raw_files, [1]), "numFiles") == 2


def test_rows_outside_the_period_are_counted(spark, tmp_path, raw_files):
    path = str(tmp_path / "store")
    assert jobs.ingest(spark, raw_files, path, count=True) == {"read": 104, "kept": 96}
    assert jobs.ingest(spark, raw_files, path, start=None, end=None, blocks=[1], count=True) == {
        "read": 26, "kept": 26}
    assert jobs.ingest(spark, raw_files, path) is None


def test_ingest_with_a_decoder(spark, tmp_path):
    folder = tmp_path / "text"
    folder.mkdir()
    for site in (3, 4):
        series("2010-01-01", 5, float(site)).to_csv(folder / f"{site}.txt", index=False)

    def decode(path, content):
        frame = pd.read_csv(io.BytesIO(content), parse_dates=["datetime"])
        frame["site_id"] = int(path.rsplit("/", 1)[1].split(".")[0])
        yield frame.iloc[:2]
        yield frame.iloc[2:]

    path = str(tmp_path / "store")
    jobs.ingest(spark, str(folder), path, decoder=decode)
    stored = measurements.read_measurements(spark, path)
    assert rows(stored.groupBy("site_id").agg(F.sum("power"))) == [(3, 25.0), (4, 30.0)]


def test_ingest_of_pandas_files_with_a_time_index(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for site, zone in [(3, None), (4, "UTC"), (5, "Asia/Tokyo")]:
        frame = series("2010-01-01", 5, float(site)).set_index("datetime")
        frame.index = frame.index.tz_localize("UTC").tz_convert(zone).as_unit("ns")
        frame.rename_axis(None).to_parquet(folder / f"{site}.parquet")
    path = str(tmp_path / "store")
    jobs.ingest(spark, str(folder), path, decoder=measurements.decode_pandas_parquet)
    stored = measurements.read_measurements(spark, path)
    times = stored.groupBy("site_id").agg(F.min("datetime"), F.max("datetime"))
    first, last = dt.datetime(2010, 1, 1), dt.datetime(2010, 1, 1, 4)
    assert rows(times) == [(site, first, last) for site in (3, 4, 5)]


def test_ingest_of_narrower_types(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    frame = series("2010-01-01", 3, 1.0).astype({"power": "float32", "wind_speed": "float32"})
    frame["power"] = frame["power"] + 0.25
    frame.to_parquet(folder / "8.parquet", coerce_timestamps="us")
    path = str(tmp_path / "store")
    jobs.ingest(spark, str(folder), path)
    stored = measurements.read_measurements(spark, path)
    assert sorted(row.power for row in stored.collect()) == [1.25, 2.25, 3.25]


@pytest.fixture
def store(spark, tmp_path):
    """Measurements, site table and batches made from the given tables."""
    path, root = str(tmp_path / "measurements"), str(tmp_path / "tables")
    raw = view(spark, FOLDER, "raw_measurement")
    measurements.write_measurements(raw, path)
    tables.write_table(view(spark, FOLDER, "site_3tier"), root, "site_info")
    return raw, path, root


def test_processing_all_sites(spark, store):
    raw, path, root = store
    jobs.process_measurements(spark, path, root)
    jobs.score_sites(spark, root, 1997, 2001)

    for name, schema in schemas.RESULT_TABLES.items():
        if name == "site_info":
            continue
        found = tables.read_table(spark, root, name).drop("run_id", "site_block")
        assert {f.name: f.dataType for f in found.schema} == {
            f.name: f.dataType for f in schema
        }, name

    for file in glob.glob(f"{root}/site_facts/*/kind=*/*.parquet"):
        years = pq.ParquetFile(file).read(["year"])["year"].to_pylist()
        assert years == sorted(years)
    files = glob.glob(f"{root}/site_total_daily_capacity/site_block=0/year=*/*.parquet")
    assert len(files) >= 7
    for file in files:
        ids = pq.ParquetFile(file).read(["site_id"])["site_id"].to_pylist()
        assert ids == sorted(ids)

    for grain, name in jobs.POWER_TABLES.items():
        expected = rollup.total_power(rollup.facts(raw, grain), grain)
        assert rows(tables.read_table(spark, root, name).select(expected.columns)) == rows(expected)
    for grain, name in jobs.MEAN_TABLES.items():
        expected = rollup.means(rollup.facts(raw, grain), grain, direction=grain != "daily")
        assert rows(tables.read_table(spark, root, name).select(expected.columns)) == rows(expected)
    averages = score.avg_annual_power(rollup.facts(raw, "yearly"), 1997, 2001)
    expected = score.site_score(averages)
    assert rows(tables.read_table(spark, root, "site_score")) == rows(expected)


def test_batches_add_up_to_all_sites(spark, store, tmp_path):
    raw, path, root = store
    jobs.split_batches(spark, root, size=4)
    plan = tables.read_table(spark, root, "site_batches")
    runs = sorted({row.run_id for row in plan.collect()})
    assert len(runs) == 3
    for run_id in runs:
        jobs.process_measurements(spark, path, root, run_id)
    whole = str(tmp_path / "whole")
    jobs.process_measurements(spark, path, whole)
    names = [*jobs.POWER_TABLES.values(), *jobs.MEAN_TABLES.values(),
             jobs.SECTOR_MEAN_TABLE, jobs.SECTOR_POWER_TABLE]

    def same():
        for name in names:
            one = tables.read_table(spark, root, name).drop("run_id")
            other = tables.read_table(spark, whole, name).drop("run_id")
            assert rows(one.select(sorted(one.columns))) == rows(other.select(sorted(other.columns)))

    same()
    jobs.process_measurements(spark, path, root, runs[1])  # a rerun changes nothing
    same()
    jobs.score_sites(spark, root, 1997, 2001)
    jobs.score_sites(spark, whole, 1997, 2001)
    assert rows(tables.read_table(spark, root, "site_score")) == rows(
        tables.read_table(spark, whole, "site_score"))
    folders = {os.path.dirname(f) for f in glob.glob(f"{root}/site_total_yearly_capacity/**/*.parquet", recursive=True)}
    assert folders == {
        f"{root}/site_total_yearly_capacity/site_block=0/year={y}" for y in range(1995, 2002)
    } & folders and len(folders) >= 6
    with pytest.raises(ValueError):
        jobs.process_measurements(spark, path, whole, 1)
    with pytest.raises(ValueError):
        jobs.process_measurements(spark, path, root)


def test_all_batches_from_one_scan(spark, store, tmp_path):
    raw, path, root = store
    jobs.split_batches(spark, root, size=4)
    jobs.process_batches(spark, path, root)
    jobs.process_batches(spark, path, root)  # again, in place of the first
    single = str(tmp_path / "single")
    tables.write_table(tables.read_table(spark, root, "site_batches"), single, "site_batches")
    for run_id in (1, 2, 3):
        jobs.process_measurements(spark, path, single, run_id)
    for name in [*jobs.POWER_TABLES.values(), *jobs.MEAN_TABLES.values(), jobs.SECTOR_MEAN_TABLE,
                 jobs.SECTOR_POWER_TABLE, jobs.FACTS, *jobs.COARSER_FACTS.values()]:
        one, other = (tables.read_table(spark, r, name) for r in (root, single))
        columns = sorted(one.columns)
        assert sorted(other.columns) == columns
        assert rows(one.select(columns)) == rows(other.select(columns)), name
    jobs.score_sites(spark, root, 1997, 2001)
    jobs.score_sites(spark, single, 1997, 2001)
    assert rows(tables.read_table(spark, root, "site_score")) == rows(
        tables.read_table(spark, single, "site_score"))


def test_a_new_split_next_to_old_results_is_refused(spark, store):
    raw, path, root = store
    jobs.split_batches(spark, root, size=5)
    jobs.split_batches(spark, root, size=4)  # nothing stored yet
    jobs.process_batches(spark, path, root)
    with pytest.raises(ValueError, match="another split"):
        jobs.split_batches(spark, root, size=10)
    totals = tables.read_table(spark, root, "site_total_yearly_capacity")
    assert totals.count() == totals.select("site_id", "year").distinct().count()


def test_scores_of_some_batches_are_refused(spark, store):
    raw, path, root = store
    jobs.split_batches(spark, root, size=4)
    jobs.process_measurements(spark, path, root, 1)
    with pytest.raises(ValueError, match="2 batches with 6 sites"):
        jobs.score_sites(spark, root, 1997, 2001)
    with pytest.raises(ValueError, match="no batch 9"):
        jobs.process_measurements(spark, path, root, 9)


def test_a_known_state_comes_before_null(spark):
    listed = spark.createDataFrame(
        [(1, None), (1, "Texas"), (2, None), (3, "B"), (3, "A")], "site_id bigint, state string"
    )
    assert rows(sites.first_rows(listed)) == [(1, "Texas"), (2, None), (3, "A")]


def test_materialised_batches(spark, store, tmp_path):
    raw, path, root = store
    jobs.split_batches(spark, root, size=4)
    out = str(tmp_path / "batched")
    jobs.materialise_batches(spark, path, root, out)
    batched = spark.read.parquet(out)
    assert batched.count() == raw.count()
    assert batched.where("run_id = 2").select("site_id").distinct().count() == 4

    other = str(tmp_path / "other")
    tables.write_table(tables.read_table(spark, root, "site_batches"), other, "site_batches")
    jobs.process_measurements(spark, f"{out}/run_id=2", root, 2)
    jobs.process_measurements(spark, path, other, 2)
    for kind in ("daily", "direction"):
        assert rows(jobs.read_facts(spark, root, kind)) == rows(jobs.read_facts(spark, other, kind))


def test_lookups_over_the_result_tables(spark, store):
    raw, path, root = store
    jobs.process_measurements(spark, path, root)
    jobs.score_sites(spark, root, 1997, 2001)
    info = view(spark, FOLDER, "site_3tier").withColumns(
        {"lat": F.lit(1.0), "lon": F.lit(2.0), "state": F.lit("Iowa")}
    )
    tables.write_table(info, root, "site_info")
    pages = SiteTables(spark, root)

    assert pages.all_sites().count() == pages.scored_sites().count() == 10
    for grain in ("daily", "monthly", "yearly"):
        of_site = F.col("site_id") == 5
        totals = rollup.total_power(rollup.facts(raw, grain), grain).where(of_site)
        power = pages.power(grain, 5)
        assert rows(power) == rows(totals) and power.count() > 0
        means = rollup.means(rollup.facts(raw, grain), grain).where(of_site)
        speed = pages.speed(grain, 5)
        assert rows(speed) == rows(means.select(speed.columns))
        text = speed._jdf.queryExecution().executedPlan().toString()
        assert "EqualTo(site_id,5)" in text and re.search(r"PartitionFilters: \[[^]]*site_block", text)
        assert pages.chart(grain, "power", 5).count() == totals.count()
        assert pages.chart(grain, "speed").count() == rollup.facts(raw, grain).count()
    sectors = direction.sector_power(direction.direction_facts(raw)).where("site_id = 5")
    found = pages.sector_power(5)
    assert rows(found.select(sectors.columns)) == rows(sectors)
    assert pages.card().first().site_id == 0
    assert pages.card(7).first().site_id == 7
    assert pages.map_points("IA").count() == 10
    assert sum(row.n_sites for row in pages.map_layers("TX").collect()) == 10
    with pytest.raises(ValueError):
        pages.chart("daily", "pressure")


def test_a_batch_replaces_its_own_rows(spark, tmp_path):
    root, name = str(tmp_path / "tables"), "site_total_yearly_capacity"
    columns = "site_id bigint, year int, yearly_power double"

    def replace(run_id, some):
        results.replace_run(spark.createDataFrame(some, columns), root, name, run_id)

    def found():
        table = results.read_result(spark, root, name)
        return rows(table.select("run_id", "site_id", "year", "yearly_power"))

    replace(1, [(1, 2009, 1.0), (1, 2010, 2.0), (700, 2009, 3.0)])
    replace(2, [(2, 2009, 4.0), (1500, 2011, 5.0)])
    replace(3, [])
    others = [(2, 2, 2009, 4.0), (2, 1500, 2011, 5.0)]
    assert found() == sorted([(1, 1, 2009, 1.0), (1, 1, 2010, 2.0), (1, 700, 2009, 3.0), *others])
    # A year and a block of the batch are gone, and so are their folders.
    replace(1, [(1, 2009, 9.0)])
    assert found() == sorted([(1, 1, 2009, 9.0), *others])
    assert sorted(glob.glob(f"{root}/{name}/*/year=*")) == [
        f"{root}/{name}/site_block={b}/year={y}" for b, y in ((0, 2009), (3, 2011))
    ]
    one = serving.site_rows(results.read_result(spark, root, name), 1500)
    assert scanned(one, "numFiles") == 1 and one.count() == 1


def test_a_lookup_lists_one_block(spark, tmp_path):
    root, name = str(tmp_path / "tables"), "site_total_yearly_capacity"
    many = spark.range(40).select(
        (F.col("id") * 250).alias("site_id"), F.lit(2009).alias("year"), F.lit(1.0).alias("yearly_power"),
        (F.col("id") + 1).alias("run_id"),
    )
    results.write_result(many, root, name)
    assert len(glob.glob(f"{root}/{name}/site_block=*")) == 20
    tables.write_table(view(spark, FOLDER, "site_3tier"), root, "site_info")
    power = SiteTables(spark, root).power("yearly", 750)
    assert rows(power) == [(750, 2009, 1.0)]
    assert scanned(power, "numFiles") == 1


def scanned(df, metric):
    """A metric of the only scan of a plan that has run."""
    df.collect()
    found = []

    def walk(node):
        if node.metrics().contains(metric):
            found.append(node.metrics().apply(metric).value())
        if "AdaptiveSparkPlan" in node.nodeName():
            walk(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            walk(node.plan())
        else:
            for i in range(node.children().size()):
                walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found[0]


def test_site_zero_is_served_like_any_other(spark, tmp_path, raw_files):
    path, root = str(tmp_path / "store"), str(tmp_path / "tables")
    jobs.ingest(spark, raw_files, path)
    jobs.process_measurements(spark, path, root)
    daily = tables.read_table(spark, root, jobs.POWER_TABLES["daily"])
    points = serving.chart_series(daily, "daily", "power", 0).collect()
    assert [(row.date, row.value) for row in points] == [
        (dt.date(2009, 12, 31), sum(range(1, 13)) * 1.0),
        (dt.date(2010, 1, 1), sum(range(13, 25)) * 1.0),
    ]


def test_jobs_from_the_command_line(spark, tmp_path, raw_files):
    import run_job

    store, root = str(tmp_path / "store"), str(tmp_path / "tables")
    for line in (
        ["ingest", raw_files, store, "--end", "2010-01-01", "--start", "open", "--count"],
        ["compact", store, str(tmp_path / "compacted")],
        ["process", str(tmp_path / "compacted"), root],
        ["score", root, "--first-year", "2009"],
    ):
        run_job.run(spark, run_job.parse(line))
    scores = tables.read_table(spark, root, "site_score")
    assert rows(scores.select("site_id", "site_score")) == [(0, 0), (499, 5), (500, 10), (1203, 1)]
