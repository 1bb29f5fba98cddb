"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from sitewind.operators import batches, direction, rollup, serving
from sitewind.plans.catalogue import queries
from sitewind.plans.views import view
from sitewind.sources import measurements

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    """The first plan, before adaptive execution changes it."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Final Plan ==")[0]


def count(pattern, text):
    return len(re.findall(pattern, text))


def shuffles(text):
    return count(r"(?<![a-zA-Z])Exchange (hash|range|SinglePart)", text)


@pytest.fixture
def raw(spark):
    return view(spark, FOLDER, "raw_measurement")


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_python_and_no_full_product_in_a_query(spark, name):
    text = plan(queries()[name](spark, FOLDER))
    assert "Python" not in text and "Pandas" not in text
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


@pytest.mark.parametrize("grain", ["daily", "monthly", "yearly"])
def test_a_roll_up_scans_once_and_shuffles_once(raw, grain):
    text = plan(rollup.means(rollup.facts(raw, grain), grain))
    assert count("FileScan", text) == 1
    assert shuffles(text) == 1
    assert "partial_sum" in text
    assert "Sort" not in text


def test_power_reads_only_its_columns(raw):
    text = plan(rollup.total_power(rollup.facts(raw, "yearly"), "yearly"))
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert {part.split(":")[0] for part in schema.split(",")} == {
        "l_suppkey", "l_extendedprice", "l_discount", "l_shipdate"
    }


def test_directions_scan_once(raw):
    facts = direction.direction_facts(raw)
    for text in (plan(direction.sector_means(facts)), plan(direction.sector_power(facts))):
        assert count("FileScan", text) == 1
        assert shuffles(text) == 1


def test_daily_and_direction_facts_share_a_scan(raw):
    text = plan(direction.daily_and_direction_facts(raw))
    assert count("FileScan", text) == 1
    assert shuffles(text) == 1


def test_rolling_up_facts_needs_no_sort(spark, raw, tmp_path):
    rollup.facts(raw, "daily").write.parquet(str(tmp_path / "daily"))
    daily = spark.read.parquet(str(tmp_path / "daily"))
    text = plan(rollup.total_power(rollup.roll(daily, "yearly"), "yearly"))
    assert shuffles(text) == 1 and "Sort" not in text


def test_years_are_pushed_to_the_files_as_a_time_range(raw):
    text = plan(measurements.extract_years(raw, 1997, 2001))
    assert "GreaterThanOrEqual(l_shipdate,1997-01-01T00:00)" in text
    assert "LessThan(l_shipdate,2002-01-01T00:00)" in text


def test_score_has_no_window_and_does_not_scan_again(spark):
    scores = queries()["site_score"](spark, FOLDER)
    scores.collect()
    final = scores._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Window" not in final
    # The bounds are read off the shuffled rows of the means.
    assert "ReusedExchange" in final


def test_a_chart_of_one_site_filters_the_file(spark, raw, tmp_path):
    path = str(tmp_path / "monthly")
    rollup.total_power(rollup.facts(raw, "monthly"), "monthly").write.parquet(path)
    table = spark.read.parquet(path)
    assert "EqualTo(site_id,5)" in plan(serving.chart_series(table, "monthly", "power", 5))


def test_charts_of_all_sites_sort_once_and_not_globally(raw):
    monthly = rollup.total_power(rollup.facts(raw, "monthly"), "monthly")
    df = serving.chart_series(monthly, "monthly", "power")
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
    assert "rangepartitioning" not in final
    assert count(r"(?<!\w)Sort \[", final) == 1


def test_a_batch_reads_only_the_folders_of_its_blocks(spark, raw, tmp_path):
    path, table = str(tmp_path / "store"), str(tmp_path / "batches")
    measurements.write_measurements(
        raw.withColumn("site_id", F.col("site_id") * 400), path
    )
    spark.createDataFrame(
        [(400, 1), (800, 1), (4000, 2)], "site_id bigint, run_id bigint"
    ).write.parquet(table)
    stored = measurements.read_measurements(spark, path)
    df = batches.batch_measurements(stored, spark.read.parquet(table), 1)
    text = plan(df)
    # The list's size is known, so the measurements stay where they are.
    assert count(r"(?<![a-zA-Z])Exchange (hash|range)", text) == 0
    assert re.search(r"PartitionFilters: \[[^\]]*array_contains\(", text)
    assert {row.site_id for row in df.select("site_id").distinct().collect()} == {400, 800}


def test_ordering_sites_never_gathers_them_in_one_task(spark):
    sites = spark.range(100).select(
        F.col("id").alias("site_id"), F.lit("A").alias("state")
    )
    text = plan(batches.assign_batches(sites, 7))
    # The only unpartitioned window is over one total per bucket.
    windows = [line for line in text.splitlines() if re.search(r"\bWindow \[", line)]
    assert windows and all("_bucket" in line for line in windows)
    assert "Range" not in re.sub(r"\bRange \(", "", text) and "sample" not in text.lower()


def test_a_list_of_sites_and_the_default_site_read_their_blocks_only(spark, raw, tmp_path):
    path, table = str(tmp_path / "store"), str(tmp_path / "sites")
    measurements.write_measurements(raw.withColumn("site_id", F.col("site_id") * 400), path)
    spark.createDataFrame([(400,), (3600,)], "site_id bigint").write.parquet(table)
    stored, sites = measurements.read_measurements(spark, path), spark.read.parquet(table)
    for df, ids in ((batches.in_sites(stored, sites), {400, 3600}), (serving.of_default_site(stored, sites), {400})):
        text = plan(df)
        assert re.search(r"PartitionFilters: \[.*site_block", text)
        assert count(r"(?<![a-zA-Z])Exchange (hash|range)", text.split("Subquery")[0]) == 0
        df.write.format("noop").mode("overwrite").save()
        blocks = {row.site_block for row in df.select("site_block").distinct().collect()}
        assert {row.site_id for row in df.select("site_id").distinct().collect()} == ids
        assert blocks == {i // 500 for i in ids}
        assert read_files(df) < len(stored.inputFiles())


def read_files(df):
    """Files that the scan of the measurements read."""
    df.collect()
    found = []

    def walk(node):
        metrics = node.metrics()
        if metrics.contains("numFiles") and "wind_speed" in node.toString():
            found.append(metrics.apply("numFiles").value())
        children = node.children() if "AdaptiveSparkPlan" not in node.nodeName() else None
        if children is None:
            walk(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            walk(node.plan())
        else:
            for i in range(children.size()):
                walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return max(found)


@pytest.mark.parametrize("name", [
    "wind_dir_avg", "daily_avg", "monthly_avg", "yearly_power", "daily_and_direction_totals",
    "yearly_power_large", "monthly_avg_rolled",
])
def test_no_generated_method_is_too_long_to_be_compiled(spark, name):
    """The JVM compiles no method of 8,000 bytes and more."""
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        executed = queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan()
        stages = getattr(debug, "MODULE$").codegenStringSeq(executed)
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sizes and 0 < max(sizes) < 8000
    assert "decimal" not in plan(queries()[name](spark, FOLDER)).split("Exchange")[-1].lower()
