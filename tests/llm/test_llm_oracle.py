"""The queries that SQL can express, against DuckDB on the given tables."""

import duckdb
import pytest

from sitewind.llm import catalogue

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings"):
        duck.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    ours = catalogue.queries()[name](spark, FOLDER)
    theirs = duck.sql(catalogue.oracle_sql()[name])
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    assert sorted(map(str, ours.select(columns).collect())) == sorted(
        map(str, spark.createDataFrame(theirs.df(), ours.select(theirs.columns).schema).select(columns).collect())
    )


def test_every_operator_has_a_query():
    names = [name.split("_")[0] for name in catalogue.queries()]
    assert sorted(names, key=lambda n: int(n[2:])) == [f"op{n}" for n in range(1, 14)]
