"""Every query against DuckDB on the given tables: columns, types, rows and values."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from sitewind.plans import catalogue, oracle

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")

_KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
    "boolean": "BOOLEAN",
}


# Tables in which one key holds a third of the rows, and a site row has many copies.
SKEWED = {
    "lineitem": """
        select * replace (case when l_orderkey % 3 = 0 then 1 else l_suppkey end as l_suppkey)
        from '{path}'""",
    "events": """
        select * replace (case when event_id % 3 = 0 then 5 else user_id end as user_id,
                          case when event_id % 9 = 0 then timestamp '2024-01-03 05:00:00'
                               else ts end as ts)
        from '{path}'""",
    "supplier": """
        select * from '{path}'
        union all
        select s.* from (select * from '{path}' where s_suppkey = 7) s, range(6)""",
    "orders": """
        select * replace (case when o_orderkey % 3 = 0 then 2 else o_custkey end as o_custkey)
        from '{path}'""",
}


@pytest.fixture(scope="module", params=["given", "skewed"])
def tables(request, tmp_path_factory):
    """A folder of tables, and DuckDB with a view on each of them."""
    folder = FOLDER
    connection = duckdb.connect()
    if request.param == "skewed":
        folder = str(tmp_path_factory.mktemp("skewed"))
        for path in glob.glob("/root/testdata/sf0.001/*.parquet"):
            name = os.path.basename(path)
            query = SKEWED.get(name.removesuffix(".parquet"), "from '{path}'").format(path=path)
            connection.execute(f"copy ({query}) to '{folder}/{name}' (format parquet)")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    yield folder, connection
    connection.close()


def _plain(value):
    if value is None or value is pd.NaT or value != value:
        return None
    return repr(value) if isinstance(value, float) else str(value)


def _sorted(rows):
    return sorted([tuple(_plain(value) for value in row) for row in rows], key=str)


def test_every_query_has_an_oracle():
    assert set(catalogue.queries()) == set(oracle.oracle_sql())
    assert set(catalogue.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_matches_oracle(spark, tables, name):
    folder, duck = tables
    ours = entry.queries()[name](spark, folder)
    theirs = duck.sql(entry.oracle_sql()[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    columns = sorted(ours.columns)
    kinds = dict(ours.dtypes)
    other_kinds = dict(zip(theirs.columns, map(str, theirs.types)))
    assert {c: _KINDS[kinds[c]] for c in columns} == other_kinds
    quoted = ", ".join(f'"{column}"' for column in columns)
    expected = _sorted(theirs.project(quoted).fetchall())
    actual = _sorted(tuple(row) for row in ours.select(columns).collect())
    assert len(actual) == len(expected)
    assert len(actual) > 0
    assert actual == expected
