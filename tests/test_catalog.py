"""Every registered query against its SQL in another engine, at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry_points

DATA = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def test_oracles_name_queries():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() == 6000


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_query(spark, duck, name):
    got = entry_points.queries()[name](spark, DATA).toPandas()
    # The smallest table may hold nothing to report.
    assert len(got) or name.endswith("_scan")
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        return
    want = duck.sql(sql).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    got, want = (df[columns].sort_values(columns, ignore_index=True) for df in (got, want))
    assert got.dtypes.astype(str).to_dict() == want.dtypes.astype(str).to_dict()
    assert len(got) == len(want) and got.equals(want)
