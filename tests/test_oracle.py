"""Every named query against its SQL twin."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points

QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for path in glob.glob(f"{small}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def rows_of(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(repr([row[i] for i in order]) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, small, name):
    df = QUERIES[name](spark, small)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_throttled_events_are_accepted_as_counted(spark):
    df = QUERIES["throttle_sliding_log"](spark, "/root/testdata/sf0.01")
    assert df.filter("accepted").count() == 5658
