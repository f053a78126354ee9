"""One customer, order and user hold a third of all rows; joins are shuffled and split as on a cluster."""

import glob
import os
import shutil

import duckdb
import pytest

import __spark_entry__ as entry_points

SETTINGS = {
    "spark.sql.files.maxPartitionBytes": "64KB",
    "spark.sql.files.openCostInBytes": "0",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "8KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}
NAMES = (
    "credit_features", "pit_join_absolute", "clean_bureau_pit", "bureau_features", "payment_features",
    "throttle_window", "throttle_sliding_log", "credit_summary", "stratified_folds",
)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    source = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for name in ("customer", "nation"):
        shutil.copy(f"{source}/{name}.parquet", folder)
    hot = {"orders": ("o_custkey", "o_orderkey", 7), "lineitem": ("l_orderkey", "l_partkey", 21), "events": ("user_id", "event_id", 3)}
    for name, (column, by, value) in hot.items():
        con.execute(
            f"COPY (SELECT * REPLACE (CASE WHEN {by} % 3 = 0 THEN {value} ELSE {column} END AS {column}) "
            f"FROM '{source}/{name}.parquet') TO '{folder}/{name}.parquet' (ROW_GROUP_SIZE 2048)"
        )
    con.close()
    return str(folder)


@pytest.fixture(scope="module")
def tuned(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys(tuned, skewed, name):
    con = duckdb.connect()
    for path in glob.glob(f"{skewed}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    result = con.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in result.description]
    df = entry_points.queries()[name](tuned, skewed)
    mine = sorted(repr([r[n] for n in sorted(names)]) for r in df.collect())
    order = sorted(range(len(names)), key=names.__getitem__)
    assert mine == sorted(repr([r[i] for i in order]) for r in result.fetchall())
    con.close()


def test_hot_customer_is_split(tuned, skewed):
    df = entry_points.queries()["bureau_features"](tuned, skewed)
    df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
