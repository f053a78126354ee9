import json

import pytest
from pyspark.sql import functions as F

from ledgerlens.sources import versions


def rows(df):
    return sorted(r.id for r in df.collect())


def test_a_failed_write_leaves_the_table_as_it_was(spark, tmp_path):
    folder = str(tmp_path / "t")
    assert rows(versions.replace_table(spark.range(5), folder)) == list(range(5))
    before = versions.read_table(spark, folder)
    broken = spark.range(9, numPartitions=4).withColumn("id", F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error("lost").cast("long")))
    with pytest.raises(Exception, match="lost"):
        versions.replace_table(broken, folder)
    assert rows(versions.read_table(spark, folder)) == rows(before) == list(range(5))
    versions.replace_table(spark.range(3), folder, "here")
    assert rows(versions.read_table(spark, folder)) == [0, 1, 2] and rows(before) == list(range(5))
    assert versions.read_pointer(spark, folder)["made_from"] == "here"


def test_a_plain_folder_is_read_as_it_is(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "plain"))
    assert rows(versions.read_table(spark, str(tmp_path / "plain"))) == [0, 1, 2, 3]


def test_readers_see_the_tables_of_a_finished_run(spark, tmp_path):
    base = str(tmp_path)
    with pytest.raises(ValueError, match="no finished run"):
        versions.open_run(spark, base)
    for name in ("a", "b"):
        versions.replace_table(spark.range(2), f"{base}/{name}")
    versions.commit_run(spark, base, ["a", "b"], [])
    versions.replace_table(spark.range(7), f"{base}/a")  # the next run stops here
    assert {name: df.count() for name, df in versions.open_run(spark, base).items()} == {"a": 2, "b": 2}
    versions.replace_table(spark.range(6), f"{base}/b")
    versions.commit_run(spark, base, ["a", "b"], [])
    assert {name: df.count() for name, df in versions.open_run(spark, base).items()} == {"a": 7, "b": 6}
    assert len([p for p in (tmp_path / "a").iterdir() if p.name.startswith("version-")]) == 1
    assert set(json.loads((tmp_path / "_current").read_text())["tables"]) == {"a", "b"}
