import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import quality


def test_contract(spark):
    df = spark.createDataFrame([(1, None)], "SK_ID_CURR long, days_credit int")
    quality.assert_contract(df, "bureau", ["sk_id_curr", "DAYS_CREDIT"])
    with pytest.raises(ValueError, match="target"):
        quality.assert_contract(df, "bureau", ["sk_id_curr", "target"])
    report = quality.contract_report({"bureau": df}, {"bureau": ["sk_id_curr", "days_credit", "target"]})
    assert [tuple(r) for r in report.orderBy("column_name").collect()] == [
        ("bureau", "days_credit", True, 1, 1),
        ("bureau", "sk_id_curr", True, 1, 0),
        ("bureau", "target", False, 1, None),
    ]


def test_rules_and_pass_rate(spark):
    df = spark.createDataFrame([("M", 1), ("F", 2), ("X", -1), (None, None)], "gender string, day int")
    rules = quality.accepted_values({"gender": ("M", "F")}) | quality.not_after_application(["day"])
    results = quality.failed_rows(df, rules | {"never": F.lit(False)})
    assert {r.rule: r.failed_rows for r in results.collect()} == {
        "gender accepted": 1, "day not after application": 2, "never": 0,
    }
    assert tuple(quality.pass_rate(results).first()) == (3, 1, 33.3333)


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,)], "k int")
    assert tuple(quality.duplicate_keys(df, "k").first()) == (2, 1, 2)
    assert tuple(quality.duplicate_keys(df.limit(0), "k").first()) == (0, 0, 0)


def test_null_drift(spark):
    before = spark.range(100).select(F.when(F.col("id") >= 10, 1).alias("a"), F.lit(1).alias("b"))
    after = spark.range(100).select(F.when(F.col("id") >= 16, 1).alias("a"), F.lit(1).alias("b"))
    drift = {r.column_name: r for r in quality.null_drift(before, after).collect()}
    assert drift["a"].alert and abs(drift["a"].rise_points - 6) < 1e-9
    assert not drift["b"].alert


def test_schema_drift(spark):
    before = spark.createDataFrame([], "a int, b string, c double")
    after = spark.createDataFrame([], "A int, b long, d double")
    drift = {r.column_name: (r.baseline_type, r.current_type) for r in quality.schema_drift(before, after).collect()}
    assert drift == {"b": ("string", "bigint"), "c": ("double", None), "d": (None, "double")}
