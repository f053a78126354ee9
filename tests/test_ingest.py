import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import scalars as S
from ledgerlens.operators import ingest, quality
from ledgerlens.schemas import MANDATORY, SPECS

APPLICATIONS = (
    "SK_ID_CURR long, TARGET int, AMT_CREDIT long, AMT_ANNUITY long, AMT_INCOME_TOTAL long, DAYS_BIRTH int, "
    "DAYS_EMPLOYED int, AMT_GOODS_PRICE long, CODE_GENDER string, FLAG_OWN_CAR string, FLAG_OWN_REALTY string"
)


def applications(spark):
    return spark.createDataFrame(
        [
            (1, 0, 100000, 10000, 50000, -10000, -1000, 90000, "M", "Y", "Y"),
            (2, 1, 200000, 20000, 50000, -20000, 365243, 180000, "F", "N", "Y"),
            (3, 1, 200000, 20000, 0, -20000, None, None, "XNA", None, None),
            (4, 0, 200000, 20000, 0, 5, -1, None, "M", "N", "N"),
        ],
        APPLICATIONS,
    )


def test_mostly_null_columns_are_dropped(spark):
    df = spark.createDataFrame(
        [(1, 0, None, 1), (2, 0, None, 2), (3, 0, None, 3), (4, 0, None, 4), (5, 1, 1.0, 5)],
        "SK_ID_CURR int, TARGET int, MOSTLY_NULL double, NO_NULL int",
    )
    kept = quality.columns_to_keep(df, MANDATORY["application_train"], 60.0)
    assert kept == ["sk_id_curr", "target", "no_null"]
    assert "mostly_null" in quality.columns_to_keep(df, ["mostly_null"], 60.0)


def test_limit_is_exclusive_and_empty_tables_keep_everything(spark):
    df = spark.createDataFrame([(None,), (None,), (None,), (1,), (2,)], "a int")
    assert quality.columns_to_keep(df, [], 60.0) == ["a"]
    assert quality.columns_to_keep(df, [], 59.99) == []
    assert quality.columns_to_keep(df.limit(0), [], 60.0) == ["a"]


def test_derived_columns(spark):
    rows = {r.target_id: r for r in ingest.prepare_application(applications(spark)).withColumn("target_id", F.col("sk_id_curr")).collect()}
    assert rows[1].credit_income_ratio == 2.0 and rows[1].annuity_income_ratio == 0.2
    assert rows[1].goods_price_credit_ratio == 0.9
    assert (rows[1].is_employed, rows[2].is_employed, rows[3].is_employed) == (1, 0, 1)
    assert rows[1].days_employed_clean == -1000 and rows[2].days_employed_clean is None
    assert (rows[1].gender_enc, rows[2].gender_enc, rows[3].gender_enc) == (1, 0, None)
    assert (rows[1].owns_car, rows[2].owns_car, rows[3].owns_car) == (1, 0, 0)
    assert rows[3].owns_realty == 0
    assert rows[3].credit_income_ratio is None
    assert rows[1].age_years == 10000 / 365.25
    assert 4 not in rows


def test_id_is_hashed_twice_over(spark):
    expected = hashlib.sha256(b"1").hexdigest().encode().hex().upper()
    got = ingest.clean_application(applications(spark)).filter("amt_credit = 100000").first().sk_id_curr
    assert got == expected and len(got) == 128
    salted = spark.range(1).select(S.hashed_id(F.lit(1), "salt")).first()[0]
    assert salted == hashlib.sha256(b"1salt").hexdigest().encode().hex().upper()


def test_same_id_hashes_alike_in_every_table(spark):
    bureau = spark.createDataFrame([(1, -5, -3)], "SK_ID_CURR long, DAYS_CREDIT int, DAYS_CREDIT_ENDDATE int")
    left = ingest.clean_application(applications(spark))
    assert left.join(ingest.clean_history(bureau, "bureau"), "sk_id_curr").count() == 1
    balance = spark.createDataFrame([(7, -1, "C")], SPECS["bureau_balance"].schema)
    assert ingest.clean_history(balance, "bureau_balance").first().sk_id_bureau == 7


def test_point_in_time_modes(spark):
    rows = [(1, -10, -1), (2, -10, 300), (3, -10, None), (4, 5, -1), (5, None, -1), (6, 0, 0)]
    bureau = spark.createDataFrame(rows, "sk_id_curr long, days_credit int, days_credit_enddate int")
    ids = lambda mode: sorted(r.sk_id_curr for r in ingest.prepare_history(bureau, "bureau", mode).collect())
    assert ids("strict") == [1, 6]
    assert ids("observed") == [1, 2, 3, 6]
    payments = spark.createDataFrame(
        [(1, -10, -5), (2, -10, None), (3, -10, 4), (4, 3, -1)],
        "sk_id_curr long, days_instalment int, days_entry_payment int",
    )
    known = lambda mode: sorted(r.sk_id_curr for r in ingest.prepare_history(payments, "installments_payments", mode).collect())
    assert known("strict") == [1]
    assert known("observed") == [1, 2]
    with pytest.raises(ValueError):
        ingest.known_by_application(bureau, "loose")


def test_mean_of_known(spark):
    df = spark.createDataFrame([(0.25, None, 0.75), (None, None, None)], "a double, b double, c double")
    assert [r[0] for r in df.select(S.mean_of_known("a", "b", "c")).collect()] == [0.5, None]
