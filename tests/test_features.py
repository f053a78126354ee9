import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import scalars as S
from ledgerlens.operators import features
from ledgerlens.plans import queries
from ledgerlens.schemas import SPECS
from ledgerlens.sources.fixture_views import CreditTables


def test_bureau_features_by_hand(spark):
    bureau = spark.createDataFrame(
        [
            (1, 10, "Active", -30, 0, -1, 1, 100.0, 50.0, "card"),
            (1, 11, "Closed", -10, 7, -1, 2, 300.0, None, "card"),
            (1, 12, "Sold", -20, 3, -1, 0, 0.1, 0.2, "loan"),
            (2, 13, "Active", -5, 0, -1, 0, 0.0, 5.0, None),
        ],
        SPECS["bureau"].schema,
    )
    balance = spark.createDataFrame(
        [(10, -1, "C"), (10, -2, "2"), (11, -1, "X"), (12, -1, "?"), (99, -1, "5")], SPECS["bureau_balance"].schema
    )
    rows = {r.sk_id_curr: r for r in features.bureau_features(bureau, balance).collect()}
    one = rows[1]
    assert (one.bureau_record_count, one.active_bureau_count, one.closed_bureau_count) == (3, 1, 1)
    assert (one.days_since_last_bureau, one.avg_days_credit) == (10, -20.0)
    assert (one.total_days_overdue, one.overdue_bureau_count, one.max_days_overdue) == (10, 2, 7)
    assert (one.total_bureau_credit, one.total_bureau_debt) == (400.1, 50.2)
    assert one.bureau_debt_ratio == 50.2 / 400.1
    assert (one.total_credit_prolongations, one.distinct_credit_types) == (3, 2)
    assert one.worst_ever_bureau_status == "2"
    assert rows[2].bureau_debt_ratio is None and rows[2].worst_ever_bureau_status is None
    assert rows[2].distinct_credit_types == 0


def test_payment_features_by_hand(spark):
    payments = spark.createDataFrame(
        [
            (1, 5, 1, -30, -35, 100.0, 100.0),
            (1, 5, 2, -20, -10, 100.0, 50.0),
            (1, 5, 3, -10, -10, 0.0, None),
            (2, 6, 1, -10, -10, 10.0, 10.0),
        ],
        SPECS["installments_payments"].schema,
    )
    rows = {r.sk_id_curr: r for r in features.payment_features(payments).collect()}
    one = rows[1]
    assert (one.total_instalments, one.worst_payment_lag) == (3, -10)
    assert one.avg_payment_lag == pytest.approx(-5 / 3)
    assert one.late_payment_rate == pytest.approx(1 / 3)
    # A missing payment counts as a row that is not under-paid.
    assert (one.total_underpayments, one.underpayment_rate) == (1, pytest.approx(1 / 3))
    assert (one.avg_payment_ratio, one.min_payment_ratio) == (0.75, 0.5)
    assert one.overall_payment_completeness == 0.75
    assert rows[2].payment_lag_volatility is None


def test_previous_features_by_hand(spark):
    previous = spark.createDataFrame(
        [(1, 1, "Approved", 10.0, -1), (1, 2, "Refused", 30.0, -1), (2, 3, "Canceled", None, -2)],
        SPECS["previous_application"].schema,
    )
    rows = {r.sk_id_curr: r for r in features.previous_features(previous).collect()}
    assert (rows[1].prev_loan_count, rows[1].prev_approved_count) == (2, 1)
    assert (rows[1].prev_approval_rate, rows[1].avg_prev_credit) == (0.5, 20.0)
    assert rows[2].avg_prev_credit is None


def test_join_keeps_every_application_once(spark, small):
    t = CreditTables(spark, small)
    joined = queries.joined_features(t)
    assert joined.count() == queries.application(t).count() == joined.select("sk_id_curr").distinct().count()
    assert joined.filter(F.col("bureau_record_count").isNull()).count() > 0


def test_history_known_by(spark):
    day = lambda d: dt.date(2024, 1, d)
    apps = spark.createDataFrame([(1, 11, day(10)), (2, 12, day(10))], "sk_id_curr long, app long, app_date date")
    history = spark.createDataFrame(
        [(1, day(1), 5.0), (1, day(10), 2.0), (1, day(11), 9.0), (2, day(20), 1.0)], "sk_id_curr long, d date, amount double"
    )
    rows = {r.sk_id_curr: r for r in features.history_known_by(apps, history, "app", "app_date", "d", "amount").collect()}
    assert (rows[1].known_count, rows[1].known_amount, rows[1].days_since_last_known) == (2, 7.0, 0)
    assert (rows[2].known_count, rows[2].known_amount, rows[2].days_since_last_known) == (0, None, None)


def test_several_applications_of_one_id(spark):
    day = lambda m, d: dt.date(2024, m, d)
    apps = spark.createDataFrame([(1, "a", day(1, 10)), (1, "b", day(3, 10)), (1, "c", None)], "sk_id_curr long, app string, app_date date")
    history = spark.createDataFrame([(1, day(1, 1), 10.0), (1, day(2, 1), 5.0), (1, day(2, 1), 5.0), (1, None, 1.0)],
                                    "sk_id_curr long, d date, amount double")
    rows = {r.app: tuple(r)[2:] for r in features.history_known_by(apps, history, "app", "app_date", "d", "amount").collect()}
    assert rows == {"a": (1, 10.0, 9), "b": (3, 20.0, 38), "c": (0, None, None)}


def test_sums_of_large_and_small_amounts(spark):
    total = lambda values: spark.createDataFrame([(v,) for v in values], "x double").agg(S.exact_sum("x")).first()[0]
    assert total([5e14, 5e14]) == 1e15
    assert total([0.00004] * 1000) == pytest.approx(0.04)
    values = [1e12 / 7, 3.3, -2e11 / 3] * 40
    assert total(values) == pytest.approx(math.fsum(values), abs=1e-4)
    assert total([float("nan"), 1.0]) == 1.0
    for lost in (float("inf"), -1e33):
        with pytest.raises(Exception, match="cannot be added up exactly"):
            total([1.0, lost])


def test_one_applicant_with_most_of_the_rows(spark):
    bulk = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("sk_id_curr"),
        F.col("id").alias("sk_id_bureau"), F.lit("Active").alias("credit_active"), F.lit(-1).alias("days_credit"),
        F.lit(0).alias("credit_day_overdue"), F.lit(-1).alias("days_credit_enddate"), F.lit(0).alias("cnt_credit_prolong"),
        F.lit(0.1).alias("amt_credit_sum"), F.lit(0.1).alias("amt_credit_sum_debt"), F.lit("card").alias("credit_type"),
    )
    hot = features.bureau_features(bulk).filter("sk_id_curr = 7").first()
    assert hot.bureau_record_count == 10_001
    # Ten thousand tenths add up exactly, in whatever order.
    assert hot.total_bureau_credit == 1000.1
