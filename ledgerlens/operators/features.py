"""Per-applicant features from each history table, and the joined feature table.

Every history table is aggregated before it is joined, on the raw id: a partial aggregate runs before the only shuffle,
so an applicant with very many rows costs one task no more than its partial results. Hash the id afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import scalars as S
from ledgerlens.operators.ingest import ID
from ledgerlens.operators.ranked import running_by_key


def count_where(condition) -> F.Column:
    return F.count_if(condition).cast("long")


def worst_status_per_loan(balance: DataFrame) -> DataFrame:
    """The most severe monthly status of each bureau loan, as a rank."""
    return balance.groupBy("sk_id_bureau").agg(F.max(S.status_rank()).alias("status_rank"))


def bureau_features(bureau: DataFrame, balance: DataFrame | None = None) -> DataFrame:
    if balance is None:
        bureau = bureau.withColumn("status_rank", F.lit(None).cast("int"))
    else:
        bureau = bureau.join(worst_status_per_loan(balance), "sk_id_bureau", "left")
    totals = bureau.groupBy(ID).agg(
        F.count("*").alias("bureau_record_count"),
        count_where(F.col("credit_active") == "Active").alias("active_bureau_count"),
        count_where(F.col("credit_active") == "Closed").alias("closed_bureau_count"),
        (-F.max("days_credit")).cast("int").alias("days_since_last_bureau"),
        F.avg("days_credit").alias("avg_days_credit"),
        F.sum("credit_day_overdue").cast("long").alias("total_days_overdue"),
        count_where(F.col("credit_day_overdue") > 0).alias("overdue_bureau_count"),
        F.max("credit_day_overdue").cast("int").alias("max_days_overdue"),
        S.exact_sum("amt_credit_sum").alias("total_bureau_credit"),
        S.exact_sum("amt_credit_sum_debt").alias("total_bureau_debt"),
        F.sum("cnt_credit_prolong").cast("long").alias("total_credit_prolongations"),
        F.count_distinct("credit_type").alias("distinct_credit_types"),
        F.max("status_rank").alias("status_rank"),
    )
    return totals.withColumns(
        {
            "bureau_debt_ratio": S.ratio("total_bureau_debt", "total_bureau_credit"),
            "worst_ever_bureau_status": S.status_of_rank("status_rank"),
        }
    ).drop("status_rank")


def payment_features(installments: DataFrame) -> DataFrame:
    lag = (F.col("days_instalment") - F.col("days_entry_payment")).cast("double")
    late = F.col("days_entry_payment") > F.col("days_instalment")
    under = F.col("amt_payment") < F.col("amt_instalment")
    paid_share = S.ratio("amt_payment", "amt_instalment")
    totals = installments.groupBy(ID).agg(
        F.count("*").alias("total_instalments"),
        F.avg(lag).alias("avg_payment_lag"),
        F.min(lag).cast("int").alias("worst_payment_lag"),
        F.stddev_samp(lag).alias("payment_lag_volatility"),
        F.avg(F.when(late, F.lit(1.0)).otherwise(F.lit(0.0))).alias("late_payment_rate"),
        count_where(under).alias("total_underpayments"),
        F.avg(paid_share).alias("avg_payment_ratio"),
        F.min(paid_share).alias("min_payment_ratio"),
        S.exact_sum("amt_payment").alias("total_paid"),
        S.exact_sum("amt_instalment").alias("total_owed"),
    )
    return totals.withColumns(
        {
            "underpayment_rate": S.ratio("total_underpayments", "total_instalments"),
            "overall_payment_completeness": S.ratio("total_paid", "total_owed"),
        }
    ).drop("total_paid", "total_owed")


def previous_features(previous: DataFrame) -> DataFrame:
    totals = previous.groupBy(ID).agg(
        F.count("*").alias("prev_loan_count"),
        count_where(F.col("name_contract_status") == "Approved").alias("prev_approved_count"),
        S.exact_sum("amt_credit").alias("total_prev_credit"),
        F.count("amt_credit").alias("prev_credit_known"),
    )
    return totals.withColumns(
        {
            "prev_approval_rate": S.ratio("prev_approved_count", "prev_loan_count"),
            "avg_prev_credit": S.ratio("total_prev_credit", "prev_credit_known"),
        }
    ).drop("total_prev_credit", "prev_credit_known")


def application_features(application: DataFrame) -> DataFrame:
    """Ratios and blends of the application's own columns that are not part of cleaning."""
    external = ["ext_source_1", "ext_source_2", "ext_source_3"]
    return application.withColumns(
        {
            "employment_age_ratio": S.ratio(F.abs("days_employed_clean"), F.abs("days_birth")),
            "ext_source_avg": S.mean_of_known(*external),
            "ext_source_first": F.coalesce(*external),
        }
    )


def credit_features(
    application: DataFrame,
    bureau: DataFrame | None = None,
    payments: DataFrame | None = None,
    previous: DataFrame | None = None,
) -> DataFrame:
    """One row per application with the given aggregates; applicants without history keep NULL there."""
    rows = application_features(application)
    for history in (bureau, payments, previous):
        if history is not None:
            rows = rows.join(history, ID, "left")
    if bureau is not None:
        rows = rows.withColumn("bureau_debt_to_new_credit", S.ratio("total_bureau_debt", "amt_credit"))
    if previous is not None:
        rows = rows.withColumn("avg_prev_credit_ratio", S.ratio("avg_prev_credit", "amt_credit")).drop("avg_prev_credit")
    return rows


def history_known_by(
    applications: DataFrame, history: DataFrame, key: str, app_date: str, event_date: str, amount: str
) -> DataFrame:
    """Point-in-time join on absolute dates: for each application, what the applicant's history adds up to by its date.

    ``key`` names the application; an applicant may have many. Events and applications of an applicant lie on one timeline
    on which totals run, so an applicant with very many of both costs no more than their sum. Events without a date are
    left out; an application without one knows nothing.
    """
    events = history.filter(F.col(event_date).isNotNull()).select(
        F.col(ID), F.col(event_date).alias("at"), F.lit(0).alias("is_application"),
        F.expr(f"try_cast({S.quoted(amount)} AS DECIMAL(38,6))").alias("amount"), F.col(event_date).alias("event_at"),
    )
    asked = applications.select(
        F.col(ID), F.col(key).alias("application"), F.col(app_date).alias("at"), F.lit(1).alias("is_application")
    )
    known = running_by_key(
        events.unionByName(asked, allowMissingColumns=True), ID, ["at", "is_application"],
        {"events": (1 - F.col("is_application")).cast("long"), "total": F.col("amount"), "valued": F.col("amount").isNotNull().cast("long")},
        {"last": F.col("event_at")},
    )
    return known.filter("is_application = 1").select(
        F.col("application").alias(key), ID, F.col("events").alias("known_count"),
        F.when(F.col("valued") > 0, F.col("total").cast("double")).alias("known_amount"),
        F.datediff("at", "last").alias("days_since_last_known"),
    )
