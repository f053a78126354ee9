"""Schemas, keys and column contracts of the seven credit tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

TYPES = {"long": LongType(), "int": IntegerType(), "double": DoubleType(), "string": StringType()}


@dataclass(frozen=True)
class TableSpec:
    """One source table, its columns written as "name type" pairs.

    ``known_by`` columns must be at or before the application (0) for a row to count as known then.
    ``known_if_set`` columns must be so only where they hold a value.
    """

    name: str
    columns: str
    key: str | None = None
    known_by: tuple[str, ...] = ()
    known_if_set: tuple[str, ...] = ()

    @property
    def schema(self) -> StructType:
        pairs = [c.split() for c in self.columns.split(", ")]
        return StructType([StructField(name, TYPES[kind]) for name, kind in pairs])


# Table names, keys, column names and types of the credit data.
MANIFEST = (
    TableSpec(
        "application_train",
        "sk_id_curr long, target int, name_contract_type string, code_gender string, flag_own_car string, "
        "flag_own_realty string, cnt_children int, amt_income_total double, amt_credit double, amt_annuity double, "
        "amt_goods_price double, name_income_type string, name_education_type string, name_family_status string, "
        "name_housing_type string, days_birth int, days_employed int, days_registration int, days_id_publish int, "
        "occupation_type string, cnt_fam_members int, region_rating_client int, reg_city_not_work_city int, "
        "organization_type string, ext_source_1 double, ext_source_2 double, ext_source_3 double",
        key="sk_id_curr",
        known_by=("days_birth",),
    ),
    TableSpec(
        "bureau",
        "sk_id_curr long, sk_id_bureau long, credit_active string, days_credit int, credit_day_overdue int, "
        "days_credit_enddate int, cnt_credit_prolong int, amt_credit_sum double, amt_credit_sum_debt double, "
        "credit_type string",
        key="sk_id_bureau",
        known_by=("days_credit",),
    ),
    TableSpec(
        "bureau_balance",
        "sk_id_bureau long, months_balance int, status string",
        known_by=("months_balance",),
    ),
    TableSpec(
        "previous_application",
        "sk_id_curr long, sk_id_prev long, name_contract_status string, amt_credit double, days_decision int",
        key="sk_id_prev",
        known_by=("days_decision",),
    ),
    TableSpec(
        "installments_payments",
        "sk_id_curr long, sk_id_prev long, num_instalment_number int, days_instalment int, days_entry_payment int, "
        "amt_instalment double, amt_payment double",
        known_by=("days_instalment",),
        known_if_set=("days_entry_payment",),
    ),
    TableSpec(
        "credit_card_balance",
        "sk_id_prev long, sk_id_curr long, months_balance int, amt_balance double, amt_credit_limit_actual double",
        known_by=("months_balance",),
    ),
    TableSpec(
        "pos_cash_balance",
        "sk_id_prev long, sk_id_curr long, months_balance int, cnt_instalment int, name_contract_status string",
        known_by=("months_balance",),
    ),
)

SPECS = {spec.name: spec for spec in MANIFEST}

# Columns a table must have (the data contract).
MANDATORY = {
    "application_train": (
        "sk_id_curr", "target", "ext_source_1", "ext_source_2", "ext_source_3",
        "amt_credit", "amt_annuity", "amt_income_total", "amt_goods_price",
        "days_birth", "days_employed", "code_gender", "flag_own_car", "flag_own_realty",
    ),
    "bureau": ("sk_id_curr", "days_credit"),
    "installments_payments": ("sk_id_curr", "days_instalment"),
}

# Thresholds and sentinels.
NULL_PCT_LIMIT = 60.0
NOT_EMPLOYED = 365243
DAYS_PER_YEAR = 365.25
MISSING_LABEL = "MISSING"
CORRELATION_LIMIT = 0.95
ID_CORRELATION_LIMIT = 0.05
AUC_LIMIT = 0.75
STATUS_WORST_LAST = "XC012345"

# Model inputs by source.
NUMERIC_FEATURES = (
    "amt_credit", "amt_annuity", "amt_income_total", "amt_goods_price",
    "credit_income_ratio", "annuity_income_ratio", "goods_price_credit_ratio",
    "gender_enc", "owns_car", "owns_realty",
    "cnt_children", "cnt_fam_members", "age_years",
    "is_employed", "days_employed_clean", "employment_age_ratio",
    "days_registration", "days_id_publish",
    "region_rating_client", "reg_city_not_work_city",
    "ext_source_1", "ext_source_2", "ext_source_3", "ext_source_avg",
    "bureau_record_count", "active_bureau_count", "closed_bureau_count",
    "days_since_last_bureau", "avg_days_credit",
    "total_days_overdue", "overdue_bureau_count", "max_days_overdue",
    "total_bureau_credit", "total_bureau_debt", "bureau_debt_ratio",
    "total_credit_prolongations", "distinct_credit_types",
    "bureau_debt_to_new_credit",
    "total_instalments", "avg_payment_lag", "worst_payment_lag",
    "payment_lag_volatility", "late_payment_rate",
    "total_underpayments", "underpayment_rate",
    "avg_payment_ratio", "min_payment_ratio", "overall_payment_completeness",
    "prev_loan_count", "prev_approved_count", "prev_approval_rate",
    "avg_prev_credit_ratio",
)
CATEGORICAL_FEATURES = (
    "name_contract_type", "name_income_type", "name_education_type", "name_family_status",
    "name_housing_type", "occupation_type", "organization_type", "worst_ever_bureau_status",
)
TARGET = "target"

# Columns of the explorer report.
EXPLORER_COLUMNS = (
    "sk_id_curr", "name_contract_type", "amt_credit", "amt_income_total",
    "credit_income_ratio", "name_income_type", "name_education_type",
    "age_years", "is_employed", "ext_source_2", "bureau_debt_ratio",
    "late_payment_rate", "target",
)
