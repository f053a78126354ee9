"""Credit data drawn per applicant id, for tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.schemas import SPECS

# Parameters of the sample data.
DEFAULT_SHARE = 0.08
CONTRACTS = ("Cash loans", "Revolving loans")
GENDERS = ("M", "F")
FLAGS = ("Y", "N")
INCOMES = ("Working", "Commercial associate", "Pensioner")
EDUCATIONS = ("Secondary / secondary special", "Higher education")
FAMILIES = ("Married", "Single / not married")
HOUSINGS = ("House / apartment", "Rented apartment")
EMPLOYMENT_DAYS = (-1000, -2000, 365243)
OCCUPATIONS = ("Laborers", "Sales staff", "Core staff")
ORGANIZATIONS = ("Business Entity Type 3", "Self-employed", "Other")
LOAN_STATES = ("Closed", "Active")
CREDIT_TYPES = ("Consumer credit", "Credit card")
DECISIONS = ("Approved", "Refused", "Canceled")
BUREAU_PER_APPLICANT, LOANS_PER_APPLICANT, INSTALMENTS_PER_LOAN = 3, 2, 5


class Draws:
    """Seeded random columns keyed by row: the same row and seed give the same value on every run."""

    def __init__(self, row: Sequence[str], seed: int):
        self.row = [F.col(c) for c in row]
        self.seed = seed
        self.used = 0

    def uniform(self) -> Column:
        """A number in (0, 1) from a hash of the row's key, so a lost task draws the same again."""
        self.used += 1
        h = F.xxhash64(F.lit(self.seed * 1000 + self.used), *self.row)
        return (F.pmod(h, F.lit(2**52)).cast("double") + 0.5) / float(2**52)

    def normal(self) -> Column:
        return F.sqrt(-2 * F.log(self.uniform())) * F.cos(2 * F.pi() * self.uniform())

    def lognormal(self, mu: float, sigma: float) -> Column:
        return F.exp(F.lit(mu) + F.lit(sigma) * self.normal())

    def whole(self, low: int, high: int) -> Column:
        """A whole number in [low, high)."""
        return (F.floor(self.uniform() * (high - low)) + low).cast("int")

    def between(self, low: float, high: float) -> Column:
        return self.uniform() * (high - low) + low

    def choice(self, values: Sequence, shares: Sequence[float] | None = None) -> Column:
        if shares is None:
            return F.element_at(F.array(*[F.lit(v) for v in values]), self.whole(1, len(values) + 1))
        u, upto, picked = self.uniform(), 0.0, None
        for value, share in zip(values[:-1], shares[:-1]):
            upto += share
            picked = F.when(u < upto, F.lit(value)) if picked is None else picked.when(u < upto, F.lit(value))
        return picked.otherwise(F.lit(values[-1]))

    def beta(self, a: int, b: int) -> Column:
        """Beta for whole-numbered parameters, as a ratio of sums of exponentials."""
        left = sum((-F.log(self.uniform()) for _ in range(a)), F.lit(0.0))
        right = sum((-F.log(self.uniform()) for _ in range(b)), F.lit(0.0))
        return left / (left + right)


def applicants(spark: SparkSession, n: int = 100, first: int = 100_001) -> DataFrame:
    return spark.range(first, first + n).withColumnRenamed("id", "sk_id_curr")


def _shaped(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SPECS[table].schema])


def applications(ids: DataFrame, seed: int = 42) -> DataFrame:
    """One application per applicant id."""
    d = Draws(["sk_id_curr"], seed)
    rows = ids.select("sk_id_curr").withColumns(
        {
            "target": d.choice((0, 1), (1 - DEFAULT_SHARE, DEFAULT_SHARE)),
            "name_contract_type": d.choice(CONTRACTS),
            "code_gender": d.choice(GENDERS),
            "flag_own_car": d.choice(FLAGS),
            "flag_own_realty": d.choice(FLAGS),
            "cnt_children": d.whole(0, 5),
            "amt_income_total": F.round(d.lognormal(11.7, 0.5)),
            "amt_credit": F.round(d.lognormal(13.2, 0.6)),
            "amt_annuity": F.round(d.lognormal(10.5, 0.4)),
            "amt_goods_price": F.round(d.lognormal(13.1, 0.6)),
            "name_income_type": d.choice(INCOMES),
            "name_education_type": d.choice(EDUCATIONS),
            "name_family_status": d.choice(FAMILIES),
            "name_housing_type": d.choice(HOUSINGS),
            "days_birth": d.whole(-25000, -7000),
            "days_employed": d.choice(EMPLOYMENT_DAYS),
            "days_registration": d.whole(-15000, 0),
            "days_id_publish": d.whole(-5000, 0),
            "occupation_type": d.choice(OCCUPATIONS),
            "cnt_fam_members": d.whole(1, 6),
            "region_rating_client": d.whole(1, 4),
            "reg_city_not_work_city": d.whole(0, 2),
            "organization_type": d.choice(ORGANIZATIONS),
            "ext_source_1": d.beta(3, 2),
            "ext_source_2": d.beta(3, 2),
            "ext_source_3": d.beta(3, 2),
        }
    )
    return _shaped(rows, "application_train")


def _children(ids: DataFrame, count: int, name: str) -> DataFrame:
    return ids.select("sk_id_curr", F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name))


def bureau_records(ids: DataFrame, seed: int = 43) -> DataFrame:
    d = Draws(["sk_id_curr", "nr"], seed)
    rows = _children(ids, BUREAU_PER_APPLICANT, "nr").withColumns(
        {
            "sk_id_bureau": F.col("sk_id_curr") * BUREAU_PER_APPLICANT + F.col("nr"),
            "credit_active": d.choice(LOAN_STATES),
            "days_credit": d.whole(-3000, 0),
            "credit_day_overdue": d.choice((0, 10, 0)),
            "days_credit_enddate": d.whole(-1000, 1000),
            "cnt_credit_prolong": d.choice((0, 1, 0, 0)),
            "amt_credit_sum": d.lognormal(12, 1),
            "amt_credit_sum_debt": d.lognormal(11, 1),
            "credit_type": d.choice(CREDIT_TYPES),
        }
    )
    return _shaped(rows, "bureau")


def previous_loans(ids: DataFrame, seed: int = 44) -> DataFrame:
    d = Draws(["sk_id_curr", "nr"], seed)
    rows = _children(ids, LOANS_PER_APPLICANT, "nr").withColumns(
        {
            "sk_id_prev": F.col("sk_id_curr") * LOANS_PER_APPLICANT + F.col("nr"),
            "name_contract_status": d.choice(DECISIONS),
            "amt_credit": d.lognormal(12, 1),
            "days_decision": d.whole(-3000, 0),
        }
    )
    return _shaped(rows, "previous_application")


def instalments(ids: DataFrame, seed: int = 45) -> DataFrame:
    d = Draws(["sk_id_curr", "loan", "nr"], seed)
    per_loan = F.explode(F.sequence(F.lit(1), F.lit(INSTALMENTS_PER_LOAN)))
    rows = (
        _children(ids, LOANS_PER_APPLICANT, "loan")
        .select("sk_id_curr", "loan", per_loan.alias("nr"))
        .withColumns(
            {
                "sk_id_prev": F.col("sk_id_curr") * LOANS_PER_APPLICANT + F.col("loan"),
                "num_instalment_number": F.col("nr"),
                "days_instalment": d.whole(-500, 0),
                "days_entry_payment": d.whole(-500, 0),
                "amt_instalment": d.lognormal(10, 1),
                "amt_payment": d.lognormal(10, 1),
            }
        )
    )
    return _shaped(rows, "installments_payments")


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], SPECS[table].schema)


def all_tables(ids: DataFrame, seed: int = 42) -> dict[str, DataFrame]:
    """The seven tables for the given applicants; the three balance tables have columns but no rows."""
    spark = ids.sparkSession
    return {
        "application_train": applications(ids, seed),
        "bureau": bureau_records(ids, seed + 1),
        "bureau_balance": empty_table(spark, "bureau_balance"),
        "previous_application": previous_loans(ids, seed + 2),
        "installments_payments": instalments(ids, seed + 3),
        "credit_card_balance": empty_table(spark, "credit_card_balance"),
        "pos_cash_balance": empty_table(spark, "pos_cash_balance"),
    }
