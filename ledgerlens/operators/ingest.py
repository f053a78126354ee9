"""Cleaning: null pruning, id hashing, derived application columns and the point-in-time filter."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import scalars as S
from ledgerlens.operators.quality import columns_to_keep
from ledgerlens.schemas import MANDATORY, NULL_PCT_LIMIT, SPECS, TableSpec

ID = "sk_id_curr"


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def hash_ids(df: DataFrame, salt: str | None = None) -> DataFrame:
    """Replace the applicant id by its hash where the table has one; the same id hashes alike in every table."""
    if ID not in df.columns:
        return df
    return df.withColumn(ID, S.hashed_id(ID, salt))


def derived_columns() -> dict[str, Column]:
    return {
        "age_years": S.age_years(),
        "credit_income_ratio": S.ratio("amt_credit", "amt_income_total"),
        "annuity_income_ratio": S.ratio("amt_annuity", "amt_income_total"),
        "goods_price_credit_ratio": S.ratio("amt_goods_price", "amt_credit"),
        "is_employed": S.is_employed(),
        "days_employed_clean": S.employed_days(),
        "gender_enc": S.gender_code(),
        "owns_car": S.yes_flag("flag_own_car"),
        "owns_realty": S.yes_flag("flag_own_realty"),
    }


def prepare_application(
    raw: DataFrame,
    mandatory: Iterable[str] = MANDATORY["application_train"],
    null_pct_limit: float = NULL_PCT_LIMIT,
    keep: list[str] | None = None,
) -> DataFrame:
    """Applications known by day 0, mostly-null columns dropped, derived columns added; the id is left raw.

    Deciding what to drop costs one scan, unless the caller passes the names to keep.
    """
    raw = lower_names(raw)
    kept = keep if keep is not None else columns_to_keep(raw, mandatory, null_pct_limit)
    return raw.filter(F.col("days_birth") <= 0).select(*kept, *[c.alias(n) for n, c in derived_columns().items()])


def clean_application(raw: DataFrame, salt: str | None = None, **options) -> DataFrame:
    """The cleaned application table as it is written: ``prepare_application`` with the id hashed."""
    return hash_ids(prepare_application(raw, **options), salt)


def known_rule(df: DataFrame, mode: str = "strict", spec: TableSpec | None = None) -> Column:
    """Whether a row was known when the applicant applied.

    ``strict`` wants every ``days_*`` column at or before day 0 and drops rows where one is NULL. ``observed`` looks at
    the columns that date the observation itself, so a loan that ends in the future stays.
    """
    if mode == "strict":
        rules = [F.col(c) <= 0 for c in df.columns if c.startswith("days_")]
    elif mode == "observed" and spec is not None:
        rules = [F.col(c) <= 0 for c in spec.known_by]
        rules += [F.col(c).isNull() | (F.col(c) <= 0) for c in spec.known_if_set]
    else:
        raise ValueError("mode is 'strict', or 'observed' with a table spec")
    return S.all_of(rules) if rules else F.lit(True)


def known_by_application(df: DataFrame, mode: str = "strict", spec: TableSpec | None = None) -> DataFrame:
    """Keep the rows that were known when the applicant applied."""
    return df.filter(known_rule(df, mode, spec))


def prepare_history(raw: DataFrame, table: str, mode: str = "strict") -> DataFrame:
    """A history table with the point-in-time filter; the id is left raw for aggregation."""
    return known_by_application(lower_names(raw), mode, SPECS[table])


def clean_history(raw: DataFrame, table: str, mode: str = "strict", salt: str | None = None) -> DataFrame:
    """A history table as it is written: point-in-time filter, id hashed."""
    return hash_ids(prepare_history(raw, table, mode), salt)
