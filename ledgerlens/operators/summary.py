"""Portfolio reports: segment summary, headline figures, histogram and the application explorer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import scalars as S
from ledgerlens.operators.ingest import ID
from ledgerlens.schemas import EXPLORER_COLUMNS, TARGET

# Summary grains, their columns, and the labels of the employment grain.
GRAINS = (
    ("contract_type", "name_contract_type"),
    ("income_type", "name_income_type"),
    ("education_type", "name_education_type"),
    ("region_rating", "region_rating_client"),
    ("employment_status", "is_employed"),
)
EMPLOYED, UNEMPLOYED = "Employed", "Unemployed"


def credit_summary(application: DataFrame) -> DataFrame:
    """Counts, default rate and mean amounts per segment, all five segmentations from one scan."""
    labels = [F.col(c).cast("string").alias(g) for g, c in GRAINS[:-1]]
    labels.append(F.when(F.col("is_employed") == 1, EMPLOYED).otherwise(UNEMPLOYED).alias(GRAINS[-1][0]))
    names = [g for g, _ in GRAINS]
    grouped = (
        application.select(*labels, TARGET, "amt_credit", "credit_income_ratio")
        .groupingSets([[F.col(g)] for g in names], *[F.col(g) for g in names])
        .agg(
            *[F.grouping(g).alias(f"_rolled_{g}") for g in names],
            F.count("*").alias("application_count"),
            F.sum(TARGET).cast("long").alias("default_count"),
            S.exact_sum("amt_credit").alias("_credit"),
            F.count("amt_credit").alias("_credit_known"),
            F.avg("credit_income_ratio").alias("avg_credit_income_ratio"),
        )
    )
    pick = lambda value: F.coalesce(*[F.when(F.col(f"_rolled_{g}") == 0, value(g)) for g in names])
    return grouped.select(
        pick(F.lit).alias("grain"),
        pick(F.col).alias("dim_value"),
        "application_count",
        "default_count",
        F.round(S.ratio(F.col("default_count") * 100, "application_count"), 2).alias("default_rate_pct"),
        S.ratio("_credit", "_credit_known").alias("avg_credit_amount"),
        "avg_credit_income_ratio",
    )


def slice_of(summary: DataFrame, grain: str) -> DataFrame:
    return summary.filter(F.col("grain") == grain).drop("grain")


def riskiest_first(summary: DataFrame) -> DataFrame:
    return summary.orderBy(F.col("default_rate_pct").desc(), "dim_value")


def headline_figures(summary: DataFrame, grain: str = "contract_type") -> DataFrame:
    """Totals over one grain. The mean credit is the plain mean of the segments' means."""
    return slice_of(summary, grain).agg(
        F.coalesce(F.sum("application_count"), F.lit(0)).cast("long").alias("total_applications"),
        F.coalesce(F.sum("default_count"), F.lit(0)).cast("long").alias("total_defaults"),
        F.coalesce(S.ratio(F.sum("default_count"), F.sum("application_count")), F.lit(0.0)).alias("default_rate"),
        F.avg("avg_credit_amount").alias("avg_of_group_avgs"),
    )


def weighted_mean_credit(summary: DataFrame, grain: str = "contract_type") -> DataFrame:
    """Mean credit over applications, from the segments' means and counts."""
    amount = F.sum(F.col("avg_credit_amount") * F.col("application_count"))
    return slice_of(summary, grain).agg(
        F.sum("application_count").cast("long").alias("total_applications"),
        S.ratio(amount, F.sum("application_count")).alias("weighted_avg_credit"),
    )


def default_rate(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("application_count"), F.avg(F.col(TARGET).cast("double")).alias("default_rate"))


def histogram(df: DataFrame, column: str, bins: int = 50, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins between the smallest and the largest value, counted per group. Empty bins are left out."""
    x = F.col(column).cast("double")
    lo, hi = df.agg(F.min(x), F.max(x)).first()
    known = df.filter(x.isNotNull())
    width = ((hi - lo) / bins if lo is not None else 0.0) or 1.0
    number = F.least(F.floor((x - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    return (
        known.groupBy(*by, number.alias("bin"))
        .agg(F.count("*").alias("row_count"))
        .withColumn("bin_start", F.lit(lo) + F.col("bin") * F.lit(width))
    )


def explore(
    df: DataFrame, contract: Sequence[str] = (), income: Sequence[str] = (), target: int | None = None
) -> DataFrame:
    """Filter applications; an empty list or None means no filter."""
    if contract:
        df = df.filter(F.col("name_contract_type").isin(*contract))
    if income:
        df = df.filter(F.col("name_income_type").isin(*income))
    if target is not None:
        df = df.filter(F.col(TARGET) == target)
    return df


def options(df: DataFrame, column: str) -> DataFrame:
    """The values a filter can take, in order."""
    return df.select(column).dropna().distinct().orderBy(column)


def sample_of(df: DataFrame, limit: int = 50_000, wanted: Sequence[str] = EXPLORER_COLUMNS) -> DataFrame:
    """The explorer's columns of the first applications by id."""
    return df.select(*S.present(df, wanted)).orderBy(ID).limit(limit)


def page(df: DataFrame, limit: int = 1000) -> DataFrame:
    """What the explorer shows: the first matches by id, the target under its display name."""
    return sample_of(df, limit).withColumnRenamed(TARGET, "DEFAULT")


def top(df: DataFrame, value: str, label: str, k: int) -> DataFrame:
    """The k largest values; ties go by label."""
    return df.orderBy(F.col(value).desc_nulls_last(), label).limit(k)


def match_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("match_count"))
