"""Data contracts, null profiles, rule checks and drift between two loads."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.scalars import quoted, stacked, text
from ledgerlens.schemas import MANDATORY, NULL_PCT_LIMIT


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    present = {c.lower() for c in df.columns}
    return [c for c in required if c.lower() not in present]


def assert_contract(df: DataFrame, table: str, required: Iterable[str]) -> DataFrame:
    """Return the frame unchanged, or raise when a required column is absent (case does not matter)."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"{table} lacks required columns: {missing}")
    return df


def contract_report(tables: Mapping[str, DataFrame], contract: Mapping[str, Sequence[str]] = MANDATORY) -> DataFrame:
    """One row per required column: is it there, and in how many of the table's rows is it empty."""

    def one(table: str) -> DataFrame:
        df = tables[table]
        absent = set(missing_columns(df, contract[table]))
        counts = [F.expr(f"count({quoted(c)})").alias(f"known_{c}") for c in contract[table] if c not in absent]
        entries = [
            [text(table), text(c), "false", "row_count", "CAST(NULL AS BIGINT)"]
            if c in absent
            else [text(table), text(c), "true", "row_count", f"row_count - {quoted(f'known_{c}')}"]
            for c in contract[table]
        ]
        return stacked(
            df.agg(F.count("*").alias("row_count"), *counts),
            entries,
            ["table_name", "column_name", "present", "row_count", "null_count"],
        )

    return reduce(DataFrame.unionByName, [one(t) for t in contract])


def null_profile(df: DataFrame) -> DataFrame:
    """Null share of every column, from one scan."""
    known = {c: f"known_{i}" for i, c in enumerate(df.columns)}
    counts = df.agg(F.count("*").alias("row_count"), *[F.expr(f"count({quoted(c)})").alias(k) for c, k in known.items()])
    entries = [[text(c.lower()), "row_count", f"row_count - {k}"] for c, k in known.items()]
    pct = F.col("null_count") * F.lit(100.0) / F.nullif(F.col("row_count"), F.lit(0))
    return stacked(counts, entries, ["column_name", "row_count", "null_count"]).withColumn("null_pct", F.round(pct, 2))


def column_decisions(df: DataFrame, mandatory: Iterable[str], limit: float = NULL_PCT_LIMIT) -> DataFrame:
    """The null profile with the keep-or-drop decision: drop above the limit, unless mandatory."""
    must_keep = F.col("column_name").isin(*mandatory)
    return null_profile(df).select(
        "column_name", "null_pct", (must_keep | ~F.coalesce(F.col("null_pct") > limit, F.lit(False))).alias("kept")
    )


def columns_to_keep(df: DataFrame, mandatory: Iterable[str], limit: float = NULL_PCT_LIMIT) -> list[str]:
    """Names to keep, in table order. Reads one row per column back to the driver."""
    decided = {r.column_name: r.kept for r in column_decisions(df, mandatory, limit).collect()}
    return [c.lower() for c in df.columns if decided[c.lower()]]


def failed_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per rule with the number of rows that break it. A rule is a predicate that marks a broken row."""
    counts = df.agg(*[F.count_if(broken).alias(f"r{i}") for i, broken in enumerate(rules.values())])
    return stacked(counts, [[text(name), f"r{i}"] for i, name in enumerate(rules)], ["rule", "failed_rows"])


def accepted_values(allowed: Mapping[str, Sequence]) -> dict[str, Column]:
    """Rules that a column holds listed values only; NULL passes."""
    return {
        f"{c} accepted": F.col(c).isNotNull() & ~F.col(c).isin(*values) for c, values in allowed.items()
    }


def not_after_application(columns: Iterable[str]) -> dict[str, Column]:
    """Rules that no row lies after the application (day 0)."""
    return {f"{c} not after application": F.col(c) > 0 for c in columns}


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """One row: how many key values occur, how many occur more than once, and how many rows repeat one."""
    return (
        df.groupBy(key)
        .count()
        .agg(
            F.count("*").alias("key_count"),
            F.count_if(F.col("count") > 1).alias("duplicate_keys"),
            F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("surplus_rows"),
        )
    )


def pass_rate(results: DataFrame) -> DataFrame:
    """Share of rules without a broken row, over a (rule, failed_rows) frame."""
    passed = (F.col("failed_rows") == 0).cast("int")
    return results.agg(
        F.count("*").alias("rule_count"),
        F.sum(passed).cast("long").alias("passed_count"),
        F.round(F.avg(passed.cast("double")) * 100, 4).alias("pass_rate_pct"),
    )


def quality_score(results: DataFrame, profile: DataFrame) -> DataFrame:
    """One row: the pass rate of the rules, the column with the largest null share, and a score of both.

    The score is the pass rate times the mean share of known values over all columns.
    """
    rows = results.select("rule", "failed_rows").unionByName(profile.select("column_name", "null_pct"), allowMissingColumns=True)
    passed = F.when(F.col("rule").isNotNull(), (F.col("failed_rows") == 0).cast("int"))
    share = F.round(F.avg(passed.cast("double")) * 100, 4)
    return rows.agg(
        F.count("rule").alias("rule_count"), F.sum(passed).cast("long").alias("passed_count"), share.alias("pass_rate_pct"),
        F.max_by("column_name", F.struct("null_pct", "column_name")).alias("worst_column"),
        F.max("null_pct").alias("max_null_pct"),
        F.round(share * F.avg(100 - F.col("null_pct")) / 100, 4).alias("quality_score_pct"),
    )


def null_drift(baseline: DataFrame, current: DataFrame, alert_points: float = 5.0) -> DataFrame:
    """Null share of each shared column in two loads, flagged when it rose by more than the given points."""
    pct = F.col("null_count") * F.lit(100.0) / F.nullif(F.col("row_count"), F.lit(0))
    before = null_profile(baseline).select("column_name", pct.alias("baseline_pct"))
    after = null_profile(current).select("column_name", pct.alias("current_pct"))
    rise = F.col("current_pct") - F.col("baseline_pct")
    return before.join(after, "column_name").select(
        "column_name", "baseline_pct", "current_pct", rise.alias("rise_points"), (rise > alert_points).alias("alert")
    )


def schema_drift(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """Columns that were added, removed or changed type between two loads."""
    spark = current.sparkSession
    shape = lambda df, as_name: spark.createDataFrame(
        [(f.name.lower(), f.dataType.simpleString()) for f in df.schema], f"column_name string, {as_name} string"
    )
    both = shape(baseline, "baseline_type").join(shape(current, "current_type"), "column_name", "full")
    return both.filter(~F.col("baseline_type").eqNullSafe(F.col("current_type")))
