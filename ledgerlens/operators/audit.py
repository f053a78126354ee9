"""Leakage audit: columns, ids or missing values that give the target away."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from ledgerlens.functions.scalars import quoted, stacked, text
from ledgerlens.operators.ingest import ID
from ledgerlens.schemas import CORRELATION_LIMIT, ID_CORRELATION_LIMIT, TARGET


# The spread of a constant computed in floating point, as in a ratio that is 0.9 but for its last bits. Whole numbers and
# decimals have none.
ROUNDING = 1e-15
#: Columns whose sums one pass holds: a few numbers for each.
BLOCK = 8


def numeric_columns(df: DataFrame, without: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType) and f.name not in without]


def _report(check: str, values: DataFrame, limit: float) -> DataFrame:
    entries = [[text(check), text(n), quoted(n)] for n in values.columns]
    rows = stacked(values, entries, ["check", "feature", "value"])
    return rows.withColumn("flagged", F.coalesce(F.col("value") > limit, F.lit(False)))


def _correlations(df: DataFrame, names: list[str], target: str) -> list[DataFrame]:
    """Absolute Pearson correlations with the target over rows where both are known: one row for each block of columns.

    A first pass finds the smallest value of each column. The next sum up co-moments of the distances from it, which are
    kept centred as rows and partial sums are added, so large numbers lose no digits; a row stays one row, however many
    columns a block has. NULL, not an error, where either side is constant.
    """
    exact = {f.name: not isinstance(f.dataType, FloatType | DoubleType) for f in df.schema}
    lows = dict(zip(names, df.agg(*[F.expr(f"min({quoted(c)})").alias(f"low_{i}") for i, c in enumerate(names)]).first() or (), strict=True))
    blocks = [names[i : i + BLOCK] for i in range(0, len(names), BLOCK)]
    return [df.agg(*[F.expr(_correlation(c, lows[c], exact[c], target)).alias(c) for c in block]) for block in blocks]


def _correlation(column: str, low, exact: bool, target: str) -> str:
    y = f"CAST({quoted(target)} AS DOUBLE)"
    x = f"CASE WHEN {y} IS NOT NULL THEN CAST({quoted(column)} - {_literal(low, exact)} AS DOUBLE) END"
    y = f"CASE WHEN {quoted(column)} IS NOT NULL THEN {y} END"
    noise = "0D" if exact else f"{ROUNDING}D * greatest(abs({_number(low)}), abs(max({x}) + {_number(low)}))"
    return f"CASE WHEN max({x}) - min({x}) > {noise} AND max({y}) > min({y}) THEN sqrt(regr_r2({y}, {x})) END"


def _number(low) -> str:
    return "CAST(NULL AS DOUBLE)" if low is None else f"CAST('{low}' AS DOUBLE)"


def _literal(low, exact: bool) -> str:
    """A column's smallest value as a literal that subtracts without overflow or loss."""
    if low is None:
        return "CAST(NULL AS DOUBLE)"
    return f"CAST('{low}' AS DECIMAL(38,0))" if exact and abs(low) >= 1 << 53 else f"CAST('{low}' AS DOUBLE)"


def _correlation_report(check: str, df: DataFrame, names: list[str], target: str, limit: float) -> DataFrame:
    if not names:
        return df.sparkSession.createDataFrame([], "check string, feature string, value double, flagged boolean")
    return reduce(DataFrame.unionByName, [_report(check, values, limit) for values in _correlations(df, names, target)])


def correlation_audit(df: DataFrame, target: str = TARGET, limit: float = CORRELATION_LIMIT) -> DataFrame:
    """Absolute correlation of every numeric column with the target; each block of columns is read once."""
    return _correlation_report("correlation", df, numeric_columns(df, without=(target,)), target, limit)


def id_audit(df: DataFrame, id_col: str = ID, target: str = TARGET, limit: float = ID_CORRELATION_LIMIT) -> DataFrame:
    """Correlation of a numeric id with the target. A hashed id is text and yields no row."""
    return _correlation_report("id", df, [id_col] if id_col in numeric_columns(df) else [], target, limit)


def null_state_audit(
    df: DataFrame, id_col: str = ID, target: str = TARGET, limit: float = CORRELATION_LIMIT
) -> DataFrame:
    """Absolute correlation between a column being NULL and the target, from exact counts of one scan.

    Columns that are always or never NULL yield no row.
    """
    names = [c for c in df.columns if c not in (id_col, target)]
    positive = f"{quoted(target)} = 1"
    counted = df.selectExpr(
        "CAST(count(*) AS DOUBLE) AS n",
        f"CAST(count_if({positive}) AS DOUBLE) AS p",
        *[f"CAST(count(*) - count({quoted(c)}) AS DOUBLE) AS u{i}" for i, c in enumerate(names)],
        *[
            f"CAST(count_if({positive}) - count(CASE WHEN {positive} THEN {quoted(c)} END) AS DOUBLE) AS b{i}"
            for i, c in enumerate(names)
        ],
    )
    phi = "abs((n * b{0} - u{0} * p) / nullif(sqrt(u{0} * (n - u{0}) * p * (n - p)), 0D)) AS {1}"
    values = counted.selectExpr(*[phi.format(i, quoted(c)) for i, c in enumerate(names)])
    return _report("null_state", values, limit).filter(F.col("value").isNotNull())


def audit_report(df: DataFrame, id_col: str = ID, target: str = TARGET) -> DataFrame:
    """All three checks. Hand in a stored table: it is scanned once for each.

    A numeric id also takes part in the first check, like any other numeric column.
    """
    return (
        correlation_audit(df, target)
        .unionByName(id_audit(df, id_col, target))
        .unionByName(null_state_audit(df, id_col, target))
    )


def audit_verdict(report: DataFrame) -> DataFrame:
    """One row: how many findings each check has, and whether there is any."""
    found = lambda check: F.count_if(F.col("flagged") & (F.col("check") == check))
    return report.agg(
        found("correlation").alias("correlation_findings"),
        found("id").alias("id_findings"),
        found("null_state").alias("null_state_findings"),
        F.coalesce(F.max("flagged"), F.lit(False)).alias("leak_found"),
    )
