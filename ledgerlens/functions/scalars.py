"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.schemas import DAYS_PER_YEAR, NOT_EMPLOYED, STATUS_WORST_LAST


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hashed_id(c: str | Column, salt: str | None = None) -> Column:
    """SHA-256 of the id's text, then the hex digits of that hex text: 128 upper-case characters.

    The second encoding is part of the published key format, so keys match data hashed elsewhere.
    """
    text = as_column(c).cast("string")
    if salt is not None:
        text = F.concat(text, F.lit(salt))
    return F.upper(F.hex(F.sha2(text, 256)))


def ratio(num: str | Column, den: str | Column) -> Column:
    """Quotient in double precision, NULL for a zero denominator."""
    if isinstance(num, str) and isinstance(den, str):
        return F.expr(f"CAST({quoted(num)} AS DOUBLE) / nullif(CAST({quoted(den)} AS DOUBLE), 0D)")
    return as_column(num).cast("double") / F.nullif(as_column(den).cast("double"), F.lit(0.0))


def exact_sum(c: str) -> Column:
    """Sum of an amount that does not depend on the order in which partitions are merged.

    Amounts are rounded to six decimal places and totals count to 32 digits before the point; the result is a double. What is
    no number counts as unknown; an infinite amount, or one of more digits, raises.
    """
    too_long = f"raise_error('{c} cannot be added up exactly: ' || CAST({c} AS STRING))"
    known = f"CASE WHEN {c} IS NULL OR isnan({c}) THEN NULL WHEN abs({c}) < 1e31D THEN CAST({c} AS DECIMAL(38,6)) ELSE CAST({too_long} AS DECIMAL(38,6)) END"
    return F.expr(f"CAST(sum({known}) AS DOUBLE)")


def age_years(days_birth: str | Column = "days_birth") -> Column:
    return F.abs(as_column(days_birth)).cast("double") / F.lit(DAYS_PER_YEAR)


def is_employed(days_employed: str | Column = "days_employed") -> Column:
    return F.when(as_column(days_employed) == NOT_EMPLOYED, 0).otherwise(1)


def employed_days(days_employed: str | Column = "days_employed") -> Column:
    """Days employed with the not-employed sentinel as NULL."""
    return F.nullif(as_column(days_employed), F.lit(NOT_EMPLOYED))


def gender_code(c: str | Column = "code_gender") -> Column:
    return F.when(as_column(c) == "M", 1).when(as_column(c) == "F", 0)


def yes_flag(c: str | Column) -> Column:
    return F.when(as_column(c) == "Y", 1).otherwise(0)


def all_of(predicates: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, predicates)


def mean_of_known(*cols: str | Column) -> Column:
    """Mean over the values that are not NULL; NULL when all are."""
    parts = [as_column(c).cast("double") for c in cols]
    total = reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0.0)) for p in parts])
    known = reduce(lambda a, b: a + b, [F.when(p.isNull(), 0).otherwise(1) for p in parts])
    return total / F.nullif(known.cast("double"), F.lit(0.0))


def status_rank(c: str | Column = "status") -> Column:
    """Severity of a monthly status, 1 for the mildest; NULL for an unknown code."""
    return F.nullif(F.instr(F.lit(STATUS_WORST_LAST), as_column(c)), F.lit(0))


def status_of_rank(c: str | Column) -> Column:
    return F.substr(F.lit(STATUS_WORST_LAST), as_column(c), F.lit(1))


def present(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    """The wanted columns that the frame has."""
    return [c for c in wanted if c in df.columns]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """A string as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def stacked(df: DataFrame, entries: list[list[str]], names: list[str], keep: Iterable[str] = ()) -> DataFrame:
    """Turn a wide row into one row per entry; entries are lists of SQL expressions, one for each name."""
    items = ", ".join(e for entry in entries for e in entry)
    return df.selectExpr(*keep, f"stack({len(entries)}, {items}) AS ({', '.join(names)})")
