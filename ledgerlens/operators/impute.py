"""Exact medians of many columns at once, overall or by group, and values filled in from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.scalars import quoted, stacked, text
from ledgerlens.operators.ranked import running_totals
from ledgerlens.schemas import MISSING_LABEL


def _grouped(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """A missing label is a label of its own."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(MISSING_LABEL)) for c in by})


def medians(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, n, median): one row for each group and column that has a value there; n counts the values.

    Equal values become one row with a count first. All columns are then ordered together, by group, column and value, in
    ordered parts, and the one or two values in the middle are read off the running counts. So nothing is approximate, no
    column is gathered, and the passes do not grow with the columns. ``by`` names columns of few labels.
    """
    by = list(by)
    entries = [[text(c), f"CAST({quoted(c)} AS DOUBLE)"] for c in columns]
    keys = [*by, "feature"]
    long = stacked(_grouped(df, by), entries, ["feature", "value"], [quoted(c) for c in by]).filter("value IS NOT NULL")
    counts = long.groupBy(*keys, "value").agg(F.count("*").alias("here"))
    upto = running_totals(counts, [F.col("value")], {"upto": "here"}, within=keys)
    totals = counts.groupBy(*keys).agg(F.sum("here").alias("n"))  # a row for each group and column
    placed = upto.join(totals, keys)
    at = lambda place: F.max(F.when((F.col("upto") - F.col("here") < place) & (place <= F.col("upto")), F.col("value")))
    low, high = F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1
    return placed.groupBy(*keys, "n").agg(((at(low) + at(high)) / 2).alias("median"))


def overall_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """The median of each column that has a value, as plain numbers."""
    return {r["feature"]: r["median"] for r in medians(df, columns).collect()}


def filled_statement(values: Mapping[str, float], suffix: str = "_filled") -> str:
    """SQL over ``__THIS__`` that adds each column with its gaps filled, for a stage of a model."""
    filled = [f"coalesce({quoted(c)}, CAST('{v!r}' AS DOUBLE)) AS {quoted(c + suffix)}" for c, v in values.items()]
    return f"SELECT {', '.join(['*', *filled])} FROM __THIS__"


def imputed(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The rows with gaps filled by the median of their group, or of all rows where the group has none."""
    by = list(by)
    pivot = medians(df, columns, by).groupBy(*by).agg(
        *[F.max(F.when(F.col("feature") == c, F.col("median"))).alias(f"_median_{c}") for c in columns]
    )
    own = pivot.withColumnsRenamed({c: f"_of_{c}" for c in by})
    rest = overall_medians(df, columns)
    same = [F.coalesce(F.col(c).cast("string"), F.lit(MISSING_LABEL)) == F.col(f"_of_{c}") for c in by]
    fill = {c: F.coalesce(F.col(c).cast("double"), F.col(f"_median_{c}"), F.lit(rest.get(c)).cast("double")) for c in columns}
    return df.join(own, same, "left").withColumns(fill).select(*df.columns)
