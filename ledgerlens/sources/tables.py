"""Reading the seven tables from files and writing results."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.schemas import MANIFEST, TableSpec


def read_csv(spark: SparkSession, raw_dir: str, spec: TableSpec) -> DataFrame:
    """One table from ``<raw_dir>/<name>.csv`` with a header row, under its declared types.

    Columns are matched by header name in any case and order; declared columns the file lacks are left out so that the
    contract check can name them. A missing file raises.
    """
    path = f"{raw_dir}/{spec.name}.csv"
    header = spark.read.csv(path, header=True).columns
    declared = {f.name: f.dataType for f in spec.schema}
    # A whole number may be written as 3.0 where its column has gaps, so such columns are parsed as doubles first; a
    # fraction raises.
    parsed = {name: T.DoubleType() if kind == T.IntegerType() else kind for name, kind in declared.items()}
    layout = T.StructType([T.StructField(c, parsed.get(c.lower(), T.StringType())) for c in header])
    rows = spark.read.csv(path, schema=layout, header=True, mode="FAILFAST")
    return rows.select(*[_typed(c, declared.get(c.lower(), T.StringType())).alias(c.lower()) for c in header])


def _typed(name: str, kind: T.DataType) -> Column:
    value = F.col(f"`{name}`")
    if kind != T.IntegerType():
        return value.cast(kind)
    told = F.concat(F.lit(f"{name} holds no whole number: "), value.cast("string"))
    return F.when(value != F.floor(value), F.raise_error(told).cast(kind)).otherwise(value.cast(kind))


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows of whatever job reads the frame next, without a job of its own."""
    rows = Observation(f"{name} rows")
    return df.observe(rows, F.count(F.lit(1)).alias("n")), rows


def load_all(spark: SparkSession, raw_dir: str, manifest: Iterable[TableSpec] = MANIFEST) -> dict[str, DataFrame]:
    return {spec.name: read_csv(spark, raw_dir, spec) for spec in manifest}


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def write_csv(df: DataFrame, path: str) -> None:
    """A small report as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)
