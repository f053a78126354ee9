"""Exact global ranks and running totals without a window over all rows.

Rows are cut into ordered parts. Each part is ranked or summed on its own, and starts from the totals of the parts
before it. Those totals are a frame with one row per part (and group), which is the only thing that is broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import staged

PART = "_part"


def ordered_parts(df: DataFrame, order: Sequence[Column], parts: int | None = None) -> DataFrame:
    """Range-partition by the order and number the parts. The rows are stored, so a part never changes."""
    ranged = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    return staged(ranged.withColumn(PART, F.spark_partition_id()), "parts")


def _with_starts(df: DataFrame, totals: DataFrame, sums: Sequence[str], within: Sequence[str]) -> DataFrame:
    """Attach what each part starts from. ``totals`` has one row per part and group: parts x groups, a bounded size."""
    earlier = Window.partitionBy(*within).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        PART, *within, *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).cast("long").alias(f"_start_{s}") for s in sums]
    )
    return df.join(F.broadcast(starts), [PART, *within])


def running_totals(
    df: DataFrame, order: Sequence[Column], sums: Mapping[str, str], within: Sequence[str] = (), parts: int | None = None
) -> DataFrame:
    """Add the running total of whole-number columns over all rows in the given order.

    ``sums`` maps each new column to the column it accumulates. ``within`` names groups that start from zero; it is
    meant for a handful of groups (classes, folds), as the part totals hold one row for each of them.
    """
    within = list(within)
    cut = ordered_parts(df, [*[F.col(c) for c in within], *order], parts)
    totals = cut.groupBy(PART, *within).agg(*[F.sum(c).alias(name) for name, c in sums.items()])
    so_far = Window.partitionBy(PART, *within).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = cut.withColumns({f"_local_{name}": F.sum(c).over(so_far) for name, c in sums.items()})
    summed = _with_starts(local, totals, list(sums), within)
    return summed.select(
        *df.columns,
        *[(F.col(f"_local_{s}") + F.col(f"_start_{s}")).cast("long").alias(s) for s in sums],
    )


def running_by_key(
    df: DataFrame, key: str, order: Sequence[str], sums: Mapping[str, Column], latest: Mapping[str, Column]
) -> DataFrame:
    """Add, for each row, sums and maxima over the rows of its key up to it in the given order.

    Unlike ``running_totals``, every key starts afresh. Rows are cut into ordered parts, so a busy key spreads over many
    tasks; the totals of a key's earlier parts are joined, one row for each key and part. Rows that tie in the order are
    taken one after the other.
    """
    cut = ordered_parts(df, [F.col(key), *map(F.col, order), F.rand(1)])
    kinds = {**{n: (F.sum, c) for n, c in sums.items()}, **{n: (F.max, c) for n, c in latest.items()}}
    totals = cut.groupBy(key, PART).agg(*[f(c).alias(n) for n, (f, c) in kinds.items()])
    earlier = Window.partitionBy(key).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        F.col(key).alias("_key"), F.col(PART).alias("_of"), *[f(n).over(earlier).alias(f"_start_{n}") for n, (f, _) in kinds.items()]
    )
    so_far = Window.partitionBy(PART, key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = cut.withColumns({f"_local_{n}": f(c).over(so_far) for n, (f, c) in kinds.items()})
    both = local.join(starts, F.col(key).eqNullSafe(F.col("_key")) & (F.col(PART) == F.col("_of")))
    zero = lambda n, kind: F.coalesce(F.col(f"_{kind}_{n}"), F.lit(0))
    return both.select(
        *df.columns,
        *[(zero(n, "local") + zero(n, "start")).alias(n) for n in sums],
        *[F.greatest(f"_local_{n}", f"_start_{n}").alias(n) for n in latest],
    )


def hash_order(id_text: Column, seed: int) -> Column:
    return F.sha2(F.concat(id_text, F.lit(str(seed))), 256)


def digits_for(rows: int, rows_per_part: int = 1_000_000) -> int:
    """Hex digits that cut so many rows into parts of about the given size; three are enough for some four billion."""
    digits = 3
    while 16**digits * rows_per_part < rows:
        digits += 1
    return digits


def shuffled_rank(
    df: DataFrame, id_col: str, seed: int, within: Sequence[str] = (), rank: str = "rank", size: str = "size",
    digits: int = 3,
) -> DataFrame:
    """Number the rows 1..n of each group in a seeded random order, and add the group's size.

    The order is that of a hash of the id. Its leading hex digits cut every group into evenly filled parts by
    themselves, so no sampling and no intermediate table is needed. ``digits_for`` gives the digits for a number of rows.
    """
    within = list(within)
    keyed = df.withColumn("_hash", hash_order(F.col(id_col).cast("string"), seed)).withColumn(
        PART, F.substr("_hash", F.lit(1), F.lit(digits))
    )
    totals = keyed.groupBy(PART, *within).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy(*within).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        PART, *within,
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_start"),
        F.sum("n").over(Window.partitionBy(*within)).alias(size),
    )
    local = F.row_number().over(Window.partitionBy(PART, *within).orderBy("_hash", id_col))
    return (
        keyed.withColumn("_local", local)
        .join(F.broadcast(starts), [PART, *within])
        .withColumn(rank, (F.col("_local") + F.col("_start")).cast("long"))
        .drop(PART, "_hash", "_local", "_start")
    )
