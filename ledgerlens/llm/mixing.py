"""Mixing sources to target weights by repeating documents.

The words of every source are added up and its target share of the mix gives a repetition rate. A document is emitted
floor(rate) times, and once more where a number hashed from its id and text falls below the fraction that is left.

* Sources are ordered by code point, the missing source last, and take the given weights in turn.
* A target never exceeds ``most`` times its source; what is cut off is shared among the other sources by weight again,
  until no target is above its bound. Where the budget exceeds what all bounds allow, every source gets its bound.
* A missing text has no words, and so has a text of blanks only. Sources without words have target 0; documents without
  words are never copied. Repeated rows with the same id and text draw the same number, so reruns agree.
* Extra columns are carried along by ``mixed`` unchanged. An empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import WORD, fresh
from ledgerlens.operators.ranked import running_totals
from ledgerlens.session import staged


@dataclass(frozen=True)
class Mix:
    #: Weights of the sources in order, repeating.
    weights: Sequence[int] = (3, 1, 2)
    #: The size of the mix as a percentage of all words.
    percent: int = 150
    #: A source is repeated at most so often.
    most: int = 2
    seed: int = 17


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, text: Column, seed: int) -> Column:
    """A number in [0, 1) from 52 bits of a hash."""
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) for each source.

    Only the totals of the sources that have reached their bound travel to the driver, once for each round.
    """
    first, weights = F.col("source").isNull().cast("long"), F.array(*[F.lit(w) for w in mix.weights])
    one = sizes.withColumns({"_missing": first, "_one": F.lit(1)})
    placed = running_totals(one, [F.col("_missing"), F.col("source")], {"_place": "_one"})
    table = staged(
        placed.select(
            "source", "source_size",
            F.element_at(weights, ((F.col("_place") - 1) % len(mix.weights) + 1).cast("int")).cast("long").alias("weight"),
        ),
        "source-weights",
    )
    # Whole numbers throughout: budget and bounds are kept times 100, in 38 digits.
    exact = lambda n: F.lit(str(n)).cast("decimal(30,0)")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    budget, bound = total * mix.percent, F.col("source_size") * exact(mix.most * 100)
    left, open_weight, full = budget, None, -1
    while True:
        # A source is full where its share of what is left would reach its bound.
        is_full = F.lit(False) if open_weight is None else (F.col("weight") * exact(left) >= bound * exact(open_weight))
        row = table.select(is_full.alias("full"), "weight", bound.alias("bound")).agg(
            F.sum(F.when(~F.col("full"), F.col("weight"))), F.sum(F.when(F.col("full"), F.col("bound"))),
            F.count_if("full"),
        ).first()
        if row[2] == full or not row[0]:
            break
        open_weight, left, full = row[0], budget - int(row[1] or 0), row[2]
    if open_weight is None or not row[0]:
        target = F.col("source_size").cast("double") * mix.most
    else:
        share = (F.col("weight") * exact(left)).cast("double") / F.lit(float(open_weight * 100))
        target = F.when(is_full, F.col("source_size").cast("double") * mix.most).otherwise(share)
    return table.select("source", "source_size", target.alias("target"))


def copies(docs: DataFrame, mix: Mix = Mix(), doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, draw, source_size, target, n_copies) for each document."""
    sized = staged(
        docs.select(
            F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"),
            draw(F.col(doc_id), F.col(text), mix.seed).alias("draw"),
        ),
        "sizes",
    )
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), mix)
    t = targets.select(F.col("source").alias("_source"), "source_size", "target")
    # A plain join: the documents of a hot source are split by the adaptive planner.
    return sized.join(t, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn(
        "n_copies", n_copies("draw", "target", "source_size")
    )


def n_copies(draw: str, target: str, size: str) -> Column:
    rate = F.col(target) / F.nullif(F.col(size), F.lit(0))
    whole = F.floor(rate)
    return F.coalesce(whole + (F.col(draw) < rate - whole).cast("long"), F.lit(0)).cast("long")


def mixed(docs: DataFrame, mix: Mix = Mix(), doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken."""
    sizes = staged(docs.select(F.col(source).alias("source"), n_words(F.col(text)).alias("size")), "sizes")
    targets = source_targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), mix)
    key, size, target, number, times = (fresh(docs, c) for c in ("_source", "_size", "_target", "_draw", "_copies"))
    t = targets.select(F.col("source").alias(key), F.col("source_size").alias(size), F.col("target").alias(target))
    drawn = docs.withColumn(number, draw(F.col(doc_id), F.col(text), mix.seed)).join(
        t, F.col(source).eqNullSafe(F.col(key))
    )
    taken = drawn.withColumn(times, n_copies(number, target, size)).filter((F.col(times) > 0) & (n_words(F.col(text)) > 0))
    return taken.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times).cast("int")))).select(*docs.columns)
