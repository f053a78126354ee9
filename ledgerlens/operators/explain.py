"""What drives a score: exact contributions of a linear score; sampled Shapley values and permutation importance of any score."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.scalars import quoted, stacked, text
from ledgerlens.operators.evaluate import roc_auc
from ledgerlens.operators.ranked import shuffled_rank
from ledgerlens.schemas import TARGET
from ledgerlens.session import staged


def linear_score(weights: Mapping[str, float], means: Mapping[str, float] | None = None) -> Column:
    """Weighted sum of features; an unknown value counts as its mean (or 0 without means)."""
    total = F.lit(0.0)
    for name, weight in weights.items():
        stand_in = F.lit(float(means[name]) if means else 0.0)
        total = total + F.lit(float(weight)) * F.coalesce(F.col(name).cast("double"), stand_in)
    return total


def feature_means(df: DataFrame, names: Sequence[str]) -> dict[str, float]:
    """Means as plain numbers, one per feature."""
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in names]).first()
    return {c: row[c] if row[c] is not None else 0.0 for c in names}


def contributions(weights: Mapping[str, float], means: Mapping[str, float]) -> dict[str, Column]:
    """Weight times distance from the mean: the exact attribution of a linear score with independent features."""
    return {
        c: F.coalesce(F.lit(float(w)) * (F.col(c).cast("double") - F.lit(float(means[c]))), F.lit(0.0))
        for c, w in weights.items()
    }


def global_attribution(df: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """Mean absolute contribution of each feature over all rows."""
    parts = contributions(weights, feature_means(df, list(weights)))
    means = df.agg(*[F.avg(F.abs(part)).alias(c) for c, part in parts.items()])
    return stacked(means, [[text(c), quoted(c)] for c in parts], ["feature", "mean_abs_contribution"])


def local_attribution(df: DataFrame, id_col: str, weights: Mapping[str, float], k: int = 3) -> DataFrame:
    """The k strongest contributions of every row, ranked by size; ties go by feature name."""
    parts = contributions(weights, feature_means(df, list(weights)))
    entries = F.array(
        *[
            F.struct((-F.abs(part)).alias("order"), F.lit(c).alias("feature"), part.alias("contribution"))
            for c, part in parts.items()
        ]
    )
    strongest = F.slice(F.array_sort(entries), 1, k)
    return df.select(id_col, F.posexplode(strongest).alias("pos", "entry")).select(
        id_col, (F.col("pos") + 1).alias("rank"), "entry.feature", "entry.contribution"
    )


def with_donors(df: DataFrame, id_col: str, features: Sequence[str], seeds: tuple[int, int] = (1, 2), digits: int = 3) -> DataFrame:
    """Give every row the features of another row, as struct ``donor``: a random one-to-one exchange.

    Both sides number all rows by a seeded hash and are joined on that number, so no key is frequent.
    """
    receivers = shuffled_rank(df, id_col, seeds[0], rank="_rank", size="_size", digits=digits).drop("_size")
    donors = shuffled_rank(df.select(id_col, *features), id_col, seeds[1], rank="_rank", size="_size", digits=digits).select(
        "_rank", F.struct(*features).alias("donor")
    )
    return receivers.join(donors, "_rank").drop("_rank")


def permutation_importance(
    df: DataFrame,
    id_col: str,
    features: Sequence[str],
    score: Callable[[DataFrame], DataFrame],
    label: str = TARGET,
    digits: int = 3,
) -> DataFrame:
    """Loss of AUC when one feature is exchanged between rows.

    ``score`` adds a column ``score``. The exchanged rows are stored and read once: each becomes one row as it is and one for
    every feature, with that feature replaced. All AUCs come from one ordered pass over the narrow (feature, score, label)
    rows.
    """
    exchanged = staged(with_donors(df, id_col, features, digits=digits), "exchanged")
    variants = exchanged.withColumn("_replaced", F.explode(F.array(*[F.lit(name) for name in ["", *features]])))
    taken = {c: F.when(F.col("_replaced") == c, F.col(f"donor.{c}")).otherwise(F.col(c)) for c in features}
    scored = score(variants.withColumns(taken).drop("donor")).select(F.col("_replaced").alias("feature"), "score", label)
    auc = roc_auc(scored, "score", label, ["feature"])
    # One row per feature from here on.
    unchanged = F.max(F.when(F.col("feature") == "", F.col("auc"))).over(Window.partitionBy(F.lit(1)))
    return (
        auc.select("feature", F.col("auc").alias("permuted_auc"), unchanged.alias("reference_auc"))
        .filter(F.col("feature") != "")
        .withColumn("importance", F.col("reference_auc") - F.col("permuted_auc"))
    )


def log_odds(score: Column) -> Column:
    """A probability on the scale on which the trees of a model add up."""
    return F.log(score / (1 - score))


def sampled_attribution(
    df: DataFrame,
    id_col: str,
    features: Sequence[str],
    score: Callable[[DataFrame], DataFrame],
    samples: int = 2,
    digits: int = 3,
) -> DataFrame:
    """(id, feature, contribution) of every row: Shapley values, estimated from ``samples`` donors and random orders.

    A sample gives a row another row as its donor and takes over the row's own features one by one, in an order drawn for
    the row. Each step changes the score, and the change is that feature's. The changes of a sample add up to the score less
    the donor's exactly, whatever the score is made of; their mean over samples has the Shapley value as its expectation,
    the rows being the background. ``score`` adds a column ``score``. Rows are multiplied by the features once, scored in
    place, and added up by row and feature before they are shuffled. Ids are unique.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    taken = {c: F.array_position("_order", c) <= F.col("_step") for c in features}
    own = df.select(id_col, *features)
    changes = []
    for k in range(samples):
        drawn = F.array_sort(
            F.array(*[F.struct(F.xxhash64(F.col(id_col), F.lit(c), F.lit(k)).alias("draw"), F.lit(c).alias("name")) for c in features])
        )
        paired = staged(
            with_donors(own, id_col, features, seeds=(2 * k + 1, 2 * k + 2), digits=digits).withColumn("_order", F.transform(drawn, lambda d: d["name"])),
            "paired",
        )
        steps = paired.withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(len(features)))))
        mixed = steps.withColumns({c: F.when(taken[c], F.col(c)).otherwise(F.col(f"donor.{c}")).cast(kinds[c]) for c in features})
        # A step's score ends one feature's change and begins the next one's.
        ends = F.struct(F.get("_order", F.col("_step") - 1).alias("feature"), F.col("score").alias("change"))
        begins = F.struct(F.get("_order", F.col("_step")).alias("feature"), (-F.col("score")).alias("change"))
        scored = score(mixed).select(id_col, F.explode(F.array(ends, begins)).alias("c"))
        changes.append(scored.select(id_col, "c.feature", "c.change").filter("feature IS NOT NULL"))
    summed = reduce(DataFrame.unionByName, changes).groupBy(id_col, "feature").agg(F.sum("change").alias("total"))
    return summed.select(id_col, "feature", (F.col("total") / samples).alias("contribution"))


def mean_absolute(attribution: DataFrame) -> DataFrame:
    """(feature, mean_abs_contribution) of attributions of rows."""
    return attribution.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs_contribution"))
