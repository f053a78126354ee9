"""Splits and metrics for a binary score, exact at any number of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.scalars import stacked, text
from ledgerlens.operators.ranked import running_totals, shuffled_rank
from ledgerlens.schemas import AUC_LIMIT, TARGET

SEED = 42


def class_weight(df: DataFrame, label: str = TARGET) -> DataFrame:
    """One row: the default rate p and the weight (1-p)/p that balances the positive class."""
    p = F.avg(F.col(label).cast("double"))
    return df.agg(p.alias("default_rate")).withColumn(
        "positive_weight", (F.lit(1.0) - F.col("default_rate")) / F.nullif(F.col("default_rate"), F.lit(0.0))
    )


def _dealt(df: DataFrame, id_col: str, label: str, seed: int, digits: int) -> DataFrame:
    """The rows with the rank of their id among the shuffled ids of their class, and the size of the class.

    Ids and labels alone are ranked. Wider rows are joined with the ranks by id; of a bucketed table they are not moved.
    """
    ranked = shuffled_rank(df.select(id_col, label), id_col, seed, [label], "_rank", "_size", digits)
    if len(df.columns) == 2:
        return ranked
    # Ids are unique; were one not, its rows would stay together.
    places = ranked.groupBy(id_col).agg(F.min("_rank").alias("_rank"), F.max("_size").alias("_size"))
    return df.join(places, id_col, "left")


def stratified_folds(
    df: DataFrame, id_col: str, label: str = TARGET, folds: int = 5, seed: int = SEED, fold: str = "fold", digits: int = 3
) -> DataFrame:
    """Deal the shuffled rows of each class to the folds in turn; sizes differ by one row per class at most."""
    ranked = _dealt(df, id_col, label, seed, digits)
    return ranked.withColumn(fold, ((F.col("_rank") - 1) % folds).cast("int")).drop("_rank", "_size")


def stratified_holdout(
    df: DataFrame, id_col: str, label: str = TARGET, one_in: int = 5, seed: int = SEED, flag: str = "holdout",
    digits: int = 3,
) -> DataFrame:
    """Mark the first fifth (or other whole share) of each class's shuffled rows."""
    ranked = _dealt(df, id_col, label, seed, digits)
    return ranked.withColumn(flag, (F.col("_rank") * one_in <= F.col("_size")).cast("int")).drop("_rank", "_size")


def score_counts(df: DataFrame, score: str, label: str = TARGET, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score: equal scores collapse before anything is ordered."""
    positive = F.col(label).cast("long")
    return df.groupBy(*by, F.col(score).alias("score")).agg(F.sum(positive).alias("p"), F.sum(1 - positive).alias("n"))


def cumulative_counts(df: DataFrame, score: str, label: str = TARGET, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score, the true and false positives when that score is the threshold."""
    return running_totals(
        score_counts(df, score, label, by), [F.col("score").desc()], {"tp": "p", "fp": "n"}, within=by
    )


def ranking_metrics(cumulative: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC (ties count half) and average precision (step sum) from cumulative counts."""
    p, n, tp, fp = (F.col(c).cast("double") for c in ("p", "n", "tp", "fp"))
    pos, neg = F.nullif(F.sum(p), F.lit(0.0)), F.nullif(F.sum(n), F.lit(0.0))
    return cumulative.groupBy(*by).agg(
        (F.sum(n * (tp - p / 2)) / (pos * neg)).alias("auc"),
        (F.sum(p * tp / (tp + fp)) / pos).alias("average_precision"),
    )


def roc_auc(df: DataFrame, score: str, label: str = TARGET, by: Sequence[str] = ()) -> DataFrame:
    return ranking_metrics(cumulative_counts(df, score, label, by), by).select(*by, "auc")


def average_precision(df: DataFrame, score: str, label: str = TARGET, by: Sequence[str] = ()) -> DataFrame:
    return ranking_metrics(cumulative_counts(df, score, label, by), by).select(*by, "average_precision")


def roc_points(df: DataFrame, score: str, label: str = TARGET) -> DataFrame:
    """The ROC curve: one point per distinct score, and the origin at an infinite threshold."""
    cumulative = cumulative_counts(df, score, label)
    totals = cumulative.agg(F.sum("p").cast("double").alias("P"), F.sum("n").cast("double").alias("N"))
    per_class = lambda total: F.nullif(total.scalar(), F.lit(0.0))
    curve = cumulative.select(
        (F.col("fp") / per_class(totals.select("N"))).alias("fpr"),
        (F.col("tp") / per_class(totals.select("P"))).alias("tpr"),
        F.col("score").cast("double").alias("threshold"),
    )
    origin = totals.select(F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(float("inf")).alias("threshold"))
    return curve.unionByName(origin)


def predicted_class(score: str | Column, threshold: float = 0.5) -> Column:
    return ((F.col(score) if isinstance(score, str) else score) >= threshold).cast("int")


def _cells(df: DataFrame, score: str, label: str, threshold: float) -> list[Column]:
    predicted = predicted_class(score, threshold)
    return [
        F.count_if((F.col(label) == a) & (predicted == b)).alias(name)
        for name, a, b in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))
    ]


def confusion_matrix(df: DataFrame, score: str, label: str = TARGET, threshold: float = 0.5) -> DataFrame:
    """All four cells, empty ones included, from one scan."""
    cells = df.agg(*_cells(df, score, label, threshold))
    entries = [["0", "0", "tn"], ["0", "1", "fp"], ["1", "0", "fn"], ["1", "1", "tp"]]
    return stacked(cells, entries, ["actual", "predicted", "row_count"])


def _or_zero(num: Column, den: Column) -> Column:
    return F.coalesce(num / F.nullif(den, F.lit(0.0)), F.lit(0.0))


def classification_report(df: DataFrame, score: str, label: str = TARGET, threshold: float = 0.5) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, plain and weighted means. 0 where undefined."""
    cells = df.agg(*_cells(df, score, label, threshold))
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    total = tn + fp + fn + tp
    measured = cells.select(
        *[
            c.alias(n)
            for n, c in {
                "p0": _or_zero(tn, tn + fn), "r0": _or_zero(tn, tn + fp), "s0": tn + fp,
                "p1": _or_zero(tp, tp + fp), "r1": _or_zero(tp, tp + fn), "s1": tp + fn,
                "acc": _or_zero(tn + tp, total), "total": total,
            }.items()
        ]
    )
    f1 = lambda p, r: _or_zero(2 * F.col(p) * F.col(r), F.col(p) + F.col(r))
    measured = measured.withColumns({"f0": f1("p0", "r0"), "f1": f1("p1", "r1")})
    plain = lambda m: f"({m}0 + {m}1) / 2"
    weighted = lambda m: f"coalesce(({m}0 * s0 + {m}1 * s1) / nullif(total, 0D), 0D)"
    entries = [
        [text("0"), "p0", "r0", "f0", "s0"],
        [text("1"), "p1", "r1", "f1", "s1"],
        [text("accuracy"), "acc", "acc", "acc", "total"],
        [text("macro avg"), *[plain(m) for m in "prf"], "total"],
        [text("weighted avg"), *[weighted(m) for m in "prf"], "total"],
    ]
    rows = stacked(measured, entries, ["label", "precision", "recall", "f1_score", "support"])
    return rows.withColumn("support", F.col("support").cast("long"))


def cv_summary(scored: DataFrame, score: str, label: str = TARGET, fold: str = "fold") -> DataFrame:
    """Mean and population deviation of the folds' AUC, and their mean average precision."""
    per_fold = ranking_metrics(cumulative_counts(scored, score, label, [fold]), [fold])
    return per_fold.agg(
        F.count("*").alias("fold_count"),
        F.avg("auc").alias("mean_auc"),
        F.stddev_pop("auc").alias("std_auc"),
        F.avg("average_precision").alias("mean_average_precision"),
    )


def model_gate(df: DataFrame, score: str, label: str = TARGET, threshold: float = AUC_LIMIT) -> DataFrame:
    """One row: the AUC, the limit and whether the model passes."""
    return roc_auc(df, score, label).select(
        "auc", F.lit(threshold).alias("threshold"), F.coalesce(F.col("auc") >= threshold, F.lit(False)).alias("passed")
    )


def headline_metrics(df: DataFrame, score: str, by: str, label: str = TARGET, threshold: float = 0.5) -> DataFrame:
    """AUC, accuracy, precision and recall of each group, in long form."""
    auc = roc_auc(df, score, label, [by])
    cells = df.groupBy(by).agg(*_cells(df, score, label, threshold))
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    wide = cells.join(auc, by).select(
        by, "auc",
        _or_zero(tn + tp, tn + fp + fn + tp).alias("accuracy"),
        _or_zero(tp, tp + fp).alias("precision"),
        _or_zero(tp, tp + fn).alias("recall"),
    )
    return wide.unpivot(by, ["auc", "accuracy", "precision", "recall"], "metric", "value")


def metric_drift(df: DataFrame, score: str, serving: str, label: str = TARGET) -> DataFrame:
    """Training against serving: ``serving`` is a 0/1 column that tells the two apart."""
    side = lambda flag: F.max(F.when(F.col(serving) == flag, F.col("value")))
    return (
        headline_metrics(df, score, serving, label)
        .groupBy("metric")
        .agg(side(0).alias("training_value"), side(1).alias("serving_value"))
        .withColumn("delta", F.col("serving_value") - F.col("training_value"))
    )
