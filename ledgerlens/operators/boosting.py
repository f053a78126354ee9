"""Gradient boosting that goes on from where it stands: a few Spark regression trees a round, on a stored margin.

The margin of a row is half its log-odds, so a finished run is an ordinary Spark classification model. A round fits trees to
the rows' Newton steps, residual over curvature, weighted by curvature, so the mean in a leaf is the leaf's Newton step. Its
trees are fitted side by side, in the same passes over the rows, each to rows and columns drawn for it; as a step is short,
they come close to trees fitted one after the other. Trees since the margin was last stored are added as it is read; after a
block of rounds the margin is written and takes them in. So a round costs the same however many came before, a run can be
continued from any model, and a lost executor costs a round.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import discard, scratch_path

FEATURES, LABEL, WEIGHT, WATCHED, MARGIN, ROW = "features", "label", "weight", "watched", "margin", "row"
#: Least curvature of a row; the step times the weight stays the exact gradient.
LEAST_CURVATURE = 1e-6


@dataclass(frozen=True)
class BoostSettings:
    """How trees are drawn and grown, and when boosting ends: at ``rounds`` trees, or ``patience`` trees after the best one."""

    rounds: int = 1000
    #: Trees that are fitted side by side.
    together: int = 5
    step: float = 0.02
    depth: int = 6
    row_share: float = 0.8
    column_share: float = 0.8
    min_rows: int = 50
    patience: int = 50
    #: After so many trees the watched loss of each is looked at, and the margin is stored.
    block: int = 10
    #: Rows that a task gets at least; smaller tables take fewer tasks.
    rows_per_task: int = 4_000
    bins: int = 64
    seed: int = 42


@dataclass
class Boosted:
    """The trees of a run and the loss of the watched rows after each; the first ``best`` trees have the least."""

    trees: list[DecisionTreeRegressionModel]
    step: float
    losses: list[float] = field(default_factory=list)

    @property
    def best(self) -> int:
        if not self.losses:
            return len(self.trees)
        least = min(range(len(self.losses)), key=self.losses.__getitem__)
        return len(self.trees) - len(self.losses) + least + 1

    def model(self) -> GBTClassificationModel:
        """The trees up to the best round as a Spark model, which can be saved, loaded and put into a pipeline."""
        return _assembled("classification.GBTClassificationModel", self.trees[: self.best], self.step, GBTClassificationModel)


def _assembled(name: str, trees: Sequence[DecisionTreeRegressionModel], step: float, wrapper: type):
    """A Spark ensemble of these trees with one weight, by the ensemble's public constructor."""
    spark = SparkSession.getActiveSession()
    gateway, ml = spark.sparkContext._gateway, spark._jvm.org.apache.spark.ml
    tree_array = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
    weights = gateway.new_array(spark._jvm.double, len(trees))
    for i, tree in enumerate(trees):
        tree_array[i], weights[i] = tree._java_obj, step
    package, simple = name.split(".")
    ensemble = getattr(getattr(ml, package), simple)
    return wrapper(ensemble(f"boosted_{len(trees)}_{id(trees):x}", tree_array, weights))


def probability(margin: Column) -> Column:
    return 1 / (1 + F.exp(-2 * margin))


def _with_margin(rows: DataFrame, trees: Sequence[DecisionTreeRegressionModel], step: float) -> DataFrame:
    if not trees:
        return rows
    more = _assembled("regression.GBTRegressionModel", trees, step, GBTRegressionModel)
    added = more.setFeaturesCol(FEATURES).setPredictionCol("_more").transform(rows)
    return added.withColumn(MARGIN, F.col(MARGIN) + F.col("_more")).drop("_more")


def _steps(rows: DataFrame) -> DataFrame:
    """(features, step, curvature weight) of the rows that are learned from."""
    p = probability(F.col(MARGIN))
    curvature = F.greatest(4 * p * (1 - p), F.lit(LEAST_CURVATURE))
    return rows.filter(~F.col(WATCHED)).select(
        FEATURES, (2 * (F.col(LABEL) - p) / curvature).alias("_step"), (F.col(WEIGHT) * curvature).alias("_curvature")
    )


def _watched_losses(rows: DataFrame, trees: Sequence[DecisionTreeRegressionModel], step: float) -> list[float]:
    """Mean logistic loss of the watched rows, by weight, after each of these trees in turn; one pass."""
    seen = rows.filter(WATCHED)
    margin, losses = F.col(MARGIN), []
    for k, tree in enumerate(trees):
        seen = tree.copy().setFeaturesCol(FEATURES).setPredictionCol(f"_p{k}").transform(seen)
        margin = margin + step * F.col(f"_p{k}")
        wrong_way = F.when(F.col(LABEL) == 1, -2 * margin).otherwise(2 * margin)
        losses.append(F.greatest(wrong_way, F.lit(0.0)) + F.log1p(F.exp(-F.abs(wrong_way))))
    return list(seen.agg(*[F.sum(F.col(WEIGHT) * loss) / F.sum(WEIGHT) for loss in losses]).first())


class _Stored:
    """The rows with their margin, written and held ready for the rounds; only the latest table is kept."""

    def __init__(self, rows: DataFrame, tasks: int):
        self.path, self.tasks, spark = scratch_path(rows.sparkSession, "margins"), tasks, rows.sparkSession
        rows.coalesce(tasks).write.parquet(self.path)
        self.rows = spark.read.schema(rows.schema).parquet(self.path).coalesce(tasks).persist(StorageLevel.MEMORY_AND_DISK)

    def replaced(self, rows: DataFrame) -> _Stored:
        after = _Stored(rows, self.tasks)
        self.drop()
        return after

    def drop(self) -> None:
        self.rows.unpersist()
        discard(self.rows.sparkSession, self.path)


def boost(rows: DataFrame, s: BoostSettings, start: Boosted | None = None) -> Boosted:
    """Add trees to ``start``, or begin with none, until the watched loss has not fallen for ``patience`` trees.

    ``rows`` has features, label (0 or 1), weight, which rows are watched, those are never learned from, and a number ``row``
    that orders them, so that the same rows give the same trees. Without watched rows of both labels ``rounds`` trees are made.
    """
    done = Boosted(list(start.trees[: start.best]) if start else [], s.step)
    margin = F.lit(0.0).alias(MARGIN)
    n, kinds = rows.agg(F.count("*"), F.count_distinct(F.when(F.col(WATCHED), F.col(LABEL)))).first()
    tasks = max(1, -(-n // s.rows_per_task))
    dealt = rows.repartition(tasks, ROW).sortWithinPartitions(ROW)
    first = dealt.select(FEATURES, F.col(LABEL).cast("double").alias(LABEL), WEIGHT, WATCHED, margin)
    table = _Stored(_with_margin(first, done.trees, s.step), tasks)
    learner = RandomForestRegressor(
        featuresCol=FEATURES, labelCol="_step", weightCol="_curvature", maxDepth=s.depth, maxBins=s.bins,
        minInstancesPerNode=s.min_rows, subsamplingRate=s.row_share, featureSubsetStrategy=str(s.column_share), bootstrap=False,
    )
    try:
        while len(done.trees) < s.rounds:
            block: list[DecisionTreeRegressionModel] = []
            while len(block) < min(s.block, s.rounds - len(done.trees)):
                number = len(done.trees) + len(block)
                learner.setSeed(s.seed + number).setNumTrees(min(s.together, s.rounds - number))
                block += learner.fit(_steps(_with_margin(table.rows, block, s.step))).trees
            done.trees += block
            if kinds > 1:
                done.losses += _watched_losses(table.rows, block, s.step)
                if len(done.trees) - done.best >= s.patience:
                    break
            table = table.replaced(_with_margin(table.rows, block, s.step))
    finally:
        table.drop()
    return done
