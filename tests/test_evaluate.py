import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from ledgerlens.operators import evaluate, ranked
from ledgerlens.session import bucketed


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(5)
    score = np.round(rng.random(2000), 2)
    target = (rng.random(2000) < 0.1 + 0.3 * score).astype(int)
    rows = [(i, float(s), int(t)) for i, (s, t) in enumerate(zip(score, target))]
    return spark.createDataFrame(rows, "id long, score double, target int").cache()


def brute_auc(rows):
    pos = np.array([r.score for r in rows if r.target == 1])[:, None]
    neg = np.array([r.score for r in rows if r.target == 0])[None, :]
    return ((pos > neg) + 0.5 * (pos == neg)).mean()


def brute_ap(rows):
    total, tp, seen, ap = sum(r.target for r in rows), 0, 0, 0.0
    for s in sorted({r.score for r in rows}, reverse=True):
        hits = sum(r.target for r in rows if r.score == s)
        seen += sum(1 for r in rows if r.score == s)
        tp += hits
        ap += hits / total * tp / seen
    return ap


def test_auc_and_average_precision(scored):
    rows = scored.collect()
    got = evaluate.ranking_metrics(evaluate.cumulative_counts(scored, "score")).first()
    assert got.auc == pytest.approx(brute_auc(rows), abs=1e-12)
    assert got.average_precision == pytest.approx(brute_ap(rows), abs=1e-12)
    raw = scored.withColumn("target", F.col("target").cast("double"))
    spark_auc = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="target", numBins=0).evaluate(raw)
    assert got.auc == pytest.approx(spark_auc, abs=1e-12)


def test_auc_symmetry_and_constant(scored):
    auc = lambda df: evaluate.roc_auc(df, "score").first()["auc"]
    assert auc(scored) + auc(scored.withColumn("score", -F.col("score"))) == pytest.approx(1.0)
    assert auc(scored.withColumn("score", F.lit(0.3))) == 0.5
    assert auc(scored.filter("target = 0")) is None


def test_running_totals_over_many_parts(scored):
    df = scored.withColumn("w", F.lit(1).cast("long")).withColumn("g", F.col("id") % 3)
    got = ranked.running_totals(df, [F.col("score").desc(), F.col("id")], {"upto": "w"}, within=["g"], parts=7)
    for g in range(3):
        rows = sorted(got.filter(F.col("g") == g).collect(), key=lambda r: (-r.score, r.id))
        assert [r.upto for r in rows] == list(range(1, len(rows) + 1))


def test_shuffled_rank_is_a_permutation(scored):
    rows = ranked.shuffled_rank(scored, "id", 9, ["target"]).collect()
    for target in (0, 1):
        mine = [r for r in rows if r.target == target]
        assert sorted(r["rank"] for r in mine) == list(range(1, len(mine) + 1))
        assert {r["size"] for r in mine} == {len(mine)}
    coarse = {r.id: r["rank"] for r in ranked.shuffled_rank(scored, "id", 9, ["target"], digits=1).collect()}
    assert coarse == {r.id: r["rank"] for r in rows}


def test_folds_and_holdout(scored):
    folds = evaluate.stratified_folds(scored, "id").groupBy("target", "fold").count().collect()
    for target in (0, 1):
        sizes = [r["count"] for r in folds if r.target == target]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    held = evaluate.stratified_holdout(scored, "id").groupBy("target").agg(F.sum("holdout").alias("h"), F.count("*").alias("n"))
    assert all(r.h == r.n // 5 for r in held.collect())


def wide_exchanges(df, wide):
    """How many shuffles of the plan carry a column of that name."""
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    blocks = [b for b in plan.split("\n\n") if b.lstrip().startswith("(")]
    return sum(wide in b for b in blocks if "Exchange" in b.splitlines()[0])


def test_folds_of_a_bucketed_table_move_ids_alone(spark, scored):
    rows = scored.withColumn("wide_column", F.repeat(F.col("id").cast("string"), F.lit(50)))
    stored = bucketed(rows, "rows", "id")
    joined = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(joined)
    spark.conf.set(joined, "-1")
    try:
        folds = evaluate.stratified_folds(stored, "id")
        assert wide_exchanges(folds, "wide_column") == 0 < wide_exchanges(evaluate.stratified_folds(rows, "id"), "wide_column")
        narrow = {r.id: r.fold for r in evaluate.stratified_folds(scored.select("id", "target"), "id").collect()}
        assert {r.id: r.fold for r in folds.collect()} == narrow
    finally:
        spark.conf.set(joined, before)


def test_confusion_and_report(spark):
    df = spark.createDataFrame([(0.5, 1), (0.7, 0), (0.1, 0), (0.2, 1), (0.9, 1)], "score double, target int")
    cells = {(r.actual, r.predicted): r.row_count for r in evaluate.confusion_matrix(df, "score").collect()}
    assert cells == {(0, 0): 1, (0, 1): 1, (1, 0): 1, (1, 1): 2}
    report = {r.label: r for r in evaluate.classification_report(df, "score").collect()}
    assert report["1"].precision == pytest.approx(2 / 3) and report["1"].support == 3
    assert report["accuracy"].f1_score == pytest.approx(0.6)
    assert report["macro avg"].recall == pytest.approx((0.5 + 2 / 3) / 2)
    none = {r.label: r for r in evaluate.classification_report(df.withColumn("score", F.lit(0.0)), "score").collect()}
    assert none["1"].precision == 0.0 and none["1"].f1_score == 0.0


def test_roc_points(spark):
    df = spark.createDataFrame([(0.9, 1), (0.9, 0), (0.1, 1), (0.0, 0)], "score double, target int")
    points = sorted((r.fpr, r.tpr, r.threshold) for r in evaluate.roc_points(df, "score").collect())
    assert points == [(0.0, 0.0, float("inf")), (0.5, 0.5, 0.9), (0.5, 1.0, 0.1), (1.0, 1.0, 0.0)]


def test_gate(scored):
    assert evaluate.model_gate(scored, "score", threshold=0.0).first().passed is True
    assert evaluate.model_gate(scored, "score", threshold=1.0).first().passed is False
    assert evaluate.model_gate(scored.filter("target = 0"), "score").first().passed is False


def test_class_weight(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "target int")
    assert tuple(evaluate.class_weight(df).first()) == (0.25, 3.0)
