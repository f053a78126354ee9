import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ledgerlens.operators import evaluate, explain, model
from ledgerlens.plans.queries import QUERIES
from ledgerlens.session import scratch_path

import synthetic


def test_labels_are_coded_in_sorted_order(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3), (None, 4), ("C", 5)], "label string, n int")
    encoded, encoder = model.encode_categoricals(df, ["label", "absent"])
    assert encoder.labelsArray[0] == ("C", "MISSING", "a", "b") or list(encoder.labelsArray[0]) == ["C", "MISSING", "a", "b"]
    assert {r.n: r.label for r in encoded.collect()} == {1: 3, 2: 2, 3: 3, 4: 1, 5: 0}


def test_saved_encoder_rejects_new_labels(spark):
    seen = spark.createDataFrame([("a",), ("b",)], "label string")
    _, encoder = model.encode_categoricals(seen, ["label"])
    again, _ = model.encode_categoricals(seen.limit(1), ["label"], encoder)
    assert again.count() == 1
    with pytest.raises(Exception, match="Unseen label"):
        model.encode_categoricals(spark.createDataFrame([("z",)], "label string"), ["label"], encoder)[0].collect()


def test_matrix_has_the_configured_columns_that_exist(spark):
    df = spark.createDataFrame([(1000, "Cash", 0, 0), (2000, "Revolving", 1, 0)],
                               "amt_credit int, name_contract_type string, target int, non_existent_feature int")
    matrix, names, _ = model.feature_matrix(df)
    assert names == ["amt_credit", "name_contract_type"]
    assert matrix.columns == [*names, "target"] and matrix.count() == 2


@pytest.fixture(scope="module")
def rows(spark):
    apps = synthetic.applications(synthetic.applicants(spark, 400))
    signal = (F.col("ext_source_2") < 0.45).cast("int")
    gaps = F.when(F.col("sk_id_curr") % 5 > 0, F.col("ext_source_1"))
    return apps.withColumn("target", signal).withColumn("ext_source_1", gaps).cache()


def test_trees_learn_save_and_load(spark, rows):
    settings = model.TreeSettings(rounds=3, step=0.3, depth=3, min_rows=5)
    fitted = model.fit_trees(rows, "sk_id_curr", settings)
    scored = model.score(fitted, rows)
    assert scored.schema["ext_source_1"] == rows.schema["ext_source_1"]
    assert evaluate.roc_auc(scored, "score").first().auc > 0.95
    path = scratch_path(spark, "model")
    fitted.write().overwrite().save(path)
    loaded = model.score(PipelineModel.load(path), rows)
    assert loaded.select("sk_id_curr", "score").exceptAll(scored.select("sk_id_curr", "score")).count() == 0
    strongest = model.importance(fitted).orderBy(F.desc("importance")).first()
    assert strongest.feature == "ext_source_2"


def test_boosting_looks_past_its_best_round(spark, rows):
    noisy = rows.withColumn("target", F.when(F.xxhash64("sk_id_curr") % 4 == 0, 1 - F.col("target")).otherwise(F.col("target")))
    settings = model.TreeSettings(rounds=60, step=0.1, depth=2, min_rows=5, patience=20)
    fitted = model.fit_trees(noisy, "sk_id_curr", settings)
    kept = fitted.stages[-1].getNumTrees
    assert 1 < kept <= 60
    again = model.fit_trees(noisy, "sk_id_curr", settings)
    assert again.stages[-1].getNumTrees == kept
    one = model.fit_trees(noisy, "sk_id_curr", model.TreeSettings(rounds=1, depth=2, min_rows=5), early_stop=False)
    auc = lambda trees: evaluate.roc_auc(model.score(trees, noisy), "score").first().auc
    assert auc(fitted) >= auc(one)


def test_boosting_goes_on_from_a_model(spark, rows):
    settings = model.TreeSettings(rounds=6, together=2, block=4, step=0.2, depth=2, min_rows=5)
    first = model.fit_trees(rows, "sk_id_curr", settings, early_stop=False)
    path = scratch_path(spark, "model")
    first.write().overwrite().save(path)
    more = model.fit_trees(
        rows, "sk_id_curr", model.TreeSettings(rounds=12, together=2, block=4, step=0.2, depth=2, min_rows=5), early_stop=False,
        resume=PipelineModel.load(path),
    )
    assert (first.stages[-1].getNumTrees, more.stages[-1].getNumTrees) == (6, 12)
    loss = lambda m: model.score(m, rows).agg(F.avg(-F.log(F.when(F.col("target") == 1, F.col("score")).otherwise(1 - F.col("score"))))).first()[0]
    assert loss(more) < loss(first) < 0.69


def test_a_round_is_a_newton_step(spark):
    """One leaf: the margin moves by the step times gradient over curvature."""
    from pyspark.ml.linalg import Vectors

    from ledgerlens.operators import boosting

    data = [(Vectors.dense(1.0), 1.0 if i % 4 == 0 else 0.0, 1.0 + i % 2, False, i) for i in range(40)]
    rows = spark.createDataFrame(data, ["features", "label", "weight", "watched", "row"])
    s = boosting.BoostSettings(rounds=2, together=1, block=1, step=0.5, depth=2, row_share=1.0, column_share=1.0, min_rows=1)
    done = boosting.boost(rows, s)
    margin = 0.0
    for tree in done.trees:
        p = 1 / (1 + np.exp(-2 * margin))
        w, y = np.array([r[2] for r in data]), np.array([r[1] for r in data])
        expected = (w * 2 * (y - p)).sum() / (w * 4 * p * (1 - p)).sum()
        assert tree.predict(Vectors.dense(1.0)) == pytest.approx(expected)
        margin += 0.5 * expected
    score = done.model().transform(rows).first().probability[1]
    assert score == pytest.approx(1 / (1 + np.exp(-2 * margin)))


def test_scores_of_the_query(spark, small):
    rows = QUERIES["gbt_scores"](spark, small).collect()
    assert rows and all(0 < r.score < 1 for r in rows)  # too few rows here for a split that leaves 50 on either side
    gains = QUERIES["gbt_importance"](spark, small).collect()
    assert len(gains) == 60 and all(0 <= r.importance <= 1 for r in gains)


def test_a_saved_model_rejects_new_labels(spark, rows):
    fitted = model.fit_trees(rows, "sk_id_curr", model.TreeSettings(rounds=1, depth=2, min_rows=5), early_stop=False)
    path = scratch_path(spark, "model")
    fitted.write().overwrite().save(path)
    strange = rows.limit(3).withColumn("name_income_type", F.lit("Lottery"))
    with pytest.raises(Exception, match="Unseen label"):
        model.score(PipelineModel.load(path), strange).collect()
    known = model.fit_trees(
        rows, "sk_id_curr", model.TreeSettings(rounds=1, depth=2, min_rows=5), early_stop=False,
        codes=model.label_codes(rows.unionByName(strange)),
    )
    assert model.score(known, strange).count() == 3


def test_cross_validation_scores_every_row_once(rows):
    scored = model.cross_validate(rows, "sk_id_curr", 2, model.TreeSettings(rounds=1, depth=2, min_rows=5))
    assert scored.count() == 400 and scored.select("sk_id_curr").distinct().count() == 400


def test_linear_attribution_adds_up(rows):
    weights = {"ext_source_2": -2.0, "days_birth": 0.001}
    means = explain.feature_means(rows, list(weights))
    got = {r.feature: r.mean_abs_contribution for r in explain.global_attribution(rows, weights).collect()}
    values = [abs(-2.0 * (r.ext_source_2 - means["ext_source_2"])) for r in rows.collect()]
    assert got["ext_source_2"] == pytest.approx(sum(values) / len(values))
    local = explain.local_attribution(rows, "sk_id_curr", weights, k=1)
    assert local.count() == 400 and local.filter("rank <> 1").count() == 0


def test_sampled_attributions_add_up(spark, rows):
    """For any score a row's contributions sum up to its score less the mean of its donors'."""
    names = ["ext_source_2", "days_birth", "ext_source_3"]
    score = lambda df: df.withColumn("score", F.col("ext_source_2") * F.coalesce("ext_source_3", F.lit(0.5)) + F.sin("days_birth"))
    some = rows.select("sk_id_curr", *names)
    found = explain.sampled_attribution(some, "sk_id_curr", names, score, samples=3)
    assert found.count() == 400 * 3
    total = found.groupBy("sk_id_curr").agg(F.sum("contribution").alias("sum"))
    both = total.join(score(some), "sk_id_curr").select((F.col("score") - F.col("sum")).alias("base"))
    donors = score(some).agg(F.avg("score").alias("mean"), F.min("score").alias("low"), F.max("score").alias("high")).first()
    base = both.agg(F.avg("base"), F.min("base"), F.max("base")).first()
    assert base[0] == pytest.approx(donors.mean) and donors.low <= base[1] and base[2] <= donors.high


def test_sampled_attributions_of_a_linear_score(rows):
    weights = {"ext_source_2": -2.0, "days_birth": 0.001}
    score = lambda df: df.withColumn("score", explain.linear_score(weights))
    some = rows.select("sk_id_curr", *weights).filter("ext_source_2 IS NOT NULL AND days_birth IS NOT NULL")
    samples, n = 8, some.count()
    got = explain.sampled_attribution(some, "sk_id_curr", list(weights), score, samples).join(some, "sk_id_curr").collect()
    values = {c: np.array([r[c] for r in some.collect()], float) for c in weights}
    for c, w in weights.items():
        error = np.array([r.contribution - w * (r[c] - values[c].mean()) for r in got if r.feature == c])
        standard = abs(w) * values[c].std() / np.sqrt(samples)
        assert len(error) == n and abs(error).max() < 6 * standard and error.std() == pytest.approx(standard, rel=0.2)
    shares = {r.feature: r.mean_abs_contribution for r in explain.mean_absolute(explain.sampled_attribution(some, "sk_id_curr", list(weights), score)).collect()}
    assert set(shares) == set(weights)


def test_attributions_of_trees(spark, rows):
    fitted = model.fit_trees(rows, "sk_id_curr", model.TreeSettings(rounds=4, step=0.3, depth=3, min_rows=5), early_stop=False)
    inputs = [r.feature for r in model.importance(fitted).collect()]
    on_margin = lambda df: model.score(fitted, df).withColumn("score", explain.log_odds(F.col("score")))
    found = explain.sampled_attribution(rows.select("sk_id_curr", *inputs).limit(60), "sk_id_curr", inputs, on_margin, samples=1)
    strongest = explain.mean_absolute(found).orderBy(F.desc("mean_abs_contribution")).first()
    assert strongest.feature == "ext_source_2" and found.count() == 60 * len(inputs)


def test_permuting_the_only_used_feature_costs_all_the_auc(rows):
    score = lambda df: df.withColumn("score", -F.col("ext_source_2"))
    got = {r.feature: r for r in explain.permutation_importance(rows, "sk_id_curr", ["ext_source_2", "days_birth"], score).collect()}
    assert got["ext_source_2"].reference_auc == 1.0
    assert got["ext_source_2"].importance == pytest.approx(0.5, abs=0.1)
    assert got["days_birth"].importance == 0.0


def test_donors_are_exchanged_one_to_one(rows):
    pairs = explain.with_donors(rows, "sk_id_curr", ["sk_id_curr"]).select("sk_id_curr", F.col("donor.sk_id_curr").alias("d"))
    assert pairs.count() == pairs.select("d").distinct().count() == 400
    assert pairs.filter("sk_id_curr = d").count() < 20


def test_run_log_appends(spark):
    path = scratch_path(spark, "runs")
    model.log_run(spark, path, "r1", {"rounds": 5}, {"auc": 0.123456})
    model.log_run(spark, path, "r2", {"rounds": 6}, {"auc": 0.5})
    log = {tuple(r) for r in spark.read.parquet(path).collect()}
    assert ("r1", "metric", "auc", "0.1235") in log and len(log) == 4
