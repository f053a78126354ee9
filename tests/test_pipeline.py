import os
import shutil

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import quality
from ledgerlens import __main__ as commands
from ledgerlens.operators.model import TreeSettings
from ledgerlens.plans import graph, pipeline
from ledgerlens.session import checkpoint_dir
from ledgerlens.sources import versions

import synthetic


@pytest.fixture(scope="module")
def raw_dir(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    for name, df in synthetic.all_tables(synthetic.applicants(spark, 300)).items():
        df.toPandas().to_csv(folder / f"{name}.csv", index=False)
    return folder


def test_full_run(spark, raw_dir, tmp_path):
    settings = TreeSettings(rounds=2, step=0.3, depth=2, min_rows=5)
    outcome = pipeline.run(spark, str(raw_dir), str(tmp_path), "r1", settings, auc_limit=0.0, folds=2)
    folder = checkpoint_dir(spark).removeprefix("file:")
    assert not [name for name in os.listdir(folder) if name.startswith(("run-", "rdd-"))]
    assert outcome.passed and 0 <= outcome.auc <= 1
    table = outcome.tables["credit_features"]
    assert table.count() == 300 and len(table.first().sk_id_curr) == 128
    assert outcome.tables["credit_summary"].select("grain").distinct().count() == 5
    late = quality.not_after_application(["days_credit", "days_credit_enddate"])
    assert {r.failed_rows for r in quality.failed_rows(outcome.tables["clean_bureau"], late).collect()} == {0}
    log = {r.name: r.value for r in spark.read.parquet(f"{tmp_path}/runs").collect()}
    assert log["rounds"] == "2" and float(log["holdout_auc"]) == pytest.approx(outcome.auc, abs=1e-4)
    assert outcome.tables["holdout_scores"].count() < 75
    assert (tmp_path / "r1" / "model").exists()
    folds = [float(log[f"fold_{k}_auc"]) for k in (1, 2)]
    assert sum(folds) / 2 == pytest.approx(float(log["cv_mean_auc"]), abs=1e-4)
    assert float(log["scale_pos_weight"]) > 1 and int(log["n_features"]) == len(csv_rows(tmp_path / "r1" / "importance_csv"))
    shown = csv_rows(tmp_path / "r1" / "explanation_csv")
    assert len(shown) == int(log["n_features"])
    assert len(csv_rows(tmp_path / "r1" / "attribution_csv")) == int(log["n_features"])
    assert outcome.tables["attribution"].count() == 300 * int(log["n_features"])
    features, stored = str(tmp_path / "r1" / "credit_features"), str(tmp_path / "r1" / "model")
    assert commands.main(["gate", stored, features, "--limit", "0.0"]) == 0
    assert commands.main(["gate", stored, features, "--limit", "1.1"]) == 1
    assert commands.main(["audit", features]) == int(outcome.leak_found)
    leaky = versions.read_table(spark, features).withColumn("leak", F.col("target") * 2)
    leaky.write.parquet(str(tmp_path / "leaky"))
    assert commands.main(["audit", str(tmp_path / "leaky")]) == 1
    finished = versions.open_run(spark, str(tmp_path / "r1"))
    assert set(finished) == set(outcome.tables) and finished["credit_features"].count() == 300


def csv_rows(folder):
    return next(folder.glob("part-*.csv")).read_text().splitlines()[1:]


def test_only_what_depends_on_a_changed_file_is_rebuilt(spark, raw_dir, tmp_path):
    raw, base = tmp_path / "raw", str(tmp_path / "r1")
    shutil.copytree(raw_dir, raw)
    first, rebuilt = pipeline.stored_tables(spark, str(raw), base)
    assert set(rebuilt) == set(first) >= {"clean_application", "clean_bureau", "credit_features", "credit_summary", "audit"}
    _, rebuilt = pipeline.stored_tables(spark, str(raw), base)
    assert rebuilt == []
    lines = (raw / "credit_card_balance.csv").read_text()
    (raw / "credit_card_balance.csv").write_text(lines + "\n")
    _, rebuilt = pipeline.stored_tables(spark, str(raw), base)
    assert rebuilt == ["clean_credit_card_balance"]
    payments = (raw / "installments_payments.csv").read_text().splitlines()
    (raw / "installments_payments.csv").write_text("\n".join(payments[:-5]) + "\n")
    tables, rebuilt = pipeline.stored_tables(spark, str(raw), base)
    assert set(rebuilt) == {"clean_installments_payments", "credit_features", "audit"}
    assert tables["clean_installments_payments"].count() < first["clean_installments_payments"].count()
    _, rebuilt = pipeline.stored_tables(spark, str(raw), base, salt="other")
    assert "clean_bureau" in rebuilt and "credit_summary" in rebuilt


def test_a_missing_file_is_named_before_any_job(spark, raw_dir, tmp_path):
    raw = tmp_path / "raw"
    shutil.copytree(raw_dir, raw)
    (raw / "bureau_balance.csv").unlink()
    spark.sparkContext.setJobGroup("missing", "")
    with pytest.raises(ValueError, match="credit_features needs bureau_balance"):
        pipeline.stored_tables(spark, str(raw), str(tmp_path / "r1"))
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("missing")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_tables_are_put_behind_their_sources():
    made = lambda name, *sources: graph.Table(name, sources, lambda t: None)
    ordered = graph.in_order([made("c", "b", "x"), made("b", "a"), made("a", "x")], ["x"])
    assert [t.name for t in ordered] == ["a", "b", "c"]
    with pytest.raises(ValueError, match="a needs y; b needs z"):
        graph.in_order([made("a", "y"), made("b", "z", "a")], ["x"])
    with pytest.raises(ValueError, match="made from each other: a, b"):
        graph.in_order([made("a", "b"), made("b", "a"), made("c")], [])


def test_a_missing_column_stops_the_run(spark, raw_dir, tmp_path):
    broken = tmp_path / "raw"
    broken.mkdir()
    for source in raw_dir.glob("*.csv"):
        (broken / source.name).write_text(source.read_text().replace("days_credit,", "days_lent,", 1))
    with pytest.raises(ValueError, match="days_credit"):
        pipeline.run(spark, str(broken), str(tmp_path), "r1")
