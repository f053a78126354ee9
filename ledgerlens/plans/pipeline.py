"""The whole run: raw files to clean tables, features, reports, audit, model and gate."""

from __future__ import annotations

import hashlib
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import session
from ledgerlens.operators import audit, evaluate, explain, features, ingest, model, quality, summary
from ledgerlens.operators.ingest import ID
from ledgerlens.operators.ranked import digits_for
from ledgerlens.schemas import AUC_LIMIT, MANDATORY, MANIFEST, SPECS, TARGET
from ledgerlens.plans.graph import Table, Tables, build, in_order
from ledgerlens.sources import versions
from ledgerlens.sources.tables import read_csv, write_csv

#: Applications whose contributions are sampled, against each other as background.
EXPLAINED_ROWS = 2_000


@dataclass(frozen=True)
class Outcome:
    """What a run came to. ``tables`` are the stored tables by name."""

    tables: dict[str, DataFrame]
    leak_found: bool
    auc: float
    passed: bool


def build_features(raw: Tables, application: DataFrame | None = None, pit: str = "strict") -> DataFrame:
    """The joined feature table from raw tables, hashed last: a 128-character key would be dear to shuffle."""
    known = lambda name: ingest.prepare_history(raw[name], name, pit)
    base = application if application is not None else ingest.prepare_application(raw["application_train"])
    return features.credit_features(
        base,
        features.bureau_features(known("bureau"), known("bureau_balance")),
        features.payment_features(known("installments_payments")),
        features.previous_features(known("previous_application")),
    )


def table_graph(pit: str, salt: str | None) -> list[Table]:
    """The stored tables of a run that need no model, with their sources."""
    settings = f"pit={pit} salt={hashlib.sha256((salt or '').encode()).hexdigest()}"
    prepared: list[DataFrame] = []

    def application(t: Tables) -> DataFrame:
        if not prepared:
            prepared.append(session.staged(ingest.prepare_application(t["application_train"]), "application"))
        return prepared[0]

    def clean(name: str) -> Table:
        return Table(f"clean_{name}", (name,), lambda t: ingest.clean_history(t[name], name, pit, salt), settings)

    return [
        Table("clean_application", ("application_train",), lambda t: ingest.hash_ids(application(t), salt), settings),
        *[clean(spec.name) for spec in MANIFEST[1:]],
        Table(
            "credit_features",
            ("application_train", "bureau", "bureau_balance", "installments_payments", "previous_application"),
            lambda t: ingest.hash_ids(build_features(t, application(t), pit), salt), settings,
        ),
        Table("credit_summary", ("clean_application",), lambda t: summary.credit_summary(t["clean_application"])),
        Table("audit", ("credit_features",), lambda t: audit.audit_report(t["credit_features"])),
    ]


def stored_tables(
    spark: SparkSession, raw_dir: str, base: str, pit: str = "strict", salt: str | None = None
) -> tuple[dict[str, DataFrame], list[str]]:
    """Bring the tables that need no model up to date; (tables, names of those that were rebuilt).

    A missing file is named before any job. The headers of all files are then checked, and a file is read once, where a
    table made from it is out of date; the copies hold raw ids and go with the run's scratch folder.
    """
    files = {spec.name: versions.fingerprint_of_files(spark, f"{raw_dir}/{spec.name}.csv") for spec in MANIFEST}
    graph = table_graph(pit, salt)
    in_order(graph, [name for name, mark in files.items() if mark is not None])
    raw = {name: read_csv(spark, raw_dir, SPECS[name]) for name in files}
    for table, required in MANDATORY.items():
        quality.assert_contract(raw[table], table, required)
    return build(spark, base, graph, files, lambda name: session.staged(raw[name], name))


def run(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    run_id: str,
    trees: model.TreeSettings = model.TreeSettings(),
    auc_limit: float = AUC_LIMIT,
    salt: str | None = None,
    pit: str = "strict",
    folds: int = 5,
) -> Outcome:
    """Bring everything below ``<out_dir>/<run_id>`` up to date.

    Tables whose files and settings are unchanged are kept. The model is fitted on four fifths of the applications and judged
    on the rest. Readers see the new tables all at once, by ``versions.open_run``, when the run has come to its end.
    """
    session.configure(spark)
    with session.run_scratch(spark):
        return _run(spark, raw_dir, out_dir, run_id, trees, auc_limit, salt, pit, folds)


def _run(spark, raw_dir, out_dir, run_id, trees, auc_limit, salt, pit, folds) -> Outcome:
    base = f"{out_dir}/{run_id}"
    stored, _ = stored_tables(spark, raw_dir, base, pit, salt)
    table = stored["credit_features"]

    def keep(df: DataFrame, name: str) -> DataFrame:
        stored[name] = versions.replace_table(df, f"{base}/{name}")
        return stored[name]

    # The audit comes before training.
    leak_found = audit.audit_verdict(stored["audit"]).first()["leak_found"]

    digits = digits_for(table.count())
    scores = session.staged(model.cross_validate(table, ID, folds, trees, digits), "cv-scores")
    by_fold = {r["fold"]: r["auc"] for r in evaluate.roc_auc(scores, "score", by=["fold"]).collect()}
    cv = evaluate.cv_summary(scores, "score").first()
    split = keep(evaluate.stratified_holdout(table, ID, digits=digits), "split")
    train = split.filter("holdout = 0").drop("holdout")
    fitted = model.fit_trees(train, ID, trees, codes=model.label_codes(table))
    path = versions.new_version(f"{base}/model")
    fitted.write().save(path)
    versions.move_pointer(spark, f"{base}/model", {"version": path.rsplit("/", 1)[1]})
    scored = keep(
        model.score(fitted, split.filter("holdout = 1")).select(ID, TARGET, "score"), "holdout_scores"
    )
    keep(evaluate.classification_report(scored, "score"), "classification_report")
    keep(evaluate.roc_points(scored, "score"), "roc_points")
    importance = model.importance(fitted)
    write_csv(importance.orderBy(F.desc("importance"), "feature"), f"{base}/importance_csv")
    inputs = [r["feature"] for r in importance.select("feature").collect()]
    explained = explain.permutation_importance(
        table.select(ID, TARGET, *inputs), ID, inputs, lambda df: model.score(fitted, df), digits=digits
    )
    write_csv(explained.orderBy(F.desc("importance"), "feature"), f"{base}/explanation_csv")
    some = session.staged(table.select(ID, *inputs).orderBy(F.xxhash64(ID)).limit(EXPLAINED_ROWS), "explained")
    on_margin = lambda df: model.score(fitted, df).withColumn("score", explain.log_odds(F.col("score")))
    attribution = keep(explain.sampled_attribution(some, ID, inputs, on_margin, digits=1), "attribution")
    write_csv(explain.mean_absolute(attribution).orderBy(F.desc("mean_abs_contribution"), "feature"), f"{base}/attribution_csv")

    gate = evaluate.model_gate(scored, "score", threshold=auc_limit).first()
    precision = evaluate.average_precision(scored, "score").first()["average_precision"]
    metrics = {
        "cv_mean_auc": cv["mean_auc"], "cv_std_auc": cv["std_auc"], "cv_mean_ap": cv["mean_average_precision"],
        "holdout_auc": gate["auc"], "holdout_ap": precision,
    } | {f"fold_{k + 1}_auc": auc for k, auc in sorted(by_fold.items())}
    weight = evaluate.class_weight(train).first()["positive_weight"]
    params = asdict(trees) | {
        "cv_strategy": f"stratified-{folds}", "pit": pit, "scale_pos_weight": round(weight, 2), "n_features": len(inputs),
        "trees": fitted.stages[-1].getNumTrees,
    }
    model.log_run(spark, f"{out_dir}/runs", run_id, params, metrics)
    versions.commit_run(spark, base, list(stored), ["model"])
    return Outcome(stored, leak_found, gate["auc"], gate["passed"])
