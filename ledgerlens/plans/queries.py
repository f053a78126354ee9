"""The named queries, each over whole tables of one data folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ledgerlens import session
from ledgerlens.functions import scalars as S
from ledgerlens.operators import audit, evaluate, explain, features, impute, ingest, model, quality, summary, throttle
from ledgerlens.operators.ingest import ID
from ledgerlens.schemas import MANIFEST, SPECS, TARGET
from ledgerlens.sources.fixture_views import APPLICATION_CUTOFF, APPLICATION_HELPERS, CreditTables
from ledgerlens.sources.tables import row_counts
from ledgerlens.streaming import throttle as stream_throttle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Parameters that the oracle texts share.
SALT = "pepper-2024"
DRIFT_DATE = "1998-07-01"
ACCEPTED = {
    "code_gender": ("M", "F"),
    "name_contract_type": ("Cash loans", "Revolving loans"),
    "name_family_status": ("Married", "Single / not married"),
    "region_rating_client": (1, 2, 3),
}
EXPLORER_INCOMES = ("BUILDING", "MACHINERY")
# Small enough to bind at every test scale.
SAMPLE_ROWS, PAGE_ROWS = 100, 25
THROTTLE_LIMIT, THROTTLE_WINDOW_S = 2, 86_400
WEIGHTS = {
    "ext_source_2": -1.5,
    "bureau_debt_ratio": 0.8,
    "late_payment_rate": 1.25,
    "age_years": -0.0625,
    "is_employed": -0.25,
}


def query(fn: Callable[[CreditTables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(fn(CreditTables(session.configure(spark), sf_dir)))

    QUERIES[fn.__name__] = run
    return run


PLACES = 6
# A mean of two-digit ratios often ends on a five, where six places would round either way.
FINER_PLACES = {"avg_payment_ratio": 9, "mean_change": 9}


def rounded(df: DataFrame) -> DataFrame:
    """Round doubles once, at the very end, so engines that add up in another order agree."""
    exact = lambda f: S.quoted(f.name)
    places = lambda f: FINER_PLACES.get(f.name, PLACES)
    return df.selectExpr(
        *[
            f"round({exact(f)}, {places(f)}) AS {exact(f)}" if f.dataType == DoubleType() else exact(f)
            for f in df.schema
        ]
    )


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def raw_application(t: CreditTables) -> DataFrame:
    return t["application_train"].drop(*APPLICATION_HELPERS)


def application(t: CreditTables) -> DataFrame:
    """Applications with derived columns and a raw id. Pruning costs a scan, so it is left out where columns are named."""
    raw = raw_application(t)
    return ingest.prepare_application(raw, keep=raw.columns)


def history(t: CreditTables, table: str, mode: str = "strict") -> DataFrame:
    return ingest.prepare_history(t[table], table, mode)


def joined_features(t: CreditTables) -> DataFrame:
    t.share_applications()
    t.share_orders()
    return features.credit_features(
        ingest.prepare_application(raw_application(t)),
        features.bureau_features(history(t, "bureau"), history(t, "bureau_balance")),
        features.payment_features(history(t, "installments_payments")),
        features.previous_features(history(t, "previous_application")),
    )


def scored(t: CreditTables) -> DataFrame:
    """A fixed score with many ties; no training involved."""
    steps = F.floor(F.coalesce(F.col("ext_source_2"), F.lit(0.5)) * F.lit(20.0)) / F.lit(20.0)
    return application(t).select(ID, TARGET, (F.lit(1.0) - steps).alias("score"))


def risk_features(t: CreditTables, ids: list[int] | None = None) -> DataFrame:
    """Applications with the bureau and payment aggregates, for reports that need no more; of some ids, or of all."""
    of = lambda df: df if ids is None else df.filter(F.col(ID).isin(ids))
    return features.credit_features(
        of(application(t)),
        features.bureau_features(of(history(t, "bureau"))),
        features.payment_features(of(history(t, "installments_payments"))),
    )


def explorer_rows(t: CreditTables, ids: list[int] | None = None) -> DataFrame:
    return ingest.hash_ids(risk_features(t, ids).select(*summary.EXPLORER_COLUMNS))


def first_rows(t: CreditTables, applications: DataFrame, limit: int) -> DataFrame:
    """The explorer's rows of the first applications by hashed id: they are found first, and histories read for them alone."""
    first = applications.select(ID, S.hashed_id(ID).alias("_hash")).orderBy("_hash").limit(limit)
    return explorer_rows(t, [r[ID] for r in first.collect()])


def with_planted_leaks(t: CreditTables) -> DataFrame:
    """The stored feature table with three columns that leak the target and one constant; the id stays numeric."""
    planted = joined_features(t).withColumns(
        {
            "leak_offset": F.lit(10**15) + F.col(TARGET) * 100,
            "leak_score": (F.col(TARGET) * 100 + F.col(ID) % 3).cast("double"),
            "leak_null": F.when(F.col(TARGET) == 1, F.lit(1.0)),
            "constant_zero": F.lit(0.0),
        }
    )
    return session.staged(planted, "audited")


# --- Ingest and quality ---


@query
def ingest_row_counts(t):
    t.share_orders()
    return row_counts({spec.name: t[spec.name] for spec in MANIFEST})


@query
def null_profile(t):
    return quality.null_profile(raw_application(t))


@query
def kept_columns(t):
    return quality.column_decisions(raw_application(t), ingest.MANDATORY["application_train"])


@query
def contract_report(t):
    return quality.contract_report({name: t[name] for name in quality.MANDATORY})


@query
def key_uniqueness(t):
    return union(
        [
            quality.duplicate_keys(t[spec.name], spec.key).select(F.lit(spec.name).alias("table_name"), "*")
            for spec in MANIFEST
            if spec.key
        ]
    )


@query
def accepted_values(t):
    return quality.failed_rows(raw_application(t), quality.accepted_values(ACCEPTED))


def dated_columns(table: str) -> list[str]:
    return [f.name for f in SPECS[table].schema if f.name.startswith("days_")]


@query
def pit_audit(t):
    """Rows dated after the application, per date column, before and after the point-in-time filter."""
    t.share_orders()
    frames = []
    for table in ("bureau", "previous_application", "installments_payments"):
        raw = t[table]
        after = quality.not_after_application(dated_columns(table))
        known = ingest.known_rule(raw, "strict", SPECS[table])
        counted = quality.failed_rows(raw, after | {f"known {rule}": known & broken for rule, broken in after.items()})
        is_known = F.col("rule").startswith("known ")
        frames.append(
            counted.groupBy(F.regexp_replace("rule", "^known ", "").alias("rule")).agg(
                F.max(F.when(~is_known, F.col("failed_rows"))).alias("raw_rows_after"),
                F.max(F.when(is_known, F.col("failed_rows"))).alias("clean_rows_after"),
            ).select(F.lit(table).alias("table_name"), "*")
        )
    return union(frames)


@query
def quality_pass_rate(t):
    t.share_orders()
    apps = raw_application(t)
    results = quality.failed_rows(apps, quality.accepted_values(ACCEPTED))
    for table in ("bureau", "previous_application", "installments_payments"):
        results = results.unionByName(
            quality.failed_rows(history(t, table), quality.not_after_application(dated_columns(table)))
        )
    unique = quality.duplicate_keys(apps, ID).select(F.lit("unique id").alias("rule"), F.col("surplus_rows").alias("failed_rows"))
    return quality.quality_score(results.unionByName(unique), quality.null_profile(apps))


@query
def schema_drift(t):
    """The application view against a load in which a column is gone, one is new and one has another type."""
    apps = raw_application(t)
    changed = apps.drop("own_car_age").withColumns({"cnt_children": F.col("cnt_children").cast("string"), "tenure": F.lit(1)})
    return quality.schema_drift(apps, changed)


@query
def null_drift(t):
    """Applications before a date against those from that date on."""
    dated = t["application_train"]
    cut = F.col("app_date") < F.lit(DRIFT_DATE).cast("timestamp_ntz")
    return quality.null_drift(
        dated.filter(cut).drop(*APPLICATION_HELPERS), dated.filter(~cut).drop(*APPLICATION_HELPERS)
    )


@query
def clean_application(t):
    return ingest.clean_application(raw_application(t))


@query
def hash_salted(t):
    return raw_application(t).select(
        S.hashed_id(ID).alias(ID), S.hashed_id(ID, SALT).alias("salted_id")
    )


def _clean(table: str, name: str, mode: str = "strict") -> None:
    def run(t):
        return ingest.clean_history(t[table], table, mode)

    run.__name__ = name
    query(run)


_clean("bureau", "clean_bureau_pit")
_clean("installments_payments", "clean_installments_pit")
_clean("previous_application", "clean_previous_pit")
_clean("bureau_balance", "clean_bureau_balance")
_clean("credit_card_balance", "clean_credit_card")
_clean("pos_cash_balance", "clean_pos_cash")
_clean("bureau", "clean_bureau_observed", "observed")
_clean("installments_payments", "clean_installments_observed", "observed")
_clean("credit_card_balance", "clean_credit_card_observed", "observed")


# --- Features ---


@query
def bureau_features(t):
    return features.bureau_features(history(t, "bureau"), history(t, "bureau_balance"))


@query
def bureau_worst_status(t):
    worst = features.bureau_features(history(t, "bureau"), history(t, "bureau_balance"))
    return worst.select(ID, "worst_ever_bureau_status")


@query
def payment_features(t):
    return features.payment_features(history(t, "installments_payments"))


@query
def payment_features_observed(t):
    return features.payment_features(history(t, "installments_payments", "observed"))


@query
def prev_features(t):
    return features.previous_features(history(t, "previous_application"))


@query
def application_features(t):
    names = ["employment_age_ratio", "ext_source_avg", "ext_source_first"]
    return features.application_features(application(t)).select(ID, *names)


@query
def credit_features(t):
    return ingest.hash_ids(joined_features(t))


@query
def pit_join_absolute(t):
    """Every order as an application, with what was known of its customer's orders the day before."""
    orders = t.source("orders").select(F.col("o_custkey").alias(ID), "o_orderkey", "o_orderdate", "o_totalprice")
    apps = orders.filter(f"o_orderdate <= {APPLICATION_CUTOFF}").withColumn("app_date", F.expr("o_orderdate - INTERVAL 1 DAY"))
    return features.history_known_by(apps, orders, "o_orderkey", "app_date", "o_orderdate", "o_totalprice")


# --- Reports ---


@query
def credit_summary(t):
    return summary.credit_summary(application(t))


@query
def summary_by_region(t):
    return summary.riskiest_first(summary.slice_of(summary.credit_summary(application(t)), "region_rating"))


@query
def kpi_strip(t):
    return summary.headline_figures(summary.credit_summary(application(t)))


@query
def kpi_weighted(t):
    return summary.weighted_mean_credit(summary.credit_summary(application(t)))


@query
def default_rate(t):
    return summary.default_rate(application(t))


@query
def histogram_ratio(t):
    return summary.histogram(application(t), "credit_income_ratio", by=[TARGET])


@query
def explorer_filter(t):
    return summary.explore(explorer_rows(t), ["Cash loans"], EXPLORER_INCOMES, 1)


@query
def explorer_match_count(t):
    return summary.match_count(summary.explore(application(t), [], EXPLORER_INCOMES, 0))


@query
def explorer_options(t):
    return summary.options(raw_application(t), "occupation_type")


@query
def explorer_sample(t):
    return summary.sample_of(first_rows(t, application(t), SAMPLE_ROWS), SAMPLE_ROWS)


@query
def explorer_page(t):
    matches = summary.explore(application(t), ["Cash loans"])
    return summary.page(first_rows(t, matches, PAGE_ROWS), PAGE_ROWS)


@query
def top_features(t):
    report = audit.correlation_audit(with_planted_leaks(t))
    strongest = report.select("feature", F.round("value", 6).alias("value"))
    return summary.top(strongest, "value", "feature", 15)


# --- Leakage audit ---


@query
def audit_correlation(t):
    return audit.correlation_audit(with_planted_leaks(t))


@query
def audit_id(t):
    return audit.id_audit(application(t).select(ID, TARGET))


@query
def audit_null_state(t):
    return audit.null_state_audit(with_planted_leaks(t))


@query
def audit_verdict(t):
    return audit.audit_verdict(audit.audit_report(with_planted_leaks(t)))


# --- Modelling ---

ENCODED = (
    "name_contract_type", "name_income_type", "name_education_type", "name_family_status", "name_housing_type",
    "occupation_type", "organization_type",
)


@query
def label_encode(t):
    return model.encode_categoricals(application(t).select(ID, *ENCODED), ENCODED)[0]


@query
def feature_matrix(t):
    return model.feature_matrix(session.staged(joined_features(t), "features"))[0]


# Columns with gaps, and what they are filled in by.
IMPUTED, IMPUTED_BY = ("amt_goods_price", "own_car_age", "ext_source_1", "ext_source_2", "ext_source_3", "days_employed_clean"), "name_income_type"


@query
def impute_medians(t):
    """By income type, and of all applications under the label ALL."""
    rows = session.staged(application(t).select(IMPUTED_BY, *IMPUTED), "gaps")
    overall = impute.medians(rows, IMPUTED).withColumn(IMPUTED_BY, F.lit("ALL"))
    return impute.medians(rows, IMPUTED, [IMPUTED_BY]).unionByName(overall)


@query
def imputed_applications(t):
    rows = session.staged(application(t).select(ID, IMPUTED_BY, *IMPUTED), "gaps")
    return ingest.hash_ids(impute.imputed(rows, IMPUTED, [IMPUTED_BY]))


@query
def class_weight(t):
    return evaluate.class_weight(application(t))


@query
def stratified_folds(t):
    return evaluate.stratified_folds(application(t).select(ID, TARGET), ID)


@query
def stratified_holdout(t):
    return evaluate.stratified_holdout(application(t).select(ID, TARGET), ID)


@query
def roc_auc(t):
    return evaluate.roc_auc(scored(t), "score")


@query
def average_precision(t):
    return evaluate.average_precision(scored(t), "score")


@query
def roc_points(t):
    return evaluate.roc_points(scored(t), "score")


@query
def confusion_matrix(t):
    return evaluate.confusion_matrix(scored(t), "score")


@query
def classification_report(t):
    return evaluate.classification_report(scored(t), "score")


@query
def cv_summary(t):
    return evaluate.cv_summary(evaluate.stratified_folds(scored(t), ID), "score")


@query
def model_gate(t):
    return evaluate.model_gate(scored(t), "score")


@query
def metric_drift(t):
    """The holdout as serving data against the rest."""
    return evaluate.metric_drift(evaluate.stratified_holdout(scored(t), ID), "score", "holdout")


@query
def linear_attribution_global(t):
    return explain.global_attribution(session.staged(risk_features(t).select(ID, *WEIGHTS), "explained"), WEIGHTS)


@query
def linear_attribution_local(t):
    rows = session.staged(risk_features(t).select(ID, *WEIGHTS), "explained")
    return ingest.hash_ids(explain.local_attribution(rows, ID, WEIGHTS))


@query
def sampled_attribution(t):
    """Shapley values of the fixed linear score, by the way that takes any score."""
    rows = session.staged(risk_features(t).select(ID, *WEIGHTS), "explained")
    found = explain.sampled_attribution(rows, ID, list(WEIGHTS), lambda df: df.withColumn("score", explain.linear_score(WEIGHTS)))
    # No negative zero is left.
    change = (F.round("contribution", FINER_PLACES["mean_change"]) + F.lit(0.0)).alias("mean_change")
    return ingest.hash_ids(found.select(ID, "feature", change))


@query
def permutation_importance(t):
    rows = session.staged(risk_features(t).select(ID, TARGET, *WEIGHTS), "explained")
    score = lambda df: df.withColumn("score", explain.linear_score(WEIGHTS))
    return explain.permutation_importance(rows, ID, list(WEIGHTS), score)


@query
def gbt_scores(t):
    """The scores of a fifth of the applications by trees that have seen the others."""
    rows = session.staged(joined_features(t), "features")
    held = session.staged(evaluate.stratified_holdout(rows, ID), "held")
    trees = model.fit_trees(held.filter("holdout = 0"), ID, codes=model.label_codes(held))
    return ingest.hash_ids(model.score(trees, held.filter("holdout = 1")).select(ID, TARGET, "score"))


@query
def gbt_importance(t):
    rows = session.staged(joined_features(t), "features")
    return model.importance(model.fit_trees(rows, ID))


# --- Throttling ---


@query
def throttle_window(t):
    return throttle.trailing_counts(t.source("events"), "user_id", "ts", THROTTLE_WINDOW_S)


@query
def throttle_sliding_log(t):
    flagged = throttle.throttle_events(
        t.source("events"), "user_id", "ts", "event_id", THROTTLE_LIMIT, THROTTLE_WINDOW_S
    )
    return flagged.select("event_id", "user_id", "accepted")


# Events arrive up to so many seconds late, in this many deliveries.
LATEST_S, DELIVERIES = 3_600, 4


@query
def throttle_stream(t):
    """The same decisions taken by a stream over deliveries whose order is not that of time.

    The watermark stays a delivery and the largest lateness behind. A closing delivery, read after all others, takes it past
    every event.
    """
    events = t.source("events")
    late = F.pmod(F.xxhash64("event_id"), F.lit(LATEST_S))
    second = F.unix_seconds(F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min(second), F.max(second)).first()
    if first is None:
        return events.select("event_id", "user_id", F.lit(True).alias("accepted"))  # no events, no decisions
    span = (last - first + LATEST_S) // DELIVERIES + 1
    arrivals = events.withColumn("arrival", second + late)
    folder = session.scratch_path(t.spark, "deliveries")
    for k in range(DELIVERIES):
        delivered = arrivals.filter(F.floor((F.col("arrival") - first) / span) == k)
        delivered.drop("arrival").write.mode("append").parquet(folder)
    files = len(t.spark.read.schema(events.schema).parquet(folder).inputFiles())
    stream = stream_throttle.read_events(
        t.spark, folder, events.schema, "*.parquet", batch_files=max(1, files // DELIVERIES)
    )
    delay = span + LATEST_S
    flagged = stream_throttle.throttle_stream(
        stream, "user_id", "ts", "event_id", THROTTLE_LIMIT, THROTTLE_WINDOW_S, f"{delay} seconds"
    )
    out, checkpoint = session.scratch_path(t.spark, "flagged"), session.scratch_path(t.spark, "stream")
    stream_throttle.write_available(flagged, out, checkpoint)
    # One event, later than the last by more than the delay and the window. The watermark stays behind it, so it is never
    # judged itself, and it is too late to count for any other of its key.
    end = F.col("ts") + F.make_dt_interval(secs=F.lit(delay + THROTTLE_WINDOW_S + 1))
    closing = events.orderBy(F.col("ts").desc()).limit(1).withColumn("ts", end.cast(events.schema["ts"].dataType))
    closing.write.mode("append").parquet(folder)
    stream_throttle.write_available(flagged, out, checkpoint)
    judged = t.spark.read.schema(flagged.schema).parquet(out).filter("late_ms IS NULL")
    return judged.select("event_id", "user_id", "accepted")
