"""DuckDB texts that compute each named query independently, from the same Parquet tables."""

from __future__ import annotations

import re

from ledgerlens.plans import queries as q
from ledgerlens.schemas import (
    AUC_LIMIT, CATEGORICAL_FEATURES, CORRELATION_LIMIT, EXPLORER_COLUMNS, ID_CORRELATION_LIMIT, MANDATORY, MANIFEST,
    NUMERIC_FEATURES, SPECS,
)
from ledgerlens.sources.fixture_views import APPLICATION, APPLICATION_CUTOFF, APPLICATION_HELPERS, oracle_view

RAW_COLUMNS = [c for c in APPLICATION if c not in APPLICATION_HELPERS]
KEPT_COLUMNS = [c for c in RAW_COLUMNS if c != "own_car_age"]
DOUBLES_IN_RAW = ["amt_income_total", "amt_credit", "amt_annuity", "amt_goods_price", "ext_source_1", "ext_source_2",
                  "ext_source_3", "own_car_age"]
HASH = "upper(hex(sha256(CAST(sk_id_curr AS VARCHAR))))"


def r6(expression: str, name: str | None = None) -> str:
    places = q.FINER_PLACES.get(name or expression, q.PLACES)
    return f"ROUND({expression}, {places}) AS {name or expression}"


def money(expression: str) -> str:
    return f"CAST(SUM(CAST({expression} AS DECIMAL(38,6))) AS DOUBLE)"


def div(num: str, den: str) -> str:
    return f"CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0)"


DERIVED = {
    "age_years": "CAST(abs(days_birth) AS DOUBLE) / CAST(365.25 AS DOUBLE)",
    "credit_income_ratio": div("amt_credit", "amt_income_total"),
    "annuity_income_ratio": div("amt_annuity", "amt_income_total"),
    "goods_price_credit_ratio": div("amt_goods_price", "amt_credit"),
    "is_employed": "CASE WHEN days_employed = 365243 THEN 0 ELSE 1 END",
    "days_employed_clean": "CASE WHEN days_employed = 365243 THEN NULL ELSE days_employed END",
    "gender_enc": "CASE WHEN code_gender = 'M' THEN 1 WHEN code_gender = 'F' THEN 0 END",
    "owns_car": "CASE WHEN flag_own_car = 'Y' THEN 1 ELSE 0 END",
    "owns_realty": "CASE WHEN flag_own_realty = 'Y' THEN 1 ELSE 0 END",
}
DERIVED_DOUBLES = ["age_years", "credit_income_ratio", "annuity_income_ratio", "goods_price_credit_ratio"]

STRICT = {
    "bureau": "days_credit <= 0 AND days_credit_enddate <= 0",
    "previous_application": "days_decision <= 0",
    "installments_payments": "days_instalment <= 0 AND days_entry_payment <= 0",
    "bureau_balance": "TRUE",
    "credit_card_balance": "TRUE",
    "pos_cash_balance": "TRUE",
}
OBSERVED = {
    "bureau": "days_credit <= 0",
    "installments_payments": "days_instalment <= 0 AND (days_entry_payment IS NULL OR days_entry_payment <= 0)",
    "credit_card_balance": "months_balance <= 0",
}

STEPS: dict[str, str] = {spec.name: oracle_view(spec.name) for spec in MANIFEST}
STEPS["app"] = (
    "SELECT *, "
    + ", ".join(f"{e} AS {c}" for c, e in DERIVED.items())
    + " FROM application_train WHERE days_birth <= 0"
)
for _name, _rule in STRICT.items():
    STEPS[f"known_{_name}"] = f"SELECT * FROM {_name} WHERE {_rule}"
for _name, _rule in OBSERVED.items():
    STEPS[f"observed_{_name}"] = f"SELECT * FROM {_name} WHERE {_rule}"

BUREAU_DOUBLES = ["avg_days_credit", "total_bureau_credit", "total_bureau_debt", "bureau_debt_ratio"]
STEPS["bureau_agg"] = f"""
SELECT *, total_bureau_debt / NULLIF(total_bureau_credit, 0) AS bureau_debt_ratio FROM (
  SELECT b.sk_id_curr, COUNT(*) AS bureau_record_count,
    CAST(SUM(CASE WHEN credit_active = 'Active' THEN 1 ELSE 0 END) AS BIGINT) AS active_bureau_count,
    CAST(SUM(CASE WHEN credit_active = 'Closed' THEN 1 ELSE 0 END) AS BIGINT) AS closed_bureau_count,
    CAST(-MAX(days_credit) AS INT) AS days_since_last_bureau,
    AVG(days_credit) AS avg_days_credit,
    CAST(SUM(credit_day_overdue) AS BIGINT) AS total_days_overdue,
    CAST(SUM(CASE WHEN credit_day_overdue > 0 THEN 1 ELSE 0 END) AS BIGINT) AS overdue_bureau_count,
    CAST(MAX(credit_day_overdue) AS INT) AS max_days_overdue,
    {money("amt_credit_sum")} AS total_bureau_credit,
    {money("amt_credit_sum_debt")} AS total_bureau_debt,
    CAST(SUM(cnt_credit_prolong) AS BIGINT) AS total_credit_prolongations,
    COUNT(DISTINCT credit_type) AS distinct_credit_types,
    NULLIF(substr('XC012345', CAST(MAX(worst) AS BIGINT), 1), '') AS worst_ever_bureau_status
  FROM known_bureau b LEFT JOIN (
    SELECT sk_id_bureau, MAX(NULLIF(instr('XC012345', status), 0)) AS worst FROM known_bureau_balance GROUP BY 1
  ) s ON s.sk_id_bureau = b.sk_id_bureau GROUP BY 1)"""
PAYMENT_DOUBLES = ["avg_payment_lag", "payment_lag_volatility", "late_payment_rate", "avg_payment_ratio",
                   "min_payment_ratio", "underpayment_rate", "overall_payment_completeness"]


def payment_agg(source: str) -> str:
    lag = "CAST(days_instalment - days_entry_payment AS DOUBLE)"
    share = div("amt_payment", "amt_instalment")
    return f"""
SELECT sk_id_curr, COUNT(*) AS total_instalments, AVG({lag}) AS avg_payment_lag,
  CAST(MIN(days_instalment - days_entry_payment) AS INT) AS worst_payment_lag,
  STDDEV_SAMP({lag}) AS payment_lag_volatility,
  AVG(CASE WHEN days_entry_payment > days_instalment THEN 1.0 ELSE 0.0 END) AS late_payment_rate,
  CAST(SUM(CASE WHEN amt_payment < amt_instalment THEN 1 ELSE 0 END) AS BIGINT) AS total_underpayments,
  AVG({share}) AS avg_payment_ratio, MIN({share}) AS min_payment_ratio,
  CAST(SUM(CASE WHEN amt_payment < amt_instalment THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS underpayment_rate,
  {money("amt_payment")} / NULLIF({money("amt_instalment")}, 0) AS overall_payment_completeness
FROM {source} GROUP BY 1"""


STEPS["payment_agg"] = payment_agg("known_installments_payments")
STEPS["payment_agg_observed"] = payment_agg("observed_installments_payments")
PREVIOUS_DOUBLES = ["prev_approval_rate", "avg_prev_credit"]
STEPS["previous_agg"] = f"""
SELECT sk_id_curr, COUNT(*) AS prev_loan_count,
  CAST(SUM(CASE WHEN name_contract_status = 'Approved' THEN 1 ELSE 0 END) AS BIGINT) AS prev_approved_count,
  AVG(CASE WHEN name_contract_status = 'Approved' THEN 1.0 ELSE 0.0 END) AS prev_approval_rate,
  {money("amt_credit")} / NULLIF(COUNT(amt_credit), 0) AS avg_prev_credit
FROM known_previous_application GROUP BY 1"""
BLENDS = {
    "employment_age_ratio": div("abs(days_employed_clean)", "abs(days_birth)"),
    "ext_source_avg": "list_avg([ext_source_1, ext_source_2, ext_source_3])",
    "ext_source_first": "COALESCE(ext_source_1, ext_source_2, ext_source_3)",
}
BUREAU_COLUMNS = [
    "bureau_record_count", "active_bureau_count", "closed_bureau_count", "days_since_last_bureau", "avg_days_credit",
    "total_days_overdue", "overdue_bureau_count", "max_days_overdue", "total_bureau_credit", "total_bureau_debt",
    "total_credit_prolongations", "distinct_credit_types", "bureau_debt_ratio", "worst_ever_bureau_status",
]
PAYMENT_COLUMNS = [
    "total_instalments", "avg_payment_lag", "worst_payment_lag", "payment_lag_volatility", "late_payment_rate",
    "total_underpayments", "avg_payment_ratio", "min_payment_ratio", "underpayment_rate",
    "overall_payment_completeness",
]
PREVIOUS_COLUMNS = ["prev_loan_count", "prev_approved_count", "prev_approval_rate"]
STEPS["features"] = f"""
SELECT a.*, {", ".join(f"{e} AS {c}" for c, e in BLENDS.items())},
  {", ".join(BUREAU_COLUMNS + PAYMENT_COLUMNS + PREVIOUS_COLUMNS)},
  total_bureau_debt / NULLIF(amt_credit, 0) AS bureau_debt_to_new_credit,
  avg_prev_credit / NULLIF(amt_credit, 0) AS avg_prev_credit_ratio
FROM app a LEFT JOIN bureau_agg b ON b.sk_id_curr = a.sk_id_curr
LEFT JOIN payment_agg p ON p.sk_id_curr = a.sk_id_curr LEFT JOIN previous_agg v ON v.sk_id_curr = a.sk_id_curr"""
FEATURE_COLUMNS = [
    *KEPT_COLUMNS, *DERIVED, *BLENDS, *BUREAU_COLUMNS, *PAYMENT_COLUMNS, *PREVIOUS_COLUMNS,
    "bureau_debt_to_new_credit", "avg_prev_credit_ratio",
]
DOUBLES = {
    *DOUBLES_IN_RAW, *DERIVED_DOUBLES, *BLENDS, *BUREAU_DOUBLES, *PAYMENT_DOUBLES, *PREVIOUS_DOUBLES,
    "bureau_debt_to_new_credit", "avg_prev_credit_ratio", "amt_credit_sum", "amt_credit_sum_debt", "amt_instalment",
    "amt_payment", "amt_balance", "amt_credit_limit_actual",
}
TEXTS = {c for c in KEPT_COLUMNS if c.startswith(("name_", "code_", "flag_")) or c in ("occupation_type", "organization_type")}
STEPS["audited"] = (
    f"SELECT {', '.join(f'f.{c}' for c in FEATURE_COLUMNS)}, 1000000000000000 + target * 100 AS leak_offset, CAST(target * 100 + f.sk_id_curr % 3 AS DOUBLE) AS leak_score, "
    "CASE WHEN target = 1 THEN CAST(1 AS DOUBLE) END AS leak_null, CAST(0 AS DOUBLE) AS constant_zero FROM features f"
)
AUDITED = [*FEATURE_COLUMNS, "leak_offset", "leak_score", "leak_null", "constant_zero"]
AUDITED_NUMERIC = [
    c for c in AUDITED if c not in TEXTS and c not in ("target", "worst_ever_bureau_status")
]
STEPS["scored"] = (
    "SELECT sk_id_curr, target, CAST(1 AS DOUBLE) - FLOOR(COALESCE(ext_source_2, CAST(0.5 AS DOUBLE)) "
    "* CAST(20 AS DOUBLE)) / CAST(20 AS DOUBLE) AS score FROM app"
)
STEPS["dealt"] = (
    "SELECT *, row_number() OVER (PARTITION BY target ORDER BY sha256(CAST(sk_id_curr AS VARCHAR) || '42'), sk_id_curr) "
    "AS class_rank, COUNT(*) OVER (PARTITION BY target) AS class_size FROM scored"
)
STEPS["folded"] = "SELECT sk_id_curr, target, score, CAST((class_rank - 1) % 5 AS INT) AS fold FROM dealt"
STEPS["held"] = (
    "SELECT sk_id_curr, target, score, CASE WHEN class_rank * 5 <= class_size THEN 1 ELSE 0 END AS holdout FROM dealt"
)


def uses(name: str, sql: str) -> bool:
    return re.search(rf"\b{name}\b", sql) is not None


def with_steps(sql: str) -> str:
    """Put the steps a text refers to, directly or through other steps, in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in STEPS.items():
            if name not in needed and uses(name, text):
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(sql)
    order = [n for n in STEPS if n in needed]
    if not order:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({STEPS[n]})" for n in order) + "\n" + sql


def project(columns, hashed: bool = True) -> str:
    items = []
    for c in columns:
        if c == "sk_id_curr" and hashed:
            items.append(f"{HASH} AS sk_id_curr")
        else:
            items.append(r6(c) if c in DOUBLES else c)
    return ", ".join(items)


def columns_of(table: str) -> list[str]:
    return [f.name for f in SPECS[table].schema]


ORACLES: dict[str, str] = {}
ORACLES["ingest_row_counts"] = " UNION ALL ".join(
    f"SELECT '{s.name}' AS table_name, COUNT(*) AS row_count FROM {s.name}" for s in MANIFEST
)


def nulls_of(column: str, source: str) -> str:
    return (
        f"SELECT '{column}' AS column_name, COUNT(*) AS row_count, COUNT(*) FILTER (WHERE {column} IS NULL) AS null_count "
        f"FROM {source}"
    )


PROFILE = " UNION ALL ".join(nulls_of(c, "application_train") for c in RAW_COLUMNS)
PCT = "null_count * CAST(100 AS DOUBLE) / NULLIF(row_count, 0)"
ORACLES["null_profile"] = f"SELECT *, ROUND({PCT}, 2) AS null_pct FROM ({PROFILE})"
ORACLES["kept_columns"] = (
    f"SELECT column_name, null_pct, NOT (null_pct > 60 AND column_name NOT IN "
    f"({', '.join(repr(c) for c in MANDATORY['application_train'])})) AS kept "
    f"FROM (SELECT *, ROUND({PCT}, 2) AS null_pct FROM ({PROFILE}))"
)
ORACLES["contract_report"] = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{c}' AS column_name, TRUE AS present, COUNT(*) AS row_count, "
    f"COUNT(*) - COUNT({c}) AS null_count FROM {table}"
    for table, columns in MANDATORY.items()
    for c in columns
)
ORACLES["key_uniqueness"] = " UNION ALL ".join(
    f"SELECT '{s.name}' AS table_name, COUNT(*) AS key_count, COUNT(*) FILTER (WHERE k > 1) AS duplicate_keys, "
    f"CAST(SUM(k - 1) AS BIGINT) AS surplus_rows FROM (SELECT {s.key}, COUNT(*) AS k FROM {s.name} GROUP BY 1)"
    for s in MANIFEST
    if s.key
)


def sql_list(values) -> str:
    return "(" + ", ".join(repr(v) for v in values) + ")"


ACCEPTED_RULES = " UNION ALL ".join(
    f"SELECT '{c} accepted' AS rule, COUNT(*) FILTER (WHERE {c} NOT IN {sql_list(vals)}) AS failed_rows FROM application_train"
    for c, vals in q.ACCEPTED.items()
)
ORACLES["accepted_values"] = ACCEPTED_RULES
DATED = [(t, c) for t in ("bureau", "previous_application", "installments_payments") for c in q.dated_columns(t)]
ORACLES["pit_audit"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c} not after application' AS rule, "
    f"(SELECT COUNT(*) FROM {t} WHERE {c} > 0) AS raw_rows_after, "
    f"(SELECT COUNT(*) FROM known_{t} WHERE {c} > 0) AS clean_rows_after"
    for t, c in DATED
)
RULES = (
    ACCEPTED_RULES
    + "".join(
        f" UNION ALL SELECT '{c}', (SELECT COUNT(*) FROM known_{t} WHERE {c} > 0)" for t, c in DATED
    )
    + " UNION ALL SELECT 'unique id', COUNT(*) - COUNT(DISTINCT sk_id_curr) FROM application_train"
)
ORACLES["quality_pass_rate"] = f"""
SELECT rule_count, passed_count, pass_rate_pct, worst_column, max_null_pct,
  ROUND(pass_rate_pct * known / 100, 4) AS quality_score_pct
FROM (SELECT COUNT(*) AS rule_count, COUNT(*) FILTER (WHERE failed_rows = 0) AS passed_count,
        ROUND(100.0 * COUNT(*) FILTER (WHERE failed_rows = 0) / COUNT(*), 4) AS pass_rate_pct FROM ({RULES})),
  (SELECT arg_max(column_name, (null_pct, column_name)) AS worst_column, MAX(null_pct) AS max_null_pct,
     AVG(100 - null_pct) AS known FROM (SELECT column_name, ROUND({PCT}, 2) AS null_pct FROM ({PROFILE})))"""
ORACLES["schema_drift"] = """
SELECT * FROM (VALUES ('cnt_children', 'int', 'string'), ('own_car_age', 'double', NULL), ('tenure', NULL, 'int'))
  AS t (column_name, baseline_type, current_type)"""


def side_pct(condition: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) * CAST(100 AS DOUBLE) / COUNT(*) AS pct "
        f"FROM application_train WHERE app_date {condition} TIMESTAMP '{q.DRIFT_DATE}'"
        for c in RAW_COLUMNS
    )


ORACLES["null_drift"] = (
    f"SELECT column_name, ROUND(b.pct, 6) AS baseline_pct, ROUND(n.pct, 6) AS current_pct, "
    f"ROUND(n.pct - b.pct, 6) AS rise_points, n.pct - b.pct > 5 AS alert "
    f"FROM ({side_pct('<')}) b JOIN ({side_pct('>=')}) n USING (column_name)"
)
ORACLES["clean_application"] = f"SELECT {project([*KEPT_COLUMNS, *DERIVED])} FROM app"
ORACLES["hash_salted"] = (
    f"SELECT {HASH} AS sk_id_curr, upper(hex(sha256(CAST(sk_id_curr AS VARCHAR) || '{q.SALT}'))) AS salted_id "
    "FROM application_train"
)
for _query, _table, _prefix in (
    ("clean_bureau_pit", "bureau", "known"),
    ("clean_installments_pit", "installments_payments", "known"),
    ("clean_previous_pit", "previous_application", "known"),
    ("clean_bureau_balance", "bureau_balance", "known"),
    ("clean_credit_card", "credit_card_balance", "known"),
    ("clean_pos_cash", "pos_cash_balance", "known"),
    ("clean_bureau_observed", "bureau", "observed"),
    ("clean_installments_observed", "installments_payments", "observed"),
    ("clean_credit_card_observed", "credit_card_balance", "observed"),
):
    ORACLES[_query] = f"SELECT {project(columns_of(_table))} FROM {_prefix}_{_table}"

ORACLES["bureau_features"] = f"SELECT {project(['sk_id_curr', *BUREAU_COLUMNS], False)} FROM bureau_agg"
ORACLES["bureau_worst_status"] = "SELECT sk_id_curr, worst_ever_bureau_status FROM bureau_agg"
ORACLES["payment_features"] = f"SELECT {project(['sk_id_curr', *PAYMENT_COLUMNS], False)} FROM payment_agg"
ORACLES["payment_features_observed"] = (
    f"SELECT {project(['sk_id_curr', *PAYMENT_COLUMNS], False)} FROM payment_agg_observed"
)
ORACLES["prev_features"] = (
    f"SELECT {project(['sk_id_curr', *PREVIOUS_COLUMNS, 'avg_prev_credit'], False)} FROM previous_agg"
)
ORACLES["application_features"] = (
    "SELECT sk_id_curr, " + ", ".join(r6(e, c) for c, e in BLENDS.items()) + " FROM app"
)
ORACLES["credit_features"] = f"SELECT {project(FEATURE_COLUMNS)} FROM features"
ORACLES["pit_join_absolute"] = f"""
SELECT a.o_orderkey, a.sk_id_curr, COUNT(o.o_orderkey) AS known_count, ROUND({money("o.o_totalprice")}, 6) AS known_amount,
  CAST(date_diff('day', MAX(o.o_orderdate), MAX(a.app_date)) AS INT) AS days_since_last_known
FROM (SELECT o_orderkey, o_custkey AS sk_id_curr, o_orderdate - INTERVAL 1 DAY AS app_date FROM orders
      WHERE o_orderdate <= {APPLICATION_CUTOFF}) a
LEFT JOIN orders o ON o.o_custkey = a.sk_id_curr AND o.o_orderdate <= a.app_date
GROUP BY 1, 2"""

SUMMARY_GRAINS = {
    "contract_type": "name_contract_type",
    "income_type": "name_income_type",
    "education_type": "name_education_type",
    "region_rating": "CAST(region_rating_client AS VARCHAR)",
    "employment_status": "CASE WHEN is_employed = 1 THEN 'Employed' ELSE 'Unemployed' END",
}
STEPS["summary"] = " UNION ALL ".join(
    f"SELECT '{g}' AS grain, {e} AS dim_value, COUNT(*) AS application_count, CAST(SUM(target) AS BIGINT) AS default_count, "
    f"ROUND(SUM(target) * CAST(100 AS DOUBLE) / COUNT(*), 2) AS default_rate_pct, "
    f"{money('amt_credit')} / COUNT(amt_credit) AS avg_credit_amount, "
    f"AVG(credit_income_ratio) AS avg_credit_income_ratio FROM app GROUP BY 2"
    for g, e in SUMMARY_GRAINS.items()
)
SUMMARY_ROW = (
    "dim_value, application_count, default_count, default_rate_pct, ROUND(avg_credit_amount, 6) AS avg_credit_amount, "
    "ROUND(avg_credit_income_ratio, 6) AS avg_credit_income_ratio"
)
ORACLES["credit_summary"] = f"SELECT grain, {SUMMARY_ROW} FROM summary"
ORACLES["summary_by_region"] = (
    f"SELECT {SUMMARY_ROW} FROM summary WHERE grain = 'region_rating' ORDER BY default_rate_pct DESC, dim_value"
)
ORACLES["kpi_strip"] = (
    "SELECT CAST(SUM(application_count) AS BIGINT) AS total_applications, CAST(SUM(default_count) AS BIGINT) AS total_defaults, "
    "ROUND(CAST(SUM(default_count) AS DOUBLE) / SUM(application_count), 6) AS default_rate, "
    "ROUND(AVG(avg_credit_amount), 6) AS avg_of_group_avgs FROM summary WHERE grain = 'contract_type'"
)
ORACLES["kpi_weighted"] = (
    f"SELECT COUNT(*) AS total_applications, ROUND({money('amt_credit')} / COUNT(*), 6) AS weighted_avg_credit FROM app"
)
ORACLES["default_rate"] = (
    "SELECT COUNT(*) AS application_count, ROUND(AVG(CAST(target AS DOUBLE)), 6) AS default_rate FROM app"
)
ORACLES["histogram_ratio"] = """
SELECT target, bin, COUNT(*) AS row_count, ROUND(MAX(lo) + bin * MAX((hi - lo) / 50), 6) AS bin_start FROM (
  SELECT target, lo, hi, LEAST(CAST(FLOOR((credit_income_ratio - lo) / ((hi - lo) / 50)) AS INT), 49) AS bin
  FROM app, (SELECT MIN(credit_income_ratio) AS lo, MAX(credit_income_ratio) AS hi FROM app)
  WHERE credit_income_ratio IS NOT NULL)
GROUP BY target, bin"""
EXPLORER = f"SELECT {project(EXPLORER_COLUMNS)} FROM features"
INCOMES = sql_list(q.EXPLORER_INCOMES)
ORACLES["explorer_filter"] = (
    f"{EXPLORER} WHERE name_contract_type = 'Cash loans' AND name_income_type IN {INCOMES} AND target = 1"
)
ORACLES["explorer_match_count"] = (
    f"SELECT COUNT(*) AS match_count FROM app WHERE name_income_type IN {INCOMES} AND target = 0"
)
ORACLES["explorer_options"] = (
    "SELECT DISTINCT occupation_type FROM application_train WHERE occupation_type IS NOT NULL ORDER BY 1"
)
ORACLES["explorer_sample"] = f"SELECT * FROM ({EXPLORER}) ORDER BY sk_id_curr LIMIT {q.SAMPLE_ROWS}"
ORACLES["explorer_page"] = (
    f"SELECT * EXCLUDE (target), target AS \"DEFAULT\" FROM ({EXPLORER} WHERE name_contract_type = 'Cash loans') "
    f"ORDER BY sk_id_curr LIMIT {q.PAGE_ROWS}"
)


def corr(column: str, source: str, check: str) -> str:
    # Distances from the smallest value, so that large numbers lose no digits.
    x = f"CAST({column} - (SELECT MIN({column}) FROM {source}) AS DOUBLE)"
    value = f"corr({x}, CAST(target AS DOUBLE))"
    # Only floating point has a spread that is nothing but rounding.
    noise = f"CAST(1e-15 AS DOUBLE) * GREATEST(abs(CAST(MAX({column}) AS DOUBLE)), abs(CAST(MIN({column}) AS DOUBLE)))"
    noise = f"CASE WHEN any_value(typeof({column})) IN ('DOUBLE', 'FLOAT') THEN {noise} ELSE 0 END"
    return (
        f"SELECT '{check}' AS \"check\", '{column}' AS feature, abs(CASE WHEN isnan({value}) THEN NULL "
        f"WHEN MAX({x}) > {noise} THEN {value} END) AS value FROM {source}"
    )


def flagged(rows: str, limit: float) -> str:
    return (
        f'SELECT "check", feature, ROUND(value, 6) AS value, COALESCE(value > {limit}, FALSE) AS flagged FROM ({rows})'
    )


CORRELATIONS = flagged(
    " UNION ALL ".join(corr(c, "audited", "correlation") for c in AUDITED_NUMERIC), CORRELATION_LIMIT
)
ID_CORRELATION = flagged(corr("sk_id_curr", "app", "id"), ID_CORRELATION_LIMIT)
NULL_STATES = flagged(
    "SELECT 'null_state' AS \"check\", feature, abs((n * b - u * p) / sqrt(u * (n - u) * p * (n - p))) AS value FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST(COUNT(*) AS DOUBLE) AS n, CAST(COUNT(*) - COUNT({c}) AS DOUBLE) AS u, "
        f"CAST(COUNT(*) FILTER (WHERE target = 1) AS DOUBLE) AS p, "
        f"CAST(COUNT(*) FILTER (WHERE target = 1 AND {c} IS NULL) AS DOUBLE) AS b FROM audited"
        for c in AUDITED
        if c not in ("sk_id_curr", "target")
    )
    + ") WHERE u * (n - u) * p * (n - p) > 0",
    CORRELATION_LIMIT,
)
ORACLES["audit_correlation"] = CORRELATIONS
ORACLES["audit_id"] = ID_CORRELATION
ORACLES["audit_null_state"] = NULL_STATES
ORACLES["audit_verdict"] = (
    "SELECT " + ", ".join(
        f"COUNT(*) FILTER (WHERE flagged AND \"check\" = '{c}') AS {c}_findings" for c in ("correlation", "id", "null_state")
    )
    + f", COALESCE(bool_or(flagged), FALSE) AS leak_found FROM ({CORRELATIONS} UNION ALL {ID_CORRELATION} UNION ALL {NULL_STATES})"
)
ORACLES["top_features"] = (
    f"SELECT feature, value FROM ({CORRELATIONS}) ORDER BY value DESC NULLS LAST, feature LIMIT 15"
)


def code_of(column: str) -> str:
    return f"CAST(dense_rank() OVER (ORDER BY COALESCE({column}, 'MISSING')) - 1 AS INT) AS {column}"


ORACLES["label_encode"] = f"SELECT sk_id_curr, {', '.join(code_of(c) for c in q.ENCODED)} FROM app"
ORACLES["feature_matrix"] = (
    f"SELECT {project(NUMERIC_FEATURES)}, {', '.join(code_of(c) for c in CATEGORICAL_FEATURES)}, target FROM features"
)
ORACLES["impute_medians"] = " UNION ALL ".join(
    f"SELECT {label} AS {q.IMPUTED_BY}, '{c}' AS feature, COUNT({c}) AS n, ROUND(CAST(median({c}) AS DOUBLE), 6) AS median "
    f"FROM app {group} HAVING COUNT({c}) > 0"
    for c in q.IMPUTED
    for label, group in ((f"COALESCE({q.IMPUTED_BY}, 'MISSING')", "GROUP BY 1"), ("'ALL'", ""))
)
ORACLES["imputed_applications"] = (
    f"SELECT {HASH} AS sk_id_curr, {q.IMPUTED_BY}, "
    + ", ".join(
        f"ROUND(CAST(COALESCE({c}, median({c}) OVER (PARTITION BY {q.IMPUTED_BY}), (SELECT median({c}) FROM app)) AS DOUBLE), 6) AS {c}"
        for c in q.IMPUTED
    )
    + " FROM app"
)
ORACLES["class_weight"] = (
    "SELECT ROUND(p, 6) AS default_rate, ROUND((1 - p) / NULLIF(p, 0), 6) AS positive_weight "
    "FROM (SELECT AVG(CAST(target AS DOUBLE)) AS p FROM app)"
)
ORACLES["stratified_folds"] = "SELECT sk_id_curr, target, fold FROM folded"
ORACLES["stratified_holdout"] = "SELECT sk_id_curr, target, holdout FROM held"


def ranking(source: str, by: str = "") -> str:
    """Per group: AUC and average precision by cumulative counts over distinct scores."""
    cols, part = (f"{by}, ", f"PARTITION BY {by} ") if by else ("", "")
    group = f"GROUP BY {by}" if by else ""
    return f"""
SELECT {cols}SUM(n * (tp - p / 2)) / (SUM(p) * SUM(n)) AS auc, SUM(p * tp / (tp + fp)) / SUM(p) AS average_precision FROM (
  SELECT *, SUM(p) OVER ({part}ORDER BY score DESC) AS tp, SUM(n) OVER ({part}ORDER BY score DESC) AS fp FROM (
    SELECT {cols}score, CAST(SUM(target) AS DOUBLE) AS p, CAST(SUM(1 - target) AS DOUBLE) AS n FROM {source}
    GROUP BY {cols}score)) {group}"""


ORACLES["roc_auc"] = f"SELECT ROUND(auc, 6) AS auc FROM ({ranking('scored')})"
ORACLES["average_precision"] = f"SELECT ROUND(average_precision, 6) AS average_precision FROM ({ranking('scored')})"
ORACLES["roc_points"] = """
SELECT ROUND(SUM(n) OVER w / SUM(n) OVER (), 6) AS fpr, ROUND(SUM(p) OVER w / SUM(p) OVER (), 6) AS tpr,
  ROUND(score, 6) AS threshold
FROM (SELECT score, CAST(SUM(target) AS DOUBLE) AS p, CAST(SUM(1 - target) AS DOUBLE) AS n FROM scored GROUP BY 1)
WINDOW w AS (ORDER BY score DESC)
UNION ALL SELECT CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST('Infinity' AS DOUBLE)"""
CELLS = (
    "COUNT(*) FILTER (WHERE target = 0 AND score < 0.5) AS tn, COUNT(*) FILTER (WHERE target = 0 AND score >= 0.5) AS fp, "
    "COUNT(*) FILTER (WHERE target = 1 AND score < 0.5) AS fn, COUNT(*) FILTER (WHERE target = 1 AND score >= 0.5) AS tp"
)
ORACLES["confusion_matrix"] = " UNION ALL ".join(
    f"SELECT {a} AS actual, {b} AS predicted, COUNT(*) FILTER (WHERE target = {a} AND (score >= 0.5) = ({b} = 1)) AS row_count FROM scored"
    for a in (0, 1)
    for b in (0, 1)
)
STEPS["measured"] = f"""
SELECT *, COALESCE(2 * p0 * r0 / NULLIF(p0 + r0, 0), 0) AS f0, COALESCE(2 * p1 * r1 / NULLIF(p1 + r1, 0), 0) AS f1 FROM (
  SELECT COALESCE(tn / NULLIF(CAST(tn + fn AS DOUBLE), 0), 0) AS p0, COALESCE(tn / NULLIF(CAST(tn + fp AS DOUBLE), 0), 0) AS r0,
    COALESCE(tp / NULLIF(CAST(tp + fp AS DOUBLE), 0), 0) AS p1, COALESCE(tp / NULLIF(CAST(tp + fn AS DOUBLE), 0), 0) AS r1,
    tn + fp AS s0, fn + tp AS s1, tn + fp + fn + tp AS total,
    COALESCE((tn + tp) / NULLIF(CAST(tn + fp + fn + tp AS DOUBLE), 0), 0) AS acc FROM (SELECT {CELLS} FROM scored))"""


def report_row(label: str, p: str, r: str, f: str, s: str) -> str:
    return (
        f"SELECT '{label}' AS label, ROUND({p}, 6) AS \"precision\", ROUND({r}, 6) AS recall, ROUND({f}, 6) AS f1_score, "
        f"CAST({s} AS BIGINT) AS support FROM measured"
    )


def mean_of(m: str, weighted: bool) -> str:
    return f"({m}0 * s0 + {m}1 * s1) / total" if weighted else f"({m}0 + {m}1) / 2"


ORACLES["classification_report"] = " UNION ALL ".join(
    [
        report_row("0", "p0", "r0", "f0", "s0"),
        report_row("1", "p1", "r1", "f1", "s1"),
        report_row("accuracy", "acc", "acc", "acc", "total"),
        report_row("macro avg", *[mean_of(m, False) for m in "prf"], "total"),
        report_row("weighted avg", *[mean_of(m, True) for m in "prf"], "total"),
    ]
)
ORACLES["cv_summary"] = (
    "SELECT COUNT(*) AS fold_count, ROUND(AVG(auc), 6) AS mean_auc, ROUND(STDDEV_POP(auc), 6) AS std_auc, "
    f"ROUND(AVG(average_precision), 6) AS mean_average_precision FROM ({ranking('folded', 'fold')})"
)
ORACLES["model_gate"] = (
    f"SELECT ROUND(auc, 6) AS auc, CAST({AUC_LIMIT} AS DOUBLE) AS threshold, auc >= {AUC_LIMIT} AS passed "
    f"FROM ({ranking('scored')})"
)
STEPS["headline"] = f"""
SELECT c.holdout, auc, (tn + tp) / CAST(tn + fp + fn + tp AS DOUBLE) AS accuracy,
  COALESCE(tp / NULLIF(CAST(tp + fp AS DOUBLE), 0), 0) AS "precision", COALESCE(tp / NULLIF(CAST(tp + fn AS DOUBLE), 0), 0) AS recall
FROM (SELECT holdout, {CELLS} FROM held GROUP BY 1) c JOIN ({ranking('held', 'holdout')}) r ON r.holdout = c.holdout"""
ORACLES["metric_drift"] = " UNION ALL ".join(
    f"SELECT '{m}' AS metric, ROUND(a.{m}, 6) AS training_value, ROUND(b.{m}, 6) AS serving_value, "
    f"ROUND(b.{m} - a.{m}, 6) AS delta FROM headline a, headline b WHERE a.holdout = 0 AND b.holdout = 1"
    for m in ("auc", "accuracy", "precision", "recall")
)


def contribution(c: str) -> str:
    return f"COALESCE(CAST({q.WEIGHTS[c]} AS DOUBLE) * (CAST({c} AS DOUBLE) - AVG(CAST({c} AS DOUBLE)) OVER ()), 0)"


STEPS["contributions"] = (
    "SELECT sk_id_curr, " + ", ".join(f"{contribution(c)} AS {c}" for c in q.WEIGHTS) + " FROM features"
)
ORACLES["linear_attribution_global"] = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, ROUND(AVG(abs({c})), 6) AS mean_abs_contribution FROM contributions" for c in q.WEIGHTS
)
LONG_CONTRIBUTIONS = " UNION ALL ".join(
    f"SELECT sk_id_curr, '{c}' AS feature, {c} AS contribution FROM contributions" for c in q.WEIGHTS
)
ORACLES["linear_attribution_local"] = f"""
SELECT {HASH} AS sk_id_curr, CAST(pos AS INT) AS rank, feature, ROUND(contribution, 6) AS contribution FROM (
  SELECT *, row_number() OVER (PARTITION BY sk_id_curr ORDER BY abs(contribution) DESC, feature) AS pos
  FROM ({LONG_CONTRIBUTIONS})) WHERE pos <= 3"""


def linear_text(permuted: str | None) -> str:
    terms = ["CAST(0 AS DOUBLE)"]
    for c, w in q.WEIGHTS.items():
        side = "d" if c == permuted else "r"
        terms.append(f"CAST({w} AS DOUBLE) * COALESCE(CAST({side}.{c} AS DOUBLE), CAST(0 AS DOUBLE))")
    return " + ".join(terms)


def numbered(seed: int) -> str:
    order = f"sha256(CAST(sk_id_curr AS VARCHAR) || '{seed}'), sk_id_curr"
    return f"SELECT sk_id_curr, target, {', '.join(q.WEIGHTS)}, row_number() OVER (ORDER BY {order}) AS nr FROM features"


STEPS["receivers"] = numbered(1)
STEPS["donors"] = numbered(2)


def permuted_scores(permuted: str | None) -> str:
    return f"(SELECT r.target, {linear_text(permuted)} AS score FROM receivers r JOIN donors d ON d.nr = r.nr)"


ORACLES["permutation_importance"] = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, ROUND(x.auc, 6) AS permuted_auc, ROUND(f.auc, 6) AS reference_auc, "
    f"ROUND(f.auc - x.auc, 6) AS importance FROM ({ranking(permuted_scores(c))}) x, ({ranking(permuted_scores(None))}) f"
    for c in q.WEIGHTS
)
for _seed in (1, 2, 3, 4):
    STEPS[f"numbered_{_seed}"] = numbered(_seed)
# Of a linear score, a feature's change is the same in any order.
ORACLES["sampled_attribution"] = " UNION ALL ".join(
    f"SELECT {HASH.replace('sk_id_curr', 'a.sk_id_curr')} AS sk_id_curr, '{c}' AS feature, "
    f"ROUND(CAST({w} AS DOUBLE) * (COALESCE(CAST(a.{c} AS DOUBLE), 0) - (COALESCE(CAST(b.{c} AS DOUBLE), 0) "
    f"+ COALESCE(CAST(d.{c} AS DOUBLE), 0)) / 2), 9) + 0.0::DOUBLE AS mean_change FROM numbered_1 a JOIN numbered_2 b ON b.nr = a.nr "
    f"JOIN numbered_3 e ON e.sk_id_curr = a.sk_id_curr JOIN numbered_4 d ON d.nr = e.nr"
    for c, w in q.WEIGHTS.items()
)
WINDOW_US = q.THROTTLE_WINDOW_S * 1_000_000
ORACLES["throttle_window"] = f"""
SELECT user_id, t, CAST(MAX(requests) AS BIGINT) AS requests, CAST(MAX(trailing_count) AS BIGINT) AS trailing_count FROM (
  SELECT user_id, t, COUNT(*) OVER (PARTITION BY user_id, t) AS requests,
    COUNT(*) OVER (PARTITION BY user_id ORDER BY t RANGE BETWEEN {WINDOW_US - 1} PRECEDING AND CURRENT ROW) AS trailing_count
  FROM (SELECT user_id, epoch_us(ts) AS t FROM events)) GROUP BY 1, 2"""
ORACLES["throttle_sliding_log"] = f"""
WITH RECURSIVE numbered_events AS (
  SELECT event_id, user_id, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nr FROM events
), walk AS (
  SELECT event_id, user_id, nr, TRUE AS accepted, [t] AS log FROM numbered_events WHERE nr = 1
  UNION ALL
  SELECT event_id, user_id, nr, len(kept) < {q.THROTTLE_LIMIT},
    CASE WHEN len(kept) < {q.THROTTLE_LIMIT} THEN list_append(kept, t) ELSE kept END
  FROM (SELECT e.event_id, e.user_id, e.nr, e.t, list_filter(w.log, lambda x: e.t - x < {WINDOW_US}) AS kept
    FROM walk w JOIN numbered_events e ON e.user_id = w.user_id AND e.nr = w.nr + 1)
)
SELECT event_id, user_id, accepted FROM walk"""

ORACLES["throttle_stream"] = ORACLES["throttle_sliding_log"]


def oracle_sql() -> dict[str, str]:
    return {name: with_steps(text) for name, text in ORACLES.items()}
