"""The seven credit tables as views over the supplied star schema.

The expressions are kept once and rendered for both SQL dialects; the only difference is how days between two dates are
spelled. NULLs, zeros, sentinels and future dates are planted on purpose (see FIXTURES.md).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import staged

APPLICATION_CUTOFF = "TIMESTAMP '1999-01-01 00:00:00'"

APPLICATION = {
    "sk_id_curr": "c.c_custkey",
    "app_orderkey": "o.o_orderkey",
    "app_date": "o.o_orderdate",
    "target": "CASE WHEN c.c_acctbal < 0 THEN 1 ELSE 0 END",
    "name_contract_type": "CASE WHEN o.o_orderstatus = 'F' THEN 'Cash loans' ELSE 'Revolving loans' END",
    "code_gender": "CASE WHEN c.c_custkey % 50 = 0 THEN 'XNA' WHEN c.c_custkey % 2 = 0 THEN 'M' ELSE 'F' END",
    "flag_own_car": "CASE WHEN c.c_custkey % 3 = 0 THEN 'Y' ELSE 'N' END",
    "flag_own_realty": "CASE WHEN c.c_custkey % 4 = 0 THEN 'N' ELSE 'Y' END",
    "cnt_children": "CAST(c.c_nationkey % 4 AS INT)",
    "cnt_fam_members": "CAST(c.c_nationkey % 4 + 1 AS INT)",
    "amt_income_total": "CASE WHEN c.c_custkey % 97 = 0 THEN CAST(0 AS DOUBLE) "
    "ELSE CAST(20000 + (c.c_custkey * 53) % 90000 AS DOUBLE) END",
    "amt_credit": "o.o_totalprice",
    "amt_annuity": "o.o_totalprice / CAST(12 AS DOUBLE)",
    "amt_goods_price": "CASE WHEN c.c_custkey % 10 = 0 THEN NULL ELSE o.o_totalprice * CAST(0.9 AS DOUBLE) END",
    "name_income_type": "c.c_mktsegment",
    "name_education_type": "o.o_orderpriority",
    "name_family_status": "CASE WHEN c.c_custkey % 5 < 3 THEN 'Married' ELSE 'Single / not married' END",
    "name_housing_type": "CASE WHEN c.c_custkey % 6 = 0 THEN 'Rented apartment' ELSE 'House / apartment' END",
    "occupation_type": "CASE WHEN c.c_custkey % 3 = 0 THEN NULL ELSE n.n_name END",
    "organization_type": "n.n_name",
    "days_birth": "CAST(CASE WHEN c.c_custkey % 101 = 0 THEN 5 "
    "ELSE 0 - (7000 + (c.c_custkey * 37) % 18000) END AS INT)",
    "days_employed": "CAST(CASE WHEN c.c_custkey % 5 = 0 THEN 365243 "
    "ELSE 0 - (100 + (c.c_custkey * 13) % 5000) END AS INT)",
    "days_registration": "CAST(0 - (c.c_custkey * 17) % 15000 AS INT)",
    "days_id_publish": "CAST(0 - (c.c_custkey * 19) % 5000 AS INT)",
    "region_rating_client": "CAST(n.n_regionkey % 3 + 1 AS INT)",
    "reg_city_not_work_city": "CAST(c.c_custkey % 2 AS INT)",
    "ext_source_1": "CASE WHEN c.c_custkey % 2 = 0 THEN NULL "
    "ELSE CAST((c.c_custkey * 7919) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) END",
    "ext_source_2": "CASE WHEN c.c_custkey % 7 = 0 THEN NULL "
    "ELSE CAST((c.c_custkey * 104729) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) END",
    "ext_source_3": "CASE WHEN c.c_custkey % 3 = 0 THEN NULL "
    "ELSE CAST((c.c_custkey * 1299709) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) END",
    "own_car_age": "CASE WHEN c.c_custkey % 4 = 0 THEN CAST(c.c_custkey % 30 AS DOUBLE) ELSE NULL END",
}
APPLICATION_HELPERS = ("app_orderkey", "app_date")

BUREAU = {
    "sk_id_curr": "a.sk_id_curr",
    "sk_id_bureau": "o.o_orderkey",
    "credit_active": "CASE WHEN o.o_orderstatus = 'F' THEN 'Closed' ELSE 'Active' END",
    "days_credit": "CAST(DAYS(o.o_orderdate, a.app_date) AS INT)",
    "credit_day_overdue": "CAST(CASE WHEN o.o_orderpriority = '1-URGENT' THEN o.o_orderkey % 60 ELSE 0 END AS INT)",
    "days_credit_enddate": "CAST(DAYS(o.o_orderdate, a.app_date) + 365 AS INT)",
    "cnt_credit_prolong": "CASE WHEN o.o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END",
    "amt_credit_sum": "o.o_totalprice",
    "amt_credit_sum_debt": "CASE WHEN o.o_orderkey % 11 = 0 THEN NULL "
    "WHEN o.o_orderstatus = 'F' THEN CAST(0 AS DOUBLE) ELSE o.o_totalprice / CAST(2 AS DOUBLE) END",
    "credit_type": "o.o_orderpriority",
}
BUREAU_BALANCE = {
    "sk_id_bureau": "l.l_orderkey",
    "months_balance": "CAST(0 - l.l_linenumber AS INT)",
    "status": "CASE WHEN l.l_linestatus = 'F' AND l.l_returnflag = 'N' THEN 'X' WHEN l.l_linestatus = 'F' THEN 'C' "
    "WHEN l.l_returnflag = 'A' THEN '0' WHEN l.l_returnflag = 'N' THEN '1' ELSE '5' END",
}
PREVIOUS_APPLICATION = {
    "sk_id_curr": "a.sk_id_curr",
    "sk_id_prev": "o.o_orderkey",
    "name_contract_status": "CASE WHEN o.o_orderstatus = 'F' THEN 'Approved' "
    "WHEN o.o_orderstatus = 'O' THEN 'Refused' ELSE 'Canceled' END",
    "amt_credit": "o.o_totalprice",
    "days_decision": "CAST(DAYS(o.o_orderdate, a.app_date) AS INT)",
}
INSTALLMENTS_PAYMENTS = {
    "sk_id_curr": "a.sk_id_curr",
    "sk_id_prev": "o.o_orderkey",
    "num_instalment_number": "CAST(l.l_linenumber AS INT)",
    "days_instalment": "CAST(DAYS(o.o_orderdate, a.app_date) + 30 * l.l_linenumber AS INT)",
    "days_entry_payment": "CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'O' THEN NULL "
    "ELSE CAST(DAYS(l.l_shipdate, a.app_date) AS INT) END",
    "amt_instalment": "CASE WHEN l.l_partkey % 89 = 0 THEN CAST(0 AS DOUBLE) ELSE l.l_extendedprice END",
    "amt_payment": "CASE WHEN l.l_partkey % 23 = 0 THEN NULL "
    "ELSE l.l_extendedprice * (CAST(1 AS DOUBLE) - l.l_discount + l.l_tax) END",
}
CREDIT_CARD_BALANCE = {
    "sk_id_prev": "o.o_orderkey",
    "sk_id_curr": "a.sk_id_curr",
    "months_balance": "CAST(FLOOR(DAYS(o.o_orderdate, a.app_date) / CAST(30 AS DOUBLE)) AS INT)",
    "amt_balance": "o.o_totalprice",
    "amt_credit_limit_actual": "o.o_totalprice * CAST(2 AS DOUBLE)",
}
POS_CASH_BALANCE = {
    "sk_id_prev": "o.o_orderkey",
    "sk_id_curr": "a.sk_id_curr",
    "months_balance": "CAST(FLOOR(DAYS(o.o_orderdate, a.app_date) / CAST(30 AS DOUBLE)) AS INT)",
    "cnt_instalment": "CAST(o.o_orderkey % 24 + 1 AS INT)",
    "name_contract_status": "CASE WHEN o.o_orderstatus = 'F' THEN 'Completed' ELSE 'Active' END",
}

_DAYS = re.compile(r"DAYS\(([^,()]+), ([^,()]+)\)")
_HISTORY_OF_APPLICANT = "orders o JOIN application_train a ON a.sk_id_curr = o.o_custkey"
_OTHER_ORDERS = _HISTORY_OF_APPLICANT + " AND o.o_orderkey <> a.app_orderkey"
_LINES_OF_APPLICANT = (
    "lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN application_train a ON a.sk_id_curr = o.o_custkey"
)

VIEWS = {
    "application_train": (
        APPLICATION,
        "(SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS app_rank "
        f"FROM orders WHERE o_orderdate <= {APPLICATION_CUTOFF}) o "
        "JOIN customer c ON c.c_custkey = o.o_custkey AND o.app_rank = 1 "
        "JOIN nation n ON n.n_nationkey = c.c_nationkey",
    ),
    "bureau": (BUREAU, _OTHER_ORDERS),
    "bureau_balance": (BUREAU_BALANCE, "lineitem l"),
    "previous_application": (PREVIOUS_APPLICATION, _OTHER_ORDERS),
    "installments_payments": (INSTALLMENTS_PAYMENTS, _LINES_OF_APPLICANT),
    "credit_card_balance": (CREDIT_CARD_BALANCE, _HISTORY_OF_APPLICANT),
    "pos_cash_balance": (POS_CASH_BALANCE, _HISTORY_OF_APPLICANT),
}


def oracle_view(name: str) -> str:
    """The view as a DuckDB query."""
    columns, source = VIEWS[name]
    items = ", ".join(f"{_DAYS.sub(_duckdb_days, text)} AS {col}" for col, text in columns.items())
    return f"SELECT {items} FROM {source}"


def _duckdb_days(m: re.Match) -> str:
    return f"date_diff('day', {m[2]}, {m[1]})"


def _project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{_DAYS.sub(r'datediff(\1, \2)', text)} AS {col}" for col, text in columns.items()])


class CreditTables:
    """The seven tables of one test-data folder, by name, as lazy frames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._sources: dict[str, DataFrame] = {}
        self._views: dict[str, DataFrame] = {}
        self._applications: DataFrame | None = None
        self._shared: DataFrame | None = None

    def source(self, name: str) -> DataFrame:
        if name not in self._sources:
            self._sources[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._sources[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._views:
            columns, _ = VIEWS[name]
            self._views[name] = _project(getattr(self, f"_{name}")(), columns)
        return self._views[name]

    def _application_train(self) -> DataFrame:
        # The latest order is found by a partial aggregate, so a customer with very many orders never forms one group.
        latest = (
            self.source("orders")
            .filter(f"o_orderdate <= {APPLICATION_CUTOFF}")
            .groupBy("o_custkey")
            .agg(F.max(F.struct("o_orderdate", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")).alias("o"))
        )
        return (
            latest.join(self.source("customer").alias("c"), F.expr("c.c_custkey = o_custkey"))
            .join(self.source("nation").alias("n"), F.expr("n.n_nationkey = c.c_nationkey"))
        )

    def applications(self) -> DataFrame:
        """Id, order and date of every application, stored once: three histories and their joins start from it.

        Joined from storage, both sides of those joins are plain shuffles, which the adaptive planner can split where
        one customer has very many orders.
        """
        if self._applications is None:
            keys = self["application_train"].select("sk_id_curr", *APPLICATION_HELPERS)
            self._applications = staged(keys, "applications")
        return self._applications

    def share_applications(self) -> None:
        """Store the applications whole, for queries that read their columns and their histories."""
        if self._applications is None:
            stored = staged(self["application_train"], "application")
            self._views["application_train"] = stored
            self._applications = stored.select("sk_id_curr", *APPLICATION_HELPERS)

    def share_orders(self) -> None:
        """Store the orders of applicants, for queries that read several histories: their join then runs once."""
        if self._shared is None:
            joined = self._orders_of_applicants()
            self._shared = staged(
                joined.select(
                    F.struct("o.o_orderkey", "o.o_orderdate", "o.o_orderstatus", "o.o_orderpriority", "o.o_totalprice").alias("o"),
                    F.struct("a.sk_id_curr", *[f"a.{c}" for c in APPLICATION_HELPERS]).alias("a"),
                ),
                "orders-of-applicants",
            )

    def _orders_of_applicants(self) -> DataFrame:
        if self._shared is not None:
            return self._shared
        applicants = self.applications().alias("a")
        return self.source("orders").alias("o").join(applicants, F.expr("a.sk_id_curr = o.o_custkey"))

    def _bureau(self) -> DataFrame:
        return self._orders_of_applicants().filter("o.o_orderkey <> a.app_orderkey")

    def _bureau_balance(self) -> DataFrame:
        return self.source("lineitem").alias("l")

    def _previous_application(self) -> DataFrame:
        return self._bureau()

    def _installments_payments(self) -> DataFrame:
        # Orders meet their applicants first, so the far larger line items are shuffled once, by order.
        return self.source("lineitem").alias("l").join(
            self._orders_of_applicants(), F.expr("o.o_orderkey = l.l_orderkey")
        )

    def _credit_card_balance(self) -> DataFrame:
        return self._orders_of_applicants()

    def _pos_cash_balance(self) -> DataFrame:
        return self._orders_of_applicants()
