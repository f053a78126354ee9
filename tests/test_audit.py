import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import audit


@pytest.fixture(scope="module")
def frame(spark):
    df = spark.range(200).select(
        F.col("id").alias("sk_id_curr"),
        (F.col("id") % 10 == 0).cast("int").alias("target"),
        F.lit(3.0).alias("constant"),
        (F.lit(0.9) + F.when(F.col("id") % 2 == 0, 1.1102230246251565e-16).otherwise(0.0)).alias("noise"),
        F.when(F.col("id") % 10 == 0, 1.0).alias("leak_null"),
        F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("gaps"),
        F.lit(None).cast("double").alias("empty"),
        F.lit("text").alias("label"),
    )
    return df.withColumn("leak", F.col("target") * 100 + F.col("sk_id_curr") % 3).cache()


def test_correlations(frame):
    report = {r.feature: r for r in audit.correlation_audit(frame).collect()}
    assert set(report) == {"sk_id_curr", "constant", "noise", "leak_null", "gaps", "empty", "leak"}
    assert report["leak"].flagged and report["leak"].value > 0.99
    for name in ("constant", "noise", "leak_null", "empty"):
        assert report[name].value is None and not report[name].flagged
    ids = np.arange(200)
    some = ids % 3 > 0
    expected = abs(np.corrcoef((ids % 7)[some], (ids % 10 == 0)[some])[0, 1])
    assert report["gaps"].value == pytest.approx(expected)


def test_leaks_in_large_numbers(spark):
    df = spark.range(200).select((F.col("id") % 10 == 0).cast("int").alias("target"), F.col("id"))
    leaky = df.withColumns({"whole": F.lit(10**15) + F.col("target") * 100, "real": F.lit(1e15) + F.col("target") * 100.0})
    report = {r.feature: r for r in audit.correlation_audit(leaky).collect()}
    assert report["whole"].flagged and report["real"].flagged and report["whole"].value == pytest.approx(1.0)


def test_id_check_skips_hashed_ids(frame):
    assert audit.id_audit(frame).count() == 1
    hashed = frame.withColumn("sk_id_curr", F.sha2(F.col("sk_id_curr").cast("string"), 256))
    assert audit.id_audit(hashed).count() == 0


def test_null_states(frame):
    report = {r.feature: r for r in audit.null_state_audit(frame).collect()}
    assert set(report) == {"leak_null", "gaps"}
    assert report["leak_null"].flagged and report["leak_null"].value == pytest.approx(1.0)
    assert not report["gaps"].flagged


def test_verdict(frame):
    found = audit.audit_verdict(audit.audit_report(frame)).first()
    assert (found.correlation_findings, found.null_state_findings, found.leak_found) == (1, 1, True)
    clean = audit.audit_verdict(audit.audit_report(frame.select(F.sha2(F.lit("x"), 256).alias("sk_id_curr"), "target", "gaps")))
    assert clean.first().leak_found is False


def test_rows_are_not_multiplied_by_columns(spark):
    wide = spark.range(500).select((F.col("id") % 2).alias("target"), *[(F.col("id") * k % 17).alias(f"c{k}") for k in range(40)])
    report = audit.correlation_audit(wide)
    assert report.count() == 40
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    below = [line for line in plan.splitlines() if "Aggregate" in line]
    assert len(below) == -(-40 // audit.BLOCK) and "Expand" not in plan
    # What turns columns into rows stands above the aggregates, so it sees one row for each block.
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    assert max(depth(line) for line in plan.splitlines() if "Generate" in line) < min(map(depth, below))
