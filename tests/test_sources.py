import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgerlens.schemas import MANIFEST, SPECS
from ledgerlens.sources import tables

import synthetic


def test_csv_is_read_under_declared_types(spark, tmp_path):
    (tmp_path / "previous_application.csv").write_text(
        "SK_ID_PREV,SK_ID_CURR,NAME_CONTRACT_STATUS,AMT_CREDIT,DAYS_DECISION,EXTRA\n7,1,Approved,10,-3.0,x\n8,1,,,,y\n"
    )
    df, rows = tables.counted(tables.read_csv(spark, str(tmp_path), SPECS["previous_application"]), "previous")
    assert dict(df.dtypes) == {
        "sk_id_prev": "bigint", "sk_id_curr": "bigint", "name_contract_status": "string", "amt_credit": "double",
        "days_decision": "int", "extra": "string",
    }
    assert sorted(tuple(r) for r in df.collect())[0] == (7, 1, "Approved", 10.0, -3, "x")
    assert rows.get == {"n": 2}


def test_missing_file_and_bad_values_raise(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        tables.read_csv(spark, str(tmp_path), SPECS["bureau"])
    (tmp_path / "bureau_balance.csv").write_text("sk_id_bureau,months_balance,status\nabc,1,C\n")
    with pytest.raises(Exception):
        tables.read_csv(spark, str(tmp_path), SPECS["bureau_balance"]).collect()


def test_fractions_in_whole_columns_raise(spark, tmp_path):
    (tmp_path / "bureau_balance.csv").write_text("sk_id_bureau,months_balance,status\n1,-1.7,C\n")
    with pytest.raises(Exception, match="no whole number"):
        tables.read_csv(spark, str(tmp_path), SPECS["bureau_balance"]).collect()


def test_header_only_files_keep_their_types(spark, tmp_path):
    (tmp_path / "bureau_balance.csv").write_text("sk_id_bureau,months_balance,status\n")
    df = tables.read_csv(spark, str(tmp_path), SPECS["bureau_balance"])
    assert df.count() == 0 and df.schema == SPECS["bureau_balance"].schema


def test_write_csv(spark, tmp_path):
    tables.write_csv(spark.createDataFrame([("a", 0.5)], "feature string, importance double"), str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("part-*.csv")).read_text()
    assert text == "feature,importance\na,0.5\n"


def test_synthetic_tables(spark):
    drawn = synthetic.all_tables(synthetic.applicants(spark))
    counts = {r.table_name: r.row_count for r in tables.row_counts(drawn).collect()}
    assert counts == {
        "application_train": 100, "bureau": 300, "bureau_balance": 0, "previous_application": 200,
        "installments_payments": 1000, "credit_card_balance": 0, "pos_cash_balance": 0,
    }
    for spec in MANIFEST:
        assert [(f.name, f.dataType) for f in drawn[spec.name].schema] == [(f.name, f.dataType) for f in spec.schema]
    apps = drawn["application_train"]
    ids = synthetic.applicants(spark)
    assert apps.exceptAll(synthetic.applications(ids.repartition(5))).count() == 0
    assert apps.exceptAll(synthetic.applications(ids, seed=1)).count() > 90


def test_synthetic_distributions(spark):
    ids = synthetic.applicants(spark, 20_000)
    row = synthetic.applications(ids).agg(
        F.avg("target"), F.avg("ext_source_2"), F.stddev("ext_source_2"), F.avg(F.log("amt_income_total")),
        F.min("days_birth"), F.max("days_birth"), F.count_distinct("days_employed"),
    ).first()
    assert row[0] == pytest.approx(0.08, abs=0.01)
    assert row[1] == pytest.approx(0.6, abs=0.01) and row[2] == pytest.approx(0.2, abs=0.01)
    assert row[3] == pytest.approx(11.7, abs=0.02)
    assert row[4] >= -25000 and row[5] < -7000 and row[6] == 3
