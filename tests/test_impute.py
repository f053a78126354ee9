import random
import statistics

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import impute


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(2)
    rows = [
        (i, rng.choice(["a", "b", None]), rng.choice([None, 1, 1, 2, rng.randrange(50)]), rng.choice([None, rng.gauss(0, 1)]), None)
        for i in range(400)
    ]
    rows += [(400 + i, "lone", None, -1.5, None) for i in range(3)]
    return spark.createDataFrame(rows, "id int, kind string, whole int, real double, empty double").cache()


def plain(rows, column, kind=...):
    values = [r[column] for r in rows if r[column] is not None and (kind is ... or (r.kind or "MISSING") == kind)]
    return (len(values), statistics.median(values)) if values else None


def test_medians_are_exact(frame):
    rows = frame.collect()
    got = {r.feature: (r.n, r.median) for r in impute.medians(frame, ["whole", "real", "empty"]).collect()}
    assert got == {c: plain(rows, c) for c in ("whole", "real")}
    grouped = {(r.kind, r.feature): (r.n, r.median) for r in impute.medians(frame, ["whole", "real"], ["kind"]).collect()}
    expected = {(k, c): plain(rows, c, k) for k in ("a", "b", "MISSING", "lone") for c in ("whole", "real")}
    assert grouped == {k: v for k, v in expected.items() if v}


def test_a_hot_value_is_one_row(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, F.lit(7.0)).otherwise(F.col("id").cast("double")).alias("x"))
    assert [(r.n, r.median) for r in impute.medians(df, ["x"]).collect()] == [(30_000, 7.0)]


def test_gaps_are_filled_by_group_then_overall(frame):
    rows = {r.id: r for r in frame.collect()}
    filled = impute.imputed(frame, ["whole", "real", "empty"], ["kind"])
    assert filled.columns == frame.columns and filled.count() == len(rows)
    for r in filled.collect():
        before = rows[r.id]
        assert r.kind == before.kind and r.empty is None
        for c in ("whole", "real"):
            own = plain(rows.values(), c, before.kind or "MISSING") or plain(rows.values(), c)
            assert r[c] == (before[c] if before[c] is not None else own[1])


def test_no_rows(frame):
    assert impute.medians(frame.limit(0), ["whole"], ["kind"]).count() == 0
