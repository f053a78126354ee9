"""Vector codes and hard negatives against plain versions of themselves."""

import numpy as np
import pytest

from ledgerlens.llm import hard_negatives, vector_codes
from ledgerlens.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return [r.asDict() for r in df.collect()]


@pytest.mark.parametrize("name", ["op12_vector_codes", "op13_hard_negatives"])
def test_same_as_sql_on_given_rows(spark, sql, name):
    df = QUERIES[name](spark, SF)
    names, expected = sql(SF, ORACLES[name])
    assert sorted(names) == sorted(df.columns) and len(expected) > 100
    assert sorted(repr(tuple(r[c] for c in names)) for r in rows_of(df)) == sorted(repr(tuple(r)) for r in expected)


def nearest(points, entries):
    distance = ((points[:, None].astype(object) - entries[None].astype(object)) ** 2).sum(2)
    return np.array([min(range(len(entries)), key=lambda k: (d[k], k)) for d in distance])


@pytest.mark.parametrize("scale", [3, 1 << 22])
@pytest.mark.parametrize("n, k", [(1, 1), (5, 9), (300, 40), (2000, 7)])
def test_dual_walk_equals_all_distances(n, k, scale):
    """Narrow clusters that are assigned whole, entries that are equal, ties, and numbers beyond what doubles hold."""
    rng = np.random.default_rng(n + k)
    centres = rng.integers(-100, 100, (6, 3)) * scale
    points = centres[rng.integers(0, 6, n)] + rng.integers(-2, 3, (n, 3))
    entries = np.concatenate([centres, points])[rng.integers(0, 6 + n, k)]
    edges = vector_codes._edges(n, 16)
    ordered = points[vector_codes._order(points, edges)]
    tree = vector_codes._tree(ordered, edges, vector_codes._of_leaves(ordered, edges))
    codes, whole = vector_codes.assigned(tree, vector_codes._book(entries))
    for start, end, index, total in whole:
        assert (codes[start:end] == -1).all() and (total == ordered[start:end].sum(0)).all()
        codes[start:end] = index
    assert codes.tolist() == nearest(ordered, entries).tolist()
    if (n, k) == (2000, 7):
        assert sum(end - start for start, end, *_ in whole) > n / 3


def test_blocks_do_not_matter(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    some = vector_codes.Settings(entries=16, rounds=2)
    one, books = vector_codes.compressed(vectors, some)
    two, others = vector_codes.compressed(vectors.repartition(5), vector_codes.Settings(entries=16, rounds=2, block=70, leaf=3))
    assert (books == others).all() and sorted(one.collect()) == sorted(two.collect())


def test_unequal_lengths_are_refused(spark):
    rows = spark.createDataFrame([(1, [1.0] * 4, 1), (2, [1.0] * 8, 1)], "vec_id bigint, embedding array<float>, label int")
    with pytest.raises(ValueError, match="components"):
        vector_codes.compressed(rows)
    with pytest.raises(ValueError, match="components"):
        hard_negatives.mined(rows, rows.vec_id == 1)


def test_vectors_without_components(spark):
    rows = spark.createDataFrame([(1, [], 1), (2, [], 2)], "vec_id bigint, embedding array<float>, label int")
    coded, books = vector_codes.compressed(rows)
    assert {(r.code, r.error) for r in coded.collect()} == {("00000000", 0)} and not books.size
    assert hard_negatives.mined(rows, rows.vec_id == 1).collect() == []


@pytest.mark.parametrize("width", [3, 64, 70])
def test_intervals_hold_every_score(width):
    rng = np.random.default_rng(width)
    s = hard_negatives.Settings(dense_levels=1)
    turns = hard_negatives.rotations(width, s)
    vectors = rng.integers(-300, 300, (400, width))
    vectors[:12] = 0
    vectors[20:40] = vectors[40:60]
    anchors = hard_negatives.prepared(list(range(30)), list(range(30)), ["a"] * 30, vectors[10:40], turns, s)
    words, aligned, rest = hard_negatives.coded(vectors, turns)
    rows = hard_negatives.Rows(np.arange(400), np.arange(400), np.zeros(400, bool), np.zeros(400, int), vectors, words, aligned, rest)
    score = vectors[10:40] @ vectors.T
    at, wanted = np.arange(30), np.ones((30, 400), bool)
    for gap in (0, 5_000):
        for column in range(0, 400, 57):
            exact = score[:, column].astype(float)
            found = set(zip(*hard_negatives.candidates(anchors, at, rows, wanted, exact - gap, exact + gap, s), strict=True))
            assert {(i, r) for i, r in zip(*np.nonzero(np.abs(score - exact[:, None]) <= gap), strict=True)} <= found
    if width == 64:
        top = np.sort(score, axis=1)[:, -5].astype(float)
        found, _ = hard_negatives.candidates(anchors, at, rows, wanted, top, np.full(30, np.inf), s)
        assert np.sum(found > 1) < 0.2 * 28 * 400  # the first two are zero and alike to all


def plain(rows, s):
    """(anchor, positive, rank, negative, scores), with a row's place for its id."""
    found = []
    for a, x, v in rows:
        if a is None or a % 100:
            continue
        score = lambda r: sum(p * q for p, q in zip(v, r[2], strict=True))  # noqa: B023, E731
        others = [r for r in rows if r[2] is not v]
        order = lambda r: (-score(r), r[0] is None, r[0] or 0)  # noqa: B023, E731
        for p in sorted((r for r in others if r[1] == x), key=order)[: s.positives]:
            inside = [r for r in others if r[1] != x and 80 * score(p) <= 100 * score(r) <= 100 * score(p)]
            for rank, n in enumerate(sorted(inside, key=order)[: s.negatives], 1):
                found.append((a, p[0], rank, n[0], score(p), score(n)))
    return sorted(found, key=repr)


def test_mining_in_small_runs(spark, edges):
    """Many blocks of anchors, runs of few rows, copies of anchors, ties and rows without an id."""
    s = hard_negatives.Settings(anchors=2, anchor_run=1, row_run=7, scored_run=5)
    df = spark.read.parquet(f"{edges}/embeddings.parquet")
    rows = [
        (r["vec_id"], str(r["label"]), [int(np.floor(256 * x)) for x in r["embedding"]])
        for r in df.collect()
        if r["label"] is not None and r["embedding"] and all(x is not None and np.isfinite(x) for x in r["embedding"])
    ]
    got = [tuple(r) for r in hard_negatives.mined(df.repartition(3), df.vec_id % 100 == 0, s).collect()]
    expected = plain(rows, s)
    assert len(expected) > 20 and sorted(got, key=repr) == expected
