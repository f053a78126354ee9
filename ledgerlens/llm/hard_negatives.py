"""Hard negatives: for an anchor and each of its positives, the most similar rows of other labels within a window of scores.

Vectors become whole numbers, and a score is an exact inner product. All rows are indexed by rotated one-bit codes: a vector
is rotated, the signs of its components are its code, and its alignment with the code, a unit vector, is stored. What the
code leaves over is rotated and coded again, ``levels`` times in all; the length of what is left after each is stored too.
An anchor is rotated likewise and its components are cut to a few bits, so that its product with a code is a weighted sum of
popcounts. Alignments times such products estimate a score. By Cauchy-Schwarz the estimate is wrong by at most the lengths of
what was cut from the anchor, times the alignments, and what is left of the vector, times the anchor's length. Only pairs
whose interval reaches the window and the best rows so far are scored, in whole numbers, so no row is missed.

* Anchors are taken in blocks of a bounded number; a block is sent to all tasks, which read the index and give the best
  rows of their part for each anchor, first of the positives, then of the negatives. No table of all pairs is made, and a
  label that many rows have makes no difference. Results of a block are written before the next one begins.
* Higher scores come first, equal ones by smaller id; rows without an id count last. Repeated rows are rows of their own, and
  a copy of an anchor may be its positive. An anchor without another row of its label, or without rows in the window, gives
  none.
* Rows without a label or a vector, and vectors with a null or non-finite component, take no part. All others must have one
  length, and numbers whose products fit into 53 bits; otherwise a ``ValueError`` says so. Vectors without components score
  0. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import numbered
from ledgerlens.llm.vector_codes import complete, whole_numbers, width_of
from ledgerlens.session import scratch_path, staged

#: Relative to the lengths of both vectors, more than what floating point adds to an estimate's error.
ROUNDING = 1e-9
INDEX = "uid bigint, vec_id bigint, label string, v array<bigint>, codes binary, aligned array<double>, rest array<double>"
FOUND = "unit bigint, score bigint, id bigint, uid bigint"
RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


@dataclass(frozen=True)
class Settings:
    scale: int = 256
    positives: int = 5
    negatives: int = 5
    #: The window of negatives, in hundredths of the positive's score.
    least_percent: int = 80
    most_percent: int = 100
    levels: int = 4
    anchor_bits: int = 7
    #: Levels estimated for all pairs before the pairs left are listed.
    dense_levels: int = 2
    #: Anchors sent out at a time, and how many anchors and rows are compared at a time.
    anchors: int = 2048
    anchor_run: int = 512
    row_run: int = 2048
    scored_run: int = 65_536
    seed: int = 29


# --- Codes ---


def rotations(width: int, s: Settings) -> np.ndarray:
    """Random orthogonal matrices, one for each level."""
    rng = np.random.default_rng(s.seed)
    return np.stack([np.linalg.qr(rng.standard_normal((width, width)))[0] for _ in range(s.levels)])


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    bytes_ = np.packbits(bits, axis=-1, bitorder="little")
    missing = -bytes_.shape[-1] % 8
    padded = np.pad(bytes_, [(0, 0)] * (bytes_.ndim - 1) + [(0, missing)])
    return np.ascontiguousarray(padded).view(np.uint64)


def coded(vectors: np.ndarray, turns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each level's code, alignment, length of what is left) for each vector; levels are the second axis."""
    n, width = vectors.shape
    left, words, aligned, rest = vectors.astype(np.float64), [], [], []
    for turn in turns:
        left = left @ turn.T
        signs = left >= 0
        aligned.append(np.abs(left).sum(1) / np.sqrt(max(width, 1)))
        left = left - np.where(signs, 1.0, -1.0) * (aligned[-1] / np.sqrt(max(width, 1)))[:, None]
        words.append(_packed(signs))
        rest.append(np.sqrt(np.einsum("ij,ij->i", left, left)))
    return np.stack(words, 1), np.stack(aligned, 1), np.stack(rest, 1)


@dataclass(frozen=True)
class Anchors:
    """A block of anchors, with their rotated components cut to ``low + step * whole``, and the wholes as planes of bits."""

    uid: np.ndarray
    ids: list[int]
    labels: list[str]
    vectors: np.ndarray
    length: np.ndarray
    planes: np.ndarray  # level, bit, anchor, word
    whole_sum: np.ndarray  # level, anchor; so are the next three
    low: np.ndarray
    step: np.ndarray
    cut: np.ndarray


def prepared(uid: list[int], ids: list[int], labels: list[str], vectors: np.ndarray, turns: np.ndarray, s: Settings) -> Anchors:
    turned, levels = vectors.astype(np.float64), []
    most = (1 << s.anchor_bits) - 1
    for turn in turns:
        turned = turned @ turn.T
        low = turned.min(1, initial=0.0)
        step = np.maximum(turned.max(1, initial=0.0) - low, 1e-30) / most
        whole = np.rint((turned - low[:, None]) / step[:, None]).astype(np.int64).clip(0, most)
        off = turned - (low[:, None] + step[:, None] * whole)
        planes = np.stack([_packed(whole >> bit & 1 == 1) for bit in range(s.anchor_bits)])
        levels.append((planes, whole.sum(1), low, step, np.sqrt(np.einsum("ij,ij->i", off, off))))
    length = np.sqrt(np.einsum("ij,ij->i", turned, turned))
    return Anchors(np.array(uid, np.int64), ids, labels, vectors, length, *[np.stack(x) for x in zip(*levels, strict=True)])


@dataclass(frozen=True)
class Rows:
    """A run of indexed rows."""

    uid: np.ndarray
    ids: np.ndarray
    no_id: np.ndarray
    labels: np.ndarray  # numbers of the anchors' labels, -1 for others
    vectors: np.ndarray
    codes: np.ndarray  # row, level, word
    aligned: np.ndarray  # row, level; so is the next
    rest: np.ndarray

    def part(self, start: int, end: int) -> Rows:
        return Rows(*[getattr(self, name)[start:end] for name in self.__dataclass_fields__])


def _products(a: Anchors, level: int, i, rows: Rows, r) -> np.ndarray:
    """Products of anchors i, as cut, with the codes of rows r; popcounts weighted by the bits' places."""
    codes, width = rows.codes[r, level], rows.vectors.shape[1]
    shape = np.broadcast_shapes(a.planes[level, 0, i].shape, codes.shape)[:-1]
    common = np.zeros(shape, np.int64)
    for bit, plane in enumerate(a.planes[level]):
        common += np.bitwise_count(plane[i] & codes).sum(-1, dtype=np.int64) << bit
    ones = np.bitwise_count(codes).sum(-1, dtype=np.int64)
    cut = a.step[level, i] * (2 * common - a.whole_sum[level, i]) + a.low[level, i] * (2 * ones - width)
    return cut / np.sqrt(max(width, 1))


def candidates(
    a: Anchors, at: np.ndarray, rows: Rows, wanted: np.ndarray, least: np.ndarray, most: np.ndarray, s: Settings
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (anchor, row) of the wanted ones whose score may lie from ``least`` to ``most`` of their anchor."""
    i, r = at[:, None], np.arange(len(rows.uid))[None, :]
    estimate, cut = np.zeros(()), np.zeros(())
    for level in range(s.levels):
        estimate = estimate + rows.aligned[r, level] * _products(a, level, i, rows, r)
        cut = cut + rows.aligned[r, level] * a.cut[level, i]
        if level + 1 < min(s.dense_levels, s.levels):
            continue
        whole = np.sqrt(rows.aligned[r, 0] ** 2 + rows.rest[r, 0] ** 2)
        wide = cut + (rows.rest[r, level] + ROUNDING * whole) * a.length[i] + ROUNDING
        near = (estimate + wide >= least[i]) & (estimate - wide <= most[i])
        if near.ndim == 2:
            pair = np.nonzero(near & wanted)
            i, r, estimate, cut = at[pair[0]], pair[1], estimate[pair], cut[pair]
        else:
            i, r, estimate, cut = i[near], r[near], estimate[near], cut[near]
    return i, r


# --- The best rows of a task ---


class Best:
    """For each unit the first ``k`` rows so far, as columns: unit, score, whether it lacks an id, id, uid."""

    def __init__(self, units: int, k: int):
        self.k, self.least = k, np.full(units, -np.inf)
        self.columns = [np.zeros(0, np.int64) for _ in range(5)]

    def add(self, unit: np.ndarray, score: np.ndarray, rows: Rows, r: np.ndarray) -> None:
        if not len(unit):
            return
        new = (unit, score, rows.no_id[r].astype(np.int64), rows.ids[r], rows.uid[r])
        unit, score, no_id, ids, uid = (np.concatenate(x) for x in zip(self.columns, new, strict=True))
        order = np.lexsort((uid, ids, no_id, -score, unit))
        ordered = unit[order]
        first = np.flatnonzero(np.diff(ordered, prepend=-1))
        place = np.arange(len(order)) - np.repeat(first, np.diff(first, append=len(order)))
        kept = order[place < self.k]
        self.columns = [x[kept] for x in (unit, score, no_id, ids, uid)]
        last = order[place == self.k - 1]
        self.least[unit[last]] = score[last]

    def batch(self) -> pa.RecordBatch:
        unit, score, no_id, ids, uid = self.columns
        columns = [pa.array(unit), pa.array(score), pa.array(ids, mask=no_id == 1), pa.array(uid)]
        return pa.RecordBatch.from_arrays(columns, names=["unit", "score", "id", "uid"])


def _scores(a: Anchors, i: np.ndarray, rows: Rows, r: np.ndarray, s: Settings) -> np.ndarray:
    runs = [slice(k, k + s.scored_run) for k in range(0, len(i), s.scored_run)]
    found = [np.einsum("ij,ij->i", a.vectors[i[run]], rows.vectors[r[run]]) for run in runs]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _runs(batches: Iterator[pa.RecordBatch], width: int, number: dict[str, int], s: Settings) -> Iterator[Rows]:
    for batch in batches:
        n = len(batch)
        if not n:
            continue
        matrix = lambda c, width: batch[c].flatten().to_numpy(zero_copy_only=False).reshape(n, width)  # noqa: E731, B023
        codes = [np.frombuffer(x, np.uint64).reshape(s.levels, -(-width // 64)) for x in batch["codes"].to_pylist()]
        rows = Rows(
            batch["uid"].to_numpy(), batch["vec_id"].fill_null(0).to_numpy(), batch["vec_id"].is_null().to_numpy(zero_copy_only=False),
            np.array([number.get(x, -1) for x in batch["label"].to_pylist()], np.int64), matrix("v", width),
            np.stack(codes), matrix("aligned", s.levels), matrix("rest", s.levels),
        )
        for start in range(0, n, s.row_run):
            yield rows.part(start, start + s.row_run)


def _numbers(labels: list[str]) -> tuple[dict[str, int], np.ndarray]:
    number = {x: k for k, x in enumerate(dict.fromkeys(labels))}
    return number, np.array([number[x] for x in labels], np.int64)


def _positives(sent, s: Settings):
    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: Anchors = sent.value
        number, label = _numbers(a.labels)
        found, most = Best(len(a.ids), s.positives), np.full(len(a.ids), np.inf)
        for rows in _runs(batches, a.vectors.shape[1], number, s):
            for at in np.array_split(np.arange(len(a.ids)), -(-len(a.ids) // s.anchor_run)):
                wanted = (label[at][:, None] == rows.labels[None, :]) & (a.uid[at][:, None] != rows.uid[None, :])
                i, r = candidates(a, at, rows, wanted, found.least, most, s)
                found.add(i, _scores(a, i, rows, r, s), rows, r)
        yield found.batch()

    return best


def _negatives(sent, positive_scores, s: Settings):
    """Units are anchors times ``positives`` plus the positive's place; a place without a positive has an empty window."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: Anchors = sent.value
        number, label = _numbers(a.labels)
        least, most = positive_scores.value  # of the scores, anchor by place
        found = Best(least.size, s.negatives)
        for rows in _runs(batches, a.vectors.shape[1], number, s):
            for at in np.array_split(np.arange(len(a.ids)), -(-len(a.ids) // s.anchor_run)):
                wanted = label[at][:, None] != rows.labels[None, :]
                # A row is of use where it is in some window and not below the last of the rows found there.
                use = np.where(least <= most, np.maximum(least, found.least.reshape(least.shape)), np.inf)
                i, r = candidates(a, at, rows, wanted, use.min(1), most.max(1), s)
                score = _scores(a, i, rows, r, s)
                for place in range(s.positives):
                    inside = (score >= use[i, place]) & (score <= most[i, place])
                    found.add(i[inside] * s.positives + place, score[inside], rows, r[inside])
        yield found.batch()

    return best


# --- Jobs ---


def _indexed(rows: DataFrame, turns: np.ndarray) -> DataFrame:
    """Every row with its codes, stored."""
    width = turns.shape[1]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch["v"].flatten().to_numpy(zero_copy_only=False).reshape(len(batch), width)
            words, aligned, rest = coded(vectors, turns)
            lists = [pa.array(list(x), pa.list_(pa.float64())) for x in (aligned, rest)]
            codes = pa.array([w.tobytes() for w in words], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, codes, *lists], names=[*batch.schema.names, "codes", "aligned", "rest"])

    return staged(rows.select("uid", "vec_id", "label", "v").mapInArrow(index, INDEX), "index")


def _first(found: DataFrame, k: int) -> DataFrame:
    """Of what the tasks found, the first ``k`` rows of each unit, with their place."""
    order = Window.partitionBy("unit").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "uid")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def _block_bounds(anchors: DataFrame, size: int) -> list[tuple[int, int]]:
    """Ranges of numbers with at most ``size`` anchors each. Numbers run from 0 within each stored partition."""
    part = F.shiftright("number", 33)
    sizes = sorted((r["part"], r["n"]) for r in anchors.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    total = sum(n for _, n in sizes)
    starts, before = [], 0
    for part_, n in sizes:
        starts += [(part_ << 33) + k - before for k in range(-(-before // size) * size, before + n, size)]
        before += n
    return list(zip(starts, [*starts[1:], 1 << 62], strict=True)) if total else []


def mined(
    vectors: DataFrame, is_anchor: Column, s: Settings = Settings(), vec_id: str = "vec_id", vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), stored."""
    spark = vectors.sparkSession
    kept = vectors.filter(F.col(label).isNotNull() & complete(F.col(vector)))
    rows = numbered(
        kept.select(
            F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).cast("string").alias("label"),
            whole_numbers(F.col(vector), s.scale).alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
        ),
        "vectors",
    )
    width = width_of(rows, bits=53)
    turns = rotations(width, s)
    index = _indexed(rows, turns)
    anchors = numbered(rows.filter("is_anchor").select("uid", "vec_id", "label", "v"), "anchors", uid="number")
    folder = scratch_path(spark, "negatives")
    blocks = _block_bounds(anchors, s.anchors)
    for block, (start, end) in enumerate(blocks):
        own = anchors.filter((F.col("number") >= start) & (F.col("number") < end)).collect()
        whole = np.array([r["v"] for r in own], np.int64).reshape(len(own), width)
        block_anchors = prepared([r["uid"] for r in own], [r["vec_id"] for r in own], [r["label"] for r in own], whole, turns, s)
        _mine(index, block_anchors, s).write.parquet(f"{folder}/block={block}")
    if not blocks:
        return spark.createDataFrame([], RESULT)
    return spark.read.schema(f"{RESULT}, block int").parquet(folder).drop("block")


def _mine(index: DataFrame, a: Anchors, s: Settings) -> DataFrame:
    spark = index.sparkSession
    sent = spark.sparkContext.broadcast(a)
    first = _first(index.mapInArrow(_positives(sent, s), FOUND), s.positives).collect()
    # The driver knows a block's positives: as many as the two settings say.
    least, most = np.full((len(a.ids), s.positives), np.inf), np.full((len(a.ids), s.positives), -np.inf)
    for r in first:
        least[r["unit"], r["place"] - 1] = -(-s.least_percent * r["score"] // 100)
        most[r["unit"], r["place"] - 1] = s.most_percent * r["score"] // 100
    windows = spark.sparkContext.broadcast((least, most))
    named = [(r["unit"] * s.positives + r["place"] - 1, a.ids[r["unit"]], r["id"], r["score"]) for r in first]
    positives = spark.createDataFrame(named, "unit bigint, anchor_id bigint, positive_id bigint, positive_score bigint")
    negatives = _first(index.mapInArrow(_negatives(sent, windows, s), FOUND), s.negatives)
    both = negatives.join(positives, "unit")
    return both.select(
        "anchor_id", "positive_id", F.col("place").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
