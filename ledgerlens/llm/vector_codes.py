"""Vector codes: a codebook for each part of the vectors, refined by dual-tree Lloyd rounds in whole numbers.

Vectors become whole numbers and are cut into equal parts; each part is coded by the nearest entry of its position's
codebook. Bounded blocks of vectors get a tree for each position, which is stored with the bounds and the sums of its nodes
and serves all rounds. The entries get a tree in every round. Pairs of nodes, one of either tree, are opened level by level:
the boxes of a pair bound the distances between what is in them, and a pair goes where another node of entries is nearer at
its farthest than this one at its nearest. A node of parts with one entry left is assigned whole, by its stored sum; parts
of leaves with several entries left are compared with those, in whole numbers.

* A round adds up sums and counts in Spark, at most one row for each entry and task; only the entries, whose number is a
  parameter, come to the driver and are sent out. Results do not depend on blocks or partitions.
* Distances are squared Euclidean; of equally near entries the one with the lower index wins. An entry without parts stays.
* Rows without a vector, and vectors with a null or non-finite component, are dropped. All others must have one length, a
  multiple of ``parts``, and numbers whose distances fit into 64 bits; otherwise a ``ValueError`` says so. The first entries
  are those of the smallest ids; rows without an id count last, rows of one id in order of their vectors. Fewer rows than
  entries give a codebook of as many. Repeated rows count each. An empty table gives an empty result.
* Null labels are one label. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import staged


@dataclass(frozen=True)
class Settings:
    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024
    #: Vectors of one tree, and the least number of them in a leaf.
    block: int = 2048
    leaf: int = 16


# --- Trees ---


def _edges(n: int, leaf: int) -> list[np.ndarray]:
    """For each level, where its nodes begin, and the end: every node is halved until a half would be smaller than a leaf."""
    edges = [np.array([0, n])]
    while n >= 2 * leaf * (len(edges[-1]) - 1):
        now = edges[-1]
        halved = np.empty(2 * len(now) - 1, np.int64)
        halved[::2], halved[1::2] = now, (now[:-1] + now[1:]) // 2
        edges.append(halved)
    return edges


def _order(points: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """The points in the order of the tree: each node is cut at the median of its widest component."""
    order = np.arange(len(points))
    for level, halves in zip(edges[:-1], edges[1:], strict=True):
        for i, (start, end) in enumerate(zip(level[:-1], level[1:], strict=True)):
            own = points[order[start:end]]
            widest = np.argmax(own.max(0) - own.min(0))
            order[start:end] = order[start:end][np.argpartition(own[:, widest], halves[2 * i + 1] - start)]
    return order


@dataclass(frozen=True)
class Tree:
    """Points in the order of the tree; for each level the edges, smallest and largest components and sums of its nodes."""

    points: np.ndarray
    edges: list[np.ndarray]
    low: list[np.ndarray]
    high: list[np.ndarray]
    total: list[np.ndarray]


def _levels(leaves: np.ndarray, merge: np.ufunc, depth: int) -> list[np.ndarray]:
    """From what the leaves have, what the nodes of each level have, the root first."""
    levels = [leaves]
    for _ in range(depth):
        levels.append(merge(levels[-1][::2], levels[-1][1::2]))
    return levels[::-1]


def _of_leaves(points: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
    return [merge.reduceat(points, edges[-1][:-1], axis=0) for merge in (np.minimum, np.maximum, np.add)]


def _tree(points: np.ndarray, edges: list[np.ndarray], leaves: list[np.ndarray]) -> Tree:
    kinds = zip(leaves, (np.minimum, np.maximum, np.add), strict=True)
    return Tree(points, edges, *[_levels(x, merge, len(edges) - 1) for x, merge in kinds])


@dataclass(frozen=True)
class Book:
    """The tree of a position's different entries, and the index of each; of equal entries only the first can be nearest."""

    tree: Tree
    index: np.ndarray


def _book(entries: np.ndarray) -> Book:
    different, index = np.unique(entries, axis=0, return_index=True)
    edges = _edges(len(different), 1)
    order = _order(different, edges)
    points = different[order]
    tree = _tree(points, edges, _of_leaves(points, edges))
    if len(points) > len(edges[-1]) - 1:  # a last level of single entries
        tree = Tree(points, [*edges, np.arange(len(points) + 1)], *[[*x, points] for x in (tree.low, tree.high, tree.total)])
    return Book(tree, index[order])


# --- The walk over both trees ---


def _opened(edges: list[np.ndarray], level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes one level below, one node's after the other's, and how many each has."""
    first = np.searchsorted(edges[level + 1], edges[level][nodes])
    n = np.searchsorted(edges[level + 1], edges[level][nodes + 1]) - first
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum()), n


def _near_and_far(a: Tree, level_a: int, i: np.ndarray, b: Tree, level_b: int, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of nodes, bounds of the squared distances between their points."""
    over = a.low[level_a][i] - b.high[level_b][j]
    under = b.low[level_b][j] - a.high[level_a][i]
    gap, span = np.maximum(np.maximum(over, under), 0), np.maximum(-over, -under)
    return np.einsum("ij,ij->i", gap, gap), np.einsum("ij,ij->i", span, span)


def assigned(data: Tree, book: Book) -> tuple[np.ndarray, list[tuple[int, int, int, np.ndarray]]]:
    """(index for each point of an undecided leaf and -1 elsewhere, [(start, end, index, sum)] of nodes assigned whole)."""
    entries, whole = book.tree, []
    i, j, level, entry_level = np.zeros(1, np.int64), np.zeros(1, np.int64), 0, 0
    deepest, entry_deepest = len(data.edges) - 1, len(entries.edges) - 1
    while True:
        near, far = _near_and_far(data, level, i, entries, entry_level, j)
        first = np.flatnonzero(np.diff(i, prepend=-1))
        keep = near <= np.repeat(np.minimum.reduceat(far, first), np.diff(first, append=len(i)))
        i, j = i[keep], j[keep]
        start, end = entries.edges[entry_level][j], entries.edges[entry_level][j + 1]
        alone = (np.diff(i, prepend=-1) != 0) & (np.diff(i, append=-1) != 0) & (end - start == 1)
        for node, at in zip(i[alone].tolist(), start[alone].tolist(), strict=True):
            edges = data.edges[level]
            whole.append((int(edges[node]), int(edges[node + 1]), int(book.index[at]), data.total[level][node]))
        i, j = i[~alone], j[~alone]
        if not len(i) or (level == deepest and entry_level == entry_deepest):
            break
        if entry_level < entry_deepest:
            j, n = _opened(entries.edges, entry_level, j)
            i, entry_level = np.repeat(i, n), entry_level + 1
        if level < deepest:
            i, n = _opened(data.edges, level, i)
            j, level = np.repeat(j, n), level + 1
            order = np.argsort(i, kind="stable")
            i, j = i[order], j[order]
    return _compared(data, book, i, j), whole


def _compared(data: Tree, book: Book, leaves: np.ndarray, entry_leaves: np.ndarray) -> np.ndarray:
    """The nearest entry of each point of these leaves among the entries left for its leaf."""
    codes = np.full(len(data.points), -1, np.int64)
    if not len(leaves):
        return codes
    edges, entry_edges = data.edges[-1], book.tree.edges[-1]
    exact = _exact(data.points, book.tree.points)
    points, entries = data.points.astype(exact), book.tree.points.astype(exact)
    squares = np.einsum("ij,ij->i", entries, entries)
    first = np.flatnonzero(np.diff(leaves, prepend=-1))
    for at, end in zip(first, [*first[1:], len(leaves)], strict=True):
        own = entry_leaves[at:end]
        left = entry_edges[own]  # single entries by now
        left = left[np.argsort(book.index[left])]
        rows = slice(edges[leaves[at]], edges[leaves[at] + 1])
        codes[rows] = book.index[left[np.argmin(squares[left] - 2 * (points[rows] @ entries[left].T), axis=1)]]
    return codes


def _exact(*arrays: np.ndarray) -> type:
    """Double precision holds whole numbers up to 2**53 exactly and multiplies faster; beyond, 64-bit integers."""
    most = max((int(np.abs(a).max()) for a in arrays if a.size), default=0)
    return np.float64 if 4 * most * most * arrays[0].shape[1] < 1 << 53 else np.int64


# --- Blocks of vectors, stored with their trees ---


def whole_numbers(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def complete(vector: Column) -> Column:
    """Whether there is a vector all of whose components are finite numbers."""
    number = lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False))
    return F.coalesce(F.forall(vector, number), F.lit(False))


def width_of(rows: DataFrame, column: str = "v", bits: int = 62) -> int:
    """The one length of the vectors. Their numbers must be small enough for squared distances of so many bits."""
    sizes, most = F.size(column), F.array_max(F.transform(column, F.abs))
    least, longest, largest = rows.agg(F.min(sizes), F.max(sizes), F.max(most)).first()
    if least != longest:
        raise ValueError(f"vectors of {least} and of {longest} components")
    if largest and 4 * largest * largest * longest >= 1 << bits:
        raise ValueError(f"components up to {largest} are too large for exact sums")
    return longest or 0


def _blocks(rows: DataFrame, width: int, s: Settings) -> DataFrame:
    """One row for each block: its ids and labels, its points in the order of each position's tree, and what the leaves have."""
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    numbers = ("points", "order", "low", "high", "total")

    def built(batch: pa.Table) -> pa.RecordBatch:
        n = len(batch)
        vectors = batch["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, s.parts, width // s.parts)
        edges, found = _edges(n, s.leaf), {name: [] for name in numbers}
        for position in range(s.parts):
            order = _order(vectors[:, position], edges)
            points = vectors[order, position]
            for name, x in zip(numbers, (points, order, *_of_leaves(points, edges)), strict=True):
                found[name].append(np.ascontiguousarray(x, np.int64).tobytes())
        lists = [pa.ListArray.from_arrays([0, n], batch[c].combine_chunks()) for c in kinds]
        stacked = [pa.array([b"".join(found[name])], pa.binary()) for name in numbers]
        return pa.RecordBatch.from_arrays([*lists, *stacked], names=["vec_ids", "labels", *numbers])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, table]) if held is not None else table
            while len(held) >= s.block:
                yield built(held.slice(0, s.block))
                held = held.slice(s.block)
        if held is not None and len(held):
            yield built(held)

    lists = f"vec_ids array<{kinds['vec_id']}>, labels array<{kinds['label']}>, "
    built_rows = rows.select("vec_id", "label", "v").mapInArrow(build, lists + ", ".join(f"{name} binary" for name in numbers))
    return staged(built_rows, "vector-blocks")


def _trees(row: dict, position_width: int, s: Settings) -> Iterator[Tree]:
    """The tree of each position of a stored block."""
    read = lambda name: np.frombuffer(row[name], np.int64).reshape(s.parts, -1, position_width)
    points, leaves = read("points"), [read(name) for name in ("low", "high", "total")]
    edges = _edges(points.shape[1], s.leaf)
    for position in range(s.parts):
        yield _tree(points[position], edges, [x[position] for x in leaves])


# --- Rounds ---


def _moved(blocks: DataFrame, books: np.ndarray, s: Settings) -> np.ndarray:
    """The entries after one round: (positions, entries, components)."""
    positions, entries, width = books.shape
    sent = blocks.sparkSession.sparkContext.broadcast([_book(b) for b in books])
    sums = [f"s{k}" for k in range(width)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((positions, entries), np.int64), np.zeros((positions, entries, width), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                for position, tree in enumerate(_trees(row, width, s)):
                    codes, whole = assigned(tree, sent.value[position])
                    for start, end, index, node_sum in whole:
                        count[position, index] += end - start
                        total[position, index] += node_sum
                    compared = codes >= 0
                    count[position] += np.bincount(codes[compared], minlength=entries)
                    np.add.at(total[position], codes[compared], tree.points[compared])
        position, entry = np.nonzero(count)
        columns = [position, entry, count[position, entry], *total[position, entry].T]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c, np.int64)) for c in columns], names=["position", "entry", "n", *sums])

    partial = blocks.select("points", "low", "high", "total").mapInArrow(
        add, ", ".join(f"{c} bigint" for c in ("position", "entry", "n", *sums))
    )
    moved = books.copy()
    for r in partial.groupBy("position", "entry").agg(*[F.sum(c).alias(c) for c in ("n", *sums)]).collect():
        moved[r["position"], r["entry"]] = [r[c] // r["n"] for c in sums]
    return moved


def _coded(blocks: DataFrame, books: np.ndarray, kinds: dict[str, str], s: Settings) -> DataFrame:
    """(vec_id, label, code, error) of every vector."""
    width = books.shape[2]
    sent = blocks.sparkSession.sparkContext.broadcast([_book(b) for b in books])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, row in enumerate(batch.drop_columns(["vec_ids", "labels"]).to_pylist()):
                ids, labels = (batch[c][k].values for c in ("vec_ids", "labels"))
                orders = np.frombuffer(row["order"], np.int64).reshape(s.parts, -1)
                codes, error = np.empty((len(ids), s.parts), np.int64), np.zeros(len(ids), np.int64)
                for position, tree in enumerate(_trees(row, width, s)):
                    own, whole = assigned(tree, sent.value[position])
                    for start, end, index, _ in whole:
                        own[start:end] = index
                    away = tree.points - books[position][own]
                    codes[orders[position], position] = own
                    error[orders[position]] += np.einsum("ij,ij->i", away, away)
                text = ["".join(f"{c:02x}" for c in one) for one in codes.tolist()]
                columns = [ids, labels, pa.array(text, pa.string()), pa.array(error)]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    fields = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint"
    return blocks.mapInArrow(code, fields)


def compressed(
    vectors: DataFrame, s: Settings = Settings(), vec_id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) for every kept row, stored; and the codebooks (positions, entries, components)."""
    numbers = whole_numbers(F.col(vector), s.scale)
    kept = vectors.filter(complete(F.col(vector)))
    rows = staged(kept.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), numbers.alias("v")), "vectors")
    width = width_of(rows)
    if width % s.parts:
        raise ValueError(f"{width} components do not make {s.parts} equal parts")
    if not width:  # no rows, or vectors without components, which are all alike
        alike = rows.select("vec_id", "label", F.lit("00" * s.parts).alias("code"), F.lit(0).cast("bigint").alias("error"))
        return alike, np.zeros((s.parts, 0, 0), np.int64)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(s.entries).select("v").collect()
    books = np.array([r["v"] for r in first], np.int64).reshape(len(first), s.parts, -1).transpose(1, 0, 2)
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    blocks = _blocks(rows, width, s)
    for _ in range(s.rounds):
        books = _moved(blocks, books, s)
    return staged(_coded(blocks, books, kinds, s), "vector-codes"), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """Add the sum of the errors over all rows of the same label; nulls are one label."""
    totals = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(totals, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")


def digest(books: np.ndarray) -> str:
    """A name of the codebooks: all components by position, entry and place."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
