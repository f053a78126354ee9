"""Near-duplicate groups by a chosen-path set similarity join.

A text is the set of its word shingles, and two texts are linked where their sets have at least ``percent`` hundredths of
their union in common. Equal sets are joined first; what follows sees one row for each different set.

Every set gets a sketch of minwise tokens. A tree branches the sets by the tokens at a few of the sketch's positions,
chosen by the path that led there, 1/similarity of them on average, so that a path splits what is unlike and linked sets
meet in some node; ``trees`` independent trees of two branches at the root bring the recall to its target. Nodes of at most
``leaf`` sets are compared exhaustively. Sketches only propose groups of sets that may be linked; within a group every pair
is compared on the full sets, and one pair less than there are connected sets goes on, however many links there are.

Sets known to be connected need no further comparison with each other. A larger node first compares its sets with one of
them. If all but ``few`` then belong to one connected group, it ends by comparing those with every set of the node; only
other nodes branch on. What has not come apart after ``levels`` levels is compared exhaustively in blocks, so no candidate
is ever dropped for the size of its node.

Whole sets are compared in the end, so groups are proposed by the lowest byte of each token: tokens that differ agree there
once in 256, which proposes a little more and never less. Branches go by whole tokens.

* Words are runs without the six ASCII blanks, A-Z lower-cased. A text of fewer words than a shingle is one shingle of
  all its words; a missing text, and one without words, has the empty set and is linked with nothing.
* The group's id is the smallest id reachable; a row without an id counts last, and among rows of one id the smallest
  hash of the text stands for the group. Repeated rows are equal and are both kept or both not.
* An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import codes_of, lower_words_of, numbered, slices
from ledgerlens.session import bucketed, staged

PAIRS = "array<struct<a:bigint,b:bigint>>"


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    percent: int = 80
    positions: int = 128
    trees: int = 6
    leaf: int = 64
    #: A larger node ends once at most so many of its sets are outside its largest connected group.
    few: int = 1024
    #: Sets, and about how many of their shingles, that are compared with each other in one unit.
    block: int = 512
    block_shingles: int = 1_000_000
    levels: int = 24
    #: Sketches propose a pair down to so far below the threshold: four standard errors of an estimate.
    slack: float = 0.13
    batch_chars: int = 1_000_000
    seed: int = 41


# --- Sets and sketches ---


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (multiply and shift, three times)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of all texts, text after text in order, and how many each has."""
    per_text = [lower_words_of(text) for text in texts]
    sizes = np.array([len(words) for words in per_text], np.int64)
    codes, distinct = codes_of([w for words in per_text for w in words])
    hashed = np.array([xxhash.xxh3_64_intdigest(w) for w in distinct], np.uint64)
    words, ends = (hashed[codes] if len(codes) else np.zeros(0, np.uint64)), np.cumsum(sizes)
    text_of = np.repeat(np.arange(len(texts)), sizes)
    at = np.arange(len(words))
    length = np.minimum(k, sizes)[text_of]
    at = at[at + length <= ends[text_of]]
    h = length[at].astype(np.uint64)
    for i in range(k):
        inside = length[at] > i
        nxt = words[np.where(inside, at + i, 0)] if len(words) else words
        h = np.where(inside, _mixed(h * np.uint64(0x9E3779B97F4A7C15) + nxt), h)
    of = text_of[at]
    order = np.lexsort((h, of))
    h, of = h[order], of[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
    return h[first], np.bincount(of[first], minlength=len(texts))


def _sketches(texts: list[str | None], s: Settings) -> list[tuple]:
    """(size of the set, a name of the set, the lowest byte of each minwise token, their other bytes) for each text."""
    h, sizes = shingle_sets(texts, s.shingle)
    full = np.flatnonzero(sizes)
    if not len(full):
        return [(0, None, None, None)] * len(texts)
    starts = (np.cumsum(sizes) - sizes)[full]
    numbers = np.random.default_rng(s.seed).integers(1, 1 << 63, (2, s.positions), np.uint64)
    tokens = np.empty((len(full), s.positions), np.uint32)
    for i, (a, b) in enumerate(zip(numbers[0] | np.uint64(1), numbers[1], strict=True)):
        tokens[:, i] = np.minimum.reduceat((h ^ b) * a, starts) >> np.uint64(32)
    name = [np.add.reduceat(_mixed(h ^ np.uint64(c)), starts).tolist() for c in (0x5851F42D4C957F2D, 0x2545F4914F6CDD1D)]
    rows: list[tuple] = [(0, None, None, None)] * len(texts)
    for i, text in enumerate(full.tolist()):
        own = tokens[i].astype("<u4").view(np.uint8).reshape(-1, 4)
        rows[text] = (int(sizes[text]), f"{name[0][i]:016x}{name[1][i]:016x}", own[:, 0].tobytes(), own[:, 1:].tobytes())
    return rows


def _sketcher(s: Settings):
    @F.pandas_udf("n_shingles bigint, set string, sketch binary, branch binary")
    def sketch(texts: pd.Series) -> pd.DataFrame:
        frame, rows = texts.to_frame("t"), []
        for run in slices(frame, frame["t"].str.len().fillna(0).to_numpy(), s.batch_chars):
            rows += _sketches(run["t"].tolist(), s)
        return pd.DataFrame(rows, columns=["n_shingles", "set", "sketch", "branch"])

    return sketch


def _full_sets(s: Settings):
    @F.pandas_udf("array<bigint>")
    def full_set(texts: pd.Series) -> pd.Series:
        frame, sets = texts.to_frame("t"), []
        for run in slices(frame, frame["t"].str.len().fillna(0).to_numpy(), s.batch_chars):
            h, sizes = shingle_sets(run["t"].tolist(), s.shingle)
            sets += np.split(h.view(np.int64), np.cumsum(sizes)[:-1])
        return pd.Series(sets, dtype=object)

    return full_set


# --- Comparing the sets of a unit ---


def components(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers that pairs connect, in order, and for each the place of the smallest one it is connected with."""
    names, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b, label = at[: len(u)], at[len(u) :], np.arange(len(names))
    while True:
        least, low = label.copy(), np.minimum(label[a], label[b])
        np.minimum.at(least, a, low)
        np.minimum.at(least, b, low)
        least = least[least]
        if (least == label).all():
            return names, label
        label = least


def _grouper(s: Settings):
    least = int((s.percent / 100 - s.slack) * s.positions)

    @F.pandas_udf("array<array<bigint>>")
    def group(
        ids: pd.Series, roots: pd.Series, sketches: pd.Series, few: pd.Series, few_roots: pd.Series, few_sketches: pd.Series
    ) -> pd.Series:
        """The sets of a unit, grouped by sketches that agree often enough, of sets that are not known to be connected."""
        found = []
        for a, ra, x, b, rb, y in zip(ids, roots, sketches, few, few_roots, few_sketches, strict=True):
            a, ra, b, rb = map(np.asarray, (a, ra, b, rb))
            left = np.frombuffer(b"".join(x), np.uint8).reshape(len(a), -1)
            right = np.frombuffer(b"".join(y), np.uint8).reshape(len(b), -1)
            alike = np.zeros((len(a), len(b)), np.int16)
            for k in range(s.positions):
                alike += left[:, k, None] == right[None, :, k]
            i, j = np.nonzero((alike >= least) & (ra[:, None] != rb[None, :]))
            names, label = components(a[i], b[j])
            order = np.argsort(label, kind="stable")
            found.append(np.split(names[order], np.flatnonzero(np.diff(label[order])) + 1) if len(names) else [])
        return pd.Series(found, dtype=object)

    return group


def linked_pairs(sets: list[np.ndarray], percent: int, columns: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of sets that are similar enough, from exact counts of what they share."""
    sizes = np.array([len(x) for x in sets], np.int64)
    of = np.repeat(np.arange(len(sets)), sizes)
    _, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times[token] > 1)
    column = (np.cumsum(times > 1) - 1)[token[shared]]
    order = np.argsort(column, kind="stable")
    column, of = column[order], of[shared[order]]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        run = slice(*np.searchsorted(column, [start, start + columns]))
        has = np.zeros((len(sets), columns), np.float32)
        has[of[run], column[run] - start] = 1
        common += has @ has.T
    common = common.astype(np.int64)
    return np.nonzero(np.triu(100 * common >= percent * (sizes[:, None] + sizes[None, :] - common), 1))


def _linker(s: Settings):
    @F.pandas_udf(PAIRS)
    def link(ids: pd.Series, sets: pd.Series) -> pd.Series:
        """Every set of a group that has a link there, with the smallest one it is connected with: one pair less than sets."""
        found = []
        for own, hashes in zip(ids, sets, strict=True):
            own = np.asarray(own)
            names, label = components(*linked_pairs([np.asarray(h) for h in hashes], s.percent))
            pairs = zip(own[names].tolist(), own[names[label]].tolist(), strict=True)
            found.append([{"a": a, "b": b} for a, b in pairs if a != b])
        return pd.Series(found, dtype=object)

    return link


def _listed(rows: DataFrame, *by: str, names: tuple[str, str, str] = ("ids", "roots", "sketches")) -> DataFrame:
    """The members of each unit as three lists."""
    lists = zip(("uid", "root", "sketch"), names, strict=True)
    return rows.groupBy(*by).agg(*[F.collect_list(c).alias(name) for c, name in lists])


def _with_roots(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return rows.withColumn("root", F.col("uid"))
    return rows.join(roots, "uid", "left").withColumn("root", F.coalesce("root", "uid"))


def _leaf_groups(leaves: DataFrame, sketches: DataFrame, roots: DataFrame | None, s: Settings) -> DataFrame:
    """Alike sets of each small node; nodes of the same sets are compared once."""
    members = leaves.groupBy("node").agg(F.sort_array(F.collect_list("uid")).alias("ids")).select("ids").distinct()
    one = members.select(F.xxhash64("ids").alias("group"), F.explode("ids").alias("uid")).join(sketches, "uid")
    units = _listed(_with_roots(one, roots), "group").filter(F.size(F.array_distinct("roots")) > 1)
    three = ("ids", "roots", "sketches")
    return units.select(F.explode(_grouper(s)(*three, *three)).alias("ids"))


def _node_groups(members: DataFrame, few: DataFrame, sketches: DataFrame, s: Settings) -> DataFrame:
    """Each of a node's few (node, part, uid, root) against all its sets, in blocks of bounded size."""
    block = F.pmod(F.xxhash64("uid"), _blocks(F.col("n"), F.col("total"), s))
    blocks = _listed(members.withColumn("block", block).join(sketches, "uid"), "node", "block")
    names = ("few", "few_roots", "few_sketches")
    units = blocks.join(_listed(few.join(sketches, "uid"), "node", "part", names=names), "node")
    return units.select(F.explode(_grouper(s)("ids", "roots", "sketches", *names)).alias("ids"))


def _blocks(n: Column, total: Column, s: Settings) -> Column:
    """How many blocks sets are dealt to, by their number and the number of their shingles."""
    return F.ceil(F.greatest(n / s.block, total / s.block_shingles))


def _links(groups: DataFrame, full: DataFrame, s: Settings) -> DataFrame:
    """(a, b): pairs that links connect, from the full sets of each group."""
    members = groups.select(F.xxhash64("ids").alias("group"), F.explode("ids").alias("uid")).join(full, "uid")
    units = members.groupBy("group").agg(F.collect_list(F.struct("uid", "hashes")).alias("sets"))
    return units.select(F.explode(_linker(s)("sets.uid", "sets.hashes")).alias("p")).select("p.a", "p.b")


# --- Connected groups ---


#: Rows of the graph that a task takes at least; smaller tables need no shuffle.
GRAPH_ROWS = 100_000


def connected(links: DataFrame) -> DataFrame:
    """(uid, root) for every linked number, the root being the smallest reachable: large and small stars in turn.

    Every round writes its table, so lineage does not grow; only two counts come to the driver.
    """
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        entangled, n = _entangled(edges)
        edges = edges.coalesce(-(-n // GRAPH_ROWS) or 1)
        if not entangled:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        both = both.coalesce(-(-n // GRAPH_ROWS))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # Larger neighbours move to the smallest number around.
        moved = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Smaller neighbours, and the number itself, move to the smallest of them.
        low = moved.groupBy("u").agg(F.min("v").alias("m"))
        edges = moved.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = staged(edges.filter("u > v").distinct(), "links")
    roots = edges.select(F.col("u").alias("uid"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("uid"), "root")).distinct()


def _entangled(edges: DataFrame) -> tuple[int, int]:
    """How many numbers have more than one smaller neighbour, or one and are one themselves; and how many edges there are."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("root")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("root"))
    )
    per = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("root").alias("root"))
    row = per.agg(F.count_if(F.col("up") + F.col("root") > 1), F.coalesce(F.sum("up"), F.lit(0))).first()
    return row[0], row[1]


def _rooted(pairs: DataFrame, roots: DataFrame | None) -> DataFrame:
    """(a, b, root_a, root_b) of the pairs that are not known to be connected."""
    if roots is None:
        return pairs.select("a", "b", F.col("a").alias("root_a"), F.col("b").alias("root_b"))
    side = lambda c: roots.select(F.col("uid").alias(c), F.col("root").alias(f"root_{c}"))
    both = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    return both.select(
        "a", "b", F.coalesce("root_a", "a").alias("root_a"), F.coalesce("root_b", "b").alias("root_b")
    ).filter("root_a <> root_b")


def _extended(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """The roots after more links: only the roots that the links connect are looked at again."""
    if roots is None:
        return staged(connected(links), "roots")
    fresh = staged(_rooted(links, roots).distinct(), "new-links")
    if fresh.isEmpty():
        return roots
    top = connected(fresh.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
    moved = top.select(F.col("uid").alias("root"), F.col("root").alias("new"))
    known = roots.join(moved, "root", "left").select("uid", F.coalesce("new", "root").alias("root"))
    added = top.join(roots.select("uid"), "uid", "left_anti")
    return staged(known.unionByName(added), "roots")


# --- The join ---


def _branches(positions: list[Column], path: list[Column]) -> Column:
    """The nodes that a set goes to: the path, a position, and the whole token there."""
    at = lambda p: F.concat(F.substring("sketch", p + 1, F.lit(1)), F.substring("branch", p * 3 + 1, F.lit(3)))
    return F.array(*[F.xxhash64(*path, p, at(p)) for p in positions])


def _roots(sketches: DataFrame, s: Settings) -> DataFrame:
    chosen = np.random.default_rng(s.seed + 1).permutation(s.positions)
    nodes = [
        _branches([F.lit(int(chosen[(2 * t + i) % s.positions])) for i in range(2)], [F.lit(t)]) for t in range(s.trees)
    ]
    return sketches.select("uid", "size", F.explode(F.concat(*nodes)).alias("node"))


def _next_nodes(large: DataFrame, s: Settings) -> DataFrame:
    """One branch for each set of a node, and a second in as many nodes as the similarity asks for."""
    draw = lambda i: F.xxhash64("node", F.lit(s.seed + i))
    positions = [F.pmod(draw(i), F.lit(s.positions)).cast("int") for i in range(2)]
    both = _branches(positions, [F.col("node")])
    second = F.pmod(draw(2), F.lit(1000)) < int(1000 * (100 / s.percent - 1))
    return large.select("uid", "size", F.explode(F.array_distinct(F.when(second, both).otherwise(F.slice(both, 1, 1)))).alias("node"))


def _populated(frontier: DataFrame, level: int) -> DataFrame:
    """The rows of nodes that more than one set is in, with the node's sets, their shingles, and one of the sets."""
    sizes = frontier.groupBy("node").agg(
        F.count("*").alias("n"), F.sum("size").alias("total"), F.min("uid" if level == 0 else F.struct(F.xxhash64("uid", "node"), "uid")).alias("pivot")
    ).filter("n > 1")
    pivot = "pivot" if level == 0 else "pivot.uid"
    return staged(frontier.join(sizes, "node").select("node", "uid", "size", "n", "total", F.col(pivot).alias("pivot")), "nodes")


def grouped(docs: DataFrame, s: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, key, n_shingles, component_id, kept) for each row; ``key`` tells rows of one id apart by their text."""
    rows = staged(
        docs.select(F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("key"), _sketcher(s)(F.col(text)).alias("x"))
        .select("doc_id", "key", "x.*"),
        "sketches",
    )
    rank = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "key")
    full = rows.filter("n_shingles > 0")
    sets = numbered(
        full.groupBy("set").agg(F.min(rank).alias("first"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"), F.first("branch").alias("branch")),
        "sets",
    )
    roots = _joined(docs, sets, s, doc_id, text).join(sets.select("uid", "set", "first"), "uid")
    smallest = roots.groupBy("root").agg(F.min("first").alias("smallest"))
    linked = roots.join(smallest, "root").select("set", "smallest")
    own = sets.select("set", "first").join(linked, "set", "left")
    classes = own.select(F.col("set").alias("_set"), F.coalesce("smallest", "first").alias("best"))
    out = rows.drop("sketch", "branch").join(classes, F.col("set") == F.col("_set"), "left")
    is_first = F.col("n_shingles").eqNullSafe(0) | (F.col("key") == F.col("best.key"))
    component = F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id"))
    return out.select("doc_id", "key", "n_shingles", component.alias("component_id"), is_first.alias("kept"))


def row_key(doc_id: str, text: str) -> Column:
    return F.md5(F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))))


def _joined(docs: DataFrame, sets: DataFrame, s: Settings, doc_id: str, text: str) -> DataFrame:
    """(uid, root) of all sets with a link, the root naming the connected group."""
    sketches = sets.select("uid", "sketch")
    roots, full = None, None
    frontier = _roots(sets.select("uid", "sketch", "branch", F.col("n").alias("size")), s)
    for level in range(s.levels + 1):
        nodes = _populated(frontier, level)
        small = (F.col("n") <= s.leaf) & (F.col("total") <= s.block_shingles)
        leaves, large = nodes.filter(small), nodes.filter(~small)
        rooted = _with_roots(large, roots)
        pivots = rooted.filter(F.col("uid") == F.col("pivot")).withColumn("part", F.lit(0))
        stars = _node_groups(rooted, pivots, sketches, s)
        groups = staged(_leaf_groups(leaves, sketches, roots, s).unionByName(stars).distinct(), "groups")
        if full is None:
            # Whatever a later group holds is in a first group, or in a large node.
            wanted = nodes.filter(~small).select("uid").unionByName(groups.select(F.explode("ids").alias("uid"))).distinct()
            full = _stored_sets(docs, sets.join(wanted, "uid"), s, doc_id, text)
        roots = _extended(roots, _links(groups, full, s))
        # Stored, as three readers would each join the roots again; without sketches, which only nodes with a few need.
        labelled = staged(_with_roots(large, roots).select("node", "uid", "size", "n", "total", "root"), "labelled")
        few, rest = _unconnected(labelled, s, last=level == s.levels)
        inside = labelled.join(few.select("node").distinct(), "node", "left_semi")
        groups = staged(_node_groups(inside, few, sketches, s).distinct(), "groups")
        roots = _extended(roots, _links(groups, full, s))
        if rest is None or rest.isEmpty():
            return roots
        frontier = staged(_next_nodes(large.join(rest.distinct(), "node", "left_semi").join(sets.select("uid", "sketch", "branch"), "uid"), s), "frontier")


def _stored_sets(docs: DataFrame, wanted: DataFrame, s: Settings, doc_id: str, text: str) -> DataFrame:
    """(uid, n, hashes): the full sets of the wanted numbers, from the text that stands for each.

    Every level joins groups with them, so they are dealt by their number once, as texts, which are shorter.
    """
    keyed = docs.select(row_key(doc_id, text).alias("key"), F.col(text).alias("text"))
    found = wanted.select("uid", "n", F.col("first.key").alias("key")).join(keyed, "key").dropDuplicates(["key"])
    return bucketed(found.select("uid", "n", "text"), "full-sets", "uid", then=lambda dealt: dealt.withColumn("hashes", _full_sets(s)("text")).drop("text"))


def _unconnected(labelled: DataFrame, s: Settings, last: bool) -> tuple[DataFrame, DataFrame | None]:
    """The sets of a node outside its largest connected group: those of nodes with few of them, and the nodes with more."""
    sizes = labelled.groupBy("node", "root").agg(F.count("*").alias("n"), F.sum("size").alias("total"))
    largest = sizes.groupBy("node").agg(
        F.max_by("root", F.struct("n", "root")).alias("main"), (F.sum("n") - F.max("n")).alias("outside"),
        (F.sum("total") - F.max_by("total", F.struct("n", "root"))).alias("outside_total"),
    ).filter("outside > 0")
    outside = staged(
        labelled.drop("n", "total", "size").join(largest, "node").filter("root <> main")
        .select("node", "uid", "root", "outside", "outside_total"), "outside",
    )
    some = outside if last else outside.filter(F.col("outside") <= s.few)
    part = F.pmod(F.xxhash64("uid"), _blocks(F.col("outside"), F.col("outside_total"), s))
    rest = None if last else outside.filter(F.col("outside") > s.few).select("node")
    return some.select("node", part.alias("part"), "uid", "root"), rest
