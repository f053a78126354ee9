"""Benchmark decontamination with suffix arrays of the training text.

Documents are searched in shards. A shard's words form one stream, and the suffixes of the stream are sorted by their
words; every suffix of every benchmark item is then looked up by binary search. The range of equal suffixes is narrowed
word by word, so a search ends at the longest verbatim match, and the range gives all its places. A suffix of the stream
can only be found if it starts with two neighbouring words (or the one word) of an item, so the others are not sorted.

* Words are runs of ASCII digits, letters and any characters beyond ASCII, A-Z lower-cased.
* A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one window. Document
  words inside any occurrence of a window are hit. Matches never cross documents.
* A missing text, and an empty one, has no words and no matches; an item without words is never found. Repeated rows and
  repeated items are judged each on its own. Items without an id take part, but are not listed. Extra columns are kept.
* Items are numbered into blocks of about ``block_words`` words (or one item). A block is sent to the tasks, searched in
  all shards, and its findings are stored before the next one is read, so neither a task nor the driver holds more than one;
  findings are put together by document. Its suffix order is small, that of a shard never leaves its task.
* Places are listed only where a match is as long as it gets: behind the last word that agrees, and, by the word before them,
  where it cannot begin earlier. So long runs of one word give as many rows as there are such matches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import fresh, numbered, slices, union
from ledgerlens.operators.ranked import running_totals
from ledgerlens.session import staged

WINDOW = 13

#: Every byte that cannot be in a word becomes a blank; A-Z become a-z.
_TO_WORDS = bytes(
    32 if i <= 0x2F or 0x3A <= i <= 0x40 or 0x5B <= i <= 0x60 or 0x7B <= i <= 0x7F else (i + 32 if 0x41 <= i <= 0x5A else i)
    for i in range(256)
)

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

MATCHES = "matches array<struct<item_id:long,item_start:int,doc_start:int,length:int>>"


@dataclass(frozen=True)
class Settings:
    window: int = WINDOW
    block_words: int = 2_000_000
    shard_words: int = 1_000_000
    #: Whether longest matches are listed, or only hit words and items.
    matches: bool = True


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_TO_WORDS).split() if text else []


class Block:
    """The suffixes of some items: words as numbers, and for each start the words that follow within the item."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int):
        texts = [(item, words) for item, text in items if (words := words_of(text))]
        self.codes: dict[bytes, int] = {}
        stream = [self.codes.setdefault(w, len(self.codes)) for _, words in texts for w in words]
        self.stream = np.array(stream, np.int64)
        sizes = np.array([len(words) for _, words in texts], np.int64)
        ends = np.cumsum(sizes)
        self.items = [item for item, _ in texts]
        self.item_of = np.repeat(np.arange(len(texts)), sizes)
        self.start = np.arange(len(stream)) - np.repeat(ends - sizes, sizes)
        self.left = np.repeat(ends, sizes) - np.arange(len(stream))
        #: How many words must match from here for a whole window; 0 where too few follow.
        self.needed = np.where(self.left >= window, window, np.where(self.start == 0, self.left, 0))
        n = len(self.codes)
        self.first = np.unique(self.stream[self.left > 1] * n + self.stream[np.flatnonzero(self.left > 1) + 1])
        self.alone = np.unique(self.stream[(self.left == 1) & (self.start == 0)])


class Shard:
    """The sorted suffixes of a run of documents that an item can start with."""

    def __init__(self, texts: list[str | None], block: Block):
        per_doc = [words_of(text) for text in texts]
        self.sizes = np.array([len(words) for words in per_doc], np.int64)
        self.ends = np.cumsum(self.sizes)
        n, get = len(block.codes), block.codes.get
        # Words unknown to the items, and the end of each document, compare unequal to every item word.
        self.stream = np.fromiter((get(w, n) for words in per_doc for w in words), np.int64, int(self.sizes.sum()))
        self.doc_of = np.repeat(np.arange(len(texts)), self.sizes)
        at = np.flatnonzero(self.stream < n)
        self.left = self.ends[self.doc_of[at]] - at
        follows = np.where(self.left > 1, self.stream[np.minimum(at + 1, max(0, len(self.stream) - 1))], n)
        starts = _isin(self.stream[at] * n + follows, block.first) & (follows < n)
        keep = starts | _isin(self.stream[at], block.alone)
        self.at, self.left = at[keep], self.left[keep]

    def word(self, at: np.ndarray, left: np.ndarray, depth: int, none: int) -> np.ndarray:
        """The word at a depth of suffixes; ``none`` beyond the end of the document."""
        inside = left > depth
        return np.where(inside, self.stream[np.where(inside, at + depth, 0)], none)

    def search(self, block: Block) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(depth, item suffixes that match so far, their first and last place in the order) for growing depths."""
        if not len(self.at) or not len(block.stream):
            return
        none = len(block.codes)
        at, left = self.at, self.left
        group = np.zeros(len(at), np.int64)  # suffixes that agree in the words so far have the same number
        query, query_group = np.arange(len(block.stream)), np.zeros(len(block.stream), np.int64)
        depth = 0
        while len(query):
            key = group * (none + 1) + self.word(at, left, depth, none)
            order = np.argsort(key, kind="stable")
            key, at, left = key[order], at[order], left[order]
            wanted = query_group * (none + 1) + block.stream[query + depth]
            low, high = np.searchsorted(key, wanted, "left"), np.searchsorted(key, wanted, "right")
            found = high > low
            query, low, high = query[found], low[found], high[found]
            depth += 1
            if not len(query):
                return
            yield depth, query, low, high, at
            # Only suffixes that some item still follows stay in the array, in order.
            more = block.left[query] > depth
            query, low, high = query[more], low[more], high[more]
            marks = np.zeros(len(key) + 1, np.int64)
            np.add.at(marks, low, 1)
            np.add.at(marks, high, -1)
            alive = np.cumsum(marks[:-1]) > 0
            fresh_key = np.concatenate([[True], key[1:] != key[:-1]])
            number = np.cumsum(fresh_key & alive) - 1
            query_group = number[low] if len(low) else low
            at, left, group = at[alive], left[alive], number[alive]


def _isin(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    place = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[place] == values


def _places(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges [low, high), and which range each is from."""
    sizes = high - low
    of = np.repeat(np.arange(len(low)), sizes)
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[of], of


def _before(stream: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The word before each place within its text, -1 at the beginning."""
    inside = (at > 0) & (owner[np.maximum(at - 1, 0)] == owner[at])
    return np.where(inside, stream[np.maximum(at - 1, 0)], -1)


def _ended(shard: Shard, block: Block, depth: int, query: np.ndarray, low: np.ndarray, high: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(item place, place, depth) of the matches that reach no further on either side.

    Ranges that several suffixes share are gone through once, in order of the word before and the word behind each place; a
    suffix then leaves out the places that agree with its own word there.
    """
    ranges, which = np.unique(np.stack([low, high]), axis=1, return_inverse=True)
    rows, of = _places(ranges[0], ranges[1])
    places = at[rows]
    none = len(block.codes)
    before = _before(shard.stream, shard.doc_of, places)
    left = shard.ends[shard.doc_of[places]] - places
    behind = np.where(left > depth, shard.stream[np.minimum(places + depth, len(shard.stream) - 1)], none)
    # Words beyond the items, and beginnings and ends, agree with nothing: they are told apart from the items' words.
    before = np.where(before == none, -1, before)
    order = np.lexsort((behind, before, of))
    places, before, behind, of = places[order], before[order], behind[order], of[order]
    edge = np.flatnonzero((np.diff(of, prepend=-1) != 0) | (np.diff(before, prepend=-2) != 0) | (np.diff(behind, prepend=-2) != 0))
    end = np.append(edge[1:], len(of))
    first, last = np.searchsorted(of[edge], np.arange(ranges.shape[1])), np.searchsorted(of[edge], np.arange(ranges.shape[1]), "right")
    which = which.reshape(-1)
    group, asker = _places(first[which], last[which])  # groups of places with the same words around, for each suffix
    own_before = _before(block.stream, block.item_of, query)[asker]
    own_behind = np.where(block.left[query] > depth, block.stream[np.minimum(query + depth, len(block.stream) - 1)], -1)[asker]
    apart = ((before[edge[group]] < 0) | (before[edge[group]] != own_before)) & (behind[edge[group]] != own_behind)
    group, asker = group[apart], asker[apart]
    rows, of_group = _places(edge[group], end[group])
    return np.stack([query[asker][of_group], places[rows], np.full(len(rows), depth)])


def _search(texts: list[str | None], block: Block, s: Settings) -> list[tuple[int, list[int], list[int], list[dict]]]:
    """For each text: its number of words, the words that are hit, the items with a window there, and the longest matches."""
    shard = Shard(texts, block)
    marks = np.zeros(len(shard.stream) + 1, np.int64)
    longest: list[np.ndarray] = []
    pairs: list[np.ndarray] = []
    for depth, query, low, high, at in shard.search(block):
        whole = block.needed[query] == depth
        if whole.any():
            ranges, which = np.unique(np.stack([low[whole], high[whole]]), axis=1, return_inverse=True)
            rows, of = _places(ranges[0], ranges[1])
            np.add.at(marks, at[rows], 1)
            np.add.at(marks, at[rows] + depth, -1)
            # Each range's documents, for each item that asks for the range.
            docs = np.unique(np.stack([of, shard.doc_of[at[rows]]]), axis=1)
            asked = np.unique(np.stack([which.reshape(-1), block.item_of[query[whole]]]), axis=1)
            first, last = np.searchsorted(docs[0], asked[0]), np.searchsorted(docs[0], asked[0], "right")
            rows, of = _places(first, last)
            pairs.append(np.stack([docs[1][rows], asked[1][of]]))
        if s.matches:
            long = (block.needed[query] > 0) & (depth >= block.needed[query])
            if long.any():
                longest.append(_ended(shard, block, depth, query[long], low[long], high[long], at))
    hit = np.cumsum(marks[:-1]) > 0
    items: list[list[int]] = [[] for _ in texts]
    for doc, item in (np.unique(np.concatenate(pairs, axis=1), axis=1).T.tolist() if pairs else []):
        items[doc].append(block.items[item])
    found: list[list[dict]] = [[] for _ in texts]
    begins = shard.ends - shard.sizes
    for item, place, length in (np.concatenate(longest, axis=1).T.tolist() if longest else []):
        doc = int(shard.doc_of[place])
        found[doc].append({
            "item_id": block.items[block.item_of[item]], "item_start": int(block.start[item]),
            "doc_start": int(place - begins[doc]), "length": length,
        })
    return [
        (int(size), (np.flatnonzero(hit[b:e])).tolist(), [i for i in own if i is not None], matches)
        for size, b, e, own, matches in zip(shard.sizes, begins, shard.ends, items, found, strict=True)
    ]


def _blocked(benchmark: DataFrame, item_id: str, text: str, s: Settings) -> tuple[DataFrame, int]:
    """(item_id, text, block), stored, and the number of blocks."""
    rows = numbered(
        benchmark.select(
            F.col(item_id).cast("bigint").alias("item_id"), F.col(text).alias("text"),
            F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).alias("words"),
        ),
        "items",
    )
    upto = running_totals(rows, [F.col("uid")], {"upto": "words"})
    block = F.floor(F.greatest(F.col("upto") - 1, F.lit(0)) / s.block_words).cast("int")
    items = staged(upto.select("item_id", "text", block.alias("block")), "item-blocks")
    return items, (items.agg(F.max("block")).first()[0] or 0) + 1


def matched(
    docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), text: str = "text",
    item_id: str = "item_id", item_text: str = "text", name: str = "contamination",
) -> DataFrame:
    """The documents with a struct column: n_words, n_hit, items (ids in order, each once) and the longest matches."""
    items, n = _blocked(benchmark, item_id, item_text, settings)
    part = lambda k: _searcher(docs.sparkSession, [tuple(r) for r in items.filter(F.col("block") == k).select("item_id", "text").collect()], settings)
    found, key = fresh(docs, "_found"), fresh(docs, "_uid")
    if n == 1:
        searched = docs.withColumn(found, part(0)(F.col(text)))
        return searched.select(*docs.columns, _summary(F.col(found), F.array(found)).alias(name))
    rows = numbered(docs, "documents", uid=key)
    passes = union([staged(rows.select(key, part(k)(F.col(text)).alias(found)), "found") for k in range(n)])
    put = passes.groupBy(key).agg(F.collect_list(found).alias(found))  # a row for each block
    both = rows.join(put, key)
    return both.select(*docs.columns, _summary(F.get(found, F.lit(0)), F.col(found)).alias(name))


def _summary(one: Column, parts: Column) -> Column:
    flat = lambda field: F.flatten(F.transform(parts, lambda p: p[field]))
    return F.struct(
        one["n_words"].alias("n_words"), F.size(F.array_distinct(flat("hits"))).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(flat("items"))).alias("items"), flat("matches").alias("matches"),
    )


def _searcher(spark, items: list[tuple], settings: Settings):
    sent = spark.sparkContext.broadcast(items)
    loaded: list[Block] = []

    @F.pandas_udf(f"n_words long, hits array<int>, items array<long>, {MATCHES}")
    def search(texts: pd.Series) -> pd.DataFrame:
        if not loaded:
            loaded.append(Block(sent.value, settings.window))
        rows = []
        frame = texts.to_frame("t")
        for run in slices(frame, frame["t"].str.len().fillna(0).to_numpy(), 6 * settings.shard_words):
            rows += _search(run["t"].tolist(), loaded[0], settings)
        return pd.DataFrame(rows, columns=["n_words", "hits", "items", "matches"])

    return search


def is_contaminated(result: Column) -> Column:
    """Hit, and at least a twentieth of its words."""
    return (result.n_hit > 0) & (20 * result.n_hit >= result.n_words)


def decontaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents that are not contaminated."""
    name = fresh(docs, "_contamination")
    found = matched(docs, benchmark, replace(settings, matches=False), name=name)
    return found.filter(~is_contaminated(F.col(name))).select(*docs.columns)
