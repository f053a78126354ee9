"""Language-model scores from a probabilistic suffix tree over words.

Symbols are the words of a text and one end. A node of the tree is a context of one to ``depth`` words with a distribution
of the next symbol. A context is a candidate if it occurs twice, in a corpus of any size, and is retained if its
distribution diverges from that of its longest retained suffix by a likelihood-ratio test. A text is scored symbol by
symbol in the state of the longest retained context.

* Smoothing: a counted next symbol has (n + k P(symbol | parent)) / (n(context) + k); the others share what is left in
  proportion to the parent's distribution, down to the smoothed counts of single symbols. Every distribution adds up to 1.
* Counts cover all training texts. A context's next symbols are counted one by one where the pair occurs twice, and as one
  class otherwise. So what is learned from a passage does not depend on how much else there is.
* Neither words nor contexts are gathered anywhere. Texts are kept in chunks, whose vocabularies are joined with the counted
  symbols. A place needs the contexts that end before it, and all of them end in the same word: places are dealt by that
  word, so that a group has the whole subtree of its words, learns it and scores its places with it, training or not.
* Where a context has more than ``largest_group`` places, its next symbols are counted with partial sums in each chunk and
  joined back, and its places are dealt by the context one word longer. There are at most depth times (training words /
  ``largest_group``) such contexts; they and how many symbols occur how often are all that the driver sees.
* Scores are added up as whole multiples of 2**-32, so no order of the sums shows.
* Words are runs without the six ASCII blanks, A-Z lower-cased. A missing text counts as empty: it has the end only.
  Without training texts every symbol is unknown and has the smoothed share of one unseen symbol. Repeated rows get equal
  scores. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerlens.llm.common import lower_words_of, numbered, slices, union
from ledgerlens.session import staged, unstaged

#: No word holds a blank, so these keys are free.
END = b" end"
LONG = 48


@dataclass(frozen=True)
class Settings:
    depth: int = 3
    #: How often a context, and a next symbol that is counted, must occur.
    least_context: int = 2
    least_entry: int = 2
    #: Shares of the training words that they must make up besides; with these the tree is bounded, but not whole.
    context_share: float = 0.0
    entry_share: float = 0.0
    #: A context is kept if its occurrences times its divergence in nats reach this.
    least_gain: float = 12.0
    smoothing: float = 8.0
    #: What an unseen symbol counts.
    prior: float = 0.1
    #: Bounds what a task holds at a time: distinct symbols or keys counted so far, and codes in arrays.
    held_keys: int = 400_000
    run_codes: int = 400_000
    #: Symbols of a chunk of texts, and places that are learned from and scored at a time. They change no result.
    chunk_codes: int = 1_000_000
    largest_group: int = 1_000_000


def _symbols(text: str | None) -> list[bytes]:
    """Words, long ones by their digest, and the end."""
    words = [w if len(w) <= LONG else b" " + hashlib.md5(w).hexdigest().encode() for w in lower_words_of(text)]
    words.append(END)
    return words


# --- Counts of single symbols ---


def _counted(settings: Settings):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[bytes, int] = {}
        for batch in batches:
            for text in batch["text"]:
                for symbol in _symbols(text):
                    seen[symbol] = seen.get(symbol, 0) + 1
                if len(seen) >= settings.held_keys:
                    yield pd.DataFrame({"symbol": list(seen), "n": list(seen.values())})
                    seen = {}
        yield pd.DataFrame({"symbol": list(seen), "n": np.array(list(seen.values()), np.int64)})

    return count


def symbol_counts(texts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(symbol, n) over all rows of a column ``text``; partial sums are formed before the shuffle."""
    partial = texts.select("text").mapInPandas(_counted(settings), "symbol binary, n bigint")
    return partial.groupBy("symbol").agg(F.sum("n").alias("n"))


# --- The tree in one place: for looking at the tree of a corpus that fits the driver; ``scored`` does without ---


def _coder(numbers):
    coded = "codes array<int>, rare array<struct<symbol:binary,n:bigint>>"

    @F.pandas_udf(coded)
    def code(texts: pd.Series) -> pd.DataFrame:
        get = numbers.value.get
        rows = []
        for text in texts:
            symbols = _symbols(text)
            codes = np.fromiter((get(s, -1) for s in symbols), np.int32, len(symbols))
            rare: dict[bytes, int] = {}
            for i in np.flatnonzero(codes < 0).tolist():
                rare[symbols[i]] = rare.get(symbols[i], 0) + 1
            rows.append((codes, [{"symbol": s, "n": n} for s, n in rare.items()]))
        return pd.DataFrame(rows, columns=["codes", "rare"])

    return code


# --- The tree, as arrays ---
# words: how many symbols have a number; log_root: their log10 share. Contexts are numbered through all depths.
# step: sorted keys (context * words + symbol) that lead to the context one word longer, from context -1 at depth 1, and
# step_to. parent: the longest retained proper suffix, -1 the root; retained; log_rest. entry: sorted keys, and entry_log.


def _empty_tree(log_root: np.ndarray) -> dict[str, np.ndarray]:
    whole, real = np.zeros(0, np.int64), np.zeros(0)
    return {
        "log_root": log_root, "depth_end": whole, "step": whole, "step_to": whole, "parent": whole,
        "retained": np.zeros(0, bool), "log_rest": real, "entry": whole, "entry_log": real,
    }


def _find(ordered: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where keys are in a sorted array, and whether they are."""
    if not len(ordered):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(ordered, keys), len(ordered) - 1)
    return at, ordered[at] == keys


def _key(tree: dict, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    return (context + 1) * len(tree["log_root"]) + symbol


def _stepped(tree: dict, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """The context one word longer, or -1 where there is none."""
    at, found = _find(tree["step"], _key(tree, context, symbol))
    return np.where(found & (symbol >= 0), tree["step_to"][at] if len(tree["step_to"]) else -1, -1)


def _contexts(tree: dict, codes: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """For each depth, the context that ends just before each place; ``first`` marks the first symbol of a text."""
    found = []
    ending = np.full(len(codes), -1, np.int64)  # of the depth so far, ending at the place itself
    for depth in range(len(tree["depth_end"])):
        if depth == 0:
            ending = _stepped(tree, ending, codes)
        else:
            before = np.concatenate([[-1], ending[:-1]])
            ending = np.where((before >= 0) & ~first, _stepped(tree, before, codes), -1)
        found.append(np.where(first, -1, np.concatenate([[-1], ending[:-1]])))
    return found


def _log_probability(tree: dict, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """log10 of the symbols after contexts; for symbols without a number, of the class they are in within the root."""
    total, state = np.zeros(len(symbol)), context.copy()
    open_ = np.flatnonzero(state >= 0)
    done = np.zeros(len(symbol), bool)
    while len(open_):
        at, found = _find(tree["entry"], _key(tree, state[open_], symbol[open_]))
        found &= symbol[open_] >= 0
        total[open_[found]] += tree["entry_log"][at[found]] if found.any() else 0.0
        done[open_[found]] = True
        open_ = open_[~found]
        total[open_] += tree["log_rest"][state[open_]]
        state[open_] = tree["parent"][state[open_]]
        open_ = open_[state[open_] >= 0]
    rest = ~done & (symbol >= 0)
    total[rest] += tree["log_root"][symbol[rest]]
    return total


def _state(tree: dict, contexts: list[np.ndarray], n: int) -> np.ndarray:
    """The longest retained context."""
    state = np.full(n, -1, np.int64)
    for found in contexts:
        state = np.where(found >= 0, found, state)
    some = np.flatnonzero(state >= 0)
    skip = some[~tree["retained"][state[some]]]
    state[skip] = tree["parent"][state[skip]]
    return state


def _deeper(tree: dict, counts: np.ndarray, n: np.ndarray, totals: np.ndarray, first_new: int, s: Settings) -> None:
    """Judge the newest contexts by the counts n of (context, symbol) keys; add their distributions to the tree."""
    width = len(tree["log_root"])
    context, symbol = counts // width - 1, counts % width
    local = context - first_new
    log_parent = _log_probability(tree, tree["parent"][context], symbol)
    parent = 10.0 ** log_parent
    own = (n + s.smoothing * parent) / (totals[local] + s.smoothing)
    size = len(totals)
    spread = lambda values: np.bincount(local, values, size)
    left = np.clip(1 - spread(own), 1e-12, 1)
    parent_left = np.clip(1 - spread(parent), 1e-12, 1)
    divergence = spread(own * np.log(own / parent)) + left * np.log(left / parent_left)
    tree["retained"] = np.concatenate([tree["retained"], totals * divergence >= s.least_gain])
    tree["log_rest"] = np.concatenate([tree["log_rest"], np.log10(left / parent_left)])
    keep = tree["retained"][context]
    entry = np.concatenate([tree["entry"], counts[keep]])
    log = np.concatenate([tree["entry_log"], np.log10(own[keep])])
    order = np.argsort(entry)
    tree["entry"], tree["entry_log"] = entry[order], log[order]


def _extended(tree: dict, contexts: np.ndarray, symbols: np.ndarray) -> dict[str, np.ndarray]:
    """The tree with candidates: each a context and the word after it. Their suffixes are candidates already."""
    first_new = len(tree["parent"])
    new = first_new + np.arange(len(contexts))
    suffix = np.full(len(contexts), -1, np.int64)
    longer = contexts >= 0
    if longer.any():
        # One word shorter in front: the suffix of the context, followed by the same word.
        suffix[longer] = _stepped(tree, tree["suffix"][contexts[longer]], symbols[longer])
    parent = suffix.copy()
    known = np.flatnonzero(suffix >= 0)
    skip = known[~tree["retained"][suffix[known]]]
    parent[skip] = tree["parent"][suffix[skip]]
    step = np.concatenate([tree["step"], _key(tree, contexts, symbols)])
    to = np.concatenate([tree["step_to"], new])
    order = np.argsort(step)
    return tree | {
        "step": step[order], "step_to": to[order], "parent": np.concatenate([tree["parent"], parent]),
        "suffix": np.concatenate([tree.get("suffix", new[:0]), suffix]),
        "depth_end": np.concatenate([tree["depth_end"], [first_new + len(new)]]),
    }


def _joined(batch: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All codes of a batch, the text of each, and which of them are the first of their text."""
    sizes = batch.map(len).to_numpy(np.int64)
    codes = np.concatenate(batch.to_list()).astype(np.int64) if len(batch) else np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(batch)), sizes)
    return codes, text, np.concatenate([[True], text[1:] != text[:-1]])[: len(codes)]


def _runs(batch: pd.Series, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The texts of a batch in runs of about so many codes, or one text."""
    frame = batch.to_frame("codes")
    for run in slices(frame, batch.map(len).to_numpy(np.int64), most):
        yield _joined(run["codes"])


def _next_counts(coded: DataFrame, tree: dict, settings: Settings) -> DataFrame:
    """(key, n): how often each numbered symbol follows each of the deepest contexts."""
    sent = coded.sparkSession.sparkContext.broadcast(tree)

    def merged(keys: list[np.ndarray], ns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        found, of = np.unique(np.concatenate(keys), return_inverse=True)
        return found, np.bincount(of, np.concatenate(ns), len(found)).astype(np.int64)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, ns, held = [], [], 0
        for batch in batches:
            for codes, _, first in _runs(batch["codes"], settings.run_codes):
                context = _contexts(sent.value, codes, first)[-1]
                use = (context >= 0) & (codes >= 0)
                found, n = np.unique(_key(sent.value, context[use], codes[use]), return_counts=True)
                keys, ns, held = [*keys, found], [*ns, n], held + len(found)
                if held >= settings.held_keys:
                    found, n = merged(keys, ns)
                    yield pd.DataFrame({"key": found, "n": n})
                    keys, ns, held = [], [], 0
        if keys:
            found, n = merged(keys, ns)
            yield pd.DataFrame({"key": found, "n": n})

    return coded.select("codes").mapInPandas(count, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def _grown(coded: DataFrame, log_root: np.ndarray, counts: np.ndarray, end: int, total: int, s: Settings) -> dict:
    """The tree, depth after depth. Candidates come from the counts before, so no context is counted in vain."""
    tree = _empty_tree(log_root)
    least_context, least_entry = max(s.least_context, s.context_share * total), max(s.least_entry, s.entry_share * total)
    width = len(log_root)
    symbols = np.flatnonzero((counts >= least_context) & (np.arange(width) != end))
    contexts, totals = np.full(len(symbols), -1, np.int64), counts[symbols]
    for _ in range(s.depth):
        if not len(symbols):
            break
        first_new = len(tree["parent"])
        tree = _extended(tree, contexts, symbols)
        # As Arrow columns: rows of Python objects would take many times the memory.
        found = _next_counts(coded, tree, s).filter(F.col("n") >= least_entry).toArrow()
        keys, n = found["key"].to_numpy(), found["n"].to_numpy()
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
        _deeper(tree, keys, n, totals, first_new, s)
        deeper = (n >= least_context) & (keys % width != end)
        contexts, symbols, totals = keys[deeper] // width - 1, keys[deeper] % width, n[deeper]
    return tree


# --- Whole numbers as bytes: a plane for each byte that any of them needs, as values of one plane are alike ---


def _packed(values: np.ndarray) -> list[bytes]:
    planes = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return [pa.compress(((values >> (8 * k)) & 255).astype(np.uint8).tobytes(), "zstd", asbytes=True) for k in range(planes)]


def _unpacked(planes, n: int) -> np.ndarray:
    values = np.zeros(n, np.int64)
    for k, plane in enumerate(planes):
        values |= np.frombuffer(pa.decompress(bytes(plane), n, "zstd", asbytes=True), np.uint8).astype(np.int64) << (8 * k)
    return values


#: Logarithms as whole numbers: none is above this by more than rounding.
TOP, UNIT = 8, 2.0**32


def _whole(log: np.ndarray) -> np.ndarray:
    return np.rint((TOP - log) * UNIT).astype(np.int64)


# --- Chunks of coded texts ---


def _chunked(settings: Settings, ids: pa.DataType):
    """Chunks of rows: their texts as numbers of the chunk's own symbols, and how often training texts have each."""

    def row(docs: list, training: list, codes: list[np.ndarray], seen: dict[bytes, int]) -> pa.RecordBatch:
        sizes, learn = [len(c) for c in codes], [t is True for t in training]
        joined = np.concatenate(codes)
        symbols = [w if len(w) <= LONG else b" " + hashlib.md5(w).hexdigest().encode() for w in seen]
        times = np.bincount(joined[np.repeat(learn, sizes)], minlength=len(seen))
        columns = {
            "ids": (ids, docs), "training": (pa.bool_(), training), "learn": (pa.bool_(), learn), "sizes": (pa.int32(), sizes),
            "codes": (pa.binary(), _packed(joined)), "symbols": (pa.binary(), symbols), "times": (pa.int64(), times),
        }
        return pa.RecordBatch.from_arrays([pa.array([v], pa.list_(kind)) for kind, v in columns.values()], list(columns))

    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, flags, codes, seen, n = [], [], [], {}, 0
        for batch in batches:
            for doc, training, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "is_training", "text")), strict=True):
                words = [*lower_words_of(text), END]
                codes.append(np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int32, len(words)))
                docs.append(doc)
                flags.append(training)
                n += len(words)
                if n >= settings.chunk_codes:
                    yield row(docs, flags, codes, seen)
                    docs, flags, codes, seen, n = [], [], [], {}, 0
        if codes:
            yield row(docs, flags, codes, seen)

    return chunk


class Frequencies(NamedTuple):
    """Symbols are numbered by falling counts, so a few edges tell each one's count."""

    ends: np.ndarray
    counts: np.ndarray
    divisor: float
    prior: float

    def least(self, count: float) -> int:
        """How many symbols occur so often: those of the codes below."""
        return int(self.ends[self.counts >= count].max(initial=0))

    def _looked_up(self, values: np.ndarray, unseen, codes: np.ndarray) -> np.ndarray:
        return np.append(values, unseen)[np.where(codes < 0, len(values), np.searchsorted(self.ends, codes, "right"))]

    def of(self, codes: np.ndarray) -> np.ndarray:
        """How often training texts have symbols; -1 is one that they do not have."""
        return self._looked_up(self.counts, 0, codes)

    def alike(self, codes: np.ndarray, least: int) -> np.ndarray:
        """Codes where symbols from ``least`` on are told apart by their count alone."""
        rare = np.flatnonzero(codes >= least)
        codes = codes.copy()
        codes[rare] = self._looked_up(self.ends - 1, -1, codes[rare])
        return codes

    def log(self, codes: np.ndarray) -> np.ndarray:
        logs = np.log10((np.append(self.counts, 0) + self.prior) / self.divisor)
        return self._looked_up(logs[:-1], logs[-1], codes)


def _numbered_symbols(counts: DataFrame) -> tuple[DataFrame, DataFrame, list]:
    """The stored counts, (symbol, code) by falling counts, and (n, symbols that occur n times) in that order."""
    ordered = staged(counts.sort(F.desc("n"), "symbol").withColumn("place", F.monotonically_increasing_id()), "symbols")
    part, within = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    before, starts = 0, []
    for r in sorted(ordered.groupBy(part.alias("part")).count().collect()):
        starts.append((r["part"], before))
        before += r["count"]
    first = ordered.sparkSession.createDataFrame(starts, "part long, start long")
    coded = ordered.withColumn("part", part).join(F.broadcast(first), "part")
    often = ordered.groupBy("n").count().orderBy(F.desc("n")).collect()
    return ordered, coded.select("symbol", (F.col("start") + within).alias("code")), often


def _recoded(chunk: pa.Table, words: pa.Table) -> pa.Table:
    """A chunk with the numbers that symbols have in the corpus."""
    code = np.zeros(len(words), np.int64)
    code[words["pos"].to_numpy()] = words["code"].to_numpy()
    codes = code[_unpacked(chunk["codes"][0].as_py(), sum(chunk["sizes"][0].as_py()))]
    at = chunk.schema.get_field_index("codes")
    return chunk.set_column(at, "codes", pa.array([_packed(codes)], pa.list_(pa.binary())))


class Places(NamedTuple):
    """The places of a chunk: the symbol, the words before it, nearest first, -1 outside the text, and whether it is learned from."""

    symbol: np.ndarray
    before: list[np.ndarray]
    learn: np.ndarray


def _places(row, depth: int) -> Places:
    sizes = np.asarray(row["sizes"], np.int64)
    codes = (_unpacked(row["codes"], int(sizes.sum())) - 1).astype(np.int32)
    at = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    before = [np.where(at >= k, np.roll(codes, k), np.int32(-1)) for k in range(1, depth + 1)]
    return Places(codes, before, np.repeat(np.asarray(row["learn"], bool), sizes))


# --- Contexts of very many places ---
# large: for each depth the sorted keys (number of the context one word shorter at the old end + 1) << 32 | that older word.


class Large(NamedTuple):
    keys: np.ndarray
    totals: np.ndarray
    kept: np.ndarray
    rest: np.ndarray


def _pair(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return ((context.astype(np.int64) + 1) << 32) | word


def _large_contexts(keys: list[np.ndarray], before: list[np.ndarray]) -> list[np.ndarray]:
    """For each depth the number of the large context before each place, or -1; and none is large after one that is not."""
    found = []
    context = np.full(len(before[0]), -1, np.int64)
    open_ = np.arange(len(context))
    for of, word in zip(keys, before, strict=False):
        open_ = open_[word[open_] >= 0]
        at, hit = _find(of, _pair(context[open_], word[open_]))
        open_ = open_[hit]
        context = np.full(len(context), -1, np.int64)
        context[open_] = at[hit]
        found.append(context)
    return found


def _lengths(contexts: list[np.ndarray], n: int) -> np.ndarray:
    """How many of the contexts before each place are large."""
    return sum((c >= 0 for c in contexts), np.zeros(n, np.int8))


def _large_counts(large: list[np.ndarray], settings: Settings):
    """(chunk, context, symbol, n) of the contexts of the last depth of ``large``, as a chunk has them."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                places = _places(row, settings.depth)
                context = _large_contexts(large, places.before)[-1]
                use = context >= 0
                found, of = np.unique(_pair(context[use], places.symbol[use] + 1), return_inverse=True)
                n = np.bincount(of, places.learn[use], len(found)).astype(np.int64)
                yield pd.DataFrame({"chunk": row["uid"], "context": (found >> 32) - 1, "symbol": (found & 0xFFFFFFFF) - 1, "n": n})

    return count


def _large_pairs(coded: DataFrame, often: Frequencies, total: int, places: int, s: Settings) -> tuple[list[Large], list[DataFrame]]:
    """The large contexts of each depth, and (chunk, context, symbol, n) of the counted pairs that chunks have of them."""
    spark = coded.sparkSession
    least_entry = max(s.least_entry, s.entry_share * total)
    # Counts are those of training texts, whose share of a context's places is taken to be that of all places.
    bound = max(s.largest_group * total / max(places, 1), s.least_context, least_entry, s.context_share * total)
    words = int(often.ends[often.counts > bound].max(initial=0))
    keys, totals, paths = _pair(np.full(words, -1), np.arange(words)), often.of(np.arange(words)), [(w,) for w in range(words)]
    large: list[Large] = []
    tables: list[DataFrame] = []
    shorter: dict[tuple, int] = {}
    before = None
    pair = Window.partitionBy("context", "symbol")
    while len(keys) and len(large) < s.depth:
        count = _large_counts([x.keys for x in large] + [keys], s)
        own = coded.select("uid", "learn", "sizes", "codes").mapInPandas(count, "chunk long, context int, symbol long, n long")
        # A pair has at most a row for each chunk; one of them stands for it.
        own = own.withColumn("first", F.row_number().over(pair.orderBy("chunk")) == 1).withColumn("n", F.sum("n").over(pair))
        found = staged(own.filter(F.col("n") >= least_entry), "large")
        tables.append(found)
        facts = [(i, int(totals[i]), shorter.get(p[1:], -1)) for i, p in enumerate(paths)]
        facts = spark.createDataFrame(facts, "context int, total long, suffix int")
        pairs = found.filter("first").select("context", "symbol", "n").join(F.broadcast(facts), "context")
        root = _log_of(often)("symbol")
        if before is None:
            pairs = pairs.withColumn("up", root)
        else:
            # What is counted after a context is counted after its suffix.
            up = before.select(F.col("context").alias("suffix"), "symbol", F.col("log").alias("up"))
            pairs = pairs.join(up, ["suffix", "symbol"])
        share = F.pow(F.lit(10.0), "up")
        own_share = (F.col("n") + s.smoothing * share) / (F.col("total") + s.smoothing)
        pairs = staged(pairs.withColumn("share", share).withColumn("own", own_share), "pairs")
        sums = pairs.groupBy("context").agg(
            F.sum("own").alias("own"), F.sum("share").alias("share"), F.sum(F.col("own") * F.log(F.col("own") / F.col("share"))).alias("gain")
        )
        # One row for each large context.
        judged = {r["context"]: r for r in sums.collect()}
        kept, rest = np.zeros(len(keys), bool), np.zeros(len(keys))
        for i, r in judged.items():
            left, up_left = (min(1.0, max(1e-12, 1 - r[c])) for c in ("own", "share"))
            kept[i] = totals[i] * (r["gain"] + left * math.log(left / up_left)) >= s.least_gain
            rest[i] = math.log10(left / up_left)
        large.append(Large(keys, totals, kept, rest))
        flags = spark.createDataFrame([(i, bool(k)) for i, k in enumerate(kept)], "context int, kept boolean")
        log = F.when(F.col("kept"), F.log10("own")).otherwise(F.col("up"))
        before = pairs.join(F.broadcast(flags), "context").select("context", "symbol", "n", log.alias("log"))
        # A context one word longer is a large one and the next word of it. Paths are in the order of the text.
        longer = [((*paths[r["context"]], r["symbol"]), r["n"]) for r in pairs.filter(F.col("n") > bound).collect()]
        shorter = {p: i for i, p in enumerate(paths)}
        longer = [(p, n) for p, n in longer if p[1:] in shorter]
        keys = _pair(np.array([shorter[p[1:]] for p, _ in longer], np.int64), np.array([p[0] for p, _ in longer], np.int64))
        order = np.argsort(keys)
        keys, totals, paths = keys[order], np.array([n for _, n in longer], np.int64)[order], [longer[i][0] for i in order]
    return large, tables


def _log_of(often: Frequencies):
    sent = often

    @F.pandas_udf("double")
    def log(codes: pd.Series) -> pd.Series:
        return pd.Series(sent.log(codes.to_numpy(np.int64)))

    return log


# --- Groups of places ---


def _mixed(values: np.ndarray, word: np.ndarray) -> np.ndarray:
    mixed = (values ^ (word + 1).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return mixed ^ (mixed >> np.uint64(29))


def _dealt(places: Places, contexts: list[np.ndarray], least: int, bins: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bin of each place, -1 where no group is needed, how many of its contexts are large, and the order by bin.

    Within a bin, places that are learned from come first, and places after the same word are together.
    """
    depth = _lengths(contexts, len(places.symbol))
    key = np.full(len(depth), 1, np.uint64)
    bin_ = np.full(len(depth), -1, np.int64)
    for k, word in enumerate(places.before[: len(contexts) + 1]):
        key = _mixed(key, word)
        here = np.flatnonzero((depth == k) & (word >= 0) & (word < least))
        bin_[here] = (key[here] >> np.uint64(20)).astype(np.int64) % bins
    # Stable sorts of short numbers take time in proportion.
    order = np.argsort((places.before[0] & 0xFFFF).astype(np.uint16), kind="stable")
    last = (2 * (bin_ + 1) + ~places.learn).astype(np.uint16 if bins < 30_000 else np.int64)
    return bin_, depth, order[np.argsort(last[order], kind="stable")]


def _pair_counts(places: Places, context: np.ndarray, pairs: pd.DataFrame) -> np.ndarray:
    """How often the symbol of each place follows its large context, 0 where that is not counted."""
    keys = _pair(pairs["context"].to_numpy(np.int64), pairs["symbol"].to_numpy(np.int64) + 1)
    by = np.argsort(keys)
    here = np.flatnonzero(context >= 0)
    at, found = _find(keys[by], _pair(context[here], places.symbol[here].astype(np.int64) + 1))
    n = np.zeros(len(context), np.int64)
    n[here[found]] = pairs["n"].to_numpy(np.int64)[by][at[found]]
    return n


def _large_log(log: np.ndarray, large: list[Large], contexts: list[np.ndarray], counts: list[np.ndarray], s: Settings) -> np.ndarray:
    """The log10 probability of each place after the longest of its large contexts, from that of the single symbol."""
    for x, context, n in zip(large, contexts, counts, strict=True):
        here = np.flatnonzero(context >= 0)
        here = here[x.kept[context[here]]]
        of = context[here]
        own = np.log10((n[here] + s.smoothing * 10.0 ** log[here]) / (x.totals[of] + s.smoothing))
        log[here] = np.where(n[here] > 0, own, log[here] + x.rest[of])
    return log


BLOCK = "uid long, bin long, n int, n_learn int, symbol array<binary>, before array<array<binary>>, counts array<array<binary>>"


def _blocks(large: list[Large], often: Frequencies, bins: int, least: float, least_entry: float, s: Settings):
    """A chunk's places as a row for each bin."""
    context_end, entry_end = often.least(least), often.least(least_entry)

    def deal(chunk: pd.DataFrame, pairs: pd.DataFrame | None) -> pd.DataFrame:
        out = []
        for _, row in chunk.iterrows():
            places = _places(row, s.depth)
            contexts = _large_contexts([x.keys for x in large], places.before)
            bin_, depth, order = _dealt(places, contexts, context_end, bins)
            counts = [_pair_counts(places, context, pairs[pairs["depth"] == k]) for k, context in enumerate(contexts)]
            symbol = often.alike(places.symbol, entry_end)
            # A rare word ends no candidate, and no longer context has one.
            before = [np.where(word < context_end, word, np.int32(-1)) for word in places.before]
            ordered = bin_[order]
            edges = np.flatnonzero(np.diff(ordered, prepend=-2, append=-2))
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                at, number = order[a:b], int(ordered[a])
                if number < 0:
                    at, number = at[depth[at] > 0], -1 - int(row["uid"])
                if len(at):
                    some = bool(depth[at].any())
                    out.append((
                        row["uid"], number, len(at), int(places.learn[at].sum()), _packed(symbol[at] + 1),
                        [_packed(word[at] + 1) for word in before], [_packed(n[at]) for n in counts] if some else [],
                    ))
        return pd.DataFrame(out, columns=[c.split()[0] for c in BLOCK.split(", ")])

    return deal


def _learned(depth, symbol, counted, before, learn, log, totals_least: float, entry_least: float, s: Settings) -> np.ndarray:
    """The log10 probability of each place of a group, which has all places of its contexts longer than ``depth``.

    ``counted`` are symbols that can be counted one by one. ``log`` is that of the longest large context, or of the single
    symbol; contexts are judged depth after depth.
    """
    log, open_ = log.copy(), np.arange(len(log))
    context = np.zeros(len(log), np.int64)
    for k, word in enumerate(before):
        open_ = open_[word[open_] >= 0]
        keys, context[open_] = np.unique((context[open_] << 32) | word[open_], return_inverse=True)
        here = open_[depth[open_] <= k]
        totals = np.bincount(context[here[learn[here]]], minlength=len(keys))
        candidate = totals >= (totals_least if k == 0 else max(totals_least, entry_least))
        here = here[candidate[context[here]]]
        of = context[here]
        known = np.flatnonzero(counted[here])
        at = here[known]
        grams, gram = np.unique((of[known] << 32) | symbol[at], return_inverse=True)
        n = np.bincount(gram[learn[at]], minlength=len(grams))
        up = grams >> 32
        # The places of a gram have the same probability so far.
        parent = np.zeros(len(grams))
        parent[gram] = log[at]
        parent = 10.0 ** parent
        entry = n >= entry_least
        own = (n + s.smoothing * parent) / (totals[up] + s.smoothing)
        spread = lambda values: np.bincount(up[entry], values[entry], len(keys))  # noqa: B023, E731
        left, parent_left = np.clip(1 - spread(own), 1e-12, 1), np.clip(1 - spread(parent), 1e-12, 1)
        divergence = spread(own * np.log(own / parent)) + left * np.log(left / parent_left)
        kept = totals * divergence >= s.least_gain
        better = log[here] + np.log10(left / parent_left)[of]
        better[known] = np.where(entry[gram], np.log10(own)[gram], better[known])
        log[here] = np.where(kept[of], better, log[here])
        # Deeper contexts are longer than a candidate or than a large context.
        open_ = np.concatenate([here, open_[depth[open_] > k]])
    return log


def _scored_bin(large: list[Large], often: Frequencies, totals_least: float, entry_least: float, s: Settings) -> Callable:
    entry_end = often.least(entry_least)

    def score(blocks: pd.DataFrame) -> pd.DataFrame:
        sizes = blocks["n"].to_numpy(np.int64)

        def whole(planes) -> np.ndarray:
            return np.concatenate([_unpacked(v, n) for v, n in zip(planes, sizes, strict=True)])

        symbol = whole(blocks["symbol"]) - 1
        before = [(whole(blocks["before"].str[k]) - 1).astype(np.int32) for k in range(s.depth)]
        contexts = _large_contexts([x.keys for x in large], before)
        counts = [whole([v[k] if len(v) else [] for v in blocks["counts"]]) for k in range(len(large))]
        log = _large_log(often.log(symbol), large, contexts, counts, s)
        if blocks["bin"].iloc[0] >= 0:
            learn = np.concatenate([np.arange(n) < m for n, m in zip(sizes, blocks["n_learn"], strict=True)])
            counted = (symbol >= 0) & (symbol < entry_end)
            log = _learned(_lengths(contexts, len(log)), symbol, counted, before, learn, log, totals_least, entry_least, s)
        ends = np.cumsum(sizes)
        out = blocks[["uid", "bin", "n"]].copy()
        out["log"] = [_packed(_whole(log[a:b])) for a, b in zip(ends - sizes, ends, strict=True)]
        return out

    return score


def _added_up(large: list[Large], often: Frequencies, bins: int, least: float, s: Settings) -> Callable:
    """The rows of a chunk with the sums over their places."""

    def add(chunk: pa.Table, parts: pa.Table) -> pa.Table:
        flat = {c: chunk[c].combine_chunks().flatten() for c in ("ids", "training", "learn", "sizes", "codes")}
        sizes = flat["sizes"].to_numpy().astype(np.int64)
        places = _places({"sizes": sizes, "learn": flat["learn"].to_pylist(), "codes": flat["codes"].to_pylist()}, s.depth)
        contexts = _large_contexts([x.keys for x in large], places.before)
        bin_, depth, order = _dealt(places, contexts, often.least(least), bins)
        root = often.log(places.symbol)
        whole = _whole(root)
        ordered = bin_[order]
        for part in parts.select(["bin", "n", "log"]).to_pylist():
            number = max(part["bin"], -1)
            a, b = np.searchsorted(ordered, [number, number + 1])
            at = order[a:b]
            whole[at if number >= 0 else at[depth[at] > 0]] = _unpacked(part["log"], part["n"])
        starts = np.cumsum(sizes) - sizes
        # Every text has its end, so none is empty here.
        return pa.table({
            "doc_id": flat["ids"], "is_training": flat["training"], "n_tokens": sizes,
            "n_known": np.add.reduceat((places.symbol >= 0).astype(np.int64), starts),
            "base_score": np.bincount(np.repeat(np.arange(len(sizes)), sizes), root, len(sizes)),
            "score": TOP * sizes - np.add.reduceat(whole, starts) / UNIT,
        })

    return add


# --- Scores ---


def scored(
    docs: DataFrame, training: Column, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, is_training, n_tokens, n_known, train_tokens, base_score, score) for each row.

    ``training`` says which rows are learned from. Scores are log10 probabilities of whole texts.
    """
    s = settings
    rows = docs.select(F.col(doc_id).alias("doc_id"), training.alias("is_training"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType
    schema = (
        f"ids array<{kind.simpleString()}>, training array<boolean>, learn array<boolean>, sizes array<int>, codes array<binary>, "
        "symbols array<binary>, times array<long>"
    )
    chunks = numbered(rows.mapInArrow(_chunked(s, to_arrow_type(kind)), schema), "chunks")
    words = chunks.select("uid", F.posexplode(F.arrays_zip("symbols", "times")).alias("pos", "w"))
    words = words.select(F.col("uid").alias("chunk"), "pos", F.col("w.symbols").alias("symbol"), F.col("w.times").alias("n"))
    counts = words.groupBy("symbol").agg(F.sum("n").alias("n")).filter("n > 0")
    ordered, codes, counted = _numbered_symbols(counts)
    n, symbols = (np.array([r[i] for r in counted], np.int64) for i in range(2))
    total, distinct = int((n * symbols).sum()), int(symbols.sum())
    often = Frequencies(np.cumsum(symbols), n, total + s.prior * (distinct + 1), s.prior)
    least_context, least_entry = max(s.least_context, s.context_share * total), max(s.least_entry, s.entry_share * total)

    # One up: 0 is a symbol that training texts do not have.
    numbers = words.join(codes, "symbol", "left").select("chunk", "pos", F.coalesce(F.col("code") + 1, F.lit(0)).alias("code"))
    kept = (
        f"uid long, ids array<{kind.simpleString()}>, training array<boolean>, learn array<boolean>, sizes array<int>, "
        "codes array<binary>"
    )
    slim = chunks.select("uid", "ids", "training", "learn", "sizes", "codes")
    # Rows with their ids go through Arrow alone, which keeps every type and null as it is.
    coded = staged(slim.groupBy("uid").cogroup(numbers.groupBy("chunk")).applyInArrow(_recoded, kept), "coded")
    unstaged(chunks, ordered)

    places = coded.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b))).first()[0] or 0
    large, tables = _large_pairs(coded, often, total, places, s)
    bins = 1 + 2 * places // s.largest_group
    deal = _blocks(large, often, bins, least_context, least_entry, s)
    narrow = coded.select("uid", "learn", "sizes", "codes")
    if large:
        pairs = union([x.select("chunk", F.lit(k).alias("depth"), "context", "symbol", "n") for k, x in enumerate(tables)])
        blocks = narrow.groupBy("uid").cogroup(pairs.groupBy("chunk")).applyInPandas(deal, BLOCK)
    else:
        blocks = narrow.mapInPandas(lambda batches: (deal(b, None) for b in batches), BLOCK)
    score = _scored_bin(large, often, least_context, least_entry, s)
    parts = staged(blocks.groupBy("bin").applyInPandas(score, "uid long, bin long, n int, log array<binary>"), "parts")
    unstaged(*tables)

    add = _added_up(large, often, bins, least_context, s)
    schema = f"doc_id {kind.simpleString()}, is_training boolean, n_tokens long, n_known long, base_score double, score double"
    found = coded.groupBy("uid").cogroup(parts.groupBy("uid")).applyInArrow(add, schema)
    return found.select(
        "doc_id", "is_training", "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"), "base_score", "score"
    )
