"""Best-fit packing of token sequences by minimum bin slack.

A document is its token ids and an end id; only documents longer than a sequence are cut. Sequences are filled one after
the other: a subset-sum over bit sets finds the fullest feasible combination of the lengths still there, the one with the
longest pieces if several are as full, and the combination is removed.

Which pieces are of a length does not matter for that, so it is done on the counts of the lengths: one row for each length
up to ``capacity``, however many documents there are. A combination stays the fullest for as long as its pieces last, so it
is taken as often as the counts allow in one step. A step uses up a length but for a few pieces, or takes some of those few;
with n lengths there are at most n + capacity / 1 + ... + capacity / n steps, a bound without the corpus in it. The pieces of
a length are then numbered in Spark, and a piece's number tells the combination, the sequence and the place it is in.

* A missing text counts as empty; an empty text has the end id alone. Every row gives at least one piece, equal rows give
  equal pieces in places of their own. Very long texts give as many pieces as they need. An empty table gives an empty result.
* Sequences are numbered from 0 without gaps; the pieces of one start at 0 and leave no gaps. Extra columns are not read.
* Words between ASCII blanks are tokenized one by one and remembered: the vocabulary's cut never joins characters across a
  blank. The vocabulary's path is a parameter; its file is read on the driver and has a fixed size.
"""

from __future__ import annotations

import os
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Mapping
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import numbered, slices, words_of

#: Signs that the vocabulary's cut joins to each other, but not to letters before them: not so the apostrophe.
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
LAST_PLAIN = "\xff"
#: The vocabulary spells a byte that is no visible sign of Latin-1 as the next free character from U+0100.
HIDDEN = [*range(0x21), *range(0x7F, 0xA1), 0xAD]
BYTE_SIGNS = {byte: 0x100 + i for i, byte in enumerate(HIDDEN)}

PIECES = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>"
#: A number given by ``numbered`` has the partition above this bit.
PARTITION_BIT = 33


@dataclass(frozen=True)
class Settings:
    vocabulary: str = "/opt/tokenizers/word_bpe_49k.json"
    capacity: int = 4096
    end_id: int = 1
    batch_chars: int = 1_000_000
    #: A worker forgets its words beyond so many words or ids.
    held_words: int = 1_000_000
    held_ids: int = 5_000_000


# --- Tokens ---


class WordIds(dict):
    """The number of each word seen, given when it is first looked up; and all words' ids, with where each one's end.

    A word of letters up to ``LAST_PLAIN`` is one piece for the vocabulary's cut and has no other normal form than its lower case,
    so its merges are taken as they are; ``SIGNS`` behind one are a piece of their own. All other words go through
    the whole tokenizer.
    """

    def __init__(self, vocabulary: str, settings: Settings):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer, self.settings = Tokenizer.from_str(vocabulary), settings
        self.merges = self.tokenizer.model.tokenize
        self.ids, self.ends = array("I"), array("q", [0])

    def __missing__(self, word: bytes) -> int:
        if word.isalpha():
            ids = [token.id for token in self.merges(word.lower().decode())]
        else:
            ids = self._other(word.decode())
        self.ids.extend(ids)
        self[word] = number = len(self.ends) - 1
        self.ends.append(len(self.ids))
        return number

    def _other(self, text: str) -> list[int]:
        letters = text.rstrip(SIGNS)
        if not letters.isalpha() or max(letters) > LAST_PLAIN:
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        if letters == text:
            return [token.id for token in self.merges(text.lower().encode().decode("latin-1").translate(BYTE_SIGNS))]
        parts = [self[letters.encode()], self[text[len(letters) :].encode()]]
        return [i for part in parts for i in self.ids[self.ends[part] : self.ends[part + 1]]]

    def ids_of(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text, without an end."""
        if len(self) > self.settings.held_words or len(self.ids) > self.settings.held_ids:
            self.clear()
            self.ids, self.ends = array("I"), array("q", [0])
        per_text = [words_of(text) for text in texts]
        n_words = np.array([len(words) for words in per_text], np.int64)
        at = np.fromiter(map(self.__getitem__, chain.from_iterable(per_text)), np.int64, n_words.sum())
        ids, ends = np.array(self.ids, np.uint32), np.array(self.ends, np.int64)
        length = ends[at + 1] - ends[at]
        after = np.cumsum(length)
        found = ids[np.repeat(ends[at] - (after - length), length) + np.arange(after[-1] if len(after) else 0)]
        return np.split(found, np.concatenate([[0], after])[np.cumsum(n_words)[:-1]])


@lru_cache(maxsize=1)
def _words(vocabulary: str, s: Settings) -> WordIds:
    """Kept by a worker from task to task."""
    return WordIds(vocabulary, s)


def _cutter(spark: SparkSession, s: Settings):
    with open(s.vocabulary, encoding="utf-8") as file:
        vocabulary = spark.sparkContext.broadcast(file.read())

    @F.pandas_udf(PIECES)
    def cut(texts: pd.Series) -> pd.Series:
        words = _words(vocabulary.value, s)
        frame, rows = texts.to_frame("t"), []
        for run in slices(frame, frame["t"].str.len().fillna(0).to_numpy(), s.batch_chars):
            for ids in words.ids_of(run["t"].tolist()):
                rows.append(_cut(np.append(ids, np.uint32(s.end_id)), s.capacity))
        return pd.Series(rows, dtype=object)

    return cut


def _cut(ids: np.ndarray, capacity: int) -> list[dict]:
    runs = [(start, ids[start : start + capacity]) for start in range(0, len(ids), capacity)]
    return [
        {"piece": i, "start": start, "length": len(run), "ids_crc32": zlib.crc32(run.astype("<u4").tobytes())}
        for i, (start, run) in enumerate(runs)
    ]


def pieces(docs: DataFrame, s: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(uid, doc_id, piece, start, length, ids_crc32), stored: every document's pieces."""
    cut = docs.select(F.col(doc_id).alias("doc_id"), F.explode(_cutter(docs.sparkSession, s)(F.col(text))).alias("p"))
    return numbered(cut.select("doc_id", "p.*"), "pieces")


# --- Combinations ---


def combinations(counts: Mapping[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(times, [(length, how many in one sequence)]) in the order taken; all counts are used up.

    ``below[i]`` is the bit set of all sums of pieces shorter than ``lengths[i]``. It changes only above the shortest length
    whose usable count changed, and once every sum can be reached it stays so.
    """
    lengths = sorted(n for n, count in counts.items() if count)
    left = {n: counts[n] for n in lengths}
    every = (1 << capacity + 1) - 1
    below: list[int] = [1]
    taken = []
    while lengths:
        for i in range(len(below) - 1, len(lengths)):
            below.append(_with(below[i], lengths[i], left[lengths[i]], capacity, every))
        room = below[-1].bit_length() - 1
        chosen, i = [], len(lengths)
        while room:
            i = bisect_right(lengths, room, 0, i) - 1
            n = lengths[i]
            most = min(left[n], room // n)
            k = next(k for k in range(most, -1, -1) if below[i] >> room - k * n & 1)
            if k:
                chosen.append((n, k))
                room -= k * n
        times = min(left[n] // k for n, k in chosen)
        taken.append((times, chosen))
        changed = len(lengths)
        for n, k in chosen:
            usable = min(left[n], capacity // n)
            left[n] -= times * k
            if min(left[n], capacity // n) != usable:
                changed = min(changed, bisect_right(lengths, n) - 1)
        del below[changed + 1 :]
        lengths[changed:] = [n for n in lengths[changed:] if left[n]]
    return taken


def _with(sums: int, length: int, count: int, capacity: int, every: int) -> int:
    """The sums with up to ``count`` more pieces of a length, doubling how many are added at a time."""
    count, step = min(count, capacity // length), 1
    while count and sums != every:
        step = min(step, count)
        sums = (sums | sums << step * length) & every
        count, step = count - step, 2 * step
    return sums


@dataclass(frozen=True)
class Plan:
    """For runs of a length's pieces, in order of length and first number: sequence, how many in one, and offset there."""

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the pieces with these lengths and numbers within their length."""
        run = np.searchsorted(_ordered(self.length, self.first), _ordered(length, number), side="right") - 1
        within = number - self.first[run]
        return self.sequence[run] + within // self.each[run], self.offset[run] + within % self.each[run] * length


def _ordered(length: np.ndarray, number: np.ndarray) -> np.ndarray:
    """One number that is ordered as the pairs are; there are fewer than 2**48 pieces."""
    return (length.astype(np.int64) << 48) + number


def planned(counts: Mapping[int, int], capacity: int) -> Plan:
    rows, used, sequence = [], dict.fromkeys(counts, 0), 0
    for times, chosen in combinations(counts, capacity):
        offset = 0
        for length, each in chosen:
            rows.append((length, used[length], sequence, each, offset))
            used[length] += times * each
            offset += length * each
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return Plan(*table.T)


# --- Places ---


def _numbered_within(cut: DataFrame) -> DataFrame:
    """Number the pieces of each length from 0: within each stored partition, after the partitions before it."""
    part = F.shiftright("uid", PARTITION_BIT).alias("part")
    rows = cut.select("*", part)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("length", "part").agg(F.count("*").alias("n"))
    base = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    own = F.row_number().over(Window.partitionBy("length", "part").orderBy("uid")) - 1
    return rows.withColumn("own", own).join(base, ["length", "part"]).withColumn("number", F.col("base") + F.col("own"))


def packed(docs: DataFrame, s: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece."""
    cut = pieces(docs, s, doc_id, text)
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most ``capacity`` rows
    plan = docs.sparkSession.sparkContext.broadcast(planned(counts, s.capacity))

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        sequence, offset = plan.value.place(length.to_numpy(), number.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    placed = _numbered_within(cut).withColumn("at", place("length", "number"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset")
