"""Quality rules with repetition measured by a suffix array of each text.

The suffixes of a text's words are sorted; neighbours in that order share the longest prefixes, so the intervals of the
longest-common-prefix array give, for every place, the longest passage from there that occurs elsewhere in the text. The
union of those that are long enough is the covered part, the longest of all the longest repeat. Both are limited.

* Texts of a batch are sorted together, the text's number before its words, so a short text costs no sort of its own and
  a long one is sorted whole. Prefix doubling takes as many rounds as the longest repeat has binary digits.
* A missing text has no words and fails the base rules; so does an empty one. Counts depend on the text alone, so
  repeated rows get equal rows. Extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.llm.common import codes_of, slices, words_of

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"
CONTINUATION = bytes(range(0x80, 0xC0))

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat")
MEASURES = ", ".join(f"{c} long" for c in COUNTS) + ", spans array<struct<start:int,end:int>>"


@dataclass(frozen=True)
class Settings:
    window: int = 5
    #: Repeats of at least so many words count as covered.
    long_repeat: int = 10
    batch_chars: int = 4_000_000
    least_words: int = 10
    most_repeated_percent: int = 20
    most_covered_percent: int = 15
    longest_allowed: int = 100


def _ranks(words: np.ndarray, doc: np.ndarray, left: np.ndarray) -> list[np.ndarray]:
    """For 1, 2, 4, ... words: the place of each suffix in their order, equal for suffixes that agree so far.

    ``left`` counts the words from a place to the end of its text. The last array has no ties.
    """
    n = len(words)
    order = np.lexsort((words, doc))
    tied, rank = _placed(order, np.zeros(n, np.int64), doc[order] * (words.max() + 1) + words[order], 0)
    levels, length = [rank], 1
    while len(tied):
        beyond = left[tied] > length
        follow = np.where(beyond, rank[np.where(beyond, tied + length, 0)] + 1, 0)
        order = np.lexsort((follow, rank[tied]))
        tied = tied[order]
        tied, rank = _placed(tied, rank, follow[order], rank[tied])
        levels.append(rank)
        length *= 2
    return levels


def _placed(order: np.ndarray, rank: np.ndarray, key: np.ndarray, group) -> tuple[np.ndarray, np.ndarray]:
    """Ranks after sorting some suffixes by (group, key), the group being the rank they shared, and those still tied."""
    n = len(order)
    group = np.broadcast_to(group, n)
    new_group = np.concatenate([[True], group[1:] != group[:-1]])
    new_key = new_group | np.concatenate([[True], key[1:] != key[:-1]])
    at = np.arange(n)
    first_of_group = np.maximum.accumulate(np.where(new_group, at, 0))
    first_of_key = np.maximum.accumulate(np.where(new_key, at, 0))
    rank = rank.copy()
    rank[order] = group + (first_of_key - first_of_group)
    alone = new_key & np.concatenate([new_key[1:], [True]])
    return order[~alone], rank


def longest_repeats(words: np.ndarray, doc: np.ndarray, left: np.ndarray) -> np.ndarray:
    """For each place, how many words from there on also occur from another place of the same text."""
    if not len(words):
        return np.zeros(0, np.int64)
    levels = _ranks(words, doc, left)
    suffixes = np.empty(len(words), np.int64)
    suffixes[levels[-1]] = np.arange(len(words))
    a, b = suffixes[:-1].copy(), suffixes[1:].copy()
    common = np.zeros(len(a), np.int64)
    same_doc = doc[a] == doc[b]
    room = np.minimum(left[a], left[b])
    for level in range(len(levels) - 1, -1, -1):
        ranks = levels[level]
        inside = same_doc & (common < room)
        more = inside.copy()
        more[inside] = ranks[a[inside] + common[inside]] == ranks[b[inside] + common[inside]]
        common[more] += 1 << level
    found = np.zeros(len(words), np.int64)
    found[a] = common
    found[b] = np.maximum(found[b], common)
    return found


def _covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + lengths, -1)
    return np.cumsum(marks[:-1]) > 0


def _measured(texts: list[str | None], settings: Settings) -> list[tuple]:
    per_doc = [words_of(text) for text in texts]
    sizes = np.array([len(words) for words in per_doc], np.int64)
    ends = np.cumsum(sizes)
    codes, _ = codes_of([w for words in per_doc for w in words])
    doc = np.repeat(np.arange(len(texts)), sizes)
    left = ends[doc] - np.arange(len(codes))
    repeats = longest_repeats(codes, doc, left)
    short = np.flatnonzero(repeats >= settings.window)
    in_window = _covered(short, np.full(len(short), settings.window), len(codes))
    long = np.flatnonzero(repeats >= settings.long_repeat)
    covered = _covered(long, repeats[long], len(codes))
    rows = []
    for text, n, end in zip(texts, sizes.tolist(), ends.tolist(), strict=True):
        raw, begin = (text or "").encode(), end - n
        lines = [line for line in raw.split(b"\n") if line.strip()]
        here = np.concatenate([[False], covered[begin:end], [False]])
        edges = np.flatnonzero(here[1:] != here[:-1]).tolist()
        rows.append((
            n, len(raw.translate(None, BLANKS + CONTINUATION)), len(raw) - len(raw.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), int(in_window[begin:end].sum()), int(covered[begin:end].sum()),
            int(repeats[begin:end].max(initial=0)),
            [{"start": s, "end": e} for s, e in zip(edges[::2], edges[1::2], strict=True)],
        ))
    return rows


def measurer(settings: Settings = Settings()):
    """A column function from a text to its counts and the word spans of its long repeats."""

    @F.pandas_udf(MEASURES)
    def measure(texts: pd.Series) -> pd.DataFrame:
        frame, rows = texts.to_frame("t"), []
        for run in slices(frame, frame["t"].str.len().fillna(0).to_numpy(), settings.batch_chars):
            rows += _measured(run["t"].tolist(), settings)
        return pd.DataFrame(rows, columns=[*COUNTS, "spans"])

    return measure


def base_failed(m: Column, settings: Settings = Settings()) -> Column:
    return (m["n_words"] < settings.least_words) | (100 * m["n_repeat_words"] > settings.most_repeated_percent * m["n_words"])


def kept(m: Column, settings: Settings = Settings()) -> Column:
    """Passes the base rules, repeats little of itself, and nothing at great length."""
    return (
        ~base_failed(m, settings) & (100 * m["n_covered"] <= settings.most_covered_percent * m["n_words"])
        & (m["longest_repeat"] <= settings.longest_allowed)
    )
