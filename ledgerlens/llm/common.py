"""What the operators on documents share: words, stable row tables, bounded Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import staged

#: A word is a run of characters other than the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"

ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
UNBOUNDED = 1 << 30


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bounded_batches(spark: SparkSession, limit: str = "4m") -> None:
    """Bound the bytes of an Arrow batch, so that a run of very long texts does not fill a Python worker.

    A bound that the session already has is kept.
    """
    now = spark.conf.get(BATCH_BYTES, None)
    digits = "".join(c for c in now or "" if c.isdigit() or c == "-")
    if not digits or digits.startswith("-") or int(digits) >= UNBOUNDED:
        spark.conf.set(BATCH_BYTES, limit)


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z and nothing else, unlike ``lower``, which knows every alphabet."""
    return F.translate(c, ASCII_UPPER, ASCII_LOWER)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; bytes split at exactly the six ASCII blanks."""
    return text.encode().split() if text else []


def lower_words_of(text: str | None) -> list[bytes]:
    """The same with A-Z lower-cased; bytes know no other letters."""
    return text.encode().lower().split() if text else []


def codes_of(words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Numbers for words, and the distinct words in that order."""
    seen: dict[bytes, int] = {}
    codes = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    return codes, list(seen)


def slices(frame: pd.DataFrame, sizes: np.ndarray, most: int) -> Iterator[pd.DataFrame]:
    """Cut a batch into runs of rows whose sizes add up to about ``most``; one row larger than that is a run."""
    if len(frame):
        run = (np.cumsum(sizes) - sizes) // most
        for start, end in _runs(run):
            yield frame.iloc[start:end]


def _runs(keys: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(keys)) + 1
    return list(zip([0, *edges], [*edges, len(keys)], strict=True))


def numbered(df: DataFrame, name: str, uid: str = "uid") -> DataFrame:
    """Write a narrow table with a number on each row. Read back, the numbers never change."""
    return staged(df.withColumn(uid, F.monotonically_increasing_id()), name)


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
