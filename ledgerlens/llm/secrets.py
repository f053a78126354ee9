"""Secret scan: fixed patterns, and a token-efficiency test for random strings.

A vocabulary of frequent byte sequences packs natural text into few tokens and random characters into many. A run of key
characters whose characters per token stay below a bound is random, unless it is a known digest or an identifier.

* Kinds: ``assign`` a password or key that is given a value; ``access`` an access key id; ``hex`` a long run of hex
  digits; ``random`` what the token test adds outside those three. Spans are code points, the end exclusive, in order of
  their start, then of the kinds as listed.
* Known digests are hex runs of a digest's length with its name before them, and commit ids after the word commit;
  identifiers are UUIDs, numbers with their separators and dates. They are no ``random`` spans; a ``hex`` span that is a known
  digest is marked ``known``. A UUID is cut out of a run, and what is left of the run is judged by itself.
* A run of letters and digits is judged by a constant bound. One of letters alone must change between upper and lower case
  like no word does, and pack fewer characters into a token than the document's own words: invented or foreign words pack few
  as well. Letters of one case and digits alone are taken for words and numbers.
* A missing text counts as empty and has no spans; neither has an empty one. Equal texts have equal spans. Extra columns
  are not read. The vocabulary file's path is a parameter; it is read on the driver and has a fixed size.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import fresh

# The patterns of the base kinds, the digest names, and how the vocabulary's texts are cut.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
DIGEST_NAME = re.compile(r"(?:md5|sha-?1|sha-?224|sha-?256|sha-?384|sha-?512|blake2[bs]?|digest|checksum|commit|etag)\W{0,4}$", re.I)
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
UUID = re.compile(r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}")
CUT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KINDS = ("assign", "access", "hex", "random")

RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
LETTER, DIGIT = re.compile(r"[A-Za-z]"), re.compile(r"[0-9]")
HEX_DIGITS = re.compile(r"[0-9a-fA-F]+")
CASE_CHANGE, OWN_WORD = re.compile(r"(?<=[a-z])[A-Z]|(?<=[A-Z])[a-z]"), re.compile(r"[^\W\d_]{4,}")

SPANS = "array<struct<kind:string,start:int,end:int,known:boolean>>"


@dataclass(frozen=True)
class Settings:
    vocabulary: str = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    #: Random runs pack fewer characters than this into a token; those of letters alone, at most this share of what the
    #: document's words do, and they change their case this often.
    most_per_token: float = 2.2
    most_of_words: float = 0.8
    least_changes: int = 5
    least_run: int = 16


def _base(text: str) -> list[tuple[str, int, int]]:
    spans = []
    low = text.lower()
    if any(word in low for word in ASSIGN_WORDS):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    return spans + [("hex", *m.span()) for m in HEX.finditer(text)]


def _is_digest(text: str, start: int, end: int) -> bool:
    return end - start in DIGEST_LENGTHS and DIGEST_NAME.search(text, max(0, start - 20), start) is not None


def _pieces(text: str, least: int) -> Iterator[tuple[int, int]]:
    """Runs of key characters, without the UUIDs in them."""
    for m in RUN.finditer(text):
        start = m.start()
        for known in [*UUID.finditer(text, m.start(), m.end()), None]:
            end = known.start() if known else m.end()
            if end - start >= least:
                yield start, end
            start = known.end() if known else end


def _random(text: str, taken: list[tuple[str, int, int]], tokens: Callable[[str], int], s: Settings) -> list[tuple[str, int, int]]:
    found, of_words = [], None
    for start, end in _pieces(text, s.least_run):
        run = text[start:end]
        if not LETTER.search(run) or (HEX_DIGITS.fullmatch(run) and _is_digest(text, start, end)):
            continue
        most = s.most_per_token
        if not DIGIT.search(run):
            if len(CASE_CHANGE.findall(run)) < s.least_changes:
                continue
            if of_words is None:  # characters per token of the document's words, each once
                words = {w for w in OWN_WORD.findall(text) if w not in run}
                of_words = sum(map(len, words)) / max(1, sum(map(tokens, words))) if words else s.most_per_token
            most = min(most, s.most_of_words * of_words)
        if any(a < end and start < b for _, a, b in taken):
            continue
        if len(run) < most * tokens(run):
            found.append(("random", start, end))
    return found


def scanner(spark: SparkSession, settings: Settings = Settings()):
    """A column function from a text to its spans."""
    with open(settings.vocabulary, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    sent = spark.sparkContext.broadcast(ranks)
    encoders: list[tiktoken.Encoding] = []

    def n_tokens(run: str) -> int:
        if not encoders:
            encoders.append(tiktoken.Encoding("own", pat_str=CUT, mergeable_ranks=sent.value, special_tokens={}))
        return len(encoders[0].encode_ordinary(run))

    def spans_of(text: str | None) -> list[dict]:
        if not text:
            return []
        base = _base(text)
        spans = sorted(base + _random(text, base, n_tokens, settings), key=lambda s: (s[1], KINDS.index(s[0])))
        return [{"kind": k, "start": s, "end": e, "known": k == "hex" and _is_digest(text, s, e)} for k, s, e in spans]

    @F.pandas_udf(SPANS)
    def scan(texts: pd.Series) -> pd.Series:
        return texts.map(spans_of, na_action=None)

    return scan


def digest(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def without_secrets(docs: DataFrame, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """The documents that hold no secret; a known digest is none."""
    name = fresh(docs, "_spans")
    scanned = docs.withColumn(name, scanner(docs.sparkSession, settings)(F.col(text)))
    return scanned.filter(~F.exists(name, lambda s: ~s["known"])).select(*docs.columns)
