"""Personal data: fixed patterns, and identifiers that bootstrapped contexts discover.

The fixed patterns give the seeds. The words before a seed are lexical patterns; a pattern extracts the identifier-like
tokens that follow it anywhere in the corpus. Pattern and instance score each other on that graph: a pattern is as good as
the share of its instances that are known, times the share of its occurrences in the corpus that an identifier-like token
follows, so that a common word is no pattern; an instance is as good as its patterns make likely together. After a few
rounds, patterns of high confidence that enough different seeds support mark what else they extract.

* Base kinds ``email``, ``ip``, ``card``, ``phone``: leftmost matches without overlap within a kind; a match that fails its
  check is dropped and not retried. Discovered spans have the kind ``context``. Spans are code points, the end exclusive,
  ordered by start, then by kind as listed.
* Identifier-like tokens have at least six ASCII letters and digits, three of them digits, and do not overlap a base span.
* The graph holds each different (pattern, instance) once, so copies of a document do not add confidence. It stays in
  tables. Occurrences are counted for the patterns that enough seeds support, in all texts; the tasks get a bit for each
  hash of such a pattern, a table of a fixed size, and what hashes alike is left out by a join.
* A missing text counts as empty and has no spans, like an empty one. Repeated rows get equal spans. An empty table gives
  an empty result. Extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import numbered
from ledgerlens.session import staged

# The patterns of the base kinds. Runs are taken whole, so a long run is read once; the part of an address
# before its @ is found from the @ backwards.
KINDS = ("email", "ip", "card", "phone", "context")
LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: A word with a digit, read once from its start.
NUMBERED_WORD = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+")
EDGES = ".,;:!?()[]{}<>\"'*#$%&|"
#: Bits that tell the tasks which patterns to count.
COUNTED_BITS = 1 << 20

FOUND = """base array<struct<start:int,rank:int,kind:string,end:int>>,
seen array<struct<start:int,end:int,instance:string,seed:boolean,patterns:array<string>>>"""


@dataclass(frozen=True)
class Settings:
    rounds: int = 3
    least_confidence: float = 0.8
    #: Different known instances that must support a pattern.
    least_support: int = 3
    #: What one pattern of full confidence adds to an instance.
    trust: float = 0.9


def _emails(text: str) -> list[tuple[int, int]]:
    found, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_PART:
            start -= 1
        domain = DOMAIN.match(text, at) if start < at else None
        if domain:
            found.append((start, domain.end()))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    return found


def _luhn(digits: str) -> bool:
    doubled = [int(c) * 2 for c in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _digits(run: str) -> str:
    return "".join(c for c in run if c in "0123456789")


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """(start, rank of the kind, kind, end) in order."""
    spans = [(s, 0, "email", e) for s, e in _emails(text)]
    small = lambda part: len(p := part.lstrip("0")) < 4 and int(p or "0") <= 255
    spans += [(m.start(), 1, "ip", m.end()) for m in IP.finditer(text) if all(map(small, m.groups()))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
            spans.append((m.start(), 2, "card", m.end()))
    if "+" in text:
        spans += [(m.start(), 3, "phone", m.end()) for m in PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(spans)


_SHAPE = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyz" + "0" * 10)


def patterns_before(text: str, start: int) -> list[str]:
    """The last word before a place, and the last two, in lower case and with every digit a zero."""
    size = 80
    while len(words := text[max(0, start - size):start].split()) < 3 and size < start:
        size *= 4  # until the last two are there whole
    words = " ".join(words[-2:]).translate(_SHAPE).split()
    return [words[-1], " ".join(words)] if len(words) == 2 else [" ".join(["^", *words])]


def _identifiers(text: str, base: list[tuple]) -> list[tuple[int, int]]:
    found, i = [], 0
    ends = sorted((s, e) for s, _, _, e in base)
    for m in NUMBERED_WORD.finditer(text):
        word = m[0]
        start = m.start() + len(word) - len(word.lstrip(EDGES))
        end = start + len(word.strip(EDGES))
        while i < len(ends) and ends[i][1] <= start:
            i += 1
        if any(s < end and start < e for s, e in ends[i:i + 5]):
            continue
        core = [c for c in text[start:end] if c.isascii() and c.isalnum()]
        if len(core) >= 6 and sum(c.isdigit() for c in core) >= 3:
            found.append((start, end))
    return found


def _found(text: str | None) -> tuple[list[dict], list[dict]]:
    if not text:
        return [], []
    base = base_spans(text)
    seen = [(s, e, True) for s, _, _, e in base] + [(s, e, False) for s, e in _identifiers(text, base)]
    return (
        [{"start": s, "rank": r, "kind": k, "end": e} for s, r, k, e in base],
        [
            {"start": s, "end": e, "instance": text[s:e].lower(), "seed": seed, "patterns": patterns_before(text, s)}
            for s, e, seed in seen
        ],
    )


def finder():
    """A column function from a text to its base spans and to all places that a pattern may extract."""

    @F.pandas_udf(FOUND)
    def find(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_found(text) for text in texts], columns=["base", "seen"])

    return find


def _occurrences(texts: DataFrame, candidates: DataFrame) -> DataFrame:
    """(pattern, occurrences) of the candidates: how often their one or two words occur one after the other in all texts."""
    hashed = lambda c: F.pmod(F.crc32(c.cast("binary")), F.lit(COUNTED_BITS))
    bits = [r[0] for r in candidates.select(hashed(F.col("pattern")).alias("bit")).distinct().collect()]  # at most COUNTED_BITS
    wanted = np.zeros(COUNTED_BITS, bool)
    wanted[np.array(bits, np.int64)] = True
    sent = texts.sparkSession.sparkContext.broadcast(np.packbits(wanted))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, seen = np.unpackbits(sent.value).view(bool), {}
        counted = lambda pattern: table[zlib.crc32(pattern.encode()) % COUNTED_BITS]
        known: dict[str, bool] = {}
        for batch in batches:
            for text in batch["text"]:
                before = ""
                for word in (text or "").translate(_SHAPE).split():
                    if word not in known:
                        known[word] = bool(counted(word))
                    # Whoever follows two words follows the last of them, so pairs are looked at behind counted words alone.
                    if known[word]:
                        seen[word] = seen.get(word, 0) + 1
                        pair = f"{before} {word}"
                        if counted(pair):
                            seen[pair] = seen.get(pair, 0) + 1
                    before = word
            if len(known) > 500_000:
                known = {}
            if len(seen) > 200_000:
                yield pd.DataFrame({"pattern": list(seen), "n": list(seen.values())})
                seen = {}
        if seen:
            yield pd.DataFrame({"pattern": list(seen), "n": list(seen.values())})

    found = texts.mapInPandas(count, "pattern string, n bigint").groupBy("pattern").agg(F.sum("n").alias("occurrences"))
    return candidates.select("pattern").join(found, "pattern", "left")


def confident_patterns(edges: DataFrame, follows: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(pattern, confidence, support) of the accepted patterns.

    ``edges`` are distinct rows (pattern, instance, seed), ``follows`` the share of a pattern's occurrences that is followed
    by an identifier-like token, for the patterns that can be accepted.
    """
    known = F.when(F.col("seed"), 1.0).otherwise(0.0)
    scored = staged(edges.withColumn("score", known), "edges")
    for round_ in range(settings.rounds):
        patterns = staged(
            scored.groupBy("pattern").agg(
                # One unknown instance is assumed, so that a pattern needs several known ones.
                (F.sum("score") / (F.count("*") + 1)).alias("of_instances"),
                F.count_if(F.col("score") >= settings.least_confidence).alias("support"),
            ).join(follows, "pattern", "left").select(
                "pattern", "support", (F.col("of_instances") * F.coalesce("share", F.lit(0.0))).alias("confidence")
            ),
            "patterns",
        )
        if round_ + 1 < settings.rounds:
            judged = scored.join(patterns, "pattern").groupBy("instance").agg(
                (1 - F.exp(F.sum(F.log1p(-settings.trust * F.col("confidence"))))).alias("likely")
            )
            scored = staged(
                edges.join(judged, "instance").withColumn("score", F.greatest(known, "likely")).drop("likely"), "edges"
            )
    return patterns.filter(
        (F.col("confidence") >= settings.least_confidence) & (F.col("support") >= settings.least_support)
    )


def scanned(docs: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans) for each row, spans being structs (start, rank, kind, end)."""
    rows = numbered(docs.select(F.col(doc_id).alias("doc_id"), finder()(F.col(text)).alias("f")).select("doc_id", "f.*"), "personal")
    places = rows.select("uid", F.explode("seen").alias("p")).select("uid", "p.*")
    each = places.withColumn("pattern", F.explode("patterns"))
    edges = staged(each.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"), F.count("*").alias("places")), "edges")
    # Discovery never makes more instances known than there are, so a pattern needs as many instances, and one seed.
    candidates = staged(
        edges.groupBy("pattern").agg(F.sum("places").alias("places"), F.count_if("seed").alias("seeds"), F.count("*").alias("n"))
        .filter((F.col("seeds") > 0) & (F.col("n") >= settings.least_support)), "candidates",
    )
    texts = docs.select(F.col(text).alias("text"))
    often = candidates.join(_occurrences(texts, candidates), "pattern")
    follows = staged(often.select("pattern", (F.col("places") / F.greatest("places", "occurrences")).alias("share")), "follows")
    accepted = confident_patterns(edges.drop("places"), follows, settings).select("pattern")
    extra = each.filter(~F.col("seed")).join(accepted, "pattern").select("uid", "start", "end").distinct()
    span = F.struct(
        "start", F.lit(len(KINDS) - 1).alias("rank"), F.lit(KINDS[-1]).alias("kind"), "end"
    )
    extra = extra.groupBy("uid").agg(F.collect_list(span).alias("extra"))
    spans = F.when(F.col("extra").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "extra")))
    return rows.select("uid", "doc_id", "base").join(extra, "uid", "left").select("doc_id", spans.alias("spans"))


def digest(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
