"""Request throttling: which events a sliding-log limiter accepts."""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.ranked import PART, ordered_parts, running_totals
from ledgerlens.session import staged

MICROS = 1_000_000


def trailing_counts(df: DataFrame, key: str, ts: str, window_s: int) -> DataFrame:
    """Events of a key in the window that ends at each of its timestamps, itself included.

    One row per key and timestamp. The count is the difference of two running totals: events up to the timestamp less
    events up to the window's start. Both are read off one ordered pass, so a busy key spreads over many tasks.
    """
    stamped = df.groupBy(F.col(key), F.unix_micros(F.col(ts).cast("timestamp")).alias("t")).agg(
        F.count("*").alias("n")
    )
    # The window's start sorts after events at that very moment, which have aged out.
    marks = F.explode(
        F.array(
            F.struct(F.col("t").alias("at"), F.lit(0).alias("is_start"), F.col("n").alias("add")),
            F.struct((F.col("t") - window_s * MICROS).alias("at"), F.lit(1).alias("is_start"), F.lit(0).cast("long").alias("add")),
        )
    )
    timeline = stamped.select(key, "t", "n", marks.alias("m")).select(key, "t", "n", "m.*")
    counted = running_totals(timeline, [F.col(key), F.col("at"), F.col("is_start"), F.col("t")], {"so_far": "add"})
    signed = F.when(F.col("is_start") == 0, F.col("so_far")).otherwise(-F.col("so_far"))
    return counted.groupBy(key, "t").agg(
        F.max("n").alias("requests"), F.sum(signed).cast("long").alias("trailing_count")
    )


def accept(stamps: list[int], log: deque, limit: int, window: int) -> list[bool]:
    """Run the limiter over ordered stamps. ``log`` holds the accepted stamps that still count, and is updated."""
    accepted = []
    for t in stamps:
        while log and t - log[0] >= window:
            log.popleft()
        accepted.append(len(log) < limit)
        if accepted[-1]:
            log.append(t)
    return accepted


def flag_part(rows: pd.DataFrame, entry: list[int], limit: int, window: int) -> tuple[pd.DataFrame, list[int]]:
    """Flag one ordered part whose first key starts with the log ``entry``; also return the log its last key ends with.

    Keys that never come close to the limit are accepted as a whole; only the others are walked event by event.
    """
    rows = rows.sort_values(["key", "t", "tie"], na_position="first", ignore_index=True)
    codes = pd.Series(pd.factorize(rows["key"], use_na_sentinel=False)[0])
    stamps = rows["t"]
    crowded = (codes == codes.shift(limit)) & (stamps - stamps.shift(limit) < window)
    to_walk = set(codes[crowded]) | ({0} if entry else set())

    flags = np.ones(len(rows), dtype=bool)
    last = int(codes.iloc[-1])
    own = stamps[codes == last].tolist()
    log = [t for t in own[-limit:] if own[-1] - t < window]
    for code in sorted(to_walk):
        start, stop = np.searchsorted(codes, [code, code + 1])
        running = deque(entry if code == 0 else ())
        flags[start:stop] = accept(stamps[start:stop].tolist(), running, limit, window)
        if code == last:
            log = list(running)
    return rows.assign(accepted=flags), log


# --- What a part does to the log it is entered with ---
#
# The number A(i) of accepted events up to the i-th is the lesser of A(i - 1) + 1 and A(p) + limit, p being the events that
# have left the window by then. So it is a shortest path: one step on costs 1, a jump over a window costs the limit. Paths
# through a part leave the log at its beginning, or where one of the log's stamps expires; from there on they are those of
# a limiter that starts empty. So a part is told by the runs of empty limiters from every stamp of its first window.


@dataclass(frozen=True)
class Passage:
    """For each row a run of an empty limiter over the events from a stamp on: how many it accepts, and the log it ends with."""

    starts: list[int]
    counts: list[int]
    logs: list[list[int]]
    last: int

    def after(self, entry: list[int], limit: int, window: int) -> tuple[int, list[int]]:
        """How many events are accepted after the log ``entry``, and the log they leave."""
        runs = [(0, 0)] + [(limit - len(entry) + c, bisect_left(self.starts, t + window)) for c, t in enumerate(entry)]
        paths = {row: cost for cost, row in sorted(runs, reverse=True)}.items()
        left = lambda row, t: len(self.logs[row]) - bisect_right(self.logs[row], t)
        before = min(cost + self.counts[row] - len(self.logs[row]) for row, cost in paths)
        log = [t for t in entry if self.last - t < window]
        for t in sorted({t for row, _ in paths for t in self.logs[row]}):
            now = min(cost + self.counts[row] - left(row, t) for row, cost in paths)
            log += [t] * (now - before)
            before = now
        return min(cost + self.counts[row] for row, cost in paths), log

    def then(self, other: Passage, limit: int, window: int) -> Passage:
        """This part and the next one as one."""
        known = {log: other.after(list(log), limit, window) for log in set(map(tuple, self.logs))}
        ends = [known[tuple(log)] for log in self.logs]
        starts, counts, logs = self.starts, [n + more for n, (more, _) in zip(self.counts, ends, strict=True)], [log for _, log in ends]
        if starts[-1] == BEYOND:  # the first window goes on in the next part
            rows = slice(bisect_left(other.starts, starts[0] + window) + 1)
            starts, counts, logs = starts[:-1] + other.starts[rows], counts[:-1] + other.counts[rows], logs[:-1] + other.logs[rows]
        return Passage(starts, counts, logs, other.last)


#: Events after which runs that have come to the same state go on as one.
MERGED_EVERY = 4096
BEYOND = (1 << 63) - 1


def passage(stamps: np.ndarray, limit: int, window: int, merged_every: int = MERGED_EVERY) -> Passage:
    """The runs through one ordered part, all at once.

    A run is a ring of the events at which its accepted ones expire, and their stamps. It accepts the first event that is
    neither before the oldest of these nor taken yet. Where events are dense, a run accepts few of them; where they are not,
    runs soon come to the same state and go on as one.
    """
    n, expiry = len(stamps), np.searchsorted(stamps, stamps + window)
    first = np.flatnonzero(np.diff(stamps[: np.searchsorted(stamps, stamps[0] + window)], prepend=stamps[0] - 1))
    beyond = int(np.searchsorted(stamps, stamps[0] + window))
    starts = np.append(first, beyond)
    ready, taken = np.zeros((len(starts), limit), np.int64), np.full((len(starts), limit), -1, np.int64)
    head, at, count = np.zeros(len(starts), np.int64), starts.copy(), np.zeros(len(starts), np.int64)
    state_of, before = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    for end in [*range(merged_every, n, merged_every), n]:
        while True:
            event = np.maximum(ready[np.arange(len(at)), head], at)
            run = np.flatnonzero(event < end)
            if not len(run):
                break
            event, place = event[run], head[run]
            ready[run, place], taken[run, place] = expiry[event], event
            head[run], at[run] = (place + 1) % limit, event + 1
            count[run] += 1
        at = np.maximum(at, end)
        # From here on a run depends on what is still to expire, and the next part on the stamps that do not expire here.
        order = (head[:, None] + np.arange(limit)) % limit
        waiting, held = np.take_along_axis(ready, order, 1), np.take_along_axis(taken, order, 1)
        kept = np.where(waiting == n, stamps[held], stamps[0] - 1)
        _, some, same = np.unique(np.concatenate([np.maximum(waiting, end), kept, at[:, None]], axis=1), axis=0, return_index=True, return_inverse=True)
        if len(some) < len(at):
            same = same.reshape(-1)
            before += (count - count[some][same])[state_of]
            state_of = same[state_of]
            ready, taken, head, at, count = ready[some], taken[some], head[some], at[some], count[some]
    logs = [sorted(int(stamps[e]) for e in row if e >= 0 and stamps[-1] - stamps[e] < window) for row in taken.tolist()]
    from_t = [*stamps[first].tolist(), int(stamps[beyond]) if beyond < n else BEYOND]
    return Passage(from_t, (before + count[state_of]).tolist(), [logs[k] for k in state_of.tolist()], int(stamps[-1]))


# --- All parts ---

PASSAGE = "starts array<long>, counts array<long>, logs array<array<long>>, last long"


def _bounds(events: DataFrame) -> DataFrame:
    """One row for each part, numbered in order: whether it begins inside a key, ends inside one, and lies inside one.

    ``place`` counts the parts that lie inside a key, from the one that the key begins in, which has 0.
    """
    ends = events.groupBy(PART).agg(
        F.min(F.struct("key", "t")).alias("first"), F.max(F.struct("key", "t")).alias("end"),
    )
    order = Window.orderBy(PART)
    numbered = ends.select(
        PART, F.col("first.key").alias("first_key"), F.col("end.key").alias("last_key"), F.row_number().over(order).alias("nr"),
        (F.lag(F.lit(True)).over(order) & F.lag("end.key").over(order).eqNullSafe(F.col("first.key"))).alias("continued"),
        (F.lead(F.lit(True)).over(order) & F.lead("first.key").over(order).eqNullSafe(F.col("end.key"))).alias("feeds"),
    ).fillna(False, ["continued", "feeds"])
    inside = F.col("continued") & F.col("feeds") & F.col("first_key").eqNullSafe(F.col("last_key"))
    head = F.last(F.when(F.col("feeds") & ~inside, F.col("nr")), ignorenulls=True).over(Window.orderBy("nr"))
    place = F.when(inside, F.col("nr") - head).when(F.col("feeds"), F.lit(0))
    return staged(numbered.withColumn("place", place), "bounds")


def _passages(events: DataFrame, bounds: DataFrame, limit: int, window: int) -> DataFrame:
    """(nr, place, passage) of every part that ends inside a key; where the key begins in it, the log it ends with."""
    last = F.broadcast(bounds.filter("feeds").select(F.col(PART).alias("part"), "nr", "place", "last_key"))  # a row for a part
    tails = events.join(last, (F.col(PART) == F.col("part")) & F.col("key").eqNullSafe(F.col("last_key")))

    def told(rows: pd.DataFrame) -> pd.DataFrame:
        stamps, place = np.sort(rows["t"].to_numpy(np.int64)), int(rows["place"].iloc[0])
        if place:
            found = passage(stamps, limit, window)
        else:
            found = Passage([int(stamps[0])], [0], [flag_part(rows, [], limit, window)[1]], int(stamps[-1]))
        return pd.DataFrame([(int(rows["nr"].iloc[0]), place, found.starts, found.counts, found.logs, found.last)])

    return tails.groupBy("part").applyInPandas(told, f"nr int, place int, {PASSAGE}")


def _exits(passages: DataFrame, longest: int, limit: int, window: int) -> DataFrame:
    """(nr, log): what each part that ends inside a key ends with.

    Each round joins every part with the one as far before it as the parts that it tells already, so after the logarithm of
    the longest chain all are told from the part that their key begins in, which has one row.
    """

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = lambda starts, counts, logs, last: Passage(list(starts), list(counts), [list(log) for log in logs], int(last))
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                both = read(r.b_starts, r.b_counts, r.b_logs, r.b_last).then(read(r.starts, r.counts, r.logs, r.last), limit, window)
                rows.append((r.nr, r.place, both.starts, both.counts, both.logs, both.last))
            yield pd.DataFrame(rows, columns=["nr", "place", "starts", "counts", "logs", "last"])

    told, reach = staged(passages, "passages"), 1
    while reach <= longest:
        before = told.select((F.col("nr") + reach).alias("nr"), *[F.col(c).alias(f"b_{c}") for c in ("starts", "counts", "logs", "last")])
        longer = told.filter(F.col("place") >= reach).join(before, "nr").mapInPandas(joined, f"nr int, place int, {PASSAGE}")
        told = staged(told.filter(F.col("place") < reach).unionByName(longer), "passages")
        reach *= 2
    return told.select("nr", F.col("logs")[0].alias("log"))


def throttle_events(
    df: DataFrame, key: str, ts: str, tie: str, limit: int = 20, window_s: int = 60, rows_per_part: int = 1_000_000
) -> DataFrame:
    """Flag every event: accepted while fewer than ``limit`` accepted events of its key are younger than the window.

    Rejected events do not count, so each decision depends on earlier ones. Events are cut into ordered parts of
    bounded size, however busy a key is. A part that begins in the middle of a key needs the log the part before it ended
    with. What a part makes of any log is found for all parts at once and then joined pairwise, so a key that never pauses
    takes rounds in the logarithm of its parts; logs stay in tables. ``tie`` is a unique column that orders equal timestamps.
    """
    window, parts = window_s * MICROS, max(1, math.ceil(df.count() / rows_per_part))
    events = ordered_parts(
        df.select(
            F.col(key).alias("key"), F.unix_micros(F.col(ts).cast("timestamp")).alias("t"), F.col(tie).alias("tie")
        ),
        [F.col("key"), F.col("t"), F.col("tie")],
        parts,
    )
    key_type = events.schema["key"].dataType.simpleString()
    tie_type = events.schema["tie"].dataType.simpleString()
    flagged_type = f"key {key_type}, t long, tie {tie_type}, accepted boolean"

    def flag(rows: pd.DataFrame, entry: pd.DataFrame | None = None) -> pd.DataFrame:
        log = [int(x) for x in entry["log"].iloc[0]] if entry is not None and len(entry) else []
        flagged, _ = flag_part(rows, log, limit, window)
        return flagged[["key", "t", "tie", "accepted"]]

    if parts == 1:
        out = events.groupBy(PART).applyInPandas(lambda rows: flag(rows), flagged_type)
    else:
        entries = _entries(events, limit, window).groupBy(PART)
        out = events.groupBy(PART).cogroup(entries).applyInPandas(flag, flagged_type)
    return out.select(F.col("key").alias(key), F.col("t"), F.col("tie").alias(tie), "accepted")


def _entries(events: DataFrame, limit: int, window: int) -> DataFrame:
    """(part, log): the log that each part which begins inside a key is entered with."""
    bounds = _bounds(events)
    longest = bounds.agg(F.max("place")).first()[0] or 0
    exits = _exits(_passages(events, bounds, limit, window), longest, limit, window)
    return exits.select((F.col("nr") + 1).alias("nr"), "log").join(bounds.select(PART, "nr"), "nr").select(PART, "log")
