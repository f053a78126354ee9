import datetime as dt
import random
from collections import deque

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import throttle
from ledgerlens.plans.oracle import ORACLES
from ledgerlens.plans.queries import QUERIES
from ledgerlens.session import scratch_path
from ledgerlens.streaming import throttle as streaming

START = dt.datetime(2024, 1, 1)


def events(spark, rows):
    stamped = [(i, k, START + dt.timedelta(seconds=s)) for i, (k, s) in enumerate(rows)]
    return spark.createDataFrame(stamped, "event_id long, user_id long, ts timestamp_ntz")


def brute_force(rows, limit, window):
    logs, out = {}, {}
    for s, i, k in sorted((s, i, k) for i, (k, s) in enumerate(rows)):
        log = logs.setdefault(k, deque())
        while log and s - log[0] >= window:
            log.popleft()
        out[i] = len(log) < limit
        if out[i]:
            log.append(s)
    return out


def workload(seed, keys, count, span, hot_share=1 / 3):
    rng = random.Random(seed)
    return [(0 if rng.random() < hot_share else rng.randrange(1, keys), rng.randrange(span)) for _ in range(count)]


@pytest.mark.parametrize(
    "limit,window,span,rows_per_part",
    [(1, 60, 2000, 40), (3, 60, 2000, 40), (5, 30, 20000, 100), (20, 60, 600, 50), (2, 10, 100000, 1000)],
)
def test_many_small_parts_agree_with_brute_force(spark, limit, window, span, rows_per_part):
    rows = workload(limit, 6, 1200, span)
    got = throttle.throttle_events(events(spark, rows), "user_id", "ts", "event_id", limit, window, rows_per_part)
    assert {r.event_id: r.accepted for r in got.collect()} == brute_force(rows, limit, window)


def test_a_key_that_never_pauses(spark):
    rows = [(0, s) for s in range(900)]
    got = throttle.throttle_events(events(spark, rows), "user_id", "ts", "event_id", 7, 60, 50)
    assert {r.event_id: r.accepted for r in got.collect()} == brute_force(rows, 7, 60)


@pytest.mark.parametrize("merged_every", [1, 3, 4096])
def test_passages_tell_what_parts_do(merged_every):
    """Joined in any order, parts make of a log what the limiter makes of it event by event."""
    rng = random.Random(merged_every)
    for _ in range(400):
        limit, window, span = rng.randrange(1, 6), rng.choice([3, 10, 30]), rng.choice([5, 20, 60, 200])
        stamps = sorted(rng.randrange(span) for _ in range(rng.randrange(2, 40)))
        cuts = sorted(rng.sample(range(1, len(stamps)), min(4, len(stamps) - 1)))
        head, *rest = (stamps[a:b] for a, b in zip([0, *cuts], [*cuts, len(stamps)]))
        log = deque()
        throttle.accept(head, log, limit, window)
        told = [throttle.passage(np.array(part), limit, window, merged_every) for part in rest]
        while len(told) > 1:
            k = rng.randrange(len(told) - 1)
            told[k : k + 2] = [told[k].then(told[k + 1], limit, window)]
        got = told[0].after(list(log), limit, window)
        flags = [ok for part in rest for ok in throttle.accept(part, log, limit, window)]
        assert got == (sum(flags), [t for t in log if rest[-1][-1] - t < window])


def test_rounds_grow_with_the_logarithm_of_the_parts(spark):
    """A key that never pauses, in 8 and in 64 parts: three rounds more, a table each."""
    jobs = {}
    for parts in (8, 64):
        rows = [(0, s) for s in range(parts * 25)]
        spark.sparkContext.setJobGroup(f"limiter-{parts}", "")
        got = throttle.throttle_events(events(spark, rows), "user_id", "ts", "event_id", 7, 60, 25)
        assert {r.event_id: r.accepted for r in got.collect()} == brute_force(rows, 7, 60)
        jobs[parts] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"limiter-{parts}"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[64] - jobs[8] <= 3 * 4


def test_null_keys_form_one_group(spark):
    rows = [(None, s) for s in range(0, 300, 7)] + [(4, s) for s in range(0, 300, 11)]
    got = throttle.throttle_events(events(spark, rows), "user_id", "ts", "event_id", 2, 60, 10)
    shifted = [(-1 if k is None else k, s) for k, s in rows]
    assert {r.event_id: r.accepted for r in got.collect()} == brute_force(shifted, 2, 60)


def test_trailing_counts(spark):
    rows = workload(8, 5, 600, 900)
    got = throttle.trailing_counts(events(spark, rows), "user_id", "ts", 60).collect()
    zero = int(START.replace(tzinfo=dt.timezone.utc).timestamp())
    assert len(got) == len(set(rows))
    for r in got:
        s = r.t // 1_000_000 - zero
        assert r.trailing_count == sum(1 for k, x in rows if k == r.user_id and s - 60 < x <= s)
        assert r.requests == rows.count((r.user_id, s))


def delivered(spark, rows, parts):
    """A folder with the rows in so many files, in the order given; and their schema."""
    frame = events(spark, rows)
    folder = scratch_path(spark, "arrivals").removeprefix("file:")
    size = -(-len(rows) // parts)
    for k in range(parts):
        frame.filter(F.col("event_id").between(k * size, k * size + size - 1)).coalesce(1).write.mode("append").parquet(folder)
    return folder, frame.schema


def streamed(spark, folder, schema, delay):
    stream = streaming.read_events(spark, folder, schema, "*.parquet", batch_bytes=1)
    flagged = streaming.throttle_stream(stream, "user_id", "ts", "event_id", 3, 60, delay)
    out = scratch_path(spark, "flagged")
    query = streaming.write_available(flagged, out, scratch_path(spark, "stream"))
    return {r.event_id: (r.accepted, r.late_ms) for r in spark.read.schema(flagged.schema).parquet(out).collect()}, query


def test_stream_out_of_order_agrees_with_batch(spark):
    rng = random.Random(4)
    rows = sorted(workload(3, 4, 300, 3000), key=lambda r: r[1] + rng.randrange(200))
    got, query = streamed(spark, *delivered(spark, rows, 3), "200 seconds")
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    end = max(s for _, s in rows) - 200
    expected = {i: (ok, None) for i, ok in brute_force(rows, 3, 60).items() if rows[i][1] < end}
    assert got == expected and len(got) > 200


def test_idle_keys_leave_the_state_and_late_events_are_kept(spark):
    rows = [(k, k) for k in range(20)] + [(99, 5000)] + [(99, 9000), (3, 10)]
    got, query = streamed(spark, *delivered(spark, rows, 23), "10 seconds")
    # The last event but one waits for the watermark; the one after it is behind a watermark of 5000 or 9000 less the delay.
    assert {i: got[i] for i in range(21)} == {i: (True, None) for i in range(21)} and 21 not in got
    accepted, late = got.pop(22)
    assert accepted is None and late in (8_980_000, 4_980_000) and len(got) == 21
    last = [p for p in query.recentProgress if p["stateOperators"]]
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in last) == 0
    assert last[-1]["stateOperators"][0]["numRowsTotal"] < 10


def test_output_and_late_events_are_the_input(spark):
    rng = random.Random(9)
    rows = sorted(workload(5, 4, 240, 3000), key=lambda r: r[1] + rng.choice([0, 0, 0, 900]))
    rows.append((2, 10**6))  # takes the watermark past all others
    folder, schema = delivered(spark, rows, 12)
    got, _ = streamed(spark, folder, schema, "50 seconds")
    assert sorted(got) == list(range(240))
    late = {i for i, (accepted, ms) in got.items() if ms is not None}
    assert 10 < len(late) < 200 and all(got[i][0] is None and got[i][1] > 0 for i in late)
    timely = [(k if i not in late else -1, s) for i, (k, s) in enumerate(rows)]
    expected = brute_force(timely, 3, 60)
    assert {i: got[i][0] for i in got if i not in late} == {i: expected[i] for i in range(240) if i not in late}


def test_timers_of_the_stream_grow_with_batches(spark):
    rng = random.Random(6)
    rows = sorted(workload(7, 4, 600, 3000), key=lambda r: r[1] + rng.randrange(200))
    rows.append((2, 10**6))  # takes the watermark past all others
    got, query = streamed(spark, *delivered(spark, rows, 4), "200 seconds")
    expected = brute_force(rows, 3, 60)
    assert {i: ok for i, (ok, _) in got.items()} == {i: expected[i] for i in range(600)}
    states = [p["stateOperators"][0]["customMetrics"] for p in query.recentProgress if p["stateOperators"]]
    # For each of four keys and each batch, one for what came and one for what is left.
    assert 0 < sum(m["numRegisteredTimers"] for m in states) <= 4 * 2 * len(states)


def test_null_keys_share_a_log_in_the_stream(spark):
    rows = [(None, s) for s in range(0, 300, 7)] + [(4, s) for s in range(0, 300, 11)] + [(5, 10**6)]
    got, _ = streamed(spark, *delivered(spark, rows, 2), "400 seconds")
    expected = brute_force([(-1 if k is None else k, s) for k, s in rows], 3, 60)
    assert {i: ok for i, (ok, _) in got.items()} == {i: expected[i] for i in range(len(rows) - 1)}


def test_the_stream_query_without_events(spark, small, tmp_path):
    spark.read.parquet(f"{small}/events.parquet").limit(0).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    assert QUERIES["throttle_stream"](spark, str(tmp_path)).collect() == []


def test_the_stream_query_judges_every_event(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{small}/events.parquet'")
    expected = sorted(con.execute(ORACLES["throttle_sliding_log"]).fetchall())
    got = sorted((r.event_id, r.user_id, r.accepted) for r in QUERIES["throttle_stream"](spark, small).collect())
    assert got == expected and len(got) == 1000
