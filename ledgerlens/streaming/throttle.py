"""The sliding-log limiter over a stream: the state of a key is the accepted stamps that still count."""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from ledgerlens.operators.throttle import MICROS, accept


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Events of a group are stored in lists of at most so many.
CHUNK = 50_000


def _order(event: tuple) -> tuple:
    _, t, tie = event
    return t, tie is not None, tie


class SlidingLog(StatefulProcessor):
    """Accept events of one key while fewer than ``limit`` accepted ones are younger than the window.

    The state is that of a group of keys, since a call for each key would take longer than its events; every key has its own
    log. Events wait until the watermark has passed them, so that every earlier one has arrived, and are then judged in time
    order, all that are due in one call. One that arrives when the watermark has passed it is handed on as late, with how far
    behind it is. A timer lies on the first moment that has an event waiting, and where none waits on the moment the last log
    runs out. Each call drops the logs that have run out, and so their keys; without any the group leaves the state.
    """

    def __init__(self, limit: int, window: int, key: str, tie: str):
        self.limit = limit
        self.window = window
        self.key = key
        self.tie = tie

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.logs = handle.getValueState("logs", f"keys array<{self.key}>, stamps array<long>")
        self.waiting = handle.getListState("waiting", f"keys array<{self.key}>, t array<long>, ties array<{self.tie}>")

    def wait(self, events: list[tuple]) -> None:
        for start in range(0, len(events), CHUNK):
            self.waiting.appendValue(tuple(map(list, zip(*events[start : start + CHUNK], strict=True))))
        self.handle.registerTimer(min(t for _, t, _ in events) // 1000)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        watermark, timely = timerValues.getCurrentWatermarkInMs(), []
        for row in rows:
            if row.t is None:
                continue
            behind = watermark - row.t // 1000
            if behind > 0:
                yield Row(key=row.key, t=row.t, tie=row.tie, accepted=None, late_ms=behind)
            else:
                timely.append((row.key, row.t, row.tie))
        if timely:
            self.wait(timely)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = max(expiredTimerInfo.getExpiryTimeInMs() + 1, timerValues.getCurrentWatermarkInMs())
        due, left = [], []
        for chunk in self.waiting.get():
            for event in zip(*chunk, strict=True):
                (due if event[1] // 1000 < passed else left).append(event)
        if left and not due:
            return  # an earlier call judged what this timer was set for, and another is set for the rest
        logs, events = defaultdict(deque), defaultdict(list)
        for k, stamp in zip(*(self.logs.get() or ((), ())), strict=True):
            logs[k].append(stamp)
        for event in sorted(due, key=_order):
            events[event[0]].append(event)
        flags = {k: accept([t for _, t, _ in own], logs[k], self.limit, self.window) for k, own in events.items()}
        ends = {k: (log[-1] + self.window) // 1000 for k, log in logs.items() if log}
        kept = [(k, stamp) for k, end in ends.items() if end >= passed for stamp in logs[k]]
        if kept:
            self.logs.update(tuple(map(list, zip(*kept, strict=True))))
        else:
            self.logs.clear()
        self.waiting.clear()
        if left:
            self.wait(left)
        elif kept:
            self.handle.registerTimer(max(ends.values()))
        for k, own in events.items():
            for (_, t, tie), accepted in zip(own, flags[k], strict=True):
                yield Row(key=k, t=t, tie=tie, accepted=accepted, late_ms=None)

    def close(self) -> None:
        pass


def throttle_stream(
    events: DataFrame, key: str, ts: str, tie: str, limit: int = 20, window_s: int = 60, delay: str = "1 minute", groups: int = 1024
) -> DataFrame:
    """Flag every event of a stream once the watermark, ``delay`` behind the newest event, has passed it.

    The answer is that of the batch limiter however events are split and ordered within the delay. An event that arrives
    behind the watermark is not judged and not dropped either: its row has no ``accepted``, and in ``late_ms`` how far behind
    it was. So the rows that come out, and those still waiting for the watermark, are the rows that went in. Idle keys leave
    the state. Keys share the state of ``groups`` groups, a number that stays with a checkpoint. The session must use the
    RocksDB state store.
    """
    moment = F.col(ts).cast("timestamp")
    shaped = events.select(
        F.col(key).alias("key"), F.unix_micros(moment).alias("t"), F.col(tie).alias("tie"), moment.alias("at")
    ).withWatermark("at", delay)
    group = F.pmod(F.xxhash64("key"), F.lit(groups)).alias("group")
    shaped = shaped.select(group, "key", "t", "tie")  # without the time itself, the engine lets late rows through
    kinds = {f.name: f.dataType.simpleString() for f in shaped.schema}
    flagged = shaped.groupBy("group").transformWithState(
        statefulProcessor=SlidingLog(limit, window_s * MICROS, kinds["key"], kinds["tie"]),
        outputStructType=f"key {kinds['key']}, t long, tie {kinds['tie']}, accepted boolean, late_ms long",
        outputMode="Append",
        timeMode="EventTime",
    )
    return flagged.withColumnsRenamed({"key": key, "tie": tie})


def read_events(
    spark: SparkSession, folder: str, schema: StructType, pattern: str, batch_bytes: int = 256 << 20, batch_files: int | None = None
) -> DataFrame:
    """Parquet files of a folder as a stream whose micro-batches are bounded in bytes, or in files where that is given."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    bound = ("maxBytesPerTrigger", batch_bytes) if batch_files is None else ("maxFilesPerTrigger", batch_files)
    return reader.option(bound[0], str(bound[1])).parquet(folder)


def write_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is there, append it to Parquet and stop. A restart continues where the checkpoint ends.

    Late events are in a folder of their own, ``is_late=true``, so either table can be read alone.
    """
    conf, name = stream.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name, None)
    conf.set(name, ROCKSDB)
    try:
        query = (
            stream.withColumn("is_late", F.col("late_ms").isNotNull()).writeStream.format("parquet").partitionBy("is_late")
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start(path)
        )
        query.awaitTermination()
    finally:
        conf.set(name, before) if before else conf.unset(name)
    return query
