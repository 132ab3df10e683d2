"""Streams: an event log read as it grows, windows over it with late data, the job state machine as state that survives a restart."""

from __future__ import annotations

import contextlib
import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.workflow import TRANSITIONS

#: State that processors keep is stored in RocksDB, beside the checkpoint.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Microseconds of an event without a time: before all others.
NEVER = -(2**63)
STEPS = "job_id string, event_id long, at timestamp, before string, status string, allowed boolean"


def event_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A folder of JSON lines as a stream; lines that do not parse come in column corrupt."""
    return spark.readStream.schema(f"{schema}, corrupt string").option("columnNameOfCorruptRecord", "corrupt").json(path)


def windowed_counts(events: DataFrame, at: str, kind: str, window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """(start, kind, n, total) by window; rows later than the watermark are dropped, state is bounded by it."""
    rows = events.withWatermark(at, late).groupBy(F.window(at, window), kind).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return rows.select(F.col("window.start").alias("start"), kind, "n", "total")


class Steps(StatefulProcessor):
    """Of each job the last status, and the events that the watermark has not passed; a timer stands at the earliest of them.

    Events wait until none before them can come any more, so steps are judged in order of time whatever batch brings them.
    """

    def __init__(self, allowed: dict[str, list[str]] | None):
        self.allowed = allowed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "status string")
        self.waiting = handle.getListState("waiting", "at long, event_id long, status string")
        self.timer = handle.getValueState("timer", "at long")

    def _set(self, at: int) -> None:
        held = self.timer.get()[0] if self.timer.exists() else None
        if held is None or at < held:
            if held is not None:
                self.handle.deleteTimer(held)
            self.handle.registerTimer(at)
            self.timer.update((at,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = []
        for batch in rows:
            new += zip(batch["micros"].tolist(), batch["event_id"].tolist(), batch["status"].tolist(), strict=True)
        self.waiting.appendList([(int(a), int(e), s) for a, e, s in new])
        self._set(min(a for a, _, _ in new) // 1000 + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        held = sorted((tuple(x) for x in self.waiting.get()), key=lambda x: x[:2])
        ready = [x for x in held if x[0] // 1000 < passed]
        rest = held[len(ready) :]
        before, out = self.last.get()[0] if self.last.exists() else None, []
        for at, event, status in ready:
            allowed = self.allowed is None or before is None or status in self.allowed.get(before, [])
            out.append((key[0], event, at, before, status, allowed))
            before = status if allowed else before
        if out:
            self.last.update((before,))
        self.timer.clear()
        if rest:
            self.waiting.put(rest)
            self._set(rest[0][0] // 1000 + 1)
        else:
            self.waiting.clear()
        if out:
            yield pd.DataFrame(out, columns=["job_id", "event_id", "at", "before", "status", "allowed"])

    def close(self) -> None:
        pass


def checked_transitions(events: DataFrame, late: str = "1 hour", transitions: dict[str, list[str]] | None = TRANSITIONS) -> DataFrame:
    """Each step (job_id string, event_id long, at, status) of a stream with the state before it and whether it was allowed.

    Refused steps do not move the job; transitions None allows all. Steps of a job come in order of at, then event_id, once
    the watermark is past them; events that come later than `late` behind the latest are dropped. The session's state store
    must be RocksDB (see stateful).
    """
    rows = events.select(F.col("job_id").cast("string").alias("job_id"), F.col("event_id").cast("long").alias("event_id"), "at", "status").withWatermark("at", late)
    # Time goes in and out as microseconds: pandas is given timestamps in the session's time zone, the watermark is none of it.
    rows = rows.withColumn("micros", F.coalesce(F.unix_micros("at"), F.lit(NEVER)))
    steps = rows.groupBy("job_id").transformWithStateInPandas(Steps(transitions), STEPS.replace("at timestamp", "at long"), "Append", "EventTime")
    return steps.withColumn("at", F.timestamp_micros(F.nullif("at", F.lit(NEVER))))


@contextlib.contextmanager
def stateful(spark: SparkSession):
    """The session's state store set to the one that processors need, and back."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, PROVIDER)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def append(rows: DataFrame, path: str, checkpoint: str, stop_after: int | None = None, limit: float | None = None) -> int:
    """Append a stream to a folder of Parquet files until what its source holds is read, or stop it before that once so many
    batches are through.

    Started again with the same checkpoint it goes on where it was: offsets, state, timers and the sink's log agree on batches,
    so each row is there once. A stream that fails, or is not through after `limit` seconds (None: however long it takes),
    raises and is stopped, so that part of a result is never taken for the whole. Gives the number of the last batch that is
    through, -1 if there is none.
    """
    began = time.monotonic()
    query = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        while not query.awaitTermination(0.05):  # raises what the stream failed with
            if stop_after is not None and (done := query.lastProgress) and done["batchId"] + 1 >= stop_after:
                break
            if limit is not None and time.monotonic() - began > limit:
                raise TimeoutError(f"the stream to {path} was not through after {limit} seconds")
    finally:
        query.stop()
    if failed := query.exception():
        raise failed
    return query.lastProgress["batchId"] if query.lastProgress else -1


def append_events(events: DataFrame, path: str, checkpoint: str):
    """Start appending a stream to a folder of Parquet files, each row once: the sink's log and the checkpoint agree on batches."""
    return events.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
