"""Streams over the events table: written in waves, read in batches, stopped on the way and started again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.storage import shared_folder
from ..streaming import jobs

#: Waves that the events arrive in; each holds its share of the time, so a row is at most a wave late.
WAVES = 5
#: Batches that the files of a start are read in, about.
BATCHES = 4
EVENTS = "job_id string, event_id long, at timestamp, status string"


def _arrived(spark: SparkSession, sf_dir: str, folder: str, waves: range) -> int:
    """Write the waves of events to a folder as files, in order; the length of a wave in seconds."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").where("ts IS NOT NULL").select(F.col("user_id").cast("string").alias("job_id"), "event_id", F.col("ts").cast("timestamp").alias("at"), F.col("event_type").alias("status"))
    first, last = events.agg(F.min(F.unix_micros("at")), F.max(F.unix_micros("at"))).first()
    if first is None:
        return 1
    span = (last - first) // WAVES + 1
    for wave in waves:
        events.where(F.floor((F.unix_micros("at") - first) / span) == wave).write.mode("append").parquet(folder)
    if waves.stop == WAVES:  # one row long after all others moves the watermark past them
        spark.range(1).select(F.lit(None).cast("string").alias("job_id"), F.lit(-1).cast("long").alias("event_id"), F.timestamp_micros(F.lit(last + 3 * span)).alias("at"), F.lit(None).cast("string").alias("status")).write.mode("append").parquet(folder)
    return span // 1_000_000 + 1


def event_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event of a user with the type of the one before, by a stream that is stopped half way and started again."""
    folder = shared_folder(spark)
    source, out, checkpoint = (f"{folder}/{x}" for x in ("source", "out", "checkpoint"))
    late = _arrived(spark, sf_dir, source, range(WAVES - 2))
    with jobs.stateful(spark):
        for waves in (range(0), range(WAVES - 2, WAVES)):
            if waves:
                _arrived(spark, sf_dir, source, waves)
            # A share of the files a batch: batches have a cost of their own, so their number must not grow with the files.
            files = len(spark.read.schema(EVENTS).parquet(source).inputFiles())
            stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", max(2, -(-files // BATCHES))).parquet(source)
            jobs.append(jobs.checked_transitions(stream, f"{late} seconds", None), out, checkpoint, None if waves else 2)
    steps, arrived = spark.read.schema(jobs.STEPS).parquet(out), spark.read.schema(EVENTS).parquet(source)
    if steps.count() != arrived.count() - 1:  # all but the row that moves the watermark
        raise RuntimeError("the stream has dropped events as late, or was stopped before its end")
    return steps.where("job_id IS NOT NULL").select("job_id", "event_id", "before", "status")


SQL = {
    "event_steps": "SELECT user_id::VARCHAR AS job_id, event_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before, event_type AS status FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL",
}

QUERIES = {f.__name__: f for f in (event_steps,)}
