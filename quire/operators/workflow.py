"""Jobs: transitions, latest states, buckets, reconciliation with an index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T

#: The state machine.
TRANSITIONS = {
    "candidate": ["parsing"], "parsing": ["planned", "failed_parse", "failed"], "planned": ["repairing", "returned", "failed"], "repairing": ["repaired", "planned", "failed"],
    "repaired": ["admitted", "planned", "failed"], "admitted": ["scanning", "failed"], "scanning": ["extracting", "failed"], "extracting": ["indexed", "failed"],
    "failed_parse": [], "indexed": [], "returned": [], "failed": ["planned"],
}
TERMINAL = ["indexed", "returned", "failed_parse", "failed"]
ACTIVE = ["parsing", "repairing", "repaired", "admitted", "scanning", "extracting"]
EXTRACTING = ["admitted", "scanning", "extracting"]
OWNED = [*EXTRACTING, "indexed"]
FLIP, KEEP, SKIP = "翻牌", "留著", "不管"


def is_allowed(before: Column, after: Column) -> Column:
    edges = [f"{a}>{b}" for a, bs in TRANSITIONS.items() for b in bs]
    return F.concat(before, F.lit(">"), after).isin(edges)


def bad_transitions(history: DataFrame) -> DataFrame:
    """(job_id, at, before, status) of steps that the state machine forbids. history: (job_id, at, status)."""
    rows = history.withColumn("before", F.lag("status").over(W.partitionBy("job_id").orderBy("at")))
    return rows.where(F.col("before").isNotNull() & ~is_allowed(F.col("before"), F.col("status"))).select("job_id", "at", "before", "status")


def latest_per_document(jobs: DataFrame) -> DataFrame:
    """The job of each file that was updated last; of equals the later row."""
    return jobs.groupBy("filename").agg(F.max_by(F.struct("job_id", "status", "updated_at"), F.struct("updated_at", "pos")).alias("j")).select("filename", "j.*")


def section(status: Column, index_status: Column) -> Column:
    """Where a job is shown; of indexed jobs the index has the last word."""
    indexed = F.when(index_status.isNull() | (index_status == "processed"), "completed").when(index_status == "failed", "failed").otherwise("in_progress")
    return (
        F.when(status == "candidate", "selection")
        .when(status == "parsing", "parsing")
        .when(status == "planned", "review")
        .when(status.isin("repairing", "repaired", *EXTRACTING), "in_progress")
        .when(status == "returned", "skipped")
        .when(status.isin("failed_parse", "failed"), "failed")
        .when(status == "indexed", indexed)
    )


def console(jobs: DataFrame) -> DataFrame:
    """(section, n, filename) of jobs (filename, status, index_status): a row for each job, with the size of its section. No list
    of names stands in one row, as a section may hold most jobs."""
    rows = jobs.select("filename", section(F.col("status"), F.col("index_status")).alias("section"))
    sizes = rows.groupBy("section").agg(F.count("*").alias("n"))  # at most as many rows as sections
    return rows.join(F.broadcast(sizes), "section").select("section", "n", "filename")


def pending_by_reason(jobs: DataFrame) -> DataFrame:
    """(reason, n) of what waits for a person: plans that are not clean by each of their reasons, failures by their kind."""
    given = F.coalesce("reasons", F.array().cast("array<string>"))
    reasons = F.when((F.col("status") == "planned") & ~F.col("decision").eqNullSafe("clean"), given).when(F.col("status") == "failed_parse", F.array(F.lit("解析失敗"))).when(F.col("status") == "failed", F.array(F.lit("工作失敗")))
    return jobs.select("job_id", F.explode(reasons).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def convergence(events: DataFrame, processed: int) -> DataFrame:
    """One row: kinds of events so far, how many events, and how many documents were processed since the last one by created_at."""
    kind = T.event_kind(F.col("reason"))
    last = F.max_by("processed_index", "created_at")
    return events.agg(F.array_sort(F.collect_set(F.when(kind != "", kind))).alias("kinds"), F.count("*").alias("occurrences"), F.greatest(F.lit(0), processed - last).alias("distance"))


def decide(job_status: Column, index_status: Column, verify_ok: Column) -> Column:
    """Whether a failed job whose document the index holds is to be turned."""
    return F.when(job_status != "failed", SKIP).when(index_status.isNull() | (F.lower(index_status) != "processed") | ~verify_ok, KEEP).otherwise(FLIP)


def recover(jobs: DataFrame, index: DataFrame | None) -> DataFrame:
    """(job_id, status, recovered, action) of jobs in flight after a restart, by what the index says.

    Jobs that never touched the index are queued again as they are. Of the others those it has processed are indexed, those it
    still works on wait, and those it does not know have failed. Without an answer from the index (None) nothing is guessed.
    """
    rows = jobs.where(F.col("status").isin(ACTIVE))
    early = F.col("status").isin("parsing", "repairing", "repaired")
    if index is None:
        return rows.select("job_id", "status", F.col("status").alias("recovered"), F.when(early, "queue").otherwise("ask").alias("action"))
    rows = rows.join(index, "filename", "left")
    known = F.lower(F.coalesce("index_status", F.lit("")))
    new = F.when(early, F.col("status")).when(known == "processed", "indexed").when(known.isin("processing", "pending"), F.col("status")).otherwise("failed")
    action = F.when(early, "queue").when(known == "processed", "done").when(known.isin("processing", "pending"), "wait").otherwise("failed")
    return rows.select("job_id", "status", new.alias("recovered"), action.alias("action"))


def foreign_documents(index: DataFrame, jobs: DataFrame) -> DataFrame:
    return index.join(jobs.where(F.col("status").isin(OWNED)).select("filename"), "filename", "left_anti")


def round_can_start(jobs: DataFrame) -> DataFrame:
    """(job_id, blocked) of the jobs that wait for the batch: blocked while any is parsing or extracting."""
    busy = jobs.agg((F.count_if(F.col("status").isin("parsing", *EXTRACTING)) > 0).alias("blocked"))  # one row
    return jobs.where("status = 'planned'").select("job_id").crossJoin(F.broadcast(busy))


def stale(reports: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """(name, at, stale) of the latest report of each name; at is ISO-8601 text."""
    last = reports.groupBy("name").agg(F.max(F.to_timestamp("at")).alias("at"))
    return last.withColumn("stale", F.col("at") < now - F.expr(f"INTERVAL {hours} HOURS"))


def changed_files(files: DataFrame, cache: DataFrame) -> DataFrame:
    """Files whose path, length and time the cache does not know: what must be hashed or planned again."""
    return files.join(cache, ["path", "length", "modified"], "left_anti")


def shared_families(voters: DataFrame) -> DataFrame:
    """Families of models with more than one voter: votes that would not be independent."""
    return voters.groupBy("family").agg(F.count("*").alias("n")).where("n > 1")
