"""Ledgers and levels: gate records, summaries, alarm levels, plan evaluation, findings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T
from ..plans.storage import BROADCAST_ROWS, ranked, settled

#: Gates, and the checks whose failures only warn.
GATES = ["parse.coverage", "parse.checks", "pp.preflight", "pp.tables", "pp.equations", "extract.grounding", "extract.format", "retrieval.smoke"]
WARNING_CHECKS, UNVERIFIED_ON_3 = ["parse", "coverage"], ["tests", "drill", "canary"]
KNOWN_CHECKS = ["compat", "canary", "scan", "parse", "coverage", "units", "deploy", "fresh", "tests", "drill"]
MAX_PAGES, MAX_ITEMS, MAX_POINTS = 100_000, 1_000_000, 10_000.0


def gate_cells(ledger: DataFrame) -> DataFrame:
    """Nested gates as rows (doc, gate, state, value, threshold, note, at)."""
    return ledger.select("doc", F.explode("gates").alias("gate", "g")).select("doc", "gate", "g.state", "g.value", "g.threshold", "g.note", "g.at")


def invalid_records(records: DataFrame) -> DataFrame:
    """Records with an unknown gate or state, or unverifiable without a note."""
    why = F.when(~F.col("gate").isin(GATES), "gate").when(~F.col("state").isin(P.STATES), "state").when((F.col("state") == "unverifiable") & T.is_blank(F.col("note")), "note")
    return records.withColumn("why", why).where("why IS NOT NULL")


def latest(records: DataFrame) -> DataFrame:
    """The last record of each cell by at, with the state of the record before it where that differs.

    records: append-only (doc, gate, state, …, at). One window over each cell finds both.
    """
    w = W.partitionBy("doc", "gate").orderBy("at")
    before = F.lag("state").over(w)
    rows = records.withColumns({"previous": F.when(before != F.col("state"), before), "r": F.row_number().over(W.partitionBy("doc", "gate").orderBy(F.desc("at")))})
    return rows.where("r = 1").drop("r")


def summary(cells: DataFrame, docs: DataFrame) -> DataFrame:
    """Documents by gates, null for unset."""
    return docs.join(cells, "doc", "left").groupBy("doc").pivot("gate", GATES).agg(F.first("state"))


def tally(cells: DataFrame, docs: DataFrame) -> DataFrame:
    """(state, n) over all documents and gates; unset cells count too."""
    grid = docs.select("doc", F.explode(F.array(*map(F.lit, GATES))).alias("gate"))
    return grid.join(cells, ["doc", "gate"], "left").groupBy(F.coalesce("state", F.lit("unset")).alias("state")).agg(F.count("*").alias("n"))


def ghosts(recorded: DataFrame, live: DataFrame) -> DataFrame:
    """Recorded documents that are no more; none where the live population is empty, as then it can't be told."""
    population = live.agg(F.count("*").alias("population"))
    return recorded.select("doc").distinct().join(live.select("doc"), "doc", "left_anti").crossJoin(population).where("population > 0").select("doc")


def ghost_verdicts(cells: DataFrame, gone: DataFrame) -> DataFrame:
    return cells.join(gone, "doc", "left_semi").groupBy("state").agg(F.count("*").alias("n"))


def sync(source: DataFrame, target: DataFrame) -> DataFrame:
    """(name, action): add, update, unchanged or only_local, by the hashes of content; nothing is ever deleted."""
    s, t = source.select("name", F.sha2("content", 256).alias("a")), target.select("name", F.sha2("content", 256).alias("b"))
    action = F.when(F.col("b").isNull(), "add").when(F.col("a").isNull(), "only_local").when(F.col("a") == F.col("b"), "unchanged").otherwise("update")
    return s.join(t, "name", "full").select("name", action.alias("action"))


def newest(files: DataFrame, keep: int) -> DataFrame:
    """The files beyond the newest `keep` of each family, to be pruned."""
    return files.withColumn("r", F.row_number().over(W.partitionBy("family").orderBy(F.desc("modified"), "path"))).where(F.col("r") > keep).drop("r")


def level(check: Column, rc: Column, scope: Column) -> Column:
    """block, warn, unverified or ok. Green without a positive count of what was compared is unverified; unknown checks block."""
    green = F.when(F.coalesce(scope, F.lit(0)) <= 0, "unverified").otherwise("ok")
    return (
        F.when(rc == 0, green)
        .when((check == "compat") & (rc == 5), "warn")
        .when(check.isin(UNVERIFIED_ON_3) & (rc == 3), "unverified")
        .when(check.isin(WARNING_CHECKS), "warn")
        .otherwise("block")
    )


def summarise(checks: DataFrame) -> DataFrame:
    """One row: names by level, and the status of all, which only blocking levels fail."""
    rows = checks.withColumn("level", level(F.col("name"), F.col("rc"), F.col("scope")))
    lists = [F.array_sort(F.collect_list(F.when(F.col("level") == v, F.concat("name", F.lit("_rc"))))).alias(n) for v, n in (("block", "blocking"), ("warn", "warnings"), ("unverified", "unverified"))]
    return rows.agg(*lists, F.when(F.bool_or(F.col("level") == "block"), "fail").otherwise("pass").alias("status"))


def findings_for(measures: DataFrame, findings: DataFrame, drift: float = 0.5) -> DataFrame:
    """(check, metric, doc, pos, stale): the first finding on record for each measure, stale if a value moved by over half (one of zero can't tell).

    findings: (pos, check, metric, doc, value) where doc is part of a name; they are few and are broadcast by size.
    """
    f = findings.select(F.col("check").alias("c"), F.col("metric").alias("m"), F.col("doc").alias("part"), "pos", F.col("value").alias("was"))
    hit = measures.join(f, (F.col("check") == F.col("c")) & (F.col("metric") == F.col("m")) & F.col("doc").contains(F.col("part")))
    first = hit.withColumn("r", F.row_number().over(W.partitionBy("check", "metric", "doc").orderBy("pos"))).where("r = 1")
    moved = F.when(F.col("was") == 0, False).otherwise(F.try_divide(F.abs(F.col("value") - F.col("was")), F.abs("was")) > drift)
    return first.select("check", "metric", "doc", "pos", moved.alias("stale"))


def plan_issues(plan: str = "plan") -> Column:
    """Names of the numbers of a plan struct that are out of range.

    Fields: pages, items, page_size, noise_ratio, noise_suspicious, tables, repair, review, mute, held, convert, dangling.
    """
    c = lambda n: F.col(f"{plan}.{n}")
    inside = lambda x, low, high: F.coalesce(x.between(low, high), F.lit(False))
    most = F.coalesce(c("items"), F.lit(MAX_ITEMS))
    size_ok = (F.size(c("page_size")) == 2) & F.forall(c("page_size"), lambda v: F.coalesce((v > 0) & (v <= MAX_POINTS), F.lit(False)))
    bad = [
        ("pages", ~inside(c("pages"), 1, MAX_PAGES)), ("items", ~inside(c("items"), 1, MAX_ITEMS)), ("page_size", ~F.coalesce(size_ok, F.lit(False))), ("ratio", ~inside(c("noise_ratio"), 0, 1)),
        ("suspicious", F.coalesce(c("noise_suspicious"), F.lit(False))), ("tables", ~inside(c("tables"), 0, most)), *((n, ~inside(c(n), 0, most)) for n in ("mute", "held", "convert", "dangling")),
        *((n, ~inside(c(n), 0, F.coalesce(c("tables"), F.lit(MAX_ITEMS)))) for n in ("repair", "review")),
    ]
    return F.filter(F.array(*(F.when(cond, F.lit(name)) for name, cond in bad)), lambda x: x.isNotNull())


def evaluate_plans(payloads: DataFrame) -> DataFrame:
    """(doc, accepted, reasons): payloads (doc, failed array, plan_doc, plan, refs_ratio, refs_suspicious, title_ratio, title_suspicious)."""
    failed = F.array_distinct(F.transform("failed", T.failure_reason))
    percent = lambda c: F.format_string("%.1f%%", F.col(c) * 100)
    notes = F.array(
        F.when(~F.col("plan_doc").eqNullSafe(F.col("doc")), "preflight 擋下"), F.when(F.size(plan_issues()) > 0, "數字異常"),
        F.when(F.coalesce("refs_suspicious", F.lit(False)), F.concat(F.lit("參考文獻消音比例異常（"), percent("refs_ratio"), F.lit("）"))),
        F.when(F.coalesce("title_suspicious", F.lit(False)), F.concat(F.lit("標題頁消音比例異常（"), percent("title_ratio"), F.lit("）"))),
    )
    reasons = F.when(F.size("failed") > 0, failed).when(F.col("plan").isNull(), F.array(F.lit("preflight 擋下"))).otherwise(F.filter(notes, lambda x: x.isNotNull()))
    return payloads.select("doc", reasons.alias("reasons")).withColumn("accepted", F.size("reasons") == 0)


def entries_from_plan(rows: DataFrame) -> DataFrame:
    """(doc, gate, state) that a plan decides: rows (doc, accepted, admitted, has_tables, repair, review)."""
    preflight = F.when(F.col("accepted"), "pass").when(F.col("admitted"), "unverifiable").otherwise("fail")
    tables = F.when(~F.col("has_tables"), "unverifiable").when((F.col("repair") > 0) | (F.col("review") > 0), "unverifiable").otherwise("pass")
    cells = F.array(F.struct(F.lit("pp.preflight").alias("gate"), preflight.alias("state")), F.struct(F.lit("pp.tables").alias("gate"), tables.alias("state")))
    return rows.select("doc", F.explode(cells).alias("c")).select("doc", "c.gate", "c.state")


def hard_failures(checks: DataFrame, names: DataFrame) -> DataFrame:
    """(name, what) of hard checks that failed, by the documents named in them; name is null where none is."""
    bad = checks.where("level = 'hard' AND ok = false").select("what").distinct()
    # A name may stand anywhere in a message, so no key can meet: the messages, counted, go to the names block by block.
    blocks = -(-bad.count() // BROADCAST_ROWS)
    if not blocks:
        return bad.select(F.lit(None).cast("string").alias("name"), "what")
    cut = [bad.where(F.pmod(F.xxhash64("what"), F.lit(blocks)) == i) for i in range(blocks)]
    found = reduce(DataFrame.unionByName, [names.join(F.broadcast(x), F.col("what").contains(F.col("name"))) for x in cut]).select("name", "what")
    return found.unionByName(bad.join(found.select("what").distinct(), "what", "left_anti").select(F.lit(None).cast("string").alias("name"), "what"))


def pending(docs: DataFrame, recorded: DataFrame) -> DataFrame:
    """(doc, position, next): documents not yet decided, in order, with the one that follows."""
    left = settled(ranked(docs.select("doc").distinct().join(recorded, "doc", "left_anti"), ["doc"]))
    follows = left.select((F.col("k") - 1).alias("k"), F.col("doc").alias("next"))
    return left.join(follows, "k", "left").select("doc", (F.col("k") + 1).cast("int").alias("position"), "next")


def hold_reason(pending_items: Column, confirmed: Column) -> Column:
    return F.when((pending_items > 0) & ~confirmed, "waits for a person").otherwise("")


def profile_hash(*fields: str) -> Column:
    """A hash of fields as JSON with keys in order."""
    return F.sha2(F.to_json(F.struct(*(F.col(f) for f in sorted(fields)))), 256)
