"""The rule plan of a corpus: every rule in order of claim, guards, and applying and reverting it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T
from ..functions.latex import fix_latex
from ..operators import layout
from ..sources.bundles import unpivoted
from .storage import settled

SHADOWS = {"text": "orig_text", "list_items": "orig_list_items", "table_body": "orig_table_body", "type": "orig_type"}


class Refused(ValueError):
    """A guard says no: nothing may be written."""


def plan(items: DataFrame, n_pages: DataFrame | None = None) -> DataFrame:
    """Rows of all five muting rules. Noise, references and titles claim first, then wrapper pages, then margins."""
    first = settled(layout.noise_plan(items, n_pages).unionByName(layout.reference_plan(items)).unionByName(layout.title_plan(items)))
    second = first.unionByName(settled(layout.cover_plan(items, first)))
    return second.unionByName(layout.margin_plan(items, second))


def overlaps(plan_rows: DataFrame) -> DataFrame:
    """(doc_id, item_idx, rules) of items that two rules mute: an error, not a tie to settle."""
    muted = plan_rows.where("action = 'mute'").groupBy("doc_id", "item_idx").agg(F.sort_array(F.collect_set("rule")).alias("rules"), F.count("*").alias("n"))
    return muted.where("n > 1").select("doc_id", "item_idx", "rules")


def ratios(items: DataFrame, plan_rows: DataFrame) -> DataFrame:
    """(doc_id, rule, before, after, ratio, suspicious): what each rule takes of a document's characters.

    References count all types with their lists; the others body types only, wrapper pages and margins without white space
    at the ends.
    """
    body = F.col("type").isin(P.BODY_TYPES)
    plain = F.when(body, F.length(T.filled(F.col("text")))).otherwise(0)
    bare = F.when(body, F.length(T.stripped(T.filled(F.col("text"))))).otherwise(0)
    whole = T.item_chars(F.col("text"), F.col("list_items"))
    sized = items.select("doc_id", "item_idx", F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), c.cast("long").alias("chars")) for r, c in (("noise", plain), ("title", plain), ("cover", bare), ("margin", bare), ("reference", whole))))).alias("x")).select("doc_id", "item_idx", "x.*")
    muted = plan_rows.where("action = 'mute'").select("doc_id", "item_idx", "rule", F.lit(True).alias("muted")).distinct()
    joined = sized.join(muted, ["doc_id", "item_idx", "rule"], "left")
    rows = joined.groupBy("doc_id", "rule").agg(F.sum("chars").alias("before"), F.sum(F.when(F.col("muted"), 0).otherwise(F.col("chars"))).alias("after"))
    ratio = F.coalesce(F.try_divide(F.col("before") - F.col("after"), F.col("before")), F.lit(0.0))
    limit = F.element_at(F.create_map(*(F.lit(x) for kv in P.SUSPICIOUS.items() for x in kv)), F.col("rule"))
    return rows.withColumn("ratio", ratio).withColumn("suspicious", F.col("ratio") > limit)


def guard(items: DataFrame, plan_rows: DataFrame, acknowledged: bool = False) -> None:
    """Raise Refused if rules overlap, a target is missing, or a share is suspicious and nobody acknowledged it."""
    if clash := overlaps(plan_rows).take(3):
        raise Refused(f"more than one rule mutes {[(r.doc_id, r.item_idx, r.rules) for r in clash]}")
    if lost := plan_rows.join(items, ["doc_id", "item_idx"], "left_anti").take(3):
        raise Refused(f"no such item: {[(r.doc_id, r.item_idx) for r in lost]}")
    if not acknowledged and (high := ratios(items, plan_rows).where("suspicious").take(3)):
        raise Refused(f"too much of a document goes: {[(r.doc_id, r.rule, r.ratio) for r in high]}")


def mute(items: DataFrame, plan_rows: DataFrame) -> DataFrame:
    """Blank the text and lists of muted items, originals kept in shadow columns. Rows and their order stay; muting twice is muting once."""
    chosen = plan_rows.where("action = 'mute'").select("doc_id", "item_idx", F.lit(True).alias("muted")).distinct()
    rows = items.join(chosen, ["doc_id", "item_idx"], "left")
    go = F.coalesce("muted", F.lit(False))
    text, listed = go & ~T.is_blank(F.col("text")), go & (F.size(F.coalesce("list_items", F.array())) > 0)
    changed = {"orig_text": F.when(text, F.col("text")).otherwise(F.col("orig_text")), "orig_list_items": F.when(listed, F.col("list_items")).otherwise(F.col("orig_list_items"))}
    rows = rows.withColumns({f"new_{k}": v for k, v in (changed | {"text": F.when(text, "").otherwise(F.col("text")), "list_items": F.when(listed, F.array().cast("array<string>")).otherwise(F.col("list_items"))}).items()})
    return rows.select(*(F.col(f"new_{c}").alias(c) if f"new_{c}" in rows.columns else c for c in items.columns))


def convert_charts(items: DataFrame, charts: DataFrame) -> DataFrame:
    """Charts whose file is there become images; captions and footnotes move along. Done twice it changes nothing more."""
    chosen = charts.where("action = 'convert'").select("doc_id", "item_idx", F.lit(True).alias("chosen"))
    rows = items.join(chosen, ["doc_id", "item_idx"], "left")
    go = F.coalesce("chosen", F.lit(False)) & (F.col("type") == "chart")
    none = F.lit(None)
    new = {
        "orig_type": F.when(go, F.col("type")).otherwise(F.col("orig_type")), "type": F.when(go, "image").otherwise(F.col("type")),
        "image_caption": F.when(go & F.col("chart_caption").isNotNull(), F.col("chart_caption")).otherwise(F.col("image_caption")), "chart_caption": F.when(go, none).otherwise(F.col("chart_caption")),
        "image_footnote": F.when(go & F.col("chart_footnote").isNotNull(), F.col("chart_footnote")).otherwise(F.col("image_footnote")), "chart_footnote": F.when(go, none).otherwise(F.col("chart_footnote")),
    }
    rows = rows.withColumns({f"new_{k}": v for k, v in new.items()})
    return rows.select(*(F.col(f"new_{c}").alias(c) if c in new else c for c in items.columns))


def patch(items: DataFrame, verified: DataFrame, field: str, at: str) -> DataFrame:
    """Put verified values (doc_id, item_idx, value) in a field; the first original is kept, the time stamped."""
    rows = items.join(verified.select("doc_id", "item_idx", F.col("value").alias("verified")), ["doc_id", "item_idx"], "left")
    go = F.col("verified").isNotNull()
    shadow = SHADOWS[field]
    new = {field: F.coalesce("verified", field), shadow: F.when(go, F.coalesce(shadow, F.coalesce(field, F.lit("")))).otherwise(F.col(shadow)), "repaired_at": F.when(go, at).otherwise(F.col("repaired_at"))}
    if field == "table_body":
        new |= {"had_table_body": F.when(go, F.coalesce("had_table_body", "has_table_body")).otherwise(F.col("had_table_body")), "has_table_body": F.col("has_table_body") | go}
    rows = rows.withColumns({f"new_{k}": v for k, v in new.items()})
    return rows.select(*(F.col(f"new_{c}").alias(c) if c in new else c for c in items.columns))


def revert(items: DataFrame) -> DataFrame:
    """Undo everything from the shadow columns: texts, lists, tables and whether their key was there, types."""
    had = F.coalesce("had_table_body", "has_table_body")
    image = F.col("orig_type") == "chart"
    new = {
        "text": F.coalesce("orig_text", "text"), "list_items": F.coalesce("orig_list_items", "list_items"),
        "table_body": F.when(F.col("had_table_body").isNotNull() & ~F.col("had_table_body"), F.lit(None)).otherwise(F.coalesce("orig_table_body", "table_body")), "has_table_body": had, "type": F.coalesce("orig_type", "type"),
        "chart_caption": F.when(image, F.col("image_caption")).otherwise(F.col("chart_caption")), "image_caption": F.when(image, F.lit(None)).otherwise(F.col("image_caption")),
        "chart_footnote": F.when(image, F.col("image_footnote")).otherwise(F.col("chart_footnote")), "image_footnote": F.when(image, F.lit(None)).otherwise(F.col("image_footnote")),
    }
    shadows = {"orig_text", "orig_list_items", "orig_type", "orig_table_body", "had_table_body", "repaired_at"}
    rows = items.withColumns({f"new_{k}": v for k, v in new.items()})
    kinds = {f.name: f.dataType for f in items.schema}
    return rows.select(*(F.col(f"new_{c}").alias(c) if c in new else F.lit(None).cast(kinds[c]).alias(c) if c in shadows else F.col(c) for c in items.columns))


def apply(items: DataFrame, plan_rows: DataFrame, charts: DataFrame | None = None, acknowledged: bool = False, path: str | None = None) -> DataFrame:
    """Guard, mute, convert; nothing else may change. Without a path it is a dry run.

    With one, the result is written beside it, read again and checked, and only then takes the place of what is there, which
    is kept beside it as the backup; if anything fails before, the path is as it was. rollback() puts the backup back.
    """
    guard(items, plan_rows, acknowledged)
    out = mute(items, plan_rows)
    out = convert_charts(out, charts) if charts is not None else out
    if path is None:
        return out
    spark, staging = items.sparkSession, _beside(path, "staging")
    files, at = _files(spark, path)
    try:
        out.write.mode("overwrite").parquet(staging)
        verify(items, spark.read.parquet(staging))
        if files.exists(at(path)):
            files.delete(at(_beside(path, "backup")), True)
            _move(files, at(path), at(_beside(path, "backup")))
        try:
            _move(files, at(staging), at(path))
        except OSError:
            if files.exists(at(_beside(path, "backup"))) and not files.exists(at(path)):
                _move(files, at(_beside(path, "backup")), at(path))
            raise
    finally:
        files.delete(at(staging), True)
    return spark.read.parquet(path)


def verify(before: DataFrame, after: DataFrame) -> None:
    """Raise Refused unless reverting what was written gives what was there, item by item."""
    key = lambda df: revert(df).select("doc_id", "item_idx", F.xxhash64(*(F.to_json(F.struct(c)) for c in sorted(REVERTED))).alias("h"))
    a, b = key(before), key(after).withColumnRenamed("h", "g")
    n, m = before.count(), after.count()
    if n != m:
        raise Refused(f"{n} items became {m}")
    if lost := a.join(b, ["doc_id", "item_idx"], "left").where("NOT h <=> g").take(3):
        raise Refused(f"what was written can't be reverted at {[(r.doc_id, r.item_idx) for r in lost]}")


#: Columns that reverting must give back.
REVERTED = ["type", "text", "list_items", "table_body", "chart_caption", "image_caption"]


def rollback(spark: SparkSession, path: str) -> DataFrame:
    """Put back what apply() last replaced at path, and keep what was there as the new backup, so that it can be undone as well."""
    files, at = _files(spark, path)
    backup, aside = at(_beside(path, "backup")), at(_beside(path, "staging"))
    if not files.exists(backup):
        raise Refused(f"there is no backup of {path}")
    _move(files, at(path), aside)
    _move(files, backup, at(path))
    _move(files, aside, backup)
    return spark.read.parquet(path)


def _beside(path: str, what: str) -> str:
    head, _, name = path.rstrip("/").rpartition("/")
    return f"{head}/.{name}.{what}"


def _files(spark: SparkSession, path: str):
    """The file system of a path as the JVM has it, and how it names one: any store that Spark writes to."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(conf), at


def _move(files, a, b) -> None:
    if not files.rename(a, b):
        raise OSError(f"{a} could not be renamed {b}")


def latex_edits(items: DataFrame) -> DataFrame:
    """(doc_id, item_idx, field, text, times, partials, veto, words) of the fields with a backslash that change or are vetoed."""
    rows = unpivoted(items).where(F.col("value").contains("\\")).withColumn("fix", fix_latex(F.col("value")))
    return rows.where((F.col("fix.text") != F.col("value")) | F.col("fix.veto")).select("doc_id", "item_idx", "field", "fix.*")


def honour(plan_rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """Held rows that a person suppressed become muted. decisions: (doc_id, section, item_idx, suppress)."""
    d = decisions.where("suppress").select("doc_id", F.col("section").alias("rule"), "item_idx", F.lit(True).alias("suppressed")).distinct()
    rows = plan_rows.join(d, ["doc_id", "rule", "item_idx"], "left")
    return rows.withColumn("action", F.when((F.col("action") == "held") & F.col("suppressed"), "mute").otherwise(F.col("action"))).select(layout.PLAN)


def unmatched_decisions(plan_rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """Suppressions that no row of the plan answers to."""
    d = decisions.where("suppress").select("doc_id", F.col("section").alias("rule"), "item_idx").distinct()
    return d.join(plan_rows, ["doc_id", "rule", "item_idx"], "left_anti")


def confirm_items(plan_rows: DataFrame) -> DataFrame:
    """What a person is asked: held rows of noise and title, but those that a wrapper page or margin takes, prose and keywords."""
    taken = plan_rows.where("rule IN ('cover', 'margin') AND action = 'mute'").select("doc_id", "item_idx")
    held = plan_rows.where("action = 'held' AND rule IN ('noise', 'title')").join(taken, ["doc_id", "item_idx"], "left_anti")
    return held.where(F.coalesce(~((F.col("rule") == "title") & F.col("why").isin(P.WHY_PROSE, P.WHY_KEYWORD)), F.lit(True)))


def muted_items(plan_rows: DataFrame) -> DataFrame:
    """All muted rows under one schema, with the reason as text."""
    return plan_rows.where("action = 'mute'").select("doc_id", "item_idx", "rule", F.coalesce("signal", "rule").alias("reason"))


def muted_count(plan_rows: DataFrame) -> DataFrame:
    return plan_rows.where("action = 'mute'").groupBy("doc_id").agg(F.count("*").alias("muted"))


def around(items: DataFrame, span: int = 2, empty: str = "（空）") -> DataFrame:
    """Each item with the display texts of the `span` items before and after it."""
    from pyspark.sql import Window as W

    shown = T.display_text(F.col("text"), F.col("list_items"))
    w = W.partitionBy("doc_id").orderBy("item_idx")
    text: Column = F.when(shown == "", empty).otherwise(shown)
    rows = items.select("doc_id", "item_idx", text.alias("shown"))
    return rows.select("doc_id", "item_idx", F.collect_list("shown").over(w.rowsBetween(-span, -1)).alias("before"), F.collect_list("shown").over(w.rowsBetween(1, span)).alias("after"))


def group_confirm(rows: DataFrame) -> DataFrame:
    """(category, text, n, docs) of like items of many documents, the commonest first."""
    grouped = rows.groupBy("category", T.stripped(F.col("text")).alias("text")).agg(F.count("*").alias("n"), F.sort_array(F.collect_set("doc_id")).alias("docs"))
    return grouped.orderBy(F.desc("n"), "category", "text")


def canary(items: DataFrame, plan_rows: DataFrame) -> DataFrame:
    """One row of counters per document: items by type, muted and held by rule, characters."""
    kinds = [F.count_if(F.col("type") == t).alias(f"type_{t}") for t in P.KNOWN_TYPES]
    base = items.groupBy("doc_id").agg(F.count("*").alias("items"), *kinds, F.sum(T.item_chars(F.col("text"), F.col("list_items"))).cast("long").alias("chars"))
    cells = [F.count_if((F.col("rule") == r) & (F.col("action") == a)).alias(f"{r}_{a}") for r in P.SUSPICIOUS for a in ("mute", "held")]
    joined = base.join(plan_rows.groupBy("doc_id").agg(*cells), "doc_id", "left")
    return joined.na.fill(0)


def canary_diff(baseline: DataFrame, current: DataFrame, key: str = "doc_id") -> DataFrame:
    """(doc_id, field, old, new, change): drift of a counter, or a document added or gone."""
    fields = [c for c in baseline.columns if c != key and c in current.columns]
    long = lambda df, name: df.select(key, F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias(name)) for c in fields))).alias("x")).select(key, "x.*")
    joined = long(baseline, "old").withColumn("b", F.lit(True)).join(long(current, "new").withColumn("c", F.lit(True)), [key, "field"], "full")
    change = F.when(F.col("b").isNull(), "added").when(F.col("c").isNull(), "gone").when(~F.col("old").eqNullSafe(F.col("new")), "drift")
    rows = joined.select(key, "field", "old", "new", change.alias("change")).where("change IS NOT NULL")
    whole = rows.where("change <> 'drift'").select(key, F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("old"), F.lit(None).cast("string").alias("new"), "change").distinct()
    return rows.where("change = 'drift'").unionByName(whole)


def violations(items: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc_id, what, at): unknown types, and pages whose index is not their place."""
    unknown = items.where(~F.coalesce(F.col("type").isin(P.KNOWN_TYPES), F.lit(False))).select("doc_id", F.concat(F.lit("unknown type "), F.coalesce("type", F.lit("null"))).alias("what"), F.col("item_idx").alias("at"))
    shifted = pages.where(~F.col("page_idx").eqNullSafe(F.col("page_pos"))).select("doc_id", F.lit("page order").alias("what"), F.col("page_pos").alias("at"))
    return unknown.unionByName(shifted)


def all_of(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
