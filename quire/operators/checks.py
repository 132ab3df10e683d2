"""Corpus checks: coverage against a witness, parse severity, grounding of entities, noise in retrieved text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T
from ..functions.unicode import normal, words_of


def word_counts(rows: DataFrame, doc: str, text: str, ascii_only: bool = False) -> DataFrame:
    """(doc, word, n): the word multiset of each document. ascii_only stays in the JVM, for text without ligatures or LaTeX."""
    words = T.ascii_words(F.col(text)) if ascii_only else words_of(F.col(text))
    return rows.select(F.col(doc).alias("doc"), F.explode(words).alias("word")).groupBy("doc", "word").agg(F.count("*").alias("n"))


def paired_counts(rows: DataFrame, doc: str, witness: str, content: str) -> DataFrame:
    """(doc, word, a, b): both word multisets of each document whose two texts stand in one row, counted in tasks and then
    in one shuffle. Words as in word_counts with ascii_only."""
    side = lambda text, a: F.transform(T.ascii_words(F.col(text)), lambda w: F.struct(w.alias("word"), F.lit(a).alias("a")))
    words = rows.select(F.col(doc).alias("doc"), F.explode(F.concat(side(witness, 1), side(content, 0))).alias("s")).select("doc", "s.word", "s.a")
    return words.groupBy("doc", "word").agg(F.sum("a").alias("a"), F.sum(1 - F.col("a")).alias("b"))


def item_strings(items: DataFrame) -> DataFrame:
    """(doc_id, text) of everything in items that is text, originals of muted fields included and of repaired ones not."""
    plain = [F.col(c) for c in ("text", "content", "body", "code_body", "table_body")]
    lists = [F.coalesce(F.col(c), F.array().cast("array<string>")) for c in ("list_items", "table_caption", "image_caption", "image_footnote", "chart_caption", "chart_footnote")]
    visible = lambda c: T.table_text(F.col(c)) != ""
    shadows = [F.when(~visible("text"), F.col("orig_text")), F.when(~visible("table_body"), F.col("orig_table_body"))]
    strings = F.concat(F.array(*plain, *shadows), *lists, F.coalesce("orig_list_items", F.array().cast("array<string>")))
    return items.select("doc_id", F.explode(strings).alias("text")).where("text IS NOT NULL")


def coverage(witness: DataFrame, content: DataFrame, top: int = 10) -> DataFrame:
    """From word counts of both sides: pdf_words, content_words, missing, rate, top, unverifiable per document of witness.

    missing is the bag difference, floored at zero word by word. A witness that is empty, or shorter than the content by more
    than 15 %, cannot tell.
    """
    w, c = witness.withColumnRenamed("n", "a"), content.withColumnRenamed("n", "b")
    return coverage_of(w.join(c, ["doc", "word"], "full").na.fill(0, ["a", "b"]), top)


def coverage_of(both: DataFrame, top: int = 10) -> DataFrame:
    """coverage() of the counts of both sides, (doc, word, a, b). Sums leave the tasks, and of words those that are missing."""
    both = both.withColumn("gone", F.greatest(F.col("a") - F.col("b"), F.lit(0)))
    worst = F.slice(F.sort_array(F.collect_list(F.when(F.col("gone") > 0, F.struct((-F.col("gone")).alias("k"), "word")))), 1, top)
    rows = both.groupBy("doc").agg(F.sum("a").alias("pdf_words"), F.sum("b").alias("content_words"), F.sum("gone").alias("missing"), worst.alias("w"))
    rows = rows.withColumn("top", F.transform("w", lambda x: F.struct(x.word.alias("word"), (-x.k).alias("n")))).drop("w")
    return rows.withColumns({"rate": F.try_divide("missing", "pdf_words"), "unverifiable": (F.col("pdf_words") == 0) | witness_short(F.col("pdf_words"), F.col("content_words"))})


def witness_short(pdf_words: Column, content_words: Column) -> Column:
    return content_words > pdf_words * P.WITNESS_SHORT


def is_red(unverifiable: Column, error: Column, rate: Column, threshold: float = P.COVERAGE_RED) -> Column:
    return F.when(unverifiable, False).when(error.isNotNull(), True).otherwise(F.coalesce(rate > threshold, F.lit(False)))


def body_of(items: DataFrame, ascii_only: bool = False) -> Column:
    """An item's text; that of a muted one is its original."""
    now = T.item_body(F.col("text"), F.col("table_body"), F.col("code_body"))
    return F.when(T.is_blank(now, ascii_only), F.coalesce("orig_text", F.lit(""))).otherwise(now)


def parse_check(items: DataFrame, ascii_only: bool = False) -> DataFrame:
    """Per document: items, pages, counts of damage and of empty parts, characters, and pages without text. ascii_only takes
    but ASCII letters and white space for such, as SQL's patterns do. Items without a document are one document."""
    rows = items.withColumn("body_text", body_of(items, ascii_only))
    chars = F.when(F.col("type").isin(P.PROSE_TYPES), F.length("body_text")).otherwise(0)
    empty = lambda t: F.count_if((F.col("type") == t) & T.is_blank(F.col("body_text"), ascii_only))
    per = rows.groupBy("doc_id").agg(
        F.count("*").alias("items"), (F.coalesce(F.max("page_idx"), F.lit(-1)) + 1).alias("pages"), F.count_if(T.is_mangled(F.col("body_text"), F.col("type"), ascii_only)).alias("mangled"),
        F.count_if((F.col("body_text") != "") & T.has_leak(F.col("body_text"))).alias("leaks"), empty("text").alias("empty_text"), F.count_if((F.col("type") == "table") & (T.table_text(F.col("body_text")) == "")).alias("empty_table"),
        empty("equation").alias("empty_equation"), F.sum(chars).cast("long").alias("chars"),
        F.count_distinct(F.when(chars > 0, F.col("page_idx"))).alias("texted"),
    )
    return per.withColumn("textless_pages", F.col("pages") - F.col("texted")).drop("texted")


def textless_pages(items: DataFrame) -> DataFrame:
    """(doc_id, page) of every page below the last that has no characters of prose."""
    rows = items.withColumn("body_text", body_of(items))
    pages = items.groupBy("doc_id").agg(F.max("page_idx").alias("last")).where("last IS NOT NULL").select("doc_id", F.explode(F.sequence(F.lit(0), "last")).alias("page"))
    texted = rows.where(F.col("type").isin(P.PROSE_TYPES) & (F.length("body_text") > 0)).select("doc_id", F.col("page_idx").alias("page")).distinct()
    return pages.join(texted, ["doc_id", "page"], "left_anti")


def type_histogram(items: DataFrame) -> DataFrame:
    return items.groupBy("doc_id", "type").agg(F.count("*").alias("n"))


def severity(mangled: Column, leaks: Column, chars: Column, empties: Column, textless: Column, pages: Column) -> Column:
    """ERROR, WARN or OK."""
    many = textless > F.greatest(F.lit(3.0), pages * 0.2)
    return F.when((mangled > 0) | (leaks > 0) | (chars == 0), "ERROR").when((empties > 0) | many, "WARN").otherwise("OK")


def with_severity(checked: DataFrame) -> DataFrame:
    s = severity(F.col("mangled"), F.col("leaks"), F.col("chars"), F.col("empty_text") + F.col("empty_table") + F.col("empty_equation"), F.col("textless_pages"), F.col("pages"))
    return checked.withColumn("severity", s).orderBy(F.when(s == "ERROR", 0).when(s == "WARN", 1).otherwise(2), F.desc("mangled"), "doc_id")


def grounded(name: Column, text: Column) -> Column:
    """A normalised name is in a normalised text as a whole, or every one of its words of three letters or more is."""
    words = F.filter(F.split(name, " "), lambda w: F.length(w) > 2)
    return F.when(name == "", False).otherwise(text.contains(name) | ((F.size(words) > 0) & F.forall(words, lambda w: text.contains(w))))


def grounding(entities: DataFrame, chunks: DataFrame, normalise=normal) -> DataFrame:
    """Per document of the entities: total, ok, missing_chunk, symbolic, suspect.

    An entity is ok if any of its chunks grounds it, missing if none of them is there, symbolic if all of them are markup.
    Chunks are normalised once, before the join.
    """
    ready = chunks.select(F.col("id").alias("chunk"), normalise(F.col("content")).alias("plain"), T.is_symbolic(F.col("content")).alias("symbolic"))
    named = entities.select(F.col("file_path").alias("doc"), "entity_name", normalise(F.col("entity_name")).alias("name"), F.explode_outer("chunk_ids").alias("chunk"))
    joined = named.join(ready, "chunk", "left")
    per = joined.groupBy("doc", "entity_name").agg(F.bool_or(F.coalesce(grounded(F.col("name"), F.col("plain")), F.lit(False))).alias("ok"), F.count("plain").alias("live"), F.coalesce(F.bool_and("symbolic"), F.lit(False)).alias("symbolic"))
    kind = F.when(F.col("live") == 0, "missing_chunk").when(F.col("ok"), "ok").when(F.col("symbolic"), "symbolic").otherwise("suspect")
    per = per.withColumn("kind", kind)
    return per.groupBy("doc").agg(F.count("*").alias("total"), *(F.count_if(F.col("kind") == k).alias(k) for k in ("ok", "missing_chunk", "symbolic", "suspect")))


def relation_endpoints(relations: DataFrame, chunks: DataFrame, normalise=normal) -> DataFrame:
    """Per document: relations with both, one or neither end grounded in a chunk of theirs."""
    ready = chunks.select(F.col("id").alias("chunk"), normalise(F.col("content")).alias("plain"))
    named = relations.select(F.col("file_path").alias("doc"), "source_id", "target_id", normalise(F.col("source_id")).alias("s"), normalise(F.col("target_id")).alias("t"), F.explode_outer("chunk_ids").alias("chunk")).join(ready, "chunk", "left")
    found = lambda c: F.bool_or(F.coalesce(grounded(F.col(c), F.col("plain")), F.lit(False))).cast("int")
    per = named.groupBy("doc", "source_id", "target_id").agg((found("s") + found("t")).alias("ends"))
    return per.groupBy("doc").agg(*(F.count_if(F.col("ends") == n).alias(k) for k, n in (("both", 2), ("one", 1), ("neither", 0))))


def grounding_state(total: Column, ok: Column, missing: Column, symbolic: Column, threshold: float = P.GROUNDING_RED) -> Column:
    """struct(state, ratio): suspects over those that matching can tell; nothing to tell is not a pass."""
    suspect = total - ok - missing - symbolic
    known = ok + suspect
    ratio = F.try_divide(suspect, known)
    return F.struct(F.when(known <= 0, "unverifiable").when(ratio <= threshold, "pass").otherwise("fail").alias("state"), ratio.alias("ratio"))


def noise_share(chunks: DataFrame, noise: DataFrame) -> DataFrame:
    """Per document: characters of retrieved chunks, characters of muted strings in them, chunks that hold any.

    chunks: (chunk, doc, content); noise: (doc, text). Strings are found without overlaps, each on its own.
    """
    strings = noise.where(~T.is_blank(F.col("text"))).select("doc", "text").distinct()
    joined = chunks.join(strings, "doc", "left")
    gone = F.when(F.col("text").isNotNull(), F.length("content") - F.length(F.replace("content", F.col("text"), F.lit("")))).otherwise(0)
    per = joined.groupBy("doc", "chunk").agg(F.max(F.length("content")).alias("chars"), F.sum(gone).alias("noise"))
    return per.groupBy("doc").agg(F.sum("chars").alias("chars"), F.sum("noise").alias("noise_chars"), F.count("*").alias("chunks"), F.count_if(F.col("noise") > 0).alias("hit"))


def noise_index(plan_rows: DataFrame, items: DataFrame) -> DataFrame:
    """(doc, text) of every string muted now or before."""
    planned = plan_rows.where("action = 'mute'").join(items, ["doc_id", "item_idx"]).select("doc_id", T.display_text(F.col("text"), F.col("list_items")).alias("text"))
    kept = items.where("orig_text IS NOT NULL").select("doc_id", T.stripped(F.col("orig_text")).alias("text"))
    return planned.union(kept).where("text <> ''").distinct().withColumnRenamed("doc_id", "doc")


def muted_audit(items: DataFrame) -> DataFrame:
    """Per document: texts and lists that were removed, from their originals where the live field is empty now: how many, their
    characters, the list entries, the kinds, and their share of all characters."""
    none = F.array().cast("array<string>")
    size = lambda c: F.aggregate(F.coalesce(F.col(c), none), F.lit(0), lambda n, x: n + F.length(T.filled(x)))
    text = F.col("orig_text").isNotNull() & (F.length(T.filled(F.col("text"))) == 0)
    listed = F.col("orig_list_items").isNotNull() & (size("list_items") == 0)
    kind = F.concat_ws("/", "type", F.coalesce(F.nullif("sub_type", F.lit("")), F.lit("-")))
    rows = items.select(
        "doc_id", T.item_chars(F.col("text"), F.col("list_items")).alias("live"), (text.cast("int") + listed.cast("int")).alias("gone"), F.when(text | listed, kind).alias("kind"),
        (F.when(text, F.length("orig_text")).otherwise(0) + F.when(listed, size("orig_list_items")).otherwise(0)).alias("chars"), F.when(listed, F.size("orig_list_items")).otherwise(0).alias("entries"),
    )
    per = rows.groupBy("doc_id").agg(F.sum("gone").alias("removed"), F.sum("chars").alias("removed_chars"), F.sum("entries").alias("list_entries"), F.array_sort(F.collect_set("kind")).alias("kinds"), F.sum("live").alias("live_chars"))
    return per.withColumn("ratio", F.coalesce(F.try_divide(F.col("removed_chars"), F.col("removed_chars") + F.col("live_chars")), F.lit(0.0)))
