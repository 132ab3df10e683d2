"""Matching: titles to files with ties refused, equation classes and pairs, entity variants, sources of documents."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T
from ..functions.latex import equation_key, text_ratio
from ..functions.unicode import file_words, key_of_name, tier_of, title_words
from ..plans.storage import components


def overlap(a: Column, b: Column) -> Column:
    """Shared members over the smaller set; 0 if it is empty."""
    least = F.least(F.size(a), F.size(b))
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), least), F.lit(0.0))


def score(a: Column, b: Column) -> Column:
    """The overlap if both sides have three words, four are shared and 0.85 are covered; else 0."""
    good = (F.least(F.size(a), F.size(b)) >= P.MATCH_WORDS) & (F.size(F.array_intersect(a, b)) >= P.MATCH_SHARED) & (overlap(a, b) >= P.MATCH_OVERLAP)
    return F.when(good, overlap(a, b)).otherwise(0.0)


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), union), F.lit(0.0))


def word_jaccard(a: Column, b: Column) -> Column:
    """Of the words of four letters or more of two texts, lower-cased."""
    words = lambda x: F.array_distinct(T.matches_of(F.lower(T.filled(x)), "[a-z]{4,}"))
    x, y = words(a), words(b)
    return F.size(F.array_intersect(x, y)) / F.greatest(F.size(F.array_union(x, y)), F.lit(1))


def best_matches(needles: DataFrame, haystack: DataFrame) -> DataFrame:
    """(needle, match, score, jaccard): the best of haystack for each needle; no row where two tie on both measures.

    Both sides: (id, words). A match covers 0.85 of the smaller set, so it shares one of that set's rarest words, as many as may
    be missing and one more: only those of the smaller side are joined with the other side's words, and a word that many sets
    hold meets nothing unless a set has few rarer ones.
    """
    n, h = needles.select(F.col("id").alias("needle"), F.col("words").alias("a")), haystack.select(F.col("id").alias("match"), F.col("words").alias("b"))
    listed = {x: rows.where(F.size(words) >= P.MATCH_WORDS).select(x, F.size(words).alias("size"), F.explode(words).alias("w")) for x, rows, words in (("needle", n, "a"), ("match", h, "b"))}
    known = listed["needle"].select("w").union(listed["match"].select("w")).groupBy("w").agg(F.count("*").alias("df"))

    def rare(side: str) -> DataFrame:
        missing = F.col("size") - F.ceil(F.col("size") * P.MATCH_OVERLAP - 1e-9)
        order = F.row_number().over(W.partitionBy(side).orderBy("df", "w"))
        return listed[side].join(known, "w").withColumn("r", order).where(F.col("r") <= missing + 1).select(side, "size", "w")

    def meet(small: str, large: str) -> DataFrame:
        other = listed[large].withColumnRenamed("size", "other")
        return rare(small).join(other, "w").where("size <= other").select("needle", "match")

    shared = meet("needle", "match").union(meet("match", "needle")).distinct()
    scored = shared.join(n, "needle").join(h, "match").select("needle", "match", score(F.col("a"), F.col("b")).alias("score"), jaccard(F.col("a"), F.col("b")).alias("jaccard")).where("score > 0")
    best = scored.withColumn("r", F.rank().over(W.partitionBy("needle").orderBy(F.desc("score"), F.desc("jaccard")))).where("r = 1")
    return best.withColumn("ties", F.count("*").over(W.partitionBy("needle"))).where("ties = 1").select("needle", "match", "score", "jaccard")


def with_title_words(rows: DataFrame, column: str) -> DataFrame:
    return rows.withColumn("words", title_words(F.col(column)))


def with_file_words(rows: DataFrame, column: str) -> DataFrame:
    return rows.withColumn("words", file_words(F.col(column)))


def ascii_title_words(title: Column) -> Column:
    """Significant words of a title without Unicode, in the JVM."""
    words = T.matches_of(F.lower(T.filled(title)), "[a-z0-9]+")
    return F.array_sort(F.array_distinct(F.filter(words, lambda w: ~w.isin(P.STOPWORDS) & ((F.length(w) > 1) | w.rlike("^[0-9]$")))))


def documents_in_kb(bib: DataFrame, stored: DataFrame, tag: str) -> DataFrame:
    """(key, how, filename): bibliography items with a stored file. bib: (key, title, extra); stored: (filename).

    A key in a file's name always wins; then a file name recorded under `tag`, then the title's best match. A file belongs to one item:
    the highest claim, none where the highest tie.
    """
    keyed = stored.select("filename", F.regexp_extract("filename", P.ITEM_KEY, 1).alias("key")).where("key <> ''")
    stamped = bib.join(keyed, "key").groupBy("key").agg(F.min("filename").alias("filename")).select("key", F.lit("key").alias("how"), "filename")
    rest = bib.join(keyed.select("key").distinct(), "key", "left_anti")
    listed = rest.select("key", F.posexplode(T.recorded_filenames(F.col("extra"), tag)).alias("pos", "filename")).join(stored, "filename", "left_semi")
    exact = listed.groupBy("key").agg(F.min_by("filename", "pos").alias("filename")).select("key", "filename", F.lit(2.0).alias("claim"), F.lit("recorded").alias("how"))
    open_ = rest.join(exact, "key", "left_anti")
    found = best_matches(with_title_words(open_.select(F.col("key").alias("id"), "title"), "title"), with_file_words(stored.select(F.col("filename").alias("id"), "filename"), "filename"))
    fuzzy = found.select(F.col("needle").alias("key"), F.col("match").alias("filename"), (F.col("score") + F.col("jaccard")).alias("claim"), F.lit("title").alias("how"))
    claims = exact.unionByName(fuzzy).withColumn("r", F.rank().over(W.partitionBy("filename").orderBy(F.desc("claim")))).where("r = 1")
    won = claims.withColumn("ties", F.count("*").over(W.partitionBy("filename"))).where("ties = 1").select("key", "how", "filename")
    return stamped.unionByName(won)


def plan_changes(bib: DataFrame, in_kb: DataFrame, read: DataFrame, status: dict[str, str], prune: bool = False) -> DataFrame:
    """(key, before, after) of the items whose tags change: status tags are set anew, other tags stay.

    bib: (key, tags, parent). status names the tags for in_kb and read. Children carry no status tags; without prune a
    status tag once given stays.
    """
    known = F.array(F.lit(status["in_kb"]), F.lit(status["read"]))
    rows = bib.join(in_kb.select("key", F.lit(True).alias("k")).distinct(), "key", "left").join(read.select("key", F.lit(True).alias("d")).distinct(), "key", "left")
    tags = F.coalesce("tags", F.array().cast("array<string>"))
    want = F.filter(F.array(F.when(F.col("k"), status["in_kb"]), F.when(F.col("d"), status["read"])), lambda x: x.isNotNull())
    want = want if prune else F.array_union(want, F.array_intersect(tags, known))
    want = F.when(F.col("parent").isNotNull(), F.array().cast("array<string>")).otherwise(want)
    after = F.array_sort(F.array_union(F.array_except(tags, known), want))
    return rows.select("key", F.array_sort(F.array_distinct(tags)).alias("before"), after.alias("after")).where("before <> after")


def decide_by_key(keys: DataFrame, rows: DataFrame) -> DataFrame:
    """(key, state): missing without index rows (key, status), failed if any is, done if all are completed, else pending."""
    per = rows.groupBy("key").agg(F.bool_or(F.col("status") == "failed").alias("f"), F.bool_and(F.col("status") == "completed").alias("c"))
    state = F.when(F.col("f").isNull(), "missing").when(F.col("f"), "failed").when(F.col("c"), "done").otherwise("pending")
    return keys.join(per, "key", "left").select("key", state.alias("state"))


#: How translations are tagged and named.
TRANSLATED_TAG, TRANSLATED_NAME = "BabelDOC_translated", r"(?iu)(_?zht|zh-?tw|[-_.]dual\b|[-_.]mono\b|_translation|翻譯)"


def choose_attachment(attachments: DataFrame) -> DataFrame:
    """(key, chosen, reason) of attachments (key, name, title, tags): the only one; else, without translations, the only one left or
    the only one titled PDF; else null, as a wrong one is worse than none."""
    text = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("name", F.lit("")))
    rows = attachments.withColumn("fine", ~(F.coalesce(F.array_contains("tags", TRANSLATED_TAG), F.lit(False)) | text.rlike(TRANSLATED_NAME)))
    rows = rows.withColumn("named", F.col("fine") & (T.stripped(T.filled(F.col("title"))) == "PDF"))
    pick = lambda c: F.max(F.when(c, F.col("name")))
    per = rows.groupBy("key").agg(F.count("*").alias("n"), F.count_if("fine").alias("f"), F.count_if("named").alias("p"), F.max("name").alias("any"), pick(F.col("fine")).alias("one"), pick(F.col("named")).alias("pdf"))
    reason = F.when(F.col("n") == 1, "only").when(F.col("f") == 0, "all-translated").when(F.col("f") == 1, "sole-original").when(F.col("p") == 1, "named-PDF").otherwise("ambiguous")
    chosen = F.when(reason == "only", F.col("any")).when(reason == "sole-original", F.col("one")).when(reason == "named-PDF", F.col("pdf"))
    return per.select("key", chosen.alias("chosen"), reason.alias("reason"))


#: Characters that most skeletons are made of, counted to rule out pairs.
_COUNTED = "#\\{}()+-=^_ aefinorst"


def equations(rows: DataFrame) -> DataFrame:
    """Equations (doc, item, latex, source) with skeleton, nums and profile; one Python pass computes all three."""
    return rows.where(~T.is_blank(F.col("latex"))).withColumn("k", equation_key(F.col("latex"))).select("doc", "item", "latex", "source", "k.*")


def equation_classes(eqs: DataFrame) -> DataFrame:
    """Skeletons that are not trivial and stand in two sources or more; disagreeing constants first."""
    grouped = eqs.where(~F.col("skeleton").rlike(P.TRIVIAL_SKELETON)).groupBy("skeleton").agg(
        F.count("*").alias("size"), F.sort_array(F.collect_set("source")).alias("sources"), (F.count_distinct("nums") == 1).alias("constants_agree"), F.sort_array(F.collect_list(F.struct("doc", "item", "nums"))).alias("members")
    )
    return grouped.where(F.size("sources") > 1).orderBy("constants_agree", F.desc("size"), "skeleton")


def equation_pairs(eqs: DataFrame, least: float) -> DataFrame:
    """Pairs of unlike skeletons of other sources with one profile, of a ratio of at least `least`.

    Different skeletons meet once, whatever the number of equations that share them, and only where their lengths and counts of
    characters allow the ratio: both bound the matching blocks from above. So no block is left out for its size.
    """
    rows = eqs.where(~F.col("skeleton").rlike(P.TRIVIAL_SKELETON))
    kinds = rows.groupBy("profile", "skeleton").agg(F.count_distinct("source").alias("sources"), F.min("source").alias("source")).withColumn("n", F.length("skeleton"))
    # The shorter is at least least / (2 - least) as long, so it is found within a few bands of lengths that grow by that factor.
    band = F.floor(F.log(F.greatest(F.col("n"), F.lit(1)).cast("double")) / math.log((2 - least) / least) if least < 1 else F.col("n")).cast("long")
    side = lambda x: kinds.select("profile", *(F.col(c).alias(f"{x}_{c}") for c in ("skeleton", "sources", "source", "n")), band.alias(f"{x}_band"))
    near_band = F.explode(F.array(F.col("b_band") - 1, F.col("b_band"), F.col("b_band") + 1)).alias("a_band")
    met = side("a").join(side("b").select("*", near_band), ["profile", "a_band"]).where("a_skeleton < b_skeleton")
    most = lambda x: F.transform(F.sequence(F.lit(0), F.lit(len(_COUNTED) - 1)), lambda i: F.length(F.col(x)) - F.length(F.replace(F.col(x), F.substring(F.lit(_COUNTED), i + 1, 1), F.lit(""))))
    total = F.col("a_n") + F.col("b_n")
    met = met.where((2 * F.least("a_n", "b_n") >= least * total) & (F.col("a_sources") + F.col("b_sources") > 2) | (2 * F.least("a_n", "b_n") >= least * total) & (F.col("a_source") != F.col("b_source")))
    # Characters that one has more of than the other can't match.
    apart = F.aggregate(F.zip_with(most("a_skeleton"), most("b_skeleton"), lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x)
    met = met.where(total - apart >= least * total).withColumn("ratio", text_ratio(F.col("a_skeleton"), F.col("b_skeleton"))).where(F.col("ratio") >= least).select("profile", "a_skeleton", "b_skeleton", "ratio")
    whole = lambda x: rows.select("profile", F.col("skeleton").alias(f"{x}_skeleton"), F.struct("doc", "item").alias(f"{x}_id"), F.col("nums").alias(f"{x}_nums"), F.col("source").alias(f"{x}_source"))
    near = met.join(whole("a"), ["profile", "a_skeleton"]).join(whole("b"), ["profile", "b_skeleton"]).where("a_source <> b_source")
    turned = F.col("a_id") > F.col("b_id")
    first, second = (lambda c, x=x, y=y: F.when(turned, F.col(f"{y}_{c}")).otherwise(F.col(f"{x}_{c}")) for x, y in (("a", "b"), ("b", "a")))
    near = near.select(first("id").alias("a_id"), second("id").alias("b_id"), "ratio", first("nums").alias("a_nums"), second("nums").alias("b_nums"))
    near = near.withColumns({"constants_agree": F.col("a_nums") == F.col("b_nums"), "first_diff": first_difference(F.col("a_nums"), F.col("b_nums")), "evidence": F.least(F.size("a_nums"), F.size("b_nums"))})
    return near.select("a_id", "b_id", "ratio", "constants_agree", "first_diff", "evidence").orderBy("constants_agree", F.desc("evidence"), F.desc("ratio"), "a_id", "b_id")


def first_difference(a: Column, b: Column) -> Column:
    """The first place where two arrays differ, a missing entry included; null if they are equal."""
    differs = F.transform(F.arrays_zip(a.alias("a"), b.alias("b")), lambda x: ~x.a.eqNullSafe(x.b))
    at = F.array_position(differs, F.lit(True))
    return F.when(at > 0, (at - 1).cast("int"))


def with_evidence(pairs: DataFrame) -> DataFrame:
    return pairs.where("evidence > 0")


def audited(classes: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Classes with their verdict, unaudited where there is none. verdicts: (skeleton, verdict)."""
    return classes.join(verdicts, "skeleton", "left").withColumn("verdict", F.coalesce("verdict", F.lit("unaudited")))


def entity_variants(names: DataFrame) -> DataFrame:
    """(key, names, tier, keep) of groups of names that differ in separators, marks or case alone."""
    grouped = names.select("name").distinct().withColumn("key", key_of_name(F.col("name"))).groupBy("key").agg(F.sort_array(F.collect_list("name")).alias("names")).where(F.size("names") > 1)
    keep = F.get(F.transform(F.sort_array(F.transform("names", lambda n: F.struct((-T.separators(n)).alias("s"), (-F.length(n)).alias("l"), n.alias("n")))), lambda x: x.n), F.lit(0))
    return grouped.withColumns({"tier": tier_of(F.col("names")), "keep": keep})


def wasted_slots(variants: DataFrame, retrieved: DataFrame) -> DataFrame:
    """(key, wasted) of variant groups: slots of query results that repeat a group. retrieved: (query, name)."""
    named = variants.select("key", F.explode("names").alias("name"))
    per = retrieved.join(named, "name").groupBy("query", "key").agg((F.count("*") - 1).alias("waste"))
    return named.select("key").distinct().join(per.groupBy("key").agg(F.sum("waste").alias("wasted")), "key", "left").select("key", F.coalesce("wasted", F.lit(0)).alias("wasted")).orderBy(F.desc("wasted"), "key")


def case_variants(names: DataFrame) -> DataFrame:
    """(lower, n, names) of names equal but for case."""
    return names.groupBy(F.lower("name").alias("lower")).agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("name")), " | ").alias("names")).where("n > 1")


def source_roots(sources: DataFrame) -> DataFrame:
    """(source, root): classes of sources declared the same work; the root is the least of the class.

    sources: (source, same_work_as array), which may name sources that have no row.
    """
    same = sources.select(F.col("source").alias("a"), F.explode("same_work_as").alias("b"))
    alone = sources.select(F.col("source").alias("a"), F.col("source").alias("b"))
    return components(same.union(alone)).withColumnRenamed("id", "source")


def reconcile(corpus: DataFrame, registry: DataFrame, ledger: DataFrame) -> DataFrame:
    """(doc, state) of corpus (doc), registry (doc, source, pdf_sha256), ledger (doc, digest):
    unregistered, no_ledger, hash_changed or ok; registered documents that are gone are stale."""
    r, d = registry.select("doc", F.lit(True).alias("registered"), "pdf_sha256"), ledger.select("doc", "digest")
    changed = (F.coalesce("pdf_sha256", F.lit("")) != "") & (F.col("pdf_sha256") != F.col("digest"))
    rows = corpus.join(r, "doc", "left").join(d, "doc", "left").select("doc", F.when(F.col("registered").isNull(), "unregistered").when(F.col("digest").isNull(), "no_ledger").when(changed, "hash_changed").otherwise("ok").alias("state"))
    return rows.unionByName(registry.join(corpus, "doc", "left_anti").select("doc", F.lit("stale").alias("state")))


def source_of(states: DataFrame, registry: DataFrame, roots: DataFrame) -> DataFrame:
    """(doc, source) of documents whose registration holds; others have none."""
    named = registry.join(states.where("state = 'ok'").select("doc"), "doc", "left_semi").where("source IS NOT NULL")
    return named.join(roots.withColumnRenamed("source", "s"), F.col("source") == F.col("s"), "left").select("doc", F.coalesce("root", "source").alias("source"))


#: How a file name tells its source.
NUMBERED, BOOK_OFFSETS, CHAPTER, HANDBOOK, SUPPLEMENT = r"^0(\d{4})_(\d+)", {9: "0xxxx-A", 6: "0xxxx-B"}, r"(?i)^(.*?)_CH\d", r"^([A-R]) [A-Z]", r"(?i)supplement|MOESM"


def propose_sources(docs: DataFrame) -> DataFrame:
    """(doc, source, why): a source by number, chapter cluster, handbook or supplement, else the document itself.

    A chapter's cluster is the shortest prefix that begins its own: prefixes are few, so they meet by their lengths' cuts.
    """
    index, chapter = (F.regexp_extract("doc", NUMBERED, 1).cast("int") / 100).cast("int"), F.regexp_extract("doc", NUMBERED, 2).cast("int")
    numbered = F.when(F.col("doc").rlike(NUMBERED), F.coalesce(*(F.when(index - k == chapter, F.lit(f"book:{v}")) for k, v in BOOK_OFFSETS.items())))
    rows = docs.select("doc", numbered.alias("numbered"), F.when(F.col("doc").rlike(CHAPTER), T.squash(F.regexp_extract("doc", CHAPTER, 1))).alias("prefix"))
    prefixes = rows.where("prefix IS NOT NULL").select(F.col("prefix").alias("p")).distinct()
    lengths = F.transform(F.sequence(F.lit(0), F.length("prefix")), lambda n: F.substring("prefix", 1, n))
    cuts = rows.where("prefix IS NOT NULL").select("doc", F.explode(lengths).alias("p")).join(prefixes, "p").groupBy("doc").agg(F.min_by("p", F.length("p")).alias("root"))
    out = rows.join(cuts, "doc", "left")
    source = F.when(F.col("numbered").isNotNull(), F.col("numbered")).when(F.col("root").isNotNull(), F.concat(F.lit("book:"), F.substring("root", 1, 60))).when(F.col("doc").rlike(HANDBOOK), "book:a-r-handbook").when(F.col("doc").rlike(SUPPLEMENT), None).otherwise(F.concat(F.lit("doc:"), F.col("doc")))
    why = F.when(F.col("numbered").isNotNull(), "number").when(F.col("root").isNotNull(), "chapter").when(F.col("doc").rlike(HANDBOOK), "handbook").when(F.col("doc").rlike(SUPPLEMENT), "supplement").otherwise("self")
    return out.select("doc", source.alias("source"), why.alias("why"))


def near_matches(names: DataFrame, labels: DataFrame) -> DataFrame:
    """(name, label): names that are no label but equal one but for white space and case."""
    n = names.join(labels.select(F.col("label").alias("name")), "name", "left_anti").select("name", T.squash(F.col("name")).alias("k"))
    return n.join(labels.select("label", T.squash(F.col("label")).alias("k")), "k").select("name", "label")


def find_image(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """(name, doc, file, ambiguous): images by file name or alias; more than one document refuses. index: (doc, file, alias)."""
    known = index.select("doc", "file", F.explode(F.array("file", "alias")).alias("name")).distinct()
    hits = wanted.join(known, "name").groupBy("name").agg(F.count_distinct("doc").alias("n"), F.min("doc").alias("doc"), F.min("file").alias("file"))
    return hits.select("name", F.when(F.col("n") == 1, F.col("doc")).alias("doc"), F.when(F.col("n") == 1, F.col("file")).alias("file"), (F.col("n") > 1).alias("ambiguous"))


def figure_index(items: DataFrame, slug: Column) -> DataFrame:
    """(doc_id, ordinal, file, alias, page, caption) of the items with an image, in order; aliases carry the document's fingerprint."""
    rows = items.where(F.coalesce("img_path", F.lit("")) != "").withColumn("ordinal", F.row_number().over(W.partitionBy("doc_id").orderBy("item_idx")))
    page = F.coalesce("page_idx", F.lit(0)) + 1
    ending = F.regexp_extract("img_path", r"(\.[^./]+)$", 1)
    alias = F.concat(slug, F.lit("-"), F.substring(F.sha1("doc_id"), 1, 6), F.format_string("-p%02d-%02d", page, "ordinal"), F.when(ending == "", ".jpg").otherwise(ending))
    some = lambda c: F.nullif(T.stripped(F.array_join(F.filter(F.col(c), lambda x: ~T.is_blank(x)), " ")), F.lit(""))
    return rows.select("doc_id", "ordinal", F.element_at(F.split("img_path", "/"), -1).alias("file"), alias.alias("alias"), page.alias("page"), F.coalesce(some("image_caption"), some("chart_caption"), some("table_caption"), F.lit("")).alias("caption"))
