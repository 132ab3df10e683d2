"""Layout rules: which items of a document are furniture. Every rule plans; plans.mute applies.

A plan is rows (doc_id, item_idx, rule, action, signal, why): action mute or held. Windows and aggregates are per document,
so documents are the unit of parallel work; nothing crosses them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T
from ..plans.storage import hinted, settled

PLAN = ["doc_id", "item_idx", "rule", "action", "signal", "why"]


def _plan(rows: DataFrame, rule: str) -> DataFrame:
    return rows.select("doc_id", "item_idx", F.lit(rule).alias("rule"), "action", F.col("signal").cast("string").alias("signal"), F.col("why").cast("string").alias("why"))


def page_counts(items: DataFrame) -> DataFrame:
    return items.groupBy("doc_id").agg((F.coalesce(F.max("page_idx"), F.lit(-1)) + 1).alias("n_pages"))


def _band(items: DataFrame, low: int, high: int, names: tuple[str, str]) -> DataFrame:
    """Per document: the k-th least of one edge and the k-th greatest of the other, k a tenth; null below five paragraphs."""
    body = items.where((F.col("type") == "text") & (F.size("bbox") >= 4) & ~T.is_blank(F.col("text")))
    sorted_ = body.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.col("bbox")[low])).alias("a"), F.sort_array(F.collect_list(F.col("bbox")[high])).alias("b"))
    n = F.size("a")
    k = F.floor(n * P.BODY_EDGE_PERCENT / 100).cast("int")
    known = n >= P.BODY_LEAST_PARAGRAPHS
    return sorted_.select("doc_id", F.when(known, F.get("a", k)).alias(names[0]), F.when(known, F.get("b", n - 1 - k)).alias(names[1]))


def body_band(items: DataFrame) -> DataFrame:
    return _band(items, 1, 3, ("top", "bottom"))


def body_hband(items: DataFrame) -> DataFrame:
    return _band(items, 0, 2, ("left_edge", "right_edge"))


def outside_body(box: Column, top: Column, bottom: Column) -> Column:
    return F.coalesce((F.size(box) >= 4) & ((F.get(box, F.lit(3)) <= top) | (F.get(box, F.lit(1)) >= bottom)), F.lit(False))


def noise_plan(items: DataFrame, n_pages: DataFrame | None = None) -> DataFrame:
    """Headers, footers and side text: muted if repeated, on the cover, outside the body, boilerplate or gibberish; else held."""
    owned = items.where(F.col("type").isin(P.NOISE_TYPES)).withColumns({"literal": T.stripped(T.filled(F.col("text"))), "template": T.template_key(T.filled(F.col("text")))})
    n = F.greatest(F.count("*").over(W.partitionBy("doc_id", "literal")), F.count("*").over(W.partitionBy("doc_id", "template")))
    rows = owned.withColumn("n", n).where("literal <> ''").join(n_pages if n_pages is not None else page_counts(items), "doc_id", "left").join(body_band(items), "doc_id", "left")
    gibberish = (F.col("type") == "aside_text") & T.is_gibberish(F.col("text"))
    signal = (
        F.when(F.col("n") >= T.head_threshold(F.coalesce("n_pages", F.lit(0))), "repeat")
        .when(F.coalesce(F.col("page_idx") == 0, F.lit(False)), "cover")
        .when(outside_body(F.col("bbox"), F.col("top"), F.col("bottom")), "edge")
        .when(T.is_publisher_boilerplate(F.col("text")), "publisher")
        .when(gibberish, "gibberish")
    )
    rows = rows.withColumn("signal", signal).withColumn("action", F.when(F.col("signal").isNotNull(), "mute").otherwise("held"))
    return _plan(rows.withColumn("why", F.col("n")), "noise")


def reference_plan(items: DataFrame) -> DataFrame:
    """Reference and acknowledgement sections, from a heading of the kind to the next one as high or a resumption of the body.

    Which sections open depends on which items earlier ones muted, so documents are folded in order, one after another in
    each task; a task keeps the open sections of one document at a time. Only documents that hold a heading of the kind or
    an item marked as a reference are moved at all.
    """
    level = F.coalesce("text_level", F.lit(0))
    kind = F.when(level > 0, T.section_kind(F.col("text")))
    concerned = settled(items.where(kind.isNotNull() | (F.col("sub_type") == "ref_text")).select(F.col("doc_id").alias("concerned")).distinct())
    held = items.join(hinted(concerned), F.col("doc_id").eqNullSafe(F.col("concerned")), "left_semi")
    rows = held.select("doc_id", "item_idx", "type", "sub_type", level.alias("level"), kind.alias("kind"), T.resumes_body(F.col("text")).alias("resumes"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, opened = None, []  # the document, and level and kind of the sections that go on in it, the first to open first
        for batch in batches:
            docs, at, signals = [], [], []
            for doc, index, kind_of, sub, level, kind, resumes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if doc != here:
                    here, opened = doc, []
                furniture = kind_of in P.NOISE_TYPES
                if opened and (level > 0 or resumes):
                    opened = [x for x in opened if not (0 < level <= x[0] or resumes)]
                if level > 0 and kind and (furniture or not opened):
                    opened.append((level, kind))  # furniture is never muted here, so a heading in it opens its own
                signal = opened[0][1] if opened and not furniture else "reference" if sub == "ref_text" else None
                if signal:
                    docs.append(doc)
                    at.append(index)
                    signals.append(signal)
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.string()), pa.array(at, pa.int32()), pa.array(signals, pa.string())], names=["doc_id", "item_idx", "signal"])

    ordered = rows.repartition("doc_id").sortWithinPartitions("doc_id", "item_idx")
    muted = ordered.mapInArrow(fold, "doc_id string, item_idx int, signal string")
    return _plan(muted.withColumns({"action": F.lit("mute"), "why": F.lit(None)}), "reference")


def reference_spans(items: DataFrame) -> DataFrame:
    """(doc_id, item_idx, kind, span_end) of every heading of the kind, by windows alone: the end is the first later item as
    high or a resumption, or the document's length. For documents whose sections do not nest."""
    level = F.coalesce("text_level", F.lit(0))
    heads = items.where((level > 0) & T.section_kind(F.col("text")).isNotNull()).select("doc_id", "item_idx", level.alias("level"), T.section_kind(F.col("text")).alias("kind"))
    stops = items.where((level > 0) | T.resumes_body(F.col("text"))).select("doc_id", F.col("item_idx").alias("stop"), level.alias("stop_level"), T.resumes_body(F.col("text")).alias("resumes"))
    joined = heads.join(stops, "doc_id", "left")
    ends = (F.col("stop") > F.col("item_idx")) & (((F.col("stop_level") > 0) & (F.col("stop_level") <= F.col("level"))) | F.col("resumes"))
    spans = joined.groupBy("doc_id", "item_idx", "level", "kind").agg(F.min(F.when(ends, F.col("stop"))).alias("end"))
    sizes = items.groupBy("doc_id").agg((F.max("item_idx") + 1).alias("size"))
    return spans.join(sizes, "doc_id").select("doc_id", "item_idx", "kind", F.coalesce("end", "size").alias("span_end"))


def title_index(items: DataFrame) -> DataFrame:
    """(doc_id, title_idx, reason): the item that holds the title, or why there is none. Only where a title that is not the
    first item depends on it are the first page's lines looked at for an anchor."""
    page = F.coalesce("page_idx", F.lit(0))
    head = F.col("item_idx") < P.TITLE_LOOKAHEAD
    facts = items.groupBy("doc_id").agg(
        F.max(F.when(F.col("item_idx") == 0, F.coalesce(F.col("text_level") == 1, F.lit(False)))).alias("first_is_title"),
        F.max(F.when(F.col("item_idx") == 0, page)).alias("first_page"),
        F.min(F.when(head & (page != 0), F.col("item_idx"))).alias("turn"),
        F.min(F.when(head & (F.col("text_level") == 1), F.col("item_idx"))).alias("found"),
    )
    facts = settled(facts)
    behind = F.col("found").isNotNull() & (F.col("turn").isNull() | (F.col("found") < F.col("turn")))
    open_ = settled(facts.where(behind & ~F.coalesce("first_is_title", F.lit(False))).select(F.col("doc_id").alias("open")))
    lines = items.where(F.col("type").isin(P.TITLE_TYPES) & (page == 0)).join(hinted(open_), F.col("doc_id").eqNullSafe(F.col("open")), "left_semi")
    signal = T.title_signal(T.stripped(T.filled(F.col("text"))), bare=True)
    anchors = lines.select(F.col("doc_id").alias("anchor"), F.coalesce(signal.isin(P.ANCHORS), F.lit(False)).alias("is")).where("is").select("anchor").distinct()
    facts = facts.join(anchors.withColumn("anchored", F.lit(True)), F.col("doc_id").eqNullSafe(F.col("anchor")), "left").withColumn("anchored", F.coalesce("anchored", F.lit(False)))
    index = F.when(F.col("first_is_title"), F.when(F.col("first_page") == 0, 0)).when(behind & F.col("anchored"), F.col("found"))
    reason = F.when(index.isNotNull(), "").when(F.col("first_is_title"), "not on page 0").when(behind, "no anchor").otherwise("no title")
    return facts.select("doc_id", index.cast("int").alias("title_idx"), reason.alias("reason"))


#: A title stands among the items looked ahead at, so what ends its block, or is in it, stands here at the latest.
LAST_OF_SPAN = P.TITLE_LOOKAHEAD + 1 + P.TITLE_SPAN


def title_span(items: DataFrame) -> DataFrame:
    """(doc_id, title_idx, span_end, reason): items after the title up to a heading, another page or 25 of them."""
    titles = settled(title_index(items))  # a row a document, read twice
    stops = items.where(F.col("item_idx") <= LAST_OF_SPAN).join(titles, "doc_id").where((F.col("item_idx") > F.col("title_idx")) & ((F.coalesce("text_level", F.lit(0)) != 0) | (F.coalesce("page_idx", F.lit(0)) != 0)))
    first = stops.groupBy("doc_id").agg(F.min("item_idx").alias("stop"))
    sizes = items.groupBy("doc_id").agg((F.max("item_idx") + 1).alias("size"))
    end = F.least(F.coalesce("stop", "size"), F.col("title_idx") + 1 + P.TITLE_SPAN)
    return titles.join(first, "doc_id", "left").join(sizes, "doc_id").select("doc_id", "title_idx", F.when(F.col("title_idx").isNotNull(), end).alias("span_end"), "reason")


def title_plan(items: DataFrame) -> DataFrame:
    """Signalled lines of the title block are muted, other lines held; page-0 footnotes count without a block."""
    near = (F.col("item_idx") <= LAST_OF_SPAN) | (F.col("type") == "page_footnote")
    rows = items.where(F.col("type").isin(P.TITLE_TYPES) & near).join(title_span(items), "doc_id").withColumn("bare", T.stripped(F.col("text"))).where("bare <> ''")
    in_span = (F.col("item_idx") > F.col("title_idx")) & (F.col("item_idx") < F.col("span_end"))
    t = F.col("bare")
    foot = F.when((F.col("type") == "page_footnote") & (F.coalesce("page_idx", F.lit(0)) == 0), F.when(t.rlike(P.PUBLICATION), "publication").when(T.is_correspondence(t), "correspondence"))
    block = F.coalesce(in_span, F.lit(False))
    signal = F.coalesce(F.when(F.col("block"), T.title_signal(t, bare=True)), foot)
    # Exploding the one signal finds it once; a filter on it would be pushed down and find it again.
    rows = rows.withColumn("block", block).where(F.col("block") | (F.col("type") == "page_footnote")).withColumn("signal", F.explode(F.array(signal))).where("signal IS NOT NULL OR block")
    rows = rows.withColumn("action", F.when(F.col("signal").isNotNull(), "mute").otherwise("held"))
    return _plan(rows.withColumn("why", F.when(F.col("action") == "held", T.held_reason(F.col("text")))), "title")


def _unclaimed(items: DataFrame, claimed: DataFrame | None) -> DataFrame:
    """Items that hold text and that no earlier rule mutes."""
    rows = items.where(~T.is_blank(F.col("text")))
    return rows if claimed is None else rows.join(claimed.where("action = 'mute'").select("doc_id", "item_idx"), ["doc_id", "item_idx"], "left_anti")


def wrapper_pages(items: DataFrame) -> DataFrame:
    """(doc_id, markers, longest, fires): is page 0 a publisher's wrapper?"""
    page = items.where("page_idx = 0").select("doc_id", "item_idx", T.stripped(T.filled(F.col("text"))).alias("t"))
    blob = page.groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("item_idx", "t"))), lambda x: x.t), "\n").alias("blob"), F.max(F.length("t")).alias("longest"))
    # Exploded, so that the long text is searched once for all that asks for the count.
    blob = blob.select("doc_id", "longest", F.explode(F.array(T.distinct_markers(F.col("blob")))).alias("markers"))
    fires = (F.col("markers") > 0) & ~((F.col("longest") >= P.BODY_PARAGRAPH_CHARS) & (F.col("markers") < P.MARKERS_WAIVING_LENGTH))
    return blob.select("doc_id", "markers", "longest", fires.alias("fires"))


def cover_plan(items: DataFrame, claimed: DataFrame | None = None) -> DataFrame:
    fires = settled(wrapper_pages(items).where("fires").select("doc_id"))
    rows = _unclaimed(items.where("page_idx = 0").join(hinted(fires), "doc_id", "left_semi"), claimed)
    return _plan(rows.withColumns({"action": F.lit("mute"), "signal": F.lit("wrapper_page"), "why": F.lit(None)}), "cover")


def margin_side(box: Column, left: Column, right: Column) -> Column:
    known = F.size(box) >= 4
    return F.when(known & (F.get(box, F.lit(2)) <= left), "left_margin").when(known & (F.get(box, F.lit(0)) >= right), "right_margin")


def margin_plan(items: DataFrame, claimed: DataFrame | None = None) -> DataFrame:
    """Items of any type wholly left or right of the body."""
    rows = _unclaimed(items, claimed).join(body_hband(items), "doc_id").withColumn("signal", margin_side(F.col("bbox"), F.col("left_edge"), F.col("right_edge")))
    return _plan(rows.where("signal IS NOT NULL").withColumns({"action": F.lit("mute"), "why": F.lit(None)}), "margin")


def table_plan(items: DataFrame, pages: DataFrame) -> DataFrame:
    """Tables that are not in order, with their boxes in points of the reference page; repairable unless only thin or boxless."""
    tables = items.where("type = 'table'").withColumn("klass", T.table_class(F.coalesce("has_table_body", F.lit(False)), F.col("table_body"))).where("klass <> 'ok'")
    size = reference_page_size(pages)
    boxed = F.size("bbox") == 4
    caption = F.array_join(F.filter(F.coalesce("table_caption", F.array().cast("array<string>")), lambda x: ~T.is_blank(x)), " ")
    rows = tables.join(size, "doc_id", "left")
    return rows.select(
        "doc_id", "item_idx", "page_idx", "klass", F.when(boxed, T.bbox_points(F.col("bbox"), F.col("width"), F.col("height"))).alias("bbox_pt"),
        caption.alias("caption"), F.length(T.table_text(F.col("table_body"))).alias("text_len"), F.col("klass").isin("missing_key", "empty_shell").alias("repairable"),
    )


def chart_plan(items: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Charts to be made images, and those whose image file is missing (dangling). files: (doc_id, img_path) that exist."""
    charts = items.where("type = 'chart'").select("doc_id", "item_idx", F.coalesce("page_idx", F.lit(0)).alias("page_idx"), F.coalesce("img_path", F.lit("")).alias("img_path"), T.stripped(F.coalesce(_first_text("chart_caption"), _first_text("image_caption"), F.lit(""))).alias("caption"))
    if files is None:
        return charts.withColumn("action", F.when(F.col("img_path") == "", "dangling").otherwise("convert"))
    there = charts.join(files.select("doc_id", "img_path", F.lit(True).alias("there")).distinct(), ["doc_id", "img_path"], "left")
    return there.withColumn("action", F.when(F.col("there"), "convert").otherwise("dangling")).drop("there")


def _first_text(column: str) -> Column:
    return F.get(F.filter(F.col(column), lambda x: ~T.is_blank(x)), F.lit(0))


#: Fixed values, in points and dots an inch: what a crop takes in around a table, and around an equation by axis.
TABLE_PAD, EQUATION_PADS, CROP_DPI = 6.0, (4.0, 1.0), 300


def crop_rectangles(regions: DataFrame, pad: float = TABLE_PAD, pad_y: float | None = None, dpi: int = CROP_DPI) -> DataFrame:
    """regions (page_idx, bbox_pt, width, height and others) with what a renderer is asked for: page from 1, rect in points
    within the page, pixels [x, y, width, height], and whether the rectangle is valid at all."""
    high = pad if pad_y is None else pad_y
    box, zero = F.col("bbox_pt"), F.lit(0.0)
    rect = F.array(F.greatest(zero, box[0] - pad), F.greatest(zero, box[1] - high), F.least(F.col("width"), box[2] + pad), F.least(F.col("height"), box[3] + high))
    rows = regions.withColumn("rect", rect).withColumn("page", F.col("page_idx") + 1)
    r, scale = F.col("rect"), dpi / 72.0
    pixels = F.array(*((x * scale).cast("int") for x in (r[0], r[1], r[2] - r[0], r[3] - r[1])))
    return rows.withColumns({"pixels": pixels, "valid": (r[2] > r[0]) & (r[3] > r[1])})


def page_size_spread(pages: DataFrame) -> DataFrame:
    size = F.col("page_size")
    return pages.groupBy("doc_id").agg((F.max(size[0]) - F.min(size[0])).alias("dw"), (F.max(size[1]) - F.min(size[1])).alias("dh"))


def reference_page_size(pages: DataFrame) -> DataFrame:
    """The commonest page size of a document; of equally common ones the first to appear."""
    sizes = pages.groupBy("doc_id", F.col("page_size")[0].alias("width"), F.col("page_size")[1].alias("height")).agg(F.count("*").alias("n"), F.min("page_pos").alias("first"))
    best = F.min_by(F.struct("width", "height"), F.struct(-F.col("n"), F.col("first")))
    return sizes.groupBy("doc_id").agg(best.alias("s")).select("doc_id", "s.width", "s.height")


def cropping_mismatch(pages: DataFrame, tables: DataFrame, tolerance: float = 2.0) -> DataFrame:
    """Pages with repairable tables whose size is off the reference by more than the tolerance."""
    off = pages.join(reference_page_size(pages), "doc_id").where((F.abs(F.col("page_size")[0] - F.col("width")) > tolerance) | (F.abs(F.col("page_size")[1] - F.col("height")) > tolerance))
    return off.join(tables.where("repairable").select("doc_id", "page_idx").distinct(), ["doc_id", "page_idx"], "left_semi").select("doc_id", "page_idx")
