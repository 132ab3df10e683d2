"""Line dedup by site-relative frequency, in DataFrame operations only."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: A line goes from every page of a host if over this share of the host's pages hold it, and at least so many pages.
RATIO, MIN_PAGES = 0.10, 3
#: The boilerplate lines of all hosts are broadcast up to so many; beyond, the join shuffles.
BROADCAST_LINES = 500_000


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), "\n")


def _worded(line: Column) -> Column:
    return line.rlike("[^\\x20\\x09-\\x0D]")


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """Rows (host, line, pages, host_pages): hashes of the lines with a word on over `ratio` of the host's pages.

    Each page counts a line once. Counts are aggregated per task before the shuffle, by host and line, so a large host is
    spread over its lines; only lines on min_pages pages or more meet the host totals.
    """
    pages = docs.select(F.col(f"`{host}`").alias("host"), F.array_distinct(F.transform(F.filter(_lines(text), _worded), lambda x: F.xxhash64(x))).alias("lines"))
    counts = pages.select("host", F.explode("lines").alias("line")).groupBy("host", "line").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages)
    totals = docs.groupBy(F.col(f"`{host}`").alias("site")).agg(F.count("*").alias("host_pages"))
    return counts.join(totals, F.col("host").eqNullSafe(F.col("site"))).where(F.col("pages") > ratio * F.col("host_pages")).select("host", "line", "pages", "host_pages")


def drop_boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """docs with the boilerplate lines of their hosts taken out of text, and columns lines_before and lines_dropped.

    Every row stays, in all its columns; names that clash with the two are replaced. A null text stays null and has no
    lines (0, 0); null hosts are one host; lines without a word stay; lines are compared whole, by a 64-bit hash. A line
    on exactly the ratio of pages stays. A host's boilerplate lines are fewer than its mean number of lines a page over
    the ratio, so the list of a host is bounded whatever the number of its pages.
    """
    mine = uuid.uuid4().hex  # in the names of columns on the way, so that none of docs can clash
    gone, site, left_over = (f"__{x}_{mine}" for x in ("gone", "site", "left"))
    found = boilerplate(docs, host, text, ratio, min_pages)
    lists = cut(found.groupBy("host").agg(F.collect_set("line").alias(gone)).withColumnRenamed("host", site), "lines")
    total = lists.agg(F.coalesce(F.sum(F.size(gone)), F.lit(0))).first()[0]
    side = F.broadcast(lists) if total <= BROADCAST_LINES else lists
    joined = docs.join(side, F.col(f"`{host}`").eqNullSafe(F.col(site)), "left")
    parts = _lines(text)
    left = F.filter(parts, lambda x: ~(_worded(x) & F.coalesce(F.array_contains(gone, F.xxhash64(x)), F.lit(False))))
    joined = joined.withColumn(left_over, F.when(F.col(gone).isNotNull(), left).otherwise(parts))
    present = F.col(f"`{text}`").isNotNull()
    out = {
        text: F.when(F.col(gone).isNull(), F.col(f"`{text}`")).when(present, F.array_join(left_over, "\n")),
        "lines_before": F.when(present, F.size(parts)).otherwise(0).cast("long"),
        "lines_dropped": F.when(present, F.size(parts) - F.size(left_over)).otherwise(0).cast("long"),
    }
    made = {f"__new_{mine}_{c}": x for c, x in out.items()}
    joined = joined.withColumns(made).drop(gone, site, left_over)
    new = lambda c: F.col(f"`__new_{mine}_{c}`").alias(c)
    return joined.select(*(new(c) if c in out else F.col(f"`{c}`") for c in docs.columns), *(new(c) for c in out if c not in docs.columns))
