"""Points within spans: an equi-join by bins, with the bounds tested on what meets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.storage import hinted, settled

#: Bins of a level are so many times as wide as those of the one below; a span lies in at most one more of them.
FACTOR = 8
#: Points of one bin that meet its spans in one group; more are dealt to several, each with all the bin's spans.
HOT_POINTS = 50_000


def within(points: DataFrame, spans: DataFrame, width: int, keys: list[str] | None = None, hot: int = HOT_POINTS) -> DataFrame:
    """Every point (at, and more) with every span (low, high, and more) that holds it, ends included; keys must be equal too.

    at, low and high are whole numbers; null ones, and spans that end before they begin, meet nothing. Columns but keys must
    not share names. width: of the finest bins, best about a usual span's length. A longer span goes to a level with wider bins,
    so no span is more than FACTOR + 1 rows, and a point is one row for each level that spans use. Bins of very many points
    are split, so neither a frequent time nor a frequent key gathers its rows in one task.
    """
    keys = keys or []
    # The level of a span: the least whose bins are no more than FACTOR times narrower than the span.
    size = (F.col("high") - F.col("low")).cast("decimal(38,0)")
    spans = spans.where("low <= high")
    levels, top = [width], spans.agg(F.max(size)).first()[0]
    while top is not None and levels[-1] * FACTOR < top:
        levels.append(levels[-1] * FACTOR)
    level = F.lit(0)
    for i, w in enumerate(levels[:-1]):
        level = F.when(size > w * FACTOR, i + 1).otherwise(level)
    held = spans.withColumn("__level", level)
    first, last = (_bin(F.col(c), F.col("__level"), levels) for c in ("low", "high"))
    held = held.withColumn("__bin", F.explode(F.sequence(first, last)))
    # A point is a row for each level in use; there are few.
    found = [r[0] for r in held.select("__level").distinct().collect()]
    given = points.where("at IS NOT NULL").withColumn("__level", F.explode(F.array(*(F.lit(x) for x in sorted(found))).cast("array<int>")))
    given = given.withColumn("__bin", _bin(F.col("at"), F.col("__level"), levels))
    at = [*keys, "__level", "__bin"]
    crowded = settled(given.groupBy(*at).agg(F.count("*").alias("n")).where(F.col("n") > hot).select(*at, F.ceil(F.col("n") / hot).cast("int").alias("__slices")))
    if crowded.limit(1).count():
        crowded = hinted(crowded)
        slices = F.coalesce(F.col("__slices"), F.lit(1))
        given = given.join(crowded, at, "left").withColumn("__slice", F.pmod(F.xxhash64(*points.columns), slices).cast("int")).drop("__slices")
        held = held.join(crowded, at, "left").withColumn("__slice", F.explode(F.sequence(F.lit(0), slices - 1))).drop("__slices")
        at = [*at, "__slice"]
    return given.join(held, at).where("at BETWEEN low AND high").drop("__level", "__bin", "__slice")


def _bin(value: Column, level: Column, levels: list[int]) -> Column:
    """The bin of a whole number at a level."""
    w = F.element_at(F.array(*(F.lit(x) for x in levels)), level + 1)
    return F.call_function("div", value - F.pmod(value, w), w)
