"""Near strings: pairs within an edit distance, found by shared segments; longest common subsequences."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import unicode
from ..functions.vectorised import vectorised
from ..plans.storage import settled


def _begin(length: Column, number: Column, parts: int) -> Column:
    """Where segment `number` of an even cut of a string of this length begins; the last segments are the longer ones."""
    short, left = F.floor(length / parts), length % parts
    return (number * short + F.greatest(number - (F.lit(parts) - left), F.lit(0))).cast("int")


def near_pairs(rows: DataFrame, distance: int) -> DataFrame:
    """(a, b, distance, left_text, right_text) of all pairs of different texts of rows (id, text) within an edit distance.

    a and b are the least ids of their texts, left_text comes before right_text. A string is cut evenly into distance + 1
    segments. Edits leave one whole, so of two near strings the longer one holds a segment of the shorter; and if it is the
    i-th, it is moved by less than the edits before and after it, so only few places are looked up. Pairs that meet are
    verified within a band. No block is too large and none is left out; null texts have no pairs.
    """
    parts = distance + 1
    texts = settled(rows.where("text IS NOT NULL").groupBy("text").agg(F.min("id").alias("id")).withColumn("n", F.length("text")))
    number = F.explode(F.sequence(F.lit(0), F.lit(distance)))
    cut = texts.withColumn("i", number).withColumn("at", _begin(F.col("n"), F.col("i"), parts))
    held = cut.select("id", "text", "n", "i", F.substring("text", F.col("at") + 1, _begin(F.col("n"), F.col("i") + 1, parts) - F.col("at")).alias("segment"))
    # Of each text and each length it may be near to: the substrings that may be that one's segments.
    asks = texts.select(F.col("id").alias("b"), F.col("text").alias("other"), F.col("n").alias("long"), F.explode(F.sequence(F.greatest(F.col("n") - distance, F.lit(0)), F.col("n"))).alias("n"))
    asks = asks.withColumn("i", number).withColumn("at", _begin(F.col("n"), F.col("i"), parts)).withColumn("size", _begin(F.col("n"), F.col("i") + 1, parts) - F.col("at"))
    more = F.col("long") - F.col("n")
    first = F.greatest(F.lit(0), F.col("at") - F.col("i"), F.col("at") + more - (distance - F.col("i")))
    last = F.least(F.col("long") - F.col("size"), F.col("at") + F.col("i"), F.col("at") + more + (distance - F.col("i")))
    places = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    asks = asks.select("b", "other", "n", "i", "size", F.explode(places).alias("place")).select("b", "other", "n", "i", F.substring("other", F.col("place") + 1, F.col("size")).alias("segment"))
    asks = asks.distinct()
    met = held.select(F.col("id").alias("a"), "text", "n", "i", "segment").join(asks, ["n", "i", "segment"])
    # Of equal lengths each pair meets from both sides; strings that share many segments meet once for each.
    met = met.where((F.length("text") < F.length("other")) | (F.col("text") < F.col("other"))).select("a", "b", "text", "other").distinct()
    near = met.withColumn("distance", F.levenshtein("text", "other", distance)).where("distance >= 0")
    turned = F.col("text") > F.col("other")
    return near.select(F.when(turned, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(turned, F.col("a")).otherwise(F.col("b")).alias("b"), "distance", F.least("text", "other").alias("left_text"), F.greatest("text", "other").alias("right_text"))


@vectorised("int")
def lcs(a: pd.Series, b: pd.Series) -> pd.Series:
    """Lengths of the longest common subsequences of two columns, in characters; null where one is."""
    return pd.Series([unicode.lcs(x, y) if x is not None and y is not None else None for x, y in zip(a, b, strict=True)], dtype="Int32")
