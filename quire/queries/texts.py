"""Texts against texts over the data tables: known passages, near strings, common subsequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import needles, strings

#: A line that so many documents hold, and of so many characters, is a template.
TEMPLATE_DOCS, TEMPLATE_CHARS = 4, 20


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def passage_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place of every benchmark passage, and of every line that is a template of several documents, in the documents."""
    docs = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), "text")
    lines = docs.select("doc", F.explode(F.array_distinct(F.split("text", "\n"))).alias("text")).where(F.length("text") >= TEMPLATE_CHARS)
    lines = lines.groupBy("text").agg(F.count_distinct("doc").alias("n")).where(F.col("n") >= TEMPLATE_DOCS)
    known = _t(spark, sf_dir, "benchmark").select(F.concat(F.lit("item "), "item_id").alias("needle"), "text")
    known = known.unionByName(lines.select(F.concat(F.lit("line "), F.md5("text")).alias("needle"), "text"))
    return needles.occurrences(docs, known)


def near_first_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of different first lines of documents within an edit distance of 3, characters beyond ASCII as question marks."""
    first = F.regexp_replace(F.get(F.split("text", "\n"), F.lit(0)), r"[^\x00-\x7F]", "?")
    rows = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), first.alias("text"))
    return strings.near_pairs(rows, 3).select("a", "b", "distance")


def turn_subsequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest common subsequence of each turn with the one before it in its conversation, in characters."""
    turns = _t(spark, sf_dir, "conversations").withColumn("before", F.lag("text").over(W.partitionBy("conv_id").orderBy("turn")))
    return turns.where("before IS NOT NULL AND text IS NOT NULL").select("conv_id", "turn", F.length("text").alias("chars"), strings.lcs(F.col("before"), F.col("text")).alias("shared"))


SQL = {
    "passage_places": f"""WITH l AS (SELECT doc_id, unnest(list_distinct(string_split(text, chr(10)))) AS line FROM documents), k AS (SELECT 'item ' || item_id AS needle, text FROM benchmark WHERE text <> '' UNION ALL SELECT 'line ' || md5(line), line FROM l WHERE length(line) >= {TEMPLATE_CHARS} GROUP BY line HAVING count(DISTINCT doc_id) >= {TEMPLATE_DOCS}),
      p AS (SELECT needle, doc_id, length(k.text) AS size, list_transform(string_split(d.text, k.text), lambda x: length(x)) AS parts FROM k JOIN documents d ON contains(d.text, k.text))
      SELECT needle, doc_id AS doc, unnest(list_transform(range(1, len(parts)), lambda i: list_sum(list_slice(parts, 1, i))::BIGINT + (i - 1) * size)) AS start FROM p""",
    "near_first_lines": r"""WITH f AS (SELECT regexp_replace(string_split(text, chr(10))[1], '[^\x00-\x7F]', '?', 'g') AS t, min(doc_id) AS id FROM documents WHERE text IS NOT NULL GROUP BY t)
      SELECT x.id AS a, y.id AS b, levenshtein(x.t, y.t)::INTEGER AS distance FROM f x JOIN f y ON x.t < y.t AND abs(length(x.t) - length(y.t)) <= 3 WHERE levenshtein(x.t, y.t) <= 3""",
}

QUERIES = {f.__name__: f for f in (passage_places, near_first_lines, turn_subsequences)}
