"""Queries over odd rows against their SQL: what the small tables don't hold and larger ones do."""

import random

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
from conftest import canonical
from pyspark.sql import Window
from pyspark.sql import functions as F
from test_queries import ALL, SQL

from quire.functions import patterns as P
from quire.functions import text as T
from quire.operators import layout, retrieval


def same_rows(spark, folder, name, **tables):
    con = duckdb.connect()
    for t, data in tables.items():
        pq.write_table(data, f"{folder}/{t}.parquet")
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    got, want = ALL[name](spark, str(folder)), con.sql(SQL[name])
    rows = got.collect()
    assert canonical(rows, got.columns) == canonical(want.fetchall(), want.columns)
    return rows


def documents(texts, ids=None):
    return pa.table({"doc_id": pa.array(ids or range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})


def test_parse_severity(spark, tmp_path):
    texts = ["q w" + " e r t y u" * 20_000, "sí y la y de y é", "oh la y de la y té", "a b c d é", "x d e f g h_ z", "x\x0bb\x0bc\x0bd\x0be\x0bf", " ", "\x0b", " \t\n \n\f", "", None, "Worſe", "World Athleticſ", "ok", "\n" * 90 + "end", "$b c d e f g$ x"]
    rows = same_rows(spark, tmp_path, "parse_severity", documents=documents(texts + ["lost", "w\n" * 50], [*range(len(texts)), None, None]))
    assert {r["doc_id"] for r in rows if r["mangled"]} >= {"0", "2"}


def test_nearest_of_odd_vectors(spark, monkeypatch):
    """Scores, ties and nulls as the plain expression has them, over many blocks."""
    rng = random.Random(7)
    inf, nan = float("inf"), float("nan")
    odd = [None, [], [0.0] * 4, [1.0, None, 0.0, 0.0], [nan, 1.0, 0.0, 0.0], [inf, 1.0, 0.0, 0.0], [1.0, 0.0], [1e-160] * 4, [1e-170, 0.0, 0.0, 0.0], [1e200] * 4, [-1.0, -2.0, -3.0, -4.0]]
    vectors = [[rng.gauss(0, 1) for _ in range(4)] for _ in range(300)] + odd + [[1.0, 2.0, 3.0, 4.0]] * 40 + [[2.0, 4.0, 6.0, 8.0]] * 40
    monkeypatch.setattr(retrieval, "VECTORS", 32)
    monkeypatch.setattr(retrieval, "QUERIES", 16)
    monkeypatch.setattr(retrieval, "STRIP", 5)
    rows = spark.createDataFrame([(f"é{i % 7}x{i}", v) for i, v in enumerate(vectors)], "id string, vector array<double>").repartition(3)
    for wide in ("double", "float"):
        own = rows.withColumn("vector", F.col("vector").cast(f"array<{wide}>"))
        asked = own.where("substring(id, -1) IN ('0', '5', '9') OR size(vector) <> 4")
        for k in (1, 20, 500):
            pairs = own.select("id", F.col("vector").alias("v")).crossJoin(asked.select(F.col("id").alias("query"), F.col("vector").alias("q"))).select("query", "id", retrieval.cosine(F.col("q"), F.col("v")).alias("score"))
            want = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))).where(F.col("rank") <= k)
            assert sorted(map(repr, retrieval.top_k(asked, own, k).collect())) == sorted(map(repr, want.collect()))
    assert retrieval.top_k(rows.where("false"), rows).count() == retrieval.top_k(rows, rows.where("false")).count() == 0
    plan = retrieval.top_k(asked, own)._jdf.queryExecution().executedPlan().toString()
    assert "zip_with" not in plan


def test_white_space_prose_and_phrases(spark):
    """The quicker forms against the patterns that they stand for."""
    texts = [f"{w}a {w} b{w}{w}" for w in P.WHITE] + ["", "\x1c a\x1f", "a\n", " \n", "​ x", "word " * 11, "word " * 12, "\xa0".join("abcdefghijkl"), "\n x" * 12, None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(
        T.stripped(F.col("t")).alias("a"), F.regexp_replace("t", r"(?U)^\s+|\s+$", "").alias("b"), T.looks_like_prose(F.col("t"), F.lit(0.0)).alias("c"), (F.regexp_count(F.coalesce("t", F.lit("")), F.lit(r"(?U)\S+")) >= P.PROSE_WORDS).alias("d")
    )
    for r in got.collect():
        assert (r["a"], r["c"]) == (r["b"], r["d"])
    phrases = ["ARTICLE you may be  interested in", "you may also like", "Learn\nmore", "lakeſhore", "whİtepaper", "lock-ın amplifiers", "PII : S1", "part of the open Commons", "LİNK", "to cite this article", "nothing here", "belongs here", None]
    marked = spark.createDataFrame([(t,) for t in phrases], "t string").select("t", T.distinct_markers(F.col("t")).alias("n"), F.size(F.regexp_extract_all(F.coalesce("t", F.lit("")), F.lit(P.AD_MARKERS), F.lit(0))).alias("m")).collect()
    assert all((r["n"] > 0) == (r["m"] > 0) for r in marked) and sum(r["n"] for r in marked) >= 7
    alternatives = P.AD_MARKERS.removeprefix("(?iU)").split("|")
    assert all(any(w in a.replace("\\b", "").lower() for w in P.AD_WORDS) for a in alternatives)


def test_documents_without_a_heading_of_the_kind_are_not_moved(spark):
    rows = [("a", 0, "text", None, "References", 1), ("a", 1, "text", None, "one", None), ("b", 0, "text", None, "Title", 1), ("b", 1, "text", "ref_text", "[1] x", None), ("c", 0, "text", None, "Title", 1), (None, 0, "text", None, "References", 1), (None, 1, "text", None, "two", None)]
    items = spark.createDataFrame(rows, "doc_id string, item_idx int, type string, sub_type string, text string, text_level int")
    got = sorted(repr((r["doc_id"], r["item_idx"], r["signal"])) for r in layout.reference_plan(items).collect())
    assert len(got) == 5 and "('c', 0" not in "".join(got)
    assert "BroadcastHashJoin" in layout.reference_plan(items)._jdf.queryExecution().executedPlan().toString()


def test_coverage_takes_words_through_one_shuffle(spark, tmp_path):
    texts = ["zeta alpha\nzeta alpha\nzeta beta", "soft\xad hyphen\nsoft\xad hyphen", "", None, "abc", "same line\n" * 5 + "LAST same"]
    same_rows(spark, tmp_path, "coverage_of_lines", documents=documents(texts))
    plan = ALL["coverage_of_lines"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2 and "Join" not in plan
