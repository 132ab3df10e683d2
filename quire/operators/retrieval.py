"""Retrieval shaping: cosine top-k, character budgets, scores of two sides, graphs about an entity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.vectorised import BATCH_BYTES, batched
from ..plans.storage import hinted, settled

#: Vectors of a block, queries of a block, and queries that are compared with a block of vectors at a time.
VECTORS, QUERIES, STRIP = 8192, 1024, 64


def cosine(a: Column, b: Column) -> Column:
    """In double precision, summed in order of the components; null for a zero vector."""
    add = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
    wide = lambda x: F.transform(x, lambda v: v.cast("double"))
    dot = add(F.zip_with(wide(a), wide(b), lambda x, y: x * y))
    norm = lambda x: F.sqrt(add(F.transform(wide(x), lambda v: v * v)))
    return dot / F.nullif(norm(a) * norm(b), F.lit(0.0))


def _blocks(rows: DataFrame, most: int) -> DataFrame:
    """(ids, size, data) of rows (id, vector): vectors of one size side by side, at most so many; size 0 holds those without a cosine."""
    kind = rows.schema["id"].dataType.simpleString()
    wide = "float" if rows.schema["vector"].dataType.elementType.simpleString() == "float" else "double"
    code, held = ("<f4", 4) if wide == "float" else ("<f8", 8)

    def cut(table: pa.Table) -> Iterator[pa.RecordBatch]:
        ids, lists = table.column(0).combine_chunks(), table.column(1).combine_chunks()
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat, first = lists.flatten(), np.concatenate([[0], np.cumsum(sizes)])
        holes = np.concatenate([[0], np.cumsum(flat.is_null().to_numpy(zero_copy_only=False))]) if flat.null_count else np.zeros(len(flat) + 1, np.int64)
        usable = np.where(holes[first[1:]] > holes[first[:-1]], 0, sizes)
        values = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False).astype(code)
        for size in np.unique(usable).tolist():
            rows_of = np.flatnonzero(usable == size)
            step = max(1, min(most, BATCH_BYTES // (held * size))) if size else most
            for at in range(0, len(rows_of), step):
                some = rows_of[at : at + step]
                own = ids.take(pa.array(some))
                data = values[first[some][:, None] + np.arange(size)].tobytes()
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), own), pa.array([size], pa.int32()), pa.array([data], pa.binary())], names=["ids", "size", "data"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, n, held_bytes = [], 0, 0
        for batch in batches:
            kept, n, held_bytes = [*kept, batch], n + batch.num_rows, held_bytes + batch.nbytes
            if n >= most or held_bytes >= BATCH_BYTES:
                yield from cut(pa.Table.from_batches(kept))
                kept, n, held_bytes = [], 0, 0
        if n:
            yield from cut(pa.Table.from_batches(kept))

    return rows.select("id", F.col("vector").cast(f"array<{wide}>").alias("vector")).mapInArrow(task, f"ids array<{kind}>, size int, data binary").withColumn("wide", F.lit(code))


def _norms(x: np.ndarray) -> np.ndarray:
    """As cosine() has them, component by component."""
    total = np.zeros(x.shape[0])
    for column in x.T:
        total += column * column
    return np.sqrt(total)


def _best(q: np.ndarray, v: np.ndarray, order: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row of q, row of v, score, is null): the k best of each row of q, equal ones by order, with the very scores of cosine().

    A matrix product finds what can be among them within its rounding; those are summed again in order of the components.
    """
    out, across, down, lengths, of_q = [], np.ascontiguousarray(q.T), np.ascontiguousarray(v.T), _norms(v), _norms(q)
    margin = 8 * (q.shape[1] + 8) * np.finfo(float).eps
    for a in range(0, len(q), STRIP):
        norms = of_q[a : a + STRIP, None] * lengths
        near = (q[a : a + STRIP] @ down) / norms
        null = norms == 0
        odd = (~np.isfinite(near) | (norms < 1e-280)) & ~null
        near[odd | null] = -np.inf
        if len(v) > k:
            near = (near >= np.partition(near, len(v) - k, axis=1)[:, len(v) - k, None] - margin) | odd
        else:
            near = np.ones(norms.shape, bool)
        i, j = np.nonzero(near)
        dot = np.zeros(len(i))
        for x, y in zip(across, down, strict=True):
            dot += x[a + i] * y[j]
        score, none = dot / norms[i, j], null[i, j]
        lost = np.isnan(score) & ~none
        place = np.lexsort((order[j], np.where(none | lost, 0, -score), np.where(none, 2, np.where(lost, 0, 1)), i))
        i, j, score, none = i[place], j[place], score[place], none[place]
        top = np.arange(len(i)) - np.searchsorted(i, i) < k
        out.append((a + i[top], j[top], score[top], none[top]))
    return tuple(map(np.concatenate, zip(*out)))


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 20) -> DataFrame:
    """(query, id, score, rank): the k nearest vectors of each query, exactly. A stated set of queries meets all vectors.

    Queries and vectors meet in blocks, so neither side is whole anywhere; of a pair of blocks k rows of each query are left,
    and ranks are limited once more before the shuffle. Scores are those of cosine(), null ones come last.
    """
    spark = vectors.sparkSession
    batched(spark)
    left = settled(_blocks(queries, QUERIES).toDF("asked", "asked_size", "asked_data", "asked_wide"))
    right = settled(_blocks(vectors, VECTORS).repartition(2 * spark.sparkContext.defaultParallelism))
    of_query, of_vector = (x.schema["id"].dataType.simpleString() for x in (queries, vectors))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                asked, ids = (batch.column(c)[r].values for c in ("asked", "ids"))
                m, n = (batch.column(c)[r].as_py() for c in ("asked_size", "size"))
                order = np.empty(len(ids), np.int64)
                order[pc.sort_indices(ids, null_placement="at_start").to_numpy()] = np.arange(len(ids))
                if m == n and n:
                    q, v = (np.frombuffer(batch.column(f"{c}data")[r].as_py(), batch.column(f"{c}wide")[r].as_py()).reshape(-1, n).astype(float) for c in ("asked_", ""))
                    with np.errstate(all="ignore"):
                        i, j, score, none = _best(q, v, order, k)
                else:
                    first = np.argsort(order)[:k]
                    i, j = np.repeat(np.arange(len(asked)), len(first)), np.tile(first, len(asked))
                    score, none = np.zeros(len(i)), np.ones(len(i), bool)
                yield pa.RecordBatch.from_arrays([asked.take(pa.array(i)), ids.take(pa.array(j)), pa.array(score, mask=none)], names=["query", "id", "score"])

    scored = right.crossJoin(hinted(left)).mapInArrow(task, f"query {of_query}, id {of_vector}, score double")
    ranked = scored.withColumn("rank", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "id")))
    return ranked.where(F.col("rank") <= k)


def entities_for(queries: DataFrame, entities: DataFrame, k: int = 20) -> DataFrame:
    """(query, rank, name) of the k entities (name, vector) nearest to each query (id, vector)."""
    found = top_k(queries, entities.select(F.col("name").alias("id"), "vector"), k)
    return found.select("query", "rank", F.col("id").alias("name"))


def rerank(scores: DataFrame, n: int) -> DataFrame:
    """(query, rank, doc, score): the n best of each query by a second model's scores (query, doc, score), doc breaking ties;
    pairs that the model gave no score have none."""
    ranked = scores.where("score IS NOT NULL").withColumn("rank", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "doc")))
    return ranked.where(F.col("rank") <= n).select("query", "rank", "doc", "score")


def within_budget(hits: DataFrame, chars: int, chunks: int | None = None) -> DataFrame:
    """Hits (query, rank, text) up to a budget of characters: the one that crosses it is cut, later ones go."""
    before = F.coalesce(F.sum(F.length("text")).over(W.partitionBy("query").orderBy("rank").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = hits if chunks is None else hits.where(F.col("rank") <= chunks)
    return rows.withColumn("before", before).where(F.col("before") < chars).withColumn("text", F.expr(f"substring(text, 1, CAST({chars} - before AS INT))")).drop("before")


def mean_top(scores: DataFrame, n: int, by: list[str]) -> DataFrame:
    """The mean of the n best scores of each group; groups without scores are not there."""
    ranked = scores.withColumn("r", F.row_number().over(W.partitionBy(*by).orderBy(F.desc("score"))))
    return ranked.where(F.col("r") <= n).groupBy(*by).agg(F.avg("score").alias("score"), F.count("*").alias("n"))


def compare_sides(scores: DataFrame) -> DataFrame:
    """(lang or null for all, a, b, delta_percent, wins_a, wins_b, ties) of questions scored on sides a and b."""
    per = scores.groupBy("id", "lang").pivot("side", ["a", "b"]).agg(F.first("score")).where("a IS NOT NULL AND b IS NOT NULL")
    out = per.rollup("lang").agg(F.avg("a").alias("a"), F.avg("b").alias("b"), F.count_if(F.col("a") > F.col("b")).alias("wins_a"), F.count_if(F.col("b") > F.col("a")).alias("wins_b"), F.count_if(F.col("a") == F.col("b")).alias("ties"))
    return out.withColumn("delta_percent", (F.col("b") - F.col("a")) / F.nullif(F.col("a"), F.lit(0.0)) * 100)


def needs_keywords(mode: Column, high: Column, low: Column, allow: Column) -> Column:
    """All modes but naive walk the graph and must bring keywords of either level, unless the caller allows otherwise."""
    none = (F.size(F.coalesce(high, F.array())) == 0) & (F.size(F.coalesce(low, F.array())) == 0)
    return (mode != "naive") & none & ~F.coalesce(F.lower(allow).isin("1", "true", "yes"), F.lit(False))


def section_sizes(contexts: DataFrame) -> DataFrame:
    """(query, section, chars, words) of a context's sections, in place of a tokenizer's count."""
    rows = contexts.select("query", F.posexplode(T.context_sections(F.col("context"))).alias("section", "s"))
    return rows.select("query", "section", F.length("s").alias("chars"), F.size(F.filter(F.split("s", r"\s+"), lambda w: w != "")).alias("words"))


def doc_summary(items: DataFrame, headings: int = 60, equations: int = 80) -> DataFrame:
    """(doc_id, part, item_idx, text): headings, tables, equations and figures of each document, in order, the long lists cut short."""
    part = F.when(F.coalesce("text_level", F.lit(0)) > 0, "heading").when(F.col("type") == "table", "table").when(F.col("type") == "equation", "equation").when(F.col("type").isin("image", "chart"), "figure")
    rows = items.withColumn("part", part).where("part IS NOT NULL").withColumn("r", F.row_number().over(W.partitionBy("doc_id", "part").orderBy("item_idx")))
    limit = F.when(F.col("part") == "heading", headings).when(F.col("part") == "equation", equations)
    return rows.where(limit.isNull() | (F.col("r") <= limit)).select("doc_id", "part", "item_idx", "text")


def neighbourhood(edges: DataFrame, names: DataFrame) -> DataFrame:
    """Edges (src, dst) with an end among names, each once. One semi-join for each end, so hubs cost their edges only."""
    n = names.select("name").distinct()
    return edges.join(n, edges.src == n.name, "left_semi").union(edges.join(n, edges.dst == n.name, "left_semi")).distinct()


def merge_entities(edges: DataFrame, merges: DataFrame) -> DataFrame:
    """Edges (src, dst, weight) with merged names (name, target) replaced, loops gone, equal edges summed."""
    m = merges.select("name", "target")
    out = edges.join(m.withColumnsRenamed({"name": "s", "target": "st"}), F.col("src") == F.col("s"), "left").join(m.withColumnsRenamed({"name": "d", "target": "dt"}), F.col("dst") == F.col("d"), "left")
    return out.select(F.coalesce("st", "src").alias("src"), F.coalesce("dt", "dst").alias("dst"), "weight").where("src <> dst").groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def graph_shape(nodes: DataFrame) -> DataFrame:
    """One row: nodes, label nodes by bucket, persons and organisations. nodes: (name, type)."""
    bucket = T.label_bucket(F.col("name"))
    return nodes.agg(F.count("*").alias("nodes"), F.count_if(bucket == "certain").alias("certain"), F.count_if(bucket == "suspect").alias("suspect"), F.count_if(F.lower("type").isin("person", "organization")).alias("people"))


def label_survey(nodes: DataFrame) -> DataFrame:
    """(name, type, bucket) of nodes that are positions; the type of a property that is missing is ?."""
    kind = F.coalesce(F.get_json_object("properties", "$.entity_type"), F.lit("?"))
    return nodes.select("name", kind.alias("type"), T.label_bucket(F.col("name")).alias("bucket")).where("bucket IS NOT NULL").orderBy("name")


def histogram(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def change_fingerprint(documents: DataFrame, chunks: DataFrame, entities: DataFrame, relations: DataFrame) -> DataFrame:
    """One row of counts and the last update: what a backup compares to see a change."""
    one = lambda df, name: df.agg(F.count("*").alias(name))
    last = documents.agg(F.count("*").alias("documents"), F.max("updated_at").alias("updated_at"))
    row = last.crossJoin(one(chunks, "chunks")).crossJoin(one(entities, "entities")).crossJoin(one(relations, "relations"))
    return row.select("*", F.concat_ws("|", "documents", "chunks", "entities", "relations", "updated_at").alias("fingerprint"))
