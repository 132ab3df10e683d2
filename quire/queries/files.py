"""Queries over files: bundles, logs and ledgers written from the inline tables and read again, whole plans over the documents."""

from __future__ import annotations

import hashlib
import json

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ledger, retrieval
from ..plans import rules
from ..plans.storage import shared_folder
from ..schema import LEDGER
from ..sources import bundles
from ..streaming import jobs
from . import corpus
from .fixtures import TABLES, frame, values
from .inline import PLAN

_KEPT = ("type", "sub_type", "text", "text_level", "page_idx", "bbox", "list_items", "code_body", "table_body", "table_caption", "image_caption", "chart_caption", "img_path")


def _write(spark: SparkSession, files: dict[str, str]) -> str:
    """A new shared folder with these small files in it."""
    folder = shared_folder(spark)
    system, root = fs.FileSystem.from_uri(folder)
    for name, content in files.items():
        system.create_dir(f"{root}/{name}".rpartition("/")[0], recursive=True)
        with system.open_output_stream(f"{root}/{name}") as out:
            out.write(content.encode())
    return folder


def _workspace(spark: SparkSession) -> str:
    """The inline items, pages and sources as bundles on disk."""
    files, lists = {}, {}
    for row in TABLES["items"][1]:
        lists.setdefault(row["doc_id"], []).append({k: row[k] for k in _KEPT if row.get(k) is not None})
    for doc, items in lists.items():
        pages = [{"page_idx": page, "page_size": size} for d, _, page, size in TABLES["layout_pages"][1] if d == doc]
        source = f"%PDF {doc}"
        files |= {f"{doc}.mineru_raw/content_list.json": json.dumps(items, indent=1), f"{doc}.mineru_raw/layout.json": json.dumps({"pdf_info": pages}, indent=1), f"sources/{doc}.pdf": source}
        files[f"{doc}.mineru_raw/_manifest.json"] = json.dumps({"source_content_hash": "sha256:" + hashlib.sha256((source if doc != "wrap" else "other").encode()).hexdigest(), "files": [{"path": "content_list.json"}]})
    return _write(spark, files)


def bundle_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundles.find_bundles(spark, _workspace(spark)).select("doc_id")


def bundle_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = bundles.read_items(spark, _workspace(spark))
    return got.select("doc_id", "item_idx", "type", "text", "page_idx", "text_level", "has_table_body", "img_path", F.array_join("list_items", "|").alias("list_items"))


def bundle_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundles.read_strings(spark, _workspace(spark))


def bundle_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundles.read_pages(spark, _workspace(spark)).select("doc_id", "page_pos", "page_idx", F.col("page_size")[0].alias("width"))


def bundle_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source file of each bundle by the hash in its manifest; none where the hash is of something else."""
    folder = _workspace(spark)
    found = bundles.source_of(bundles.read_manifests(spark, folder), bundles.source_files(spark, f"{folder}/sources"))
    return found.select("doc_id", F.element_at(F.split("path", "/"), -1).alias("file"))


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = [json.dumps({"reason": reason, "processed_index": n, "created_at": at}, ensure_ascii=False) for reason, n, at in TABLES["event_rows"][1]]
    folder = _write(spark, {"events.jsonl": "\n".join([lines[0], "", "not json", *lines[1:]])})
    return bundles.read_jsonl(spark, folder, "reason string, processed_index int, created_at string").select("reason", "processed_index", "created_at", "corrupt")


def note_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _write(spark, {f"notes/{'deep/' * i}{name}.md": body for i, (name, body) in enumerate(TABLES["notes"][1])})
    return bundles.read_notes(spark, folder)


def entity_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five vectors nearest to every vector whose id is divisible by 100, as entities by name."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.format_string("e%06d", "vec_id").alias("name"), F.col("embedding").alias("vector"))
    return retrieval.entities_for(rows.where("id % 100 = 0"), rows, 5)


def ledger_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledgers as files, a document each, and their gates as cells."""
    held: dict[str, dict] = {}
    for doc, gate, state, note, at in TABLES["records"][1]:
        held.setdefault(doc, {})[gate] = {"state": state, "note": note, "at": at}
    folder = _write(spark, {f"{doc}.json": json.dumps({"doc": doc, "gates": gates}) for doc, gates in held.items()})
    return ledger.gate_cells(spark.read.schema(LEDGER).json(folder)).select("doc", "gate", "state", "note", "at")


def applied_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole plan applied to a stored corpus, then rolled back and applied again: what is stored at the end."""
    path = f"{shared_folder(spark)}/corpus"
    frame(spark, "items").write.parquet(path)
    items = spark.read.parquet(path)
    for again in (False, True):
        if again:
            items = rules.rollback(spark, path)
        out = rules.apply(items, rules.plan(items), acknowledged=True, path=path)
    return out.select("doc_id", "item_idx", "text", "orig_text")


def appended_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log read as a stream and appended to a table, twice: each line is there once."""
    folder = _write(spark, {"log/a.json": "\n".join(json.dumps({"job_id": j, "at": at, "status": status}) for j, at, status in TABLES["history"][1])})
    for _ in range(2):
        events = jobs.event_log(spark, f"{folder}/log", "job_id string, at int, status string").drop("corrupt")
        jobs.append_events(events, f"{folder}/table", f"{folder}/state").awaitTermination()
    return spark.read.schema("job_id string, at int, status string").parquet(f"{folder}/table")


def document_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A count by SQL text over a view, as a store's tables are asked."""
    spark.read.parquet(f"{sf_dir}/documents.parquet").createOrReplaceTempView("quire_documents")
    return spark.sql("SELECT source, count(*) AS n, count(DISTINCT lang) AS langs FROM quire_documents GROUP BY source")


def plan_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as items: the first line a heading, the first line of every further page its header."""
    rows = corpus.items_of(spark, sf_dir)
    head = (F.col("item_idx") > 0) & (F.col("item_idx") % 40 == 0)
    none = F.lit(None)
    return rows.select("doc_id", "item_idx", F.when(head, "header").otherwise("text").alias("type"), none.cast("string").alias("sub_type"), "text", F.when(F.col("item_idx") == 0, 1).cast("int").alias("text_level"), "page_idx", none.cast("array<double>").alias("bbox"), none.cast("array<string>").alias("list_items"))


def document_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole rule plan over all documents, counted by document, rule and action."""
    return rules.plan(plan_items(spark, sf_dir)).groupBy("doc_id", "rule", "action").agg(F.count("*").alias("n"))


_ITEMS = f"""items AS (SELECT doc_id, item_idx, CASE WHEN item_idx > 0 AND item_idx % 40 = 0 THEN 'header' ELSE 'text' END AS type, NULL::VARCHAR AS sub_type, text, CASE WHEN item_idx = 0 THEN 1 END AS text_level, (item_idx // 40)::INTEGER AS page_idx, NULL::DOUBLE[] AS bbox FROM ({corpus.LINES}))"""

SQL = {
    "bundle_list": f"SELECT DISTINCT doc_id FROM ({values('items')})",
    "bundle_items": f"SELECT doc_id, item_idx, type, text, page_idx, text_level, has_table_body, img_path, array_to_string(list_items, '|') AS list_items FROM ({values('items')})",
    "bundle_strings": f"SELECT doc_id, item_idx, unnest(list_filter(list_concat([text, code_body, table_body], coalesce(list_items, []), coalesce(table_caption, []), coalesce(image_caption, []), coalesce(chart_caption, [])), lambda x: x IS NOT NULL)) AS text FROM ({values('items')})",
    "note_files": f"SELECT name, body FROM ({values('notes')})",
    "entity_hits": "WITH p AS (SELECT q.vec_id AS query, printf('e%06d', v.vec_id) AS name, list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) AS score FROM embeddings v, embeddings q WHERE q.vec_id % 100 = 0) SELECT query, (row_number() OVER w)::INTEGER AS rank, name FROM p WINDOW w AS (PARTITION BY query ORDER BY score DESC, name) QUALIFY row_number() OVER w <= 5",
    "bundle_pages": f"SELECT doc_id, page_pos, page_idx, page_size[1] AS width FROM ({values('layout_pages')})",
    "bundle_sources": f"SELECT DISTINCT doc_id, CASE WHEN doc_id <> 'wrap' THEN doc_id || '.pdf' END AS file FROM ({values('items')})",
    "event_lines": f"SELECT reason, processed_index, created_at, NULL::VARCHAR AS corrupt FROM ({values('event_rows')}) UNION ALL SELECT NULL, NULL, NULL, 'not json'",
    "ledger_files": f"SELECT doc, gate, state, note, \"at\" FROM ({values('records')}) QUALIFY row_number() OVER (PARTITION BY doc, gate ORDER BY \"at\" DESC) = 1",
    "applied_items": f"WITH items AS ({values('items')}), {PLAN}, m AS (SELECT DISTINCT doc_id, item_idx FROM whole WHERE action = 'mute') SELECT i.doc_id, i.item_idx, CASE WHEN m.doc_id IS NOT NULL AND trim(coalesce(text, '')) <> '' THEN '' ELSE text END AS text, CASE WHEN m.doc_id IS NOT NULL AND trim(coalesce(text, '')) <> '' THEN text END AS orig_text FROM items i LEFT JOIN m ON i.doc_id = m.doc_id AND i.item_idx = m.item_idx",
    "appended_events": f"SELECT job_id, \"at\", status FROM ({values('history')})",
    "document_counts": "SELECT source, count(*) AS n, count(DISTINCT lang) AS langs FROM documents GROUP BY source",
    "document_plan": f"WITH {_ITEMS}, {PLAN} SELECT doc_id, rule, action, count(*) AS n FROM whole GROUP BY doc_id, rule, action",
}

QUERIES = {f.__name__: f for f in (bundle_list, bundle_items, bundle_strings, bundle_pages, bundle_sources, event_lines, ledger_files, note_files, entity_hits, applied_items, appended_events, document_counts, document_plan)}
