"""Sources: parsed bundles, and the adapter that makes items of plain documents."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import patterns as P
from ..functions.text import stripped

#: An element of a content list as it is on disk. Keys that are absent come as null, so their presence is read apart.
CONTENT = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("type", "sub_type", "text", "content", "body", "code_body", "table_body", "img_path", "_pp_original_text", "_pp_original_type", "_pp_original_table_body", "_pp_repaired_at")]
    + [T.StructField(n, T.IntegerType()) for n in ("text_level", "page_idx")]
    + [T.StructField("bbox", T.ArrayType(T.DoubleType())), T.StructField("_pp_had_table_body", T.BooleanType())]
    + [T.StructField(n, T.ArrayType(T.StringType())) for n in ("list_items", "table_caption", "image_caption", "image_footnote", "chart_caption", "chart_footnote", "_pp_original_list_items")]
)
BUNDLE_SUFFIX = ".mineru_raw"


def doc_of(path: Column) -> Column:
    """The document of a file inside a bundle folder."""
    return F.regexp_extract(path, r"([^/]+)\.mineru_raw/[^/]*$", 1)


def find_bundles(spark: SparkSession, workspace: str, doc: str | None = None, allow_empty: bool = False) -> DataFrame:
    """(doc_id, path) of every bundle below workspace whose name holds `doc`, whatever the case. None found is an error."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "content_list.json").option("recursiveFileLookup", "true").load(workspace).select("path")
    found = files.select(doc_of(F.col("path")).alias("doc_id"), "path").where("doc_id <> ''")
    if doc:
        found = found.where(F.lower("doc_id").contains(doc.lower()))
    if not allow_empty and found.isEmpty():
        raise FileNotFoundError(f"no bundle below {workspace}" + (f" has {doc!r} in its name" if doc else ""))
    return found


def read_items(spark: SparkSession, workspace: str, doc: str | None = None) -> DataFrame:
    """Bundles as items, one row per element of each content list; the index is the row's identity.

    Each list is parsed twice from one text: with the schema, and as maps for whether table_body is there at all.
    """
    raw = spark.read.option("pathGlobFilter", "content_list.json").option("recursiveFileLookup", "true").text(workspace, wholetext=True)
    raw = raw.select(doc_of(F.col("_metadata.file_path")).alias("doc_id"), "value")
    if doc:
        raw = raw.where(F.lower("doc_id").contains(doc.lower()))
    parsed = raw.select("doc_id", F.arrays_zip(F.from_json("value", T.ArrayType(CONTENT)).alias("item"), F.from_json("value", T.ArrayType(T.MapType(T.StringType(), T.StringType()))).alias("keys")).alias("z"))
    rows = parsed.select("doc_id", F.posexplode("z").alias("item_idx", "z")).select("doc_id", "item_idx", "z.item.*", F.map_contains_key("z.keys", "table_body").alias("has_table_body"))
    renamed = {"_pp_original_text": "orig_text", "_pp_original_list_items": "orig_list_items", "_pp_original_type": "orig_type", "_pp_original_table_body": "orig_table_body", "_pp_had_table_body": "had_table_body", "_pp_repaired_at": "repaired_at"}
    return rows.withColumnsRenamed(renamed)


def strings_in(value: object) -> Iterator[str]:
    """Every string below a JSON value, fields aside that are no text. Of an object with a kept original beside a field, the
    original counts only where the field shows no text now: it was muted then, else repaired."""
    if isinstance(value, str):
        yield value
    elif isinstance(value, list):
        for x in value:
            yield from strings_in(x)
    elif isinstance(value, dict):
        shown = lambda f: isinstance(value.get(f), str) and re.sub(P.TAG, "", value[f]).strip() != ""
        repaired = {f"_pp_original_{f}" for f in P.REPAIR_FIELDS if shown(f)}
        for k, x in value.items():
            if k not in P.SKIPPED_FIELDS and k not in repaired:
                yield from strings_in(x)


def read_strings(spark: SparkSession, workspace: str) -> DataFrame:
    """(doc_id, item_idx, text) of every string in every item of the content lists, however deep it stands."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(doc, i, s) for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for i, item in enumerate(json.loads(raw)) for s in strings_in(item)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.string())], names=["doc_id", "item_idx", "text"])

    raw = spark.read.option("pathGlobFilter", "content_list.json").option("recursiveFileLookup", "true").text(workspace, wholetext=True)
    return raw.select(doc_of(F.col("_metadata.file_path")).alias("doc_id"), "value").mapInArrow(walk, "doc_id string, item_idx int, text string")


def read_pages(spark: SparkSession, workspace: str) -> DataFrame:
    """(doc_id, page_pos, page_idx, page_size) from the bundles' layouts."""
    raw = spark.read.option("pathGlobFilter", "layout.json").option("recursiveFileLookup", "true").text(workspace, wholetext=True)
    pages = F.from_json("value", "struct<pdf_info: array<struct<page_idx: int, page_size: array<double>>>>").pdf_info
    return raw.select(doc_of(F.col("_metadata.file_path")).alias("doc_id"), F.posexplode(pages).alias("page_pos", "p")).select("doc_id", "page_pos", "p.page_idx", "p.page_size")


def read_manifests(spark: SparkSession, workspace: str) -> DataFrame:
    """(doc_id, source_content_hash, …) of every bundle. Spark's listing hides names that begin with _, so the tasks open each
    manifest beside its content list; a bundle without one gives no row."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, texts = [], []
            for doc, path in zip(batch.column("doc_id").to_pylist(), batch.column("path").to_pylist(), strict=True):
                system, name = fs.FileSystem.from_uri(path if "://" in path or not path.startswith("file:") else "file://" + path.removeprefix("file:"))
                try:
                    with system.open_input_stream(name.rsplit("/", 1)[0] + "/_manifest.json") as f:
                        texts.append(f.read().decode("utf-8"))
                except FileNotFoundError:
                    continue
                docs.append(doc)
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.string()), pa.array(texts, pa.string())], names=["doc_id", "value"])

    kind = "struct<source_content_hash: string, options_signature: string, critical_file: struct<path: string, size: bigint, sha256: string>, files: array<struct<path: string>>>"
    raw = find_bundles(spark, workspace, allow_empty=True).mapInArrow(read, "doc_id string, value string")
    return raw.select("doc_id", F.from_json("value", kind).alias("m")).select("doc_id", "m.*")


def read_notes(spark: SparkSession, folder: str) -> DataFrame:
    """(name, body) of every note below a folder, whatever its name says; name is the file's without its ending."""
    raw = spark.read.option("pathGlobFilter", "*.md").option("recursiveFileLookup", "true").text(folder, wholetext=True)
    name = F.regexp_replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), r"\.md$", "")
    return raw.select(F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))).alias("name"), F.col("value").alias("body"))


def source_files(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """(path, name, size, sha256) of candidate sources; hashed where they are read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("sha256"))


def source_of(manifests: DataFrame, candidates: DataFrame) -> DataFrame:
    """(doc_id, path) of the first candidate with the manifest's hash; documents without one have a null path."""
    best = candidates.groupBy("sha256").agg(F.min("path").alias("path"))
    return manifests.join(best, manifests.source_content_hash == best.sha256, "left").select("doc_id", "path")


def source_or_first(candidates: DataFrame) -> DataFrame:
    """From (doc_id, pos, path, hash_match): the first match, else the first candidate at all."""
    return candidates.groupBy("doc_id").agg(F.min_by("path", F.struct(~F.col("hash_match"), "pos")).alias("path"), F.bool_or("hash_match").alias("verified"))


def new_candidates(found: DataFrame, used_ids: DataFrame, known: list[DataFrame], reset: DataFrame) -> DataFrame:
    """Candidates whose id is unused and whose hash no known set holds, hashes of reset bundles aside; unsafe names go."""
    hashes = known[0].select("sha256")
    for more in known[1:]:
        hashes = hashes.union(more.select("sha256"))
    hashes = hashes.distinct().join(reset.select("sha256"), "sha256", "left_anti")
    safe = found.where(~F.col("name").rlike(r"(^\.)|[/\\\x00]|\.\."))
    return safe.join(used_ids, "candidate_id", "left_anti").join(hashes, "sha256", "left_anti")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with a column corrupt: the text of lines that are not objects; blank lines are skipped."""
    return spark.read.schema(f"{schema}, corrupt string").option("columnNameOfCorruptRecord", "corrupt").option("mode", "PERMISSIVE").json(path)


def parse_env(lines: DataFrame, value: str = "value") -> DataFrame:
    """(key, value) of KEY=VALUE lines; comments go, quotes at the ends too; of equal keys the last line (by pos) holds."""
    t = lines.select("pos", stripped(F.col(value)).alias("line")).where("line LIKE '%=%' AND NOT startswith(line, '#')")
    parts = F.split("line", "=", 2)
    rows = t.select("pos", stripped(parts[0]).alias("key"), F.regexp_replace(stripped(parts[1]), r"^['\"]+|['\"]+$", "").alias("value"))
    return rows.groupBy("key").agg(F.max_by("value", "pos").alias("value"))


def overlay_env(base: DataFrame, over: DataFrame) -> DataFrame:
    """base with the values of over, and what over did to each key: overwrite, new, or null."""
    b, o = base.select("key", F.col("value").alias("old")), over.select(F.col("key").alias("k"), F.col("value").alias("fresh"))
    j = b.join(o, F.col("key") == F.col("k"), "full")
    action = F.when(F.col("key").isNull(), "new").when(F.col("k").isNotNull(), "overwrite")
    return j.select(F.coalesce("key", "k").alias("key"), F.coalesce("fresh", "old").alias("value"), action.alias("action"))


def indexed_documents(paths: DataFrame, column: str = "file_path") -> DataFrame:
    """Base names of the first of each multi-valued path."""
    first = F.element_at(F.split(F.split(F.col(column), "<SEP>")[0], "/"), -1)
    return paths.where(F.col(column).isNotNull()).select(stripped(first).alias("name")).where("name <> ''").distinct()


def documents_as_items(documents: DataFrame, lines_per_page: int = 40) -> DataFrame:
    """Plain documents as items: a line each, blank ones kept so that indices stay; pages of `lines_per_page` lines."""
    rows = documents.select(F.col("doc_id").cast("string").alias("doc_id"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("item_idx", "text"))
    return rows.withColumns({"type": F.lit("text"), "page_idx": F.floor(F.col("item_idx") / lines_per_page).cast("int")})


def unpivoted(items: DataFrame, fields: list[str] = P.REPAIR_FIELDS) -> DataFrame:
    """(doc_id, item_idx, field, value) of the text fields that are not null."""
    pairs = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields))
    return items.select("doc_id", "item_idx", F.explode(pairs).alias("p")).select("doc_id", "item_idx", "p.*").where("value IS NOT NULL")
