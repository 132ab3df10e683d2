"""How far the sources of a language diverge in their words: counts by shard in DuckDB, sums and ranks merged by Spark.

A map task counts terms of bounded batches in DuckDB and holds partial counts, so what it shuffles is small; Spark sums them
by language, source and term, so a word of every document is spread over its sources. Shards of whole (language, term) keys
then find in SQL which terms are kept and, once the totals are known, the groups' shares, the best terms and partial sums of
every pair of sources. A pair's sum over terms that both lack, or only one has, needs no row for the other: it follows from
one source's shares and the other's share of an absent term. So shards only meet sources that share a term.
"""

from __future__ import annotations

from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, hinted, map_arrow, utf8

#: Documents of its language that a term must be in to be kept, what is added to every count, the whole of the shares, terms listed.
LEAST_DOCS, ADDED, WHOLE, TERMS = 30, 5, 1_000_000_000, 50
#: Bytes of one piece of text, partial counts that a map task holds, cells of a shard, and pair sums that one statement makes, about.
PIECE_BYTES, HELD_COUNTS, SHARD_CELLS, PAIR_SUMS = 1 << 20, 300_000, 500_000, 1_000_000
#: Groups that are broadcast at most.
BROADCAST_GROUPS = 100_000

_letter = np.ones(256, bool)
_letter[[*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32


def engine() -> duckdb.DuckDBPyConnection:
    """A database in one thread and in memory only: what a task holds is bounded, so nothing may spill to a local disk."""
    return duckdb.connect(config={"threads": 1, "memory_limit": "768MB", "temp_directory": ""})


def pieces(data: np.ndarray, offsets: np.ndarray, size: int = PIECE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Borders that cut longer texts between terms, about every `size` bytes, and the text of each piece."""
    borders, rows = [offsets[:1]], []
    for row in range(len(offsets) - 1):
        at, end = int(offsets[row]), int(offsets[row + 1])
        while end - at > size:
            cut = at + size
            while cut < end and (inside := _letter[data[cut : min(cut + size, end)]]).all():
                cut += len(inside)
            if cut >= end:
                break
            at = cut + int(np.argmin(inside))
            borders.append(np.array([at]))
            rows.append(row)
        borders.append(np.array([end]))
        rows.append(row)
    return np.concatenate(borders).astype(np.int64), np.array(rows, np.int64)


COUNTS = r"""
WITH w AS (SELECT g, doc, unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM texts),
d AS (SELECT g, doc, term, count(*) AS n FROM w GROUP BY g, doc, term),
s AS (SELECT g, term, sum(n)::BIGINT AS n, count(*) AS docs FROM d GROUP BY g, term)
INSERT INTO held SELECT lang, source, term, n, docs FROM s JOIN names USING (g)
"""


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (lang, source, body): partial counts (lang, source, term, n, docs)."""
    con = engine()
    new = "CREATE OR REPLACE TABLE held (lang VARCHAR, source VARCHAR, term VARCHAR, n BIGINT, docs BIGINT)"
    con.execute(new).fetchall()

    def drained() -> Iterator[pa.RecordBatch]:
        yield from con.sql("SELECT lang, source, term, sum(n)::BIGINT AS n, sum(docs)::BIGINT AS docs FROM held GROUP BY lang, source, term").to_arrow_reader(20_000)
        con.execute(new).fetchall()

    for batch in batches:
        data, offsets = utf8(batch.column("body"))
        borders, row = pieces(data, offsets)
        small = _lower[data]
        names = pa.table({"lang": batch.column("lang"), "source": batch.column("source")})
        groups = names.group_by(["lang", "source"]).aggregate([]).append_column("g", pa.array(range(len(names.group_by(["lang", "source"]).aggregate([]))), pa.int64()))
        g = np.asarray(names.append_column("row", pa.array(range(len(names)))).join(groups, ["lang", "source"]).sort_by("row").column("g"))
        first = 0
        while first < len(row):
            last = max(first + 1, int(np.searchsorted(borders, borders[first] + 4 * PIECE_BYTES, "right")) - 1)
            last = min(last, len(row))
            part = small[borders[first] : borders[last]]
            body = pa.Array.from_buffers(pa.large_string(), last - first, [None, pa.py_buffer(borders[first : last + 1] - borders[first]), pa.py_buffer(part)])
            con.register("texts", pa.table({"g": g[row[first:last]], "doc": row[first:last], "body": body}))
            con.register("names", groups)
            con.execute(COUNTS).fetchall()
            held = con.execute("SELECT count(*) FROM held").fetchall()[0][0]
            if held > HELD_COUNTS:
                yield from drained()
            first = last
    yield from drained()
    con.close()


KEPT = """
WITH t AS (SELECT lang, term, sum(n)::BIGINT AS n FROM shard GROUP BY lang, term HAVING sum(docs) >= {least})
SELECT lang, term, TRUE AS whole, '' AS source, n FROM t
UNION ALL SELECT s.lang, s.term, FALSE, s.source, s.n FROM shard s SEMI JOIN t ON s.lang = t.lang AND s.term = t.term
"""


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[duckdb.DuckDBPyConnection]:
    """A database whose table shard holds the partition's rows, if there are any."""
    con = None
    for batch in batches:
        if batch.num_rows:
            made = con is not None
            con = con or engine()
            con.register("batch", pa.table(batch))
            con.execute("INSERT INTO shard SELECT * FROM batch" if made else "CREATE TABLE shard AS SELECT * FROM batch").fetchall()
    if con is not None:
        yield con
        con.close()


def _kept(least: int):
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for con in _shards(batches):
            yield from con.sql(KEPT.format(least=least)).to_arrow_reader(20_000)

    return kept


#: Whole numbers of any size, so that no share is rounded.
SHARES = f"CREATE TABLE c AS SELECT lang, term, whole, g, p0, (1 + ({WHOLE}::HUGEINT * (n + {ADDED})) // (total + {ADDED}::HUGEINT * kept))::BIGINT AS p FROM shard"
SHARED = """
SELECT 'both' AS what, a.g AS a, b.g AS b, NULL::VARCHAR AS term, sum(abs(a.p - b.p) - abs(a.p - b.p0) - abs(a.p0 - b.p) + abs(a.p0 - b.p0))::BIGINT AS value
FROM c a JOIN c b ON a.lang = b.lang AND a.term = b.term AND a.g < b.g WHERE NOT a.whole AND NOT b.whole AND a.g % {parts} = {part} GROUP BY a.g, b.g
"""
SINGLE = "SELECT 'one' AS what, g AS a, p AS b, NULL::VARCHAR AS term, count(*) AS value FROM c WHERE NOT whole GROUP BY g, p"
BEST = """
SELECT 'term' AS what, c.g AS a, NULL::BIGINT AS b, c.term, c.p - q.p AS value FROM c JOIN c q ON c.lang = q.lang AND c.term = q.term AND q.whole
WHERE NOT c.whole AND c.p > q.p QUALIFY row_number() OVER (PARTITION BY c.g ORDER BY value DESC, c.term) <= {terms}
"""


def _sums(terms: int):
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for con in _shards(batches):
            con.execute(SHARES).fetchall()
            groups = con.execute("SELECT coalesce(max(n), 0)::BIGINT FROM (SELECT count(DISTINCT g) AS n FROM c WHERE NOT whole GROUP BY lang)").fetchall()[0][0]
            parts = max(1, groups * groups // (2 * PAIR_SUMS))
            for sql in (SINGLE, BEST.format(terms=terms), *(SHARED.format(parts=parts, part=i) for i in range(parts))):
                yield from con.sql(sql).to_arrow_reader(20_000)

    return sums


def _spread(df: DataFrame, rows: int) -> DataFrame:
    """Shards of whole (lang, term) keys, of about SHARD_CELLS rows; never fewer than the session's shuffle partitions."""
    return df.repartition(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // SHARD_CELLS)), "lang", "term")


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS, terms: int = TERMS) -> DataFrame:
    """Rows (lang, source, part, item, value long, rank int) for every group (lang, source) of docs.

    Terms are runs of ASCII letters and of characters beyond ASCII; only A-Z are lower-cased. A language keeps the terms of
    at least least_docs of its documents; every row is a document, so repeated rows count each. A group gives each kept term
    the share 1 + floor(10**9 * (count + 5) / (N + 5 * V)), N its count of kept terms, V their number; so does the language.
    Part pair: every other source of the language, value the sum of the shares' absolute differences over the kept terms (0
    where none is kept). Part term: terms of which the group has a greater share than its language, the `terms` with the
    greatest difference. Ranks go by value, descending, then by item. All numbers are exact.

    Null texts, languages and sources are read as empty; so a null source and an empty one are one group. A group without
    terms has its pairs; a language of one source has none. Equal values rank by item, so ranks never tie. Texts of any
    length are cut between terms. An empty table gives no rows; other columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    filled = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = docs.select(filled(lang).alias("lang"), filled(source).alias("source"), filled(text).alias("body"))
    counts = map_arrow(rows, _count, "lang string, source string, term string, n long, docs long")
    counts = scratch.cut(counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "divergence-counts")
    kept = map_arrow(_spread(counts, counts.count()), _kept(least_docs), "lang string, term string, whole boolean, source string, n long")
    kept = scratch.cut(kept, "divergence-kept")

    # Totals of groups and languages, a row for each.
    totals = kept.groupBy("lang", "whole", "source").agg(F.sum("n").alias("total"), F.count("*").alias("terms"))
    langs = totals.where("whole").select("lang", F.col("total").alias("l_total"), F.col("terms").alias("kept"))
    groups = rows.select("lang", "source").distinct().join(totals.where("NOT whole").drop("whole", "terms"), ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept"))
    absent = F.expr(f"CASE WHEN kept > 0 THEN 1 + {WHOLE * ADDED}L DIV (total + {ADDED} * kept) ELSE 0 END")
    groups = scratch.cut(groups.withColumn("p0", absent).withColumn("g", F.monotonically_increasing_id()), "divergence-groups")
    known = groups.select("lang", F.lit(False).alias("whole"), "source", "total", "kept", "p0", "g")
    known = known.unionByName(langs.select("lang", F.lit(True).alias("whole"), F.lit("").alias("source"), F.col("l_total").alias("total"), "kept", F.lit(0).cast("long").alias("p0"), F.lit(-1).cast("long").alias("g")))

    cells = kept.join(hinted(known, BROADCAST_GROUPS), ["lang", "whole", "source"]).select("lang", "term", "whole", "g", "n", "total", "kept", "p0")
    sums = map_arrow(_spread(cells, kept.count()), _sums(terms), "what string, a long, b long, term string, value long")
    sums = scratch.cut(sums, "divergence-sums")
    pairs = _pairs(groups, sums)
    best = sums.where("what = 'term'").withColumn("rank", _rank("a", "term")).where(F.col("rank") <= terms)
    best = best.join(groups, best["a"] == groups["g"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    return scratch.last(pairs.unionByName(best), "divergence")


def _rank(by: str, item: str) -> Column:
    return F.row_number().over(W.partitionBy(by).orderBy(F.desc("value"), item))


def _pairs(groups: DataFrame, sums: DataFrame) -> DataFrame:
    """The pairs of sources: what both, only one and none of the two have, added up."""
    side = lambda x: groups.select("lang", *(F.col(c).alias(f"{c}_{x}") for c in ("g", "source", "p0")), *([F.col("kept")] if x == "a" else []))
    ordered = side("a").join(side("b"), "lang").where("g_a <> g_b")
    # Of one source and each share x that others give an absent term: sum of |p - x| over the terms it has, from running sums.
    single = sums.where("what = 'one'").groupBy("a", "b").agg(F.sum("value").alias("n")).select("a", F.col("b").alias("p"), "n")
    asked = ordered.select(F.col("g_a").alias("a"), F.col("p0_b").alias("p")).distinct().withColumn("n", F.lit(0).cast("long"))
    upto, every = W.partitionBy("a").orderBy("p", "n").rowsBetween(W.unboundedPreceding, 0), W.partitionBy("a")
    run = single.unionByName(asked).withColumns({"n_upto": F.sum("n").over(upto), "s_upto": F.sum(F.col("n") * F.col("p")).over(upto), "n_all": F.sum("n").over(every), "s_all": F.sum(F.col("n") * F.col("p")).over(every)})
    # Shares equal to x add nothing on either side, so their place among equals does not matter.
    far = run.where("n = 0").select("a", "p", (F.col("p") * (2 * F.col("n_upto") - F.col("n_all")) + F.col("s_all") - 2 * F.col("s_upto")).alias("far"), F.col("n_all").alias("has"))
    apart = F.abs(F.col("p0_a") - F.col("p0_b"))
    one = ordered.join(far, (F.col("g_a") == far["a"]) & (F.col("p0_b") == far["p"])).select(F.least("g_a", "g_b").alias("a"), F.greatest("g_a", "g_b").alias("b"), (F.col("far") - F.col("has") * apart).alias("value"))
    none = ordered.where("g_a < g_b").select(F.col("g_a").alias("a"), F.col("g_b").alias("b"), (F.col("kept") * apart).alias("value"))
    both = sums.where("what = 'both'").select("a", "b", "value")
    added = one.unionByName(none).unionByName(both).groupBy("a", "b").agg(F.sum("value").alias("value"))
    either = F.explode(F.array(F.struct(F.col("a").alias("me"), F.col("b").alias("you")), F.struct(F.col("b").alias("me"), F.col("a").alias("you"))))
    mirrored = added.select("value", either.alias("e")).select("value", "e.me", "e.you")
    named = mirrored.join(groups.select(F.col("g").alias("you"), F.col("source").alias("item")), "you").join(groups.select(F.col("g").alias("me"), "lang", "source"), "me")
    return named.withColumn("rank", _rank("me", "item")).select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
