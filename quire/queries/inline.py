"""Queries over the inline tables: rules that need boxes, levels, tables, LaTeX, ledgers, which the data tables do not have."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import latex as tex
from ..functions import patterns as P
from ..functions import unicode
from ..functions import text as T
from ..operators import chapters, checks, layout, ledger, matching, retrieval, votes, workflow
from ..plans import rules
from ..sources import bundles
from . import corpus
from .fixtures import frame, values

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, joined: tuple[str, ...] = ()):
    """Register a query over inline tables; in its SQL each table is a view of the same rows. Array columns in `joined`
    come as one string on both sides."""

    def wrap(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        names = [n for n in f.__code__.co_varnames[: f.__code__.co_argcount]]
        QUERIES[f.__name__] = lambda spark, sf_dir: f(*(frame(spark, n) for n in names)).withColumns({c: F.array_join(c, "|") for c in joined})
        if sql is not None:
            body = sql.strip()
            views = ", ".join(f"{n} AS ({values(n)})" for n in names)
            recursive = "RECURSIVE " * body.upper().startswith("WITH RECURSIVE ")
            whole = f"WITH {recursive}{views}, {body[5 + len(recursive) :]}" if body[:5].upper() == "WITH " else f"WITH {views} {body}"
            replaced = ", ".join(f"array_to_string({c}, '|') AS {c}" for c in joined)
            SQL[f.__name__] = f"SELECT * REPLACE ({replaced}) FROM ({whole})" if joined else whole
        return f

    return wrap


STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
BAND = """b AS (SELECT doc_id, list_sort(list(bbox[1])) AS x0, list_sort(list(bbox[2])) AS y0, list_sort(list(bbox[3])) AS x1, list_sort(list(bbox[4])) AS y1, count(*) AS n FROM items WHERE type = 'text' AND trim(coalesce(text, '')) <> '' AND len(bbox) >= 4 GROUP BY doc_id),
  band AS (SELECT doc_id, CASE WHEN n >= 5 THEN y0[n * 10 // 100 + 1] END AS top, CASE WHEN n >= 5 THEN y1[n - n * 10 // 100] END AS bottom, CASE WHEN n >= 5 THEN x0[n * 10 // 100 + 1] END AS left_edge, CASE WHEN n >= 5 THEN x1[n - n * 10 // 100] END AS right_edge FROM b)"""

# The muting rules as common table expressions, so that whole plans can be computed in SQL as well.
NOISE = rf"""n1 AS (SELECT *, {STRIP.format("text")} AS t, regexp_replace({STRIP.format("text")}, '[0-9]+', '#', 'g') AS k FROM items WHERE type IN ('header', 'footer', 'aside_text')),
  n2 AS (SELECT doc_id, coalesce(max(page_idx), -1) + 1 AS pages FROM items GROUP BY doc_id),
  n3 AS (SELECT n1.*, greatest(count(*) OVER (PARTITION BY doc_id, t), count(*) OVER (PARTITION BY doc_id, k)) AS n FROM n1),
  n4 AS (SELECT n3.*, CASE WHEN n >= greatest(2, least(3, ceil(pages * 0.5))) THEN 'repeat' WHEN page_idx = 0 THEN 'cover' WHEN bbox[4] <= top OR bbox[2] >= bottom THEN 'edge'
    WHEN {corpus.PUBLISHER} THEN 'publisher'
    WHEN type = 'aside_text' AND NOT regexp_matches(t, '[A-Za-z]*[aeiouAEIOU][A-Za-z]{{2,}}|[A-Za-z][aeiouAEIOU][A-Za-z]|[A-Za-z]{{2,}}[aeiouAEIOU]') THEN 'gibberish' END AS signal FROM n3 JOIN n2 USING (doc_id) LEFT JOIN band USING (doc_id) WHERE t <> ''),
  noise AS (SELECT doc_id, item_idx, CASE WHEN signal IS NULL THEN 'held' ELSE 'mute' END AS action, signal, n::VARCHAR AS why FROM n4)"""
HEADS = r"""h1 AS (SELECT doc_id, item_idx, coalesce(text_level, 0) AS level, CASE WHEN regexp_matches(text, '(?i)^\s*#*\s*(references?|bibliography|works\s+cited|literature\s+cited)\s*$') THEN 'reference'
    WHEN regexp_matches(text, '(?i)^\s*#*\s*(acknowledge?ments?|funding|author\s+contributions?|conflicts?\s+of\s+interest|declaration\s+of\s+competing\s+interest)\s*$') THEN 'acknowledgement' END AS kind,
    regexp_matches(coalesce(text, ''), '(?i)^\s*#*\s*(appendix|supplementary\s+(information|material))\b') AS resumes, max(item_idx) OVER (PARTITION BY doc_id) + 1 AS size FROM items),
  heads AS (SELECT a.doc_id, a.item_idx, a.kind, coalesce((SELECT min(b.item_idx) FROM h1 b WHERE b.doc_id = a.doc_id AND b.item_idx > a.item_idx AND ((b.level > 0 AND b.level <= a.level) OR b.resumes)), a.size)::INTEGER AS stop FROM h1 a WHERE level > 0 AND kind IS NOT NULL)"""
REFERENCES = f"""{HEADS}, refs AS (SELECT i.doc_id, i.item_idx, coalesce(min_by(h.kind, h.item_idx), 'reference') AS signal FROM items i LEFT JOIN heads h ON h.doc_id = i.doc_id AND i.item_idx >= h.item_idx AND i.item_idx < h.stop AND i.type NOT IN ('header', 'footer', 'aside_text')
  WHERE h.kind IS NOT NULL OR i.sub_type = 'ref_text' GROUP BY i.doc_id, i.item_idx)"""
PUBLICATION = corpus.SIGNAL.split("CASE WHEN ", 1)[1].split(" THEN 'publication'")[0]
CORRESPONDENCE = corpus.SIGNAL.split("THEN 'publisher'")[1].split("WHEN ", 1)[1].split(" THEN 'correspondence'")[0]
TITLES = rf"""t1 AS (SELECT *, regexp_replace(coalesce(text, ''), {corpus.WS}) AS t, coalesce(page_idx, 0) AS page FROM items), t2 AS (SELECT *, CASE WHEN t <> '' THEN {corpus.SIGNAL} END AS said, {corpus.PROSE} AS prose FROM t1),
  t3 AS (SELECT doc_id, bool_or(type IN ('text', 'page_footnote') AND page = 0 AND said IN ('publication', 'correspondence')) AS anchored, bool_or(item_idx = 0 AND text_level = 1) AS heads_it, max(page) FILTER (item_idx = 0) AS page,
    min(item_idx) FILTER (item_idx < 5 AND page <> 0) AS turn, min(item_idx) FILTER (item_idx < 5 AND text_level = 1) AS found, max(item_idx) + 1 AS size FROM t2 GROUP BY doc_id),
  t4 AS (SELECT doc_id, size, CASE WHEN heads_it THEN CASE WHEN page = 0 THEN 0 END WHEN found IS NOT NULL AND (turn IS NULL OR found < turn) AND anchored THEN found END AS title FROM t3),
  t5 AS (SELECT t4.*, least(coalesce((SELECT min(item_idx) FROM t2 WHERE t2.doc_id = t4.doc_id AND item_idx > title AND (coalesce(text_level, 0) <> 0 OR page <> 0)), size), title + 26) AS stop FROM t4),
  t6 AS (SELECT t2.doc_id, item_idx, t, prose, coalesce(item_idx > title AND item_idx < stop, FALSE) AS block, said, CASE WHEN type = 'page_footnote' AND page = 0 THEN CASE WHEN {PUBLICATION} THEN 'publication' WHEN {CORRESPONDENCE} THEN 'correspondence' END END AS foot
    FROM t2 JOIN t5 USING (doc_id) WHERE type IN ('text', 'page_footnote') AND t <> ''),
  t7 AS (SELECT *, coalesce(CASE WHEN block THEN said END, foot) AS signal FROM t6),
  titles_ AS (SELECT doc_id, item_idx, CASE WHEN signal IS NULL THEN 'held' ELSE 'mute' END AS action, signal, CASE WHEN signal IS NULL THEN CASE WHEN regexp_matches(t, '(?i)^\s*(index\s+terms|key\s?words?)\b') THEN '關鍵字' WHEN prose THEN '散文' ELSE '沒有訊號' END END AS why FROM t7 WHERE signal IS NOT NULL OR block)"""
MARKERS = P.AD_MARKERS.removeprefix("(?iU)")
WRAPPERS = rf"""w1 AS (SELECT doc_id, string_agg(trim(coalesce(text, '')), chr(10) ORDER BY item_idx) AS blob, max(length(trim(coalesce(text, '')))) AS longest FROM items WHERE page_idx = 0 GROUP BY doc_id),
  w2 AS (SELECT *, len(list_distinct(list_transform(regexp_extract_all(blob, '(?i){MARKERS}'), lambda x: lower(x)))) AS markers FROM w1),
  wrappers AS (SELECT doc_id, markers::INTEGER AS markers, longest::INTEGER AS longest, markers > 0 AND NOT (longest >= 300 AND markers < 2) AS fires FROM w2)"""
EDGES = "edges AS (SELECT doc_id, item_idx, CASE WHEN bbox[3] <= left_edge THEN 'left_margin' ELSE 'right_margin' END AS signal FROM items JOIN band USING (doc_id) WHERE trim(coalesce(text, '')) <> '' AND len(bbox) >= 4 AND (bbox[3] <= left_edge OR bbox[1] >= right_edge))"
PLAN = f"""{BAND}, {NOISE}, {REFERENCES}, {TITLES}, {WRAPPERS}, {EDGES},
  p1 AS (SELECT doc_id, 'noise' AS rule, item_idx, action, signal, why FROM noise UNION ALL SELECT doc_id, 'reference', item_idx, 'mute', signal, NULL FROM refs UNION ALL SELECT doc_id, 'title', item_idx, action, signal, why FROM titles_),
  p2 AS (SELECT * FROM p1 UNION ALL SELECT i.doc_id, 'cover', i.item_idx, 'mute', 'wrapper_page', NULL FROM items i JOIN wrappers USING (doc_id) WHERE fires AND page_idx = 0 AND trim(coalesce(text, '')) <> '' AND (i.doc_id, i.item_idx) NOT IN (SELECT (doc_id, item_idx) FROM p1 WHERE action = 'mute')),
  whole AS (SELECT * FROM p2 UNION ALL SELECT doc_id, 'margin', item_idx, 'mute', signal, NULL FROM edges WHERE (doc_id, item_idx) NOT IN (SELECT (doc_id, item_idx) FROM p2 WHERE action = 'mute'))"""
SIZES = "g1 AS (SELECT doc_id, page_size[1] AS w, page_size[2] AS h, count(*) AS n, min(page_pos) AS first FROM layout_pages GROUP BY ALL), sizes AS (SELECT doc_id, w, h FROM g1 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first) = 1)"
ROMAN = r"(?:\\(?:mathsf|mathrm|mathbf|mathit|text|sf)\s*\{\s*[IlL1|]\s*\}|[IlL1|])"
#: A fraction whose two sides each begin with an accent over something and have more behind it.
SIDES = r"\\frac\s*\{\s*(\\(?:wide)?(?:hat|bar|tilde)\s*\{[^{}]*\})[^{}]*\}\s*\{\s*(\\(?:wide)?(?:hat|bar|tilde)\s*\{[^{}]*\})\s*[^{}\s][^{}]*\}"
#: Structure keys of the equations at hand, by replacement: commands of structure kept aside, other commands and letters as variables.
KEYS = r"""k1 AS (SELECT doc, item, source, regexp_replace(regexp_replace(regexp_replace(latex, '\\frac', '¶', 'g'), '\\sqrt', '§', 'g'), '\\nabla', '∇', 'g') AS a FROM equations WHERE trim(latex) <> ''),
  k2 AS (SELECT *, regexp_replace(regexp_replace(a, '\\[A-Za-z]+', 'v', 'g'), '\s+', '', 'g') AS b FROM k1), k3 AS (SELECT *, regexp_replace(b, '\{([0-9.]+|[A-Za-z])\}', '\1', 'g') AS c FROM k2),
  k4 AS (SELECT doc, item, source, regexp_replace(c, '\^[0-9]', '', 'g') AS plain, regexp_replace(c, '\^2', '²', 'g') AS d FROM k3),
  keys AS (SELECT doc, item, source, replace(replace(replace(replace(regexp_replace(regexp_replace(d, '[A-Za-z]+', '#', 'g'), '[0-9]+(\.[0-9]+)?', 'N', 'g'), '¶', '\frac'), '§', '\sqrt'), '∇', '\nabla'), '²', '^2') AS skeleton, regexp_extract_all(plain, '[0-9]+(?:\.[0-9]+)?') AS nums FROM k4)"""
PLAIN = "trim(lower(regexp_replace({0}, '[^A-Za-z0-9]+', ' ', 'g')))"
CHUNKS_PLAIN = rf"c AS (SELECT id AS chunk, {PLAIN.format('content')} AS plain, coalesce(list_sum(list_transform(regexp_extract_all(content, '<[^>]+>|\$[^$]*\$|\\[a-zA-Z]+'), lambda x: length(x))), 0) / greatest(length(content), 1) > 0.35 AS symbolic FROM chunks)"
FOUND = "({0} <> '' AND (contains(plain, {0}) OR (len(list_filter(string_split({0}, ' '), lambda w: length(w) > 2)) > 0 AND list_bool_and(list_transform(list_filter(string_split({0}, ' '), lambda w: length(w) > 2), lambda w: contains(plain, w))))))"
GROUNDED = f"{CHUNKS_PLAIN}, e AS (SELECT file_path AS doc, entity_name, {PLAIN.format('entity_name')} AS n, unnest(CASE WHEN len(chunk_ids) = 0 THEN [NULL] ELSE chunk_ids END) AS chunk FROM entities)"
VARIANTS = r"""v1 AS (SELECT DISTINCT name, list_filter(regexp_split_to_array(name, '[\s_\-.,()]+'), lambda x: x <> '') AS parts FROM nodes), v2 AS (SELECT *, lower(array_to_string(parts, '')) AS key, array_to_string(parts, '') AS glued, len(regexp_extract_all(name, '[\s_\-.,()]+')) AS seps FROM v1),
  variants AS (SELECT key, list_sort(list(name)) AS names, first(name ORDER BY seps DESC, length(name) DESC, name) AS keep,
    CASE WHEN count(DISTINCT glued) = 1 THEN 'A' WHEN count(DISTINCT len(parts)) = 1 AND bool_and(list_bool_and(list_transform(parts, lambda p: regexp_full_match(p, '[A-Za-z]{3,}')))) THEN 'B' ELSE 'C' END AS tier FROM v2 GROUP BY key HAVING count(*) > 1)"""
GATES = "gates(gate) AS (VALUES " + ", ".join(f"('{g}')" for g in ledger.GATES) + ")"
LEVEL = "CASE WHEN rc = 0 AND coalesce(scope, 0) <= 0 THEN 'unverified' WHEN rc = 0 THEN 'ok' WHEN name = 'compat' AND rc = 5 THEN 'warn' WHEN name IN ('tests', 'drill', 'canary') AND rc = 3 THEN 'unverified' WHEN name IN ('parse', 'coverage') THEN 'warn' ELSE 'block' END"
# Chapters.
_WORDS = "array_to_string(list_transform(regexp_extract_all(title, '[A-Za-z][A-Za-z'']*'), lambda w: lower(w)), ' ')"
_matter = lambda anywhere, first, whole: f"regexp_matches(title, '{'|'.join(anywhere)}') OR regexp_matches({_WORDS}, '^({'|'.join(first)})( |$)') OR {_WORDS} IN ({', '.join(repr(x) for x in whole)})"
PREAMBLE, APPENDIX = _matter(T.PREAMBLE_ANYWHERE, T.PREAMBLE_FIRST, T.PREAMBLE_WHOLE), _matter(T.APPENDIX_ANYWHERE, T.APPENDIX_FIRST, T.APPENDIX_WHOLE)
RANGES = """r1 AS (SELECT toc.*, total_pages, lead(page) OVER (PARTITION BY toc.doc ORDER BY pos) AS nxt FROM toc JOIN totals USING (doc) WHERE level <= 2),
  ranges AS (SELECT doc, pos, level, title, page, fin FROM (SELECT *, CASE WHEN nxt IS NULL THEN total_pages ELSE greatest(nxt - 1, page) END AS fin FROM r1) WHERE page <= fin)"""
NUMBERS = f"""m1 AS (SELECT *, {PREAMBLE} AS pre, {APPENDIX} AS app FROM ranges), m2 AS (SELECT *, coalesce(bool_or(NOT pre AND NOT app AND level = 1) OVER (PARTITION BY doc ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS seen FROM m1),
  m3 AS (SELECT *, CASE WHEN pre AND NOT seen THEN 'front' WHEN app THEN 'appendix' WHEN level = 1 THEN 'chapter' ELSE 'section' END AS kind FROM m2),
  m4 AS (SELECT *, count(*) FILTER (kind = 'chapter') OVER (PARTITION BY doc ORDER BY pos) AS chapter FROM m3), m5 AS (SELECT *, row_number() OVER (PARTITION BY doc, kind ORDER BY pos) - 1 AS nth, row_number() OVER (PARTITION BY doc, kind, chapter ORDER BY pos) AS section FROM m4),
  m6 AS (SELECT *, CASE kind WHEN 'front' THEN nth WHEN 'appendix' THEN 900 + nth WHEN 'chapter' THEN chapter * 100 ELSE chapter * 100 + section END AS number FROM m5)"""
HEADINGS = r"""h1 AS (SELECT s.*, r.pos, r.page AS start, trim(text) AS t FROM spans s JOIN ranges r ON s.doc = r.doc AND s.page BETWEEN r.page AND r.fin), h2 AS (SELECT doc, pos, round_even(size, 1) AS size, sum(length(t)) AS chars, min((page, line, span)) AS first FROM h1 WHERE t <> '' AND size > 0 GROUP BY doc, pos, round_even(size, 1)),
  h3 AS (SELECT doc, pos, size AS body FROM h2 QUALIFY row_number() OVER (PARTITION BY doc, pos ORDER BY chars DESC, first) = 1),
  h4 AS (SELECT h1.doc, h1.pos, page, line, trim(string_agg(text, ' ' ORDER BY span)) AS l, bool_or(size >= body * 1.15 AND length(t) > 3) AS large FROM h1 JOIN h3 ON h1.doc = h3.doc AND h1.pos = h3.pos WHERE page > start GROUP BY ALL),
  headings AS (SELECT DISTINCT doc, pos, page FROM h4 WHERE length(l) >= 3 AND (large OR regexp_matches(l, '^[0-9]+\.[0-9]+\s+\w')))"""
ROOTS = """e AS (SELECT source AS a, unnest(same_work_as) AS b FROM sources), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e), w(source, root) AS (SELECT source, source FROM sources UNION SELECT u.b, w.root FROM w JOIN u ON u.a = w.source), roots AS (SELECT source, min(root) AS root FROM w GROUP BY source)"""
# Stored files of bibliography items.
_SIGNIFICANT = "list_distinct(list_filter(regexp_extract_all(lower({0}), '[a-z0-9]+'), lambda w: NOT list_contains(" + repr(P.STOPWORDS) + ", w) AND (length(w) > 1 OR regexp_matches(w, '^[0-9]$'))))"
_STEM = r"regexp_replace(regexp_replace(regexp_replace(filename, '(?i)\.pdf$', ''), '^([23456789A-HJ-NP-Z]{8})\s+', ''), '^[0-9]{4}\s*-\s*', '')"
STORED = rf"""s1 AS (SELECT filename, regexp_extract(filename, '^([23456789A-HJ-NP-Z]{{8}})\s+', 1) AS key, {_SIGNIFICANT.format(_STEM)} AS words FROM stored),
  s2 AS (SELECT b.key, 'key' AS how, min(filename) AS filename FROM bib b JOIN s1 USING (key) WHERE parent IS NULL GROUP BY b.key), s3 AS (SELECT * FROM bib WHERE parent IS NULL AND key NOT IN (SELECT key FROM s2)),
  s4 AS (SELECT key, unnest(list_transform(list_filter(string_split(coalesce(extra, ''), chr(10)), lambda x: starts_with(lower(trim(x)), 'shelf:')), lambda x: trim(regexp_replace(x, '^[^:]*:', '')))) AS filename FROM s3),
  s5 AS (SELECT key, first(filename) AS filename FROM s4 JOIN stored USING (filename) GROUP BY key), s6 AS (SELECT key, {_SIGNIFICANT.format("title")} AS words FROM s3 WHERE key NOT IN (SELECT key FROM s5)),
  s7 AS (SELECT s6.key, filename, len(list_intersect(s6.words, s1.words)) AS shared, len(s6.words) AS m, len(s1.words) AS n FROM s6, s1), s8 AS (SELECT key, filename, shared / least(m, n) AS score, shared / (m + n - shared) AS jac FROM s7 WHERE least(m, n) >= 3 AND shared >= 4 AND shared / least(m, n) >= 0.85),
  s9 AS (SELECT *, rank() OVER (PARTITION BY key ORDER BY score DESC, jac DESC) AS r FROM s8), s10 AS (SELECT key, filename, score + jac AS claim FROM s9 WHERE r = 1 QUALIFY count(*) OVER (PARTITION BY key) = 1),
  s11 AS (SELECT key, 'recorded' AS how, filename, 2.0 AS claim FROM s5 UNION ALL SELECT key, 'title', filename, claim FROM s10), s12 AS (SELECT *, rank() OVER (PARTITION BY filename ORDER BY claim DESC) AS r FROM s11),
  found AS (SELECT * FROM s2 UNION ALL SELECT key, how, filename FROM s12 WHERE r = 1 QUALIFY count(*) OVER (PARTITION BY filename) = 1)"""
ENV = r"""l1 AS (SELECT pos, trim(value) AS line FROM env), l2 AS (SELECT pos, trim(string_split(line, '=')[1]) AS key, regexp_replace(trim(substr(line, position('=' IN line) + 1)), '^[''"]+|[''"]+$', '', 'g') AS value FROM l1 WHERE contains(line, '=') AND NOT starts_with(line, '#')), env_ AS (SELECT key, arg_max(value, pos) AS value FROM l2 GROUP BY key)"""
# Plans as payloads: out of range numbers, and the reasons against a plan.
ISSUES = """issues AS (SELECT *, list_filter([CASE WHEN NOT coalesce(pages BETWEEN 1 AND 100000, FALSE) THEN 'pages' END, CASE WHEN NOT coalesce(items BETWEEN 1 AND 1000000, FALSE) THEN 'items' END, CASE WHEN NOT coalesce(len(page_size) = 2 AND list_bool_and(list_transform(page_size, lambda v: v > 0 AND v <= 10000)), FALSE) THEN 'page_size' END,
    CASE WHEN NOT coalesce(noise_ratio BETWEEN 0 AND 1, FALSE) THEN 'ratio' END, CASE WHEN NOT coalesce(tables BETWEEN 0 AND coalesce(items, 1000000), FALSE) THEN 'tables' END, CASE WHEN NOT coalesce(repair BETWEEN 0 AND coalesce(tables, 1000000), FALSE) THEN 'repair' END, CASE WHEN NOT coalesce(review BETWEEN 0 AND coalesce(tables, 1000000), FALSE) THEN 'review' END], lambda x: x IS NOT NULL) AS issues FROM payloads)"""
JUDGED = """judged AS (SELECT doc, CASE WHEN len(failed) > 0 THEN list_transform(failed, lambda m: CASE WHEN contains(m, '未知的項目型別') THEN '未知型別 ' || array_to_string(regexp_extract_all(string_split(m, '未知的項目型別')[2], '[A-Za-z_][A-Za-z0-9_-]*'), ', ') WHEN contains(m, '頁序錯位') THEN '頁序錯位' ELSE 'preflight 擋下' END) WHEN NOT planned THEN ['preflight 擋下']
    ELSE list_filter([CASE WHEN plan_doc IS DISTINCT FROM doc THEN 'preflight 擋下' END, CASE WHEN len(issues) > 0 THEN '數字異常' END, CASE WHEN coalesce(refs_suspicious, FALSE) THEN '參考文獻消音比例異常（' || printf('%.1f%%', refs_ratio * 100) || '）' END], lambda x: x IS NOT NULL) END AS reasons FROM issues)"""
STRINGS = """strings AS (SELECT doc_id, unnest(list_filter(list_concat([text, content, body, code_body, table_body, CASE WHEN trim(coalesce(text, '')) = '' THEN orig_text END, CASE WHEN trim(regexp_replace(coalesce(table_body, ''), '<[^>]+>', '', 'g')) = '' THEN orig_table_body END], coalesce(list_items, []), coalesce(table_caption, []), coalesce(image_caption, []), coalesce(image_footnote, []), coalesce(chart_caption, []), coalesce(chart_footnote, []), coalesce(orig_list_items, [])), lambda x: x IS NOT NULL)) AS text FROM items)"""


@query(f"WITH {BAND} SELECT doc_id, top, bottom, left_edge, right_edge FROM band")
def body_bands(items):
    return layout.body_band(items).join(layout.body_hband(items), "doc_id")


@query(f"WITH {BAND}, {NOISE} SELECT doc_id, item_idx, 'noise' AS rule, action, signal, why FROM noise")
def noise_rule(items):
    return layout.noise_plan(items)


@query(f"WITH {HEADS} SELECT doc_id, item_idx, kind, stop AS span_end FROM heads")
def section_spans(items):
    return layout.reference_spans(items)


@query(f"WITH {REFERENCES} SELECT doc_id, item_idx, signal FROM refs")
def reference_rule(items):
    return layout.reference_plan(items).select("doc_id", "item_idx", "signal")


@query(f"WITH {TITLES} SELECT doc_id, item_idx, action, signal, why FROM titles_")
def title_rule(items):
    return layout.title_plan(items).select("doc_id", "item_idx", "action", "signal", "why")


@query(f"WITH {WRAPPERS} SELECT * FROM wrappers")
def wrapper_rule(items):
    return layout.wrapper_pages(items)


@query(f"WITH {BAND}, {NOISE}, {TITLES}, {WRAPPERS} SELECT i.doc_id, i.item_idx, 'wrapper_page' AS signal FROM items i JOIN wrappers USING (doc_id) WHERE fires AND page_idx = 0 AND trim(coalesce(text, '')) <> '' AND (doc_id, item_idx) NOT IN (SELECT (doc_id, item_idx) FROM noise WHERE action = 'mute' UNION ALL SELECT (doc_id, item_idx) FROM titles_ WHERE action = 'mute')")
def cover_rule(items):
    first = layout.noise_plan(items).unionByName(layout.title_plan(items))
    return layout.cover_plan(items, first).select("doc_id", "item_idx", "signal")


@query(f"WITH {BAND}, {EDGES} SELECT * FROM edges")
def margin_rule(items):
    return layout.margin_plan(items).select("doc_id", "item_idx", "signal")


@query(r"""WITH g AS (SELECT doc_id, page_size[1] AS w, page_size[2] AS h, count(*) AS n, min(page_pos) AS first FROM layout_pages GROUP BY ALL), s AS (SELECT doc_id, w, h FROM g QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first) = 1),
  t AS (SELECT *, trim(regexp_replace(coalesce(table_body, ''), '<[^>]+>', '', 'g')) AS txt FROM items WHERE type = 'table'),
  c AS (SELECT *, CASE WHEN NOT has_table_body THEN 'missing_key' WHEN txt = '' THEN 'empty_shell' WHEN contains(table_body, '<img') AND length(txt) < 200 THEN 'img_thin' ELSE 'ok' END AS klass FROM t)
  SELECT doc_id, item_idx, page_idx, klass, round(bbox[1] / 1000 * w, 6) AS x0, round(bbox[4] / 1000 * h, 6) AS y1, coalesce(array_to_string(table_caption, ' '), '') AS caption, length(txt)::INTEGER AS text_len, klass <> 'img_thin' AS repairable FROM c JOIN s USING (doc_id) WHERE klass <> 'ok'""")
def table_rule(items, layout_pages):
    got = layout.table_plan(items, layout_pages)
    return got.withColumns({"x0": F.round(F.col("bbox_pt")[0], 6), "y1": F.round(F.col("bbox_pt")[3], 6)}).drop("bbox_pt")


@query("SELECT i.doc_id, item_idx, CASE WHEN f.img_path IS NULL THEN 'dangling' ELSE 'convert' END AS action, coalesce(chart_caption[1], '') AS caption FROM items i LEFT JOIN files f ON i.doc_id = f.doc_id AND i.img_path = f.img_path WHERE type = 'chart'")
def chart_rule(items, files):
    return layout.chart_plan(items, files).select("doc_id", "item_idx", "action", "caption")


@query("""WITH g AS (SELECT doc_id, page_size[1] AS w, page_size[2] AS h, count(*) AS n, min(page_pos) AS first FROM layout_pages GROUP BY ALL), s AS (SELECT doc_id, w, h FROM g QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first) = 1),
  d AS (SELECT doc_id, max(page_size[1]) - min(page_size[1]) AS dw, max(page_size[2]) - min(page_size[2]) AS dh FROM layout_pages GROUP BY doc_id) SELECT doc_id, w AS width, h AS height, dw, dh FROM s JOIN d USING (doc_id)""")
def page_sizes(layout_pages):
    return layout.reference_page_size(layout_pages).join(layout.page_size_spread(layout_pages), "doc_id")


@query(f"""WITH {SIZES}, t AS (SELECT DISTINCT doc_id, page_idx FROM items WHERE type = 'table' AND (NOT has_table_body OR trim(regexp_replace(coalesce(table_body, ''), '<[^>]+>', '', 'g')) = ''))
  SELECT p.doc_id, p.page_idx FROM layout_pages p JOIN sizes USING (doc_id) JOIN t ON p.doc_id = t.doc_id AND p.page_idx = t.page_idx WHERE abs(page_size[1] - w) > 2.0 OR abs(page_size[2] - h) > 2.0""")
def cropping(items, layout_pages):
    return layout.cropping_mismatch(layout_pages, layout.table_plan(items, layout_pages))


@query("SELECT doc_id, 'page order' AS what, page_pos AS \"at\" FROM layout_pages WHERE page_idx IS DISTINCT FROM page_pos")
def preflight(items, layout_pages):
    return rules.violations(items, layout_pages)


@query(f"WITH {PLAN} SELECT doc_id, rule, count(*) AS n FROM whole WHERE action = 'mute' GROUP BY doc_id, rule")
def whole_plan(items):
    return rules.plan(items).where("action = 'mute'").groupBy("doc_id", "rule").agg(F.count("*").alias("n"))


@query(f"WITH {PLAN}, twice AS (SELECT doc_id, item_idx, rule FROM whole WHERE action = 'mute' UNION ALL SELECT doc_id, item_idx, 'again' FROM edges) SELECT doc_id, item_idx, list_sort(list(DISTINCT rule)) AS rules FROM twice GROUP BY doc_id, item_idx HAVING count(*) > 1", joined=("rules",))
def plan_overlaps(items):
    """The plan beside a margin rule that does not leave out what others claim."""
    careless = layout.margin_plan(items).withColumn("rule", F.lit("again"))
    return rules.overlaps(rules.plan(items).unionByName(careless)).select("doc_id", "item_idx", "rules")


@query(f"""WITH {REFERENCES}, s AS (SELECT doc_id, item_idx, length(coalesce(text, '')) + coalesce(list_sum(list_transform(list_items, lambda x: length(x))), 0) AS c FROM items),
  r AS (SELECT doc_id, sum(c)::BIGINT AS before, coalesce(sum(c) FILTER (signal IS NULL), 0)::BIGINT AS after FROM s LEFT JOIN refs USING (doc_id, item_idx) GROUP BY doc_id)
  SELECT doc_id, 'reference' AS rule, before, after, round(CASE WHEN before > 0 THEN (before - after) / before ELSE 0 END, 9) AS ratio, CASE WHEN before > 0 THEN (before - after) / before ELSE 0 END > 0.3 AS suspicious FROM r""")
def reference_ratio(items):
    return rules.ratios(items, layout.reference_plan(items)).where("rule = 'reference'").withColumn("ratio", F.round("ratio", 9))


@query("SELECT doc_id, item_idx, type, text, coalesce(list_items, []) AS list_items, img_path FROM items", joined=('list_items',))
def mute_and_revert(items, files):
    """Muting, converting and reverting gives the items back."""
    changed = rules.convert_charts(rules.mute(items, rules.plan(items)), layout.chart_plan(items, files))
    return rules.revert(changed).select("doc_id", "item_idx", "type", "text", F.coalesce("list_items", F.array().cast("array<string>")).alias("list_items"), "img_path")


@query(f"WITH {REFERENCES} SELECT doc_id, item_idx, '' AS text, text AS orig_text FROM items JOIN refs USING (doc_id, item_idx) WHERE trim(coalesce(text, '')) <> ''")
def muted_text(items):
    return rules.mute(items, layout.reference_plan(items)).where("orig_text IS NOT NULL").select("doc_id", "item_idx", "text", "orig_text")


@query(f"WITH {BAND}, {NOISE} SELECT n.doc_id, 'noise' AS rule, n.item_idx, CASE WHEN d.item_idx IS NOT NULL THEN 'mute' ELSE n.action END AS action FROM noise n LEFT JOIN (SELECT DISTINCT doc_id, item_idx FROM decisions WHERE suppress AND section = 'noise') d ON n.doc_id = d.doc_id AND n.item_idx = d.item_idx")
def honoured(items, decisions):
    return rules.honour(layout.noise_plan(items), decisions).select("doc_id", "rule", "item_idx", "action")


@query(f"WITH {PLAN} SELECT DISTINCT doc_id, section AS rule, item_idx FROM decisions WHERE suppress AND (doc_id, section, item_idx) NOT IN (SELECT (doc_id, rule, item_idx) FROM whole)")
def lost_decisions(items, decisions):
    return rules.unmatched_decisions(rules.plan(items), decisions)


@query(f"WITH {PLAN} SELECT doc_id, item_idx, rule FROM whole WHERE action = 'held' AND (doc_id, item_idx) NOT IN (SELECT (doc_id, item_idx) FROM whole WHERE rule IN ('cover', 'margin')) AND NOT (rule = 'title' AND why IN ('散文', '關鍵字'))")
def to_confirm(items):
    return rules.confirm_items(rules.plan(items)).select("doc_id", "item_idx", "rule")


@query(f"""WITH {PLAN}, p AS (SELECT doc_id, {", ".join(f"count(*) FILTER (rule = '{r}' AND action = '{a}') AS {r}_{a}" for r in ("noise", "reference", "title", "cover", "margin") for a in ("mute", "held"))} FROM whole GROUP BY doc_id),
  c AS (SELECT doc_id, count(*) AS items, {", ".join(f"count(*) FILTER (type = '{t}') AS type_{t}" for t in P.KNOWN_TYPES)}, sum(length(coalesce(text, '')) + coalesce(list_sum(list_transform(list_items, lambda x: length(x))), 0))::BIGINT AS chars FROM items GROUP BY doc_id)
  SELECT c.*, {", ".join(f"coalesce({r}_{a}, 0) AS {r}_{a}" for r in ("noise", "reference", "title", "cover", "margin") for a in ("mute", "held"))} FROM c LEFT JOIN p USING (doc_id)""")
def canary_rows(items):
    return rules.canary(items, rules.plan(items))


@query("""WITH a AS (SELECT doc_id, count(*) AS items, count(*) FILTER (type = 'text') AS texts FROM items WHERE doc_id <> 'wrap' GROUP BY doc_id), b AS (SELECT doc_id, count(*) AS items, count(*) FILTER (type = 'text') AS texts FROM items WHERE NOT (doc_id = 'book' AND item_idx = 8) AND doc_id <> 'plain' GROUP BY doc_id),
  j AS (SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, a.doc_id IS NULL AS added, b.doc_id IS NULL AS gone, a.items AS i1, b.items AS i2, a.texts AS t1, b.texts AS t2 FROM a FULL JOIN b ON a.doc_id = b.doc_id)
  SELECT doc_id, 'items' AS field, i1::VARCHAR AS old, i2::VARCHAR AS new, 'drift' AS change FROM j WHERE i1 <> i2 UNION ALL SELECT doc_id, 'texts', t1::VARCHAR, t2::VARCHAR, 'drift' FROM j WHERE t1 <> t2
  UNION ALL SELECT doc_id, NULL, NULL, NULL, CASE WHEN added THEN 'added' ELSE 'gone' END FROM j WHERE added OR gone""")
def canary_drift(items):
    counted = lambda df: df.groupBy("doc_id").agg(F.count("*").alias("items"), F.count_if(F.col("type") == "text").alias("texts"))
    return rules.canary_diff(counted(items.where("doc_id <> 'wrap'")), counted(items.where("NOT (doc_id = 'book' AND item_idx = 8) AND doc_id <> 'plain'")))


HAT = r"\\(?:wide)?hat\s*\{\s*\\sigma\s*\}|\\(?:wide)?hat\s*\{\s*\\partial\s*\}|\\widehat\s*\{\s*c\s*\}|\\(?:wide)?hat\s*\{\s*o\s*\}"


@query(rf"""WITH a AS (SELECT id, s, regexp_replace(s, '(_\s*\{{\s*(?:{ROMAN}\s*)*?\\mathsf\s*\{{\s*[IlL1|]\s*\}}(?:\s*{ROMAN})*\s*)\\times(\s*\}})', '\1\\mathsf {{ x }}\2', 'g') AS t, len(regexp_extract_all(s, '_\s*\{{\s*{ROMAN}(?:\s*{ROMAN})*\s*\\times\s*\}}')) AS times FROM latex WHERE contains(s, '\')),
  b AS (SELECT *, regexp_replace(t, '(_\s*\{{\s*{ROMAN}(?:\s*{ROMAN})*\s*)\\times(\s*\}})', '\1x\2', 'g') AS u FROM a), c AS (SELECT *, len(regexp_extract_all(u, '{HAT}')) AS n, regexp_matches(u, '\\frac|/') AS f, regexp_matches(u, '(?i)\\sqrt\s*\{{\s*n\s*\}}|\\bar\s*\{{\s*X\s*\}}') AS st FROM b),
  d AS (SELECT *, n >= 2 AND f AND NOT st AS done, CASE WHEN n >= 2 AND f AND NOT st THEN regexp_replace(u, '{HAT}', '\\partial', 'g') ELSE u END AS v FROM c),
  e AS (SELECT *, list_filter(list_transform(flatten(list_transform(list_filter(regexp_extract_all(v, '\\[A-Za-z]+\s*\{{[^{{}}]*\}}'), lambda x: NOT regexp_matches(x, '^\\(text|mbox)')), lambda x: string_split(regexp_extract(x, '\{{([^{{}}]*)\}}', 1), '~'))), lambda x: trim(x)), lambda x: regexp_full_match(x, '([A-Za-z]\s+)+[A-Za-z]')) AS apart FROM d)
  SELECT id, list_reduce(list_concat([v], apart), lambda whole, x: replace(whole, x, replace(x, ' ', ''))) AS text, times::INTEGER AS times, CASE WHEN done THEN n ELSE 0 END::INTEGER AS partials, n >= 2 AND f AND st AS veto, list_transform(apart, lambda x: replace(x, ' ', '')) AS words FROM e""", joined=("words",))
def latex_fixes(latex):
    return latex.where(F.col("s").contains("\\")).select("id", tex.fix_latex(F.col("s")).alias("f")).select("id", "f.*")


@query(r"""WITH n AS (SELECT id, s, len(regexp_extract_all(s, '\\(?:wide)?hat\s*\{\s*\\sigma\s*\}|\\(?:wide)?hat\s*\{\s*\\partial\s*\}|\\widehat\s*\{\s*c\s*\}|\\(?:wide)?hat\s*\{\s*o\s*\}')) AS n FROM latex),
  v AS (SELECT *, n >= 2 AND regexp_matches(s, '\\frac|/') AS hit, regexp_matches(s, '(?i)\\sqrt\s*\{\s*n\s*\}|\\bar\s*\{\s*X\s*\}') AS stat FROM n)
  SELECT id, CASE WHEN hit AND NOT stat THEN regexp_replace(s, '\\(?:wide)?hat\s*\{\s*\\sigma\s*\}|\\(?:wide)?hat\s*\{\s*o\s*\}', '\\partial', 'g') ELSE s END AS fixed, CASE WHEN hit AND NOT stat THEN n ELSE 0 END::INTEGER AS n, hit AND stat AS veto FROM v""")
def native_partials(latex):
    text, n, veto = T.fix_partial(F.col("s"))
    return latex.select("id", text.alias("fixed"), n.cast("int").alias("n"), veto.alias("veto"))


@query(rf"""WITH m AS (SELECT id, s, regexp_replace(s, '(_\s*\{{\s*(?:{ROMAN}\s*)*?\\mathsf\s*\{{\s*[IlL1|]\s*\}}(?:\s*{ROMAN})*\s*)\\times(\s*\}})', '\1\\mathsf {{ x }}\2', 'g') AS a, len(regexp_extract_all(s, '_\s*\{{\s*{ROMAN}(?:\s*{ROMAN})*\s*\\times\s*\}}')) AS n FROM latex)
  SELECT id, regexp_replace(a, '(_\s*\{{\s*{ROMAN}(?:\s*{ROMAN})*\s*)\\times(\s*\}})', '\1x\2', 'g') AS fixed, n::INTEGER AS n FROM m""")
def native_times(latex):
    text, n = T.fix_times(F.col("s"))
    return latex.select("id", text.alias("fixed"), n.cast("int").alias("n"))


@query(rf"""WITH f AS (SELECT id, s, unnest(regexp_extract_all(s, '{SIDES}')) AS f FROM latex), t AS (SELECT id, s, f, regexp_extract(f, '{SIDES}', 1) AS a, regexp_extract(f, '{SIDES}', 2) AS b FROM f),
  r AS (SELECT id, replace(s, f, replace(replace(f, a, '\partial'), b, '\partial')) AS text, 2 AS n FROM t WHERE regexp_replace(a, '\s|wide', '', 'g') = regexp_replace(b, '\s|wide', '', 'g'))
  SELECT latex.id, coalesce(r.text, s) AS text, coalesce(n, 0)::INTEGER AS n FROM latex LEFT JOIN r USING (id)""")
def repaired_partials(latex):
    return latex.select("id", tex.repair_partials(F.col("s")).alias("r")).select("id", "r.text", "r.n")


@query(rf"""WITH f AS (SELECT id, unnest(regexp_extract_all(s, '{SIDES}')) AS f FROM latex), t AS (SELECT id, regexp_replace(regexp_replace(regexp_extract(f, '{SIDES}', 1), '\s', '', 'g'), 'wide', '') AS a, regexp_replace(regexp_replace(regexp_extract(f, '{SIDES}', 2), '\s', '', 'g'), 'wide', '') AS b FROM f)
  SELECT id, a AS token, count(*) AS n FROM t WHERE a = b GROUP BY id, a""")
def partial_scan(latex):
    hits = latex.where(F.col("s").contains("frac") | F.col("s").contains("/")).select("id", tex.scan_partials(F.col("s")).alias("r"))
    return hits.select("id", F.explode("r.hits").alias("h")).groupBy("id", "h.token").agg(F.count("*").alias("n"))


@query(f"WITH {KEYS} SELECT skeleton, count(*) AS size, count(DISTINCT nums) = 1 AS constants_agree FROM keys WHERE NOT regexp_full_match(skeleton, '[#N=,.;:()\\[\\]{{}}+\\-*/^_\\s]*') GROUP BY skeleton HAVING count(DISTINCT source) > 1")
def equation_classes(equations):
    return matching.equation_classes(matching.equations(equations)).select("skeleton", "size", "constants_agree")


@query()
def equation_pairs(equations):
    pairs = matching.with_evidence(matching.equation_pairs(matching.equations(equations), 0.8))
    return pairs.select("a_id.doc", "a_id.item", F.col("b_id.doc").alias("other"), F.col("b_id.item").alias("other_item"), "ratio", "constants_agree", "first_diff", "evidence")


@query(rf"""WITH f AS (SELECT doc, item, regexp_replace(regexp_replace(latex, '^\s*\$\$?|\$\$?\s*$', ' ', 'g'), '\\(?:mathrm|mathsf|left|right)([^a-zA-Z]|$)', '\1', 'g') AS t FROM equations) SELECT doc, item, lower(regexp_replace(t, '[{{}}\s]', '', 'g')) AS plain FROM f""")
def normal_equations(equations):
    return equations.select("doc", "item", T.eq_normalize(F.col("latex")).alias("plain"))


@query(f"""WITH {GROUNDED}, k AS (SELECT doc, entity_name, bool_or(coalesce(ok, FALSE)) AS ok, count(plain) AS live, coalesce(bool_and(symbolic), FALSE) AS symbolic FROM (SELECT e.*, plain, symbolic, {FOUND.format("n")} AS ok FROM e LEFT JOIN c USING (chunk)) GROUP BY ALL),
  g AS (SELECT doc, count(*) AS total, count(*) FILTER (live > 0 AND ok) AS ok, count(*) FILTER (live = 0) AS missing_chunk, count(*) FILTER (live > 0 AND NOT ok AND symbolic) AS symbolic, count(*) FILTER (live > 0 AND NOT ok AND NOT symbolic) AS suspect FROM k GROUP BY doc)
  SELECT *, CASE WHEN ok + suspect = 0 THEN 'unverifiable' WHEN suspect / (ok + suspect) <= 0.1 THEN 'pass' ELSE 'fail' END AS state FROM g""")
def grounding(entities, chunks):
    got = checks.grounding(entities, chunks)
    return got.withColumn("state", checks.grounding_state(F.col("total"), F.col("ok"), F.col("missing_chunk"), F.col("symbolic")).state)


@query(f"""WITH {CHUNKS_PLAIN}, r AS (SELECT file_path AS doc, source_id, target_id, {PLAIN.format("source_id")} AS n, {PLAIN.format("target_id")} AS m, unnest(chunk_ids) AS chunk FROM relations),
  p AS (SELECT doc, source_id, target_id, bool_or(coalesce({FOUND.format("n")}, FALSE))::INTEGER + bool_or(coalesce({FOUND.format("m")}, FALSE))::INTEGER AS ends FROM r LEFT JOIN c USING (chunk) GROUP BY ALL)
  SELECT doc, count(*) FILTER (ends = 2) AS "both", count(*) FILTER (ends = 1) AS one, count(*) FILTER (ends = 0) AS neither FROM p GROUP BY doc""")
def relation_ends(relations, chunks):
    return checks.relation_endpoints(relations, chunks)


@query("""WITH c AS (SELECT h.chunk, h.doc, length(content) AS n, coalesce(sum(CASE WHEN trim(text) <> '' THEN (length(content) - length(replace(content, text, ''))) END), 0) AS gone FROM hits h LEFT JOIN muted m ON h.doc = m.doc GROUP BY ALL)
  SELECT doc, sum(n)::BIGINT AS chars, sum(gone)::BIGINT AS noise_chars, count(*) AS chunks, count(*) FILTER (gone > 0) AS hit FROM c GROUP BY doc""")
def noise_in_hits(hits, muted):
    return checks.noise_share(hits, muted).select("doc", "chars", F.col("noise_chars").cast("long").alias("noise_chars"), "chunks", "hit")


LABELS = r"'(?i)^(equation|eqn|eq|formula|figure|fig|table|tab|section|sec|appendix|chapter|reference|ref)[\s._\-#]*([0-9]+(\.[0-9]+)*([a-z](-[a-z])?)?|[ivx]+)[)]?\s*$'"
SUSPECTS = r"'(?i)^(region|zone|mode|model|part|case|sample|step|type|stage|item|note|example|phase|panel|scheme|configuration|config)[\s._\-#]*([0-9]+(\.[0-9]+)*([a-z](-[a-z])?)?|[ivx]+)[)]?\s*$'"


@query(f"SELECT count(*) AS nodes, count(*) FILTER (regexp_matches(name, {LABELS})) AS certain, count(*) FILTER (regexp_matches(name, {SUSPECTS})) AS suspect, count(*) FILTER (lower(type) IN ('person', 'organization')) AS people FROM nodes")
def graph_shape(nodes):
    return retrieval.graph_shape(nodes)


@query(f"SELECT name, coalesce(json_extract_string(properties, '$.entity_type'), '?') AS type, CASE WHEN regexp_matches(name, {LABELS}) THEN 'certain' ELSE 'suspect' END AS bucket FROM nodes WHERE regexp_matches(name, {LABELS}) OR regexp_matches(name, {SUSPECTS})")
def label_survey(nodes):
    return retrieval.label_survey(nodes)


@query("SELECT lower(name) AS lower, count(*) AS n, string_agg(name, ' | ' ORDER BY name) AS names FROM nodes GROUP BY lower(name) HAVING count(*) > 1")
def case_variants(nodes):
    return matching.case_variants(nodes)


@query(f"WITH {VARIANTS} SELECT key, names, tier, keep FROM variants", joined=("names",))
def entity_variants(nodes):
    return matching.entity_variants(nodes).select("key", "names", "tier", "keep")


@query(f"WITH {VARIANTS}, q AS (SELECT key, query, count(*) - 1 AS waste FROM (SELECT key, unnest(names) AS name FROM variants) JOIN retrieved USING (name) GROUP BY ALL) SELECT key, coalesce(sum(waste), 0)::BIGINT AS wasted FROM variants LEFT JOIN q USING (key) GROUP BY key")
def wasted_slots(nodes, retrieved):
    return matching.wasted_slots(matching.entity_variants(nodes), retrieved)


@query("SELECT src, dst, weight FROM edges WHERE src IN ('Sound', 'k_0') OR dst IN ('Sound', 'k_0')")
def neighbourhood(edges, merges):
    return retrieval.neighbourhood(edges, merges.select(F.col("target").alias("name")))


@query("WITH m AS (SELECT coalesce(a.target, src) AS src, coalesce(b.target, dst) AS dst, weight FROM edges LEFT JOIN merges a ON src = a.name LEFT JOIN merges b ON dst = b.name) SELECT src, dst, sum(weight) AS weight FROM m WHERE src <> dst GROUP BY src, dst")
def merged_graph(edges, merges):
    return retrieval.merge_entities(edges, merges)


@query("SELECT slots, count(*) AS names FROM (SELECT name, count(*) AS slots FROM retrieved GROUP BY name) GROUP BY slots")
def slot_histogram(retrieved):
    return votes.slot_histogram(retrieved)


@query("SELECT doc, gate, state, note, \"at\", CASE WHEN gate NOT IN ('parse.coverage', 'parse.checks', 'pp.preflight', 'pp.tables', 'pp.equations', 'extract.grounding', 'extract.format', 'retrieval.smoke') THEN 'gate' WHEN state NOT IN ('pass', 'fail', 'unverifiable') THEN 'state' ELSE 'note' END AS why FROM records WHERE doc IN ('d3', 'd4') OR (doc = 'd2' AND gate = 'pp.tables')")
def bad_records(records):
    return ledger.invalid_records(records)


@query("SELECT doc, gate, state, note, \"at\", CASE WHEN lag(state) OVER (PARTITION BY doc, gate ORDER BY \"at\") <> state THEN lag(state) OVER (PARTITION BY doc, gate ORDER BY \"at\") END AS previous FROM records QUALIFY row_number() OVER (PARTITION BY doc, gate ORDER BY \"at\" DESC) = 1")
def latest_records(records):
    return ledger.latest(records)


@query("""WITH l AS (SELECT * FROM records QUALIFY row_number() OVER (PARTITION BY doc, gate ORDER BY "at" DESC) = 1)
  SELECT doc, max(state) FILTER (gate = 'parse.checks') AS checks, max(state) FILTER (gate = 'pp.tables') AS tables FROM live LEFT JOIN l USING (doc) GROUP BY doc""")
def ledger_matrix(records, live):
    got = ledger.summary(ledger.latest(records).select("doc", "gate", "state"), live)
    return got.select("doc", F.col("`parse.checks`").alias("checks"), F.col("`pp.tables`").alias("tables"))


@query(f"WITH {GATES}, r AS (SELECT * FROM records QUALIFY row_number() OVER (PARTITION BY doc, gate ORDER BY \"at\" DESC) = 1) SELECT coalesce(state, 'unset') AS state, count(*) AS n FROM live CROSS JOIN gates LEFT JOIN r USING (doc, gate) GROUP BY 1")
def ledger_tally(records, live):
    return ledger.tally(ledger.latest(records).select("doc", "gate", "state"), live)


@query("SELECT DISTINCT doc FROM records WHERE doc NOT IN (SELECT doc FROM live)")
def ghost_documents(records, live):
    return ledger.ghosts(records, live)


@query(f"SELECT name, {LEVEL} AS level FROM checks")
def alarm_levels(checks):
    return checks.select("name", ledger.level(F.col("name"), F.col("rc"), F.col("scope")).alias("level"))


@query(f"WITH l AS (SELECT name || '_rc' AS rc_name, {LEVEL} AS level FROM checks) SELECT list_sort(list(rc_name) FILTER (level = 'block')) AS blocking, list_sort(list(rc_name) FILTER (level = 'warn')) AS warnings, list_sort(list(rc_name) FILTER (level = 'unverified')) AS unverified, CASE WHEN bool_or(level = 'block') THEN 'fail' ELSE 'pass' END AS status FROM l", joined=('blocking', 'warnings', 'unverified'))
def alarm_summary(checks):
    return ledger.summarise(checks)


@query("SELECT n.name, c.what FROM compat c LEFT JOIN names n ON contains(c.what, n.name) WHERE c.level = 'hard' AND NOT c.ok")
def hard_failures(compat, names):
    return ledger.hard_failures(compat, names)


@query("SELECT job_id, CASE WHEN status <> 'failed' THEN '不管' WHEN index_status IS NULL OR lower(index_status) <> 'processed' OR NOT verify_ok THEN '留著' ELSE '翻牌' END AS decision FROM jobs")
def reconciled(jobs):
    return jobs.select("job_id", workflow.decide(F.col("status"), F.col("index_status"), F.col("verify_ok")).alias("decision"))


@query("SELECT filename, job_id, status FROM jobs QUALIFY row_number() OVER (PARTITION BY filename ORDER BY updated_at DESC, pos DESC) = 1")
def latest_jobs(jobs):
    return workflow.latest_per_document(jobs).select("filename", "job_id", "status")


@query("SELECT job_id, \"at\", before, status FROM (SELECT *, lag(status) OVER (PARTITION BY job_id ORDER BY \"at\") AS before FROM history) WHERE (before = 'planned' AND status = 'indexed') OR (before = 'candidate' AND status <> 'parsing')")
def bad_transitions(history):
    return workflow.bad_transitions(history)


@query("SELECT CASE WHEN filename IS NULL THEN section END AS none, section, n, filename FROM (SELECT CASE WHEN status = 'parsing' THEN 'parsing' WHEN status = 'planned' THEN 'review' WHEN status = 'extracting' THEN 'in_progress' WHEN status = 'failed' THEN 'failed' WHEN status = 'indexed' THEN 'completed' END AS section, filename, count(*) OVER (PARTITION BY CASE WHEN status = 'parsing' THEN 'parsing' WHEN status = 'planned' THEN 'review' WHEN status = 'extracting' THEN 'in_progress' WHEN status = 'failed' THEN 'failed' WHEN status = 'indexed' THEN 'completed' END) AS n FROM jobs)")
def job_console(jobs):
    return workflow.console(jobs).select(F.when(F.col("filename").isNull(), F.col("section")).alias("none"), "section", "n", "filename")


@query("SELECT '工作失敗' AS reason, count(*) AS n FROM jobs WHERE status = 'failed'")
def pending_reasons(jobs):
    return workflow.pending_by_reason(jobs.withColumn("decision", F.lit("novel"))).select("reason", "n")


@query("SELECT name, CASE WHEN b.content IS NULL THEN 'add' WHEN a.content IS NULL THEN 'only_local' WHEN a.content = b.content THEN 'unchanged' ELSE 'update' END AS action FROM mirror_a a FULL JOIN mirror_b b USING (name)")
def mirror_actions(mirror_a, mirror_b):
    return ledger.sync(mirror_a, mirror_b)


@query("WITH v AS (SELECT pair, count(*) FILTER (error IS NULL AND confidence >= 0.7 AND verdict = 'same') AS s, count(*) FILTER (error IS NULL AND confidence >= 0.7 AND verdict = 'different') AS d FROM rulings GROUP BY pair) SELECT pair, CASE WHEN s > d AND s >= 2 THEN 'same' WHEN d > s AND d >= 2 THEN 'different' ELSE 'uncertain' END AS verdict FROM v")
def panel_verdicts(rulings):
    return votes.panel(rulings)


@query("""WITH r AS (SELECT *, error IS NULL AS fine, CASE WHEN error IS NULL AND confidence >= 0.7 THEN verdict END AS said FROM rulings)
  SELECT eye, count(*) FILTER (fine AND truth = 'same' AND said = 'same') AS same_ok, count(*) FILTER (fine AND truth = 'different' AND said = 'different') AS diff_ok, count(*) FILTER (fine AND truth = 'different' AND said = 'same') AS diff_wrong, count(error) AS errors FROM r GROUP BY eye""")
def eye_controls(rulings):
    return votes.control(rulings).select("eye", "same_ok", "diff_ok", "diff_wrong", "errors")


@query("SELECT CASE WHEN jaccard < 0.3 THEN '<0.3' WHEN jaccard < 0.5 THEN '0.3-0.5' WHEN jaccard < 0.7 THEN '0.5-0.7' ELSE '>=0.7' END AS bin, count(*) AS n, count(*) FILTER (verdict = 'different') AS caught, count(*) FILTER (verdict = 'same') AS missed FROM rulings WHERE error IS NULL GROUP BY bin")
def judged_bins(rulings):
    return votes.judged_bins(rulings)


@query("""WITH p AS (SELECT id, lang, max(score) FILTER (side = 'a') AS a, max(score) FILTER (side = 'b') AS b FROM scores GROUP BY ALL)
  SELECT lang, round(avg(a), 9) AS a, round(avg(b), 9) AS b, count(*) FILTER (a > b) AS wins_a, count(*) FILTER (b > a) AS wins_b, count(*) FILTER (a = b) AS ties FROM p WHERE b IS NOT NULL GROUP BY ROLLUP (lang)""")
def scored_sides(scores):
    return retrieval.compare_sides(scores).select("lang", F.round("a", 9).alias("a"), F.round("b", 9).alias("b"), "wins_a", "wins_b", "ties")


@query(f"WITH {RANGES}, {NUMBERS} SELECT doc, pos, title, page AS start, fin AS \"end\", number::INTEGER AS number, lpad(number::VARCHAR, 5, '0') || '_' AS prefix, replace(replace(title, '/', '_'), ':', '_') AS safe_title FROM m6")
def chapter_numbers(toc, totals):
    return chapters.numbered(chapters.ranges(toc, totals)).select("doc", "pos", "title", "start", "end", "number", "prefix", "safe_title")


@query(f"WITH {RANGES}, {HEADINGS} SELECT doc, pos, page FROM headings")
def chapter_headings(toc, totals, spans):
    return chapters.heading_pages(spans, chapters.ranges(toc, totals))


@query(rf"""WITH RECURSIVE {RANGES}, {HEADINGS},
  c(doc, pos, here, fin) AS (SELECT doc, pos, page, fin FROM ranges UNION ALL SELECT c.doc, c.pos, coalesce((SELECT max(h.page) FROM headings h WHERE h.doc = c.doc AND h.pos = c.pos AND h.page > c.here AND h.page < c.here + 18), c.here + 18), fin FROM c WHERE fin - here + 1 > 18),
  d AS (SELECT *, coalesce(lead(here) OVER w - 1, fin) AS until, row_number() OVER w AS i FROM c WINDOW w AS (PARTITION BY doc, pos ORDER BY here)),
  e AS (SELECT * FROM d WHERE i = 1 OR until - here + 1 >= 10), f AS (SELECT *, row_number() OVER w AS j, lag(here) OVER w AS prior FROM e WINDOW w AS (PARTITION BY doc, pos ORDER BY here)), g AS (SELECT * FROM f WHERE NOT (j = 2 AND here - prior < 10))
  SELECT doc, pos, (row_number() OVER w)::INTEGER AS part, here AS start, coalesce(lead(here) OVER w - 1, fin) AS "end", CASE WHEN count(*) OVER (PARTITION BY doc, pos) > 1 THEN '_part' || row_number() OVER w ELSE '' END AS suffix FROM g WINDOW w AS (PARTITION BY doc, pos ORDER BY here)""")
def chapter_parts(toc, totals, spans):
    plans = chapters.ranges(toc, totals)
    return chapters.parts(plans, chapters.heading_pages(spans, plans), 18)


@query("""WITH s AS (SELECT doc, total_pages, unnest(range(1, greatest(total_pages, 1) + 1, 15)) AS a FROM totals WHERE total_pages > 0), k AS (SELECT *, max(a) OVER (PARTITION BY doc) AS last FROM s), f AS (SELECT * FROM k WHERE a = 1 OR a < last OR total_pages - a + 1 >= 10)
  SELECT doc, (row_number() OVER w)::INTEGER AS part, a::INTEGER AS start, coalesce(lead(a) OVER w - 1, total_pages)::INTEGER AS "end" FROM f WINDOW w AS (PARTITION BY doc ORDER BY a)""")
def equal_parts(totals):
    return chapters.without_toc(totals, 15)


@query(r"""WITH p AS (SELECT doc, total_pages AS pages, count(toc.pos) AS n, count(*) FILTER (level <= 1) AS flat, count(*) FILTER (regexp_matches(title, '(?i)^\s*(?:第\s*)?(?:[0-9]+|[ivxlcdm]+)\s*(?:頁)?\s*$')) AS numeric FROM totals LEFT JOIN toc USING (doc) GROUP BY ALL)
  SELECT doc, pages > 0 AND n >= 20 AND flat >= 0.9 * n AND (n >= 0.75 * pages OR (n >= 0.5 * pages AND numeric >= 0.75 * n)) AS degenerate FROM p""")
def degenerate_tocs(toc, totals):
    return chapters.degenerate(toc, totals)


@query(f"""WITH d AS (SELECT doc, unnest(range(1, max(level) + 1)) AS upto FROM toc GROUP BY doc), r AS (SELECT t.*, upto, total_pages, lead(page) OVER (PARTITION BY t.doc, upto ORDER BY pos) AS nxt FROM toc t JOIN d ON t.doc = d.doc AND t.level <= upto JOIN totals ON t.doc = totals.doc)
  SELECT doc, upto::INTEGER AS level, count(*) FILTER (page <= coalesce(greatest(nxt - 1, page), total_pages) AND NOT ({PREAMBLE}) AND NOT ({APPENDIX})) AS selected FROM r GROUP BY doc, upto""")
def depth_options(toc, totals):
    return chapters.level_options(toc, totals)


@query(f"WITH {RANGES} SELECT doc, title, row_number() OVER w::INTEGER AS serial, 'K_' || printf('%02d', row_number() OVER w) || ' T_' || replace(title, ':', '_') || '.pdf' AS filename, NOT (({PREAMBLE}) OR ({APPENDIX})) AS selected FROM ranges WINDOW w AS (PARTITION BY doc ORDER BY pos)")
def chapter_selection(toc, totals):
    return chapters.selection(chapters.ranges(toc, totals), "K", "T").select("doc", "title", "serial", "filename", "selected")


@query("SELECT doc, pos, title, sum((level <= 1)::INTEGER) OVER (PARTITION BY doc ORDER BY pos)::BIGINT AS \"group\", last_value(CASE WHEN level <= 1 THEN title END IGNORE NULLS) OVER (PARTITION BY doc ORDER BY pos) AS group_title FROM toc")
def chapter_groups(toc):
    return chapters.groups(toc).select("doc", "pos", "title", "group", "group_title")


@query(rf"""SELECT id, CASE WHEN {PREAMBLE} THEN 'preamble' WHEN {APPENDIX} THEN 'appendix' ELSE 'chapter' END AS kind, coalesce(nullif(trim(regexp_replace(regexp_replace(regexp_replace(title, '[^\p{{L}}\p{{N}}\p{{P}}\p{{S}}\p{{Zs}}\t]', '', 'g'), '[\\/*?:"<>|]', '_', 'g'), '\s+', ' ', 'g')), ''), 'untitled') AS safe FROM titles""")
def title_kinds(titles):
    return titles.select("id", chapters.title_kind(F.col("title")).alias("kind"), T.sanitize_filename(F.col("title")).alias("safe"))


@query(f"WITH RECURSIVE {ROOTS} SELECT source, root FROM roots")
def source_roots(sources):
    return matching.source_roots(sources)


@query("""WITH s AS (SELECT c.doc, CASE WHEN r.doc IS NULL THEN 'unregistered' WHEN d.digest IS NULL THEN 'no_ledger' WHEN coalesce(pdf_sha256, '') <> '' AND pdf_sha256 <> digest THEN 'hash_changed' ELSE 'ok' END AS state FROM corpus c LEFT JOIN registry r USING (doc) LEFT JOIN digests d USING (doc))
  SELECT * FROM s UNION ALL SELECT doc, 'stale' FROM registry WHERE doc NOT IN (SELECT doc FROM corpus)""")
def source_states(corpus, registry, digests):
    return matching.reconcile(corpus, registry, digests)


@query(f"""WITH RECURSIVE {ROOTS}, s AS (SELECT c.doc, d.digest IS NOT NULL AND (coalesce(r.pdf_sha256, '') = '' OR r.pdf_sha256 = d.digest) AS fine, r.source FROM corpus c JOIN registry r USING (doc) LEFT JOIN digests d USING (doc))
  SELECT doc, coalesce(root, s.source) AS source FROM s LEFT JOIN roots ON s.source = roots.source WHERE fine AND s.source IS NOT NULL""")
def trusted_sources(corpus, registry, digests, sources):
    return matching.source_of(matching.reconcile(corpus, registry, digests), registry, matching.source_roots(sources))


@query(r"""WITH f AS (SELECT doc, try_cast(regexp_extract(doc, '^0([0-9]{4})_([0-9]+)', 1) AS INTEGER) // 100 - try_cast(regexp_extract(doc, '^0([0-9]{4})_([0-9]+)', 2) AS INTEGER) AS off, CASE WHEN regexp_matches(doc, '(?i)^.*?_CH[0-9]') THEN lower(regexp_replace(regexp_extract(doc, '(?i)^(.*?)_CH[0-9]', 1), '\s+', '', 'g')) END AS prefix FROM filenames),
  r AS (SELECT a.doc, min_by(b.prefix, length(b.prefix)) AS root FROM f a JOIN f b ON starts_with(a.prefix, b.prefix) GROUP BY a.doc)
  SELECT doc, CASE WHEN off = 9 THEN 'book:0xxxx-A' WHEN off = 6 THEN 'book:0xxxx-B' WHEN root IS NOT NULL THEN 'book:' || left(root, 60) WHEN regexp_matches(doc, '^[A-R] [A-Z]') THEN 'book:a-r-handbook' WHEN regexp_matches(doc, '(?i)supplement|MOESM') THEN NULL ELSE 'doc:' || doc END AS source,
    CASE WHEN off IN (6, 9) THEN 'number' WHEN root IS NOT NULL THEN 'chapter' WHEN regexp_matches(doc, '^[A-R] [A-Z]') THEN 'handbook' WHEN regexp_matches(doc, '(?i)supplement|MOESM') THEN 'supplement' ELSE 'self' END AS why FROM f LEFT JOIN r USING (doc)""")
def proposed_sources(filenames):
    return matching.propose_sources(filenames)


@query(f"WITH {STORED} SELECT key, how, filename FROM found")
def stored_items(bib, stored):
    return matching.documents_in_kb(bib.where("parent IS NULL"), stored, "shelf")


@query(f"""WITH {STORED}, w AS (SELECT b.key, parent, tags, CASE WHEN parent IS NOT NULL THEN [] ELSE list_distinct(list_concat(CASE WHEN f.key IS NULL THEN [] ELSE ['in-kb'] END, list_filter(tags, lambda x: x IN ('in-kb', 'read')))) END AS want FROM bib b LEFT JOIN found f USING (key)),
  c AS (SELECT key, list_sort(list_distinct(tags)) AS before, list_sort(list_distinct(list_concat(list_filter(tags, lambda x: x NOT IN ('in-kb', 'read')), want))) AS after FROM w) SELECT * FROM c WHERE before <> after""", joined=('before', 'after'))
def tag_changes(bib, stored):
    found = matching.documents_in_kb(bib.where("parent IS NULL"), stored, "shelf")
    return matching.plan_changes(bib, found, bib.where("false"), {"in_kb": "in-kb", "read": "read"})


@query(f"WITH {ENV} SELECT key, value FROM env_")
def env_values(env):
    return bundles.parse_env(env)


@query(f"WITH {ENV} SELECT coalesce(b.key, o.key) AS key, coalesce(o.value, b.value) AS value, CASE WHEN b.key IS NULL THEN 'new' WHEN o.key IS NOT NULL THEN 'overwrite' END AS action FROM env_ b FULL JOIN over o ON b.key = o.key")
def env_overlay(env, over):
    return bundles.overlay_env(bundles.parse_env(env), over)


@query("SELECT DISTINCT trim(string_split(string_split(file_path, '<SEP>')[1], '/')[-1]) AS name FROM paths WHERE file_path IS NOT NULL AND file_path <> ''")
def indexed_names(paths):
    return bundles.indexed_documents(paths)


@query("SELECT doc_id, first(path ORDER BY hash_match DESC, pos) AS path, bool_or(hash_match) AS verified FROM candidates GROUP BY doc_id")
def verified_sources(candidates):
    return bundles.source_or_first(candidates)


@query(r"""WITH b AS (SELECT id, regexp_replace(command, '(?sm)<<-?\s*[''"]?EOF[''"]?.*?^EOF\s*$', '<<HEREDOC', 'g') AS c FROM commands)
  SELECT id, list_filter([CASE WHEN regexp_matches(c, 'docker\s+compose\b[^|;&]*\bconfig\b') AND NOT regexp_matches(c, 'docker\s+compose\b[^|;&]*\bconfig\b[^|;&]*--hash') THEN 'compose-config-resolves-env' END, CASE WHEN regexp_matches(c, '(^|[|;&]\s*)(env|printenv)\s*($|[|;&])') THEN 'whole-env-dump' END,
    CASE WHEN regexp_matches(c, '\b(cat|less|more|head|tail|bat)\b[^|;&]*(^|[\s=/])\.env($|[^.\w])') THEN 'cat-dotenv' END, CASE WHEN regexp_matches(c, '(^|[|;&]\s*)(source|\.)\s+[^\s|;&]*\.env\b') THEN 'source-dotenv' END,
    CASE WHEN regexp_matches(c, '\.Config\.(Cmd|Env)[^|;&]*\|\s*(sed|awk|grep|python)') THEN 'redact-after-the-fact' END, CASE WHEN regexp_matches(c, '\|[^;&\n]*[;&]\s*[^;&\n]*\$\?') THEN 'exit-code-after-pipe' END], lambda x: x IS NOT NULL) AS rules FROM b""", joined=('rules',))
def guarded_commands(commands):
    return commands.select("id", T.command_rules(F.col("command")).alias("rules"))


@query(r"""WITH m AS (SELECT *, regexp_extract_all(string_split(string_split(message, '未知的項目型別')[-1], '——')[1], '[A-Za-z_][A-Za-z0-9_-]*') AS kinds FROM messages)
  SELECT id, CASE WHEN contains(message, '未知的項目型別') THEN '未知型別 ' || CASE WHEN len(kinds) > 0 THEN array_to_string(kinds, ', ') ELSE '未列出' END WHEN contains(message, '頁面尺寸不一致') THEN '頁面尺寸不一致' WHEN contains(message, '頁序錯位') THEN '頁序錯位' WHEN contains(message, '比例') OR contains(message, '數字') THEN '數字異常' ELSE 'preflight 擋下' END AS reason FROM m""")
def failure_reasons(messages):
    return messages.select("id", T.failure_reason(F.col("message")).alias("reason"))


@query(rf"""SELECT id, coalesce(nullif(regexp_extract(raw, '(?is)(<table\b.*?</table>)', 1), ''), {STRIP.format("raw")}) AS html, list_filter([CASE WHEN coalesce(finish, '') NOT IN ('', 'stop') THEN 'V1 finish_reason=' || finish END, CASE WHEN NOT regexp_matches(raw, '(?is)</table>\s*`*\s*$') THEN 'V2 輸出未以 </table> 結尾' END], lambda x: x IS NOT NULL) AS failures FROM raws""", joined=('failures',))
def transcripts(raws):
    return raws.select("id", T.extract_html(F.col("raw")).alias("html"), T.truncation_failures(F.col("raw"), F.col("finish")).alias("failures"))


CELLS = "list_transform(regexp_extract_all({0}, '<tr>(.*?)</tr>', 1), lambda r: list_transform(regexp_extract_all(r, '<td>(.*?)</td>', 1), lambda c: list_distinct(list_transform(regexp_extract_all(replace(c, '\\mathrm', ''), '[A-Za-z]_\\{{+[^}}]*\\}}+|[A-Za-z]{{3,}}|[0-9]+(?:\\.[0-9]+)?'), lambda t: lower(regexp_replace(t, '[{{}}]', '', 'g'))))))"


@query(f"""WITH g AS (SELECT id, {CELLS.format("a")} AS x, {CELLS.format("b")} AS y FROM tables_html), u AS (SELECT id, unnest(flatten(x)) AS p, unnest(flatten(y)) AS q FROM g WHERE len(x) = len(y)),
  n AS (SELECT id, count(*) AS cells, count(*) FILTER (len(list_intersect(p, q)) >= 0.8 * len(list_distinct(list_concat(p, q)))) AS agree FROM u WHERE len(p) + len(q) > 0 GROUP BY id)
  SELECT id, CASE WHEN len(x) = 0 OR len(y) = 0 THEN 'no table' END AS structural, coalesce(cells, 0)::INTEGER AS cells, coalesce(agree, 0)::INTEGER AS agree, coalesce(agree = cells AND cells >= 4, FALSE) AS ok FROM g LEFT JOIN n USING (id)""")
def compared_tables(tables_html):
    return tables_html.select("id", votes.compare_tables(F.col("a"), F.col("b")).alias("c")).select("id", "c.*")


@query(r"SELECT where_ FROM edits WHERE NOT regexp_matches(new, '(?s)' || array_to_string(list_transform(string_split(coalesce(current, ''), ''), lambda c: regexp_escape(c)), '.*'))")
def additive_edits(edits):
    return votes.additive_violations(edits).select("where_")


@query(r"""WITH n AS (SELECT where_, tag, count(*) AS n FROM (SELECT where_, unnest(regexp_extract_all(new, '(?i)<img\b[^>]*>')) AS tag FROM edits) GROUP BY ALL), c AS (SELECT where_, tag, count(*) AS c FROM (SELECT where_, unnest(regexp_extract_all(coalesce(current, ''), '(?i)<img\b[^>]*>')) AS tag FROM edits) GROUP BY ALL)
  SELECT n.where_, n.tag FROM n LEFT JOIN c ON n.where_ = c.where_ AND n.tag = c.tag WHERE n.n > coalesce(c.c, 0) OR regexp_matches(n.tag, '(?i)src\s*=\s*["'']?\s*(?:[a-z]+:|//|/|\.\.)')""")
def image_edits(edits):
    return votes.image_violations(edits)


@query(r"""WITH h AS (SELECT name, coalesce(nullif(regexp_extract(name, '^(?:draft_)?[A-Za-zÀ-ɏ&\-'']+\s+[0-9]{4}\s*[-–]\s*(.+)$', 1), ''), name) AS own, string_split(coalesce(body, ''), '## Links')[1] AS head FROM notes),
  s AS (SELECT name, own, CASE WHEN contains(head, '## Sources') THEN substr(head, position('## Sources' IN head) + 10) ELSE '' END AS src FROM h)
  SELECT name, list_concat([own], list_concat(regexp_extract_all(src, '`([^`]{20,})`', 1), regexp_extract_all(src, '[-*]\s+(.{20,})', 1))) AS candidates FROM s""", joined=('candidates',))
def note_titles(notes):
    return notes.select("name", T.note_candidates(F.col("name"), F.col("body")).alias("candidates"))


#: Letters set apart in an argument: ~ parts words.
GLUED = r"array_to_string(list_transform(string_split(regexp_extract(plain, '\\[A-Za-z]+\s*\{([^{}]*)\}', 1), '~'), lambda x: CASE WHEN regexp_full_match(trim(x), '([a-z]\s+)+[a-z]') THEN replace(x, ' ', '') ELSE x END), ' ')"


@query(rf"""WITH p AS (SELECT id, text, replace(regexp_replace(text, '\x{{00AD}}\s*', '', 'g'), 'ﬂ', 'fl') AS plain, replace(strip_accents(replace(replace(text, 'ﬂ', 'fl'), 'ł', 'l')), 'Ł', 'L') AS folded FROM words_text),
  g AS (SELECT *, CASE WHEN regexp_matches(plain, '\\[A-Za-z]+\s*\{{') THEN regexp_replace(plain, '\{{[^{{}}]*\}}', '{{ ' || {GLUED} || ' }}') ELSE plain END AS joined FROM p)
  SELECT id, array_to_string(regexp_extract_all(lower(joined), '[a-z]{{4,}}'), '|') AS words, trim(lower(regexp_replace(folded, '[^A-Za-z0-9\x{{3040}}-\x{{30ff}}\x{{3400}}-\x{{4dbf}}\x{{4e00}}-\x{{9fff}}\x{{ac00}}-\x{{d7af}}]+', ' ', 'g'))) AS norm FROM g""")
def unicode_words(words_text):
    return words_text.select("id", F.array_join(unicode.words_of(F.col("text")), "|").alias("words"), unicode.normal(F.col("text")).alias("norm"))


@query("SELECT doc_id, 1::INTEGER * row_number() OVER (PARTITION BY doc_id ORDER BY item_idx)::INTEGER AS ordinal, string_split(img_path, '/')[-1] AS file, (coalesce(page_idx, 0) + 1)::INTEGER AS page FROM items WHERE img_path IS NOT NULL")
def figures(items):
    return matching.figure_index(items, F.lower("doc_id")).select("doc_id", "ordinal", "file", "page")


@query("SELECT doc_id, 'heading' AS part, count(*) AS n FROM items WHERE text_level > 0 GROUP BY doc_id UNION ALL SELECT doc_id, CASE WHEN type IN ('image', 'chart') THEN 'figure' ELSE type END, count(*) FROM items WHERE type IN ('table', 'equation', 'image', 'chart') GROUP BY ALL")
def document_parts(items):
    return retrieval.doc_summary(items).groupBy("doc_id", "part").agg(F.count("*").alias("n"))


def _payload_frame(payloads: DataFrame) -> DataFrame:
    zero = F.lit(0)
    plan = F.struct("pages", "items", "page_size", "noise_ratio", F.lit(False).alias("noise_suspicious"), "tables", "repair", "review", *(zero.alias(n) for n in ("mute", "held", "convert", "dangling")))
    return payloads.withColumns({"plan": F.when(F.col("planned"), plan), "title_ratio": F.lit(None).cast("double"), "title_suspicious": F.lit(False)})


@query(f"WITH {ISSUES}, {JUDGED} SELECT doc, len(reasons) = 0 AS accepted, reasons FROM judged", joined=("reasons",))
def plan_evaluation(payloads):
    return ledger.evaluate_plans(_payload_frame(payloads)).select("doc", "accepted", "reasons")


@query(f"WITH {ISSUES} SELECT doc, issues FROM issues WHERE planned", joined=("issues",))
def plan_issues(payloads):
    return _payload_frame(payloads).where("planned").select("doc", ledger.plan_issues().alias("issues"))


@query(f"""WITH {ISSUES}, {JUDGED} SELECT doc, 'pp.preflight' AS gate, CASE WHEN len(reasons) = 0 THEN 'pass' WHEN admitted THEN 'unverifiable' ELSE 'fail' END AS state FROM judged JOIN payloads USING (doc)
  UNION ALL SELECT doc, 'pp.tables', CASE WHEN NOT planned OR repair > 0 OR review > 0 THEN 'unverifiable' ELSE 'pass' END FROM payloads""")
def plan_entries(payloads):
    judged = ledger.evaluate_plans(_payload_frame(payloads)).select("doc", "accepted")
    return ledger.entries_from_plan(payloads.join(judged, "doc").withColumn("has_tables", F.col("planned")))


@query("""SELECT m."check", m.metric, m.doc, k.pos, CASE WHEN k.value = 0 THEN FALSE ELSE abs(m.value - k.value) / abs(k.value) > 0.5 END AS stale FROM measures m JOIN known k ON m."check" = k."check" AND m.metric = k.metric AND contains(m.doc, k.doc)
  QUALIFY row_number() OVER (PARTITION BY m."check", m.metric, m.doc ORDER BY k.pos) = 1""")
def finding_staleness(measures, known):
    return ledger.findings_for(measures, known)


@query("SELECT doc, row_number() OVER (ORDER BY doc)::INTEGER AS position, lead(doc) OVER (ORDER BY doc) AS next FROM corpus WHERE doc NOT IN (SELECT doc FROM live)")
def review_queue(corpus, live):
    return ledger.pending(corpus, live)


@query(r"""WITH f AS (SELECT *, NOT (list_contains(tags, 'BabelDOC_translated') OR regexp_matches(title || ' ' || name, '(?i)(_?zht|zh-?tw|[-_.]dual\b|[-_.]mono\b|_translation|翻譯)')) AS fine FROM attachments),
  g AS (SELECT key, count(*) AS n, count(*) FILTER (fine) AS f, count(*) FILTER (fine AND trim(title) = 'PDF') AS p, max(name) AS one, max(name) FILTER (fine) AS sole, max(name) FILTER (fine AND trim(title) = 'PDF') AS pdf FROM f GROUP BY key)
  SELECT key, CASE WHEN n = 1 THEN one WHEN f = 0 THEN NULL WHEN f = 1 THEN sole WHEN p = 1 THEN pdf END AS chosen, CASE WHEN n = 1 THEN 'only' WHEN f = 0 THEN 'all-translated' WHEN f = 1 THEN 'sole-original' WHEN p = 1 THEN 'named-PDF' ELSE 'ambiguous' END AS reason FROM g""")
def chosen_attachments(attachments):
    return matching.choose_attachment(attachments)


@query("SELECT DISTINCT key, CASE WHEN key NOT IN (SELECT key FROM index_rows) THEN 'missing' WHEN key IN (SELECT key FROM index_rows WHERE status = 'failed') THEN 'failed' WHEN key NOT IN (SELECT key FROM index_rows WHERE status <> 'completed') THEN 'done' ELSE 'pending' END AS state FROM attachments")
def index_states(index_rows, attachments):
    return matching.decide_by_key(attachments.select("key").distinct(), index_rows)


@query("""WITH n AS (SELECT doc, file, file AS name FROM images UNION SELECT doc, file, alias FROM images) SELECT name, CASE WHEN count(DISTINCT doc) = 1 THEN min(doc) END AS doc, CASE WHEN count(DISTINCT doc) = 1 THEN min(file) END AS file, count(DISTINCT doc) > 1 AS ambiguous FROM wanted JOIN n USING (name) GROUP BY name""")
def image_lookup(images, wanted):
    return matching.find_image(images, wanted)


@query("SELECT name, label FROM asked JOIN label_list ON lower(regexp_replace(name, '\\s+', '', 'g')) = lower(regexp_replace(label, '\\s+', '', 'g')) WHERE name NOT IN (SELECT label FROM label_list)")
def near_labels(asked, label_list):
    return matching.near_matches(asked, label_list)


@query("SELECT family, path FROM reports QUALIFY row_number() OVER (PARTITION BY family ORDER BY modified DESC, path) > 2")
def pruned_reports(reports):
    return ledger.newest(reports, 2).select("family", "path")


@query("SELECT name, max(\"at\"::TIMESTAMPTZ) < TIMESTAMPTZ '2024-01-03 12:00:00+00' - INTERVAL 24 HOURS AS stale FROM reports GROUP BY name")
def stale_reports(reports):
    return workflow.stale(reports, F.lit("2024-01-03 12:00:00").cast("timestamp")).select("name", "stale")


@query("SELECT id, mode <> 'naive' AND coalesce(len(high), 0) = 0 AND coalesce(len(low), 0) = 0 AND coalesce(allow, '') NOT IN ('1', 'true', 'yes') AS missing FROM requests")
def keyword_guard(requests):
    return requests.select("id", retrieval.needs_keywords(F.col("mode"), F.col("high"), F.col("low"), F.col("allow")).alias("missing"))


@query(r"""WITH p AS (SELECT query, list_filter(string_split(regexp_replace(coalesce(context, ''), '(?m)^(#{1,6}\s)', chr(1) || '\1', 'g'), chr(1)), lambda x: x <> '') AS parts FROM contexts), u AS (SELECT query, unnest(parts) AS s, generate_subscripts(parts, 1) - 1 AS section FROM p)
  SELECT query, section::INTEGER AS section, length(s)::INTEGER AS chars, len(list_filter(regexp_split_to_array(s, '\s+'), lambda w: w <> ''))::INTEGER AS words FROM u""")
def context_sizes(contexts):
    return retrieval.section_sizes(contexts).select("query", "section", "chars", "words")


@query("""SELECT id, CASE WHEN ab >= 0.85 AND (am >= 0.85 OR bm >= 0.85) THEN 'consensus' WHEN ab >= 0.85 THEN 'suspect' WHEN am >= 0.85 OR bm >= 0.85 THEN 'majority' WHEN coalesce(ca, 0) >= 0.85 OR coalesce(cb, 0) >= 0.85 OR coalesce(cm, 0) >= 0.85 THEN 'tie_broken' ELSE 'three_way' END AS kind FROM ratios""")
def four_votes(ratios):
    return votes.vote4(ratios).select("id", "kind")


@query("""WITH s AS (SELECT name, count(*) AS slots FROM retrieved GROUP BY name), l AS (SELECT DISTINCT name FROM nodes)
  SELECT verdict, count(*) AS n, count(l.name) AS matched, coalesce(sum(slots), 0)::BIGINT AS slots, count(*) FILTER (coalesce(slots, 0) > 0) AS hit FROM answers LEFT JOIN l USING (name) LEFT JOIN s USING (name) GROUP BY verdict""")
def verdict_slots(answers, retrieved, nodes):
    slots = retrieved.groupBy("name").agg(F.count("*").alias("slots"))
    return votes.verdict_groups(answers, slots, nodes.select("name").distinct()).select("verdict", "n", "matched", "slots", "hit")


@query("SELECT list_sort(list(DISTINCT regexp_replace(reason, '（[^（()）]*[0-9][^（()）]*）$', ''))) AS kinds, count(*) AS occurrences, greatest(0, 30 - arg_max(processed_index, created_at))::INTEGER AS distance FROM event_rows", joined=("kinds",))
def event_distance(event_rows):
    return workflow.convergence(event_rows, 30)


@query(r"SELECT candidate_id, name FROM pdfs WHERE NOT regexp_matches(name, '(^\.)|[/\\]|\.\.') AND candidate_id NOT IN (SELECT candidate_id FROM used) AND sha256 NOT IN (SELECT sha256 FROM hashes WHERE sha256 NOT IN (SELECT sha256 FROM resets))")
def new_candidates(pdfs, used, hashes, resets):
    return bundles.new_candidates(pdfs, used, [hashes], resets).select("candidate_id", "name")


@query("SELECT family, count(*) AS n FROM voters GROUP BY family HAVING count(*) > 1")
def shared_families(voters):
    return workflow.shared_families(voters)


@query("WITH w AS (SELECT id, list_distinct(regexp_extract_all(lower(a), '[a-z]{4,}')) AS a, list_distinct(regexp_extract_all(lower(b), '[a-z]{4,}')) AS b FROM two_texts) SELECT id, round(len(list_intersect(a, b)) / greatest(len(list_distinct(list_concat(a, b))), 1), 9) AS jaccard FROM w")
def word_overlap(two_texts):
    return two_texts.select("id", F.round(matching.word_jaccard(F.col("a"), F.col("b")), 9).alias("jaccard"))


@query("""WITH a AS (SELECT j.job_id, j.status, j.status IN ('parsing', 'repairing', 'repaired') AS early, lower(coalesce(i.index_status, '')) AS known FROM jobs j LEFT JOIN index_docs i USING (filename) WHERE j.status IN ('parsing', 'repairing', 'repaired', 'admitted', 'scanning', 'extracting'))
  SELECT job_id, status, CASE WHEN early THEN status WHEN known = 'processed' THEN 'indexed' WHEN known IN ('processing', 'pending') THEN status ELSE 'failed' END AS recovered, CASE WHEN early THEN 'queue' WHEN known = 'processed' THEN 'done' WHEN known IN ('processing', 'pending') THEN 'wait' ELSE 'failed' END AS action FROM a""")
def recovered_jobs(jobs, index_docs):
    return workflow.recover(jobs.drop("index_status"), index_docs)


@query("SELECT job_id, (SELECT bool_or(status IN ('parsing', 'admitted', 'scanning', 'extracting')) FROM jobs) AS blocked FROM jobs WHERE status = 'planned'")
def batch_barrier(jobs):
    return workflow.round_can_start(jobs)


@query("SELECT filename, index_status FROM index_docs WHERE filename NOT IN (SELECT filename FROM jobs WHERE status IN ('admitted', 'scanning', 'extracting', 'indexed'))")
def foreign_documents(index_docs, jobs):
    return workflow.foreign_documents(index_docs, jobs)


@query("""SELECT name, sha256('{"family":"' || family || '","name":"' || name || '"}') AS hash FROM voters""")
def profile_hashes(voters):
    return voters.select("name", ledger.profile_hash("name", "family").alias("hash"))


@query("WITH d AS (SELECT count(*) AS n, max('2024-01-0' || right(doc, 1)) AS last FROM corpus) SELECT d.n AS documents, concat_ws('|', d.n, (SELECT count(*) FROM chunks), (SELECT count(*) FROM entities), (SELECT count(*) FROM relations), d.last) AS fingerprint FROM d")
def change_fingerprint(corpus, chunks, entities, relations):
    dated = corpus.withColumn("updated_at", F.concat(F.lit("2024-01-0"), F.right("doc", F.lit(1))))
    return retrieval.change_fingerprint(dated, chunks, entities, relations).select("documents", "fingerprint")


@query(f"""WITH {REFERENCES}, s AS (SELECT doc_id, item_idx, type, sub_type, length(coalesce(text, '')) AS t, coalesce(list_sum(list_transform(list_items, lambda x: length(x))), 0) AS l, coalesce(len(list_items), 0) AS entries, trim(coalesce(text, '')) <> '' AS texted FROM items),
  r AS (SELECT s.doc_id, sum((signal IS NOT NULL AND texted)::INTEGER + (signal IS NOT NULL AND entries > 0)::INTEGER)::BIGINT AS removed, coalesce(sum(CASE WHEN texted THEN t ELSE 0 END + l) FILTER (signal IS NOT NULL), 0)::BIGINT AS removed_chars, coalesce(sum(entries) FILTER (signal IS NOT NULL), 0)::BIGINT AS list_entries,
    sum(t + l)::BIGINT AS chars, list_sort(list(DISTINCT type || '/' || coalesce(nullif(sub_type, ''), '-')) FILTER (signal IS NOT NULL AND (texted OR entries > 0))) AS kinds FROM s LEFT JOIN refs ON s.doc_id = refs.doc_id AND s.item_idx = refs.item_idx GROUP BY s.doc_id)
  SELECT doc_id, removed, removed_chars, list_entries, array_to_string(coalesce(kinds, []), '|') AS kinds, round(CASE WHEN chars > 0 THEN removed_chars / chars ELSE 0 END, 9) AS ratio FROM r""")
def removed_text(items):
    got = checks.muted_audit(rules.mute(items, layout.reference_plan(items)))
    return got.select("doc_id", *(F.col(c).cast("long").alias(c) for c in ("removed", "removed_chars", "list_entries")), F.array_join("kinds", "|").alias("kinds"), F.round("ratio", 9).alias("ratio"))


SPOKEN = "list_filter(list_transform(regexp_extract_all(regexp_replace({0}, '<[^>]*>', ' ', 'g'), '[A-Za-z]{{4,}}'), lambda w: lower(w)), lambda w: regexp_matches(w, '[aeiou]'))"


@query(rf"""WITH w AS (SELECT *, list_distinct({SPOKEN.format("truth")}) AS need, {SPOKEN.format("raw")} AS have, list_distinct({SPOKEN.format("caption")}) AS titled FROM raw_tables),
  r AS (SELECT *, len(list_intersect(need, have)) / greatest(len(need), 1) AS recall, coalesce(list_max(list_transform(near, lambda x: len(list_intersect(list_distinct({SPOKEN.format("x")}), have)) / greatest(len(list_distinct({SPOKEN.format("x")})), 1))), 0) AS other FROM w),
  f AS (SELECT *, list_filter([CASE WHEN coalesce(finish, '') NOT IN ('', 'stop') THEN 'V1' END, CASE WHEN NOT regexp_matches(raw, '(?is)</table>\s*`*\s*$') THEN 'V2' END, CASE WHEN contains(lower(raw), '<img') THEN 'V3' END,
      CASE WHEN len(need) >= 8 AND len(titled) > 0 AND len(list_filter(titled, lambda t: list_contains(have, t) OR list_contains(need, t))) < 0.5 * len(titled) THEN 'V9' END,
      CASE WHEN len(need) >= 8 AND abs(len(regexp_extract_all(raw, '(?i)<tr\b')) - expected) > 0.3 * greatest(expected, 1) THEN 'V10' END], lambda x: x IS NOT NULL) AS hard,
    list_filter([CASE WHEN len(need) < 8 THEN 'V12' END, CASE WHEN len(need) >= 8 AND recall < 0.7 THEN 'V5' END, CASE WHEN len(need) >= 8 AND recall < 0.6 THEN 'V7' END, CASE WHEN len(need) >= 8 AND len(near) > 0 AND recall - other < 0.15 THEN 'V8' END], lambda x: x IS NOT NULL) AS soft FROM r)
  SELECT id, len(hard) + len(soft) = 0 AS ok, list_contains(soft, 'V12') OR (len(soft) > 0 AND len(hard) = 0) AS unverified, array_to_string(CASE WHEN list_contains(soft, 'V12') THEN list_concat(soft, hard) ELSE list_concat(hard, soft) END, '|') AS failed FROM f""")
def judged_tables(raw_tables):
    got = raw_tables.select("id", votes.judge_table(F.col("raw"), F.col("finish"), F.col("truth"), F.col("near"), F.col("caption"), F.col("expected")).alias("j"))
    return got.select("id", "j.ok", "j.unverified", F.array_join("j.failed", "|").alias("failed"))


@query()
def control_pairs(equations):
    eqs = matching.equations(equations)
    got = votes.control_pairs(eqs, matching.equation_classes(eqs), 3)
    return got.select("a_id.doc", "a_id.item", F.col("b_id.doc").alias("other"), F.col("b_id.item").alias("other_item"), "truth")


@query("SELECT doc_id, item_idx FROM items WHERE type = 'equation' AND len(bbox) = 4")
def equation_sample(items):
    """A sample of more equations than there are: every one with a box."""
    return votes.density_sample(items, 100).select("doc_id", "item_idx")


@query("SELECT doc, page::INTEGER AS page FROM (SELECT DISTINCT doc, unnest(range(page, fin + 1)) AS page FROM (WITH " + RANGES + " SELECT * FROM ranges WHERE fin - page + 1 > 18))")
def needed_pages(toc, totals):
    return chapters.pages_needed(chapters.ranges(toc, totals), 18)


@query(f"""WITH {KEYS}, v(skeleton, verdict) AS (SELECT skeleton, 'same' FROM keys WHERE contains(skeleton, 'frac') GROUP BY skeleton HAVING count(*) > 2)
  SELECT skeleton, coalesce(verdict, 'unaudited') AS verdict FROM (SELECT skeleton FROM keys WHERE NOT regexp_full_match(skeleton, '[#N=,.;:()\\[\\]{{}}+\\-*/^_\\s]*') GROUP BY skeleton HAVING count(DISTINCT source) > 1) LEFT JOIN v USING (skeleton)""")
def audited_classes(equations):
    eqs = matching.equations(equations)
    verdicts = eqs.where(F.col("skeleton").contains("frac")).groupBy("skeleton").agg(F.count("*").alias("n")).where("n > 2").select("skeleton", F.lit("same").alias("verdict"))
    return matching.audited(matching.equation_classes(eqs), verdicts).select("skeleton", "verdict")


@query("SELECT category, trim(text) AS text, count(*) AS n, list_sort(list(DISTINCT doc_id)) AS docs FROM confirmations GROUP BY category, trim(text)", joined=("docs",))
def grouped_confirmations(confirmations):
    return rules.group_confirm(confirmations)


@query(f"WITH {PLAN} SELECT doc_id, item_idx, rule, coalesce(signal, rule) AS reason FROM whole WHERE action = 'mute'")
def muted_items(items):
    return rules.muted_items(rules.plan(items))


@query(f"WITH {PLAN} SELECT doc_id, count(*) AS muted FROM whole WHERE action = 'mute' GROUP BY doc_id")
def muted_counts(items):
    return rules.muted_count(rules.plan(items))


@query(f"""WITH {PLAN}, asked AS (SELECT doc_id, count(*) AS n FROM whole WHERE action = 'held' AND (doc_id, item_idx) NOT IN (SELECT (doc_id, item_idx) FROM whole WHERE rule IN ('cover', 'margin')) AND NOT (rule = 'title' AND why IN ('散文', '關鍵字')) GROUP BY doc_id)
  SELECT i.doc_id, CASE WHEN coalesce(n, 0) > 0 AND NOT bool_or(d.doc_id IS NOT NULL) THEN 'waits for a person' ELSE '' END AS reason FROM (SELECT DISTINCT doc_id FROM items) i LEFT JOIN asked USING (doc_id) LEFT JOIN (SELECT DISTINCT doc_id FROM decisions) d ON i.doc_id = d.doc_id GROUP BY i.doc_id, n""")
def hold_reasons(items, decisions):
    asked = rules.confirm_items(rules.plan(items)).groupBy("doc_id").agg(F.count("*").alias("n"))
    decided = decisions.select("doc_id", F.lit(True).alias("decided")).distinct()
    docs = items.select("doc_id").distinct().join(asked, "doc_id", "left").join(decided, "doc_id", "left")
    return docs.select("doc_id", ledger.hold_reason(F.coalesce("n", F.lit(0)), F.coalesce("decided", F.lit(False))).alias("reason"))


@query(f"WITH {KEYS} SELECT doc, item, skeleton, nums FROM keys", joined=("nums",))
def equation_keys(equations):
    return matching.equations(equations).select("doc", "item", "skeleton", "nums")


@query(rf"WITH s AS (SELECT doc_id, item_idx, type, {corpus.STRIPPED.replace('text', "coalesce(text, '')")} AS s FROM items) SELECT doc_id, item_idx, length(s)::BIGINT AS chars FROM s WHERE type IN ('text', 'header') AND {corpus.MANGLED}")
def mangled_items(items):
    return items.where(T.is_mangled(F.col("text"), F.col("type"))).select("doc_id", "item_idx", F.length(T.strip_math(F.col("text"))).cast("long").alias("chars"))


@query("""WITH p AS (SELECT doc_id, unnest(range(0, max(page_idx) + 1)) AS page FROM items GROUP BY doc_id), b AS (SELECT DISTINCT doc_id, page_idx AS page FROM items WHERE type IN ('text', 'header') AND length(coalesce(nullif(text, ''), nullif(table_body, ''), code_body, '')) > 0)
  SELECT doc_id, page::INTEGER AS page FROM p WHERE (doc_id, page) NOT IN (SELECT (doc_id, page) FROM b)""")
def pages_without_text(items):
    return checks.textless_pages(items)


@query(f"WITH {STRINGS} SELECT doc_id, text, count(*) AS n FROM strings GROUP BY doc_id, text")
def item_strings(items):
    return checks.item_strings(items).groupBy("doc_id", "text").agg(F.count("*").alias("n"))


@query(r"SELECT id, list_filter([CASE WHEN len(regexp_extract_all(raw, '(?i)<table\b')) <> 1 OR len(regexp_extract_all(raw, '(?i)</table>')) <> 1 THEN 'table' END, CASE WHEN regexp_matches(raw, '(?i)Noah Carter|World Athletics|Carbon-Fiber Spikes|100m Sprint|Knowledge Graph Specialist') THEN 'leak' END], lambda x: x IS NOT NULL) AS lacks FROM raw_tables", joined=("lacks",))
def table_gates(raw_tables):
    return raw_tables.select("id", votes.table_gate(F.col("raw")).alias("lacks"))


@query("SELECT lang, side, round(avg(score), 9) AS score, count(*) AS n FROM (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, side ORDER BY score DESC) <= 2) GROUP BY lang, side")
def mean_of_best(scores):
    return retrieval.mean_top(scores, 2, ["lang", "side"]).withColumn("score", F.round("score", 9))


@query(f"WITH {KEYS} SELECT doc, item, len(regexp_extract_all(skeleton, '\\\\[A-Za-z]+'))::INTEGER AS commands, length(skeleton)::INTEGER AS chars, len(regexp_extract_all(skeleton, '#'))::INTEGER AS slots FROM keys")
def equation_specificity(equations):
    s = T.specificity(F.col("skeleton"))
    return matching.equations(equations).select("doc", "item", s.commands.cast("int").alias("commands"), s.chars.cast("int").alias("chars"), s.slots.cast("int").alias("slots"))


@query("SELECT state, count(*) AS n FROM records WHERE doc NOT IN (SELECT doc FROM live) GROUP BY state")
def ghost_states(records, live):
    return ledger.ghost_verdicts(records, ledger.ghosts(records, live))


@query(f"WITH {REFERENCES}, p AS (SELECT doc_id AS doc, array_to_string(list_filter(list_transform(list_concat([coalesce(text, '')], coalesce(list_items, [])), lambda x: trim(coalesce(x, ''))), lambda x: x <> ''), chr(10)) AS text FROM items JOIN refs USING (doc_id, item_idx)) SELECT DISTINCT doc, text FROM p WHERE text <> ''")
def muted_strings(items):
    return checks.noise_index(layout.reference_plan(items), items)


@query("SELECT type, count(*) AS n FROM nodes GROUP BY type")
def node_types(nodes):
    return retrieval.histogram(nodes, "type")


@query("SELECT doc_id, type, count(*) AS n FROM items GROUP BY doc_id, type")
def item_types(items):
    return checks.type_histogram(items)


@query("SELECT family, path, modified FROM reports WHERE (path, modified) NOT IN (SELECT (path, modified + 1) FROM reports WHERE family = 'daily' UNION ALL SELECT (path, modified) FROM reports WHERE family = 'weekly')")
def stale_digests(reports):
    """Files that a cache of digests, kept for other times or lengths, has to read again."""
    files = reports.select("family", "path", F.lit(1).alias("length"), "modified")
    cache = files.withColumn("modified", F.when(F.col("family") == "daily", F.col("modified") + 1).otherwise(F.col("modified"))).drop("family")
    return workflow.changed_files(files, cache).select("family", "path", "modified")


@query("SELECT doc, gate, state FROM records")
def ledger_cells(records):
    """Records as nested ledgers, and those as cells again."""
    gate = F.struct("state", F.lit(None).cast("double").alias("value"), F.lit(None).cast("double").alias("threshold"), "note", "at", F.lit(None).cast("struct<state: string, value: double, at: string>").alias("previous"))
    each = records.select("doc", F.map_from_arrays(F.array("gate"), F.array(gate)).alias("gates"))
    return ledger.gate_cells(each).select("doc", "gate", "state")


@query("""WITH p(a, b, r) AS (SELECT a.id, b.id, round(1 - abs(a.score - b.score), 9) FROM scores a JOIN scores b ON (a.id, a.side) < (b.id, b.side)), q AS (SELECT a, b, r, CASE WHEN r >= 0.95 THEN 0.95 WHEN r >= 0.9 THEN 0.9 WHEN r >= 0.85 THEN 0.85 WHEN r >= 0.8 THEN 0.8 END AS band FROM p),
  k AS (SELECT *, row_number() OVER (PARTITION BY band ORDER BY r DESC, a, b) - 1 AS k, count(*) OVER (PARTITION BY band) AS size FROM q WHERE band IS NOT NULL)
  SELECT a AS a_id, b AS b_id, r AS ratio, band::DOUBLE AS band FROM k WHERE size <= 2 OR k IN (SELECT i * k.size // 2 FROM range(2) t(i))""")
def question_samples(scores):
    a, b = (scores.select(F.col("id").alias(f"{x}_id"), F.col("side").alias(f"{x}_side"), F.col("score").alias(f"{x}_score")) for x in "ab")
    pairs = a.join(b, F.struct("a_id", "a_side") < F.struct("b_id", "b_side")).withColumn("ratio", F.round(1 - F.abs(F.col("a_score") - F.col("b_score")), 9))
    return votes.question_bands(pairs.select("a_id", "b_id", "ratio"), 2)


@query(r"SELECT id, trim(regexp_replace(regexp_replace(regexp_replace(s, '\\(?:mathrm|mathsf)', '', 'g'), '\s*([_^])\s*', '\1', 'g'), '\s{2,}', ' ', 'g')) AS plain FROM latex WHERE NOT contains(s, '{')")
def readable_texts(latex):
    return latex.where("NOT contains(s, '{')").select("id", tex.readable_latex(F.col("s")).alias("plain"))


@query(f"""WITH {SIZES}, t AS (SELECT i.doc_id, item_idx, page_idx + 1 AS page, list_value(greatest(0, bbox[1] / 1000 * w - 6), greatest(0, bbox[2] / 1000 * h - 1), least(w, bbox[3] / 1000 * w + 6), least(h, bbox[4] / 1000 * h + 1)) AS r FROM items i JOIN sizes USING (doc_id) WHERE len(bbox) = 4)
  SELECT doc_id, item_idx, page, array_to_string(list_transform([r[1], r[2], r[3] - r[1], r[4] - r[2]], lambda x: trunc(x * 300 / 72)::INTEGER), '|') AS pixels, r[3] > r[1] AND r[4] > r[2] AS valid FROM t""")
def crop_rectangles(items, layout_pages):
    boxed = items.where("size(bbox) = 4").join(layout.reference_page_size(layout_pages), "doc_id")
    got = layout.crop_rectangles(boxed.withColumn("bbox_pt", T.bbox_points(F.col("bbox"), F.col("width"), F.col("height"))), 6.0, 1.0)
    return got.select("doc_id", "item_idx", "page", F.array_join("pixels", "|").alias("pixels"), "valid")


@query("""WITH c AS (SELECT doc, CASE WHEN pos = 4 THEN 'p3.pdf' ELSE 'p' || pos || '.pdf' END AS name, page AS a, page + 30 AS b FROM toc WHERE doc = 'bk'), j AS (SELECT c.*, total_pages, count(*) OVER (PARTITION BY name) AS same FROM c LEFT JOIN totals USING (doc)),
  w AS (SELECT doc, name, CASE WHEN NOT (a >= 1 AND b <= total_pages) THEN 'range' WHEN name = 'p0.pdf' THEN 'exists' WHEN same > 1 THEN 'twice' END AS why FROM j) SELECT * FROM w WHERE why IS NOT NULL""")
def refused_cuts(toc, totals):
    name = F.concat(F.lit("p"), F.when(F.col("pos") == 4, 3).otherwise(F.col("pos")), F.lit(".pdf"))
    cuts = toc.where("doc = 'bk'").select("doc", name.alias("name"), F.col("page").alias("start"), (F.col("page") + 30).alias("end"))
    return chapters.bad_cuts(cuts, totals, cuts.where("name = 'p0.pdf'"))


@query(rf"""WITH a AS (SELECT DISTINCT family AS eye, id::VARCHAR AS sha FROM voters, raws), h AS (SELECT 'f1' AS eye, id::VARCHAR AS sha, raw, finish FROM raws)
  SELECT a.eye, a.sha, raw IS NULL AS ask, CASE WHEN coalesce(finish, '') IN ('', 'stop') AND regexp_matches(raw, '(?is)</table>\s*`*\s*$') THEN regexp_extract(raw, '(?is)(<table\b.*?</table>)', 1) END AS html FROM a LEFT JOIN h ON a.eye = h.eye AND a.sha = h.sha""")
def transcriptions(voters, raws):
    """Two models and three pictures, of which one model has looked at all."""
    crops = raws.select(F.col("id").cast("string").alias("sha"))
    cache = raws.select(F.lit("f1").alias("eye"), F.col("id").cast("string").alias("sha"), "raw", "finish")
    return votes.seen_by(voters.select(F.col("family").alias("eye")), crops, cache).select("eye", "sha", "ask", "html")


@query("SELECT lang AS query, (row_number() OVER w)::INTEGER AS rank, id || side AS doc, score FROM scores WINDOW w AS (PARTITION BY lang ORDER BY score DESC, id || side) QUALIFY row_number() OVER w <= 3")
def reranked(scores):
    return retrieval.rerank(scores.select(F.col("lang").alias("query"), F.concat("id", "side").alias("doc"), "score"), 3)
