"""Small inline tables for what the data tables can't show: boxes, levels, tables, LaTeX, ledgers. Given to Spark and to SQL alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import schema as S


def _item(doc, idx, kind, text=None, page=0, level=None, box=None, **more):
    return {"doc_id": doc, "item_idx": idx, "type": kind, "text": text, "page_idx": page, "text_level": level, "bbox": box, "has_table_body": "table_body" in more} | more


def _document(doc, rows):
    return [_item(doc, i, *r[:-1], **r[-1]) if isinstance(r[-1], dict) else _item(doc, i, *r) for i, r in enumerate(rows)]


_LONG = "The sound absorption of a panel depends on the depth of the cavity behind it and on the resistance of the holes, as was shown before. "


def _body(y):
    return [100.0, float(y), 900.0, y + 80.0]


ITEMS = (
    _document("paper", [
        ("header", "Journal of Sound 12", 0, None, [100.0, 20.0, 900.0, 40.0]), ("text", "Absorption of Panels", 0, 1, [100.0, 60.0, 900.0, 90.0]), ("text", "Anna B. Lee, Carl Doe, and Eva Roe", 0, None, _body(100)),
        ("text", "1Department of Physics, Some University", 0, None, _body(150)), ("text", "Received 3 May 2020", 0, None, _body(170)), ("text", "Keywords: sound, panels", 0, None, _body(180)), ("text", _LONG, 0, None, _body(190)),
        ("text", "PACS 43.55", 0, None, _body(195)), ("text", "Some odd line", 0, None, _body(196)), ("text", "Abstract", 0, 2, _body(200)), ("text", _LONG * 2, 0, None, _body(300)),
        ("page_footnote", "*Corresponding author. Email: lee@uni.example.org", 0, None, _body(900)), ("footer", "doi: 10.1000/182", 0, None, [100.0, 960.0, 900.0, 980.0]), ("aside_text", "9r 0 1 -.s] :0006", 0, None, [10.0, 300.0, 30.0, 700.0]),
        ("header", "Journal of Sound 13", 1, None, [100.0, 20.0, 900.0, 40.0]), ("text", "1 Methods", 1, 1, _body(80)), ("text", "The word is mangled  e e  s t  e b d s e here", 1, None, _body(200)), ("text", _LONG, 1, None, _body(400)),
        ("equation", "k_{r}^{2} = 3 2 \\frac { a } { b }", 1, None, _body(500)), ("table", None, 1, None, [100.0, 600.0, 500.0, 700.0], {"table_caption": ["TABLE 1. Values"]}), ("table", None, 1, None, [100.0, 600.0, 500.0, 700.0], {"table_body": "<table><tr><td></td></tr></table>"}),
        ("header", "Journal of Sound 14", 2, None, [100.0, 20.0, 900.0, 40.0]), ("aside_text", "Downloaded from a library in spring", 2, None, [10.0, 300.0, 30.0, 700.0]), ("text", "A lone header-like remark", 2, None, _body(250)), ("header", "2 Results of the tests", 2, None, _body(300)),
        ("table", None, 2, None, [100.0, 600.0, 500.0, 700.0], {"table_body": "<table><tr><td>one two</td><td>3</td></tr><tr><td><img src='images/a.jpg'></td><td>5</td></tr></table>"}), ("chart", None, 2, None, _body(700), {"img_path": "images/c1.jpg", "chart_caption": ["FIG. 1. Curve"]}), ("chart", None, 2, None, _body(750), {"img_path": "images/lost.jpg"}),
        ("text", "Acknowledgments", 2, 1, _body(800)), ("text", "We thank all.", 2, None, _body(850)), ("text", "References", 3, 1, _body(100)), ("list", None, 3, None, _body(150), {"list_items": ["[1] A. One, Title.", "[2] B. Two, Title."]}),
        ("footer", "Page 3", 3, None, [100.0, 960.0, 900.0, 980.0]), ("text", "Data", 3, 2, _body(400)), ("text", "[3] C. Three.", 3, None, _body(450)), ("text", "Appendix A. More on holes", 3, None, _body(500)), ("text", _LONG, 3, None, _body(600)),
        ("text", "[4] D. Four.", 3, None, _body(700), {"sub_type": "ref_text"}), ("text", "left note", 3, None, [5.0, 300.0, 60.0, 320.0]), ("image", None, 3, None, _body(750), {"img_path": "images/f.png", "image_caption": ["FIG. 2. Rig"]}),
    ])
    + _document("book", [
        ("header", "3 Ducts 101", 0), ("text", "3.1 Waves in ducts", 0, 2), ("text", _LONG, 0), ("header", "3 Ducts 102", 1), ("text", _LONG, 1), ("header", "3 Ducts 103", 2), ("text", _LONG, 2), ("text", "be so if r is small in it", 2), ("code", "from jax import random", 2, None, None, {"code_body": "from jax import random"}),
    ])
    + _document("wrap", [
        ("text", "View Related Articles", 0), ("text", "To cite this article: A. One (2020)", 0), ("image", None, 0, None, None, {"img_path": "images/logo.jpg"}), ("text", _LONG * 3, 0), ("text", "Real Title Here", 1, 1), ("text", _LONG, 1),
    ])
    + _document("plain", [("text", "Learn more", 0), ("text", _LONG * 3, 0), ("text", "", 1), ("page_number", "2", 1)])
)

TABLES: dict[str, tuple[str, list]] = {
    "items": (S.ITEMS, ITEMS),
    "files": ("doc_id string, img_path string", [("paper", "images/c1.jpg"), ("paper", "images/f.png")]),
    "layout_pages": (S.PAGES, [("paper", 0, 0, [600.0, 800.0]), ("paper", 1, 1, [610.0, 800.0]), ("paper", 2, 2, [600.0, 800.0]), ("paper", 3, 4, [600.0, 800.0]), ("book", 0, 0, [500.0, 700.0]), ("book", 1, 1, [510.0, 700.0]), ("wrap", 0, 0, [600.0, 800.0]), ("plain", 0, 0, [1.0, 1.0]), ("plain", 1, 1, [1.0, 1.0])]),
    "decisions": ("doc_id string, section string, item_idx int, suppress boolean", [("paper", "noise", 22, True), ("paper", "title", 8, False), ("paper", "noise", 999, True)]),
    "chunks": (S.CHUNKS, [("c1", "The sound absorption of panels was measured by Lee.", "w"), ("c2", "<table><tr><td>$G$</td><td>$G=I/U$</td></tr></table>", "w"), ("c3", "Bessel function of the first kind and the orifice partition", "w")]),
    "entities": (S.ENTITIES, [("Sound Absorption", "Concept", ["c1"], "d1"), ("Lee", "Person", ["c1", "c2"], "d1"), ("Conductance", "Concept", ["c2"], "d1"), ("Invented Thing", "Concept", ["c1"], "d1"), ("Orifice Partition Impedance", "Concept", ["c3"], "d2"), ("Partition Orifice", "Concept", ["c3"], "d2"), ("Gone", "Concept", ["c9"], "d2"), ("Empty", "Concept", [], "d2")]),
    "relations": (S.RELATIONS, [("Lee", "Sound Absorption", ["c1"], "d1"), ("Lee", "Nothing", ["c1"], "d1"), ("X Y", "Nothing", ["c1", "c3"], "d2")]),
    "nodes": ("name string, type string, properties string", [(n, t, None if t is None else '{"entity_type": "%s"}' % t) for n, t in [("Equation 22", "Concept"), ("equation 3.3", "Concept"), ("figure 5b-d", None), ("Table ii", "Artifact"), ("Region 2", "Location"), ("Model A", "Concept"), ("Sound", "Concept"), ("sound", "Concept"), ("SOUND", None), ("Lee", "Person"), ("Chapter house", "Location"), ("model 4", "Concept"), ("k_0", "Symbol"), ("k0", "Symbol")]]),
    "edges": ("src string, dst string, weight double", [("Sound", "Lee", 1.0), ("sound", "Lee", 2.0), ("Lee", "k_0", 1.0), ("k0", "k_0", 1.0), ("Region 2", "Model A", 3.0)]),
    "merges": ("name string, target string", [("sound", "Sound"), ("SOUND", "Sound"), ("k0", "k_0")]),
    "retrieved": ("query string, name string", [("q1", "Sound"), ("q1", "sound"), ("q1", "SOUND"), ("q2", "Sound"), ("q2", "k_0"), ("q2", "k0"), ("q2", "Lee"), ("q3", "Lee")]),
    "records": ("doc string, gate string, state string, note string, at string", [("d1", "parse.checks", "fail", None, "2024-01-01"), ("d1", "parse.checks", "pass", None, "2024-01-02"), ("d1", "parse.checks", "pass", None, "2024-01-03"), ("d1", "pp.tables", "unverifiable", "look", "2024-01-01"), ("d2", "parse.checks", "pass", None, "2024-01-01"), ("d2", "pp.tables", "unverifiable", " ", "2024-01-02"), ("d3", "pp.oops", "pass", None, "2024-01-01"), ("d4", "pp.tables", "maybe", None, "2024-01-01")]),
    "live": ("doc string", [("d1",), ("d2",), ("d5",)]),
    "checks": ("name string, rc int, scope int", [("compat", 0, 12), ("compat2", 0, None), ("canary", 0, 0), ("parse", 1, 5), ("coverage", 0, 7), ("tests", 3, 1), ("scan", 3, 1), ("odd", 1, 1)]),
    "compat": ("id string, level string, ok boolean, what string", [("A-10", "hard", False, "bundle a.pdf lists more"), ("A-19", "hard", False, "pipeline busy"), ("A-21", "soft", False, "b.pdf token"), ("A-13", "hard", True, "b.pdf source")]),
    "names": ("name string", [("a.pdf",), ("b.pdf",)]),
    "jobs": ("job_id string, filename string, status string, reasons array<string>, updated_at string, pos int, index_status string, verify_ok boolean", [("j1", "a.pdf", "failed", ["參考文獻消音比例異常（31.6%）"], "2024-01-01", 1, "processed", True), ("j2", "a.pdf", "planned", [], "2024-01-03", 2, None, True), ("j3", "b.pdf", "parsing", [], "2024-01-02", 3, None, False), ("j4", "c.pdf", "failed", ["參考文獻消音比例異常（49.0%）"], "2024-01-02", 4, "pending", True), ("j5", "d.pdf", "indexed", [], "2024-01-02", 5, "processed", True), ("j6", "d.pdf", "extracting", [], "2024-01-02", 6, "Processed", True), ("j7", "e.pdf", "failed", ["數字異常"], "2024-01-05", 7, None, True)]),
    "history": ("job_id string, at int, status string", [("j1", 1, "candidate"), ("j1", 2, "parsing"), ("j1", 3, "planned"), ("j1", 4, "indexed"), ("j2", 1, "candidate"), ("j2", 2, "planned"), ("j3", 1, "failed"), ("j3", 2, "planned")]),
    "rulings": ("pair string, eye string, verdict string, confidence double, error string, truth string, jaccard double", [("p1", "a", "same", 0.9, None, "same", 0.8), ("p1", "b", "same", 0.8, None, "same", 0.8), ("p1", "c", "different", 0.9, None, "same", 0.8), ("p2", "a", "same", 0.9, None, "different", 0.2), ("p2", "b", "different", 0.9, None, "different", 0.2), ("p2", "c", "different", 0.5, None, "different", 0.2), ("p3", "a", "different", 0.7, None, "different", 0.4), ("p3", "b", "different", 0.7, None, "different", 0.4), ("p3", "c", "same", 0.9, "timeout", "different", 0.4), ("p4", "a", "uncertain", 0.9, None, "same", 0.6), ("p4", "b", "same", 0.95, None, "same", 0.6)]),
    "toc": (S.TOC, [("bk", 0, 1, "Preface", 1), ("bk", 1, 1, "1 Waves", 5), ("bk", 2, 2, "1.1 Sound", 8), ("bk", 3, 2, "1.2 Noise", 20), ("bk", 4, 3, "Detail", 22), ("bk", 5, 1, "2 Rooms", 60), ("bk", 6, 1, "Appendix A: Data", 90), ("bk", 7, 1, "Index", 99), ("flat", 0, 1, "1", 1)] + [("flat", i, 1, str(i + 1), i + 1) for i in range(1, 24)]),
    "totals": ("doc string, total_pages int", [("bk", 100), ("flat", 25), ("none", 37), ("short", 7)]),
    "spans": (S.SPANS, [("bk", p, 1, 1, "body text of the page that goes on", 10.0) for p in range(20, 60)] + [("bk", 33, 0, 0, "1.3 Barriers", 10.0), ("bk", 44, 0, 0, "Large heading", 12.0), ("bk", 50, 0, 0, "ab", 14.0)]),
    "sources": ("source string, same_work_as array<string>", [("s1", ["s2"]), ("s2", []), ("s3", ["s4", "s5"]), ("s4", []), ("s5", ["s6"]), ("s6", []), ("s7", [])]),
    "registry": ("doc string, source string, pdf_sha256 string", [("d1", "s1", "h1"), ("d2", "s2", "h2"), ("d3", "s6", None), ("d4", None, "h4"), ("gone", "s7", "h")]),
    "digests": ("doc string, digest string", [("d1", "h1"), ("d2", "other"), ("d3", "h3"), ("d4", "h4")]),
    "corpus": ("doc string", [("d1",), ("d2",), ("d3",), ("d4",), ("d5",), ("d6",)]),
    "filenames": ("doc string", [("01405_5.5 The influence",), ("01105_5.1 Another",), ("01205_9.9 None",), ("Room modes_CH01",), ("Room  Modes_CH02",), ("Room modes_Conclusions_CH03",), ("C Equivalent Networks",), ("2020 - Some supplementary data",), ("2021 - Own paper",)]),
    "bib": ("key string, title string, extra string, tags array<string>, parent string", [("AAAA2222", "Acoustic coherent perfect absorbers", None, ["in-kb", "mine"], None), ("BBBB3333", "Low frequency broadband absorbers with micro slit panels", None, [], None), ("CCCC4444", "Whatever title", "note\nshelf: 2026 - Nonlinear Dynamics.pdf\nshelf: x.pdf", [], None), ("DDDD5555", "Loudspeaker room response equalization methods survey", None, ["read"], None), ("EEEE6666", "Loudspeaker room response equalization methods survey", None, [], None), ("FFFF7777", "Keyed item", None, [], None), ("GGGG8888", "child", None, ["in-kb"], "AAAA2222")]),
    "stored": ("filename string", [("2014 - Acoustic coherent perfect absorbers.pdf",), ("2023 - Ultra broadband symmetrical acoustic coherent perfect absorbers in ducts.pdf",), ("2026 - Nonlinear Dynamics.pdf",), ("2019 - Loudspeaker room response equalization methods survey.pdf",), ("FFFF7777 2020 - Anything at all.pdf",), ("M Room Acoustics.pdf",)]),
    "equations": (S.EQUATIONS, [("d1", 1, "Z = R + j ( \\omega M - \\frac { 3 2 } { \\omega C } )", "s1"), ("d2", 4, "Z = R + j ( \\omega M - \\frac { 3 2 } { \\omega C } )", "s2"), ("d3", 2, "Z = r + j ( \\omega m - \\frac { 3 3 } { \\omega c } )", "s3"), ("d1", 5, "x = y", "s1"), ("d2", 6, "x = y", "s2"), ("d2", 7, "p = \\sqrt { 2 } + \\frac { 1 } { k }", "s2"), ("d3", 8, "p = \\sqrt { 2 } - \\frac { 1 } { k }", "s3"), ("d4", 9, "\\nabla ^ 2 p + k ^ 2 p = 0", "s4")]),
    "latex": ("id int, s string", [(1, "\\mathrm { w i t h ~ f r o n t } x"), (2, "p _ { I \\times } = \\mathsf { t a n h } ( x )"), (3, "\\frac { \\hat { \\sigma } p } { \\hat { \\sigma } n }"), (4, "\\frac { \\bar { X } - \\mu } { \\hat { \\sigma } / \\sqrt { n } } + \\hat { \\sigma }"), (5, "\\frac{\\hat{o} p}{\\hat{o} n} and \\hat{c}_n"), (6, "plain text"), (7, "_ { \\mathsf { I } \\mathsf { I } \\times } y")]),
    "scores": ("id string, lang string, side string, score double", [("q1", "en", "a", 0.5), ("q1", "en", "b", 0.6), ("q2", "en", "a", 0.7), ("q2", "en", "b", 0.7), ("q3", "zh", "a", 0.9), ("q3", "zh", "b", 0.3), ("q4", "zh", "a", 0.2)]),
    "env": ("pos int, value string", [(1, "# comment"), (2, "A = 'x y'"), (3, "B=1;2"), (4, ""), (5, "B=\"3=4\""), (6, "noequals")]),
    "over": ("key string, value string", [("B", "9"), ("C", "new")]),
    "paths": ("file_path string", [("/a/b/x.pdf<SEP>/c/y.pdf",), ("x.pdf",), (None,), ("",), ("z/ w.pdf",)]),
    "mirror_a": ("name string, content string", [("1", "a"), ("2", "b"), ("3", "c")]),
    "mirror_b": ("name string, content string", [("2", "b"), ("3", "x"), ("4", "d")]),
    "candidates": ("doc_id string, pos int, path string, hash_match boolean", [("a", 0, "p0", False), ("a", 1, "p1", True), ("b", 0, "q0", False), ("b", 1, "q1", False)]),
    "commands": ("id int, command string", [(1, "make | tail -3; echo $?"), (2, "cat > f <<'EOF'\nmake | tail; echo $?\nEOF\nls"), (3, "ls -l"), (4, "cat .env"), (5, "cat .env.example"), (6, "docker compose config --hash x"), (7, "printenv; ls")]),
    "messages": ("id int, message string", [(1, "未知的項目型別：seal, stamp_2 ——停"), (2, "頁面尺寸不一致 3 頁"), (3, "頁序錯位"), (4, "消音比例 0.4"), (5, "其他"), (6, "未知的項目型別：—— 無")]),
    "titles": ("id int, title string", [(1, "Preface to the second edition"), (2, "Index"), (3, "Indexing methods"), (4, "附錄一 資料"), (5, "Appendix A: Data"), (6, "Contents"), (7, "1 Waves: a/b?"), (8, "第二章"), (9, "目錄"), (10, "​\t"), (11, "About the author")]),
    "raws": ("id int, raw string, finish string", [(1, "```html\n<table><tr><td>1</td></tr></table>\n```", "stop"), (2, "<table><tr>", "length"), (3, " none ", None)]),
    "tables_html": ("id int, a string, b string", [(1, "<table><tr><td>Z_{Mi}</td><td>1.5</td></tr><tr><td>rho</td><td>2</td></tr></table>", "<table><tr><td>Z_{\\mathrm{Mi}}</td><td>1.5</td></tr><tr><td>rho</td><td>2</td></tr></table>"), (2, "<table><tr><td>alpha</td><td>1</td></tr><tr><td>beta</td><td>2</td></tr></table>", "<table><tr><td>alpha</td><td>9</td></tr><tr><td>beta</td><td>2</td></tr></table>"), (3, "none", "<table><tr><td>x</td></tr></table>")]),
    "edits": ("where_ string, current string, new string", [("t1", "abc", "aXbc"), ("t2", "abc", "abd"), ("t3", None, "new"), ("t4", "<img src='images/a.jpg'>", "<img src='images/a.jpg'> x"), ("t5", "", "<img src='http://x/y.jpg'>")]),
    "confirmations": ("doc_id string, category string, text string", [("d1", "noise", " B"), ("d2", "noise", "B "), ("d1", "noise", "A lone"), ("d2", "title", "B")]),
    "muted": ("doc string, text string", [("d1", "ab"), ("d1", "  "), ("d2", "zz")]),
    "hits": ("chunk string, doc string, content string", [("k1", "d1", "ab cab ababx"), ("k2", "d1", "nothing"), ("k3", "d2", "pizza zzzz")]),
    "notes": ("name string, body string", [("Li 2024 - Hybrid Lattice", "text\n## Sources\n- `Multifunctional hybrid lattice absorbers`\n* A listed source that is long enough\n## Links\n- `not this one here at all`"), ("loose", "no sources")]),
    "payloads": ("doc string, failed array<string>, plan_doc string, planned boolean, pages int, items int, page_size array<double>, noise_ratio double, tables int, repair int, review int, refs_ratio double, refs_suspicious boolean, admitted boolean", [("a", [], "a", True, 10, 100, [600.0, 800.0], 0.05, 3, 0, 0, 0.1, False, False), ("b", ["未知的項目型別：seal", "頁序錯位"], "b", False, None, None, None, None, None, None, None, None, None, True), ("c", [], "x", True, 0, 100, [600.0], 1.5, 3, 2, 0, 0.316, True, True), ("d", [], None, False, None, None, None, None, None, None, None, None, None, False)]),
    "measures": ("check string, metric string, doc string, value double", [("parse", "mangled", "2020 - Paper one.pdf", 10.0), ("parse", "mangled", "2021 - Paper two.pdf", 4.0), ("coverage", "rate", "2020 - Paper one.pdf", 0.2), ("parse", "leak", "none.pdf", 1.0)]),
    "known": ("pos int, check string, metric string, doc string, value double", [(1, "parse", "mangled", "Paper one", 9.0), (2, "parse", "mangled", "Paper", 1.0), (3, "coverage", "rate", "Paper one", 0.0)]),
    "attachments": ("key string, name string, title string, tags array<string>", [("k1", "a_dual.pdf", "Full Text", []), ("k2", "a.pdf", "PDF", []), ("k2", "b.pdf", "Snapshot", []), ("k3", "a.zh-TW.mono.pdf", "deepseek-mono", []), ("k3", "b.pdf", "Original", []), ("k4", "a.pdf", "PDF_ZHT", []), ("k4", "b.pdf", "x", ["BabelDOC_translated"]), ("k5", "a.pdf", "One", []), ("k5", "b.pdf", "Two", [])]),
    "index_rows": ("key string, status string", [("k1", "completed"), ("k1", "completed"), ("k2", "completed"), ("k2", "pending"), ("k3", "failed"), ("k3", "completed")]),
    "images": ("doc string, file string, alias string", [("d1", "h1.jpg", "d1-p01-01.jpg"), ("d2", "h2.jpg", "d2-p01-01.jpg"), ("d3", "h2.jpg", "d3-p02-01.jpg")]),
    "wanted": ("name string", [("h1.jpg",), ("d2-p01-01.jpg",), ("h2.jpg",), ("none.jpg",)]),
    "label_list": ("label string", [("Sound Wave",), ("sound",), ("Noise",)]),
    "asked": ("name string", [("soundwave",), ("Sound Wave",), ("NOISE ",), ("other",)]),
    "reports": ("family string, path string, modified int, name string, at string", [("daily", "p1", 1, "daily", "2024-01-01T00:00:00Z"), ("daily", "p2", 2, "daily", "2024-01-02T00:00:00Z"), ("daily", "p3", 3, "daily", "2024-01-03T06:00:00Z"), ("weekly", "p4", 1, "weekly", "2024-01-01T12:00:00Z")]),
    "requests": ("id int, mode string, high array<string>, low array<string>, allow string", [(1, "mix", [], [], None), (2, "mix", ["a"], [], None), (3, "naive", [], [], None), (4, "hybrid", None, None, "1"), (5, "local", [], None, "0")]),
    "contexts": ("query string, context string", [("q1", "# One\na b c\n## Two\nd e\n"), ("q2", "no heading here")]),
    "ratios": ("id int, ab double, am double, bm double, ca double, cb double, cm double", [(1, 0.95, 0.2, 0.86, None, None, None), (2, 0.85, 0.5, 0.84, None, None, None), (3, 0.5, 0.95, 0.5, None, None, None), (4, 0.1, 0.2, 0.3, 0.95, 0.1, 0.1), (5, 0.1, 0.2, 0.3, 0.4, 0.1, 0.1)]),
    "answers": ("name string, verdict string", [("Sound", "same"), ("sound", "same"), ("Lee", "different"), ("Nobody", "different")]),
    "event_rows": ("reason string, processed_index int, created_at string", [("參考文獻消音比例異常（31.6%）", 10, "2024-01-01"), ("參考文獻消音比例異常（49.0%）", 25, "2024-01-03"), ("頁序錯位", 27, "2024-01-02")]),
    "pdfs": ("candidate_id string, name string, sha256 string", [("c1", "new.pdf", "h1"), ("c2", "known.pdf", "h2"), ("c3", "used.pdf", "h3"), ("c4", "../evil.pdf", "h4"), ("c5", "reset.pdf", "h5"), ("c6", ".hidden.pdf", "h6")]),
    "used": ("candidate_id string", [("c3",)]),
    "hashes": ("sha256 string", [("h2",), ("h5",)]),
    "resets": ("sha256 string", [("h5",)]),
    "voters": ("name string, family string", [("a", "f1"), ("b", "f1"), ("c", "f2")]),
    "two_texts": ("id int, a string, b string", [(1, "sound waves in rooms", "Sound waves of halls"), (2, "", ""), (3, "alpha beta gamma", "alpha beta gamma")]),
    "index_docs": ("filename string, index_status string", [("d.pdf", "Processed"), ("z.pdf", "processed"), ("a.pdf", "pending")]),
    "raw_tables": ("id int, raw string, finish string, truth string, near array<string>, caption string, expected double", [(1, "<table><tr><td>impedance orifice partition absorber resonance cavity panel velocity 1.5</td></tr></table>", "stop", "impedance orifice partition absorber resonance cavity panel velocity 1.5", ["wholly different words about other matters"], "Impedance of the orifice", 1.0), (2, "<table><tr><td>few</td></tr></table>", "stop", "few words", [], "", None), (3, "<table><tr><td><img src='x'>", "length", "impedance orifice partition absorber resonance cavity panel velocity", [], "", None)]),
    "words_text": ("id int, text string", [(1, "absorp­\ntion of the ﬂuctuations"), (2, "\\mathrm { v e c t o r ~ f r o m } it"), (3, "Michał Raczyński 微穿孔板, naïve")]),
}


def frame(spark: SparkSession, name: str) -> DataFrame:
    ddl, rows = TABLES[name]
    kind = _parse(ddl)
    return spark.createDataFrame([tuple(r.get(f.name) for f in kind.fields) if isinstance(r, dict) else r for r in rows], kind)


def _parse(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def _literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, list):
        return "[" + ", ".join(map(_literal, v)) + "]"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


_KINDS: dict[str, str] = {"string": "VARCHAR", "int": "INTEGER", "long": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


def values(name: str) -> str:
    """The table as a SELECT over VALUES, with types. Needs no session, so the types are read from the DDL's words."""
    ddl, rows = TABLES[name]
    fields = [f.strip().split(" ", 1) for f in ddl.split(", ")]
    types = {n: _KINDS[k.removeprefix("array<").removesuffix(">")] + "[]" * k.startswith("array<") for n, k in fields}
    lines = ", ".join("(" + ", ".join(_literal(r.get(n) if isinstance(r, dict) else r[i]) for i, n in enumerate(types)) + ")" for r in rows)
    q = {n: f'"{n}"' for n in types}
    return f"SELECT {', '.join(f'{q[n]}::{k} AS {q[n]}' for n, k in types.items())} FROM (VALUES {lines}) AS t({', '.join(q.values())})"
