"""Text expressions: native columns only, so Catalyst compiles them into the scan's stage."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P

def filled(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def stripped(text: Column) -> Column:
    """Without white space at the ends, of any kind; null stays null."""
    return F.btrim(text, F.lit(P.WHITE))


def is_blank(text: Column, ascii_only: bool = False) -> Column:
    return filled(text).rlike(P.BLANK_ASCII) if ascii_only else stripped(filled(text)) == ""


def count_of(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def matches_of(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


# Headers and footers.


def template_key(text: Column) -> Column:
    """The text with every run of digits as one #: headers that differ in a page number share it."""
    return F.regexp_replace(stripped(text), r"\d+", "#")


def head_threshold(pages: Column) -> Column:
    """Repeats from which a text is a running head: 3, and 2 in documents of few pages."""
    most = F.lit(P.RUNNING_HEAD_REPEATS)
    return F.when(pages <= 0, most).otherwise(F.greatest(F.lit(2), F.least(most, F.ceil(pages * P.RUNNING_HEAD_PAGES)))).cast("int")


def is_publisher_boilerplate(text: Column, bare: bool = False) -> Column:
    """bare: text is stripped and not null already, here and below, so that this is not done for every question anew."""
    t = text if bare else stripped(filled(text))
    return (t != "") & (F.length(t) <= P.PUBLISHER_CHARS) & t.rlike(P.PUBLISHER)


def is_gibberish(text: Column) -> Column:
    """Not one run of three letters holds a vowel."""
    return ~F.exists(matches_of(filled(text), "[A-Za-z]{3,}"), lambda w: w.rlike("[aeiouAEIOU]"))


# Sections and title blocks.


def section_kind(text: Column) -> Column:
    return F.when(filled(text).rlike(P.REFERENCE_HEADING), "reference").when(filled(text).rlike(P.ACKNOWLEDGEMENT_HEADING), "acknowledgement")


def resumes_body(text: Column) -> Column:
    return filled(text).rlike(P.BODY_RESUMES)


def item_chars(text: Column, list_items: Column) -> Column:
    """Characters of an item, list entries included."""
    entries = F.coalesce(list_items, F.array().cast("array<string>"))
    return F.length(filled(text)) + F.aggregate(entries, F.lit(0), lambda n, x: n + F.length(filled(x)))


def display_text(text: Column, list_items: Column) -> Column:
    parts = F.concat(F.array(filled(text)), F.coalesce(list_items, F.array().cast("array<string>")))
    return F.array_join(F.filter(F.transform(parts, lambda x: stripped(filled(x))), lambda x: x != ""), "\n")


def caps_ratio(text: Column) -> Column:
    """The share of words of two letters or more that begin in upper case; 0 without such words."""
    t = filled(text)
    return F.coalesce(F.try_divide(F.regexp_count(t, F.lit(P.UPPER_TOKEN)), F.regexp_count(t, F.lit(P.ALPHA_TOKEN))), F.lit(0.0))


def looks_like_prose(text: Column, caps: Column | None = None) -> Column:
    """caps: the text's caps_ratio where it is at hand, so that it is found once."""
    # The word that decides is looked for; those behind it need no count.
    enough = filled(text).rlike(rf"(?U)\A\s*+(?:\S++\s++){{{P.PROSE_WORDS - 1}}}\S")
    return enough & ((caps_ratio(text) if caps is None else caps) < P.PROSE_CAPS)


def looks_like_author_line(text: Column, caps: Column | None = None, bare: bool = False) -> Column:
    t = text if bare else stripped(filled(text))
    return (t != "") & (F.length(t) <= P.AUTHOR_CHARS) & t.rlike(P.AUTHOR_SEPARATOR) & ((caps_ratio(t) if caps is None else caps) >= P.AUTHOR_CAPS)


def is_standalone_name(text: Column, bare: bool = False) -> Column:
    t = F.regexp_replace(text if bare else stripped(filled(text)), "[,;]+$", "")
    return (t != "") & (F.length(t) <= P.NAME_CHARS) & t.rlike(P.INITIAL) & t.rlike(P.STANDALONE_NAME)


def is_correspondence(t: Column) -> Column:
    """The pattern is dear, so it is asked only where one of the words that it needs stands."""
    low = F.lower(t)
    return (t.contains("@") | low.contains("author") | low.contains("mail") | low.contains("tel")) & t.rlike(P.CORRESPONDENCE)


def title_signal(text: Column, caps: Column | None = None, bare: bool = False) -> Column:
    """The first of the signals that mark a line of a title block, null for none. The order counts: prose is asked midway."""
    t = text if bare else stripped(filled(text))
    return (
        F.when(t == "", None)
        .when(t.rlike(P.PUBLICATION), "publication")
        .when(t.rlike(P.SUBMISSION), "submission")
        .when(t.rlike(P.CLASSIFICATION), "classification")
        .when(is_publisher_boilerplate(t, True), "publisher")
        .when(is_correspondence(t), "correspondence")
        .when(looks_like_prose(t, caps), None)
        .when(t.rlike(P.AFFILIATION), "affiliation")
        .when(looks_like_author_line(t, caps, True), "author")
        .when(is_standalone_name(t, True), "name_line")
    )


def held_reason(text: Column) -> Column:
    """Why an unsignalled line of a title block is shown to a person."""
    return F.when(stripped(filled(text)).rlike(P.KEYWORDS), P.WHY_KEYWORD).when(looks_like_prose(text), P.WHY_PROSE).otherwise(P.WHY_NONE)


def distinct_markers(text: Column) -> Column:
    """How many different wrapper-page phrases a page holds."""
    # Each phrase holds one of a few words; a page without them is not searched for phrases. ſ, ı and İ match s and i.
    # The lambda's variable is found once for all words.
    may = F.exists(F.array(F.lower(filled(text))), lambda low: reduce(or_, (low.contains(x) for x in P.AD_WORDS))) | filled(text).rlike("[ſıİ]")
    return F.when(may, F.size(F.array_distinct(F.transform(matches_of(filled(text), P.AD_MARKERS), lambda m: F.lower(stripped(m)))))).otherwise(0)


# Damage.


def strip_math(text: Column) -> Column:
    return F.regexp_replace(filled(text), P.MATH, " ")


def is_mangled(text: Column, kind: Column, ascii_only: bool = False) -> Column:
    """Prose with a run of short words of which three or more are single letters other than a and i."""
    run, single = (P.MANGLED_ASCII, P.SINGLE_LETTER_ASCII) if ascii_only else (P.MANGLED, P.SINGLE_LETTER)
    runs = matches_of(strip_math(text), run)
    return F.coalesce(kind.isin(P.PROSE_TYPES), F.lit(False)) & F.exists(runs, lambda r: F.regexp_count(r, F.lit(single)) >= P.LEAST_SINGLES)


def has_leak(text: Column) -> Column:
    return filled(text).rlike(P.LEAK)


def table_text(body: Column) -> Column:
    return stripped(F.regexp_replace(filled(body), P.TAG, ""))


def item_body(*fields: Column) -> Column:
    return F.coalesce(*(F.nullif(f, F.lit("")) for f in fields), F.lit(""))


def is_symbolic(text: Column) -> Column:
    """More than 0.35 of the text is markup, math or commands."""
    marked = F.aggregate(F.transform(matches_of(filled(text), P.MARKUP), lambda x: F.length(x)), F.lit(0), lambda a, x: a + x)
    return F.when(filled(text) == "", False).otherwise(marked / F.greatest(F.length(text), F.lit(1)) > P.SYMBOLIC_SHARE)


def desoft(text: Column) -> Column:
    """Soft hyphens and the white space behind them joined."""
    return F.regexp_replace(filled(text), "(?U)­\\s*", "")


def ascii_words(text: Column) -> Column:
    """Words of four ASCII letters or more, lower case, for text that needs no Unicode normalisation."""
    return matches_of(F.lower(desoft(text)), "[a-z]{4,}")


def bbox_points(box: Column, width: Column, height: Column) -> Column:
    """A box of 0 to 1000 per axis, in points of the page."""
    return F.array(box[0] / 1000 * width, box[1] / 1000 * height, box[2] / 1000 * width, box[3] / 1000 * height)


def table_class(has_body: Column, body: Column) -> Column:
    """missing_key, empty_shell, img_thin or ok. The key's being there counts, so it is a column of its own."""
    t = table_text(body)
    thin = filled(body).contains("<img") & (F.length(t) < P.IMAGE_TEXT_CHARS)
    return F.when(~has_body, "missing_key").when(t == "", "empty_shell").when(thin, "img_thin").otherwise("ok")


# LaTeX that needs no balanced braces.


def fix_times(text: Column) -> tuple[Column, Column]:
    """x for \\times behind roman subscripts, in \\mathsf where the subscript is; and how often."""
    wrapped = r"(_\s*\{(?=(?:(?!\\times).)*\\mathsf)\s*" + P.TIMES_SUBSCRIPT.removeprefix(r"(_\s*\{\s*")
    fixed = F.regexp_replace(F.regexp_replace(filled(text), wrapped, r"$1\\mathsf { x }$2"), P.TIMES_SUBSCRIPT, "$1x$2")
    return fixed, count_of(filled(text), P.TIMES_SUBSCRIPT)


def fix_partial(text: Column) -> tuple[Column, Column, Column]:
    """\\partial for its four misreadings where two or more stand in a fraction; how many; and whether statistics forbid it."""
    t = filled(text)
    found = count_of(t, P.HAT_SIGMA)
    anchored = (found >= 2) & t.rlike(P.FRACTION)
    veto = anchored & t.rlike(P.STATISTICS)
    done = anchored & ~veto
    return F.when(done, F.regexp_replace(t, P.HAT_SIGMA, r"\\partial")).otherwise(t), F.when(done, found).otherwise(0), veto


def prepare_equation(latex: Column) -> Column:
    """Without delimiters, fonts and spaces inside numbers, synonyms made one."""
    t = F.regexp_replace(F.regexp_replace(filled(latex), P.EQUATION_DELIMITER, " "), P.FONT_COMMANDS, "")
    for a, b in P.ALIASES.items():
        if a.startswith("\\"):
            t = F.replace(t, F.lit(a), F.lit(b))
    t = F.regexp_replace(t, r"(?<=\d)\s+(?=\d)", "")
    t = F.regexp_replace(t, r"(?<=\d)\s*\.\s*(?=\d)", ".")
    return F.regexp_replace(t, r"(?<=\d)\s+(?=\d)", "")


def equation_tokens(prepared: Column) -> Column:
    return matches_of(prepared, r"\\[A-Za-z]+|\\.|\d+(?:\.\d+)?|\S")


def eq_normalize(latex: Column) -> Column:
    """An equation as a bare sequence of symbols."""
    t = F.regexp_replace(F.regexp_replace(filled(latex), P.EQUATION_DELIMITER, " "), P.FONT_COMMANDS, "")
    for a, b in P.ALIASES.items():
        if a.startswith("\\"):
            t = F.replace(t, F.lit(a), F.lit(b))
    return F.lower(F.regexp_replace(t, r"[{}\s]", ""))


def specificity(skeleton: Column) -> Column:
    """Commands, characters and variable slots of a skeleton."""
    return F.struct(count_of(skeleton, r"\\[A-Za-z]+").alias("commands"), F.length(skeleton).alias("chars"), count_of(skeleton, "#").alias("slots"))


# Names, labels and messages.


def label_pattern(prefixes: list[str]) -> str:
    return "^(" + "|".join(prefixes) + ")" + P.LABEL_TAIL


def label_bucket(name: Column) -> Column:
    """certain or suspect for names that are positions (equation 3, zone ii), else null."""
    return F.when(name.rlike("(?iU)" + label_pattern(P.CERTAIN_PREFIXES)), "certain").when(name.rlike("(?iU)" + label_pattern(P.SUSPECT_PREFIXES)), "suspect")


def squash(text: Column) -> Column:
    return F.lower(F.regexp_replace(filled(text), r"(?U)\s+", ""))


def separators(name: Column) -> Column:
    return count_of(name, r"[\s_\-.,()]+")


def sanitize_filename(name: Column, most: int = 80) -> Column:
    """A safe file name part: printable characters, _ for those that Windows forbids, single spaces, at most `most`."""
    t = F.regexp_replace(F.regexp_replace(name, r"[^\p{L}\p{N}\p{P}\p{S}\p{Zs}\t]", ""), r'[\\/*?:"<>|]', "_")
    t = F.trim(F.regexp_replace(t, r"(?U)\s+", " "))
    cut = F.substring(t, 1, most) if most > 0 else t
    return F.when(t == "", "untitled").otherwise(cut)


def prefix_number(value: Column, width: int = 5) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def event_kind(reason: Column) -> Column:
    """A reason without the measured value in brackets at its end."""
    return stripped(F.regexp_replace(stripped(filled(reason)), r"[（(][^（()）]*[0-9][^（()）]*[)）]\s*$", ""))


def failure_reason(message: Column) -> Column:
    tail = F.regexp_extract(message, r"未知的項目型別((?:(?!——)[\s\S])*)", 1)
    kinds = matches_of(tail, "[A-Za-z_][A-Za-z0-9_-]*")
    return (
        F.when(message.contains("未知的項目型別"), F.concat(F.lit("未知型別 "), F.when(F.size(kinds) > 0, F.array_join(kinds, ", ")).otherwise("未列出")))
        .when(message.contains("頁面尺寸不一致"), "頁面尺寸不一致")
        .when(message.contains("頁序錯位"), "頁序錯位")
        .when(message.contains("比例") | message.contains("數字"), "數字異常")
        .otherwise("preflight 擋下")
    )


def recorded_filenames(extra: Column, tag: str) -> Column:
    """The values of a field's `tag:` lines, in order; tag is what a library writes before the name of a stored file."""
    lines = F.transform(F.split(filled(extra), r"\r\n|\r|\n"), stripped)
    named = F.filter(lines, lambda x: F.lower(x).startswith(tag + ":"))
    return F.filter(F.transform(named, lambda x: stripped(F.regexp_replace(x, r"^[^:]*:", ""))), lambda x: x != "")


def note_candidates(name: Column, body: Column) -> Column:
    """What in a note may be a paper's title: its own, and the quoted or listed strings of its sources."""
    own = F.regexp_extract(name, P.NOTE_TITLE, 1)
    head = F.split_part(filled(body), F.lit("## Links"), F.lit(1))
    sources = F.when(head.contains("## Sources"), F.regexp_replace(head, r"(?s)^.*?## Sources", "")).otherwise("")
    return F.concat(F.array(F.when(own != "", own).otherwise(name)), matches_of(sources, "`([^`]{20,})`", 1), matches_of(sources, r"[-*]\s+(.{20,})", 1))


def context_sections(context: Column) -> Column:
    """A context cut before its headings; the whole if there is none."""
    parts = F.filter(F.split(filled(context), r"(?m)(?=^#{1,6}\s)"), lambda x: x != "")
    return F.when(F.size(parts) > 0, parts).otherwise(F.array(filled(context)))


def strip_heredocs(command: Column) -> Column:
    return F.regexp_replace(filled(command), r"(?sm)<<-?\s*(['\"]?)([A-Za-z_][A-Za-z0-9_]*)\1.*?^\2\s*$", "<<HEREDOC")


#: Commands that print or load secrets, or take the exit code behind a pipe.
COMMAND_RULES = {
    "compose-config-resolves-env": r"docker\s+compose\b[^|;&]*\bconfig\b(?![^|;&]*--hash)",
    "whole-env-dump": r"(^|[|;&]\s*)(env|printenv)\s*($|[|;&])",
    "cat-dotenv": r"\b(cat|less|more|head|tail|bat)\b[^|;&]*(^|[\s=/])\.env(?![.\w])",
    "source-dotenv": r"(^|[|;&]\s*)(source|\.)\s+[^\s|;&]*\.env\b",
    "redact-after-the-fact": r"\.Config\.(Cmd|Env)[^|;&]*\|\s*(sed|awk|grep|python)",
    "exit-code-after-pipe": r"\|[^;&\n]*[;&]\s*[^;&\n]*\$\?",
}


def command_rules(command: Column, rules: dict[str, str] = COMMAND_RULES) -> Column:
    """Names of the rules that a command breaks, heredocs aside."""
    bare = strip_heredocs(command)
    return F.filter(F.array(*(F.when(bare.rlike(p), F.lit(n)) for n, p in rules.items())), lambda x: x.isNotNull())


def extract_html(raw: Column) -> Column:
    table = F.regexp_extract(filled(raw), r"(?is)(<table\b.*?</table>)", 1)
    return F.when(table != "", table).otherwise(stripped(filled(raw)))


def truncation_failures(raw: Column, finish: Column, closing: str | None = "</table>") -> Column:
    """V1: the model was stopped; V2: the output lacks its closing tag."""
    end = F.regexp_replace(F.regexp_replace(filled(raw), r"(?U)\s+$", ""), r"`+$", "")
    found = [F.when((filled(finish) != "") & (finish != "stop"), F.concat(F.lit("V1 finish_reason="), finish))]
    if closing:
        found.append(F.when(~F.lower(F.regexp_replace(end, r"(?U)\s+$", "")).endswith(closing.lower()), f"V2 輸出未以 {closing} 結尾"))
    return F.filter(F.array(*found), lambda x: x.isNotNull())


#: Titles of front and back matter. Chinese ones count anywhere in a title; English ones as its first
#: words or as the whole of it.
PREAMBLE_ANYWHERE = ["目錄", "序言", "前言", "導讀", "導論", "緒論", "引言", "推薦序", "自序", "譯者序", "作者序", "致謝", "謝辭", "版權", "出版"]
PREAMBLE_FIRST = ["preface", "foreword", "dedication", "acknowledgment", "acknowledgement", "acknowledgments", "acknowledgements", "copyright", "frontispiece", "about the author", "about the authors", "title page", "half title"]
PREAMBLE_WHOLE = ["contents", "table of contents", "abstract", "list of figures", "list of tables", "list of illustrations", "cover", "front cover", "back cover"]
APPENDIX_ANYWHERE = ["附錄", "附記", "後記", "索引", "參考", "注釋", "結語"]
APPENDIX_FIRST = ["appendix", "appendices", "bibliography", "glossary", "colophon", "afterword", "epilogue", "references"]
APPENDIX_WHOLE = ["index", "subject index", "author index", "name index", "general index", "notes", "notation", "nomenclature", "symbols", "list of symbols"]


def _matter(title: Column, anywhere: list[str], first: list[str], whole: list[str]) -> Column:
    words = F.array_join(F.transform(matches_of(filled(title), "[A-Za-z][A-Za-z']*"), lambda w: F.lower(w)), " ")
    return filled(title).rlike("|".join(anywhere)) | words.rlike("^(" + "|".join(first) + ")( |$)") | words.isin(whole)


def is_preamble_title(title: Column) -> Column:
    return _matter(title, PREAMBLE_ANYWHERE, PREAMBLE_FIRST, PREAMBLE_WHOLE)


def is_appendix_title(title: Column) -> Column:
    return _matter(title, APPENDIX_ANYWHERE, APPENDIX_FIRST, APPENDIX_WHOLE)
