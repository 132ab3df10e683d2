"""Patterns, word lists and thresholds that results depend on.

Fixed values: they must equal those of the documents' processing this engine reproduces. Patterns are in Java's dialect;
(?U) makes \\w, \\b and \\s cover Unicode.
"""

# Item types and groups of them.
KNOWN_TYPES = ["text", "header", "footer", "table", "equation", "image", "page_number", "page_footnote", "code", "list", "aside_text", "chart"]
#: White space of any kind, as (?U)\s has it.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
PROSE_TYPES = ["text", "header"]
BODY_TYPES = ["text", "header", "footer", "aside_text"]
NOISE_TYPES = ["header", "footer", "aside_text"]
TITLE_TYPES = ["text", "page_footnote"]
BODY_FIELDS = ["text", "content", "body", "code_body"]
REPAIR_FIELDS = ["text", "content", "body", "code_body", "table_body"]
SKIPPED_FIELDS = ["img_path", "type", "sub_type", "text_format", "_pp_original_type", "_pp_repaired_at", "_pp_had_table_body", "_pp_table_additive"]

# Running heads.
RUNNING_HEAD_REPEATS = 3
RUNNING_HEAD_PAGES = 0.5
BODY_EDGE_PERCENT = 10
BODY_LEAST_PARAGRAPHS = 5
PUBLISHER = r"(?iU)(journal\s+homepage|https?://|doi\.org|\bdoi:\s*10\.|©|\(c\)\s*\d{4}|all\s+rights\s+reserved|\bISSN\b|this\s+article\s+is\s+copyrighted|check\s+for\s+updates)"
PUBLISHER_CHARS = 240

# Shares of muted characters above which a plan is suspicious.
SUSPICIOUS = {"noise": 0.10, "reference": 0.30, "title": 0.08, "cover": 0.15, "margin": 0.05}

# Reference and acknowledgement sections.
REFERENCE_HEADING = r"(?iU)^\s*#*\s*(references?|bibliography|works\s+cited|literature\s+cited)\s*$"
ACKNOWLEDGEMENT_HEADING = r"(?iU)^\s*#*\s*(acknowledge?ments?|funding|author\s+contributions?|conflicts?\s+of\s+interest|declaration\s+of\s+competing\s+interest)\s*$"
BODY_RESUMES = r"(?iU)^\s*#*\s*(appendix|supplementary\s+(information|material))\b"

# Title blocks.
TITLE_SPAN = 25
TITLE_LOOKAHEAD = 5
ANCHORS = ["publication", "correspondence"]
AFFILIATION = (
    r"(?iU)(?<![A-Za-z])(department|dept\.|institute|institut|university|universit[ée]|college|school\s+of|faculty|laborator(y|ies)|laboratoire|academy|academia|research\s+cent(er|re)|"
    r"cent(er|re)\s+for|ministry|division|hospital|cnrs|affiliations?|co\.,?\s*ltd|company|inc\.|gmbh|corporation|\bltd\b)\b"
)
CORRESPONDENCE = r"(?iU)([\w.+-]+\s*@\s*[\w.-]+\.\w+|corresponding\s+author|author\s+to\s+whom\s+correspondence|\be-?mail\s*:|\btel\.?\s*:)"
PUBLICATION = (
    r"(?iU)^\s*[\\*°••\-]*\s*(citation\b|cite\s+as\b|published\s+(by|in)\b|publication\s+date\b|view\s+(online|table\s+of\s+contents)\b|link\s+(to|back)\b|"
    r"downloaded\s+from\b|document\s+version\b|copyright\b|©|doi\s*:|https?://(dx\.)?doi\.org|submitted\s*:|received\s*:|accepted\s*:)"
)
SUBMISSION = r"(?iU)^\s*\(?\s*(received|revised|accepted|submitted|manuscript\s+received)\b"
CLASSIFICATION = r"(?iU)^\s*(PACS|MSC|CCS|AMS)\b"
KEYWORDS = r"(?iU)^\s*(index\s+terms|key\s?words?)\b"
AUTHOR_SEPARATOR = r"(?iU)([,;]|\band\b)"
ALPHA_TOKEN = r"[A-Za-zÀ-ɏ]{2,}"
UPPER_TOKEN = r"(?<![A-Za-zÀ-ɏ])[\p{Lu}&&[A-Za-zÀ-ɏ]][A-Za-zÀ-ɏ]+"
PROSE_WORDS, PROSE_CAPS = 12, 0.5
AUTHOR_CAPS, AUTHOR_CHARS = 0.7, 220
STANDALONE_NAME = r"(?U)^[A-Z][A-Za-z'\-]*\.?(\s+[A-Z][A-Za-z'\-]*\.?){1,3}$"
INITIAL = r"(?U)\b[A-Z]\."
NAME_CHARS = 34
WHY_KEYWORD, WHY_PROSE, WHY_NONE = "關鍵字", "散文", "沒有訊號"

# Wrapper pages.
#: Of each phrase below a word, in lower case.
AD_WORDS = (
    "interested also learn whitepaper shore zurich advance potential money belongs challenge lock-in cite link submit related citing views crossmark issn homepage"
    " conditions citation additional commons scholarworks brought proof pii appear enhancements"
).split()
AD_MARKERS = (
    r"(?iU)articles?\s+you\s+may\s+be\s+interested\s+in|you\s+may\s+also\s+like|learn\s+more|get\s+the\s+whitepaper|lake\s?shore|zurich\s+instruments"
    r"|advance\s+your\s+science|potential\s+to\s+shape\s+the\s+future|save\s+your\s+money\s+for\s+your\s+research|belongs\s+in|challenge\s+us|lock-in\s+amplifiers|whitepaper"
    r"|to\s+cite\s+this\s+article|to\s+link\s+to\s+this\s+article|submit\s+your\s+article\s+to\s+this\s+journal|view\s+related\s+articles"
    r"|citing\s+articles?\s*:|article\s+views\s*:|view\s+crossmark\s+data|issn\s*:\s*\(print\)|journal\s+homepage\s*:\s*www"
    r"|full\s+terms\s+&?\s*conditions\s+of\s+access|recommended\s+citation|follow\s+this\s+and\s+additional\s+works|digital\s+commons|scholarworks"
    r"|part\s+of\s+the\s+.{0,45}\bcommons\b|brought\s+to\s+you\s+for\s+free\s+and\s+open\s+access|journal\s+pre-?proof|\bPII\s*:\s*S\d"
    r"|to\s+appear\s+in\s*:|please\s+cite\s+this\s+article|undergone\s+enhancements\s+after\s+acceptance"
)
MARKERS_WAIVING_LENGTH = 2
BODY_PARAGRAPH_CHARS = 300

# Damage and leaks.
# Possessive: the matcher goes over a run step by step, where it would call itself for each word; a word can end in one place only.
MANGLED = r"(?U)(?:\s+[a-z]{1,2}\b){5,}+"
SINGLE_LETTER = r"(?U)\b[b-hj-z]\b"
# The same where only ASCII makes words and white space, as SQL has it.
MANGLED_ASCII = r"(?:[\t\n\f\r ]+[a-z]{1,2}(?![A-Za-z0-9_])){5,}+"
SINGLE_LETTER_ASCII = r"(?<![A-Za-z0-9_])[b-hj-z](?![A-Za-z0-9_])"
BLANK_ASCII = r"\A[\t\n\f\r ]*+\z"
LEAST_SINGLES = 3
MATH = r"(?s)\$[^$]*\$|\\\(.*?\\\)|\\\[.*?\\\]"
TAG = r"<[^>]+>"
LEAK = r"(?iu)Noah Carter|World Athletics|Carbon-Fiber Spikes|100m Sprint|Knowledge Graph Specialist"
IMAGE_TEXT_CHARS = 200
MARKUP = r"<[^>]+>|\$[^$]*\$|\\[a-zA-Z]+"
SYMBOLIC_SHARE = 0.35

# Coverage and parsing.
COVERAGE_RED = 0.05
WITNESS_SHORT = 1.15
GROUNDING_RED = 0.10

# Labels of positions that must not be entities.
CERTAIN_PREFIXES = ["equation", "eqn", "eq", "formula", "figure", "fig", "table", "tab", "section", "sec", "appendix", "chapter", "reference", "ref"]
SUSPECT_PREFIXES = ["region", "zone", "mode", "model", "part", "case", "sample", "step", "type", "stage", "item", "note", "example", "phase", "panel", "scheme", "configuration", "config"]
LABEL_TAIL = r"[\s._\-#]*([0-9]+(\.[0-9]+)*([a-z](-[a-z])?)?|[ivxIVX]+)[)]?\s*$"

# Title matching.
STOPWORDS = ["a", "an", "the", "of", "for", "in", "on", "and", "with", "to", "by", "at", "from", "using", "via", "its", "into", "based"]
MATCH_WORDS, MATCH_OVERLAP, MATCH_SHARED, TRUNCATED_AT = 3, 0.85, 4, 95
ITEM_KEY = r"^([23456789A-HJ-NP-Z]{8})\s+"
NOTE_TITLE = r"^(?:draft_)?[A-Za-zÀ-ɏ&\-']+\s+\d{4}\s*[-–]\s*(.+)$"

# LaTeX.
FONT_COMMANDS = (
    r"\\(?:displaystyle|textstyle|scriptstyle|mathrm|mathit|mathbf|mathsf|mathcal|mathtt|mathfrak|mathbb|mathnormal|boldsymbol|boldmath|pmb|"
    r"bf|rm|it|sf|tt|text|left|right|Bigg|bigg|Big|big|,|;|!|:|quad|qquad)(?![a-zA-Z])"
)
FORMAT_COMMANDS = (
    r"\\(?:displaystyle|textstyle|scriptstyle|mathrm|mathit|mathbf|mathsf|qquad|quad|underline|overline|nolimits|limits|left|right|Bigg|bigg|Big|big|text|rm|it|bf|underset|overset|substack)(?![a-zA-Z])"
)
EQUATION_DELIMITER = r"^\s*\$\$?|\$\$?\s*$|\\tag\{[^}]*\}"
ALIASES = {
    "\\varepsilon": "\\epsilon", "\\vartheta": "\\theta", "\\varphi": "\\phi", "\\varrho": "\\rho", "\\varsigma": "\\sigma", "\\geq": "\\ge", "\\leq": "\\le",
    "\\longrightarrow": "\\to", "\\rightarrow": "\\to", "\\Longrightarrow": "\\to", "\\dfrac": "\\frac", "\\tfrac": "\\frac", "\\xrightarrow": "\\to",
    "\\xlongrightarrow": "\\to", "\\ne": "\\neq", "\\ldots": "\\dots", "\\cdots": "\\dots", "img": "figure",
}
STRUCTURE_COMMANDS = (
    "frac sqrt sum int iint iiint oint prod lim partial nabla times cdot pm mp leq geq neq approx equiv propto in exp log ln sin cos tan sinh cosh tanh cot sec csc arctan arcsin arccos "
    "overline hat bar tilde vec dot ddot prime begin end array cases matrix pmatrix bmatrix"
).split()
CONSTANT_GREEK = ["pi", "infty"]
TEXT_MODE = ["text", "textrm", "textbf", "textit", "textsf", "texttt", "mbox", "textnormal"]
ROMAN = r"(?:\\(?:mathsf|mathrm|mathbf|mathit|text|sf)\s*\{\s*[IlL1|]\s*\}|[IlL1|])"
TIMES_SUBSCRIPT = r"(_\s*\{\s*" + ROMAN + r"(?:\s*" + ROMAN + r")*\s*)\\times(\s*\})"
HAT_SIGMA = r"\\(?:wide)?hat\s*\{\s*\\sigma\s*\}|\\(?:wide)?hat\s*\{\s*\\partial\s*\}|\\widehat\s*\{\s*c\s*\}|\\(?:wide)?hat\s*\{\s*o\s*\}"
FRACTION = r"\\[Bb]igg?/|\\frac|/"
STATISTICS = (
    r"(?iU)\\(?:wide)?hat\s*\{\s*\\(?:mu|theta|beta|alpha|gamma)\s*\}|\\sqrt\s*\{\s*n\s*\}|t\s*_\s*\{\s*n\s*-\s*1\s*\}"
    r"|standard\s+deviation|estimator|confidence\s+interval|p[\s-]value|\\bar\s*\{\s*X\s*\}"
)
TRIVIAL_SKELETON = r"^[#N=,.;:()\[\]{}+\-*/^_\s]*$"

# Letters that Unicode decomposition leaves whole, and what they fold to.
FOLD_FROM, FOLD_TO = "łŁøØðÐþÞđĐıŒœæÆß", "lLoOdDtTdDiOoaAs"
CJK = "\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uac00-\ud7af"

# Gates, states and levels.
STATES = ["pass", "fail", "unverifiable"]
SAME_VOTES, SAME_CONFIDENCE = 2, 0.7
