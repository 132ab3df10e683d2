"""Scalar functions: what they must and must not match."""

import pytest
from pyspark.sql import functions as F

from quire.functions import latex, unicode
from quire.functions import text as T


def one(spark, column, **values):
    kinds = {str: "string", int: "int", list: "array<string>", bool: "boolean"}
    ddl = ", ".join(f"{k} {kinds.get(type(v), 'string')}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], ddl).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "text, signal",
    [
        ("Citation: A. One", "publication"), ("the citation shows", None), ("Received 3 May", "submission"), ("The microphone received the signal", None), ("PACS 43.55", "classification"), ("Check for updates", "publisher"),
        ("Email: a@b.org", "correspondence"), ("1Department of Physics", "affiliation"), ("Long Houyou, Gao Shuxiang and Cheng Ying", "author"), ("FLOYD E. TOOLE", "name_line"), ("Sound Absorption", None), ("", None),
        ("we measured at Tongji University the sound of many panels in a large room for a long time", None),
    ],
)
def test_title_signal(spark, text, signal):
    assert one(spark, T.title_signal(F.col("t")), t=text) == signal


def test_head_threshold(spark):
    assert [one(spark, T.head_threshold(F.col("n")), n=n) for n in (0, 1, 3, 4, 6, 68)] == [3, 2, 2, 2, 3, 3]


@pytest.mark.parametrize("text, bad", [("x  a e e s  t d s s end", True), ("may not be so if r is small", False), ("$ a b c d e f g h $", False)])
def test_mangled(spark, text, bad):
    assert one(spark, T.is_mangled(F.col("t"), F.lit("text")), t=text) is bad
    assert one(spark, T.is_mangled(F.col("t"), F.lit("equation")), t=text) is False


@pytest.mark.parametrize("name, bucket", [("Equation 3.3", "certain"), ("figure 5b-d", "certain"), ("Table ii", "certain"), ("Region 2", "suspect"), ("Chapter house", None), ("Mode shape", None), ("Reference pressure", None)])
def test_labels(spark, name, bucket):
    assert one(spark, T.label_bucket(F.col("n")), n=name) == bucket


def test_strings(spark):
    assert one(spark, T.template_key(F.col("t")), t=" 3.1 Waves 102\n") == "#.# Waves #"
    assert one(spark, T.desoft(F.col("t")), t="absorp­\ntion") == "absorption"
    assert one(spark, T.strip_heredocs(F.col("t")), t="cat <<'EOF'\na | b; echo $?\nEOF\nls") == "cat <<HEREDOC\nls"
    assert one(spark, T.recorded_filenames(F.col("t"), "shelf"), t="x\nShelf: a: b.pdf \nshelf:\nshelf: c.pdf") == ["a: b.pdf", "c.pdf"]
    assert one(spark, T.context_sections(F.col("t")), t="a\n# B\nc\n## D\n") == ["a\n", "# B\nc\n", "## D\n"]
    assert one(spark, T.context_sections(F.col("t")), t="plain") == ["plain"]
    assert one(spark, T.sanitize_filename(F.col("t")), t="a\tb​:  c?" + "x" * 100) == "a b_ c_" + "x" * 73


def test_equation_tokens_agree(spark):
    for s in (r"\frac { 1 } { 2 . 5 } x _ { 3 2 }", r"$$ \mathrm { k } = \varepsilon \leq 3 $$"):
        assert one(spark, T.equation_tokens(T.prepare_equation(F.col("s"))), s=s) == latex.tokens(latex.prepare(s))
        assert one(spark, T.eq_normalize(F.col("s")), s=s) == latex.eq_normalize(s)


def test_skeletons():
    assert latex.skeleton(r"\rho_0 c_0 k^{2}") == latex.skeleton(r"\rho c k^{2}") == "#^2"
    assert latex.skeleton(r"k^{3}") != latex.skeleton(r"k^{2}")
    assert latex.skeleton(r"[a+b]^{1/2}") == latex.skeleton(r"\sqrt{a+b}")
    assert latex.constants(r"0 . 8 5 + 3 2 x^{2}") == ["0.85", "32"]
    assert latex.structure_profile(r"\frac{1}{2}\frac{3}{x}") == [("#nums", 3), ("frac", 2)]


@pytest.mark.parametrize(
    "s, fixed, n",
    [
        (r"\frac{\hat{o} p}{\hat{o} n}", r"\frac{\partial p}{\partial n}", 2), (r"\frac{\hat{o}}{\hat{o} t}", r"\frac{\partial}{\partial t}", 2), (r"\frac{\bar{\rho} \bar{f}}{\bar{\rho}}", None, 0),
        (r"\frac{\tilde{\rho}_{ss}}{\tilde{\rho}_{ff}}", None, 0), (r"\hat{c}_1 = a ; \hat{c}_n", None, 0), (r"\hat{c} u / \hat{c} t", r"\partial u / \partial t", 2), (r"1 + x / \bar{x} \approx x / \bar{x}", None, 0),
    ],
)
def test_misread_partials(s, fixed, n):
    assert latex.repair_text(s) == (fixed or s, n)
    assert latex.repair_text(latex.repair_text(s)[0])[1] == 0


def test_fix_one():
    got = latex.fix_one(r"\mathrm { w i t h ~ f r o n t } \text { a b } _{I \times }")
    assert got.text == r"\mathrm { with ~ front } \text { a b } _{I x }" and got.words == ["with", "front"] and got.times == 1
    veto = latex.fix_one(r"\frac{\bar{X}}{\hat{\sigma}/\sqrt{n}} \hat{\sigma}")
    assert veto.veto and veto.partials == 0


def test_unicode():
    assert unicode.norm("Michał Raczyński, 微穿孔板") == "michal raczynski 微穿孔板"
    assert unicode.coverage_words("ﬂuctuations \\mathrm { w i t h ~ x }") == ["fluctuations", "mathrm", "with"]
    assert unicode.tier(["k_0", "k0"]) == "A" and unicode.tier(["Sound wave", "sound Wave"]) == "B" and unicode.tier(["Eta_N", "Eta_n"]) == "C" and unicode.tier(["Wave Number", "wavenumber"]) == "C"
    assert unicode.kb_words("2025 - Sound of the room part 1.pdf") == ["1", "part", "room", "sound"]
    assert unicode.lcs(list("abcde"), list("xbxdx")) == 2 and unicode.is_subsequence("abc", "aXbXc") and not unicode.is_subsequence("abc", "acb")
    assert unicode.grid("<table><tr><td>a</td><td><img></td></tr><tr><td> </td></tr><tr><td>b") == [["a", "[IMG]"], ["b"]] or unicode.grid("<table><tr><td>a</td><td><img></td></tr></table>") == [["a", "[IMG]"]]
    assert unicode.compact_drawings('x <drawing id="1" caption="FIG  2" /> y <drawing id="2"/>') == "x [圖：FIG 2] y "
    assert unicode.slug("A  b_c!.pdf") == "a-b-c"
