"""The source audit against a plain count, and odd rows."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF, canonical

from quire.llm import divergence
from quire.llm.common import utf8
from quire.llm.entry import OP11_SQL, op11_divergence


def plain(rows, least=30, most=50):
    """rows: (lang, source, text)"""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source, text = lang or "", source or "", text or ""
        words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
        counts[lang, source].update(words)
        docs[lang].update(set(words))
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= least)

        def shares(of):
            n = {t: sum(counts[lang, s][t] for s in of) for t in kept}
            total = sum(n.values()) + 5 * len(kept)
            return n, {t: 1 + 10**9 * (n[t] + 5) // total for t in kept}

        _, q = shares(sources)
        p = {s: shares([s]) for s in sources}
        for s in sources:
            pairs = [(sum(abs(p[s][1][t] - p[o][1][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][1][t] - q[t], t) for t in kept if p[s][0][t] and p[s][1][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(found, 1) if part == "pair" or i <= most]
    return sorted(out)


def rows_of(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r.rank) for r in df.collect())


def test_query_on_a_whole_table(spark, duck):
    got, want = op11_divergence(spark, SF), duck.sql(OP11_SQL)
    assert canonical(got.collect(), got.columns) == canonical(want.fetchall(), want.columns)
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert rows_of(got) == plain([(r.lang, r.source, r.text) for r in docs]) and {r.part for r in got.collect()} == {"pair", "term"}


ODD = [
    ("en", "a", "The the THE, étÉ x2y\nz"), ("en", "b", None), ("en", "c", "the \x00 été été"), ("en", "a", "The the THE, étÉ x2y\nz"), ("en", None, "the"), ("en", "", "x y"),
    (None, None, "alone 漢字 漢字"), ("", "s", "漢字 alone"), ("de", "a", ""), ("de", "b", "12 34 _[]{}"), ("fr", "only", "un un deux"), ("en", "B", "y z the"),
]


def test_odd_rows(spark):
    df = spark.createDataFrame([(*r, 1, "clash") for r in ODD * 2], "lang string, source string, text string, rank int, term string")
    for least, most in ((1, 50), (3, 2), (2, 3), (100, 50)):
        assert rows_of(divergence.audit(df, least_docs=least, terms=most)) == plain(ODD * 2, least, most)
    assert divergence.audit(df.limit(0)).count() == 0


def test_many_sources_and_small_bounds(spark, monkeypatch):
    """Counts drained again and again, pair sums in many statements, texts cut in pieces."""
    rng = np.random.default_rng(3)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    rows = [("en" if i % 3 else "de", f"s{rng.zipf(1.5) % 40}", " ".join(rng.choice(words, rng.integers(0, 60), p=None))) for i in range(300)]
    rows.append(("en", "long", "Long wört, " * 5000))
    want = plain(rows, 4)
    for name, value in (("HELD_COUNTS", 500), ("PAIR_SUMS", 50), ("PIECE_BYTES", 999)):
        monkeypatch.setattr(divergence, name, value)
    assert rows_of(divergence.audit(spark.createDataFrame(rows, "lang string, source string, text string"), least_docs=4)) == want


@pytest.mark.parametrize("size", [1, 3, 10])
def test_pieces_cut_between_terms(size):
    texts = ["", "ab cd", "abcdefghijklm", "a b c d é é", "      ", "xyz" * 9 + " a"]
    data, offsets = utf8(pa.array(texts, pa.large_string()))
    borders, row = divergence.pieces(data, offsets, size)
    found = defaultdict(list)
    for a, b, r in zip(borders[:-1], borders[1:], row, strict=True):
        found[int(r)].append(data[a:b].tobytes().decode())
    for i, t in enumerate(texts):
        assert "".join(found[i]) == t
        assert [w for part in found[i] for w in re.findall(r"[^\W\d_]+", part)] == re.findall(r"[^\W\d_]+", t)
