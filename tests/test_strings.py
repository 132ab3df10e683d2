"""Known passages, near strings and common subsequences against plain ways."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.functions import unicode
from quire.operators import needles, strings


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcé", max_size=150), st.text(alphabet="abcé", max_size=90))
def test_common_subsequence(a, b):
    assert unicode.lcs(a, b) == common(a, b)


def test_common_subsequence_of_columns(spark):
    df = spark.createDataFrame([("abcd", "xbd"), (None, "a"), ("", "a"), ("a" * 300 + "b", "b" + "a" * 300)], "a string, b string")
    assert [r[0] for r in df.select(strings.lcs(F.col("a"), F.col("b"))).collect()] == [2, None, 0, 300]


def test_near_pairs(spark):
    rng = random.Random(8)
    texts = [None, "", "a", "b", "ab", "é", "éa"]
    for _ in range(60):
        base = "".join(rng.choices("abcdeé", k=rng.randrange(25)))
        texts.append(base)
        for _ in range(3):
            s = list(base)
            for _ in range(rng.randrange(5)):
                at = rng.randrange(len(s) + 1)
                s[at : at + rng.randrange(2)] = rng.choices("abé", k=rng.randrange(2))
            texts.append("".join(s))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    least = {}
    for i, t in enumerate(texts):
        least.setdefault(t, i)
    known = sorted(t for t in least if t is not None)
    for most in (0, 1, 3):
        got = sorted((r.a, r.b, r.distance) for r in strings.near_pairs(df, most).collect())
        assert got == sorted((least[x], least[y], d) for i, x in enumerate(known) for y in known[i + 1 :] if (d := distance(x, y)) <= most)


def test_every_place_of_every_passage(spark):
    rng = random.Random(9)
    docs = [(i, "".join(rng.choices("abé ", k=rng.randrange(200)))) for i in range(80)] + [(90, None), (91, ""), (92, "aaaa")]
    known = [(f"n{i}", "".join(rng.choices("abé ", k=rng.randrange(1, 5)))) for i in range(40)] + [("none", None), ("empty", ""), ("twice", "aa"), ("again", "aa")]
    want = sorted((n, d, i) for n, w in known if w for d, t in docs if t for i in range(len(t)) if t.startswith(w, i))
    d, k = spark.createDataFrame(docs, "doc long, text string"), spark.createDataFrame(known, "needle string, text string")
    for size in (4 << 20, 20):
        assert sorted(tuple(r) for r in needles.occurrences(d, k, size).select("needle", "doc", "start").collect()) == want
    assert needles.occurrences(d, k.where("text IS NULL")).count() == 0
