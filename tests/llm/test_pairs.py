"""Near-duplicate texts and vectors, and URL reputation, against brute force."""

import math
import random
import re
from pathlib import Path

import numpy as np
import pytest
from conftest import canonical
from pyspark.sql import functions as F

from quire.llm import jaccard_join, urls, vectors
from quire.llm.common import components
from quire.llm.entry import OP9_SQL, URL_RULES, op2_jaccard, op8_vectors, op9_urls

SF = "/root/testdata/sf0.001"


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def brute(rows, similar):
    """Links and least id of components for (id, value) rows; a null id links with nothing."""
    n = len(rows)
    hit = [[i != j and rows[i][0] is not None and rows[j][0] is not None and similar(rows[i][1], rows[j][1]) for j in range(n)] for i in range(n)]
    top = [r[0] for r in rows]
    while True:
        new = [min([top[i], *(top[j] for j in range(n) if hit[i][j])]) if rows[i][0] is not None else None for i in range(n)]
        if new == top:
            return sorted(repr((rows[i][0], sum(hit[i]), top[i])) for i in range(n))
        top = new


def same_texts(a, b):
    return bool(a and b) and len(a & b) >= 0.8 * len(a | b) - 1e-9


def got_texts(df):
    return sorted(repr((r.doc_id, r.n_links, r.class_id)) for r in df.collect())


def test_texts_query(spark):
    rows = [(r.doc_id, shingles(r.text)) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got_texts(op2_jaccard(spark, SF)) == brute(rows, same_texts)


def test_texts_odd(spark, monkeypatch):
    """Chains, copies, short and empty texts, nulls, and a large group, with buckets small enough to be split and met in blocks."""
    monkeypatch.setattr(jaccard_join, "LEAF", 3)
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 8)
    random.seed(1)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = [random.choice(vocabulary) for _ in range(120)]
    rows = [(i, " ".join(base[:k] + [f"x{i}"] + base[k + 1 :])) for i, k in enumerate(random.choices(range(120), k=40))]
    rows += [(100 + i, " ".join(base)) for i in range(5)] + [(100, " ".join(base))]
    chain = [random.choice(vocabulary) for _ in range(100)]
    rows += [(200 + i, " ".join(chain[4 * i : 4 * i + 60])) for i in range(6)]
    rows += [(300, None), (301, ""), (302, "one two"), (303, "one two"), (304, "two one"), (305, " \n"), (None, " ".join(base)), (306, "one two three four five"), (307, "a " * 30_000), (308, "a b")]
    shared = " ".join(base[:30])
    rows += [(400 + i, shared + " " + " ".join(random.choice(vocabulary) for _ in range(60))) for i in range(30)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, class_id string, n int")
    got = jaccard_join.near_texts(df, secret=3)
    assert got_texts(got) == brute([(i, shingles(t)) for i, t in rows], same_texts)
    kept = jaccard_join.keep_first(df.where("doc_id IS NOT NULL"))
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got.where("kept AND doc_id IS NOT NULL").collect())
    assert jaccard_join.near_texts(df.limit(0)).count() == 0


def test_runs_reach_the_recall():
    """Simulated: of pairs at the threshold whose every bucket is split, the share that some run brings to the last level."""
    rng = np.random.default_rng(4)
    pairs, runs = 20_000, jaccard_join.runs()
    alive = rng.poisson(jaccard_join.ROOT_MEAN, (pairs, runs))
    agree = rng.binomial(jaccard_join.SLOTS, 0.8, (pairs, 1)) / jaccard_join.SLOTS  # of the orders at hand
    for _ in range(jaccard_join.LEVELS - 1):
        alive = rng.binomial(alive * jaccard_join.FOLLOWED, agree)
    assert (alive.sum(1) == 0).mean() < 0.0006


def test_threshold_pairs_in_large_buckets_are_met(spark, monkeypatch):
    """Every shared bucket counts as large, as those of frequent shingles do: pairs meet only if they do at the last level."""
    monkeypatch.setattr(jaccard_join, "LEAF", 1)
    words = lambda i: [f"{i}x{j}" for j in range(104)]
    rows = [(2 * i + k, " ".join(words(i)[: 84 + 20 * k])) for i in range(300) for k in (0, 1)]  # 80 of 100 shingles shared
    got = jaccard_join.near_texts(spark.createDataFrame(rows, "doc_id long, text string"), secret=3).collect()
    assert sum(r.n_links == 1 for r in got) == len(rows)


def test_settled_sets_lose_no_link(spark, monkeypatch):
    """Near copies of a text beside texts that are similar to some of them only: what pivots settle still meets the rest."""
    monkeypatch.setattr(jaccard_join, "LEAF", 5)
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 16)
    base = [f"b{i}" for i in range(300)]
    rows = [(i, " ".join(base[: 300 - i] + [f"n{i}"])) for i in range(80)]
    got = jaccard_join.near_texts(spark.createDataFrame(rows, "doc_id long, text string"), secret=3)
    assert got_texts(got) == brute([(i, shingles(t)) for i, t in rows], same_texts)


def test_texts_of_one_template_stay_apart(spark, monkeypatch):
    """Near-copy pairs of texts that share two fifths of their words: no proposed component joins unlike texts in number."""
    sizes = []

    def watched(edges, label, scratch=None):
        out = components(edges, label, scratch)
        if label == "jaccard":
            sizes.append(out.groupBy("component").count().agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(jaccard_join, "components", watched)
    monkeypatch.setattr(jaccard_join, "LEAF", 64)
    shared = [f"t{i}" for i in range(90)]
    rows = []
    for i in range(400):
        own = [f"{i}x{j}" for j in range(110)]
        rows += [(2 * i, " ".join(shared + own)), (2 * i + 1, " ".join(shared + own[:-3] + ["other"]))]
    got = jaccard_join.near_texts(spark.createDataFrame(rows, "doc_id long, text string"), secret=3).collect()
    assert all(r.n_links == 1 and r.class_id == r.doc_id // 2 * 2 for r in got) and sizes[0] < 20


def test_words_that_clash_in_polynomials_stay_apart(spark):
    twins = ["".join("ab"[(i.bit_count() + k) % 2] for i in range(2048)) for k in (0, 1)]
    rows = [(k, " ".join(f"w{i}" for i in range(20)) + " " + twins[k] + " " + " ".join(f"v{i}" for i in range(3))) for k in (0, 1)] + [(2 + k, x) for k, x in enumerate(twins)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got_texts(jaccard_join.near_texts(df)) == brute([(i, shingles(t)) for i, t in rows], same_texts)
    assert jaccard_join.keep_first(df).count() == 4


def test_repeated_rows_of_a_kept_document_go(spark):
    df = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (2, "a b c"), (1, "x y z"), (None, "q"), (None, "q")], "doc_id long, text string")
    assert sorted(map(str, ((r.doc_id, r.text) for r in jaccard_join.keep_first(df).collect()))) == sorted(map(str, [(1, "a b c"), (1, "x y z"), (None, "q"), (None, "q")]))


def cosine(a, b):
    dot = sum(x * y for x, y in zip(a, b, strict=True))
    return dot / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(y * y for y in b))


def same_vectors(a, b):
    fine = lambda v: v[1] is not None and v[0] is not None and all(x is not None and math.isfinite(x) for x in v[1]) and any(v[1])
    return fine(a) and fine(b) and a[0] == b[0] and len(a[1]) == len(b[1]) and cosine(a[1], b[1]) >= 0.93


def got_vectors(df):
    return sorted(repr((r.vec_id, r.n_links, r.component_id)) for r in df.collect())


def test_vectors_query(spark):
    rows = [(r.vec_id, (r.label, r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert got_vectors(op8_vectors(spark, SF)) == brute(rows, same_vectors)


def test_vectors_odd(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 7)
    monkeypatch.setattr(vectors, "CHUNK", 5)
    random.seed(2)
    gauss = lambda v, s: [x + random.gauss(0, s) for x in v]
    centre = [random.gauss(0, 1) for _ in range(16)]
    rows = [(i, gauss(centre, 0.15), i % 2) for i in range(50)] + [(100 + i, gauss([0.0] * 16, 1), 0) for i in range(40)]
    rows += [(200, centre, 0), (201, centre, 0), (201, centre, 0), (202, [2 * x for x in centre], 0), (203, centre, None), (204, None, 0), (205, [0.0] * 16, 0), (206, [float("nan")] * 16, 0), (207, [None] + centre[1:], 0), (208, [float("inf")] + centre[1:], 0), (209, [], 0), (210, centre[:8], 0), (211, centre[:8], 0), (None, centre, 0)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, component_id string")
    got = vectors.near_vectors(df)
    want = brute([(i, (label, v)) for i, v, label in rows], same_vectors)
    assert got_vectors(got) == want
    assert all(r.kept == (r.vec_id == r.component_id or r.vec_id is None) for r in got.collect())
    assert vectors.near_vectors(df.limit(0)).count() == 0


def planted(kind, n=1500, d=64, seed=5):
    """Vectors of few dimensions, in clusters or of all directions, with neighbours at just about the threshold."""
    rng = np.random.default_rng(seed)
    if kind == "clusters":
        x = rng.normal(size=(30, d))[rng.integers(0, 30, n)] + 0.6 * rng.normal(size=(n, d))
    else:
        x = rng.normal(size=(n, kind)) @ rng.normal(size=(kind, d))
    x /= np.linalg.norm(x, axis=1)[:, None]
    other = np.roll(x, 1, 0) if kind != d else rng.normal(size=(n, d))
    across = other - (other * x).sum(1)[:, None] * x
    angle = np.arccos(0.94)
    return np.concatenate([x, np.cos(angle) * x + np.sin(angle) * across / np.linalg.norm(across, axis=1)[:, None]])


@pytest.mark.parametrize("kind", [3, 4, 6, 12, 64, "clusters"])
def test_recall_and_both_ends(spark, kind):
    x = planted(kind)
    got = sorted((r.vec_id, r.n_links) for r in vectors.near_vectors(spark.createDataFrame([(i, v, 1) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>, label int")).collect())
    near = x @ x.T >= 0.93
    np.fill_diagonal(near, False)
    links = np.array([n for _, n in got])
    assert (links <= near.sum(1)).all() and links.sum() % 2 == 0 and links.sum() >= 0.99 * near.sum()


def test_huge_and_tiny_components(spark):
    rows = [(1, [1e200, 2e200, 0.0], 0), (2, [1e-200, 2e-200, 0.0], 0), (3, [1.0, 2.0, 0.1], 0), (4, [1e308, -1e308, 1e308], 0)]
    got = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert {r.vec_id: (r.n_links, r.component_id) for r in got.collect()} == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4)}


def test_cosines_of_a_full_group_go_by_few_rows(spark):
    """No product of more than a few rows with a block is made at once; counts at both ends come out whole."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1, 8)) + 0.02 * rng.normal(size=(700, 8))
    assert vectors.COMPARED * vectors.BLOCK * 8 <= 16 << 20
    got = vectors.near_vectors(spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")).collect()
    u = x / np.linalg.norm(x, axis=1)[:, None]
    want = (u @ u.T >= 0.93).sum(1) - 1
    assert sum(r.n_links for r in got) >= 0.98 * want.sum() and all(r.n_links <= want[r.vec_id] for r in got) and sum(r.component_id == 0 for r in got) > 690


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(300, 300), (None, 5)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {300: 300}


def test_urls_query(spark, duck):
    got, want = op9_urls(spark, SF), duck.sql(OP9_SQL)
    assert canonical(got.collect(), got.columns) == canonical(want.fetchall(), want.columns)


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        ("http://A.Example.COM/en/7x?q#f", "a.example.com", "/en/7x", "example.com/en/7", "allow"), ("x://www.z.com/en/", "www.z.com", "/en/", "com/en/", "block"), ("http://example.net/de/8", "example.net", "/de/8", "example.net/de/8", "block"),
        ("http://b.net/de/", "b.net", "/de/", "net/de/", "allow"), (None, "", "", None, None), ("no scheme", "", "", None, None), ("http://h?x=/en/", "h", "", None, None), ("a://b://c/d", "b:", "//c/d", None, None), ("http://notcom/en/", "notcom", "/en/", None, None),
    ],
)
def test_url_rules(spark, url, host, path, rule, verdict):
    r = urls.judge(spark.createDataFrame([(1, url, "x")], "page_id long, url string, host string"), URL_RULES).first()
    assert (r.host, r.path, r.rule) == (host, path, rule) and (verdict is None or r.verdict == verdict)


def test_reputation_shrinks(spark):
    bad = [("bad.a.com", 1)] * 60 + [("good.a.com", 0)] * 60 + [("few.b.org", 1)] + [("x.b.org", 0)] * 40 + [("new.a.com", None)]
    got = {r.host: r for r in urls.reputation(spark.createDataFrame(bad, "host string, bad int")).collect()}
    assert got["bad.a.com"].low > 0.5 > got["good.a.com"].mean and got["few.b.org"].low < 0.5 and got["new.a.com"].n == 0
    assert urls.judge(spark.createDataFrame([], "page_id long, url string"), URL_RULES).count() == 0
    labelled = spark.createDataFrame([(i, f"http://{h}/p", b) for i, (h, b) in enumerate(bad)], "page_id long, url string, outcome int")
    assert {r.host: r.verdict for r in urls.judge(labelled, [], outcome="outcome").collect()}["bad.a.com"] == "block"


def test_registered_domains_by_suffix_list(spark):
    hosts = ["a.b.co.uk:80", "co.uk", "x.example.com", "localhost", "", "h.com:8080", "deep.a.b.example.co.uk"]
    df = spark.createDataFrame([(h,) for h in hosts], "h string")
    got = lambda *s: [tuple(r) for r in df.select(*urls.site_levels(F.col("h"), s)).collect()]
    assert got("co.uk") == [("b.co.uk", "co.uk"), ("co.uk", "co.uk"), ("example.com", "com"), ("localhost", "localhost"), ("", ""), ("h.com", "com"), ("example.co.uk", "co.uk")]
    assert got()[:2] == [("co.uk", "uk"), ("co.uk", "uk")]
    bad = [(f"h{i}.a.co.uk", 1) for i in range(30)] + [(f"h{i}.b.co.uk", 0) for i in range(30)] + [("new.a.co.uk", None), ("new.b.co.uk", None)]
    means = {r.host: r.mean for r in urls.reputation(spark.createDataFrame(bad, "host string, bad int"), ["co.uk"]).collect()}
    assert means["new.a.co.uk"] > 0.8 and means["new.b.co.uk"] < 0.2


def test_urls_odd_rows(spark):
    rows = [(1, "http://a.com/" + "x" * 200_000), (1, "http://a.com/"), (1, "http://a.com/"), (None, "http://a.com/en/"), (None, None), (3, "")]
    got = urls.judge(spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, verdict string"), URL_RULES).collect()
    assert len(got) == len(rows) and sorted(len(r.path) for r in got) == [0, 0, 1, 1, 4, 200_001]
    assert {r.rule for r in got if r.page_id is None} == {"com/en/", None}


def test_nothing_is_left_in_the_shared_folder_but_the_result(spark):
    root = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    before = set(root.iterdir())
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(i, i + 60))) for i in range(20)], "doc_id long, text string")
    assert jaccard_join.near_texts(docs).count() == 20 and len(set(root.iterdir()) - before) == 1
    vecs = spark.createDataFrame([(i, [1.0, i / 10], 0) for i in range(20)], "vec_id long, embedding array<double>, label int")
    assert vectors.near_vectors(vecs).count() == 20 and len(set(root.iterdir()) - before) == 2
