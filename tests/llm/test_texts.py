"""Quality, PII, toxicity and line dedup against plain versions, and their odd cases."""

import collections
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import canonical
from pyspark.sql import functions as F

from quire.llm import lines, pii, quality, toxicity
from quire.llm.common import mix, span_hashes, utf8
from quire.llm.entry import OP10_SQL, op5_toxicity, op6_quality, op7_pii, op10_lines

SF = "/root/testdata/sf0.001"
TWINS = ["".join("ab"[(i.bit_count() + k) % 2] for i in range(2048)) for k in (0, 1)]  # equal under every polynomial hash modulo 2**64
WORD = r"[^\x20\x09-\x0D]+"
ODD = [None, "", "  \n ", "one", "a b c a b c", "é ü\xa0x #|# x", "same line\nsame line\n\n\nsame line", "w " * 120_000, "x" * 50_000, " ".join(f"w{i}" for i in range(60)), "\n".join(TWINS), " ".join(TWINS * 30), "\n".join([*TWINS, TWINS[0]])]


def base(t):
    words = re.findall(WORD, t)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts, cover, seen, dup = Counter(grams), set(), set(), 0
    for i, g in enumerate(grams):
        if counts[g] > 1:
            cover |= {i, i + 1, i + 2}
    for line in t.split("\n"):
        if re.search(WORD, line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover), len(words) < 50 or 100 * len(cover) > 50 * len(words)


def verdict(t):
    """The method's shares, plainly: characters of words inside windows that an earlier window equals."""
    words = re.findall(WORD, t)
    chars = sum(map(len, words))
    bad, seen, gone = base(t)[5], set(), 0
    for line in t.split("\n"):
        if re.search(WORD, line):
            gone += sum(map(len, re.findall(WORD, line))) * (line in seen)
            seen.add(line)
    bad |= gone > quality.LINE_SHARE * chars
    for n, share in quality.GRAMS.items():
        known, cover = set(), set()
        for i in range(len(words) - n + 1):
            g = tuple(words[i : i + n])
            if g in known:
                cover |= set(range(i, i + n))
            known.add(g)
        bad |= sum(len(words[i]) for i in cover) > share * chars
    return not bad


def test_quality_query(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in op6_quality(spark, SF).collect():
        t = docs[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(t)
        assert r.kept == verdict(t)


def test_quality_odd(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)] + [(None, "a", "x"), (3, "one", "x")], "doc_id long, text string, n_words string")
    got = quality.repetition(df).collect()
    assert len(got) == len(ODD) + 2
    for r in got:
        if r.doc_id is not None:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(ODD[r.doc_id] or "")
    assert quality.repetition(df.limit(0)).count() == 0
    kept = quality.keep_good(df)
    assert kept.columns == df.columns and [r.doc_id for r in kept.collect()] == [9]


def brute_pii(t):
    kinds = [(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True), (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))), (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and pii.luhn(d)), (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15)]
    return sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(kinds) for m in re.finditer(p, t) if ok(m[0]))


def test_base_patterns():
    random.seed(3)
    for _ in range(4000):
        t = "".join(random.choice(["@", "a.b", "@x.y", "1", "22", "+1", "(4", "5)", "-", " ", ".", "255", "4111111111111111", "é", "a@b.c", "\n", "300", "3.4.5.6", "%"]) for _ in range(random.randint(0, 14)))
        assert pii.base_spans(t) == brute_pii(t)
    assert pii.base_spans("1." + "9" * 5000 + ".1.1") == [] and pii.base_spans("a" * 200_000 + "@") == []


def test_pii_query(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in op7_pii(spark, SF).collect():
        want = brute_pii(docs[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for _, k, _ in want) for x in range(4)]
        assert r.base_sha256 == hashlib.sha256(pii.joined(want).encode()).hexdigest()
        assert set(pii.joined(want).split(",")) <= set(r.spans.split(","))


@pytest.fixture(scope="module")
def field(spark):
    return pii.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def spans(spark, model, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [[(x.kind, t[x.start : x.end], x.added) for x in r.found] for r, t in zip(pii.find_pii(df, model).orderBy("doc_id").collect(), texts, strict=True) if t is not None]


def test_skip_links_add_like_words(spark, field):
    got = spans(spark, field, ["Call +1 (456) 555-2186 now, or 5552186. See 4.0 (123)", "no 5552186 and 5552186", "card 4041894974608795 or 4041-8949-7460.8795", "ip 42.144.35.254 and 42-144-35-254", "no 12 numbers 3456 here", "a 42-144-35-254 b"])
    assert got[0] == [("phone", "+1 (456) 555-2186", False), ("phone", "5552186", True)]
    assert got[1] == got[4] == got[5] == []
    assert ("card", "4041-8949-7460.8795", True) in got[2] and ("ip", "42-144-35-254", True) in got[3]


def test_words_whose_pattern_failed_for_what_stands_beside_them_are_found(spark, field):
    got = spans(spark, field, ["mentle 7536784127813050 4845168114407329 oile", "é +1 (826) 555-4081 190.137.2.77 x", "7536784127813051 4845168114407320"])
    assert got[0] == [("card", "7536784127813050", True), ("card", "4845168114407329", True)]
    assert ("phone", "+1 (826) 555-4081", True) in got[1] and ("ip", "190.137.2.77", False) in got[1]
    assert got[2] == []


def enumerated(g, model):
    """Label probabilities by going through all labellings."""
    n, k = len(g.spans), len(pii.LABELS)
    unary, total = g.features @ model.unary, np.zeros((n, k))
    for y in itertools.product(range(k), repeat=n):
        if any(g.seen[i] and y[i] != g.seen[i] for i in range(n)):
            continue
        s = sum(unary[i, y[i]] for i in range(n) if not g.seen[i]) + sum(model.chain[y[i], y[j]] for i, j in g.chain)
        s += sum(model.skip[t, y[i]] for i, j, t in g.skip if y[i] == y[j])
        for i in range(n):
            total[i, y[i]] += np.exp(s)
    return total / total.sum(1, keepdims=True)


def random_graph(rng, n, chain, skip):
    no = np.zeros((0, 3), np.int64)
    return pii.Graph([(0, 0)] * n, rng.normal(size=(n, pii.N_FEATURES)), np.zeros(n, np.int64), np.array(chain, np.int64).reshape(-1, 2), np.array(skip, np.int64).reshape(-1, 3), no)


def test_beliefs_against_all_labellings():
    rng = np.random.default_rng(3)
    k = len(pii.LABELS)
    for _ in range(20):
        model = pii.Potentials(rng.normal(size=(pii.N_FEATURES, k)) * 0.4, rng.normal(size=(k, k)) * 0.5, rng.normal(1, 0.5, (3, k)))
        tree = random_graph(rng, 5, [(0, 1), (1, 2)], [(0, 3, 0), (2, 4, 2)])
        assert np.abs(pii.beliefs(tree, model) - enumerated(tree, model)).max() < 1e-3
        loop = random_graph(rng, 5, [(0, 1), (1, 2), (2, 3), (3, 4)], [(0, 3, 0), (1, 4, 2)])
        assert np.abs(pii.beliefs(loop, model) - enumerated(loop, model)).max() < 0.15


def test_the_fit_recovers_agreement_and_shape():
    """Labels drawn from a known field: fitted potentials score the true labels better than ones without skip edges."""
    text = "card 4041894974608795 and 4041-8949-7460.8795 ok"
    base = pii.base_spans(text)
    g = pii.graph(text, *pii.nodes(*utf8(pa.array([text], pa.large_string())))[0], base)
    assert g.seen.tolist() == [3, 0] and g.hubs.tolist() == [[1, 3, pii.SAME]]
    model = pii.fit([g] * 50)
    assert np.isfinite(model.unary).all() and model.skip[pii.SAME, 3] < 0  # here like words disagree
    model = pii.fit([g._replace(truth=np.array([3, 3]))] * 50 + [g._replace(truth=np.array([3, 0]), skip=g.skip[:0])] * 50)
    assert model.skip[pii.SAME, 3] > 1  # and here they agree where they are linked
    assert not pii.fit([]).skip.any()


def test_skip_edges_find_repeats_in_other_writings(spark, field):
    """Repeats planted far from what is confirmed, in writings that no base pattern knows, beside as many drawn numbers and
    names in the same writings: without skip edges hardly one is found, with them nearly all and hardly a drawn one."""
    rng = np.random.default_rng(23)
    docs = [x for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("text RLIKE '[0-9@]' AND doc_id % 3 = 0").orderBy("doc_id").collect() if (x := pii.planted(r.text, rng))[1]]
    assert len(docs) > 50

    def found(model):
        n = collections.Counter()
        for text, marks in docs:
            base, added = pii.find(text, pii.nodes(*utf8(pa.array([text], pa.large_string())))[0], model)
            for a, b, label in marks:
                if not any(x < b and a < y for x, _, y in base):
                    n[label > 0, any(x < b and a < y for x, _, y in added)] += 1
        return n[True, True] / (n[True, True] + n[True, False]), n[True, True] / max(1, n[True, True] + n[False, True])

    recall, precision = found(field)
    assert recall > 0.9 and precision > 0.95
    assert found(field._replace(skip=np.zeros_like(field.skip)))[0] < 0.3  # cards alone, by their check sums


def test_numbers_of_several_words_and_short_domains(spark, field):
    got = spans(spark, field, ["call +1 555 010 2030 or 555 010 2030 or then 555 010 2030", "call +15550102030 or 5550102030 or 555.010.2030", "ask anna.berg@example.com or anna.berg@example now", "no 555 010 2030 or 555 010 2030"])
    assert [x for x in got[0] if x[2]] == [("phone", "555 010 2030", True)] * 2
    assert [x for x in got[1] if x[2]] == [("phone", "5550102030", True), ("phone", "555.010.2030", True)]
    assert [x for x in got[2] if x[2]] == [("email", "anna.berg@example", True)] and got[3] == []


@pytest.mark.parametrize("n", [1, 2, 5, 50])
def test_all_repeats_after_one_confirmed_word_are_found(spark, field, n):
    got = spans(spark, field, ["Call +1 (456) 555-2186" + " or (456) 555-2186" * n, "card 4041894974608795" + " or 4041-8949-7460.8795" * n, "4041-8949-7460.8795 or " * n + "card 4041894974608795", "ip 42.144.35.254" + " and 42-144-35-254" * n])
    assert got[0] == [("phone", "+1 (456) 555-2186", False)] + [("phone", "(456) 555-2186", True)] * n
    for found, kind, word in ((got[1], "card", "4041-8949-7460.8795"), (got[2], "card", "4041-8949-7460.8795"), (got[3], "ip", "42-144-35-254")):
        assert len(found) == n + 1 and found.count((kind, word, True)) == n


def test_redaction(spark, field):
    df = spark.createDataFrame([(1, "é mail a.b@c.org, ip 1.2.3.4", "k"), (2, None, "k"), (3, "none", None)], "doc_id long, text string, found string")
    assert [(r.doc_id, r.text, r.found) for r in pii.redact(df, field).orderBy("doc_id").collect()] == [(1, "é mail [EMAIL], ip [IP]", "k"), (2, None, "k"), (3, "none", None)]
    assert pii.redact(df.limit(0), field).count() == 0 and pii.find_pii(df.limit(0), field).count() == 0
    empty = pii.train(df.limit(0))
    assert spans(spark, empty, ["x 1.2.3.4 1.2.3.4"]) == [[("ip", "1.2.3.4", False), ("ip", "1.2.3.4", False)]]


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = op5_toxicity(spark, sf).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    bad, good = [r.score for r in held if truth[r.doc_id]], [r.score for r in held if not truth[r.doc_id]]
    assert sum(a > b for a in bad for b in good) / (len(bad) * len(good)) > 0.93
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95


def test_toxic_sentences_are_located(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    text = "É the of and. You are an idiot and scum. The rest of it\nis fine."
    df = spark.createDataFrame([(1, text, 9), (2, None, 9), (3, "", 9), (None, "x", 9)], "doc_id long, text string, score int")
    got = {r.doc_id: r for r in toxicity.score(df, model, sentences_from=0.5).collect()}
    assert [text[s.start : s.end] for s in got[1].sentences] == [" You are an idiot and scum"] and got[1].predicted == 1
    assert got[2].score == got[3].score < 0.5 and got[None].held_out is False


def long_toxic(n):
    """Labelled texts of over 20,000 characters; the offending sentence of a toxic one stands last."""
    filler = "the plain words of this page go on. " * 600
    rows = [(i, filler + ("you are a zorgle." if i % 2 else "that is all.")) for i in range(n)]
    return rows, [(i, i % 2) for i in range(n)]


def test_toxicity_is_fitted_on_whole_texts(spark):
    rows, labels = long_toxic(60)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = toxicity.score(docs, model, sentences_from=0.5).collect()
    assert all(r.predicted == r.doc_id % 2 for r in got)
    assert all([rows[r.doc_id][1][s.start : s.end].strip() for s in r.sentences] == ["you are a zorgle"] * (r.doc_id % 2) for r in got)


def test_a_labelled_id_that_repeats_stays_within_the_sample(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(toxicity, "SAMPLE_TOXIC", 4)
    monkeypatch.setattr(toxicity, "SAMPLE_CLEAN", 6)
    monkeypatch.setattr(toxicity, "fit", lambda texts, y, rate: taken.extend(zip(texts, y, strict=True)))
    rows = [(1, f"text {i % 50}", "clash") for i in range(500)] + [(i, "clean", "clash") for i in range(2, 30)]
    labels = [(1, 1)] + [(i, 0) for i in range(2, 30)]
    toxicity.train(spark.createDataFrame(rows, "doc_id long, text string, h string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert sum(y == 1 for _, y in taken) == 4 and sum(y == 0 for _, y in taken) == 6
    assert len({t for t, y in taken if y == 1}) == 4  # repeated rows count once


def test_toxicity_sample_takes_whole_documents_until_its_bytes(spark, monkeypatch):
    rows, labels = long_toxic(60)
    taken = []
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES_TOXIC", 50_000)
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES_CLEAN", 100_000)
    monkeypatch.setattr(toxicity, "fit", lambda texts, y, rate: taken.extend(zip(texts, y, strict=True)))
    toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert [sum(y == c for _, y in taken) for c in (1, 0)] == [3, 5] and {t for t, _ in taken} == {t for _, t in rows[:2]}


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    none = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.predicted for r in toxicity.score(docs, none).collect()] == [0, 0]


def test_lines_odd(spark):
    rows = [(i, f"nav\n\nown {i}\nnav", "h") for i in range(10)] + [(10, None, "h"), (11, "", None), (12, "nav\nx", None), (13, "nav", "tiny"), (14, "twice\ntwice", "tiny")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, lines_before int")
    got = {r.doc_id: r for r in lines.drop_boilerplate(df).collect()}
    assert got[3].text == "\nown 3" and (got[3].lines_before, got[3].lines_dropped) == (4, 2)
    assert got[10].text is None and (got[10].lines_before, got[10].lines_dropped) == (0, 0)
    assert got[12].text == "nav\nx" and got[13].text == "nav" and got[14].text == "twice\ntwice" and got[11].text == ""
    assert lines.drop_boilerplate(df.limit(0)).count() == 0


def test_a_line_on_just_the_ratio_stays(spark):
    df = spark.createDataFrame([(i, "edge" if i < 3 else f"l{i}", "h") for i in range(30)], "doc_id long, text string, source string")
    assert lines.boilerplate(df).count() == 0
    assert lines.boilerplate(df.where("doc_id < 29")).count() == 1


def test_lines_query(spark, duck):
    got, want = op10_lines(spark, SF), duck.sql(OP10_SQL)
    assert canonical(got.collect(), got.columns) == canonical(want.fetchall(), want.columns)


def test_lines_are_native(spark):
    plan = op10_lines(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert F.col("x") is not None


def test_lines_with_names_like_those_on_the_way(spark):
    rows = [(i, f"nav\nown {i}", "h", "a", "b", "c") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, __gone string, __left string, `lines.dropped` string")
    got = lines.drop_boilerplate(df)
    assert got.columns == [*df.columns, "lines_before", "lines_dropped"]
    assert {(r.text, r["__gone"], r["__left"], r["lines.dropped"], r.lines_dropped) for r in got.collect()} == {(f"own {i}", "a", "b", "c", 1) for i in range(6)}


def plain_score(model, text):
    """The noisy-or of a text's sentences, word by word."""
    total = model.leak
    weights = dict(zip(model.features.tolist(), model.weights.tolist(), strict=True))
    for sentence in re.split("[.!?\n]", text):
        if not sentence:
            continue
        found = set()
        for w in re.findall(r"[^\x00-\x20!-/:-@\[-`{-~]+", sentence):
            raw = bytes(b + 32 if 65 <= b <= 90 else b for b in w.encode())
            for n in (0, *toxicity.BEGINNINGS):
                if not n or len(raw) > n:
                    part = np.frombuffer(raw if not n else raw[:n], np.uint8)
                    h = span_hashes(part, np.array([0]), np.array([len(part)]), toxicity.KEY) ^ mix(np.full(1, n, np.uint64))
                    found.add(int(h[0]))
        z = model.bias + sum(weights.get(h, 0.0) for h in found)
        total += np.log1p(np.exp(z)) if z < 30 else z
    return 1 - np.exp(-total)


def test_toxicity_scores_against_a_plain_noisy_or(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    assert len(model.features) > 5
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in toxicity.score(docs, model).collect():
        assert abs(r.score - plain_score(model, texts[r.doc_id])) < 1e-9


def test_toxicity_odd_rows(spark):
    rows, labels = long_toxic(20)
    model = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    odd = [(1, "you are a zorgle."), (1, "you are a zorgle."), (2, "fine. " * 300_000 + "you are a zorgle."), (3, "x" * 2_000_000), (4, ".!?\n" * 50)]
    got = toxicity.score(spark.createDataFrame(odd, "doc_id long, text string"), model).collect()
    assert [r.predicted for r in sorted(got, key=lambda r: r.doc_id)] == [1, 1, 1, 0, 0]
    assert toxicity.score(spark.createDataFrame([], "doc_id long, text string"), model).count() == 0


def test_pii_odd_rows(spark, field):
    rows = [(None, "ip 1.2.3.4"), (1, "ip 1.2.3.4"), (1, "ip 1.2.3.4"), (2, "7" * 500_000), (3, "a@b.org " * 20_000), (4, "1 " * 100_000), (5, "+" * 100_000), (6, None)]
    got = pii.find_pii(spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, spans string"), field).collect()
    assert sorted((r.doc_id or 0, r.n_ip, r.n_email) for r in got) == [(0, 1, 0), (1, 1, 0), (1, 1, 0), (2, 0, 0), (3, 0, 20_000), (4, 0, 0), (5, 0, 0), (6, 0, 0)]


def test_quality_of_a_text_with_a_fifth_repeated_once():
    words = [f"w{i}" for i in range(400)]
    again = " ".join(words + words[:80])  # a sixth of all characters repeats
    plain = " ".join(words)
    data, offsets = utf8(pa.array([again, plain], pa.large_string()))
    assert quality.verdict(quality.measure(data, offsets)).tolist() == [verdict(again), verdict(plain)] == [False, True]
    assert not base(again)[5]  # the base rules keep it: the method decides
