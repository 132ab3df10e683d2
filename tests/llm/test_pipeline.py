"""The pipeline: every stage keeps its promises on its own input; run() is the stages in order."""

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from test_pairs import same_texts, shingles
from test_texts import WORD, brute_pii, verdict
from tokenizers import Tokenizer

from quire.llm import jaccard_join, lines, packing, pii, quality
from quire.llm.common import utf8

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        before, after = {r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in out.collect()}
        assert set(after) <= set(before)
        if name == "quality rules":
            assert set(after) == {r.doc_id for r in quality.repetition(docs).where("kept").collect()}
            assert all(after[i] == before[i] for i in after)
        elif name == "line dedup":
            assert {i: r.text for i, r in after.items()} == {r.doc_id: r.text for r in lines.drop_boilerplate(docs).collect()}
        elif name == "near duplicates":
            assert set(after) == {r.doc_id for r in jaccard_join.near_texts(docs).where("kept").collect()}
        else:
            assert set(after) == set(before) and any(after[i].text != before[i].text for i in after)
        assert all(r.n_chars == len(r.text) for r in after.values() if r.text is not None) or name == "quality rules"
        docs = spark.createDataFrame(out.collect(), out.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.count()
    ran = corpus_pipeline.run(spark, SF)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(repr, ran.select(columns).collect())) == sorted(map(repr, packed.select(columns).collect()))


def test_empty_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_odd_rows_pass_through_every_stage(spark):
    """Nulls in any column, equal rows, ties, long and empty texts, columns with clashing names."""
    words = " ".join(f"word{i}" for i in range(120))
    rows = [(1, words, "en", "a", len(words)), (1, words, "en", "a", len(words)), (2, words, "en", "b", None), (3, None, None, None, None), (4, "", "en", "a", 0), (None, words + " tail", None, "a", 1), (5, words + " mail x@y.org", "en", "a", 7), (6, "long " + " ".join(f"z{i}" for i in range(200_000)), "en", "c", 1)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, kept string, __gone string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), out.schema)
    left = {r.doc_id: r for r in docs.collect()}
    assert set(left) == {1, None, 6} or set(left) == {1, None, 5, 6}
    assert docs.where("doc_id = 1").count() == 1 and left[6].n_chars == len(left[6].text)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == set(left)


def plain_pipeline(spark, docs):
    """(doc_id, text) before packing, by plain versions of the stages; the random field alone is the module's own."""
    kept = [r for r in docs if verdict(r.text or "")]
    pages, on = Counter(r.source for r in kept), Counter()
    lines_of = {r.doc_id: (r.text or "").split("\n") for r in kept}
    for r in kept:
        on.update((r.source, line) for line in {x for x in lines_of[r.doc_id] if re.search(WORD, x)})
    texts = {}
    for r in kept:
        texts[r.doc_id] = "\n".join(x for x in lines_of[r.doc_id] if not (on[r.source, x] >= 3 and on[r.source, x] > 0.1 * pages[r.source]))
    sets = {i: shingles(t) for i, t in texts.items()}
    top = {i: i for i in texts}
    while True:
        new = {i: min([top[i], *(top[j] for j in sets if j != i and same_texts(sets[i], sets[j]))]) for i in sets}
        if new == top:
            break
        top = new
    texts = {i: t for i, t in texts.items() if top[i] == i}
    model = pii.train(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    out = {}
    for i, t in texts.items():
        data, offsets = utf8(pa.array([t], pa.large_string()))
        base, added = pii.find(t, pii.nodes(data, offsets)[0], model)
        assert base == (brute_pii(t) if base else [])
        out[i] = pii.redacted(t, base + added)
    return out


def test_run_against_a_plain_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    library, want = Tokenizer.from_file(P.path("byte_bpe_50k.json")), []
    for doc, text in plain_pipeline(spark, docs).items():
        ids, start = [*library.encode(text, add_special_tokens=False).ids, 0], 0
        for n in packing.lengths(len(ids)):
            want.append((doc, start, n, zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes()), len(ids)))
            start += n
    got = [tuple(r) for r in corpus_pipeline.run(spark, SF).select("doc_id", "start", "length", "ids_crc32", "doc_tokens").collect()]
    assert sorted(got) == sorted(want)
