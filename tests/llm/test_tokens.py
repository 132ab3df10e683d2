"""BPE and packing against the public libraries, exact edits, and pieces that cover every id once."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quire.llm import bpe, packing
from quire.llm.entry import op3_bpe, op4_packing

SF = "/root/testdata/sf0.001"
MULTI = P.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.load_ranks(MULTI)
LIBRARY = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
KNOWN = bpe.Ranks(RANKS)
ODD = ["", " ", "a", " a", "a ", "a\n\nb", "a \n b", "x\x1cy z", "a\xa0b c", "\x85", "word" * 5000, "don't, won't. I'll", "é, ß. ñ", "1,2 3.", "<|endoftext|> x", "中文 字", "a  b", "tab\tx y", "U.S., x", "\u2028 a", "Ünï cödé,", "x <|endoftext|> y, <|endoftext|>"]
# Two unlike words whose polynomial hashes modulo 2**64 are equal for every base.
TWINS = ["".join("ab"[(i.bit_count() + k) % 2] for i in range(2048)) for k in (0, 1)]
ODD += [f"{TWINS[0]} {TWINS[1]}", f"x {TWINS[1]}\n{TWINS[0]}"]


def le(ids):
    return np.array(ids, "<u4").tobytes()


def test_texts_against_the_library(spark):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate([*ODD, None])], "doc_id long, text string, ids string")
    got = {r.doc_id: r for r in bpe.encode_texts(df, MULTI, P.PATTERN).collect()}
    for i, t in enumerate([*ODD, ""]):
        ids = LIBRARY.encode_ordinary(t)
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].ids) == (len(ids), hashlib.sha256(le(ids)).hexdigest(), ids)
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_query_on_a_whole_table(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op3_bpe(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = LIBRARY.encode_ordinary(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(le(ids)).hexdigest(), hashlib.sha256(docs[r.doc_id].encode()).hexdigest())


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode_texts(empty, MULTI, P.PATTERN).count() == 0
    assert packing.pack(empty, P.path("byte_bpe_50k.json"), P.PATTERN).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=" abtheingré.,'\n0ß\xa0", max_size=60))
def test_pieces_equal_the_library(text):
    from quire.llm.common import utf8

    import pyarrow as pa

    data, offsets = utf8(pa.array([text, "x", text]))
    ids, at = bpe.rank_pieces(MULTI, P.PATTERN)[0].ids(data, offsets)
    assert ids[at[0] : at[1]].tolist() == ids[at[2] : at[3]].tolist() == LIBRARY.encode_ordinary(text)


def test_the_table_starts_anew_when_full():
    from quire.llm.common import utf8

    import pyarrow as pa

    pieces = bpe.Pieces(P.PATTERN, bpe.Encoder(RANKS), limit=40)
    random.seed(5)
    for _ in range(30):
        texts = [" ".join("".join(random.choice("abcde") for _ in range(4)) for _ in range(8)) for _ in range(3)]
        data, offsets = utf8(pa.array(texts))
        ids, at = pieces.ids(data, offsets)
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [LIBRARY.encode_ordinary(t) for t in texts]


def test_appends_and_edits_are_exact():
    random.seed(7)
    few = 0
    for _ in range(150):
        data = bytes(random.choice(b"the inga\xc3\xa9") for _ in range(200))
        table = bpe.Prefixes(KNOWN)
        for i in range(0, 200, 37):
            table.append(data[i : i + 37])
        assert table.last == bpe.Prefixes(KNOWN, data).last
        assert table.tokens() == [RANKS[x] for x in KNOWN.merged(data)]
        a = random.randrange(200)
        b, new = random.randint(a, min(200, a + 5)), bytes(random.choice(b"thexz") for _ in range(random.randrange(4)))
        done = table.splice(a, b, new)
        assert table.last == bpe.Prefixes(KNOWN, data[:a] + new + data[b:]).last
        few += done < 150
    assert few > 30  # most of an edited piece is kept


def test_pairs_are_what_merging_both_gives():
    random.seed(11)
    for _ in range(3000):
        a, b = random.randrange(len(RANKS)), random.randrange(len(RANKS))
        joined = [KNOWN.bytes_of[a], KNOWN.bytes_of[b]]
        assert KNOWN.may_follow(a, b) == (KNOWN.merged(b"".join(joined)) == joined)


def test_a_pattern_that_cuts_elsewhere_is_refused():
    with pytest.raises(ValueError):
        bpe.Pieces(r"[\s\S]+", lambda x: b"")


@pytest.mark.parametrize("n", [1, 2, 3, 1023, 1024, 1025, 5000])
def test_lengths(n):
    got = packing.lengths(n)
    assert sum(got) == n and got == sorted(got, reverse=True) and all(x <= 1024 and x & (x - 1) == 0 for x in got) and len(set(got) - {1024}) == len([x for x in got if x != 1024])


def check_packing(rows, docs):
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert set(by) == set(docs) and len({r.sequence_id for r in rows}) == len(rows)
    for doc, pieces in by.items():
        ids, at = [*tokenizer.encode(docs[doc], add_special_tokens=False).ids, 0], 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.offset) == (at, len(ids), 0)
            assert r.ids_crc32 == zlib.crc32(le(ids[at : at + r.length])) and r.length <= 1024 and r.length & (r.length - 1) == 0
            assert r.sequence_id % 11 == r.bucket == r.length.bit_length() - 1
            at += r.length
        assert at == len(ids)


def test_packing_query(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    check_packing(op4_packing(spark, SF).collect(), docs)


def test_packing_odd_texts(spark):
    texts = dict(enumerate([*ODD, "long text " * 3000]))
    df = spark.createDataFrame([(i, t or None, 1) for i, t in texts.items()], "doc_id long, text string, length int")
    rows = packing.pack(df, P.path("byte_bpe_50k.json"), P.PATTERN).collect()
    check_packing(rows, texts)
    assert all(len(r.ids) == r.length for r in rows)
