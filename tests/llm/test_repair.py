"""Re-Pair shards: exact expansion, a plain reading of the grammar, random access, whole tables against the library."""

import io
import json
import struct
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quire.llm import repair
from quire.llm.entry import op12_repair

JSON = P.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(JSON)


def plainly(g, symbols):
    """Every symbol expanded on its own."""
    n = len(g.terminals)

    def one(s):
        return [int(g.terminals[s])] if s < n else one(int(g.left[s - n])) + one(int(g.right[s - n]))

    return [x for s in symbols.tolist() for x in one(s)]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=300), st.sampled_from([1, 1000, 1 << 21]))
def test_every_sequence_comes_back(ids, scale):
    ids = np.array(ids * 3, np.uint32) * np.uint32(scale)
    g, symbols = repair.compress(ids)
    assert plainly(g, symbols) == ids.tolist() == repair.Expander(g)(symbols.astype(np.int64)).tolist()
    assert [len(plainly(g, np.array([len(g.terminals) + i]))) for i in range(len(g.left))] == g.length.tolist()


def test_rounds_use_the_frequent_pairs():
    rng = np.random.default_rng(1)
    words = [rng.integers(1, 50_000, n) for n in rng.integers(2, 9, 300)]
    ids = np.concatenate([np.append(np.concatenate([words[i] for i in rng.zipf(1.3, 40) % 300]), 0) for _ in range(2000)])
    g, symbols = repair.compress(ids)
    assert (repair.Expander(g)(symbols.astype(np.int64)) == ids).all()
    assert len(symbols) < 0.35 * len(ids) and len(g.levels) > 3
    used = np.bincount(np.concatenate([symbols, g.left, g.right]).astype(np.int64))[len(g.terminals) :]
    assert used.min() > 0
    ends = repair.Expander(g)
    assert not any((ends(np.array([len(g.terminals) + i])) == 0).any() for i in range(len(g.left)))  # no document's end inside


def shard_of(docs):
    data = repair.shard_bytes(pa.array([k for k, _ in docs], pa.int64()), np.array([len(x) for _, x in docs], np.int64), np.array([i for _, x in docs for i in x], "<u4"))
    return data, repair.Shard(io.BytesIO(data), len(data))


def test_random_access(monkeypatch):
    monkeypatch.setattr(repair, "STEP", 16)
    rng = np.random.default_rng(2)
    docs = [(k, [*(rng.integers(1, 12, rng.integers(0, 90)) + 5).tolist(), 0]) for k in [None, -5, *range(120)]]
    data, shard = shard_of(docs)
    every = [i for _, x in docs for i in x]
    assert shard.keys.to_pylist() == [k for k, _ in docs] and shard.ids().tolist() == every
    assert [shard.document(i).tolist() for i in range(len(docs))] == [x for _, x in docs]
    for a, b in rng.integers(0, len(every) + 5, (200, 2)).tolist():
        assert shard.ids(a, b).tolist() == every[a:b]
    read = []
    monkeypatch.setattr(repair.Shard, "_read", lambda self, at, n, f=repair.Shard._read: read.append(n) or f(self, at, n))
    shard.ids(700, 710)
    assert max(read) < len(data) / 8  # a few steps of symbols and the index, not the sequence


def test_the_format_as_it_is_described():
    docs = [(1, [7, 8] * 40 + [0]), (2, [0]), (3, [7, 8, 9] * 30 + [0])]
    data, _ = shard_of(docs)
    assert data[:4] == b"QRP1" and struct.unpack("<I", data[-4:])[0] == zlib.crc32(data[:-4])
    n = struct.unpack("<I", data[4:8])[0]
    head, at, got = json.loads(data[8 : 8 + n]), 8 + n, {}
    for name, kind, count in head["arrays"]:
        got[name] = np.frombuffer(data, kind, count, at)
        at += got[name].nbytes
    assert at + 4 == len(data)
    g = repair.Grammar(*(got[x] for x in repair.Grammar._fields))
    for i, (_, ids) in enumerate(docs):
        assert plainly(g, got["symbols"][got["documents"][i] : got["documents"][i + 1]]) == ids


@pytest.mark.parametrize("change", [lambda d: d[:-1], lambda d: d + b"x", lambda d: b"XXXX" + d[4:], lambda d: d[:60] + bytes([d[60] ^ 1]) + d[61:], lambda d: d[:-5] + bytes([d[-5] ^ 1]) + d[-4:], lambda d: b""])
def test_bad_files(change):
    data, _ = shard_of([(1, [5, 6] * 20 + [0])])
    bad = change(data)
    with pytest.raises(repair.BadShard):
        shard = repair.Shard(io.BytesIO(bad), len(bad))
        shard.check()
        shard.ids()


def want(rows):
    """rows in order: (key, text)"""
    out, start = [], 0
    for k, t in rows:
        ids = [*LIBRARY.encode(t or "", add_special_tokens=False).ids, 0]
        out.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_on_a_whole_table(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in op12_repair(spark, SF).collect())
    assert got == want(docs)


def test_odd_rows_in_small_shards(spark):
    texts = ["", None, "a <|endoftext|> b", "word " * 3000, "x", "\n\n", "é ß", "x"]
    rows = [(i % 5 if i % 7 else None, texts[i % len(texts)], "clash") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, path string").repartition(3, "text")
    shards = repair.write_shards(df, JSON, P.PATTERN, shard_ids=500).cache()
    listed = shards.orderBy("start").collect()
    assert len(listed) > 5 and all(a.start + a.ids == b.start for a, b in zip(listed, listed[1:]))
    got = sorted((r.start, r.key, r.n_tokens, tuple(r.ids)) for r in repair.read_shards(shards, "bigint", with_ids=True).collect())
    keys = [-1 if k is None else k for _, k, *_ in got]
    assert keys == sorted(keys) and got[0][0] == 0
    assert all(a[0] + a[2] == b[0] for a, b in zip(got, got[1:]))
    known = sorted((k is not None, k, [*LIBRARY.encode(t or "", add_special_tokens=False).ids, 0]) for k, t, _ in rows)
    assert sorted((k is not None, k, list(ids)) for _, k, _, ids in got) == known
    assert repair.round_trip(df.limit(0), JSON, P.PATTERN).count() == 0
    names = spark.createDataFrame([("b", "x y"), ("a", "z")], "name string, body string")
    assert [r.name for r in repair.round_trip(names, JSON, P.PATTERN, "name", "body").orderBy("start").collect()] == ["a", "b"]
