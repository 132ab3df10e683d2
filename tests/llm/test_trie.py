"""The prefix tree against a plain one, odd rows, and running sums over ranges."""

import hashlib
import random
import zlib
from collections import defaultdict

from conftest import SF, canonical
from pyspark.sql import functions as F

from quire.llm import trie
from quire.llm.common import Scratch
from quire.llm.entry import OP13_SQL, op13_trie


def plain(rows):
    """rows: (conv, turn, role, text)"""
    of = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            said = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            of[c].append((turn is not None, turn or 0, said, role, text))
    turns = {c: [x[3:] for x in sorted(v)] for c, v in of.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 9
        t = turns.get(c - c % 5, [])[:h] + turns[c][h:]
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
        ends[tuple(t)].append(str(c))
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    sums = {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        below = [sums[k] for k in kids[p]]
        sums[p] = (sum(x for x, _ in below) or 1, own + sum(y for _, y in below))
    return sorted(((m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(kids[p]), *sums[p], hashlib.sha256(",".join(ends[p]).encode()).hexdigest()) for p, m in members.items()), key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_on_a_whole_table(spark, duck):
    got, want = op13_trie(spark, SF), duck.sql(OP13_SQL)
    assert canonical(got.collect(), got.columns) == canonical(want.fetchall(), want.columns)
    assert rows_of(got) == plain([tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()])


ODD = [
    (0, 0, "u", "a"), (0, 0, "u", "a"), (0, None, None, None), (0, 1, "a", "é"), (1, 5, "u", "x"), (None, 0, "u", "lost"), (7, 0, "u", "a"), (7, 1, "a", "b"), (3, 9, "", ""),
    (10, 0, "u", "a"), (10, 1, "u", "a"), (12, 2, "ua", ""), (12, 2, "u", "a"), (23, 0, "u", "deep"), (1004, 0, "u", "a"),
]


def test_odd_rows(spark):
    df = spark.createDataFrame([(*r, "clash") for r in ODD], "conv_id long, turn long, role string, text string, depth string")
    assert rows_of(trie.prefix_tree(df)) == plain(ODD)
    assert trie.prefix_tree(df.limit(0)).count() == 0
    assert trie.prefix_tree(df.where("conv_id IS NULL")).count() == 0


def test_long_copied_and_branching(spark):
    """Conversations that are copies, prefixes and branches of each other, at many depths, and one that holds a third of all rows."""
    rng = random.Random(5)
    rows, stems = [], [[("u", f"s{i}.{d}") for d in range(40)] for i in range(3)]
    for c in range(120):
        stem = stems[rng.randrange(3)][: rng.choice([1, 2, 9, 20, 39, 40])]
        for _ in range(rng.randrange(3)):
            stem = stem[: rng.randrange(len(stem) + 1)] + [("a", f"b{rng.randrange(4)}")] * rng.randrange(4)
        rows += [(c, d, *x) for d, x in enumerate(stem or [("u", "only")])]
    rows += [(500, d, "u", f"s0.{d % 40}") for d in range(len(rows) // 2)]
    got = trie.prefix_tree(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7))
    assert rows_of(got) == plain(rows)


def test_running_sums_over_ranges(spark):
    rows = [(k, i, i % 7) for k, n in (("a", 1), ("b", 900), ("c", 3), (None, 5)) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, i long, v long").where("k IS NOT NULL")
    got = trie.running(df, "k", [F.col("i")], {"upto": F.col("v"), "n": F.lit(1)}, Scratch(spark), "t").collect()
    assert len({r.n for r in got if r.k == "b"}) == 900
    for r in got:
        assert (r.upto, r.n) == (sum(i % 7 for i in range(r.i + 1)), r.i + 1)


def test_ids_joined_in_many_strings(spark, monkeypatch):
    monkeypatch.setattr(trie, "ID_BYTES", 40)
    ids = spark.range(-50, 3000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40).cast("long").alias("k"), F.col("id").alias("c"))
    want = defaultdict(list)
    for k, c in sorted(tuple(r) for r in ids.collect()):
        want[k].append(str(c))
    got = {r.k: r.ends_sha256 for r in trie._digests(ids.repartition(5), ["k"]).collect()}
    assert got == {k: hashlib.sha256(",".join(v).encode()).hexdigest() for k, v in want.items()}
