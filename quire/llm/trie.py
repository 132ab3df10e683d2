"""The prefix tree of conversations: who owns a node is found by binary search, chains of owned nodes are added up from below.

A node is a distinct sequence of first turns, named by its depth and a digest; the smallest conversation that begins with it
owns it. Who owns a node on its way owns all below, so a conversation's nodes are one chain, from its first owned depth to its
end. That depth is found for all conversations at once: each round joins one probe of every open conversation with the least
conversation of each digest. A chain hangs on the node above it, which is another's; what chains sum up to is handed up from
those that nothing hangs on.

Digests of prefixes are sums of keyed hashes of place and turn, so they come from running sums. Running sums go over ranges
of rows, and what a conversation has in the ranges before is added, so one conversation may hold any share of the rows.
"""

from __future__ import annotations

import hashlib
import secrets

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, map_arrow

#: Parts of a digest, and hexadecimal digits of each: 120 bits under a key that is drawn for every call.
PARTS, DIGITS = ("g1", "g2"), 15
#: The type of a digest's parts: sums of any number of turns.
SUM = "decimal(38,0)"
#: Conversations that share the first turns of one of them, and the largest number of turns shared, less one.
FAMILY, SHARED = 5, 9
#: Bytes of ids that one row carries on the way to a node's digest, about.
ID_BYTES = 1 << 16


def running(rows: DataFrame, key: str, order: list[Column], sums: dict[str, Column], scratch: Scratch, label: str) -> DataFrame:
    """rows with running sums over each key in order, the row's own included, under the names of sums.

    Rows are dealt to ranges by key and order. Only keys that reach over a range's border, at most one for each border, have
    something added.
    """
    parts = rows.repartitionByRange(F.col(key), *order).withColumn("__part", F.spark_partition_id())
    parts = scratch.cut(parts.withColumns({f"__{n}": c for n, c in sums.items()}), label)
    per = parts.groupBy(key, "__part").agg(*(F.sum(f"__{n}").alias(f"__{n}") for n in sums))
    before = W.partitionBy(key).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    ahead = per.select(F.col(key).alias("__key"), F.col("__part").alias("__at"), F.count("*").over(before).alias("__ahead"), *(F.sum(f"__{n}").over(before).alias(f"__before_{n}") for n in sums))
    ahead = F.broadcast(ahead.where("__ahead > 0"))  # at most a row for each border between ranges
    own = W.partitionBy("__part", key).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    out = parts.withColumns({n: F.sum(f"__{n}").over(own) for n in sums})
    out = out.join(ahead, (F.col(key) == F.col("__key")) & (F.col("__part") == F.col("__at")), "left")
    return out.select(*(F.col(c) for c in rows.columns), *((F.col(n) + F.coalesce(f"__before_{n}", F.lit(0))).alias(n) for n in sums))


def _turns(rows: DataFrame, conv: str, turn: str, role: str, text: str, scratch: Scratch) -> DataFrame:
    """(c, at, said, bytes): each conversation's turns, at from 0; said names role and text."""
    filled = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    t = rows.select(F.col(f"`{conv}`").cast("long").alias("c"), F.col(f"`{turn}`").alias("turn"), filled(role).alias("role"), filled(text).alias("text")).where("c IS NOT NULL")
    said = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    t = t.select("c", "turn", said.alias("said"), F.octet_length("text").cast("long").alias("bytes"))
    order = [F.col("turn"), F.col("said")]
    return scratch.cut(running(t, "c", order, {"n": F.lit(1).cast("long")}, scratch, "trie-turns").select("c", (F.col("n") - 1).alias("at"), "said", "bytes"), "trie-said")


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (c), and (c, d, said, bytes): their turns with the family's first ones before their own, d from 1."""
    shared = F.crc32(F.col("c").cast("string").cast("binary")) % SHARED
    convs = turns.select("c").distinct().select("c", shared.alias("h"), (F.col("c") - F.col("c") % FAMILY).alias("base"))
    heads = turns.where(F.col("at") < SHARED - 1).select(F.col("c").alias("base"), F.col("at").alias("head"), "said", "bytes")
    given = convs.join(heads, "base").where("head < h")
    first = given.select("c", (F.col("head") + 1).alias("d"), "said", "bytes")
    kept = convs.join(heads.groupBy("base").agg(F.count("*").alias("n")), "base", "left").select("c", "h", F.least("h", F.coalesce("n", F.lit(0))).alias("k"))
    own = turns.join(kept, "c").where("at >= h").select("c", (F.col("at") - F.col("h") + F.col("k") + 1).alias("d"), "said", "bytes")
    return convs.select("c"), first.unionByName(own)


def _first_owned(ends: DataFrame, paths: DataFrame, least: DataFrame, scratch: Scratch) -> DataFrame:
    """(c, first): the least depth from 1 on at which a conversation is the least of its digest; its length and one more where none.

    ends: (c, length). Each round halves the depths left to every conversation that still has two or more.
    """
    open_ = ends.select("c", F.lit(1).cast("long").alias("low"), (F.col("length") + 1).alias("high"))
    done = None
    while True:
        # Depth high is owned, or past the end; depths below low are not.
        closed = open_.where("low >= high").select("c", F.col("low").alias("first"))
        done = closed if done is None else done.unionByName(closed)
        open_ = open_.where("low < high")
        if not open_.limit(1).count():
            return done
        probes = open_.withColumn("d", F.floor((F.col("low") + F.col("high")) / 2).cast("long"))
        probes = probes.join(paths.select("c", "d", *PARTS), ["c", "d"])
        # The least conversation of a digest and the prober are one key, so no digest that many share gathers their probes.
        owned = least.select("d", *PARTS, F.col("owner").alias("c"), F.lit(True).alias("mine"))
        met = probes.join(owned, ["c", "d", *PARTS], "left")
        open_ = scratch.cut(met.select("c", F.when(F.col("mine"), F.col("low")).otherwise(F.col("d") + 1).alias("low"), F.when(F.col("mine"), F.col("d")).otherwise(F.col("high")).alias("high")), "trie-search")


def _handed_up(chains: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, depth, chains, leaves, saved): what the chains that hang on a node sum up to, with all that hangs on them.

    chains: (c, parent, depth, leaves, saved) with the sums of their own nodes; parent null for the root's. Each round takes
    the chains that nothing hangs on any more.
    """
    found, left = None, chains
    while True:
        above = left.where("parent IS NOT NULL").select(F.col("parent").alias("c")).distinct()
        ready = left.where("parent IS NOT NULL").join(above, "c", "left_anti")
        sums = ready.groupBy(F.col("parent").alias("conv_id"), "depth").agg(F.count("*").alias("chains"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        sums = scratch.cut(sums, "trie-sums")
        found = sums if found is None else found.unionByName(sums)
        if not sums.limit(1).count():
            return found.groupBy("conv_id", "depth").agg(*(F.sum(x).alias(x) for x in ("chains", "leaves", "saved")))
        added = sums.groupBy(F.col("conv_id").alias("c")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        more = lambda x: (F.col(x) + F.coalesce(f"more_{x}", F.lit(0))).alias(x)
        left = left.join(ready.select("c"), "c", "left_anti").join(added, "c", "left").select("c", "parent", "depth", more("leaves"), more("saved"))
        left = scratch.cut(left, "trie-left")


def _digests(ids: DataFrame, key: list[str]) -> DataFrame:
    """(key, ends_sha256) of rows (key, c): SHA-256 of each key's ids in decimal, ascending, joined by commas.

    Ranges of ids are joined to long strings first, so a key of very many ids comes to its task in few rows, which are hashed
    as they come and never held together.
    """
    names = [*key, "c"]

    def joined(batches):
        at, first, held, size = None, None, [], 0
        for batch in batches:
            rows, out = zip(*(batch.column(x).to_pylist() for x in names), strict=True), []
            for *k, c in rows:
                if at != k or size > ID_BYTES:
                    if held:
                        out.append((*at, first, ",".join(held)))
                    at, first, held, size = k, c, [], 0
                held.append(str(c))
                size += len(held[-1]) + 1
            yield _batch(batch.schema, out)
        if held:
            yield _batch(batch.schema, [(*at, first, ",".join(held))])

    def _batch(schema, out):
        fields = [*(schema.field(x) for x in names), pa.field("text", pa.string())]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(fields)], schema=pa.schema(fields))

    def hashed(batches):
        at, state = None, None
        for batch in batches:
            out = []
            for *k, text in zip(*(batch.column(x).to_pylist() for x in [*key, "text"]), strict=True):
                if at != k:
                    if state:
                        out.append((*at, state.hexdigest()))
                    at, state = k, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield _sums(batch.schema, out)
        if state:
            yield _sums(batch.schema, [(*at, state.hexdigest())])

    def _sums(schema, out):
        fields = [*(schema.field(x) for x in key), pa.field("ends_sha256", pa.string())]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(fields)], schema=pa.schema(fields))

    kinds = ", ".join(f"{x} {dict(ids.dtypes)[x]}" for x in names)
    parts = map_arrow(ids.select(*names).repartitionByRange(*names).sortWithinPartitions(*names), joined, f"{kinds}, text string")
    parts = parts.repartition(*key).sortWithinPartitions(*names).select(*key, "text")
    return map_arrow(parts, hashed, ", ".join(f"{x} {dict(ids.dtypes)[x]}" for x in key) + ", ends_sha256 string")


def prefix_tree(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by turn (null first), equal ones by the SHA-256 of role and text; repeated rows are turns each. A null role or text
    is empty; rows without a conversation are none's. A conversation begins with the turns of its family's first one, as many
    as a checksum of its id says, and goes on with its own after as many. conv_id is the least conversation that begins with a
    node, n_convs the number of those that do, saved_tokens the sum over the node and all below of (n_convs - 1) times the
    bytes of the last turn's text, ends_sha256 of those that end there. The root is every conversation's beginning and has
    no parent; with no conversation there is no node. Other columns are not read, whatever their names.
    """
    spark = rows.sparkSession
    scratch, secret = Scratch(spark), secrets.token_hex(16)
    turns = _turns(rows, conv, turn, role, text, scratch)
    convs, rebuilt = _rebuilt(turns)
    named = F.sha2(F.concat(F.lit(f"{secret}:").cast("binary"), F.col("d").cast("string").cast("binary"), F.lit(":").cast("binary"), F.col("said")), 256)
    number = lambda i: F.conv(F.substring("hash", 1 + DIGITS * i, DIGITS), 16, 10).cast("decimal(20,0)")
    rebuilt = rebuilt.withColumn("hash", named).select("c", "d", "bytes", *(number(i).alias(f"t{i}") for i in range(len(PARTS))))
    paths = running(rebuilt, "c", [F.col("d")], {g: F.col(f"t{i}") for i, g in enumerate(PARTS)}, scratch, "trie-hashes")
    paths = scratch.cut(paths.select("c", "d", "bytes", *(F.col(g).cast(SUM).alias(g) for g in PARTS)), "trie-paths")
    least = scratch.cut(paths.groupBy("d", *PARTS).agg(F.min("c").alias("owner"), F.count("*").alias("n_convs"), F.first("bytes").alias("bytes")), "trie-least")
    ends = convs.join(paths.groupBy("c").agg(F.max("d").alias("length")), "c", "left").select("c", F.coalesce("length", F.lit(0)).alias("length"))
    ends = scratch.cut(ends, "trie-ends")
    root = ends.agg(F.min("c").alias("top"), F.count("*").alias("n")).first()
    top, count = F.lit(root["top"]).cast("long"), F.lit(root["n"]).cast("long")

    # Chains, and the nodes they hang on: the root, or the one that another conversation owns above the first own depth.
    first = scratch.cut(_first_owned(ends, paths, least, scratch), "trie-first")
    chains = ends.join(first, "c").where((F.col("first") <= F.col("length")) | (F.col("c") == top))
    chains = chains.select("c", "length", F.when(F.col("c") == top, F.lit(0)).otherwise(F.col("first")).cast("long").alias("first"))
    above = chains.where("first > 1").select("c", (F.col("first") - 1).alias("d")).join(paths.select("c", "d", *PARTS), ["c", "d"])
    above = above.join(least.select("d", *PARTS, "owner"), ["d", *PARTS]).select("c", F.col("owner").alias("parent"))
    chains = chains.join(above, "c", "left").withColumn("parent", F.when(F.col("first") == 1, top).otherwise(F.col("parent")))
    chains = scratch.cut(chains, "trie-chains")

    none = F.lit(None).cast(SUM)
    nodes = least.select(F.col("owner").alias("conv_id"), F.col("d").alias("depth"), *PARTS, "n_convs", ((F.col("n_convs") - 1) * F.col("bytes")).alias("saves"))
    nodes = nodes.unionByName(ends.where(F.col("c") == top).select(F.col("c").alias("conv_id"), F.lit(0).cast("long").alias("depth"), *(none.alias(g) for g in PARTS), count.alias("n_convs"), F.lit(0).cast("long").alias("saves")))
    hangs = chains.where("parent IS NOT NULL").select(F.col("parent").alias("c"), (F.col("first") - 1).alias("length")).distinct()
    bare = chains.join(hangs.withColumn("more", F.lit(True)), ["c", "length"], "left").select("c", "parent", (F.col("first") - 1).alias("depth"), F.when(F.col("more"), 0).otherwise(1).cast("long").alias("leaves"))
    own = nodes.groupBy(F.col("conv_id").alias("c")).agg(F.sum("saves").alias("saved"))
    bare = scratch.cut(bare.join(own, "c").select("c", "parent", "depth", "leaves", "saved"), "trie-bare")
    up = scratch.cut(_handed_up(bare, scratch), "trie-up")

    # A node has what hangs on it and what the nodes below it on its chain have: sums from the chain's end.
    ended = ends.join(paths.select("c", F.col("d").alias("length"), *PARTS), ["c", "length"], "left").select("c", F.col("length").alias("depth"), *PARTS)
    zero = lambda c: F.coalesce(c, F.lit(0))
    shas = _digests(ended.select("depth", *(F.coalesce(g, F.lit(0).cast(SUM)).alias(g) for g in PARTS), "c"), ["depth", *PARTS])
    last = chains.select(F.col("c").alias("conv_id"), F.col("first"), F.col("length"), F.col("parent"))
    tip = bare.select(F.col("c").alias("conv_id"), F.col("leaves").alias("tip"))
    whole = nodes.join(up, ["conv_id", "depth"], "left").join(last.join(tip, "conv_id"), "conv_id")
    whole = whole.select(
        "conv_id", "depth", *(zero(g).cast(SUM).alias(g) for g in PARTS), "n_convs", "first", "parent",
        (F.when(F.col("depth") < F.col("length"), 1).otherwise(0) + zero("chains")).cast("long").alias("n_children"),
        (zero("leaves") + F.when(F.col("depth") == F.col("length"), F.col("tip")).otherwise(0)).alias("leaves"), (F.col("saves") + zero("saved")).alias("saved"),
    )
    summed = running(whole.withColumn("up", -F.col("depth")), "conv_id", [F.col("up")], {"n_leaves": F.col("leaves"), "saved_tokens": F.col("saved")}, scratch, "trie-nodes")
    out = summed.join(shas, ["depth", *PARTS], "left")
    parent = F.when(F.col("depth") > F.col("first"), F.col("conv_id")).otherwise(F.col("parent"))
    out = out.select("conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
    return scratch.last(out, "trie")
