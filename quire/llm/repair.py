"""Token ids in binary shards under a Re-Pair grammar: frequent pairs of ids are replaced by nonterminals again and again.

A shard holds whole documents in ascending order. In every round all pairs are counted; where frequent ones overlap, the
more frequent is replaced, the left one of equals; a nonterminal that would be used too seldom is not made. No pair reaches
over the end of a document, so a document is a range of symbols. Every nonterminal's expansion length is stored, and the
position of every STEP-th symbol, so any range of ids is decoded from the symbols that cover it, and nothing before them.

A file, all integers little-endian: MAGIC; a JSON header and its length (4 bytes); then the arrays that the header names with
their types, one after the other; at last a CRC-32 of all before. terminals: ids of symbols 0 to n - 1; left, right, length:
of the nonterminals that follow; levels: the first nonterminal of each round; symbols: the sequence; steps: ids before every
STEP-th symbol; documents, starts: first symbol and first id of each document, and the totals; keys: an Arrow stream.
"""

from __future__ import annotations

import functools
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BATCH_ROWS, cut, map_arrow, shared_dir, text_of
from .packing import END_ID, encoded

MAGIC = b"QRP1"
#: A shard is closed beyond so many ids, a round makes so many nonterminals at most, each used so often at least; at most so many rounds.
SHARD_IDS, ROUND_RULES, LEAST_USES, ROUNDS = 1 << 20, 16_384, 6, 8
#: Rounds end when one shortens the sequence by less than this share.
LEAST_GAIN = 0.02
STEP = 1024


class Grammar(NamedTuple):
    terminals: np.ndarray
    left: np.ndarray
    right: np.ndarray
    length: np.ndarray  # ids that each nonterminal stands for
    levels: np.ndarray


class BadShard(ValueError):
    """A shard that is not as it must be."""


def _counted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.sort(key)
    at = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
    return key[at[:-1]], np.diff(at)


def compress(ids: np.ndarray, end: int = END_ID) -> tuple[Grammar, np.ndarray]:
    """A grammar and the sequence of symbols that it expands to ids. No nonterminal holds the id `end`."""
    terminals, seq = np.unique(ids, return_inverse=True) if len(ids) and ids.max() >= 1 << 20 else _dense(ids)
    bits = 16 if len(terminals) < 1 << 15 else 32
    kind = np.uint32 if bits == 16 else np.uint64
    seq = seq.astype(kind)
    most = (1 << bits) - 1  # symbols
    stop = np.flatnonzero(terminals == end)
    stop = kind(stop[0] if len(stop) else most)  # in no pair, also where it is none of the ids
    left, right, length, levels, n = [], [], [np.ones(len(terminals), np.int64)], [0], len(terminals)
    for _ in range(ROUNDS):
        room = min(ROUND_RULES, most - n)
        if len(seq) < 2 or room <= 0:
            break
        key = (seq[:-1] << kind(bits)) | seq[1:]
        pairs, uses = _counted(key)
        good = uses >= LEAST_USES
        pairs, uses = pairs[good], uses[good]
        good = (pairs >> kind(bits) != stop) & (pairs & kind(most) != stop)
        pairs, uses = pairs[good], uses[good]
        if len(pairs) > room:
            good = np.argpartition(uses, len(uses) - room)[len(uses) - room :]
            pairs, uses = pairs[good], uses[good]
        order = np.argsort(uses, kind="stable")
        pairs, uses = pairs[order], uses[order]
        # A table of the pairs by a hash of 16 bits; of those in one slot the most frequent stays for this round.
        slot = lambda x: (x * kind(0x9E3779B1 if bits == 16 else 0x9E3779B97F4A7C15)) >> kind(2 * bits - 16)
        known, rule = np.zeros(1 << 16, kind), np.full(1 << 16, -1, np.int32)
        known[slot(pairs)], rule[slot(pairs)] = pairs, np.arange(len(pairs), dtype=np.int32)
        place = slot(key)
        at = np.flatnonzero(known[place] == key)
        at = at[rule[place[at]] >= 0]  # not a slot without a pair
        if not len(at):
            break
        here = rule[place[at]]
        weight = uses[here]
        # Where matches are side by side, one stays if it is more frequent than that before and no less than that after it.
        beside = at[1:] == at[:-1] + 1
        wins = np.ones(len(at), bool)
        wins[1:] &= ~beside | (weight[1:] > weight[:-1])
        wins[:-1] &= ~beside | (weight[:-1] >= weight[1:])
        at, here = at[wins], here[wins]
        used = np.bincount(here, minlength=len(pairs))
        good = used[here] >= LEAST_USES
        at, here = at[good], here[good]
        if len(at) < LEAST_GAIN * len(seq):
            break
        made = np.flatnonzero(used >= LEAST_USES)
        number = np.zeros(len(pairs), kind)
        number[made] = n + np.arange(len(made))
        a, b = pairs[made] >> kind(bits), pairs[made] & kind(most)
        every = np.concatenate(length)
        left.append(a), right.append(b), length.append(every[a] + every[b])
        seq[at] = number[here]
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq = seq[keep]
        levels.append(levels[-1] + len(made))
        n += len(made)
    small = np.dtype("<u2") if n <= 1 << 16 else np.dtype("<u4")
    join = lambda x: np.concatenate([np.zeros(0, np.int64), *x])
    return Grammar(terminals.astype("<u4"), join(left).astype(small), join(right).astype(small), join(length[1:]).astype("<u4"), np.array(levels, "<u4")), seq.astype(small)


def _dense(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    there = np.bincount(ids) > 0 if len(ids) else np.zeros(0, bool)
    return np.flatnonzero(there), (np.cumsum(there) - 1)[ids]


class Expander:
    """Expansions of all symbols of a grammar, flat, made level by level."""

    def __init__(self, g: Grammar):
        n = len(g.terminals)
        self.length = np.concatenate([np.ones(n, np.int64), g.length.astype(np.int64)])
        self.begin = np.concatenate([[0], np.cumsum(self.length)])[:-1]
        self.flat = np.zeros(int(self.length.sum()), "<u4")
        self.flat[:n] = g.terminals
        for a, b in zip(g.levels[:-1].tolist(), g.levels[1:].tolist()):
            both = np.stack([g.left[a:b], g.right[a:b]], 1).reshape(-1).astype(np.int64)
            made = self(both)
            self.flat[self.begin[n + a] : self.begin[n + a] + len(made)] = made

    def __call__(self, symbols: np.ndarray) -> np.ndarray:
        length = self.length[symbols]
        ends = np.cumsum(length)
        return self.flat[np.repeat(self.begin[symbols] - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)]


def shard_bytes(keys: pa.Array, sizes: np.ndarray, ids: np.ndarray, end: int = END_ID) -> bytes:
    """A shard's file: its documents' keys, their numbers of ids, and all ids, each document's last one being `end`."""
    grammar, symbols = compress(ids, end)
    long = np.concatenate([np.ones(len(grammar.terminals), np.int64), grammar.length])[symbols]
    before = np.concatenate([[0], np.cumsum(long)])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    stream = pa.BufferOutputStream()
    with pa.ipc.new_stream(stream, pa.schema([("key", keys.type)])) as writer:
        writer.write_batch(pa.record_batch([keys], names=["key"]))
    arrays = grammar._asdict() | {"symbols": symbols, "steps": before[:-1:STEP].astype("<u4"), "documents": np.searchsorted(before, starts).astype("<u4"), "starts": starts.astype("<u4"), "keys": np.frombuffer(stream.getvalue(), "|u1")}
    head = json.dumps({"ids": len(ids), "step": STEP, "arrays": [(k, v.dtype.str, len(v)) for k, v in arrays.items()]}).encode()
    out = b"".join([MAGIC, struct.pack("<I", len(head)), head, *(v.tobytes() for v in arrays.values())])
    return out + struct.pack("<I", zlib.crc32(out))


class Shard:
    """A shard opened for reading. ids() reads and decodes only what covers the range asked for."""

    def __init__(self, file, size: int):
        """file: with seek and read, as pyarrow's input files."""
        self.file, self.size = file, size
        if self._read(0, 4) != MAGIC:
            raise BadShard("no shard")
        n = struct.unpack("<I", self._read(4, 4))[0]
        try:
            head = json.loads(self._read(8, n))
            self.place, at = {}, 8 + n
            for name, kind, count in head["arrays"]:
                self.place[name] = at, np.dtype(kind), count
                at += np.dtype(kind).itemsize * count
            self.n_ids, self.step = head["ids"], head["step"]
        except (ValueError, KeyError, TypeError) as e:
            raise BadShard(f"bad header: {e}") from e
        if at + 4 != size:
            raise BadShard(f"{size} bytes instead of {at + 4}")

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        out = self.file.read(n)
        if len(out) != n:
            raise BadShard("cut off")
        return out

    def check(self) -> None:
        """Read all and compare the CRC-32."""
        crc, at = 0, 0
        while at < self.size - 4:
            part = self._read(at, min(1 << 20, self.size - 4 - at))
            crc, at = zlib.crc32(part, crc), at + len(part)
        if crc != struct.unpack("<I", self._read(self.size - 4, 4))[0]:
            raise BadShard("CRC-32 differs")

    def array(self, name: str, first: int = 0, last: int | None = None) -> np.ndarray:
        at, kind, count = self.place[name]
        last = count if last is None else min(last, count)
        return np.frombuffer(self._read(at + first * kind.itemsize, max(0, last - first) * kind.itemsize), kind)

    @functools.cached_property
    def expand(self) -> Expander:
        return Expander(Grammar(*(self.array(x) for x in Grammar._fields)))

    @functools.cached_property
    def starts(self) -> np.ndarray:
        return self.array("starts").astype(np.int64)

    @functools.cached_property
    def keys(self) -> pa.Array:
        return pa.ipc.open_stream(pa.py_buffer(self.array("keys").tobytes())).read_all().column("key").combine_chunks()

    def ids(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """The ids from number first to before number last of the shard."""
        last = self.n_ids if last is None else min(last, self.n_ids)
        if first >= last:
            return np.zeros(0, "<u4")
        steps = self.array("steps").astype(np.int64)
        a, b = int(np.searchsorted(steps, first, "right")) - 1, int(np.searchsorted(steps, last, "left"))
        out = self.expand(self.array("symbols", a * self.step, b * self.step))
        return out[first - steps[a] : last - steps[a]]

    def document(self, number: int) -> np.ndarray:
        return self.ids(int(self.starts[number]), int(self.starts[number + 1]))


def open_shard(uri: str) -> Shard:
    system, path = fs.FileSystem.from_uri(uri)
    return Shard(system.open_input_file(path), system.get_file_info(path).size)


def write_shards(docs: DataFrame, tokenizer_path: str, pattern: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID, shard_ids: int = SHARD_IDS, label: str = "repair") -> DataFrame:
    """Write the ids of all documents in ascending order of key; one row (path, start, docs, ids, bytes) a shard.

    A document's ids are those of packing.pack: the library's with its own settings, then end_id. A null text is empty, null
    keys come first, rows of one key in the table's order. start: the ids of all documents before the shard. Ranges of keys
    go to tasks, so shards are written side by side; their ids are added up range by range. File names are new in every
    attempt, and only those of attempts that succeeded are listed. An empty table gives no shard.
    """
    folder = shared_dir(docs.sparkSession, label)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, end, rows, held, keys = TaskContext.get().partitionId(), struct.pack("<I", end_id), [], [], []
        size = 0

        def flush() -> None:
            system, path = fs.FileSystem.from_uri(folder)
            system.create_dir(path, recursive=True)
            name = f"{uuid.uuid4().hex}.ids"
            data = shard_bytes(pa.concat_arrays(keys), np.array([len(x) // 4 for x in held], np.int64), np.frombuffer(b"".join(held), "<u4"), end_id)
            with system.open_output_stream(f"{path}/{name}") as out:
                out.write(data)
            rows.append((f"{folder}/{name}", part, len(rows), len(held), size, len(data)))

        for batch in batches:
            first = 0
            for i, ids in encoded(batch.column(1), tokenizer_path, pattern):
                held.append(ids + end)
                size += len(ids) // 4 + 1
                if size >= shard_ids:
                    keys.append(batch.column(0).slice(first, i + 1 - first))
                    first = i + 1
                    flush()
                    held, keys, size = [], [], 0
            keys.append(batch.column(0).slice(first))
        if held:
            flush()
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in enumerate([pa.string(), *[pa.int64()] * 5])], names=["path", "part", "number", "docs", "ids", "bytes"])

    # The table's order breaks ties, so rows that share a key may lie in several ranges.
    rows = docs.select(F.col(f"`{key}`").alias("key"), text_of(f"`{text}`").alias("body")).withColumn("at", F.monotonically_increasing_id())
    ranges = rows.repartitionByRange("key", "at").sortWithinPartitions("key", "at").select("key", "body")
    listed = cut(map_arrow(ranges, write, "path string, part long, number long, docs long, ids long, bytes long"), f"{label}-list")
    # A row for each range, and within a range one for each shard.
    whole = listed.groupBy("part").agg(F.sum("ids").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    within = F.coalesce(F.sum("ids").over(W.partitionBy("part").orderBy("number").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return listed.withColumn("within", within).join(whole.select("part", "before"), "part").select("path", (F.col("before") + F.col("within")).alias("start"), "docs", "ids", "bytes")


def read_shards(shards: DataFrame, kind: str, with_ids: bool = False) -> DataFrame:
    """From rows (path, start): one row (key, start, n_tokens, ids_crc32) a document, and ids if asked for. kind: the key's type.

    Every file's length and CRC-32 are checked; what is wrong raises BadShard, which names the file.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]
        for batch in batches:
            for path, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    shard = open_shard(path)
                    shard.check()
                    ids, starts, keys = shard.ids(), shard.starts, shard.keys
                except BadShard as e:
                    raise BadShard(f"{path}: {e}") from e
                raw = ids.tobytes()
                for a in range(0, len(keys), BATCH_ROWS):
                    ends = starts[a : a + BATCH_ROWS + 1]
                    crcs = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(ends.tolist(), ends[1:].tolist())]
                    columns = [keys.slice(a, BATCH_ROWS), pa.array(before + ends[:-1], pa.int64()), pa.array(np.diff(ends), pa.int64()), pa.array(crcs, pa.int64())]
                    if with_ids:
                        columns.append(pa.ListArray.from_arrays(pa.array(ends - ends[0], pa.int32()), pa.array(ids[ends[0] : ends[-1]].astype(np.int32))))
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"key {kind}, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    spread = shards.select("path", "start").repartition(max(1, min(10_000, shards.count())), "path")
    return map_arrow(spread, read, schema)


def round_trip(docs: DataFrame, tokenizer_path: str, pattern: str, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Write docs as shards and read them back: key, start, n_tokens, ids_crc32, one row per row of docs."""
    shards = cut(write_shards(docs, tokenizer_path, pattern, key, text, **options), "repair-starts")
    return read_shards(shards, docs.schema[key].dataType.simpleString()).withColumnRenamed("key", key)
