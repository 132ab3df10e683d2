"""What the training-data operators share: shared storage, Arrow batches, and byte-level words."""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
import re
import secrets
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of one Arrow batch handed to Python; bounds a Python worker's memory.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20
#: The bytes that separate words: the class [\x20\x09-\x0D].
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
#: Bytes of text that one numpy pass covers.
SLICE_BYTES = 1 << 18
#: Odd, so it has an inverse modulo 2**64.
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder below spark.checkpoint.dir. Where that is unset a temporary folder serves a local session; a cluster must set it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[\d*, ]+\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="quire-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/quire-{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends, and lost executors cost nothing before it."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """The folders that one operation writes on its way to a result; they are removed once the result itself is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def cut(self, df: DataFrame, label: str) -> DataFrame:
        self.paths.append(shared_dir(self.spark, label))
        df.write.parquet(self.paths[-1])
        return self.spark.read.schema(df.schema).parquet(self.paths[-1])

    def last(self, df: DataFrame, label: str) -> DataFrame:
        out = cut(df, label)
        for path in self.paths:
            at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)
        return out


#: Bytes of strings and lists in a side of a join that is broadcast at most.
BROADCAST_BYTES = 64 << 20


def hinted(df: DataFrame, most: int) -> DataFrame:
    """df for the small side of a join: broadcast if it is counted to have so few rows and so few bytes in columns of any length,
    else left to shuffle."""
    size = F.lit(0).cast("long")
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0))
        elif kind.startswith("array"):
            size = size + 8 * F.coalesce(F.size(F.col(f"`{name}`")), F.lit(0))
    rows, held = df.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(df) if rows <= most and held <= BROADCAST_BYTES else df


def batched(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session's Python stages by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def release_memory() -> None:
    """Give what a finished task has freed back to the system; workers live on and would hold their largest task's memory."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def map_arrow(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow in bounded batches, with freed memory given back after each task."""
    batched(df.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from f(batches)
        finally:
            release_memory()

    return df.mapInArrow(task, schema)


def text_of(name: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array without nulls, and the offsets of its rows (one more than rows)."""
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None and column.buffers()[2].size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole rows of about `size` bytes; a longer row makes a range of its own."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, min(last, rows)
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer of 64-bit values (the public splitmix64 one)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of consecutive texts, as positions in their joined bytes.

    start, end: of each word; row: its text; first: the number of the first word of each text, and the total.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = _SPACE):
        inside = ~breaks[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        begins[heads] = inside[heads]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        ends[tails] = inside[tails]
        self.data, self.offsets = data, offsets
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))

    def hashes(self, key: int) -> np.ndarray:
        """A 64-bit hash of each word: the same bytes give the same value anywhere under the same key."""
        return span_hashes(self.data, self.start, self.end, key)


#: Spans of up to so many bytes are hashed all at once, eight bytes a step; longer ones each by BLAKE2b.
SHORT_SPAN = 64
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_process_key = secrets.randbits(64)


def process_key() -> int:
    """A key of this process alone, for hashes that never leave it: no input can be made to collide under it."""
    return _process_key


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit hash under a secret key of the bytes of each span, which are a function of bytes, length and key alone.

    Nothing is a sum of the bytes, so unlike a polynomial modulo 2**64 it has no words that clash for every key. Spans
    of up to eight bytes and one length never clash; others do for one pair in 2**64, also where texts are chosen to.
    """
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    wide = np.ndarray(len(data) + 1, "<u8", buffer=padded, strides=(1,))
    size, secret = end - start, np.uint64(key)
    out = mix(mix(size.astype(np.uint64) * BASE + secret) ^ (wide[start] & _KEEP[np.minimum(size, 8)]))
    todo, at = np.flatnonzero((size > 8) & (size <= SHORT_SPAN)), 8
    while len(todo):
        left = size[todo] - at
        out[todo] = mix((out[todo] + secret) ^ (wide[start[todo] + at] & _KEEP[np.minimum(left, 8)]))
        todo, at = todo[left > 8], at + 8
    for i in np.flatnonzero(size > SHORT_SPAN).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[start[i] : end[i]], digest_size=8, key=int(key).to_bytes(8, "little")).digest(), "little")
    return out


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE and its inverse to the powers 0 to n - 1, modulo 2**64; kept up to one slice."""
    if len(_powers[0]) < n:
        made = []
        for base in (BASE, BASE_INVERSE):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            made.append(np.multiply.accumulate(x))
        if n > SLICE_BYTES:
            return made[0], made[1]
        _powers[:] = made
    return _powers[0][:n], _powers[1][:n]


class Rolling:
    """Hashes of windows of consecutive values from prefix sums of a polynomial, so every window costs the same at any length.

    The values are hashes under a secret key and windows are short, so sums that clash can't be chosen.
    """

    def __init__(self, values: np.ndarray, row: np.ndarray):
        up, self.down = powers(len(values) + 1)
        self.row, self.prefix = row, np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:-1], out=self.prefix[1:])

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the n-value windows that stay within one row."""
        at = np.flatnonzero(self.row[: max(0, len(self.row) - n + 1)] == self.row[n - 1 :])
        return at, self.at(at, n)

    def at(self, start: np.ndarray, n: int) -> np.ndarray:
        return mix((self.prefix[start + n] - self.prefix[start]) * self.down[start] + np.uint64(n))


def components(edges: DataFrame, label: str, scratch: Scratch | None = None) -> DataFrame:
    """Connected components of edges (a, b): rows (id, component), component the smallest id of the component.

    Alternates large-star and small-star rounds until nothing changes; every round is cut. A hub costs one row per
    neighbour and its minimum is aggregated before the shuffle; nothing is gathered in a list or at the driver.
    Ids of any orderable type; null ends are ignored; loops give a component of one.
    """
    cut = (scratch or Scratch(edges.sparkSession)).cut
    both = lambda e: e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = cut(edges.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b").distinct(), f"{label}-edges")
    ids = edges.select(F.col("a").alias("id")).union(edges.select(F.col("b").alias("id"))).distinct()
    links = edges.where("a <> b")
    before = None
    while True:
        # Large star: larger neighbours of a node go to the least of its neighbourhood. Small star: so do smaller ones.
        near = both(links)
        least = near.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        large = near.where("b > a").join(least, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least.withColumnRenamed("a", "k"), F.col("a") == F.col("k"))
        small = joined.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        links = cut(small, f"{label}-round")
        now = links.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if now == before:
            break
        before = now
    return ids.join(links.select(F.col("a").alias("id"), F.col("b").alias("m")), "id", "left").select("id", F.coalesce("m", "id").alias("component"))
