"""Jaccard self-join of word shingles by chosen paths.

In each run a text's shingle set is sent down a random tree. At the root it follows the shingles whose hash for the run is
small enough for the set's size; buckets of few sets are compared by brute force. Larger ones are split again on newly
sampled shingles: at each further node a set follows the least shingles under two orders that the path picks, which a pair
shares with the chance of its similarity. What is still large at the last level is compared in blocks. The runs are repeated
until a pair at the threshold has met with the target recall even if all its buckets are split to the last level.

In a large bucket the sets much like one of its pivots need no further splitting: they are joined to the pivot. Whatever could
be similar to one of them (Jaccard distance obeys the triangle inequality) without being like the pivot meets them by sketches.

Meetings only propose, by ids and small sketches. What they connect is compared exactly, all with all, in blocks: that gives
the link counts, also of pairs that no bucket met, and the edges of spanning forests whose components are the classes. Pairs
are never written out. Equal sets are one class from the start, whatever their number. Nothing is gathered at the driver.
"""

from __future__ import annotations

import math
import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BASE, Rolling, Scratch, Words, batched, components, cut, hinted, map_arrow, mix, slices, text_of, utf8

#: Words of a shingle and the least similarity of a link.
SHINGLE, THRESHOLD = 5, 0.8
#: The share of similar pairs that the runs together are to meet, and levels of splitting.
RECALL, LEVELS = 0.9998, 4
#: Chosen shingles that a pair at the threshold shares on average at the root, and orders whose least shingle is followed below.
ROOT_MEAN, FOLLOWED = 1.0, 2
#: Buckets of so many sets are leaves; larger ones are compared in blocks of so many shingles and sets when no level is left.
LEAF, BLOCK_SHINGLES, BLOCK_SETS = 2048, 1 << 19, 2048
#: Sketch slots of a byte, and how many agree for an exact comparison (at similarity 0.8, 3 pairs in 100,000 fall below).
SLOTS, AGREE = 48, 27
#: Slots that agree with a pivot for a set to be settled (similarity about 0.87), and for it to meet the settled ones.
SETTLED, LOOSE = 42, 16
PIVOTS = 2
#: Ids and shared paths that are broadcast at most; beyond, the joins shuffle.
BROADCAST_IDS, BROADCAST_PATHS = 500_000, 250_000

_rng = np.random.default_rng(20240)
_odd = lambda n: (_rng.integers(0, 1 << 63, n, np.uint64) << np.uint64(1)) | np.uint64(1)
_SKETCH, _CHOICE = _odd(SLOTS), _odd(4096)
_SKETCHES = [f"k{i}" for i in range(SLOTS // 8)]


def runs(threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """Runs until a pair at the threshold has met with probability `recall`, at the last level if not before.

    A node's choice is its own, so the shared chosen shingles form a branching process: below a shared node a pair reaches
    the last level with chance p = 1 - (1 - threshold * p of the next) ** FOLLOWED, a run meets it with 1 - exp(-ROOT_MEAN * p).
    """
    met = 1.0
    for _ in range(LEVELS - 1):
        met = 1 - (1 - threshold * met) ** FOLLOWED
    return max(1, math.ceil(-math.log(1 - recall) / (ROOT_MEAN * met)))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, key: int, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, sorted within it, and offsets. A text of 1 to n - 1 words is one shingle."""
    words = Words(data, offsets)
    rolling, counts = Rolling(words.hashes(key), words.row), np.diff(words.first)
    at, h = rolling.windows(n)
    parts = [(words.row[at], h)]
    for m in range(1, n):
        rows = np.flatnonzero(counts == m)
        parts.append((rows, rolling.at(words.first[rows], m)))
    row, h = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(row, kind="stable")
    row, h = row[order], h[order]
    borders = np.searchsorted(row, np.arange(len(offsets)))
    sets = [np.unique(h[a:b]) for a, b in zip(borders, borders[1:])]
    ends = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int64)
    return (np.concatenate(sets) if sets else h), ends


def set_keys(h: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name each set, whatever the order of its members."""
    total = lambda x: np.diff(np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)])[ends])
    return mix(total(mix(h)) ^ np.diff(ends).astype(np.uint64)).view(np.int64), mix(total(mix(h ^ BASE))).view(np.int64)


def sketches(h: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of each set a byte of its least shingle under each of SLOTS orders."""
    full = np.flatnonzero(np.diff(ends))
    out = np.zeros((len(ends) - 1, SLOTS), np.uint8)
    for k in range(SLOTS if len(full) else 0):
        out[full, k] = (mix(np.minimum.reduceat(h * _SKETCH[k], ends[:-1][full])) & np.uint64(0xFF)).astype(np.uint8)
    return out


def _signatures(n_runs: int, threshold: float, secret: int):
    """Per text: key, the set's name and size, its sketch, and its nodes below the root in all runs."""

    def one(key: pa.Array, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
        h, ends = shingle_sets(data, offsets, secret)
        size = np.diff(ends)
        s1, s2 = set_keys(h, ends)
        row = np.repeat(np.arange(len(size)), size)
        most = np.minimum(2.0**64 * ROOT_MEAN / (threshold * np.maximum(size, 1)), 2.0**64 - 2048).astype(np.uint64)[row]
        at, path = [], []
        for run in range(n_runs):
            chosen = np.flatnonzero(h * _CHOICE[run] <= most)
            at.append(row[chosen])
            path.append(mix(h[chosen] + _CHOICE[run]))
        at, path = np.concatenate(at), np.concatenate(path)
        order = np.argsort(at, kind="stable")
        borders = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(size)))])
        paths = pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(path[order].view(np.int64), pa.int64()))
        slots = [pa.array(c) for c in sketches(h, ends).view("<i8").T]
        return pa.RecordBatch.from_arrays([key, pa.array(s1), pa.array(s2), pa.array(size, pa.int64()), *slots, paths], names=["key", "s1", "s2", "n", *_SKETCHES, "paths"])

    def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in slices(offsets):
                yield one(batch.column(0).slice(a, b - a), data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])

    return signatures


def _members(secret: int):
    """From rows (body, s1, s2, others): the others, and the set as bytes under members, of the rows whose text is that of
    the class (s1, s2); others share a key with it."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("body"))
            w1, w2 = np.asarray(batch.column("s1")), np.asarray(batch.column("s2"))
            rows, sets = [], []
            for a, b in slices(offsets):
                h, ends = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], secret)
                s1, s2 = set_keys(h, ends)
                for i in np.flatnonzero((s1 == w1[a:b]) & (s2 == w2[a:b])).tolist():
                    rows.append(a + i)
                    sets.append(h[ends[i] : ends[i + 1]].tobytes())
            kept = batch.take(pa.array(rows, pa.int64()))
            names = [x for x in batch.schema.names if x not in ("body", "s1", "s2")]
            yield pa.RecordBatch.from_arrays([*(kept.column(x) for x in names), pa.array(sets, pa.binary())], names=[*names, "members"])

    return members


def _whole_groups(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[tuple[pa.Table, list[int]]]:
    """From batches sorted by a column: tables of whole groups, with the borders between groups."""
    held: list[pa.RecordBatch] = []

    def borders(t: pa.Table) -> np.ndarray:
        codes = np.asarray(t.column(name).combine_chunks().dictionary_encode().indices)
        return np.flatnonzero(codes[1:] != codes[:-1]) + 1

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if len(held) > 1 and held[0].column(name)[held[0].num_rows - 1] == batch.column(name)[batch.num_rows - 1]:
            continue  # still the group that was open
        t = pa.Table.from_batches(held).combine_chunks()
        at = borders(t)
        if len(at):
            yield t.slice(0, at[-1]), [0, *at.tolist()]
            held = t.slice(at[-1]).combine_chunks().to_batches()
        else:
            held = t.to_batches()
    if held:
        t = pa.Table.from_batches(held).combine_chunks()
        yield t, [0, *borders(t).tolist(), t.num_rows]


def _labels(m: int, links: Iterator[tuple[int, np.ndarray]]) -> np.ndarray:
    """The least member of each one's tree, from (member, those it is linked to). Pairs are never held, only rows of them."""
    top, flag = np.arange(m), np.zeros(m, bool)
    for x, others in links:
        met = np.unique(np.append(top[others], top[x]))
        if len(met) > 1:
            flag[met] = True
            top[flag[top]] = met[0]
            flag[met] = False
    return top


def _agreeing(sketch: np.ndarray, n: np.ndarray, side: np.ndarray, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """Each i with the j > i whose sketches and sizes allow the threshold; of two sides, only pairs across."""
    m = len(n)
    for a in range(0, m, 128):
        x = slice(a, min(m, a + 128))
        fits = (np.minimum(n[x, None], n[None]) >= threshold * np.maximum(n[x, None], n[None])) & (np.arange(a, x.stop)[:, None] < np.arange(m)[None])
        if side.min() != side.max():
            fits &= side[x, None] != side[None]
        i, j = np.nonzero(fits)
        if len(i) * 8 < fits.size:
            good = (sketch[a + i] == sketch[j]).sum(1) >= AGREE
        else:
            same = np.zeros(fits.shape, np.uint8)
            for k in range(SLOTS):
                same += sketch[x, None, k] == sketch[None, :, k]
            good = same[i, j] >= AGREE
        i, j = i[good], j[good]
        for row, others in zip(np.unique(i), np.split(j, np.flatnonzero(np.diff(i)) + 1)):
            yield int(row) + a, others


def _sketches(t: pa.Table) -> np.ndarray:
    return np.ascontiguousarray(np.stack([np.asarray(t.column(k), "<i8") for k in _SKETCHES], 1)).view(np.uint8)


def _sift(threshold: float):
    """Of each bucket: edges (a, b) of a forest over the sets whose sketch and size agree with another's."""

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, borders in _whole_groups(batches, "g"):
            cid, n, side, sketch = np.asarray(t.column("cid")), np.asarray(t.column("n")), np.asarray(t.column("side")), _sketches(t)
            starts = np.array(borders[:-1])
            length = np.diff(borders)
            two = starts[length == 2]  # most buckets, all at once
            good = (sketch[two] == sketch[two + 1]).sum(1) >= AGREE
            good &= np.minimum(n[two], n[two + 1]) >= threshold * np.maximum(n[two], n[two + 1])
            found = [np.stack([cid[two[good]], cid[two[good] + 1]], 1)]
            for a, m in zip(starts[length > 2], length[length > 2], strict=True):
                top = _labels(m, _agreeing(sketch[a : a + m], n[a : a + m], side[a : a + m], threshold))
                hung = np.flatnonzero(top != np.arange(m))
                found.append(np.stack([cid[a + top[hung]], cid[a + hung]], 1))
            edges = np.unique(np.concatenate(found), axis=0)
            edges = edges[edges[:, 0] != edges[:, 1]]
            yield pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], names=["a", "b"])

    return sift


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of blocks of the incidence of shingles that more than one holds."""
    m, row = len(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(counts > 1) - 1
    kept = counts[inverse] > 1
    row, column = row[kept], number[inverse[kept]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out, width = np.zeros((m, m), np.float32), max(64, (1 << 22) // max(m, 1))
    total = int(column[-1]) + 1 if len(column) else 0
    for a in range(0, total, width):
        x, y = np.searchsorted(column, [a, a + width])
        block = np.zeros((m, min(width, total - a)), np.float32)
        block[row[x:y], column[x:y] - a] = 1
        out += block @ block.T
    return out


def _similar(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    if len(sets) == 2:
        a, b = sets
        shared = len(np.intersect1d(a, b, assume_unique=True))
        hit = shared >= threshold * (len(a) + len(b) - shared) - 1e-9
        return np.array([[False, hit], [hit, False]])
    n, shared = np.array([len(x) for x in sets], np.float64), _overlaps(sets)
    hits = np.empty(shared.shape, bool)
    for a in range(0, len(n), 256):  # in rows, as sizes are compared in double precision
        some = shared[a : a + 256].astype(np.float64)
        hits[a : a + 256] = some >= threshold * (n[a : a + 256, None] + n[None] - some) - 1e-9
    np.fill_diagonal(hits, False)
    return hits


def _compare(threshold: float):
    """Of each group, all with all: (cid, links) counts the documents that a set is linked to, (cid, root) are the edges of
    a spanning forest, root the least id of the tree in the group; whole says that the group is all of a component."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, borders in _whole_groups(batches, "g"):
            cid, copies, side, whole = (np.asarray(t.column(x)) for x in ("cid", "copies", "side", "whole"))
            members = [np.frombuffer(x, np.uint64) for x in t.column("members").to_pylist()]
            n = np.array([len(x) for x in members], np.int64)
            sketch = sketches(np.concatenate(members), np.concatenate([[0], np.cumsum(n)]))
            links, root, first = np.zeros(t.num_rows, np.int64), cid.copy(), np.ones(t.num_rows, bool)
            for a, b in zip(borders, borders[1:]):
                _, at = np.unique(cid[a:b], return_index=True)  # a repeated row is its class again
                first[a:b] = False
                first[a + at] = True
                at += a
                if len(at) < 2:
                    continue
                top = _labels(len(at), _agreeing(sketch[at], n[at], side[at], threshold))
                order = np.argsort(top, kind="stable")
                for part in np.split(order, np.flatnonzero(np.diff(top[order])) + 1):
                    if len(part) < 2:
                        continue
                    rows = at[part]
                    hits = _similar([members[x] for x in rows], threshold)
                    if side[rows].min() != side[rows].max():
                        hits &= side[rows, None] != side[None, rows]
                    links[rows] = [copies[rows[x]].sum() for x in hits]
                    tree = _labels(len(rows), ((x, np.flatnonzero(hits[x])) for x in np.flatnonzero(hits.any(1)).tolist()))
                    least = np.full(len(rows), np.iinfo(np.int64).max)
                    np.minimum.at(least, tree, cid[rows])
                    root[rows] = least[tree]
            yield pa.RecordBatch.from_arrays([pa.array(x[first]) for x in (cid, links, root, whole)], names=["cid", "links", "root", "whole"])

    return compare


def _blocks(sets: Column, shingles: Column) -> Column:
    return F.greatest(F.ceil(shingles / BLOCK_SHINGLES), F.ceil(sets / BLOCK_SETS)).cast("long")


def _in_blocks(rows: DataFrame, group: str, blocks: str) -> DataFrame:
    """Each row in every pair of blocks that its own is part of, under g = group, lower and upper block; side is its own."""
    rows = rows.withColumn("side", F.pmod(F.xxhash64("cid"), F.col(blocks)))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1)))
    # A group of more than one block meets itself only in pairs of different blocks and in the block's own pair.
    return rows.withColumn("g", F.concat_ws(":", F.col(group).cast("string"), F.least("side", "other"), F.greatest("side", "other")))


def _agreement(left: str, right: str) -> Column:
    """How many sketch slots of two rows agree: of every eight bytes, those that are zero in the exclusive or."""
    total = F.lit(0)
    for k in _SKETCHES:
        x = F.col(left + k).bitwiseXOR(F.col(right + k))
        for step in (4, 2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, step))
        total = total + F.lit(8) - F.bit_count(x.bitwiseAND(F.lit(0x0101010101010101)))
    return total


def _slot(number: Column) -> Column:
    """The byte of a sketch slot."""
    return F.call_function("shiftrightunsigned", F.element_at(F.array(*_SKETCHES), (number / 8).cast("int") + 1), F.pmod(number, F.lit(8)) * 8).bitwiseAND(F.lit(255))


def _followed(rows: DataFrame) -> DataFrame:
    """From rows (cid, path, sketch): the nodes below, as rows (cid, path). The orders that a path picks differ."""
    first = F.pmod(F.xxhash64("path", F.lit(1)), F.lit(SLOTS)).cast("int")
    step = 1 + F.pmod(F.xxhash64("path", F.lit(2)), F.lit(SLOTS // FOLLOWED - 1)).cast("int")
    rows = rows.withColumn("slot", F.explode(F.array(*(F.pmod(first + step * i, F.lit(SLOTS)) for i in range(FOLLOWED)))))
    return rows.select("cid", F.xxhash64("path", "slot", _slot(F.col("slot"))).alias("path"))


def _halo(met: DataFrame, near: Column, name: str) -> DataFrame:
    """Sets that a pivot settles and sets that are not much like it, yet may be similar to one of those, in blocks that meet
    under g: side 0 and 1. A set that agrees with the pivot itself is joined to it without that."""
    rows = met.withColumn("side", F.when(near >= SETTLED, 0).when((near >= LOOSE) & (near < AGREE), 1).cast("long")).where("side IS NOT NULL")
    counts = rows.groupBy("path").agg(*(F.ceil(F.count_if(F.col("side") == k) / BLOCK_SETS).cast("long").alias(f"b{k}") for k in (0, 1))).where("b0 > 0 AND b1 > 0")
    rows = rows.join(counts, "path")
    own = F.pmod(F.xxhash64("cid"), F.when(F.col("side") == 0, F.col("b0")).otherwise(F.col("b1")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("side") == 0, F.col("b1")).otherwise(F.col("b0")) - 1))
    rows = rows.withColumn("own", own).withColumn("other", other)
    place = [F.when(F.col("side") == k, F.col("own")).otherwise(F.col("other")) for k in (0, 1)]
    return rows.select(F.concat_ws(":", F.lit(name), "path", *place).alias("g"), "side", "cid", "n", *_SKETCHES)


def _proposals(classes: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """Edges (a, b) between classes (cid) that met and whose sketches agree; classes without any have none."""
    sketched = classes.select("cid", "n", *_SKETCHES)
    level = classes.select("cid", F.explode("paths").alias("path"))
    leaves, edges, halos = [], [], []
    for i in range(LEVELS):
        # Nearly all buckets hold one set. So only the paths are counted, and rows of ids meet those that are shared.
        sizes = scratch.cut(level.groupBy("path").agg(F.count("*").alias("m")).where("m > 1"), f"jaccard-sizes{i}")
        shared = level.join(hinted(sizes, BROADCAST_PATHS), "path").join(sketched, "cid")
        shared = scratch.cut(shared, f"jaccard-level{i}")
        leaves.append(shared.where(F.col("m") <= LEAF).select("cid", "n", *_SKETCHES, F.col("path").alias("bucket"), F.lit(1).cast("long").alias("blocks")))
        large = shared.where(F.col("m") > LEAF)
        if not sizes.where(F.col("m") > LEAF).limit(1).count():
            break
        pick = lambda j: F.min(F.struct(F.xxhash64("cid", F.lit(j)).alias("h"), "cid", *_SKETCHES)).alias(f"p{j}")
        pivots = scratch.cut(large.groupBy("path").agg(F.sum("n").alias("total"), *(pick(j) for j in range(PIVOTS))), f"jaccard-pivots{i}")
        met = large.join(hinted(pivots, BROADCAST_PATHS), "path")
        alike = [F.when(F.col("cid") == F.col(f"p{j}.cid"), 0).otherwise(_agreement("", f"p{j}.")).alias(f"a{j}") for j in range(PIVOTS)]
        met = scratch.cut(met.select("cid", "n", *_SKETCHES, "path", "m", "total", *(F.col(f"p{j}.cid").alias(f"p{j}") for j in range(PIVOTS)), *alike), f"jaccard-met{i}")
        for j in range(PIVOTS):
            near = F.col(f"a{j}")
            edges.append(met.where(near >= AGREE).select(F.col(f"p{j}").alias("a"), F.col("cid").alias("b")))
            halos.append(_halo(met, near, f"{i}.{j}"))
        rest = met.where(F.greatest(*(F.col(f"a{j}") for j in range(PIVOTS))) < SETTLED)
        if i == LEVELS - 1:
            leaves.append(rest.select("cid", "n", *_SKETCHES, F.col("path").alias("bucket"), _blocks(F.col("m"), F.col("total")).alias("blocks")))
            break
        level = scratch.cut(_followed(rest), f"jaccard-nodes{i}")
    held = leaves[0]
    for x in leaves[1:]:
        held = held.unionByName(x)
    held = _in_blocks(held, "bucket", "blocks").select("g", "side", "cid", "n", *_SKETCHES)
    for x in halos:
        held = held.unionByName(x)
    found = map_arrow(held.repartition("g").sortWithinPartitions("g"), _sift(threshold), "a long, b long")
    for x in edges:
        found = found.unionByName(x)
    return found.where("a <> b").distinct()


def near_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL, secret: int | None = None) -> DataFrame:
    """One row per row of docs: key, class_id, n_links, kept.

    Documents link if the Jaccard similarity of their sets of five-word shingles is at least the threshold; n_links counts
    the others a document links to, class_id is the smallest key that links lead to, kept says that it is the own one.
    Words are runs of other than space, tab, line and page breaks, compared as they are; a text of one to four words is one
    shingle, one without words (empty or null) links with nothing. A null key links with nothing and has a null class.
    Repeated rows are documents that link; rows that repeat the smallest key are kept together. Whole texts count. An empty
    table gives no rows; other columns are not read. secret: the key of all hashes, drawn anew if not given, so no text can
    be made to pass for another; a given one makes the paths the same again.
    """
    spark = docs.sparkSession
    batched(spark)
    scratch = Scratch(spark)
    kind, secret = docs.schema[key].dataType.simpleString(), secrets.randbits(64) if secret is None else secret
    rows = docs.select(F.col(f"`{key}`").alias("key"), text_of(text).alias("body"))
    slots = ", ".join(f"{k} long" for k in _SKETCHES)
    signed = map_arrow(rows.where("key IS NOT NULL"), _signatures(runs(threshold, recall), threshold, secret), f"key {kind}, s1 long, s2 long, n long, {slots}, paths array<long>")
    signed = scratch.cut(signed, "jaccard-signatures")
    first = [F.first(x).alias(x) for x in ("n", *_SKETCHES, "paths")]
    classes = signed.where("n > 0").groupBy("s1", "s2").agg(F.min("key").alias("rep"), F.count("*").alias("copies"), *first)
    classes = scratch.cut(classes.withColumn("cid", F.monotonically_increasing_id()), "jaccard-classes")

    found = components(_proposals(classes, threshold, scratch), "jaccard", scratch).select(F.col("id").alias("cid"), F.col("component").alias("c"))
    found = found.join(classes.select("cid", "rep", "s1", "s2", "n", "copies"), "cid")
    found = scratch.cut(found, "jaccard-components")
    sizes = found.groupBy("c").agg(_blocks(F.count("*"), F.sum("n")).alias("blocks"))
    placed = scratch.cut(found.join(sizes, "c").drop("n"), "jaccard-placed")
    # The sets are made anew from their texts. One block is its component: its sets go straight to it.
    texts = lambda x: rows.join(hinted(x, BROADCAST_IDS), rows["key"] == x["rep"]).drop("key", "rep")
    one = map_arrow(texts(placed.where("blocks = 1").select("rep", "s1", "s2", "c", "cid", "copies")), _members(secret), "c long, cid long, copies long, members binary")
    one = one.select(F.col("c").cast("string").alias("g"), "cid", "copies", F.lit(0).cast("long").alias("side"), F.lit(True).alias("whole"), "members")
    more = placed.where("blocks > 1")
    if more.limit(1).count():
        sets = scratch.cut(map_arrow(texts(more.select("rep", "s1", "s2", "cid")), _members(secret), "cid long, members binary"), "jaccard-sets")
        more = _in_blocks(more, "c", "blocks").select("g", "cid", "copies", F.col("side").cast("long").alias("side"), F.lit(False).alias("whole"))
        one = one.unionByName(more.join(sets, "cid"))
    compared = map_arrow(one.repartition("g").sortWithinPartitions("g"), _compare(threshold), "cid long, links long, root long, whole boolean")
    compared = scratch.cut(compared, "jaccard-compared")
    parts = compared.where("NOT whole")
    roots = compared.where("whole").select("cid", "root")
    if parts.limit(1).count():
        trees = components(parts.select(F.col("cid").alias("a"), F.col("root").alias("b")), "jaccard-parts", scratch)
        roots = roots.unionByName(trees.select(F.col("id").alias("cid"), F.col("component").alias("root")))
    links = compared.groupBy("cid").agg(F.sum("links").alias("links"))
    linked = classes.select("cid", "s1", "s2", "rep", "copies").join(roots, "cid").join(links, "cid")
    linked = scratch.cut(linked, "jaccard-linked")
    least = linked.groupBy("root").agg(F.min("rep").alias("class_id"))
    linked = linked.join(least, "root").select("cid", "s1", "s2", "class_id", "links", "copies")
    alone = classes.where("copies > 1").join(linked.select("cid"), "cid", "left_anti").select("cid", "s1", "s2", F.col("rep").alias("class_id"), F.lit(0).cast("long").alias("links"), "copies")
    known = scratch.cut(linked.unionByName(alone).select("s1", "s2", "class_id", (F.col("links") + F.col("copies") - 1).alias("n_links")), "jaccard-known")
    named = signed.select("key", F.when(F.col("n") > 0, F.col("s1")).alias("s1"), F.when(F.col("n") > 0, F.col("s2")).alias("s2"))
    out = named.join(known, ["s1", "s2"], "left").select("key", F.coalesce("class_id", "key").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    bare = docs.where(F.col(f"`{key}`").isNull()).select(F.col(f"`{key}`").alias("key"), F.lit(None).cast(kind).alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    out = out.unionByName(bare).withColumn("kept", F.coalesce(F.col("key") == F.col("class_id"), F.lit(True))).withColumnRenamed("key", key)
    return scratch.last(out, "jaccard")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of docs for each class, that with the smallest key; all columns stay as they are.

    Of rows that repeat a key and its text one stays, whichever. Rows with null keys stay, as do texts without words.
    """
    near = near_texts(docs, key, text).select(F.col(f"`{key}`").alias("__key"), "kept")
    gone = cut(near.where("NOT kept").select("__key").distinct(), "jaccard-gone")
    left = docs.join(hinted(gone, BROADCAST_IDS), F.col(f"`{key}`") == F.col("__key"), "left_anti")
    again = cut(near.where("kept AND __key IS NOT NULL").groupBy("__key").count().where("count > 1").select("__key"), "jaccard-again")
    if not again.limit(1).count():
        return left
    side, same = hinted(again, BROADCAST_IDS), F.col(f"`{key}`") == F.col("__key")
    return left.join(side, same, "left_anti").unionByName(left.join(side, same, "left_semi").dropDuplicates([key, text]))
