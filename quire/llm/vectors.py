"""Near-duplicate vectors by product quantisation: inverted lists, residual codes, table distances, exact cosine.

Coarse centroids and subspace codebooks are fitted at the driver on a bounded sample; every vector is indexed in the list
of its nearest centroid with the codes of its residual and the error of those codes. A vector probes the lists whose border
a neighbour within the threshold may cross; how far neighbours lean towards borders is measured on the sample, by neighbours
made at just the threshold in random directions, towards other vectors and towards near ones, so that data of few effective
dimensions get the probes they need. Table distances then leave out only what the triangle inequality excludes.

Codes travel to the lists that ask for them; vectors follow only for what the tables leave. Every pair of lists is met from
one side, and a pair of vectors is counted at both ends at once. Large lists are met in blocks; a block gives counts and a
spanning forest, never pairs.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, batched, components, map_arrow

#: Codes and vectors of one list that a task compares at most.
BLOCK, CHUNK = 16384, 4096
#: Sample rows for each coarse list, the most lists, codewords of each subspace, and components of all sample rows; they
#: bound the fit at the driver.
SAMPLE_PER_LIST, MOST_LISTS, CODEWORDS, SUBSPACES = 32, 4096, 256, 16
SAMPLE_NUMBERS = 16 << 20
#: Lists for each square root of the vectors.
LISTS_PER_ROOT = 0.25
#: Sample vectors whose made neighbours fit the probes, and the share of those neighbours that the probes are to reach.
PROBE_SAMPLE, REACHED = 4096, 0.998
#: Rows whose distances to all centroids are held at once, and whose cosines with a whole block are.
ROWS, COMPARED = 4096, 64


def _assigned(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    square = (centres**2).sum(1)
    return np.concatenate([np.argmin(square - 2 * x[a : a + ROWS] @ centres.T, 1) for a in range(0, len(x), ROWS)]) if len(x) and len(centres) else np.zeros(len(x), int)


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    k = min(k, len(x))
    centres = x[np.random.default_rng(seed).choice(len(x), k, replace=False)].copy() if k else np.zeros((0, x.shape[1]))
    for _ in range(rounds):
        near = _assigned(x, centres)
        sums, n = np.zeros_like(centres), np.bincount(near, minlength=k)
        np.add.at(sums, near, x)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


class Index:
    """Coarse centroids and the residuals' codebooks for unit vectors of one dimension.

    give: the greatest share of its distance that a neighbour goes towards the border it crosses, for REACHED of them.
    """

    def __init__(self, sample: np.ndarray, lists: int, reach: float):
        self.centres, self.reach = kmeans(sample, lists), reach
        self.square = (self.centres**2).sum(1)
        self.cuts = np.linspace(0, sample.shape[1], min(SUBSPACES, sample.shape[1]) + 1).astype(int)
        rest = sample - self.centres[_assigned(sample, self.centres)]
        self.books = [kmeans(rest[:, a:b], CODEWORDS, seed=11 + a) for a, b in zip(self.cuts, self.cuts[1:])]
        self.give = self._fitted(sample) if len(self.centres) > 1 else 0.0

    def _fitted(self, sample: np.ndarray) -> float:
        rng = np.random.default_rng(13)
        x = sample[rng.permutation(len(sample))[:PROBE_SAMPLE]]
        other = sample[rng.integers(0, len(sample), (len(x), 32))]
        cosines = np.einsum("nkd,nd->nk", other, x)
        cosines[cosines > 1 - 1e-9] = -2  # copies of the vector itself have no direction
        close = other[np.arange(len(x)), cosines.argmax(1)]
        home, square = self.homes(x)
        wanted = 0.0
        for towards in (rng.normal(size=x.shape), other[:, 0], close):
            across = towards - (towards * x).sum(1)[:, None] * x
            size = np.sqrt((across**2).sum(1))
            good = size > 1e-6
            angle = 2 * np.arcsin(min(1.0, self.reach / 2))
            y = np.cos(angle) * x[good] + np.sin(angle) * across[good] / size[good, None]
            there, rows = _assigned(y, self.centres), np.flatnonzero(good)
            excess = square[rows, there] - square[rows, home[rows]]
            apart = np.sqrt(((self.centres[there] - self.centres[home[rows]]) ** 2).sum(1))
            share = np.where(there == home[rows], 0.0, excess / np.maximum(2 * self.reach * apart, 1e-12))
            wanted = max(wanted, float(np.quantile(share, REACHED, method="higher")) if len(share) else 0.0)
        return min(1.0, wanted)

    def homes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        square = np.maximum(0, (x**2).sum(1)[:, None] + self.square - 2 * x @ self.centres.T)
        return np.argmin(square, 1), square

    def probes(self, square: np.ndarray, home: np.ndarray) -> np.ndarray:
        """Which cells neighbours may lie in: by the distance to the plane between a cell's centre and the home's."""
        near = self.centres[np.unique(home)]
        apart = np.sqrt(np.maximum(0, (near**2).sum(1)[:, None] + self.square - 2 * near @ self.centres.T))[np.unique(home, return_inverse=True)[1]]
        excess = square - square[np.arange(len(home)), home][:, None]
        return excess <= 2 * self.reach * self.give * apart + 1e-9

    def encode(self, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        codes, error = [], np.zeros(len(rest))
        for (a, b), book in zip(zip(self.cuts, self.cuts[1:]), self.books, strict=True):
            square = np.maximum(0, (rest[:, a:b] ** 2).sum(1)[:, None] + (book**2).sum(1) - 2 * rest[:, a:b] @ book.T)
            near = np.argmin(square, 1)
            codes.append(near.astype(np.uint8))
            error += square[np.arange(len(rest)), near]
        return np.stack(codes, 1), np.sqrt(error)

    def table_distances(self, x: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances of queries to the coded vectors of list `at`, from one lookup table a query."""
        rest, total = x - self.centres[at], np.zeros((len(x), len(codes)), np.float32)
        for m, ((a, b), book) in enumerate(zip(zip(self.cuts, self.cuts[1:]), self.books, strict=True)):
            lookup = ((rest[:, a:b] ** 2).sum(1)[:, None] + (book**2).sum(1) - 2 * rest[:, a:b] @ book.T).astype(np.float32)
            total += lookup[:, codes[:, m]]
        return np.maximum(total, 0)


def forest(hits: np.ndarray) -> list[list[tuple[int, int]]]:
    """For each connected group of a bipartite boolean matrix: its (side, number) members."""
    out, left = [], hits.any(1)
    while left.any():
        rows = np.zeros(len(hits), bool)
        rows[np.argmax(left)] = True
        columns = np.zeros(hits.shape[1], bool)
        fresh = rows.copy()
        while fresh.any():
            reached = hits[fresh].any(0) & ~columns
            columns |= reached
            fresh = hits[:, reached].any(1) & ~rows
            rows |= fresh
        left &= ~rows
        out.append([(0, i) for i in np.flatnonzero(rows)] + [(1, i) for i in np.flatnonzero(columns)])
    return out


def _matrix(column: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), np.float64).reshape(n, -1)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by their largest component first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(1, initial=0)[:, None]
    return x / np.sqrt((x**2).sum(1))[:, None]


def _linked(q: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs reach the threshold; those that a product of blocks can't tell are decided one by one, in one way."""
    dots = q @ y.T
    hits = dots >= threshold
    i, j = np.nonzero(np.abs(dots - threshold) < 1e-9)
    hits[i, j] = np.einsum("nd,nd->n", q[i], y[j]) >= threshold
    return hits


def _usable(vector: Column, label: Column) -> Column:
    """Vectors that may link: no null or non-finite component, some component not zero, a label."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(label.isNotNull() & finite & F.exists(wide, lambda x: x != 0), F.lit(False))


def near_vectors(rows: DataFrame, threshold: float = 0.93, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row per row of rows: key, n_links, component_id, kept.

    Vectors with equal labels link from a cosine of `threshold` on, in double precision. Those that are null, empty or
    zero, hold null or non-finite components, or have no label or key link with nothing (0 links, their own component).
    Equal rows are one class in all comparisons and count each as another's link. Vectors of different lengths do not
    link. Components of any finite size count. An empty table gives no rows; other columns are not read.
    """
    spark = rows.sparkSession
    batched(spark)
    scratch = Scratch(spark)
    wide = "float" if rows.schema[vector].dataType.simpleString() == "array<float>" else "double"
    v = F.col(f"`{vector}`").cast(f"array<{wide}>")
    base = rows.select(F.col(f"`{key}`").alias("id"), F.col(f"`{label}`").alias("label"), v.alias("v"))
    base = base.withColumn("ok", F.col("id").isNotNull() & _usable(F.col("v"), F.col("label")))
    base = base.withColumns({"k1": F.when(F.col("ok"), F.xxhash64("label", "v")), "k2": F.when(F.col("ok"), F.xxhash64("v", "label", F.lit(1)))})
    classes = scratch.cut(base.where("ok").groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("v").alias("v")), "vectors")
    found = scratch.cut(_links(classes, threshold, scratch), "vector-links")
    counts = found.groupBy("k1", "k2").agg(F.sum("links").alias("links"))
    near = components(found.where("o1 IS NOT NULL").select(F.struct("k1", "k2").alias("a"), F.struct(F.col("o1").alias("k1"), F.col("o2").alias("k2")).alias("b")), "vectors", scratch)
    near = near.select(F.col("id.k1").alias("k1"), F.col("id.k2").alias("k2"), F.col("component").alias("c"))
    known = classes.select("k1", "k2", "rep", "copies").join(near, ["k1", "k2"], "left").withColumn("c", F.coalesce("c", F.struct("k1", "k2")))
    least = known.groupBy("c").agg(F.min("rep").alias("component"))
    known = known.join(least, "c").join(counts, ["k1", "k2"], "left").select("k1", "k2", "component", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    out = base.select("id", "k1", "k2").join(known, ["k1", "k2"], "left")
    component = F.coalesce("component", "id")
    out = out.select(F.col("id").alias(key), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
    return scratch.last(out, "vectors")


def _links(classes: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """Rows (k1, k2, links, o1, o2): partial link counts, and edges of spanning forests where o1 is given."""
    schema = "k1 long, k2 long, links long, o1 long, o2 long"
    classes = classes.withColumn("dim", F.size("v"))
    sizes = {r["dim"]: r["count"] for r in classes.groupBy("dim").count().collect()}
    out = None
    for dim, n in sizes.items():
        part = _links_of(classes.where(F.col("dim") == dim), dim, n, threshold, schema, scratch)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else classes.sparkSession.createDataFrame([], schema)


def fitted(classes: DataFrame, dim: int, n: int, threshold: float) -> Index:
    """An index fitted on about SAMPLE_PER_LIST vectors a list: those with the smallest hashes, so no task sorts rows."""
    lists = int(min(MOST_LISTS, max(1, round(LISTS_PER_ROOT * n**0.5))))
    rows = max(1, min(lists * SAMPLE_PER_LIST, SAMPLE_NUMBERS // max(1, dim)))
    below = -(1 << 63) + min((1 << 64) - 1, (rows << 64) // max(1, n))
    sample = classes.where(F.col("k2") <= below).select("k2", "k1", "v").toArrow().sort_by([("k2", "ascending"), ("k1", "ascending")])
    if not sample.num_rows:  # by chance, of very few
        sample = classes.limit(rows).select("v").toArrow()
    x = _unit(_matrix(sample.column("v"), sample.num_rows))
    return Index(x, max(1, min(lists, sample.num_rows // 4)), float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6)


def _links_of(classes: DataFrame, dim: int, n: int, threshold: float, schema: str, scratch: Scratch) -> DataFrame:
    index = fitted(classes, dim, n, threshold)

    def assign(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unit(_matrix(batch.column("v"), batch.num_rows))
            home, square = index.homes(x)
            codes, error = index.encode(x - index.centres[home])
            near = index.probes(square, home) & (np.arange(len(index.centres)) >= home[:, None])  # lists are met from the first of the two
            probes = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(near.sum(1))]), pa.int32()), pa.array(np.nonzero(near)[1], pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2"), batch.column("label"), batch.column("v"), pa.array(home, pa.int32()), probes, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error, pa.float64())], names=["k1", "k2", "label", "v", "home", "probes", "codes", "error"])

    kinds = {x: classes.schema[x].dataType.simpleString() for x in ("label", "v")}
    indexed = scratch.cut(map_arrow(classes.select("k1", "k2", "label", "v"), assign, f"k1 long, k2 long, label {kinds["label"]}, v {kinds["v"]}, home int, probes array<int>, codes binary, error double"), "vector-index")
    asked = indexed.select("k1", "k2", "label", F.col("home").alias("list"), F.col("home").alias("of"), "v", "probes", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("double").alias("error"))
    wanted = indexed.select("label", F.col("home").alias("list"), F.explode("probes").alias("of")).distinct()
    codes = indexed.select("k1", "k2", "label", F.col("home").alias("of"), "codes", "error").join(wanted, ["label", "of"])
    codes = codes.select("k1", "k2", "label", "list", "of", F.lit(None).cast(kinds["v"]).alias("v"), F.lit(None).cast("array<int>").alias("probes"), "codes", "error")
    sizes = indexed.groupBy("label", F.col("home").alias("list")).agg(F.count("*").alias("n"))
    blocks = wanted.join(sizes.withColumnRenamed("list", "of"), ["label", "of"]).groupBy("label", "list").agg(F.ceil(F.sum("n") / BLOCK).alias("blocks"))
    grid = scratch.cut(sizes.select("label", "list", F.ceil(F.col("n") / CHUNK).alias("chunks")).join(blocks, ["label", "list"]), "vector-grid")
    upto = lambda n: F.explode(F.sequence(F.lit(0), (F.col(n) - 1).cast("int")))
    own = lambda n: F.pmod(F.xxhash64("k1", "k2"), F.col(n)).cast("int")
    codes = codes.join(grid, ["label", "list"]).select("*", own("blocks").alias("block"), upto("chunks").alias("chunk"))
    asked = asked.join(grid, ["label", "list"]).select("*", own("chunks").alias("chunk"), upto("blocks").alias("block"))

    def keys_of(t: pa.Table) -> np.ndarray:
        return np.stack([np.asarray(t.column("k1")), np.asarray(t.column("k2"))], 1)

    def before(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which keys of a come before which of b."""
        return (a[:, None, 0] < b[None, :, 0]) | ((a[:, None, 0] == b[None, :, 0]) & (a[:, None, 1] < b[None, :, 1]))

    def meet(key: tuple, t: pa.Table) -> pa.Table:
        """Of one list's vectors and the codes it asked for: what table distances leave, as members of groups to compare."""
        coded = np.asarray(t.column("codes").is_valid())
        asks, held = t.filter(pa.array(~coded)), t.filter(pa.array(coded))
        rows: list[tuple[bytes, bool, int, np.ndarray]] = []
        if asks.num_rows and held.num_rows:
            x, xk, yk, home = _unit(_matrix(asks.column("v"), asks.num_rows)), keys_of(asks), keys_of(held), asks.column("list")[0].as_py()
            probed = np.repeat(np.arange(asks.num_rows), np.asarray(asks.column("probes").combine_chunks().value_lengths()))
            lists = np.asarray(asks.column("probes").combine_chunks().flatten())
            of, error = np.asarray(held.column("of")), np.asarray(held.column("error"), np.float32)
            code = np.frombuffer(b"".join(held.column("codes").to_pylist()), np.uint8).reshape(held.num_rows, -1)
            name = repr([k.as_py() for k in key]).encode()
            for j in np.unique(of).tolist():
                q, y = probed[lists == j], np.flatnonzero(of == j)
                if not len(q):
                    continue
                far = (index.reach + error[y]) ** 2 + 1e-3
                left, right = np.zeros(len(q), bool), np.zeros(len(y), bool)
                for a in range(0, len(q), 256):
                    maybe = index.table_distances(x[q[a : a + 256]], j, code[y]) <= far
                    if j == home:
                        maybe &= before(xk[q[a : a + 256]], yk[y])
                    left[a : a + 256] = maybe.any(1)
                    right |= maybe.any(0)
                group = hashlib.blake2b(name + str(j).encode(), digest_size=16).digest()
                rows += [(group, j == home, 0, xk[q[left]]), (group, j == home, 1, yk[y[right]])]
        n = [len(r[3]) for r in rows]
        keys = np.concatenate([r[3] for r in rows]) if rows else np.zeros((0, 2), np.int64)
        spread = lambda i, kind: pa.array([r[i] for r, m in zip(rows, n, strict=True) for _ in range(m)], kind)
        return pa.table({"g": spread(0, pa.binary()), "inner": spread(1, pa.bool_()), "side": spread(2, pa.int32()), "k1": keys[:, 0], "k2": keys[:, 1]})

    def compare(t: pa.Table) -> pa.Table:
        """Of one group, by exact cosines: links counted at both ends, and a forest."""
        side = np.asarray(t.column("side"))
        keys, copies, x = keys_of(t), np.asarray(t.column("copies")), _unit(_matrix(t.column("v"), t.num_rows))
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        inner, y = t.column("inner")[0].as_py(), x[b]
        hits, left, right = np.zeros((len(a), len(b)), bool), np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        for i in range(0, len(a), COMPARED):  # cosines of a few rows at a time: all that stays is a bit for each pair
            some = slice(i, i + COMPARED)
            hits[some] = _linked(x[a[some]], y, threshold)
            if inner:
                hits[some] &= before(keys[a[some]], keys[b])
            left[some] = hits[some] @ copies[b]
            right += copies[a[some]] @ hits[some]
        links = np.concatenate([left, right])
        ends = np.concatenate([keys[a], keys[b]])
        rows = [(*ends[i].tolist(), int(links[i]), None, None) for i in np.flatnonzero(links)]
        for group in forest(hits):
            members = sorted({tuple(keys[(a, b)[s][i]].tolist()) for s, i in group})
            rows += [(*m, 0, *members[0]) for m in members[1:]]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        return pa.table({c: pa.array(z, pa.int64()) for c, z in zip(("k1", "k2", "links", "o1", "o2"), columns, strict=True)})

    names = ["k1", "k2", "label", "list", "of", "v", "probes", "codes", "error", "block", "chunk"]
    left = codes.select(names).unionByName(asked.select(names)).groupBy("label", "list", "block", "chunk").applyInArrow(meet, "g binary, inner boolean, side int, k1 long, k2 long")
    left = scratch.cut(left, "vector-left")
    return left.join(classes.select("k1", "k2", "copies", "v"), ["k1", "k2"]).groupBy("g").applyInArrow(compare, schema)
