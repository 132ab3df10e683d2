"""Toxicity by multiple-instance learning: sentence scores, combined by noisy-or, learnt from document labels alone.

A sentence has the logit bias + sum of the weights of its distinct features (words, word beginnings); a document is toxic
unless the leak and every sentence fail to make it so: P = 1 - exp(-leak - sum softplus(logit)). Only the documents'
labels enter the likelihood, yet the fitted sentence scores tell which sentences offend.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, cut, map_arrow, mix, slices, span_hashes, text_of, utf8

#: Labelled documents of each class that the fit reads at most; those with the smallest hashes of the id are taken.
SAMPLE_TOXIC, SAMPLE_CLEAN = 2000, 4000
#: Bytes of text after which each class's sample takes no further document. Texts are whole, also the one that passes it.
SAMPLE_BYTES_TOXIC, SAMPLE_BYTES_CLEAN = 40_000_000, 80_000_000
#: Lengths in bytes of the word beginnings that are features beside the word.
BEGINNINGS = (4, 5, 6)
#: A feature is fitted if so many toxic sample documents hold it, and if it is so many times as frequent there by words.
LEAST_DOCS, LEAST_LIFT = 3, 2.5
#: Key of the features' hashes; models are kept between processes, so it is a fixed one.
KEY = 5
ROUNDS, RATE, DECAY = 150, 0.15, 1e-4

_break = np.zeros(256, bool)
_break[[*range(0x21), *b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"]] = True
_stop = np.zeros(256, bool)
_stop[list(b".!?\n")] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_lead = (np.arange(256) & 0xC0) != 0x80


class Model(NamedTuple):
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float
    leak: float


class Bags(NamedTuple):
    """Distinct features of sentences: parallel arrays, and for each sentence its document and span in bytes."""

    sentence: np.ndarray
    feature: np.ndarray
    document: np.ndarray
    start: np.ndarray
    end: np.ndarray


def bags(data: np.ndarray, offsets: np.ndarray, only: np.ndarray | None = None) -> Bags:
    """Sentences end at . ! ? and line breaks; only: sorted hashes of the features to keep."""
    sentences = Words(data, offsets, _stop)
    low = _lower[data]
    words = Words(low, offsets, _break)
    of = np.searchsorted(sentences.start, words.start, "right") - 1
    filter_ = None
    if only is not None:
        filter_ = np.zeros(1 << 16, bool)
        filter_[only & np.uint64(0xFFFF)] = True
    found = []
    for n in (0, *BEGINNINGS):
        at = np.arange(len(words.start)) if not n else np.flatnonzero(words.end - words.start > n)
        h = span_hashes(low, words.start[at], words.end[at] if not n else words.start[at] + n, KEY) ^ mix(np.full(1, n, np.uint64))
        where = of[at]
        if only is not None:
            maybe = np.flatnonzero(filter_[h & np.uint64(0xFFFF)])
            h, where = h[maybe], where[maybe]
            slot = np.minimum(np.searchsorted(only, h), max(0, len(only) - 1))
            good = only[slot] == h if len(only) else np.zeros(len(h), bool)
            h, where = h[good], where[good]
        found.append((where, h))
    where, h = (np.concatenate(x) for x in zip(*found, strict=True))
    if only is not None and len(h):
        order = np.lexsort((h, where))
        where, h = where[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (where[1:] != where[:-1]) | (h[1:] != h[:-1])
        where, h = where[new], h[new]
    return Bags(where, h, sentences.row, sentences.start, sentences.end)


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def fit(texts: list[str], labels: np.ndarray, rate: float) -> Model:
    """Fit on sample texts; classes are weighted so that toxic ones have the share `rate`."""
    none = np.zeros(0, np.uint64)
    if not len(labels) or labels.min() == labels.max():
        return Model(none, np.zeros(0), -30.0, float(-np.log1p(-min(rate, 1 - 1e-9))))
    data, offsets = utf8(pa.array(texts, pa.large_string()))
    counts: list[tuple[np.ndarray, np.ndarray]] = []
    totals = np.zeros(2)
    for a, b in slices(offsets):
        got = bags(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        doc = got.document[got.sentence]
        toxic = labels[a:b][doc] == 1
        totals += (~toxic).sum(), toxic.sum()
        pair = np.unique(np.stack([got.feature, doc.astype(np.uint64) + np.uint64(a)], 1)[toxic], axis=0)
        counts.append((pair[:, 0], got.feature[~toxic]))
    held, docs = np.unique(np.concatenate([x for x, _ in counts]), return_counts=True)
    enough = docs >= LEAST_DOCS
    held, docs = held[enough], docs[enough]
    clean = np.zeros(len(held))
    for _, x in counts:
        slot = np.minimum(np.searchsorted(held, x), max(0, len(held) - 1))
        np.add.at(clean, slot[held[slot] == x] if len(held) else [], 1)
    lift = (docs / totals[1]) / ((clean + 0.5) / totals[0])
    features = held[lift >= LEAST_LIFT]
    parts = []
    shift = 0
    for a, b in slices(offsets):
        got = bags(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], features)
        parts.append((got.sentence + shift, np.searchsorted(features, got.feature), got.document + a))
        shift += len(got.document)
    sentence, feature, document = (np.concatenate(x) for x in zip(*parts, strict=True))
    y, n, k = labels.astype(float), len(labels), len(features)
    share = y.mean()
    weight = np.where(y == 1, rate / share, (1 - rate) / (1 - share)) / n
    w = np.concatenate([np.zeros(k), [-8.0, -4.0]])  # weights, bias, logit of the leak
    first, second = np.zeros(k + 2), np.zeros(k + 2)
    for step in range(1, ROUNDS + 1):
        z = w[k] + np.bincount(sentence, w[feature], len(document))
        total = softplus(w[k + 1]) + np.bincount(document, softplus(z), n)
        slope = weight * np.where(y == 1, -1 / np.expm1(np.clip(total, 1e-9, 700)), 1.0)
        by = slope[document] / (1 + np.exp(-z))
        grad = np.concatenate([np.bincount(feature, by[sentence], k) + DECAY * w[:k] / max(1, n) ** 0.5, [by.sum(), slope.sum() / (1 + np.exp(-w[k + 1]))]])
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        w -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return Model(features, w[:k], float(w[k]), float(softplus(w[k + 1])))


def sentence_scores(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[Bags, np.ndarray, np.ndarray]:
    """The sentences, their probabilities, and the documents' scores by noisy-or."""
    got = bags(data, offsets, model.features)
    z = np.full(len(got.document), model.bias)
    if len(got.feature):
        z += np.bincount(got.sentence, model.weights[np.searchsorted(model.features, got.feature)], len(z))
    total = model.leak + np.bincount(got.document, softplus(z), len(offsets) - 1)
    return got, 1 / (1 + np.exp(-z)), -np.expm1(-total)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fit on labelled documents that are not held out. A document labelled twice is toxic if any label says so. An id with
    several texts gives each of them, within the bounds of the sample."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key))).groupBy(F.col(key).alias("id")).agg(F.max(label).cast("int").alias("y"))
    shares = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    first = lambda y, n: known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(n)
    chosen = first(1, SAMPLE_TOXIC).unionByName(first(0, SAMPLE_CLEAN))
    # Keys, hashes and lengths choose the documents; texts are fetched last. A text repeated under one id counts once.
    texts = docs.select(F.col(key).alias("id"), text_of(text).alias("body")).withColumn("h", F.xxhash64("body"))
    known = texts.join(F.broadcast(chosen), "id").groupBy("y", "id", "h").agg(F.first(F.octet_length("body")).alias("bytes"))
    known = cut(known, "toxicity-lengths")
    order = [F.xxhash64("id"), F.col("id"), F.col("h")]
    least = lambda y, n: known.where(F.col("y") == y).orderBy(*order).limit(n)
    rows = least(1, SAMPLE_TOXIC).unionByName(least(0, SAMPLE_CLEAN))
    # Of those, whole documents by hash until the class's bytes are reached.
    before = F.sum("bytes").over(Window.partitionBy("y").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    most = F.when(F.col("y") == 1, SAMPLE_BYTES_TOXIC).otherwise(SAMPLE_BYTES_CLEAN)
    taken = rows.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < most).select("id", "h", "y")
    taken = cut(taken, "toxicity-taken")
    rows = cut(texts.join(F.broadcast(taken), ["id", "h"]).dropDuplicates(["id", "h"]), "toxicity-sample").orderBy(*order, "body").toArrow()
    total = shares.get(0, 0) + shares.get(1, 0)
    return fit(rows.column("body").to_pylist(), np.asarray(rows.column("y")), shares.get(1, 0) / total if total else 0.0)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", sentences_from: float | None = None) -> DataFrame:
    """One row per row of docs: key, held_out, score, predicted, and the offending sentences if asked for.

    sentences_from: the least probability of the sentences listed as array<struct<start, end, score>>, in code points,
    end exclusive. A null or empty text has no sentence and scores the leak. Rows are scored each on their own: repeated
    rows and null keys (not held out) change nothing; other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            scores, spans = [], []
            for a, b in slices(offsets):
                part, ends = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                got, p, s = sentence_scores(model, part, ends)
                scores.append(s)
                if sentences_from is not None:
                    points = np.concatenate([[0], np.cumsum(_lead[part])])
                    found: list[list[dict]] = [[] for _ in range(b - a)]
                    for i in np.flatnonzero(p >= sentences_from):
                        zero = points[ends[got.document[i]]]
                        found[got.document[i]].append({"start": int(points[got.start[i]] - zero), "end": int(points[got.end[i]] - zero), "score": float(p[i])})
                    spans += found
            s = np.concatenate(scores) if scores else np.zeros(0)
            columns = [batch.column(0), batch.column(1), pa.array(s), pa.array((s >= 0.5).astype(np.int32))]
            if sentences_from is not None:
                columns.append(pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))))
            yield pa.RecordBatch.from_arrays(columns, names=["key", "held_out", "score", "predicted", "sentences"][: len(columns)])

    schema = f"key {kind}, held_out boolean, score double, predicted int" + (", sentences array<struct<start: int, end: int, score: double>>" if sentences_from is not None else "")
    return map_arrow(docs.select(F.col(key).alias("key"), held_out(F.col(key)).alias("out"), text_of(text).alias("body")), apply, schema).withColumnRenamed("key", key)
