"""Quality rules by repetition coverage: rolling hashes of several n-gram lengths, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, Rolling, Words, map_arrow, mix, process_key, slices, span_hashes, text_of, utf8

#: Lengths in words of the repeated n-grams that count, and the greatest share of a text's word characters that they
#: may cover: the limits published for filtering web text. A window counts from its second occurrence on.
GRAMS = {5: 0.15, 7: 0.13, 10: 0.10}
#: The greatest share of word characters in lines that repeat an earlier line.
LINE_SHARE = 0.30
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, REPEAT_PERCENT = 50, 50

_symbol = np.zeros(256, bool)
_symbol[list(SYMBOLS)] = True
_line_break = np.zeros(256, bool)
_line_break[10] = True
_lead = (np.arange(256) & 0xC0) != 0x80  # bytes that begin a code point

FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars", *(f"dup_chars_{n}" for n in GRAMS)]
SCHEMA = ", ".join(f"{x} long" for x in FIELDS)


def keyed(hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Hashes that differ between rows."""
    return mix(hashes ^ mix(row.astype(np.uint64) + np.uint64(1)))


def again(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: is it found twice or more; is it equal to an earlier one."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = keys[order[1:]] == keys[order[:-1]]
    twice, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    twice[order] = same[1:] | same[:-1]
    later[order] = same[:-1]
    return twice, later


def covered(at: np.ndarray, n: int, words: int) -> np.ndarray:
    """Which words lie in the n-word windows that start at `at`."""
    step = np.zeros(words + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + n, -1)
    return np.cumsum(step[:-1]) > 0


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of FIELDS for each text."""
    rows = len(offsets) - 1
    w = Words(data, offsets)
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_lead[data], out=points[1:])
    chars = points[w.end] - points[w.start]
    total = lambda v, row: np.bincount(row, v, rows).astype(np.int64)
    marks = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_symbol[data], out=marks[1:])
    out = {"n_words": np.diff(w.first), "word_chars": total(chars, w.row), "n_symbols": marks[offsets[1:]] - marks[offsets[:-1]]}

    lines = Words(data, offsets, _line_break)
    has_word = np.searchsorted(w.start, lines.end) > np.searchsorted(w.start, lines.start)
    start, end, row = lines.start[has_word], lines.end[has_word], lines.row[has_word]
    _, later = again(keyed(span_hashes(data, start, end, process_key()), row))
    out["n_dup_lines"] = total(later, row)
    upto = np.concatenate([[0], np.cumsum(chars)])
    in_line = upto[np.searchsorted(w.start, end)] - upto[np.searchsorted(w.start, start)]
    out["dup_line_chars"] = total(in_line * later, row)

    rolling = Rolling(w.hashes(process_key()), w.row)
    at, hashes = rolling.windows(3)
    twice, _ = again(keyed(hashes, w.row[at]))
    out["n_repeat_words"] = total(covered(at[twice], 3, len(w.start)), w.row)
    for n in GRAMS:
        at, hashes = rolling.windows(n)
        _, later = again(keyed(hashes, w.row[at]))
        out[f"dup_chars_{n}"] = total(covered(at[later], n, len(w.start)) * chars, w.row)
    return out


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(batch.num_columns - 1))
        parts = []
        for a, b in slices(offsets, SLICE_BYTES):
            got = measure(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            parts.append(got)
        columns = [pa.array(np.concatenate([p[f] for p in parts]) if parts else np.zeros(0, np.int64), pa.int64()) for f in FIELDS]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*batch.schema.names[:-1], *FIELDS])


def with_verdict(df: DataFrame) -> DataFrame:
    """Add base_failed, reject_reason (null if kept) and kept to rows that hold FIELDS."""
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    reason = F.when(base, "base").when(F.col("dup_line_chars") > LINE_SHARE * F.col("word_chars"), "lines")
    for n, share in GRAMS.items():
        reason = reason.when(F.col(f"dup_chars_{n}") > share * F.col("word_chars"), f"grams_{n}")
    return df.withColumns({"base_failed": base, "reject_reason": reason}).withColumn("kept", F.col("reject_reason").isNull())


def repetition(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: key, the counts of FIELDS, base_failed, reject_reason, kept.

    Words are runs of other than space, tab and the line and page breaks; lines are split at \\n. A null or empty text
    has no words and fails. Repeated rows and null keys are judged each on its own; other columns are not read. A very
    long text makes a numpy pass of its own. Only shares strictly above a limit reject, so ties keep.
    """
    kind = docs.schema[key].dataType.simpleString()
    counted = map_arrow(docs.select(F.col(key).alias("key"), text_of(text).alias("body")), _measure, f"key {kind}, {SCHEMA}")
    return with_verdict(counted).withColumnRenamed("key", key)


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of docs that the rules keep, with the columns of docs."""
    names = docs.columns

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        for batch in batches:
            column = pc.fill_null(batch.column(names.index(text)).cast(pa.string()), "")
            data, offsets = utf8(column)
            keep = [verdict(measure(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])) for a, b in slices(offsets)]
            yield batch.filter(pa.array(np.concatenate(keep) if keep else np.zeros(0, bool)))

    return map_arrow(docs, judge, docs.schema)


def verdict(m: dict[str, np.ndarray]) -> np.ndarray:
    """The same rules as with_verdict, on arrays."""
    bad = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > REPEAT_PERCENT * m["n_words"])
    bad |= m["dup_line_chars"] > LINE_SHARE * m["word_chars"]
    for n, share in GRAMS.items():
        bad |= m[f"dup_chars_{n}"] > share * m["word_chars"]
    return ~bad
