"""Packing by power-of-two decomposition: every document is cut into pieces of binary lengths, one piece a sequence.

Pieces of equal length share a bucket, so batches are of one length, nothing is padded and no sequence crosses
documents. Token counts decide everything, so no token ever moves between tasks and there is no shuffle.
"""

from __future__ import annotations

import functools
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import TOKEN_SLICE, Pieces
from .common import BATCH_ROWS, map_arrow, slices, text_of, utf8

SEQUENCE_TOKENS = 1024
END_ID = 0


def lengths(n: int, most: int = SEQUENCE_TOKENS) -> list[int]:
    """n as a sum of powers of two of at most `most` (itself one), the largest first, each but `most` at most once."""
    return [most] * (n // most) + [1 << k for k in reversed(range(most.bit_length() - 1)) if n % most >> k & 1]


@functools.lru_cache(maxsize=2)
def tokenizer_pieces(path: str, pattern: str) -> tuple[Pieces, Callable[[str], list[int]], list[bytes]]:
    """The tokenizer of a file behind a cache of pieces, its plain call, and its special tokens' strings in UTF-8; kept
    while the worker process lives. The pieces are ordinary text, special tokens in them too."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    special = [x.content.encode() for x in tokenizer.get_added_tokens_decoder().values() if x.special]
    own, tokenizer.encode_special_tokens = tokenizer.encode_special_tokens, True
    encode = tokenizer.encode

    def whole_text(text: str) -> list[int]:
        """With the tokenizer's own settings, which are back to those of pieces afterwards."""
        tokenizer.encode_special_tokens = own
        try:
            return encode(text, add_special_tokens=False).ids
        finally:
            tokenizer.encode_special_tokens = True

    def words_of(words: list[str]) -> list[bytes]:
        """One call for many words: the tokenizer's own word numbers part the ids."""
        got = encode(" " + " ".join(words), add_special_tokens=False)
        ids, number = np.array(got.ids, "<u4"), np.array(got.word_ids)
        borders = np.concatenate([[0], np.flatnonzero(number[1:] != number[:-1]) + 1, [len(ids)]]) * 4
        data = ids.tobytes()
        return [data[a:b] for a, b in zip(borders.tolist(), borders[1:].tolist())]

    pieces = Pieces(pattern, lambda piece: struct.pack(f"<{len(x := encode(piece, add_special_tokens=False).ids)}I", *x), words_of)
    return pieces, whole_text, special


def encoded(texts: pa.Array, tokenizer_path: str, pattern: str) -> Iterator[tuple[int, bytes]]:
    """The ids of each text of a column without nulls, as the tokenizer gives them with its own settings, in little-endian
    unsigned 32-bit integers; with the text's number. Texts that hold a special token are encoded by the library whole."""
    pieces, whole_text, special = tokenizer_pieces(tokenizer_path, pattern)
    data, offsets = utf8(texts)
    for a, b in slices(offsets, TOKEN_SLICE):
        every, borders = pieces.ids(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        raw, part = every.tobytes(), data[offsets[a] : offsets[b]].tobytes()
        marked = any(x in part for x in special)
        for i, (x, y) in enumerate(zip(borders.tolist(), borders[1:].tolist()), a):
            if marked and any(z in part[offsets[i] - offsets[a] : offsets[i + 1] - offsets[a]] for z in special):
                yield i, np.array(whole_text(texts[i].as_py()), "<u4").tobytes()
            else:
                yield i, raw[4 * x : 4 * y]


def pack(docs: DataFrame, tokenizer_path: str, pattern: str, key: str = "doc_id", text: str = "text", most: int = SEQUENCE_TOKENS, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket, and ids if asked for.

    A document's ids are those that the byte-level tokenizer at tokenizer_path (readable on every executor) gives with its
    own settings and add_special_tokens=False, then end_id; so the string of a special token in a text is that token, and
    texts that hold one are encoded by the library whole. A null text is empty and gives the end id alone. bucket is log2 of the length. sequence_id is unique: bucket + (levels) * (the number of the sequence in its
    bucket and task + 2**32 * the task's number), so sequences of a bucket are ids of one residue; offset is always 0.
    Rows are independent: repeated rows are packed each, a null key stays null, other columns are not read. A task that
    is run again gives the same rows.
    """
    kind, levels = docs.schema[key].dataType.simpleString(), most.bit_length()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = struct.pack("<I", end_id)
        task, counts = TaskContext.get().partitionId() << 32, [0] * levels
        names = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket", *(["ids"] if with_ids else [])]
        for batch in batches:
            at, rows, lists = [], [], []
            for i, ids in encoded(batch.column(1), tokenizer_path, pattern):
                ids, n, start = ids + end, len(ids) // 4 + 1, 0
                for length in lengths(n, most):
                    bucket, cut = length.bit_length() - 1, ids[4 * start : 4 * (start + length)]
                    rows.append((start, length, zlib.crc32(cut), n, (task + counts[bucket]) * levels + bucket, 0, bucket))
                    at.append(i)
                    if with_ids:
                        lists.append(np.frombuffer(cut, "<u4").astype(np.int32))
                    counts[bucket] += 1
                    start += length
            table = np.array(rows, np.int64).reshape(-1, 7)
            columns = [batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, pa.int64()) for c in table.T), *([pa.array(lists, pa.list_(pa.int32()))] if with_ids else [])]
            whole = pa.RecordBatch.from_arrays(columns, names=names)
            for first in range(0, whole.num_rows, BATCH_ROWS):
                yield whole.slice(first, BATCH_ROWS)

    schema = f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, bucket long" + (", ids array<int>" if with_ids else "")
    return map_arrow(docs.select(F.col(key).alias("key"), text_of(text).alias("body")), packed, schema).withColumnRenamed("key", key)
