"""Byte-level BPE by prefix dynamic programming, and the piece cache that whole texts are encoded through.

For every prefix of a piece exactly one token can come last in the encoding of that prefix: the token that ends there
and that may follow the last token of the prefix before it. A pair of tokens may stand side by side if the merges of
their joined bytes give just that pair. So the table of last tokens is filled from left to right; bytes are appended
exactly, and after an edit only the entries near it change.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
import struct
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, map_arrow, mix, process_key, slices, span_hashes, text_of, utf8

#: Words that a worker's table holds at most; beyond, it starts anew. A memory bound only (about 60 bytes a word).
CACHE_PIECES = 1_000_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Ranks:
    """The tokens of a rank file and which of them may follow which. A token is named by its rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks), default=1)
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, bool] = {}

    def merges(self, data: bytes) -> Iterator[list[bytes]]:
        """The parts after each merge in rank order, done plainly: what defines the encoding. For short inputs."""
        parts = [data[i : i + 1] for i in range(len(data))]
        yield parts
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = self.ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts = [*parts[:at], parts[at] + parts[at + 1], *parts[at + 2 :]]
            yield parts

    def merged(self, data: bytes) -> list[bytes]:
        *_, parts = self.merges(data)
        return parts

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens that the last merge of a token joins; itself twice for a byte; None if merges don't reach it."""
        if token not in self.halves:
            data = self.bytes_of[token]
            if len(data) == 1:
                self.halves[token] = (token, token)
            else:
                before, after = [], []
                for parts in self.merges(data):
                    before, after = after, parts
                self.halves[token] = (self.ranks[before[0]], self.ranks[before[1]]) if len(after) == 1 else None
        return self.halves[token]

    def may_follow(self, left: int, right: int) -> bool:
        """Would no merge across the border of two sound tokens come before those that make them?"""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > 1_000_000:
                self.pairs.clear()
            known = self.pairs[key] = self._border(left, right)
        return known

    def _border(self, a: int, b: int) -> bool:
        """Undo the later of the two merges beside the border step by step; a merge across must come after all undone.

        On equal ranks the left one is done first, so the right one is undone first.
        """
        limit = None  # ranks below it are merged before what stands at the border is
        while True:
            across = self.ranks.get(self.bytes_of[a] + self.bytes_of[b])
            if across is not None and (limit is None or across < limit):
                return False
            byte_a, byte_b = len(self.bytes_of[a]) == 1, len(self.bytes_of[b]) == 1
            if byte_a and byte_b:
                return True
            if not byte_a and (byte_b or a > b):
                limit, a = a, self.split(a)[1]
            else:
                limit, b = b + 1, self.split(b)[0]


class Prefixes:
    """The table of one piece: last[i] is the last token of the encoding of the first i + 1 bytes."""

    def __init__(self, ranks: Ranks, data: bytes = b""):
        self.ranks, self.data, self.last = ranks, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        """Extend the piece; entries for what was there stay as they are."""
        self.data += more
        for end in range(len(self.last) + 1, len(self.data) + 1):
            self.last.append(self._last(end))

    def _last(self, end: int) -> int:
        get, pairs, data, last, ranks = self.ranks.ranks.get, self.ranks.pairs, self.data, self.last, self.ranks
        for begin in range(max(0, end - ranks.longest), end):
            token = get(data[begin:end])
            if token is None:
                continue
            if begin:
                fits = pairs.get(last[begin - 1] << 32 | token)
                if fits is None:
                    fits = ranks.split(token) is not None and ranks.may_follow(last[begin - 1], token)
            else:
                fits = ranks.split(token) is not None
            if fits:
                return token
        raise ValueError(f"byte {data[end - 1]} has no token")

    def splice(self, start: int, stop: int, new: bytes) -> int:
        """Replace bytes start to stop by new. Entries are computed anew from start until as many in a row as the
        longest token has bytes agree with the old ones behind the edit; the rest is kept. Gives how many were computed."""
        old, kept = self.last, self.data[stop:]
        self.data = self.data[:start] + new + kept
        self.last = old[:start]
        agree = done = 0
        shift = len(new) - (stop - start)
        while len(self.last) < len(self.data):
            end = len(self.last) + 1
            self.last.append(self._last(end))
            done += 1
            before = end - 1 - shift
            agree = agree + 1 if end > start + len(new) and old[before] == self.last[-1] else 0
            if agree > self.ranks.longest:
                self.last += old[before + 1 :]
                break
        return done

    def tokens(self) -> list[int]:
        out, at = [], len(self.data)
        while at:
            out.append(self.last[at - 1])
            at -= len(self.ranks.bytes_of[out[-1]])
        return out[::-1]


class Encoder:
    """tiktoken's ordinary encoding by prefix tables: a piece that is a token is that token, others go through the table.

    An automaton of all tokens gives the ones that end at each byte, so a whole piece's table is filled in one pass.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.known, self.ends = Ranks(ranks), ahocorasick.Automaton()
        for token, rank in ranks.items():
            if self.known.split(rank) is not None:
                self.ends.add_word(token.decode("latin-1"), (rank, len(token)))
        self.ends.make_automaton()

    def tokens(self, data: bytes) -> list[int]:
        pairs, fits = self.known.pairs, self.known.may_follow
        last: list[tuple[int, int] | None] = [None] * len(data)
        for end, found in self.ends.iter(data.decode("latin-1")):
            if last[end] is None:
                begin = end - found[1]
                if begin >= 0:
                    before = last[begin][0]
                    ok = pairs.get(before << 32 | found[0])
                    if ok is None:
                        ok = fits(before, found[0])
                    if not ok:
                        continue
                last[end] = found
        out, at = [], len(data) - 1
        while at >= 0:
            rank, n = last[at]
            out.append(rank)
            at -= n
        return out[::-1]

    def __call__(self, piece: str) -> bytes:
        data = piece.encode("utf-8", "surrogatepass")
        rank = self.known.ranks.get(data)
        ids = [rank] if rank is not None else self.tokens(data)
        return struct.pack(f"<{len(ids)}I", *ids)


class Pieces:
    """Ids of texts, by a table of the words met so far.

    A text is cut at single spaces and line breaks between two other characters, and before a comma or full stop between
    an ASCII letter and such a cut; the pattern always cuts there. The words of a slice of texts are hashed and looked up
    in an open-addressing table all at once, by 64 bits under a key of the process that cover bytes, length and whether a
    space stands before: with a million words in the table, about one lookup of a new word in 10**13 would meet another's
    key, whatever the texts are. New words are encoded and added. A text with white space side by side or at its end, or with bytes that may be white space beyond ASCII, is
    matched whole by the pattern.
    """

    def __init__(self, pattern: str, encode: Callable[[str], bytes], encode_words: Callable[[list[str]], list[bytes]] | None = None, limit: int = CACHE_PIECES):
        """encode gives the ids of one piece; encode_words, where it is quicker, those of many words of letters, each behind a space."""
        self.find, self.encode, self.encode_words, self.limit = regex.compile(pattern).findall, encode, encode_words, limit
        if any(self.find(x) != y for x, y in _CUT_SAMPLES.items()):
            raise ValueError("the pattern does not cut at spaces, line breaks and marks as this cache does")
        self.mask = np.uint64((1 << (2 * limit).bit_length()) - 1)
        self.fixed = {m: self.encode(m) for m in "\n,."}
        self._clear()

    def _clear(self) -> None:
        """The first three entries are the line break, comma and full stop."""
        self.keys, self.slots = np.zeros(int(self.mask) + 1, np.uint64), np.zeros(int(self.mask) + 1, np.int32)
        self.flat, self.begin, self.length, self.n = np.zeros(1 << 16, "<u4"), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 0
        self.known: dict[str, bytes] = {}
        self._append(list(self.fixed.values()))

    def _append(self, ids: list[bytes]) -> np.ndarray:
        """Store ids; gives their entries' numbers."""
        made = np.frombuffer(b"".join(ids), "<u4")
        length = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        start = int(self.begin[self.n - 1] + self.length[self.n - 1]) if self.n else 0
        while len(self.flat) < start + len(made):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self.begin) < self.n + len(ids):
            self.begin, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.length))
        self.flat[start : start + len(made)] = made
        at = np.arange(self.n, self.n + len(ids))
        self.begin[at], self.length[at] = start + np.cumsum(length) - length, length
        self.n += len(ids)
        return at

    def _lookup(self, keys: np.ndarray) -> np.ndarray:
        """Entries of keys, -1 for new ones."""
        out, todo, at = np.full(len(keys), -1, np.int64), np.arange(len(keys)), keys & self.mask
        while len(todo):
            there = self.keys[at]
            hit = there == keys[todo]
            out[todo[hit]] = self.slots[at[hit]]
            on = ~hit & (there != 0)
            todo, at = todo[on], (at[on] + np.uint64(1)) & self.mask
        return out

    def _insert(self, keys: np.ndarray, entries: np.ndarray) -> None:
        at = keys & self.mask
        while len(keys):
            free = np.flatnonzero(self.keys[at] == 0)
            _, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.keys[at[won]], self.slots[at[won]] = keys[won], entries[won]
            on = np.ones(len(keys), bool)
            on[won] = False
            keys, entries, at = keys[on], entries[on], (at[on] + np.uint64(1)) & self.mask

    def _whole(self, text: str) -> bytes:
        out, known = [], self.known
        for piece in self.find(text):
            ids = known.get(piece)
            if ids is None:
                if len(known) >= self.limit:
                    known.clear()
                ids = known[piece] = self.encode(piece)
            out.append(ids)
        return b"".join(out)

    def _new(self, words: list[str], lead: np.ndarray) -> list[bytes]:
        """Ids of words not met before; lead: no space stands before it."""
        made: list[bytes] = [b""] * len(words)
        plain = [i for i, w in enumerate(words) if _letters(w) and not lead[i]] if self.encode_words else []
        if plain:
            for i, ids in zip(plain, self.encode_words([words[i] for i in plain]), strict=True):
                made[i] = ids
        for i, w in enumerate(words):
            if not made[i]:
                text = w if lead[i] else " " + w
                made[i] = self.encode(text) if _letters(w) else self._whole(text)
        return made

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a slice in one array, and where each text's begin and end in it."""
        rows = len(offsets) - 1
        if not len(data):
            return np.zeros(0, "<u4"), np.zeros(rows + 1, np.int64)
        odd, blank = np.zeros(rows, bool), _BLANK[data]
        last = np.zeros(len(data) + 1, bool)
        last[offsets] = True
        follows = np.append(blank[1:], True) | last[1:]
        after = np.append(data[1:], 0)
        wide = _WIDE_BLANK[data] | ((data == 0xC2) & ((after == 0x85) | (after == 0xA0)))
        odd[np.searchsorted(offsets, np.flatnonzero((blank & follows) | wide), "right") - 1] = True

        chunks = Words(data, offsets, _CUTS)
        use = ~odd[chunks.row]
        start, end, row = chunks.start[use], chunks.end[use], chunks.row[use]
        lead = (data[np.maximum(start - 1, 0)] != 32) | last[start]
        mark = data[end - 1]
        split = ((mark == 44) | (mark == 46)) & (end - start > 1) & _ASCII_LETTER[data[end - 2]]
        end = end - split
        keys = mix(span_hashes(data, start, end, process_key()) ^ lead.astype(np.uint64))
        keys[keys == 0] = 1
        entries = self._lookup(keys)
        new = np.flatnonzero(entries < 0)
        if len(new):
            fresh, first, inverse = np.unique(keys[new], return_index=True, return_inverse=True)
            if self.n + len(fresh) > self.limit:
                self._clear()
                new = np.arange(len(keys))
                fresh, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
            at = new[first]
            raw = data.tobytes()
            made = self._append(self._new([raw[a:b].decode() for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)], lead[at]))
            self._insert(fresh, made)
            entries[new] = made[inverse]
        breaks = np.flatnonzero(data == 10)
        breaks = breaks[~odd[np.searchsorted(offsets, breaks, "right") - 1]]
        rows_odd = np.flatnonzero(odd)
        marked = end[split]
        whole = [self._whole(data[offsets[r] : offsets[r + 1]].tobytes().decode()) for r in rows_odd.tolist()]
        where = np.concatenate([start, marked, breaks, offsets[rows_odd]])
        entry = np.concatenate([entries, np.where(data[marked] == 44, 1, 2), np.zeros(len(breaks), np.int64), -1 - np.arange(len(rows_odd))])
        order = np.argsort(where, kind="stable")
        where, entry = where[order], entry[order]
        outside = entry < 0  # texts matched whole, whose ids stand behind those of the table
        extra = np.frombuffer(b"".join(whole), "<u4")
        extra_length = np.fromiter(map(len, whole), np.int64, len(whole)) // 4
        size = int(self.begin[self.n - 1] + self.length[self.n - 1])
        begin, counts = self.begin[entry], self.length[entry]
        begin[outside], counts[outside] = size + (np.cumsum(extra_length) - extra_length)[-1 - entry[outside]], extra_length[-1 - entry[outside]]
        flat = np.concatenate([self.flat[:size], extra]) if len(extra) else self.flat
        total = np.concatenate([[0], np.cumsum(counts)])
        ids = flat[np.repeat(begin - total[:-1], counts) + np.arange(total[-1])]
        return ids, total[np.searchsorted(where, offsets)]


#: What a pattern must do with these texts for the cuts to hold.
_CUT_SAMPLES = {"a b": ["a", " b"], "a\nb": ["a", "\n", "b"], "a, b": ["a", ",", " b"], "a.\nb": ["a", ".", "\n", "b"], "1 é": ["1", " é"], "! -": ["!", " -"], " a": [" a"]}
#: Letters of the Latin blocks, which every version of Unicode at hand has as letters.
_letters = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]+").fullmatch
_BLANK, _WIDE_BLANK, _CUTS, _ASCII_LETTER = (np.zeros(256, bool) for _ in range(4))
_BLANK[[*range(9, 14), *range(28, 33)]] = True
_WIDE_BLANK[[0xE1, 0xE2, 0xE3]] = True  # lead bytes of white space beyond U+00FF
_CUTS[[10, 32]] = True
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
#: Bytes of text whose words are looked up together; arrays of this length and wider ones are what a worker holds beside its table.
TOKEN_SLICE = 1 << 18


@functools.lru_cache(maxsize=2)
def rank_pieces(path: str, pattern: str) -> tuple[Pieces, np.ndarray]:
    """The encoder of a rank file with its caches, and the bytes of each id; kept while the worker process lives."""
    ranks = load_ranks(path)
    names = np.empty(max(ranks.values(), default=-1) + 1, object)
    for token, rank in ranks.items():
        names[rank] = token
    return Pieces(pattern, Encoder(ranks)), names


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """Encode every text and decode it again: key, n_tokens, ids_sha256, decoded_sha256, and ids array<long> if asked for.

    ids_sha256 is of the ids as little-endian unsigned 32-bit integers, decoded_sha256 of the bytes decoded from the ids.
    A null text is empty and has no ids. Rows are independent: repeated rows, null keys and other columns change
    nothing. Time is linear in a text's length for pieces of bounded length, and in a piece's length times the longest
    token for longer ones. ranks_path must be readable on every executor.
    """
    kind = docs.schema[key].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, names = rank_pieces(ranks_path, pattern)
        for batch in batches:
            counts, hashes, decoded, lists = [], [], [], []
            data, offsets = utf8(batch.column(1))
            for a, b in slices(offsets, TOKEN_SLICE):
                every, borders = pieces.ids(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                for x, y in zip(borders.tolist(), borders[1:].tolist()):
                    numbers = every[x:y]
                    counts.append(y - x)
                    hashes.append(hashlib.sha256(numbers).hexdigest())
                    decoded.append(hashlib.sha256(b"".join(names[numbers].tolist())).hexdigest())
                    if with_ids:
                        lists.append(numbers.astype(np.int64))
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())]
            columns += [pa.array(lists, pa.list_(pa.int64()))] if with_ids else []
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(columns)])

    made = map_arrow(docs.select(F.col(key).alias("key"), text_of(text).alias("body")), encode, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<long>" if with_ids else ""))
    return made.withColumnRenamed("key", key)
