"""Personal data: base patterns, and a skip-chain conditional random field that makes labels consistent in a document.

Nodes are the words with a digit or an @. Neighbouring words share a chain potential; words with the same normal form, or
with a like one (digits that end alike, one domain, one local part, one network), share a skip potential, however far apart:
open words with each label that a base pattern confirms for their form, or, if there is none, with the like word before. A
number may be written in several words: runs of up to SEGMENT_WORDS have forms as well, of all their digits, and each of their
words shares in the run's edges. Loopy belief propagation gives each node's label; words that a base pattern confirms are
observed.

The potentials are fitted by the gradient of the likelihood, with the expectations of loopy belief propagation, on a bounded
sample; nothing is labelled by hand. Labels are the base patterns' own, and to the end of each sample text some of what they
confirm there is added in writings that they do not know, with its label, and as many drawn numbers and names in the same
writings, which are none. So the skip potentials learn what a repeat in another writing is worth, whatever its shape. A word
is found by its shape and neighbours, where a pattern's match failed for what stands beside it, or by a like word that is
confirmed. What is found must still
have the form of its kind: a card's digits and check sum, four numbers of an address, digits of a telephone number; and
without a confirmed like word also its usual writing.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, cut, map_arrow, slices, text_of, utf8

KINDS = ("email", "ip", "card", "phone")
LABELS = ("", *KINDS)
#: Different documents that the fit reads at most, on average, and the bytes after which it takes no further one. Texts are whole.
SAMPLE_DOCS, SAMPLE_BYTES = 2000, 40_000_000
#: Kinds of skip edges: the same normal form of at least LONG_FORM characters, the same shorter one, a like one.
SAME, SHORT, LIKE = 0, 1, 2
LONG_FORM = 7
#: The priors of the potentials: skip potentials of agreement by kind of edge, the others nought; and their spreads.
SKIP_PRIOR, SKIP_SPREAD, SPREAD = (0.0, 0.0, 0.0), 5.0, 3.0
#: Words of one number at most, and the digits that a number of several words has.
SEGMENT_WORDS, SEGMENT_DIGITS = 5, (9, 19)
#: Confirmed spans of a sample text that are added to it in another writing at most.
PLANTED = 4
STEPS, RATE = 120, 0.15
#: Messages are passed until none changes by SETTLED, at most ROUNDS times; in the fit, from where they were, FIT_ROUNDS times.
ROUNDS, SETTLED, DAMPING, FIT_ROUNDS = 200, 1e-4, 0.3, 12

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_EDGE = ".,;:!?\"'()[]{}<>"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each @ outwards: linear also in long runs without one."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, sorted; kind is a number into KINDS."""
    found = [(a, 0, b) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def doubtful(text: str) -> list[tuple[int, int]]:
    """Spans of several words that a base pattern matched and dropped: their words may be data whose match took in too much."""
    kept = {(a, b) for a, _, b in base_spans(text)}
    found = [m.span() for p in (_CARD, *([_PHONE] if "+" in text else [])) for m in p.finditer(text)]
    return [x for x in found if x not in kept and " " in text[x[0] : x[1]]]


def key_of(word: str) -> str | None:
    """The normal form by which words are alike: the digits of a word without letters, else its letters, digits and @."""
    digits = _NOT_DIGIT.sub("", word)
    if not any(c.isalpha() for c in word):
        return digits if len(digits) >= 3 else None
    form = "".join(c for c in word.lower() if c.isalnum() or c == "@")
    return form if len(form) >= 6 else None


def like_forms(word: str) -> list[str]:
    """Weaker normal forms: the last seven digits of a number, domain and local part of an address, the network of four numbers."""
    at = word.strip(_EDGE).lower().rpartition("@")
    if at[1]:
        return ([f"@{at[2]}"] if at[0] and "." in at[2] else []) + ([f"l{at[0]}"] if len(at[0]) >= 4 and at[2] else [])
    if any(c.isalpha() for c in word):
        return []
    digits, numbers = _NOT_DIGIT.sub("", word), re.findall("[0-9]+", word)
    if len(numbers) == 4 and all(len(x) <= 3 for x in numbers):
        return ["n" + ".".join(numbers[:3])]
    return [f"t{digits[-7:]}"] if len(digits) >= 7 else []


def shape(word: str, before: str, after: str) -> list[float]:
    """Features of a word; before and after are the words beside it if they are nodes too, else empty."""
    bare = word.strip(_EDGE)
    digits = _NOT_DIGIT.sub("", word)
    letters = any(c.isalpha() for c in word)
    n = len(digits) if "@" not in word else -1  # how many digits an address holds tells nothing
    return [1, "@" in word, "@" in word and "." in word.rpartition("@")[2], word[0] == "+", word[0] == "(", 0 <= n <= 2, n == 3, 4 <= n <= 6, n == 7, 8 <= n <= 11, 12 <= n <= 19, n > 19, bare.count(".") == 3 and not letters, letters, "-" in bare, 12 <= n <= 19 and luhn(digits), before[:1] == "+", before[:1] == "(", after[:1] == "("]


N_FEATURES = len(shape("0", "", ""))


class Potentials(NamedTuple):
    unary: np.ndarray  # features x labels
    chain: np.ndarray  # labels x labels
    skip: np.ndarray  # kinds of skip edges x labels, for two words that agree


class Graph(NamedTuple):
    """A document's nodes: spans of words, features, the base labels (0: none), and edges by node numbers.

    skip: like words, each with the one before, and the kind of edge. hubs: open nodes with the labels that like words are
    confirmed to have, each label once, and the kind; as those are observed, open words do not answer for each other.
    truth: in a sample, the labels to fit where they are not the base ones.
    """

    spans: list[tuple[int, int]]
    features: np.ndarray
    seen: np.ndarray
    chain: np.ndarray
    skip: np.ndarray
    hubs: np.ndarray
    truth: np.ndarray | None = None


def graph(text: str, spans: list[tuple[int, int]], neighbours: list[bool], base: list[tuple[int, int, int]]) -> Graph:
    """spans: the words that are nodes, in order; neighbours[i]: is word i directly after word i - 1."""
    words = [text[a:b] for a, b in spans]
    n = len(words)
    features = np.array([shape(w, words[i - 1] if i and neighbours[i] else "", words[i + 1] if i + 1 < n and neighbours[i + 1] else "") for i, w in enumerate(words)], float).reshape(n, N_FEATURES)
    seen, starts = np.zeros(n, np.int64), np.array([a for a, _ in spans])
    ends = np.array([b for _, b in spans])
    for a, kind, b in base:
        seen[np.searchsorted(ends, a, "right") : np.searchsorted(starts, b, "left")] = kind + 1
    chain = [(i - 1, i) for i in range(1, n) if neighbours[i]]
    digits = [_NOT_DIGIT.sub("", w) if not any(c.isalpha() or c == "@" for c in w) else None for w in words]
    last: dict[str, int] = {}
    held: dict[str, set[int]] = {}
    skip: list[tuple[int, int, int]] = []
    forms: list[list[tuple[int, str]]] = [[] for _ in words]
    for i, w in enumerate(words):
        key = key_of(w)
        mine = [(f"={key}", SAME if len(key) >= LONG_FORM else SHORT, range(i, i + 1))] if key else []
        if w.strip(_EDGE)[:1] == "+" and digits[i]:  # a number is also the number without its country code
            mine += [(f"={digits[i][k:]}", SAME, range(i, i + 1)) for k in (1, 2, 3) if len(digits[i]) - k >= LONG_FORM]
        mine += [(x, LIKE, range(i, i + 1)) for x in like_forms(w)]
        whole, at = digits[i], i
        while whole is not None and at and neighbours[at] and digits[at - 1] is not None and i - at + 2 <= SEGMENT_WORDS:
            at -= 1
            whole = digits[at] + whole
            if len(whole) > SEGMENT_DIGITS[1]:
                break
            if len(whole) >= SEGMENT_DIGITS[0]:
                mine += [(f"={whole}", SAME, range(at, i + 1)), (f"t{whole[-7:]}", LIKE, range(at, i + 1))]
        linked = set()
        for form, kind, members in mine:
            before = last.get(form)
            if before is not None and before not in members:
                for m in members:  # of two edges between two words, the stronger
                    if (before, m) not in linked:
                        linked.add((before, m))
                        skip.append((before, m, kind))
            labels = {int(seen[m]) for m in members}
            if len(labels) == 1 and 0 not in labels:
                held.setdefault(form, set()).update(labels)
            for m in members:
                forms[m].append((kind, form))
        for form, *_ in mine:
            last[form] = i
    hubs = []
    for i, mine in enumerate(forms):
        known: set[int] = set()
        for kind, form in sorted(mine) if not seen[i] else ():
            hubs += [(i, label, kind) for label in sorted(held.get(form, set()) - known)]
            known |= held.get(form, set())
    three = lambda x: np.array(x, np.int64).reshape(-1, 3)
    return Graph(spans, features, seen, np.array(chain, np.int64).reshape(-1, 2), three(skip), three(hubs))


class Field:
    """Messages on the edges of one or more graphs, in logs."""

    def __init__(self, nodes: int, chain: np.ndarray, skip: np.ndarray):
        self.chain, self.skip, k = chain, skip, len(LABELS)
        edges = np.concatenate([chain, skip[:, :2]])
        self.source, self.target = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
        self.back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        self.nodes, self.messages = nodes, np.zeros((2 * len(edges), k))

    def tables(self, model: Potentials) -> np.ndarray:
        """The potentials of each edge, labels x labels."""
        k = len(LABELS)
        agree = np.zeros((len(self.skip), k, k))
        agree[:, np.arange(k), np.arange(k)] = model.skip[self.skip[:, 2]]
        return np.concatenate([np.broadcast_to(model.chain, (len(self.chain), k, k)), agree])

    def totals(self, unary: np.ndarray) -> np.ndarray:
        out = unary.copy()
        np.add.at(out, self.target, self.messages)
        return out

    def settle(self, unary: np.ndarray, tables: np.ndarray, rounds: int) -> np.ndarray:
        """Damped sum-product until the messages settle; gives each node's label probabilities."""
        both = np.concatenate([tables, tables.transpose(0, 2, 1)])
        for _ in range(rounds):
            out = (self.totals(unary)[self.source] - self.messages[self.back])[:, :, None] + both
            top = out.max(1)
            out = top + np.log(np.exp(out - top[:, None, :]).sum(1))
            out -= out.max(1, keepdims=True)
            before, self.messages = self.messages, DAMPING * self.messages + (1 - DAMPING) * out
            if np.abs(self.messages - before).max(initial=0) < SETTLED:
                break
        return _normal(self.totals(unary), 1)

    def pairs(self, unary: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Probabilities of the labels of each edge's two ends."""
        n, total = len(tables), self.totals(unary)
        out = tables + (total[self.source[:n]] - self.messages[self.back[:n]])[:, :, None] + (total[self.target[:n]] - self.messages[:n])[:, None, :]
        return _normal(out.reshape(n, -1), 1).reshape(out.shape)


def _normal(x: np.ndarray, axis: int) -> np.ndarray:
    p = np.exp(x - x.max(axis, keepdims=True, initial=-1e300))
    return p / p.sum(axis, keepdims=True)


def fit(graphs: list[Graph]) -> Potentials:
    """Potentials of the greatest posterior: the observed labels' likelihood, its expectations by loopy belief propagation."""
    k = len(LABELS)
    first = np.cumsum([0] + [len(g.spans) for g in graphs])
    joined = lambda name, width, ends: np.concatenate([np.zeros((0, width), np.int64), *(np.concatenate([getattr(g, name)[:, :ends] + f, getattr(g, name)[:, ends:]], 1) for g, f in zip(graphs, first))])
    x = np.concatenate([np.zeros((0, N_FEATURES)), *(g.features for g in graphs)])
    y = np.concatenate([np.zeros(0, np.int64), *(g.seen if g.truth is None else g.truth for g in graphs)])
    field = Field(len(y), joined("chain", 2, 2), joined("skip", 3, 2))
    n, prior = len(field.chain), np.repeat(np.array(SKIP_PRIOR)[:, None], k, 1)
    observed, one = np.eye(k)[y], np.eye(k)
    pairs = one[y[field.source[: len(field.chain) + len(field.skip)]]][:, :, None] * one[y[field.target[: len(field.chain) + len(field.skip)]]][:, None, :]
    values = [np.zeros((N_FEATURES, k)), np.zeros((k, k)), prior.copy()]
    moments = [(np.zeros_like(v), np.zeros_like(v)) for v in values]
    for step in range(1, STEPS + 1 if len(y) else 1):
        model = Potentials(*values)
        unary, tables = x @ model.unary, field.tables(model)
        off = observed - field.settle(unary, tables, FIT_ROUNDS)
        wrong = pairs - field.pairs(unary, tables)
        agree = np.zeros((len(SKIP_PRIOR), k))
        np.add.at(agree, field.skip[:, 2], np.diagonal(wrong[n:], axis1=1, axis2=2))
        slopes = [x.T @ off - model.unary / SPREAD**2, wrong[:n].sum(0) - model.chain / SPREAD**2, agree - (model.skip - prior) / SKIP_SPREAD**2]
        for v, g, (m, q) in zip(values, slopes, moments, strict=True):
            m += 0.1 * (g - m)
            q += 0.01 * (g**2 - q)
            v += RATE * (m / (1 - 0.9**step)) / (np.sqrt(q / (1 - 0.99**step)) + 1e-9)
    return Potentials(*values)


def beliefs(g: Graph, model: Potentials) -> np.ndarray:
    """Label probabilities of each node; what a base pattern confirms is certain."""
    unary, confirmed = g.features @ model.unary, g.seen > 0
    unary[confirmed] = -30
    unary[confirmed, g.seen[confirmed]] = 0
    np.add.at(unary, (g.hubs[:, 0], g.hubs[:, 1]), model.skip[g.hubs[:, 2], g.hubs[:, 1]])  # what an observed node sends
    free = ~confirmed
    free[g.hubs[:, 0]] = False
    field = Field(len(unary), g.chain, g.skip[free[g.skip[:, :2]].all(1)])
    return field.settle(unary, field.tables(model), ROUNDS)


#: The written form of each kind, which a word without a confirmed like word must have.
_WRITTEN = (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), _IP, _CARD, _PHONE)


def fits(word: str, kind: int, like: bool, tails: set[str]) -> bool:
    """Has a word the form of its kind? Where a like word is confirmed (like), in any writing. tails: the last seven digits
    of confirmed telephone numbers."""
    if not like and not _WRITTEN[kind].fullmatch(word):
        return False
    digits, numbers = _NOT_DIGIT.sub("", word), re.findall("[0-9]+", word)
    if kind == 0:
        local, _, domain = word.rpartition("@")
        return bool(local) and ("." in domain.strip(".") or like and bool(domain.strip(".")))
    if kind == 1:
        return len(numbers) == 4 and all(len(x.lstrip("0")) <= 3 and int(x[-4:]) <= 255 for x in numbers)
    if kind == 2:
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 or digits[-7:] in tails and 7 <= len(digits) <= 15


def added_spans(text: str, g: Graph, model: Potentials, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Runs of neighbouring open nodes with one label that have the form of their kind, else single words of them, without
    punctuation at the ends and where no base span is."""
    if (g.seen > 0).all():
        return []
    p = beliefs(g, model)
    label = np.where(p[:, 0] < 0.5, p[:, 1:].argmax(1) + 1, 0)
    label[g.seen > 0] = 0
    beside = np.zeros(len(label), bool)
    beside[g.chain[:, 1]] = True
    supported = {(int(i), int(kind)) for i, kind, _ in g.hubs}
    tails = {_NOT_DIGIT.sub("", text[a:b])[-7:] for a, kind, b in base if kind == 3}
    starts, ends = np.array([x[0] for x in sorted(base)], np.int64), np.maximum.accumulate(np.array([x[2] for x in sorted(base)], np.int64))

    def taken(a: int, b: int) -> bool:
        i = np.searchsorted(starts, b)  # base spans that begin before b
        return i > 0 and ends[i - 1] > a

    out, i = [], 0
    while i < len(label):
        j = i + 1
        while j < len(label) and label[j] == label[i] and beside[j]:
            j += 1
        if label[i]:
            kind = int(label[i]) - 1
            for x, y in [(i, j), *((m, m + 1) for m in range(i, j))] if j > i + 1 else [(i, j)]:
                a, b = g.spans[x][0], g.spans[y - 1][1]
                strip = _EDGE if kind != 3 else ".,;:!?\"'[]{}<>"
                a, b = a + len(text[a:b]) - len(text[a:b].lstrip(strip)), b - (len(text[a:b]) - len(text[a:b].rstrip(strip)))
                like = any((m, kind + 1) in supported for m in range(x, y))
                if a < b and fits(text[a:b], kind, like, tails) and not taken(a, b):
                    out.append((a, kind, b))
                    if (x, y) == (i, j):
                        break
        i = j
    return out


_node = np.zeros(256, bool)
_node[[*range(48, 58), 64]] = True
_lead = (np.arange(256) & 0xC0) != 0x80


def nodes(data: np.ndarray, offsets: np.ndarray) -> list[tuple[list[tuple[int, int]], list[bool]] | None]:
    """For each text: the code point spans of words with a digit or @, and which directly follow the one before; None if none."""
    words = Words(data, offsets)
    marks = np.concatenate([[0], np.cumsum(_node[data])])
    at = np.flatnonzero(marks[words.end] > marks[words.start])
    out: list = [None] * (len(offsets) - 1)
    if len(at):
        points = np.concatenate([[0], np.cumsum(_lead[data])])
        row, zero = words.row[at], points[offsets[words.row[at]]]
        start, end = (points[words.start[at]] - zero).tolist(), (points[words.end[at]] - zero).tolist()
        after = np.concatenate([[False], (at[1:] == at[:-1] + 1) & (row[1:] == row[:-1])]).tolist()
        borders = np.concatenate([[0], np.flatnonzero(row[1:] != row[:-1]) + 1, [len(at)]]).tolist()
        for a, b in zip(borders, borders[1:]):
            out[row[a]] = (list(zip(start[a:b], end[a:b], strict=True)), after[a:b])
    return out


def find(text: str, held: tuple[list[tuple[int, int]], list[bool]] | None, model: Potentials) -> tuple[list, list]:
    """Base and added spans (start, kind, end) of a text, given its nodes."""
    if held is None:
        return [], []
    base = base_spans(text)
    return base, added_spans(text, graph(text, *held, base), model, base)


def train(docs: DataFrame, text: str = "text") -> Potentials:
    """Fit on whole documents with a digit or @: of equal texts one, and of different ones those with the smallest hashes, so
    that SAMPLE_DOCS are expected, until SAMPLE_BYTES are reached. No task gathers or sorts more than hashes before that."""
    rows = docs.select(text_of(text).alias("body")).where(F.col("body").rlike("[0-9@]")).select("body", F.xxhash64("body").alias("h"))
    known = rows.select("h").distinct().count()
    below = -(1 << 63) + min((1 << 64) - 1, (SAMPLE_DOCS << 64) // max(1, known))
    sample = cut(rows.where(F.col("h") <= below).dropDuplicates(["h"]), "pii-sample")
    order = sample.select("h", F.octet_length("body").alias("bytes")).toArrow().sort_by("h")
    inside = np.flatnonzero(np.cumsum(np.concatenate([[0], np.asarray(order.column("bytes"))[:-1]])) < SAMPLE_BYTES) if order.num_rows else []
    last = order.column("h")[len(inside) - 1].as_py() if len(inside) else -(1 << 63)
    texts = sample.where(F.col("h") <= last).toArrow().sort_by("h").column("body").to_pylist()
    rng = np.random.default_rng(17)
    return fit([g for t in texts if (g := sampled(*planted(t, rng))) is not None])


def sampled(text: str, marks: list[tuple[int, int, int]]) -> Graph | None:
    """The graph of a sample text with the labels to fit; marks: (start, end, label) of what was added to it."""
    held = nodes(*utf8(pa.array([text], pa.large_string())))[0]
    if not held:
        return None
    spans, neighbours = certain(text, *held, [(a, b) for a, b, _ in marks])
    if not spans:
        return None
    g = graph(text, spans, neighbours, base_spans(text))
    truth = g.seen.copy()
    for a, b, label in marks:
        inside = [i for i, (x, y) in enumerate(spans) if x < b and a < y and not g.seen[i]]
        truth[inside] = label
    return g._replace(truth=truth)


def rewritten(kind: int, word: str, rng: np.random.Generator) -> str:
    """Personal data in a writing that the base patterns do not know."""
    digits = _NOT_DIGIT.sub("", word)
    sign = lambda *signs: signs[rng.integers(len(signs))]
    if kind == 0:
        local, _, domain = word.rpartition("@")
        return f"{local}@{domain.split('.')[0]}"
    if kind == 1:
        return sign("-", "[.]", ":", "_").join(re.findall("[0-9]+", word))
    if kind == 2:
        return sign(".", "/", "_").join(digits[i : i + 4] for i in range(0, len(digits), 4))
    own = (digits, digits[-10:], digits[-7:])[rng.integers(3)]  # with and without country, and within a place
    if rng.random() < 0.3:
        return own
    parts = [own[:-7], own[-7:-4], own[-4:]]
    return sign(" ", "-", ".", "/").join(x for x in parts if x)


def planted(text: str, rng: np.random.Generator) -> tuple[str, list[tuple[int, int, int]]]:
    """text with confirmed spans repeated in other writings at its end, and drawn ones in the same writings; and their marks."""
    base = base_spans(text)
    if not base:
        return text, []
    words, marks, out = text[:10_000].split() or ["-"], [], [text]
    at = len(text)
    word = lambda: words[rng.integers(len(words))]
    for i in rng.permutation(len(base))[:PLANTED]:
        a, kind, b = base[i]
        # Drawn ones have other digits, and of an address other letters.
        drawn = "".join(str(rng.integers(10)) if c.isdigit() else chr(97 + rng.integers(26)) if kind == 0 and c.isalpha() else c for c in text[a:b])
        drawn = [] if kind == 2 and luhn(_NOT_DIGIT.sub("", drawn)) else [(rewritten(kind, drawn, rng), 0)]  # a check sum that holds tells nothing
        for new, label in ((rewritten(kind, text[a:b], rng), kind + 1), *drawn):
            before = f" {word()} "
            out += [before, new, f" {word()}"]
            marks.append((at + len(before), at + len(before) + len(new), label))
            at += sum(map(len, out[-3:]))
    return "".join(out), marks


def certain(text: str, spans: list[tuple[int, int]], neighbours: list[bool], known: list[tuple[int, int]] = ()) -> tuple[list[tuple[int, int]], list[bool]]:
    """Nodes and neighbours without the nodes in doubtful spans that no base span confirms: no label of theirs is known. known:
    further spans whose nodes stay."""
    doubt = doubtful(text)
    if not doubt:
        return spans, neighbours
    sure = [*((a, b) for a, _, b in base_spans(text)), *known]
    kept = [not any(x < b and a < y for x, y in doubt) or any(x < b and a < y for x, y in sure) for a, b in spans]
    return [x for x, k in zip(spans, kept, strict=True) if k], [bool(n and i and kept[i - 1]) for i, (n, k) in enumerate(zip(neighbours, kept, strict=True)) if k]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def _each(batch: pa.RecordBatch, column: int, model: Potentials) -> Iterator[tuple[str, list, list]]:
    data, offsets = utf8(batch.column(column))
    for a, b in slices(offsets):
        held = nodes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        for i in range(a, b):
            t = batch.column(column)[i].as_py() if held[i - a] else ""
            yield t, *find(t, held[i - a], model)


def find_pii(docs: DataFrame, model: Potentials, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: key, n_email, n_ip, n_card, n_phone, base_sha256, spans, found.

    The counts and base_sha256 are of the base spans; spans (a string) and found (array<struct<kind, start, end, added>>)
    have all, in code points, end exclusive. A null text is empty and has none. Rows are searched each on its own: repeated
    rows and null keys change nothing; other columns are not read. Whole texts are searched, in time linear in their length.
    """
    kind = docs.schema[key].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, hashes, all_spans, found = [[] for _ in KINDS], [], [], []
            for _, base, added in _each(batch, 1, model):
                for k, c in enumerate(counts):
                    c.append(sum(x[1] == k for x in base))
                hashes.append(hashlib.sha256(joined(base).encode()).hexdigest())
                all_spans.append(joined(base + added))
                found.append([{"kind": KINDS[k], "start": a, "end": b, "added": x >= len(base)} for x, (a, k, b) in enumerate(base + added)])
            struct = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("added", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(hashes, pa.string()), pa.array(all_spans, pa.string()), pa.array(found, struct)], names=["key", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "found"])

    schema = f"key {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, found array<struct<kind: string, start: int, end: int, added: boolean>>"
    return map_arrow(docs.select(F.col(key).alias("key"), text_of(text).alias("body")), apply, schema).withColumnRenamed("key", key)


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Every span replaced by its kind in brackets; overlapping ones by the first one's."""
    out, at = [], 0
    for a, k, b in sorted(spans):
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: Potentials, text: str = "text") -> DataFrame:
    """docs with personal data in text replaced; null texts stay null, other columns and all rows stay as they are."""
    at, schema = docs.columns.index(text), docs.schema

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        for batch in batches:
            filled = pa.RecordBatch.from_arrays([pc.fill_null(batch.column(at).cast(pa.string()), "")], names=["t"])
            new = batch.column(at).to_pylist()
            for i, (t, base, added) in enumerate(_each(filled, 0, model)):
                if base or added:
                    new[i] = redacted(t, base + added)
            columns = list(batch.columns)
            columns[at] = pa.array(new, pa.string()).cast(batch.column(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return map_arrow(docs, apply, schema)
