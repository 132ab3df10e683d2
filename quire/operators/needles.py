"""Many known passages looked up in many texts: Aho-Corasick automata, cut into shards by bytes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.storage import hinted, settled

#: Bytes of the passages of one automaton, about; an automaton takes some 50 times as much memory.
SHARD_BYTES = 4 << 20
#: Matches of one batch of rows.
ROWS = 10_000

_made: dict[str, object] = {}


def _automaton(name: str, needles: dict[str, int]):
    """The automaton of a shard, kept while the worker works on that shard."""
    if name not in _made:
        import ahocorasick

        _made.clear()
        _made[name] = a = ahocorasick.Automaton()
        for text, number in needles.items():
            a.add_word(text, (number, len(text)))
        a.make_automaton()
    return _made[name]


def occurrences(docs: DataFrame, needles: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(needle, doc, start): each place where the text of needles (needle, text) stands in that of docs (doc, text).

    start counts characters from 0; places may overlap, of one needle as of several. Null and empty texts match nothing, needles
    of one text match alike. The driver takes the passages shard by shard, of shard_bytes on average, and every text is read
    once for each shard, from end to end in one pass whatever the number of passages.
    """
    known = needles.where("text <> ''").select("text").distinct()
    shards = max(1, -(-(known.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]) // shard_bytes))
    known = settled(known.withColumns({"number": F.monotonically_increasing_id(), "shard": F.pmod(F.xxhash64("text"), F.lit(shards))}))
    kind, rows, found = docs.schema["doc"].dataType.simpleString(), docs.where("text <> ''").select("doc", "text"), None
    for shard in range(shards):
        some = known.where(F.col("shard") == shard).select("text", "number").toArrow()
        words = dict(zip(some.column("text").to_pylist(), some.column("number").to_pylist(), strict=True))
        if words:
            part = rows.mapInArrow(_search(f"{id(words)}-{shard}-{len(words)}-{hash(frozenset(words))}", words), f"doc {kind}, number long, start long")
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = rows.sparkSession.createDataFrame([], f"doc {kind}, number long, start long")
    named = hinted(needles.join(known.select("text", "number"), "text").select("needle", "number"))
    return found.join(named, "number").select("needle", "doc", "start")


def _search(name: str, words: dict[str, int]):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(name, words)
        for batch in batches:
            at, numbers, starts = [], [], []

            def made() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(numbers, pa.int64()), pa.array(starts, pa.int64())], names=["doc", "number", "start"])

            for i, text in enumerate(batch.column(1)):
                for end, (number, length) in automaton.iter(text.as_py()):
                    at.append(i)
                    numbers.append(number)
                    starts.append(end + 1 - length)
                    if len(at) == ROWS:
                        yield made()
                        at, numbers, starts = [], [], []
            yield made()

    return search
