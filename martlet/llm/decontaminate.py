"""Benchmark decontamination by Wu-Manber search over words.

The patterns are all runs of ``WINDOW`` consecutive words of the benchmark
items; an item with fewer words is one pattern of its own length. Patterns of
one length share a table: a shift table keyed by blocks of up to ``BLOCK``
words says how far the window may move on, buckets keyed by the last block
hold the distinct patterns that end with it, and a direct comparison of the
words confirms an occurrence. A place is compared with one pattern of its
bucket, found by its words, so repeated words cost no more than others.

The benchmark is cut into parts of bounded size, an item longer than a part
into runs that overlap by ``WINDOW`` - 1 words. The parts pass through the
driver one at a time; each is sent to the executors and searched in a pass of
its own over all documents, whose hits are written. One part, the usual case,
needs no shuffle.

Defined cases: a null or empty text has no words and no hits; an item without
words is no pattern; a null item id counts for hits but is not listed; equal
ids are listed once; repeated rows are searched each on its own; an empty
table gives no rows and an empty benchmark no hits.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.llm._io import Scratch, set_aside
from martlet.llm._text import pieces, with_columns

WINDOW = 10
BLOCK = 3
#: Benchmark text, in bytes, that one pass sends to every executor.
PART_BYTES = 2 << 20

#: Lower-cases A-Z and turns every ASCII byte that is in no word into a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a UTF-8 text."""
    return text.translate(_FOLD).split() if text else []


class Patterns:
    """Shift table and buckets of all patterns of one length; equal patterns are one entry."""

    def __init__(self, length: int):
        self.length, self.block = length, min(BLOCK, length)
        self.far = length - self.block + 1
        self.shift: dict[bytes, int] = {}
        #: Patterns by their last block, then by their words, with the items that hold them.
        self.ends: dict[bytes, dict[bytes, list[int]]] = {}

    def add(self, item: int, words: list[bytes]) -> None:
        last = len(words) - 1
        for end in range(self.block - 1, len(words)):
            key = b" ".join(words[end - self.block + 1 : end + 1])
            # The nearest pattern end at or after this block, in any pattern that holds it.
            ahead = max(end, self.length - 1) - end
            if end + ahead <= last:
                self.shift[key] = min(ahead, self.shift.get(key, self.far))
            if end >= self.length - 1:
                run = b" ".join(words[end - self.length + 1 : end + 1])
                holders = self.ends.setdefault(key, {}).setdefault(run, [])
                if not holders or holders[-1] != item:  # items are added one after the other
                    holders.append(item)

    def find(self, words: list[bytes], hits: bytearray, items: set[int]) -> None:
        """Mark the words inside an occurrence in ``hits`` and add the items to ``items``."""
        n, m, b, far = len(words), self.length, self.block, self.far
        shift, ends, end = self.shift, self.ends, self.length - 1
        marked, met = 0, set()
        while end < n:
            key = b" ".join(words[end - b + 1 : end + 1]) if b > 1 else words[end]
            step = shift.get(key, far)
            if step == 0:
                run = b" ".join(words[end - m + 1 : end + 1])
                found = ends[key].get(run)
                if found is not None:
                    start = max(marked, end - m + 1)
                    marked = end + 1
                    hits[start:marked] = b"\x01" * (marked - start)
                    if run not in met:
                        met.add(run)
                        items.update(found)
                step = 1
            end += step


def build(items: list[tuple[str | None, bytes | None]], window: int = WINDOW) -> list[Patterns]:
    """Tables of all patterns. Runs cut from one item keep its length, if it has a window at all."""
    tables: dict[int, Patterns] = {}
    for number, (_, text) in enumerate(items):
        words = words_of(text)
        if words:
            length = min(window, len(words))
            tables.setdefault(length, Patterns(length)).add(number, words)
    return list(tables.values())


def _cut(window: int, run_bytes: int):
    """Items as rows of at most about ``run_bytes``: runs of whole words that overlap by
    ``window`` - 1 words, so that every window lies in a run and no run is short of one."""

    def run(batches):
        for batch in batches:
            ids, runs = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if len(text) <= run_bytes:
                    ids.append(item)
                    runs.append(text)
                    continue
                words = words_of(text)
                start = 0
                while start < len(words):
                    end, size = start, 0
                    while end < len(words) and (end - start < window or size < run_bytes):
                        size += len(words[end]) + 1
                        end += 1
                    ids.append(item)
                    runs.append(b" ".join(words[start:end]))
                    if end == len(words):
                        break
                    start = end - window + 1
            yield pa.record_batch([pa.array(ids, pa.string()), pa.array(runs, pa.binary())], names=["id", "text"])

    return run


def _parts(benchmark: DataFrame, part_bytes: int, window: int = WINDOW) -> Iterator[list[tuple[str | None, bytes]]]:
    """The benchmark in parts of about ``part_bytes``, collected one at a time.

    An item longer than a part is dealt in overlapping runs; runs of equal words are one.
    """
    items = benchmark.select(
        F.col("item_id").cast("string").alias("id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    )
    size, longest = items.agg(F.sum(F.octet_length("text")), F.max(F.octet_length("text"))).first()
    if (longest or 0) > part_bytes:
        items = Scratch(benchmark.sparkSession, "benchmark").keep(
            items.mapInArrow(_cut(window, part_bytes), items.schema), "runs"
        )
        size = items.agg(F.sum(F.octet_length("text"))).first()[0]
    n = max(1, -(-(size or 0) // part_bytes))
    part = F.pmod(F.xxhash64("id", "text"), F.lit(n))
    for k in range(n):
        yield [(r["id"], bytes(r["text"])) for r in items.filter(part == k).distinct().collect()]


#: The tables of the part that this worker searched last, by its broadcast.
_TABLES: dict[tuple, list[Patterns]] = {}


def _tables(part: str, items: list, window: int) -> list[Patterns]:
    if part not in _TABLES:
        _TABLES.clear()
        _TABLES[part] = build(items, window)
    return _TABLES[part]


def _search(docs: DataFrame, keep: list[str], items: list, window: int) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(items)
    part = uuid.uuid4().hex
    schema = T.StructType(
        [docs.schema[c] for c in keep]
        + [
            T.StructField("n_words", T.LongType()),
            T.StructField("hits", T.ArrayType(T.IntegerType())),
            T.StructField("items", T.ArrayType(T.StringType())),
        ]
    )

    def run(batches):
        ids = [i for i, _ in sent.value]
        tables = _tables(part, sent.value, window)
        for batch, texts in pieces(batches):
            counts, where, which = [], [], []
            for text in texts.to_pylist():
                words = words_of(text)
                hits, found = bytearray(len(words)), set()
                for table in tables:
                    table.find(words, hits, found)
                counts.append(len(words))
                where.append([i for i, hit in enumerate(hits) if hit] if found else [])
                which.append(sorted({ids[i] for i in found if ids[i] is not None}))
            yield with_columns(
                batch,
                keep,
                n_words=pa.array(counts, pa.int64()),
                hits=pa.array(where, pa.list_(pa.int32())),
                items=pa.array(which, pa.list_(pa.string())),
            )

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int = WINDOW, part_bytes: int = PART_BYTES
) -> DataFrame:
    """``keep`` columns of every document, ``n_words``, ``hits`` (numbers of the
    words inside any occurrence, from 0) and ``items`` (ids that occur, as sorted strings)."""
    parts = _parts(benchmark, part_bytes, window)
    items = next(parts)
    after = next(parts, None)
    if after is None:
        return _search(docs, keep, items, window)
    scratch = Scratch(docs.sparkSession, "decontaminate")
    numbered = scratch.keep(
        docs.select(*dict.fromkeys([*keep, "text"])).withColumn("_pos", F.monotonically_increasing_id()), "documents"
    )
    every = None
    for k, items in enumerate(itertools.chain([items, after], parts)):
        # A part's hits are written before the next part is collected.
        some = scratch.keep(_search(numbered, ["_pos"], items, window), f"part{k}")
        every = some if every is None else every.unionByName(some)
    merged = every.groupBy("_pos").agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return numbered.select(*keep, "_pos").join(merged, "_pos").drop("_pos")


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a single hit, their columns unchanged."""
    docs, back = set_aside(docs, "text")
    return back(find_benchmark(docs, benchmark, docs.columns).filter(F.size("hits") == 0))


def contamination_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``op4``: hit words and occurring items of every document."""
    return find_benchmark(docs, benchmark, ["doc_id"]).select(
        "doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )
