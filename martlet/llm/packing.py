"""Packing token sequences into windows, by histogram and non-negative least squares.

Documents become token ids with an end id. A document's full windows are
sequences of their own; what is left of it, shorter than a window, is packed
with others. Rests are dealt to shards of about ``SHARD_BYTES`` of text by
seeded hashes, and each shard is packed by itself:

1. Lengths are counted in steps of ``UNIT`` tokens (rounded up) into a histogram.
2. The shallow combinations of lengths that fill a window are listed: up to
   three lengths, or one length several times with one other.
3. Non-negative least squares finds how often each combination should be used,
   so that their sum comes closest to the histogram.
4. The counts are rounded, and as many windows of whole rests are made as the
   shard has rests for.
5. The rests left over are laid end to end, longest first, into what rounding up
   left free in those windows, then into new windows; they are cut where a window
   is full. What remains at last, less than a window, becomes sequences whose
   lengths are powers of two. So no window needs padding, and only leftovers and
   documents of more than a window are cut.

Ids are those of the ``tokenizers`` library with the vocabulary file given. Its
merges are applied by ``tiktoken``, four times as fast, if the file's ids are in
the order of its merges, which gives the same ids; texts with a special token or
with very long runs go through ``tokenizers`` itself.

Defined cases: a null or empty text is the end id alone; rows of one id are
documents of their own; which of several equal rows lies where depends on how
the rows lie in files, all else on the rows only; a text of any length is packed
whole; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import functools
import json
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WINDOW = 2048
END_ID = 1
#: Tokens of one step of the histogram.
UNIT = 16
#: Bytes of text for each shard.
SHARD_BYTES = 32 << 20
#: Letters or spaces in a row that go to ``tokenizers``.
LONG_RUN = 2000
#: Documents that a task remembers to tell equal rows apart.
SEEN = 500_000


class Encoder:
    """Token ids of texts, the same as ``Tokenizer.encode(text, add_special_tokens=False).ids``."""

    def __init__(self, path: str):
        self.plain = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        self.special = [t["content"] for t in model["added_tokens"]]
        self.size = self.plain.get_vocab_size()
        self.fast = self._by_merges(model)

    @staticmethod
    def _by_merges(model: dict) -> tiktoken.Encoding | None:
        """The vocabulary as ranks, if its ids are the order of its merges."""
        vocab = model["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        if not all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(merges)):
            return None
        # Byte-level files write a byte as the printable letter it is, the others in order from 256 on.
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        letters = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        special = {t["content"] for t in model["added_tokens"]}
        ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items() if token not in special}
        return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _odd(self, text: str) -> bool:
        words = text.split()
        spaces = len(text) - sum(map(len, words)) - len(words)
        return spaces > LONG_RUN or len(max(words, key=len, default="")) > LONG_RUN or any(s in text for s in self.special)

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or self._odd(text):
            return np.array(self.plain.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return np.array(self.fast.encode_ordinary(text), dtype=np.uint32)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


@functools.lru_cache(maxsize=4)
def combinations(units: int) -> np.ndarray:
    """How often each combination (column) has each length of 1 to ``units`` steps (row)."""
    found = {((units, 1),)}
    for a in range(1, units):
        for times in range(1, units // a + 1):
            rest = units - times * a
            if rest == 0:
                found.add(((a, times),))
            elif rest != a:
                found.add(((a, times), (rest, 1)))
        for b in range(a + 1, (units - a) // 2 + 1):
            c = units - a - b
            if c > b:
                found.add(((a, 1), (b, 1), (c, 1)))
    # A pair of two single lengths is named twice; equal columns are one.
    columns = {tuple(sorted(x)) for x in found}
    out = np.zeros((units, len(columns)))
    for j, column in enumerate(sorted(columns)):
        for length, times in column:
            out[length - 1, j] = times
    return out


def non_negative_least_squares(a: np.ndarray, b: np.ndarray, steps: int = 1000) -> np.ndarray:
    """The x >= 0 with the least |a x - b|, by active sets."""
    n = a.shape[1]
    x, used = np.zeros(n), np.zeros(n, dtype=bool)
    small = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(steps):
        slope = a.T @ (b - a @ x)
        slope[used] = -np.inf
        best = int(slope.argmax())
        if slope[best] <= small:
            break
        used[best] = True
        while True:
            s = np.zeros(n)
            s[used] = np.linalg.lstsq(a[:, used], b, rcond=None)[0]
            low = used & (s <= 1e-12)
            if not low.any():
                break
            reach = np.full(n, np.inf)
            reach[low] = x[low] / np.maximum(x[low] - s[low], 1e-300)
            step = float(reach.min())
            x += step * (s - x)
            used &= ~(low & (reach <= step))
            x[~used] = 0
        x = s
    return x


def window_counts(lengths: np.ndarray, window: int = WINDOW, unit: int = UNIT) -> list[tuple[int, np.ndarray]]:
    """(times, row of the histogram's counts) of each combination used, most used first."""
    units = window // unit
    steps = -(-lengths // unit)
    left = np.bincount(steps, minlength=units + 1)[1:]
    a = combinations(units)
    x = non_negative_least_squares(a, left.astype(float))
    out = []
    for j in np.lexsort((np.arange(len(x)), -x)):
        times = int(np.floor(x[j] + 0.5))
        if not times:
            break
        need = a[:, j].astype(np.int64)
        times = min(times, int((left[need > 0] // need[need > 0]).min()))
        if times:
            left = left - times * need
            out.append((times, need))
    return out


def pack(lengths: np.ndarray, window: int = WINDOW, unit: int = UNIT) -> np.ndarray:
    """Pieces (item, from, length, sequence, offset) of items shorter than ``window``.

    Sequences are full, but for some at the end whose lengths are powers of two.
    """
    units = window // unit
    steps = -(-lengths // unit)
    queue = [np.flatnonzero(steps == u) for u in range(1, units + 1)]
    taken = [0] * units
    windows: list[list[int]] = []
    for times, need in window_counts(lengths, window, unit):
        rows = [[] for _ in range(times)]
        for u in np.flatnonzero(need):
            k = int(need[u])
            items = queue[u][taken[u] : taken[u] + times * k].tolist()
            taken[u] += times * k
            for i, row in enumerate(rows):
                row.extend(items[i * k : (i + 1) * k])
        windows += rows
    rest = [i for q, t in zip(queue, taken) for i in q[t:].tolist()]
    free = [window - int(lengths[w].sum()) for w in windows]
    spare, have = sum(free), int(lengths[rest].sum())
    # Leftovers must fill what the windows have free.
    while windows and have < spare:
        rest += windows.pop()
        spare -= free.pop()
        have = int(lengths[rest].sum())
    rest = np.array(sorted(rest, key=lambda i: (-int(lengths[i]), i)), dtype=np.int64)
    total = have - spare
    places = free + [window] * (total // window) + [1 << b for b in range(window.bit_length(), -1, -1) if total % window >> b & 1]
    sequences = np.arange(len(places))

    out = [np.zeros((0, 5), dtype=np.int64)]
    if windows:
        items = np.concatenate([np.array(w, dtype=np.int64) for w in windows])
        of = np.repeat(np.arange(len(windows)), [len(w) for w in windows])
        ends = np.cumsum(lengths[items])
        first = np.searchsorted(of, np.arange(len(windows)))
        begins = ends - lengths[items]
        out.append(np.stack([items, np.zeros_like(items), lengths[items], of, begins - begins[first][of]], axis=1))
    if len(rest):
        # Cut the leftovers, end to end, at their own ends and at those of the places.
        ends, filled = np.cumsum(lengths[rest]), np.cumsum(places)
        cuts = np.unique(np.concatenate([ends, filled]))
        begins = np.concatenate([[0], cuts[:-1]])
        item = np.searchsorted(ends, begins, side="right")
        place = np.searchsorted(filled, begins, side="right")
        offset = begins - (filled - np.array(places))[place] + np.where(place < len(free), window - np.array(places)[place], 0)
        out.append(np.stack([rest[item], begins - (ends - lengths[rest])[item], cuts - begins, sequences[place], offset], axis=1))
    return np.concatenate(out)


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def window_pieces(docs: DataFrame, id: str, window: int, vocabulary: str, end: int, with_ids: bool) -> DataFrame:
    """Every document cut at multiples of ``window``; ids travel as bytes where they are needed later."""
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[id].dataType)]
        + [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "copy")]
        + [T.StructField("tokens", T.BinaryType())]
    )

    def run(batches):
        encode, seen = encoder(vocabulary), {}
        width = "<u2" if max(encode.size, end + 1) <= 1 << 16 else "<u4"
        for batch in batches:
            rows = []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.append(encode.ids(text or ""), np.uint32(end))
                mark = (i, len(ids), _crc(ids))
                copy = seen[mark] = seen.get(mark, -1) + 1
                if len(seen) > SEEN:
                    seen.clear()
                for at in range(0, len(ids), window):
                    part = ids[at : at + window]
                    held = part.astype(width).tobytes() if with_ids or len(part) < window else None
                    rows.append((i, at, len(part), _crc(part), len(ids), copy, held))
                if len(rows) >= 4096:
                    yield _batch(rows, types)
                    rows = []
            yield _batch(rows, types)

    types = [batch_type(f.dataType) for f in schema]
    return docs.select(F.col(f"`{id}`").alias("doc_id"), "text").mapInArrow(run, schema)


def batch_type(kind: T.DataType) -> pa.DataType:
    known = {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.StringType(): pa.string(), T.BinaryType(): pa.binary()}
    return known[kind] if kind in known else pa.list_(pa.int32())


_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "copy", "tokens"]


def _batch(rows: list[tuple], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in types]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=_NAMES)


def packed_pieces(
    docs: DataFrame,
    id: str = "doc_id",
    window: int = WINDOW,
    unit: int = UNIT,
    vocabulary: str = VOCABULARY,
    end: int = END_ID,
    shard_bytes: int = SHARD_BYTES,
    with_ids: bool = False,
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece, and ``ids`` if asked for.

    ``window`` is a multiple of ``unit``, both powers of two; ``id`` is a long, int or string column.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = int(total // shard_bytes + 1)
    pieces = window_pieces(docs, id, window, vocabulary, end, with_ids)
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "copy"), F.lit(shards)))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    fields = [T.StructField("doc_id", docs.schema[id].dataType)] + [T.StructField(c, T.LongType()) for c in names[1:7]]
    schema = T.StructType(fields + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids)
    types = [batch_type(f.dataType) for f in schema]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("length", "doc_id", "start", "ids_crc32", "copy")])
        shard = table.column("shard")[0].as_py()
        key = table.column("doc_id").combine_chunks()
        start, length, crc, tokens = (table.column(c).to_numpy() for c in _NAMES[1:5])
        held = table.column("tokens").combine_chunks()
        rests = int(np.searchsorted(length, window))
        cut = pack(length[:rests], window, unit)
        whole = np.arange(rests, len(length))
        after = int(cut[:, 3].max()) + 1 if len(cut) else 0
        zero = np.zeros_like(whole)
        cut = np.concatenate([cut, np.stack([whole, zero, length[rests:], after + whole - rests, zero], axis=1)])
        item, at, n, sequence, offset = cut.T
        width = {len(held[i].as_py()) // int(length[i]) for i in range(min(1, rests))} or {2}
        kind = f"<u{width.pop()}"

        def ids(k: int) -> np.ndarray:
            return np.frombuffer(held[int(item[k])].as_py(), dtype=kind)[at[k] : at[k] + n[k]]

        sums = crc[item].copy()
        for k in np.flatnonzero(n < length[item]):
            sums[k] = _crc(ids(k))
        columns = [key.take(pa.array(item)), start[item] + at, n, sums, tokens[item], (shard << 32) + sequence, offset]
        if with_ids:
            columns.append([ids(k).astype(np.int32) for k in range(len(item))])
        return pa.Table.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return dealt.groupBy("shard").applyInArrow(run, schema)


def packed_sequences(docs: DataFrame, **options) -> DataFrame:
    """sequence_id, ids and the lengths of the pieces in them, one row for each sequence."""
    pieces = packed_pieces(docs, with_ids=True, **options)
    rows = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "length", "ids"))).alias("p"))
    return rows.select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.length").alias("lengths"))


def packing_digest(documents: DataFrame) -> DataFrame:
    """``op13``: every piece with its checksum and place."""
    return packed_pieces(documents)
