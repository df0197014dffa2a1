"""Exact removal of repeated byte strings, shard by shard with suffix arrays.

Every string of ``LENGTH`` bytes names one of its ``GRAM``-byte grams, the one
with the least hash (the last of equals), its anchor. Neighbouring strings of a
text that name the same anchor form a segment. Equal strings name equal
anchors, so segments are dealt to shards by their anchor's hash, and what
repeats across documents meets in one shard without comparing all shards.

Segments that are equal as a whole (128 bits of hash) repeat the first of
them. Of those that only share the anchor, the first of each kind goes on with
its bytes: a shard joins them, sorts a suffix array by Larsson-Sadakane
refinement, compares neighbours, and marks all but the first of equal strings.
An array of up to ``ARRAY_BYTES`` holds whole anchors, and as equal strings
have one anchor, arrays need not be compared with each other.

Each task merges what repeats within its own texts before the shuffle, so a
segment that a third of all rows holds sends one row per task. A passage in
differing contexts still sends a segment for each document, all of one anchor.
Anchors with more than ``HOT_ROWS`` segments are therefore not dealt as one:
their segments are dealt by their own hash, and their strings one by one by
128 bits of hash, an aggregate whose least position is the first of equals.

Order is doc_id, then start. Defined cases: null texts are empty; texts under
``LENGTH`` bytes keep every byte; rows equal in id and text are one document
with one result each; of rows that share only the id, the one whose text
hashes lower comes first; a null id comes before all others; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm._hash import mix, powers, prefix_sums, run_hashes
from martlet.llm._io import Scratch
from martlet.llm._text import joined_bytes, pieces, with_columns

LENGTH = 100
GRAM = 32
#: Text bytes for each shard of anchors.
SHARD_BYTES = 24 << 20
#: Bytes that one suffix array sorts.
ARRAY_BYTES = 2 << 20
#: Segments of one anchor that go to one task; so many fill an array at most.
HOT_ROWS = ARRAY_BYTES // (2 * LENGTH - GRAM)
#: Anchor rows that a task merges before it sends them.
MERGE_ROWS = 600_000

#: A longer text is searched in slices that overlap by a string less one byte.
SLICE_BYTES = 4 << 20

_LOW = np.uint64(0x7FFFFFFF)
#: Other numbers for the bytes, for a second hash.
_OTHER = mix(np.arange(256, dtype=np.uint64), 77)


def anchors(data: np.ndarray, bounds: np.ndarray):
    """Segments of a piece: (text number, first string start, bytes, anchor hash, segment hash)."""
    n, span = len(data), LENGTH - GRAM + 1
    if n < LENGTH:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    prefix = prefix_sums(data)
    at = np.arange(n - GRAM + 1)
    grams = mix(run_hashes(prefix, at, at + GRAM))
    # The low bits hold the place, counted down, so that the last of equal hashes is the least.
    ranked = (grams & ~_LOW) | (_LOW - at.astype(np.uint64))
    rows = -(-len(ranked) // span)
    block = np.full(rows * span, np.uint64(0xFFFFFFFFFFFFFFFF))
    block[: len(ranked)] = ranked
    block = block.reshape(rows, span)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    back = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    strings = n - LENGTH + 1
    named = (_LOW - (np.minimum(back[:strings], ahead[span - 1 : span - 1 + strings]) & _LOW)).astype(np.int64)
    # A string must lie in one text.
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:strings]
    inside = np.arange(strings) + LENGTH <= bounds[owner + 1]
    edge = np.ones(strings, dtype=bool)
    edge[1:] = (named[1:] != named[:-1]) | (owner[1:] != owner[:-1]) | ~inside[:-1]
    first = np.flatnonzero(edge & inside)
    if not len(first):
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    edges = np.flatnonzero(edge | ~inside)
    after = np.append(edges, strings)[np.searchsorted(edges, first) + 1]
    last = after - 1
    text, anchor = owner[first], named[first]
    size = last - first + LENGTH
    whole = run_hashes(prefix, first, first + size)
    shape = (size.astype(np.uint64) << np.uint64(32)) + (anchor - first).astype(np.uint64)
    return text, first - bounds[text], size, mix(grams[anchor], 71), mix(whole + mix(shape, 72), 73)


def merge_spans(group: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """Unions of spans [lo, hi) within each group: (group, lo, hi), sorted."""
    if not len(lo):
        return group, lo, hi
    order = np.lexsort((lo, group))
    group, lo, hi = group[order], lo[order], hi[order]
    # Reach so far, kept apart between groups by an offset larger than any span end.
    step = int(hi.max()) + 1
    number = np.concatenate([[0], np.cumsum(group[1:] != group[:-1])])
    reach = np.maximum.accumulate(hi + number * step)
    new = np.ones(len(lo), dtype=bool)
    new[1:] = lo[1:] + number[1:] * step > reach[:-1]
    new[1:] |= group[1:] != group[:-1]
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(lo)) - 1
    return group[starts], lo[starts], reach[ends] - number[ends] * step


def _pack(lo, size, mark):
    return (lo.astype(np.int64) << 32) | (size.astype(np.int64) << 24) | mark.astype(np.int64)


def _order(fp, ext, doc, pack):
    """Sort keys: anchor, then document, text mark and start."""
    return np.lexsort((pack >> 32, pack & 0xFFFFFF, doc, fp))


def _first_of_kind(fp: np.ndarray, ext: np.ndarray) -> np.ndarray:
    """For rows sorted within their anchor: whether the row is the first with its (anchor, segment hash)."""
    by_kind = np.lexsort((np.arange(len(fp)), ext, fp))
    same = (fp[by_kind][1:] == fp[by_kind][:-1]) & (ext[by_kind][1:] == ext[by_kind][:-1])
    first = np.ones(len(fp), dtype=bool)
    first[by_kind[1:]] = ~same
    return first


def _anchor_rows(docs: DataFrame) -> DataFrame:
    """(fp, ext, doc, pack): a segment, or with a size of 0 in ``pack`` a span that is known to repeat."""

    def batch_of(fp, ext, doc, pack):
        return pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (fp.view(np.int64), ext.view(np.int64), doc, pack)],
            names=["fp", "ext", "doc", "pack"],
        )

    def flush(held):
        fp, ext, doc, pack = (np.concatenate(x) for x in zip(*held))
        order = _order(fp, ext, doc, pack)
        fp, ext, doc, pack = fp[order], ext[order], doc[order], pack[order]
        first = _first_of_kind(fp, ext)
        yield batch_of(fp[first], ext[first], doc[first], pack[first])
        again = ~first
        if again.any():
            key = np.stack([doc[again], pack[again] & 0xFFFFFF], axis=1)
            texts, group = np.unique(key, axis=0, return_inverse=True)
            lo = pack[again] >> 32
            group, lo, hi = merge_spans(group.ravel(), lo, lo + ((pack[again] >> 24) & 0xFF))
            doc, mark = texts[group, 0], texts[group, 1]
            route = mix((doc * 1_000_003 + lo).view(np.uint64), 74)
            yield batch_of(route, (hi - lo).view(np.uint64), doc, _pack(lo, np.zeros_like(lo), mark))

    def run(batches):
        held, rows = [], 0
        for batch, text in pieces(batches):
            data, bounds = joined_bytes(text)
            for at in range(0, len(data), SLICE_BYTES):  # only a text that is a piece of its own has several
                part = data[at : at + SLICE_BYTES + LENGTH - 1]
                number, lo, size, fp, ext = anchors(part, bounds if len(part) == len(data) else np.array([0, len(part)]))
                doc = batch.column(0).to_numpy(zero_copy_only=False)[number]
                mark = batch.column(1).to_numpy(zero_copy_only=False)[number]
                held.append((fp, ext, doc, _pack(lo + at, size, mark)))
                rows += len(lo)
                if rows >= MERGE_ROWS:
                    yield from flush(held)
                    held, rows = [], 0
        if rows:
            yield from flush(held)

    return docs.select("doc", "mark", "text").mapInArrow(run, "fp long, ext long, doc long, pack long")


def _hot_anchors(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(fp, hot): the anchors with more than ``HOT_ROWS`` segments.

    Anchors are first counted in buckets of few rows on average; only a bucket
    over the bound can hold such an anchor, so most anchors are never dealt.
    """
    held = rows.filter(F.shiftright("pack", 24).bitwiseAND(F.lit(0xFF).cast("long")) > 0)
    bucket = F.pmod(F.col("fp"), F.lit(max(1 << 10, 4 * rows.count() // HOT_ROWS)).cast("long"))
    held = held.select("fp", bucket.alias("bucket"))
    over = lambda *key: held.groupBy(*key).agg(F.count("*").alias("n")).filter(F.col("n") > HOT_ROWS)
    full = scratch.keep(over("bucket").select("bucket"), "buckets")
    held = held.join(full, "bucket", "left_semi")
    return over("fp").select("fp", F.lit(True).alias("hot"))


def _decide(rows: DataFrame, hot: DataFrame, shards: int) -> DataFrame:
    """(doc, mark, lo, size, fp, hot): spans that repeat (null fp), and segments to be compared byte by byte."""

    def run(batches):
        held = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches if b.num_rows]
        if not held:
            return
        fp, ext, doc, pack, hot = (np.concatenate(x) for x in zip(*held))
        size = (pack >> 24) & 0xFF
        known = size == 0
        order = _order(fp, ext, doc, pack)
        order = order[~known[order]]
        f, e = fp[order], ext[order]
        first = _first_of_kind(f, e)
        kinds = np.add.reduceat(first.astype(np.int64), np.flatnonzero(np.r_[True, f[1:] != f[:-1]])) if len(f) else first
        many = np.repeat(kinds > 1, np.diff(np.flatnonzero(np.r_[True, f[1:] != f[:-1], True]))) if len(f) else first
        # A hot anchor's other kinds are in other tasks.
        again, compare = order[~first], order[first & (many | hot[order])]
        spans = np.concatenate([np.flatnonzero(known), again])
        lengths = np.where(known, ext, size)
        every = np.concatenate([spans, compare])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(doc[every], pa.int64()),
                pa.array(pack[every] & 0xFFFFFF, pa.int64()),
                pa.array(pack[every] >> 32, pa.int64()),
                pa.array(lengths[every], pa.int64()),
                pa.array(fp[every], pa.int64(), mask=np.arange(len(every)) < len(spans)),
                pa.array(hot[every], pa.bool_()),
            ],
            names=["doc", "mark", "lo", "size", "fp", "hot"],
        )

    told = rows.join(hot, "fp", "left").select("fp", "ext", "doc", "pack", F.coalesce("hot", F.lit(False)).alias("hot"))
    dealt = told.repartition(shards, "fp", F.when(F.col("hot"), F.col("ext")))
    return dealt.mapInArrow(run, "doc long, mark long, lo long, size long, fp long, hot boolean")


def _cut(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(fp, doc, mark, lo, bytes, hot) of the wanted segments."""
    lists = wanted.groupBy("doc", "mark").agg(F.collect_list(F.struct("fp", "lo", "size", "hot")).alias("cuts"))
    # Rows equal in id and text are one document, so their text is read once.
    texts = docs.join(lists.hint("merge"), ["doc", "mark"])
    cuts = texts.select("doc", "mark", F.col("text").cast("binary").alias("text"), F.explode("cuts").alias("c"))
    return cuts.select(
        F.col("c.fp").alias("fp"), "doc", "mark", F.col("c.lo").alias("lo"),
        F.substring("text", (F.col("c.lo") + 1).cast("int"), F.col("c.size").cast("int")).alias("bytes"),
        F.col("c.hot").alias("hot"),
    )


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place, first byte most significant; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(data), dtype=np.uint64)
    for j in range(8):
        out = (out << np.uint64(8)) | padded[j : j + len(data)]
    return out


def suffix_array(keys: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Places in the order of the ``depth`` bytes or more that follow them.

    Larsson-Sadakane: places are ranked by eight bytes; as long as a group of
    equal rank is left, its places are sorted by the rank of the place as many
    bytes ahead as are sorted already, which doubles them.
    """
    n = len(keys)
    sa = np.argsort(keys, kind="stable")
    change = np.r_[True, keys[sa][1:] != keys[sa][:-1]]
    rank = np.empty(n + 1, dtype=np.int64)
    rank[n] = -1
    rank[sa] = np.flatnonzero(change)[np.cumsum(change) - 1]
    sorted_to = 8
    while sorted_to < depth:
        alone = np.r_[change[1:], True] & change
        slots = np.flatnonzero(~alone)
        if not len(slots):
            break
        places = sa[slots]
        group = rank[places]
        ahead = rank[np.minimum(places + sorted_to, n)]
        order = np.lexsort((ahead, group))
        places, group, ahead = places[order], group[order], ahead[order]
        sa[slots] = places
        new = np.r_[True, (group[1:] != group[:-1]) | (ahead[1:] != ahead[:-1])]
        change[slots] = new
        rank[places] = slots[np.flatnonzero(new)][np.cumsum(new) - 1]
        sorted_to *= 2
    return sa


def _compare(keys_a, a, keys_b, b):
    """Sign of the ``LENGTH``-byte string at a against that at b."""
    sign = np.zeros(len(a), dtype=np.int8)
    left = np.arange(len(a))
    for off in range(0, LENGTH, 8):
        x, y = keys_a[a[left] + off], keys_b[b[left] + off]
        if LENGTH - off < 8:
            cut = np.uint64(8 * (8 - (LENGTH - off)))
            x, y = x >> cut, y >> cut
        sign[left] = (x > y).astype(np.int8) - (x < y).astype(np.int8)
        left = left[x == y]
        if not len(left):
            break
    return sign


def _held(keys_in: np.ndarray, sorted_in: np.ndarray, keys: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether the string at each place is among the sorted strings of another array (binary search)."""
    low, high = np.zeros(len(places), np.int64), np.full(len(places), len(sorted_in), np.int64)
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            break
        mid = (low[open_] + high[open_]) // 2
        less = _compare(keys_in, sorted_in[mid], keys, places[open_]) < 0
        low[open_[less]] = mid[less] + 1
        high[open_[~less]] = mid[~less]
    found = np.zeros(len(places), dtype=bool)
    there = np.flatnonzero(low < len(sorted_in))
    found[there] = _compare(keys_in, sorted_in[low[there]], keys, places[there]) == 0
    return found


def repeated_strings(segments: list[bytes], array_bytes: int = ARRAY_BYTES) -> list[np.ndarray]:
    """For each segment, where strings start in it that an earlier place of the list also holds."""
    out: list[np.ndarray] = []
    earlier: list[tuple[np.ndarray, np.ndarray]] = []
    at = 0
    while at < len(segments):
        stop, total = at, 0
        while stop < len(segments) and (stop == at or total + len(segments[stop]) <= array_bytes):
            total += len(segments[stop])
            stop += 1
        part = segments[at:stop]
        sizes = np.array([len(s) for s in part])
        starts = np.r_[0, np.cumsum(sizes)]
        keys = words_at(np.frombuffer(b"".join(part), dtype=np.uint8))
        sa = suffix_array(keys)
        owner = np.repeat(np.arange(len(part)), sizes)
        sa = sa[sa + LENGTH <= starts[owner[sa] + 1]]
        # Common prefix of neighbours, eight bytes at a time, as far as it matters.
        new = np.r_[True, _compare(keys, sa[1:], keys, sa[:-1]) != 0] if len(sa) else np.empty(0, bool)
        heads = np.flatnonzero(new)
        first = np.minimum.reduceat(sa, heads) if len(sa) else sa
        again = np.zeros(len(keys), dtype=bool)
        again[sa] = True
        again[first] = False
        distinct = sa[heads]
        known = np.zeros(len(heads), dtype=bool)
        for keys_in, sorted_in in earlier:
            known |= _held(keys_in, sorted_in, keys, distinct)
        again[sa[known[np.cumsum(new) - 1]]] = True
        earlier.append((keys, distinct))
        out += [np.flatnonzero(again[starts[i] : starts[i + 1]]) for i in range(len(part))]
        at = stop
    return out


def _packs(fp: np.ndarray, sizes: np.ndarray, array_bytes: int) -> list[tuple[int, int]]:
    """Runs [a, b) of sorted segments that hold whole anchors, of up to ``array_bytes`` or one anchor."""
    edges = np.flatnonzero(np.r_[True, fp[1:] != fp[:-1], True])
    ends = np.r_[0, np.cumsum(sizes)][edges]
    packs, at = [], 0
    while at < len(edges) - 1:
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + array_bytes, side="right")) - 1)
        packs.append((int(edges[at]), int(edges[stop])))
        at = stop
    return packs


def _resolve(cuts: DataFrame, shards: int) -> DataFrame:
    """Spans (doc, mark, lo, size) of the compared segments that repeat."""

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        fp, doc, mark, lo = (rows.column(c).to_numpy() for c in ("fp", "doc", "mark", "lo"))
        order = np.lexsort((lo, mark, doc, fp))
        keep = np.r_[True, (np.diff(doc[order]) != 0) | (np.diff(mark[order]) != 0) | (np.diff(lo[order]) != 0)]
        order = order[keep]
        sizes = pc.binary_length(rows.column("bytes")).to_numpy()[order]
        for a, b in _packs(fp[order], sizes, ARRAY_BYTES):
            part = order[a:b]
            starts = repeated_strings(rows.column("bytes").take(pa.array(part)).to_pylist())
            group = np.repeat(np.arange(len(part)), [len(s) for s in starts])
            where = np.concatenate(starts)
            group, first, last = merge_spans(group, where, where + LENGTH)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[part][group]), pa.array(mark[part][group]), pa.array(lo[part][group] + first), pa.array(last - first)],
                names=["doc", "mark", "lo", "size"],
            )

    return cuts.repartition(shards, "fp").mapInArrow(run, "doc long, mark long, lo long, size long")


def _first_strings(cuts: DataFrame) -> DataFrame:
    """(doc, mark, lo): the first place of every string of the segments, by 128 bits of the string's hash."""

    def flush(held):
        h1, h2, doc, place = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((place, doc, h2, h1))
        h1, h2 = h1[order], h2[order]
        first = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
        order = order[first]
        columns = (h1[first].view(np.int64), h2[first].view(np.int64), doc[order], place[order])
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["h1", "h2", "doc", "place"])

    def run(batches):
        held, rows = [], 0
        for batch, segments in pieces(batches, "bytes"):
            data, bounds = joined_bytes(segments)
            strings = np.diff(bounds) - LENGTH + 1
            owner = np.repeat(np.arange(len(strings)), strings)
            offset = np.arange(len(owner)) - np.repeat(np.cumsum(strings) - strings, strings)
            at = bounds[owner] + offset
            doc, mark, lo = (batch.column(c).to_numpy(zero_copy_only=False)[owner] for c in (1, 2, 3))
            ones, twos = prefix_sums(data), prefix_sums(_OTHER[data])
            h1, h2 = mix(run_hashes(ones, at, at + LENGTH), 75), mix(run_hashes(twos, at, at + LENGTH), 76)
            held.append((h1, h2, doc, (mark << 32) | (lo + offset)))
            rows += len(owner)
            if rows >= MERGE_ROWS:
                yield flush(held)
                held, rows = [], 0
        if rows:
            yield flush(held)

    each = cuts.mapInArrow(run, "h1 long, h2 long, doc long, place long")
    least = each.groupBy("h1", "h2").agg(F.min(F.struct("doc", "place")).alias("p"))
    low = F.lit(0xFFFFFFFF).cast("long")
    return least.select("p.doc", F.shiftright("p.place", 32).alias("mark"), F.col("p.place").bitwiseAND(low).alias("lo"))


def _resolve_hot(cuts: DataFrame, segments: DataFrame) -> DataFrame:
    """Spans (doc, mark, lo, size) of the segments' strings that are not the first of equals.

    No key is hot here: strings are aggregated, and firsts meet segments by text.
    """
    firsts = _first_strings(cuts).groupBy("doc", "mark").agg(F.collect_list("lo").alias("firsts"))
    lists = segments.groupBy("doc", "mark").agg(F.collect_list(F.struct("lo", "size")).alias("cuts"))

    def run(batches):
        for batch in batches:
            out = []
            for doc, mark, cuts, first in zip(*(c.to_pylist() for c in batch.columns)):
                lo = np.array([c["lo"] for c in cuts], dtype=np.int64)
                strings = np.array([c["size"] for c in cuts], dtype=np.int64) - LENGTH + 1
                at = np.arange(int(strings.sum())) + np.repeat(lo - (np.cumsum(strings) - strings), strings)
                again = np.setdiff1d(at, np.array(first or [], dtype=np.int64))
                _, a, b = merge_spans(np.zeros(len(again), np.int64), again, again + LENGTH)
                out += [(doc, mark, x, y - x) for x, y in zip(a.tolist(), b.tolist())]
            columns = list(zip(*out)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc", "mark", "lo", "size"])

    joined = lists.join(firsts.hint("merge"), ["doc", "mark"], "left").select("doc", "mark", "cuts", "firsts")
    return joined.mapInArrow(run, "doc long, mark long, lo long, size long")


def repeated_spans(docs: DataFrame, scratch: Scratch, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc, mark, lo, size): byte spans of repeated strings, for docs of (doc, mark, text)."""
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = max(1, total // shard_bytes)
    rows = scratch.keep(_anchor_rows(docs), "anchors")
    hot = scratch.keep(_hot_anchors(rows, scratch), "hot")
    decided = scratch.keep(_decide(rows, hot, shards), "decided")
    scratch.drop("anchors")
    found = decided.filter(F.col("fp").isNull()).select("doc", "mark", "lo", "size")
    segments = decided.filter(F.col("fp").isNotNull())
    # Segments overlap, so they can hold several times the bytes of the texts.
    sizes = {r["hot"]: r["bytes"] for r in segments.groupBy("hot").agg(F.sum("size").alias("bytes")).collect()}
    cuts = _cut(docs, segments)
    if True in sizes:  # both ways of comparing read the texts once
        cuts = scratch.keep(cuts, "cuts")
    cold = _resolve(cuts.filter(~F.col("hot")).drop("hot"), max(shards, sizes.get(False, 0) // shard_bytes))
    found = found.unionByName(scratch.keep(cold, "resolved"))
    if True in sizes:
        spread = _resolve_hot(cuts.filter("hot"), segments.filter("hot"))
        found = found.unionByName(scratch.keep(spread, "resolved-hot"))
        scratch.drop("cuts")
    return found


def marked(documents: DataFrame) -> DataFrame:
    """The documents with an order key ``doc`` and ``mark``, 24 bits of the text's hash."""
    return documents.withColumns(
        {
            "doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long")),
            "mark": F.coalesce(F.xxhash64("text"), F.lit(0)).bitwiseAND(F.lit(0xFFFFFF).cast("long")),
        }
    )


def without_repeats(documents: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every document: the removed runs
    [lo, hi) in order, and the remaining bytes."""
    scratch = Scratch(documents.sparkSession, "substrings")
    docs = marked(documents.select("doc_id", "text"))
    spans = repeated_spans(docs.select("doc", "mark", "text"), scratch)
    lists = spans.groupBy("doc", "mark").agg(F.collect_list(F.struct("lo", "size")).alias("found"))
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch, text in pieces(batches):
            runs, kept = [], []
            for raw, found in zip(text.to_pylist(), batch.column(2).to_pylist()):
                lo = np.array([s["lo"] for s in found or ()], dtype=np.int64)
                hi = lo + np.array([s["size"] for s in found or ()], dtype=np.int64)
                _, lo, hi = merge_spans(np.zeros(len(lo), np.int64), lo, hi)
                at, parts = 0, []
                for a, b in zip(lo.tolist(), hi.tolist()):
                    parts.append(raw[at:a])
                    at = b
                runs.append([{"lo": a, "hi": b} for a, b in zip(lo.tolist(), hi.tolist())])
                kept.append(b"".join([*parts, raw[at:]]))
            yield with_columns(
                batch,
                ["doc_id"],
                n_bytes=pa.array([len(t) for t in text.to_pylist()], pa.int64()),
                spans=pa.array(runs, pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))),
                kept=pa.array(kept, pa.binary()),
            )

    joined = docs.join(lists.hint("merge"), ["doc", "mark"], "left").select("doc_id", "text", "found")
    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes long, spans array<struct<lo:long,hi:long>>, kept binary")


def substring_digest(documents: DataFrame) -> DataFrame:
    """``op6``: bytes and runs that exact deduplication removes from every document."""
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["hi"] - s["lo"])
    return without_repeats(documents).select(
        "doc_id",
        "n_bytes",
        size.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
