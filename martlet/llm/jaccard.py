"""Exact n-gram Jaccard join with PartEnum signatures.

Texts with the same shingle set are one node. Sets of a size band and the band
above it, whose pairs of enough similarity differ in at most k shingles, share
a tag. Under it the shingle domain is hashed into first-level parts, so many
that some part differs in at most one shingle, and each part into three
second-level parts; every choice of two of these is a signature. Similar sets
therefore share a signature under some tag.

A signature over no shingles at all would join strangers. Each tag has
``SPARE`` first-level parts more than needed, so a set with at most that many
parts that yield an empty signature can leave those out without losing a
partner; the few sets with more keep them all.

Signatures that two nodes share make groups. In a first round each node is
compared with the most central member of its groups, which joins most near
copies; links are checked exactly on the whole sets and merged into
components. Then every pair that shares a group across components is compared,
so no link that joins two components is missed: of groups of up to ``SMALL``
members all pairs, of the nodes of larger ones the pairs that share a shingle
of their prefixes. There the shingles of a set are ordered: first those that only
nodes of its own component hold, then the others by how many of these nodes hold
them, rare ones first; similar sets share one of the first few. Sizes and places in
the order, neither of which drops a similar pair, sort out others. A passage in many
texts comes last in the order and so makes no pairs of texts that only share it. A
shingle that only one component has makes no pair across components and is not
listed: the counts also set the bits of a filter of bounded size, which tells most
of those (a shingle of two components always passes). So copies within a component
add no rows, however many they are.

Before any set is sent for a pair, of either kind, two counts must allow it: the
sizes, and a count sketch of each set, which says how many of its shingles hash
into each of a few cells. Cell by cell the counts of two sets differ by at most
the shingles that only one of them has, so no similar pair is dropped. A short
form of the sketch, with cells added up, is compared before the whole one.

Sets, nodes and signatures are 64-bit hashes. Defined cases: null and blank
texts have no shingles and are linked with nothing; fewer words than a shingle
are one shingle; repeated rows are one node; rows without an id get a
component but name none; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.llm._graph import components
from martlet.llm._hash import mix, scaled, set_keys, shingle_sets, word_hashes
from martlet.llm._io import Scratch, set_aside
from martlet.llm._text import joined_bytes, pieces, with_columns

WIDTH = 4
#: Similarity of linked texts, in percent.
PERCENT = 85
#: First-level parts beyond those that the pigeonhole needs.
SPARE = 3
#: Members of a group whose pairs are listed one by one.
SMALL = 16
#: Shingles that are known as common, and prefix rows of one shingle for each task.
COMMON, SALT_ROWS = 1 << 17, 4096
#: Bits of the filter of shingles across components, at most this power of two (16 MB), and bits for each shingle below that.
HELD_BITS, HELD_SPACE = 27, 8
#: Cells of a count sketch, and shingles of a set for each cell.
CELLS, CELL_SHINGLES = (64, 8192), 2
#: Cells of the short form that is looked at first; pairs whose sketches are compared at once.
BRIEF, AT_ONCE = 128, 256
#: Ids that are broadcast to the texts (8 bytes each).
FEW = 1 << 18
#: Nodes whose signatures a task remembers to have sent.
SEEN = 500_000
_PAIRS = ((0, 1), (0, 2), (1, 2))


class Tags:
    """Size bands and, for each, the first-level parts that its tag needs."""

    def __init__(self, percent: int):
        self.percent = percent
        self.edges = [1]
        self.parts: list[int] = []

    def reach(self, size: int) -> None:
        while self.edges[-1] <= size:
            nxt = self.edges[-1] * 100 // self.percent + 1
            k = (nxt - 1) * (100 - self.percent) // self.percent
            self.parts.append(k // 2 + 1 + SPARE if k else 0)
            self.edges.append(nxt)

    def bands(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(np.array(self.edges), sizes, side="right") - 1


def signatures(hashes: np.ndarray, bounds: np.ndarray, tags: Tags) -> tuple[np.ndarray, np.ndarray]:
    """(signature, index of its set) of non-empty sets, under both of their tags."""
    sizes = np.diff(bounds)
    sigs, owners = [], []
    if not len(sizes):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    tags.reach(int(sizes.max()))
    band = tags.bands(sizes)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    h1, h2, h3 = mix(hashes, 21), mix(hashes, 22), mix(hashes, 23)
    # A tag without a difference to spare has no parts: only equal sets are similar there, and those are one node.
    second = scaled(h2, np.full(1, 3)).astype(np.int64)
    for step in (0, -1):
        tag = band + step
        parts = np.where(tag >= 0, np.array(tags.parts)[np.maximum(tag, 0)], 0)
        first = np.zeros(len(sizes) + 1, dtype=np.int64)
        np.cumsum(parts, out=first[1:])
        used = parts[owner] > 0
        cell = (first[owner] + scaled(h1, parts[owner]).astype(np.int64))[used] * 3 + second[used]
        sums = np.zeros(int(first[-1]) * 3, dtype=np.uint64)
        np.add.at(sums, cell, h3[used])
        sums = sums.reshape(-1, 3)
        held = np.bincount(cell, minlength=len(sums) * 3).reshape(-1, 3)
        of = np.repeat(np.arange(len(sizes)), parts)
        place = np.arange(len(sums)) - first[of]
        empty = np.stack([held[:, a] + held[:, b] == 0 for a, b in _PAIRS])
        tainted = np.bincount(of[empty.any(axis=0)], minlength=len(sizes))
        keep_empty = (tainted > SPARE)[of]
        name = mix((tag[of].astype(np.uint64) << np.uint64(32)) + place.astype(np.uint64), 31)
        for i, (a, b) in enumerate(_PAIRS):
            send = ~empty[i] | keep_empty
            both = mix(sums[:, a], 41 + i) + mix(sums[:, b], 51 + i)
            sigs.append(mix(both ^ name, 61)[send])
            owners.append(of[send])
    return np.concatenate(sigs), np.concatenate(owners)


def _sets(text: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    data, bounds = joined_bytes(text)
    words, at = word_hashes(data, bounds)
    return shingle_sets(words, at, width)


def keyed(docs: DataFrame, keep: list[str], width: int, sketch: bool = False) -> DataFrame:
    """``keep`` columns of every document with its set's size ``n_shingles``, key ``node`` and, if asked for, its ``sketch`` and ``brief`` sketch."""
    more = [T.StructField("n_shingles", T.LongType()), T.StructField("node", T.LongType())]
    if sketch:
        more += [T.StructField(c, T.BinaryType()) for c in ("sketch", "brief")]
    schema = T.StructType([docs.schema[c] for c in keep] + more)

    def run(batches):
        for batch, text in pieces(batches):
            hashes, bounds = _sets(text, width)
            columns = {
                "n_shingles": pa.array(np.diff(bounds), pa.int64()),
                "node": pa.array(set_keys(hashes, bounds).view(np.int64), pa.int64()),
            }
            if sketch:
                whole = [count_sketch(hashes[a:b]) for a, b in zip(bounds, bounds[1:])]
                columns["sketch"] = pa.array(whole, pa.binary())
                columns["brief"] = pa.array([brief_sketch(x) for x in whole], pa.binary())
            yield with_columns(batch, keep, **columns)

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def _signature_rows(docs: DataFrame, width: int, percent: int) -> DataFrame:
    def run(batches):
        tags, seen = Tags(percent), set()
        for _, text in pieces(batches):
            hashes, bounds = _sets(text, width)
            keys = set_keys(hashes, bounds).view(np.int64)
            new = np.zeros(len(keys), dtype=bool)
            for i in np.flatnonzero(np.diff(bounds) > 0):
                k = int(keys[i])
                if k not in seen:
                    seen.add(k)
                    new[i] = True
            if len(seen) > SEEN:
                seen.clear()
            sizes = np.diff(bounds)
            hashes = hashes[np.repeat(new, sizes)]
            at = np.concatenate([[0], np.cumsum(sizes[new])])
            sigs, owner = signatures(hashes, at, tags)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sigs.view(np.int64), pa.int64()), pa.array(keys[new][owner], pa.int64())], names=["sig", "node"]
            )

    return docs.select("text").mapInArrow(run, "sig long, node long")


def _shared(sigs: DataFrame) -> DataFrame:
    """Rows whose signature two nodes or more have, once each; streams over sorted partitions."""

    def run(batches):
        last = None  # (sig, node, sent) of the row before
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = batch.column(0).to_numpy(zero_copy_only=False)
            node = batch.column(1).to_numpy(zero_copy_only=False)
            if last is not None:
                sig, node = np.concatenate([[last[0]], sig]), np.concatenate([[last[1]], node])
            fresh = np.ones(len(sig), dtype=bool)
            fresh[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
            sig, node = sig[fresh], node[fresh]
            same = sig[1:] == sig[:-1]
            out = np.zeros(len(sig), dtype=bool)
            out[1:] |= same
            out[:-1] |= same
            sent = last[2] if last is not None else False
            tail = (sig[-1], node[-1], bool(out[-1]) if len(sig) > 1 else sent)
            if last is not None and sent:
                out[0] = False
            last = tail
            yield pa.RecordBatch.from_arrays(
                [pa.array(sig[out], pa.int64()), pa.array(node[out], pa.int64())], names=["sig", "node"]
            )

    return sigs.repartition("sig").sortWithinPartitions("sig", "node").mapInArrow(run, "sig long, node long")


def count_sketch(hashes: np.ndarray) -> bytes:
    """How many members of a set fall into each cell, at most 255; larger sets have more cells."""
    low, high = CELLS
    bits = int(np.clip((len(hashes) - 1) // CELL_SHINGLES, low - 1, high - 1)).bit_length()
    cell = (mix(hashes, 92) >> np.uint64(64 - bits)).astype(np.int64)
    return np.minimum(np.bincount(cell, minlength=1 << bits), 255).astype(np.uint8).tobytes()


def brief_sketch(sketch: bytes) -> bytes:
    """The sketch with neighbouring cells added up to at most ``BRIEF`` cells."""
    cells = np.frombuffer(sketch, dtype=np.uint8).astype(np.int64)
    return np.minimum(cells.reshape(min(len(cells), BRIEF), -1).sum(axis=1), 255).astype(np.uint8).tobytes()


def least_difference(one: list[bytes], two: list[bytes]) -> np.ndarray:
    """For each pair of sketches, a bound below the number of shingles that only one of the sets has."""
    widths = np.array([[len(a), len(b)] for a, b in zip(one, two)])
    out = np.zeros(len(one), dtype=np.int64)
    for a, b in np.unique(widths, axis=0) if len(one) else ():
        at = np.flatnonzero((widths == (a, b)).all(axis=1))
        counts = []
        for sketches, width in ((one, a), (two, b)):
            c = np.frombuffer(b"".join(sketches[i] for i in at), dtype=np.uint8).reshape(len(at), width).astype(np.int32)
            # Neighbouring cells of the wider sketch are one of the narrower.
            counts.append(np.minimum(c.reshape(len(at), min(a, b), -1).sum(axis=2), 255))
        out[at] = np.abs(counts[0] - counts[1]).sum(axis=1)
    return out


def _set_rows(docs: DataFrame, width: int) -> DataFrame:
    """(node, members) of the texts; a task sends equal sets once."""

    def run(batches):
        seen = set()
        for batch, text in pieces(batches):
            hashes, bounds = _sets(text, width)
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(hashes.view(np.int64), pa.int64()))
            keys = set_keys(hashes, bounds).view(np.int64)
            new = []
            for i, k in enumerate(keys.tolist()):
                if k not in seen:
                    seen.add(k)
                    new.append(i)
            if len(seen) > SEEN:
                seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), lists], names=["node", "members"]).take(pa.array(new, pa.int64()))

    return docs.select("text").mapInArrow(run, "node long, members array<long>")


def _count_keys(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The upper 32 + ``bits`` bits of shingles, by which they are counted."""
    return hashes.view(np.uint64) >> np.uint64(32 - bits)


def _held_at(keys: np.ndarray, bits: int, held_bits: int) -> np.ndarray:
    """Where the filter of shingles across components has the bit of a key: at its upper bits."""
    return (keys >> (32 + bits - held_bits)).astype(np.int64)


def _counted(sets: DataFrame, bits: int, least: int, held_bits: int) -> DataFrame:
    """(key, n): by their keys, the shingles that more than ``least`` of the sets have;
    and (part, null, held): a run of the filter of keys that sets of two labels or more have.

    A task sends its counts as arrays, one for each value of the upper bits, the part,
    with a label of each key's sets and whether they have others (``many``).
    """
    names = ["part", "low", "times", "owners", "many"]

    def send(batches):
        for batch in batches:
            lists = batch.column(0)
            keys = _count_keys(lists.flatten().to_numpy(zero_copy_only=False), bits)
            labels = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False))
            keys, times, owners, many = _by_key(keys, np.ones(len(keys), dtype=np.int64), labels, np.zeros(len(keys), dtype=bool))
            parts = (keys >> np.uint64(32)).astype(np.int64)
            starts = _starts(parts)
            ends = [*starts[1:], len(parts)]
            arrays = [keys.astype("<u4"), times.astype("<u4"), owners.astype("<i8"), many.astype("u1")]
            columns = [pa.array(parts[starts], pa.int64())]
            columns += [pa.array([x[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()) for x in arrays]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    def total(part, *sent):
        arrays = [np.frombuffer(b"".join(x), kind) for x, kind in zip(sent, ("<u4", "<u4", "<i8", "u1"))]
        keys, n, _, many = _by_key(arrays[0], arrays[1].astype(np.int64), arrays[2], arrays[3] > 0)
        keys = keys.astype(np.int64) + (part << 32)
        run = np.zeros(1 << (held_bits - bits), dtype=np.uint8)
        run[_held_at(keys[many], bits, held_bits) & (len(run) - 1)] = 1
        keys, n = keys[n > least], n[n > least]
        columns = [
            pa.array([*keys.tolist(), part], pa.int64()),
            pa.array([*n.tolist(), None], pa.int64()),
            pa.array([None] * len(keys) + [np.packbits(run).tobytes()], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["key", "n", "held"])

    def receive(batches):
        now, sent = None, []
        for batch in batches:
            for part, *arrays in zip(*(batch.column(i).to_pylist() for i in range(len(names)))):
                if part != now:
                    if sent:
                        yield total(now, *zip(*sent))
                    now, sent = part, []
                sent.append(arrays)
        if sent:
            yield total(now, *zip(*sent))

    rows = sets.select("members", F.xxhash64("label").alias("owner"))
    sent = rows.mapInArrow(send, "part long, low binary, times binary, owners binary, many binary")
    return sent.repartition("part").sortWithinPartitions("part").mapInArrow(receive, "key long, n long, held binary")


def _starts(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.r_[True, values[1:] != values[:-1]][: len(values)])


def _by_key(keys: np.ndarray, times: np.ndarray, owners: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each key once: its times added up, one of its owners, and whether it has ``many``."""
    order = np.lexsort((owners, keys))
    keys, times, owners, many = keys[order], times[order], owners[order], many[order]
    starts = _starts(keys)
    if not len(starts):
        return keys, times, owners, many
    last = np.r_[starts[1:], len(keys)] - 1
    many = np.logical_or.reduceat(many, starts) | (owners[starts] != owners[last])
    return keys[starts], np.add.reduceat(times, starts), owners[starts], many


def _prefix_rows(sets: DataFrame, counts: DataFrame, bits: int, held_bits: int, percent: int) -> DataFrame:
    """(node, label, shingle, size, place, short): the prefix of each set, shingles of one
    label first, then rare ones, without most of the shingles that only one label has.

    A set shares one of its prefix with any similar one, one of its ``short``
    prefix with any similar one that is not smaller.
    """
    common = counts.filter("n IS NOT NULL").orderBy(F.desc("n"), "key").limit(COMMON).collect()
    held = np.zeros(1 << (held_bits - 3), dtype=np.uint8)
    for r in counts.filter("held IS NOT NULL").select("key", "held").collect():
        at = r["key"] * len(r["held"])
        held[at : at + len(r["held"])] = np.frombuffer(r["held"], dtype=np.uint8)
    known = np.array([r["key"] for r in common], dtype=np.int64)
    by = np.argsort(known)
    known, often = known[by], np.array([r["n"] for r in common], dtype=np.int64)[by]
    sent = sets.sparkSession.sparkContext.broadcast((known, often, held))
    names = ["node", "label", "shingle", "size", "place", "short"]

    def run(batches):
        known, often, held = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(2)
            hashes = lists.flatten().to_numpy(zero_copy_only=False)
            sizes = np.array(lists.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
            starts = np.cumsum(sizes) - sizes
            owner = np.repeat(np.arange(len(sizes)), sizes)
            count = np.zeros(len(hashes), dtype=np.int64)
            keys = _count_keys(hashes, bits)
            at = _held_at(keys, bits, held_bits)
            across = (held[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0
            if len(known):
                keys = keys.view(np.int64)
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                count = np.where(known[at] == keys, often[at], 0)
            order = np.lexsort((hashes, count, across, owner))
            place = np.arange(len(order)) - starts[owner]
            long = sizes + 1 + (-percent * sizes) // 100
            short = sizes + 1 + (-2 * percent * sizes) // (100 + percent)
            first = (place < long[owner]) & across[order]
            of, place, shingle = owner[first], place[first], hashes[order[first]]
            columns = [batch.column(i).take(pa.array(of)) for i in range(2)]
            columns += [pa.array(c, pa.int64()) for c in (shingle, sizes[of], place)] + [pa.array(place < short[of])]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = [T.StructField("node", T.LongType()), sets.schema["label"]]
    fields += [T.StructField(c, T.LongType()) for c in names[2:5]] + [T.StructField("short", T.BooleanType())]
    return sets.select("node", "label", "members").mapInArrow(run, T.StructType(fields))


class Join:
    """The join over ``docs`` (an ``id`` column and ``text``).

    ``rows``: id, n_shingles and node of every document. ``nodes``: smallest id
    and component of every node with shingles.
    """

    def __init__(self, docs: DataFrame, id: str = "doc_id", width: int = WIDTH, percent: int = PERCENT):
        self.scratch, self.percent, self.width = Scratch(docs.sparkSession, "jaccard"), percent, width
        self.base = docs.select(F.col(id).alias("id"), "text")
        rows = self.scratch.keep(keyed(self.base, ["id"], width, sketch=True), "rows")
        self.rows = rows.drop("sketch", "brief")
        reps = self.rows.filter("n_shingles > 0").groupBy("node").agg(F.min("id").alias("rep"))
        shared = self.scratch.keep(_shared(_signature_rows(self.base, width, percent)), "shared")
        # The signatures are the largest shuffle of the join.
        self.scratch.release()
        groups = shared.join(reps.hint("merge"), "node").filter(F.col("rep").isNotNull())
        sizes = groups.groupBy("sig").agg(F.count("*").alias("n")).filter("n > 1")
        groups = groups.join(sizes.hint("merge"), "sig")
        # How many members a node meets over all of its groups.
        central = groups.groupBy("node").agg(F.sum("n").alias("score"))
        groups = groups.join(central.hint("merge"), "node").select("sig", "n", "node", "rep", "score", F.col("rep").alias("label"))
        groups = self.scratch.keep(groups, "groups-0")
        self.scratch.drop("shared")
        sketches = rows.filter("n_shingles > 0").select("node", F.col("n_shingles").alias("n"), "brief", "sketch")
        wanted = groups.select("node", "rep").distinct()
        self.sketches = self.scratch.keep(sketches.dropDuplicates(["node"]).join(wanted.hint("merge"), "node"), "sketches")
        links = self._links(groups)
        labels = components(links, self.scratch, "components")
        joined = reps.join(labels.hint("merge"), reps["rep"] == labels["node"], "left")
        self.nodes = joined.select(reps["node"], "rep", F.coalesce("label", "rep").alias("component_id"))

    def _links(self, groups: DataFrame) -> DataFrame:
        """Links (a, b) between smallest ids that connect every component."""
        first = self._similar(self._central(groups), "central")
        merged = components(first, self.scratch, "merge")
        labels = groups.join(merged.withColumnRenamed("label", "new").hint("merge"), groups["rep"] == merged["node"], "left")
        groups = labels.select("sig", "n", groups["node"], "rep", F.coalesce("new", "label").alias("label"))
        groups = self.scratch.keep(groups, "groups-1")
        self.scratch.drop("groups-0")
        open_groups = groups.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi")
        groups = groups.join(open_groups.select("sig").hint("merge"), "sig", "left_semi")
        small = self._all_pairs(groups.filter(F.col("n") <= SMALL))
        large = self._sharing_prefix(groups.filter(F.col("n") > SMALL))
        return first.unionByName(self._similar(small.unionByName(large).distinct(), "rest"))

    def _sets(self, nodes: DataFrame, name: str) -> DataFrame:
        """The written ``members`` of some ``nodes`` (node, rep, ...), beside their columns."""
        nodes = self.scratch.keep(nodes.distinct(), f"{name}-nodes")
        ids = nodes.select(F.col("rep").alias("id")).distinct()
        # The node is taken from the text itself, as one id can stand on several texts.
        if nodes.count() <= FEW:
            # Few ids go to the texts; beyond that the texts are shuffled to the ids.
            sets = _set_rows(self.base.join(F.broadcast(ids), "id", "left_semi"), self.width).join(F.broadcast(nodes), "node")
        else:
            sets = _set_rows(self.base.join(ids.hint("merge"), "id", "left_semi"), self.width)
            sets = sets.dropDuplicates(["node"]).join(nodes.hint("merge"), "node")
        sets = self.scratch.keep(sets, f"{name}-sets")
        self.scratch.release()
        return sets

    @staticmethod
    def _central(groups: DataFrame) -> DataFrame:
        """For each node the most central member of its groups: of those that lead
        a group, the one that leads most of them."""
        lead = F.struct("score", "node", "rep")
        leaders = groups.groupBy("sig").agg(F.max(lead).alias("p"))
        named = (
            groups.join(leaders.hint("merge"), "sig")
            .filter("node <> p.node")
            .groupBy("node", F.col("p.node").alias("node2"), F.col("p.rep").alias("rep2"))
            .agg(F.count("*").alias("led"))
        )
        best = F.max(F.struct("led", "node2", "rep2")).alias("p")
        return named.groupBy("node").agg(best).select("node", "p.node2")

    @staticmethod
    def _all_pairs(groups: DataFrame) -> DataFrame:
        """The pairs across components that share one of these groups of bounded size."""
        one = groups.select("sig", "node", "label")
        two = groups.select("sig", F.col("node").alias("node2"), F.col("label").alias("label2"))
        pairs = one.join(two.hint("merge"), "sig").filter("label < label2")
        return pairs.select("node", "node2").distinct()

    def _sharing_prefix(self, groups: DataFrame) -> DataFrame:
        """Pairs across components, of nodes in these groups, that share a shingle of
        their prefixes and may be similar by their sizes and its places."""
        sets = self._sets(groups.select("node", "rep", "label"), "large")
        total = self.sketches.agg(F.sum("n")).first()[0] or 0
        # Parts of about a million shingles, each with a run of whole bytes in the filter.
        bits = min(HELD_BITS - 3, (total >> 20).bit_length())
        held_bits = min(HELD_BITS, max(bits + 3, (total * HELD_SPACE).bit_length()))
        counts = self.scratch.keep(_counted(sets, bits, SMALL, held_bits), "counts")
        self.scratch.release()
        rows = self.scratch.keep(_prefix_rows(sets, counts, bits, held_bits, self.percent), "prefixes")
        del sets
        self.scratch.drop("large-sets")
        self.scratch.release()
        many = rows.groupBy("shingle").agg(F.count("*").alias("n")).filter(F.col("n") > SALT_ROWS)
        many = self.scratch.keep(many.select("shingle", F.ceil(F.col("n") / SALT_ROWS).cast("int").alias("salts")), "salts")
        rows = rows.join(many, "shingle", "left")
        salt = F.pmod(F.xxhash64(F.lit(29), "node"), F.coalesce("salts", F.lit(1))).cast("int")
        one = rows.withColumn("salt", salt).drop("salts")
        # Only rows of the salted shingles stand in several tasks.
        short = rows.filter("short").drop("short")
        spread = short.filter("salts IS NOT NULL").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        two = short.filter("salts IS NULL").withColumn("salt", F.lit(0)).unionByName(spread).drop("salts")
        two = two.select("shingle", "salt", *[F.col(c).alias(f"{c}2") for c in two.columns if c not in ("shingle", "salt")])
        least = F.ceil((F.col("size") + F.col("size2")) * self.percent / F.lit(100 + self.percent) - 1e-9).cast("long")
        pairs = one.join(two.hint("merge"), ["shingle", "salt"]).filter(
            (F.col("label") != F.col("label2"))
            & ((F.col("size2") < F.col("size")) | ((F.col("size2") == F.col("size")) & (F.col("node2") < F.col("node"))))
            & (F.col("size2") * 100 >= F.col("size") * self.percent)
            # If this is the first shingle both have, the rest bounds what they share.
            & (F.least(F.col("size") - F.col("place"), F.col("size2") - F.col("place2")) >= least)
        )
        return pairs.select("node", "node2").distinct()

    def _plausible(self, pairs: DataFrame) -> DataFrame:
        """The pairs (node, node2) that may be similar by the sizes and count sketches
        of their sets, with the smallest ids of both."""
        percent = self.percent

        def run(batches):
            for batch in batches:
                n, n2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 4))
                least = -(-(n + n2) * percent // (100 + percent))
                for at in range(0, batch.num_rows, AT_ONCE):
                    some = slice(at, at + AT_ONCE)
                    part = batch.slice(at, AT_ONCE)
                    differ = least_difference(part.column(3).to_pylist(), part.column(5).to_pylist())
                    yield part.select([0, 1]).filter(pa.array(differ <= (n + n2 - 2 * least)[some]))

        for sketch in ("brief", "sketch"):
            one = self.sketches.select("node", "n", F.col(sketch).alias("s"))
            two = one.select(*[F.col(c).alias(f"{c}2") for c in one.columns])
            sized = pairs.join(one.hint("merge"), "node").join(two.hint("merge"), "node2")
            sized = sized.filter(F.least("n", "n2") * 100 >= F.greatest("n", "n2") * percent)
            pairs = sized.select("node", "node2", "n", "s", "n2", "s2").mapInArrow(run, "node long, node2 long")
        reps = self.sketches.select("node", "rep")
        two = reps.select(F.col("node").alias("node2"), F.col("rep").alias("rep2"))
        return pairs.join(reps.hint("merge"), "node").join(two.hint("merge"), "node2")

    def _similar(self, pairs: DataFrame, name: str) -> DataFrame:
        """The written links (a, b): pairs whose whole sets are similar enough."""
        pairs = self.scratch.keep(self._plausible(pairs), f"{name}-pairs")
        named = pairs.select("node", "rep").unionByName(pairs.select(F.col("node2").alias("node"), F.col("rep2").alias("rep")))
        sets = self._sets(named, name)
        one = sets.select("node", F.col("members").alias("m1"))
        two = sets.select(F.col("node").alias("node2"), F.col("members").alias("m2"))
        links = (
            pairs.join(one.hint("merge"), "node")
            .join(two.hint("merge"), "node2")
            .withColumn("both", F.size(F.array_intersect("m1", "m2")))
            .filter(F.col("both") * 100 >= (F.size("m1") + F.size("m2") - F.col("both")) * self.percent)
            .select(F.col("rep").alias("a"), F.col("rep2").alias("b"))
        )
        links = self.scratch.keep(links, f"{name}-links")
        self.scratch.drop(f"{name}-sets")
        return links


def jaccard_digest(documents: DataFrame) -> DataFrame:
    """``op2``: set size and component of every document."""
    join = Join(documents)
    return (
        join.rows.join(join.nodes.hint("merge"), "node", "left")
        .select(
            F.col("id").alias("doc_id"),
            "n_shingles",
            F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "id")).otherwise(F.col("id")).alias("component_id"),
        )
    )


def one_of_each(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents without those linked to one of smaller id; texts without words and rows without an id all stay."""
    docs, back = set_aside(documents, "doc_id", "text")
    join = Join(docs, width=width, percent=percent)
    stay = join.nodes.filter("rep = component_id").select("node", "rep")
    rows = keyed(docs, docs.columns, width)
    empty = rows.filter((F.col("n_shingles") == 0) | F.col("doc_id").isNull())
    kept = rows.filter("n_shingles > 0").join(
        stay.hint("merge"), (rows["node"] == stay["node"]) & (rows["doc_id"] == stay["rep"]), "left_semi"
    )
    return back(kept.dropDuplicates(["doc_id", "node"]).unionByName(empty))
