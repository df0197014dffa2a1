"""Decontamination, substring removal and the Jaccard join against plain Python."""

import hashlib
import random
import re
import time

import numpy as np
import pandas as pd
import pytest

from martlet.llm import decontaminate, jaccard, substrings
from martlet.llm._hash import shingle_sets, word_hashes
from tests.llm.frames import EN, documents, no_documents, prose

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def bench_words(text):
    return BENCH_WORD.findall((text or "").translate(FOLD))


def plain_hits(texts, items):
    windows = {}
    for item, text in items:
        w = bench_words(text)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault((n, tuple(w[k : k + n])), set()).add(item)
    lengths = {n for n, _ in windows}
    out = []
    for i, text in texts:
        w, hit, found = bench_words(text), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                ids = windows.get((n, tuple(w[k : k + n])))
                if ids:
                    hit.update(range(k, k + n))
                    found |= ids
        names = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def bench_frame(spark, docs):
    texts = [r["text"] for r in docs.orderBy("doc_id").collect() if r["text"]]
    items = [
        (1, texts[0]),
        (2, " ".join(texts[1].split()[5:19]).upper()),
        (3, "the"),
        (4, "and to"),
        (5, None),
        (6, ""),
        (None, texts[2]),
        (10, texts[0]),
        (1, "of the in"),
    ]
    return spark.createDataFrame(items, "item_id long, text string"), items


@pytest.mark.parametrize("part_bytes", [decontaminate.PART_BYTES, 300])
def test_contamination_equals_plain_search(spark, part_bytes):
    docs = documents(spark)
    bench, items = bench_frame(spark, docs)
    want = plain_hits([(r["doc_id"], r["text"]) for r in docs.collect()], items)
    found = decontaminate.find_benchmark(docs.select("doc_id", "text"), bench, ["doc_id"], part_bytes=part_bytes)
    got = []
    for r in found.collect():
        names = ",".join(r["items"])
        got.append((r["doc_id"], r["n_words"], len(r["hits"]), len(r["items"]), hashlib.sha256(names.encode()).hexdigest(), bool(r["hits"])))
    assert sorted(got, key=str) == want
    if part_bytes == decontaminate.PART_BYTES:
        digest = [tuple(r) for r in decontaminate.contamination_digest(docs, bench).collect()]
        assert sorted(digest, key=str) == want


def test_repeated_words_are_searched_in_linear_time():
    words = [b"tick"] * 20_000
    (found,) = decontaminate.build([("a", b" ".join(words)), ("b", b" ".join(words[:12]))])
    hits, items = bytearray(len(words)), set()
    start = time.process_time()
    found.find(words, hits, items)
    assert time.process_time() - start < 5 and all(hits) and items == {0, 1}


def test_long_items_are_cut_without_loss(spark):
    words = [f"w{i % 97}" for i in range(500)]
    bench = spark.createDataFrame([("x", " ".join(words)), ("y", "w1 w2")], "item_id string, text string")
    parts = list(decontaminate._parts(bench, 200))
    runs = [text.split() for part in parts for i, text in part if i == "x"]
    windows = {tuple(r[k : k + 10]) for r in runs for k in range(len(r) - 9)}
    assert windows == {tuple(w.encode() for w in words[k : k + 10]) for k in range(491)}
    assert len(parts) > 1 and all(10 <= len(r) for r in runs) and max(len(b" ".join(r)) for r in runs) < 250


def test_clean_documents_keeps_columns(spark):
    docs = documents(spark)
    bench, items = bench_frame(spark, docs)
    items = [(i, t) for i, t in items if t and len(t) > 20]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.clean_documents(docs, bench)
    assert out.columns == docs.columns
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    clean = [r[0] for r in plain_hits(rows, items) if not r[5]]
    assert sorted(map(str, clean)) == sorted(str(r["doc_id"]) for r in out.collect())


def plain_sets(texts, width=4):
    out = {}
    for i, text in texts:
        w = WORD.findall((text or "").translate(FOLD))
        out[i] = frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])
    return out


def plain_components(sets, percent):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for at, a in enumerate(ids):
        for b in ids[at + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def near_copies(n, seed=4):
    """Bases of many lengths, each with variants around the similarity limit."""
    r, rows = random.Random(seed), []
    for b in range(n):
        words = prose(1000 + b, r.choice([1, 3, 4, 5, 9, 20, 60, 200])).split()
        for _ in range(r.choice([1, 2, 6, 12])):
            copy = list(words)
            for _ in range(r.choice([0, 1, 1, 2, 4])):
                copy[r.randrange(len(copy))] = r.choice(EN) + str(r.randrange(5))
            rows.append((len(rows), " ".join(copy)))
    return rows


@pytest.mark.parametrize("percent, small", [(85, jaccard.SMALL), (80, 2)])
def test_jaccard_components_equal_plain_join(spark, monkeypatch, percent, small):
    """With a bound of two, most groups are compared block against block."""
    monkeypatch.setattr(jaccard, "SMALL", small)
    rows = near_copies(60)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    join = jaccard.Join(docs, percent=percent)
    sets = plain_sets(rows)
    want = plain_components(sets, percent)
    nodes = {r["node"]: r["component_id"] for r in join.nodes.collect()}
    got = {r["id"]: (r["n_shingles"], nodes[r["node"]]) for r in join.rows.collect()}
    assert got == {i: (len(sets[i]), want[i]) for i in sets}


def test_sketches_bound_the_difference():
    """The bound never exceeds what only one set has, and tells strangers apart."""
    r = np.random.default_rng(4)
    for n in (1, 5, 120, 130, 700, 3000, 30000, 2_000_000):
        base = r.integers(0, 1 << 63, n).astype(np.uint64)
        for share in (0.0, 0.05, 0.2, 1.0):
            k = int(n * share)
            other = np.concatenate([base[k:], r.integers(0, 1 << 63, k // 2).astype(np.uint64)])
            if not len(other):
                continue
            bound = jaccard.least_difference([jaccard.count_sketch(base)], [jaccard.count_sketch(other)])[0]
            only = len(np.setxor1d(base, other))
            assert bound <= only
            if share == 1.0 and 100 <= n <= 30000:
                assert bound > 0.25 * n
    assert jaccard.least_difference([], []).tolist() == []


def test_signatures_cover_every_similar_pair():
    """Any two sets within the limit share a signature under some tag."""
    r = random.Random(8)
    tags = jaccard.Tags(85)
    for _ in range(150):
        n = r.choice([6, 7, 8, 12, 20, 33, 50, 120, 400])
        base = [r.getrandbits(64) for _ in range(n)]
        extra = [r.getrandbits(64) for _ in range(n)]
        drop = r.randrange(0, n // 6 + 1)
        add = r.randrange(0, n // 6 + 1)
        other = base[drop:] + extra[:add]
        both, union = n - drop, n + add
        if 100 * both < 85 * union:
            continue
        hashes = np.array(base + other, dtype=np.uint64)
        sigs, owner = jaccard.signatures(hashes, np.array([0, n, n + len(other)]), tags)
        shared = set(sigs[owner == 0].tolist()) & set(sigs[owner == 1].tolist())
        assert shared or (drop == add == 0)


def test_jaccard_digest_on_odd_rows(spark):
    docs = documents(spark)
    got = jaccard.jaccard_digest(docs).collect()
    assert len(got) == docs.count()
    plain = plain_sets([(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] is not None])
    want = plain_components(plain, 85)
    for r in got:
        if r["doc_id"] is not None:
            assert (r["n_shingles"], r["component_id"]) == (len(plain[r["doc_id"]]), want[r["doc_id"]])
    out = jaccard.one_of_each(docs, width=4, percent=85)
    assert out.columns == docs.columns
    kept = [r["doc_id"] for r in out.collect()]
    wanted = [i for i in plain if want[i] == i]
    assert sorted(i for i in kept if i is not None) == sorted(wanted) and kept.count(None) == 2


def test_shared_passage_makes_no_pairs(spark, monkeypatch):
    """Short texts that share a passage, but are not similar, are not compared."""
    monkeypatch.setattr(jaccard, "SMALL", 4)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(i, " ".join(f"a{i}x{j}" for j in range(7)) + f" {passage} " + " ".join(f"b{i}x{j}" for j in range(7))) for i in range(80)]
    rows += [(80 + i, rows[i][1] + " end") for i in range(0, 80, 20)]
    asked, plausible = [], jaccard.Join._plausible

    def watched(self, pairs):
        asked.append(pairs.count())
        return plausible(self, pairs)

    monkeypatch.setattr(jaccard.Join, "_plausible", watched)
    join = jaccard.Join(spark.createDataFrame(rows, "doc_id long, text string"))
    nodes = {r["rep"]: r["component_id"] for r in join.nodes.collect()}
    assert nodes == plain_components(plain_sets(rows), 85)
    assert sum(asked[1:]) < 80


def test_prefix_rows_do_not_grow_with_copies_within_components(spark):
    """Prefixes hold the shingles that sets of two components share, however many sets a component has."""
    bits, held_bits = 1, 16

    def rows(copies):
        sets = []
        for label in range(4):
            own = [mixed(100 * label + i) for i in range(40)]
            for c in range(copies):
                # All share 30 of 40 shingles with their component; 1 and 2 also share their first ten.
                members = own[:-10] + [mixed(10_000 + 1000 * label + 10 * c + i) for i in range(10)]
                members[:10] = [mixed(77_000 + i) for i in range(10)] if label in (1, 2) else members[:10]
                sets.append((1000 * label + c, label, members))
        frame = spark.createDataFrame(sets, "node long, label long, members array<long>").repartition(3)
        counts = jaccard._counted(frame, bits, jaccard.SMALL, held_bits).cache()
        return jaccard._prefix_rows(frame, counts, bits, held_bits, 50).collect()

    def mixed(n):
        return int(np.random.default_rng(n).integers(-(1 << 63), 1 << 63))

    across = {mixed(77_000 + i) for i in range(10)}
    for copies in (2, 40):
        found = rows(copies)
        # Thirty shingles of its own come before those shared: none of the prefix of 21 is listed.
        assert len(found) < copies
    # A set that shares more than its rest has the shared ones in its prefix, once each.
    sets = [(n, label, sorted(across) + [mixed(500 + 10 * n + i) for i in range(3)]) for n, label in ((1, 1), (2, 1), (3, 2))]
    frame = spark.createDataFrame(sets, "node long, label long, members array<long>").repartition(3)
    counts = jaccard._counted(frame, bits, jaccard.SMALL, held_bits).cache()
    got = {}
    for r in jaccard._prefix_rows(frame, counts, bits, held_bits, 50).collect():
        got.setdefault(r["node"], set()).add(r["shingle"])
    assert set(got) == {1, 2, 3} and set.intersection(*got.values()) & across


@pytest.mark.parametrize("few", [0, 1000])
def test_one_id_on_two_texts(spark, monkeypatch, few):
    """Every node is compared with the set of its own text."""
    monkeypatch.setattr(jaccard, "FEW", few)
    words = [f"w{i}" for i in range(80)]
    other = [f"v{i}" for i in range(80)]
    rows = [(1, " ".join(words)), (1, " ".join(other)), (2, " ".join(words[:-1])), (3, " ".join(other[:-1]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    join = jaccard.Join(docs)
    sets = {r["node"]: len(r["members"]) for r in join._sets(join.nodes, "test").collect()}
    want = {r["node"]: r["n_shingles"] for r in join.rows.collect()}
    assert sets == want and sorted(sets.values()) == [76, 76, 77, 77]
    assert [r["component_id"] for r in join.nodes.collect()] == [1] * 4


def test_shingle_sets_tell_texts_apart():
    texts = [b"a b c d", b"a b c", b"", b"  ", b"A  b\tC d", b"a b c d e", b"b a c d", "é b c d".encode()]
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    bounds = np.cumsum([0] + [len(t) for t in texts])
    words, at = word_hashes(data, bounds)
    assert np.diff(at).tolist() == [4, 3, 0, 0, 4, 5, 4, 4]
    hashes, edges = shingle_sets(words, at, 4)
    got = [frozenset(hashes[a:b].tolist()) for a, b in zip(edges, edges[1:])]
    assert got[0] == got[4] and len(got[5]) == 2 and got[0] < got[5]
    assert len({g for g in got if g}) == 5


def plain_removal(texts, length=100):
    seen, out = set(), {}
    for i, raw in texts:
        cover = np.zeros(len(raw) + 1, dtype=bool)
        for k in range(len(raw) - length + 1):
            w = raw[k : k + length]
            if w in seen:
                cover[k : k + length] = True
            seen.add(w)
        cover = cover[: len(raw)]
        kept = bytes(np.frombuffer(raw, np.uint8)[~cover])
        runs = int((np.diff(np.r_[0, cover.astype(int), 0]) == 1).sum())
        out[i] = (len(raw), int(cover.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


def repeats(n=60, seed=3):
    r = random.Random(seed)
    passages = [prose(2000 + k, r.choice([14, 20, 30, 60])) for k in range(8)]
    rows = []
    for i in range(n):
        text = prose(3000 + i, r.randrange(0, 120))
        for _ in range(r.randrange(0, 4)):
            p = r.choice(passages)
            cut = r.randrange(0, len(p) // 3)
            at = r.randrange(0, len(text) + 1)
            text = text[:at] + p[cut:] + text[at:]
        rows.append((i, text))
    rows += [(n, "a" * 700), (n + 1, "ab" * 300), (n + 2, "x" * 99), (n + 3, "é漢" * 120), (n + 4, None), (n + 5, rows[7][1])]
    r.shuffle(rows)
    return rows


def test_substring_removal_equals_plain_scan(spark):
    rows = repeats()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = plain_removal(sorted((i, (t or "").encode()) for i, t in rows))
    got = {r["doc_id"]: tuple(r)[1:] for r in substrings.substring_digest(docs).collect()}
    assert got == want


def test_substring_slices_and_small_arrays(spark, monkeypatch):
    monkeypatch.setattr(substrings, "SLICE_BYTES", 250)
    data = np.frombuffer(("q" * 40 + prose(1, 200)).encode(), np.uint8)
    text, lo, size, _, _ = substrings.anchors(data, np.array([0, 300, len(data)]))
    covered = [set(), set()]
    for t, a, n in zip(text, lo, size):
        covered[t].update(range(a, a + n - 99))
    assert covered[0] == set(range(201)) and covered[1] == set(range(len(data) - 300 - 99))


@pytest.mark.parametrize("array_bytes", [1 << 20, 3000])
def test_repeated_strings_equal_plain_scan(array_bytes):
    r = random.Random(5)
    common = prose(6, 60).encode()
    segments = []
    for i in range(60):
        a = r.randrange(0, len(common) - 150)
        segments.append(prose(i, 3).encode() + common[a : a + r.randrange(100, 150)] + prose(i + 99, 2).encode())
    seen, want = set(), []
    for s in segments:
        own = []
        for k in range(len(s) - 99):
            if s[k : k + 100] in seen:
                own.append(k)
            seen.add(s[k : k + 100])
        want.append(own)
    got = substrings.repeated_strings(segments, array_bytes)
    assert [g.tolist() for g in got] == want


def test_common_passage_in_differing_contexts(spark, monkeypatch):
    """Segments that name one anchor do not meet in one task when they are many."""
    monkeypatch.setattr(substrings, "HOT_ROWS", 20, raising=False)
    monkeypatch.setattr(substrings, "MERGE_ROWS", 500)
    seen, resolve = [], substrings._resolve

    def watched(cuts, shards):
        seen.append(cuts.groupBy("fp").count().agg({"count": "max"}).first()[0] or 0)
        return resolve(cuts, shards)

    monkeypatch.setattr(substrings, "_resolve", watched)
    passages = [prose(7001, 30)[:60], prose(7002, 40)[:110]]
    rows = [(i, prose(8000 + i, 20) + " " + passages[i % 3 % 2] + " " + prose(9000 + i % 40, 20)) for i in range(150)]
    rows += [(n + len(rows), t) for n, t in repeats(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = plain_removal(sorted((i, (t or "").encode()) for i, t in rows))
    got = {r["doc_id"]: tuple(r)[1:] for r in substrings.substring_digest(docs).collect()}
    assert got == want
    assert max(seen) <= 20


def test_substring_digest_on_odd_rows(spark):
    docs = documents(spark)
    got = substrings.substring_digest(docs).collect()
    assert len(got) == docs.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], set()).add(tuple(r)[1:])
    assert len(by_id[306]) == 1  # equal rows, one result
    assert all(n[1] <= n[0] for rows in by_id.values() for n in rows)


def test_empty_tables(spark):
    empty = no_documents(spark)
    bench = spark.createDataFrame([], "item_id long, text string")
    assert jaccard.jaccard_digest(empty).count() == 0
    assert substrings.substring_digest(empty).count() == 0
    assert decontaminate.contamination_digest(empty, bench).count() == 0
    docs = documents(spark)
    assert not any(r["contaminated"] for r in decontaminate.contamination_digest(docs, bench).collect())
