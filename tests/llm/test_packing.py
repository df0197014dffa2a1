"""Packing: laws of the pieces, an exact round trip, and the parts of the method."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from martlet.llm import packing
from martlet.llm._io import table
from tests.conftest import SF_SMOKE
from tests.llm.frames import documents, no_documents

COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


TOKENIZER = Tokenizer.from_file(packing.VOCABULARY)


def token_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1]


def check_laws(docs, pieces, window=2048):
    """Every document's ids lie once, in order, in gapless sequences; returns the share of padding."""
    wanted = sorted((i is None, i or 0, tuple(token_ids(t))) for i, t in docs)
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for doc_id, start, length, crc, n, sequence, offset in pieces:
        assert 0 < length <= window
        sequences[sequence].append((offset, length))
        by_doc[doc_id, n].append((start, length, crc))
    padded = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        padded += 0 if at & (at - 1) == 0 else window - at
    left = defaultdict(list)
    for null, i, ids in wanted:
        left[None if null else i, len(ids)].append(ids)
    for (doc_id, n), texts in left.items():
        got = sorted(by_doc.pop((doc_id, n)))
        assert sum(length for _, length, _ in got) == n * len(texts)
        if len(texts) == 1 or len(set(texts)) == 1:
            at = 0
            for start, length, crc in got:
                assert crc == zlib.crc32(np.array(texts[0][start : start + length], "<u4").tobytes())
                if len(texts) == 1:
                    assert start == at
                at += length
    assert not by_doc
    return padded


def rows(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def test_all_documents_of_a_table(spark):
    docs = table(spark, SF_SMOKE, "documents")
    out = packing.packing_digest(docs)
    assert out.columns == COLUMNS
    got = rows(out)
    assert check_laws([tuple(r) for r in docs.select("doc_id", "text").collect()], got) == 0
    cut = {r[0] for r in got if r[2] < min(2048, r[4]) and r[4] <= 2048}
    assert len(cut) < 0.25 * docs.count()


def test_odd_rows_many_shards_and_reruns(spark):
    odd = [(500, "a<|endoftext|>b"), (501, " " * 30000 + "x" + "\n" * 5000), (502, "y" * 50000), (503, "漢字" * 3000), (504, "tab\t   nbsp")]
    docs = documents(spark).select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    docs = docs.withColumns({c: F.lit(c) for c in ("start", "length", "shard", "tokens", "copy")})
    got = rows(packing.packed_pieces(docs, shard_bytes=40_000))
    assert check_laws([tuple(r) for r in docs.select("doc_id", "text").collect()], got) == 0
    once = docs.dropDuplicates(["doc_id", "text"])
    runs = [rows(packing.packed_pieces(once.repartition(n), shard_bytes=40_000)) for n in (2, 5)]
    assert sorted(runs[0], key=str) == sorted(runs[1], key=str)


def test_sequences_hold_the_ids(spark):
    docs = documents(spark, extra=False).filter("doc_id < 200")
    got = packing.packed_sequences(docs, window=256).collect()
    assert all(len(r["ids"]) == sum(r["lengths"]) for r in got)
    assert sorted(x for r in got for x in r["ids"]) == sorted(x for r in docs.collect() for x in token_ids(r["text"]))
    pieces = packing.packed_pieces(docs, window=256, with_ids=True).filter("doc_id = 3").orderBy("start").collect()
    assert [x for p in pieces for x in p["ids"]] == token_ids(docs.filter("doc_id = 3").first()["text"])


def test_a_third_of_all_rows_alike(spark):
    docs = spark.createDataFrame([(7 if i % 3 else i, "one two three" if i % 3 else f"row {i}") for i in range(600)], "doc_id long, text string")
    got = rows(packing.packed_pieces(docs, shard_bytes=500))
    assert check_laws([tuple(r) for r in docs.collect()], got) == 0
    sizes = defaultdict(int)
    for r in got:
        sizes[r[5] >> 32] += 1
    assert max(sizes.values()) < 0.3 * len(got)


def test_empty_table(spark):
    assert rows(packing.packing_digest(no_documents(spark))) == []


@given(st.lists(st.integers(1, 63), max_size=80))
@settings(max_examples=100, deadline=None)
def test_pack_places_every_token_once(lengths):
    lengths = np.array(lengths, dtype=np.int64)
    cut = packing.pack(lengths, window=64, unit=4)
    held, filled = defaultdict(list), defaultdict(list)
    for item, at, n, sequence, offset in cut.tolist():
        held[item].append((at, n))
        filled[sequence].append((offset, n))
    assert {i: sum(n for _, n in p) for i, p in held.items()} == dict(enumerate(lengths.tolist()))
    for parts in [*held.values(), *filled.values()]:
        assert [a for a, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:k]) for k in range(len(parts))]
    assert all(n == 64 or n & (n - 1) == 0 for n in (sum(x for _, x in p) for p in filled.values()))


@pytest.mark.parametrize("seed", range(5))
def test_least_squares_meets_its_conditions(seed):
    r = np.random.default_rng(seed)
    a, b = r.random((12, 40)) * (r.random((12, 40)) < 0.4), r.random(12) * 100
    x = packing.non_negative_least_squares(a, b)
    slope = a.T @ (b - a @ x)
    assert (x >= 0).all() and (slope <= 1e-6).all() and np.abs(slope[x > 0]).max() < 1e-6


def test_combinations_fill_a_window():
    a = packing.combinations(128)
    assert (np.arange(1, 129) @ a == 128).all()
    assert len(np.unique(a.T, axis=0)) == a.shape[1] and ((a > 0).sum(axis=0) <= 3).all()
