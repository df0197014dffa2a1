import zlib

import pytest
from pyspark.sql import functions as F

from martlet.llm import mix, shard
from tests.llm.frames import documents, no_documents


def fair_targets(sizes, weights=(1, 2, 3), cap=3):
    """Shares by weight; what lies over a cap is shared again among the rest."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, out, left = sum(sizes.values()), {}, set(names)
    while left:
        free = total - sum(out.values())
        level = free / sum(weight[s] for s in left)
        over = {s for s in left if level * weight[s] > cap * sizes[s]}
        if not over:
            out.update({s: level * weight[s] for s in left})
            break
        out.update({s: cap * sizes[s] for s in over})
        left -= over
    return out


def test_mix_digest_meets_targets_and_caps(spark):
    docs = documents(spark)
    rows = mix.mix_digest(docs).collect()
    assert len(rows) == docs.count()
    sizes, taken, target = {}, {}, {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    want = fair_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s], abs=1e-6)
        assert abs(taken[s] - target[s]) <= mix.BLOCK_WORDS
    assert all(r["source_size"] == sizes[r["source"]] for r in rows)
    again = mix.mix_digest(docs).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_mixed_texts_hold_the_taken_words(spark):
    docs = documents(spark)
    out = mix.mixed_texts(docs)
    assert out.columns == docs.columns
    got = {r["source"]: r["n"] for r in out.groupBy("source").agg(F.sum(mix.word_count(F.col("text"))).alias("n")).collect()}
    want = {}
    for r in mix.mix_digest(docs).collect():
        want[r["source"]] = want.get(r["source"], 0) + r["taken"]
    assert got == {s: n for s, n in want.items() if n}
    assert out.filter(F.length("text") != F.col("n_chars")).count() == 0


def test_permutation_is_a_bijection(spark):
    for n in (1, 2, 7, 100, 1023):
        out = spark.range(n).select(mix.permuted(F.col("id"), F.lit(n), F.lit(3)).alias("p")).collect()
        assert sorted(r["p"] for r in out) == list(range(n))
    out = [r["p"] for r in spark.range(500).select(mix.permuted(F.col("id"), F.lit(500), F.lit(1)).alias("p")).collect()]
    assert out != list(range(500))


def test_shards_are_gapless_and_keyed(spark):
    docs = documents(spark)
    rows = shard.sharded_digest(docs).collect()
    assert len(rows) == docs.count()
    text_of = {(r["doc_id"], len((r["text"] or "").encode()) + 1): r["text"] for r in docs.collect()}
    slots, where = {}, {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert where.setdefault(r["doc_id"], r["shard"]) == r["shard"]
        assert r["grown_shard"] in (r["shard"], shard.SHARDS)
        assert r["text_crc32"] == zlib.crc32((text_of[r["doc_id"], r["size"]] or "").encode())
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    assert sorted(map(str, shard.sharded_digest(docs).collect())) == sorted(map(str, rows))


def test_buckets_split_shards_and_keep_columns(spark):
    docs = documents(spark)
    out = shard.shuffle_into_shards(docs, "doc_id", F.octet_length("text"), shards=2, bucket_bytes=2000, bucket_rows=5)
    assert set(out.columns) == set(docs.columns)
    rows = out.collect()
    for s in {r["shard"] for r in rows}:
        got = [r["slot"] for r in rows if r["shard"] == s]
        assert sorted(got) == list(range(len(got)))
    assert sorted(str(r["text"]) for r in rows) == sorted(str(r["text"]) for r in docs.collect())


def test_shards_written_in_slot_order(spark, scratch):
    out = shard.shuffle_into_shards(spark.range(300), "id", F.lit(1), shards=3)
    shard.write_shards(out, f"{scratch}/shards")
    back = spark.read.parquet(f"{scratch}/shards")
    assert back.count() == 300 and back.select("shard").distinct().count() == 3


def test_layout_changes_neither_mix_nor_slots(spark, scratch):
    docs = documents(spark)
    few, many = docs.coalesce(1).orderBy(F.desc("text")), docs.repartition(13, F.rand(5))
    few.write.parquet(f"{scratch}/few")
    many.write.parquet(f"{scratch}/many")
    before, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for folder, partitions in (("few", "3"), ("many", "16")):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            rows = spark.read.parquet(f"{scratch}/{folder}")
            split = shard.shuffle_into_shards(rows, "doc_id", F.octet_length("text"), shards=3, bucket_bytes=2000, bucket_rows=5)
            results = (mix.mix_digest(rows), mix.mixed_texts(rows), shard.sharded_digest(rows), split)
            seen.append([sorted(map(str, r.collect())) for r in results])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1]


def test_records_with_maps_are_sharded(spark):
    rows = spark.range(20).select("id", F.create_map(F.lit("a"), "id").alias("m"), F.array(F.create_map(F.lit("a"), "id")).alias("ms"))
    out = shard.shuffle_into_shards(rows, "id", F.lit(1), shards=2).collect()
    assert sorted(r["id"] for r in out) == list(range(20)) and all(r["m"]["a"] == r["id"] for r in out)


def test_empty_tables(spark):
    empty = no_documents(spark)
    assert mix.mix_digest(empty).count() == 0
    assert mix.mixed_texts(empty).count() == 0
    assert shard.sharded_digest(empty).count() == 0
