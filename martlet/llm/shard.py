"""Two-pass external shuffle into shards (DataFrame functions only).

Pass 1 gives every record a shard and, inside it, a memory-sized bucket, both
from seeded hashes, and writes the scattered records. Pass 2 sorts each bucket
by a seeded hash, draws a Fisher-Yates permutation of its positions
(``shuffle(sequence(...), seed)``) and numbers the records through it; bucket
offsets make the numbers of a shard gapless. ``shuffle`` seeds its draws by
partition, so bucket numbers alone decide the partition of a draw and its place
there: files, cores and shuffle partitions of the session change no slot.

Shards follow the ``key`` law by rendezvous hashing: a record goes to the
shard with the largest hash of (key, shard), so one more shard can only take
records into itself. The bucket of a record comes from a hash of its key and content, so
a repeated key cannot fill one bucket; records that are equal as a whole share a
bucket, and their position in the scan only tells them apart.

Defined cases: a null key hashes like any value; a null or empty text weighs
one byte; repeated rows keep one slot each; an empty table gives no rows;
columns of the input named like ``shard_col``/``slot_col`` are replaced.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm._io import Scratch

SHARDS = 16
SEED = 20177
#: Types without a hash, in the JSON of a column's type.
NO_HASH = re.compile(r'"(?:map|variant)"')
#: Bytes a bucket may hold, so that one task sorts it in memory.
BUCKET_BYTES = 32 << 20
#: Rows a bucket may hold, whatever their size.
BUCKET_ROWS = 250_000
#: Most tasks that draw permutations; each then draws for several buckets in order.
DRAW_TASKS = 1024


def rendezvous(key: Column, shards: int, seed: int = SEED) -> Column:
    """Shard of a key: the index of the largest of ``shards`` seeded hashes."""
    draws = F.array(*[F.xxhash64(F.lit(seed), F.lit(s), key) for s in range(shards)])
    return (F.array_position(draws, F.array_max(draws)) - 1).cast("int")


def shuffle_into_shards(
    records: DataFrame,
    key: str,
    size: Column,
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
    bucket_rows: int = BUCKET_ROWS,
    shard_col: str = "shard",
    slot_col: str = "slot",
) -> DataFrame:
    """``records`` with an int shard and a long slot, gapless from 0 in each shard."""
    spark = records.sparkSession
    scratch = Scratch(spark, "shard")
    base = records.drop(shard_col, slot_col)
    # Maps have no hash; records that differ in them alone count as equal here.
    content = [F.col(f"`{f.name}`") for f in base.schema if not NO_HASH.search(f.dataType.json())]
    placed = base.select(
        F.struct(*[F.col(f"`{c}`") for c in base.columns]).alias("rec"),
        F.coalesce(size, F.lit(1)).cast("long").alias("bytes"),
        rendezvous(F.col(f"`{key}`"), shards, seed).alias("s"),
        F.xxhash64(F.lit(seed + 1), F.col(f"`{key}`")).alias("h"),
        F.xxhash64(F.lit(seed + 3), *content).alias("content"),
        F.monotonically_increasing_id().alias("pos"),
    )
    scattered = scratch.keep(placed, "scattered")
    total = scattered.agg(F.sum("bytes").alias("b"), F.count("*").alias("n")).first()
    per_shard = max(1, -(-(total["b"] or 0) // (shards * bucket_bytes)), -(-total["n"] // (shards * bucket_rows)))
    bucket = F.col("s").cast("long") * per_shard + F.pmod(F.xxhash64(F.lit(seed + 2), "h", "content"), F.lit(per_shard))
    rows = scattered.withColumn("bucket", bucket)

    tasks = min(DRAW_TASKS, shards * per_shard)
    counts = rows.groupBy("s", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = counts.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    draws = (
        buckets.repartitionById(tasks, F.pmod("bucket", F.lit(tasks)).cast("int"))
        .sortWithinPartitions("bucket")
        .select("bucket", "offset", F.shuffle(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), seed).alias("draw"))
    )
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("h", "content", "pos"))
    return (
        rows.withColumn("rank", rank)
        .join(draws.hint("merge"), "bucket")
        .select(
            "rec.*",
            F.col("s").alias(shard_col),
            (F.col("offset") + F.element_at("draw", F.col("rank"))).alias(slot_col),
        )
    )


def write_shards(sharded: DataFrame, path: str, shard_col: str = "shard", slot_col: str = "slot") -> None:
    """Write one folder per shard, each file a contiguous, sorted run of slots."""
    (
        sharded.repartitionByRange(shard_col, slot_col)
        .sortWithinPartitions(shard_col, slot_col)
        .write.mode("errorifexists")
        .partitionBy(shard_col)
        .parquet(path)
    )


def sharded_digest(documents: DataFrame) -> DataFrame:
    """``op7``: shard and slot of every document under the ``key`` law."""
    text = F.coalesce(F.col("text"), F.lit(""))
    records = documents.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    return shuffle_into_shards(records, "doc_id", F.col("size")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        "slot",
        rendezvous(F.col("doc_id"), SHARDS + 1).alias("grown_shard"),
    )
