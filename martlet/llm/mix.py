"""Mixing sources to target weights (DataFrame functions only).

The words of a source, in a seeded document order, form one stream that is cut
into blocks of ``BLOCK_WORDS``. Each source gets a target share of the whole,
at most ``MAX_PASSES`` times its size, and from it a number of block draws.
The draws of all sources are thrown onto the output positions by a
pseudorandom permutation; an output shard is a run of positions, so its counts
per source are one multinomial draw, conditioned on the totals. Draw ``j`` of a
source is block ``perm(j mod n)`` of pass ``j div n``, where ``perm`` is the
pseudorandom permutation of that source and pass. Slots and blocks meet in a
join on (source, block).

The permutations are swap-or-not shuffles: each round maps x to K - x (mod n)
when a hash of the pair says so, which is a bijection of [0, n) for every n and
needs no sort. Stream positions come from a two-level running sum over salted
groups of a source (as many salts as the square root of the rows), so a hot
source is never one task's window. Salt and order come from what a row holds
(its id and a hash of its text), so files, cores and partitions of the input
change nothing; rows that are equal in both share a salt, and a row number only
tells them apart.

Defined cases: null or blank text has no words, is in no block and is taken 0
times; a null source is a source of its own, last in order; repeated rows are
rows of their own; an empty table, or one without words, gives targets of 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm._io import Scratch, set_aside

#: A word, as the sizes count them.
WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 64
#: Weights of the sources in code point order, repeating.
WEIGHTS = (1, 2, 3)
MAX_PASSES = 3
SHARD_SLOTS = 4096
SEED = 90210
ROUNDS = 8
#: Draws that one row makes when the slots are generated.
SLOT_CHUNK = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def permuted(index: Column, n: Column, *key: Column, seed: int = SEED) -> Column:
    """Where the permutation of [0, n) named by ``key`` puts ``index``.

    The rounds run inside one ``aggregate``, whose variables are evaluated once
    a round; written as nested columns the expression would double every round.
    """

    def swap(x, r):
        mirror = F.pmod(F.pmod(F.xxhash64(F.lit(seed), r, *key), n) - x, n)
        side = F.xxhash64(F.lit(seed + 1), r, *key, F.greatest(x, mirror))
        return F.when(side.bitwiseAND(F.lit(1)) == 1, mirror).otherwise(x)

    rounds = F.array(*[F.lit(r) for r in range(ROUNDS)])
    return F.coalesce(F.aggregate(rounds, index, swap), F.lit(0).cast("long"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.0, max_passes: int = MAX_PASSES) -> DataFrame:
    """(source, source_size, rank, target) from rows of (source, source_size).

    A target is ``min(max_passes * size, level * weight)`` for the one level at
    which the targets add up to ``share`` of all words: what sharing by weight
    and resharing every excess ends in. Sorted by cap per weight, the level is
    that of the first source which its own level does not fill.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    cap = F.col("source_size") * F.lit(float(max_passes))
    ranked = (
        sizes.withColumn("rank", rank)
        .withColumns({"weight": weight, "cap": cap})
        .withColumn("fill", F.col("cap") / F.col("weight"))
    )
    by_fill = Window.orderBy("fill", "rank")
    earlier = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    later = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))) / F.sum(
        "weight"
    ).over(later)
    levels = ranked.withColumn("own", level)
    reached = F.min(F.when(F.col("own") <= F.col("fill"), F.struct("fill", "rank", "own"))).over(whole)
    return levels.withColumn("level", reached["own"]).select(
        "source",
        "source_size",
        "rank",
        F.coalesce(F.least("cap", F.col("level") * F.col("weight")), F.lit(0.0)).alias("target"),
    )


class Mix:
    """One mix of ``records``, which have ``source``, ``size`` (words) and ``tie`` columns.

    Rows stand in the order of ``order`` and ``tie``, a hash of their texts. ``rows``: the records with ``pos``, a row number of their own. ``sources``:
    targets and draws. ``segments``: the word ranges of each row in each block.
    ``slots``: what stands at each place of each output shard.
    """

    def __init__(self, records: DataFrame, order: str = "doc_id", block_words: int = BLOCK_WORDS, seed: int = SEED, **targets):
        self.scratch = Scratch(records.sparkSession, "mix")
        self.block_words, self.seed = block_words, seed
        base = records.drop("pos")
        self.rows = self.scratch.keep(base.withColumn("pos", F.monotonically_increasing_id()), "rows")
        n = self.rows.count()
        salts = max(1, math.isqrt(n))
        salt = F.pmod(F.xxhash64(F.lit(seed + 2), order, "tie"), F.lit(salts)).cast("int")
        narrow = self.rows.select("source", F.col("size").cast("long").alias("size"), "pos", F.col(order).alias("ord"), "tie", salt.alias("salt"))
        groups = narrow.groupBy("source", "salt").agg(F.sum("size").alias("words"))
        sizes = groups.groupBy("source").agg(F.sum("words").alias("source_size"))
        of_source = source_targets(sizes, **targets)
        blocks = F.ceil(F.col("source_size") / F.lit(block_words)).cast("long")
        draws = F.when(F.col("source_size") > 0, F.round(F.col("target") / F.col("source_size") * F.col("blocks")))
        upto = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
        self.sources = self.scratch.keep(
            of_source.withColumn("blocks", blocks)
            .withColumn("draws", F.coalesce(draws, F.lit(0)).cast("long"))
            .withColumn("first_draw", F.coalesce(F.sum("draws").over(upto), F.lit(0))),
            "sources",
        )
        self.total_draws = self.sources.agg(F.coalesce(F.sum("draws"), F.lit(0)).alias("n")).first()["n"]

        before = Window.partitionBy("source").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
        offsets = groups.withColumn("offset", F.coalesce(F.sum("words").over(before), F.lit(0))).drop("words")
        ranks = self.sources.select(F.col("source").alias("_s"), "rank")
        offsets = offsets.join(ranks, F.col("source").eqNullSafe(F.col("_s"))).select(
            F.col("source").alias("_s"), F.col("salt").alias("_salt"), "offset", "rank"
        )
        within = Window.partitionBy("source", "salt").orderBy("ord", "tie", "pos").rowsBetween(Window.unboundedPreceding, -1)
        starts = (
            narrow.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
            .filter("size > 0")
            .join(offsets, F.col("source").eqNullSafe(F.col("_s")) & (F.col("salt") == F.col("_salt")))
            .select("pos", "rank", "size", (F.col("offset") + F.col("inner")).alias("start"))
        )
        b = F.lit(block_words)
        cut = starts.withColumn(
            "block", F.explode(F.sequence(F.floor(F.col("start") / b), F.floor((F.col("start") + F.col("size") - 1) / b)))
        )
        first = F.greatest(F.col("start"), F.col("block") * b)
        last = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * b)
        self.segments = cut.select(
            "pos", "rank", "block", (first - F.col("start")).alias("first"), (last - first).alias("words"), "size"
        )

    def slots(self) -> DataFrame:
        """(shard, slot, rank, pass, block) of every draw."""
        chunks = self.sources.filter("draws > 0").withColumn(
            "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("draws") - 1) / SLOT_CHUNK)))
        )
        parts = max(1, self.total_draws // (64 * SLOT_CHUNK))
        at = F.col("chunk") * SLOT_CHUNK
        draws = (
            chunks.repartition(parts, "rank", "chunk")
            .select("rank", "blocks", "first_draw", F.explode(F.sequence(at, F.least(at + SLOT_CHUNK, "draws") - 1)).alias("j"))
            .withColumn("pass", F.floor(F.col("j") / F.col("blocks")))
        )
        place = permuted(F.col("first_draw") + F.col("j"), F.lit(max(1, self.total_draws)), seed=self.seed + 3)
        block = permuted(F.pmod("j", "blocks"), F.col("blocks"), F.col("rank"), F.col("pass"), seed=self.seed + 5)
        return draws.select("rank", "pass", place.alias("place"), block.alias("block")).select(
            F.floor(F.col("place") / SHARD_SLOTS).alias("shard"),
            F.pmod("place", F.lit(SHARD_SLOTS)).alias("slot"),
            "rank",
            "pass",
            "block",
        )

    def taken(self) -> DataFrame:
        """(pos, taken): the words that the mix takes of each row it takes from."""
        drawn = self.slots().groupBy("rank", "block").agg(F.count("*").alias("times"))
        return (
            self.segments.hint("merge").join(drawn, ["rank", "block"])
            .groupBy("pos")
            .agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
        )

    def passages(self) -> DataFrame:
        """(pos, pass, parts, words): the word ranges taken of a row in one pass."""
        return (
            self.segments.hint("merge").join(self.slots().select("rank", "block", "pass"), ["rank", "block"])
            .groupBy("pos", "pass")
            .agg(
                F.sort_array(F.collect_list(F.struct("first", "words"))).alias("parts"),
                F.sum("words").alias("words"),
            )
        )


def mixed_texts(documents: DataFrame, **params) -> DataFrame:
    """The mix as documents: for each pass over a document, the text it takes.

    A pass that takes the whole document keeps its text as it is; otherwise the
    taken words follow each other with one space. ``n_chars`` is recounted when
    the input has it; the other columns are kept.
    """
    docs, back = set_aside(documents, "doc_id", "source", "text", "n_chars")
    mix = Mix(docs.withColumns({"size": word_count(F.col("text")), "tie": F.xxhash64("text")}), **params)
    joined = mix.rows.hint("merge").join(mix.passages(), "pos")

    def cut(words):
        return F.flatten(F.transform(F.col("parts"), lambda p: F.slice(words, (p["first"] + 1).cast("int"), p["words"].cast("int"))))

    found = F.array(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    some = F.array_join(F.element_at(F.transform(found, cut), 1), " ")
    text = F.when(F.col("words") == F.col("size"), F.col("text")).otherwise(some)
    out = joined.withColumn("text", text)
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return back(out)


def mix_digest(documents: DataFrame) -> DataFrame:
    """``op1``: target of every document's source and the words taken of it."""
    records = documents.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("tie"))
    mix = Mix(records)
    of_source = mix.sources.select(F.col("source").alias("_s"), "source_size", "target")
    return (
        mix.rows.join(of_source, F.col("source").eqNullSafe(F.col("_s")))
        .join(mix.taken().hint("merge"), "pos", "left")
        .select(
            "doc_id",
            "size",
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
            "source",
        )
    )
