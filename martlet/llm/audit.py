"""Filter interaction audit: what five text filters remove in every order of use.

Each document gets the set of filters that it fails. Four are tests of its own
text; the fifth (``E``) fails when a document of smaller id has the same text.
That one is an existential self-join: a left-semi join of the documents with
the smallest id of each text, on the hash of the text, where the id is smaller.
Texts are compared exactly: the smallest ids come from groups of the whole
texts, and where one hash stands for several texts, its documents are joined on
the text itself as well. Copies shrink to one row of a group per task before
they are shuffled, so a text held by many documents is carried once per task.

The ids of the self-join are united with the failures of the other filters and
summed to one bit combination per document. Everything else is arithmetic on
the counts of (part, combination): a filter at a given step removes what fails
it and none of the filters before it, whatever their order, so there are only
80 cases of a filter and a set before it, from which the 600 steps are read.

Defined cases: a null text is empty; a null source is the empty part; a null id
is never smaller than another and has no labels; rows of one id are documents of
their own; rows equal in id and text do not repeat each other; a document with
several label rows has a mark if one of them has it; an empty table gives no
rows; further columns are not read. A source whose documents all pass still has
its 600 rows.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm._io import Scratch

#: Filters in the order of their bits; the last is the one on repeated texts.
LETTERS = "ABCDE"
WORD = r"[^\x20\x09-\x0D]+"
MIN_WORDS = 50
#: Percent: distinct words among all, at least; capitals among code points, at most.
MIN_DISTINCT, MAX_CAPITALS = 65, 5
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = "[#$%&*|]"


def text_hash(text: Column) -> Column:
    return F.xxhash64(text)


def own_failures(text: Column, words: Column) -> list[Column]:
    """The tests of a document's own text, true where it fails, in the order of ``LETTERS``."""
    n, chars = F.size(words), F.length(text)
    capitals = chars - F.length(F.translate(text, CAPITALS, ""))
    return [
        n < MIN_WORDS,
        F.size(F.array_distinct(words)) * F.lit(100) < n * F.lit(MIN_DISTINCT),
        capitals.cast("long") * 100 > chars.cast("long") * MAX_CAPITALS,
        text.rlike(MARKS),
    ]


def _own(docs: DataFrame, hash_of) -> DataFrame:
    """Rows (doc_id, part, hash, mark, bits, text) of all documents."""
    text, words = F.col("text"), F.col("words")
    bits = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(own_failures(text, words))), F.lit(0))
    return (
        docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
        .select(
            "doc_id",
            "part",
            hash_of(text).alias("hash"),
            F.xxhash64(F.lit(1), text).alias("mark"),
            bits.alias("bits"),
            "text",
        )
    )


def repeats(rows: DataFrame, docs: DataFrame, scratch: Scratch, hash_of=text_hash) -> DataFrame:
    """The ``rows`` (as of ``_own``, without text) that repeat the text of a smaller id."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), "doc_id").withColumn("hash", hash_of(F.col("text")))
    firsts = texts.groupBy("hash", "text").agg(F.min("doc_id").alias("first"))
    firsts = scratch.keep(firsts.select("hash", "first"), "firsts")
    clashes = firsts.groupBy("hash").agg(F.count("*").alias("n"), F.min("first").alias("first"))
    clashes = scratch.keep(clashes, "hashes")
    alone = clashes.filter("n = 1").select(F.col("hash").alias("hash2"), "first")
    cut = (rows["hash"] == alone["hash2"]) & (alone["first"] < rows["doc_id"])
    found = rows.join(alone.hint("merge"), cut, "left_semi")
    several = clashes.filter("n > 1").select("hash")
    if several.isEmpty():
        return found
    # Hashes of several texts: the same join with the text among its keys.
    wide = _own(docs, hash_of).join(several.hint("merge"), "hash", "left_semi")
    whole = texts.join(several.hint("merge"), "hash", "left_semi").groupBy("hash", "text").agg(F.min("doc_id").alias("first"))
    whole = whole.select(F.col("hash").alias("hash2"), F.col("text").alias("text2"), "first")
    cut = (wide["hash"] == whole["hash2"]) & (wide["text"] == whole["text2"]) & (whole["first"] < wide["doc_id"])
    return found.unionByName(wide.join(whole.hint("merge"), cut, "left_semi").select(rows.columns))


def failure_masks(docs: DataFrame, scratch: Scratch, hash_of=text_hash) -> DataFrame:
    """(doc_id, part, mask, n): the failed filters as bits, for ``n`` rows of a document."""
    rows = scratch.keep(_own(docs, hash_of).drop("text"), "rows")
    repeated = repeats(rows, docs, scratch, hash_of)
    last = 1 << (len(LETTERS) - 1)
    both = rows.withColumns({"more": F.lit(0), "n": F.lit(1)}).unionByName(
        repeated.withColumns({"more": F.lit(last), "n": F.lit(0)})
    )
    summed = both.groupBy("doc_id", "hash", "mark", "part", "bits").agg(F.max("more").alias("more"), F.sum("n").alias("n"))
    return summed.select("doc_id", "part", (F.col("bits") + F.col("more")).alias("mask"), "n")


def combinations(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents, and those marked, for each bit combination."""
    marks = labels.groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    marked = masks.join(marks.hint("merge"), "doc_id")
    every = masks.groupBy("part", "mask").agg(F.sum("n").alias("n"))
    lost = marked.groupBy("part", "mask").agg(
        F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")
    )
    nothing = F.lit(0).cast("long")
    rows = every.withColumns({"good": nothing, "toxic": nothing}).unionByName(lost.withColumn("n", nothing))
    return rows.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def order_report(combos: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row for each part, order of the filters and step in it."""
    k, every = len(letters), (1 << len(letters)) - 1
    cases = [(before * k + i, before, 1 << i) for i in range(k) for before in range(every + 1) if not before >> i & 1]
    steps = []
    for order in permutations(range(k)):
        before = 0
        for step, i in enumerate(order):
            steps.append((before * k + i, "".join(letters[j] for j in order), step + 1))
            before |= 1 << i
    steps = combos.sparkSession.createDataFrame(steps, "case int, filter_order string, step int")

    cases = F.array(*[F.struct(*[F.lit(x).alias(c) for x, c in zip(row, ("case", "before", "bit"))]) for row in cases])
    rows = combos.select("*", F.explode(cases).alias("c")).select(*combos.columns, "c.*")
    before, bit = F.col("before"), F.col("bit")
    fails, spared = F.col("mask").bitwiseAND(bit) != 0, F.col("mask").bitwiseAND(before) == 0

    def total(what: Column, where: Column) -> Column:
        return F.sum(F.when(where, what).otherwise(F.lit(0).cast("long")))

    n = F.col("n")
    stats = rows.groupBy("part", "case").agg(
        total(n, spared & ~fails).alias("kept"),
        total(n, spared & fails).alias("removed"),
        total(n, ~spared & fails).alias("redundant"),
        total(n, F.col("mask") == bit).alias("unique_fails"),
        total(F.col("good"), spared & fails).alias("good_lost"),
        total(F.col("toxic"), spared & fails).alias("toxic_lost"),
        # Of the filters that a document fails, each comes first in an equal share of the orders.
        total(n * F.floor(F.lit(factorial(k)) / F.greatest(F.bit_count("mask"), F.lit(1))), fails).alias("shapley"),
    )
    # A few hundred steps, whatever the data.
    return stats.join(F.broadcast(steps), "case").select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def filter_audit(documents: DataFrame, labels: DataFrame, hash_of=text_hash) -> DataFrame:
    """``op11``: counts of every part, order and step."""
    scratch = Scratch(documents.sparkSession, "audit")
    masks = scratch.keep(failure_masks(documents, scratch, hash_of), "masks")
    return order_report(combinations(masks, labels))
