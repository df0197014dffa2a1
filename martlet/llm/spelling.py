"""Spelling variants: words one edit apart, and the commoner form each belongs to.

Words are counted over whole texts. Two words are near if one inserted, deleted
or replaced code point turns one into the other: their common prefix and common
suffix together reach the longer length minus one. That is decided by dense
tiles: words of one length class are rows of padded code-point matrices, aligned
left for prefixes and right for suffixes, and blocks of rows are compared with
each other column by column.

Only words that can be near meet in a tile. In the class of a longer length M
(words of M and of M - 1 code points) a near pair agrees in the first half of
the M - 1 places or else in the second, so every word goes into a group by its
first and one by its last half. A group of more than ``GROUP`` words is split
the same way on the places between, and again, until it is small; with one place
between there are no more members than an alphabet has letters. A pair counts
only where each split was taken for its common prefix, which is one group. So no
group of many words meets in one task, and no pair is missed or found twice.

A word's form is its commonest near word, if that is at least twice as frequent;
roots follow the forms by pointer doubling.

Defined cases: null and empty texts have no words; a null id counts as empty
text in the seeded deletions; repeated rows count each time; words of any length
are compared whole, long ones in smaller blocks; an empty table gives no rows;
further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm._io import Scratch
from martlet.llm.urls import LOWER, UPPER

RUN = "[A-Za-zÀ-ÿ]+"
#: Of the runs of a document, one in ``SLIP`` loses a code point.
SLIP = 97
MIN_LENGTH, MIN_COUNT = 5, 3
#: How many times as frequent a word's form is, at least.
RATIO = 2
#: Words of one group, of one block, and code points of one block.
GROUP, BLOCK, BLOCK_POINTS = 1024, 256, 1 << 20
#: Rows that a task gathers before it compares them, and rows of one task.
GATHER, TASK_ROWS = 4096, 1 << 16
_KEY = ["m", "p", "s", "cap", "pre", "suf"]


def slipped(doc_id: Column, run: Column) -> Column:
    """The run, without one code point if the checksum of id and run says so."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.length(run).cast("long")).cast("int")
    return F.when(F.pmod(h, F.lit(SLIP)) == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) over all texts."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("run"))
    words = runs.filter(F.length("run") >= min_length).select(slipped(F.col("doc_id"), F.col("run")).alias("word"))
    return words.filter(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


def _split(rows: DataFrame) -> DataFrame:
    """Every row of a group (longer length ``m``, ``p`` places of prefix and ``s`` of suffix shared) in its two parts.

    ``cap``: a pair's common prefix must stay below it, else it counts elsewhere.
    """
    open_places = F.col("m") - F.col("p") - F.col("s") - 1
    first = F.ceil(open_places / 2).cast("int")
    last = (F.floor(open_places / 2) + 1).cast("int")
    p, s, cap = F.col("p"), F.col("s"), F.col("cap")
    parts = F.array(
        F.struct((p + first).alias("p"), s.alias("s"), cap.alias("cap")),
        F.struct(p.alias("p"), (s + last).alias("s"), F.least(cap, p + first).alias("cap")),
    )
    cut = rows.select("word", "n", "m", F.explode(parts).alias("part")).select("word", "n", "m", "part.*")
    return cut.select("*", F.expr("substring(word, 1, p)").alias("pre"), F.expr("right(word, s)").alias("suf"))


def tile_groups(words: DataFrame, scratch: Scratch, group: int = GROUP) -> DataFrame:
    """The words (word, n) in groups of at most ``group`` that hold all near pairs."""
    length = F.length("word")
    start = words.select("word", "n", F.explode(F.array(length, length + 1)).alias("m"))
    rows = _split(start.withColumns({"p": F.lit(0), "s": F.lit(0), "cap": F.col("m")}))
    done, step = None, 0
    while True:
        rows = scratch.keep(rows, f"split-{step}")
        sizes = rows.groupBy(*_KEY).agg(F.count("*").alias("size"), F.max(F.length("word")).alias("top"))
        # Near words are two, and one of them has the longer length.
        sizes = sizes.filter((F.col("size") > 1) & (F.col("top") == F.col("m"))).drop("top")
        sized = scratch.keep(rows.join(sizes.hint("merge"), _KEY), f"sized-{step}")
        scratch.drop(f"split-{step}")
        large = (F.col("size") > group) & (F.col("m") - F.col("p") - F.col("s") > 1)
        small = sized.filter(~large).drop("size")
        done = small if done is None else done.unionByName(small)
        rest = sized.filter(large)
        if rest.isEmpty():
            return done
        rows, step = _split(rest), step + 1


def _points(words: list[str], width: int, right: bool, pad: str) -> np.ndarray:
    text = "".join(w.rjust(width, pad) if right else w.ljust(width, pad) for w in words)
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).reshape(len(words), width)


def _common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Leading columns in which each row of ``x`` agrees with each row of ``y``."""
    alive = np.ones((len(x), len(y)), dtype=bool)
    out = np.zeros((len(x), len(y)), dtype=np.int32)
    for j in range(x.shape[1]):
        alive &= x[:, j][:, None] == y[:, j][None, :]
        if not alive.any():
            break
        out += alive
    return out


def near_tile(x: list[str], y: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(near, common prefix) of all words of ``x`` with all of ``y``, neither longer than ``width``."""
    prefix = _common(_points(x, width, False, "\0"), _points(y, width, False, "\1"))
    suffix = _common(_points(x, width, True, "\0")[:, ::-1], _points(y, width, True, "\1")[:, ::-1])
    lx, ly = np.array([len(w) for w in x])[:, None], np.array([len(w) for w in y])[None, :]
    longer, shorter = np.maximum(lx, ly), np.minimum(lx, ly)
    differ = (prefix < longer) & (longer - shorter <= 1)
    return differ & (prefix + suffix >= longer - 1), prefix


def _compared(m: int, rows: list[tuple]) -> list[tuple]:
    """(word, near, best_n, best) from whole groups of one length class; rows (group, cap, word, n) in group order."""
    size = max(1, min(BLOCK, BLOCK_POINTS // m))
    blocks = [rows[i : i + size] for i in range(0, len(rows), size)]
    out = []
    for i, a in enumerate(blocks):
        for b in blocks[i:]:
            if b[0][0] > a[-1][0]:
                break
            near, prefix = near_tile([r[2] for r in a], [r[2] for r in b], m)
            ga, gb = np.array([r[0] for r in a]), np.array([r[0] for r in b])
            la, lb = np.array([len(r[2]) for r in a]), np.array([len(r[2]) for r in b])
            near &= (ga[:, None] == gb[None, :]) & (prefix < np.array([r[1] for r in a])[:, None])
            near &= np.maximum(la[:, None], lb[None, :]) == m
            sides = [(a, b, near)] if a is b else [(a, b, near), (b, a, near.T)]
            for mine, other, hits in sides:
                if not hits.any():
                    continue
                # Places in the order of forms: most frequent first, then by code points.
                order = sorted(range(len(other)), key=lambda k: (-other[k][3], other[k][2]))
                ranked = hits[:, order]
                for k in np.flatnonzero(ranked.any(axis=1)):
                    best = other[order[int(ranked[k].argmax())]]
                    out.append((mine[k][2], int(ranked[k].sum()), best[3], best[2]))
    return out


def near_words(groups: DataFrame) -> DataFrame:
    """(word, near, best_n, best): what the tiles of each group find, in parts."""

    def run(batches):
        rows, m, key, number = [], None, None, 0

        def flush():
            found = _compared(m, rows)
            columns = list(zip(*found)) if found else [[], [], [], []]
            types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types)]
            return pa.RecordBatch.from_arrays(arrays, names=["word", "near", "best_n", "best"])

        for batch in batches:
            for word, n, *now in zip(*(batch.column(i).to_pylist() for i in range(8))):
                now = tuple(now)
                if now != key:
                    if rows and (now[0] != m or len(rows) >= GATHER):
                        yield flush()
                        rows = []
                    key, m, number = now, now[0], number + 1
                rows.append((number, now[3], word, n))
        if rows:
            yield flush()

    # Small rows, much work: the parts follow the rows, not their bytes.
    parts = groups.count() // TASK_ROWS + 1
    ordered = groups.select("word", "n", *_KEY).repartition(parts, *_KEY).sortWithinPartitions(*_KEY)
    return ordered.mapInArrow(run, "word string, near long, best_n long, best string")


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) of every word (word, form) that has a form: the end of its chain of forms."""
    ups = scratch.keep(forms.select("word", F.col("form").alias("root")), "roots-0")
    step = 0
    while True:
        above = ups.select(F.col("word").alias("root"), F.col("root").alias("higher"))
        ahead = ups.join(above.hint("merge"), "root", "left")
        step += 1
        moved = ahead.select("word", F.coalesce("higher", "root").alias("root"), F.col("higher").isNotNull().alias("moved"))
        moved = scratch.keep(moved, f"roots-{step}")
        scratch.drop(f"roots-{step - 1}")
        ups = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return ups


def spelling_variants(words: DataFrame, scratch: Scratch, group: int = GROUP, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near and form_n of the counted ``words`` (word, n)."""
    found = near_words(tile_groups(words, scratch, group))
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top")
    near = found.groupBy("word").agg(F.sum("near").alias("n_near"), best)
    enough = -F.col("top.less") >= F.col("n") * ratio
    rows = words.join(near.hint("merge"), "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("top.best")).alias("form"),
        F.when(enough, -F.col("top.less")).alias("form_n"),
    )
    rows = scratch.keep(rows, "forms")
    ends = roots(rows.filter("form IS NOT NULL"), scratch)
    return rows.join(ends.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_digest(documents: DataFrame) -> DataFrame:
    """``op12``: every counted word with its form and root."""
    scratch = Scratch(documents.sparkSession, "spelling")
    return spelling_variants(scratch.keep(word_counts(documents), "words"), scratch)
