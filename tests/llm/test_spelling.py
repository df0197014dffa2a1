"""Spelling variants against plain Python over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martlet.llm import spelling
from martlet.llm._io import Scratch
from tests.llm.frames import documents, no_documents

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_counts(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 3}


def plain_variants(counts):
    near = {w: [v for v in counts if one_edit(v, w)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items())


def answers(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in df.collect())


def vocabulary(seed, n, letters="abé", low=5, high=9):
    r = random.Random(seed)
    return {"".join(r.choice(letters) for _ in range(r.randint(low, high))): r.choice([3, 3, 4, 6, 9, 13, 40, 200]) for _ in range(n)}


@pytest.mark.parametrize("group", [2, 5, 1024])
def test_variants_of_a_dense_vocabulary(spark, group):
    words = vocabulary(group, 700)
    words |= {"x" * 3000: 3, "x" * 2999: 9, "x" * 1500 + "y" + "x" * 1499: 20}
    frame = spark.createDataFrame(list(words.items()), "word string, n long").repartition(5)
    assert answers(spelling.spelling_variants(frame, Scratch(spark, "t"), group)) == plain_variants(words)


def test_groups_stay_small(spark):
    words = {f"shared{i:05d}tail": 3 for i in range(5000)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    groups = spelling.tile_groups(frame, Scratch(spark, "t"), 100)
    assert groups.groupBy("m", "p", "s", "cap", "pre", "suf").count().agg(F.max("count")).first()[0] <= 100
    # The second digit has four others, each of the last three has nine.
    assert spelling.near_words(groups).agg(F.sum("near")).first()[0] == 5000 * (4 + 3 * 9)


def test_counts_and_forms_of_documents(spark):
    docs = documents(spark)
    typos = [(900 + i, "Reader READERS reders " * 2 + "Àbcéd cafés cafes ×÷×÷× " * (i % 3)) for i in range(300)]
    more = spark.createDataFrame(typos + [(None, "reader " * 4)], "doc_id long, text string")
    docs = docs.select("doc_id", "text").unionByName(more).withColumns({c: F.lit(c) for c in ("word", "run", "n", "m", "p")})
    counts = plain_counts([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert {"reader", "readers", "reders"} <= set(counts)
    assert answers(spelling.spelling_digest(docs)) == plain_variants(counts)


def test_empty_table(spark):
    assert answers(spelling.spelling_digest(no_documents(spark))) == []


@given(st.lists(st.text("abÿ", min_size=1, max_size=6), min_size=1, max_size=8), st.lists(st.text("abÿ", min_size=1, max_size=6), min_size=1, max_size=8))
@settings(max_examples=150, deadline=None)
def test_tiles_are_single_edits(x, y):
    near, _ = spelling.near_tile(x, y, 6)
    assert np.array_equal(near, [[one_edit(a, b) for b in y] for a in x])
