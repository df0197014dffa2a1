"""The filter interaction audit against plain Python."""

import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from martlet.llm import audit
from tests.llm.frames import documents, no_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int"


def fails(i, text, rows):
    words = WORD.findall(text)
    out = ""
    out += "A" if len(words) < 50 else ""
    out += "B" if 100 * len(set(words)) < 65 * len(words) else ""
    out += "C" if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text) else ""
    out += "D" if any(c in "#$%&*|" for c in text) else ""
    return out + ("E" if i is not None and any(j is not None and j < i and t == text for j, t, _ in rows) else "")


def plain(rows, labels):
    rows = [(i, t or "", s or "") for i, t, s in rows]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    failed = [(i, s, fails(i, t, rows)) for i, t, s in rows]
    out = []
    for part in {s for _, _, s in rows}:
        mine = [(i, f) for i, s, f in failed if s == part]
        removed_by = dict.fromkeys("ABCDE", 0)
        lines = []
        for order in permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                lost = [(i, f) for i, f in left if x in f]
                left = [(i, f) for i, f in left if x not in f]
                removed_by[x] += len(lost)
                alone = sum(f == x for _, f in mine)
                marks = (sum(i in good for i, _ in lost), sum(i in toxic for i, _ in lost))
                redundant = sum(x in f for _, f in mine) - len(lost)
                lines.append((x, part, "".join(order), step, len(left), len(lost), redundant, alone, *marks))
        out += [(*line[1:], removed_by[line[0]]) for line in lines]
    return sorted(out)


def odd_rows(spark):
    more = [
        (400, "Loud WORDS " * 40, "srcA"),
        (401, "a # b", "srcA"),
        (402, "a # b", None),
        (399, "a # b", ""),
        (399, "a # b", "srcA"),
        (None, "a # b", "srcA"),
        (403, "x y z " * 20000 + "|", "srcA"),
    ]
    return documents(spark).select("doc_id", "text", "source").unionByName(
        spark.createDataFrame(more, "doc_id long, text string, source string")
    )


def answers(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("hash_of", [audit.text_hash, lambda t: F.length(t).cast("long") % 7])
def test_audit_is_what_the_filters_do_one_by_one(spark, hash_of):
    docs = odd_rows(spark)
    labels = [(0, 1, 0), (1, 1, 1), (1, 0, 0), (201, 1, 1), (211, 0, 1), (300, 1, 1), (306, 1, 0), (None, 1, 1), (403, None, 1), (9999, 1, 1)]
    got = audit.filter_audit(docs, spark.createDataFrame(labels, LABELS), hash_of)
    assert got.columns[:3] == ["part", "filter_order", "step"]
    assert answers(got) == plain([tuple(r) for r in docs.collect()], labels)


def test_extra_columns_and_empty_tables(spark):
    docs = documents(spark).withColumns({c: F.lit(c) for c in ("hash", "bits", "part", "mask", "n", "first", "words", "case")})
    none = spark.createDataFrame([], LABELS)
    assert answers(audit.filter_audit(docs, none)) == plain([tuple(r) for r in docs.select("doc_id", "text", "source").collect()], [])
    assert audit.filter_audit(no_documents(spark), none).collect() == []


def test_a_third_of_all_rows_with_one_text(spark):
    rows = [(i, "one two" if i % 3 else f"text {i}", "s") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    got = audit.filter_audit(docs, spark.createDataFrame([], LABELS)).filter("filter_order = 'EABCD' and step = 1").collect()
    assert [(r["kept"], r["removed"]) for r in got] == [(301, 599)]
