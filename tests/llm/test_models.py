"""Language identification, toxicity, nearest neighbours: held-out accuracy and brute force."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from martlet.llm import ann, langid, toxicity
from martlet.llm._io import table
from tests.conftest import SF_CHECK
from tests.llm.frames import documents, no_documents, prose

LABEL_SCHEMA = "doc_id long, quality int, toxic int"


def test_language_of_held_out_documents(spark):
    docs = table(spark, SF_CHECK, "documents")
    got = langid.language_digest(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(got) > 200
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.98 * len(got)


def test_language_digest_on_odd_rows(spark):
    docs = documents(spark)
    rows = langid.language_digest(docs).collect()
    assert len(rows) == docs.count()
    pred = {r["doc_id"]: r for r in rows}
    for i in (300, 301, 302, 303):
        assert (pred[i]["lang_pred"], pred[i]["score"]) == ("und", 0.0)
    assert pred[5]["lang_pred"] == "en" and pred[305]["lang_pred"] == "en" and pred[105]["lang_pred"] == "fr"
    assert all(0 <= r["score"] <= 1 and r["lang_pred"] in ("en", "fr", "und") for r in rows)
    for r in rows:
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    kept = langid.identified_documents(docs)
    assert kept.columns == docs.columns
    assert not {300, 301, 302, 303} & {r["doc_id"] for r in kept.collect()}
    assert kept.filter("doc_id < 200").count() == 36


def test_language_without_training_rows(spark):
    docs = documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.language_digest(docs).collect()} == {"und"}
    assert langid.language_digest(no_documents(spark)).count() == 0


def toxic_frames(spark, n=400):
    r, docs, labels = random.Random(2), [], []
    for i in range(n):
        words, bad = prose(i, r.randrange(5, 150)).split(), i % 7 == 0
        if bad:
            for _ in range(max(2, len(words) // 25)):
                words.insert(r.randrange(len(words)), r.choice(["zorgul", "zorgulen", "idiot", "scum", "vextrash"]))
        docs.append((i, " ".join(words), "en", "s", 0))
        if i % 5:
            labels.append((i, 1, int(bad)))
    docs += [(None, "x", None, None, None), (9000, None, None, None, None), (9001, "", None, None, None), docs[0], docs[0]]
    labels += [(None, 0, 1), (9001, None, None), labels[0]]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(labels, LABEL_SCHEMA)


def test_toxicity_of_held_out_documents(spark):
    docs, labels = toxic_frames(spark)
    rows = toxicity.toxicity_digest(docs, labels).collect()
    assert len(rows) == docs.count()
    truth = [(r["doc_id"] % 7 == 0, r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] < 9000]
    assert sum(bad == bool(p) for bad, p in truth) >= 0.97 * len(truth)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    assert {r["predicted"] for r in rows if r["doc_id"] in (9000, 9001)} == {0}


def test_toxicity_on_the_given_tables(spark):
    docs, labels = table(spark, SF_CHECK, "documents"), table(spark, SF_CHECK, "labels")
    rows = toxicity.toxicity_digest(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    toxic = [r["predicted"] for r in rows if r["toxic"] == 1]
    assert sum(clean) <= 0.03 * len(clean) and sum(toxic) >= 0.7 * len(toxic)


def test_toxicity_without_labels(spark):
    docs, labels = toxic_frames(spark, 30)
    rows = toxicity.toxicity_digest(docs, spark.createDataFrame([], LABEL_SCHEMA)).collect()
    assert len(rows) == docs.count()
    assert toxicity.toxicity_digest(no_documents(spark), labels).count() == 0


def test_label_model_trusts_the_better_voter():
    r = np.random.default_rng(1)
    y = (r.random(2000) < 0.2).astype(float)
    good = np.where(r.random(2000) < 0.95, y, 1 - y)
    noise = (r.random(2000) < 0.3).astype(float)
    post, rates, _ = toxicity.label_model(np.stack([good, noise, noise], axis=1), y)
    assert rates[0][0] > 0.85 > 0.2 > rates[1][0]
    assert ((post > 0.5) == (y > 0)).mean() > 0.95


def test_label_model_overturns_wrong_labels():
    r = np.random.default_rng(6)
    y = (r.random(3000) < 0.15).astype(float)
    votes = np.stack([np.where(r.random(3000) < 0.9, y, r.random(3000) < 0.02) for _ in range(4)], axis=1).astype(float)
    wrong = r.random(3000) < 0.08
    known = np.where(wrong, 1 - y, y)
    post, _, _ = toxicity.label_model(votes, known)
    assert ((post > 0.5) == (y > 0))[wrong].mean() > 0.9
    assert ((post > 0.5) == (y > 0))[~wrong].mean() > 0.99


def test_toxicity_learned_from_labels_with_errors(spark):
    docs, labels = toxic_frames(spark)
    turned = F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(100)) < 6
    noisy = labels.withColumn("toxic", F.when(turned, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    rows = [r for r in toxicity.toxicity_digest(docs, noisy).collect() if r["held_out"] and r["doc_id"] < 9000]
    assert sum((r["doc_id"] % 7 == 0) == bool(r["predicted"]) for r in rows) >= 0.95 * len(rows)


def brute(ids, x, qid, top=10):
    at = ids.index(qid)
    d = np.sqrt(((x - x[at]) ** 2).sum(axis=1))
    order = sorted((float(d[i]), ids[i]) for i in range(len(ids)) if ids[i] != qid)
    return order[:top]


def test_neighbours_of_few_vectors_are_exact(spark):
    r = np.random.default_rng(0)
    rows = [(i, [float(v) for v in r.normal(size=4)], 0) for i in range(0, 250)]
    rows += [(1000 + i, rows[0][1], 0) for i in range(15)]  # ties with query 0
    odd = [(2000, None, 0), (2100, [0.0] * 4, 0), (2200, [1.0, None, 0.0, 1.0], 0), (2300, [1.0, float("nan"), 0.0, 1.0], 0),
           (2400, [float("inf"), 0.0, 0.0, 1.0], 0), (2500, [1.0], 0), (None, [1.0, 2.0, 3.0, 4.0], 0)]
    df = spark.createDataFrame(rows + odd + [rows[100]], "vec_id long, embedding array<double>, label int").repartition(3)
    got = {}
    for g in ann.nearest_digest(df).collect():
        got.setdefault(g["query_id"], []).append((g["rank"], g["score"], g["vec_id"]))
    ids, x = [i for i, _, _ in rows], np.array([v for _, v, _ in rows])
    assert set(got) == {i for i in ids if i % 100 == 0}
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 11))
        want = brute(ids, x, q)
        assert [f[2] for f in found] == [i for _, i in want]
        assert [f[1] for f in found] == pytest.approx([d for d, _ in want], rel=1e-12, abs=1e-12)


def test_fewer_candidates_than_ten(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0], 0) for i in range(4)], "vec_id long, embedding array<float>, label int")
    rows = ann.nearest_digest(df).orderBy("rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rows] == [(0, 1, 1, 1.0), (0, 2, 2, 2.0), (0, 3, 3, 3.0)]
    assert ann.nearest_digest(df.limit(0)).count() == 0


def test_recall_over_learned_partitions(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART_ROWS", 128)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 100)
    r = np.random.default_rng(3)
    centres = r.normal(size=(10, 16)) * 2
    x = centres[r.integers(0, 10, 3000)] + r.normal(size=(3000, 16))
    x[1500:1800] = x[1500]  # one vector that repeats
    df = spark.createDataFrame([(i, [float(v) for v in row], 0) for i, row in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {}
    for g in ann.nearest_digest(df).collect():
        got.setdefault(g["query_id"], set()).add(g["vec_id"])
    hits = sum(len(got[q] & {i for _, i in brute(list(range(3000)), x, q)}) for q in range(0, 3000, 100))
    assert hits >= 0.9 * 300


def test_balanced_parts():
    r = np.random.default_rng(4)
    x = r.normal(size=(600, 8))
    part = ann.balanced_parts(x, ann.neighbour_graph(x, 8), 8)
    sizes = np.bincount(part, minlength=8)
    assert sizes.min() >= 60 and sizes.max() <= 90
