"""The pipeline and the registered queries."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from martlet.llm import queries
from martlet.llm.mix import word_count
from tests.conftest import SF_SMOKE
from tests.llm.frames import documents
from tests.llm.test_text_search import bench_words, plain_components, plain_sets
from tests.oracle_compare import digest


def test_every_operator_is_registered():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 14)]
    assert set(queries.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_equal_their_sql(spark, name):
    out = queries.queries()[name](spark, SF_SMOKE)
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMOKE}/{t}.parquet'")
    res = con.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in res.description]
    assert digest(columns, res.fetchall()) == digest(out.columns, [tuple(r) for r in out.collect()])


def test_stages_in_turn(spark):
    docs = documents(spark, extra=False).cache()
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMOKE).cache()
        seen[name] = docs.collect()
        assert docs.columns[: len(columns)] == columns
    texts = {r["doc_id"]: r["text"] for r in documents(spark, extra=False).collect()}
    spoken = {r["doc_id"] for r in seen["language_id"]}
    assert not spoken & {300, 301, 302, 303} and 305 in spoken
    sets = plain_sets([(i, texts[i]) for i in spoken if i is not None], 5)
    label = plain_components(sets, 80)
    kept = [r["doc_id"] for r in seen["near_duplicates"] if r["doc_id"] is not None]
    assert sorted(kept) == sorted(i for i in sets if label[i] == i)
    assert {r["doc_id"] for r in seen["decontamination"]} <= set(kept) | {None}
    n = sum(len(r["text"].split()) for r in seen["decontamination"])
    assert abs(sum(len(r["text"].split()) for r in seen["mixing"]) - n) <= 64 * 5
    for s in {r["shard"] for r in seen["sharding"]}:
        slots = sorted(r["slot"] for r in seen["sharding"] if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert len(seen["sharding"]) == len(seen["mixing"])


def test_run_over_the_given_documents(spark):
    out = corpus_pipeline.run(spark, SF_SMOKE).cache()
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    assert out.columns == [*docs.columns, "shard", "slot"]
    bench = [tuple(bench_words(r["text"])) for r in spark.read.parquet(f"{SF_SMOKE}/benchmark.parquet").collect()]
    windows = {b[k : k + 10] for b in bench for k in range(max(1, len(b) - 9))}
    kept = {r["doc_id"] for r in out.collect()}
    whole = {r["doc_id"]: bench_words(r["text"]) for r in docs.collect()}
    for i in kept:
        assert not any(tuple(whole[i][k : k + 10]) in windows for k in range(len(whole[i])))
    assert out.agg(F.sum(word_count(F.col("text")))).first()[0] > 0
