"""Driver smoke contract."""

import __spark_entry__ as entry


def test_entry_runs_with_stable_schema(spark):
    df = entry.entry(spark)
    first = df.schema
    rows = df.collect()
    assert len(rows) > 0
    assert entry.entry(spark).schema == first


def test_queries_are_dataframes(spark):
    from pyspark.sql import DataFrame

    core = {n: f for n, f in entry.queries().items() if not n.startswith("op") and n != "pipeline"}
    for name, fn in core.items():
        assert isinstance(fn(spark, "/root/testdata/sf0.001"), DataFrame), name
