"""Every registered query against its DuckDB oracle at sf0.01 (the gate)."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_CHECK
from tests.oracle_compare import compare

# The training-data queries have their own tests.
NAMES = sorted(n for n in entry.queries() if not n.startswith("op") and n != "pipeline")


def test_every_query_has_an_oracle():
    assert set(entry.oracle_sql()) >= set(NAMES) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.slow
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    rec = compare(spark, SF_CHECK, [name])[name]
    assert rec["cols_match"], rec
    assert rec["spark_rows"] == rec["oracle_rows"], rec
    assert rec["hash_match"], rec
