"""Every registered query against its DuckDB oracle on sf0.001 (rows-only where none)."""

import os

import pytest

import __spark_entry__ as entry
from tools.oracle_check import compare

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
ORACLE = entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    if name not in ORACLE:
        assert QUERIES[name](spark, SF).count() >= 0
        return
    ok, msg, _, _ = compare(spark, SF, name, QUERIES[name], ORACLE[name])
    assert ok, msg


def test_entry_flagship(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 255     # hours with runs at sf0.001
    assert df.columns[:2] == ["timestamp", "total_runs"]
