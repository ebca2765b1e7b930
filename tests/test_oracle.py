"""Every registered query against its DuckDB oracle (the driver's gate), on
sf0.001 so the suite stays quick; scripts/check_oracle.py runs sf0.01."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.oracle_util import compare, duckdb_frame, spark_frame
from tidemark.plans import batch, operations, recovery, scenarios, stored

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
SQL = entry.oracle_sql()
OWN = {**batch.QUERIES, **scenarios.QUERIES, **recovery.QUERIES, **stored.QUERIES, **operations.QUERIES}


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(QUERIES)
    assert set(OWN) <= set(SQL) <= set(QUERIES)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["zone", "date", "hour", "total_amount"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_oracle(spark, name):
    got = spark_frame(QUERIES[name](spark, SF))
    want = duckdb_frame(SF, SQL[name])
    ok, msg = compare(got, want)
    assert ok, msg
