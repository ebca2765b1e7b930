"""Operators that SQL can express, against DuckDB over whole tables."""

from __future__ import annotations

import pytest

from tests.oracle_util import compare, duckdb_frame, spark_frame
from tidemark.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_oracle(spark, name):
    ok, why = compare(spark_frame(queries.QUERIES[name](spark, SF)), duckdb_frame(SF, queries.SQL[name]))
    assert ok, why
