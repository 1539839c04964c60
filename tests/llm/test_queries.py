"""Queries with SQL give DuckDB's rows; all give rows on the smallest tables."""

from __future__ import annotations

import pytest
from compare import compare, connect

from recordtrust.llm.queries import oracle, queries

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(oracle()))
def test_query_matches_sql(spark, name):
    assert compare(queries()[name](spark, SF_DIR).toArrow(), connect(SF_DIR).sql(oracle()[name]).to_arrow_table()) is None
