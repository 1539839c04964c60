"""Every registered query with a SQL counterpart gives DuckDB's rows; the others give rows."""

from __future__ import annotations

import os

import pytest
from compare import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from catalog import queries as catalog_queries

SF_DIR = "/root/testdata/sf0.001"
ORACLES = oracle_sql()
QUERIES = queries()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SF_DIR).toArrow(), duck.sql(ORACLES[name]).to_arrow_table()) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    df = entry(spark)
    assert len(df.columns) == 285
    assert df.count() == 5933


@pytest.mark.parametrize(
    "name",
    ["pairs_all", "pairs_reliable", "combine_logo", "features_full", "features_numeric_key", "version_report_projection"],
)
def test_hot_key_paths_give_the_same_rows(spark, duck, settings, name):
    """With tiny limits nearly every key is hot and nothing is broadcast by size."""
    settings(taskRows="20", broadcastBytes="0")
    assert compare(QUERIES[name](spark, SF_DIR).toArrow(), duck.sql(ORACLES[name]).to_arrow_table()) is None


def test_version_report_works_labels_out_once(spark, monkeypatch):
    given = catalog_queries.Inputs(spark, SF_DIR)
    monkeypatch.setattr(catalog_queries, "inputs", lambda *_: given)
    try:
        assert QUERIES["version_report_projection"](spark, SF_DIR).count() > 0
        staged = [name.split("-")[0] for name in os.listdir(given.workspace.root.removeprefix("file:"))]
        assert staged.count("labelled") == 1 and "marked" not in staged
    finally:
        given.workspace.close()
