"""Runs a registered query and its SQL counterpart and compares names, types and rows."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    return v


def _family(kind: pa.DataType) -> str:
    if pa.types.is_timestamp(kind):
        return "timestamp" + (" tz" if kind.tz else "")
    if pa.types.is_large_string(kind) or pa.types.is_string(kind):
        return "string"
    return str(kind)


def _content(table: pa.Table) -> tuple[dict[str, str], Counter]:
    names = sorted(table.column_names)
    types = {n: _family(table.schema.field(n).type) for n in names}
    columns = [[_value(v) for v in table.column(n).to_pylist()] for n in names]
    return types, Counter(zip(*columns))


def compare(spark_table: pa.Table, duck_table: pa.Table) -> str | None:
    """None when equal, else what differs."""
    types, rows = _content(spark_table)
    expected_types, expected = _content(duck_table)
    if types != expected_types:
        diff = {n: (types.get(n), expected_types.get(n)) for n in types.keys() | expected_types.keys()}
        return f"schema: { {n: d for n, d in diff.items() if d[0] != d[1]} }"
    if rows != expected:
        extra, lacking = rows - expected, expected - rows
        return f"rows {rows.total()} vs {expected.total()}; extra {extra.most_common(2)}; lacking {lacking.most_common(2)}"
    return None
