from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

import pytest
from pyspark.sql import functions as F

from recordtrust.functions.comparators import (
    band,
    filled_flag,
    full_name,
    hash_bucket,
    known,
    ratio,
    strict,
    within_days,
)
from recordtrust.operators.labels import add_labels

NAN = float("nan")
T0 = datetime(2020, 2, 29, 12, 30)
Q = timedelta(days=90)


def labels(spark, kind, rows, compare):
    schema = f"pos int, v_version {kind}, v_master {kind}"
    df = spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(rows)], schema)
    out = add_labels(df, {"v": compare}).orderBy("pos")
    return [r.v_label for r in out.collect()]


def test_strict(spark):
    rows = [(5, 5), (5, 6), (None, 5), (5, None), (None, None)]
    assert labels(spark, "bigint", rows, strict) == [1, 0, -1, -1, -1]
    assert labels(spark, "double", [(NAN, 1.0), (1.0, NAN), (1.0, 1.0), (0.0, -0.0)], strict) == [-1, -1, 1, 1]


def test_five_percent_band(spark):
    rows = [(95.0, 100.0), (105.0, 100.0), (94.9, 100.0), (105.1, 100.0), (-100.0, -100.0), (0.0, 0.0), (0.1, 0.0)]
    assert labels(spark, "double", rows, lambda s, t: band(s, t, 0.95, 1.05)) == [1, 1, 0, 0, 0, 1, 0]


def test_eight_percent_band(spark):
    rows = [(92.0, 100.0), (108.0, 100.0), (91.0, 100.0), (NAN, 100.0), (None, 1.0)]
    assert labels(spark, "double", rows, lambda s, t: band(s, t, 0.92, 1.08)) == [1, 1, 0, -1, -1]


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_ninety_days(spark, kind):
    second = timedelta(seconds=1)
    rows = [(T0 + Q, T0), (T0 - Q, T0), (T0 + Q + second, T0), (T0 - Q - second, T0), (T0, None), (None, T0)]
    assert labels(spark, kind, rows, lambda s, t: within_days(s, t, 90)) == [1, 1, 0, 0, -1, -1]


def test_ninety_days_on_dates(spark):
    d = T0.date()
    rows = [(d + Q, d), (d + Q + timedelta(days=1), d)]
    assert labels(spark, "date", rows, lambda s, t: within_days(s, t, 90)) == [1, 0]


def test_filled_counts_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (NAN,), (None,)], "x double")
    assert [r[0] for r in df.select(filled_flag(known(df, "x"))).collect()] == [1, 0, 0]


def test_full_name_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([("Ann", "Lee"), ("Ann", None), (None, "Lee")], "a string, b string")
    assert [r[0] for r in df.select(full_name(F.col("a"), F.col("b"))).collect()] == ["Ann Lee", None, None]


def test_ratio_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (0, 0)], "p bigint, w bigint")
    assert [r[0] for r in df.select(ratio(F.col("p"), F.col("w"))).collect()] == [0.5, 0.0, 0.0]


def test_hash_bucket_is_even_for_every_remainder_of_the_id(spark):
    df = spark.range(80_000).select("id", hash_bucket(F.col("id"), 10, 10).alias("b"))
    rows = df.groupBy((F.col("id") % 8).alias("r"), "b").count().collect()
    assert len(rows) == 80
    assert all(850 < r["count"] < 1150 for r in rows)


def test_hash_bucket_takes_any_id(spark):
    df = spark.createDataFrame([(-5,), (2**62,), (0,)], "id bigint")
    values = [r[0] for r in df.select(hash_bucket(F.col("id"), 3, 16)).collect()]
    assert reduce(lambda ok, v: ok and 0 <= v < 16, values, True)
