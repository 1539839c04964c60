"""Joins with hot keys give the rows of the plain join, and no task gets them all."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from recordtrust.operators.joins import attach, byte_size, hot_keys, numbered, spread_join
from recordtrust.sources.workspace import Workspace

HOT = {"taskRows": "50", "broadcastBytes": "0"}


def rows_of(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def plain(left, right, keys, how, null_safe=False):
    renamed = right.withColumnsRenamed({k: f"r_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on &= F.col(k).eqNullSafe(F.col(f"r_{k}")) if null_safe else F.col(k) == F.col(f"r_{k}")
    return left.join(renamed, on, how).drop(*[f"r_{k}" for k in keys])


@pytest.fixture
def many(spark):
    """A third of the rows under one key, a third without a key, the rest spread."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") % 211)
    return spark.range(3000).select(F.col("id").alias("row"), key.cast("long").alias("k"))


@pytest.fixture
def one(spark):
    return spark.range(150).select(F.col("id").alias("k"), (F.col("id") * 10).alias("payload"))


def test_hot_keys_are_found_and_bounded(spark, many, settings):
    assert hot_keys(many, ["k"]) is None
    settings(**HOT)
    hot = hot_keys(many, ["k"])
    found = {r.k: r["__salts"] for r in hot.table.collect()}
    assert found == {7: 21, None: 20}
    assert hot.table.count() <= many.count() / 50


def test_hot_keys_by_weight(spark, settings):
    settings(taskRows="100")
    per_key = spark.createDataFrame([("a", 900), ("b", 30), (None, 500)], "k string, n bigint")
    assert {r.k: r["__salts"] for r in hot_keys(per_key, ["k"], "n").table.collect()} == {"a": 9, None: 5}


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_left_hot(many, one, settings, how, null_safe):
    settings(**HOT)
    right = one.unionAll(one.selectExpr("cast(null AS bigint)", "payload").limit(1))
    got = spread_join(many, right, ["k"], how, left_hot=hot_keys(many, ["k"]), null_safe=null_safe)
    assert rows_of(got) == rows_of(plain(many, right, ["k"], how, null_safe))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_right_hot(many, one, settings, how, null_safe):
    settings(**HOT)
    left = one.unionAll(one.selectExpr("cast(null AS bigint)", "payload").limit(1))
    got = spread_join(left, many, ["k"], how, right_hot=hot_keys(many, ["k"]), null_safe=null_safe)
    assert rows_of(got) == rows_of(plain(left, many, ["k"], how, null_safe))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_both_hot(spark, settings, how):
    settings(**HOT)
    left = spark.range(300).selectExpr("id AS a", "if(id < 200, 1, id) AS k")
    right = spark.range(300).selectExpr("id AS b", "if(id < 120, 1, if(id < 200, 2, id + 50)) AS k")
    hot = {"left_hot": hot_keys(left, ["k"]), "right_hot": hot_keys(right, ["k"])}
    assert rows_of(spread_join(left, right, ["k"], how, **hot)) == rows_of(plain(left, right, ["k"], how))


def test_two_keys(spark, settings):
    settings(**HOT)
    left = spark.range(900).selectExpr("id", "if(id % 3 = 0, 1, id % 20) AS a", "if(id % 2 = 0, null, 'x') AS b")
    right = left.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    got = spread_join(left, right, ["a", "b"], left_hot=hot_keys(right, ["a", "b"], "n"), null_safe=True)
    assert rows_of(got) == rows_of(plain(left, right, ["a", "b"], "inner", null_safe=True))
    assert got.count() == 900


def test_ids_do_not_depend_on_how_rows_are_dealt(spark, settings):
    """A task that is run again, on rows in another order and other partitions, gives equal rows the same ids."""
    settings(**HOT)
    rows = spark.range(900).selectExpr("if(id % 3 = 0, id, 5) AS k", "if(id % 2 = 0, null, 'x') AS t")
    one, two = (rows_of(numbered(x, "row")) for x in (rows.coalesce(1), rows.orderBy(F.rand(3)).repartition(7)))
    assert one == two and len({r[1] for r in one}) == 900
    right = spark.range(300).selectExpr("id AS k", "id AS payload")
    joined = [
        spread_join(numbered(x, "row"), right, ["k"], "left", left_hot=hot_keys(x, ["k"]), left_row=F.col("row"))
        for x in (rows.coalesce(1), rows.repartition(7, "t"))
    ]
    assert rows_of(joined[0]) == rows_of(joined[1])
    assert rows_of(joined[0].drop("row")) == rows_of(plain(rows, right, ["k"], "left"))


def test_numbers_only_where_there_are_hot_keys(spark, settings):
    rows = spark.range(9).selectExpr("id % 2 AS k")
    assert {r.row for r in numbered(rows, "row", None, None).collect()} == {0}
    settings(**HOT)
    assert len({r.row for r in numbered(spark.range(900).selectExpr("1 AS k"), "row", None, hot_keys(spark.range(900).selectExpr("1 AS k"), ["k"])).collect()}) == 900


def test_attach_deals_equal_rows(spark, settings, sixteen):
    """With a workspace equal rows of a hot key spread over tasks."""
    settings(**HOT)
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, id, 5) AS k", "'same' AS t")
    stats = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    with Workspace(spark) as space:
        got = attach(rows, stats, ["k"], "inner", "n", workspace=space)
        assert rows_of(got) == rows_of(plain(rows, stats, ["k"], "inner"))
        assert largest_partition(got) < 1000


def test_copies_are_dealt_by_row_number(spark, settings):
    settings(**HOT)
    copies = numbered(spark.range(600).selectExpr("if(id % 3 = 0, id, 5) AS k"), "row")
    right = spark.range(300).selectExpr("id AS k", "id AS payload")
    got = spread_join(copies, right, ["k"], "left", left_hot=hot_keys(copies, ["k"]), left_row=F.col("row"))
    assert rows_of(got) == rows_of(plain(copies, right, ["k"], "left"))


@pytest.mark.parametrize("limits", [{"taskRows": "50", "broadcastBytes": "0"}, {"broadcastBytes": "100000"}])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_attach(many, settings, limits, how):
    settings(**limits)
    stats = many.where("k < 100").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert rows_of(attach(many, stats, ["k"], how, "n")) == rows_of(plain(many, stats, ["k"], how))


@pytest.fixture
def sixteen(spark):
    """Shuffle joins over 16 partitions that nothing merges or splits."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def largest_partition(df):
    return max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_no_partition_holds_the_hot_key(many, one, settings, sixteen):
    settings(**HOT)
    got = spread_join(many, one, ["k"], "left", left_hot=hot_keys(many, ["k"]), left_row=F.col("row"))
    assert largest_partition(got) < 700  # of 3,000 rows, 1,000 with one key and 1,000 without


@pytest.mark.parametrize("task_rows", ["50", "100000"])
def test_attach_scatters_null_keys(many, settings, sixteen, task_rows):
    settings(taskRows=task_rows, broadcastBytes="0")
    rows = many.where("k IS NULL OR k != 7")
    stats = rows.dropna().groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    got = attach(rows, stats, ["k"], "left", "n")
    assert largest_partition(got) < 300  # of 2,000 rows, 1,000 without a key
    assert rows_of(got) == rows_of(plain(rows, stats, ["k"], "left"))


def test_null_keys_of_a_null_safe_join_are_not_scattered(many, one):
    with pytest.raises(ValueError):
        spread_join(many, one, ["k"], "left", null_safe=True, scatter_nulls=True)


def test_byte_size_counts_text(spark):
    df = spark.createDataFrame([(1, "abc"), (2, "é"), (3, None)], "k bigint, t string")
    assert byte_size(df) == 3 * 16 + 3 + 2


def test_many_keys_below_a_thousandth_of_the_rows_are_hot(spark, settings):
    settings(taskRows="20", broadcastBytes="0")
    rows = spark.range(120_000).select((F.col("id") % 2000).alias("k"), F.col("id").alias("row"))  # 60 rows a key
    hot = hot_keys(rows, ["k"])
    assert hot.table.count() == 2000 and hot.salts == 3 and not hot.small
    right = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("payload"))
    got = spread_join(rows, right, ["k"], left_hot=hot, left_row=F.col("row"))
    assert got.count() == 120_000 and got.where("payload != 2 * k").count() == 0
