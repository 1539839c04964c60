"""Equi-joins that hold when one key carries a large share of the rows.

A key is hot when it has more rows than one task should hold, whatever the size of the table. Hot keys
are counted and written once; there are at most rows / taskRows of them, their table is measured, and
looked up by broadcast below broadcastBytes, beyond that by a join in which every hot key is spread as
well. Rows of a hot key are dealt over as many salts as they need tasks; the matching rows of the other
side are repeated once per salt. All other rows keep salt 0. Joins without hot keys are left exactly
as Spark plans them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordtrust.sources.workspace import Workspace

TASK_ROWS = ("spark.recordtrust.taskRows", "2000000")
BROADCAST_BYTES = ("spark.recordtrust.broadcastBytes", str(64 << 20))


def setting(spark: SparkSession, option: tuple[str, str]) -> int:
    return int(spark.conf.get(*option))


class HotKeys(NamedTuple):
    """Hot key values of one join side with their salt counts, the largest of those, and whether the
    table is small enough to broadcast."""

    table: DataFrame
    keys: list[str]
    salts: int
    small: bool


def hot_keys(df: DataFrame, keys: Sequence[str], weight: str | None = None) -> HotKeys | None:
    """Hot keys of a side, or of a per-key table whose ``weight`` column counts the rows behind it.

    Null counts as a key value: it may be as crowded as any other. Counts form before the shuffle.
    """
    spark, keys = df.sparkSession, list(keys)
    task_rows = setting(spark, TASK_ROWS)
    total = df.count() if weight is None else df.agg(F.sum(weight)).first()[0] or 0
    if total <= task_rows:
        return None
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    hot = (
        df.groupBy(*keys)
        .agg(rows.alias("__rows"))
        .where(F.col("__rows") > task_rows)
        .select(*keys, F.ceil(F.col("__rows") / task_rows).cast("int").alias("__salts"))
    )
    found = Workspace(spark).stage(hot, "hot")
    salts = found.agg(F.max("__salts")).first()[0]
    if salts is None:
        return None
    return HotKeys(found, keys, salts, byte_size(found) <= setting(spark, BROADCAST_BYTES))


def numbered(df: DataFrame, name: str, *hot: HotKeys | None) -> DataFrame:
    """Rows with an id that depends on their content alone: a hash of the row and of its place among equal rows.

    Equal rows are counted and dealt out again, so a task that is run again gives the same rows the same ids,
    whatever the source. A count forms before the shuffle. Ids deal the rows of hot keys; if all of ``hot`` are
    None there is nothing to deal, and all ids are 0.
    """
    if hot and all(x is None for x in hot):
        return df.withColumn(name, F.lit(0).cast("long"))
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__equal"))
    places = counted.withColumn("__place", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__equal"))))
    marks = [x for c in df.columns for x in (F.col(c).isNull(), F.col(c))]
    return places.select(*df.columns, F.xxhash64(*marks, F.col("__place")).alias(name))


def _same(pairs: Sequence[tuple[str, str]], null_safe: bool) -> Column:
    tests = [F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) == F.col(b) for a, b in pairs]
    return reduce(Column.__and__, tests)


def _with_salts(df: DataFrame, columns: Sequence[str], hot: HotKeys, salts: str) -> DataFrame:
    """Mark the rows whose ``columns`` hold a hot key with its salt count."""
    names = {k: f"__hot_{k}" for k in hot.keys}
    table = hot.table.withColumnsRenamed({**names, "__salts": salts})
    same = _same(list(zip(columns, names.values())), null_safe=True)
    if hot.small:
        return df.join(F.broadcast(table), same, "left").drop(*names.values())
    # Each key is repeated, so the lookup spreads the rows of a hot one as well.
    table = table.withColumn("__hot_copy", F.explode(F.sequence(F.lit(0), F.lit(hot.salts - 1))))
    spread = df.withColumn("__spread", F.pmod(F.xxhash64(*df.columns), F.lit(hot.salts)).cast("int"))
    same &= F.col("__spread") == F.col("__hot_copy")
    return spread.join(table, same, "left").drop(*names.values(), "__spread", "__hot_copy")


def _deal(
    df: DataFrame, columns: Sequence[str], hot: HotKeys | None, salt: str, row: Column | None, scatter: bool = False
) -> DataFrame:
    """Give every row of a hot key one of its salts, and all other rows salt 0.

    With ``scatter`` every row with a null key gets a salt of its own.
    """
    if hot is None and not scatter:
        return df.withColumn(salt, F.lit(0))
    dealt, picked = df.withColumn("__dealt_by", F.xxhash64(*df.columns) if row is None else row), F.lit(0)
    if hot is not None:
        dealt = _with_salts(dealt, columns, hot, "__salts")
        picked = F.coalesce(F.pmod(F.col("__dealt_by"), F.col("__salts")).cast("int"), F.lit(0))
    if scatter:
        unmatched = reduce(Column.__or__, [F.col(c).isNull() for c in columns])
        picked = F.when(unmatched, F.pmod(F.xxhash64("__dealt_by"), F.lit(1 << 30)).cast("int")).otherwise(picked)
    return dealt.withColumn(salt, picked).drop("__dealt_by", "__salts")


def _repeat(df: DataFrame, columns: Sequence[str], hot: HotKeys | None, salt: str, salts: str) -> DataFrame:
    """Repeat the rows that meet a hot key once per salt."""
    if hot is None:
        return df.withColumns({salt: F.lit(0), salts: F.lit(None).cast("int")})
    last = F.coalesce(F.col(salts), F.lit(1)) - 1
    return _with_salts(df, columns, hot, salts).withColumn(salt, F.explode(F.sequence(F.lit(0), last)))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    left_hot: HotKeys | None = None,
    right_hot: HotKeys | None = None,
    left_row: Column | None = None,
    right_row: Column | None = None,
    null_safe: bool = False,
    scatter_nulls: bool = False,
) -> DataFrame:
    """Inner or left join on equally named keys; hot keys of either side are dealt over tasks.

    ``left_row`` / ``right_row`` number the rows for dealing, in a way that a retried task repeats: ``numbered`` does.
    The default hashes the whole row; pass a row id where identical copies may be frequent.
    ``scatter_nulls`` spreads the left rows with a null key, which meet nothing, over all tasks; it
    needs a join that is not ``null_safe``.
    """
    keys = list(keys)
    renamed = {k: f"__key_{k}" for k in keys}
    right_keys = list(renamed.values())
    right = right.withColumnsRenamed(renamed)
    same = _same(list(renamed.items()), null_safe)
    if scatter_nulls and null_safe:
        raise ValueError("null keys match in a null-safe join: they cannot be scattered")
    if left_hot is None and right_hot is None and not scatter_nulls:
        return left.join(right, same, how).drop(*right_keys)

    if not null_safe:  # null keys of the right side meet nothing
        right = right.dropna(subset=right_keys)
        if right_hot is not None:
            right_hot = right_hot._replace(table=right_hot.table.dropna(subset=right_hot.keys))
    left = _deal(left, keys, left_hot, "__left_dealt", left_row, scatter_nulls)
    left = _repeat(left, keys, right_hot, "__left_copy", "__copies")
    right = _deal(right, right_keys, right_hot, "__right_dealt", right_row)
    right = _repeat(right, right_keys, left_hot, "__right_copy", "__unused").withColumn("__hit", F.lit(True))
    if scatter_nulls and left_hot is None:
        # Always 0, but no literal: Catalyst would take a literal out of the keys that rows are dealt by.
        right = right.withColumn("__right_copy", F.pmod(F.xxhash64(*right_keys), F.lit(1)).cast("int"))
    same &= (F.col("__left_dealt") == F.col("__right_copy")) & (F.col("__left_copy") == F.col("__right_dealt"))
    joined = left.join(right, same, how)
    if how == "left" and right_hot is not None:
        # A hot key has matches on some of its salts: unmatched copies of a left row are no rows.
        joined = joined.where(F.col("__hit").isNotNull() | F.col("__copies").isNull())
    helpers = ("__left_dealt", "__left_copy", "__right_dealt", "__right_copy", "__copies", "__unused", "__hit")
    return joined.drop(*helpers, *right_keys)


def byte_size(df: DataFrame) -> int:
    """Bytes of a table of numbers and texts, measured: 8 per value and the length of every text."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    sizes = [F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c in texts]
    rows, *text_bytes = df.agg(F.count(F.lit(1)), *sizes).first()
    return rows * 8 * len(df.columns) + sum(text_bytes)


def attach(
    rows: DataFrame,
    per_key: DataFrame,
    keys: Sequence[str],
    how: str,
    weight: str,
    null_safe: bool = False,
    workspace: Workspace | None = None,
) -> DataFrame:
    """Join a per-key table to the rows it was made from; ``weight`` counts the rows per key.

    The table is measured, so pass one that is cheap to read (a staged one). A small one is
    broadcast; a larger one is joined by shuffle, its own counts telling which keys are hot. Rows
    that a left join keeps for their null keys are not in those counts and are scattered. Rows are dealt by
    a hash of their content; with a workspace they are dealt by a number that is written with them,
    so that equal rows spread too and a task run again finds the same numbers.
    """
    if byte_size(per_key) <= setting(rows.sparkSession, BROADCAST_BYTES):
        return spread_join(rows, F.broadcast(per_key), keys, how, null_safe=null_safe)
    hot, scatter = hot_keys(per_key, keys, weight), how == "left" and not null_safe
    if hot is None or workspace is None:
        return spread_join(rows, per_key, keys, how, left_hot=hot, null_safe=null_safe, scatter_nulls=scatter)
    written = workspace.stage(rows.withColumn("__number", F.monotonically_increasing_id()), "numbered")
    joined = spread_join(
        written, per_key, keys, how, left_hot=hot, left_row=F.col("__number"), null_safe=null_safe, scatter_nulls=scatter
    )
    return joined.drop("__number")
