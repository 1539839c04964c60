"""Column builders for labels, dates, names and ratios. All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

AGREE, DISAGREE, UNKNOWN = 1, 0, -1


def tri_state(subject: Column, target: Column, agrees: Column) -> Column:
    """-1 when either side is null, else 1 or 0."""
    return (
        F.when(subject.isNull() | target.isNull(), F.lit(UNKNOWN))
        .when(agrees, F.lit(AGREE))
        .otherwise(F.lit(DISAGREE))
    )


def strict(subject: Column, target: Column) -> Column:
    return tri_state(subject, target, subject == target)


def band(subject: Column, target: Column, low: float, high: float) -> Column:
    """Inclusive band around the target; a negative target inverts the bounds and never agrees."""
    return tri_state(subject, target, (subject >= target * F.lit(low)) & (subject <= target * F.lit(high)))


def within_days(subject: Column, target: Column, days: int) -> Column:
    """Inclusive window of instants around the target: time of day counts."""
    span = F.make_dt_interval(days=F.lit(days))
    return tri_state(subject, target, subject.between(target - span, target + span))


def known(df: DataFrame, name: str) -> Column:
    """The column with NaN read as null, as every null test here treats them alike."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.nanvl(F.col(name), F.lit(None))
    return F.col(name)


def filled_flag(value: Column) -> Column:
    return F.when(value.isNotNull(), F.lit(1)).otherwise(F.lit(0))


def full_name(first: Column, last: Column) -> Column:
    """Null when either part is null."""
    return F.concat(first, F.lit(" "), last)


def ratio(part: Column, whole: Column) -> Column:
    """Part over whole, 0 where the whole is not positive."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def hash_bucket(key: Column, seed: int, buckets: int) -> Column:
    """Seeded bucket of an id, the same on any partitioning and in any SQL engine that has MD5."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    return F.pmod(F.conv(F.left(digest, F.lit(8)), 16, 10).cast("long"), F.lit(buckets)).cast("int")
