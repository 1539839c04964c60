"""Sources: Parquet directories, JDBC tables, SQL over the tables, and the person list."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordtrust.functions.comparators import full_name
from recordtrust.functions.dates import parse_date
from recordtrust.sources.schemas import SCHEMAS

Tables = Mapping[str, DataFrame]


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def conform(df: DataFrame, schema: Mapping[str, str | None], name: str = "table") -> DataFrame:
    """Lower-case names, fail early on missing columns, cast to the declared types.

    Text in a date column is parsed, so unreadable dates become null instead of ending the run.
    Columns that are not declared are left out.
    """
    df = lower_names(df)
    missing = [c for c in schema if c not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks columns {missing}")
    columns = []
    for c, kind in schema.items():
        source = df.schema[c].dataType
        if kind is None or source.simpleString() == kind:
            columns.append(F.col(c))
        elif kind == "timestamp_ntz" and isinstance(source, T.StringType):
            columns.append(parse_date(F.col(c)).alias(c))
        else:
            columns.append(F.col(c).cast(kind).alias(c))
    return df.select(*columns)


def read_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Every declared relation from ``<path>/<name>.parquet``."""
    return {
        name: conform(spark.read.parquet(f"{path.rstrip('/')}/{name}.parquet"), schema, name)
        for name, schema in SCHEMAS.items()
    }


def read_query(tables: Tables, sql: str) -> DataFrame:
    """SQL over the tables, each named in braces (``FROM {tenant}``); result names lower-cased."""
    spark = next(iter(tables.values())).sparkSession
    used = {name: df for name, df in tables.items() if "{" + name + "}" in sql}
    return lower_names(spark.sql(sql, **used))


def jdbc_options(url: str, table: str, column: str, lower: int, upper: int, partitions: int) -> dict[str, str]:
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A database table, read in parallel ranges of an integer column; Spark pushes filters down."""
    options = {**(properties or {}), **jdbc_options(url, table, column, lower, upper, partitions)}
    return lower_names(spark.read.format("jdbc").options(**options).load())


def submitter_names(person: DataFrame) -> DataFrame:
    return person.select("id", full_name(F.col("first_name"), F.col("last_name")).alias("submitter_name"))
