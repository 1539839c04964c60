"""A bounded, repeatable sample of labelled rows for fitting a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000


def remainder(doc_id: str, by: int) -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(by))


def held_out(by: int, rest: int) -> Column:
    """Whether a row is kept from training; a null id is not (and is never learned from either)."""
    return F.coalesce(remainder("doc_id", by) == rest, F.lit(False))


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, by: int, rest: int, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, text, label of at most ``rows`` labelled documents whose id's crc32 modulo ``by`` is not ``rest``.

    Ids come in the order of a hash. Repeated labels of an id count once, the largest of them, and so do
    its rows, that of the least text hash; the sampled ids are at most ``rows``, so they are broadcast.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(by, rest))
    ids = usable.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
    chosen = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    return found.groupBy("doc_id", "label").agg(least).select("doc_id", F.col("least.text").alias("text"), "label")
