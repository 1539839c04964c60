"""Counting the keys of a corpus without a row per key.

Documents are dealt to blocks of a few megabytes by a hash of id and text. A block counts its own
keys (64-bit hashes of windows or words) and sends them in packed arrays, one row per block and
bucket; a bucket adds up the counts of equal keys from all blocks and sends every block the totals of
its keys back. So a key that a third of all documents hold arrives once per block, no group holds more
than a bucket or a block, and nothing passes through the driver but two sums.

Blocks and buckets grow in number with the corpus, not in size. The bucket of a key comes from a
second hash of its content, so keys are told apart by 64 bits and the bucket's, or from the key's upper bits, so
that a bucket's sorted keys lie close together and go as differences of some 6 bytes. A block's work follows its keys, however
many buckets there are. Once there are more buckets than a block has keys (some terabytes), a row carries few keys.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordtrust.llm.text import U64, Texts, texts_of

BLOCK_BYTES = 4 << 20
BUCKET_KEYS = 1_500_000


class Blocks(NamedTuple):
    """Documents (block, order, doc_id, text) dealt to ``n`` blocks, and the number of buckets for their words."""

    rows: DataFrame
    n: int
    buckets: int


def _order(*by: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*by), 33)


def block_of(n: int, *by: str) -> Column:
    """The block rises with the hash, so the order of hashes is that of blocks, and of rows inside them."""
    return F.floor(_order(*by) * F.lit(n) / F.lit(float(1 << 31))).cast("long")


def deal(documents: DataFrame, extra: dict[str, Column] | None = None, by: tuple[str, ...] = ("doc_id", "text")) -> Blocks:
    total = documents.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).cast("long")).first()[0]
    n = max(1, -(-total // BLOCK_BYTES))
    columns = {"doc_id": F.col("doc_id"), "text": F.col("text")} | (extra or {})
    rows = documents.select(block_of(n, *by).alias("block"), _order(*by).alias("order"), *[c.alias(name) for name, c in columns.items()])
    return Blocks(rows, n, max(1, total // 6 // BUCKET_KEYS))


def in_order(table: pa.Table) -> pa.Table:
    """A block's rows in an order that does not depend on how they arrived."""
    return table.sort_by([("order", "ascending"), ("doc_id", "ascending"), ("text", "ascending")])


class Keys(NamedTuple):
    """Key of every place of a block, and a second hash that picks the bucket; without it the key's upper bits do."""

    key: np.ndarray
    second: np.ndarray | None


class Packed(NamedTuple):
    """Distinct keys of a block in bucket order, where each place's key is among them, its buckets and where they begin."""

    key: np.ndarray
    place: np.ndarray
    bucket: np.ndarray
    cut: np.ndarray


def pack(keys: Keys, buckets: int) -> Packed:
    distinct, where, back = np.unique(keys.key, return_index=True, return_inverse=True)
    if keys.second is None:
        bucket = ((distinct >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)
    else:
        bucket = ((keys.second[where] >> U64(20)) % U64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    met, first = np.unique(bucket[order], return_index=True)
    return Packed(distinct[order], rank[back], met, np.append(first, len(order)))


Emit = Callable[[pa.Table, Texts], tuple[Keys, np.ndarray]]

SENT = "block long, bucket long, keys binary, counts binary"


def _bytes(keys: np.ndarray, close: bool) -> bytes:
    """Rising keys, whole, or as differences of as many bytes as suit them best, the larger ones listed behind."""
    if not close:
        return keys.tobytes()
    steps = np.diff(keys, prepend=U64(0))
    widths = {w: w * len(steps) + 16 * int(np.count_nonzero(steps >> U64(8 * w))) for w in range(3, 8)} | {8: 8 * len(steps)}
    width = min(widths, key=widths.get)
    large = np.flatnonzero(steps >> U64(8 * width)) if width < 8 else np.zeros(0, np.int64)
    low = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()
    return (len(keys) << 4 | width).to_bytes(8, "little") + low + large.astype(U64).tobytes() + (steps[large] >> U64(8 * width % 64)).tobytes()


def _keys(packed: bytes, close: bool) -> np.ndarray:
    if not close:
        return np.frombuffer(packed, U64)
    n, width = divmod(int.from_bytes(packed[:8], "little"), 16)
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :width] = np.frombuffer(packed, np.uint8, width * n, 8).reshape(-1, width)
    steps = wide.view(U64).ravel()
    rest = np.frombuffer(packed[8 + width * n :], U64)
    half = len(rest) // 2
    steps[rest[:half].astype(np.int64)] += rest[half:] << U64(8 * width % 64)
    return np.cumsum(steps, dtype=U64)


def send(emit: Emit, buckets: int, width: int, close: bool = False):
    """Count a block's keys: ``emit`` gives the keys of all places and their (places, width) increments.

    Keys travel whole, or with ``close`` as differences, which are short where buckets follow the keys.
    """

    def run(table: pa.Table) -> pa.Table:
        keys, steps = emit(table, texts_of(table.column("text")))
        packed = pack(keys, buckets)
        counts = np.column_stack([np.bincount(packed.place, steps[:, i], len(packed.key)) for i in range(width)]).astype(np.uint32)
        block = table.column("block")[0].as_py()
        spans = list(zip(packed.bucket.tolist(), packed.cut[:-1].tolist(), packed.cut[1:].tolist(), strict=True))
        return pa.table(
            {
                "block": pa.array([block] * len(spans), pa.int64()),
                "bucket": pa.array([b for b, _, _ in spans], pa.int64()),
                "keys": pa.array([_bytes(packed.key[x:y], close) for _, x, y in spans], pa.binary()),
                "counts": pa.array([_small(counts[x:y]) for _, x, y in spans], pa.binary()),
            }
        )

    return run


def _small(counts: np.ndarray) -> bytes:
    """Counts as bytes, with a list of those above 254 behind them."""
    flat = counts.ravel().astype(np.uint64)
    large = np.flatnonzero(flat > 254)
    small = np.minimum(flat, 255).astype(np.uint8).tobytes()
    return small + large.astype(np.uint64).tobytes() + flat[large].tobytes()


def _counts(packed: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(packed, np.uint8, n).astype(np.int64)
    rest = np.frombuffer(packed, np.uint64, offset=0, count=0) if len(packed) == n else np.frombuffer(packed[n:], np.uint64)
    half = len(rest) // 2
    out[rest[:half].astype(np.int64)] = rest[half:].astype(np.int64)
    return out


def add(width: int, summary: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None, close: bool = False):
    """Totals of equal keys of all blocks, sent back to each block in the order of its keys.

    ``summary`` of a bucket's distinct keys and totals goes with the first of its rows.
    """

    def run(table: pa.Table) -> pa.Table:
        keys = [_keys(x.as_py(), close) for x in table.column("keys")]
        cut = np.concatenate([[0], np.cumsum([len(x) for x in keys])]).tolist()
        distinct, back = np.unique(np.concatenate(keys), return_inverse=True)
        del keys
        totals = np.zeros((len(distinct), width), np.int64)
        for x, a, b in zip(table.column("counts"), cut[:-1], cut[1:], strict=True):  # a block's keys are distinct
            totals[back[a:b]] += _counts(x.as_py(), (b - a) * width).reshape(-1, width)
        columns = {
            "block": table.column("block"),
            "bucket": table.column("bucket"),
            "totals": pa.array([_small(totals[back[a:b]]) for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
        }
        if summary is not None:
            columns["summary"] = pa.array([summary(distinct, totals), *[None] * (table.num_rows - 1)], pa.list_(pa.int64()))
        return pa.table(columns)

    return run


FIRST, LATER = 1, 2


def _first(table: pa.Table) -> pa.Table:
    """For every key sent: 0 if it is met once, FIRST in the lowest block that has it, else LATER."""
    table = table.sort_by("block")
    keys = [np.frombuffer(x.as_py(), U64) for x in table.column("keys")]
    cut = np.concatenate([[0], np.cumsum([len(x) for x in keys])]).tolist()
    flat = np.concatenate(keys)
    _, where, back = np.unique(flat, return_index=True, return_inverse=True)
    counts = np.concatenate([_counts(x.as_py(), b - a) for x, a, b in zip(table.column("counts"), cut[:-1], cut[1:], strict=True)])
    met = np.bincount(back, counts)[back]
    code = np.where(met > 1, np.where(where[back] == np.arange(len(flat)), FIRST, LATER), 0)
    return pa.table(
        {
            "block": table.column("block"),
            "bucket": table.column("bucket"),
            "totals": pa.array([_small(code[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
        }
    )


TOTALS = "block long, bucket long, totals binary"


def first_keys(sent: DataFrame) -> DataFrame:
    """Whether each key sent is repeated, and if so whether its first block is the sender."""
    return sent.groupBy("bucket").applyInArrow(_first, TOTALS)


def count_keys(blocks: Blocks, emit: Emit, width: int = 1) -> DataFrame:
    """Corpus-wide totals for every block's keys: block, bucket, totals."""
    sent = blocks.rows.groupBy("block").applyInArrow(send(emit, blocks.buckets, width), SENT)
    return sent.groupBy("bucket").applyInArrow(add(width), TOTALS)


def totals_of(replies: pa.Table, packed: Packed, width: int = 1) -> np.ndarray:
    """Totals (distinct keys, width) of a block, in the order of its packed keys."""
    out = np.zeros((len(packed.key), width), np.int64)
    at = np.searchsorted(packed.bucket, replies.column("bucket").to_numpy())
    for k, totals in zip(at.tolist(), replies.column("totals"), strict=True):
        a, b = packed.cut[k], packed.cut[k + 1]
        out[a:b] = _counts(totals.as_py(), int(b - a) * width).reshape(-1, width)
    return out


def with_totals(blocks: Blocks, replies: DataFrame, use: Callable[[pa.Table, Texts, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Bring every block together with the totals of its keys."""

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        return use(table, texts_of(table.column("text")), answers)

    return blocks.rows.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, schema)
