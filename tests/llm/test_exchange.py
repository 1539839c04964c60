from __future__ import annotations

import time

import numpy as np
import pyarrow as pa
import pytest

from recordtrust.llm import exchange
from recordtrust.llm.text import U64


def keys(seed, n, high=2**63):
    return np.random.default_rng(seed).integers(0, high, n, dtype=np.uint64) * U64(2) + U64(seed % 2)


@pytest.mark.parametrize("n, high", [(0, 9), (1, 2**63), (2, 2**63), (9000, 2**63), (500, 700)])
def test_keys_lose_nothing_as_differences(n, high):
    rising = np.unique(keys(n, n, high))
    packed = exchange._bytes(rising, True)
    assert (exchange._keys(packed, True) == rising).all()
    assert (exchange._keys(exchange._bytes(np.append(rising, U64(2**64 - 1)), True), True)[-1:] == U64(2**64 - 1)).all()
    if n == 9000:
        assert len(packed) < 7.2 * n


def test_upper_bits_make_even_and_narrow_buckets():
    found = exchange.pack(exchange.Keys(keys(1, 700_000), None), 57)
    assert (np.diff(found.cut) > 11_000).all() and len(found.bucket) == 57
    sent = [exchange._bytes(found.key[a:b], True) for a, b in zip(found.cut[:-1], found.cut[1:], strict=True)]
    assert sum(map(len, sent)) < 6.01 * 700_000


@pytest.mark.parametrize("second", [False, True])
def test_many_buckets(second):
    """A block's work follows its keys: 10 blocks and 100,000 buckets, most of them empty."""
    begin, rows, blocks = time.process_time(), [], []
    for block in range(10):
        own = keys(2, 3000) if block % 2 else np.concatenate([keys(2, 1000), keys(block + 3, 2000)])
        given = exchange.Keys(own, own * U64(0x9E3779B97F4A7C15) if second else None)
        table = pa.table({"block": [block], "text": [""]})
        rows.append(exchange.send(lambda t, x, g=given: (g, np.ones((len(g.key), 1), np.int64)), 100_000, 1)(table))
        blocks.append((own, given))
    sent = pa.concat_tables(rows)
    assert sent.num_rows <= 30_000
    buckets = {b: sent.filter(pa.compute.equal(sent.column("bucket"), b)) for b in np.unique(sent.column("bucket").to_numpy())[:300].tolist()}
    replies = pa.concat_tables([exchange.add(1)(t) for t in buckets.values()])
    everything = np.concatenate([own for own, _ in blocks])
    distinct, totals = np.unique(everything, return_counts=True)
    for block, (_, given) in enumerate(blocks):
        packed = exchange.pack(given, 100_000)
        found = exchange.totals_of(replies.filter(pa.compute.equal(replies.column("block"), block)), packed)[:, 0]
        some = np.repeat(np.isin(packed.bucket, list(buckets)), np.diff(packed.cut))
        assert (found[some] == totals[np.searchsorted(distinct, packed.key[some])]).all() and some.any()
    assert time.process_time() - begin < 20
