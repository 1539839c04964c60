"""Words and rolling hashes of Arrow text batches, as flat numpy arrays.

A word is a run of bytes other than space, tab, LF, VT, FF and CR. Hashes are polynomials modulo
2**64 over random byte values, finished by a mixer; any span of words is hashed from two prefix sums.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
U64 = np.uint64


@cache
def byte_values(lower: bool) -> np.ndarray:
    """A fixed random 64-bit value per byte; with ``lower`` A-Z share those of a-z."""
    values = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
    if lower:
        values[65:91] = values[97:123]
    return values


@cache
def space_bytes() -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(SPACES)] = True
    return table


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def powers(n: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, at least ``n`` of each."""
    have = _POWERS.get(which)
    if have is None or len(have[0]) < n:
        size, base = 1 << max(16, int(n).bit_length()), BASES[which]
        up, down = np.full(size, base, U64), np.full(size, pow(base, -1, 1 << 64), U64)
        up[0] = down[0] = 1
        _POWERS[which] = have = (np.cumprod(up), np.cumprod(down))
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finisher: every input bit moves every output bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Texts(NamedTuple):
    """Texts of a chunk: all bytes, and where each text begins and the last one ends."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def texts_of(column: pa.Array) -> Texts:
    """Bytes and offsets of a string column; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and len(data) else np.zeros(0, np.uint8)
    return Texts(data[at[0] : at[-1]], at - at[0])


def chunks(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Cut batches into runs of rows of about ``limit`` bytes of text; a longer text is a run by itself."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = texts_of(batch.column(batch.schema.get_field_index(text)))
        at, row, n = texts.offsets, 0, batch.num_rows
        while row < n:
            end = max(row + 1, min(n, int(np.searchsorted(at, at[row] + limit, "right")) - 1))
            yield batch.slice(row, end - row), Texts(texts.data[at[row] : at[end]], at[row : end + 1] - at[row])
            row = end


class Words(NamedTuple):
    """Words of a chunk: byte spans, hash, and the first word of every text (and the end of the last)."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def span_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of the value sequences [start, end); equal sequences anywhere hash alike."""
    up, down = powers(len(values) + 1, which)
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U64))


PIECE = 1 << 16


def byte_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """Hash of many byte spans in rising order, a piece of them at a time to spare memory."""
    values, out = byte_values(lower), np.empty(len(start), U64)
    for i in range(0, len(start), PIECE):
        a, b = start[i : i + PIECE], end[i : i + PIECE]
        low = a[0]
        out[i : i + PIECE] = span_hash(values[data[low : b[-1]]], a - low, b - low)
    return out


def words_of(texts: Texts, lower: bool = False) -> Words:
    data, at = texts
    if not len(data):
        none = np.zeros(0, np.int64)
        return Words(none, none, none.astype(U64), np.zeros(len(at), np.int64))
    space = space_bytes()[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    before = np.empty(len(data), bool)
    before[0], before[1:] = True, space[:-1]
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = True, space[1:]
    start = np.flatnonzero(~space & (before | edge[:-1]))
    end = np.flatnonzero(~space & (after | edge[1:])) + 1
    return Words(start, end, byte_hash(data, start, end, lower), np.searchsorted(start, at))


def windows(words: Words, size: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """First words of all windows of ``size`` words inside one text, and their hashes."""
    room = np.repeat(words.first[1:], np.diff(words.first)) - np.arange(len(words.hash))
    start = np.flatnonzero(room >= size)
    return start, span_hash(words.hash, start, start + size, which)


def covered(start: np.ndarray, size: int, total: int) -> np.ndarray:
    """Which of ``total`` places lie in a window of ``size`` that begins at one of ``start``."""
    steps = np.zeros(total + 1, np.int64)
    np.add.at(steps, start, 1)
    np.add.at(steps, np.minimum(start + size, total), -1)
    return np.cumsum(steps[:-1]) > 0
