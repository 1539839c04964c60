"""Repeated passages by a sparse suffix array over content-selected positions.

In every window of ``min_words`` words, the least hash among the first SPAN k-mers selects an anchor,
so equal windows select the same place whatever surrounds them. Only suffixes that begin at anchors are
kept, about one in twelve. They are keyed by their first ``min_words - SPAN + 1`` words, which any match
of ``min_words`` words leaves to the right of its anchor; buckets sort the keys and compare neighbours.

Suffixes with an equal neighbour are extended to the left and to the right: the windows that selected
the anchor are compared in the same way, whole. A passage is repeated where such a window begins
anywhere else as well, in the same text or another. Its first place is the one in the text with the
least hash of id and text, at the least position there; the others are later ones.

Keys go by ``exchange``: per block and bucket, so a passage that a third of the documents share is
compared once per block.

Defined cases: a null text has no words; a text shorter than ``min_words`` has no passage; of equal
rows the first met keeps its text; an empty table gives no rows; all columns are kept by
``remove_later``, and only texts that lose words change.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordtrust.llm import exchange
from recordtrust.llm.text import U64, Texts, Words, covered, span_hash, texts_of, windows, words_of

MIN_WORDS, KMER, SPAN = 50, 8, 24
MATCHES = "doc_id long, n_words long, n_repeated long, n_later long, passages array<struct<start:long,length:long>>"


class Windows(NamedTuple):
    """Begins of all windows of ``min_words`` words, and the anchor that each selects."""

    start: np.ndarray
    anchor: np.ndarray


def anchored(words: Words, min_words: int) -> Windows:
    kmer = min(KMER, max(1, min_words // 4))
    span = min(SPAN, max(1, min_words - kmer))
    room = np.repeat(words.first[1:], np.diff(words.first)) - np.arange(len(words.hash))
    start = np.flatnonzero(room >= min_words)
    if not len(start):
        return Windows(start, start)
    # The upper half is the k-mer's hash, the lower half its place: the least is the leftmost of equals.
    value = np.full(len(words.hash) + span, U64(2**64 - 1))
    at, key = windows(words, kmer)
    value[at] = ((key >> U64(32)) << U64(32)) | at.astype(U64)
    size = 1
    while 2 * size <= span:
        value[: len(value) - size] = np.minimum(value[: len(value) - size], value[size:])
        size *= 2
    least = np.minimum(value[start], value[start + span - size])
    return Windows(start, (least & U64(2**32 - 1)).astype(np.int64))


def suffix_words(min_words: int) -> int:
    kmer = min(KMER, max(1, min_words // 4))
    return min_words - min(SPAN, max(1, min_words - kmer)) + 1


def keys_at(words: Words, start: np.ndarray, size: int) -> exchange.Keys:
    return exchange.Keys(span_hash(words.hash, start, start + size), span_hash(words.hash, start, start + size, 1))


def repeated_windows(blocks: exchange.Blocks, min_words: int) -> DataFrame:
    """Replies for every block's suffixes (level 1) and extended windows (level 2)."""
    buckets, size = blocks.buckets, suffix_words(min_words)

    def emit(table: pa.Table, texts: Texts) -> tuple[exchange.Keys, np.ndarray]:
        words = words_of(texts)
        keys = keys_at(words, np.unique(anchored(words, min_words).anchor), size)
        return keys, np.ones((len(keys.key), 1), np.int64)

    def extend(table: pa.Table, replies: pa.Table) -> pa.Table:
        def windows_of(_: pa.Table, texts: Texts) -> tuple[exchange.Keys, np.ndarray]:
            words = words_of(texts)
            keys = keys_at(words, candidates(words, min_words, buckets, replies), min_words)
            return keys, np.ones((len(keys.key), 1), np.int64)

        return exchange.send(windows_of, buckets, 1)(table)

    suffixes = exchange.count_keys(blocks, emit)
    sent = blocks.rows.groupBy("block").cogroup(suffixes.groupBy("block")).applyInArrow(extend, exchange.SENT)
    matches = exchange.first_keys(sent)
    return suffixes.withColumn("level", F.lit(1)).unionByName(matches.withColumn("level", F.lit(2)))


def candidates(words: Words, min_words: int, buckets: int, replies: pa.Table) -> np.ndarray:
    """Begins of the windows whose anchor's suffix has an equal neighbour."""
    found = anchored(words, min_words)
    anchors, back = np.unique(found.anchor, return_inverse=True)
    packed = exchange.pack(keys_at(words, anchors, suffix_words(min_words)), buckets)
    met = exchange.totals_of(replies, packed)[packed.place, 0]
    return found.start[met[back] > 1]


class Repeats(NamedTuple):
    """For every word, whether it lies in a repeated window, and whether in one that is not the first."""

    any: np.ndarray
    later: np.ndarray


def repeats_of(table: pa.Table, texts: Texts, replies: pa.Table, min_words: int, buckets: int) -> tuple[Words, Repeats]:
    words = words_of(texts)
    level = np.asarray(replies.column("level").to_numpy(), np.int64)
    start = candidates(words, min_words, buckets, replies.filter(pa.array(level == 1)))
    packed = exchange.pack(keys_at(words, start, min_words), buckets)
    code = exchange.totals_of(replies.filter(pa.array(level == 2)), packed)[:, 0]
    # In the first block of a window, its first place is the least in (order, row, position).
    order = np.asarray(table.column("order").to_numpy(), np.int64)[words.rows()[start]] if len(start) else start
    by = np.lexsort((start, order, packed.place))
    head = np.ones(len(by), bool)
    head[1:] = packed.place[by][1:] != packed.place[by][:-1]
    first = np.zeros(len(by), bool)
    first[by[head]] = True
    code = code[packed.place]
    later = (code == exchange.LATER) | ((code == exchange.FIRST) & ~first)
    n = len(words.hash)
    return words, Repeats(covered(start[code > 0], min_words, n), covered(start[later], min_words, n))


def _spans(flags: np.ndarray) -> list[dict[str, int]]:
    edges = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
    return [{"start": a, "length": b - a} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]


def _apply(blocks: exchange.Blocks, min_words: int, use: Callable, schema: str) -> DataFrame:
    replies, buckets = repeated_windows(blocks, min_words), blocks.buckets

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        texts = texts_of(table.column("text"))
        return use(table, texts, *repeats_of(table, texts, answers, min_words, buckets))

    return blocks.rows.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, schema)


def repeated_passages(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Documents with repeated passages, where those lie, and how many words are not the first of theirs."""

    def use(table: pa.Table, texts: Texts, words: Words, found: Repeats) -> pa.Table:
        total = np.concatenate([[0], np.cumsum(found.any)])[words.first]
        later = np.concatenate([[0], np.cumsum(found.later)])[words.first]
        rows = np.flatnonzero(np.diff(total))
        cut = words.first.tolist()
        return pa.table(
            {
                "doc_id": table.column("doc_id").combine_chunks().take(pa.array(rows)),
                "n_words": pa.array(np.diff(words.first)[rows]),
                "n_repeated": pa.array(np.diff(total)[rows]),
                "n_later": pa.array(np.diff(later)[rows]),
                "passages": pa.array(
                    [_spans(found.any[cut[r] : cut[r + 1]]) for r in rows.tolist()],
                    pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])),
                ),
            }
        )

    return _apply(exchange.deal(documents), min_words, use, MATCHES)


def without(raw: bytes, words: Words, gone: np.ndarray, at: int, end: int, first: int, last: int) -> str:
    """A text [at, end) less the bytes from the first to the last word of every run of words ``gone``."""
    parts, here = [], at
    edges = np.flatnonzero(np.diff(np.r_[False, gone[first:last], False].astype(np.int8))) + first
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        parts.append(raw[here : words.start[a]])
        here = int(words.end[b - 1])
    return b"".join([*parts, raw[here:end]]).decode("utf-8")


def remove_later(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Documents without the later places of repeated passages.

    A text of which no word is left goes; ``n_chars``, if there is such a column, follows the text.
    """
    others = [c for c in documents.columns if c != "text"]
    blocks = exchange.deal(documents, {"__row": F.struct(*others)})

    def use(table: pa.Table, texts: Texts, words: Words, found: Repeats) -> pa.Table:
        left = np.concatenate([[0], np.cumsum(found.later)])[words.first]
        lost, n = np.diff(left), np.diff(words.first)
        stays = np.flatnonzero((lost == 0) | (lost < n))
        raw, at, cut = texts.data.tobytes(), texts.offsets.tolist(), words.first.tolist()
        old = table.column("text").combine_chunks()
        new = [without(raw, words, found.later, at[r], at[r + 1], cut[r], cut[r + 1]) if lost[r] else old[r].as_py() for r in stays.tolist()]
        return pa.table({"__row": table.column("__row").combine_chunks().take(pa.array(stays)), "text": pa.array(new, pa.string()), "lost": pa.array(lost[stays])})

    schema = f"__row {blocks.rows.schema['__row'].dataType.simpleString()}, text string, lost long"
    kept = _apply(blocks, min_words, use, schema)
    columns = [F.col("text") if c == "text" else F.col(f"__row.`{c}`").alias(c) for c in documents.columns]
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        old = F.col("__row.n_chars")
        columns[documents.columns.index("n_chars")] = F.when(F.col("lost") > 0, F.char_length("text").cast(kind)).otherwise(old).alias("n_chars")
    return kept.select(columns)
