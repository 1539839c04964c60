"""Cross-entropy difference of two matched bigram models.

The target model is counted on the documents labelled good, the background model on all documents;
both have the same order, smoothing and vocabulary, that of all documents. A document's score is its
mean loss per token under the target model less that under the background model: the lower, the more
target-like. Its own counts are taken out of both models first, so labelled documents have no advantage.

Tokens are words in lower case and an end mark, the context of the first word is a begin mark.
p(w|v) = (c(vw) + MU * p(w)) / (c(v) + MU), p(w) = (c(w) + 1) / (N + V + 1).

No n-gram is pruned or capped and no table of them is broadcast: blocks send the counts of their
n-grams to buckets by ``exchange`` and get corpus-wide counts back. N-grams go by 64 bits of a hash, one of
which tells words from pairs; nothing is cut from it on the way, as sorted keys of a bucket travel as differences.

Defined cases: a text without words (null, empty, blank) has no tokens, losses and score 0; repeated
rows are documents of their own; a label of a document counts if any of its rows says good; null ids are
never labelled; empty tables give no rows or an empty target model; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordtrust.llm import exchange
from recordtrust.llm.text import U64, Texts, Words, mix, texts_of, words_of
from recordtrust.sources.workspace import Workspace

MU = 10.0
BEGIN, END = U64(0x5BD1E9955BD1E995), U64(0xC2B2AE3D27D4EB4F)
OUTPUT = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"


class Grams:
    """N-grams of a block: word and context of every token, and all keys one after another."""

    def __init__(self, words: Words):
        n = np.diff(words.first)
        self.rows = np.repeat(np.arange(len(n)), np.where(n > 0, n + 1, 0))
        size = len(self.rows)
        first = np.ones(size, bool)
        first[1:] = self.rows[1:] != self.rows[:-1]
        last = np.ones(size, bool)
        last[:-1] = first[1:]
        word = np.full(size, END)
        word[~last] = words.hash
        context = np.full(size, END)  # the begin mark is met as often as the end mark
        context[~first] = words.hash
        left = np.where(first, BEGIN, context)
        self.word, self.context = word & ~U64(1), context & ~U64(1)
        self.pair = mix(left * U64(0x9E3779B97F4A7C15) ^ word) | U64(1)

    def keys(self) -> exchange.Keys:
        return exchange.Keys(np.concatenate([self.word, self.pair]), None)


def targets_of(documents: DataFrame, labels: DataFrame, blocks: int) -> DataFrame:
    """Ids labelled good, packed for every block that has rows of theirs.

    The rows of one id lie in as many blocks as it has texts, so a block and id are one row before they meet the labels.
    """
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    block = exchange.block_of(blocks, "doc_id", "text").alias("block")
    placed = documents.where("doc_id IS NOT NULL").select(block, "doc_id").distinct()

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("doc_id").to_numpy().astype(np.int64)
        return pa.table({"block": table.column("block").slice(0, 1), "bucket": pa.array([-1], pa.int64()), "totals": pa.array([ids.tobytes()], pa.binary())})

    return placed.join(good, "doc_id", "left_semi").groupBy("block").applyInArrow(run, exchange.TOTALS)


def _flags(table: pa.Table, packed: pa.Table) -> np.ndarray:
    good = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(x.as_py(), np.int64) for x in packed.column("totals")]])
    ids = table.column("doc_id")
    known = ids.is_valid().to_numpy(zero_copy_only=False) if isinstance(ids, pa.Array) else np.asarray(ids.is_valid())
    values = np.asarray(ids.fill_null(0).to_numpy(), np.int64)
    return np.isin(values, good) & known


def score(documents: DataFrame, labels: DataFrame, workspace: Workspace) -> DataFrame:
    blocks = exchange.deal(documents)
    buckets = max(1, 2 * blocks.buckets)
    targets = workspace.stage(targets_of(documents, labels, blocks.n), "targets")

    def send(table: pa.Table, packed: pa.Table) -> pa.Table:
        def emit(table: pa.Table, texts: Texts) -> tuple[exchange.Keys, np.ndarray]:
            grams = Grams(words_of(texts, lower=True))
            good = _flags(table, packed)[grams.rows] if len(grams.rows) else np.zeros(0, bool)
            return grams.keys(), np.column_stack([np.ones(2 * len(good), np.int64), np.tile(good, 2).astype(np.int64)])

        if not table.num_rows:
            return pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())]).empty_table()
        return exchange.send(emit, buckets, 2, close=True)(table)

    def vocabulary(distinct: np.ndarray, totals: np.ndarray) -> np.ndarray:
        words = (distinct & U64(1)) == 0
        return np.array([np.count_nonzero(words), *totals[words].sum(axis=0)])

    sent = blocks.rows.groupBy("block").cogroup(targets.groupBy("block")).applyInArrow(send, exchange.SENT)
    schema = f"{exchange.TOTALS}, summary array<long>"
    replies = workspace.stage(sent.groupBy("bucket").applyInArrow(exchange.add(2, vocabulary, close=True), schema), "counts")
    sums = [F.coalesce(F.sum(F.get("summary", F.lit(i))), F.lit(0)) for i in range(3)]
    size, n_all, n_target = (int(x) for x in replies.agg(*sums).first())

    def use(table: pa.Table, answers: pa.Table) -> pa.Table:
        bucket = np.asarray(answers.column("bucket").to_numpy(), np.int64)
        words = words_of(texts_of(table.column("text")), lower=True)
        grams = Grams(words)
        good = _flags(table, answers.filter(pa.array(bucket < 0)))
        packed = exchange.pack(grams.keys(), buckets)
        totals = exchange.totals_of(answers.filter(pa.array(bucket >= 0)), packed, 2)
        n = len(grams.rows)
        word_place, pair_place = packed.place[:n], packed.place[n:]
        ends = np.searchsorted(grams.rows, np.arange(table.num_rows), "right") - 1
        begins = np.searchsorted(grams.rows, np.arange(table.num_rows))
        length = ends - begins + 1
        # Places of the contexts: the word before, or the end mark in place of the begin mark.
        context_place = np.empty(n, np.int64)
        context_place[1:] = word_place[:-1]
        some = np.flatnonzero(length > 0)
        context_place[begins[some]] = word_place[ends[some]]
        losses = []
        own = [_own(grams.rows, place, len(packed.key)) for place in (word_place, pair_place)]
        own_context = own[0].copy()
        own_context[1:] = own[0][:-1]
        own_context[begins[some]] = own[0][ends[some]]
        for model, total in ((1, n_target), (0, n_all)):
            mine = good[grams.rows].astype(np.int64) if model else np.ones(n, np.int64)
            c_word = totals[word_place, model] - mine * own[0]
            c_context = totals[context_place, model] - mine * own_context
            c_pair = totals[pair_place, model] - mine * own[1]
            unigram = (c_word + 1) / (total - mine * length[grams.rows] + size + 1)
            loss = -np.log((c_pair + MU * unigram) / (c_context + MU))
            losses.append(np.bincount(grams.rows, loss, table.num_rows) / np.maximum(length, 1))
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "n_tokens": pa.array(length.astype(np.int64)),
                "target_loss": pa.array(losses[0]),
                "background_loss": pa.array(losses[1]),
                "score": pa.array(losses[0] - losses[1]),
            }
        )

    answers = replies.drop("summary").unionByName(targets)
    return blocks.rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(use, OUTPUT)


def _own(rows: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """How often each token's key occurs in its own document."""
    _, back, counts = np.unique(rows * max(n, 1) + place, return_inverse=True, return_counts=True)
    return counts[back]
