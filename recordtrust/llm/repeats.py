"""Long repeated spans by a de Bruijn graph of word k-mers, compacted into nonbranching paths.

Every window of k words is an edge from its first k-1 to its last k-1 words; ``exchange`` counts how
often each edge is met in the corpus. Edges met twice or more are repeated. A text walks through the
graph; its maximal runs of repeated edges, cut where the number of walkers changes, are its paths. A
node where that number changes branches or ends a walk, so paths between such nodes do not branch.
Paths with the same words meet in a Spark join on their content, which compacts them to one path with
all its source coordinates.

A path met as often as its edges are is confirmed by its sources, which all have the same words from
end to end (two independent hashes of the whole path). A path met less often shares single edges with
paths that run on differently (a branch where as many walkers leave as join); its edges were compared
one by one in their bucket, by 64 bits of one hash and the bucket's bits of another.

Defined cases: null text: no words; a text shorter than a window has none; repeated rows are texts of
their own, so all their windows are repeated; empty table: no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordtrust.llm import exchange
from recordtrust.llm.text import Texts, Words, span_hash, texts_of, windows, words_of
from recordtrust.sources.workspace import Workspace

WINDOW = 35
PATHS = "block long, row long, doc_id long, start long, n_edges long, met long, path long, check long"
OUTPUT = "doc_id long, n_words long, n_removed long, kept_sha256 string, n_paths long, n_confirmed long"


def edge_keys(words: Words, k: int) -> tuple[np.ndarray, exchange.Keys]:
    start, key = windows(words, k)
    return start, exchange.Keys(key, span_hash(words.hash, start, start + k, 1))


def paths(blocks: exchange.Blocks, k: int) -> DataFrame:
    """Runs of repeated edges of every text, cut where the number of walkers changes."""
    buckets = blocks.buckets

    def emit(table: pa.Table, texts: Texts) -> tuple[exchange.Keys, np.ndarray]:
        _, keys = edge_keys(words_of(texts), k)
        return keys, np.ones((len(keys.key), 1), np.int64)

    def use(table: pa.Table, texts: Texts, replies: pa.Table) -> pa.Table:
        table = exchange.in_order(table)
        words = words_of(texts_of(table.column("text")))
        start, keys = edge_keys(words, k)
        packed = exchange.pack(keys, buckets)
        met = exchange.totals_of(replies, packed)[packed.place, 0]
        rows = words.rows()[start] if len(start) else start
        repeated = met > 1
        new = repeated.copy()
        new[1:] &= ~repeated[:-1] | (met[1:] != met[:-1]) | (rows[1:] != rows[:-1])
        first = np.flatnonzero(new)
        stop = np.zeros(len(new), bool)
        stop[:-1] = ~repeated[1:] | new[1:]
        stop[-1:] = True
        last = np.flatnonzero(stop & repeated)
        begin, end = start[first], start[last] + k
        ids = table.column("doc_id").combine_chunks()
        return pa.table(
            {
                "block": pa.array(np.full(len(first), table.column("block")[0].as_py() if table.num_rows else 0, np.int64)),
                "row": pa.array(rows[first]),
                "doc_id": ids.take(pa.array(rows[first])),
                "start": pa.array(begin - words.first[rows[first]]),
                "n_edges": pa.array(last - first + 1),
                "met": pa.array(met[first]),
                "path": pa.array(span_hash(words.hash, begin, end).view(np.int64)),
                "check": pa.array(span_hash(words.hash, begin, end, 1).view(np.int64)),
            }
        )

    return exchange.with_totals(blocks, exchange.count_keys(blocks, emit), use, PATHS)


def compact(found: DataFrame, workspace: Workspace) -> DataFrame:
    """Join paths with the same words: add their sources, the first of them, and whether they confirm it.

    The merged paths are written, so the join has two plain shuffles and Spark can split a path that
    very many texts share.
    """
    same = ["path", "check", "n_edges"]
    merged = found.groupBy(*same).agg(
        F.count(F.lit(1)).alias("sources"), F.min(F.struct("doc_id", "start")).alias("first_source"), F.max("met").alias("walkers")
    )
    joined = found.join(workspace.stage(merged, "merged"), same)
    return joined.withColumn("confirmed", F.col("sources") >= F.col("walkers"))


def remove_repeats(documents: DataFrame, workspace: Workspace, k: int = WINDOW) -> DataFrame:
    """Digest of every text without the words covered by repeated windows; see OUTPUT."""
    blocks = exchange.deal(documents)
    found = workspace.stage(paths(blocks, k), "paths")
    spans = compact(found, workspace).select("block", "row", "start", "n_edges", "confirmed")

    def use(table: pa.Table, found: pa.Table) -> pa.Table:
        table = exchange.in_order(table)
        texts = texts_of(table.column("text"))
        words = words_of(texts)
        row, begin = (found.column(c).to_numpy() for c in ("row", "start"))
        size = found.column("n_edges").to_numpy()
        at = words.first[row] + begin if len(row) else row.astype(np.int64)
        steps = np.zeros(len(words.hash) + 1, np.int64)
        np.add.at(steps, at, 1)
        np.add.at(steps, at + size + k - 1, -1)
        kept = np.cumsum(steps[:-1]) == 0
        raw, first = texts.data.tobytes(), words.first.tolist()
        left = np.concatenate([[0], np.cumsum(kept)])[words.first]
        digests = []
        for a, b in zip(first[:-1], first[1:], strict=True):
            some = np.flatnonzero(kept[a:b]) + a
            spans = zip(words.start[some].tolist(), words.end[some].tolist(), strict=True)
            digests.append(hashlib.sha256(b" ".join([raw[x:y] for x, y in spans])).hexdigest())
        n = np.diff(words.first)
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "n_words": pa.array(n),
                "n_removed": pa.array(n - np.diff(left)),
                "kept_sha256": pa.array(digests, pa.string()),
                "n_paths": pa.array(np.bincount(row, minlength=len(n))),
                "n_confirmed": pa.array(np.bincount(row[found.column("confirmed").to_numpy(zero_copy_only=False)], minlength=len(n))),
            }
        )

    return blocks.rows.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(use, OUTPUT)


