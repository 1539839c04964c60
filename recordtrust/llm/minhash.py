"""Near duplicates by MinHash banding, confirmed on full shingle sets, and connected components.

A document's set holds its distinct 5-word shingles, as 64-bit hashes. Universal hash functions give
a signature of minima; documents that agree on all minima of one of BANDS bands meet in a bucket. With
BANDS = 40 bands of ROWS = 5 minima two sets of similarity 0.85 miss each other in all bands with a
probability of 6e-11, sets of 0.8 with 1e-7.

Documents with equal sets are one class, which one row (of the least doc_id) stands for. Classes that meet in buckets make
families, the components of the star that links every member of a bucket to its least one; no pair is
written. A family's texts are brought together once, in tiles of bounded shingles and rows: a family that fits in one
tile is compared in there; of a larger one every two tiles meet. In a tile, a member of a bucket is compared
with those of other groups only: first with a few of the largest group, which links a copy at once, then
with all that are left, by signature (SLACK below the threshold, over 4 standard deviations) and then on
their full sets; only a link that joins two groups is returned. Components of those links
come from alternating large-star and small-star steps.

Defined cases: a text without words (null, empty, blank) has an empty set, is linked with nothing and is
its own component; fewer than 5 words are one shingle; several rows of one doc_id are compared by their
sets, and each has the component of its id's links; a null doc_id has no component and is kept; an empty
table gives no rows; further columns are ignored by ``near_duplicates`` and kept by ``drop_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordtrust.llm.components import components
from recordtrust.llm.text import U64, Texts, Words, chunks, mix, span_hash, texts_of, windows, words_of
from recordtrust.sources.workspace import Workspace

SHINGLE, PERCENT = 5, 85
BANDS, ROWS = 40, 5
SLACK = 0.13
TILE_SHINGLES, TILE_ROWS = 2_000_000, 20_000
FEW, SOME = 8, 4096
SIGNED = "doc_id long, text_hash long, n_shingles long, set_a long, set_b long, signature binary"
LINKS = "a long, b long"


@cache
def coefficients() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(11).integers(0, 2**63, (2, BANDS * ROWS), dtype=np.uint64)
    return draw[0] * U64(2) + U64(1), draw[1] * U64(2) + U64(1)


def shingle_sets(texts: Texts) -> list[np.ndarray]:
    """Sorted distinct shingles of every text."""
    words: Words = words_of(texts, lower=True)
    start, key = windows(words, SHINGLE)
    count = np.diff(words.first)
    cut = np.searchsorted(start, words.first).tolist()
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    whole = dict(zip(short.tolist(), span_hash(words.hash, words.first[short], words.first[short + 1]), strict=True))
    return [np.array([whole[i]], U64) if i in whole else np.unique(key[cut[i] : cut[i + 1]]) for i in range(len(texts))]


def signature(shingles: np.ndarray) -> np.ndarray:
    """Upper 32 bits of the least value of each hash function over a set."""
    by, plus = coefficients()
    least = np.full(len(by), U64(2**64 - 1))
    for at in range(0, len(shingles), 512):
        part = shingles[at : at + 512]
        least = np.minimum(least, (by[:, None] * part[None, :] + plus[:, None]).min(axis=1))
    return (least >> U64(32)).astype(np.uint32)


def signatures(documents: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            sets = shingle_sets(texts)
            two = [(int(x.sum(dtype=U64)) % 2**64, int(mix(x).sum(dtype=U64)) % 2**64) for x in sets]
            sums = np.array(two, U64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array(sums[:, 0]),
                    pa.array(sums[:, 1]),
                    pa.array([signature(x).tobytes() if len(x) else None for x in sets], pa.binary()),
                ],
                names=["doc_id", "text_hash", "n_shingles", "set_a", "set_b", "signature"],
            )

    return documents.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash")).mapInArrow(run, SIGNED)


def band_keys(classes: DataFrame) -> DataFrame:
    """node, bucket: one row for every band of every class."""
    size = ROWS * 4
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.substring("signature", i * size + 1, F.lit(size)))
    return classes.select("node", F.posexplode(bands).alias("band", "minima")).select("node", F.xxhash64("band", "minima").alias("bucket"))


def equal_sets(one: np.ndarray, two: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(one) > len(two):
        one, two = two, one
    at = np.searchsorted(two, one)
    at[at == len(two)] = len(two) - 1
    return int(np.count_nonzero(two[at] == one))


class Tile:
    """Rows of a tile, and the groups that links have made of them so far: a label per row."""

    def __init__(self, sets: list[np.ndarray], signed: np.ndarray, side: np.ndarray, percent: int):
        self.sets, self.signed, self.side, self.percent = sets, signed, side, percent
        self.size = np.array([len(x) for x in sets])
        self.label = np.arange(len(sets))
        self.members = [[i] for i in range(len(sets))]
        self.links: list[tuple[int, int]] = []
        self.apart: set[tuple[int, int]] = set()

    def _join(self, x: int, y: int) -> None:
        """The smaller group takes the label of the larger one."""
        less, more = sorted((int(self.label[x]), int(self.label[y])), key=lambda g: len(self.members[g]))
        self.label[self.members[less]] = more
        self.members[more] += self.members[less]
        self.members[less] = []
        self.links.append((x, y))

    def _similar(self, x: int, y: int) -> bool:
        pair = (min(x, y), max(x, y))
        if pair in self.apart:
            return False
        same = equal_sets(self.sets[x], self.sets[y])
        if 100 * same >= self.percent * (self.size[x] + self.size[y] - same):
            return True
        self.apart.add(pair)
        return False

    def meet(self, x: int, others: np.ndarray) -> None:
        """Link a row to each group of ``others`` that has a similar row."""
        near = others[self.label[others] != self.label[x]]
        if self.side[x] >= 0:
            near = near[self.side[near] != self.side[x]]
        size = self.size[near]
        near = near[100 * np.minimum(size, self.size[x]) >= self.percent * np.maximum(size, self.size[x])]
        if not len(near):
            return
        like = np.concatenate([(self.signed[near[i : i + SOME]] == self.signed[x]).mean(axis=1) for i in range(0, len(near), SOME)])
        best = np.argsort(-like, kind="stable")
        for y in near[best[like[best] >= self.percent / 100 - SLACK]].tolist():
            if self.label[x] != self.label[y] and self._similar(x, y):
                self._join(x, y)

    def bucket(self, members: np.ndarray) -> None:
        """Link the groups that meet in a bucket, the rows of the smaller ones one by one."""
        labels = self.label[members]
        if (labels == labels[0]).all():
            return
        _, group, count = np.unique(labels, return_inverse=True, return_counts=True)
        members = members[np.lexsort((group, -count[group]))]
        largest = int(count.max())
        for at in range(largest, len(members)):
            x = int(members[at])
            self.meet(x, members[:FEW])
            self.meet(x, members[:at])


def links_in_tile(ids: list[int], sets: list[np.ndarray], signed: np.ndarray, side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that join groups, of rows that share a bucket; with two sides, between those only."""
    tile = Tile(sets, signed, side, percent)
    for band in range(BANDS):
        part = np.ascontiguousarray(signed[:, band * ROWS : (band + 1) * ROWS]).view(f"V{ROWS * 4}").ravel()
        _, where, count = np.unique(part, return_inverse=True, return_counts=True)
        order = np.argsort(where, kind="stable")
        end = np.cumsum(count)
        for k in np.flatnonzero(count > 1).tolist():
            tile.bucket(order[end[k] - count[k] : end[k]])
    return [(ids[x], ids[y]) for x, y in tile.links]


def set_classes(signed: DataFrame) -> DataFrame:
    """One row per distinct set: node (a key of its row), doc_id, text_hash, n_shingles, signature."""
    known = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    one = known.groupBy("set_a", "set_b", "n_shingles").agg(F.min(F.struct("doc_id", "text_hash")).alias("row"), F.first("signature").alias("signature"))
    return one.select(F.xxhash64("row").alias("node"), "row.doc_id", "row.text_hash", "n_shingles", "signature")


def family_tiles(classes: DataFrame, workspace: Workspace) -> DataFrame:
    """Classes of families, with family, tile and the number of tiles."""
    buckets = workspace.stage(band_keys(classes), "bands")
    least = buckets.groupBy("bucket").agg(F.min("node").alias("b"), F.max("node").alias("top")).where("b != top")
    stars = buckets.join(least.select("bucket", "b"), "bucket").where("node != b").select(F.col("node").alias("a"), "b")
    family = components(stars.distinct(), workspace).withColumnRenamed("component", "family")
    sized = classes.join(family, "node")
    total = sized.groupBy("family").agg(F.greatest(F.ceil(F.sum("n_shingles") / F.lit(TILE_SHINGLES)), F.ceil(F.count(F.lit(1)) / F.lit(TILE_ROWS))).alias("tiles"))
    return sized.join(total, "family").withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")))


def links(documents: DataFrame, signed: DataFrame, workspace: Workspace, percent: int) -> DataFrame:
    """Links between classes whose sets are similar, enough of them to connect each component."""
    classes = workspace.stage(set_classes(signed), "classes")
    tiles = workspace.stage(family_tiles(classes, workspace), "tiles")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    # A row and its repetitions are one text.
    texts = rows.join(tiles.select("doc_id", "text_hash"), ["doc_id", "text_hash"], "left_semi").groupBy("doc_id", "text_hash").agg(F.first("text").alias("text"))
    texts = texts.join(tiles.drop("n_shingles", "node"), ["doc_id", "text_hash"])
    # Tiles i and j of a family meet in group (i, j); a family of one tile is group (0, 0).
    pair = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1),
        lambda i: F.struct(F.least(i, F.col("tile")).alias("low"), F.greatest(i, F.col("tile")).alias("high")),
    )
    dealt = texts.withColumn("pair", F.explode(pair)).select("family", "pair.low", "pair.high", "doc_id", "text_hash", "text", "signature", "tile")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("text_hash", "ascending")])
        sets = shingle_sets(texts_of(table.column("text")))
        signed = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint32).reshape(len(sets), -1)
        side = np.asarray(table.column("tile").to_numpy(), np.int64)
        if table.column("low")[0].as_py() == table.column("high")[0].as_py():
            side = np.full(len(sets), -1)
        found = links_in_tile(table.column("doc_id").to_pylist(), sets, signed, side, percent)
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return dealt.groupBy("family", "low", "high").applyInArrow(run, LINKS)


def near_duplicates(documents: DataFrame, workspace: Workspace, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    signed = workspace.stage(signatures(documents), "signatures")
    similar = workspace.stage(links(documents, signed, workspace, percent), "links")
    known = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    by_set = known.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("b"), F.max("doc_id").alias("top")).where("b != top")
    # Written first, so the join has two plain shuffles and Spark can split a large group of copies.
    copies = known.join(workspace.stage(by_set.drop("top"), "sets"), ["set_a", "set_b", "n_shingles"]).select(F.col("doc_id").alias("a"), "b")
    found = components(similar.unionByName(copies), workspace).withColumnRenamed("node", "doc_id")
    return (
        signed.select("doc_id", "n_shingles")
        .join(found, "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def drop_duplicates(documents: DataFrame, workspace: Workspace, percent: int = PERCENT) -> DataFrame:
    """One document of each component: the one with the least id. Rows of one id that are equal are one."""
    found = near_duplicates(documents, workspace, percent)
    ids = found.groupBy("doc_id").agg(F.first("kept").alias("__kept"), (F.count(F.lit(1)) > 1).alias("__twice"))
    # Most ids are kept and met once, so only the others are looked up.
    marked = workspace.stage(ids.where("NOT __kept OR __twice").withColumnRenamed("doc_id", "__id"), "marked")
    joined = documents.join(marked, F.col("doc_id").eqNullSafe(F.col("__id")), "left").where("coalesce(__kept, true)")
    once = joined.where("NOT coalesce(__twice, false)").select(documents.columns)
    if marked.where("__kept AND __twice").isEmpty():
        return once
    return once.unionByName(joined.where("__twice").select(documents.columns).distinct())
