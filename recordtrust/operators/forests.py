"""One random forest per attribute, all grown from one binned copy of the cells.

All rows of a cell share one feature vector, so a target's training set is the cells with their label counts. Feature
quantiles are sketched once for all targets, and cells are packed into blocks of bin ids that every tree reads.
A bootstrap draws each cell's counts from a Poisson distribution, which is what drawing its rows one by one
comes to. Trees grow until their leaves hold one class or equal vectors, unless a depth is given.

A task reads the blocks itself and grows trees from all cells as long as these are at most NODE_CELLS. Beyond that, nodes with more cells are
split by histograms that all tasks add to, and every smaller node is finished in a task of its own. Either way the same
trees come out. Forests are a table of encoded trees, with a row per tree and finished part of it, which opens to flat node
arrays. Cells are scored by tasks that get up to NODE_CELLS of them and some encoded trees, and send on the sums of their votes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from functools import reduce
from math import isqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordtrust.functions.comparators import UNKNOWN, hash_bucket
from recordtrust.operators.joins import spread_join
from recordtrust.operators.profile import tally
from recordtrust.operators.trees import LEAF, LINK, Nodes, child_paths, decode, draw, encode, ends, feature_order, gini, grow, root_path, walk
from recordtrust.registry import name_groups
from recordtrust.sources.workspace import Workspace, shuffles_dropped

HELD_OUT = "held_out"
BINS = 1024
BLOCK, NODE_CELLS, TOP_NODES = 4096, 1_500_000, 2_000
SCORED_TREES = 5  # trees of a label whose votes a task adds up

BLOCKS = "block long, n int, cells binary, bins binary, counts binary"
PACKED = "label string, tree int, part int, nodes binary"
ARRAYS = "feature array<int>, cut array<int>, left array<int>, right array<int>, agree array<double>"
TREES = f"label string, tree int, part int, {ARRAYS}"


class Forests(NamedTuple):
    """Forests of some labels over the same inputs: a row per tree, and the edges of the inputs' bins.

    ``trees`` has the columns of TREES, and ``nodes`` with the same encoded if they were grown or loaded.
    """

    trees: DataFrame
    edges: list[np.ndarray]
    inputs: list[str]
    labels: list[str]


def held_out(id: str = "id", fraction: float = 0.2, seed: int = 10) -> Column:
    """True for the test share of ids: seeded, and independent of partitioning."""
    return hash_bucket(F.col(id), seed, 1000) < round(fraction * 1000)


def split(df: DataFrame, id: str = "id", fraction: float = 0.2, seed: int = 10) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; all rows of one id fall on the same side."""
    test = held_out(id, fraction, seed)
    return df.where(~test), df.where(test)


def split_tally(
    labelled: DataFrame, keys: Sequence[str], attributes: Sequence[str], fraction: float = 0.2, seed: int = 10
) -> DataFrame:
    """Label counts per key combination and side of the split: one pass for profiles and training."""
    return tally(labelled.withColumn(HELD_OUT, held_out("id", fraction, seed)), [*keys, HELD_OUT], attributes)


def exact_split_tally(
    labelled: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    workspace: Workspace,
    fraction: float = 0.2,
    seed: int = 10,
) -> DataFrame:
    """As ``split_tally``, but every target holds out exactly the ceiling of its share of its known rows.

    Rows are split, not ids, and each target by itself: a row may train one target and test another. ``n`` is counted
    on the training side alone.
    """
    needed = labelled.select(*keys, "id", *name_groups(attributes).label)
    rows = workspace.stage(needed.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    last, held = last_held_out(rows, attributes, fraction, seed), F.col(HELD_OUT)
    both = rows.withColumn(HELD_OUT, F.explode(F.array(F.lit(False), F.lit(True))))
    sides = {f"{a}_label": F.when(_is_held(last[a], seed) == held, F.col(f"{a}_label")).otherwise(UNKNOWN) for a in attributes}
    counted = tally(both.withColumns(sides), [*keys, HELD_OUT], attributes)
    return counted.withColumn("n", F.when(held, F.lit(0).cast("long")).otherwise(F.col("n")))


def _row_order(seed: int) -> Column:
    """Puts numbered rows in a seeded order. This hash maps numbers one to one, so no two rows share a place."""
    return F.xxhash64(F.col("__row"), F.lit(seed).cast("long"))


def _is_held(last: int | None, seed: int) -> Column:
    return F.lit(False) if last is None else _row_order(seed) <= F.lit(last)


def last_held_out(rows: DataFrame, attributes: Sequence[str], fraction: float = 0.2, seed: int = 10) -> dict[str, int | None]:
    """Of every attribute the place of its last held-out row: the k-th of its known rows, k being the ceiling of the share.

    Selection by counting: a pass counts the known rows in 1024 slices of the order, and the slice that holds the k-th
    is cut again, until it ends with the k-th. The driver gets 1024 counts per attribute and pass, 7 passes at most.
    """
    order, known = _row_order(seed), {a: F.col(f"{a}_label") != UNKNOWN for a in attributes}
    sizes = rows.agg(*[F.count_if(known[a]).alias(a) for a in attributes]).first()
    share = round(fraction * 10**6)
    left = {a: -(-sizes[a] * share // 10**6) for a in attributes}
    left = {a: k for a, k in left.items() if k}
    found, low, bits = dict.fromkeys(attributes), dict.fromkeys(left, -(2**63)), 64
    while left:
        step = max(bits - 10, 0)
        inside = {a: known[a] & order.between(low[a], low[a] + 2**bits - 1) for a in left}
        slices = [F.when(inside[a], F.struct(F.lit(a).alias("a"), F.shiftright(order, step).alias("slice"), order.alias("place"))) for a in left]
        met = rows.select(F.explode(F.array_compact(F.array(*slices))).alias("x"))
        counted = met.groupBy("x.a", "x.slice").agg(F.count(F.lit(1)).alias("n"), F.max("x.place").alias("last")).collect()
        for a in list(left):
            for r in sorted((r for r in counted if r["a"] == a), key=lambda r: r["slice"]):
                if left[a] <= r["n"]:
                    break
                left[a] -= r["n"]
            low[a] = r["slice"] << step
            if left[a] == r["n"]:
                found[a] = r["last"]
                del left[a]
        bits = step
    return found


def cell_key(keys: Sequence[str]) -> Column:
    """A number per key combination, nulls told apart from everything else."""
    return F.xxhash64(*[x for k in keys for x in (F.col(k).isNull(), F.col(k))])


def examples(tallied: DataFrame, cells: DataFrame, keys: Sequence[str], inputs: Sequence[str]) -> DataFrame:
    """Training counts with the key and the inputs of their cell."""
    known = cells.select(*keys, *inputs)
    joined = spread_join(tallied.where(~F.col(HELD_OUT)), known, keys, null_safe=True)
    return joined.withColumn("cell", cell_key(keys))


def bin_edges(rows: DataFrame, inputs: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Upper edges of each input's bins, at most ``bins`` quantiles that one pass sketches for all inputs.

    With fewer distinct values than bins and some thousand rows at most, the edges are all values.
    """
    found = rows.approxQuantile(list(inputs), [i / (bins - 1) for i in range(bins)], 1 / (4 * bins))
    return [np.unique(np.array(x, np.float64)) for x in found]


def pack(rows: DataFrame, cell: str, inputs: Sequence[str], edges: list[np.ndarray], counts: Sequence[str] = ()) -> DataFrame:
    """Blocks of up to BLOCK rows: their keys, bin ids (0 up to the number of edges) and counts as flat arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                values = [part.column(1 + k).to_numpy(zero_copy_only=False) for k in range(len(edges))]
                bins = np.column_stack([np.searchsorted(e, v) for e, v in zip(edges, values, strict=True)]).astype(np.uint16)
                counted = [part.column(1 + len(edges) + k).to_numpy(zero_copy_only=False) for k in range(len(counts))]
                packed = np.column_stack(counted).astype(np.int64).tobytes() if counted else None
                cells = part.column(0).to_numpy().astype(np.int64).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.array([part.num_rows], pa.int32()), pa.array([cells]), pa.array([bins.tobytes()]), pa.array([packed], pa.binary())],
                    names=["block", "n", "cells", "bins", "counts"],
                )
                number += 1

    return rows.select(cell, *inputs, *counts).mapInArrow(run, BLOCKS)


def _unpack(table: pa.Table, n_inputs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, bins (cells, inputs) and counts (cells, targets, 2) of some blocks."""

    def flat(name: str, kind: type) -> np.ndarray:
        return np.concatenate([np.frombuffer(x.as_py() or b"", kind) for x in table.column(name)])

    cells = flat("cells", np.int64)
    return cells, flat("bins", np.uint16).reshape(len(cells), n_inputs), flat("counts", np.int64).reshape(len(cells), -1, 2)


def _tree_batch(label: str, tree: int, part: int, nodes: Nodes) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array([x], kind) for x, kind in zip((label, tree, part, encode(nodes)), kinds, strict=True)], names=["label", "tree", "part", "nodes"]
    )


def opened(packed: DataFrame) -> DataFrame:
    """The node arrays next to encoded trees. They are worked out where they are read; inner nodes have share 0."""

    @F.arrow_udf(f"struct<{ARRAYS.replace(' array', ':array')}>")
    def arrays(some: pa.Array) -> pa.Array:
        found, lists = [decode(x.as_py()) for x in some], []
        ends = pa.array(np.cumsum([0, *(len(n.feature) for n in found)]), pa.int32())
        for name in Nodes._fields:  # as one array: a list of arrays would be converted number by number
            kind = np.float64 if name == "agree" else np.int32
            lists.append(pa.ListArray.from_arrays(ends, pa.array(np.concatenate([getattr(n, name).astype(kind) for n in found]))))
        return pa.StructArray.from_arrays(lists, names=Nodes._fields)

    shown = packed.withColumn("__arrays", arrays("nodes"))
    return shown.select("label", "tree", "part", *[F.col(f"__arrays.{c}").alias(c) for c in Nodes._fields], "nodes")


def _packed(trees: DataFrame) -> DataFrame:
    if "nodes" in trees.columns:
        return trees.select("label", "tree", "part", "nodes")

    @F.arrow_udf("binary")
    def nodes(*columns: pa.Array) -> pa.Array:
        return pa.array([encode(Nodes(*(np.array(x.values) for x in row))) for row in zip(*columns, strict=True)], pa.binary())

    return trees.select("label", "tree", "part", nodes(*Nodes._fields).alias("nodes"))


class Plan(NamedTuple):
    """What every tree of a training run shares."""

    labels: list[str]
    n_inputs: int
    tries: int
    span: int
    depth: int | None
    seed: int

    def root(self, target: int, tree: int) -> int:
        return root_path(self.seed, zlib.crc32(self.labels[target].encode()), tree)


def _by_tree(blocks: DataFrame, trees: int) -> DataFrame:
    """The blocks once per tree, a partition each that reads them where they are written: no copy is shuffled."""
    numbers = blocks.sparkSession.range(0, trees, 1, trees).select(F.col("id").cast("int").alias("tree"))
    return numbers.hint("shuffle_replicate_nl").crossJoin(blocks.coalesce(1)).select(*blocks.columns, "tree")


def _whole_trees(blocks: DataFrame, plan: Plan, trees: int, n_cells: int) -> DataFrame:
    """Every tree in one task, from all cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, tree = 0, None
        cells, bins = np.empty(n_cells, np.int64), np.empty((n_cells, plan.n_inputs), np.uint16)
        counts = np.empty((n_cells, len(plan.labels), 2), np.int32)
        for batch in batches:
            if batch.num_rows:
                tree = batch.column("tree")[0].as_py()
                some = _unpack(pa.Table.from_batches([batch]), plan.n_inputs)
                if some[2].max(initial=0) > np.iinfo(counts.dtype).max:
                    counts = counts.astype(np.int64)
                for held, part in zip((cells, bins, counts), some, strict=True):
                    held[at : at + len(some[0])] = part
                at += len(some[0])
        for target, label in enumerate(plan.labels if at else ()):
            path = plan.root(target, tree)
            yield _tree_batch(label, tree, 0, grow(bins, draw(cells, counts[:, target], path), path, plan.tries, plan.span, plan.depth))

    return _by_tree(blocks, trees).mapInArrow(run, PACKED)


class Top:
    """The upper nodes of a tree, which more cells reach than one task should hold."""

    def __init__(self, path: int):
        self.nodes = [[LINK], [0], [LEAF], [LEAF], [0.0]]
        self.path, self.depth, self.open = [path], [0], {0: 0}  # open: how many features a node has tried
        self.parts: dict[int, int] = {}

    def arrays(self) -> Nodes:
        kinds = (np.int64, np.int64, np.int64, np.int64, np.float64)
        return Nodes(*(np.array(x, kind) for x, kind in zip(self.nodes, kinds, strict=True)))

    def features(self, node: int, plan: Plan) -> list[int]:
        order = feature_order(np.array([self.path[node]], np.uint64), plan.n_inputs)[0]
        return order[self.open[node] : self.open[node] + plan.tries].tolist()

    def _settle(self, node: int, total: Sequence[float], plan: Plan) -> bool:
        """Make a node of one class, or at the last depth, a leaf."""
        self.nodes[4][node] = total[1] / (total[0] + total[1]) if total[0] + total[1] else 0.0
        if total[0] and total[1] and (plan.depth is None or self.depth[node] < plan.depth):
            return False
        self.nodes[0][node] = LEAF
        self.open.pop(node, None)
        return True

    def learn(self, node: int, found: dict, plan: Plan) -> None:
        if self._settle(node, found["total"], plan):
            return
        if found["feature"] is None:
            self.open[node] += plan.tries
            if self.open[node] >= plan.n_inputs:
                self.nodes[0][node] = LEAF
                del self.open[node]
            return
        del self.open[node]
        self.nodes[0][node], self.nodes[1][node] = found["feature"], found["cut"]
        paths = child_paths(np.array([self.path[node]], np.uint64))
        for side, (path, total, size) in enumerate(zip(paths, (found["left"], found["right"]), found["sizes"], strict=True)):
            child = len(self.path)
            self.nodes[2 + side][node] = child
            for column, value in zip(self.nodes, (LINK, 0, LEAF, LEAF, 0.0), strict=True):
                column.append(value)
            self.path.append(int(path[0]))
            self.depth.append(self.depth[node] + 1)
            if self._settle(child, total, plan):
                continue
            if size > NODE_CELLS:
                self.open[child] = 0
            else:
                self.parts[child] = self.nodes[2][child] = len(self.parts) + 1


def _histograms(blocks: DataFrame, plan: Plan, wanted: dict[tuple[int, int], tuple[Nodes, dict[int, list[int]], set[int]]]) -> list[dict]:
    """The best cut of every open node: all tasks add the weights of their cells by node, feature and bin."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int, int], np.ndarray] = {}
        for batch in batches:
            cells, bins, counts = _unpack(pa.Table.from_batches([batch]), plan.n_inputs)
            for (target, tree), (nodes, open_, _) in wanted.items():
                weight = draw(cells, counts[:, target], plan.root(target, tree))
                at = walk(nodes, bins)
                at[weight.sum(axis=1) == 0] = -1
                for node, features in open_.items():
                    rows = np.flatnonzero(at == node)
                    mine = sums.setdefault((target, tree, node), np.zeros((len(features), plan.span, 3)))
                    for j, f in enumerate(features):
                        for k, w in enumerate((weight[rows, 0], weight[rows, 1], None)):
                            mine[j, :, k] += np.bincount(bins[rows, f], w, plan.span)
        for (target, tree, node), mine in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], pa.int32()) for x in (target, tree, node)] + [pa.array([mine.tobytes()], pa.binary())],
                names=["target", "tree", "node", "sums"],
            )

    def best(table: pa.Table) -> pa.Table:
        target, tree, node = (table.column(c)[0].as_py() for c in ("target", "tree", "node"))
        _, open_, first_valid = wanted[target, tree]
        sums = sum(np.frombuffer(x.as_py()) for x in table.column("sums")).reshape(len(open_[node]), plan.span, 3)
        total = sums[0].sum(axis=0)
        left = np.cumsum(sums, axis=1)
        right = total - left
        valid = (left[:, :, 2] > 0) & (right[:, :, 2] > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.where(valid, gini(left[:, :, :2], right[:, :, :2]), -1.0)
        cut = score.argmax(axis=1)
        top = score[np.arange(len(cut)), cut]
        fit = np.flatnonzero(top >= 0)
        j = -1 if not len(fit) else int(fit[0]) if node in first_valid else int(top.argmax())
        at = left[j, cut[j]], right[j, cut[j]]
        row = {
            "target": target, "tree": tree, "node": node, "total": total[:2].tolist(), "feature": open_[node][j] if j >= 0 else None,
            "cut": int(cut[j]), "left": at[0][:2].tolist(), "right": at[1][:2].tolist(), "sizes": [int(x[2]) for x in at],
        }
        return pa.Table.from_pylist([row], schema)

    numbers = pa.list_(pa.float64())
    schema = pa.schema(
        [(c, pa.int32()) for c in ("target", "tree", "node")]
        + [("total", numbers), ("feature", pa.int32()), ("cut", pa.int32()), ("left", numbers), ("right", numbers), ("sizes", pa.list_(pa.int64()))]
    )
    counted = blocks.mapInArrow(count, "target int, tree int, node int, sums binary")
    kinds = "target int, tree int, node int, total array<double>, feature int, cut int, left array<double>, right array<double>, sizes array<long>"
    return [r.asDict() for r in counted.groupBy("target", "tree", "node").applyInArrow(best, kinds).collect()]


def _finish(blocks: DataFrame, plan: Plan, tops: dict[tuple[int, int], Top]) -> DataFrame:
    """Bring the cells of every node below the tops together, and grow it to the end."""
    routes = {key: (top.arrays(), top.parts, top.path, top.depth) for key, top in tops.items() if top.parts}

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, bins, counts = _unpack(pa.Table.from_batches([batch]), plan.n_inputs)
            for (target, tree), (nodes, parts, paths, depths) in routes.items():
                weight = draw(cells, counts[:, target], plan.root(target, tree))
                at = walk(nodes, bins)
                at[weight.sum(axis=1) == 0] = -1
                out = []
                for node in np.unique(at).tolist():
                    if node in parts:
                        rows = at == node
                        path = int(np.array(paths[node], np.uint64).view(np.int64))
                        out.append((target, tree, parts[node], path, depths[node], bins[rows].tobytes(), weight[rows].tobytes()))
                if out:
                    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
                    names = ["target", "tree", "part", "path", "depth", "bins", "weight"]
                    yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    def run(table: pa.Table) -> pa.Table:
        target, tree, part, path, depth = (table.column(c)[0].as_py() for c in ("target", "tree", "part", "path", "depth"))
        bins = np.concatenate([np.frombuffer(x.as_py(), np.uint16) for x in table.column("bins")]).reshape(-1, plan.n_inputs)
        weight = np.concatenate([np.frombuffer(x.as_py()) for x in table.column("weight")]).reshape(-1, 2)
        left = None if plan.depth is None else plan.depth - depth
        return pa.Table.from_batches([_tree_batch(plan.labels[target], tree, part, grow(bins, weight, path % 2**64, plan.tries, plan.span, left))])

    routed = blocks.mapInArrow(route, "target int, tree int, part int, path long, depth int, bins binary, weight binary")
    return routed.groupBy("target", "tree", "part").applyInArrow(run, PACKED)


def _split_trees(blocks: DataFrame, plan: Plan, trees: int, cells: int, workspace: Workspace) -> DataFrame:
    """Trees whose upper nodes are split by all tasks together, some trees at a time."""
    spark, out = blocks.sparkSession, []
    at_once = max(1, TOP_NODES // (len(plan.labels) * -(-cells // NODE_CELLS)))
    for first in range(0, trees, at_once):
        tops = {(t, tree): Top(plan.root(t, tree)) for t in range(len(plan.labels)) for tree in range(first, min(first + at_once, trees))}
        while any(top.open for top in tops.values()):
            wanted = {
                key: (top.arrays(), {n: top.features(n, plan) for n in top.open}, {n for n, tried in top.open.items() if tried >= plan.tries})
                for key, top in tops.items() if top.open
            }
            for found in _histograms(blocks, plan, wanted):
                tops[found["target"], found["tree"]].learn(found["node"], found, plan)
        rows = [(plan.labels[t], tree, 0, bytearray(encode(top.arrays()))) for (t, tree), top in tops.items()]
        out.append(spark.createDataFrame(rows, PACKED))
        if any(top.parts for top in tops.values()):
            out.append(workspace.stage(_finish(blocks, plan, tops), "parts"))
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found


def train_all(
    rows: DataFrame,
    attributes: Sequence[str],
    inputs: Sequence[str],
    workspace: Workspace,
    trees: int = 100,
    depth: int | None = None,
    seed: int = 1,
    bins: int = BINS,
) -> Forests:
    """Fit one forest per attribute on ``examples``: one pass for the bins, one to pack the cells.

    A node tries as many inputs as the square root of their number. ``depth`` None sets no limit.
    """
    edges, labels = bin_edges(rows, inputs, bins), name_groups(attributes).label
    counts = [f"{a}_{kind}" for a in attributes for kind in ("disagree", "agree")]
    blocks = workspace.stage(pack(rows, "cell", inputs, edges, counts), "blocks")
    cells = blocks.agg(F.sum("n")).first()[0] or 0
    plan = Plan(labels, len(inputs), max(isqrt(len(inputs)), 1), max(len(e) for e in edges) + 1, depth, seed)
    grown = _whole_trees(blocks, plan, trees, cells) if cells <= NODE_CELLS else _split_trees(blocks, plan, trees, cells, workspace)
    return Forests(opened(workspace.stage(grown, "forests")), edges, list(inputs), labels)


SUMS = "first int, block long, sums binary"


def _votes(blocks: DataFrame, forests: Forests, trees: int, chunks: int) -> DataFrame:
    """Of each block and some trees of a number, what these say of each row of each label, added up in their order.

    A group has a chunk of the blocks and the encoded trees of some numbers. Rows that leave a tree for a part of it go on there.
    """
    n_inputs, place = len(forests.inputs), {x: i for i, x in enumerate(forests.labels)}

    def run(some: pa.Table, grown: pa.Table) -> pa.Table:
        first, sizes = [some.column("first")[0].as_py()] * some.num_rows if some.num_rows else [], some.column("n").to_pylist()
        bins = np.concatenate([np.zeros(0, np.uint16), *(np.frombuffer(x.as_py(), np.uint16) for x in some.column("bins"))]).reshape(-1, n_inputs)
        sums = np.zeros((len(place), len(bins)))
        grown = grown.sort_by([("label", "ascending"), ("tree", "ascending"), ("part", "ascending")]) if len(bins) else grown.slice(0, 0)
        for label, part, packed in zip(*(grown.column(c) for c in ("label", "part", "nodes")), strict=True):
            nodes, mine = decode(packed.as_py()), sums[place[label.as_py()]]
            if part.as_py():
                rows = going[to == part.as_py()]
                mine[rows] += nodes.agree[ends(nodes, bins[rows])]
                continue
            at = ends(nodes, bins)
            mine += nodes.agree[at]  # 0 at links
            going = np.flatnonzero(nodes.feature[at] == LINK)
            to = nodes.left[at[going]]
        found = np.split(sums, np.cumsum(sizes)[:-1], axis=1) if sizes else []
        return pa.table([pa.array(first, pa.int32()), some.column("block"), pa.array([x.tobytes() for x in found], pa.binary())], names=["first", "block", "sums"])

    groups = -(-trees // SCORED_TREES)
    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("first")
    dealt = blocks.select("block", "n", "bins", F.pmod(F.xxhash64("block"), F.lit(chunks)).cast("int").alias("chunk"), every)
    numbered = _packed(forests.trees).where(F.col("label").isin(list(place))).withColumn("first", F.floor(F.col("tree") / SCORED_TREES).cast("int"))
    numbered = numbered.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    return dealt.groupBy("first", "chunk").cogroup(numbered.groupBy("first", "chunk")).applyInArrow(run, SUMS)


def score(df: DataFrame, forests: Forests, workspace: Workspace) -> DataFrame:
    """Append ``<attribute>_prob``, the mean share of agreeing rows in the leaves of the attribute's trees.

    Missing inputs count as the largest values, and an attribute without trees has probability 0.
    """
    names = [f"{label.removesuffix('_label')}_prob" for label in forests.labels]
    rows = workspace.stage(df.withColumn("__row", F.monotonically_increasing_id()), "rows")
    blocks = workspace.stage(pack(rows, "__row", forests.inputs, forests.edges), "row-blocks")
    total = blocks.agg(F.sum("n")).first()[0] or 0
    sizes = forests.trees.where("part = 0").groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max("tree").alias("last")).collect()
    trees = max((r["last"] for r in sizes), default=0) + 1
    per_label = {r["label"]: r["n"] for r in sizes}
    number = [max(per_label.get(x, 0), 1) for x in forests.labels]
    schema = pa.schema([("__row", pa.int64())] + [(c, pa.float64()) for c in names])

    def run(some: pa.Table, given: pa.Table) -> pa.Table:
        cells = np.frombuffer(some.column("cells")[0].as_py(), np.int64)
        sums = np.zeros((len(number), len(cells)))
        for x in given.sort_by("first").column("sums"):
            sums += np.frombuffer(x.as_py()).reshape(sums.shape)
        return pa.table([pa.array(cells), *(pa.array(x / n) for x, n in zip(sums, number, strict=True))], schema=schema)

    kinds = ", ".join(["__row long", *(f"{c} double" for c in names)])
    votes = _votes(blocks, forests, trees, max(1, -(-total // NODE_CELLS)))
    scored = workspace.stage(blocks.select("block", "cells").groupBy("block").cogroup(votes.groupBy("block")).applyInArrow(run, kinds), "scores")
    return rows.join(scored, "__row").select(*df.columns, *names)


def predicted(probability: str) -> Column:
    """Class of the larger probability; a tie is class 0."""
    return F.when(F.col(probability) > 0.5, 1).otherwise(0)


def save_models(forests: Forests, uri: str) -> None:
    """Write the encoded trees, a folder per label, and the edges of the bins."""
    spark = forests.trees.sparkSession
    with shuffles_dropped(spark):
        _packed(forests.trees).write.mode("overwrite").option("compression", "zstd").partitionBy("label").parquet(f"{uri.rstrip('/')}/trees")
    rows = [(i, name, edges.tolist()) for i, (name, edges) in enumerate(zip(forests.inputs, forests.edges, strict=True))]
    spark.createDataFrame(rows, "place int, input string, edges array<double>").coalesce(1).write.mode("overwrite").parquet(f"{uri.rstrip('/')}/inputs")


def load_models(spark: SparkSession, uri: str, attributes: Sequence[str]) -> Forests:
    labels = name_groups(attributes).label
    found = spark.read.parquet(f"{uri.rstrip('/')}/trees")
    packed = "nodes" in found.columns  # else they were saved as arrays
    trees = spark.read.schema(PACKED if packed else TREES).parquet(f"{uri.rstrip('/')}/trees").where(F.col("label").isin(labels))
    trees = opened(trees) if packed else trees
    inputs = spark.read.parquet(f"{uri.rstrip('/')}/inputs").orderBy("place").collect()
    return Forests(trees, [np.array(r["edges"], np.float64) for r in inputs], [r["input"] for r in inputs], labels)


def from_nodes(spark: SparkSession, trees: dict[str, list[list[tuple]]], inputs: Sequence[str]) -> Forests:
    """Forests written out by hand: of each label the trees, of each tree its nodes, the root first.

    A node is (input, threshold, left, right), where rows of at most the threshold go to the left one, or the leaf's
    share of agreeing rows alone.
    """
    place = {name: i for i, name in enumerate(inputs)}
    inner = [node for found in trees.values() for nodes in found for node in nodes if len(node) == 4]
    edges = [np.array(sorted({t for name, t, _, _ in inner if name == x}), np.float64) for x in inputs]
    rows = []
    for label, found in trees.items():
        for tree, nodes in enumerate(found):
            split = [len(n) == 4 for n in nodes]
            feature = [place[n[0]] if x else LEAF for n, x in zip(nodes, split, strict=True)]
            cut = [int(np.searchsorted(edges[f], n[1])) if x else 0 for f, n, x in zip(feature, nodes, split, strict=True)]
            left, right = ([n[k] if x else LEAF for n, x in zip(nodes, split, strict=True)] for k in (2, 3))
            rows.append((label, tree, 0, feature, cut, left, right, [0.0 if x else float(n[0]) for n, x in zip(nodes, split, strict=True)]))
    return Forests(spark.createDataFrame(rows, TREES), edges, list(inputs), list(trees))


def from_spark(spark: SparkSession, uri: str, label: str, inputs: Sequence[str]) -> Forests:
    """A binary forest that Spark ML has saved, as a table of nodes; its thresholds become the edges."""
    nodes = spark.read.parquet(f"{uri.rstrip('/')}/data").select("treeID", "nodeData.*")
    cut = F.col("split.leftCategoriesOrThreshold")[0]
    inner = F.col("leftChild") >= 0
    found = nodes.where(inner).groupBy(F.col("split.featureIndex").alias("f")).agg(F.sort_array(F.collect_set(cut)).alias("edges")).collect()
    by_input = {r["f"]: np.array(r["edges"], np.float64) for r in found}
    edges = [by_input.get(i, np.zeros(0)) for i in range(len(inputs))]
    known = spark.createDataFrame([(f, e.tolist()) for f, e in by_input.items()], "f int, edges array<double>")
    node = F.struct(
        "id",
        F.when(inner, F.col("f")).otherwise(LEAF).alias("feature"),
        F.when(inner, F.array_position("edges", cut).cast("int") - 1).otherwise(0).alias("cut"),
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
        (F.get("impurityStats", F.lit(1)) / F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x)).alias("agree"),
    )
    joined = nodes.join(F.broadcast(known), nodes["split.featureIndex"] == known["f"], "left")
    trees = joined.groupBy(F.col("treeID").alias("tree")).agg(F.array_sort(F.collect_list(node)).alias("nodes"))
    arrays = [F.col(f"nodes.{c}").alias(c) for c in Nodes._fields]
    return Forests(trees.select(F.lit(label).alias("label"), "tree", F.lit(0).alias("part"), *arrays), edges, list(inputs), [label])
