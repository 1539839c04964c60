"""Draws and growth in a task, against plain rules."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pytest

from recordtrust.operators import trees
from recordtrust.operators.trees import LEAF, draw, grow, poisson, root_path, walk


@pytest.mark.parametrize("count", [0, 1, 2, 7, 16, 17, 60, 5000])
def test_draws_follow_poisson(count):
    found = poisson(np.full(200_000, count), np.arange(200_000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    assert abs(found.mean() - count) < 5 * (count / 200_000) ** 0.5 + 1e-12
    assert found.var() == pytest.approx(count, rel=0.03)
    if 0 < count <= 7:
        assert (found == 0).mean() == pytest.approx(np.exp(-count), abs=0.005)
    assert (found >= 0).all() and (found == np.rint(found)).all()


def test_bootstrap_weights_per_tree():
    """Each tree draws as many rows as there are, give or take; trees and classes draw apart, order plays no part."""
    rng = np.random.default_rng(1)
    cells, counts = rng.integers(-(2**62), 2**62, 5000), rng.integers(0, 40, (5000, 2))
    one, two = (draw(cells, counts, root_path(1, 7, tree)) for tree in (0, 1))
    for k in (0, 1):
        assert one[:, k].sum() == pytest.approx(counts[:, k].sum(), rel=0.02)
    assert abs(np.corrcoef(one[:, 0] - counts[:, 0], two[:, 0] - counts[:, 0])[0, 1]) < 0.05
    assert abs(np.corrcoef(one[:, 0] - counts[:, 0], one[:, 1] - counts[:, 1])[0, 1]) < 0.05
    order = rng.permutation(5000)
    assert (draw(cells[order], counts[order], root_path(1, 7, 0)) == one[order]).all()


def brute_gini(left, right):
    return sum((w * w).sum() / w.sum() for w in (left, right))


def test_root_takes_the_best_cut():
    rng = np.random.default_rng(2)
    for _ in range(30):
        bins = rng.integers(0, 9, (50, 4)).astype(np.uint16)
        weight = rng.integers(0, 4, (50, 2)).astype(float)
        nodes = grow(bins, weight, 5, tries=4, span=9)
        have = weight.sum(axis=1) > 0
        best = max(
            brute_gini(weight[have & (bins[:, f] <= c)].sum(axis=0), weight[have & (bins[:, f] > c)].sum(axis=0))
            for f in range(4) for c in range(8) if (have & (bins[:, f] <= c)).any() and (have & (bins[:, f] > c)).any()
        )
        side = bins[:, nodes.feature[0]] <= nodes.cut[0]
        assert brute_gini(weight[side].sum(axis=0), weight[~side].sum(axis=0)) == pytest.approx(best)


def test_leaves_are_pure_or_hold_equal_vectors():
    rng = np.random.default_rng(3)
    bins = rng.integers(0, 3, (400, 5)).astype(np.uint16)
    weight = rng.integers(0, 3, (400, 2)).astype(float)
    nodes = grow(bins, weight, 9, tries=1, span=3)
    at = walk(nodes, bins)
    used = weight.sum(axis=1) > 0
    for leaf in np.unique(at[used]):
        mine = used & (at == leaf)
        total = weight[mine].sum(axis=0)
        assert nodes.feature[leaf] == LEAF and nodes.agree[leaf] == total[1] / total.sum()
        assert (total == 0).any() or len(np.unique(bins[mine], axis=0)) == 1


def test_counted_and_sorted_sums_grow_equal_trees(monkeypatch):
    """Few places per cell are counted, others sorted as one number, or apart where that is too long: one tree."""
    rng = np.random.default_rng(4)
    bins = rng.integers(0, 300, (3000, 20)).astype(np.uint16)
    weight = rng.integers(0, 3, (3000, 2)).astype(float)
    found = []
    for dense, span in ((4, 300), (0, 300), (10**9, 300), (0, 2**48)):
        monkeypatch.setattr(trees, "DENSE", dense)
        found.append(grow(bins, weight, 11, tries=3, span=span))
    for other in found[1:]:
        assert all((a == b).all() for a, b in zip(found[0], other, strict=True))


def test_growth_sorts_no_pairs(monkeypatch):
    """Sorting places by keys took most of a tree's time; keys and places go as one number."""
    rng = np.random.default_rng(6)
    bins, weight = rng.integers(0, 300, (500, 20)).astype(np.uint16), rng.integers(0, 3, (500, 2)).astype(float)
    monkeypatch.setattr(np, "argsort", lambda *a, **b: pytest.fail("argsort"))
    assert len(grow(bins, weight, 11, tries=3, span=300).feature) > 100


def test_weights_in_one_number_or_apart_grow_equal_trees(monkeypatch):
    """Both weights of a cell are added up in one number where they fit; equal trees come out if they do not."""
    rng = np.random.default_rng(7)
    bins, weight = rng.integers(0, 300, (2000, 20)).astype(np.uint16), rng.integers(0, 3, (2000, 2)).astype(float)
    found = [grow(bins, weight, 11, tries=3, span=300)]
    monkeypatch.setattr(trees, "ONE", 0.0)
    found.append(grow(bins, weight, 11, tries=3, span=300))
    found.append(grow(bins, weight * 2.0**40, 11, tries=3, span=300))
    for other in found[1:]:
        assert all((a == b).all() for a, b in zip(found[0], other, strict=True))


def test_growth_copies_no_bins():
    """Levels used to copy all bins of their cells twice; a node looks at those of the inputs it tries."""
    rng = np.random.default_rng(8)
    bins, weight = rng.integers(0, 300, (5000, 600)).astype(np.uint16), rng.integers(1, 3, (5000, 2)).astype(float)
    tracemalloc.start()
    grow(bins, weight, 11, tries=3, span=300, depth=3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < bins.nbytes / 2


def test_growth_looks_at_one_input_at_a_time():
    """The places of all tried inputs' bins at once took more than all else that a level needs."""
    rng = np.random.default_rng(9)
    bins, weight = rng.integers(0, 300, (100_000, 20)).astype(np.uint16), rng.integers(1, 3, (100_000, 2)).astype(float)
    tracemalloc.start()
    grow(bins, weight, 11, tries=7, span=300, depth=3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 160 * len(bins)


def test_encoded_trees():
    """Trees come back with their children numbered level by level and score alike, links and odd shares included."""
    rng = np.random.default_rng(10)
    bins, weight = rng.integers(0, 300, (2000, 20)).astype(np.uint16), rng.integers(0, 4, (2000, 2)).astype(float)
    grown = grow(bins, weight, 11, tries=3, span=300)
    packed = trees.encode(grown)
    assert len(packed) < sum(x.astype(np.int32).nbytes for x in grown[:4]) / 2
    found = trees.decode(packed)
    assert all((a == b).all() for a, b in zip(grown[:4], found[:4], strict=True))
    at = walk(grown, bins)
    assert (trees.ends(found, bins) == at).all() and (found.agree[at] == grown.agree[at]).all()
    order = rng.permutation(np.arange(1, len(grown.feature)))  # numbered at will, but for the root
    new = np.append(0, order)
    place = np.argsort(new)
    mixed = trees.Nodes(*(x[new] for x in grown))
    inner = mixed.feature >= 0
    mixed.left[inner], mixed.right[inner] = place[mixed.left[inner]], place[mixed.right[inner]]
    assert all((a == b).all() for a, b in zip(found, trees.decode(trees.encode(mixed)), strict=True))
    linked = trees.Nodes(*map(np.array, ([300, LEAF, trees.LINK], [70_000 // 2, 0, 0], [1, LEAF, 7], [2, LEAF, LEAF], [0.0, 1 / 3, 0.0])))
    assert [x.tolist() for x in trees.decode(trees.encode(linked))] == [x.tolist() for x in linked]
    alone = trees.Nodes(*map(np.array, ([LEAF], [0], [LEAF], [LEAF], [0.25])))
    assert trees.ends(trees.decode(trees.encode(alone)), bins[:3]).tolist() == [0, 0, 0]
