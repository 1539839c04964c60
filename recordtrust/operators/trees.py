"""Trees over binned features, grown from label counts in numpy: what a task does with the cells of one node.

A cell is a feature vector with its counts of disagreeing and agreeing rows. A tree's bootstrap draws every counted row a
Poisson(1) number of times, so a count c weighs Poisson(c). Draws and tried features come from hashes of seed, label, tree,
cell and the path to a node, so a tree is the same however its cells are dealt over tasks and whichever of its nodes
are split where.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np

U64 = np.uint64
LEAF, LINK = -1, -2
SMALL, LARGEST = 16, 64
ONE = float(1 << 26)  # weights below it are added up two in a number, which holds integers up to 2 ** 53
AT_ONCE = 1 << 15  # values that are looked at together
STRIDE = 1 << 15  # rows that go down a tree together
DENSE = 4  # places of a histogram per cell, up to which sums are made by counting, not by sorting


def mix(x: np.ndarray | int) -> np.ndarray:
    """64 bits of which each depends on all bits of the input."""
    with np.errstate(over="ignore"):
        x = np.asarray(x, U64) + U64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers over 0 and below 1 from hashes."""
    return ((mix(x) >> U64(12)).astype(np.float64) + 0.5) / (1 << 52)


def root_path(seed: int, label: int, tree: int) -> int:
    return int(mix(mix(mix(seed) ^ U64(label)) ^ U64(tree)))


def child_paths(path: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return mix(path ^ U64(0x5851F42D4C957F2D)), mix(path ^ U64(0x14057B7EF767814F))


def _cumulative() -> np.ndarray:
    """Of every mean up to SMALL, the Poisson probabilities of at most k, lifted by the mean."""
    out = np.zeros((SMALL + 1, LARGEST))
    for mean in range(SMALL + 1):
        p, total = np.exp(-mean), 0.0
        for k in range(LARGEST):
            total += p
            out[mean, k] = mean + min(total, 1.0)
            p *= mean / (k + 1)
        out[mean, -1] = mean + 1.0
    return out.ravel()


CUMULATIVE = _cumulative()


def poisson(count: np.ndarray, random: np.ndarray) -> np.ndarray:
    """A draw per count: by the inverse of its distribution, and above SMALL by a normal draw corrected for skew."""
    u = uniform(random)
    small = np.minimum(count, SMALL)
    out = (np.searchsorted(CUMULATIVE, small + u, "left") - small * LARGEST).astype(np.float64)
    large = np.flatnonzero(count > SMALL)
    if len(large):
        c = count[large].astype(np.float64)
        z = np.sqrt(-2 * np.log(u[large])) * np.cos(2 * np.pi * uniform(random[large] ^ U64(0xA5A5A5A5A5A5A5A5)))
        out[large] = np.maximum(np.rint(c + np.sqrt(c) * z + (z * z - 1) / 6), 0)
    return out


def draw(cells: np.ndarray, counts: np.ndarray, path: int) -> np.ndarray:
    """Weights (cells, 2) of a tree whose root has that path."""
    base = mix(cells.view(U64) ^ U64(path))
    return np.column_stack([poisson(counts[:, k].astype(np.int64), base + U64(k + 1)) for k in (0, 1)])


class Nodes(NamedTuple):
    """Nodes of a tree, the root first. A row goes left where its bin is at most ``cut``; a leaf has feature LEAF."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    agree: np.ndarray


def feature_order(path: np.ndarray, n_features: int) -> np.ndarray:
    """In what order a node tries features: by hashes, whose last bits give way to the feature's number."""
    mask = U64((1 << n_features.bit_length()) - 1)
    number = np.arange(n_features).astype(U64)
    hashes = mix(path[:, None] ^ mix(number + U64(1))[None, :])
    return (np.sort((hashes & ~mask) | number, axis=1) & mask).astype(np.int64)


def _ordered(key: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys below ``end`` in order, and their places. Key and place are sorted as one number where that fits 63 bits."""
    bits = len(key).bit_length()
    if end.bit_length() + bits > 63:
        order = np.argsort(key)
        return key[order], order
    packed = np.sort(key << bits | np.arange(len(key)))
    return packed >> bits, packed & ((1 << bits) - 1)


def _as_one(weight: list[np.ndarray]) -> list[np.ndarray]:
    """Both weights in one number, where no sum of them takes more bits than a number has: half the sums are made."""
    if all(w.sum() < ONE for w in weight):
        return [weight[0] + ONE * weight[1]]
    return weight


def _apart(sums: list[np.ndarray]) -> list[np.ndarray]:
    if len(sums) == 2:
        return sums
    high = np.floor(sums[0] / ONE)
    return [sums[0] - ONE * high, high]


def _sums(key: np.ndarray, weight: Sequence[np.ndarray], base: np.ndarray, end: int, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The distinct keys below ``end`` in order, how many of them each node has, and the weights of all keys up to each.

    Keys of a node start at its ``base``, its cells stand together, ``size`` of them, and no key weighs nothing.
    """
    if end <= DENSE * len(key):
        both = [np.bincount(key, w, end) for w in weight]
        some = (both[0] if len(both) == 1 else both[0] + both[1]) > 0
        met = np.flatnonzero(some)
        return met, np.add.reduceat(some, base, dtype=np.int64), [np.cumsum(x[met]) for x in both]
    key, order = _ordered(key, end)
    some = np.ones(len(key), bool)
    np.not_equal(key[1:], key[:-1], out=some[:-1])
    last = np.flatnonzero(some)
    return key[last], np.add.reduceat(some, np.cumsum(size) - size, dtype=np.int64), [np.cumsum(w[order])[last] for w in weight]


def _best_cuts(value: np.ndarray, weight: Sequence[np.ndarray], size: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every node the best Gini score of a cut (-1 if all values are equal) and the least such cut.

    Cells stand by node, ``size`` of them in each, and the values of a node are below its ``places``.
    """
    last = np.cumsum(places)
    base = last - places
    key, met, sums = _sums(np.repeat(base, size) + value, weight, base, int(last[-1]), size)
    score, cut = np.full(len(size), -1.0), np.zeros(len(size), np.int64)
    told = np.flatnonzero(met > 1)
    if len(told):
        end = np.cumsum(met) - 1
        inner = np.ones(len(key), bool)
        inner[end] = False
        inner = np.flatnonzero(inner)
        left, right = [], []
        for x in sums:
            until = x[end]
            before = np.append(0.0, until[:-1])
            left.append(x[inner] - np.repeat(before, met - 1))
            right.append(np.repeat(until - before, met - 1) - left[-1])
        found = _gini(*_apart(left), *_apart(right))
        cuts = met[told] - 1
        first = np.cumsum(cuts) - cuts
        top = np.maximum.reduceat(found, first)
        hit = np.flatnonzero(found == np.repeat(top, cuts))
        hit = hit[np.searchsorted(hit, first)]
        score[told], cut[told] = top, key[inner[hit]] - base[told]
    return score, cut


def _try(order: np.ndarray, size: np.ndarray, values: np.ndarray, weight: Sequence[np.ndarray], varied: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best scores and cuts (tries, nodes) of the features ``order`` (nodes, tries), whose values are (tries, cells)."""
    pending, sizes = varied[order.T], np.broadcast_to(size, order.T.shape)
    score, cut = np.full(pending.shape, -1.0), np.zeros(pending.shape, np.int64)
    if pending.any():
        who = np.flatnonzero(np.repeat(pending.ravel(), sizes.ravel()))
        cell = who if len(values) == 1 else who % values.shape[1]
        score[pending], cut[pending] = _best_cuts(values.ravel()[who], [w[cell] for w in weight], sizes[pending], places[order.T[pending]])
    return score, cut


def _gini(left0: np.ndarray, left1: np.ndarray, right0: np.ndarray, right1: np.ndarray) -> np.ndarray:
    return (left0 * left0 + left1 * left1) / (left0 + left1) + (right0 * right0 + right1 * right1) / (right0 + right1)


def gini(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Larger for purer sides: what is left of the Gini impurity once the node's own part is taken away."""
    return _gini(left[..., 0], left[..., 1], right[..., 0], right[..., 1])


def grow(bins: np.ndarray, weight: np.ndarray, path: int, tries: int, span: int, depth: int | None = None) -> Nodes:
    """Grow a node to the end: until its leaves hold one class or equal vectors, or to ``depth`` levels below it.

    A node tries ``tries`` features, and more one by one as long as none of them tells its cells apart. Features that
    are the same for all cells are tried without being looked at, and a node of one cell tries none. ``span`` is above
    all bins; a node's sums take the places of its feature's own bins.
    """
    n_features = bins.shape[1]
    places = bins.max(axis=0).astype(np.int64) + 1 if len(bins) else np.ones(n_features, np.int64)
    varied = places > bins.min(axis=0).astype(np.int64) + 1 if len(bins) else np.zeros(n_features, bool)
    # Cells stand by node, ``size`` of them in each; ``at`` is where a cell's bins start, which are never copied.
    rows = np.flatnonzero(weight.sum(axis=1) > 0)
    bins, at, weight = bins.ravel(), rows * n_features, _as_one([weight[rows, k] for k in (0, 1)])
    size, paths, first, level = np.array([len(rows)]), np.array([path], U64), 0, 0
    feature, cut, left, right, agree = ([] for _ in range(5))
    while len(paths):
        n = len(paths)
        start = np.cumsum(size) - size
        total = _apart([np.add.reduceat(w, start) if len(w) else np.zeros(n) for w in weight])
        known = total[0] + total[1]
        agree.append(np.divide(total[1], known, out=np.zeros(n), where=known > 0))
        open_ = (total[0] > 0) & (total[1] > 0) & (size > 1) & (depth is None or level < depth)
        inside = np.flatnonzero(np.repeat(open_, size))
        at, weight, opened = at[inside], [w[inside] for w in weight], np.flatnonzero(open_)
        size = size[opened]
        best, where, what = np.full(len(opened), -1.0), np.zeros(len(opened), np.int64), np.full(len(opened), LEAF)
        if len(opened):
            order = feature_order(paths[opened], n_features)
            values = np.empty((min(tries, n_features), len(at)), bins.dtype)
            for k, mine in enumerate(values):  # one by one: the places of all tries take several times the bytes of their bins
                np.take(bins, at + np.repeat(order[:, k], size), out=mine, mode="clip")
            here, step = np.arange(len(opened)), max(1, AT_ONCE // len(at))
            for k in range(0, tries, step):
                score, found = _try(order[:, k : min(k + step, tries)], size, values[k : k + step], weight, varied, places)
                top = score.argmax(axis=0)
                hit = np.flatnonzero(score[top, here] > best)
                best[hit], where[hit], what[hit] = score[top[hit], hit], found[top[hit], hit], order[hit, k + top[hit]]
            for k in range(tries, n_features, tries):
                untold = best < 0
                if not untold.any():
                    break
                cells, untold = np.flatnonzero(np.repeat(untold, size)), np.flatnonzero(untold)
                some, many = order[untold, k : k + tries], size[untold]
                values = np.ascontiguousarray(bins[at[cells, None] + np.repeat(some, many, axis=0)].T)
                score, found = _try(some, many, values, [w[cells] for w in weight], varied, places)
                top, number = (score >= 0).argmax(axis=0), np.arange(len(untold))
                best[untold], where[untold], what[untold] = score[top, number], found[top, number], np.where(score[top, number] >= 0, some[number, top], LEAF)
        split = what != LEAF
        number = np.cumsum(split) - 1
        base = first + n

        def every(values: np.ndarray, rest: int) -> np.ndarray:
            out = np.full(n, rest)
            out[opened] = values
            return out

        feature.append(every(what, LEAF))
        cut.append(every(where, 0))
        left.append(every(np.where(split, base + 2 * number, LEAF), LEAF))
        right.append(every(np.where(split, base + 2 * number + 1, LEAF), LEAF))
        go = np.flatnonzero(np.repeat(split, size))
        at, size = at[go], size[split]
        over = bins[at + np.repeat(what[split], size)] > np.repeat(where[split], size)
        child = np.repeat(2 * np.arange(len(size)), size) + over
        by_child = _ordered(child, 2 * len(size))[1]
        at, weight, size = at[by_child], [w[go[by_child]] for w in weight], np.bincount(child, minlength=2 * len(size))
        a, b = child_paths(paths[opened[split]])
        paths, first, level = np.column_stack([a, b]).ravel(), base, level + 1
    return Nodes(*(np.concatenate(x) for x in (feature, cut, left, right, agree)))


def walk(nodes: Nodes, bins: np.ndarray) -> np.ndarray:
    """The node in which every row ends: a leaf, or a link to another part of the tree."""
    at = np.zeros(len(bins), np.int64)
    moving = np.arange(len(bins)) if nodes.feature[0] >= 0 else np.zeros(0, np.int64)
    while len(moving):
        here = at[moving]
        over = bins[moving, nodes.feature[here]] > nodes.cut[here]
        at[moving] = here = np.where(over, nodes.right[here], nodes.left[here])
        moving = moving[nodes.feature[here] >= 0]
    return at


def _by_level(nodes: Nodes) -> tuple[np.ndarray, Nodes]:
    """The nodes level by level, children next to each other: which those are, and the tree numbered so."""
    inner = np.flatnonzero(nodes.feature >= 0)
    child = 1 + 2 * np.arange(len(inner))
    if (nodes.left[inner] == child).all() and (nodes.right[inner] == child + 1).all():
        return np.arange(len(nodes.feature)), nodes
    levels = [np.zeros(1, np.int64)]
    while len(inner := levels[-1][nodes.feature[levels[-1]] >= 0]):
        levels.append(np.column_stack([nodes.left[inner], nodes.right[inner]]).ravel())
    order = np.concatenate(levels)
    found = Nodes(*(x[order] for x in nodes))
    inner = np.flatnonzero(found.feature >= 0)
    found.left[inner], found.right[inner] = 1 + 2 * np.arange(len(inner)), 2 + 2 * np.arange(len(inner))
    return order, found


def encode(nodes: Nodes) -> bytes:
    """A tree in few bytes: features and cuts in as many as they take, shares of leaves as places in a list of theirs.

    Nodes stand level by level, so which nodes are split tells the numbers of all children. Shares of inner nodes, which
    no score reads, are left out.
    """
    nodes = _by_level(nodes)[1]
    inner, leaf, link = nodes.feature >= 0, nodes.feature == LEAF, nodes.feature == LINK
    shares, place = np.unique(nodes.agree[leaf], return_inverse=True)
    out = []
    for x in (nodes.feature + 2, nodes.cut[inner], place, nodes.left[link]):
        x = np.asarray(x, np.int64)
        kind = np.min_scalar_type(int(x.max())) if len(x) else np.dtype(np.uint8)
        out += [np.array([kind.itemsize, len(x)], np.int64).tobytes(), x.astype(kind).tobytes()]
    return b"".join([*out, shares.astype(np.float64).tobytes()])


def decode(packed: bytes) -> Nodes:
    """What ``encode`` packed, children numbered again; inner nodes have share 0."""
    at, parts = 0, []
    for _ in range(4):
        width, n = np.frombuffer(packed, np.int64, 2, at).tolist()
        parts.append(np.frombuffer(packed, f"u{width}", n, at + 16))
        at += 16 + width * n
    feature, shares = parts[0].astype(np.int64) - 2, np.frombuffer(packed, np.float64, -1, at)
    inner, leaf, link = np.flatnonzero(feature >= 0), feature == LEAF, feature == LINK
    cut, left, right = np.zeros(len(feature), np.int64), np.full(len(feature), LEAF), np.full(len(feature), LEAF)
    cut[inner], left[inner], right[inner], left[link] = parts[1], 1 + 2 * np.arange(len(inner)), 2 + 2 * np.arange(len(inner)), parts[3]
    agree = np.zeros(len(feature))
    agree[leaf] = shares[parts[2]]
    return Nodes(feature, cut, left, right, agree)


def ends(nodes: Nodes, bins: np.ndarray) -> np.ndarray:
    """As ``walk``, for nodes that stand level by level: a node is one number, and some thousand rows go down at a time."""
    split, n_features = nodes.feature >= 0, bins.shape[1]
    places = np.arange(len(split))
    # A row stays at a node that is not split: no bin is above its cut.
    node = np.where(split, nodes.left, places) << 32 | np.where(split, nodes.cut, 0xFFFF) << 16 | np.where(split, nodes.feature, 0)
    out, flat = np.empty(len(bins), np.int64), bins.ravel()
    for first in range(0, len(bins), STRIDE):
        start = np.arange(first, min(first + STRIDE, len(bins))) * n_features
        at, moving = np.zeros(len(start), np.int64), np.arange(len(start)) if split[0] else np.zeros(0, np.int64)
        while len(moving):
            here = at[moving]
            row = start[moving]
            for _ in range(4):
                packed = node[here]
                here = (packed >> 32) + (flat[row + (packed & 0xFFFF)] > (packed >> 16 & 0xFFFF))
            at[moving] = here
            moving = moving[split[here]]
        out[first : first + len(start)] = at
    return out
