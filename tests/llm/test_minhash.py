from __future__ import annotations

import random
import re
import time

import pytest

from recordtrust.llm import minhash
from recordtrust.llm.components import components
from recordtrust.sources.workspace import Workspace

WORD = re.compile("[^\x20\x09-\x0d]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(UPPER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows, percent=85):
    sets = [(i, shingles(t)) for i, t in rows]
    near, holders = {}, {}
    for at, (_, s) in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(at)
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for at, (i, s) in enumerate(sets):
        near = {}
        for x in s:
            for other in holders[x]:
                if other < at:
                    near[other] = near.get(other, 0) + 1
        for other, n in near.items():
            if 100 * n >= percent * (len(s) + len(sets[other][1]) - n):
                a, b = sorted((find(i), find(sets[other][0])))
                parent[b] = a
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets)


def families(seed, n):
    rng, out = random.Random(seed), []
    for f in range(n):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.choice([4, 12, 80, 300]))]
        for _ in range(rng.choice([1, 2, 5, 30])):
            text = [x if rng.random() > rng.choice([0, 0.005, 0.01, 0.02]) else f"v{rng.randrange(99)}" for x in base]
            out.append((len(out) + 1000 * (f % 3), rng.choice([" ", "\n"]).join(text)))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("tile", [2_000_000, 1500])
def test_families(spark, monkeypatch, tile):
    monkeypatch.setattr(minhash, "TILE_SHINGLES", tile)
    rows = families(3, 60)
    rows += [(9000, ""), (9001, None), (9002, "A b"), (9003, "a\tb"), (9004, " \n"), (9005, "x " * 30_000), (9006, "X " * 40_000)]
    docs = spark.createDataFrame([(*r, "p", 1) for r in rows], "doc_id long, text string, component string, family int")
    with Workspace(spark) as space:
        assert sorted(map(tuple, minhash.near_duplicates(docs, space).collect())) == brute(rows)


@pytest.mark.parametrize("tile_rows", [20_000, 50])
def test_many_texts_of_one_id(spark, monkeypatch, tile_rows):
    """An id stands for each of its texts; its rows are neither multiplied nor brought to one tile."""
    monkeypatch.setattr(minhash, "TILE_ROWS", tile_rows)
    rows = families(4, 40)
    rows += [(7, t) for _, t in rows[:150]] + [(7, rows[0][1])] * 100 + [(8, f"one two three four five six {i}") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    with Workspace(spark) as space:
        found = minhash.near_duplicates(docs, space)
        assert sorted(map(tuple, found.collect())) == brute(rows)
        signed = space.stage(minhash.signatures(docs), "signed")
        classes = space.stage(minhash.set_classes(signed), "classes")
        tiles = minhash.family_tiles(classes, space)
        assert tiles.count() == tiles.select("doc_id", "text_hash").distinct().count()
        most = tiles.groupBy("family", "tile").count().agg({"count": "max"}).first()[0]
        assert most <= 3 * tile_rows


def test_large_tile_is_linear():
    """Ten thousand near copies of one text: each finds its group at once, and the bands after the first find one group."""
    rng = random.Random(12)
    base = rng.sample(range(2**40), 120)
    sets = []
    for i in range(10_000):
        own = list(base)
        own[rng.randrange(120)] = 2**41 + i
        sets.append(minhash.mix(minhash.np.sort(minhash.np.array(own, minhash.U64))))
    sets = [minhash.np.sort(x) for x in sets]
    signed = minhash.np.array([minhash.signature(x) for x in sets])
    begin = time.process_time()
    found = minhash.links_in_tile(list(range(10_000)), sets, signed, minhash.np.full(10_000, -1), 85)
    assert len(found) == 9_999
    assert time.process_time() - begin < 10


def test_odd_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (None, "a b c d e f"), (3, "x")]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, node int")
    with Workspace(spark) as space:
        found = sorted(map(tuple, minhash.near_duplicates(docs, space).collect()), key=str)
        assert found == sorted([(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (None, 2, None, True), (3, 1, 3, True)], key=str)
        kept = minhash.drop_duplicates(docs, space)
        assert kept.columns == docs.columns
        assert sorted(map(tuple, kept.collect()), key=str) == sorted([(1, "a b c d e f", 7), (None, "a b c d e f", 7), (3, "x", 7)], key=str)
        assert minhash.near_duplicates(docs.limit(0), space).count() == 0


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    with Workspace(spark) as space:
        assert sorted(map(tuple, minhash.near_duplicates(docs, space).collect())) == brute(rows)


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(300)] + [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(250)] + [(7, 7), (2000, 2001)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    with Workspace(spark) as space:
        found = components(spark.createDataFrame(edges, "a long, b long"), space).collect()
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert sorted(map(tuple, found)) == sorted((x, find(x)) for x in linked)
