"""Leaks against the rule itself: every window of every text, or a shorter text whole, weighted similarity, no short cut."""

from __future__ import annotations

import random
import re
from collections import Counter

from recordtrust.llm import decontamination as d
from recordtrust.sources.workspace import Workspace

WORD = re.compile("[^\x20\x09-\x0d]+")


def grams(words, k):
    return Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def brute(rows, items):
    """doc_id, item_id, start, similarity of the first most similar window."""
    for item, text in items:
        words = WORD.findall(text.lower())
        k = min(5, len(words))
        want = grams(words, k)
        for i, t in rows:
            w = WORD.findall(t.lower())
            best = None
            for s in range(max(len(w) - len(words), 0) + 1):
                have = grams(w[s : s + len(words)], k)
                same, both = sum((have & want).values()), sum((have | want).values())
                if same and 10 * same >= 8 * both and (best is None or same / both > best[1]):
                    best = s, same / both
            if best:
                yield i, item, best[0], round(best[1], 9)


def check(spark, rows, items):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    with Workspace(spark) as space:
        found = {(r.doc_id, r.item_id, r.start, round(r.similarity, 9)) for r in d.leaks(docs, bench, space).collect()}
    want = set(brute(rows, items))
    assert found == want
    return {r[0] for r in want}


def test_swapped_parts(spark):
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(10**6)}"
    items, rows = [], []
    for i, n in enumerate((59, 100, 300)):
        words = [word() for _ in range(n)]
        swapped = words[n // 2 :] + words[: n // 2]
        third = n // 3
        thirds = words[third:] + words[:third]
        items.append((i, " ".join(words)))
        rows.append((10 * i, " ".join(swapped)))
        rows.append((10 * i + 1, " ".join([word() for _ in range(77)] + swapped + [word() for _ in range(40)])))
        rows.append((10 * i + 2, " ".join([word()] + thirds + swapped)))
        rows.append((10 * i + 3, " ".join([word() for _ in range(n - 1)] + swapped)))
    assert check(spark, rows, items) == {r[0] for r in rows}


def test_texts_shorter_than_an_item(spark):
    rng = random.Random(6)
    word = lambda: f"w{rng.randrange(10**6)}"
    items, rows, leaking = [], [], set()
    for i, n in enumerate((3, 5, 6, 12, 36, 59, 300)):
        words = [word() for _ in range(n)]
        items.append((i, " ".join(words)))
        m = max(n - 4, 1)
        for left in {1, 2, m // 5, m // 5 + 1}:
            for k, text in enumerate((words[left:], words[: n - left], words[: n // 2] + words[n // 2 + left :])):
                doc = 1000 * i + 10 * left + k
                rows.append((doc, " ".join(text)))
                if n > 5 and k < 2 and 0 < 5 * left <= m:  # an end is lost: similarity (m - left) / m
                    leaking.add(doc)
    rows = [r for r in rows if r[1]]
    items.append((90, "a b c d e f g h " * 6))
    rows += [(9000, "a b c d e f g h " * 5), (9001, "a b c d e f g h " * 5 + "a b c")]
    assert check(spark, rows, items) >= leaking | {9001}


def test_repeated_words(spark):
    rng = random.Random(7)
    word = lambda: f"w{rng.randrange(10**6)}"
    items, rows = [], []
    for i in range(24):
        words = [word() for _ in range(300)]
        at = rng.randrange(5, 260)
        items.append((i, " ".join(words)))
        rows.append((i, " ".join([word() for _ in range(9)] + words[:at] + ["_"] * 28 + words[at + 28 :])))
    assert check(spark, rows, items) == set(range(24))
