"""Noisy-or scores of given weights against the rule itself: sentence by sentence, in plain Python."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from recordtrust.llm import toxicity
from recordtrust.llm.text import U64, texts_of

WORD = re.compile("[A-Za-z\x80-\U0010ffff]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(word):
    """Hashes of a word and of its beginnings, as the operator makes them for a text of that word alone."""
    import pyarrow as pa

    return {int(x) for x in toxicity.tokens_of(texts_of(pa.array([word]))).hash[:, 0]}


def sentences(text):
    return [x for x in re.split("(?<=[.!?\n])", text) if x]


def brute(text, weights, bias):
    clean = 1.0
    for sentence in sentences(text or "") or [""]:
        found = {f for w in WORD.findall(sentence.translate(UPPER)) for f in features(w)}
        clean *= 1 - 1 / (1 + math.exp(-(bias + sum(weights.get(f, 0.0) for f in found))))
    return 1 - clean


def test_scores_follow_the_rule(spark):
    rng = random.Random(2)
    words = ["vile", "VILE", "nice", "grumble", "grumbling", "été", "a", "ok"]
    weights = {f: rng.uniform(-2, 3) for w in words if rng.random() < 0.7 for f in sorted(features(w))}
    keys = np.array(sorted(weights), U64)
    model = toxicity.Model(keys, np.array([weights[int(k)] for k in keys]), -2.5)
    rows = [(i, "".join(rng.choice(words) + rng.choice([" ", " ", ". ", "!\n", "? ", ", ", "1"]) for _ in range(rng.randrange(25)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "vile " * 3000), (103, "...!!"), (None, "vile.\n\nnice")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string")
    found = {r.doc_id: r.score for r in toxicity.score_documents(docs, model).collect()}
    for i, text in rows:
        assert found[i] == pytest.approx(brute(text, weights, -2.5), abs=1e-9)
