from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from recordtrust.llm import exchange, language_model
from recordtrust.sources.workspace import Workspace

WORD = re.compile("[^\x20\x09-\x0d]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, good):
    docs = [(i, [w for w in WORD.findall((t or "").translate(UPPER))]) for i, t in rows]
    parts = []
    for i, words in docs:
        tokens = [*words, "</s>"] if words else []
        parts.append((i in good, Counter(tokens), Counter(zip(["<s>", *words], tokens, strict=False)), len(tokens)))
    models = []
    for keep in (lambda g: g, lambda g: True):
        ones, twos, n = Counter(), Counter(), 0
        for g, a, b, k in parts:
            if keep(g):
                ones.update(a), twos.update(b)
                n += k
        models.append((ones, twos, n))
    size = len(models[1][0])
    for (i, words), (g, a, b, k) in zip(docs, parts, strict=True):
        losses = []
        for (ones, twos, n), own in zip(models, (g, True), strict=True):
            loss = 0.0
            for v, w in zip(["<s>", *words], [*words, "</s>"] if words else [], strict=False):
                context = "</s>" if v == "<s>" else v
                p = (ones[w] - own * a[w] + 1) / (n - own * k + size + 1)
                loss -= math.log((twos[v, w] - own * b[v, w] + 10 * p) / (ones[context] - own * a[context] + 10))
            losses.append(loss / max(k, 1))
        yield i, k, losses[0], losses[1], losses[0] - losses[1]


def check(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, block string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    with Workspace(spark) as space:
        found = sorted(map(tuple, language_model.score(docs, marks, space).collect()), key=str)
    wanted = sorted(brute(rows, {i for i, q in labels if q == 1 and i is not None}), key=str)
    assert [f[:2] for f in found] == [w[:2] for w in wanted]
    for f, w in zip(found, wanted, strict=True):
        assert f[2:] == pytest.approx(w[2:], abs=1e-9)


def test_cases(spark, monkeypatch):
    monkeypatch.setattr(exchange, "BUCKET_KEYS", 40)
    monkeypatch.setattr(exchange, "BLOCK_BYTES", 100)
    rows = [(1, "a b a c"), (2, "A b d"), (3, None), (4, ""), (5, "x " * 5000), (6, "a b a c"), (None, "a b"), (7, "the a b"), (7, "the a b"), (8, "\n")]
    check(spark, rows, [(1, 1), (1, 0), (2, 0), (7, 1), (None, 1), (99, 1), (5, None)])
    check(spark, rows, [])
    with Workspace(spark) as space:
        none = spark.createDataFrame([], "doc_id long, text string")
        assert language_model.score(none, spark.createDataFrame([(1, 1)], "doc_id long, quality int"), space).count() == 0


def test_rows_of_one_id_are_dealt_by_their_texts(spark, monkeypatch):
    """A third of the rows have one labelled id, a third no id: neither group is one block."""
    monkeypatch.setattr(exchange, "BLOCK_BYTES", 100)
    rows = [(i, f"{x} w{n} w{n % 7} tail") for n in range(60) for i, x in ((7, "the"), (None, "no"), (100 + n, "own"))]
    check(spark, rows, [(7, 1), (103, 1), (104, 0)])
    dealt = exchange.deal(spark.createDataFrame(rows, "doc_id long, text string"))
    most = dealt.rows.groupBy("block", "doc_id").count().agg({"count": "max"}).first()[0]
    assert dealt.n > 20 and most < 15


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows, [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", "quality").collect()])
