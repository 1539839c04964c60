from __future__ import annotations

import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from recordtrust.llm import exchange, suffixes

WORD = re.compile("[^\x20\x09-\x0d]+")
ROWS = "doc_id long, text string, block string, n_chars int"


def brute(rows, size):
    texts = [WORD.findall(t or "") for _, t, *_ in rows]
    often = Counter(tuple(w[i : i + size]) for w in texts for i in range(len(w) - size + 1))
    for (doc_id, *_), w in zip(rows, texts, strict=True):
        found = {i + j for i in range(len(w) - size + 1) if often[tuple(w[i : i + size])] > 1 for j in range(size)}
        if found:
            yield doc_id, len(w), sorted(found)


def flat(row):
    return row.doc_id, row.n_words, [i for p in row.passages for i in range(p.start, p.start + p.length)]


def check(spark, rows, size):
    docs = spark.createDataFrame(rows, ROWS)
    found = suffixes.repeated_passages(docs, size).collect()
    assert sorted(map(flat, found), key=str) == sorted(brute(rows, size), key=str)
    # Every window stays somewhere, and only once as long as no cut joins words anew.
    kept = [r.text for r in suffixes.remove_later(docs, size).collect()]
    windows = lambda texts: Counter(tuple(w[i : i + size]) for w in (WORD.findall(t or "") for t in texts) for i in range(len(w) - size + 1))
    before, after = windows(r[1] for r in rows), windows(kept)
    assert all(after[x] == 1 for x, n in before.items() if n == 1 and x in after)
    return found, kept


def test_cases(spark, monkeypatch):
    monkeypatch.setattr(exchange, "BUCKET_KEYS", 300)
    monkeypatch.setattr(exchange, "BLOCK_BYTES", 2000)
    part = " ".join(f"é{i}" for i in range(60))
    long = " ".join(f"w{i}" for i in range(2000))
    rows = [(i, f"own{i} begins \n{part}\tends{i} here", "", 5) for i in range(20)]
    rows += [(None, None, "", None), (30, "", "", 0), (31, long, None, 1), (31, long, None, 1), (32, " ".join(f"w{i}" for i in range(500, 549)), "", 1)]
    rows += [(33, "same " * 70, "", 1), (34, "\n", "", 1)]
    found, _ = check(spark, rows, 50)
    assert sum(r.n_repeated - r.n_later for r in found if r.doc_id < 20) == 61  # "begins" too
    docs = spark.createDataFrame(rows, ROWS)
    kept = suffixes.remove_later(docs)
    assert kept.columns == docs.columns
    texts = kept.collect()
    assert sum(part in (r.text or "") for r in texts) == 1
    assert sum(r.doc_id == 31 for r in texts) == 1
    assert {r.doc_id for r in texts} == {r[0] for r in rows}
    assert all(r.n_chars == len(r.text) for r in texts if "own" in (r.text or "") and part not in r.text)
    assert suffixes.repeated_passages(docs.limit(0)).count() == suffixes.remove_later(docs.limit(0)).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=40).map(" ".join), min_size=1, max_size=10), st.sampled_from([2, 5, 9]))
def test_random_texts(spark, texts, size):
    check(spark, [(i, t, "", None) for i, t in enumerate(texts)], size)


def test_whole_table(spark, monkeypatch):
    monkeypatch.setattr(exchange, "BLOCK_BYTES", 1 << 18)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert sorted(map(flat, suffixes.repeated_passages(docs).collect())) == sorted(brute(rows, 50))
