from __future__ import annotations

import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from recordtrust.llm import quality_rules as q
from recordtrust.sources.workspace import Workspace

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    spans = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(spans)
    covered = {i + k for i, s in enumerate(spans) if often[s] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    counts = len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)
    return (*counts, len(words) < 10 or 100 * len(covered) > 20 * len(words))


def got(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    with Workspace(spark) as space:
        return sorted(map(tuple, q.judge(docs, space).collect()), key=str)


def test_base_statistics(spark):
    texts = [None, "", " \n\t", "a", "a b c d e a b c d e", "x " * 50, "l one\nl one\n\n \nl one", "é# $%\x85 \U0001f469\n\xa0", "a b c d e f\n" * 9, "w" * 70_000]
    texts += ["a b c d e f g h i j k l m n o p"] * 2
    rows = [(i if i else None, t, "x") for i, t in enumerate(texts)]
    found = got(spark, rows)
    assert [r[:7] for r in found] == sorted([(i, *brute(t)) for i, t, _ in rows], key=str)
    assert all(r[8] is False for r in found if r[6])
    assert got(spark, []) == []


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    with Workspace(spark) as space:
        found = {r.doc_id: tuple(r)[1:] for r in q.judge(docs, space).collect()}
    for row in docs.collect():
        assert found[row.doc_id][:6] == brute(row.text)


def test_junk_goes_and_clean_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").withColumnRenamed("quality", "good")
    with Workspace(spark) as space:
        rows = q.judge(docs, space).join(labels, "doc_id").where("not base_failed").groupBy("good", "kept").count().collect()
    n = {(r.good, r.kept): r["count"] for r in rows}
    assert n[1, True] > 100 * n.get((1, False), 0)
    assert n[0, False] > 20 * n.get((0, True), 0)


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.tuples(*[st.sampled_from([-1, 0, 1])] * 3), st.integers(1, 1000), min_size=1))
def test_estimate_does_not_depend_on_size(patterns):
    beliefs = {n: q.Rule(None, None, 0.3, 0.005) for n in "abc"}
    one = q.estimate(list(patterns.items()), beliefs)
    many = q.estimate([(v, 1000 * n) for v, n in patterns.items()], beliefs)
    for name in beliefs:
        assert all(abs(x - y) < 1e-6 for x, y in zip(one.terms[name], many.terms[name], strict=True))
        assert one.terms[name][0] < 0 < one.terms[name][1]


def test_filter_keeps_all_columns(spark):
    good = "The plain words of this text go on for a while. " * 1 + "There are some more of them here, and they end."
    rows = [(1, good, "a", None), (1, good, "a", None), (2, None, "b", 1), (3, "", "b", 2), (4, "!!! ### $$$", None, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string, symbols int")
    with Workspace(spark) as space:
        kept = q.filter_documents(docs, space)
        assert kept.columns == docs.columns
        assert [tuple(r) for r in kept.collect()] == rows[:2]
        assert q.filter_documents(docs.limit(0), space).count() == 0
