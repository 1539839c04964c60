from __future__ import annotations

from recordtrust.llm.sample import labelled_sample, remainder


def test_one_row_per_sampled_id(spark):
    rows = [(i, f"text {i}") for i in range(40)] + [(7, f"other {k}") for k in range(500)] + [(7, "text 7"), (8, None), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(7, 0), (None, 1)], "doc_id long, toxic int")
    left = {r.doc_id for r in docs.where(remainder("doc_id", 3) != 1).select("doc_id").collect()}
    assert 7 in left
    found = labelled_sample(docs, labels, "toxic", 3, 1).collect()
    assert sorted(r.doc_id for r in found) == sorted(left)
    assert all((r.doc_id, r.text) in rows and r.label == r.doc_id % 2 for r in found)
    again = labelled_sample(docs.repartition(3), labels, "toxic", 3, 1).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, found))
    assert labelled_sample(docs, labels, "toxic", 3, 1, rows=5).count() == 5
