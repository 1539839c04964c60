"""The pipeline's stages against brute force, on documents in which cases are planted."""

from __future__ import annotations

import hashlib

import public_tokenizers
from test_decontamination import brute as leaking
from test_minhash import brute as near
from test_quality_rules import brute as base
from test_suffixes import brute as repeated
from tokenizers import Tokenizer

import corpus_pipeline as p
from recordtrust.sources.workspace import Workspace

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    with Workspace(spark) as space:
        docs = spark.read.parquet(f"{SF}/documents.parquet")
        columns, items = docs.columns, [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
        rows = [(r.doc_id, r.text) for r in docs.collect()]

        def after(stage, docs):
            out = space.stage(dict(p.STAGES)[stage](spark, docs, SF), stage.replace(" ", "-"))
            assert out.columns == columns
            return out, [(r.doc_id, r.text) for r in out.collect()]

        docs, kept = after("quality rules", docs)
        passing = {i for i, t in rows if not base(t)[5]}
        assert {i for i, _ in kept} <= passing and len(kept) > 0.85 * len(passing)
        docs, single = after("near duplicates", docs)
        assert sorted(i for i, _ in single) == [i for i, _, _, stays in near(kept, p.SIMILAR) if stays]
        docs, cut = after("repeated passages", docs)
        assert not any(True for _ in repeated(cut, 50))
        touched = {i for i, *_ in repeated(single, 50)}
        assert touched and {x for x in single if x[0] not in touched} <= set(cut)
        docs, clean = after("decontamination", docs)
        assert {i for i, _ in cut} - {i for i, _ in clean} == {x[0] for x in leaking(cut, items)} != set()
        real = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        found = {r.doc_id: r for r in dict(p.STAGES)["encoding"](spark, docs, SF).collect()}
        assert found.keys() == {i for i, _ in clean}
        for i, text in clean:
            ids = real.encode(text, add_special_tokens=False).ids
            assert found[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_empty_documents(spark):
    with Workspace(spark) as space:
        docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
        for name, stage in p.STAGES:
            docs = space.stage(stage(spark, docs, SF), name.replace(" ", "-"))
        assert docs.count() == 0
