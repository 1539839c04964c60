"""Cleaning a corpus: from documents to digests of tokens, one operator a stage.

Every stage reads what its predecessor wrote, works on all of it, and returns the columns of
documents; the last returns a row of digests per document that is left. Rejected and duplicate
documents go, later copies of repeated passages are cut out of their texts, documents that hold
benchmark items go. Empty tables pass through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from recordtrust.llm import bpe, decontamination, minhash, quality_rules, suffixes
from recordtrust.llm.queries import VOCABULARY, table
from recordtrust.sources.workspace import Workspace

#: Expectation-maximisation, connected components and byte-pair merges are not SQL; tests hold the
#: stages against brute force instead.
ORACLE_SQL = None
#: Near duplicates within the pipeline: the similarity in percent of 5-word shingles.
SIMILAR = 80


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.filter_documents(docs, Workspace(spark))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.drop_duplicates(docs, Workspace(spark), SIMILAR)


def passages_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffixes.remove_later(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_leaking(docs, table(spark, sf_dir, "benchmark"), Workspace(spark))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encoding_digests(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality rules", rules_stage),
    ("near duplicates", near_duplicates_stage),
    ("repeated passages", passages_stage),
    ("decontamination", decontamination_stage),
    ("encoding", encode_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspace, docs = Workspace(spark), table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = workspace.stage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
