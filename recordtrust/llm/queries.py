"""Registered queries of the operators in this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordtrust.llm import (
    bpe, chat, conversation_repair, decontamination, language_model, minhash, quality_classifier, quality_rules, repeats, spelling, suffixes,
    toxicity, warc,
)
from recordtrust.sources.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]
VOCABULARY = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoding_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), Workspace(spark))


def op3_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), Workspace(spark))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), Workspace(spark))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_passages(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), Workspace(spark))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), Workspace(spark))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Workspace(spark)).drop("text_hash")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), Workspace(spark))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = "<|im_end|><|im_start|>assistant ok"
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(marks).alias("text"),
    )
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_examples(conversations.unionByName(probe)))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_records(table(spark, sf_dir, "pages"), Workspace(spark))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.with_typos(table(spark, sf_dir, "documents"))
    return spelling.spelling_forms(spelling.vocabulary(words), Workspace(spark))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair.repair_digests(conversations, conversation_repair.damaged(conversations), Workspace(spark))


def queries() -> dict[str, Query]:
    found = (
        op1_bpe, op2_lm_score, op3_repeated_spans, op4_toxicity, op5_suffix_dedup, op6_quality_rules, op7_quality_classifier, op8_decontamination,
        op9_near_duplicates, op10_chat, op11_warc, op12_spelling, op13_conversation_repair,
    )
    return {f.__name__: f for f in found}


CHAT_SQL = r"""
WITH given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), sized AS (
    SELECT *,
        length('<|im_start|>') + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\\\1|', 'g')) + 1
            + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + length('<|im_end|>') + 1 AS piece
    FROM given
), summed AS (
    SELECT *,
        sum(piece) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS prefix,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) = count(*) OVER (PARTITION BY conv_id) AS final
    FROM sized
)
SELECT conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    (sum(prefix) FILTER (role = 'assistant' OR final))::BIGINT AS formatted_chars
FROM summed GROUP BY conv_id
"""


#: Five hex digits of the digest are 20 bits, so four characters of base32.
WARC_SQL = r"""
WITH sized AS (
    SELECT page_id, url, encode(coalesce(html, '')) AS payload, sha1(encode(coalesce(html, ''))) AS digest FROM pages
), ranked AS (
    SELECT page_id, octet_length(payload) AS payload_bytes, digest,
        row_number() OVER same AS place, first_value(page_id) OVER same AS response
    FROM sized
    WINDOW same AS (PARTITION BY digest ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST ROWS UNBOUNDED PRECEDING)
), numbers AS (
    SELECT *, [CAST('0x' || substr(digest, 5 * i + 1, 5) AS INT) for i in range(8)] AS parts FROM ranked
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
    array_to_string([
        array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> s) & 31) + 1, 1) for s in [15, 10, 5, 0]], '')
        for v in parts
    ], '') AS payload_digest,
    CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN place > 1 THEN response END AS refers_to
FROM numbers
"""


def oracle() -> dict[str, str]:
    return {"op10_chat": CHAT_SQL, "op11_warc": WARC_SQL}
