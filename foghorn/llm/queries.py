"""Registered queries of the subpackage, and the SQL twins of those that SQL can express.

Each applies its operator with the default parameters to the whole of its table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from foghorn.llm import (
    bpe,
    centroids,
    chat,
    divergence,
    licences,
    lines,
    naming,
    neighbours,
    packing,
    ranked,
    simhash,
    superminhash,
    toxicity,
)
from foghorn.llm.common import documents, table

TOKENIZER = "word_bpe_49k.json"


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of the documents and the line that stands for its component."""
    return lines.line_classes(documents(spark, sf_dir))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naming.exact_duplicates(documents(spark, sf_dir))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.score_documents(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judge_documents(documents(spark, sf_dir)).drop("class_distance", "word_distance")


def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(documents(spark, sf_dir))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", hexed.alias("fingerprint"), "component_id")


#: A conversation that consists of control strings, added to the table.
ODD_TURNS = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = spark.createDataFrame(ODD_TURNS, "conv_id bigint, turn bigint, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(odd)
    return chat.conversation_digests(chat.format_conversations(rows))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_examples(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))
    return packed.drop("loss_tokens")


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_duplicates(documents(spark, sf_dir))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_exact_dedup,
        op3_quality_classifier,
        op4_quality_rules,
        op5_licence_scan,
        op6_simhash_dedup,
        op7_chat_format,
        op8_toxicity,
        op9_bpe,
        op10_packing,
        op11_centroid_clusters,
        op12_minhash_dedup,
        op13_ranked_search,
    )
}

ORACLES: dict[str, str] = {
    "op2_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op4_quality_rules": divergence.judge_sql(),
    "op5_licence_scan": licences.scan_sql(),
    "op7_chat_format": f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       sum({chat.formatted_chars_sql()})::BIGINT AS formatted_chars,
       regexp_full_match(string_agg(CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u'
         WHEN 'assistant' THEN 'a' ELSE 'x' END, '' ORDER BY turn, role, text), 's?(ua)+') AS valid
FROM c GROUP BY conv_id""",
    "op11_centroid_clusters": centroids.clusters_sql(),
    "op12_minhash_dedup": superminhash.near_duplicates_sql(),
    "op13_ranked_search": ranked.search_sql(),
}
