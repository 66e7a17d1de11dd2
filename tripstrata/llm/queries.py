"""The registered query of each operator, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripstrata.llm import sql
from tripstrata.llm.bpe import encode_documents
from tripstrata.llm.class_lm import score_documents
from tripstrata.llm.decontaminate import find_passages
from tripstrata.llm.jaccard import jaccard_components
from tripstrata.llm.language import predict_language
from tripstrata.llm.minhash import near_copies
from tripstrata.llm.prefix_trie import shared_prefixes
from tripstrata.llm.quality_model import score_quality
from tripstrata.llm.repetition import repetition_rules
from tripstrata.llm.secrets import secret_digests
from tripstrata.llm.sharding import with_shards
from tripstrata.llm.spelling import spelling_forms
from tripstrata.llm.token_blocks import token_files_roundtrip

Query = Callable[[SparkSession, str], DataFrame]

END_ID = 2
SHARD_BYTES = 1 << 20


def tokenizer(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_passages(documents(spark, sf_dir), benchmark)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(documents(spark, sf_dir))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_language(documents(spark, sf_dir))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_quality(documents(spark, sf_dir), labels)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return with_shards(docs, SHARD_BYTES).drop("text")


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))


def op8_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return repetition_rules(docs).drop("text")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer("byte_bpe_50k.json")
    return token_files_roundtrip(documents(spark, sf_dir), path, END_ID)


def op10_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_forms(documents(spark, sf_dir))


def op12_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(documents(spark, sf_dir))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_prefixes(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Query] = {
    "op1_encode": op1_encode,
    "op2_decontaminate": op2_decontaminate,
    "op3_secrets": op3_secrets,
    "op4_language": op4_language,
    "op5_quality": op5_quality,
    "op6_sharding": op6_sharding,
    "op7_jaccard": op7_jaccard,
    "op8_repetition": op8_repetition,
    "op9_token_files": op9_token_files,
    "op10_class_lm": op10_class_lm,
    "op11_spelling": op11_spelling,
    "op12_near_copies": op12_near_copies,
    "op13_prefix_trie": op13_prefix_trie,
}

_KEY = "CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT)"
ORACLES: dict[str, str] = {
    "op7_jaccard": sql.similar(5, 80, "component_id"),
    "op11_spelling": sql.OP11,
    "op12_near_copies": sql.similar(2, 80, "component_id, doc_id = component_id AS kept"),
    "op13_prefix_trie": sql.OP13,
    # A document's bucket is the shallowest one around it that needs no split.
    "op6_sharding": f"""
WITH keyed AS (
  SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes, {_KEY} AS k FROM documents),
nodes AS (
  SELECT CAST(depth AS INTEGER) AS depth, k >> CAST(60 - depth AS INTEGER) AS prefix,
         CAST(sum(n_bytes) AS BIGINT) AS bytes, count(DISTINCT k) AS kinds
  FROM keyed, range(0, 61) AS d(depth) GROUP BY ALL),
ends AS (SELECT depth, prefix, bytes FROM nodes WHERE bytes <= {SHARD_BYTES} OR kinds = 1)
SELECT doc_id, n_bytes, depth AS shard_depth, prefix AS shard_prefix, bytes AS shard_bytes,
       bytes > {SHARD_BYTES} AS oversized
FROM (SELECT doc_id, n_bytes, depth, prefix, bytes,
             min(depth) OVER (PARTITION BY k) AS least
      FROM keyed JOIN ends ON k >> CAST(60 - depth AS INTEGER) = prefix)
WHERE depth = least""",
}
