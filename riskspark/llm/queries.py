"""Registered queries of the numbered operators: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.bpe_chunks import encode_digests
from riskspark.llm.common import stage, stage_dir, table
from riskspark.llm.embedding_dup import near_vectors
from riskspark.llm.language_id import identify
from riskspark.llm.line_dedup import host_of, line_dedup, page_text
from riskspark.llm.mixing import mix_documents
from riskspark.llm.near_dup import near_duplicates
from riskspark.llm.pii import personal_data
from riskspark.llm.prefix_trie import prefix_trie
from riskspark.llm.quality_model import classify
from riskspark.llm.quality_rules import quality_rules
from riskspark.llm.source_divergence import source_divergence
from riskspark.llm.substring_dedup import substring_dedup
from riskspark.llm.token_files import read_token_files, write_token_files
from riskspark.llm.tokens import vocabulary


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents")).select("row.doc_id", "posterior", "score", "kept")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


def op3_bpe_chunk_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op4_line_first_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(table(spark, sf_dir, "documents"), F.col("text"))
    return out.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                      "n_lost_words")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = f"{stage_dir(spark)}/tokens"
    write_token_files(table(spark, sf_dir, "documents"), out, vocabulary("word_bpe_49k.json"))
    return read_token_files(spark, out)


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target is fixed by the sources; taken by seeded draws, which SQL elsewhere cannot repeat. ``shards`` lists the draws as shard:words."""
    listed = F.array_join(F.transform("draws", lambda d: F.concat_ws(":", d["shard"].cast("string"), d["words"].cast("string"))), ",")
    return mix_documents(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "size", "source_size", "target", "taken", listed.alias("shards"))


def op8_semi_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boilerplate lines of each host's pages: counts and a digest of the page text that stays."""
    pages = table(spark, sf_dir, "pages").select("page_id", host_of(F.col("url")).alias("host"), page_text(F.col("html")).alias("text"))
    out = line_dedup(stage(pages, f"{stage_dir(spark)}/page-text"), F.col("host"), F.col("text"))  # text is read three times
    return out.select("row.page_id", "row.host", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op10_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"), ["doc_id"])


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_bpe_chunk_reuse": op3_bpe_chunk_reuse,
    "op4_line_first_rules": op4_line_first_rules,
    "op5_token_files": op5_token_files,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_mix_sources": op7_mix_sources,
    "op8_semi_crf_pii": op8_semi_crf_pii,
    "op9_line_dedup": op9_line_dedup,
    "op10_nn_descent": op10_nn_descent,
    "op11_language_id": op11_language_id,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_source_divergence": op13_source_divergence,
}
