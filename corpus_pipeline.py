"""Corpus pipeline: documents -> classified -> boilerplate lines out -> near copies out -> mixed -> tokenised.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame
that is written as Parquet and read again as the next one's docs. All but the last return the
columns of ``documents``; a stage works on every row its predecessor kept.

SQL cannot express the pipeline (expectation-maximisation, seeded draws, tokenisation), so
ORACLE_SQL is None; each operator is tested against a brute-force twin in tests/llm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.bpe_chunks import encode_digests
from riskspark.llm.common import stage, stage_dir, table, word_count
from riskspark.llm.line_dedup import line_dedup
from riskspark.llm.mixing import mix, whole_copies
from riskspark.llm.near_dup import near_duplicates
from riskspark.llm.quality_model import classify
from riskspark.llm.tokens import vocabulary

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return classify(docs).where("kept").select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of each source out; every document stays, n_chars follows the text."""
    out = line_dedup(docs, F.col("source"), F.col("text")).select("row", "text", "n_removed")
    cells = [F.col("text") if c == "text" else F.when(F.col("n_removed") > 0, F.length("text").cast("long"))
             .otherwise(F.col("row.n_chars")).alias(c) if c == "n_chars" else F.col("row")[c].alias(c) for c in docs.columns]
    return out.select(*cells)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one with the least id (a missing id comes last), then the first in the table.

    Rows are told apart by a number of their own, so different texts of one id both stay, and
    copies without an id are copies all the same.
    """
    rows = stage(docs.withColumn("_n", F.monotonically_increasing_id()), f"{stage_dir(spark)}/numbered")
    groups = near_duplicates(rows.select(F.col("_n").alias("doc_id"), "text")).select(F.col("doc_id").alias("_n"), "component_id")
    first = rows.select("_n", "doc_id").join(groups, "_n").groupBy("component_id") \
        .agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_n").alias("keep"))).alias("first"))
    return rows.join(first.select(F.col("first.keep").alias("_n")), "_n", "left_semi").drop("_n")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in whole documents (none comes more than three times), in order of output shard and place: each source's words are
    within a document and a block of its target.

    Wordless documents have nothing to draw and go. The stream's order is by id and text, so rows without an id have places of their own.
    """
    return whole_copies(mix(docs, F.col("source"), word_count(F.col("text")), F.struct("doc_id", F.xxhash64("text")))).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document of the mix."""
    return encode_digests(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("line_dedup", lines), ("near_dedup", near_copies), ("mix", mixed), ("bpe", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; between two of them the rows are a table in the shared folder."""
    docs, at = table(spark, sf_dir, "documents"), stage_dir(spark)
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"{at}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
