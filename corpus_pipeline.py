"""From raw documents to token ids: quality rules, line dedup, near-dedup, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's ``docs``. All but the last return the columns of
documents; ``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from pitfeat.llm.bpe import vocabulary_path
from pitfeat.llm.chunk_bpe import encode_documents
from pitfeat.llm.line_dedup import dedup_lines
from pitfeat.llm.mixing import mix_documents
from pitfeat.llm.near_copies import drop_near_copies
from pitfeat.llm.quality_rules import drop_rejected, trusted_ids
from pitfeat.session import shared_dir


def _resized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return drop_rejected(docs, trusted_ids(spark.read.parquet(f"{sf_dir}/labels.parquet")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go."""
    return _resized(dedup_lines(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of five-word shingle similarity 0.8 or more stays; candidates come from op2's SimHash links and from least hashes."""
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix takes a document, with the words it takes."""
    return _resized(mix_documents(docs))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (32-bit little-endian), ids_sha256 and decoded_sha256 of every row of the mix."""
    return encode_documents(docs, vocabulary_path()).select(
        F.col("key").alias("doc_id"), "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("near-dedup", near_dedup), ("mixing", mixing), ("BPE", bpe)]

# The likelihood ratio of the first stage and the hashed permutations of the fourth have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
