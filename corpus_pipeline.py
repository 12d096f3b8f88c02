"""From raw documents to token ids: quality rules, near-duplicates, benchmark passages, secrets, tokens.

``run`` applies the stages to ``documents``; each stage's rows are written to the shared folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobstrata.llm import bpe_duckdb, decontaminate, quality_rules, secret_forest, simhash_bk
from jobstrata.session import materialise, prepare


def reject_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the decision list learned from the labelled ones."""
    return quality_rules.filter_documents(docs, prepare(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group linked by fingerprints of 3-word shingles within 3 bits."""
    prepare(spark)
    return simhash_bk.one_of_each(docs, radius=simhash_bk.RADIUS)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, prepare(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced and the lengths counted anew."""
    prepare(spark)
    _, forest, words = secret_forest.train(docs)
    return secret_forest.redact(docs, forest, words).withColumn("n_chars", F.length("text").cast("long"))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, token ids (little-endian, 32 bits each) and the digests of the ids and of the decoded bytes."""
    prepare(spark)
    return bpe_duckdb.round_trip(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                 public_tokenizers.PATTERN, keep_ids=True)


STAGES = [("quality rules", reject_by_rules), ("SimHash near-dedup", drop_near_duplicates),
          ("benchmark decontamination", drop_benchmark_passages), ("secret scans", redact_secrets),
          ("byte-level BPE", encode_texts)]

ORACLE_SQL = None  # learned rules, a forest and merges to a fixpoint are beyond SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, name.replace(" ", "_"))
    return docs
