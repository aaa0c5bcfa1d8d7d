"""The corpus pipeline: documents in, token ids of clean documents out.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it
kept, and returns a DataFrame; ``run`` writes it as Parquet in the shared
folder and reads it back.  All but the last return the columns of documents.

quality          rejected documents go (score below 0.3)
near_duplicates  of each SimHash component the smallest doc_id stays
decontamination  documents that hold a benchmark item go
secret_scan      secrets in the texts are masked
sentencepiece    doc_id, n_tokens, digests and ids of every text left

SQL can't express the first stage (a fitted network) or the fingerprints, so
there is no ORACLE_SQL; the tests hold the stages against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.llm import decontam, pieces, quality, query_quality, query_simhash, secret_scan, simhash
from runledger.llm.common import free_name, stored, table

ORACLE_SQL = None


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    name = free_name(docs.columns, "score")
    scored = quality.score(docs, query_quality.model(spark, docs, sf_dir))
    return scored.where(F.col(name) >= query_quality.THRESHOLD).drop(name)


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, query_simhash.SHINGLE, query_simhash.DISTANCE)


def stage_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.without_items(docs, table(spark, sf_dir, "benchmark"))


def stage_secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.without_secrets(docs)


def stage_sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"), arrays=("ids",))


STAGES = [
    ("quality", stage_quality),
    ("near_duplicates", stage_near_duplicates),
    ("decontamination", stage_decontamination),
    ("secret_scan", stage_secret_scan),
    ("sentencepiece", stage_sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
