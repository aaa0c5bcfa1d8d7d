"""op7: quality of all documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.llm import quality
from runledger.llm.common import table

THRESHOLD = 0.3


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, mod 5."""
    return F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 5


def model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Model:
    """Vectors of ``docs``, network from the labels outside fold 0."""
    return quality.fit(docs, table(spark, sf_dir, "labels"), fold() != 0)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, model(spark, docs, sf_dir), ["doc_id"])
    return scored.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op7_quality": op7_quality}
