"""op10: fingerprints and near-duplicate components of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.llm import simhash
from runledger.llm.common import table

SHINGLE, DISTANCE = 4, 4


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), SHINGLE, DISTANCE)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op10_simhash": op10_simhash}
