"""op8: personal data in all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.llm import pii
from runledger.llm.common import table
from runledger.llm.spans import count_of, joined


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), *[count_of(F.col("base"), k).alias(f"n_{k}") for k in pii.BASE],
                        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("all")).alias("spans"))


QUERIES = {"op8_pii": op8_pii}
