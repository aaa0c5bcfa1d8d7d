"""op5: documents that hold benchmark items, as they stand or re-parameterised."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.llm import decontam
from runledger.llm.common import table


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, n_windows, first_token, last_token, reparameterised of every find."""
    found = decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", "n_windows", "first_token", "last_token", "reparameterised")


QUERIES = {"op5_decontamination": op5_decontamination}
