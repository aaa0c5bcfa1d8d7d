"""op9: secrets in all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.llm import secret_scan
from runledger.llm.common import table
from runledger.llm.spans import count_of, joined


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kinds = [r.kind for r in secret_scan.BASE]
    found = secret_scan.find_secrets(docs)
    base = F.filter("secrets", lambda s: s["kind"].isin(kinds))
    return found.select("doc_id", *[count_of(F.col("secrets"), k).alias(f"n_{k}") for k in kinds],
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))


QUERIES = {"op9_secrets": op9_secrets}
