"""op2: the 5 nearest of every vector whose id is divisible by 50."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.llm import ann
from runledger.llm.common import stored, table

K = 5


def op2_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.where(ann.usable(F.col("vector")))
    index = ann.build_index(rows, K)
    queries = stored(rows.where(F.col("id") % 50 == 0), "queries")
    return ann.search(queries, index, K)


QUERIES = {"op2_hnsw": op2_hnsw}
