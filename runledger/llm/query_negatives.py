"""op12: hard negatives of every vector whose id is divisible by 100."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.llm import residues
from runledger.llm.common import table


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    rows = table(spark, sf_dir, "embeddings").where(residues.usable(F.col("label"), F.col("embedding")))
    label = F.when(F.coalesce(F.col("vec_id") % 7 == 0, F.lit(False)), (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select(F.col("vec_id").alias("id"), label.alias("label"), residues.integers(F.col("embedding")).alias("vector"))
    return residues.hard_negatives(rows, F.coalesce(F.col("id") % 100 == 0, F.lit(False)))


QUERIES = {"op12_hard_negatives": op12_hard_negatives}

ORACLE = {"op12_hard_negatives": """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""}
