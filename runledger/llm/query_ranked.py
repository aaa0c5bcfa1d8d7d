"""op11: the 10 best documents of every benchmark item."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from runledger.llm import best_positions
from runledger.llm.common import table

K = 10


def op11_best_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_id, rank, doc_id, score."""
    index = best_positions.build_index(table(spark, sf_dir, "documents"))
    return best_positions.search(index, table(spark, sf_dir, "benchmark"), K)


QUERIES = {"op11_best_positions": op11_best_positions}

_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

ORACLE = {"op11_best_positions": f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
size AS (SELECT CAST(count(*) FILTER (len(terms) > 0) AS BIGINT) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM docs),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM docs) GROUP BY r, term),
weight AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(n_docs) + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w FROM tf, size GROUP BY term),
item AS (SELECT row_number() OVER () AS i, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)),
asked AS (SELECT i, item_id, unnest({_TERMS}) AS term FROM item),
scored AS (
  SELECT i, item_id, docs.r, docs.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(docs.terms) * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN docs ON docs.r = tf.r, size GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= {K}
"""}
