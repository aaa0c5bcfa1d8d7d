"""op3: main text of all pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.llm import templates
from runledger.llm.common import table


def op3_template_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars."""
    found = templates.main_text(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES = {"op3_template_text": op3_template_text}
