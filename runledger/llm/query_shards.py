"""op1: all documents along a Hilbert curve over source, lang, size and doc_id, cut into 8 shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.llm import hilbert
from runledger.llm.common import table

DIMS, BITS, SHARDS = ("source", "lang", "size", "doc_id"), 4, 8


def op1_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, curve_index."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.encode("text", "UTF-8")), F.lit(0)).alias("text_crc32"))
    order = [F.col("doc_id").asc_nulls_first(), "text_crc32", "size"]
    out = hilbert.hilbert_shards(docs, DIMS, order, SHARDS, BITS)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve_index")


QUERIES = {"op1_hilbert_shards": op1_hilbert_shards}
