"""Bucket edges of strings from the counts of all values."""

from pyspark.sql import functions as F

from runledger.llm import hilbert


def test_string_edges_come_from_all_rows(spark):
    """as many rows in every bucket as the values allow, also where a sample was asked for."""
    rows = spark.range(4096).select("id", F.format_string("v%05d", (F.col("id") * 1103) % 4096).alias("a"))
    for bucket in (hilbert.quantised(rows, ["a"], 4)[0], hilbert.quantised(rows, ["a"], 4, sample=64)[0]):
        depth = sorted(r["count"] for r in rows.groupBy(bucket.alias("b")).count().collect())
        assert depth == [256] * 16
    hot = rows.select(F.when(F.col("id") % 2 == 0, F.lit("v02")).when(F.col("id") % 101 == 0, None).otherwise(F.col("a")).alias("a"))
    values = sorted(r.a for r in hot.collect() if r.a is not None)
    assert hilbert._string_edges(hot, "a", 16) == [values[-(-k * len(values) // 16) - 1] for k in range(1, 16)]
    assert hilbert._string_edges(hot.where("false"), "a", 16) == []
