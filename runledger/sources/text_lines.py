"""Plain text line sources and gzip sinks (S8 input, K5).

``read_lines`` gives one row per line (column ``value``) and splits large
files across tasks; ``gzip_lines`` copies text line by line into gzip files
(one ``\\n`` per line).  Gzip is not splittable on read, so writers emit
many part files rather than one large one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def write_lines(df: DataFrame, path: str, compression: str | None = None) -> str:
    w = df.write.mode("errorifexists")
    if compression:
        w = w.option("compression", compression)
    w.text(path)
    return path


def gzip_lines(spark: SparkSession, src: str, dst: str) -> DataFrame:
    """K5: copy every line of ``src`` into gzip text at ``dst``; returns a
    reader over the copy."""
    write_lines(read_lines(spark, src), dst, "gzip")
    return read_lines(spark, dst)
