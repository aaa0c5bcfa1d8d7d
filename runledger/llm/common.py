"""Helpers shared by the operators: stored tables, batch sizes, free names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.session import fresh_dir

#: Rows and bytes of text that one Arrow batch holds: a worker's memory is a few batches.
BATCH_ROWS = 256
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the Python operators (long texts, small workers)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with a table every executor can see, so a lost executor
    costs the tasks it ran and nothing that was written before.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(columns: Iterable[str], base: str) -> str:
    """``base``, with underscores in front until no column has that name."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def text_of(column: str = "text"):
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
