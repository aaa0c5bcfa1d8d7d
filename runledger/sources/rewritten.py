"""Rewritten tables: whole new tables at paths the caller names.

``write_table`` writes a rewritten table to a path that must not exist yet: a
table being read is never overwritten, and of two writers that name the same
path the second is refused, so neither can undo the other.  There is a single
writer per table by contract; versions, concurrent writers and retention belong
to a table format, which this isn't.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from runledger.sources.materialize import source_id


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """K1: write ``df`` to the new folder ``path`` and return a reader over it."""
    df.write.mode("errorifexists").format(fmt).save(path)
    return df.sparkSession.read.format(fmt).load(path)


def write_rewrite(rewritten: DataFrame, path: str, fmt: str = "parquet") -> tuple[DataFrame, dict[str, int]]:
    """K1 + K10: write what ``rules.rewrite`` made, without its flags, and count
    on the way: a reader over the new table, and how many rows there were, how
    many a rule selected and how many changed.  The table is computed once."""
    seen = Observation("rewrite")
    counted = rewritten.observe(seen, F.count(F.lit(1)).alias("n_rows"), F.count_if("selected").alias("n_selected"), F.count_if("changed").alias("n_changed"))
    back = write_table(counted.drop("selected", "changed"), path, fmt)
    return back, {k: int(v) for k, v in seen.get.items()}


class Refreshing:
    """A handle on a table that reads it again when its files have changed."""

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet"):
        self.spark, self.path, self.fmt = spark, path, fmt
        self.seen: str | None = None
        self.df: DataFrame | None = None

    def refresh(self) -> bool:
        now = source_id(self.spark, self.path)
        if now == self.seen:
            return False
        self.seen, self.df = now, self.spark.read.format(self.fmt).load(self.path)
        return True
