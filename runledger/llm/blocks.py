"""A query set against all rows, in blocks: every shard is loaded once and the query blocks stream past it.

``shards`` holds the rows of each shard and ``blocks`` the query rows that the
shard must see, both under the column ``shard``.  One task gets a shard's rows
first and its query rows after them, in Arrow batches, so its memory is one
shard and one batch; the shard's size is what its builder bounds.  The number
of partitions is given, so that shards are not put together at run time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@contextmanager
def batch_rows(spark: SparkSession, rows: int, size: int = 16 << 20):
    """Arrow batches of at most so many rows and bytes for what runs inside; the session's own settings return after it."""
    new = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": str(size)}
    old = {k: spark.conf.get(k, None) for k in new}
    for k, v in new.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def for_each_shard(blocks: DataFrame, shards: DataFrame) -> DataFrame:
    """Every row of ``blocks`` (with a column ``block``, numbered from 0) once per row of ``shards`` (shard, blocks)."""
    wanted = shards.where("blocks > 0").select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    return wanted.join(blocks, "block").drop("block")


def stream_past(shards: DataFrame, blocks: DataFrame, partitions: int, load: Callable[[list[dict]], object],
                ask: Callable[[object, dict], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """What ``ask(loaded shard, query row)`` yields, for every query row of every shard.

    ``load`` gets the rows of one shard (as dicts) and makes what ``ask`` works on.
    A shard without query rows, and a query row of a shard without rows, yield nothing.
    """
    first, then = sorted(set(shards.columns) - {"shard"}), sorted(set(blocks.columns) - {"shard"})
    both = shards.withColumn("is_query", F.lit(False)).unionByName(blocks.withColumn("is_query", F.lit(True)), allowMissingColumns=True)
    dealt = both.repartition(max(1, partitions), "shard").sortWithinPartitions("shard", "is_query")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, loaded = None, [], None
        for b in batches:
            shard, query = b.column("shard").to_pylist(), b.column("is_query").to_pylist()
            columns = {n: b.column(n) for n in {*first, *then}}
            for i in range(b.num_rows):
                if shard[i] != now:
                    now, rows, loaded = shard[i], [], None
                if not query[i]:
                    rows.append({n: columns[n][i].as_py() for n in first})
                    continue
                if rows:
                    loaded, rows = load(rows), []
                if loaded is not None:
                    yield from ask(loaded, {n: columns[n][i].as_py() for n in then})

    return dealt.mapInArrow(run, schema)
