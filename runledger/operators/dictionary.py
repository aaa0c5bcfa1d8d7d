"""A test dictionary that grows load by load (A3).

Entries (id, test, subtest) live in folders ``load=n`` under a path, each
sorted by (test, subtest) and never written again, so an id stays what it was.
``_LOADS`` names the finished loads with the ids each reserved: [number, first
id, entries].  A load combines its cells to distinct pairs, leaves out those
the dictionary has (an anti join of distinct pairs), and numbers the rest
densely from the next free id, in first-seen order.  A load that dies leaves a
folder that is not named and not read.  One writer per dictionary.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.operators import cells as C
from runledger.operators.numbering import dense_ids
from runledger.sources import materialize as M

_SCHEMA = "id BIGINT, test STRING, subtest STRING"


class TestDictionary:
    __test__ = False  # not a test class

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def loads(self) -> list[dict]:
        """The finished loads: folder, first id, entries."""
        return json.loads(M.read_marker(self.spark, f"{self.path}/_LOADS") or "[]")

    def read(self) -> DataFrame:
        folders = [f"{self.path}/{x['folder']}" for x in self.loads()]
        return self.spark.read.schema(_SCHEMA).parquet(*folders) if folders else self.spark.createDataFrame([], _SCHEMA)

    def extend(self, cells: DataFrame, runs: DataFrame) -> int:
        """Add the pairs of a load's cells that are new; returns how many."""
        loads = self.loads()
        free = loads[-1]["first"] + loads[-1]["entries"] if loads else 0
        order = C.run_dictionary(runs.select("run_id", "created_at")).select(F.col("id").alias("run_idx"), "run_id")
        seen = cells.select("run_id", "test", "subtest", "pos").join(order, "run_id")
        pairs = seen.groupBy("test", "subtest").agg(F.min(C.first_seen_key(F.col("run_idx"), F.col("pos"))).alias("first"))
        known = self.read().select(F.col("test").alias("t"), F.col("subtest").alias("s"))
        fresh = pairs.join(known, (F.col("test") == F.col("t")) & F.col("subtest").eqNullSafe(F.col("s")), "left_anti")
        numbered = dense_ids(fresh, [F.col("first").asc()], "n").select((F.col("n") + free).alias("id"), "test", "subtest")
        folder = f"load={len(loads)}-{uuid.uuid4().hex[:8]}"
        numbered.repartitionByRange("test", "subtest").sortWithinPartitions("test", "subtest").write.mode("errorifexists").parquet(f"{self.path}/{folder}")
        n = self.spark.read.schema(_SCHEMA).parquet(f"{self.path}/{folder}").count()
        M.write_marker(self.spark, f"{self.path}/_LOADS", json.dumps([*loads, {"folder": folder, "first": free, "entries": n}]))
        return n
