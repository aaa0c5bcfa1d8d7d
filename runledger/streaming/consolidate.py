"""Incremental consolidation of newly arriving runs.

The endless "re-read all runs and revisions, skip the handled ones, handle,
sleep" loop becomes a Structured Streaming query over the folder new run
records land in, and passes over what is still to do:

* file source with an explicit schema; ``maxFilesPerTrigger`` bounds a
  micro-batch; ``trigger(availableNow=True)`` processes everything present and
  stops (schedule it periodically), a processing-time trigger keeps it running;
* every micro-batch is a pass.  A pass takes the batch's runs and the runs that
  the pass before left pending, reads revisions and shards anew, writes the
  reports of the runs that resolve and have shards, and leaves the others
  pending;
* ``retry_pending`` is a pass without new runs, for revisions and shards that
  arrive after the last run;
* ``updated_runs`` is the run-table update: report locations and full hashes of
  all runs consolidated so far.

Replay safety: ``foreachBatch`` is at-least-once.  A pass writes folders named
by its number, with overwrite, and reads only folders of earlier passes, so a
replayed pass replaces its own output.  The caller names the output, state and
checkpoint folders, so a restarted application resumes.  One writer per state
folder.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from runledger.operators import reports as RP
from runledger.sources.materialize import _fs

#: Pass numbers between two micro-batches that ``retry_pending`` may use.
RETRIES = 1 << 20
_HANDLED = "run_id BIGINT, report_url STRING, resolved_hash STRING"


def _passes(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the complete passes of a state folder, ascending."""
    p, fs = _fs(spark, folder)
    if not fs.exists(p):
        return []
    names = [(st.getPath(), st.getPath().getName()) for st in fs.listStatus(p)]
    done = [n for path, n in names if n.startswith("pass=") and fs.exists(_fs(spark, f"{path}/_SUCCESS")[0])]
    return sorted(int(n[5:]) for n in done)


def _folder(root: str, number: int) -> str:
    return f"{root}/pass={number:020d}"


class Consolidation:
    """Where a consolidation reads and writes: ``revisions`` and ``shards`` are
    called anew in every pass; ``out`` and ``state`` are folders of its own."""

    def __init__(self, spark: SparkSession, runs_schema: StructType, revisions: Callable[[], DataFrame],
                 shards: Callable[[], DataFrame], out: str, state: str, shard_buckets: int | None = None):
        self.spark, self.schema = spark, runs_schema
        self.revisions, self.shards = revisions, shards
        self.out, self.state, self.shard_buckets = out, state, shard_buckets

    def _write(self, df: DataFrame, folder: str) -> None:
        # static overwrite: a replayed pass replaces its own folder and nothing else
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "snappy").parquet(folder)

    def run_pass(self, arrived: DataFrame | None, number: int) -> None:
        before = [n for n in _passes(self.spark, f"{self.state}/pending") if n < number]
        todo = arrived
        if before:
            pending = self.spark.read.schema(self.schema).parquet(_folder(f"{self.state}/pending", before[-1]))
            todo = pending if arrived is None else pending.unionByName(arrived)
        if todo is None:
            return
        self._write(todo, _folder(f"{self.state}/todo", number))
        todo = self.spark.read.schema(self.schema).parquet(_folder(f"{self.state}/todo", number))
        reports = RP.consolidate(self.shards(), todo, self.revisions(), shard_buckets=self.shard_buckets)
        (reports.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "gzip")
         .json(_folder(self.out, number)))
        done = self.spark.read.schema(_HANDLED).json(_folder(self.out, number)).select("run_id")
        unhandled = todo.where(RP.P.is_missing_str("raw_results_url")).join(done, "run_id", "left_anti")
        self._write(unhandled.select(*self.schema.names), _folder(f"{self.state}/pending", number))

    def retry_pending(self) -> None:
        """A pass over the pending runs alone."""
        before = _passes(self.spark, f"{self.state}/pending")
        if before:
            self.run_pass(None, before[-1] + 1)

    def handled(self) -> DataFrame:
        """run_id, report_url and resolved_hash of every run consolidated so far."""
        return self.spark.read.schema(_HANDLED).json(self.out).select("run_id", "report_url", "resolved_hash").distinct()

    def updated_runs(self, runs: DataFrame) -> DataFrame:
        return RP.mark_consolidated(runs, self.handled())

    def start(self, runs_dir: str, checkpoint: str, max_files_per_trigger: int = 1, available_now: bool = True,
              processing_time: str | None = None):
        """Start the stream over ``runs_dir``; returns the ``StreamingQuery``."""
        src = (self.spark.readStream.schema(self.schema)
               .option("maxFilesPerTrigger", max_files_per_trigger)
               .parquet(runs_dir))
        w = src.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
            lambda batch, batch_id: self.run_pass(batch, (batch_id + 1) * RETRIES))
        if processing_time:
            w = w.trigger(processingTime=processing_time)
        elif available_now:
            w = w.trigger(availableNow=True)
        return w.start()
