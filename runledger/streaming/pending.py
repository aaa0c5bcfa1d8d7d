"""Runs that wait for their revision and their results, as keyed state.

Two streaming queries take the place of passes over everything still pending:

``resolve``   keyed by the first characters of a revision.  State: the commits
              and the waiting runs that share them.  A run leaves, with its full
              hash, once exactly one commit has its revision as a prefix.
``assemble``  keyed by run.  State: the first delivery of each resolved run and
              the first notice of each run, which are joined.  A run leaves once
              both are there, and never twice.  Spark's own state operators do
              this, as there is a notice for every run.  Each micro-batch joins
              only the runs that left with the shards, reading their buckets.

An arrival wakes its own key and no other, so nothing is tried again in vain:
what a batch does depends on what arrived in it, not on how many batches were
before or on how many runs wait.  No folder of pending runs is rewritten and no
past batch is listed.  ``resolve`` hands over through Spark's file sink, whose
log makes it exactly-once; ``assemble`` writes folders named by the batch, with
overwrite, so a replayed batch replaces its own output.  State lives in the
checkpoint folders (RocksDB snapshots and changelogs), which survive executors
and restarts.

A notice (run_id) says that a run's results have arrived; it may come before or
after the run, and more than once.  A run that is delivered again after it left
stays out.  Runs that have a results URL, and revisions below four characters,
are left out as in the batch form.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from runledger.functions import predicates as P
from runledger.operators import reports as RP
from runledger.operators.revisions import MIN_ABBREV

_PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
_HANDLED = "run_id BIGINT, report_url STRING, resolved_hash STRING"


class ResolveRuns(StatefulProcessor):
    """Input rows: (prefix, sha, run): a commit, or a run as JSON with its revision in ``sha``."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.commits = handle.getMapState("commits", "sha STRING", "known BOOLEAN")
        self.waiting = handle.getMapState("waiting", "run STRING", "revision STRING")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        runs, shas = {}, set()
        for r in rows:
            if r.run is None:
                shas.add(r.sha)
            else:
                runs[r.run] = r.sha
        for sha in shas:
            self.commits.updateValue((sha,), (True,))
        if shas:  # a new commit may be the one that runs wait for
            runs |= {run[0]: revision[0] for run, revision in self.waiting.iterator()}
        known = sorted(sha[0] for sha in self.commits.keys())
        for run, revision in runs.items():
            at = bisect_left(known, revision)  # commits with the same start stand together
            hits = [sha for sha in known[at:at + 2] if sha.startswith(revision)]
            if len(hits) == 1:
                self.waiting.removeKey((run,))
                yield Row(run=run, resolved_hash=hits[0])
            else:
                self.waiting.updateValue((run,), (revision,))

    def close(self) -> None:
        pass


@contextmanager
def _rocksdb(spark: SparkSession):
    """Streams started inside keep their state in RocksDB; the session's own provider returns after it."""
    key, provider = _PROVIDER
    before = spark.conf.get(key, None)
    spark.conf.set(key, provider)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


class PendingConsolidation:
    """``runs_dir``, ``revisions_dir`` (sha) and ``notices_dir`` (run_id) are Parquet folders
    that files arrive in; ``shards`` gives the current shard table; ``root`` is a
    shared folder of its own, which a restart names again."""

    def __init__(self, spark: SparkSession, runs_schema: T.StructType, runs_dir: str, revisions_dir: str, notices_dir: str, shards, root: str, shard_buckets: int | None = None):
        self.spark, self.schema, self.shards, self.root, self.shard_buckets = spark, runs_schema, shards, root, shard_buckets
        self.runs_dir, self.revisions_dir, self.notices_dir = runs_dir, revisions_dir, notices_dir
        self.resolved, self.out, self.done = f"{root}/resolved", f"{root}/reports", f"{root}/handled"

    def _source(self, folder: str, schema: str | T.StructType, files: int) -> DataFrame:
        return self.spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)

    def resolving(self, files: int) -> DataFrame:
        runs = self._source(self.runs_dir, self.schema, files).where(P.is_missing_str("raw_results_url"))
        runs = runs.select(F.col("revision").alias("sha"), F.to_json(F.struct(*self.schema.names)).alias("run"))
        commits = self._source(self.revisions_dir, "sha STRING", files).select("sha", F.lit(None).cast("string").alias("run"))
        both = runs.unionByName(commits).where(F.length("sha") >= MIN_ABBREV).select(P.first_chars("sha", MIN_ABBREV).alias("prefix"), "sha", "run")
        return both.groupBy("prefix").transformWithState(ResolveRuns(), "run STRING, resolved_hash STRING", "Append", "None")

    def assembling(self, files: int) -> DataFrame:
        resolved = self._source(self.resolved, "run STRING, resolved_hash STRING", files)
        resolved = resolved.select(F.get_json_object("run", "$.run_id").cast("bigint").alias("run_id"), "run", "resolved_hash")
        notices = self._source(self.notices_dir, "run_id BIGINT", files)
        return resolved.dropDuplicates(["run_id"]).join(notices.dropDuplicates(["run_id"]), "run_id").select("run", "resolved_hash")

    def write_batch(self, ready: DataFrame, batch: int) -> None:
        """The reports of the runs that left in a batch, and their places in the run table."""
        folder = f"batch={batch:020d}"
        schema = T.StructType([*self.schema.fields])
        runs = ready.select(F.from_json("run", schema).alias("r"), "resolved_hash").select("r.*", "resolved_hash")
        write = lambda df: df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        write(runs).parquet(f"{self.root}/ready/{folder}")
        runs = self.spark.read.schema(runs.schema).parquet(f"{self.root}/ready/{folder}")
        write(RP.consolidate_resolved(self.shards(), runs, shard_buckets=self.shard_buckets)).option("compression", "gzip").json(f"{self.out}/{folder}")
        write(RP.report_locations(runs).select("run_id", "report_url", "resolved_hash")).parquet(f"{self.done}/{folder}")

    def run_available(self, files: int = 1000) -> None:
        """Both queries over everything that has arrived, then stop; call it again for what arrives later."""
        once = lambda w, name: w.option("checkpointLocation", f"{self.root}/state/{name}").trigger(availableNow=True)
        with _rocksdb(self.spark):
            once(self.resolving(files).writeStream.format("parquet").option("path", self.resolved), "resolve").start().awaitTermination()
            once(self.assembling(files).writeStream.foreachBatch(self.write_batch), "assemble").start().awaitTermination()

    def start(self, files: int = 1000, processing_time: str = "1 minute") -> tuple:
        """Both queries, running until they are stopped."""
        every = lambda w, name: w.option("checkpointLocation", f"{self.root}/state/{name}").trigger(processingTime=processing_time)
        with _rocksdb(self.spark):
            return (every(self.resolving(files).writeStream.format("parquet").option("path", self.resolved), "resolve").start(),
                    every(self.assembling(files).writeStream.foreachBatch(self.write_batch), "assemble").start())

    def handled(self) -> DataFrame:
        """run_id, report_url and resolved_hash of every run consolidated so far."""
        return self.spark.read.schema(_HANDLED).parquet(self.done).select("run_id", "report_url", "resolved_hash")

    def updated_runs(self, runs: DataFrame) -> DataFrame:
        return RP.mark_consolidated(runs, self.handled())
