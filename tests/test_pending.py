"""X1 as keyed state: late arrivals in any order, repeated deliveries, replay and restart, work per batch."""

import os

import pytest
from pyspark.sql import functions as F

from helpers import run, runs_df
from runledger.plans import queries as Q
from runledger.session import fresh_dir
from runledger.sources import named_files as NF
from runledger.streaming import pending as PENDING

FULL = {i: f"{i:x}abcdef012" + "0" * 30 for i in range(1, 10)}


class World:
    """Folders that files arrive in, and a consolidation over them."""

    def __init__(self, spark):
        self.spark, self.root = spark, fresh_dir(spark, "world")
        self.shards = []
        self.runs(run(100, raw_results_url="https://done.example/report.json"))
        self.commits("f" * 40)
        self.notices(100)
        self.again()

    def again(self):
        """A new driver over the same folders."""
        schema = runs_df(self.spark, []).schema
        self.c = PENDING.PendingConsolidation(self.spark, schema, f"{self.root}/runs", f"{self.root}/revisions", f"{self.root}/notices", self._shards, f"{self.root}/own", Q.SHARD_BUCKETS)

    def _shards(self):
        bucket = F.pmod(F.xxhash64("run_id"), F.lit(Q.SHARD_BUCKETS)).cast("int")
        return self.spark.createDataFrame([(0, i, "/a.html", "OK", 0, 0, []) for i in self.shards], Q._SHARD_READ).withColumn("run_bucket", bucket)

    def runs(self, *rows):
        runs_df(self.spark, list(rows)).coalesce(1).write.mode("append").parquet(f"{self.root}/runs")

    def commits(self, *shas):
        self.spark.createDataFrame([(s,) for s in shas], "sha string").coalesce(1).write.mode("append").parquet(f"{self.root}/revisions")

    def notices(self, *ids):
        self.shards += ids
        self.spark.createDataFrame([(i,) for i in ids], "run_id bigint").coalesce(1).write.mode("append").parquet(f"{self.root}/notices")

    def done(self):
        return sorted(r.run_id for r in self.c.handled().collect())

    def reports(self):
        return sorted(r.run_id for r in self.spark.read.schema("run_id bigint").json(self.c.out).collect())


@pytest.fixture
def few(spark):
    """Few state partitions: the tests look at keys, not at partitions."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_late_arrivals_replay_and_restart(spark, few):
    w = World(spark)
    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    w.runs(*[run(i, revision=FULL[i][:10], raw_results_url="") for i in (1, 2, 3, 4)], run(5, revision="1ab", raw_results_url=""), run(6, revision=FULL[6], raw_results_url=""))
    w.commits(FULL[1], FULL[2])
    w.notices(1, 3)
    w.c.run_available()
    assert w.done() == w.reports() == [1]  # 2 waits for results, 3 and 4 for commits, 5 can't be resolved
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == provider

    w.again()  # a restart goes on with what waits
    w.commits(FULL[3], FULL[4], FULL[4][:10] + "1" * 30, FULL[6])  # run 4's revision is ambiguous from the start
    w.notices(2, 2)
    w.runs(run(1, revision=FULL[1][:10], raw_results_url=""))  # delivered again after it left
    w.notices(1)
    w.c.run_available()
    assert w.done() == w.reports() == [1, 2, 3]

    # work per batch: nothing new, no batch folder; one arrival, one run
    batches = lambda: sorted(os.listdir(NF.file_system(w.c.done)[1]))
    before = batches()
    w.c.run_available()
    assert w.done() == [1, 2, 3] and w.reports() == [1, 2, 3]
    w.notices(6)
    w.c.run_available()
    assert w.done() == w.reports() == [1, 2, 3, 6]
    last = (set(batches()) - set(before)).pop()
    ready = lambda b: spark.read.parquet(f"{w.root}/own/ready/{b}")
    assert sorted(r.run_id for b in set(batches()) - set(before) for r in ready(b).collect()) == [6] and last

    # a replayed batch replaces its own output
    for b in batches():
        rows = ready(b)
        left = rows.select(F.to_json(F.struct(*w.c.schema.names)).alias("run"), "resolved_hash").collect()
        w.c.write_batch(spark.createDataFrame(left, "run string, resolved_hash string"), int(b.split("=")[1]))
    assert w.done() == w.reports() == [1, 2, 3, 6]
    new = {r.run_id: r for r in w.c.updated_runs(runs_df(spark, [run(i, revision=FULL[i][:10], raw_results_url="") for i in (1, 2, 3, 4)])).collect()}
    assert all(new[i].full_revision_hash == FULL[i] and FULL[i] in new[i].raw_results_url for i in (1, 2, 3)) and new[4].raw_results_url == ""


def test_run_keeps_every_column(spark, few):
    """Labels, times and nulls of a run pass through the state."""
    w = World(spark)
    w.runs(run(1, revision=FULL[1][:10], raw_results_url="", labels=["a", "é"], time_end=None, browser_name="chrome-experimental"))
    w.commits(FULL[1])
    w.notices(1)
    w.c.run_available()
    own = spark.read.parquet(f"{w.root}/own/ready")
    (got,) = own.select(*w.c.schema.names).collect()
    (want,) = runs_df(spark, [run(1, revision=FULL[1][:10], raw_results_url="", labels=["a", "é"], time_end=None, browser_name="chrome-experimental")]).collect()
    assert got == want
