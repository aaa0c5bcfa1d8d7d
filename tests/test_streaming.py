"""Streaming consolidation equals batch; replay and feeding order change nothing."""

from pyspark.sql import functions as F

from helpers import SF_SMALL
from helpers import run, runs_df
from runledger.operators import cells as C
from runledger.operators import reports as RP
from runledger.plans import queries as Q
from runledger.session import fresh_dir
from runledger.sources import fixtures as X
from runledger.streaming import consolidate as STREAM


def _consolidation(spark, revisions=None, shards=None):
    return STREAM.Consolidation(spark, X.runs(spark, SF_SMALL).schema, revisions or (lambda: X.revisions(spark, SF_SMALL)),
                                shards or (lambda: Q._shards(spark, SF_SMALL)), fresh_dir(spark, "s_out"), fresh_dir(spark, "s_st"), Q.SHARD_BUCKETS)


def _run(spark, c, ckpt, per_trigger):
    q = c.start(Q._runs_stream_source(spark, SF_SMALL), ckpt, max_files_per_trigger=per_trigger)
    q.awaitTermination()
    return q


def _cells(spark, c):
    return Q.consolidation_cells(spark.read.schema(Q._CONSOLIDATED_READ).json(c.out))


def test_stream_replay_and_feeding(spark):
    one, ck = _consolidation(spark), fresh_dir(spark, "s_ck")
    _run(spark, one, ck, 1)
    first = _cells(spark, one)
    n = first.count()
    assert n > 0
    # Restart on the same checkpoint: nothing new, output unchanged.
    q = _run(spark, one, ck, 1)
    assert q.lastProgress is None or q.lastProgress["numInputRows"] == 0
    assert _cells(spark, one).count() == n
    # All files at once give the same reports.
    two = _consolidation(spark)
    _run(spark, two, fresh_dir(spark, "s_ck"), 100)
    once = _cells(spark, two)
    assert once.exceptAll(first).count() == 0 and first.exceptAll(once).count() == 0
    # A replayed pass replaces its own output.
    two.run_pass(X.runs(spark, SF_SMALL), STREAM.RETRIES)
    assert _cells(spark, two).count() == n


def test_late_revisions_and_shards(spark):
    """Runs wait for their revision and their shards; none is lost and none gets an empty report."""
    runs = runs_df(spark, [run(i, revision=f"{i:x}abcdef012", raw_results_url="") for i in (1, 2, 3)])
    shard = [(0, i, "/a.html", "OK", 0, 0, []) for i in (1, 2, 3)]
    have = {"sha": ["1abcdef012" + "0" * 30], "shards": [1, 2]}
    buckets = F.pmod(F.xxhash64("run_id"), F.lit(Q.SHARD_BUCKETS)).cast("int")
    c = STREAM.Consolidation(
        spark, runs.schema, lambda: spark.createDataFrame([(s,) for s in have["sha"]], "sha string"),
        lambda: spark.createDataFrame([s for s in shard if s[1] in have["shards"]], Q._SHARD_READ).withColumn("run_bucket", buckets),
        fresh_dir(spark, "l_out"), fresh_dir(spark, "l_st"), Q.SHARD_BUCKETS)
    done = lambda: sorted(r.run_id for r in c.handled().collect())
    c.run_pass(runs, STREAM.RETRIES)
    assert done() == [1]
    have["sha"] += [f"{i}abcdef012" + "0" * 30 for i in (2, 3)]
    c.retry_pending()
    assert done() == [1, 2]  # run 3 has no shards yet
    have["shards"].append(3)
    c.retry_pending()
    assert done() == [1, 2, 3]
    c.retry_pending()
    assert done() == [1, 2, 3]
    new = {r.run_id: r for r in c.updated_runs(runs).collect()}
    assert all(new[i].raw_results_url.endswith("report.json") and new[i].full_revision_hash == f"{i}abcdef012" + "0" * 30 for i in (1, 2, 3))


def test_consolidation_is_idempotent_by_url(spark):
    runs = X.runs(spark, SF_SMALL)
    revs = X.revisions(spark, SF_SMALL)
    shards = spark.read.schema(Q._SHARD_READ).json(Q.shards_path(spark, SF_SMALL))
    done = RP.consolidate(shards, runs, revs, shard_buckets=Q.SHARD_BUCKETS)
    assert done.count() > 0
    updated = RP.mark_consolidated(runs, done)
    assert updated.count() == runs.count()
    again = RP.consolidate(shards, updated, revs, shard_buckets=Q.SHARD_BUCKETS)
    assert again.count() == 0
    moved = updated.join(done.select("run_id", "report_url"), "run_id")
    assert moved.where(F.col("raw_results_url") != F.col("report_url")).count() == 0


def test_wide_upsert(spark):
    runs = runs_df(spark, [run(1), run(2)])
    schema = ("run_id bigint, results array<struct<test:string,status:string,"
              "subtests:array<struct<name:string,status:string>>>>")
    load1 = spark.createDataFrame([(1, [("/a.html", "OK", None)])], schema)
    load2 = spark.createDataFrame([(2, [("/a.html", "ERROR", None), ("/b.html", "OK", None)])], schema)
    first = C.merge_wide(C.wide_cells(load1, runs, load_ts=F.lit("2020-01-01").cast("timestamp")))
    both = C.upsert_wide(first, C.wide_cells(load2, runs, load_ts=F.lit("2020-02-01").cast("timestamp")))
    assert {(r.qualifier, r.value) for r in both.collect()} == {("/a.html", "ERROR"), ("/b.html", "OK")}


def test_wide_upsert_touches_only_its_partitions(spark):
    import os
    runs = runs_df(spark, [run(1), run(2, browser_name="firefox"), run(3)])
    schema = ("run_id bigint, results array<struct<test:string,status:string,"
              "subtests:array<struct<name:string,status:string>>>>")
    load1 = spark.createDataFrame([(1, [("/a.html", "OK", None)]), (2, [("/a.html", "OK", None)])], schema)
    path = fresh_dir(spark, "wide_parts")
    C.upsert_wide_partitions(spark, path, C.wide_cells(load1, runs, load_ts=F.lit("2020-01-01").cast("timestamp")))
    local = path[len("file:"):] if path.startswith("file:") else path
    ff_dir = os.path.join(local, "browser=firefox")
    before = {f: os.stat(os.path.join(ff_dir, f)).st_mtime_ns for f in os.listdir(ff_dir)}
    load2 = spark.createDataFrame([(3, [("/a.html", "ERROR", None), ("/b.html", "OK", None)])], schema)
    C.upsert_wide_partitions(spark, path, C.wide_cells(load2, runs, load_ts=F.lit("2020-02-01").cast("timestamp")))
    after = {f: os.stat(os.path.join(ff_dir, f)).st_mtime_ns for f in os.listdir(ff_dir)}
    assert before == after
    got = {(r.browser, r.qualifier, r.value) for r in spark.read.parquet(path).collect()}
    assert got == {("chrome", "/a.html", "ERROR"), ("chrome", "/b.html", "OK"), ("firefox", "/a.html", "OK")}
