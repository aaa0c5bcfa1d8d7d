"""Plan checks: operators stay distributed and push work down."""

from pyspark.sql import functions as F

from helpers import SF_SMALL
from runledger.operators import dedup as D
from runledger.operators import revisions as REV
from runledger.operators import rules as R
from runledger.plans import queries as Q
from runledger.sources import fixtures as X


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return df._jdf.queryExecution().executedPlan().toString()


def test_rewrite_has_no_exchange(spark):
    runs = X.runs(spark, SF_SMALL)
    new, _ = R.rewrite(runs, [R.experimental_rule(), R.stable_rule(), R.channel_rule(),
                              R.browser_name_rule(), R.time_start_rule()])
    p = plan(new)
    assert "Exchange" not in p
    assert "WholeStageCodegen" in p or "*(" in p


def test_mainline_flag_broadcasts(spark):
    runs = X.runs(spark, SF_SMALL)
    p = plan(REV.flag_mainline(runs, Q._mainline_keys(spark, SF_SMALL)))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_prefix_scan_pushes_filters(spark):
    df = Q.load_wide(spark, SF_SMALL).where(
        F.col("row_key").startswith("chrome-") & (F.col("qualifier") >= "/a") & (F.col("value") < "PAST"))
    p = plan(df)
    assert "PushedFilters" in p and "StringStartsWith(row_key,chrome-)" in p
    assert "GreaterThanOrEqual(qualifier,/a)" in p


def test_run_filter_pushes_contains(spark):
    df = Q.filter_runs(spark, SF_SMALL)
    p = plan(df)
    assert "StringContains(browser_name,chrome)" in p


def test_column_pruning(spark):
    p = plan(Q.scan_run_keys(spark, SF_SMALL))
    assert "ReadSchema: struct<run_id:bigint>" in p


def test_dedup_joins_on_composite_key(spark):
    runs = X.runs(spark, SF_SMALL)
    kept, _ = D.dedup(runs)
    p = plan(kept)
    # The semi join keys include run_id, never the URL alone, and there is no
    # window over the URL.
    assert "Window" not in p
    assert "raw_results_url#" in p and "run_id#" in p


def test_dense_ids_avoid_global_row_number(spark):
    p = plan(Q.run_dictionary(spark, SF_SMALL))
    assert "row_number" not in p.lower()


def test_shard_lookup_prunes_buckets(spark):
    from runledger.operators import reports as RP
    shards = spark.read.schema(Q._SHARD_READ).json(Q.shards_path(spark, SF_SMALL))
    runs = X.runs(spark, SF_SMALL).where(F.col("raw_results_url") == "")
    p = plan(RP.shards_for(shards, runs, buckets=Q.SHARD_BUCKETS))
    assert "dynamicpruning" in p.lower()


def test_url_predicates_push_down(spark):
    from runledger.operators import reports as RP
    runs = X.runs(spark, SF_SMALL)
    p = plan(D.dedup(runs)[0])
    assert "PushedFilters: [IsNotNull(raw_results_url), Not(EqualTo(raw_results_url,))" in p
    p = plan(RP.with_migration_log(runs, X.objects(spark, SF_SMALL)))
    assert "StringStartsWith(raw_results_url,https://storage.example/results/)" in p
    assert "StringEndsWith(raw_results_url,report.json)" in p


def test_no_single_task_before_joins(spark):
    """Joins carry no probe: no job while a plan is built, no single-partition exchange."""
    from runledger.operators import cells as C
    from runledger.operators import revisions as REV
    runs, revs = X.runs(spark, SF_SMALL), X.revisions(spark, SF_SMALL)
    ri = runs.select("run_id", F.col("run_id").alias("id"))
    tests = X.cells(spark, SF_SMALL).select("test", "subtest").distinct().withColumn("id", F.xxhash64("test"))
    for df in (REV.resolve(runs, revs), REV.flag_mainline(runs, REV.revision_keys(revs, "sha")),
               C.encode_cells(X.cells(spark, SF_SMALL), tests, ri)):
        assert "SinglePartition" not in plan(df)


def test_pivot_shuffles_once(spark):
    from runledger.operators import cells as C
    cells = spark.range(100).select(F.col("id").alias("run_idx"), (F.col("id") % 7).alias("test_id"), F.lit("OK").alias("status"),
                                    F.lit("OK").alias("sub_status"))
    p = C.pivot(cells, "run_idx", "test_id").sortWithinPartitions("run_idx", "chunk")
    assert plan(p).count("Exchange") == 1


def test_hot_url_dedup(spark):
    """One URL holds a third of all runs: same answer, no URL-keyed window."""
    runs = X.runs(spark, SF_SMALL)
    hot = runs.withColumn("raw_results_url", F.when(F.col("run_id") % 3 == 0, F.lit("hot"))
                          .otherwise(F.col("raw_results_url")))
    kept, deleted = D.dedup(hot)
    n_hot = hot.where(F.col("raw_results_url") == "hot").count()
    assert deleted.where(F.col("raw_results_url") == "hot").count() == n_hot - 1
    assert kept.count() + deleted.count() == hot.count()
    assert "Window" not in plan(kept)


def test_hot_test_pivot_chunks(spark):
    """A test present in every run is split into bounded map chunks."""
    from runledger.operators import cells as C
    cells = spark.range(0, 2500).select(F.col("id").alias("run_idx"), F.lit(7).cast("bigint").alias("test_id"),
                                        F.lit("OK").alias("status"), F.lit(None).cast("string").alias("sub_status"))
    p = C.pivot(cells, "test_id", "run_idx", chunk_size=1000)
    sizes = sorted(r.n for r in p.select(F.size("entries").alias("n")).collect())
    assert sizes == [500, 1000, 1000]
    back = C.unpivot(p, "test_id", "run_idx")
    assert back.count() == 2500 and back.select("run_idx").distinct().count() == 2500


def test_first_seen_key_holds_large_ids(spark):
    """Run ids from 2^31 and positions from 2^32 keep their order, in a hash aggregate."""
    from runledger.operators import cells as C
    rows = [(1, 5), (2 ** 31, 1), (2 ** 40, 2 ** 35), (2 ** 40, 2 ** 35 + 1), (2 ** 62, 0)]
    df = spark.createDataFrame(rows, "r bigint, p bigint").select("r", "p", C.first_seen_key(F.col("r"), F.col("p")).alias("k"))
    assert [(x.r, x.p) for x in df.orderBy("k").collect()] == rows
    assert "SortAggregate" not in plan(df.groupBy("r").agg(F.min("k")))
