"""What a job shuffles and writes: shuffles by plan, packed derived tables, partitions by the size of the source."""

import os
import re
import time

from pyspark.sql import functions as F

from helpers import CELLS_SCHEMA, SF_SMALL, run, runs_df
from runledger.operators import cells as C
from runledger.operators import reports as RP
from runledger.operators import wide_table as W
from runledger.plans import queries as Q
from runledger.session import _FREE_SHUFFLES, fresh_dir
from runledger.sources import fixtures as X
from runledger.sources import listing as LS
from runledger.sources import located as LOC
from runledger.sources import materialize as M
from runledger.sources import named_files as NF
from runledger.sources import reports_io as RIO

CELLS = [(1, "/a", None, "OK", None, 1), (1, "/a", "s3", "ERROR", "FAIL", 2), (1, "/b", None, "OK", None, 3), (2, "/a", "s1", "OK", "PASS", 1),
         (None, "/a", None, "OK", None, 1), (2, None, None, "OK", None, 2)]


def shuffles(df, kind=""):
    """Exchanges of the plan before adaptive execution, by how they deal rows out."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(rf"Exchange {kind}(?:hashpartitioning|rangepartitioning)" if not kind else rf"Exchange {kind}", plan))


def stored(spark, df):
    path = fresh_dir(spark, "stored")
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_reports_take_one_shuffle_of_the_cells(spark):
    """Cuts, windows and documents stand on one shuffle by run."""
    cells = stored(spark, spark.createDataFrame(CELLS, CELLS_SCHEMA))
    results = RP.results_from_cells(cells)
    assert shuffles(results) == 1
    got = sorted((r.run_id, r.test, r.status, r.first_pos, [tuple(s) for s in r.subtests], r.sub_base) for r in results.collect())
    assert got == [(1, "/a", "ERROR", 1, [("s3", "FAIL")], 0), (1, "/b", "OK", 3, [], 0), (2, "/a", "OK", 1, [("s1", "PASS")], 0)]
    cut = sorted((r.run_id, r.test, r.status, r.first_pos, len(r.subtests), r.sub_base) for r in RP.results_from_cells(cells, part_size=1).collect())
    assert cut == [(1, "/a", "ERROR", 1, 1, 0), (1, "/b", "OK", 3, 0, 0), (2, "/a", "OK", 1, 1, 0)]


def test_derived_json_is_packed(spark):
    for path in (Q.reports_path(spark, SF_SMALL), Q.shards_path(spark, SF_SMALL)):
        names = [n for _, _, names in os.walk(NF.file_system(path)[1]) for n in names if n.startswith("part-")]
        assert names and all(n.endswith(".json.gz") for n in names)


def test_wide_merge_stands_in_the_ranges_it_is_stored_in(spark):
    """One shuffle by ranges, and none by hash after it."""
    cells = stored(spark, C.wide_cells(Q.load_reports(spark, SF_SMALL), X.runs(spark, SF_SMALL), load_ts=F.lit("2020-01-01").cast("timestamp")))
    merged = C.merge_wide(C.in_key_order(cells))
    assert shuffles(merged, "hashpartitioning") == 0 and shuffles(merged, "rangepartitioning") == 1
    assert merged.exceptAll(C.merge_wide(cells)).count() == 0 and merged.count() == C.merge_wide(cells).count()


def test_first_wide_load_writes_its_cells_once(spark, monkeypatch):
    """nothing is checkpointed where nothing is replaced; the partitions touched are matched as a few names."""
    runs, reports = X.runs(spark, SF_SMALL), Q.load_reports(spark, SF_SMALL)
    seen, real = [], type(runs).checkpoint
    monkeypatch.setattr(type(runs), "checkpoint", lambda self, *a, **k: seen.append(1) or real(self, *a, **k))
    path = fresh_dir(spark, "wide")
    cells = C.wide_cells(reports, runs, load_ts=F.lit("2020-01-01").cast("timestamp"))
    C.upsert_wide_partitions(spark, path, cells)
    assert not seen
    C.upsert_wide_partitions(spark, path, cells.withColumn("value", F.lit("new")).withColumn("ts", F.lit("2020-02-01").cast("timestamp")))
    assert len(seen) == 1 and spark.read.parquet(path).where("value <> 'new'").count() == 0


def test_first_ranges_of_a_small_table_are_exact(spark):
    """bounds don't depend on which rows a sample happens to hold."""
    keys = spark.range(8000).select(F.format_string("k%04d", F.expr("id div 20")).alias("row_key"), F.lit("tests").alias("family"), F.format_string("/q%03d", F.expr("id % 20")).alias("qualifier"), F.lit("v").alias("value"),
                                    F.lit("2020-01-01").cast("timestamp").alias("ts"), F.lit(None).cast("timestamp_ntz").alias("created_at"), F.lit(1).cast("bigint").alias("run_id"), F.lit(0).cast("bigint").alias("part"),
                                    F.lit(0).cast("bigint").alias("result_pos"), F.lit(0).alias("sub_pos"))
    t = W.WideTable(spark, fresh_dir(spark, "wt"), ranges=16)
    t.load(keys)
    assert t.bounds() == [f"k{i:04d}" for i in range(0, 400, 25)]


def test_matrix_loader_looks_up_runs_once(spark):
    """the stored cells carry their run's id, so no cell is shuffled by run."""
    _, cells = C.load_matrix(Q.load_reports(spark, SF_SMALL), Q.stored_run_index(spark, SF_SMALL), Q.KNOWN_STATUSES)
    assert "run_id#" not in cells._jdf.queryExecution().executedPlan().toString()
    assert cells.count() > 0


def test_encoded_cells_are_combined_where_they_are(spark):
    """last write by run without a further shuffle."""
    enc = Q._encoded(spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert shuffles(C.last_write_encoded(enc)) == shuffles(enc)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = C.last_write(enc, ("run_idx", "test_id"))
    assert C.last_write_encoded(enc).exceptAll(want).count() == 0 and want.count() == C.last_write_encoded(enc).count()


def test_sizes_not_results_meet_the_runs(spark):
    """the join carries the number of a report's results."""
    plan = Q.runs_without_cells(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("size(results")


def test_shuffles_start_in_proportion_to_the_source(spark, tmp_path):
    """A task's share of the rows is bounded, whatever the session's number of partitions."""
    keep = {k: spark.conf.get(k, None) for k in (M._FIRST_PARTITIONS, M._TASK_BYTES)}
    try:
        (tmp_path / "t.parquet").write_bytes(b"\0" * (40 * M.SHUFFLE_BYTES))
        assert M.deal_by_size(spark, str(tmp_path)) == 40 and spark.conf.get(M._FIRST_PARTITIONS) == "40"
        assert M.deal_by_size(spark, str(tmp_path / "none")) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        for k, v in keep.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_cells_are_dealt_by_run_before_their_texts(spark):
    """The shuffle of cells by run carries the lineitems' own columns, and a window and a join with a small table need no other."""
    cells = X.build_cells(spark, SF_SMALL)
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert shuffles(cells) == 1 and "BroadcastHashJoin" in plan
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "p_name" not in below.split("BroadcastExchange")[0]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    want = cells.collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = X.build_cells(spark, SF_SMALL)
        assert shuffles(joined) == 3 and sorted(map(str, joined.collect())) == sorted(map(str, want))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_folders_of_files_count_for_the_size_of_a_source(spark, tmp_path):
    """A table may be a folder."""
    keep = {k: spark.conf.get(k, None) for k in (M._FIRST_PARTITIONS, M._TASK_BYTES)}
    try:
        (tmp_path / "t.parquet").mkdir()
        (tmp_path / "t.parquet" / "part-0.parquet").write_bytes(b"\0" * (30 * M.SHUFFLE_BYTES))
        assert M.deal_by_size(spark, str(tmp_path)) == 30
    finally:
        for k, v in keep.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


REPORTS_SCHEMA = "run_id bigint, part bigint, results array<struct<test:string,status:string,subtests:array<struct<name:string,status:string>>>>"


def test_matrix_rows_are_shuffled_once_as_documents(spark):
    """the last write needs no shuffle, and a small dictionary reaches the rows by broadcast; no run's size decides."""
    reports = spark.createDataFrame([(1, 0, [("/a", "OK", [("s", "PASS"), ("s", "FAIL")]), ("/b", "ERROR", [])]), (1, 1, [("/a", "CRASH", [("t", "PASS")])]), (2, 0, [("/c", "OK", None), ("/a", "OK", [])]), (None, 0, [("/d", "OK", [])]),
                                     (2, 1, [(None, "OK", [])])], REPORTS_SCHEMA)
    index = spark.createDataFrame([(0, 2), (1, 1)], "id bigint, run_id bigint")
    tests, cells = C.load_matrix(stored(spark, reports), index)
    assert shuffles(cells) == 0
    ids = {(r.test, r.subtest): r.id for r in tests.collect()}
    assert ids == {("/c", None): 0, ("/a", None): 1, ("/a", "s"): 2, ("/b", None): 3, ("/a", "t"): 4}
    assert sorted(tuple(r) for r in cells.collect()) == [(0, 0, "OK", None), (0, 1, "OK", None), (1, 1, "CRASH", None), (1, 2, "OK", "FAIL"), (1, 3, "ERROR", None), (1, 4, "CRASH", "PASS")]


def test_replaced_run_info_is_not_shuffled(spark):
    """of a field that is replaced, the join carries nothing; other fields and missing run_infos stay."""
    info = "struct<extra:string,browser_name:string,revision:string>"
    reports = stored(spark, spark.createDataFrame([(1, ("x", "old", "old")), (2, None), (3, ("y", None, None))], f"run_id bigint, run_info {info}"))
    runs = runs_df(spark, [run(1, browser_name="chrome-experimental"), run(2), run(3, os_name="mac")])
    out = RP.stamp_run_info(reports, runs)
    below = out._jdf.queryExecution().optimizedPlan().toString()
    joined = next(line for line in below.splitlines() if "extra" in line and "__is" in line)
    assert "run_info#" in joined and not re.search(r"run_info#\d+\.(?:browser_name|revision)", below)
    got = {r.run_id: r.run_info for r in out.collect()}
    assert got[1].asDict() == {"extra": "x", "browser_name": "chrome", "revision": "abcdef0123", "browser_version": "62.0", "os_name": "linux", "os_version": "3.16", "full_revision_hash": ""}
    assert got[2] is None and got[3].extra == "y" and got[3].os_name == "mac"


def test_documents_not_cells_meet_the_runs(spark):
    """the cells are exploded above the join with the runs."""
    cells = C.wide_cells(Q.load_reports(spark, SF_SMALL), X.runs(spark, SF_SMALL), load_ts=F.lit("2020-01-01").cast("timestamp"))
    plan = cells._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Join") and plan.rindex("Generate") < plan.index("Join")


def test_stored_shards_take_one_shuffle(spark):
    """cells are dealt out once, by the ranges that the shards are stored in."""
    cells = stored(spark, spark.createDataFrame(CELLS, CELLS_SCHEMA))
    for size in (None, 1):
        ranged = RP.results_from_cells(cells, part_size=size, ranges=("run_bucket", RP.run_bucket("run_id", 4)))
        assert shuffles(ranged) == shuffles(ranged, "rangepartitioning") == 1
        want = RP.results_from_cells(cells, part_size=size).withColumn("run_bucket", RP.run_bucket("run_id", 4))
        assert sorted(map(str, ranged.collect())) == sorted(map(str, want.select(*ranged.columns).collect())) != []


def test_listing_takes_few_tasks(spark, tmp_path):
    """a task lists many small files, so a listing doesn't leave a file for every 32 paths."""
    for i in range(1000):
        (tmp_path / f"{i % 10}").mkdir(exist_ok=True)
        (tmp_path / f"{i % 10}" / f"{i}.json").write_bytes(b"{}")
    (tmp_path / "0" / "other.txt").write_bytes(b"x")
    listed = LS.list_objects(spark, str(tmp_path), "*.json")
    assert listed.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert sorted(r.path for r in listed.collect()) == sorted(f"{tmp_path}/{i % 10}/{i}.json" for i in range(1000))
    (tmp_path / "none").mkdir()
    assert LS.list_objects(spark, str(tmp_path / "none")).count() == 0


def test_located_reports_are_packed_and_their_counts_meet_the_runs(spark, monkeypatch):
    """the reports stored with their locations are compressed, and the join by location carries their numbers of results."""
    stored_at = []
    monkeypatch.setattr(Q, "fresh_dir", lambda s, name: stored_at.append(fresh_dir(s, name)) or stored_at[-1])
    out = Q.read_reports_by_location(spark, SF_SMALL)
    (path,) = stored_at
    names = [n for n in os.listdir(NF.file_system(path)[1]) if n.startswith("part-")]
    assert names and all(n.endswith(".json.gz") for n in names)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("size(filter(results") and plan.index("Join") < plan.index("aggregate(results")


def test_counted_reports_have_the_same_sizes(spark):
    """counts before or after a join are the same, also of parts, later entries of a test, and missing results."""
    schema = "run_id bigint, results array<struct<test:string,subtests:array<struct<name:string,status:string>>,sub_base:bigint>>"
    sub = ("s", "PASS")
    docs = spark.createDataFrame([(1, [("/a", [sub, sub], 0), ("/a", [sub], 2), ("/b", None, None)]), (1, [("/c", [], 0)]), (2, []), (3, None), (None, [("/d", [sub], 0)]), (None, [("/d", [sub], 0)])], schema)
    sizes = lambda df: sorted((tuple(r) for r in RP.report_sizes(df).collect()), key=str)
    assert sizes(RP.result_counts(docs)) == sizes(docs) == sorted([(1, 3, 3), (2, 0, 0), (3, None, None), (None, 2, 2)], key=str)
    plain = spark.createDataFrame([(1, [("/a", [sub])]), (1, [("/a", None)])], "run_id bigint, results array<struct<test:string,subtests:array<struct<name:string,status:string>>>>")
    assert sizes(RP.result_counts(plain)) == sizes(plain) == [(1, 2, 1)]


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {n for d in dirs for _, _, names in os.walk(d.getPath()) for n in names if n.startswith("shuffle_")}


def test_stored_writes_leave_no_shuffle_files(spark, tmp_path):
    """the shuffle files of a stored table and of written reports go with the write; the session's setting is as before."""
    (tmp_path / "source").write_bytes(b"x")
    rows = lambda: spark.range(1000).repartition(3).select("id", F.concat(F.lit("/"), F.col("id")).alias("test"))
    setting, before = spark.conf.get(_FREE_SHUFFLES, None), shuffle_files(spark)
    path = M.materialize(spark, str(tmp_path / "source"), "rows", rows)
    written = RIO.write_reports(rows(), fresh_dir(spark, "freed"), "gzip")
    assert spark.conf.get(_FREE_SHUFFLES, None) == setting
    for _ in range(100):  # they go in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    assert spark.read.parquet(path).count() == spark.read.json(written).count() == 1000


def test_whole_files_leave_no_shuffle_files(spark):
    """Nor do files by name, nor the names that reports are opened by."""
    rows = spark.range(1000).repartition(3).select(F.format_string("%d/r.json", "id").alias("name"), F.lit("{}").alias("text"))
    before, folder = shuffle_files(spark), fresh_dir(spark, "freed_files")
    NF.write_files(rows, folder)
    runs = runs_df(spark, [run(i, raw_results_url=f"https://storage.example/results/{i}/r.json") for i in range(1001)])
    _, bad = LOC.read_located(runs, folder)
    for _ in range(100):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    assert {r.reason: r["count"] for r in bad.groupBy("reason").count().collect()} == {"empty": 1000, "missing": 1}
