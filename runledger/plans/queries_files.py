"""Registered queries over whole files, keyed streaming state and stored indexes.

The same contract as ``plans/queries.py``, which imports this module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.functions import predicates as P
from runledger.operators import cells as C
from runledger.operators import dedup as D
from runledger.operators import dictionary as DT
from runledger.operators import postings as PT
from runledger.operators import reports as RP
from runledger.operators import revisions as REV
from runledger.operators import rules as R
from runledger.operators import search as S
from runledger.operators import wide_table as W
from runledger.plans import queries as Q
from runledger.session import fresh_dir
from runledger.sources import fixtures as X
from runledger.sources import listing as LS
from runledger.sources import located as LOC
from runledger.sources import materialize as M
from runledger.sources import named_files as NF
from runledger.sources import rewritten as RW
from runledger.sources import snapshot as SN
from runledger.streaming import pending as PENDING

# ---- S3, S4, J5: reports at the runs' locations -----------------------------------

#: One document per run, whatever its size, as files by location have it.
_WHOLE = 1 << 60


def located_folder(spark: SparkSession, sf_dir: str) -> str:
    """Every report as a file at its run's location (of runs that share one, the
    first's).  Some are damaged, by the number of that run: not there (every
    7th), cut short (one in 5), without results (one in 9)."""
    folder = f"{M.table_path(spark, sf_dir, 'located_reports')}/files"
    if NF.totals(folder) is None:
        first, _ = D.dedup(X.runs(spark, sf_dir).where(~P.is_missing_str("raw_results_url")))
        results = RP.results_from_cells(X.cells(spark, sf_dir))
        documents = RP.assemble_reports(results, first, part_size=_WHOLE, keep=("raw_results_url",))
        text = F.to_json(F.struct("run_id", "part", "run_info", "results"))
        damaged = F.when(F.col("run_id") % 5 == 1, F.expr("substring(text, 1, length(text) - 2)")).when(F.col("run_id") % 9 == 2, F.lit("{}")).otherwise(F.col("text"))
        inside = LOC.object_name(F.col("raw_results_url"), RP.bucket_prefix()).isNotNull()
        rows = documents.where(inside & (F.col("run_id") % 7 != 0)).select(F.col("raw_results_url").alias("location"), "run_id", text.alias("text"))
        LOC.write_located(rows.select("location", damaged.alias("text")), folder)
    return folder


@Q.query("reports_at_locations")
def reports_at_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of each run's report, opened at the run's location."""
    runs = X.runs(spark, sf_dir).where(~P.is_missing_str("raw_results_url"))
    good, bad = LOC.read_located(runs, located_folder(spark, sf_dir))
    outcome = RP.report_sizes(good, "location").select("location", F.lit("read").alias("outcome"), "n_results").unionByName(
        bad.select("location", F.col("reason").alias("outcome"), F.lit(0).cast("bigint").alias("n_results")))
    return runs.select("run_id", F.col("raw_results_url").alias("location")).join(outcome, "location").select("run_id", "outcome", "n_results")


@Q.query("located_objects")
def located_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The paths of the objects below a folder, one by one."""
    folder = located_folder(spark, sf_dir)
    listed = LS.list_objects(spark, folder, "*.json")
    return listed.select(F.regexp_extract("path", "/located_reports/files/(.*)", 1).alias("path"))


# ---- S5, A2: one file per sharded result ------------------------------------------

@Q.query("consolidate_shard_files")
def consolidate_shard_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 + A2: sharded results of the runs still to do, one file each, read back and consolidated."""
    runs = X.runs(spark, sf_dir)
    todo = runs.where(P.is_missing_str("raw_results_url")).select("run_id")
    folder = fresh_dir(spark, "shard_files")
    LOC.write_shards(RP.results_from_cells(X.cells(spark, sf_dir).join(todo, "run_id", "left_semi"), part_size=_WHOLE), folder)
    shards, _ = LOC.read_shards(spark, folder)
    path = fresh_dir(spark, "consolidated")
    RP.consolidate(shards, runs, X.revisions(spark, sf_dir)).write.option("compression", "gzip").json(path)
    return Q.consolidation_cells(Q.RIO.read_own(spark, path, Q._CONSOLIDATED_READ))


# ---- S6, K6, K7: one file per key ---------------------------------------------------

def _matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.last_write_encoded(Q._encoded(spark, sf_dir))


@Q.query("run_map_files")
def run_map_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7 by file: one map per run, read back with the run from the file's name."""
    folder = fresh_dir(spark, "run_maps")
    NF.write_key_maps(_matrix(spark, sf_dir), folder, "run_idx", "test_id")
    return NF.read_key_maps(spark, folder, "run_idx", "test_id", SN.STATUS_STRUCT)


@Q.query("test_map_files")
def test_map_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7 by file: one map per test."""
    folder = fresh_dir(spark, "test_maps")
    NF.write_key_maps(_matrix(spark, sf_dir), folder, "test_id", "run_idx")
    return NF.read_key_maps(spark, folder, "test_id", "run_idx", SN.STATUS_STRUCT)


@Q.query("snapshot_files")
def snapshot_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot of whole files (arrays and one map per run), loaded and transposed."""
    path = fresh_dir(spark, "snapshot_files")
    run_index = Q.stored_run_index(spark, sf_dir).select("id", "run_id", "browser_name", "created_at")
    SN.write_snapshot_files(run_index, Q.stored_tests(spark, sf_dir), _matrix(spark, sf_dir), path)
    snap = SN.load_snapshot_files(spark, path, Q._SNAP_RUNS)
    cells = C.unpivot(snap.by_test(), "test_id", "run_idx")
    runs = snap.runs.select(F.col("id").alias("run_idx"), "run_id", "browser_name")
    tests = snap.tests.select(F.col("id").alias("test_id"), "test", "subtest")
    return cells.join(runs, "run_idx").join(tests, "test_id").select(
        "run_idx", "test_id", "run_id", "browser_name", "test", "subtest", "status", "sub_status")


# ---- X1: pending runs as keyed state ------------------------------------------------

@Q.query("stream_pending")
def stream_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 with keyed state: runs first, with half the revisions and the notices of
    half the runs' results; then the other revisions; then the other notices."""
    root = fresh_dir(spark, "pending")
    revisions, notices = X.revisions(spark, sf_dir), Q._shards(spark, sf_dir).select("run_id").distinct()
    c = PENDING.PendingConsolidation(spark, X.runs(spark, sf_dir).schema, Q._runs_stream_source(spark, sf_dir), f"{root}/revisions", f"{root}/notices",
                                     lambda: Q._shards(spark, sf_dir), f"{root}/own", Q.SHARD_BUCKETS)
    early = F.col("sha") < "8", F.col("run_id") % 2 == 0
    for which, when in ((revisions, early[0]), (notices, early[1])):
        which.where(when).write.mode("append").parquet(f"{root}/{'revisions' if which is revisions else 'notices'}")
    c.run_available()
    revisions.where(~early[0]).write.mode("append").parquet(f"{root}/revisions")
    c.run_available()
    notices.where(~early[1]).write.mode("append").parquet(f"{root}/notices")
    c.run_available()
    return Q.consolidation_cells(Q.RIO.read_own(spark, c.out, Q._CONSOLIDATED_READ))


# ---- T1-T4, L4: trigram postings ----------------------------------------------------

def search_index(spark: SparkSession, sf_dir: str) -> PT.SearchIndex:
    """The stored index of the test dictionary, built once per load."""
    base = M.table_path(spark, sf_dir, "search_index")
    name = M.read_marker(spark, f"{base}/{M.MARKER}")
    if not name:
        name = fresh_dir(spark, "index").rsplit("/", 1)[1]
        PT.write_index(Q.stored_tests(spark, sf_dir), f"{base}/{name}")
        M.write_marker(spark, f"{base}/{M.MARKER}", name)
    return PT.load_index(spark, f"{base}/{name}")


@Q.query("path_search_postings")
def path_search_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PT.path_search(search_index(spark, sf_dir), Q.PATH_QUERY)


@Q.query("name_search_postings")
def name_search_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PT.name_search(search_index(spark, sf_dir), "red/gear.html:s")


#: L4: at most so many results, the first by id.
MAX_RESULTS = 40


@Q.query("path_search_capped")
def path_search_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PT.path_search(search_index(spark, sf_dir), "/standard/b", MAX_RESULTS)


# ---- J1 as a filter, X2 -------------------------------------------------------------

@Q.query("mainline_runs")
def mainline_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs at a mainline revision, as a filter."""
    return REV.in_mainline(X.runs(spark, sf_dir), Q._mainline_keys(spark, sf_dir)).select("run_id", "revision")


@Q.query("refreshed_runs")
def refreshed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader that sees a second load after its refresh, and each load whole."""
    path = fresh_dir(spark, "refreshed")
    runs = X.runs(spark, sf_dir).select("run_id", "browser_name")
    reader = RW.Refreshing(spark, path)
    for load in (0, 1):
        runs.where(F.col("run_id") % 2 == load).write.mode("append").parquet(path)
        reader.refresh()
    return reader.df


# ---- K8: deltas and compaction; P13, P14: scans without a prefix --------------------

@Q.query("wide_deltas")
def wide_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: a first load, every third run again (compacted), every fifth run again (merged on read)."""
    runs, reports = X.runs(spark, sf_dir), Q.load_reports(spark, sf_dir)
    table = W.WideTable(spark, fresh_dir(spark, "wide_deltas"), ranges=16)
    for n, (every, word) in enumerate([(1, ""), (3, "again "), (5, "more ")]):
        cells = C.wide_cells(reports.where(F.col("run_id") % every == 0), runs, load_ts=F.lit(f"2020-0{n + 1}-01 00:00:00").cast("timestamp"))
        table.load(cells.withColumn("value", F.concat(F.lit(word), "value")))
        if n == 1:
            table.compact()
    return table.read().select("row_key", "qualifier", "value")


def zordered_path(spark: SparkSession, sf_dir: str) -> str:
    """The wide cells along a Z-order curve, built once per load."""
    base = M.table_path(spark, sf_dir, "wide_zordered")
    name = M.read_marker(spark, f"{base}/{M.MARKER}")
    if not name:
        name = fresh_dir(spark, "z").rsplit("/", 1)[1]
        W.write_zordered(Q.load_wide(spark, sf_dir), f"{base}/{name}", files=32)
        M.write_marker(spark, f"{base}/{M.MARKER}", name)
    return f"{base}/{name}"


@Q.query("qualifier_scan")
def qualifier_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P13 without a row-key prefix."""
    return W.range_scan(spark, zordered_path(spark, sf_dir), C.DEFAULT_FAMILY, q_range=("/economy/b", "/economy/c")).select("row_key", "qualifier", "value")


@Q.query("value_scan")
def value_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P14 without a row-key prefix."""
    return W.range_scan(spark, zordered_path(spark, sf_dir), C.DEFAULT_FAMILY, v_range=("TIMEOUT#P", "U")).select("row_key", "qualifier", "value")


@Q.query("qualifier_cells")
def qualifier_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P13 for a single qualifier: the first one of the table, through zones and bloom filters."""
    path = zordered_path(spark, sf_dir)
    first = spark.read.parquet(f"{path}/zones").agg(F.min("min_qualifier")).first()[0]  # one value
    return W.qualifier_lookup(spark, path, C.DEFAULT_FAMILY, first or "").select("row_key", "qualifier", "value")


# ---- K10: counts in the rewrite's own pass; A3 over two loads; A1 from footers -------

@Q.query("rewrite_counts")
def rewrite_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers of rows, selected and changed rows, counted while the rewrite is written."""
    new, _ = R.rewrite(X.runs(spark, sf_dir), [R.experimental_rule(), R.channel_rule()])
    back, n = RW.write_rewrite(new, fresh_dir(spark, "runs_counted"))
    return back.agg(F.count(F.lit(1)).alias("n_written")).select("n_written", *[F.lit(v).cast("bigint").alias(k) for k, v in n.items()])


@Q.query("dictionary_two_loads")
def dictionary_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: runs with even numbers, then the others; the first load's ids stay."""
    cells, runs = X.cells(spark, sf_dir), X.runs(spark, sf_dir)
    d = DT.TestDictionary(spark, fresh_dir(spark, "dictionary"))
    for part in (0, 1):
        d.extend(cells.where(F.col("run_id") % 2 == part), runs.where(F.col("run_id") % 2 == part))
    return d.read()


@Q.query("count_from_footers")
def count_from_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 without reading a page."""
    Q.stored_run_index(spark, sf_dir), Q.stored_tests(spark, sf_dir)
    path = lambda name: M.current(spark, M.table_path(spark, sf_dir, name))
    return S.counts_from_footers(spark, path("run_index"), path("tests_dictionary"))
