"""Registered queries: one per operator family of SURVEY §2.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole proxy
tables derived from the driver's parquet files.  Label lists are returned as
comma-joined text and timestamps as text, so results compare exactly with the
DuckDB oracle (``plans/oracle_sql.py``).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runledger.functions import predicates as P
from runledger.operators import cells as C
from runledger.operators import dedup as D
from runledger.operators import reports as RP
from runledger.operators import revisions as REV
from runledger.operators import rules as R
from runledger.operators import run_filters as RF
from runledger.operators import search as S
from runledger.session import fresh_dir
from runledger.sources import fixtures as X
from runledger.sources import listing as LS
from runledger.sources import materialize as M
from runledger.sources import reports_io as RIO
from runledger.sources import snapshot as SN
from runledger.sources import text_lines as TL
from runledger.sources import rewritten as RW
from runledger.streaming import consolidate as STREAM

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _labels_text(c: str = "labels"):
    return F.array_join(F.col(c), ",").alias(c)


def _ts_text(c: str):
    return F.col(c).cast("string").alias(c)


def _tagged(new_df: DataFrame) -> DataFrame:
    return new_df.select("run_id", _labels_text(), "selected", "changed")


# ---- §2.4 rule rewrites ------------------------------------------------------

@query("tag_stable")
def tag_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, _ = R.rewrite(X.runs(spark, sf_dir), R.stable_rule())
    return _tagged(new)


@query("tag_experimental")
def tag_experimental(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, _ = R.rewrite(X.runs(spark, sf_dir), R.experimental_rule())
    return _tagged(new)


@query("tag_browser_name")
def tag_browser_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, _ = R.rewrite(X.runs(spark, sf_dir), R.browser_name_rule())
    return _tagged(new)


@query("tag_channel")
def tag_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, _ = R.rewrite(X.runs(spark, sf_dir), R.channel_rule())
    return _tagged(new)


def _mainline_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = X.revisions(spark, sf_dir).select(F.col("sha").alias("value"))
    return REV.revision_keys(lines)


@query("tag_master")
def tag_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = REV.flag_mainline(X.runs(spark, sf_dir), _mainline_keys(spark, sf_dir))
    new, _ = R.rewrite(runs, R.mainline_rule(F.col("in_mainline")))
    return _tagged(new)


@query("backfill_time_start")
def backfill_time_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, _ = R.rewrite(X.runs(spark, sf_dir), R.time_start_rule())
    return new.select("run_id", _ts_text("time_start"), "selected", "changed")


@query("dry_run_selected")
def dry_run_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, selected = R.rewrite(X.runs(spark, sf_dir), R.channel_rule())
    return selected.select("run_id", "browser_name", "browser_version", "changed")


@query("apply_rules_chain")
def apply_rules_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = REV.flag_mainline(X.runs(spark, sf_dir), _mainline_keys(spark, sf_dir))
    chain = [R.experimental_rule(), R.stable_rule(), R.channel_rule(), R.browser_name_rule(),
             R.mainline_rule(F.col("in_mainline")), R.time_start_rule()]
    new, _ = R.rewrite(runs, chain)
    return new.select("run_id", _labels_text(), _ts_text("time_start"), "selected", "changed")


FLAGSHIP = "apply_rules_chain"


# ---- §2.7 / K2 duplicates ----------------------------------------------------


@query("dedup_runs")
def dedup_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = D.dedup(X.runs(spark, sf_dir))
    return kept.select("run_id", "raw_results_url")


@query("duplicate_groups")
def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.duplicate_groups(X.runs(spark, sf_dir))


# ---- §2.1 / §2.8 scans, filters, limits ----------------------------------------

@query("scan_runs_ordered")
def scan_runs_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = X.runs(spark, sf_dir).select("run_id", "time_start")
    return RF.scan_ordered(runs, "start_desc", "rank").select("run_id", "rank")


@query("scan_run_keys")
def scan_run_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.runs(spark, sf_dir).select("run_id")


FILTER_PARAMS = {"browser_name": "chrome", "os_name": "in", "labels": "stab"}


@query("filter_runs")
def filter_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = RF.filter_runs(X.runs(spark, sf_dir), FILTER_PARAMS)
    return out.select("run_id", "browser_name", "os_name", _labels_text())


@query("filter_runs_limit")
def filter_runs_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = RF.filter_runs(X.runs(spark, sf_dir), {**FILTER_PARAMS, "limit": "25"})
    return out.select("run_id", "browser_name", "os_name", _ts_text("created_at"))


# ---- §2.5 revisions ----------------------------------------------------------

def _revision_lines_path(spark: SparkSession, sf_dir: str) -> str:
    """The mainline commit list as a text file, one sha per line."""
    return M.materialize(spark, sf_dir, "revision_lines",
                         lambda: X.revisions(spark, sf_dir).select("sha"), fmt="text")


@query("revision_keys")
def revision_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = TL.read_lines(spark, _revision_lines_path(spark, sf_dir))
    return REV.revision_keys(lines)


@query("resolve_revisions")
def resolve_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = X.runs(spark, sf_dir).select("run_id", "revision")
    return REV.resolve(runs, X.revisions(spark, sf_dir), how="left")


@query("distinct_revisions")
def distinct_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved, unresolved = REV.resolve_distinct(X.runs(spark, sf_dir), X.revisions(spark, sf_dir))
    return (resolved.select("revision", "hash", F.lit(True).alias("resolved"))
            .unionByName(unresolved.select("revision", F.lit(None).cast("string").alias("hash"),
                                           F.lit(False).alias("resolved"))))


@query("backfill_full_hash")
def backfill_full_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = REV.resolve(X.runs(spark, sf_dir), X.revisions(spark, sf_dir), how="left")
    rule = R.Rule(
        "full_hash",
        ~P.is_missing_str("raw_results_url") & F.col("resolved_hash").isNotNull()
        & P.value_changed("full_revision_hash", "resolved_hash"),
        {"full_revision_hash": F.col("resolved_hash")})
    new, _ = R.rewrite(runs, rule)
    return new.select("run_id", "full_revision_hash", "selected", "changed")


@query("report_locations")
def report_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = REV.resolve(X.runs(spark, sf_dir), X.revisions(spark, sf_dir))
    return RP.report_locations(runs).select("run_id", "product_id", "report_path", "report_url")


@query("next_to_consolidate")
def next_to_consolidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = RP.next_to_consolidate(X.runs(spark, sf_dir), X.revisions(spark, sf_dir), n=10)
    return out.select("run_id", "resolved_hash", _ts_text("created_at"))


# ---- §2.10 scalar functions ---------------------------------------------------

@query("scalar_functions")
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = X.runs(spark, sf_dir)
    path = RP.report_path()
    return r.select(
        "run_id",
        P.trim_suffix("browser_name", P.EXPERIMENTAL_SUFFIX).alias("f1_trimmed"),
        path.alias("f2_path"),
        RP.new_report_path(path).alias("f3_new_path"),
        (F.col("raw_results_url").startswith("https://") & F.col("raw_results_url").endswith(".json")
         & F.col("browser_version").contains(" ")).alias("f4_tests"),
        P.trim_chars(F.concat(F.lit(" \t"), F.col("revision"), F.lit("\n\u000b"))).alias("f5_trimmed"),
        F.array_join(P.split_drop_first(path, "/"), "|").alias("f6_pieces"),
        F.array_join(P.regex_split(F.col("browser_version"), "[ .]"), "|").alias("f7_pieces"),
        P.first_chars("revision", 10).alias("f8_short"),
        F.length("revision").cast("bigint").alias("f8_len"),
        F.concat(RP.product_id(), F.lit("@"), F.col("full_revision_hash")).alias("f9_product"),
        P.rfc3339_utc("created_at").alias("f10_rfc3339"),
        P.lasted_longer_than("time_start", "time_end", 10).alias("f11_long"),
        P.is_missing_time("time_start").alias("f11_zero"),
        P.parse_int("os_version").alias("f12_int"),
        F.array_contains(P.labels_or_empty("labels"), "stable").alias("f13_has_stable"),
        F.size(F.array_append(P.labels_or_empty("labels"), F.lit("x"))).cast("bigint").alias("f13_size"),
        P.any_contains("labels", "ure").alias("f13_exists"),
        F.to_json(F.struct("browser_name", "os_name")).alias("f14_json"),
        F.from_json(F.to_json(F.struct("labels")), "labels ARRAY<STRING>")["labels"][0].alias("f14_first_label"),
    )


# ---- derived tables (written once under the shared scratch folder) ---------------


# Load timestamp stamped on every wide cell of the initial load.
WIDE_LOAD_TS = "2020-01-01 00:00:00"


def reports_path(spark: SparkSession, sf_dir: str) -> str:
    """One report document per run with cells, as JSON lines (K3)."""
    def build():
        results = RP.results_from_cells(X.cells(spark, sf_dir))
        return RP.assemble_reports(results, X.runs(spark, sf_dir))
    return M.materialize(spark, sf_dir, "reports", build, fmt="json", options={"compression": "gzip"})


SHARD_BUCKETS = 16


def shards_path(spark: SparkSession, sf_dir: str) -> str:
    """Sharded results: one JSON line per (run, test) result, in folders by
    ``run_bucket`` (a hash of the run key) so lookups for a few runs prune."""
    def build():
        # by ranges, so that the number of writing tasks follows the data, not the buckets
        return RP.results_from_cells(X.cells(spark, sf_dir), ranges=("run_bucket", RP.run_bucket("run_id", SHARD_BUCKETS)))
    return M.materialize(spark, sf_dir, "shards", build, fmt="json", options={"compression": "gzip"}, partition_by=["run_bucket"])


def load_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RIO.read_own(spark, reports_path(spark, sf_dir)).where(F.size("results") > 0)


def wide_path(spark: SparkSession, sf_dir: str) -> str:
    """K8: the merged wide-cell table, range-partitioned and sorted by
    (row_key, qualifier) so Parquet row-group statistics prune prefix and
    range scans."""
    def build():
        cells = C.wide_cells(load_reports(spark, sf_dir), X.runs(spark, sf_dir),
                             load_ts=F.lit(WIDE_LOAD_TS).cast("timestamp"))
        return C.merge_wide(C.in_key_order(cells)).sortWithinPartitions("row_key", "qualifier")
    return M.materialize(spark, sf_dir, "wide_cells", build)


def load_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(wide_path(spark, sf_dir))


# ---- §2.4 R14/R15, §2.6 A3-A8, §2.5 J6 ----------------------------------------------

@query("explode_cells_matrix")
def explode_cells_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.explode_matrix(load_reports(spark, sf_dir)).select(
        "run_id", "result_pos", "test", "subtest", "status", "sub_status", "sub_pos")


@query("explode_cells_wide")
def explode_cells_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.explode_wide(load_reports(spark, sf_dir)).select(
        "run_id", "result_pos", "qualifier", "value", "sub_pos")


@query("wide_cells")
def wide_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_wide(spark, sf_dir).select("row_key", "qualifier", "value")


@query("last_write_cells")
def last_write_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.last_write(X.cells(spark, sf_dir))


@query("last_subtest_status")
def last_subtest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.last_subtest_status(X.cells(spark, sf_dir))


@query("test_dictionary")
def test_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.test_dictionary(X.cells(spark, sf_dir), X.runs(spark, sf_dir))


@query("run_dictionary")
def run_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = X.runs(spark, sf_dir).select("run_id", "created_at")
    return C.run_dictionary(runs).select("id", "run_id", _ts_text("created_at"))


def stored_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test dictionary (A3) as a stored table, built once per load."""
    return spark.read.parquet(M.materialize(
        spark, sf_dir, "tests_dictionary",
        lambda: C.test_dictionary(X.cells(spark, sf_dir), run_index=stored_run_index(spark, sf_dir))))


def stored_run_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run dictionary (A4) as a stored table, built once per load."""
    return spark.read.parquet(M.materialize(
        spark, sf_dir, "run_index",
        lambda: C.run_dictionary(X.runs(spark, sf_dir).select("run_id", "browser_name", "created_at"))))


def _encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.encode_cells(X.cells(spark, sf_dir), stored_tests(spark, sf_dir),
                          stored_run_index(spark, sf_dir), KNOWN_STATUSES)


@query("encode_cells")
def encode_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _encoded(spark, sf_dir).select("run_idx", "test_id", "status", "sub_status", "pos")


# The status words of the proxy deployment.
KNOWN_STATUSES = ("OK", "PASS", "FAIL", "ERROR", "TIMEOUT", "NOTRUN", "CRASH", "ASSERT", "SKIP", "PRECONDITION_FAILED")

_PIVOT_READ = "{by} BIGINT, chunk BIGINT, entries MAP<STRING, STRUCT<status: STRING, sub_status: STRING>>"


def _pivot_roundtrip(spark: SparkSession, sf_dir: str, by: str, other: str) -> DataFrame:
    lw = C.last_write_encoded(_encoded(spark, sf_dir))
    path = C.write_pivot(C.pivot(lw, by, other), by, fresh_dir(spark, f"pivot_{by}"))
    back = spark.read.schema(_PIVOT_READ.format(by=by)).json(path)
    back = back.withColumn("entries", F.transform_keys("entries", lambda k, v: k.cast("bigint")))
    return C.unpivot(back, by, other).select("run_idx", "test_id", "status", "sub_status")


@query("pivot_by_run")
def pivot_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pivot_roundtrip(spark, sf_dir, "run_idx", "test_id")


@query("pivot_by_test")
def pivot_by_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pivot_roundtrip(spark, sf_dir, "test_id", "run_idx")


@query("report_dictionary")
def report_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 as the matrix loader builds it: from exploded reports."""
    tests, _ = C.load_matrix(load_reports(spark, sf_dir), stored_run_index(spark, sf_dir), KNOWN_STATUSES)
    return tests


@query("report_matrix")
def report_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports -> dictionary -> encoded cells, last write wins (the loader)."""
    _, cells = C.load_matrix(load_reports(spark, sf_dir), stored_run_index(spark, sf_dir), KNOWN_STATUSES)
    return cells


@query("count_runs_tests")
def count_runs_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.counts(stored_run_index(spark, sf_dir), stored_tests(spark, sf_dir))


# ---- §2.1 S3/S4, J5, R8, R9, K9, S7/J2 --------------------------------------------

@query("read_reports")
def read_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = RIO.join_reports(X.runs(spark, sf_dir).select("run_id"), load_reports(spark, sf_dir))
    return j.select("run_id", F.posexplode("results").alias("result_pos", "r")).select(
        "run_id", F.col("result_pos").cast("bigint").alias("result_pos"), F.col("r.test").alias("test"),
        F.col("r.status").alias("status"),
        F.size(F.coalesce("r.subtests", F.array())).cast("bigint").alias("n_subtests"))


@query("read_reports_by_location")
def read_reports_by_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports stored with their location, found by the runs' URLs."""
    runs = X.runs(spark, sf_dir)
    first, _ = D.dedup(runs.where(~P.is_missing_str("raw_results_url")))
    located = load_reports(spark, sf_dir).join(first.select("run_id", F.col("raw_results_url").alias("location")), "run_id")
    path = RIO.write_reports(located, fresh_dir(spark, "reports_located"), "gzip")
    back = RIO.read_own(spark, path, T.StructType([*RIO.REPORT.fields, T.StructField("location", T.StringType())]))
    # a report's numbers of results go into the join, not the results
    j = RIO.join_by_location(runs, RP.result_counts(back))
    return RP.report_sizes(j, by=("raw_results_url",))


@query("quarantined_reports")
def quarantined_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 50th document cut short; what was read and what was not."""
    lines = spark.read.text(reports_path(spark, sf_dir)).withColumn("run_id", F.get_json_object("value", "$.run_id").cast("bigint"))
    short = F.when(F.col("run_id") % 50 == 0, F.expr("substring(value, 1, length(value) - 2)")).otherwise(F.col("value"))
    path = TL.write_lines(lines.select(short.alias("value")), fresh_dir(spark, "reports_damaged"))
    good, bad = RIO.read_reports(spark, path)
    return good.select("run_id", F.lit(True).alias("read")).unionByName(
        bad.select(F.regexp_extract("raw", '"run_id":([0-9]+)', 1).cast("bigint").alias("run_id"), F.lit(False).alias("read")))


@query("list_objects")
def list_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files listed below a folder; the folders that hold any."""
    root = fresh_dir(spark, "listed")
    X.runs(spark, sf_dir).select("run_id", (F.col("run_id") % 50).alias("folder")).write.partitionBy("folder").json(root)
    listed = LS.list_objects(spark, root, "*.json")
    return listed.select(F.regexp_extract("path", "/folder=([0-9]+)/", 1).cast("bigint").alias("folder")).distinct()


@query("wide_upsert")
def wide_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: a first load of all reports, then a second load of every third
    run's reports with other statuses, merged into the touched partitions."""
    runs, reports = X.runs(spark, sf_dir), load_reports(spark, sf_dir)
    path = fresh_dir(spark, "wide_upserted")
    at = lambda t: F.lit(t).cast("timestamp")
    C.upsert_wide_partitions(spark, path, C.wide_cells(reports, runs, load_ts=at(WIDE_LOAD_TS)))
    later = C.wide_cells(reports.where(F.col("run_id") % 3 == 0), runs, load_ts=at("2020-02-01 00:00:00"))
    C.upsert_wide_partitions(spark, path, later.withColumn("value", F.concat(F.lit("again "), "value")))
    return spark.read.parquet(path).select("row_key", "qualifier", "value")


@query("runs_without_cells")
def runs_without_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a report's number of results goes into the join, not the results
    sizes = load_reports(spark, sf_dir).withColumn("results", F.size("results"))
    j = RIO.join_reports(X.runs(spark, sf_dir).select("run_id"), sizes, how="left")
    return j.select("run_id", F.coalesce("results", F.lit(0)).cast("bigint").alias("n_results")) \
        .where(F.col("n_results") == 0)


@query("has_migration_log")
def has_migration_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = X.runs(spark, sf_dir)
    return RP.with_migration_log(runs, X.objects(spark, sf_dir, runs)).select("run_id", "raw_results_url")


@query("rewrite_report_paths")
def rewrite_report_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = X.runs(spark, sf_dir)
    return RP.rewrite_report_paths(runs, X.objects(spark, sf_dir, runs)).select(
        "run_id", "old_path", "new_path", "new_url", "path_changed")


@query("cleanup_paths")
def cleanup_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = X.runs(spark, sf_dir)
    return RP.cleanup_paths(RP.rewrite_report_paths(runs, X.objects(spark, sf_dir, runs)))


def _stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = X.runs(spark, sf_dir)
    eligible = RP.with_migration_log(runs, X.objects(spark, sf_dir, runs))
    reps = load_reports(spark, sf_dir).join(eligible.select("run_id"), "run_id", "left_semi")
    return RP.stamp_run_info(reps.select("run_id", "run_info", "results"), eligible)


@query("stamp_run_info")
def stamp_run_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = RP.report_sizes(_stamped(spark, sf_dir), by=("run_info",))
    return sizes.select("run_id", "run_info.*", "n_results")


@query("write_reports")
def write_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3/K4 via the whole migration (R8 + R9): stamped reports at their new
    locations written as gzip JSON lines, read back."""
    runs = X.runs(spark, sf_dir)
    new_reports, _, _ = RP.migrate_reports(runs, load_reports(spark, sf_dir), X.objects(spark, sf_dir))
    path = RIO.write_reports(new_reports, fresh_dir(spark, "reports_gz"), "gzip")
    return _report_cells(spark, path)


def _report_cells(spark: SparkSession, path: str) -> DataFrame:
    """Every cell of the reports at ``path``, with the report's location."""
    located = T.StructType([*RIO.REPORT.fields, T.StructField("location", T.StringType())])
    good = RIO.read_own(spark, path, located)
    doc = F.struct("run_id", F.col("run_info.browser_name").alias("browser_name"), "location")
    return C.explode_matrix(good.withColumn("doc", doc), "doc").select("doc.*", "test", "subtest", "status", "sub_status")


@query("write_reports_plain")
def write_reports_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: the same reports as plain JSON."""
    new_reports, _, _ = RP.migrate_reports(X.runs(spark, sf_dir), load_reports(spark, sf_dir), X.objects(spark, sf_dir))
    return _report_cells(spark, RIO.write_reports(new_reports, fresh_dir(spark, "reports_json")))


@query("migrated_runs")
def migrated_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run table after the migration: the new locations."""
    _, moved, _ = RP.migrate_reports(X.runs(spark, sf_dir), load_reports(spark, sf_dir), X.objects(spark, sf_dir))
    return moved.select("run_id", "raw_results_url")


@query("not_selected")
def not_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs that a rule leaves out."""
    new, _ = R.rewrite(X.runs(spark, sf_dir), R.channel_rule())
    return R.not_selected(new).select("run_id", "browser_name")


@query("gzip_lines")
def gzip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TL.gzip_lines(spark, _revision_lines_path(spark, sf_dir), fresh_dir(spark, "lines_gz"))


# ---- §2.6 A2, S5, K4: consolidation --------------------------------------------

_CONSOLIDATED_READ = (
    "run_id BIGINT, part BIGINT, report_url STRING, run_info STRUCT<browser_name: STRING, "
    "full_revision_hash: STRING>, results ARRAY<STRUCT<test: STRING, status: STRING, "
    "subtests: ARRAY<STRUCT<name: STRING, status: STRING>>, first_pos: BIGINT, sub_base: BIGINT>>")
_SHARD_READ = ("run_bucket INT, run_id BIGINT, test STRING, status STRING, first_pos BIGINT, sub_base BIGINT, "
               "subtests ARRAY<STRUCT<name: STRING, status: STRING>>")


def consolidation_cells(reports: DataFrame) -> DataFrame:
    """Every cell of consolidated reports, with location, hash and browser."""
    doc = F.struct("run_id", "report_url", F.col("run_info.full_revision_hash").alias("full_revision_hash"),
                   F.col("run_info.browser_name").alias("browser_name"))
    return C.explode_matrix(reports.withColumn("doc", doc), "doc").select("doc.*", "test", "subtest", "status", "sub_status")


@query("consolidate_reports")
def consolidate_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = RP.consolidate(_shards(spark, sf_dir), X.runs(spark, sf_dir), X.revisions(spark, sf_dir),
                         shard_buckets=SHARD_BUCKETS)
    path = RIO.write_reports(out, fresh_dir(spark, "consolidated"), "gzip")
    return consolidation_cells(RIO.read_own(spark, path, _CONSOLIDATED_READ))


# ---- §2.11 / P12-P16, L3, A9: prefix, range and path queries ---------------------

PREFIX = "chrome-62.0-linux-"
QUALIFIER_RANGE = ("/economy/", "/economy0")
VALUE_RANGE = ("OK", "PAST")


@query("prefix_scan")
def prefix_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.prefix_scan(load_wide(spark, sf_dir), PREFIX, C.DEFAULT_FAMILY, QUALIFIER_RANGE,
                         VALUE_RANGE, 100).select("row_key", "qualifier", "value")


@query("prefix_scan_shape")
def prefix_scan_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = S.prefix_scan(load_wide(spark, sf_dir), PREFIX, C.DEFAULT_FAMILY, QUALIFIER_RANGE,
                         VALUE_RANGE, 100)
    return S.scan_shape(hits)


@query("regex_scan")
def regex_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.regex_scan(load_wide(spark, sf_dir), PREFIX, C.DEFAULT_FAMILY, "/economy/.*",
                        "ERROR(#.*)?", 100).select("row_key", "qualifier", "value")


PATH_QUERY = "/eco/l"


@query("path_search")
def path_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.path_search(stored_tests(spark, sf_dir), PATH_QUERY)


@query("name_search")
def name_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    tests = stored_tests(spark, sf_dir)
    return S.name_search(tests, "red/gear.html:s")


# ---- §2.1 S6/K6/M3, §2.2 K1, §2.12 X1 --------------------------------------------


_SNAP_RUNS = "id BIGINT, run_id BIGINT, browser_name STRING, created_at TIMESTAMP_NTZ"


@query("snapshot_roundtrip")
def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write runs/tests/by-run maps, load them back, transpose on load
    and return the by-test matrix as long cells."""
    tests, run_index = stored_tests(spark, sf_dir), stored_run_index(spark, sf_dir)
    lw = C.last_write_encoded(C.encode_cells(X.cells(spark, sf_dir), tests, run_index, KNOWN_STATUSES))
    path = SN.write_snapshot(run_index.select("id", "run_id", "browser_name", "created_at"), tests,
                             C.pivot(lw, "run_idx", "test_id"), fresh_dir(spark, "snapshot"))
    snap = SN.load_snapshot(spark, path, _SNAP_RUNS)
    cells = C.unpivot(snap.by_test(), "test_id", "run_idx")
    runs = snap.runs.select(F.col("id").alias("run_idx"), "run_id", "browser_name")
    tests = snap.tests.select(F.col("id").alias("test_id"), "test", "subtest")
    return cells.join(runs, "run_idx").join(tests, "test_id").select(
        "run_idx", "test_id", "run_id", "browser_name", "test", "subtest", "status", "sub_status")


@query("apply_rewrite")
def apply_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: rewrite the run table with the rule chain into a new folder and
    read it back."""
    runs = REV.flag_mainline(X.runs(spark, sf_dir), _mainline_keys(spark, sf_dir))
    chain = [R.experimental_rule(), R.stable_rule(), R.channel_rule(), R.browser_name_rule(),
             R.mainline_rule(F.col("in_mainline")), R.time_start_rule()]
    new, _ = R.rewrite(runs, chain)
    back = RW.write_table(new.drop("selected", "changed", "in_mainline"), fresh_dir(spark, "runs_rewritten"))
    return back.select("run_id", "browser_name", "browser_version", "os_name", "os_version", "revision",
                       "full_revision_hash", "raw_results_url", _ts_text("created_at"), _ts_text("time_start"),
                       _ts_text("time_end"), _labels_text())


def _runs_stream_source(spark: SparkSession, sf_dir: str) -> str:
    """Run records as they would arrive: several parquet files in a folder."""
    return M.materialize(spark, sf_dir, "runs_arriving",
                         lambda: X.runs(spark, sf_dir).repartition(4, "run_id"))


def _consolidation(spark: SparkSession, sf_dir: str, revisions, shards) -> STREAM.Consolidation:
    return STREAM.Consolidation(spark, X.runs(spark, sf_dir).schema, revisions, shards,
                                fresh_dir(spark, "stream_out"), fresh_dir(spark, "stream_state"), SHARD_BUCKETS)


def _shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RIO.read_own(spark, shards_path(spark, sf_dir), _SHARD_READ)


@query("stream_consolidate")
def stream_consolidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _consolidation(spark, sf_dir, lambda: X.revisions(spark, sf_dir), lambda: _shards(spark, sf_dir))
    c.start(_runs_stream_source(spark, sf_dir), fresh_dir(spark, "stream_ckpt"), max_files_per_trigger=2).awaitTermination()
    return consolidation_cells(RIO.read_own(spark, c.out, _CONSOLIDATED_READ))


@query("stream_late_arrivals")
def stream_late_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 over inputs that arrive late: runs first, with half the revisions and
    half the shards; then all revisions; then all shards.  Returns the run table
    after its update."""
    late = {"revisions": F.col("sha") < "8", "shards": F.col("run_id") % 2 == 0}
    c = _consolidation(spark, sf_dir, lambda: X.revisions(spark, sf_dir).where(late["revisions"]),
                       lambda: _shards(spark, sf_dir).where(late["shards"]))
    c.start(_runs_stream_source(spark, sf_dir), fresh_dir(spark, "stream_ckpt"), max_files_per_trigger=100).awaitTermination()
    for arrived in ("revisions", "shards"):
        late[arrived] = F.lit(True)
        c.retry_pending()
    return c.updated_runs(X.runs(spark, sf_dir)).select("run_id", "raw_results_url", "full_revision_hash")

# registers its queries
from runledger.plans import queries_files  # noqa: E402,F401
