"""Report-level operators.

Reports are nested documents ``run_info STRUCT, results ARRAY<STRUCT<test,
status, subtests ARRAY<STRUCT<name, status>>>>``.  Everything here is a
projection, a join on a derived key, or a per-run aggregation whose group is
one run's results (bounded by the size of a single report).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runledger.functions import predicates as P
from runledger.operators import revisions as REV

# Report object name, migration marker name, and the default
# location prefix of the results bucket (a parameter everywhere).
REPORT_FILE = "report.json"
MIGRATION_LOG = "migration.log"
DEFAULT_URL_BASE = "https://storage.example/"
DEFAULT_BUCKET = "results"

RUN_INFO_FIELDS = ("browser_name", "browser_version", "os_name", "os_version", "revision",
                   "full_revision_hash")


# ---- R11: product ids and report locations -----------------------------------

def product_id(keep_empty_os_version: bool = False) -> Column:
    """``browser-version-os[-osversion]``; the OS version is omitted when it is
    ``''`` or ``'*'`` (``concat_ws`` skips the NULL this produces)."""
    osv = F.col("os_version")
    if not keep_empty_os_version:
        osv = F.when(~F.coalesce(osv, F.lit("")).isin("", "*"), osv)
    return F.concat_ws("-", "browser_name", "browser_version", "os_name", osv)


def report_locations(resolved_runs: DataFrame, hash_col: str = "resolved_hash",
                     url_base: str = DEFAULT_URL_BASE, bucket: str = DEFAULT_BUCKET) -> DataFrame:
    """Add ``product_id``, ``report_path`` (``hash/product/report.json``) and
    ``report_url`` (public location in ``bucket``)."""
    path = F.concat_ws("/", F.col(hash_col), product_id(), F.lit(REPORT_FILE))
    return (resolved_runs
            .withColumn("product_id", product_id())
            .withColumn("report_path", path)
            .withColumn("report_url", F.concat(F.lit(f"{url_base}{bucket}/"), path)))


def next_to_consolidate(runs: DataFrame, revisions: DataFrame, n: int = 1) -> DataFrame:
    """The newest runs not yet handled (no raw results URL) whose revision
    resolves; ``n`` per pass."""
    r = REV.resolve(runs.where(P.is_missing_str("raw_results_url")), revisions)
    return r.orderBy(F.col("created_at").desc_nulls_last(), F.col("run_id").asc()).limit(max(n, 0))


# ---- P7, J2, R9, K9: report path migration -----------------------------------

def bucket_prefix(url_base: str = DEFAULT_URL_BASE, bucket: str = DEFAULT_BUCKET) -> str:
    return f"{url_base}{bucket}/"


def in_bucket_report(url: str | Column = "raw_results_url", url_base: str = DEFAULT_URL_BASE,
                     bucket: str = DEFAULT_BUCKET) -> Column:
    """The location is in the bucket and names a ``report.json``.

    NULL for a NULL location (a filter drops it); kept bare so it is pushed
    to the scan as StringStartsWith / StringEndsWith.  Coalesce before
    negating."""
    u = F.col(url) if isinstance(url, str) else url
    return u.startswith(bucket_prefix(url_base, bucket)) & u.endswith(REPORT_FILE)


def report_path(url: str = "raw_results_url", url_base: str = DEFAULT_URL_BASE,
                bucket: str = DEFAULT_BUCKET) -> Column:
    return P.trim_prefix(url, bucket_prefix(url_base, bucket))


def migration_log_url(url: str = "raw_results_url") -> Column:
    """The sibling marker object of a report location."""
    return F.concat(P.trim_suffix(url, REPORT_FILE), F.lit(MIGRATION_LOG))


def with_migration_log(runs: DataFrame, objects: DataFrame, url_base: str = DEFAULT_URL_BASE,
                       bucket: str = DEFAULT_BUCKET, path_col: str = "path") -> DataFrame:
    """S7 + J2: eligible runs (P7) whose migration log exists in the listing.

    A left-semi equi join on the derived log location; the listing may be
    large, so Spark/AQE choose the strategy from its real size."""
    eligible = runs.where(in_bucket_report("raw_results_url", url_base, bucket)) \
        .withColumn("__log", migration_log_url())
    listing = objects.select(F.col(path_col).alias("__log"))
    return eligible.join(listing, "__log", "left_semi").drop("__log")


def new_report_path(path: Column) -> Column:
    """``_`` -> ``-``, then ``*`` -> ``_``, then space -> ``_`` (one pass:
    no later step re-maps an earlier step's output)."""
    return F.translate(path, "_* ", "-__")


def rewrite_report_paths(runs: DataFrame, objects: DataFrame, url_base: str = DEFAULT_URL_BASE,
                         bucket: str = DEFAULT_BUCKET) -> DataFrame:
    """Eligible runs with ``old_path``, ``new_path``, ``new_url`` and
    ``path_changed``.  Only rows not yet rewritten may be passed (R9 is not
    idempotent: a ``_`` made from ``*`` becomes ``-`` on a second pass)."""
    r = with_migration_log(runs, objects, url_base, bucket)
    old = report_path("raw_results_url", url_base, bucket)
    return (r.withColumn("old_path", old)
            .withColumn("new_path", new_report_path(F.col("old_path")))
            .withColumn("new_url", F.concat(F.lit(bucket_prefix(url_base, bucket)), F.col("new_path")))
            .withColumn("path_changed", F.col("old_path") != F.col("new_path")))


def _ancestor_dirs(path: Column) -> Column:
    """Every directory (with trailing ``/``) that contains ``path``."""
    parts = F.split(path, "/", -1)
    n = F.size(parts) - 1
    return F.when(n >= 1, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                                      lambda i: F.concat(F.array_join(F.slice(parts, 1, i), "/"),
                                                         F.lit("/")))) \
        .otherwise(F.array().cast("array<string>"))


def cleanup_paths(rewritten: DataFrame) -> DataFrame:
    """Old report directories to remove later, only where the path
    changed and never a directory that holds any new report path."""
    old_dirs = (rewritten.where(F.col("path_changed"))
                .select(P.trim_suffix("old_path", REPORT_FILE).alias("dir")).distinct())
    held = rewritten.select(F.explode(_ancestor_dirs(F.col("new_path"))).alias("dir")).distinct()
    return old_dirs.join(held, "dir", "left_anti")


# ---- R8: stamp run info --------------------------------------------------------

def stamp_run_info(reports: DataFrame, runs: DataFrame, key: str = "run_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """Replace the product fields of each report's ``run_info`` with its run's,
    and trim ``-experimental`` from the browser name.  The fields that are
    replaced don't go into the join; a report without ``run_info`` has none."""
    r = runs.select(key, *keep, *[F.col(c).alias(f"__run_{c}") for c in RUN_INFO_FIELDS])
    names = reports.schema["run_info"].dataType.names
    own = F.struct(F.lit(True).alias("__is"), *[F.col("run_info")[c].alias(c) for c in names if c not in RUN_INFO_FIELDS])
    j = reports.withColumn("run_info", F.when(F.col("run_info").isNotNull(), own)).join(r, key)
    fields = []
    for c in [*names, *[c for c in RUN_INFO_FIELDS if c not in names]]:
        v = F.col(f"__run_{c}") if c in RUN_INFO_FIELDS else F.col("run_info")[c]
        if c == "browser_name":
            v = P.trim_suffix(v, P.EXPERIMENTAL_SUFFIX)
        fields.append(v.alias(c))
    info = F.when(F.col("run_info").isNotNull(), F.struct(*fields))
    return j.withColumn("run_info", info).drop(*[f"__run_{c}" for c in RUN_INFO_FIELDS])


# ---- building reports ------------------------------------------------------------

def run_info(trim_experimental: bool = False, hash_col: str = "full_revision_hash") -> Column:
    """The run's product fields as a ``run_info`` struct."""
    fields = []
    for c in RUN_INFO_FIELDS:
        src = hash_col if c == "full_revision_hash" else c
        v = F.col(src)
        if c == "browser_name" and trim_experimental:
            v = P.trim_suffix(v, P.EXPERIMENTAL_SUFFIX)
        fields.append(v.alias(c))
    return F.struct(*fields)


DEFAULT_PART_SIZE = 100_000


def results_from_cells(cells: DataFrame, key: str = "run_id", part_size: int | None = None,
                       ranges: tuple[str, Column] | None = None) -> DataFrame:
    """One result per (run, test): parent status from the row with the
    highest position, subtests = non-NULL subtest rows in position order,
    ``first_pos`` = the test's lowest position.

    No group collects more than ``part_size`` subtests: the rows of a test
    are cut by ``pos div part_size`` and each cut with subtests becomes its own
    result entry (a test without subtests has one).  ``sub_base`` counts the
    subtests in earlier entries of the test, so exploding the entries gives the
    same cells in the same order for any ``part_size``.  Parent status, lowest
    position and whether there are subtests are combined per cut, and then over
    a test's cuts by windows.

    The cells are shuffled once, by run: that serves the cuts, the windows and
    the assembling of reports after them.  Cells without a run or test are left out.

    With ``ranges``, the name and value of a column that the run determines, the
    shuffle is by ranges of that column and the run, the order to store results
    in folders by it; the results have the column."""
    size = int(part_size or DEFAULT_PART_SIZE)
    sub = F.when(F.col("subtest").isNotNull(),
                 F.struct(F.col("pos"), F.struct(F.col("subtest").alias("name"),
                                                 F.col("sub_status").alias("status")).alias("s")))
    last = F.when(F.col("pos").isNotNull(), F.struct("pos", "status"))
    cut = F.expr(f"pos div {size}").alias("__cut")
    mine = cells.where(F.col(key).isNotNull() & F.col("test").isNotNull())
    run = [key] if ranges is None else [ranges[0], key]
    mine = mine.repartition(key) if ranges is None else mine.withColumn(*ranges).repartitionByRange(*run)
    g = mine.groupBy(*run, "test", cut).agg(F.array_sort(F.collect_list(sub)).alias("__subs"), F.max(last).alias("__last"), F.min("pos").alias("__first"))
    whole = Window.partitionBy(*run, "test").orderBy("__cut").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.partitionBy(*run, "test").orderBy("__cut").rowsBetween(Window.unboundedPreceding, -1)
    n = F.size("__subs")
    j = g.select(*run, "test", "__cut", "__subs", F.max("__last").over(whole)["status"].alias("status"), F.min("__first").over(whole).alias("first_pos"),
                 F.max(n > 0).over(whole).alias("__has"), F.coalesce(F.sum(n).over(before), F.lit(0)).cast("bigint").alias("sub_base"))
    j = j.where(F.when(F.col("__has"), F.size("__subs") > 0).otherwise(F.col("__cut") == F.expr(f"first_pos div {size}")))
    return j.select(key, "test", "status", "first_pos", F.transform("__subs", lambda x: x["s"]).alias("subtests"), "sub_base", *run[:-1])


def assemble_reports(results: DataFrame, runs: DataFrame, key: str = "run_id",
                     info: Column | None = None, how: str = "inner",
                     part_size: int = DEFAULT_PART_SIZE, keep: tuple[str, ...] = ()) -> DataFrame:
    """Results of each run, ordered by ``first_pos``, as report documents
    with the run's ``run_info``.

    A run's report is split into parts: ``part = first_pos div part_size``, and
    within it one document per ``sub_base div part_size``, so no row - and no
    aggregation group - grows with a run or with a test's subtests.  Entries
    carry ``first_pos`` and ``sub_base``, which order them across documents."""
    base = F.col("sub_base") if "sub_base" in results.columns else F.lit(0).cast("bigint")
    results = results.withColumn("sub_base", base)
    res = F.struct("first_pos", "sub_base", "test", "status", "subtests")
    part = F.expr(f"first_pos div {int(part_size)}").cast("bigint").alias("part")
    piece = F.expr(f"sub_base div {int(part_size)}").cast("bigint").alias("__piece")
    per_part = (results.groupBy(key, part, piece)
                .agg(F.array_sort(F.collect_list(res)).alias("__r"))
                .select(key, "part", F.transform("__r", lambda x: F.struct(
                    x["test"].alias("test"), x["status"].alias("status"), x["subtests"].alias("subtests"),
                    x["first_pos"].alias("first_pos"), x["sub_base"].alias("sub_base"))).alias("results")))
    r = runs.select(key, (info if info is not None else run_info()).alias("run_info"), *keep)
    out = r.join(per_part, key, how)
    return (out.withColumn("part", F.coalesce("part", F.lit(0).cast("bigint")))
            .withColumn("results", F.coalesce(
                "results", F.array().cast("array<struct<test:string,status:string,"
                                          "subtests:array<struct<name:string,status:string>>,"
                                          "first_pos:bigint,sub_base:bigint>>"))))


def result_counts(reports: DataFrame) -> DataFrame:
    """Documents with the numbers of their tests and subtests in place of their
    results (a test's later entries, which go on with its subtests, don't count)."""
    n_sub = F.aggregate("results", F.lit(0).cast("bigint"),
                        lambda acc, r: acc + F.size(F.coalesce(r["subtests"], F.array())))
    cut_up = "sub_base" in reports.schema["results"].dataType.elementType.names
    tests = F.size(F.filter("results", lambda r: F.coalesce(r["sub_base"], F.lit(0)) == 0)) if cut_up else F.size("results")
    return reports.withColumn("results", F.struct(tests.cast("bigint").alias("n_results"), n_sub.alias("n_subtests")))


def report_sizes(reports: DataFrame, key: str = "run_id", by: tuple[str, ...] = ()) -> DataFrame:
    """Per run: number of tests and of subtests over all its documents, which
    may be counted already (``result_counts``)."""
    if isinstance(reports.schema["results"].dataType, T.ArrayType):
        reports = result_counts(reports)
    return (reports.groupBy(key, *by)
            .agg(F.sum("results.n_results").cast("bigint").alias("n_results"),
                 F.sum("results.n_subtests").cast("bigint").alias("n_subtests")))


def run_bucket(key: str = "run_id", buckets: int = 64) -> Column:
    """Hash bucket of a run key, used as the partition column of shard
    tables so lookups for a few runs read only their buckets."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def shards_for(shards: DataFrame, runs: DataFrame, key: str = "run_id",
               buckets: int | None = None) -> DataFrame:
    """Only the shards of ``runs``.  When the shard table is partitioned by
    ``run_bucket`` the semi join also carries the bucket, so a small run set
    prunes whole bucket folders at run time (dynamic partition pruning)."""
    keys = runs.select(key)
    if buckets and "run_bucket" in shards.columns:
        keys = keys.withColumn("run_bucket", run_bucket(key, buckets))
        return shards.join(keys, ["run_bucket", key], "left_semi")
    return shards.join(keys, key, "left_semi")


def consolidate(shards: DataFrame, runs: DataFrame, revisions: DataFrame,
                url_base: str = DEFAULT_URL_BASE, bucket: str = DEFAULT_BUCKET,
                shard_buckets: int | None = None) -> DataFrame:
    """S5 + A2 + R11: for every run not yet handled (no raw results URL) whose
    revision resolves, gather its shard results into a report stamped with
    the full hash and the browser name without ``-experimental``, and the
    location it is written to.

    ``shards`` has one row per shard result: ``run_id, test, status,
    subtests, first_pos`` (and ``run_bucket`` when bucketed).  Only the
    shards of the runs being handled are read and grouped.  A run without any
    shard is left for a later pass: no report is written for it."""
    todo = REV.resolve(runs.where(P.is_missing_str("raw_results_url")), revisions)
    return consolidate_resolved(shards, todo, url_base, bucket, shard_buckets)


def consolidate_resolved(shards: DataFrame, resolved_runs: DataFrame, url_base: str = DEFAULT_URL_BASE, bucket: str = DEFAULT_BUCKET,
                         shard_buckets: int | None = None) -> DataFrame:
    """The second half of ``consolidate``, for runs that carry their ``resolved_hash``."""
    todo = report_locations(resolved_runs, url_base=url_base, bucket=bucket)
    mine = shards_for(shards, todo, buckets=shard_buckets)
    info = run_info(trim_experimental=True, hash_col="resolved_hash")
    placed = ("report_path", "report_url", "resolved_hash")
    return assemble_reports(mine, todo, info=info, keep=placed)


def mark_consolidated(runs: DataFrame, consolidated: DataFrame) -> DataFrame:
    """The run-table update after consolidation: new raw results URL and the
    resolved full hash, where either differs (P17)."""
    upd = consolidated.select("run_id", F.col("report_url").alias("__url"),
                              F.col("resolved_hash").alias("__hash"))
    j = runs.join(upd, "run_id", "left")
    has = F.col("__url").isNotNull()
    return (j.withColumn("raw_results_url", F.when(has, F.col("__url")).otherwise(F.col("raw_results_url")))
            .withColumn("full_revision_hash",
                        F.when(has, F.col("__hash")).otherwise(F.col("full_revision_hash")))
            .drop("__url", "__hash"))


def migrate_reports(runs: DataFrame, reports: DataFrame, objects: DataFrame,
                    url_base: str = DEFAULT_URL_BASE, bucket: str = DEFAULT_BUCKET
                    ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """R8 + R9 + K3 + K9 together: for runs whose report is in the bucket and
    already has a migration log (P7, J2) *and* whose report could be read,
    returns

    * the stamped reports with their new ``location`` (to write, K3),
    * the run table with ``raw_results_url`` moved to the new location,
    * the old folders to remove later (K9, D6).

    Runs whose report is missing keep their URL, as a failed read stops that
    run before anything is updated."""
    rw = rewrite_report_paths(runs, objects, url_base, bucket)
    rw = rw.join(reports.select("run_id"), "run_id", "left_semi")
    # the rewritten rows carry the run's fields, so one join stamps and places the reports
    new_reports = stamp_run_info(reports, rw, keep=("new_url",)).withColumnRenamed("new_url", "location")
    moved = rw.select("run_id", F.col("new_url").alias("__new"))
    new_runs = (runs.join(moved, "run_id", "left")
                .withColumn("raw_results_url", F.coalesce(F.col("__new"), F.col("raw_results_url")))
                .drop("__new"))
    return new_reports, new_runs, cleanup_paths(rw)
