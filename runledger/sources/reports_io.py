"""Report documents: read with an explicit schema, write as (gzip) JSON.

Reports are stored as JSON lines, one document per line, each carrying the
key of the run it belongs to - many documents per file, so a load of millions
of runs is a few large splittable reads, not millions of tiny requests.
Reading never infers a schema (that would scan everything twice) and never
fails a job on a bad document: malformed lines land in a quarantine frame
(``_corrupt_record``), empty reports are dropped from the good frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runledger.session import freed_shuffles

SUBTEST = T.StructType([T.StructField("name", T.StringType()), T.StructField("status", T.StringType())])
RESULT = T.StructType([
    T.StructField("test", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("subtests", T.ArrayType(SUBTEST)),
    # Written by our own reports: where the entry stands in the run's report.
    T.StructField("first_pos", T.LongType()),
    T.StructField("sub_base", T.LongType()),
])
RUN_INFO = T.StructType([T.StructField(c, T.StringType()) for c in (
    "browser_name", "browser_version", "os_name", "os_version", "revision", "full_revision_hash")])
REPORT = T.StructType([
    T.StructField("run_id", T.LongType()),
    # Report part (0 when a run's report is a single document).
    T.StructField("part", T.LongType()),
    T.StructField("run_info", RUN_INFO),
    T.StructField("results", T.ArrayType(RESULT)),
])
CORRUPT = "_corrupt_record"


def write_reports(reports: DataFrame, path: str, compression: str | None = None) -> str:
    """K3/K4: JSON lines (``compression='gzip'`` for K4).  Never overwrites."""
    w = reports.write.mode("errorifexists")
    if compression:
        w = w.option("compression", compression)
    with freed_shuffles(reports.sparkSession):
        w.json(path)
    return path


def read_reports(spark: SparkSession, path: str | list[str], schema: T.StructType = REPORT
                 ) -> tuple[DataFrame, DataFrame]:
    """S3: ``(good, quarantine)``.  ``good`` holds parsed documents with at
    least one result; ``quarantine`` holds malformed lines with their source
    file.  Pass ``multiLine=True`` style single-document files through
    ``read_documents`` instead."""
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    raw = (spark.read.schema(full)
           .option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", CORRUPT)
           .json(path)
           .withColumn("source_file", F.input_file_name()))
    ok = F.col(CORRUPT).isNull() & F.col("run_id").isNotNull()
    good = (raw.where(ok & (F.size(F.coalesce("results", F.array())) > 0)).drop(CORRUPT)
            .withColumn("part", F.coalesce("part", F.lit(0).cast("bigint"))))
    bad = raw.where(~ok).select("source_file", F.col(CORRUPT).alias("raw"))
    return good, bad


def read_own(spark: SparkSession, path: str | list[str], schema: T.StructType | str = REPORT) -> DataFrame:
    """Documents that this library wrote: one that doesn't parse fails the job
    instead of getting lost."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def join_by_location(runs: DataFrame, reports: DataFrame, how: str = "inner", url: str = "raw_results_url",
                     location: str = "location") -> DataFrame:
    """J5 by location: runs with the report stored at their results URL.

    Both sides are compared without scheme, query and fragment, host in lower
    case; a run without a URL matches nothing.  Several runs may share a URL."""
    def place(c: str):
        bare = F.regexp_replace(F.regexp_replace(F.col(c), r"[?#].*\z", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
        host = F.lower(F.substring_index(bare, "/", 1))
        return F.when(F.col(c) != "", F.concat(host, F.regexp_replace(bare, "^[^/]*", "")))
    rep = reports.select(place(location).alias("__at"), F.col("run_info").alias("report_run_info"), "part", "results")
    return runs.withColumn("__at", place(url)).join(rep, "__at", how).drop("__at")


def read_documents(spark: SparkSession, path: str | list[str], schema: T.StructType = REPORT
                   ) -> DataFrame:
    """One (possibly multi-line) JSON document per file, e.g. one report per
    object; the run key may come from the path via ``source_file``."""
    return (spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE")
            .json(path).withColumn("source_file", F.input_file_name()))


def join_reports(runs: DataFrame, reports: DataFrame, how: str = "inner", key: str = "run_id"
                 ) -> DataFrame:
    """J5 (S3 inner / S4 left): runs with their parsed report; with ``left``
    a run whose report is missing, unreadable or empty keeps its row."""
    rep = reports.select(key, "part", F.col("run_info").alias("report_run_info"), "results")
    return runs.join(rep, key, how)


SHARD = T.StructType([
    T.StructField("test", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("subtests", T.ArrayType(SUBTEST)),
])


def read_shard_files(spark: SparkSession, root: str, run_id_pattern: str = r"/([0-9]+)/[^/]+$",
                     schema: T.StructType = SHARD) -> tuple[DataFrame, DataFrame]:
    """S5 input as one small JSON document per test result, in a folder per
    run (``<root>/<run_id>/<anything>.json``): ``(good, quarantine)``.  The run
    key comes from the path.  Files are listed and parsed in parallel.
    ``source_file`` is kept so the caller can give each result its ``first_pos``
    (e.g. file order) before ``reports.assemble_reports``; a caller that must
    not go on without a result checks that the quarantine is empty."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    docs = (spark.read.schema(full).option("multiLine", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("recursiveFileLookup", "true").json(root)
            .withColumn("source_file", F.input_file_name()))
    docs = docs.withColumn("run_id", F.regexp_extract("source_file", run_id_pattern, 1).try_cast("bigint"))
    ok = F.col(CORRUPT).isNull() & F.col("run_id").isNotNull() & F.col("test").isNotNull()
    return (docs.where(ok).select("run_id", "test", "status", "subtests", "source_file"),
            docs.where(~ok).select("source_file", F.col(CORRUPT).alias("raw")))
