"""Proxy tables derived from the driver's TPC-H-style parquet tables.

The test data holds no test runs, so ``runs``, ``cells``, ``revisions`` and
``objects`` are derived from ``orders``, ``lineitem`` and ``part`` (FIXTURES.md
§2).  The derivations (``build_*``) are plain projections and one per-order
window, so they scale with the base tables.

Operators read them the way a deployment reads its entity tables: as stored
Parquet (written once under the shared scratch folder by ``runs()`` etc.),
so filters on stored columns reach the scan as pushed filters and the
derivation is not recomputed inside every query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(expr: Column, mapping: list[tuple[object, object]], default: object = None) -> Column:
    out = None
    for k, v in mapping:
        cond = expr == F.lit(k)
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    return out.otherwise(F.lit(default)) if default is not None else out


def _sha_of_customer(custkey: Column) -> Column:
    return F.sha1(custkey.cast("string").cast("binary"))


# Fixed values of the proxy `runs` view (FIXTURES.md §2): browser by key mod 8,
# version by customer mod 6, OS by order status, OS version by priority digit,
# labels by key mod 5.
_BROWSERS = [(0, "chrome"), (1, "firefox"), (2, "safari"), (3, "edge"),
             (4, "chrome-experimental"), (5, "firefox-experimental"), (6, "unknown-bot")]
_VERSIONS = [(0, "62.0"), (1, "63.0 dev"), (2, "64.0 beta"), (3, "59.0a1"), (4, "58.0b1")]
_OSES = [("F", "linux"), ("O", "windows_x")]
_OS_VERSIONS = [("1", ""), ("2", "*"), ("3", "10"), ("4", "3.16")]
_LABELS = [(0, "azure"), (1, "taskcluster,stable"), (2, "buildbot,chrome"), (3, "master,experimental")]
URL_BASE = "https://storage.example/"
RESULTS_BUCKET = "results"


def _stored(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    from runledger.sources.materialize import materialize
    return spark.read.parquet(materialize(spark, sf_dir, f"proxy_{name}", build))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored run table, in files hash-partitioned by run_id."""
    return _stored(spark, sf_dir, "runs",
                   lambda: build_runs(spark, sf_dir, dealt=True).sortWithinPartitions("run_id"))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored cell table, sorted by (run_id, pos) within files."""
    return _stored(spark, sf_dir, "cells",
                   lambda: build_cells(spark, sf_dir).sortWithinPartitions("run_id", "pos"))


def revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored mainline revision table."""
    return _stored(spark, sf_dir, "revisions", lambda: build_revisions(spark, sf_dir))


def objects(spark: SparkSession, sf_dir: str, runs_df: DataFrame | None = None) -> DataFrame:
    """The stored object listing (migration logs that exist)."""
    return _stored(spark, sf_dir, "objects", lambda: build_objects(spark, sf_dir))


def build_runs(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """One row per test run (FIXTURES.md §1 schema); with ``dealt``, dealt out by
    run_id while the rows are still short."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    if dealt:
        o = o.repartition("o_orderkey")
    k = F.col("o_orderkey")
    b = o.select(
        k.alias("run_id"),
        F.col("o_orderdate"),
        k.alias("k"),
        _case((k % 8).cast("int"), _BROWSERS, "chrome").alias("browser_name"),
        _case((F.col("o_custkey") % 6).cast("int"), _VERSIONS, "11.1 preview").alias("browser_version"),
        _case(F.col("o_orderstatus"), _OSES, "mac").alias("os_name"),
        _case(F.substring("o_orderpriority", 1, 1), _OS_VERSIONS, "10.13").alias("os_version"),
        _sha_of_customer(F.col("o_custkey")).alias("sha"),
        _case((k % 5).cast("int"), _LABELS).alias("lab"),
    )
    k = F.col("k")
    sha = F.col("sha")
    d = F.col("o_orderdate")
    raw_url = (
        F.when(k % 11 == 0, F.lit(""))
        .when(k % 13 == 0, F.lit("https://other.example/x/report.json"))
        .when(k % 17 == 0, F.concat(F.lit(URL_BASE + RESULTS_BUCKET + "/"), F.substring(sha, 1, 10),
                                    F.lit("/summary.json")))
        .otherwise(F.concat(
            F.lit(URL_BASE + RESULTS_BUCKET + "/"), F.substring(sha, 1, 10), F.lit("/"),
            F.col("browser_name"), F.lit("-"), F.col("browser_version"),
            F.when(k % 5 == 0, F.lit("-")).otherwise(F.lit("_")),
            F.col("os_name"), F.lit("-"), F.col("os_version"), F.lit("/report.json")))
    )
    minutes = (k % 4).cast("int")
    time_end = (F.when(minutes == 0, d + F.expr("INTERVAL 10 MINUTES"))
                .when(minutes == 1, d + F.expr("INTERVAL 5 MINUTES"))
                .when(minutes == 2, d + F.expr("INTERVAL 45 MINUTES"))
                .otherwise(d + F.expr("INTERVAL 11 MINUTES")))
    return b.select(
        "run_id", "browser_name", "browser_version", "os_name", "os_version",
        F.when(k % 3 == 0, sha).otherwise(F.substring(sha, 1, 10)).alias("revision"),
        F.when(k % 4 == 0, F.lit("")).otherwise(sha).alias("full_revision_hash"),
        raw_url.alias("raw_results_url"),
        d.alias("created_at"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(d).alias("time_start"),
        time_end.alias("time_end"),
        F.split(F.col("lab"), ",").alias("labels"),
    )


def _is_broadcast(spark: SparkSession, df: DataFrame) -> bool:
    """Whether Spark would broadcast a table in a join, by its own estimate."""
    most = int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= most


def build_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exploded results: run_id, test, subtest, status, sub_status, pos."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    if _is_broadcast(spark, part):
        # the rows go to their run's task while they are short, and get their texts there
        li = li.repartition("l_orderkey")
    # The in-report order: a window partitioned by run, so each run's rows are
    # numbered inside one task of a hash-partitioned stage (no global sort).
    w = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
        "l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax")
    j = li.join(part, li.l_partkey == part.p_partkey)
    ln = F.col("l_linenumber")
    return j.select(
        F.col("l_orderkey").alias("run_id"),
        F.concat(F.lit("/"), F.lower("p_type"), F.lit("/"), F.replace("p_name", F.lit(" "), F.lit("/")),
                 F.lit(".html")).alias("test"),
        F.when(ln <= 2, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("s"), ln.cast("string"))).alias("subtest"),
        _case(F.col("l_returnflag"), [("A", "OK"), ("N", "ERROR")], "TIMEOUT").alias("status"),
        F.when(ln <= 2, F.lit(None).cast("string"))
        .when(F.col("l_linestatus") == "F", F.lit("FAIL")).otherwise(F.lit("PASS")).alias("sub_status"),
        F.row_number().over(w).cast("bigint").alias("pos"),
    )


def build_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mainline commit ids, one full sha per row."""
    o = read_table(spark, sf_dir, "orders").select("o_custkey")
    return (o.where((F.col("o_custkey") % 4) != 0)
            .select(_sha_of_customer(F.col("o_custkey")).alias("sha"))
            .distinct())


def build_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object-store listing: the migration logs that exist."""
    r = runs(spark, sf_dir)
    return (r.where(F.col("raw_results_url").like("%report.json") & (F.col("run_id") % 2 == 0))
            .select(F.replace("raw_results_url", F.lit("report.json"), F.lit("migration.log")).alias("path"))
            .distinct())
