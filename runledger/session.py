"""Session construction and the shared scratch location.

Derived tables (reports, wide cells, snapshots, versioned run tables) are
written under the folder named by ``spark.checkpoint.dir``: on a cluster this
is shared storage the cluster configures, so written tables and checkpoints
survive the loss of any executor.  Only when the setting is absent on a
``local`` master (tests) do we pick a folder of our own; any other master
without the setting is refused, as a machine's own folder is not shared.
Tables go below the folder as it is named, not below the folder that Spark
adds for each application, so a restarted application finds them.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "runledger", extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every operator assumes.

    * UTC session zone: row keys and RFC 3339 text are defined in UTC.
    * AQE on, with partition coalescing and skew-join splitting: hot keys
      in joins are split at run time instead of landing in one task.
    * UI off: no server is started.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder as it is named; set a local one only if unset."""
    current = spark.conf.get(_CKPT_KEY, None)
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not current and jdir.isDefined():
        # set by setCheckpointDir, which adds a folder per application
        current = jdir.get().rsplit("/", 1)[0]
        spark.conf.set(_CKPT_KEY, current)
    if not current:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all of {master} shares")
        current = tempfile.mkdtemp(prefix="runledger-ckpt-")
        spark.conf.set(_CKPT_KEY, current)
    if not jdir.isDefined():
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_dir(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (not created)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    if "://" not in base and not base.startswith("file:"):
        base = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base).getFileSystem(
            spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)).toString()
    return "/".join([base, "runledger", *parts])


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused path under the scratch folder (never reused or cleared)."""
    return scratch_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """For a write: its shuffle files go when it is done, not whenever the
    driver's memory is next collected, so those of several writes don't add up."""
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREE_SHUFFLES) if before is None else spark.conf.set(_FREE_SHUFFLES, before)
