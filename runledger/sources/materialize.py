"""Derived tables written once under the shared scratch folder.

A derived table (stored proxy tables, reports JSON, shards, wide cells,
dictionaries) lives under ``<spark.checkpoint.dir>/runledger/tables/<source-id>/<name>``.
The source id covers the qualified source path, the names, sizes and times of
its files and the version of the derivations, so a source that has changed, or
a changed derivation, is derived anew:

* each build writes a fresh ``data-<id>`` folder (never overwriting anything
  a reader may hold open);
* after the job has committed, a small ``_CURRENT`` marker naming that folder
  is written; readers follow the marker.

A build that dies half way leaves an unreferenced folder and no marker, so it
is never read.  The marker is written through Hadoop's FileSystem, so any
shared store the checkpoint folder lives on works.  (``_SUCCESS`` is not used
as the signal: partitioned writes under dynamic partition overwrite do not
leave one at the root.)
"""

from __future__ import annotations

import hashlib
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from runledger.session import freed_shuffles, scratch_dir

MARKER = "_CURRENT"


#: Raise when a derivation changes what it writes.
BUILD_VERSION = 3


def source_id(spark: SparkSession, source: str) -> str:
    """Hash of a source folder's qualified path, its files' names, sizes and times, and BUILD_VERSION."""
    p, fs = _fs(spark, source)
    p = fs.makeQualified(p)
    parts = [p.toString(), str(BUILD_VERSION)]
    files = fs.listFiles(p, True) if fs.exists(p) else None
    listed = []
    while files is not None and files.hasNext():
        f = files.next()
        listed.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha1("\n".join([*parts, *sorted(listed)]).encode()).hexdigest()[:16]


def table_path(spark: SparkSession, source: str, name: str) -> str:
    return scratch_dir(spark, "tables", source_id(spark, source), name)


#: Bytes of (packed) source files for which a shuffle starts with one more partition.
SHUFFLE_BYTES = 2 << 20
_FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: Bytes of (packed) shuffled rows of a task: rows of text unpack to many times that, in several sorts of a stage.
TASK_BYTES, _TASK_BYTES = 8 << 20, "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def deal_by_size(spark: SparkSession, source: str) -> int:
    """Let shuffles start with partitions in proportion to the source folder, at
    least the session's number, so that a task's sorts fit in memory however large
    the source is; adaptive execution joins small ones up to TASK_BYTES."""
    p, fs = _fs(spark, source)
    # a table may be a file or a folder of files
    size = fs.getContentSummary(p).getLength() if fs.exists(p) else 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // SHUFFLE_BYTES)
    spark.conf.set(_FIRST_PARTITIONS, str(n))
    spark.conf.set(_TASK_BYTES, str(TASK_BYTES))
    return n


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def write_marker(spark: SparkSession, path: str, text: str) -> None:
    """Write ``text`` to ``path`` (replacing it) through Hadoop's FileSystem."""
    p, fs = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_marker(spark: SparkSession, path: str) -> str | None:
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip() or None
    finally:
        stream.close()


def current(spark: SparkSession, path: str) -> str | None:
    """The committed data folder of a derived table, if any."""
    name = read_marker(spark, f"{path}/{MARKER}")
    return f"{path}/{name}" if name else None


def exists(spark: SparkSession, path: str) -> bool:
    return current(spark, path) is not None


def materialize(spark: SparkSession, source: str, name: str, build: Callable[[], DataFrame],
                fmt: str = "parquet", options: dict | None = None,
                partition_by: list[str] | None = None) -> str:
    """Write ``build()`` once as ``fmt``; return the committed data folder."""
    path = table_path(spark, source, name)
    got = current(spark, path)
    if got:
        return got
    data = f"data-{uuid.uuid4().hex[:12]}"
    w = build().write.mode("errorifexists").format(fmt)
    for k, v in (options or ({"compression": "zstd"} if fmt == "parquet" else {})).items():
        w = w.option(k, v)
    if partition_by:
        w = w.partitionBy(*partition_by)
    with freed_shuffles(spark):
        w.save(f"{path}/{data}")
    write_marker(spark, f"{path}/{MARKER}", data)
    return f"{path}/{data}"
