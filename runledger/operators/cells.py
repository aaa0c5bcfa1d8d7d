"""The run x test result matrix.

The matrix is kept long - one row per cell - which is the only layout whose
rows stay small whatever the data size.  Maps are built only at export time
(A6/A7) and are split into chunks of at most ``chunk_size`` entries, so a
test present in every run never becomes one giant row.

Shuffles, in order of a full load: last write wins per cell (hash on the cell
key, partial aggregation first), first-seen per dictionary entry (hash on the
entry), the dictionary's range sort (dense ids), and the id lookup join.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.functions import predicates as P
from runledger.operators.numbering import dense_ids
from runledger.session import fresh_dir

UNKNOWN_STATUS = "UNKNOWN"
DEFAULT_FAMILY = "tests"
DEFAULT_CHUNK = 100_000

CELL_KEY = ("run_id", "test", "subtest")


def normalize_status(c: str | Column, known: Sequence[str] | None = None) -> Column:
    """the trimmed upper-case status (NULL stays NULL).  With ``known``,
    the status words of a deployment, any other becomes UNKNOWN; without it
    every status is kept."""
    col = F.col(c) if isinstance(c, str) else c
    u = F.upper(F.trim(col))
    if known is None:
        return u
    return F.when(col.isNull(), F.lit(None).cast("string")).when(u.isin(list(known)), u).otherwise(F.lit(UNKNOWN_STATUS))


# ---- R14/R15: reports -> cells ---------------------------------------------------

def _subtests(r: Column) -> Column:
    return F.coalesce(r["subtests"], F.array().cast("array<struct<name:string,status:string>>"))


def _part(reports: DataFrame) -> Column:
    return F.coalesce(F.col("part"), F.lit(0).cast("bigint")) if "part" in reports.columns \
        else F.lit(0).cast("bigint")


def _has_field(reports: DataFrame, name: str) -> bool:
    return name in reports.schema["results"].dataType.elementType.names


def _entries(reports: DataFrame, key: str) -> DataFrame:
    """One row per result entry ``r`` with its place in the run's report.

    Our own reports say where an entry belongs: ``first_pos`` orders the tests
    of a run and ``sub_base`` is the number of subtests in earlier entries of
    the same test, so the place doesn't depend on how a report was cut.  Other
    reports are ordered by part and position in the document."""
    res = reports.select(key, _part(reports).alias("part"), F.posexplode("results").alias("result_pos", "r"))
    pos = F.col("r")["first_pos"] if _has_field(reports, "first_pos") else F.lit(None).cast("bigint")
    base = F.col("r")["sub_base"] if _has_field(reports, "sub_base") else F.lit(None).cast("bigint")
    return res.select(
        key, F.when(pos.isNull(), F.col("part")).otherwise(F.lit(0)).cast("bigint").alias("part"),
        F.col("result_pos").cast("bigint").alias("result_pos"),
        F.coalesce(pos, F.col("result_pos").cast("bigint")).alias("entry"),
        F.coalesce(base, F.lit(0)).cast("bigint").alias("sub_base"), "r")


def explode_matrix(reports: DataFrame, key: str = "run_id") -> DataFrame:
    """One cell for every result and one for each of its subtests; a
    subtest cell carries the parent status.  ``(part, entry, sub_pos)`` is the
    in-report order (``sub_pos`` NULL for the result's own cell) and doesn't
    depend on how the report was cut; ``result_pos`` is the place in the
    document.

    One generator over a per-result array (not a union of two explodes), so
    the reports are scanned once."""
    r = F.col("r")
    base = F.struct(r["test"].alias("test"), F.lit(None).cast("string").alias("subtest"),
                    r["status"].alias("status"), F.lit(None).cast("string").alias("sub_status"),
                    F.lit(None).cast("int").alias("sub_pos"))
    subs = F.transform(_subtests(r), lambda s, j: F.struct(
        r["test"].alias("test"), s["name"].alias("subtest"), r["status"].alias("status"),
        s["status"].alias("sub_status"), (F.col("sub_base") + j).cast("int").alias("sub_pos")))
    # only a test's first entry stands for the result itself
    own = F.when(F.col("sub_base") == 0, F.array(base)).otherwise(F.slice(F.array(base), 1, 0))
    return _entries(reports, key).select(key, "part", "entry", "result_pos", F.inline(F.concat(own, subs)))


def cell_id(test: Column, sub: Column | None) -> Column:
    """``test[#subtest]``."""
    return test if sub is None else F.concat(test, F.lit("#"), F.coalesce(sub, F.lit("")))


def cell_value(status: Column, sub_status: Column | None) -> Column:
    """``status[#sub_status]`` (missing parts are empty text)."""
    st = F.coalesce(status, F.lit(""))
    return st if sub_status is None else F.concat(st, F.lit("#"), F.coalesce(sub_status, F.lit("")))


def explode_wide(reports: DataFrame, key: str = "run_id") -> DataFrame:
    """Subtests if any, else the result itself -> (qualifier, value)."""
    r = F.col("r")
    subs = _subtests(r)
    per_sub = F.transform(subs, lambda s, j: F.struct(
        cell_id(r["test"], s["name"]).alias("qualifier"),
        cell_value(r["status"], s["status"]).alias("value"),
        (F.col("sub_base") + j).cast("int").alias("sub_pos")))
    single = F.array(F.struct(cell_id(r["test"], None).alias("qualifier"),
                              cell_value(r["status"], None).alias("value"),
                              F.lit(0).alias("sub_pos")))
    return _entries(reports, key).select(key, "part", "entry", "result_pos",
                                         F.inline(F.when(F.size(subs) > 0, per_sub).otherwise(single)))


def row_key() -> Column:
    """``browser-version-os-osversion@fullhash#created_at`` (UTC, seconds;
    the OS version is always kept)."""
    def s(c):
        return F.coalesce(F.col(c), F.lit(""))
    return F.concat(s("browser_name"), F.lit("-"), s("browser_version"), F.lit("-"), s("os_name"),
                    F.lit("-"), s("os_version"), F.lit("@"), s("full_revision_hash"), F.lit("#"),
                    F.coalesce(P.rfc3339_utc("created_at"), F.lit("")))


def wide_cells(reports: DataFrame, runs: DataFrame, family: str = DEFAULT_FAMILY,
               load_ts: Column | None = None) -> DataFrame:
    """K8 input: cells keyed by (row_key, family, qualifier) with the order
    columns a last-write merge needs.  Runs sharing a row key (same product,
    hash and second) merge; later (created_at, run_id, position) wins."""
    r = runs.select("run_id", row_key().alias("row_key"), "created_at")
    # whole documents meet the runs, not their cells
    cells = explode_wide(reports.join(r, "run_id").withColumn("run", F.struct("row_key", "created_at", "run_id")), "run")
    return cells.select("run.row_key", F.lit(family).alias("family"), "qualifier", "value",
                        (load_ts if load_ts is not None else F.current_timestamp()).alias("ts"),
                        "run.created_at", "run.run_id", "part", F.col("entry").alias("result_pos"), "sub_pos")


def merge_wide(cells: DataFrame) -> DataFrame:
    """K8: last write wins per (row_key, family, qualifier), ordered by
    (ts, created_at, run_id, part, result_pos, sub_pos)."""
    order = F.struct("ts", "created_at", "run_id", "part", "result_pos", "sub_pos")
    return (cells.groupBy("row_key", "family", "qualifier")
            .agg(F.max_by(F.struct("value", "ts"), order).alias("w"))
            .select("row_key", "family", "qualifier", F.col("w.value").alias("value"),
                    F.col("w.ts").alias("ts")))


def in_key_order(cells: DataFrame, partitions: int | None = None) -> DataFrame:
    """Cells dealt out by ranges of (row_key, qualifier).  A merge needs no other
    shuffle after it, and leaves its rows in the ranges they are stored in."""
    return cells.repartitionByRange(*([partitions] if partitions else []), "row_key", "qualifier")


def upsert_wide(table: DataFrame, new_cells: DataFrame) -> DataFrame:
    """K8 upsert: existing merged table + newly exploded cells, last write wins
    (a newer load timestamp beats anything older)."""
    old = table.select("row_key", "family", "qualifier", "value", "ts",
                       F.lit(None).cast("timestamp_ntz").alias("created_at"),
                       F.lit(None).cast("bigint").alias("run_id"),
                       F.lit(None).cast("bigint").alias("part"),
                       F.lit(None).cast("bigint").alias("result_pos"),
                       F.lit(None).cast("int").alias("sub_pos"))
    return merge_wide(in_key_order(old.unionByName(new_cells.select(*old.columns))))


# ---- A5, A8: last write ----------------------------------------------------------

def last_write(cells: DataFrame, keys: Sequence[str] = CELL_KEY, order: str | Column = "pos",
               values: Sequence[str] = ("status", "sub_status")) -> DataFrame:
    """A5: per key, the values of the row with the highest ``order``."""
    o = F.col(order) if isinstance(order, str) else order
    return (cells.groupBy(*keys)
            .agg(F.max_by(F.struct(*values), o).alias("__w"))
            .select(*keys, *[F.col(f"__w.{v}").alias(v) for v in values]))


def last_write_encoded(encoded: DataFrame) -> DataFrame:
    """A5 of ``encode_cells``: a run's dictionary id stands for its ``run_id``, by
    which the encoding has dealt the cells out, so naming both needs no shuffle."""
    return last_write(encoded, ("run_id", "run_idx", "test_id")).drop("run_id")


def last_subtest_status(cells: DataFrame) -> DataFrame:
    """A8 (the literal parent-overwrite behaviour): per (run, test), the
    status pair written last - a result's last subtest overwrites it."""
    return last_write(cells, ("run_id", "test"), "pos")


# ---- A3, A4, J6: dictionaries --------------------------------------------------

def first_seen_key(run_idx: Column, pos: Column) -> Column:
    """(run order, in-report position) as one DECIMAL(38,0), which holds two
    non-negative BIGINTs.  One value keeps the first-seen aggregate a hash
    aggregate with map-side combine (a struct minimum would be sort-based)."""
    return (run_idx.cast("decimal(19,0)") * F.lit(10 ** 18).cast("decimal(19,0)") * F.lit(10) + pos.cast("decimal(19,0)")).cast("decimal(38,0)")


def test_dictionary(cells: DataFrame, runs: DataFrame | None = None,
                    run_index: DataFrame | None = None) -> DataFrame:
    """A3: distinct (test, subtest) -> dense id in first-seen order: runs
    oldest first (created_at, run_id) - i.e. by run dictionary id - then
    position in the report.  Pass ``run_index`` (A4 output) to reuse it."""
    if run_index is None:
        run_index = run_dictionary(runs.select("run_id", "created_at"))
    ri = run_index.select(F.col("id").alias("__run_idx"), "run_id")
    seen = cells.select("run_id", "test", "subtest", "pos").join(ri, "run_id")
    first = (seen.groupBy("test", "subtest")
             .agg(F.min(first_seen_key(F.col("__run_idx"), F.col("pos"))).alias("__first")))
    return dense_ids(first, [F.col("__first").asc()], "id").select("id", "test", "subtest")


def extend_dictionary(existing: DataFrame, cells: DataFrame, runs: DataFrame) -> DataFrame:
    """Incremental A3: keep every existing id; number only unseen
    (test, subtest) pairs, from max(id) + 1, in first-seen order."""
    fresh = test_dictionary(
        cells.join(existing.select("test", "subtest"),
                   (cells["test"] == existing["test"]) & cells["subtest"].eqNullSafe(existing["subtest"]),
                   "left_anti"),
        runs)
    # One scalar reaches the driver: the next free id.
    base = existing.agg(F.coalesce(F.max("id") + 1, F.lit(0))).first()[0]
    return existing.unionByName(
        fresh.select((F.col("id") + F.lit(base)).alias("id"), "test", "subtest"))


def run_dictionary(runs: DataFrame) -> DataFrame:
    """A4: dense ids by creation time (oldest first, run_id breaks ties);
    every run gets an id, whether or not its report loads."""
    order = [F.col("created_at").asc_nulls_first(), F.col("run_id").asc()]
    return dense_ids(runs, order, "id")


def encode_cells(cells: DataFrame, tests: DataFrame, run_index: DataFrame, known: Sequence[str] | None = None) -> DataFrame:
    """Replace (run_id) and (test, subtest) by dictionary ids.  The subtest
    side of the key is compared null-safe (a test's own cell has none)."""
    t = tests.select(F.col("id").alias("test_id"), F.col("test").alias("__t"),
                                        F.col("subtest").alias("__s"))
    ri = run_index.select(F.col("id").alias("run_idx"), "run_id")
    j = cells.join(t, (cells["test"] == t["__t"]) & cells["subtest"].eqNullSafe(t["__s"]))
    j = j.join(ri, "run_id")
    return j.select("run_idx", "test_id", normalize_status("status", known).alias("status"),
                    normalize_status("sub_status", known).alias("sub_status"), "pos", "run_id")


# ---- A6, A7, K7: pivots --------------------------------------------------------

def pivot(cells: DataFrame, by: str, other: str, chunk_size: int = DEFAULT_CHUNK,
          values: Sequence[str] = ("status", "sub_status")) -> DataFrame:
    """``by`` -> {other: struct(values)}, one row per (by, chunk).

    The input must hold one row per (by, other) (apply ``last_write`` first:
    duplicate map keys are an error).  ``chunk = other div chunk_size`` caps
    every map at ``chunk_size`` entries, so hot keys split across rows and
    tasks; entries are sorted so the map order is deterministic.  The one
    shuffle is by ranges of (by, chunk), the order ``write_pivot`` writes in."""
    entry = F.struct(F.col(other).alias("k"), F.struct(*values).alias("v"))
    chunk = F.expr(f"`{other}` div {int(chunk_size)}").cast("bigint").alias("chunk")
    ranged = cells.withColumn("chunk", chunk).repartitionByRange(by, "chunk")
    return (ranged.groupBy(by, "chunk")
            .agg(F.array_sort(F.collect_list(entry)).alias("__e"))
            .select(by, "chunk", F.map_from_entries("__e").alias("entries")))


def unpivot(p: DataFrame, by: str, other: str) -> DataFrame:
    """Inverse of ``pivot``: back to long cells."""
    return p.select(by, F.explode("entries").alias(other, "__v")) \
        .select(by, F.col(other), "__v.*")


def transpose(p: DataFrame, by: str, other: str, chunk_size: int = DEFAULT_CHUNK) -> DataFrame:
    """A7 on load: by-run maps -> by-test maps (explode, then regroup)."""
    return pivot(unpivot(p, by, other), other, by, chunk_size)


def write_pivot(p: DataFrame, by: str, path: str) -> str:
    """K7: one line of gzip JSON per (key, chunk); ``pivot`` has dealt the keys out by
    range, so each key's chunks sit together in few files."""
    (p.withColumn("entries", F.transform_keys("entries", lambda k, v: k.cast("string")))
     .sortWithinPartitions(by, "chunk")
     .write.mode("errorifexists").option("compression", "gzip").json(path))
    return path


# ---- the matrix loader: reports -> dictionary -> encoded last-write cells -------

def _in_report_order() -> Column:
    """(part, entry, sub_pos) with a result's own cell (sub_pos NULL) before
    its subtests."""
    return F.struct("part", "entry", F.coalesce(F.col("sub_pos"), F.lit(-1)).alias("sub_pos"))


def report_dictionary(matrix_cells: DataFrame, run_index: DataFrame) -> DataFrame:
    """A3 over exploded reports (R15 output): dense ids in first-seen order -
    runs by run-dictionary id, then in-report position.

    Two phases keep the big aggregation a hash aggregate: the first run of
    every entry is ``min(run_idx)`` (a long); the in-report minimum is then
    taken only over that run's rows (a semi join on the entry and run)."""
    ri = run_index.select(F.col("id").alias("run_idx"), "run_id")
    return _first_seen(matrix_cells.join(ri, "run_id"))


def _first_seen(cells: DataFrame) -> DataFrame:
    """The dictionary of cells that carry their run's ``run_idx``.

    The first runs, a row an entry, are stored, so that Spark knows their size
    when it joins them: few entries are broadcast, and no cell is shuffled."""
    spark, path = cells.sparkSession, fresh_dir(cells.sparkSession, "first_runs")
    cells.groupBy("test", "subtest").agg(F.min("run_idx").alias("run_idx")).write.option("compression", "zstd").parquet(path)
    first_run = spark.read.parquet(path)
    key = (cells["test"] == first_run["test"]) & cells["subtest"].eqNullSafe(first_run["subtest"]) \
        & (cells["run_idx"] == first_run["run_idx"])
    firsts = cells.join(first_run, key, "left_semi")
    first = (firsts.groupBy("test", "subtest")
             .agg(F.min(F.struct("run_idx", _in_report_order().alias("o"))).alias("f")))
    order = [F.col("f.run_idx"), F.col("f.o.part"), F.col("f.o.entry"), F.col("f.o.sub_pos")]
    return dense_ids(first, order, "id").select("id", "test", "subtest")


def load_matrix(reports: DataFrame, run_index: DataFrame, known: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The matrix loader: ``(tests, cells)`` where ``cells`` holds one
    ``(run_idx, test_id, status, sub_status)`` per cell written last.

    The reports are parsed once and dealt out by run as whole documents.  Where
    they stand their cells become one row per run, test and subtest (the place of
    the cell seen first, the statuses of the one written last) and get their
    run's id.  These rows are written to the shared folder and read from there by
    the dictionary and the encoding, which look no run up again; the dictionary
    is stored too, so a small one is broadcast and no row is shuffled again."""
    spark, path, tests_path = reports.sparkSession, fresh_dir(reports.sparkSession, "matrix_cells"), fresh_dir(reports.sparkSession, "matrix_tests")
    cells = explode_matrix(reports.repartition("run_id")).select("run_id", "test", "subtest", "status", "sub_status", _in_report_order().alias("o"))
    once = cells.where(F.col("test").isNotNull()).groupBy("run_id", "test", "subtest").agg(
        F.min("o").alias("first"), F.max_by(F.struct("status", "sub_status"), "o").alias("last"))
    ri = run_index.select(F.col("id").alias("run_idx"), "run_id")
    once.join(ri, "run_id").select("run_idx", "test", "subtest", "first.*", "last.*").write.option("compression", "zstd").parquet(path)
    m = spark.read.parquet(path)
    _first_seen(m).write.option("compression", "zstd").parquet(tests_path)
    tests = spark.read.parquet(tests_path)
    t = tests.select(F.col("id").alias("test_id"), F.col("test").alias("__t"), F.col("subtest").alias("__s"))
    enc = m.join(t, (m["test"] == t["__t"]) & m["subtest"].eqNullSafe(t["__s"]))
    return tests, enc.select("run_idx", "test_id", normalize_status("status", known).alias("status"), normalize_status("sub_status", known).alias("sub_status"))


def browser_of_row() -> Column:
    """Partition column of the wide table: the browser part of the row key."""
    return F.substring_index(F.col("row_key"), "-", 1)


def upsert_wide_partitions(spark, path: str, new_cells: DataFrame, part_col: str = "browser") -> None:
    """K8 on storage, partition by partition: the wide table at ``path`` is
    partitioned by browser; only the partitions the new cells touch are read,
    merged (last write wins) and rewritten with dynamic partition overwrite;
    every other partition's files stay as they are.

    The merged rows of partitions that exist are checkpointed to the shared
    checkpoint folder first, so the write does not read the paths it replaces,
    and a failed job leaves the old partitions in place (dynamic overwrite
    publishes at job commit).  The partitions touched are a few names, which are
    made distinct before old cells are matched with them.
    """
    from runledger.session import ensure_checkpoint_dir
    from runledger.sources.materialize import path_exists

    ensure_checkpoint_dir(spark)
    new = new_cells.withColumn(part_col, browser_of_row())
    if path_exists(spark, path):
        touched = new.select(part_col).distinct()
        old = spark.read.parquet(path).join(F.broadcast(touched), part_col, "left_semi").drop(part_col)
        merged = upsert_wide(old, new.drop(part_col)).checkpoint(eager=True)
    else:
        merged = merge_wide(in_key_order(new.drop(part_col)))
    # the ranges of row keys are ranges of their first part too
    (merged.withColumn(part_col, browser_of_row()).sortWithinPartitions(part_col, "row_key", "qualifier")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", "zstd").partitionBy(part_col).parquet(path))
