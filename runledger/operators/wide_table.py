"""The wide-cell table on storage: loads as deltas, merge on read, compaction by key range (K8); layouts that prune without a row-key prefix.

``WideTable`` keeps cells (row_key, family, qualifier, value, ts) under a path:

* ``base/range=r``    the cells of a range of row keys, one row per cell, sorted;
* ``delta/load=n``    a load's own cells, one row per cell, in folders by range;
* ``_BOUNDS``         the first row key of every range (fixed when the table is made);
* ``_COMPACTED``      the last load that the base holds.

A load writes its own cells and nothing else.  A read merges base and later
loads, last write wins by (ts, load); ranges that no such load touches are read
as they are, without a shuffle.  ``compact`` rewrites the ranges that later
loads touch.  If it dies before its mark is written, the loads are merged again
on top of themselves, which changes nothing.  One writer per table.

``write_zordered`` lays the same cells out along a Z-order curve over row key,
qualifier and value, so a range of any of them lies in few files; ``zones``
holds each file's smallest and largest values, and ``range_scan`` opens only
files whose zones meet the ranges.  Parquet bloom filters on the qualifier
serve look-ups of a single one.
"""

from __future__ import annotations

import json
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runledger.operators import search as S
from runledger.operators.cells import in_key_order, merge_wide
from runledger.session import ensure_checkpoint_dir
from runledger.sources import materialize as M

KEY = ("row_key", "family", "qualifier")
#: Rows that Spark looks at for the first bounds of a table's ranges; a table of fewer cells is cut exactly.
BOUND_ROWS, _RANGE_SAMPLE = 200_000, "spark.sql.execution.rangeExchange.sampleSizePerPartition"
COLUMNS = (*KEY, "value", "ts")
_SCHEMA = "row_key STRING, family STRING, qualifier STRING, value STRING, ts TIMESTAMP"


def _range_of(bounds: Sequence[str]) -> Column:
    """The number of the range a row key is in: of bounds up to it, the last."""
    if len(bounds) <= 1:
        return F.lit(0)
    starts = F.array(*[F.lit(b) for b in bounds[1:]])
    return F.size(F.filter(starts, lambda b: b <= F.col("row_key")))


class WideTable:
    """One table of wide cells; ``ranges`` is used when it is made."""

    def __init__(self, spark: SparkSession, path: str, ranges: int = 64):
        self.spark, self.path, self.ranges = spark, path, ranges
        ensure_checkpoint_dir(spark)

    def _mark(self, name: str) -> str | None:
        return M.read_marker(self.spark, f"{self.path}/{name}")

    def bounds(self) -> list[str] | None:
        text = self._mark("_BOUNDS")
        return None if text is None else json.loads(text)

    def compacted(self) -> int:
        return int(self._mark("_COMPACTED") or -1)

    def loads(self) -> list[int]:
        """Numbers of the finished loads that the base doesn't hold, ascending."""
        p, fs = M._fs(self.spark, f"{self.path}/delta")
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        numbers = sorted(int(n[5:]) for n in names if n.startswith("load="))
        return [n for n in numbers if n > self.compacted() and M.path_exists(self.spark, f"{self.path}/delta/load={n}/_SUCCESS")]

    def create(self, cells: DataFrame) -> None:
        """The first load: the base, cut into ranges of about equal numbers of cells."""
        before = self.spark.conf.get(_RANGE_SAMPLE, None)
        self.spark.conf.set(_RANGE_SAMPLE, BOUND_ROWS // self.ranges)
        try:
            # the ranges that the cells are merged in are the table's
            ranged = merge_wide(in_key_order(cells, self.ranges)).select(*COLUMNS, F.spark_partition_id().alias("part")).checkpoint()
        finally:
            self.spark.conf.unset(_RANGE_SAMPLE) if before is None else self.spark.conf.set(_RANGE_SAMPLE, before)
        # a row key may reach over parts: it belongs to the range that starts with it, or to the one before
        first = sorted(r[0] for r in ranged.groupBy("part").agg(F.min("row_key")).select("min(row_key)").distinct().collect())  # one per range
        bounds = first or [""]
        M.write_marker(self.spark, f"{self.path}/_BOUNDS", json.dumps(bounds))
        self._write_base(ranged.drop("part").withColumn("range", _range_of(bounds)), "append")

    def _write_base(self, rows: DataFrame, mode: str) -> None:
        """Rows that stand in the order of their row keys, by range."""
        placed = rows.sortWithinPartitions("range", "row_key", "family", "qualifier")
        placed.write.mode(mode).option("compression", "zstd").option("partitionOverwriteMode", "dynamic").partitionBy("range").parquet(f"{self.path}/base")

    def load(self, cells: DataFrame) -> int:
        """Append a load as a delta; returns its number."""
        bounds = self.bounds()
        if bounds is None:
            self.create(cells)
            return -1
        p, fs = M._fs(self.spark, f"{self.path}/delta")
        taken = [int(s.getPath().getName()[5:]) for s in fs.listStatus(p) if s.getPath().getName().startswith("load=")] if fs.exists(p) else []
        number = max([*taken, self.compacted()], default=-1) + 1
        # the order of row keys is the order of their ranges
        rows = merge_wide(in_key_order(cells)).select(*COLUMNS, _range_of(bounds).alias("range"))
        placed = rows.sortWithinPartitions("range", "row_key", "family", "qualifier")
        # static: a committed job leaves _SUCCESS, the sign of a finished load
        placed.write.mode("errorifexists").option("compression", "zstd").option("partitionOverwriteMode", "static").partitionBy("range").parquet(f"{self.path}/delta/load={number}")
        return number

    def _base(self) -> DataFrame:
        return self.spark.read.schema(f"{_SCHEMA}, range INT").parquet(f"{self.path}/base")

    def _deltas(self, loads: Sequence[int]) -> DataFrame:
        every = [self.spark.read.schema(f"{_SCHEMA}, range INT").parquet(f"{self.path}/delta/load={n}").withColumn("load", F.lit(n)) for n in loads]
        out = every[0]
        for df in every[1:]:
            out = out.unionByName(df)
        return out

    def touched(self, loads: Sequence[int]) -> list[int]:
        """The ranges that loads have cells of, from their folders' names."""
        out = set()
        for n in loads:
            p, fs = M._fs(self.spark, f"{self.path}/delta/load={n}")
            out |= {int(s.getPath().getName()[6:]) for s in fs.listStatus(p) if s.getPath().getName().startswith("range=")}
        return sorted(out)

    def _merged(self, loads: Sequence[int], ranges: Sequence[int]) -> DataFrame:
        both = self._base().where(F.col("range").isin(list(ranges))).withColumn("load", F.lit(-1)).unionByName(self._deltas(loads))
        last = in_key_order(both).groupBy("range", *KEY).agg(F.max_by(F.struct("value", "ts"), F.struct("ts", "load")).alias("w"))
        return last.select(*KEY, "w.value", "w.ts", "range")

    def read(self) -> DataFrame:
        """All cells, last write wins."""
        loads = self.loads()
        touched = self.touched(loads) if loads else []
        if not touched:
            return self._base().select(*COLUMNS)
        still = self._base().where(~F.col("range").isin(touched)).select(*COLUMNS)
        return still.unionByName(self._merged(loads, touched).select(*COLUMNS))

    def compact(self) -> list[int]:
        """Merge the later loads into the base; returns the ranges rewritten."""
        loads = self.loads()
        if not loads:
            return []
        touched = self.touched(loads)
        if touched:
            self._write_base(self._merged(loads, touched).checkpoint(), "overwrite")
        M.write_marker(self.spark, f"{self.path}/_COMPACTED", str(loads[-1]))
        return touched


# ---- Z-order layout ---------------------------------------------------------------

#: Rows looked at to find the curve's steps (the layout's quality depends on them, no result does), and bits per column.
SAMPLE_ROWS, BITS = 20_000, 4
DIMENSIONS = ("row_key", "qualifier", "value")


def _steps(sample: DataFrame, column: str, bits: int) -> list[str]:
    """Values that cut a column's rows into 2**bits about equal parts."""
    values = sorted(r[0] for r in sample.select(column).where(F.col(column).isNotNull()).collect())  # SAMPLE_ROWS at most
    n = 1 << bits
    return sorted({values[len(values) * i // n] for i in range(1, n)}) if values else []


def z_value(steps: dict[str, list[str]], bits: int) -> Column:
    """The place on the Z-order curve: the columns' part numbers with their bits interleaved."""
    out = F.lit(0).cast("bigint")
    for j, (column, cuts) in enumerate(steps.items()):
        part = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col(column))) if cuts else F.lit(0)
        part = F.coalesce(part, F.lit(0))
        for b in range(bits):
            out = out + F.shiftleft(F.shiftright(part, b).bitwiseAND(1).cast("bigint"), b * len(steps) + j)
    return out


def write_zordered(cells: DataFrame, path: str, files: int, sample_rows: int = SAMPLE_ROWS, bits: int = BITS, bloom: str | None = "qualifier") -> str:
    """Store cells along the curve in about ``files`` files, with their zones."""
    spark = cells.sparkSession
    n = cells.count()
    sample = cells.select(*DIMENSIONS).sample(min(1.0, sample_rows / max(n, 1)), seed=0).limit(sample_rows)
    steps = {c: _steps(sample, c, bits) for c in DIMENSIONS}
    placed = cells.withColumn("z", z_value(steps, bits)).repartitionByRange(files, "z", *DIMENSIONS).sortWithinPartitions("z", *DIMENSIONS).drop("z")
    w = placed.write.mode("errorifexists").option("compression", "zstd")
    if bloom:
        w = w.option(f"parquet.bloom.filter.enabled#{bloom}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
    w.parquet(f"{path}/cells")
    stored = spark.read.schema(cells.schema).parquet(f"{path}/cells")
    edges = [f(c).alias(f"{n}_{c}") for c in DIMENSIONS for n, f in (("min", F.min), ("max", F.max))]
    stored.groupBy(F.input_file_name().alias("file")).agg(*edges).coalesce(1).write.parquet(f"{path}/zones")
    return path


def _meets(column: str, low: str | None, high: str | None) -> Column:
    """Whether a file's zone has values of ``[low, high)``."""
    out = F.lit(True)
    if low is not None:
        out &= F.col(f"max_{column}") >= low
    if high is not None:
        out &= F.col(f"min_{column}") < high
    return out


def _after(prefix: str) -> str | None:
    """The smallest string beyond all that start with ``prefix``."""
    for i in range(len(prefix) - 1, -1, -1):
        if ord(prefix[i]) < 0x10FFFF and not 0xD7FF <= ord(prefix[i]) < 0xE000:
            return prefix[:i] + chr(ord(prefix[i]) + 1)
    return None


def files_for(spark: SparkSession, path: str, prefix: str = "", q_range: tuple[str, str] | None = None, v_range: tuple[str, str] | None = None) -> list[str]:
    """The files that may hold cells of the ranges."""
    meets = _meets("row_key", prefix or None, _after(prefix) if prefix else None) & _meets("qualifier", *(q_range or (None, None))) & _meets("value", *(v_range or (None, None)))
    return sorted(r.file for r in spark.read.parquet(f"{path}/zones").where(meets).select("file").collect())


def range_scan(spark: SparkSession, path: str, family: str, q_range: tuple[str, str] | None = None, v_range: tuple[str, str] | None = None,
               prefix: str = "", limit_rows: int = 100) -> DataFrame:
    """P12-P14, P16, L3 over the Z-ordered table; any of prefix and ranges may be left out."""
    files = files_for(spark, path, prefix, q_range, v_range)
    reader = spark.read.schema(_SCHEMA)
    cells = reader.parquet(*files) if files else spark.createDataFrame([], _SCHEMA)
    return S.prefix_scan(cells, prefix, family, q_range, v_range, limit_rows)


def qualifier_lookup(spark: SparkSession, path: str, family: str, qualifier: str) -> DataFrame:
    """All cells of one qualifier: zones leave files, bloom filters row groups."""
    files = files_for(spark, path, q_range=(qualifier, qualifier + "\0"))
    cells = spark.read.schema(_SCHEMA).parquet(*files) if files else spark.createDataFrame([], _SCHEMA)
    return cells.where((F.col("family") == family) & (F.col("qualifier") == qualifier))
