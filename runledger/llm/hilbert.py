"""Sharding along a Hilbert curve over several metadata dimensions.

1. Each dimension is quantised into ``2**bits`` buckets of about equal depth, in
   the order of its values; the bucket edges are ``2**bits - 1`` values per
   dimension: approximate percentiles of numbers, and of strings the exact
   percentiles of all rows.
2. The buckets' Hilbert index comes from a state table: per bit, one lookup of
   the digit and one of the next state.
3. Rows are ordered by (index, id, text checksum), numbered without a
   single-task window, and the order is cut into runs of equal counts (law
   ``rows``: counts at most one apart).

Neighbours on the curve are near in every dimension, so a shard's files have
narrow minima and maxima in all of them and filters on any of them skip files.

Defined results: null dimensions fall in the lowest bucket; a null text has
size 1 and checksum 0; null ids sort first; repeated rows get slots of their
own; an empty table gives no rows; fewer rows than shards leave the last
shards with fewer rows.  Equal texts aren't kept together beyond their place
on the curve: a group may be larger than a shard.  Columns besides those
named don't matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runledger.operators.numbering import dense_ids
from runledger.session import ensure_checkpoint_dir

ACCURACY = 10_000


def state_table(dims: int) -> tuple[list[int], list[int]]:
    """Digit and next state for every (state, cell); a state is direction * 2**dims + entry."""
    n, mask = dims, (1 << dims) - 1
    gray = lambda i: i ^ i >> 1
    rank = {gray(i): i for i in range(1 << n)}
    left = lambda x, k: (x << k % n | x >> (n - k % n) % n * (k % n > 0)) & mask if k % n else x
    ones = lambda i: (~i & (i + 1)).bit_length() - 1  # trailing set bits
    digit, after = [], []
    for d in range(n):
        for e in range(1 << n):
            for cell in range(1 << n):
                w = rank[left(cell ^ e, n - (d + 1) % n)]
                digit.append(w)
                enter = gray(2 * ((w - 1) // 2)) if w else 0
                turn = 0 if not w else ones(w - 1) % n if w % 2 == 0 else ones(w) % n
                after.append((d + turn + 1) % n * (1 << n) + (e ^ left(enter, d + 1)))
    return digit, after


def curve_index(buckets: Sequence[Column], bits: int) -> Column:
    """The Hilbert index (long) of quantised coordinates."""
    n = len(buckets)
    digit, after = state_table(n)
    digits, states = F.array(*map(F.lit, digit)), F.array(*map(F.lit, after))
    index, state = F.lit(0).cast("long"), F.lit(0)
    for bit in reversed(range(bits)):
        cell = sum((F.shiftleft(F.shiftright(b, bit).bitwiseAND(1), j) for j, b in enumerate(buckets)), F.lit(0))
        at = F.shiftleft(state, n) + cell
        index = F.shiftleft(index, n) + F.get(digits, at)
        state = F.get(states, at)
    return index


def _string_edges(df: DataFrame, c: str, parts: int) -> list[str]:
    """Values that cut a string column's rows into about equal parts, from the
    counts of all its values: those are sorted and added up by ranges, and only
    the values that a cut falls on, less than ``parts``, reach the driver."""
    ensure_checkpoint_dir(df.sparkSession)
    counts = df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("n"))  # combined before the shuffle
    ordered = counts.orderBy("value").checkpoint().withColumn("range", F.spark_partition_id())
    sizes = ordered.groupBy("range").agg(F.sum("n").alias("rows"))
    total = sizes.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    if not total:
        return []
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = sizes.select("range", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("offset"))
    upto = Window.partitionBy("range").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = ordered.withColumn("seen", F.sum("n").over(upto)).join(F.broadcast(offsets), "range").withColumn("seen", F.col("seen") + F.col("offset"))
    at = seen.where(F.expr(f"seen * {parts}L div {total}L > (seen - n) * {parts}L div {total}L")).select("value", "n", "seen").collect()
    # the value at each k-th part of the rows
    return [r.value for r in sorted(at, key=lambda r: r.seen) for k in range(1, parts) if (r.seen - r.n) * parts < k * total <= r.seen * parts]


def quantised(df: DataFrame, dims: Sequence[str], bits: int, sample: int | None = None) -> list[Column]:
    """Bucket columns (int) of ``dims``; aggregates over all rows find the edges.  ``sample`` has no effect: edges of strings came from a sample once."""
    parts = 1 << bits
    at = [k / parts for k in range(1, parts)]
    text = [c for c in dims if isinstance(df.schema[c].dataType, T.StringType)]
    numbers = [c for c in dims if c not in text]
    found = df.agg(F.lit(0), *[F.percentile_approx(F.col(c).cast("double"), at, ACCURACY) for c in numbers]).first()[1:]
    edges = {c: [float(e) for e in edge or []] for c, edge in zip(numbers, found)} | {c: _string_edges(df, c, parts) for c in text}
    value = {c: F.col(c) if c in text else F.col(c).cast("double") for c in dims}
    return [F.coalesce(sum(((value[c] > F.lit(e)).cast("int") for e in edges[c]), F.lit(0)), F.lit(0)) for c in dims]


def hilbert_shards(df: DataFrame, dims: Sequence[str], order: Sequence[Column | str], shards: int, bits: int = 4) -> DataFrame:
    """Add curve_index, shard and slot to ``df``; ``order`` breaks ties on the curve."""
    placed = df.withColumn("curve_index", curve_index(quantised(df, dims, bits), bits))
    ranked = dense_ids(placed, ["curve_index", *order], "slot")
    n = ranked.select(F.count(F.lit(1))).first()[0]
    shard = F.expr(f"slot * {shards}L div {max(n, 1)}L")
    first = F.expr(f"(shard * {n}L + {shards - 1}L) div {shards}L")
    return ranked.withColumn("shard", shard).withColumn("slot", F.col("slot") - first).withColumn("shard", F.col("shard").cast("int"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write the runs as Parquet, a folder per shard, files and rows in curve order."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
