"""Hard-negative mining by a matrix product in a residue number system.

1. A row takes part if its label and vector are there and every component,
   times 256, is finite.  Components become integers, floor(256 * x).
2. Scores are integer inner products, found without integer products: the
   component matrices are taken modulo several small primes, with remainders
   centred on 0 and so small that sums of their products are exact in float32;
   one float32 matrix product per prime gives the score's remainder.
   Chinese remaindering (mixed-radix digits, centred as well) gives the exact
   signed score.  As many primes are taken as the largest component needs.
3. Rows are dealt into chunks; anchors stream past each chunk in blocks.  A
   first pass finds each anchor's nearest rows of its own label, the
   positives.  A second pass selects, for each anchor and positive, the
   nearest rows of other labels whose score lies in the window that the
   positive's score opens.  Each chunk yields a bounded number per anchor,
   which are merged.

Defined results: rows with a null label, a null vector or a null or
non-finite component take no part; vectors of different lengths never meet
(empty ones meet with score 0); repeated rows are rows of their own, but a row
with the anchor's id is neither its positive nor its negative; an anchor row
that repeats as a whole is asked once; a null id is no anchor and comes last
among equal scores; ties go to the smaller id; a score beyond 64 bits counts
as the largest or smallest long; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runledger.llm.blocks import batch_rows, stream_past
from runledger.llm.common import stored

SCALE = 256
#: Components of a chunk of rows and of a block of anchors, which bound a task's memory.
CHUNK_CELLS, BLOCK_CELLS = 1 << 19, 1 << 14
MOST_CHUNK, MOST_BLOCK = 8192, 256
#: Components that one float32 sum takes at most.
SUM = 1024


def primes_for(dim: int, largest: int) -> list[int]:
    """Odd primes, each small enough for exact float32 sums, whose product holds every inner product with its sign."""
    most = math.isqrt((1 << 24) // max(1, min(dim, SUM)))
    bound, product, out = 2 * max(1, dim) * max(1, largest) ** 2 + 1, 1, []
    for p in range(2 * most + 1, 2, -2):
        if product > bound:
            break
        if all(p % d for d in range(3, math.isqrt(p) + 1, 2)):
            out.append(p)
            product *= p
    if product <= bound:
        raise ValueError(f"components up to {largest} need more primes than there are below {2 * most + 1}")
    return out


def _centred(x: np.ndarray, p: int) -> np.ndarray:
    """x mod p, from -(p - 1) / 2 to (p - 1) / 2."""
    r = np.remainder(x, p)
    return r - p * (r > p // 2)


class Residues:
    """A matrix of integers (as doubles), one float32 matrix of centred remainders per prime."""

    def __init__(self, rows: np.ndarray, primes: list[int]):
        self.primes = primes
        self.parts = [_centred(rows, p).astype(np.float32) for p in primes]

    def times(self, other: Residues) -> np.ndarray:
        """The exact products of all rows with all rows of ``other``; beyond 64 bits the nearest long."""
        primes, digits = self.primes, []
        for i, p in enumerate(primes):
            a, b = self.parts[i], other.parts[i]
            total = np.zeros((len(a), len(b)), np.int64)
            for k in range(0, a.shape[1], SUM):
                total += (a[:, k:k + SUM] @ b[:, k:k + SUM].T).astype(np.int64)
            rest = _centred(total, p)
            for q, digit in zip(primes, digits):
                rest = _centred((rest - digit) * pow(q, -1, p), p)
            digits.append(rest)
        wide = math.prod(primes) >= 1 << 64
        score = digits[-1].astype(object) if wide else digits[-1]
        for p, digit in zip(reversed(primes[:-1]), reversed(digits[:-1])):
            score = score * p + digit
        if wide:
            score = np.array(np.clip(score, -(2 ** 63) + 1, 2 ** 63 - 1), np.int64)
        return score


def first(score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest, highest first, equal ones in order of their places."""
    if len(score) > 4 * k:
        edge = np.partition(score, len(score) - k)[len(score) - k]
        kept = np.flatnonzero(score >= edge)
        return kept[np.argsort(-score[kept], kind="stable")[:k]]
    return np.argsort(-score, kind="stable")[:k]


def usable(label: Column, vector: Column) -> Column:
    """Whether a row takes part (never null)."""
    sound = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double") * SCALE) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return F.coalesce(label.isNotNull() & sound, F.lit(False))


def integers(vector: Column) -> Column:
    """floor(256 * x) of every component, as doubles (which hold them exactly)."""
    whole = lambda x: F.when(F.abs(x) < float(1 << 53), F.floor(x).cast("double")).otherwise(x)  # noqa: E731  floor() gives longs, and beyond 2**53 every double is whole
    return F.transform(vector, lambda x: whole(x.cast("double") * SCALE))


class Chunk:
    """Rows of one length in order of their ids, with their remainders."""

    def __init__(self, rows: list[dict], primes: dict[int, list[int]]):
        rows.sort(key=lambda r: (r["id"] is None, r["id"] or 0))
        self.primes = primes[rows[0]["dim"]]
        self.ids = [r["id"] for r in rows]
        # null ids equal no anchor's
        self.known, self.numbers = np.array([i is not None for i in self.ids]), np.array([i or 0 for i in self.ids], np.int64)
        self.labels = np.array([r["label"] for r in rows], np.int64)
        self.matrix = Residues(_matrix([r["vector"] for r in rows]), self.primes)

    def scores(self, anchors: list[dict]) -> np.ndarray:
        return Residues(_matrix([a["vector"] for a in anchors]), self.primes).times(self.matrix)

    def other(self, anchor: dict) -> np.ndarray:
        return ~(self.known & (self.numbers == anchor["id"]))


def _matrix(vectors: list[list[float]]) -> np.ndarray:
    return np.array(vectors, np.float64).reshape(len(vectors), -1)


PAIRS = "anchor long, place int, id long, score long"


def _batch(out: list[tuple]) -> Iterator[pa.RecordBatch]:
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64()))], ["anchor", "place", "id", "score"])


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, from (id, label, vector of integers).

    A negative's score, in hundredths of the positive's, is from ``low`` to ``high``.
    """
    spark = rows.sparkSession
    rows = rows.select(F.col("id").cast("long"), F.col("label").cast("long"), "vector", F.size("vector").alias("dim"), is_anchor.alias("is_anchor"))
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    largest = F.coalesce(F.max(F.array_max(F.transform("vector", lambda x: F.abs(x)))), F.lit(0.0))
    dims = {r["dim"]: r for r in rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), largest.alias("largest")).collect()}  # one row per length of vectors
    if not dims:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    primes = {d: primes_for(d, int(r["largest"])) for d, r in dims.items()}
    n_chunks = {d: max(1, -(-r["n"] // max(1, min(MOST_CHUNK, CHUNK_CELLS // max(1, d))))) for d, r in dims.items()}
    by_dim = lambda values: F.element_at(F.create_map(*[F.lit(x).cast("long") for pair in values.items() for x in pair]), F.col("dim").cast("long"))
    # a shard is a chunk of one length: its number and the length
    dealt = rows.withColumn("shard", F.struct(F.col("dim"), F.pmod(F.xxhash64("row"), by_dim(n_chunks)).alias("chunk")))
    total = sum(n_chunks.values())

    asked = rows.where("is_anchor").groupBy("id", "label", "vector", "dim").agg(F.min("row").alias("anchor"))
    asked = stored(asked, "anchors")
    counts = {r["dim"]: r["count"] for r in asked.groupBy("dim").count().collect()}
    n_blocks = {d: max(1, -(-n // max(1, min(MOST_BLOCK, BLOCK_CELLS // max(1, d))))) for d, n in counts.items()}
    if not n_blocks:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")

    def against(anchors: DataFrame, ask) -> DataFrame:
        """What ``ask`` finds for the anchors in every chunk of their length."""
        fields = [c for c in anchors.columns if c != "dim"]
        blocks = anchors.withColumn("number", F.pmod(F.xxhash64("anchor"), by_dim(n_blocks))).groupBy("dim", "number").agg(F.collect_list(F.struct(*fields)).alias("anchors"))
        blocks = blocks.select(F.struct("dim", "number").alias("block"), "anchors")
        chunks = dealt.select("shard").distinct().withColumn("dim", F.col("shard.dim")).where(F.col("dim").isin(list(n_blocks)))
        wanted = chunks.select("shard", "dim", F.explode(F.sequence(F.lit(0).cast("long"), by_dim(n_blocks) - 1)).alias("number"))
        queries = wanted.select("shard", F.struct("dim", "number").alias("block")).join(blocks, "block").drop("block")
        kept = dealt.select("shard", "id", "label", "vector", "dim")
        with batch_rows(spark, 256):
            return stored(stream_past(kept, queries, 2 * total, lambda rows: Chunk(rows, primes), ask, PAIRS), "pairs")

    def nearest_of_label(chunk: Chunk, row: dict) -> Iterator[pa.RecordBatch]:
        out, scores = [], chunk.scores(row["anchors"])
        for a, score in zip(row["anchors"], scores):
            own = np.flatnonzero((chunk.labels == a["label"]) & chunk.other(a))
            out += [(a["anchor"], 0, chunk.ids[own[j]], int(score[own[j]])) for j in first(score[own], positives)]
        yield from _batch(out)

    def in_window(chunk: Chunk, row: dict) -> Iterator[pa.RecordBatch]:
        out, scores = [], chunk.scores(row["anchors"])
        for a, score in zip(row["anchors"], scores):
            others = np.flatnonzero((chunk.labels != a["label"]) & chunk.other(a))
            for place, p in enumerate(a["scores"], 1):
                inside = others[(score[others] >= -((-low * p) // 100)) & (score[others] <= (high * p) // 100)]
                out += [(a["anchor"], place, chunk.ids[inside[j]], int(score[inside[j]])) for j in first(score[inside], negatives)]
        yield from _batch(out)

    order = lambda *keys: Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    best = against(asked, nearest_of_label).withColumn("place", F.row_number().over(order("anchor"))).where(F.col("place") <= positives)
    best = stored(best, "positives")
    lists = best.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "score"))).alias("all")).select("anchor", F.col("all.score").alias("scores"))
    found = against(asked.join(lists, "anchor"), in_window).withColumn("rank", F.row_number().over(order("anchor", "place"))).where(F.col("rank") <= negatives)
    pairs = found.select("anchor", "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = pairs.join(best.select("anchor", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), ["anchor", "place"])
    return pairs.join(asked.select("anchor", F.col("id").alias("anchor_id")), "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
