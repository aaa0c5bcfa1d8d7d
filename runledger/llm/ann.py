"""Approximate nearest neighbours: a navigable small-world graph per shard, results merged.

1. Vectors that are null, zero, or hold null or non-finite numbers take no
   part.  Equal vectors are one point of the graph, with the smallest K + 1
   ids, K rows of each (no more can be among the K nearest of any query, ties
   going to the smaller id).
2. Points are dealt by hash into shards of about SHARD_ROWS; each shard gets a
   hierarchical navigable small-world graph over unit vectors, kept as flat
   arrays: per level the points and a matrix of neighbours (-1: none).
3. Every shard's graph is loaded once, by one task, and the queries of its
   dimension stream past it in blocks; a search descends greedily and widens to
   EF on the lowest level.
4. What the shards return is scored anew, by cosine in double precision on the
   original vectors, and merged: per query the K best, ties to the smaller id.

Defined results: repeated ids are rows of their own: candidates of one id
appear once per row, and queries that share an id with different vectors are
merged into one result of K; a query leaves out the
rows of its own id and is asked once if its row repeats; vectors of different lengths never meet; fewer candidates
than K give fewer rows; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runledger.llm.blocks import batch_rows, stream_past
from runledger.llm.common import stored

SHARD_ROWS, BLOCK_ROWS = 8192, 512
LINKS, EF_BUILD, EF = 16, 64, 128


class Graph:
    """Hierarchical navigable small-world graph over unit vectors."""

    def __init__(self, vectors: np.ndarray, levels: list[np.ndarray] | None = None, entry: int = 0):
        self.vectors, self.entry, self.levels = vectors, entry, levels or []
        if levels is None and len(vectors):
            self._build()

    def _near(self, q: np.ndarray, entry: list[tuple[float, int]], level: int, ef: int) -> list[tuple[float, int]]:
        """The ``ef`` nearest points found on a level, as (similarity, point), nearest first."""
        seen = {p for _, p in entry}
        todo = [(-s, p) for s, p in entry]
        heapq.heapify(todo)
        best = list(entry)
        heapq.heapify(best)
        links, vectors = self.levels[level], self.vectors
        while todo:
            s, p = heapq.heappop(todo)
            if len(best) >= ef and -s < best[0][0]:
                break
            new = [n for n in links[p].tolist() if n >= 0 and n not in seen]
            if not new:
                continue
            seen.update(new)
            for score, n in zip((vectors[new] @ q).tolist(), new):
                if len(best) < ef:
                    heapq.heappush(best, (score, n))
                elif score > best[0][0]:
                    heapq.heapreplace(best, (score, n))
                else:
                    continue
                heapq.heappush(todo, (-score, n))
        return sorted(best, reverse=True)

    def _chosen(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Neighbours that are nearer to the point than to one another, filled up with the nearest."""
        points = [p for _, p in found]
        if len(points) <= most:
            return points
        near = self.vectors[points] @ self.vectors[points].T
        taken, left = [], []
        for i, (s, _) in enumerate(found):
            if len(taken) == most:
                break
            (left if taken and near[i, taken].max() > s else taken).append(i)
        return [points[i] for i in (taken + left)[:most]]

    def _build(self) -> None:
        n = len(self.vectors)
        rng = np.random.default_rng(n)
        height = np.minimum(np.floor(-np.log(1 - rng.random(n)) / np.log(LINKS)).astype(int), 8)
        self.levels = [np.full((n, LINKS * 2 if k == 0 else LINKS), -1, np.int32) for k in range(height.max() + 1)]
        count = [np.zeros(n, np.int32) for _ in self.levels]
        top = -1
        for p in range(n):
            q, own = self.vectors[p], int(height[p])
            if top < 0:
                self.entry, top = p, own
                continue
            found = [(float(self.vectors[self.entry] @ q), self.entry)]
            for k in range(top, own, -1):
                found = self._near(q, found[:1], k, 1)
            for k in range(min(top, own), -1, -1):
                found = self._near(q, found, k, EF_BUILD)
                links, used = self.levels[k], count[k]
                most = links.shape[1]
                for o in self._chosen(found, LINKS):
                    links[p, used[p]] = o
                    used[p] += 1
                    if used[o] < most:
                        links[o, used[o]] = p
                        used[o] += 1
                    else:
                        all_of = [*links[o].tolist(), p]
                        score = (self.vectors[all_of] @ self.vectors[o]).tolist()
                        kept = self._chosen(sorted(zip(score, all_of), reverse=True), most)
                        links[o] = -1
                        links[o, :len(kept)] = kept
                        used[o] = len(kept)
            if own > top:
                self.entry, top = p, own

    def search(self, q: np.ndarray, ef: int) -> list[tuple[float, int]]:
        found = [(float(self.vectors[self.entry] @ q), self.entry)]
        for k in range(len(self.levels) - 1, 0, -1):
            found = self._near(q, found[:1], k, 1)
        return self._near(q, found, 0, ef)

    def flat(self) -> list[dict]:
        """Per level: points that have neighbours there, and the neighbours, as one array each."""
        out = []
        for links in self.levels:
            points = np.flatnonzero(links[:, 0] >= 0).astype(np.int32)
            out.append({"points": points.tobytes(), "neighbours": links[points].tobytes(), "width": links.shape[1]})
        return out

    @classmethod
    def from_flat(cls, vectors: np.ndarray, levels: list[dict], entry: int) -> Graph:
        out = []
        for level in levels:
            points = np.frombuffer(level["points"], np.int32)
            links = np.full((len(vectors), level["width"]), -1, np.int32)
            links[points] = np.frombuffer(level["neighbours"], np.int32).reshape(-1, level["width"])
            out.append(links)
        return cls(vectors, out, entry)


INDEX = "shard long, dim int, entry int, n int, vectors binary, ids array<array<long>>, levels array<struct<points:binary,neighbours:binary,width:int>>"


def usable(vector: Column) -> Column:
    """Whether a vector takes part (never null)."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return (rows / np.linalg.norm(rows, axis=1, keepdims=True)).astype(np.float32)


def build_index(rows: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard, with its graph, from (id, vector: array<double>, usable)."""
    # at most k rows of an id and k + 1 ids of equal vectors leave each task: the engine limits ranks before it shuffles
    one = Window.partitionBy("vector", "id").orderBy("id")
    same = Window.partitionBy("vector").orderBy(F.col("id").asc_nulls_last())
    points = rows.withColumn("copy", F.row_number().over(one)).where(F.col("copy") <= k)
    points = points.withColumn("rank", F.dense_rank().over(same)).where(F.col("rank") <= k + 1)
    points = stored(points.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")), "points")
    dims = {r[0]: max(1, -(-r[1] // shard_rows)) for r in points.groupBy(F.size("vector").alias("dim")).count().collect()}  # one row per dimension
    if not dims:
        return rows.sparkSession.createDataFrame([], INDEX)
    shards = F.element_at(F.create_map(*[F.lit(x) for d in dims.items() for x in d]), F.size("vector"))
    dealt = points.select(F.size("vector").alias("dim"), F.pmod(F.xxhash64("vector"), shards).alias("shard"), "ids", "vector")

    index_schema = _arrow(INDEX)

    def build(key: tuple, table: pa.Table) -> pa.Table:
        original = np.array(table.column("vector").to_pylist(), np.float64)
        ids = table.column("ids").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i], original[i].tobytes()))
        vectors = _unit(original[order])
        graph = Graph(vectors)
        return pa.Table.from_pylist([{"shard": key[1].as_py(), "dim": key[0].as_py(), "entry": graph.entry, "n": len(ids), "vectors": original[order].tobytes(),
                                      "ids": [ids[i] for i in order], "levels": graph.flat()}], schema=index_schema)

    # a number of partitions of its own, so that graphs aren't put into one task at run time
    dealt = dealt.repartition(2 * sum(dims.values()), "dim", "shard")
    return stored(dealt.groupBy("dim", "shard").applyInArrow(build, INDEX), "graphs")


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(schema))


FOUND = "query_id long, vec_id long, score double"


def search(queries: DataFrame, index: DataFrame, k: int, ef: int = EF, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found in all shards, from (id, vector) queries."""
    queries = queries.select("id", "vector").distinct()
    blocks = max(1, -(-queries.count() // block_rows))
    number = F.pmod(F.xxhash64("id", "vector"), F.lit(blocks))
    packed = queries.groupBy(F.size("vector").alias("dim"), number.alias("block")).agg(F.collect_list(F.struct("id", "vector")).alias("queries"))
    place = F.struct("dim", "shard")
    asked = index.select("dim", place.alias("shard")).join(packed, "dim").select("shard", "queries")
    graphs = index.select(place.alias("shard"), F.col("dim"), "entry", "vectors", "ids", "levels")

    def load(rows: list[dict]) -> tuple:
        (r,) = rows
        original = np.frombuffer(r["vectors"], np.float64).reshape(-1, r["dim"])
        return original, Graph.from_flat(_unit(original), r["levels"], r["entry"]), r["ids"]

    def ask(shard: tuple, row: dict) -> Iterator[pa.RecordBatch]:
        original, graph, ids = shard
        out: list[tuple] = []
        for q in row["queries"]:
            v = np.array(q["vector"], np.float64)
            scale = np.abs(v).max()
            hits = [p for _, p in graph.search(_unit(v[None])[0], max(ef, 2 * k))]
            at = original[hits]
            score = (at @ v) / (np.linalg.norm(at, axis=1) * np.linalg.norm(v)) if 1e-100 < scale < 1e100 else _exact(at, v)
            best = sorted((-s, i) for s, p in zip(score.tolist(), hits) for i in ids[p] if i is not None and i != q["id"])[:k]
            out += [(q["id"], i, -s) for s, i in best]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.float64()))], ["query_id", "vec_id", "score"])

    with batch_rows(queries.sparkSession, 4):  # a row holds a graph or a block of queries
        found = stored(stream_past(graphs, asked, 2 * max(1, index.count()), load, ask, FOUND), "neighbours")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _exact(rows: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Cosines of vectors whose squares leave the range of doubles."""
    rows, v = rows / np.abs(rows).max(axis=1, keepdims=True), v / np.abs(v).max()
    return (rows @ v) / (np.linalg.norm(rows, axis=1) * np.linalg.norm(v))
