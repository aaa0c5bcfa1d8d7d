"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints: ASCII letters in lower case, words between ASCII white space,
shingles of ``shingle`` words (repeats count; fewer words: the whole sequence;
none: fingerprint 0), XXH64 with seed 42; a bit is 1 if set in over half of
the shingles' hashes.

Links (``distance`` or fewer differing bits, exact):

1. Equal fingerprints are folded first, so copies cost one row.
2. Two fingerprints within ``distance`` bits agree on one of ``distance + 1``
   blocks of bits; each fingerprint goes to the groups of its blocks' values.
3. Groups are sorted by Gray rank and cut into runs of at most RUN
   fingerprints.  A run is a hierarchical index: nodes hold the bits that all
   fingerprints below share, an upper node takes shared bits out of its
   children, and a search adds up the differences on its way down and leaves
   out every subtree whose sum is too large.
4. A group that lies whole in one run is searched where it was cut.  Runs of
   larger groups, and of groups that two tasks share, meet pairwise, unless
   the bits that the runs share already differ too much.
5. A search yields, per group or pair of runs, one edge for each member of a
   local component and never the pairs; components over all edges follow.

Defined results: a null or empty text has fingerprint 0 and is linked as any
other; null ids have a row and don't name a component unless nothing else
can (then component_id is null); repeated rows keep their number; an empty
table gives no rows; columns besides id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import free_name, small_batches, stored, text_of
from runledger.llm.components import components

SEED = 42
#: Fingerprints in a run, children of a node, queries of a search at a time, shingles counted at a time.
RUN, FAN, QUERIES_AT_ONCE, SHINGLES = 8192, 16, 512, 1 << 16
#: Pairs that a search may hold before they are folded into labels.
PAIRS = 1 << 20


def fingerprint(text: bytes, shingle: int) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    import xxhash
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    ends = ends[min(shingle, len(words)) - 1:].tolist()
    count = np.zeros(64, np.int64)
    for i in range(0, n, SHINGLES):
        parts = [joined[a:b] for a, b in zip(starts[i:i + SHINGLES], ends[i:i + SHINGLES])]
        h = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64, len(parts))
        count += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(count * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, hash, fp): id, hash of the text, fingerprint as a signed long."""
    small_batches(docs.sparkSession)
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = [fingerprint(t, shingle) for t in b.column(2).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.array(values, np.uint64).view(np.int64))], ["id", "hash", "fp"])

    return rows.mapInArrow(compute, "id long, hash long, fp long")


def gray_rank(fp: Column) -> Column:
    """Place in the Gray order, as a signed long of the same order."""
    for step in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, step))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


class GrayIndex:
    """Hierarchy of shared bits over fingerprints in Gray order."""

    def __init__(self, fps: np.ndarray):
        self.levels = [(fps, np.full(len(fps), ~np.uint64(0)))]
        low = high = fps
        while len(low) > 1:
            at = np.arange(0, len(low), FAN)
            low, high = np.bitwise_and.reduceat(low, at), np.bitwise_or.reduceat(high, at)
            self.levels.append((low, ~(low ^ high)))
        # a node's own bits are those that its parent doesn't hold
        self.own = [m if k + 1 == len(self.levels) else m & ~np.repeat(self.levels[k + 1][1], FAN)[:len(m)] for k, (_, m) in enumerate(self.levels)]

    def search(self, queries: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of query and fingerprint of all pairs within ``distance``."""
        top = len(self.levels) - 1
        n = len(self.levels[top][0])
        q, node = np.repeat(np.arange(len(queries)), n), np.tile(np.arange(n), len(queries))
        far = np.zeros(len(q), np.int64)
        for k in range(top, -1, -1):
            far += np.bitwise_count((queries[q] ^ self.levels[k][0][node]) & self.own[k][node])
            near = far <= distance
            q, node, far = q[near], node[near], far[near]
            if k:
                size = len(self.levels[k - 1][0])
                first = node * FAN
                count = np.minimum(FAN, size - first)
                node = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum()) if len(count) else node
                q, far = np.repeat(q, count), np.repeat(far, count)
        return q, node


def _join(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (smallest place reachable) after also linking i and j."""
    while True:
        a, b = label[i], label[j]
        if (a == b).all():
            return label
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while (label[label] != label).any():
            label = label[label]


def local_edges(left: np.ndarray, right: np.ndarray | None, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(root, member) of the components that links within or between sorted runs make."""
    index = GrayIndex(left if right is None else right)
    every = left if right is None else np.concatenate([left, right])
    label, shift = np.arange(len(every)), 0 if right is None else len(left)
    step = QUERIES_AT_ONCE
    for i in range(0, len(left), step):
        q, n = index.search(left[i:i + step], distance)
        for k in range(0, len(q), PAIRS):
            label = _join(label, q[k:k + PAIRS] + i, n[k:k + PAIRS] + shift)
    member = np.flatnonzero(label != np.arange(len(every)))
    return every[label[member]], every[member]


RUNS = "a long, b long, key long, run long, pattern long, mask long, fps binary"


def _edge_batch(edges: list[tuple[np.ndarray, np.ndarray]], schema: pa.Schema) -> pa.RecordBatch:
    a, b = (np.concatenate([e[k] for e in edges]).view(np.int64) for k in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), *[pa.nulls(len(a), f.type) for f in list(schema)[2:]]], schema=schema)


def cut_runs(distance: int, run: int):
    """A function over rows (key, fp) in order: edges of whole groups, runs of the others."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()), ("run", pa.int64()), ("pattern", pa.int64()), ("mask", pa.int64()), ("fps", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        key, parts, size, whole = None, [], 0, False

        def run_row(final: bool):
            nonlocal number, parts, size
            fps = np.concatenate(parts)
            head, rest = (fps, fps[:0]) if final else (fps[:run], fps[run:])
            low, high = np.bitwise_and.reduce(head), np.bitwise_or.reduce(head)
            mask = ~(low ^ high)
            number += 1
            parts, size = ([rest], len(rest)) if len(rest) else ([], 0)
            as_long = lambda x: int(np.uint64(x).view(np.int64))
            return pa.RecordBatch.from_pylist([{"a": None, "b": None, "key": int(key), "run": number, "pattern": as_long(low), "mask": as_long(mask), "fps": head.tobytes()}], schema=schema)

        for b in batches:
            keys = b.column(0).to_numpy()
            fps = b.column(1).to_numpy().view(np.uint64)
            cuts = np.flatnonzero(np.diff(keys)) + 1
            edges = []
            for at, to in zip([0, *cuts], [*cuts, len(keys)]):
                if at == to:
                    continue
                if key is None or keys[at] != key:
                    if size and whole:
                        if size > 1:
                            edges.append(local_edges(np.concatenate(parts), None, distance))
                        parts, size = [], 0
                    elif size:
                        yield run_row(True)
                    whole, key = key is not None, keys[at]  # the first group of a task may have begun in another
                parts.append(fps[at:to])
                size += to - at
                while size > run:
                    whole = False
                    yield run_row(False)
            if edges:
                yield _edge_batch(edges, schema)
        if size:
            yield run_row(True)  # the last group may go on in another task

    return cut


def _pair_edges(distance: int):
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for same, left, right in zip(*[c.to_pylist() for c in b.columns]):
                a, m = local_edges(np.frombuffer(left, np.uint64), None if same else np.frombuffer(right, np.uint64), distance)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(m.view(np.int64))], ["a", "b"])
    return pairs


def links(fps: DataFrame, distance: int, run: int = RUN) -> DataFrame:
    """Edges (a, b) that span the components of distinct fingerprints ``fp`` within ``distance`` bits."""
    blocks, edges, low = distance + 1, [], 0
    for k in range(blocks):
        width = (64 - low) // (blocks - k)
        value = F.shiftrightunsigned("fp", low).bitwiseAND((1 << width) - 1)
        edges.append(value * blocks + k)
        low += width
    spread = fps.select(F.explode(F.array(*edges)).alias("key"), "fp").withColumn("rank", gray_rank(F.col("fp")))
    dealt = spread.repartitionByRange("key", "rank").sortWithinPartitions("key", "rank").select("key", "fp")
    cut = stored(dealt.mapInArrow(cut_runs(distance, run), RUNS), "runs")
    runs = cut.where("fps is not null").select("key", "run", "pattern", "mask", "fps")
    other = runs.select(*[F.col(c).alias(f"{c}2") for c in runs.columns])
    near = F.bit_count(F.col("pattern").bitwiseXOR(F.col("pattern2")).bitwiseAND(F.col("mask")).bitwiseAND(F.col("mask2"))) <= distance
    met = runs.join(other, (F.col("key") == F.col("key2")) & (F.col("run") <= F.col("run2")) & near)
    met = met.repartition("run", "run2").select((F.col("run") == F.col("run2")).alias("same"), "fps", "fps2")
    return cut.where("fps is null").select("a", "b").union(met.mapInArrow(_pair_edges(distance), "a long, b long"))


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, hash (of its text), fp, root (of the component), component_id."""
    rows = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    folded = stored(rows.groupBy("fp").agg(F.min("id").alias("low")), "folded")
    tree = stored(components(links(folded, distance)), "components")
    linked = tree.withColumnRenamed("node", "fp").join(folded, "fp")
    lowest = linked.groupBy("root").agg(F.min("low").alias("component_id"))
    named = tree.join(lowest, "root").select(F.col("node").alias("fp"), "root", "component_id")
    every = folded.join(named, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.when(F.col("root").isNull(), F.col("low")).otherwise(F.col("component_id")).alias("component_id"))
    return rows.join(stored(every, "labels"), "fp").select("id", "hash", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row of the smallest id (a null id only if alone).

    A row is known by (id, hash of the text); rows that repeat one count once.
    """
    found = near_duplicates(docs, shingle, distance, id_col, text_col)
    best = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "hash")).alias("best"))
    no_id = F.lit(-(1 << 63))
    id_name, hash_name = free_name(docs.columns, "row_id"), free_name(docs.columns, "row_hash")
    keep = stored(best.select(F.coalesce("best.id", no_id).alias(id_name), F.col("best.hash").alias(hash_name)), "survivors")
    keyed = docs.withColumns({id_name: F.coalesce(F.col(id_col).cast("long"), no_id), hash_name: F.xxhash64(text_of(text_col))})
    return keyed.join(keep, [id_name, hash_name], "left_semi").dropDuplicates([id_name, hash_name]).select(*[F.col(f"`{c}`") for c in docs.columns])
