"""Ranked lexical search over impact lists, by the Best Position Algorithm.

Terms are maximal runs of ASCII letters and digits and of all characters
beyond ASCII, only A-Z lower-cased.  A document's score for an item is the sum
over the item's terms, repeats included, of

    w * ((10**9 * tf) div (1000 * tf + 8 * m))     m = 100 - 75 + (75 * n * N) div L
    w = floor(1000 * ln((2 N + 2) / (2 df + 1)))

1. ``build_index`` reads the documents once, without a shuffle: each task cuts
   its documents into shards of at most SHARD_DOCS documents and about
   SHARD_TERMS terms and writes one row per shard and term (documents and
   frequencies as flat arrays) and one row per shard with its documents.  N,
   L and df are sums over that table.  The index holds every term, so other
   item sets can be asked without reading the documents again.
2. ``search`` brings the lists of the items' terms to their shards, orders
   each by impact, and lets the items stream past, block by block.  Per item,
   sorted access goes down all lists at once; every document met is looked up
   directly in all of the item's lists, which yields its score and marks its
   place in each.  A list's best position is the last of the places seen
   without a gap; the impacts there sum to the threshold.  The search ends
   when the k-th score is strictly above it, so no tie is lost.  Accesses go
   in steps that double, to keep the work in numpy.
3. The shards' best are merged: per item the k best, equal scores by doc_id.

Defined results: a null or empty text has no term and is never found, nor is
a score of 0; repeated rows and ids are documents of their own (null ids last
among equal scores); an item row that repeats as a whole is asked once,
different texts under one item id have ranks of their own; an item without terms has no rows;
long texts are taken whole (a text is in one shard, which may exceed
SHARD_TERMS by that text); empty tables give no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runledger.llm.blocks import batch_rows, for_each_shard, stream_past
from runledger.llm.common import stored, text_of

SHARD_DOCS, SHARD_TERMS, BLOCK_ITEMS = 4096, 4_000_000, 32
#: Terms of a shard whose places are kept as one array over its documents (2 bytes a document).
PLACES = 8192
FIRST_STEP = 16

INDEX = "shard long, term binary, df long, total long, docs binary, tfs binary, missing binary"

_DELIMITERS = bytes(i for i in range(128) if not chr(i).isalnum())
_TABLE = bytes.maketrans(_DELIMITERS + bytes(range(65, 91)), b" " * len(_DELIMITERS) + bytes(range(97, 123)))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in order: delimiters are ASCII, so bytes suffice."""
    return text.translate(_TABLE).split()


class _Numbers(dict):
    """Numbers for terms, in order of their first use."""

    def __missing__(self, term: bytes) -> int:
        self[term] = n = len(self)
        return n


class _Shard:
    """Gathers documents until a shard is full, then inverts them."""

    def __init__(self) -> None:
        self.ids, self.lengths, self.words, self.numbers = [], [], [], _Numbers()
        self.size = 0

    def add(self, doc_id: int | None, text: bytes) -> None:
        words = terms_of(text)
        self.ids.append(doc_id)
        self.lengths.append(len(words))
        self.words.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def full(self, most: int) -> bool:
        return len(self.ids) >= most or self.size >= SHARD_TERMS

    def rows(self, shard: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """One row per term, documents numbered in order of their ids (null last), and one row of the documents."""
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i] or 0))
        lengths = np.array(self.lengths, np.int64)[order]
        words = np.concatenate([self.words[i] for i in order])
        place = np.repeat(np.arange(len(order), dtype=np.int64), lengths)
        key, tf = np.unique((words.astype(np.int64) << 16) | place, return_counts=True)
        first = np.flatnonzero(np.diff(key >> 16, prepend=-1))
        edges = np.append(first, len(key))
        docs, tfs = (key & 0xFFFF).astype("<u2"), tf.astype("<i4")
        flat = lambda a: pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer((edges * a.itemsize).astype(np.int64)), pa.py_buffer(a)]).cast(pa.binary())
        n, none = len(first), pa.nulls(len(first), pa.binary())
        if n:
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n, shard)), pa.array(list(self.numbers), pa.binary()), pa.array(np.diff(edges)), pa.array(np.add.reduceat(tf, first).astype(np.int64)), flat(docs), flat(tfs), none], schema=schema)
        ids = [self.ids[i] for i in order]
        yield pa.RecordBatch.from_pylist([{
            "shard": shard, "term": None, "df": int((lengths > 0).sum()), "total": int(lengths.sum()), "docs": np.array([i or 0 for i in ids], "<i8").tobytes(),
            "tfs": lengths.astype("<i4").tobytes(), "missing": bytes(i is None for i in ids)}], schema=schema)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_docs: int = SHARD_DOCS) -> DataFrame:
    """The stored index (INDEX): per shard one row a term, and one row with null ``term`` for its documents."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    schema = pa.schema([(n, pa.int64() if t == "long" else pa.binary()) for n, t in (c.split() for c in INDEX.split(", "))])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, cut, shard = TaskContext.get().partitionId(), 0, _Shard()
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                shard.add(doc_id, text)
                if shard.full(shard_docs):
                    yield from shard.rows((part << 32) + cut, schema)  # the same for every attempt of a task
                    cut, shard = cut + 1, _Shard()
        if shard.ids:
            yield from shard.rows((part << 32) + cut, schema)

    with batch_rows(docs.sparkSession, 256):
        return stored(rows.mapInArrow(build, INDEX), "impact-lists")


class ImpactLists:
    """The lists of a shard for the terms that items ask for, ordered by impact."""

    def __init__(self, rows: list[dict], n_docs: int, n_terms: int, most_places: int = PLACES):
        (own,) = [r for r in rows if r["term"] is None]
        self.ids, self.missing = np.frombuffer(own["docs"], "<i8"), np.frombuffer(own["missing"], np.uint8)
        n = np.frombuffer(own["tfs"], "<i4").astype(np.int64)
        m = 100 - 75 + (75 * n * n_docs) // max(n_terms, 1)
        self.lists, self.places, self.most_places = {}, {}, most_places
        for r in rows:
            if r["term"] is not None:
                docs, tf = np.frombuffer(r["docs"], "<u2"), np.frombuffer(r["tfs"], "<i4").astype(np.int64)
                impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[docs])
                order = np.argsort(-impact, kind="stable")
                self.lists[r["term"]] = docs[order], np.append(impact[order], 0)

    def place(self, term: bytes) -> np.ndarray:
        """Where each document stands in a list; the list's length if it isn't there."""
        if term not in self.places:
            if len(self.places) >= self.most_places:
                self.places = {}
            docs = self.lists[term][0]
            place = np.full(len(self.ids), len(docs), np.uint16 if len(docs) < 1 << 16 else np.int32)
            place[docs] = np.arange(len(docs))
            self.places[term] = place
        return self.places[term]

    def best(self, terms: list[bytes], weights: list[int], k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best documents (numbers in the shard, in order) and their scores, by best positions."""
        lists = [(*self.lists[t], self.place(t), w) for t, w in zip(terms, weights) if t in self.lists]
        seen, marks, at = np.zeros(len(self.ids), bool), [np.zeros(len(x[1]), bool) for x in lists], [0] * len(lists)
        top, score = np.empty(0, np.int64), np.empty(0, np.int64)
        depth, step, deepest = 0, max(FIRST_STEP, k), max((len(x[0]) for x in lists), default=0)
        while depth < deepest:
            met = np.concatenate([docs[depth:depth + step] for docs, _, _, _ in lists])
            met = np.unique(met[~seen[met]])
            seen[met] = True
            total = np.zeros(len(met), np.int64)
            for (_, impact, place, w), mark in zip(lists, marks):  # direct accesses
                where = place[met]
                total += w * impact[where]
                mark[where] = True
            top, score = np.append(top, met), np.append(score, total)
            order = np.lexsort((top, -score))[:k]
            top, score = top[order], score[order]
            depth, step = depth + step, step * 2
            threshold = 0
            for i, ((docs, impact, _, w), mark) in enumerate(zip(lists, marks)):
                gaps = mark[at[i]:len(docs)]
                at[i] += int(np.argmin(gaps)) if not gaps.all() else len(gaps)
                threshold += w * int(impact[at[i] - 1]) if at[i] < len(docs) else 0
            if len(top) == k and threshold < score[-1]:
                break
        return top[score > 0], score[score > 0]


FOUND = "item long, doc_id long, score long"


def search(index: DataFrame, items: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every item."""
    items = items.select(F.col(id_col).alias("item_id"), text_of(text_col).alias("text")).distinct()
    items = stored(items.withColumn("item", F.monotonically_increasing_id()), "items")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, text in zip(b.column("item").to_pylist(), b.column("text").cast(pa.binary()).to_pylist()):
                terms, times = np.unique(np.array(terms_of(text), object), return_counts=True) if terms_of(text) else ([], [])
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(terms), pa.int64()), pa.array(list(terms), pa.binary()), pa.array(list(times), pa.int64())], ["item", "term", "times"])

    asked = stored(items.mapInArrow(count, "item long, term binary, times long"), "item-terms")
    heads = index.where("term is null")
    n_docs, n_terms, n_shards = heads.agg(F.coalesce(F.sum("df"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0)), F.count(F.lit(1))).first()
    lists = index.join(asked.select("term").distinct(), "term", "left_semi")
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2.0 * F.sum("df") + 1))).cast("long")
    weights = lists.groupBy("term").agg(weight.alias("weight")).where("weight > 0")
    packed = asked.join(weights, "term").groupBy("item").agg(F.collect_list("term").alias("terms"), F.collect_list(F.col("weight") * F.col("times")).alias("weights"))
    n_blocks = max(1, -(-items.count() // BLOCK_ITEMS))
    packed = stored(packed.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(n_blocks)).cast("long")), "item-blocks")
    queries = for_each_shard(packed.groupBy("block").agg(F.collect_list(F.struct("item", "terms", "weights")).alias("queries")), heads.select("shard", F.lit(n_blocks).cast("long").alias("blocks")))
    columns = ["shard", "term", "docs", "tfs", "missing"]

    def ask(shard: ImpactLists, row: dict) -> Iterator[pa.RecordBatch]:
        out = [(q["item"], *shard.best(q["terms"], q["weights"], k)) for q in row["queries"]]
        docs = np.concatenate([d for _, d, _ in out])
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat([i for i, _, _ in out], [len(d) for _, d, _ in out]).astype(np.int64)), pa.array(shard.ids[docs], mask=shard.missing[docs].astype(bool)),
            pa.array(np.concatenate([s for _, _, s in out]))], ["item", "doc_id", "score"])

    with batch_rows(index.sparkSession, 2048):
        found = stored(stream_past(lists.select(columns).unionByName(heads.select(columns)), queries, 2 * n_shards, lambda rows: ImpactLists(rows, n_docs, n_terms), ask, FOUND), "found")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
