"""Quality classifier on random-indexing word vectors.

1. Every token (word or run of punctuation, as written) has a sparse index
   vector of NONZERO signs in DIMS places, given by a hash of the token.  A
   token's vector is the sum of its neighbours' index vectors, up to WINDOW
   places to either side, over the whole corpus.  Tokens share BUCKETS hashed
   rows, so the table of vectors is bounded; sums are of whole numbers and
   don't depend on the order of tasks.
2. A document is pooled to the mean and the spread of its tokens' vectors,
   the share of tokens that repeat the one before, the concentration of its
   tokens on few rows, and the logarithm of its length.
3. A network of two layers is fitted on a bounded sample of labelled rows
   (about TRAIN_ROWS, by hash of the id) and its temperature on a part of the
   sample that the fit didn't see; scores are the calibrated probabilities.

Defined results: a null or empty text has the pooled vector 0 and the score
that the network gives it; without labels of both classes all scores are 0.5;
null ids are scored and never learnt from; an id labelled twice counts with
its mean label; rows keep their number; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import free_name, small_batches, stored, text_of

BUCKETS, DIMS, NONZERO, WINDOW = 1 << 14, 32, 4, 2
FEATURES = 2 * DIMS + 3
TRAIN_ROWS, CALIBRATE_PART = 20_000, 5
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 256, 3e-3, 1e-4
TOKEN = re.compile(r"\w+|[^\w\s]+")
#: Rows of the table in one packed message, tokens kept in a worker's table.
CHUNK, CACHE_TOKENS = 64, 500_000


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of every bucket's index vector."""
    rng = np.random.default_rng(20240607)
    places = np.argsort(rng.random((BUCKETS, DIMS)), axis=1)[:, :NONZERO]
    return places, rng.choice([-1.0, 1.0], (BUCKETS, NONZERO))


class Tokens(dict):
    """Bucket of each token, kept for the tokens of a worker."""

    def __missing__(self, token: str) -> int:
        if len(self) > CACHE_TOKENS:
            self.clear()
        self[token] = bucket = zlib.crc32(token.encode("utf-8", "replace")) % BUCKETS
        return bucket

    def of(self, text: str) -> np.ndarray:
        tokens = TOKEN.findall(text)
        return np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))


_TOKENS = Tokens()


def _texts(column: pa.Array) -> list[str]:
    return [t.decode("utf-8", "replace") for t in column.cast(pa.binary()).to_pylist()]


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The table of token vectors (BUCKETS x DIMS, rows of unit length), from all documents."""
    spark = docs.sparkSession
    small_batches(spark)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        total = np.zeros(BUCKETS * DIMS)
        for b in batches:
            parts = [t for t in map(_TOKENS.of, _texts(b.column(0))) if len(t)]
            if not parts:
                continue
            tokens, doc = np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(t) for t in parts])
            for step in range(1, WINDOW + 1):
                same = doc[step:] == doc[:-step]
                left, right = tokens[:-step][same], tokens[step:][same]
                for word, near in ((left, right), (right, left)):
                    total += np.bincount((word[:, None] * DIMS + places[near]).ravel(), signs[near].ravel(), BUCKETS * DIMS)
        chunks = total.reshape(-1, CHUNK * DIMS)
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict({"chunk": list(range(len(chunks))), "part": [part] * len(chunks), "sums": pa.array([c.tobytes() for c in chunks], pa.binary())})

    def add(key: tuple, rows: pa.Table) -> pa.Table:
        total = sum((np.frombuffer(r, np.float64) for r in rows.column("sums").to_pylist()), np.zeros(CHUNK * DIMS))
        return pa.table({"chunk": [key[0].as_py()], "part": [0], "sums": pa.array([total.tobytes()], pa.binary())})

    schema = "chunk long, part long, sums binary"
    sums = stored(docs.select(text_of(text_col)).mapInArrow(gather, schema), "contexts")
    fan = max(1, round(sums.select(F.coalesce(F.max("part"), F.lit(0))).first()[0] ** 0.5))
    # two levels, so that no group holds more than about the square root of the number of tasks
    sums = sums.withColumn("part", F.col("part") % fan).groupBy("chunk", "part").applyInArrow(add, schema)
    sums = sums.groupBy("chunk").applyInArrow(add, schema)
    table = np.zeros((BUCKETS, DIMS))
    for chunk, data in sums.select("chunk", "sums").collect():  # bounded: BUCKETS x DIMS numbers
        table[chunk * CHUNK:(chunk + 1) * CHUNK] = np.frombuffer(data, np.float64).reshape(CHUNK, DIMS)
    length = np.linalg.norm(table, axis=1, keepdims=True)
    return (table / np.where(length > 0, length, 1)).astype(np.float32)


def pooled(texts: Sequence[str], both: np.ndarray) -> np.ndarray:
    """The pooled vectors (FEATURES numbers each); ``both``: token vectors beside their squares."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    for i, text in enumerate(texts):
        tokens = _TOKENS.of(text)
        if len(tokens):
            count = np.bincount(tokens, minlength=0)
            used = np.flatnonzero(count)
            weight = (count[used] / len(tokens)).astype(np.float32)
            mean = weight @ both[used]
            out[i, :DIMS] = mean[:DIMS]
            out[i, DIMS:2 * DIMS] = np.sqrt(np.maximum(mean[DIMS:] - mean[:DIMS] ** 2, 0))
            out[i, -3] = (tokens[1:] == tokens[:-1]).mean() if len(tokens) > 1 else 0
            out[i, -2] = np.log(weight @ weight)
            out[i, -1] = np.log1p(len(tokens))
    return out


def _both(vectors: np.ndarray) -> np.ndarray:
    return np.concatenate([vectors, vectors ** 2], axis=1)


@dataclass
class Model:
    """Token vectors, feature scaling, the network's layers and its temperature."""
    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float = 1.0

    def logits(self, features: np.ndarray) -> np.ndarray:
        if not self.layers:
            return np.zeros(len(features))
        w1, b1, w2, b2 = self.layers
        return np.maximum((features - self.centre) / self.scale @ w1 + b1, 0) @ w2 + b2

    def probability(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(features) / self.temperature, -50, 50)))


def fit_network(vectors: np.ndarray, x: np.ndarray, y: np.ndarray, calibrate: np.ndarray) -> Model:
    """Adam on the rows outside ``calibrate``, then the temperature with the least log loss inside it."""
    fit = ~calibrate
    centre = x[fit].mean(axis=0) if fit.any() else np.zeros(x.shape[1])
    scale = (x[fit].std(axis=0) if fit.any() else np.ones(x.shape[1])) + 1e-6
    model = Model(vectors, centre, scale, [])
    if len(np.unique(y[fit] >= 0.5)) < 2:
        return model
    rng = np.random.default_rng(7)
    z, target = (x[fit] - centre) / scale, y[fit]
    p = [rng.normal(0, (2 / z.shape[1]) ** 0.5, (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, (1 / HIDDEN) ** 0.5, HIDDEN), np.zeros(())]
    m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(z))
        for i in range(0, len(z), BATCH):
            rows = order[i:i + BATCH]
            a = z[rows]
            h = np.maximum(a @ p[0] + p[1], 0)
            d = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -50, 50))) - target[rows]) / len(rows)
            back = np.outer(d, p[2]) * (h > 0)
            grads = [a.T @ back + DECAY * p[0], back.sum(axis=0), h.T @ d + DECAY * p[2], d.sum()]
            t += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - RATE * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
    model.layers = p
    if calibrate.any():
        logits, held = model.logits(x[calibrate]), y[calibrate]
        steps = np.geomspace(0.25, 16, 97)
        loss = [np.mean(np.logaddexp(0, logits / s) - held * logits / s) for s in steps]
        model.temperature = float(steps[int(np.argmin(loss))])
    return model


def fit(docs: DataFrame, labels: DataFrame, use: Column, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
        train_rows: int = TRAIN_ROWS) -> Model:
    """Vectors from all ``docs``; network from about ``train_rows`` rows of ``labels`` that meet ``use``."""
    vectors = word_vectors(docs, text_col)
    known = labels.where(use).where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.avg(label_col).cast("double").alias("label"))
    known = stored(known, "labels")
    n, parts = known.count(), 1 << 20
    sample = known.where(F.pmod(F.xxhash64("id"), F.lit(parts)) < F.lit(int(parts * min(1.0, train_rows / max(n, 1)))))
    # the sample is bounded by train_rows, but for chance
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).join(F.broadcast(sample), "id")
    shared = docs.sparkSession.sparkContext.broadcast(_both(vectors))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pooled(_texts(b.column(1)), shared.value)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([r.tobytes() for r in x], pa.binary())], ["id", "label", "features"])

    kind = rows.schema["id"].dataType.simpleString()
    # one row an id, of those that repeat in ``docs`` the least by its features, so that what is collected is bounded by the sample
    got = rows.mapInArrow(features, f"id {kind}, label double, features binary").groupBy("id").agg(F.min("label").alias("label"), F.min("features").alias("features")).collect()
    got.sort(key=lambda r: (r[0], r[2]))
    x = np.array([np.frombuffer(r[2], np.float32) for r in got], np.float64).reshape(len(got), FEATURES)
    y = np.array([r[1] for r in got])
    calibrate = np.array([zlib.crc32(b"calibrate " + str(r[0]).encode()) % CALIBRATE_PART == 0 for r in got], bool)
    return fit_network(vectors, x, y, calibrate)


def score(docs: DataFrame, model: Model, keep: Sequence[str] | None = None, text_col: str = "text", out: str = "score") -> DataFrame:
    """The columns ``keep`` (all by default) and the score of every whole text, under a free name."""
    spark = docs.sparkSession
    small_batches(spark)
    keep = list(docs.columns if keep is None else keep)
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], text_of(text_col).alias(free_name(keep, "whole_text")))
    name = free_name(keep, out)
    schema = rows.select(*[f"`{c}`" for c in keep], F.lit(0.0).alias(name)).schema
    shared = spark.sparkContext.broadcast((model, _both(model.vectors)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, both = shared.value
        for b in batches:
            p = network.probability(pooled(_texts(b.column(len(keep))), both).astype(np.float64))
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.array(p, pa.float64())], [*keep, name])

    return rows.mapInArrow(run, schema)
