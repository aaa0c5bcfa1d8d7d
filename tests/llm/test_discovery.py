"""Bootstrapped identifiers: contexts that stand before everything, a second generation, bounded rounds; neighbours through the query; shards on disk."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_tables import prose
from runledger.llm import ann, hilbert, pii, quality, registry
from runledger.session import fresh_dir


def found(spark, docs):
    rows = pii.find_pii(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    return {r.id: [s.value for s in r["all"] if s.kind == "id"] for r in rows}


def test_a_frequent_context_is_no_pattern(spark):
    """Five e-mails behind "in the" don't make 3,000 numbers behind it identifiers."""
    docs = [(i, f"hello we met in the {chr(97 + i)}x@mail.example.org today") for i in range(5)] + [(100 + i, f"it was in the {40_000_000 + 7 * i} then") for i in range(3000)]
    assert not any(found(spark, docs).values())


def test_found_identifiers_are_seeds_of_the_next_generation(spark):
    """Twelve ids found behind one context teach another, which finds an id that only it has."""
    docs = [(i, f"hello there contact me by {chr(97 + i)}x{i}@mail.example.org today") for i in range(12)]
    docs += [(50 + i, f"now contact me by Q-{77812345 + i} please") for i in range(12)] + [(100 + i, f"her badge number is Q-{77812345 + i} she said") for i in range(12)]
    docs += [(200, "his badge number is Z-55500011 he said"), (201, "the parcel weighs 99911122 grams")]
    got = found(spark, docs)
    assert all(got[50 + i] == got[100 + i] == [f"Q-{77812345 + i}"] for i in range(12)) and got[200] == ["Z-55500011"] and got[201] == []


def test_promotion_asks_for_reliable_patterns(spark):
    """Values that stand in many poor contexts besides aren't seeds, so what they share isn't found."""
    docs = [(i, f"hello there contact me by {chr(97 + i)}x{i}@mail.example.org today") for i in range(12)]
    docs += [(50 + i, f"now contact me by {88800000 + i} please") for i in range(6)]
    docs += [(1000 + 10 * j + i, f"word{j} other{chr(97 + j)} {88800000 + i} end") for j in range(9) for i in range(6)] + [(5000, "wordx othera 12341234 end"), (5001, "her othera 12341234 end")]
    got = found(spark, docs)
    assert not any(v for k, v in got.items() if k >= 1000)


@pytest.mark.parametrize("n", [400])
def test_rounds_do_not_grow_with_shared_values(spark, monkeypatch, n):
    """Two patterns that share n unseen values and have one seed end after the same rounds."""
    seen = []
    stored = pii.stored
    monkeypatch.setattr(pii, "stored", lambda df, name: seen.append(name) or stored(df, name))
    edges = [(p, i, 0) for p in ("a b", "c d") for i in range(n)] + [("a b", -1, 1)]
    assert pii.reliable_patterns(spark.createDataFrame(edges, "pattern string, value long, seed int")).count() == 0
    assert seen.count("live") <= pii.ROUNDS + 1


def test_scores_against_brute_force(spark):
    rng = random.Random(6)
    edges = {(f"p{int(rng.paretovariate(0.8)) % 40}", rng.randint(0, 150)) for _ in range(700)}
    seeds = {v for v in range(151) if rng.random() < 0.55}
    rows = [(p, v, int(v in seeds)) for p, v in edges]
    of = {v: [p for p, w in edges if w == v] for v in range(151)}
    n = {p: sum(q == p for q, _ in edges) for p, _ in edges}
    s = {p: sum(q == p and v in seeds for q, v in edges) for p in n}
    weight = {p: n[p] + 1 - sum(1 / len(of[v]) for q, v in edges if q == p and v not in seeds) for p in n}
    score = {p: s[p] / weight[p] for p in n}
    for _ in range(pii.ROUNDS):
        new = {p: (s[p] + pii.SPREAD * sum(sum(score[q] for q in of[v] if q != p) / len(of[v]) for r, v in edges if r == p and v not in seeds)) / weight[p] for p in n}
        change, score = max(abs(new[p] - score[p]) for p in n), new
        if change < pii.TOLERANCE:
            break

    def low(p):
        x, z = s[p] / n[p], pii.Z
        return (x + z * z / (2 * n[p]) - z * np.sqrt(x * (1 - x) / n[p] + z * z / (4 * n[p] ** 2))) / (1 + z * z / n[p])
    want = {p for p in n if score[p] >= pii.CONFIDENCE and s[p] >= pii.SUPPORT and low(p) >= pii.LEAST_SHARE}
    got = {r.pattern: r.p for r in pii.reliable_patterns(spark.createDataFrame(rows, "pattern string, value long, seed int")).collect()}
    assert set(got) == want and all(abs(got[p] - score[p]) < 1e-9 for p in got)


def test_recall_through_the_query(spark, tmp_path, monkeypatch):
    """Several shards: their graphs are loaded once each, merged results keep 0.9 of the exact ones."""
    monkeypatch.setattr(ann, "SHARD_ROWS", 300)
    monkeypatch.setattr(ann.build_index, "__defaults__", (300,))
    rng = np.random.default_rng(1)
    v = rng.normal(size=(1500, 16)).astype(np.float32)
    v[700:720] = v[50]
    folder = str(tmp_path / "t")
    spark.createDataFrame([(i, x.tolist(), 0) for i, x in enumerate(v)], "vec_id long, embedding array<float>, label int").repartition(5).write.parquet(f"{folder}/embeddings.parquet")
    got = {}
    for r in registry.QUERIES["op2_hnsw"](spark, folder).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    w = v.astype(np.float64) / np.linalg.norm(v.astype(np.float64), axis=1, keepdims=True)
    hit = 0
    for q in range(0, 1500, 50):
        score = w @ w[q]
        score[q] = -9
        want = sorted(range(1500), key=lambda i: (-round(score[i], 12), i))[:5]
        assert sorted(got[q]) == [1, 2, 3, 4, 5] and all(abs(score[i] - s) < 1e-9 for i, s in got[q].values())
        hit += len(set(want) & {i for i, _ in got[q].values()})
    assert hit / 150 >= 0.9
    assert [got[50][r][0] for r in range(1, 6)] == [700, 701, 702, 703, 704]


def test_repeated_ids_of_the_sample(spark):
    """An id with a third of all rows gives the classifier one row."""
    rng = random.Random(3)
    docs = [(i, prose(rng, 30)) for i in range(60)] + [(0, prose(rng, 5)) for _ in range(30)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    seen = []
    real = quality.fit_network
    try:
        quality.fit_network = lambda vectors, x, y, calibrate: seen.append(len(x)) or real(vectors, x, y, calibrate)
        quality.fit(spark.createDataFrame(docs, "doc_id long, text string"), labels, F.lit(True))
    finally:
        quality.fit_network = real
    assert seen == [60]


def test_string_dimensions_by_their_whole_values(spark):
    """Strings that agree in hundreds of characters fall into different buckets, in order and of about equal depth."""
    head = "x" * 400
    rows = spark.range(4096).select("id", F.concat(F.lit(head), F.format_string("%05d", "id"), F.lit("é" * 50)).alias("a"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.format_string("v%04d", "id")).alias("b"))
    a, b = hilbert.quantised(rows, ["a", "b"], 4)
    got = rows.select("id", a.alias("a"), b.alias("b")).orderBy("id").collect()
    assert [r.a for r in got] == sorted(r.a for r in got) and len({r.a for r in got}) == 16
    depth = np.bincount([r.a for r in got])
    assert depth.min() > 200 and depth.max() < 320
    assert len({r.b for r in got if r.id % 3 == 0}) == 1 and len({r.b for r in got}) >= 10
    few = hilbert.quantised(rows, ["a"], 4, sample=64)[0]
    assert rows.select(few.alias("a")).distinct().count() >= 10


def test_written_shards_prune(spark):
    """Filters on any dimension leave out files, by the minima and maxima in their footers."""
    import pyarrow.parquet as pq

    from pyarrow import fs
    rows = spark.range(8192).select("id", F.format_string("s%02d", F.col("id") * 37 % 64).alias("a"), (F.col("id") * 53 % 64).alias("b"), (F.col("id") * 29 % 64).alias("c"))
    path = fresh_dir(spark, "shards")
    hilbert.write_shards(hilbert.hilbert_shards(rows, ["a", "b", "c"], ["id"], 64), path)
    root = path.removeprefix("file:")
    files = [i.path for i in fs.LocalFileSystem().get_file_info(fs.FileSelector(root, recursive=True)) if i.path.endswith(".parquet")]
    assert spark.read.parquet(path).count() == 8192 and len(files) >= 64
    for column, value in (("a", "s20"), ("b", 20), ("c", 20)):
        touched = 0
        for f in files:
            meta = pq.ParquetFile(f).metadata
            at = meta.schema.names.index(column)
            stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
            touched += any(s.min <= value <= s.max for s in stats)
        assert touched <= len(files) / 2, column
    assert os.path.isdir(root)

