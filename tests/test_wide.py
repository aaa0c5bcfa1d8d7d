"""The wide table's deltas and compaction, its Z-order layout; counted rewrites, the growing dictionary, footer counts."""

import os
import random

import pytest
from pyspark.sql import functions as F

from helpers import CELLS_SCHEMA, run, runs_df
from runledger.operators import cells as C
from runledger.operators import dictionary as DT
from runledger.operators import rules as R
from runledger.operators import search as S
from runledger.operators import wide_table as W
from runledger.session import fresh_dir
from runledger.sources import materialize as M
from runledger.sources import named_files as NF
from runledger.sources import rewritten as RW
from test_postings import leaves, metric

CELLS = "row_key string, family string, qualifier string, value string, ts timestamp, created_at timestamp_ntz, run_id bigint, part bigint, result_pos bigint, sub_pos int"


def load(spark, keys, day, value, per=20):
    """``per`` cells of each row key, written at a day."""
    rows = spark.createDataFrame([(k,) for k in keys], "row_key string").select("row_key", F.explode(F.sequence(F.lit(1), F.lit(per))).alias("q"))
    return rows.select("row_key", F.lit("tests").alias("family"), F.format_string("/q%03d", "q").alias("qualifier"), F.lit(value).alias("value"), F.lit(f"2020-01-{day:02d}").cast("timestamp").alias("ts"),
                       F.lit(None).cast("timestamp_ntz").alias("created_at"), F.lit(1).cast("bigint").alias("run_id"), F.lit(0).cast("bigint").alias("part"), F.lit(0).cast("bigint").alias("result_pos"), F.lit(0).alias("sub_pos"))


def files(path):
    local = NF.file_system(path)[1]
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(local) for f in names if f.endswith(".parquet")}


def content(df):
    return sorted((r.row_key, r.qualifier, r.value) for r in df.collect())


def test_loads_write_their_own_cells_only(spark):
    keys = [f"k{i:04d}" for i in range(400)]
    t = W.WideTable(spark, fresh_dir(spark, "wt"), ranges=16)
    assert t.load(load(spark, keys, 1, "one")) == -1 and len(t.bounds()) == 16
    base = files(f"{t.path}/base")
    new = ["a0000", "k0005", "k0399", "z9999"]
    assert t.load(load(spark, new, 2, "two")) == 0
    assert files(f"{t.path}/base") == base and t.touched([0]) == [0, 15]
    written = spark.read.parquet(f"{t.path}/delta/load=0").count()
    assert written == 4 * 20
    want = {(k, q): "one" for k in keys for q in range(20)} | {(k, q): "two" for k in new for q in range(20)}
    assert content(t.read()) == sorted((k, f"/q{q + 1:03d}", v) for (k, q), v in want.items())
    # an older load changes nothing where a later one wrote
    t.load(load(spark, ["k0005", "k0006"], 1, "old"))
    t.load(load(spark, ["k0007"], 3, "three", per=2))
    now = content(t.read())
    assert ("k0005", "/q001", "two") in now and ("k0007", "/q002", "three") in now and ("k0007", "/q003", "one") in now
    # untouched ranges are read as they are
    assert t.touched(t.loads()) == [0, 15]
    assert t.compact() == [0, 15] and t.loads() == [] and content(t.read()) == now
    after = files(f"{t.path}/base")
    assert {f for f in base if "range=0/" not in f and "range=15/" not in f} <= set(after) and all(after[f] == base[f] for f in base if f in after)
    assert t.compact() == [] and t.load(load(spark, ["k0200"], 4, "four")) == 3 and t.touched([3]) == [8]


def test_compaction_that_dies_changes_nothing(spark, monkeypatch):
    t = W.WideTable(spark, fresh_dir(spark, "wt"), ranges=4)
    t.load(load(spark, ["a", "b", "c", "d"], 1, "one"))
    t.load(load(spark, ["b"], 2, "two"))
    want = content(t.read())
    mark = M.write_marker
    monkeypatch.setattr(M, "write_marker", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        t.compact()
    monkeypatch.setattr(M, "write_marker", mark)
    assert t.loads() == [0] and content(t.read()) == want
    # a load that died has no sign of its end and isn't read
    local = NF.file_system(f"{t.path}/delta")[1]
    os.makedirs(f"{local}/load=1/range=0")
    assert t.loads() == [0] and t.load(load(spark, ["c"], 3, "three")) == 2
    assert content(t.read()) == sorted([*(x for x in want if x[0] != "c"), *((k, q, "three") for k, q, _ in want if k == "c")])


def test_one_row_key_and_empty_loads(spark):
    t = W.WideTable(spark, fresh_dir(spark, "wt"), ranges=8)
    t.load(load(spark, ["only"], 1, "one", per=500))
    t.load(load(spark, ["only"], 2, "x").where("false"))
    t.load(load(spark, ["only", "other"], 3, "two", per=3))
    assert len(content(t.read())) == 503 and sum(v == "two" for *_, v in content(t.read())) == 6


@pytest.fixture(scope="module")
def zordered(spark):
    rng = random.Random(2)
    rows = [(f"b{rng.randint(0, 99):02d}-{i}", "tests", f"/t{rng.randint(0, 299):03d}", rng.choice("PFTO") + str(rng.randint(0, 30)), None) for i in range(20_000)]
    cells = spark.createDataFrame(rows + [("", "other", "", "", None)], "row_key string, family string, qualifier string, value string, ts timestamp")
    path = W.write_zordered(cells, fresh_dir(spark, "zo"), files=64, sample_rows=4000)
    return cells, path


@pytest.mark.parametrize("ranges, most", [({"q_range": ("/t100", "/t110")}, 0.5), ({"v_range": ("F10", "F12")}, 0.6), ({"prefix": "b07"}, 0.5), ({"prefix": "b07", "q_range": ("/t100", "/t110"), "v_range": ("F", "P")}, 0.2), ({}, 1.0),
                                          ({"q_range": ("x", "y")}, 0.0)])
def test_scans_without_a_prefix_open_few_files(spark, zordered, ranges, most):
    cells, path = zordered
    n = spark.read.parquet(f"{path}/zones").count()
    opened = W.files_for(spark, path, ranges.get("prefix", ""), ranges.get("q_range"), ranges.get("v_range"))
    assert n >= 32 and len(opened) <= most * n
    want = S.prefix_scan(cells, ranges.get("prefix", ""), "tests", ranges.get("q_range"), ranges.get("v_range"), 100)
    got = W.range_scan(spark, path, "tests", limit_rows=100, **ranges)
    key = lambda df: sorted((r.row_key, r.qualifier, r.value) for r in df.collect())
    assert key(got) == key(want)
    if opened and most < 1:
        assert max(metric(s, "numFiles") for s in leaves(got)) == len(opened)


def test_one_qualifier(spark, zordered):
    cells, path = zordered
    got = W.qualifier_lookup(spark, path, "tests", "/t123")
    assert got.count() == cells.where("qualifier = '/t123'").count() > 0 and W.qualifier_lookup(spark, path, "tests", "/t1234").count() == 0
    n = spark.read.parquet(f"{path}/zones").count()
    assert len(W.files_for(spark, path, q_range=("/t123", "/t123\0"))) < n / 2
    import pyarrow.parquet as pq
    local = NF.file_system(f"{path}/cells")[1]
    one = next(f for f in os.listdir(local) if f.endswith(".parquet"))
    assert pq.ParquetFile(f"{local}/{one}").metadata.row_group(0).column(2).statistics.min is not None


def test_counts_come_with_the_write(spark):
    runs = runs_df(spark, [run(i, browser_name="firefox" if i % 3 else "unknown", labels=None if i % 2 else ["stable"]) for i in range(60)])
    new, _ = R.rewrite(runs, R.stable_rule())
    back, n = RW.write_rewrite(new, fresh_dir(spark, "counted"))
    rows = new.collect()
    assert n == {"n_rows": 60, "n_selected": sum(r.selected for r in rows), "n_changed": sum(r.changed for r in rows)} and 0 < n["n_changed"] < n["n_selected"] < 60
    assert back.columns == runs.columns and back.count() == 60


def test_rewrite_is_one_scan(spark):
    """The observed plan reads its input once: counts are on the way to the files."""
    path = fresh_dir(spark, "src")
    runs_df(spark, [run(i) for i in range(10)]).write.parquet(path)
    new, _ = R.rewrite(spark.read.parquet(path), R.stable_rule())
    from pyspark.sql import Observation
    plan = new.observe(Observation("x"), F.count(F.lit(1)).alias("n"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan and "Exchange" not in plan


def test_dictionary_keeps_ids(spark):
    runs = runs_df(spark, [run(i) for i in range(6)])
    cells = lambda rows: spark.createDataFrame([(r, t, s, "OK", None, p) for r, t, s, p in rows], CELLS_SCHEMA)
    d = DT.TestDictionary(spark, fresh_dir(spark, "dict"))
    assert d.read().count() == 0 and d.extend(cells([]), runs) == 0
    assert d.extend(cells([(0, "/b", None, 2), (0, "/a", None, 1), (1, "/b", "s", 1)]), runs) == 3
    before = files(d.path)
    assert d.extend(cells([(2, "/a", None, 1), (2, "/b", "s", 2), (2, "/c", "", 3), (2, "/c", None, 4), (3, "/0", None, 1)]), runs) == 3
    assert {f: t for f, t in files(d.path).items() if f in before} == before
    assert sorted(tuple(r) for r in d.read().collect()) == [(0, "/a", None), (1, "/b", None), (2, "/b", "s"), (3, "/c", ""), (4, "/c", None), (5, "/0", None)]
    assert [(x["first"], x["entries"]) for x in d.loads()] == [(0, 0), (0, 3), (3, 3)] and d.extend(cells([(4, "/0", None, 1)]), runs) == 0


def test_counts_from_footers(spark):
    a, b = fresh_dir(spark, "fa"), fresh_dir(spark, "fb")
    spark.range(1000).repartition(3).write.parquet(a)
    spark.range(77).write.parquet(b)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    df = S.counts_from_footers(spark, a, b)
    assert tuple(df.first()) == (1000, 77) and "PushedAggregation: [COUNT(*)]" in df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
