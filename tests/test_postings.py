"""Trigram postings: the same results as the scans, over fewer rows; revisions by their neighbours."""

import random

import pytest
from pyspark.sql import functions as F

from runledger.operators import postings as PT
from runledger.operators import revisions as REV
from runledger.operators import search as S
from runledger.session import fresh_dir


def leaves(df):
    """The scans of the plan that ran."""
    df.collect()
    out = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "FileSourceScanExec":
            out.append(node)
        for more in (node.children(), node.subqueries()):  # a scan's partitions may be chosen by a subquery
            for i in range(more.size()):
                walk(more.apply(i))
    walk(df._jdf.queryExecution().executedPlan())
    return out


def metric(scan, name):
    return scan.metrics().apply(name).value()


def dictionary(spark, n=3000):
    rng = random.Random(5)
    part = lambda: rng.choice(["eco", "economy", "standard", "stand", "st", "a", "brass.html", "x.y", "é中文字", "a:b"]) + rng.choice(["", "1", "22", "/deep/er"])
    rows = [(i, "/" + "/".join(part() for _ in range(rng.randint(1, 4))), None if i % 3 else f"sub {i % 11}/t") for i in range(n)]
    return spark.createDataFrame(rows + [(n, "", None), (n + 1, "noslash", ""), (n + 2, "//double", None), (n + 3, "/eco", "economy")], "id bigint, test string, subtest string")


@pytest.fixture(scope="module")
def both(spark):
    tests = dictionary(spark)
    path = PT.write_index(tests, fresh_dir(spark, "pt"), buckets=16, block_size=256)
    return tests, PT.load_index(spark, path, 16, 256)


def test_same_results_as_the_scans(both):
    tests, index = both
    key = lambda df: sorted(r.id for r in df.collect())
    for q in ["/eco/st", "/economy/standard/brass", "", "/", "/e", "/éc", "/中文字", "//", "/eco//st", "/nothing", "/eco/économie", "/%", "/st_", "/standard/brass.html:sub", "/aaa"]:
        assert key(PT.path_search(index, q)) == key(S.path_search(tests, q)), q
        assert key(PT.path_search(index, q, 5)) == key(S.path_search(tests, q, 5)), q
    for s in ["eco", "", "e", "ml:sub", "b/t", "文字1", "/eco/st", "zzz", "stand22/st", "aaaa", "e/"]:
        assert key(PT.name_search(index, s)) == key(S.name_search(tests, s)), s


def test_searches_read_fewer_rows(spark, both):
    """Only the wanted buckets of the postings and the candidates' blocks of the entries are read."""
    tests, index = both
    query = next(f"/{a}/{b}" for a, b in (t.split("/")[1:3] for (t,) in tests.where("size(split(test, '/')) > 2 and test like '/x.y%'").select("test").collect()) if len(b) > 4)
    rare = PT.path_search(index, query)
    hits = sorted(r.id for r in rare.collect())
    scans = {"postings" if "gram" in s.schema().simpleString() else "entries": s for s in leaves(rare)}
    n_postings, n_entries = index.postings.count(), index.entries.count()
    assert metric(scans["postings"], "numOutputRows") < 0.75 * n_postings
    assert metric(scans["entries"], "numOutputRows") <= n_entries
    plan = rare._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket#" in plan.split("PartitionFilters")[1] + plan.split("PartitionFilters")[2]
    assert hits == sorted(r.id for r in S.path_search(tests, query).collect()) and hits
    # one name: one block of the entries
    one = PT.name_search(index, "/eco:economy")
    scans = {"postings" if "gram" in s.schema().simpleString() else "entries": s for s in leaves(one)}
    assert [r.id for r in one.collect()] == [3003] and metric(scans["entries"], "numOutputRows") <= 256


def test_empty_dictionary(spark):
    path = PT.write_index(dictionary(spark).where("false"), fresh_dir(spark, "pt"))
    index = PT.load_index(spark, path)
    assert PT.path_search(index, "/eco").count() == 0 and PT.name_search(index, "").count() == 0


def test_prefixes_by_neighbours(spark):
    """Against every pair: ties, ids that are prefixes of ids, equal and repeated rows, short and foreign strings."""
    rng = random.Random(9)
    shas = {"".join(rng.choice("ab") for _ in range(rng.randint(3, 12))) for _ in range(400)} | {"abcd" + "e" * i for i in range(6)} | {"f" * 40, "f" * 39 + "e"}
    wanted = [None, "", "ab", "abc", "zzzz", "f" * 40, "f" * 41, "f" * 39, "abcde", "ffff"] + ["".join(rng.choice("ab") for _ in range(rng.randint(4, 12))) for _ in range(600)] + sorted(shas)[:50]
    revs = spark.createDataFrame([(s,) for s in [*shas, *sorted(shas)[:20], None]], "sha string")
    got = {r.prefix: r.hash for r in REV.unique_prefixes(revs, spark.createDataFrame([(w,) for w in wanted], "revision string")).collect()}
    want = {}
    for w in wanted:
        hits = [s for s in shas if len(s) >= 4 and w and s.startswith(w)]
        if w and len(w) >= 4 and len(hits) == 1:
            want[w] = hits[0]
    assert got == want and len(want) > 50


def test_prefixes_are_not_expanded(spark):
    revs = spark.createDataFrame([("a" * 40,)], "sha string")
    plan = REV.unique_prefixes(revs, revs)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "SinglePartition" not in plan and plan.count("Exchange hashpartitioning") == 2 and plan.count("Sort [") == 1
