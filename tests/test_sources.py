"""Rewrites, refresh, object listings, text sinks."""

import pytest
from pyspark.sql import functions as F

from helpers import run, runs_df
from runledger.operators import reports as RP
from runledger.session import fresh_dir
from runledger.sources import listing as L
from runledger.sources import materialize as M
from runledger.sources import rewritten as RW


def test_rewrite_and_refresh(spark):
    path = fresh_dir(spark, "rw")
    assert RW.write_table(runs_df(spark, [run(1), run(2)]), path).count() == 2
    h = RW.Refreshing(spark, path)
    assert h.refresh() and h.df.count() == 2 and not h.refresh()
    # a second writer of the same path is refused, and the table stays
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        RW.write_table(runs_df(spark, [run(3)]), path)
    assert spark.read.parquet(path).count() == 2
    runs_df(spark, [run(4)]).write.mode("append").parquet(path)
    assert h.refresh() and h.df.count() == 3


def test_derived_tables_follow_their_source(spark, tmp_path):
    src = str(tmp_path / "src")
    runs_df(spark, [run(1)]).write.parquet(src)
    copy = lambda: spark.read.parquet(M.materialize(spark, src, "copy", lambda: spark.read.parquet(src)))
    assert copy().count() == 1
    path = M.table_path(spark, src, "copy")
    runs_df(spark, [run(2)]).write.mode("append").parquet(src)
    assert copy().count() == 2 and M.table_path(spark, src, "copy") != path
    assert M.table_path(spark, "file:" + src, "copy") == M.table_path(spark, src, "copy")


def test_shared_folder_is_stable_and_required(spark, monkeypatch):
    from runledger import session
    base = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_dir(spark, "x").endswith(base.removeprefix("file:") + "/runledger/x")

    class Context:
        master, _jsc = "spark://somewhere:7077", spark.sparkContext._jsc

    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: None)
        sparkContext = Context

    class NoDir:
        isDefined = staticmethod(lambda: False)

    class Jsc:
        sc = staticmethod(lambda: type("S", (), {"getCheckpointDir": staticmethod(lambda: NoDir)}))
    Context._jsc = Jsc
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session)


def test_binary_file_listing(spark, tmp_path):
    base = "https://storage.example/results/"
    for d in ["abc/chrome-1_linux-10", "abc/firefox-2_linux-10"]:
        (tmp_path / d).mkdir(parents=True)
        (tmp_path / d / "report.json").write_text("{}")
    (tmp_path / "abc/chrome-1_linux-10/migration.log").write_text("done")
    listing = L.list_objects(spark, str(tmp_path), "migration.log")
    assert "ReadSchema: struct<path:string>" in listing._jdf.queryExecution().executedPlan().toString()
    objs = L.as_urls(listing, str(tmp_path), base)
    runs = runs_df(spark, [run(1, raw_results_url=base + "abc/chrome-1_linux-10/report.json"),
                           run(2, raw_results_url=base + "abc/firefox-2_linux-10/report.json")])
    assert [r.run_id for r in RP.with_migration_log(runs, objs).collect()] == [1]


def test_shard_files_consolidate(spark, tmp_path):
    import json
    from pyspark.sql import Window
    from runledger.sources import reports_io as RIO
    for rid, tests in {7: ["/a.html", "/b.html"], 8: ["/c.html"]}.items():
        d = tmp_path / str(rid)
        d.mkdir()
        for i, t in enumerate(tests):
            (d / f"{i:03d}.json").write_text(json.dumps({"test": t, "status": "OK", "subtests": []}, indent=1))
    (tmp_path / "8" / "bad.json").write_text("{not json")
    shards, bad = RIO.read_shard_files(spark, str(tmp_path))
    assert [r.source_file.rsplit("/", 1)[1] for r in bad.collect()] == ["bad.json"]
    w = Window.partitionBy("run_id").orderBy("source_file")
    shards = shards.withColumn("first_pos", F.row_number().over(w).cast("bigint"))
    got = {r.run_id: [x.test for x in r.results] for r in
           RP.assemble_reports(shards, runs_df(spark, [run(7), run(8)])).collect()}
    assert got == {7: ["/a.html", "/b.html"], 8: ["/c.html"]}


def test_reports_by_location(spark):
    from runledger.sources import reports_io as RIO
    runs = runs_df(spark, [run(1, raw_results_url="https://Store.example/a/report.json?x=1"), run(2, raw_results_url=""), run(3, raw_results_url="https://store.example/B/report.json")])
    info = ("chrome", "1", "linux", "", "r", "h")
    reps = spark.createDataFrame([("http://store.example/a/report.json", 0, info, [("/t", "OK", [])]), ("", 0, info, [("/u", "OK", [])])],
                                 "location string, part bigint, run_info struct<a:string,b:string,c:string,d:string,e:string,f:string>, results array<struct<test:string,status:string,subtests:array<string>>>")
    assert [r.run_id for r in RIO.join_by_location(runs, reps).collect()] == [1]
    assert sorted(r.run_id for r in RIO.join_by_location(runs, reps, "left").collect()) == [1, 2, 3]
