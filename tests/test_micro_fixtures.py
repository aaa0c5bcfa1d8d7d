"""FIXTURES.md §4: one inline fixture per edge case."""

import datetime as dt
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from helpers import CELLS_SCHEMA, T0, run, runs_df
from runledger.functions import predicates as P
from runledger.operators import cells as C
from runledger.operators import dedup as D
from runledger.operators import reports as RP
from runledger.operators import revisions as REV
from runledger.operators import rules as R
from runledger.operators import run_filters as RF
from runledger.operators import search as S
from runledger.session import fresh_dir
from runledger.sources import reports_io as RIO
from runledger.sources import snapshot as SN

SHA = "0123456789abcdef0123456789abcdef01234567"


def _labels(df, run_id):
    return df.where(F.col("run_id") == run_id).first()["labels"]


# 1. Missing URLs never match each other.
def test_dedup_keeps_missing_urls(spark):
    rows = [run(1, raw_results_url=""), run(2, raw_results_url=""),
            run(3, raw_results_url=None), run(4, raw_results_url=None),
            run(5, raw_results_url="u"), run(6, raw_results_url="u"), run(7, raw_results_url="u")]
    kept, deleted = D.dedup(runs_df(spark, rows))
    assert sorted(r.run_id for r in kept.collect()) == [1, 2, 3, 4, 5]
    assert sorted(r.run_id for r in deleted.collect()) == [6, 7]
    groups = D.duplicate_groups(runs_df(spark, rows)).collect()
    assert sorted((g.run_id, g.role) for g in groups) == [(5, "kept"), (6, "deleted"), (7, "deleted")]


# 2. Set semantics vs append semantics; NULL labels.
def test_label_set_and_append(spark):
    df = runs_df(spark, [run(1, browser_name="chrome-experimental", labels=["stable", "stable", "x"]),
                         run(2, labels=["x", "x"], revision=SHA[:10]),
                         run(3, labels=None, browser_name="firefox")])
    new, _ = R.rewrite(df, R.experimental_rule())
    assert _labels(new, 1) == ["experimental", "x"]
    keys = spark.createDataFrame([(SHA,)], "value string")
    flagged = REV.flag_mainline(df.withColumn("labels", F.when(F.col("run_id") == 2, F.array(
        F.lit("x"), F.lit("x"), F.lit("azure"))).otherwise(F.col("labels"))), REV.revision_keys(keys))
    new, _ = R.rewrite(flagged, R.mainline_rule(F.col("in_mainline")))
    assert _labels(new, 2) == ["x", "x", "azure", "master"]
    new, _ = R.rewrite(df, R.browser_name_rule())
    assert _labels(new, 3) == ["firefox"]


# 3. Selected but unchanged.
def test_channel_selected_unchanged(spark):
    df = runs_df(spark, [run(1, browser_name="chrome-experimental", browser_version="63.0 dev")])
    new, sel = R.rewrite(df, R.channel_rule())
    r = sel.first()
    assert r.selected and not r.changed and r.labels is None


# 4. Case-sensitive preview test.
def test_safari_preview_case(spark):
    df = runs_df(spark, [run(1, browser_name="safari", browser_version="PREVIEW"),
                         run(2, browser_name="safari", browser_version="11 preview"),
                         run(3, browser_name="safari", browser_version="Preview 50")])
    new, _ = R.rewrite(df, R.channel_rule())
    assert _labels(new, 1) is None
    assert _labels(new, 2) == ["preview"]
    assert _labels(new, 3) == ["preview"]


# 5 + 6. Duration edge cases and missing times.
def test_duration_edges(spark):
    z = T0
    rows = [run(1, time_start=z, time_end=z + dt.timedelta(minutes=10)),
            run(2, time_start=z, time_end=z + dt.timedelta(minutes=10, microseconds=1)),
            run(3, time_start=None, time_end=z),
            run(4, time_start=None, time_end=None),
            run(5, time_start=z, time_end=None)]
    out = {r.run_id: r.long for r in runs_df(spark, rows).select(
        "run_id", P.lasted_longer_than("time_start", "time_end").alias("long")).collect()}
    assert out == {1: False, 2: True, 3: True, 4: False, 5: False}


# 7. Mainline keys are the full sha and its 10-char prefix only; resolution
#    accepts any unique prefix of 4+ chars.
def test_revision_lengths(spark):
    revs = [SHA[:7], SHA[:10], SHA[:12], SHA]
    df = runs_df(spark, [run(i, revision=r) for i, r in enumerate(revs)])
    keys = REV.revision_keys(spark.createDataFrame([(SHA,)], "value string"))
    got = sorted(r.run_id for r in REV.in_mainline(df, keys).collect())
    assert got == [1, 3]
    table = spark.createDataFrame([(SHA,), ("0123999999" + "0" * 30,)], "sha string")
    res = {r.run_id: r.resolved_hash for r in REV.resolve(df, table, how="left").collect()}
    assert res == {0: SHA, 1: SHA, 2: SHA, 3: SHA}
    # "0123" is ambiguous: two commits share it.
    amb = runs_df(spark, [run(9, revision="0123")])
    assert REV.resolve(amb, table, how="left").first().resolved_hash is None


# 8. One suffix trimmed only.
def test_trim_one_suffix(spark):
    df = spark.createDataFrame([("x-experimental-experimental",)], "s string")
    assert df.select(P.trim_suffix("s", "-experimental")).first()[0] == "x-experimental"


# 9. Path rewrite and cleanup.
def test_path_rewrite_and_cleanup(spark):
    base = "https://storage.example/results/"
    rows = [run(1, raw_results_url=base + "a_b/c* d/report.json"),
            run(2, raw_results_url=base + "plain/x/report.json")]
    objs = spark.createDataFrame([(base + "a_b/c* d/migration.log",), (base + "plain/x/migration.log",)],
                                 "path string")
    rw = RP.rewrite_report_paths(runs_df(spark, rows), objs)
    got = {r.run_id: (r.new_path, r.path_changed) for r in rw.collect()}
    assert got == {1: ("a-b/c__d/report.json", True), 2: ("plain/x/report.json", False)}
    assert [r.dir for r in RP.cleanup_paths(rw).collect()] == ["a_b/c* d/"]


# 10. OS version in the product id vs the row key.
def test_os_version_product_vs_row_key(spark):
    df = runs_df(spark, [run(1, os_version=""), run(2, os_version="*"), run(3, os_version="10")])
    out = {r.run_id: (r.p, r.k.split("@")[0]) for r in df.select(
        "run_id", RP.product_id().alias("p"), C.row_key().alias("k")).collect()}
    assert out[1] == ("chrome-62.0-linux", "chrome-62.0-linux-")
    assert out[2] == ("chrome-62.0-linux", "chrome-62.0-linux-*")
    assert out[3] == ("chrome-62.0-linux-10", "chrome-62.0-linux-10")


# 11. Report shapes: subtests or not, a test twice, empty, malformed, {}.
def test_report_shapes(spark, tmp_path):
    p = tmp_path / "reports.json"
    docs = [
        {"run_id": 1, "results": [{"test": "/a.html", "status": "OK"},
                                  {"test": "/b.html", "status": "OK",
                                   "subtests": [{"name": "s1", "status": "PASS"},
                                                {"name": "s2", "status": "FAIL"}]},
                                  {"test": "/a.html", "status": "ERROR"}]},
        {"run_id": 2, "results": []},
    ]
    lines = [json.dumps(d) for d in docs] + ["{not json", "{}"]
    p.write_text("\n".join(lines) + "\n")
    good, bad = RIO.read_reports(spark, str(p))
    assert [r.run_id for r in good.collect()] == [1]
    # The malformed line and the keyless "{}" are both quarantined.
    assert bad.count() == 2
    m = C.explode_matrix(good).collect()
    assert len(m) == 5
    assert [(r.test, r.subtest, r.status, r.sub_status) for r in m if r.subtest] == [
        ("/b.html", "s1", "OK", "PASS"), ("/b.html", "s2", "OK", "FAIL")]
    w = {(r.qualifier, r.value) for r in C.explode_wide(good).collect()}
    assert w == {("/a.html", "OK"), ("/b.html#s1", "OK#PASS"), ("/b.html#s2", "OK#FAIL"),
                 ("/a.html", "ERROR")}
    cells = C.explode_matrix(good).withColumn(
        "pos", F.col("result_pos") * 1000 + F.coalesce(F.col("sub_pos") + 1, F.lit(0)))
    lw = {(r.test, r.subtest): r.status for r in C.last_write(cells).collect()}
    assert lw[("/a.html", None)] == "ERROR"
    lit = {r.test: (r.status, r.sub_status) for r in C.last_subtest_status(cells).collect()}
    assert lit["/b.html"] == ("OK", "FAIL")


# 12. Dictionary keys are pairs: "a:b" alone is not ("a", "b").
def test_dictionary_key_collision(spark):
    cells = spark.createDataFrame([(1, "a:b", None, "OK", None, 1), (1, "a", "b", "OK", "PASS", 2)],
                                  CELLS_SCHEMA)
    runs = runs_df(spark, [run(1)])
    d = C.test_dictionary(cells, runs).orderBy("id").collect()
    assert [(r.id, r.test, r.subtest) for r in d] == [(0, "a:b", None), (1, "a", "b")]


# 13. Value half-open range.
def test_value_range(spark):
    vals = ["OK", "PASS", "PASS#FAIL", "OK#PASS", "P", "PAST", "NOTRUN", "FAIL", "TIMEOUT"]
    wide = spark.createDataFrame([("k", "tests", f"/q{i}", v) for i, v in enumerate(vals)],
                                 "row_key string, family string, qualifier string, value string")
    got = sorted(r.value for r in S.prefix_scan(wide, "k", "tests", None, ("OK", "PAST")).collect())
    assert got == sorted(["OK", "PASS", "PASS#FAIL", "OK#PASS", "P"])


# 14. Two runs with one row key: cells merge, last write wins.
def test_same_row_key_merges(spark):
    runs = runs_df(spark, [run(1), run(2)])
    reports = spark.createDataFrame(
        [(1, [("/a.html", "OK", None), ("/b.html", "OK", None)]),
         (2, [("/a.html", "ERROR", None)])],
        "run_id bigint, results array<struct<test:string,status:string,"
        "subtests:array<struct<name:string,status:string>>>>")
    merged = C.merge_wide(C.wide_cells(reports, runs, load_ts=F.lit("2020-01-01").cast("timestamp")))
    got = {(r.row_key.split("#")[0], r.qualifier, r.value) for r in merged.collect()}
    assert got == {("chrome-62.0-linux-3.16@", "/a.html", "ERROR"), ("chrome-62.0-linux-3.16@", "/b.html", "OK")}
    newer = C.wide_cells(reports.where("run_id = 1"), runs, load_ts=F.lit("2021-01-01").cast("timestamp"))
    up = {r.qualifier: r.value for r in C.upsert_wide(merged, newer).collect()}
    assert up == {"/a.html": "OK", "/b.html": "OK"}


# 15. Limits: 0, negative, non-numeric, larger than the data.
def test_limits(spark):
    df = runs_df(spark, [run(i) for i in range(5)])
    n = {lim: RF.filter_runs(df, {"browser_name": "chrome", "limit": lim}).count()
         for lim in ["0", "-3", "abc", " 2", "100", "2"]}
    assert n == {"0": 0, "-3": 0, "abc": 5, " 2": 5, "100": 5, "2": 2}
    import pytest
    with pytest.raises(KeyError):
        RF.run_predicate({"hash": "x"})


def test_snapshot_per_key_files(spark, tmp_path):
    d = tmp_path / "by_run"
    d.mkdir()
    (d / "7.json").write_text(json.dumps({"3": {"status": "OK"}, "4": {"status": "OK", "sub_status": "FAIL"}}))
    (d / "8.json").write_text("{}")
    rows = SN.read_id_maps(spark, str(d)).orderBy("run_idx", "test_id").collect()
    assert [(r.run_idx, r.test_id, r.status, r.sub_status) for r in rows] == [
        (7, 3, "OK", None), (7, 4, "OK", "FAIL")]
    arr = tmp_path / "tests.json"
    arr.write_text('[\n {"id": 0, "test": "/a"},\n {"id": 1, "test": "/a", "subtest": "x"}\n]')
    assert SN.read_json_array(spark, str(arr), SN.TESTS_SCHEMA).count() == 2


def test_gzip_report_roundtrip(spark):
    rep = spark.createDataFrame(
        [(1, ("chrome", "1", "linux", "", "abc", "h"), [("/a.html", "OK", [("s", "PASS")])])],
        "run_id bigint, run_info struct<browser_name:string,browser_version:string,os_name:string,"
        "os_version:string,revision:string,full_revision_hash:string>, results array<struct<test:string,"
        "status:string,subtests:array<struct<name:string,status:string>>>>")
    path = RIO.write_reports(rep, fresh_dir(spark, "t_gz"), "gzip")
    local = path[len("file:"):] if path.startswith("file:") else path
    files = [f for f in os.listdir(local) if f.endswith(".gz")]
    lines = [ln for f in files for ln in gzip.open(os.path.join(local, f)).read().splitlines()]
    assert [json.loads(ln)["run_id"] for ln in lines] == [1]
    good, _ = RIO.read_reports(spark, path)
    assert good.first().results[0].subtests[0].status == "PASS"


def test_path_search_semantics(spark):
    tests = spark.createDataFrame(
        [(0, "/economy/red/gear.html", None), (1, "/economy/red/gear.html", "s3"),
         (2, "/small/red.html", None), (3, "/eco", None)], "id bigint, test string, subtest string")
    ids = lambda q: sorted(r.id for r in S.path_search(tests, q).collect())
    assert ids("/eco/red") == [0, 1]
    assert ids("/eco/red/gear.html:s") == [1]
    assert ids("") == [0, 1, 2, 3]
    assert ids("/") == [0, 1, 2, 3]
    assert ids("/eco/r/x/y") == []
    assert sorted(r.id for r in S.name_search(tests, "gear.html:s3").collect()) == [1]


def test_extend_dictionary_keeps_ids(spark):
    runs = runs_df(spark, [run(1), run(2, created_at=T0 + dt.timedelta(days=1))])
    first = spark.createDataFrame([(1, "/a", None, "OK", None, 1), (1, "/a", "x", "OK", "PASS", 2)],
                                  CELLS_SCHEMA)
    d1 = C.test_dictionary(first, runs)
    more = spark.createDataFrame([(2, "/b", None, "OK", None, 1), (2, "/a", None, "OK", None, 2),
                                  (2, "/a", "y", "OK", "FAIL", 3)], CELLS_SCHEMA)
    d2 = C.extend_dictionary(d1, more, runs).orderBy("id").collect()
    assert [(r.id, r.test, r.subtest) for r in d2] == [
        (0, "/a", None), (1, "/a", "x"), (2, "/b", None), (3, "/a", "y")]


def test_report_parts_bound_rows(spark):
    cells = spark.createDataFrame(
        [(1, f"/t{i}.html", None, "OK" if i < 4 else "ERROR", None, i) for i in range(1, 6)]
        + [(1, "/t1.html", "s", "OK", "PASS", 6)], CELLS_SCHEMA)
    runs = runs_df(spark, [run(1)])
    reps = RP.assemble_reports(RP.results_from_cells(cells), runs, part_size=2)
    parts = {r.part: [x.test for x in r.results] for r in reps.collect()}
    assert parts == {0: ["/t1.html"], 1: ["/t2.html", "/t3.html"], 2: ["/t4.html", "/t5.html"]}
    sizes = RP.report_sizes(reps).first()
    assert (sizes.n_results, sizes.n_subtests) == (5, 1)
    order = [(r.part, r.entry, r.test) for r in
             C.explode_matrix(reps).where("subtest IS NULL").orderBy("part", "entry").collect()]
    assert [t for _, _, t in order] == ["/t1.html", "/t2.html", "/t3.html", "/t4.html", "/t5.html"]


def test_migrate_reports_end_to_end(spark):
    base = "https://storage.example/results/"
    runs = runs_df(spark, [run(1, raw_results_url=base + "h/chrome-1_linux-10/report.json",
                               browser_name="chrome-experimental"),
                           run(2, raw_results_url=base + "h/firefox-2_linux-10/report.json"),
                           run(3, raw_results_url=base + "h/safari-3_mac-10/report.json")])
    objs = spark.createDataFrame([(base + "h/chrome-1_linux-10/migration.log",),
                                  (base + "h/firefox-2_linux-10/migration.log",)], "path string")
    reports = spark.createDataFrame(
        [(1, 0, ("chrome-experimental", "1", "linux", "10", "r", ""), [("/a.html", "OK", None)]),
         (3, 0, ("safari", "3", "mac", "10", "r", ""), [("/a.html", "OK", None)])],
        "run_id bigint, part bigint, run_info struct<browser_name:string,browser_version:string,"
        "os_name:string,os_version:string,revision:string,full_revision_hash:string>, "
        "results array<struct<test:string,status:string,subtests:array<struct<name:string,status:string>>>>")
    new_reports, new_runs, cleanup = RP.migrate_reports(runs, reports, objs)
    r = new_reports.collect()
    assert [(x.run_id, x.location, x.run_info.browser_name) for x in r] == [
        (1, base + "h/chrome-1-linux-10/report.json", "chrome")]
    urls = {x.run_id: x.raw_results_url for x in new_runs.collect()}
    assert urls[1] == base + "h/chrome-1-linux-10/report.json"
    assert urls[2] == base + "h/firefox-2_linux-10/report.json"   # no report: unchanged
    assert urls[3] == base + "h/safari-3_mac-10/report.json"      # no migration log
    assert [x.dir for x in cleanup.collect()] == ["h/chrome-1_linux-10/"]
    path = fresh_dir(spark, "runs_scan")
    new_runs.write.parquet(path)
    ranked = RF.scan_runs(spark, path, "newest").orderBy("rank").collect()
    assert [x.rank for x in ranked] == [0, 1, 2]


def test_subtest_cuts_keep_cells(spark):
    rows = [(1, "/big.html", None, "OK", None, 1)] + \
        [(1, "/big.html", f"s{i}", "OK" if i < 4 else "ERROR", "PASS", i + 1) for i in range(1, 6)]
    cells = spark.createDataFrame(rows, CELLS_SCHEMA)
    runs = runs_df(spark, [run(1)])
    whole = RP.assemble_reports(RP.results_from_cells(cells), runs)
    cut = RP.assemble_reports(RP.results_from_cells(cells, part_size=2), runs)
    assert [len(r.results) for r in whole.collect()] == [1]
    # pos 1 (the base row, dropped: the test has subtests) | 2-3 | 4-5 | 6: three entries, none over two subtests.
    assert sorted(len(x.subtests) for r in cut.collect() for x in r.results) == [1, 2, 2]
    # Every entry carries the parent status (status at the highest position).
    assert {x.status for r in cut.collect() for x in r.results} == {"ERROR"}


@pytest.mark.parametrize("size", [1, 2, 3])
def test_cuts_change_nothing(spark, size):
    """Wide cells, matrix, dictionary and sizes are the same for any part size; parts from 128 on load."""
    rows = [(1, f"/t{i % 4}.html", None if i % 3 == 0 else f"s{i}", "OK" if i % 5 else "ERROR", None if i % 3 == 0 else "PASS", i) for i in range(0, 400)]
    rows += [(1, "/plain.html", None, "OK", None, 1000), (1, "/plain.html", None, "FAIL", None, 1005)]
    cells = spark.createDataFrame(rows, CELLS_SCHEMA)
    runs = runs_df(spark, [run(1)])
    index = C.run_dictionary(runs.select("run_id", "created_at"))

    def out(n):
        reps = RP.assemble_reports(RP.results_from_cells(cells, part_size=n), runs, part_size=n)
        tests, matrix = C.load_matrix(reps, index)
        wide = C.explode_wide(reps).select("run_id", "qualifier", "value", "sub_pos")
        return [sorted(map(tuple, df.collect()), key=str) for df in (wide, tests, matrix, RP.report_sizes(reps))]
    assert out(size) == out(100_000)


def test_rewrite_twice_replaces_flags(spark):
    df = runs_df(spark, [run(1, time_start=None)])
    once, _ = R.rewrite(df, R.time_start_rule())
    twice, _ = R.rewrite(once, R.time_start_rule())
    r = twice.first()
    assert twice.columns.count("selected") == 1 and not r.selected and not r.changed


def test_filter_limit_takes_missing_times_first(spark):
    runs = runs_df(spark, [run(1), run(2, created_at=None)])
    assert [r.run_id for r in RF.filter_runs(runs, {"limit": "1"}).collect()] == [2]
    ids = {r.run_id: r.id for r in C.run_dictionary(runs.select("run_id", "created_at")).collect()}
    assert ids[2] == 0


def test_whole_string_matches(spark):
    from runledger.functions import predicates as P
    from runledger.operators import search as S
    df = spark.createDataFrame([("12",), ("12\n",)], "s string").select(P.parse_int("s").alias("n"))
    assert [r.n for r in df.collect()] == [12, None]
    wide = spark.createDataFrame([("k", "tests", "/a", "OK"), ("k", "tests", "/a\n", "OK")], "row_key string, family string, qualifier string, value string")
    assert [r.qualifier for r in S.regex_scan(wide, "k", "tests", "/a", None).collect()] == ["/a"]


def test_statuses_are_kept_unless_told(spark):
    df = spark.createDataFrame([(" ok ",), ("flaky",), (None,)], "s string")
    assert [r[0] for r in df.select(C.normalize_status("s")).collect()] == ["OK", "FLAKY", None]
    assert [r[0] for r in df.select(C.normalize_status("s", ["OK"])).collect()] == ["OK", "UNKNOWN", None]


def test_long_hashes_resolve(spark):
    from runledger.operators import revisions as REV
    sha = "ab" * 32
    revs = spark.createDataFrame([(sha,), ("abc0" * 10,)], "sha string")
    runs = runs_df(spark, [run(1, revision=sha), run(2, revision=sha[:12]), run(3, revision="ab"), run(4, revision="abc0a")])
    got = {r.run_id: r.resolved_hash for r in REV.resolve(runs, revs, how="left").collect()}
    assert got == {1: sha, 2: sha, 3: None, 4: "abc0" * 10}
