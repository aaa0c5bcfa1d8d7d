"""FIXTURES.md §3 selectivity at sf0.01, and SURVEY §5 invariants."""

import pytest
from pyspark.sql import functions as F

from helpers import SF_MID
from runledger.functions import predicates as P
from runledger.operators import cells as C
from runledger.operators import dedup as D
from runledger.operators import reports as RP
from runledger.operators import revisions as REV
from runledger.operators import rules as R
from runledger.operators import search as S
from runledger.plans import queries as Q
from runledger.sources import fixtures as X


@pytest.fixture(scope="module")
def runs(spark):
    return X.runs(spark, SF_MID)


@pytest.fixture(scope="module")
def cells(spark):
    return X.cells(spark, SF_MID)


def _selected(runs, rule):
    _, sel = R.rewrite(runs, rule)
    return sel.count()


def test_tagger_selectivity(spark, runs):
    assert _selected(runs, R.experimental_rule()) == 6867
    assert _selected(runs, R.stable_rule()) == 6258
    assert _selected(runs, R.browser_name_rule()) == 10500
    assert _selected(runs, R.channel_rule()) == 10500
    _, sel = R.rewrite(runs, R.channel_rule())
    assert sel.where(F.col("browser_name").isin("chrome", "firefox", "safari")).count() == 6000
    keys = Q._mainline_keys(spark, SF_MID)
    assert _selected(REV.flag_mainline(runs, keys), R.mainline_rule(F.col("in_mainline"))) == 3856
    assert runs.where(P.is_missing_time("time_start")).count() == 2143


def test_experimental_and_stable_partition_known_browsers(runs):
    e = R.rewrite(runs, R.experimental_rule())[1].select("run_id")
    s = R.rewrite(runs, R.stable_rule())[1].select("run_id")
    known = runs.where(P.is_known_browser()).count()
    assert e.join(s, "run_id").count() == 0
    assert e.count() + s.count() == known == 13125


def test_dedup_counts(runs):
    kept, deleted = D.dedup(runs)
    assert deleted.count() == 1514
    assert kept.count() + deleted.count() == runs.count()
    assert kept.where(~P.is_missing_str("raw_results_url")).select("raw_results_url").distinct().count() == 12122


def test_url_rewrite_counts(spark, runs):
    assert runs.where(RP.in_bucket_report()).count() == 11846
    changed = runs.where(RP.in_bucket_report()).where(
        RP.report_path() != RP.new_report_path(RP.report_path())).count()
    assert changed == 11220
    assert X.objects(spark, SF_MID).count() == 5789


def test_cell_counts(spark, runs, cells):
    assert cells.count() == 60000
    assert C.last_write(cells).count() == 59921
    assert cells.select("test").distinct().count() == 382
    assert C.test_dictionary(cells, runs).count() == 2292
    left = runs.join(cells.select("run_id").distinct(), "run_id", "left_anti")
    assert left.count() == 257


def test_scan_counts(spark):
    hits = Q.prefix_scan(spark, SF_MID)
    assert hits.count() == 45
    assert hits.select("row_key").distinct().count() == 41
    shape = Q.prefix_scan_shape(spark, SF_MID).first()
    assert shape.n_rows == 41
    tests = Q.stored_tests(spark, SF_MID)
    assert S.path_search(tests, "/eco/l/ri").select("test").distinct().count() == 5
    assert S.path_search(tests, "/eco/l").select("test").distinct().count() == 40


def test_revision_counts(spark, runs):
    r = REV.resolve(runs, X.revisions(spark, SF_MID), how="left")
    assert r.where(F.col("resolved_hash").isNull()).count() == 3740
    assert runs.where(P.is_missing_str("full_revision_hash")).count() == 3750


def test_rules_idempotent(spark, runs):
    keys = Q._mainline_keys(spark, SF_MID)
    flagged = REV.flag_mainline(runs, keys)
    for rule in [R.browser_name_rule(), R.channel_rule(), R.experimental_rule(), R.stable_rule(),
                 R.mainline_rule(F.col("in_mainline")), R.time_start_rule()]:
        once, _ = R.rewrite(flagged, rule)
        twice, _ = R.rewrite(once.drop("selected", "changed"), rule)
        assert twice.where("changed").count() == 0, rule.name


def test_dense_ids(spark, runs):
    ids = C.run_dictionary(runs.select("run_id", "created_at"))
    agg = ids.agg(F.min("id"), F.max("id"), F.countDistinct("id"), F.count("*")).first()
    assert tuple(agg) == (0, 14999, 15000, 15000)


def test_pivots_agree(spark):
    a = Q.pivot_by_run(spark, SF_MID)
    b = Q.pivot_by_test(spark, SF_MID)
    assert a.count() == b.count() == 59921
    assert a.exceptAll(b).count() == 0


def test_stream_equals_batch(spark):
    s = Q.stream_consolidate(spark, SF_MID)
    b = Q.consolidate_reports(spark, SF_MID)
    assert s.count() == b.count() > 0
    assert s.exceptAll(b).count() == 0
