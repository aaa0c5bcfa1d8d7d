"""Oracle SQL (DuckDB dialect) per registered query key."""

from __future__ import annotations

from runledger.plans.oracle import (CELLS_CTE, EXPERIMENTAL_PRED, KNOWN, KNOWN_PRED, LABELS0, RUNS_CELLS,
                                    OBJECTS_CTE, RESULTS_CTE, REVISIONS_CTE, RUNS, RUNS_CTE,
                                    with_ctes)

ORACLE: dict[str, str] = {}


def _rule(sel: str, new_labels: str, base: str = "runs") -> str:
    """One label rewrite over ``base``: selected flag, new labels, changed."""
    return f"""
SELECT run_id, array_to_string(labels, ',') AS labels, selected,
       (old_labels IS DISTINCT FROM labels) AS changed
FROM (SELECT run_id, selected, old_labels,
             CASE WHEN selected THEN {new_labels} ELSE old_labels END AS labels
      FROM (SELECT *, labels AS old_labels, coalesce({sel}, false) AS selected
            FROM {base}) t) u"""


_STABLE_SEL = f"{KNOWN_PRED} AND NOT coalesce({EXPERIMENTAL_PRED}, false)"
_STABLE_NEW = (f"list_sort(list_distinct(list_append(list_filter({LABELS0}, lambda x: x <> 'experimental'),"
               f" 'stable')))")
_EXP_SEL = f"{KNOWN_PRED} AND coalesce({EXPERIMENTAL_PRED}, false)"
_EXP_NEW = (f"list_sort(list_distinct(list_append(list_filter({LABELS0}, lambda x: x <> 'stable'),"
            f" 'experimental')))")
_BN_SEL = f"{KNOWN_PRED} AND NOT list_has_any({LABELS0}, {KNOWN})"
_BN_NEW = (f"list_append({LABELS0}, CASE WHEN ends_with(browser_name, '-experimental') THEN "
           f"substr(browser_name, 1, length(browser_name) - 13) ELSE browser_name END)")
_CHANNEL = ("CASE WHEN browser_name = 'chrome' AND ends_with(browser_version, ' dev') THEN 'dev' "
            "WHEN browser_name = 'chrome' AND ends_with(browser_version, ' beta') THEN 'beta' "
            "WHEN browser_name = 'firefox' AND ends_with(browser_version, 'a1') THEN 'nightly' "
            "WHEN browser_name = 'firefox' AND ends_with(browser_version, 'b1') THEN 'beta' "
            "WHEN browser_name = 'safari' AND (contains(browser_version, 'preview') "
            "OR contains(browser_version, 'Preview')) THEN 'preview' END")
_CH_SEL = (f"{KNOWN_PRED} AND NOT list_has_any({LABELS0}, "
           f"['stable','release','beta','dev','canary','nightly','preview'])")
_CH_NEW = f"CASE WHEN ({_CHANNEL}) IS NOT NULL THEN list_append({LABELS0}, {_CHANNEL}) ELSE labels END"
_ZERO = "TIMESTAMP '0001-01-01 00:00:00'"
_MAINLINE_SEL = (f"NOT list_has_any({LABELS0}, ['master','pr_base','pr_head']) "
                 f"AND list_has_any({LABELS0}, ['azure','taskcluster','buildbot']) "
                 f"AND coalesce(time_end, {_ZERO}) > coalesce(time_start, {_ZERO}) + INTERVAL '10' MINUTE "
                 f"AND revision IN (SELECT sha FROM revisions UNION SELECT substr(sha, 1, 10) FROM revisions)")
_MAINLINE_NEW = f"list_append({LABELS0}, 'master')"

ORACLE["tag_stable"] = RUNS + _rule(_STABLE_SEL, _STABLE_NEW)
ORACLE["tag_experimental"] = RUNS + _rule(_EXP_SEL, _EXP_NEW)
ORACLE["tag_browser_name"] = RUNS + _rule(_BN_SEL, _BN_NEW)
ORACLE["tag_channel"] = RUNS + _rule(_CH_SEL, _CH_NEW)
ORACLE["tag_master"] = with_ctes(RUNS_CTE, REVISIONS_CTE) + _rule(_MAINLINE_SEL, _MAINLINE_NEW)

ORACLE["backfill_time_start"] = RUNS + f"""
SELECT run_id, CAST(CASE WHEN sel THEN created_at ELSE time_start END AS VARCHAR) AS time_start,
       sel AS selected, (time_start IS DISTINCT FROM CASE WHEN sel THEN created_at ELSE time_start END) AS changed
FROM (SELECT *, (time_start IS NULL OR time_start = {_ZERO}) AS sel FROM runs) t"""

ORACLE["dry_run_selected"] = RUNS + f"""
SELECT run_id, browser_name, browser_version,
       (labels IS DISTINCT FROM ({_CH_NEW})) AS changed
FROM runs WHERE coalesce({_CH_SEL}, false)"""


def _chain_sql() -> str:
    # Each step keeps every column, rewrites labels and ORs its flag into any_sel.
    steps = [(_EXP_SEL, _EXP_NEW), (_STABLE_SEL, _STABLE_NEW), (_CH_SEL, _CH_NEW),
             (_BN_SEL, _BN_NEW), (_MAINLINE_SEL, _MAINLINE_NEW)]
    ctes = ["c0 AS (SELECT *, labels AS old_labels, time_start AS old_ts, false AS any_sel FROM runs)"]
    for i, (sel, new) in enumerate(steps, start=1):
        ctes.append(f"""c{i}s AS (SELECT *, coalesce({sel}, false) AS s FROM c{i - 1})""")
        ctes.append(f"""c{i} AS (SELECT * EXCLUDE (s, labels, any_sel),
  CASE WHEN s THEN {new} ELSE labels END AS labels, (any_sel OR s) AS any_sel FROM c{i}s)""")
    last = len(steps)
    ctes.append(f"""c{last + 1} AS (SELECT *, (time_start IS NULL OR time_start = {_ZERO}) AS s FROM c{last})""")
    body = ",\n".join(ctes)
    return with_ctes(RUNS_CTE, REVISIONS_CTE) + "," + body + f"""
SELECT run_id, array_to_string(labels, ',') AS labels,
  CAST(CASE WHEN s THEN created_at ELSE time_start END AS VARCHAR) AS time_start,
  (any_sel OR s) AS selected,
  ((old_labels IS DISTINCT FROM labels) OR
   (old_ts IS DISTINCT FROM CASE WHEN s THEN created_at ELSE time_start END)) AS changed
FROM c{last + 1}"""


ORACLE["apply_rules_chain"] = _chain_sql()


# ---- duplicates ------------------------------------------------------------------

ORACLE["dedup_runs"] = RUNS + """
SELECT run_id, raw_results_url FROM (
  SELECT run_id, raw_results_url,
         row_number() OVER (PARTITION BY raw_results_url ORDER BY run_id) AS rn
  FROM runs) t
WHERE coalesce(raw_results_url, '') = '' OR rn = 1"""

ORACLE["duplicate_groups"] = RUNS + """
SELECT raw_results_url, run_id, concat_ws('-', browser_name, browser_version) AS product,
       concat_ws('-', os_name, os_version) AS os,
       CASE WHEN rn = 1 THEN 'kept' ELSE 'deleted' END AS role
FROM (SELECT *, row_number() OVER (PARTITION BY raw_results_url ORDER BY run_id) AS rn,
             count(*) OVER (PARTITION BY raw_results_url) AS cnt
      FROM runs WHERE coalesce(raw_results_url, '') <> '') t
WHERE cnt > 1"""

# ---- scans, filters, limits -------------------------------------------------------

ORACLE["scan_runs_ordered"] = RUNS + """
SELECT run_id, CAST(row_number() OVER (ORDER BY time_start DESC NULLS LAST, run_id) - 1 AS BIGINT) AS rank
FROM runs"""

ORACLE["scan_run_keys"] = RUNS + "SELECT run_id FROM runs"

_FILTER_WHERE = (f"contains(browser_name, 'chrome') AND contains(os_name, 'in') "
                 f"AND len(list_filter({LABELS0}, lambda x: contains(x, 'stab'))) > 0")

ORACLE["filter_runs"] = RUNS + f"""
SELECT run_id, browser_name, os_name, array_to_string(labels, ',') AS labels
FROM runs WHERE {_FILTER_WHERE}"""

ORACLE["filter_runs_limit"] = RUNS + f"""
SELECT run_id, browser_name, os_name, CAST(created_at AS VARCHAR) AS created_at
FROM runs WHERE {_FILTER_WHERE}
ORDER BY created_at NULLS FIRST, run_id LIMIT 25"""

# ---- revisions -------------------------------------------------------------------

RUNS_REVS = with_ctes(RUNS_CTE, REVISIONS_CTE)
# Unique-prefix resolution, written as a theta join (fine for the oracle).
_PREFIXES = """
prefixes AS (SELECT d.revision AS prefix, min(v.sha) AS hash
  FROM (SELECT DISTINCT revision FROM runs) d JOIN revisions v ON starts_with(v.sha, d.revision)
  WHERE length(d.revision) BETWEEN 4 AND 40
  GROUP BY d.revision HAVING count(*) = 1)"""

ORACLE["revision_keys"] = RUNS_REVS + """
SELECT DISTINCT key FROM (
  SELECT sha AS key FROM revisions WHERE length(sha) > 9
  UNION ALL SELECT substr(sha, 1, 10) AS key FROM revisions WHERE length(sha) > 9) t"""

ORACLE["resolve_revisions"] = RUNS_REVS + "," + _PREFIXES + """
SELECT r.run_id, r.revision, p.hash AS resolved_hash
FROM runs r LEFT JOIN prefixes p ON r.revision = p.prefix"""

ORACLE["distinct_revisions"] = RUNS_REVS + "," + _PREFIXES + """
SELECT d.revision, p.hash, p.hash IS NOT NULL AS resolved
FROM (SELECT DISTINCT revision FROM runs) d LEFT JOIN prefixes p ON d.revision = p.prefix"""

ORACLE["backfill_full_hash"] = RUNS_REVS + "," + _PREFIXES + """
SELECT run_id, CASE WHEN sel THEN hash ELSE full_revision_hash END AS full_revision_hash,
       sel AS selected, sel AS changed
FROM (SELECT r.*, p.hash,
             coalesce(coalesce(r.raw_results_url, '') <> '' AND p.hash IS NOT NULL
                      AND r.full_revision_hash IS DISTINCT FROM p.hash, false) AS sel
      FROM runs r LEFT JOIN prefixes p ON r.revision = p.prefix) t"""

_PRODUCT = ("concat_ws('-', browser_name, browser_version, os_name, "
            "CASE WHEN coalesce(os_version, '') NOT IN ('', '*') THEN os_version END)")

ORACLE["report_locations"] = RUNS_REVS + "," + _PREFIXES + f"""
SELECT run_id, product_id, report_path, 'https://storage.example/results/' || report_path AS report_url
FROM (SELECT r.run_id, {_PRODUCT} AS product_id,
             concat_ws('/', p.hash, {_PRODUCT}, 'report.json') AS report_path
      FROM runs r JOIN prefixes p ON r.revision = p.prefix) t"""

ORACLE["next_to_consolidate"] = RUNS_REVS + "," + _PREFIXES + """
SELECT r.run_id, p.hash AS resolved_hash, CAST(r.created_at AS VARCHAR) AS created_at
FROM runs r JOIN prefixes p ON r.revision = p.prefix
WHERE coalesce(r.raw_results_url, '') = ''
ORDER BY r.created_at DESC NULLS LAST, r.run_id LIMIT 10"""

# ---- scalar functions ------------------------------------------------------------

_PATH = ("CASE WHEN starts_with(raw_results_url, 'https://storage.example/results/') "
         "THEN substr(raw_results_url, 33) ELSE raw_results_url END")

ORACLE["scalar_functions"] = RUNS + f"""
SELECT run_id,
  CASE WHEN ends_with(browser_name, '-experimental') THEN substr(browser_name, 1, length(browser_name) - 13)
       ELSE browser_name END AS f1_trimmed,
  {_PATH} AS f2_path,
  translate({_PATH}, '_* ', '-__') AS f3_new_path,
  (starts_with(raw_results_url, 'https://') AND ends_with(raw_results_url, '.json')
   AND contains(browser_version, ' ')) AS f4_tests,
  trim(concat(' ' || chr(9), revision, chr(10) || chr(11)),
       ' ' || chr(9) || chr(13) || chr(10) || chr(11)) AS f5_trimmed,
  array_to_string(string_split({_PATH}, '/')[2:], '|') AS f6_pieces,
  array_to_string(regexp_split_to_array(browser_version, '[ .]'), '|') AS f7_pieces,
  substr(revision, 1, 10) AS f8_short,
  CAST(length(revision) AS BIGINT) AS f8_len,
  concat({_PRODUCT}, '@', full_revision_hash) AS f9_product,
  strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') AS f10_rfc3339,
  coalesce(time_end, {_ZERO}) > coalesce(time_start, {_ZERO}) + INTERVAL '10' MINUTE AS f11_long,
  (time_start IS NULL OR time_start = {_ZERO}) AS f11_zero,
  CASE WHEN regexp_full_match(os_version, '[+-]?[0-9]+')
       THEN TRY_CAST(os_version AS BIGINT) END AS f12_int,
  list_contains({LABELS0}, 'stable') AS f13_has_stable,
  CAST(len(list_append({LABELS0}, 'x')) AS BIGINT) AS f13_size,
  len(list_filter({LABELS0}, lambda x: contains(x, 'ure'))) > 0 AS f13_exists,
  to_json(struct_pack(browser_name := browser_name, os_name := os_name)) AS f14_json,
  labels[1] AS f14_first_label
FROM runs"""


# ---- matrix: reports -> cells, last write, dictionaries, pivots -----------------------

RRC = with_ctes(RUNS_CTE, CELLS_CTE, RESULTS_CTE)
_SUB_ROWS = """
sub_rows AS (SELECT c.run_id, rp.result_pos, c.test, c.subtest, rp.status, c.sub_status,
  CAST(row_number() OVER (PARTITION BY c.run_id, c.test ORDER BY c.pos) - 1 AS INTEGER) AS sub_pos
  FROM cells c JOIN results_pos rp ON c.run_id = rp.run_id AND c.test = rp.test
  WHERE c.subtest IS NOT NULL)"""

ORACLE["explode_cells_matrix"] = RRC + "," + _SUB_ROWS + """
SELECT run_id, result_pos, test, CAST(NULL AS VARCHAR) AS subtest, status,
       CAST(NULL AS VARCHAR) AS sub_status, CAST(NULL AS INTEGER) AS sub_pos FROM results_pos
UNION ALL
SELECT run_id, result_pos, test, subtest, status, sub_status, sub_pos FROM sub_rows"""

_WIDE_ROWS = """
wide_rows AS (
  SELECT run_id, result_pos, test AS qualifier, status AS value, 0 AS sub_pos FROM results_pos
  WHERE n_subtests = 0
  UNION ALL
  SELECT run_id, result_pos, test || '#' || subtest AS qualifier,
         status || '#' || coalesce(sub_status, '') AS value, sub_pos FROM sub_rows)"""

ORACLE["explode_cells_wide"] = RRC + "," + _SUB_ROWS + "," + _WIDE_ROWS + """
SELECT run_id, result_pos, qualifier, value, sub_pos FROM wide_rows"""

_ROW_KEY = ("concat(coalesce(browser_name, ''), '-', coalesce(browser_version, ''), '-', "
            "coalesce(os_name, ''), '-', coalesce(os_version, ''), '@', coalesce(full_revision_hash, ''), "
            "'#', coalesce(strftime(created_at, '%Y-%m-%dT%H:%M:%SZ'), ''))")

_WIDE = f"""
wide AS (SELECT row_key, 'tests' AS family, qualifier, value FROM (
  SELECT {_ROW_KEY} AS row_key, w.qualifier, w.value,
         row_number() OVER (PARTITION BY {_ROW_KEY}, w.qualifier
                            ORDER BY r.created_at DESC, r.run_id DESC, w.result_pos DESC, w.sub_pos DESC) AS rn
  FROM wide_rows w JOIN runs r ON w.run_id = r.run_id) t WHERE rn = 1)"""

WIDE_SQL = RRC + "," + _SUB_ROWS + "," + _WIDE_ROWS + "," + _WIDE

ORACLE["wide_cells"] = WIDE_SQL + "SELECT row_key, qualifier, value FROM wide"

ORACLE["wide_upsert"] = RRC + "," + _SUB_ROWS + "," + _WIDE_ROWS + f"""
SELECT row_key, qualifier, value FROM (
  SELECT {_ROW_KEY} AS row_key, w.qualifier, CASE WHEN w.load = 2 THEN 'again ' || w.value ELSE w.value END AS value,
         row_number() OVER (PARTITION BY {_ROW_KEY}, w.qualifier
                            ORDER BY w.load DESC, r.created_at DESC, r.run_id DESC, w.result_pos DESC, w.sub_pos DESC) AS rn
  FROM (SELECT *, 1 AS load FROM wide_rows UNION ALL SELECT *, 2 FROM wide_rows WHERE run_id % 3 = 0) w
  JOIN runs r ON w.run_id = r.run_id) t WHERE rn = 1"""

ORACLE["last_write_cells"] = with_ctes(CELLS_CTE) + """
SELECT run_id, test, subtest, status, sub_status FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id, test, subtest ORDER BY pos DESC) AS rn FROM cells) t
WHERE rn = 1"""

ORACLE["last_subtest_status"] = with_ctes(CELLS_CTE) + """
SELECT run_id, test, status, sub_status FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id, test ORDER BY pos DESC) AS rn FROM cells) t
WHERE rn = 1"""

_TESTS = """
first_seen AS (SELECT c.test, c.subtest, r.created_at, c.run_id, c.pos,
  row_number() OVER (PARTITION BY c.test, c.subtest ORDER BY r.created_at, c.run_id, c.pos) AS rn
  FROM cells c JOIN runs r ON c.run_id = r.run_id),
tests AS (SELECT CAST(row_number() OVER (ORDER BY created_at, run_id, pos) - 1 AS BIGINT) AS id, test, subtest
  FROM first_seen WHERE rn = 1),
run_index AS (SELECT CAST(row_number() OVER (ORDER BY created_at, run_id) - 1 AS BIGINT) AS id, run_id, created_at
  FROM runs)"""

RUNS_CELLS_TESTS = with_ctes(RUNS_CTE, CELLS_CTE, _TESTS)

ORACLE["test_dictionary"] = RUNS_CELLS_TESTS + "SELECT id, test, subtest FROM tests"
ORACLE["run_dictionary"] = RUNS_CELLS_TESTS + \
    "SELECT id, run_id, CAST(created_at AS VARCHAR) AS created_at FROM run_index"

_NORM = ("CASE WHEN {c} IS NULL THEN NULL WHEN upper(trim({c})) IN ('OK','PASS','FAIL','ERROR','TIMEOUT',"
         "'NOTRUN','CRASH','ASSERT','SKIP','PRECONDITION_FAILED') THEN upper(trim({c})) ELSE 'UNKNOWN' END")

_ENCODED = f"""
encoded AS (SELECT ri.id AS run_idx, t.id AS test_id, {_NORM.format(c='c.status')} AS status,
  {_NORM.format(c='c.sub_status')} AS sub_status, c.pos
  FROM cells c JOIN tests t ON c.test = t.test AND c.subtest IS NOT DISTINCT FROM t.subtest
  JOIN run_index ri ON c.run_id = ri.run_id),
matrix AS (SELECT run_idx, test_id, status, sub_status FROM (
  SELECT *, row_number() OVER (PARTITION BY run_idx, test_id ORDER BY pos DESC) AS rn FROM encoded) t
  WHERE rn = 1)"""

ENCODED = RUNS_CELLS_TESTS + "," + _ENCODED

ORACLE["encode_cells"] = ENCODED + "SELECT run_idx, test_id, status, sub_status, pos FROM encoded"
ORACLE["pivot_by_run"] = ENCODED + "SELECT run_idx, test_id, status, sub_status FROM matrix"
ORACLE["pivot_by_test"] = ORACLE["pivot_by_run"]
ORACLE["count_runs_tests"] = RUNS_CELLS + """
SELECT (SELECT count(*) FROM runs) AS n_runs,
       (SELECT count(*) FROM (SELECT DISTINCT test, subtest FROM cells) d) AS n_tests"""

# ---- reports read / migrate ------------------------------------------------------

ORACLE["read_reports"] = RRC + """
SELECT run_id, result_pos, test, status, CAST(n_subtests AS BIGINT) AS n_subtests FROM results_pos"""

ORACLE["read_reports_by_location"] = RRC + """,
holders AS (SELECT raw_results_url, min(run_id) AS holder FROM runs WHERE coalesce(raw_results_url, '') <> '' GROUP BY 1),
sizes AS (SELECT run_id, count(*) AS n_results, sum(n_subtests) AS n_subtests FROM results GROUP BY 1)
SELECT r.run_id, r.raw_results_url, CAST(s.n_results AS BIGINT) AS n_results, CAST(s.n_subtests AS BIGINT) AS n_subtests
FROM runs r JOIN holders h ON r.raw_results_url = h.raw_results_url JOIN sizes s ON s.run_id = h.holder"""

ORACLE["quarantined_reports"] = RRC + "SELECT DISTINCT run_id, run_id % 50 <> 0 AS read FROM results"

ORACLE["list_objects"] = RUNS + "SELECT DISTINCT CAST(run_id % 50 AS BIGINT) AS folder FROM runs"

ORACLE["runs_without_cells"] = RUNS_CELLS + """
SELECT run_id, CAST(0 AS BIGINT) AS n_results FROM runs
WHERE run_id NOT IN (SELECT run_id FROM cells)"""

_ELIGIBLE = """
eligible AS (SELECT * FROM runs
  WHERE starts_with(raw_results_url, 'https://storage.example/results/')
    AND ends_with(raw_results_url, 'report.json')
    AND (substr(raw_results_url, 1, length(raw_results_url) - 11) || 'migration.log') IN (SELECT path FROM objects))"""

RUNS_OBJ = with_ctes(RUNS_CTE, OBJECTS_CTE, _ELIGIBLE)

ORACLE["has_migration_log"] = RUNS_OBJ + "SELECT run_id, raw_results_url FROM eligible"

_REWRITE = """
rewritten AS (SELECT run_id, old_path, translate(old_path, '_* ', '-__') AS new_path FROM (
  SELECT run_id, substr(raw_results_url, 33) AS old_path FROM eligible) t)"""

ORACLE["rewrite_report_paths"] = RUNS_OBJ + "," + _REWRITE + """
SELECT run_id, old_path, new_path, 'https://storage.example/results/' || new_path AS new_url,
       old_path <> new_path AS path_changed FROM rewritten"""

ORACLE["cleanup_paths"] = RUNS_OBJ + "," + _REWRITE + """
SELECT DISTINCT substr(old_path, 1, length(old_path) - 11) AS dir FROM rewritten o
WHERE old_path <> new_path
  AND NOT EXISTS (SELECT 1 FROM rewritten n
                  WHERE starts_with(n.new_path, substr(o.old_path, 1, length(o.old_path) - 11)))"""

_STAMPED = """
stamped AS (SELECT e.run_id,
  CASE WHEN ends_with(e.browser_name, '-experimental') THEN substr(e.browser_name, 1, length(e.browser_name) - 13)
       ELSE e.browser_name END AS browser_name,
  e.browser_version, e.os_name, e.os_version, e.revision, e.full_revision_hash,
  CAST(count(*) AS BIGINT) AS n_results
  FROM eligible e JOIN results r ON e.run_id = r.run_id
  GROUP BY ALL)"""

RUNS_OBJ_RESULTS = with_ctes(RUNS_CTE, OBJECTS_CTE, _ELIGIBLE, CELLS_CTE, RESULTS_CTE, _STAMPED)

ORACLE["stamp_run_info"] = RUNS_OBJ_RESULTS + """
SELECT run_id, browser_name, browser_version, os_name, os_version, revision, full_revision_hash, n_results
FROM stamped"""

_CELLS_OF = """
report_cells AS (SELECT run_id, test, CAST(NULL AS VARCHAR) AS subtest, status, CAST(NULL AS VARCHAR) AS sub_status FROM results_pos
  UNION ALL SELECT run_id, test, subtest, status, sub_status FROM sub_rows)"""

ORACLE["write_reports"] = RUNS_OBJ_RESULTS + "," + _SUB_ROWS + "," + _CELLS_OF + "," + _REWRITE + """
SELECT s.run_id, s.browser_name, 'https://storage.example/results/' || w.new_path AS location,
       c.test, c.subtest, c.status, c.sub_status
FROM stamped s JOIN rewritten w ON s.run_id = w.run_id JOIN report_cells c ON s.run_id = c.run_id"""
ORACLE["write_reports_plain"] = ORACLE["write_reports"]

ORACLE["migrated_runs"] = RUNS_OBJ_RESULTS + "," + _REWRITE + """
SELECT r.run_id, CASE WHEN s.run_id IS NULL THEN r.raw_results_url
  ELSE 'https://storage.example/results/' || w.new_path END AS raw_results_url
FROM runs r LEFT JOIN stamped s ON r.run_id = s.run_id LEFT JOIN rewritten w ON r.run_id = w.run_id"""

ORACLE["not_selected"] = RUNS + f"SELECT run_id, browser_name FROM runs WHERE NOT coalesce({_CH_SEL}, false)"

ORACLE["gzip_lines"] = with_ctes(REVISIONS_CTE) + "SELECT sha AS value FROM revisions"

# ---- consolidation ------------------------------------------------------------------

_CONSOLIDATED = """
todo AS (SELECT r.*, p.hash FROM runs r JOIN prefixes p ON r.revision = p.prefix
  WHERE coalesce(r.raw_results_url, '') = ''),
consolidated AS (SELECT t.run_id,
  'https://storage.example/results/' || concat_ws('/', t.hash, concat_ws('-', t.browser_name, t.browser_version,
     t.os_name, CASE WHEN coalesce(t.os_version, '') NOT IN ('', '*') THEN t.os_version END), 'report.json')
     AS report_url,
  t.hash AS full_revision_hash,
  CASE WHEN ends_with(t.browser_name, '-experimental') THEN substr(t.browser_name, 1, length(t.browser_name) - 13)
       ELSE t.browser_name END AS browser_name,
  CAST(count(r.test) AS BIGINT) AS n_results,
  CAST(coalesce(sum(r.n_subtests), 0) AS BIGINT) AS n_subtests
  FROM todo t LEFT JOIN results r ON t.run_id = r.run_id
  GROUP BY ALL)"""

CONSOLIDATED = with_ctes(RUNS_CTE, REVISIONS_CTE, _PREFIXES, CELLS_CTE, RESULTS_CTE, _CONSOLIDATED)

ORACLE["consolidate_reports"] = CONSOLIDATED + "," + _SUB_ROWS + "," + _CELLS_OF + """
SELECT t.run_id, t.report_url, t.full_revision_hash, t.browser_name, c.test, c.subtest, c.status, c.sub_status
FROM consolidated t JOIN report_cells c ON t.run_id = c.run_id"""

# ---- scans over the wide table and the dictionary -------------------------------------

_PREFIX_HITS = """
hits AS (SELECT * FROM wide WHERE starts_with(row_key, 'chrome-62.0-linux-') AND family = 'tests'
  AND qualifier >= '/economy/' AND qualifier < '/economy0' AND value >= 'OK' AND value < 'PAST'),
first_rows AS (SELECT DISTINCT row_key FROM hits ORDER BY row_key LIMIT 100)"""

ORACLE["prefix_scan"] = WIDE_SQL + "," + _PREFIX_HITS + """
SELECT row_key, qualifier, value FROM hits WHERE row_key IN (SELECT row_key FROM first_rows)"""

ORACLE["prefix_scan_shape"] = WIDE_SQL + "," + _PREFIX_HITS + """
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(arg_min(n, row_key) AS BIGINT) AS first_row_cells
FROM (SELECT row_key, count(*) AS n FROM hits WHERE row_key IN (SELECT row_key FROM first_rows)
      GROUP BY row_key) t"""

ORACLE["regex_scan"] = WIDE_SQL + """,
rhits AS (SELECT * FROM wide WHERE starts_with(row_key, 'chrome-62.0-linux-') AND family = 'tests'
  AND regexp_full_match(qualifier, '/economy/.*') AND regexp_full_match(value, 'ERROR(#.*)?')),
rrows AS (SELECT DISTINCT row_key FROM rhits ORDER BY row_key LIMIT 100)
SELECT row_key, qualifier, value FROM rhits WHERE row_key IN (SELECT row_key FROM rrows)"""

ORACLE["path_search"] = RUNS_CELLS_TESTS + """
SELECT id, test, subtest FROM (
  SELECT *, string_split(concat_ws(':', test, subtest), '/')[2:] AS seg FROM tests) t
WHERE len(seg) >= 2 AND contains(seg[1], 'eco') AND contains(seg[2], 'l')"""

ORACLE["name_search"] = RUNS_CELLS_TESTS + """
SELECT id, test, subtest FROM tests WHERE contains(concat_ws(':', test, subtest), 'red/gear.html:s')"""

ORACLE["snapshot_roundtrip"] = ENCODED + """
SELECT m.run_idx, m.test_id, ri.run_id, r.browser_name, t.test, t.subtest, m.status, m.sub_status
FROM matrix m JOIN run_index ri ON m.run_idx = ri.id JOIN runs r ON ri.run_id = r.run_id JOIN tests t ON m.test_id = t.id"""
ORACLE["stream_consolidate"] = ORACLE["consolidate_reports"]

ORACLE["apply_rewrite"] = RUNS_REVS + f"""
SELECT r.run_id, r.browser_name, r.browser_version, r.os_name, r.os_version, r.revision, r.full_revision_hash, r.raw_results_url,
  CAST(r.created_at AS VARCHAR) AS created_at, z.time_start, CAST(r.time_end AS VARCHAR) AS time_end, z.labels
FROM runs r JOIN (""" + ORACLE["apply_rules_chain"] + """) z ON r.run_id = z.run_id"""
ORACLE["stream_late_arrivals"] = CONSOLIDATED + """
SELECT r.run_id, coalesce(c.report_url, r.raw_results_url) AS raw_results_url,
       coalesce(c.full_revision_hash, r.full_revision_hash) AS full_revision_hash
FROM runs r LEFT JOIN consolidated c ON r.run_id = c.run_id AND c.n_results > 0"""


# ---- the matrix loader over exploded reports ------------------------------------------

_LOADER = """
ex AS (SELECT run_id, result_pos, test, CAST(NULL AS VARCHAR) AS subtest, status,
         CAST(NULL AS VARCHAR) AS sub_status, -1 AS sp FROM results_pos
       UNION ALL
       SELECT run_id, result_pos, test, subtest, status, sub_status, sub_pos AS sp FROM sub_rows),
rindex AS (SELECT CAST(row_number() OVER (ORDER BY created_at, run_id) - 1 AS BIGINT) AS id, run_id FROM runs),
exi AS (SELECT e.*, ri.id AS run_idx FROM ex e JOIN rindex ri ON e.run_id = ri.run_id),
fs AS (SELECT test, subtest, run_idx, result_pos, sp,
         row_number() OVER (PARTITION BY test, subtest ORDER BY run_idx, result_pos, sp) AS rn FROM exi),
rtests AS (SELECT CAST(row_number() OVER (ORDER BY run_idx, result_pos, sp) - 1 AS BIGINT) AS id, test, subtest
           FROM fs WHERE rn = 1),
rcells AS (SELECT x.run_idx, t.id AS test_id,
   CASE WHEN x.status IS NULL THEN NULL WHEN upper(trim(x.status)) IN ('OK','PASS','FAIL','ERROR','TIMEOUT',
     'NOTRUN','CRASH','ASSERT','SKIP','PRECONDITION_FAILED') THEN upper(trim(x.status)) ELSE 'UNKNOWN' END AS status,
   CASE WHEN x.sub_status IS NULL THEN NULL WHEN upper(trim(x.sub_status)) IN ('OK','PASS','FAIL','ERROR','TIMEOUT',
     'NOTRUN','CRASH','ASSERT','SKIP','PRECONDITION_FAILED') THEN upper(trim(x.sub_status)) ELSE 'UNKNOWN' END
     AS sub_status,
   row_number() OVER (PARTITION BY x.run_idx, t.id ORDER BY x.result_pos DESC, x.sp DESC) AS rn
   FROM exi x JOIN rtests t ON x.test = t.test AND x.subtest IS NOT DISTINCT FROM t.subtest)"""

LOADER = RRC + "," + _SUB_ROWS + "," + _LOADER

ORACLE["report_dictionary"] = LOADER + "SELECT id, test, subtest FROM rtests"
ORACLE["report_matrix"] = LOADER + "SELECT run_idx, test_id, status, sub_status FROM rcells WHERE rn = 1"


# ---- whole files, keyed state, postings (plans/queries_files.py) -----------------------

_BUCKET = "'https://storage.example/results/'"

_HOLDERS = """
holders AS (SELECT raw_results_url, min(run_id) AS holder FROM runs WHERE coalesce(raw_results_url, '') <> '' GROUP BY 1),
sizes AS (SELECT run_id, CAST(count(*) AS BIGINT) AS n_results FROM results GROUP BY 1)"""

ORACLE["reports_at_locations"] = RRC + "," + _HOLDERS + f"""
SELECT run_id, outcome, CASE WHEN outcome = 'read' THEN n_results ELSE 0 END AS n_results FROM (
  SELECT r.run_id, s.n_results, CASE WHEN NOT starts_with(r.raw_results_url, {_BUCKET}) THEN 'elsewhere' WHEN h.holder % 7 = 0 OR s.n_results IS NULL THEN 'missing'
    WHEN h.holder % 5 = 1 THEN 'malformed' WHEN h.holder % 9 = 2 THEN 'empty' ELSE 'read' END AS outcome
  FROM runs r JOIN holders h ON r.raw_results_url = h.raw_results_url LEFT JOIN sizes s ON s.run_id = h.holder) t"""

ORACLE["located_objects"] = RRC + "," + _HOLDERS + f"""
SELECT substr(raw_results_url, 33) AS path FROM holders JOIN sizes ON run_id = holder
WHERE starts_with(raw_results_url, {_BUCKET}) AND holder % 7 <> 0"""

ORACLE["consolidate_shard_files"] = ORACLE["consolidate_reports"]
ORACLE["run_map_files"] = ORACLE["pivot_by_run"]
ORACLE["test_map_files"] = ORACLE["pivot_by_run"]
ORACLE["snapshot_files"] = ORACLE["snapshot_roundtrip"]
ORACLE["stream_pending"] = ORACLE["consolidate_reports"]
ORACLE["path_search_postings"] = ORACLE["path_search"]
ORACLE["name_search_postings"] = ORACLE["name_search"]

ORACLE["path_search_capped"] = RUNS_CELLS_TESTS + """
SELECT id, test, subtest FROM (
  SELECT *, string_split(concat_ws(':', test, subtest), '/')[2:] AS seg FROM tests) t
WHERE len(seg) >= 2 AND contains(seg[1], 'standard') AND contains(seg[2], 'b') ORDER BY id LIMIT 40"""

ORACLE["mainline_runs"] = RUNS_REVS + """
SELECT run_id, revision FROM runs WHERE revision IN (SELECT sha FROM revisions UNION SELECT substr(sha, 1, 10) FROM revisions)"""

ORACLE["refreshed_runs"] = RUNS + "SELECT run_id, browser_name FROM runs"

# ---- deltas, Z-order, counts, a growing dictionary, footers ----------------------------

ORACLE["wide_deltas"] = RRC + "," + _SUB_ROWS + "," + _WIDE_ROWS + f"""
SELECT row_key, qualifier, value FROM (
  SELECT {_ROW_KEY} AS row_key, w.qualifier, CASE w.load WHEN 1 THEN w.value WHEN 2 THEN 'again ' || w.value ELSE 'more ' || w.value END AS value,
         row_number() OVER (PARTITION BY {_ROW_KEY}, w.qualifier
                            ORDER BY w.load DESC, r.created_at DESC, r.run_id DESC, w.result_pos DESC, w.sub_pos DESC) AS rn
  FROM (SELECT *, 1 AS load FROM wide_rows UNION ALL SELECT *, 2 FROM wide_rows WHERE run_id % 3 = 0
        UNION ALL SELECT *, 3 FROM wide_rows WHERE run_id % 5 = 0) w
  JOIN runs r ON w.run_id = r.run_id) t WHERE rn = 1"""


def _scan(where: str) -> str:
    return WIDE_SQL + f""",
hits AS (SELECT * FROM wide WHERE family = 'tests' AND {where}),
first_rows AS (SELECT DISTINCT row_key FROM hits ORDER BY row_key LIMIT 100)
SELECT row_key, qualifier, value FROM hits WHERE row_key IN (SELECT row_key FROM first_rows)"""


ORACLE["qualifier_scan"] = _scan("qualifier >= '/economy/b' AND qualifier < '/economy/c'")
ORACLE["value_scan"] = _scan("value >= 'TIMEOUT#P' AND value < 'U'")

ORACLE["qualifier_cells"] = WIDE_SQL + """
SELECT row_key, qualifier, value FROM wide WHERE family = 'tests' AND qualifier = (SELECT min(qualifier) FROM wide)"""

_COUNTED = """
c0 AS (SELECT *, labels AS old_labels, coalesce({exp}, false) AS s0 FROM runs),
c1 AS (SELECT * EXCLUDE (labels), CASE WHEN s0 THEN {exp_new} ELSE labels END AS labels FROM c0),
c2 AS (SELECT *, coalesce({ch}, false) AS s1 FROM c1),
c3 AS (SELECT s0 OR s1 AS selected, old_labels, CASE WHEN s1 THEN {ch_new} ELSE labels END AS labels FROM c2)""".format(exp=_EXP_SEL, exp_new=_EXP_NEW, ch=_CH_SEL, ch_new=_CH_NEW)

ORACLE["rewrite_counts"] = RUNS + "," + _COUNTED + """
SELECT CAST(count(*) AS BIGINT) AS n_written, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER (selected) AS BIGINT) AS n_selected,
       CAST(count(*) FILTER (old_labels IS DISTINCT FROM labels) AS BIGINT) AS n_changed FROM c3"""

ORACLE["dictionary_two_loads"] = RUNS_CELLS + """,
seen AS (SELECT c.test, c.subtest, r.created_at, c.run_id, c.pos, c.run_id % 2 AS load FROM cells c JOIN runs r ON c.run_id = r.run_id),
firsts AS (SELECT * FROM seen QUALIFY row_number() OVER (PARTITION BY test, subtest ORDER BY load, created_at, run_id, pos) = 1)
SELECT CAST(row_number() OVER (ORDER BY load, created_at, run_id, pos) - 1 AS BIGINT) AS id, test, subtest FROM firsts"""

ORACLE["count_from_footers"] = ORACLE["count_runs_tests"]
