"""DuckDB oracle SQL for each registered query.

Only the driver's base tables are registered as views in the oracle, so the
proxy tables are inlined as CTEs (FIXTURES.md §2, same text in both engines).
Each oracle is written independently of the Spark code from the operator's
definition; column names match the Spark result exactly.
"""

from __future__ import annotations

# ---- proxy tables (FIXTURES.md §2) --------------------------------------------

RUNS_CTE = """
runs_b AS (SELECT o_orderkey AS run_id, o_orderdate, o_orderkey k,
 CASE CAST(o_orderkey % 8 AS INT) WHEN 0 THEN 'chrome' WHEN 1 THEN 'firefox' WHEN 2 THEN 'safari' WHEN 3 THEN 'edge' WHEN 4 THEN 'chrome-experimental' WHEN 5 THEN 'firefox-experimental' WHEN 6 THEN 'unknown-bot' ELSE 'chrome' END AS browser_name,
 CASE CAST(o_custkey % 6 AS INT) WHEN 0 THEN '62.0' WHEN 1 THEN '63.0 dev' WHEN 2 THEN '64.0 beta' WHEN 3 THEN '59.0a1' WHEN 4 THEN '58.0b1' ELSE '11.1 preview' END AS browser_version,
 CASE o_orderstatus WHEN 'F' THEN 'linux' WHEN 'O' THEN 'windows_x' ELSE 'mac' END AS os_name,
 CASE substr(o_orderpriority,1,1) WHEN '1' THEN '' WHEN '2' THEN '*' WHEN '3' THEN '10' WHEN '4' THEN '3.16' ELSE '10.13' END AS os_version,
 sha1(CAST(o_custkey AS STRING)) AS sha,
 CASE CAST(o_orderkey % 5 AS INT) WHEN 0 THEN 'azure' WHEN 1 THEN 'taskcluster,stable' WHEN 2 THEN 'buildbot,chrome' WHEN 3 THEN 'master,experimental' END AS lab
 FROM orders),
runs AS (SELECT run_id, browser_name, browser_version, os_name, os_version,
 CASE WHEN k % 3 = 0 THEN sha ELSE substr(sha,1,10) END AS revision,
 CASE WHEN k % 4 = 0 THEN '' ELSE sha END AS full_revision_hash,
 CASE WHEN k % 11 = 0 THEN '' WHEN k % 13 = 0 THEN 'https://other.example/x/report.json' WHEN k % 17 = 0 THEN concat('https://storage.example/results/', substr(sha,1,10), '/summary.json')
  ELSE concat('https://storage.example/results/', substr(sha,1,10), '/', browser_name, '-', browser_version, CASE WHEN k % 5 = 0 THEN '-' ELSE '_' END, os_name, '-', os_version, '/report.json') END AS raw_results_url,
 o_orderdate AS created_at,
 CASE WHEN k % 7 = 0 THEN NULL ELSE o_orderdate END AS time_start,
 CASE CAST(k % 4 AS INT) WHEN 0 THEN o_orderdate + INTERVAL '10' MINUTE WHEN 1 THEN o_orderdate + INTERVAL '5' MINUTE WHEN 2 THEN o_orderdate + INTERVAL '45' MINUTE ELSE o_orderdate + INTERVAL '11' MINUTE END AS time_end,
 string_split(lab, ',') AS labels FROM runs_b)"""

CELLS_CTE = """
cells AS (SELECT l_orderkey AS run_id, concat('/', lower(p_type), '/', replace(p_name,' ','/'), '.html') AS test,
 CASE WHEN l_linenumber <= 2 THEN NULL ELSE concat('s', CAST(l_linenumber AS STRING)) END AS subtest,
 CASE l_returnflag WHEN 'A' THEN 'OK' WHEN 'N' THEN 'ERROR' ELSE 'TIMEOUT' END AS status,
 CASE WHEN l_linenumber <= 2 THEN NULL WHEN l_linestatus='F' THEN 'FAIL' ELSE 'PASS' END AS sub_status,
 CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_returnflag, l_linestatus, l_quantity, l_discount, l_tax) AS BIGINT) AS pos
 FROM lineitem JOIN part ON l_partkey = p_partkey)"""

REVISIONS_CTE = """
revisions AS (SELECT DISTINCT sha1(CAST(o_custkey AS STRING)) AS sha FROM orders WHERE o_custkey % 4 <> 0)"""

OBJECTS_CTE = """
objects AS (SELECT DISTINCT replace(raw_results_url,'report.json','migration.log') AS path FROM runs
 WHERE raw_results_url LIKE '%report.json' AND run_id % 2 = 0)"""

# Reports derived from cells: one result per (run, test); the parent status is
# the status of the row with the highest pos; subtests are the non-NULL
# subtest rows in pos order; results are ordered by the test's lowest pos.
RESULTS_CTE = """
cells_ranked AS (SELECT *, row_number() OVER (PARTITION BY run_id, test ORDER BY pos DESC) AS rk_desc FROM cells),
results AS (SELECT c.run_id, c.test, max(CASE WHEN c.rk_desc = 1 THEN c.status END) AS status,
  min(c.pos) AS first_pos, count(c.subtest) AS n_subtests
  FROM cells_ranked c GROUP BY c.run_id, c.test),
results_pos AS (SELECT *, CAST(row_number() OVER (PARTITION BY run_id ORDER BY first_pos) - 1 AS BIGINT) AS result_pos FROM results)"""

KNOWN = "['chrome','edge','firefox','safari']"
KNOWN_PRED = ("(CASE WHEN ends_with(browser_name, '-experimental') THEN "
              "substr(browser_name, 1, length(browser_name) - 13) ELSE browser_name END) "
              "IN ('chrome','edge','firefox','safari')")
EXPERIMENTAL_PRED = ("(ends_with(browser_name, '-experimental') OR ends_with(browser_version, ' dev') "
                     "OR ends_with(browser_version, 'a1'))")
LABELS0 = "coalesce(labels, []::VARCHAR[])"


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


RUNS = with_ctes(RUNS_CTE)
RUNS_CELLS = with_ctes(RUNS_CTE, CELLS_CTE)
