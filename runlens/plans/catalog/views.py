"""Views over the driver's tables, in SQL that Spark and DuckDB both accept.

Every view keeps all rows of the tables it reads; the CASE rules only give rows the shapes the
operators look for (healthy and unhealthy groups, missing bases, container conflicts, and so on).
"""

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

VIEWS: dict[str, str] = {}

# One row per (state, test). Suppliers are groups, line numbers their states.
VIEWS["fx_lines_of_states"] = """
SELECT l_suppkey AS grp, CAST(l_linenumber AS BIGINT) AS variant_no,
       CASE WHEN l_linenumber = 1 AND s_nationkey <> 3 THEN 'base'
            WHEN l_linenumber = 2 THEN 'fixed'
            ELSE 'pred' || CAST(l_linenumber AS VARCHAR(8)) END AS variant,
       't' || CAST(l_partkey % CASE WHEN s_acctbal > 5000 THEN 7 ELSE 97 END AS VARCHAR(8)) AS test,
       CASE WHEN s_acctbal > 7000 THEN 0
            WHEN s_acctbal > 5000 THEN CASE WHEN l_tax >= 0.07 THEN 1 ELSE 0 END
            WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 3
            WHEN l_returnflag = 'R' THEN 2
            WHEN l_returnflag = 'A' AND l_linestatus = 'F' AND l_linenumber > 5 THEN 1
            ELSE 0 END AS severity,
       l_partkey, l_quantity, s_nationkey, s_acctbal
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
"""

VIEWS["fx_outcomes"] = """
SELECT 's' || CAST(grp AS VARCHAR(20)) || '__' || lpad(CAST(grp AS VARCHAR(20)), 8, '0') || '__' || variant AS instance_id,
       grp, variant_no, variant, test, CAST(max(severity) AS BIGINT) AS severity,
       CASE max(severity) WHEN 0 THEN 'PASSED' WHEN 1 THEN 'SKIPPED' WHEN 2 THEN 'FAILED' ELSE 'ERROR' END AS status
FROM fx_lines_of_states GROUP BY grp, variant_no, variant, test
"""

VIEWS["fx_discovery"] = """
SELECT DISTINCT 's' || CAST(grp AS VARCHAR(20)) || '__' || lpad(CAST(grp AS VARCHAR(20)), 8, '0') || '__' || variant AS instance_id,
       'tests.m' || CAST(l_partkey % 5 AS VARCHAR(8)) AS module
FROM fx_lines_of_states WHERE l_quantity >= 50 AND s_acctbal <= 5000
"""

# Scalar columns of each state.
VIEWS["fx_states"] = """
SELECT DISTINCT 's' || CAST(grp AS VARCHAR(20)) || '__' || lpad(CAST(grp AS VARCHAR(20)), 8, '0') || '__' || variant AS instance_id,
       'org/s' || CAST(grp AS VARCHAR(20)) AS repo,
       CASE WHEN s_nationkey = 9 THEN NULL ELSE lpad(CAST(grp AS VARCHAR(20)), 8, '0') || 'abcdef' END AS base_commit,
       CASE WHEN variant = 'base' THEN NULL ELSE 'diff of ' || variant END AS patch,
       'reg.example.io/team/c' || CAST(s_nationkey AS VARCHAR(8)) || CASE WHEN s_acctbal < 500 AND variant_no = 2 THEN '-fix' ELSE '' END AS container,
       'pytest tests' AS command,
       CASE WHEN s_nationkey = 7 THEN NULL ELSE 'g' || CAST(grp AS VARCHAR(20)) END AS group_id,
       variant, grp, variant_no, grp * 10 + variant_no AS row_index,
       s_nationkey <> 5 AS measured,
       CASE WHEN s_nationkey = 5 AND s_acctbal > 2000 THEN true END AS collection_error
FROM fx_lines_of_states
"""

VIEWS["fx_known_groups"] = """
SELECT 'g' || CAST(s_suppkey AS VARCHAR(20)) AS group_id FROM supplier WHERE s_nationkey <> 11
"""

# Trace functions: orders are tests, parts are functions.
VIEWS["fx_functions"] = """
SELECT 'i' || CAST(o_custkey AS VARCHAR(20)) AS instance_id,
       'tests/t' || CAST(o_custkey AS VARCHAR(20)) || '.py::test_' || CAST(l_orderkey AS VARCHAR(20)) AS test,
       CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_linenumber, l_extendedprice, l_suppkey) AS BIGINT) - 1 AS pos,
       'f' || CAST(l_partkey AS VARCHAR(20)) AS func,
       'src/m' || CAST(l_suppkey AS VARCHAR(20)) || '.py' AS file,
       CAST(l_linenumber AS BIGINT) AS lineno,
       CAST(l_quantity AS BIGINT) AS call_count,
       CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN CAST(0 AS DOUBLE) ELSE CAST(floor(l_extendedprice) AS DOUBLE) / 65536 END AS exclusive_time_s,
       CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) * 1000 END AS exclusive_alloc_bytes,
       CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS BIGINT) * 1100 - 9000 END AS exclusive_rss_bytes,
       l_discount, l_tax, l_returnflag, l_linestatus
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

# Trace tests: one per order.
VIEWS["fx_tests"] = """
SELECT 'i' || CAST(o_custkey AS VARCHAR(20)) AS instance_id,
       'tests/t' || CAST(o_custkey AS VARCHAR(20)) || '.py::test_' || CAST(o_orderkey AS VARCHAR(20)) AS test,
       CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'passed'
            ELSE CASE o_orderpriority WHEN '5-LOW' THEN 'skipped' WHEN '1-URGENT' THEN 'error' WHEN '2-HIGH' THEN NULL ELSE 'passed' END END AS outcome,
       o_orderpriority = '1-URGENT' AS is_assertion,
       CASE WHEN o_orderstatus <> 'O' THEN o_custkey END AS failure_line,
       CASE WHEN o_orderstatus <> 'O' THEN CASE o_orderpriority WHEN '3-MEDIUM' THEN 'ValueError' WHEN '5-LOW' THEN 'KeyError' ELSE '' END END AS exception_type,
       CASE WHEN o_totalprice < 50000 THEN CAST(0.0005 AS DOUBLE) ELSE CAST(floor(o_totalprice) AS DOUBLE) / 8192 END AS wall_time_s,
       CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(o_custkey AS BIGINT) * 100 END AS start_rss_bytes,
       CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(floor(o_totalprice) AS BIGINT) END AS peak_rss_bytes,
       CASE WHEN o_orderpriority <> '3-MEDIUM' THEN CAST(o_custkey AS BIGINT) * 10 END AS start_traced_bytes,
       CASE WHEN o_orderpriority <> '3-MEDIUM' THEN CAST(floor(o_totalprice / 3) AS BIGINT) END AS peak_traced_bytes,
       o_orderpriority <> '2-HIGH' AS tracemalloc_enabled,
       o_totalprice > 450000 AS trimmed_by_events
FROM orders
"""

# Auxiliary passes over the same tests and functions, with gaps.
VIEWS["fx_walltime"] = """
SELECT instance_id, test, CASE WHEN outcome = 'failed' THEN NULL ELSE wall_time_s * 0.875 END AS wall_time_s
FROM fx_tests WHERE tracemalloc_enabled
"""

VIEWS["fx_cprofile"] = """
SELECT instance_id, test, func, min(file) AS filename, min(lineno) AS firstlineno, func AS qualname,
       sum(call_count) AS call_count,
       CASE WHEN max(l_tax) >= 0.08 THEN NULL ELSE sum(exclusive_time_s * CASE WHEN l_discount > 0.05 THEN 0.5 ELSE 0.75 END) END AS exclusive_time_s
FROM fx_functions WHERE l_returnflag <> 'R' GROUP BY instance_id, test, func
"""

VIEWS["fx_memprof_functions"] = """
SELECT instance_id, test, func,
       CASE WHEN max(l_tax) >= 0.08 THEN NULL ELSE CAST(sum(call_count) * 512 AS BIGINT) END AS exclusive_alloc_peak_sum
FROM fx_functions WHERE l_linestatus = 'F' GROUP BY instance_id, test, func
"""

VIEWS["fx_memprof_tests"] = """
SELECT instance_id, test, CASE WHEN outcome = 'passed' THEN start_traced_bytes END AS start_traced_bytes,
       peak_traced_bytes + 64 AS peak_traced_bytes
FROM fx_tests WHERE outcome <> 'error'
"""

# Line records: users are tests, event types are files.
VIEWS["fx_line_events"] = """
SELECT 'u' || CAST(user_id AS VARCHAR(20)) AS test, 'src/' || event_type || '.py' AS file,
       event_id % 50 AS line, event_id AS seq,
       CAST(floor(value * 1000) AS BIGINT) AS time_ns,
       CASE WHEN value > 100 THEN CAST(floor(value) AS BIGINT) END AS alloc_bytes,
       CASE WHEN value > 50 THEN CAST(floor(value * 2) AS BIGINT) - 100 END AS rss_bytes
FROM events
"""

VIEWS["fx_lines"] = """
SELECT test, file, line, CAST(count(*) AS BIGINT) AS hits, CAST(sum(time_ns) AS BIGINT) AS time_ns,
       CAST(sum(alloc_bytes) AS BIGINT) AS alloc_bytes, CAST(sum(rss_bytes) AS BIGINT) AS rss_bytes
FROM fx_line_events GROUP BY test, file, line
"""

# Calls in return order, one session per user.
VIEWS["fx_call_events"] = """
SELECT 'u' || CAST(user_id AS VARCHAR(20)) AS test,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS seq,
       'fn_' || event_type AS func, 'src/' || event_type || '.py' AS file,
       event_id % 40 AS lineno, event_id % 4 AS depth,
       CAST(floor(value * 1000) AS BIGINT) AS wall_ns,
       CAST(floor(value * 10) AS BIGINT) AS rss_before, CAST(floor(value * 17) AS BIGINT) - 50 AS rss_after,
       CAST(floor(value * 5) AS BIGINT) AS alloc_inclusive
FROM events
"""

# Outcomes of measured states only, as the list form holds them.
VIEWS["fx_measured"] = """
SELECT o.* FROM fx_outcomes o JOIN fx_states s ON o.instance_id = s.instance_id WHERE s.measured
"""

VIEWS["fx_health"] = """
SELECT s.instance_id,
       NOT EXISTS (SELECT 1 FROM fx_outcomes o WHERE o.instance_id = s.instance_id AND o.severity >= 2)
       AND NOT EXISTS (SELECT 1 FROM fx_discovery d WHERE d.instance_id = s.instance_id) AS healthy
FROM fx_states s WHERE s.measured
"""

# Report cases: return flags are report files, parts are tests.
VIEWS["fx_cases"] = """
SELECT 'i' || CAST(l_suppkey AS VARCHAR(20)) AS instance_id, 'report_' || l_returnflag || '.xml' AS report,
       't' || CAST(l_partkey AS VARCHAR(20)) AS test,
       CASE WHEN l_tax >= 0.08 THEN 'ERROR' WHEN l_tax >= 0.07 THEN 'FAILED' WHEN l_tax >= 0.06 THEN 'SKIPPED' ELSE 'PASSED' END AS status,
       CASE WHEN l_tax >= 0.08 THEN 3 WHEN l_tax >= 0.07 THEN 2 WHEN l_tax >= 0.06 THEN 1 ELSE 0 END AS severity
FROM lineitem
"""

# The first stage of every dataset filter, in order, one column per rule.
VIEWS["fx_chain"] = """
SELECT s.*, s.group_id IS NULL AS no_group,
       NOT EXISTS (SELECT 1 FROM fx_measured o WHERE o.instance_id = s.instance_id AND o.status <> 'SKIPPED') AS no_outcomes
FROM fx_states s
"""

VIEWS["fx_chain2"] = """
SELECT c.*, CASE WHEN no_group THEN 'no group metadata' WHEN no_outcomes THEN 'no test outcomes' END AS reason2,
       CASE WHEN NOT no_group AND NOT no_outcomes THEN
         min(CASE WHEN NOT no_group AND NOT no_outcomes THEN container END) OVER (PARTITION BY repo, base_commit)
         <> max(CASE WHEN NOT no_group AND NOT no_outcomes THEN container END) OVER (PARTITION BY repo, base_commit) END AS conflict
FROM fx_chain c
"""

VIEWS["fx_chain3"] = """
SELECT c.*, COALESCE(reason2, CASE WHEN conflict THEN 'container conflict'
       WHEN group_id NOT IN (SELECT group_id FROM fx_known_groups) THEN 'unknown group' END) AS reason3
FROM fx_chain2 c
"""

VIEWS["fx_chain4"] = """
SELECT c.*, COALESCE(reason3, CASE WHEN
       max(CASE WHEN reason3 IS NULL AND variant = 'base' THEN 1 ELSE 0 END) OVER (PARTITION BY group_id) = 0
       THEN 'group has no base state' END) AS reason
FROM fx_chain3 c
"""

# Responses: order lines are samples, suppliers are spread over eight models in two groups.
VIEWS["fx_responses"] = """
SELECT CASE WHEN l_suppkey % 8 < 4 THEN 'plain' ELSE 'tuned' END AS grp, 'm' || CAST(l_suppkey % 8 AS VARCHAR(8)) AS model,
       'q' || CAST(l_orderkey AS VARCHAR(20)) || '-' || CAST(l_partkey AS VARCHAR(20)) || '-' || CAST(l_linenumber AS VARCHAR(8)) AS sample_id,
       'combined' AS task, CASE WHEN l_linenumber > 3 THEN 'post' ELSE 'pre' END AS side,
       CASE WHEN l_tax >= 0.08 THEN 'rate limit' END AS error, l_tax < 0.07 AS valid,
       CASE WHEN l_tax < 0.07 THEN CASE l_returnflag WHEN 'A' THEN 'Passed ' WHEN 'N' THEN 'failed' ELSE CASE WHEN l_linestatus = 'F' THEN 'error' ELSE 'maybe' END END END AS pred_outcome,
       CASE WHEN l_discount > 0.03 THEN 'ValueError' END AS pred_exception,
       CASE WHEN l_tax < 0.07 THEN floor(l_extendedprice * 2 * (1 - l_discount)) END AS pred_peak,
       CASE WHEN l_tax < 0.06 THEN floor(l_extendedprice * (1 - l_discount)) / 64 END AS pred_wall,
       CASE WHEN l_quantity < 20 THEN 'passed' WHEN l_linestatus = 'F' THEN 'failed' ELSE 'error' END AS gt_outcome,
       CASE WHEN l_quantity >= 20 THEN CASE WHEN l_linestatus = 'F' THEN 'ValueError' ELSE 'KeyError' END END AS gt_exception,
       floor(l_extendedprice * 2) AS gt_peak, floor(l_extendedprice) / 64 AS gt_wall
FROM (SELECT l_orderkey, l_partkey, l_linenumber, min(l_suppkey) AS l_suppkey, min(l_tax) AS l_tax, min(l_discount) AS l_discount, min(l_returnflag) AS l_returnflag,
             min(l_linestatus) AS l_linestatus, min(l_extendedprice) AS l_extendedprice, min(l_quantity) AS l_quantity FROM lineitem GROUP BY 1, 2, 3)
"""

# Rankings: an order is a sample, its parts are the names.
VIEWS["fx_score_values"] = """
SELECT 'o' || CAST(l_orderkey AS VARCHAR(20)) AS sample_id,
       CASE l_returnflag WHEN 'A' THEN 'hot_methods_time' WHEN 'R' THEN 'hot_lines_time'
            ELSE CASE l_linestatus WHEN 'F' THEN 'hot_methods_alloc' ELSE 'hot_lines_alloc' END END AS subtask,
       'f' || CAST(l_partkey AS VARCHAR(20)) AS name,
       CASE WHEN min(l_quantity) < 5 THEN 0.0 ELSE floor(min(l_extendedprice)) / 64 END AS value, max(l_quantity) AS quantity
FROM lineitem GROUP BY 1, 2, 3
"""
VIEWS["fx_score_truth"] = """
SELECT sample_id, subtask, name, CAST(row_number() OVER (PARTITION BY sample_id, subtask ORDER BY value DESC, name) AS BIGINT) - 1 AS pos FROM fx_score_values
"""
VIEWS["fx_score_told"] = """
SELECT 'm0' AS model, sample_id, subtask, name, quantity FROM fx_score_values
UNION ALL SELECT 'm1', sample_id, subtask, CASE WHEN quantity > 40 THEN 'g' || name ELSE name END, quantity FROM fx_score_values WHERE quantity > 10
"""
VIEWS["fx_score_preds"] = """
SELECT model, sample_id, subtask, name,
       CAST(row_number() OVER (PARTITION BY model, sample_id, subtask ORDER BY quantity, name) AS BIGINT) - 1 AS pos
FROM fx_score_told
"""
VIEWS["fx_score_rows"] = """
SELECT DISTINCT sample_id, 'm0' AS model FROM fx_score_values UNION ALL SELECT DISTINCT sample_id, 'm1' FROM fx_score_values
"""
