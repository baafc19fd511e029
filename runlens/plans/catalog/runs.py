"""Queries on runs, graded outcomes and integration joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from runlens.operators import integration, outcomes, runs
from runlens.plans.catalog.inputs import state_scalars
from runlens.plans.catalog.registry import frame, query
from runlens.plans.catalog.views import VIEWS

# Rows of a run: orders; the status decides what each left behind.
VIEWS["fx_run_rows"] = """
SELECT 'r' || CAST(o_orderkey AS VARCHAR(20)) AS instance_id, o_orderkey AS input_index, o_orderpriority <> '5-LOW' AS needs_cluster,
       'input ' || CAST(o_custkey AS VARCHAR(20)) AS payload, o_orderstatus, o_orderpriority, o_custkey, o_totalprice
FROM orders
"""
VIEWS["fx_run_results"] = "SELECT instance_id, 'result ' || instance_id AS payload FROM fx_run_rows WHERE o_orderstatus = 'O'"
VIEWS["fx_failures"] = """
SELECT instance_id, CASE WHEN o_totalprice > 200000 THEN 'infrastructure' ELSE 'row' END AS category,
       CASE WHEN o_custkey < 700 THEN 'apply' ELSE 'command' END AS stage, lower(o_orderpriority) AS reason, 'message ' || instance_id AS message
FROM fx_run_rows WHERE o_orderstatus = 'F'
"""


@query(
    "remaining",
    "SELECT instance_id, o_orderstatus AS kind, o_orderpriority AS repo FROM fx_run_rows WHERE instance_id NOT IN (SELECT instance_id FROM fx_run_results)",
)
def remaining(spark, sf_dir):
    items = frame(spark, sf_dir, "SELECT instance_id, o_orderstatus AS kind, o_orderpriority AS repo FROM fx_run_rows")
    return runs.remaining(items, frame(spark, sf_dir, "fx_run_results"))


@query(
    "triage_run",
    """
    SELECT r.instance_id, r.input_index, verdict, CASE verdict WHEN 'passthrough' THEN r.payload WHEN 'result' THEN 'result ' || r.instance_id END AS payload,
           CASE verdict WHEN 'failure' THEN f.category WHEN 'missing' THEN 'infrastructure' END AS category,
           CASE verdict WHEN 'failure' THEN f.stage WHEN 'missing' THEN 'materialize' END AS stage,
           CASE verdict WHEN 'failure' THEN f.reason WHEN 'missing' THEN 'missing_worker_artifact' END AS reason,
           CASE verdict WHEN 'failure' THEN f.message WHEN 'missing' THEN 'worker reached a terminal state without result.json or failure.json' END AS message
    FROM (SELECT *, CASE WHEN NOT needs_cluster THEN 'passthrough' WHEN o_orderstatus = 'O' THEN 'result' WHEN o_orderstatus = 'F' THEN 'failure' ELSE 'missing' END AS verdict
          FROM fx_run_rows) r LEFT JOIN fx_failures f ON f.instance_id = r.instance_id
    """,
)
def triage_run(spark, sf_dir):
    return runs.triage_run(
        frame(spark, sf_dir, "fx_run_rows"), frame(spark, sf_dir, "fx_run_results"), frame(spark, sf_dir, "fx_failures")
    )


# Units: order lines are tracer passes of their order.
VIEWS["fx_units"] = """
SELECT DISTINCT 'r' || CAST(l_orderkey AS VARCHAR(20)) AS instance_id,
       CASE WHEN l_linenumber < 3 THEN 'trace' WHEN l_linenumber < 5 THEN 'walltime' WHEN l_linenumber < 7 THEN 'cprofile' ELSE 'memprof' END AS tracer
FROM lineitem
"""
VIEWS["fx_outputs"] = """
SELECT instance_id, tracer, max(CASE WHEN l_tax > 0.03 THEN 1 ELSE 0 END) = 1 AS readable, CAST(max(l_quantity) AS BIGINT) AS test_count
FROM (SELECT *, 'r' || CAST(l_orderkey AS VARCHAR(20)) AS instance_id,
             CASE WHEN l_linenumber < 3 THEN 'trace' WHEN l_linenumber < 5 THEN 'walltime' WHEN l_linenumber < 7 THEN 'cprofile' ELSE 'memprof' END AS tracer
      FROM lineitem WHERE l_returnflag = 'A') GROUP BY instance_id, tracer
"""


@query(
    "triage_trace_run",
    """
    SELECT u.instance_id, count(*) AS units, count(o.tracer) AS outputs, count(o.tracer) > 0 AS ok,
           count(CASE WHEN o.tracer = 'trace' THEN 1 END) > 0 AS merges, CASE WHEN count(o.tracer) = 0 THEN 'missing_worker_artifact' END AS reason
    FROM fx_units u LEFT JOIN fx_outputs o ON o.instance_id = u.instance_id AND o.tracer = u.tracer GROUP BY u.instance_id
    """,
)
def triage_trace_run(spark, sf_dir):
    return runs.triage_trace_run(frame(spark, sf_dir, "fx_units"), frame(spark, sf_dir, "fx_outputs"))


VIEWS["fx_passes"] = """
SELECT u.instance_id, u.tracer, CASE WHEN r.o_orderpriority = '1-URGENT' THEN 'TimeoutExpired' ELSE 'ok' END AS status,
       CAST(floor(r.o_totalprice) AS DOUBLE) / 64 AS duration_s, r.o_orderstatus AS host
FROM fx_units u JOIN fx_run_rows r ON r.instance_id = u.instance_id
"""
_LEDGER = """
SELECT p.instance_id, p.tracer, CASE WHEN p.status = 'ok' AND o.tracer IS NULL THEN 'no_output' WHEN p.status = 'ok' AND NOT o.readable THEN 'invalid_output' ELSE p.status END AS status,
       COALESCE(o.readable, false) AS ok, p.duration_s, CASE WHEN COALESCE(o.readable, false) THEN o.test_count ELSE 0 END AS test_count, p.host
FROM fx_passes p LEFT JOIN fx_outputs o ON o.instance_id = p.instance_id AND o.tracer = p.tracer
"""


@query("pass_ledger", _LEDGER)
def pass_ledger(spark, sf_dir):
    return runs.pass_ledger(frame(spark, sf_dir, "fx_passes"), frame(spark, sf_dir, "fx_outputs"))


@query(
    "ledger_totals",
    f"""
    SELECT tracer, count(*) AS passes, count(CASE WHEN ok THEN 1 END) AS usable, CAST(sum(test_count) AS BIGINT) AS tests,
           sum(duration_s) AS duration_s FROM ({_LEDGER}) GROUP BY tracer
    """,
)
def ledger_totals(spark, sf_dir):
    return runs.ledger_totals(runs.pass_ledger(frame(spark, sf_dir, "fx_passes"), frame(spark, sf_dir, "fx_outputs")))


_JOBS = """
SELECT 'run' || CAST(o_custkey AS VARCHAR(20)) AS run, CASE WHEN o_totalprice > 100000 THEN 'worker' ELSE 'setup' END AS component,
       CASE o_orderstatus WHEN 'F' THEN 'succeeded' WHEN 'O' THEN CASE WHEN o_totalprice > 300000 THEN 'failed' ELSE 'succeeded' END
            ELSE CASE WHEN o_totalprice > 250000 THEN 'active' ELSE 'pending' END END AS state, o_orderpriority AS phase
FROM orders
"""


@query(
    "run_status",
    f"""
    SELECT c.run, c.counter, c.n, u.unfinished FROM (
      SELECT run, component || '_' || state AS counter, count(*) AS n FROM ({_JOBS}) GROUP BY 1, 2
      UNION ALL SELECT run, 'pod_' || lower(phase), count(*) FROM ({_JOBS}) GROUP BY 1, 2) c
    JOIN (SELECT run, bool_or(state IN ('pending', 'active')) AS unfinished FROM ({_JOBS}) GROUP BY run) u ON u.run = c.run
    """,
)
def run_status(spark, sf_dir):
    jobs = frame(
        spark,
        sf_dir,
        """SELECT 'run' || CAST(o_custkey AS STRING) AS run, CASE WHEN o_totalprice > 100000 THEN 'worker' ELSE 'setup' END AS component,
                  o_orderstatus = 'F' OR (o_orderstatus = 'O' AND o_totalprice <= 300000) AS complete, o_orderstatus = 'O' AS failed,
                  CASE WHEN o_totalprice > 250000 THEN 1 END AS active FROM orders""",
    ).withColumn("state", runs.job_state(F.col("complete"), F.col("failed"), F.col("active")))
    return runs.run_status(jobs, frame(spark, sf_dir, f"SELECT run, phase FROM ({_JOBS})"))


@query(
    "collect_summary",
    """
    SELECT count(CASE WHEN o_orderstatus = 'O' AND needs_cluster THEN 1 END) AS ok, count(CASE WHEN o_orderstatus <> 'F' AND NOT needs_cluster THEN 1 END) AS skip,
           count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS fail FROM fx_run_rows
    """,
)
def collect_summary(spark, sf_dir):
    rows = frame(spark, sf_dir, "SELECT instance_id, NOT needs_cluster AS was_filled, o_orderstatus = 'O' AS is_filled FROM fx_run_rows")
    return runs.collect_summary(rows, frame(spark, sf_dir, "fx_failures"))


@query(
    "cost_totals",
    """
    SELECT role, count(*) AS calls, CAST(sum(length(text)) AS BIGINT) AS input_tokens, CAST(sum(turn) AS BIGINT) AS output_tokens,
           sum(CASE WHEN turn > 1 THEN CAST(turn AS DOUBLE) / 4 ELSE 0 END) AS cost_usd FROM conversations GROUP BY role
    """,
)
def cost_totals(spark, sf_dir):
    log = frame(spark, sf_dir, "conversations").select(
        "role",
        F.length("text").alias("input_tokens"),
        F.col("turn").alias("output_tokens"),
        F.when(F.col("turn") > 1, F.col("turn") * F.lit(0.25)).alias("cost_usd"),
    )
    return runs.cost_totals(log, ["role"])


@query("failure_counts", "SELECT category, stage, reason, count(*) AS rows FROM fx_failures GROUP BY 1, 2, 3")
def failure_counts(spark, sf_dir):
    return runs.failure_counts(frame(spark, sf_dir, "fx_failures"))


# Graded outcomes ----------------------------------------------------------------------------------

VIEWS["fx_graded"] = """
SELECT 'g' || CAST(l_suppkey AS VARCHAR(20)) AS instance_id, l_returnflag AS category, 't' || CAST(l_partkey AS VARCHAR(20)) AS test,
       max(CASE WHEN l_linestatus = 'F' AND l_tax < 0.04 THEN 1 ELSE 0 END) AS ok FROM lineitem GROUP BY 1, 2, 3
"""


@query(
    "graded_outcomes",
    "SELECT instance_id, test, CASE WHEN max(ok) = 1 THEN 'passed' ELSE 'failed' END AS outcome FROM fx_graded GROUP BY instance_id, test",
)
def graded_outcomes(spark, sf_dir):
    lists = frame(spark, sf_dir, "fx_graded").groupBy("instance_id", "category").agg(
        F.collect_list(F.when(F.col("ok") == 1, F.col("test"))).alias("success"),
        F.collect_list(F.when(F.col("ok") == 0, F.col("test"))).alias("failure"),
    )
    reports = lists.groupBy("instance_id").agg(
        F.map_from_entries(F.collect_list(F.struct("category", F.struct("success", "failure")))).alias("categories")
    )
    return outcomes.graded_outcomes(reports)


@query(
    "pre_outcomes",
    """
    SELECT instance_id, test, CASE status WHEN 'PASSED' THEN 'passed' WHEN 'SKIPPED' THEN 'xfail' WHEN 'FAILED' THEN 'failed' ELSE 'error' END AS outcome
    FROM fx_outcomes WHERE variant = 'base'
    UNION ALL SELECT DISTINCT b.instance_id, f.test, 'failed' FROM fx_outcomes f JOIN fx_states b ON b.grp = f.grp AND b.variant = 'base'
    WHERE f.variant = 'fixed' AND NOT EXISTS (SELECT 1 FROM fx_outcomes o WHERE o.instance_id = b.instance_id AND o.test = f.test)
    """,
)
def pre_outcomes(spark, sf_dir):
    parsed = frame(
        spark,
        sf_dir,
        """SELECT instance_id, test, CASE status WHEN 'SKIPPED' THEN 'XFAIL' WHEN 'ERROR' THEN 'crashed' ELSE ' ' || status END AS label
           FROM fx_outcomes WHERE variant = 'base'""",
    )
    targets = frame(
        spark,
        sf_dir,
        """SELECT DISTINCT b.instance_id, f.test FROM fx_outcomes f JOIN fx_states b ON b.grp = f.grp AND b.variant = 'base'
           WHERE f.variant = 'fixed'""",
    )
    return outcomes.pre_outcomes(parsed, targets)


_EXPECTED = """
SELECT DISTINCT b.instance_id, f.test, CASE WHEN f.severity >= 2 THEN 'fail_to_pass' ELSE 'pass_to_pass' END AS kind
FROM fx_outcomes f JOIN fx_states b ON b.grp = f.grp AND b.variant = 'base' WHERE f.variant = 'pred3' AND (f.severity = 0 OR f.test > 't9')
UNION ALL SELECT instance_id, NULL, 'fail_to_pass' FROM fx_states WHERE variant = 'base'
"""


@query(
    "check_outcomes",
    f"""
    SELECT e.instance_id,
           COALESCE(bool_and(CASE WHEN e.kind = 'fail_to_pass' AND e.test IS NOT NULL THEN COALESCE(b.status, 'X') NOT IN ('PASSED', 'SKIPPED') AND COALESCE(a.status, 'X') = 'PASSED' END), true) AS fail_to_pass_match,
           COALESCE(bool_and(CASE WHEN e.kind = 'pass_to_pass' THEN COALESCE(b.status, 'X') = 'PASSED' AND COALESCE(a.status, 'X') = 'PASSED' END), true) AS pass_to_pass_match
    FROM ({_EXPECTED}) e JOIN fx_states s ON s.instance_id = e.instance_id LEFT JOIN fx_outcomes b ON b.instance_id = e.instance_id AND b.test = e.test
    LEFT JOIN fx_outcomes a ON a.grp = s.grp AND a.variant = 'fixed' AND a.test = e.test GROUP BY e.instance_id
    """,
)
def check_outcomes(spark, sf_dir):
    before = frame(spark, sf_dir, "SELECT instance_id, test, status FROM fx_outcomes WHERE variant = 'base'")
    after = frame(
        spark,
        sf_dir,
        """SELECT b.instance_id, f.test, f.status FROM fx_outcomes f JOIN fx_states b ON b.grp = f.grp AND b.variant = 'base'
           WHERE f.variant = 'fixed'""",
    )
    return outcomes.check_outcomes(before, after, frame(spark, sf_dir, _EXPECTED))


# Predictions and reports ----------------------------------------------------------------------------

VIEWS["fx_predictions"] = """
SELECT 'g' || CAST(l_suppkey AS VARCHAR(20)) AS instance_id, 'model' || CAST(l_linenumber AS VARCHAR(8)) AS model_name_or_path,
       CASE WHEN max(l_tax) < 0.08 THEN ' ' || chr(10) ELSE 'diff --git a/m' || CAST(l_linenumber AS VARCHAR(8)) || ' b/m' END AS model_patch,
       CASE WHEN l_linenumber = 6 AND max(l_quantity) >= 49 THEN 'error' END AS status, CAST(count(*) AS BIGINT) AS trajectory_length,
       'stem__' || CAST(l_linenumber AS VARCHAR(8)) AS source_stem
FROM lineitem GROUP BY l_suppkey, l_linenumber
"""
VIEWS["fx_reports"] = """
SELECT instance_id, model_name_or_path, CAST(trajectory_length AS DOUBLE) / 4 AS human_speedup_ratio, CAST(trajectory_length AS DOUBLE) / 8 AS raw_pred_speedup_ratio,
       1.0 AS correctness_pct, CASE WHEN model_name_or_path IN ('model1', 'model2') THEN CAST(0 AS DOUBLE) ELSE CAST(trajectory_length AS DOUBLE) / 2 END AS gold_speedup_ratio,
       CASE WHEN model_name_or_path = 'model3' THEN CAST(0 AS DOUBLE) ELSE CAST(trajectory_length AS DOUBLE) / 16 END AS pre_edit_runtime
FROM fx_predictions WHERE model_name_or_path <> 'model7'
"""
VIEWS["fx_gold"] = """
SELECT 'g' || CAST(s_suppkey AS VARCHAR(20)) AS instance_id, CAST(s_nationkey AS DOUBLE) AS gold_speedup_ratio, CAST(s_nationkey AS DOUBLE) / 2 AS correctness_pct,
       CAST(s_nationkey AS DOUBLE) / 4 AS pre_edit_runtime FROM supplier WHERE s_acctbal > 0
"""
_ENRICHED = """
SELECT p.instance_id, p.model_name_or_path, r.human_speedup_ratio AS speedup_ratio, r.raw_pred_speedup_ratio AS lm_speedup, g.correctness_pct AS gold_correctness_pct,
       COALESCE(NULLIF(r.gold_speedup_ratio, 0), g.gold_speedup_ratio) AS gold_speedup, COALESCE(NULLIF(r.pre_edit_runtime, 0), g.pre_edit_runtime) AS pre_edit_runtime
FROM fx_predictions p LEFT JOIN fx_reports r ON r.instance_id = p.instance_id AND r.model_name_or_path = p.model_name_or_path
LEFT JOIN fx_gold g ON g.instance_id = p.instance_id
"""


def _enriched(spark, sf_dir, preds=None):
    preds = frame(spark, sf_dir, "fx_predictions") if preds is None else preds
    return integration.enrich_predictions(preds, frame(spark, sf_dir, "fx_reports"), frame(spark, sf_dir, "fx_gold"))


@query("enrich_predictions", _ENRICHED)
def enrich_predictions(spark, sf_dir):
    return _enriched(spark, sf_dir).select(
        "instance_id", "model_name_or_path", "speedup_ratio", "lm_speedup", "gold_correctness_pct", "gold_speedup", "pre_edit_runtime"
    )


@query(
    "keep_predictions",
    """
    SELECT instance_id, model_name_or_path, CASE WHEN status = 'error' THEN 'status=error' WHEN model_patch NOT LIKE 'diff%' THEN 'empty model_patch' ELSE 'kept' END AS reason
    FROM fx_predictions
    """,
)
def keep_predictions(spark, sf_dir):
    kept, dropped = integration.keep_predictions(frame(spark, sf_dir, "fx_predictions"))
    columns = ["instance_id", "model_name_or_path"]
    return kept.select(*columns, F.lit("kept").alias("reason")).unionByName(dropped.select(*columns, "reason"))


@query(
    "prediction_states",
    f"""
    SELECT s.instance_id[:-7] || '__prediction_stem_' || substr(e.model_name_or_path, 6) AS instance_id, s.container,
           'diff --git a/m' || substr(e.model_name_or_path, 6) || ' b/m' || chr(10) AS patch, s.group_id, e.gold_speedup
    FROM fx_states s JOIN ({_ENRICHED}) e ON e.instance_id = s.group_id JOIN fx_predictions p ON p.instance_id = e.instance_id AND p.model_name_or_path = e.model_name_or_path
    WHERE s.variant = 'base' AND p.status IS DISTINCT FROM 'error' AND p.model_patch LIKE 'diff%'
    """,
)
def prediction_states(spark, sf_dir):
    base = state_scalars(spark, sf_dir).where("variant = 'base'").withColumn("test_scope", F.array(F.lit("tests/")))
    kept, _ = integration.keep_predictions(frame(spark, sf_dir, "fx_predictions"))
    made = integration.prediction_states(base, _enriched(spark, sf_dir, kept), "make build")
    return made.select(
        "instance_id",
        "container",
        "patch",
        F.get_json_object("metadata", "$.swefficiency.instance_id").alias("group_id"),
        F.get_json_object("metadata", "$.swefficiency.prediction.gold_speedup").cast("double").alias("gold_speedup"),
    )


@query(
    "trajectory_states",
    """
    SELECT s.instance_id[:-7] || '__rebench_trajectory_' || CAST(o_orderkey AS VARCHAR) AS instance_id, s.container, s.instance_id AS parent,
           lpad(CAST(s.grp AS VARCHAR), 8, '0') AS base_id, 'flaky' AS failures
    FROM fx_states s JOIN orders ON o_custkey = s.grp WHERE s.variant = 'base' AND o_orderstatus <> 'P'
    """,
)
def trajectory_states(spark, sf_dir):
    note = F.to_json(
        F.struct(
            F.struct(
                F.col("grp").cast("string").alias("rebench_instance_id"), F.array(F.lit("flaky")).alias("integration_failures")
            ).alias("rebench_integration")
        )
    )
    base = frame(spark, sf_dir, "fx_states").where("variant = 'base'").withColumn("metadata", note)
    base = base.withColumn("test_scope", F.array(F.lit("tests/")))
    trajectories = frame(
        spark,
        sf_dir,
        """SELECT CAST(o_custkey AS STRING) AS instance_id, CAST(o_orderkey AS STRING) AS trajectory_id,
                  CASE WHEN o_orderstatus = 'P' THEN ' ' ELSE 'diff of ' || CAST(o_orderkey AS STRING) END AS patch FROM orders""",
    )
    made = integration.trajectory_states(base, trajectories, "trajectories")
    own = "$.rebench_integration"
    return made.select(
        "instance_id",
        "container",
        F.get_json_object("metadata", f"{own}.parent").alias("parent"),
        F.get_json_object("metadata", "$.base_id").alias("base_id"),
        F.get_json_object("metadata", f"{own}.integration_failures[0]").alias("failures"),
    )


@query(
    "add_workload",
    """
    SELECT instance_id, CASE WHEN s_acctbal > 0 AND group_id IS NOT NULL THEN 'cat > /tmp/test_workload.py <<''PYEOF''' || chr(10) || 'def test_workload():' || chr(10)
           || '    run(' || CAST(s_nationkey AS VARCHAR) || ')' || chr(10) || '    assert True' || chr(10) || 'PYEOF' || chr(10) || 'pytest /tmp/test_workload.py ' END AS command_workload
    FROM fx_states JOIN supplier ON s_suppkey = grp
    """,
)
def add_workload(spark, sf_dir):
    bodies = frame(
        spark,
        sf_dir,
        """SELECT 'g' || CAST(s_suppkey AS STRING) AS instance_id, CASE WHEN s_acctbal > 0 THEN 'run(' || CAST(s_nationkey AS STRING) || ')' ELSE '' END AS workload
           FROM supplier""",
    )
    return integration.add_workload(state_scalars(spark, sf_dir), bodies, ["tests/"]).select("instance_id", "command_workload")


@query(
    "attach_generated",
    """
    SELECT instance_id, CASE WHEN variant = 'pred4' THEN 'command cannot take a workload' WHEN group_id IS NULL OR s_acctbal <= 0 THEN 'no generated workload for this row''s pair' ELSE 'attached' END AS reason
    FROM fx_states JOIN supplier ON s_suppkey = grp WHERE NOT (variant = 'pred4' AND (group_id IS NULL OR s_acctbal <= 0))
    UNION ALL SELECT instance_id, 'no generated workload for this row''s pair' FROM fx_states JOIN supplier ON s_suppkey = grp WHERE variant = 'pred4' AND (group_id IS NULL OR s_acctbal <= 0)
    """,
)
def attach_generated(spark, sf_dir):
    generated = frame(
        spark,
        sf_dir,
        """SELECT 's' || CAST(s_suppkey AS STRING) || '__' || lpad(CAST(s_suppkey AS STRING), 8, '0') || '__g' || CAST(s_suppkey AS STRING) AS pair,
                  'def test_light(): pass' AS content FROM supplier WHERE s_acctbal > 0""",
    )
    command = F.when(F.col("variant") == "pred4", "bash -c 'make'").otherwise("bash -c 'cd /app && pytest tests'")
    rows, skipped = integration.attach_generated(state_scalars(spark, sf_dir).withColumn("command", command), generated)
    return rows.select("instance_id", F.lit("attached").alias("reason")).unionByName(skipped)


@query(
    "with_registry",
    """
    SELECT instance_id, CASE WHEN s_acctbal > 0 THEN 'parser' || CAST(s_nationkey AS VARCHAR) END AS parser
    FROM fx_states JOIN supplier ON s_suppkey = grp
    """,
)
def with_registry(spark, sf_dir):
    registry = frame(
        spark,
        sf_dir,
        """SELECT 'org/s' || CAST(s_suppkey AS STRING) AS repo,
                  CASE WHEN s_nationkey = 9 THEN 'none_org/s' || CAST(s_suppkey AS STRING) ELSE lpad(CAST(s_suppkey AS STRING), 8, '0') || 'abcdef' END AS base_ref,
                  'parser' || CAST(s_nationkey AS STRING) AS parser, 'pytest' AS default_command, 'tests/' AS default_scope FROM supplier WHERE s_acctbal > 0""",
    )
    rows, errors = integration.with_registry(state_scalars(spark, sf_dir), registry)
    return rows.select("instance_id", "parser").unionByName(
        errors.select("instance_id", F.lit(None).cast("string").alias("parser"))
    )


# Verification: documents are changes; languages and sources decide which check fails.
_CHECKS = """
SELECT doc_id, CASE WHEN source = 'src0' THEN 'cached' WHEN source = 'src1' THEN 'no_patch' WHEN source = 'src2' THEN 'missing_fields' WHEN source = 'src3' THEN 'unparseable_pr_number'
       WHEN source = 'src4' THEN 'pr_fetch_failed' WHEN source = 'src5' THEN 'pr_not_found' WHEN source = 'src6' THEN 'pr_not_merged' WHEN source = 'src7' THEN 'base_commit_mismatch'
       WHEN source = 'src8' THEN 'no_merge_commit' WHEN source = 'src9' THEN 'diff_fetch_failed' WHEN source = 'src10' THEN 'diff_mismatch'
       WHEN source = 'src11' THEN 'request' ELSE 'landed' END AS verdict
FROM documents
"""


@query(
    "verify_golden",
    f"""
    SELECT doc_id, CASE verdict WHEN 'cached' THEN 'cachedsha' WHEN 'request' THEN 'merge' || CAST(doc_id + 1 AS VARCHAR) WHEN 'landed' THEN 'merge' || CAST(doc_id + 1 AS VARCHAR) END AS golden_commit,
           CASE WHEN verdict NOT IN ('cached', 'request', 'landed') THEN verdict END AS error
    FROM ({_CHECKS})
    """,
)
def verify_golden(spark, sf_dir):
    text = "'diff --git a/x b/x' || chr(10) || '--- a/x' || chr(10) || '+++ b/x' || chr(10) || '@@ -1 +1 @@' || chr(10) || '+' || replace(text, chr(10), chr(10) || '+')"
    number = "CAST(doc_id + 1 AS VARCHAR(20))"
    rows = frame(
        spark,
        sf_dir,
        f"""SELECT d.doc_id, 'own__repo' || CAST(d.doc_id AS STRING) || CASE verdict WHEN 'unparseable_pr_number' THEN '-x' ELSE '-' || {number.replace('doc_id', 'd.doc_id')} END AS instance_id,
                   'own/repo' AS repo, CASE WHEN verdict = 'missing_fields' THEN '' ELSE 'base' END AS base_commit,
                   CASE WHEN verdict = 'no_patch' THEN ' ' ELSE {text} END AS patch, '' AS test_patch
            FROM documents d JOIN ({_CHECKS}) c ON c.doc_id = d.doc_id""",
    )
    cache = frame(
        spark,
        sf_dir,
        f"SELECT 'own__repo' || CAST(doc_id AS STRING) || '-' || {number} AS instance_id, 'cachedsha' AS golden_commit FROM ({_CHECKS}) WHERE verdict = 'cached'",
    )
    prs = frame(
        spark,
        sf_dir,
        f"""SELECT 'own/repo' AS repo, doc_id + 1 AS number, CASE verdict WHEN 'pr_not_found' THEN 404 ELSE 200 END AS status, verdict <> 'pr_not_merged' AS merged,
                   CASE verdict WHEN 'base_commit_mismatch' THEN 'other' ELSE 'base' END AS base_sha,
                   CASE WHEN verdict <> 'no_merge_commit' THEN 'merge' || {number} END AS merge_commit_sha FROM ({_CHECKS}) WHERE verdict <> 'pr_fetch_failed'""",
    )
    diffs = frame(
        spark,
        sf_dir,
        f"""SELECT 'own/repo' AS repo, d.doc_id + 1 AS number, 'landed' AS kind, CASE WHEN verdict = 'diff_fetch_failed' THEN NULL
                   WHEN verdict IN ('diff_mismatch', 'request') THEN {text} || 'z' ELSE {text} END AS text
            FROM documents d JOIN ({_CHECKS}) c ON c.doc_id = d.doc_id
            UNION ALL SELECT 'own/repo', d.doc_id + 1, 'request', CASE WHEN verdict = 'diff_fetch_failed' THEN NULL
                   WHEN verdict = 'diff_mismatch' THEN {text} || 'z' ELSE {text} END
            FROM documents d JOIN ({_CHECKS}) c ON c.doc_id = d.doc_id""",
    )
    done = integration.verify_golden(rows, cache, prs, diffs)
    return rows.select("doc_id", "instance_id").join(done, "instance_id").select("doc_id", "golden_commit", "error")


@query(
    "integration_mode",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'patches' WHEN o_orderpriority = '1-URGENT' THEN 'patches' WHEN o_orderpriority = '2-HIGH' THEN 'skip' ELSE 'checkout' END AS golden_mode,
           concat_ws(',', CASE WHEN o_orderstatus = 'F' THEN 'pr_not_found' END, CASE o_orderpriority WHEN '1-URGENT' THEN 'environment_patch_present' WHEN '2-HIGH' THEN 'inspect_failed' END) AS integration_failures
    FROM orders
    """,
)
def integration_mode(spark, sf_dir):
    checks = frame(
        spark,
        sf_dir,
        """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN 'sha' END AS golden_commit, CASE WHEN o_orderstatus = 'F' THEN 'pr_not_found' END AS golden_error,
                  CASE o_orderpriority WHEN '1-URGENT' THEN 'environment_patch_present' WHEN '2-HIGH' THEN 'inspect_failed' END AS environment_error FROM orders""",
    )
    done = checks.select("o_orderkey", *integration.integration_mode())
    return done.withColumn("integration_failures", F.array_join("integration_failures", ","))


VIEWS["fx_commits"] = """
SELECT 'repo' || CAST(o_custkey AS VARCHAR(20)) AS repo, sha1(CAST(o_orderkey AS VARCHAR(20))) AS sha, o_orderkey, o_orderstatus, o_orderpriority,
       CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS BIGINT) - 1 AS idx
FROM orders
"""
_REQUESTS = """
SELECT o_orderkey AS request_id, repo, CASE o_orderpriority WHEN '1-URGENT' THEN substr(sha, 1, 9) WHEN '2-HIGH' THEN substr(sha, 1, 5) ELSE sha END AS base_sha,
       CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN -1 ELSE 0 END AS step, idx FROM fx_commits
"""
_STEPS = f"""
SELECT r.request_id, t.sha AS target_sha, CASE WHEN length(r.base_sha) < 7 THEN 'base commit not found' WHEN t.sha IS NULL THEN 'step out of range' END AS reason
FROM ({_REQUESTS}) r LEFT JOIN fx_commits t ON t.repo = r.repo AND t.idx = r.idx + r.step
"""


@query("commit_at_step", f"SELECT request_id, CASE WHEN reason IS NULL THEN target_sha END AS target_sha, reason FROM ({_STEPS})")
def commit_at_step(spark, sf_dir):
    good, bad = integration.commit_at_step(frame(spark, sf_dir, "fx_commits"), frame(spark, sf_dir, _REQUESTS))
    none = F.lit(None).cast("string")
    return good.select("request_id", "target_sha", none.alias("reason")).unionByName(
        bad.select("request_id", none.alias("target_sha"), "reason")
    )


@query(
    "augment_states",
    """
    SELECT s.instance_id[:-7] || '__aug' || CAST(o_orderkey AS VARCHAR) AS instance_id, s.instance_id AS parent, o_orderstatus = 'F' AS modifies_test_scope
    FROM fx_states s JOIN orders ON o_custkey = s.grp WHERE s.variant = 'base'
    """,
)
def augment_states(spark, sf_dir):
    base = frame(spark, sf_dir, "fx_states").withColumn("test_scope", F.array(F.lit("tests/")))
    diffs = frame(
        spark,
        sf_dir,
        """SELECT s.instance_id, 'aug' || CAST(o_orderkey AS STRING) AS suffix,
                  CASE WHEN o_orderstatus = 'F' THEN 'diff --git a/tests/x.py b/tests/x.py' ELSE 'diff --git a/src/x.py b/src/x.py' END AS diff
           FROM fx_states s JOIN orders ON o_custkey = s.grp WHERE s.variant IN ('base', 'fixed')""",
    )
    made, _ = integration.augment_states(base, diffs)
    return made.select(
        "instance_id",
        F.get_json_object("metadata", "$.parent").alias("parent"),
        (F.get_json_object("metadata", "$.modifies_test_scope") == "true").alias("modifies_test_scope"),
    )


@query(
    "adapt_instances",
    """
    SELECT instance_id || '__' || side AS instance_id, CASE side WHEN 'base' THEN CASE WHEN lang <> 'fr' THEN md5(tp) END ELSE md5(CASE WHEN lang <> 'fr' THEN tp ELSE '' END || fix || chr(10)) END AS digest,
           'activate && run' AS command, CASE WHEN lang = 'fr' THEN 'tests/' ELSE 'tests/' || source || '.py' END AS test_scope
    FROM (SELECT 'd' || CAST(doc_id AS VARCHAR) AS instance_id, lang, source, 'diff --git a/tests/x b/tests/x' || chr(10) || '+++ b/tests/' || source || '.py' || chr(10) AS tp, text || 'end' AS fix FROM documents)
    CROSS JOIN (SELECT unnest(['base', 'gold']) AS side)
    """,
)
def adapt_instances(spark, sf_dir):
    instances = frame(
        spark,
        sf_dir,
        """SELECT 'd' || CAST(doc_id AS STRING) AS instance_id, 'org/r' AS repo, 'c' AS base_commit, 'img' AS container, 'run' AS command, text || 'end' AS patch,
                  CASE WHEN lang = 'fr' THEN '' ELSE 'diff --git a/tests/x b/tests/x' || chr(10) || '+++ b/tests/' || source || '.py' || chr(10) END AS test_patch FROM documents""",
    )
    made = integration.adapt_instances(instances, "activate && ")
    return made.select("instance_id", F.md5("patch").alias("digest"), "command", F.array_join("test_scope", ",").alias("test_scope"))


@query(
    "group_states",
    """
    SELECT c_mktsegment || '__' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') || '__p' || CAST(c_custkey AS VARCHAR) || '__' || variant AS instance_id,
           CASE variant WHEN 'fixed' THEN c_name END AS patch, 'p' || CAST(c_custkey AS VARCHAR) AS group_id
    FROM customer CROSS JOIN (SELECT unnest(['base', 'fixed']) AS variant)
    """,
)
def group_states(spark, sf_dir):
    rows = frame(
        spark,
        sf_dir,
        """SELECT 'p' || CAST(c_custkey AS STRING) AS instance_id, 'org/' || c_mktsegment AS repo, lpad(CAST(c_custkey AS STRING), 8, '0') || 'ff' AS base_commit,
                  c_name AS patch, 'img' AS container, 'pytest' AS command, 'set' AS dataset FROM customer""",
    )
    made = integration.group_states(rows)
    return made.select("instance_id", "patch", F.get_json_object("metadata", "$.swefficiency.instance_id").alias("group_id"))


@query(
    "attach_documents",
    """
    SELECT r.instance_id, '{' || string_agg('"' || tracer || '":"gs://b/' || r.instance_id || '/' || tracer || '"', ',' ORDER BY tracer) || '}' AS execution_data
    FROM fx_run_rows r JOIN fx_outputs o ON o.instance_id = r.instance_id GROUP BY r.instance_id
    UNION ALL SELECT instance_id, 'old' FROM fx_run_rows WHERE instance_id NOT IN (SELECT instance_id FROM fx_outputs)
    """,
)
def attach_documents(spark, sf_dir):
    rows = frame(spark, sf_dir, "fx_run_rows").select("instance_id").withColumn("execution_data", F.lit("old"))
    documents = frame(spark, sf_dir, "fx_outputs").select(
        "instance_id", "tracer", F.concat(F.lit("gs://b/"), "instance_id", F.lit("/"), "tracer").alias("uri")
    )
    return integration.attach_documents(rows, documents)
