"""Queries on events, traces and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from runlens.operators import events, filters, hotspots, samples, traces
from runlens.plans.catalog.registry import frame, query
from runlens.plans.catalog.views import VIEWS

KEYS = ["instance_id", "test"]

VIEWS["fx_targets"] = """
SELECT instance_id, test FROM fx_tests WHERE outcome = 'failed' OR wall_time_s > 30
"""
VIEWS["fx_observed"] = """
SELECT instance_id, test, CASE WHEN wall_time_s > 20 THEN 'passed' ELSE 'failed' END AS outcome FROM fx_tests WHERE tracemalloc_enabled
UNION ALL SELECT instance_id, test || '[x]', 'passed' FROM fx_tests WHERE outcome = 'skipped'
"""
# Lines per trace test: order lines again, one file per supplier.
VIEWS["fx_test_lines"] = """
SELECT instance_id, test, file, lineno AS line, CAST(sum(call_count) AS BIGINT) AS hits,
       CAST(sum(call_count) * 7 AS BIGINT) AS time_ns, CAST(sum(exclusive_alloc_bytes) AS BIGINT) AS alloc_bytes,
       CAST(sum(exclusive_rss_bytes) AS BIGINT) AS rss_bytes
FROM fx_functions WHERE call_count > 3 GROUP BY instance_id, test, file, lineno
"""


@query(
    "merge_walltime",
    """
    SELECT t.instance_id, t.test, round(COALESCE(w.wall_time_s, t.wall_time_s), 6) AS wall_time_s
    FROM fx_tests t LEFT JOIN fx_walltime w ON w.instance_id = t.instance_id AND w.test = t.test
    """,
)
def merge_walltime(spark, sf_dir):
    done = traces.merge_walltime(frame(spark, sf_dir, "fx_tests"), frame(spark, sf_dir, "fx_walltime"))
    return done.select(*KEYS, F.round("wall_time_s", 6).alias("wall_time_s"))


_MERGED_FUNCTIONS = """
SELECT f.instance_id, f.test, f.pos, f.func,
       COALESCE(c.exclusive_time_s, f.exclusive_time_s) AS exclusive_time_s,
       CASE WHEN m.func IS NOT NULL THEN COALESCE(m.exclusive_alloc_peak_sum, 0) ELSE f.exclusive_alloc_bytes END AS exclusive_alloc_bytes
FROM fx_functions f
LEFT JOIN fx_cprofile c ON c.instance_id = f.instance_id AND c.test = f.test AND c.func = f.func
LEFT JOIN fx_memprof_functions m ON m.instance_id = f.instance_id AND m.test = f.test AND m.func = f.func
"""


@query(
    "merge_cprofile",
    f"SELECT instance_id, test, pos, func, round(exclusive_time_s, 6) AS exclusive_time_s FROM ({_MERGED_FUNCTIONS})",
)
def merge_cprofile(spark, sf_dir):
    done = traces.merge_cprofile(frame(spark, sf_dir, "fx_functions"), frame(spark, sf_dir, "fx_cprofile"))
    return done.select(*KEYS, "pos", "func", F.round("exclusive_time_s", 6).alias("exclusive_time_s"))


@query(
    "merge_memprof_tests",
    """
    SELECT t.instance_id, t.test, COALESCE(m.start_traced_bytes, t.start_traced_bytes) AS start_traced_bytes,
           COALESCE(m.peak_traced_bytes, t.peak_traced_bytes) AS peak_traced_bytes
    FROM fx_tests t LEFT JOIN fx_memprof_tests m ON m.instance_id = t.instance_id AND m.test = t.test
    """,
    doubles=("start_traced_bytes", "peak_traced_bytes",),
)
def merge_memprof_tests(spark, sf_dir):
    done = traces.merge_memprof_tests(frame(spark, sf_dir, "fx_tests"), frame(spark, sf_dir, "fx_memprof_tests"))
    return done.select(*KEYS, "start_traced_bytes", "peak_traced_bytes")


def _passes(spark, sf_dir):
    return traces.merge_passes(
        frame(spark, sf_dir, "fx_tests"),
        frame(spark, sf_dir, "fx_functions"),
        frame(spark, sf_dir, "fx_walltime"),
        frame(spark, sf_dir, "fx_cprofile"),
        frame(spark, sf_dir, "fx_memprof_tests"),
        frame(spark, sf_dir, "fx_memprof_functions"),
    )


@query(
    "merge_passes",
    f"SELECT instance_id, test, pos, func, round(exclusive_time_s, 6) AS exclusive_time_s, exclusive_alloc_bytes FROM ({_MERGED_FUNCTIONS})",
    doubles=("exclusive_alloc_bytes",),
)
def merge_passes(spark, sf_dir):
    done = _passes(spark, sf_dir).functions
    return done.select(
        *KEYS, "pos", "func", F.round("exclusive_time_s", 6).alias("exclusive_time_s"), "exclusive_alloc_bytes"
    )


@query(
    "enriched_tests",
    """
    SELECT t.instance_id, count(m.test) AS enriched
    FROM fx_tests t LEFT JOIN fx_memprof_tests m ON m.instance_id = t.instance_id AND m.test = t.test GROUP BY t.instance_id
    """,
)
def enriched_tests(spark, sf_dir):
    return _passes(spark, sf_dir).enriched


@query(
    "orphan_passes",
    """
    SELECT DISTINCT instance_id FROM fx_walltime
    WHERE instance_id NOT IN (SELECT instance_id FROM fx_tests WHERE outcome = 'passed')
    """,
)
def orphan_passes(spark, sf_dir):
    tests = frame(spark, sf_dir, "fx_tests").where("outcome = 'passed'")
    done = traces.merge_passes(tests, frame(spark, sf_dir, "fx_functions"), frame(spark, sf_dir, "fx_walltime"))
    return done.orphans


@query(
    "merge_outcomes",
    """
    SELECT t.instance_id, t.test, COALESCE(o.outcome, t.outcome) AS outcome
    FROM fx_tests t LEFT JOIN fx_observed o ON o.instance_id = t.instance_id AND o.test = t.test
    """,
)
def merge_outcomes(spark, sf_dir):
    done = traces.merge_outcomes(frame(spark, sf_dir, "fx_tests"), frame(spark, sf_dir, "fx_observed"))
    return done.select(*KEYS, "outcome")


@query(
    "fill_outcomes",
    """
    SELECT t.instance_id, t.test, COALESCE(t.outcome, o.outcome,
             CASE WHEN t.wall_time_s > 10 AND a.all_passed IS NOT NULL THEN CASE WHEN a.all_passed THEN 'passed' ELSE 'failed' END END) AS outcome
    FROM fx_tests t LEFT JOIN fx_observed o ON o.instance_id = t.instance_id AND o.test = t.test
    LEFT JOIN (SELECT instance_id, bool_and(outcome = 'passed') AS all_passed FROM fx_observed GROUP BY instance_id) a
      ON a.instance_id = t.instance_id
    """,
)
def fill_outcomes(spark, sf_dir):
    tests = frame(spark, sf_dir, "fx_tests").withColumn(
        "backend", F.when(F.col("wall_time_s") > 10, "settrace").otherwise("pytest")
    )
    return traces.fill_outcomes(tests, frame(spark, sf_dir, "fx_observed")).select(*KEYS, "outcome")


@query(
    "fail_to_pass",
    """
    SELECT s.repo || '@' || s.base_commit AS base_ref, o.test
    FROM fx_outcomes o JOIN fx_states s ON s.instance_id = o.instance_id WHERE s.base_commit IS NOT NULL
    GROUP BY 1, 2
    HAVING bool_or(s.variant = 'base' AND o.status IN ('FAILED', 'ERROR')) AND bool_or(s.variant <> 'base' AND o.status = 'PASSED')
    """,
)
def fail_to_pass(spark, sf_dir):
    placed = frame(spark, sf_dir, "fx_states").where("base_commit IS NOT NULL").select(
        "instance_id", F.concat_ws("@", "repo", "base_commit").alias("base_ref"), (F.col("variant") == "base").alias("is_base")
    )
    return traces.fail_to_pass(frame(spark, sf_dir, "fx_outcomes"), placed)


@query(
    "gt_wall_ms",
    "SELECT instance_id, test, round(sum(exclusive_time_s) * 1000, 6) AS wall_ms FROM fx_functions GROUP BY instance_id, test",
)
def gt_wall_ms(spark, sf_dir):
    return traces.gt_wall_ms(frame(spark, sf_dir, "fx_functions")).withColumn("wall_ms", F.round("wall_ms", 6))


_GT = """
greatest(0, COALESCE(peak_traced_bytes, 0) - COALESCE(start_traced_bytes, 0), COALESCE(peak_rss_bytes, 0) - COALESCE(start_rss_bytes, 0))
"""
_GT_LABEL = "CASE WHEN outcome IN ('failed', 'error') THEN CASE WHEN is_assertion THEN 'failed' ELSE 'error' END ELSE outcome END"


@query(
    "ground_truth",
    f"""
    SELECT instance_id, test, {_GT} AS peak_bytes, {_GT_LABEL} AS gt_outcome,
           CASE WHEN outcome IN ('failed', 'error') THEN failure_line END AS gt_failure_line,
           CASE WHEN outcome IN ('failed', 'error') AND exception_type <> '' THEN exception_type END AS gt_exception
    FROM fx_tests
    """,
    doubles=("gt_failure_line",),
)
def ground_truth(spark, sf_dir):
    return frame(spark, sf_dir, "fx_tests").select(*KEYS, traces.gt_peak_bytes().alias("peak_bytes"), *traces.gt_outcome())


@query(
    "executed_lines",
    """
    SELECT DISTINCT instance_id, test, file, line FROM (
      SELECT instance_id, test, file, line FROM fx_test_lines UNION ALL SELECT instance_id, test, file, lineno FROM fx_functions)
    """,
)
def executed_lines(spark, sf_dir):
    return traces.executed_lines(frame(spark, sf_dir, "fx_test_lines"), frame(spark, sf_dir, "fx_functions"), KEYS)


@query("trace_files", "SELECT DISTINCT instance_id, file FROM fx_functions")
def trace_files(spark, sf_dir):
    return traces.trace_files(frame(spark, sf_dir, "fx_test_lines"), frame(spark, sf_dir, "fx_functions"), ["instance_id"])


_MEMORY = "greatest(COALESCE(exclusive_alloc_bytes, 0), COALESCE(exclusive_rss_bytes, 0))"
_LINE_MEMORY = "greatest(COALESCE(alloc_bytes, 0), COALESCE(rss_bytes, 0))"
VIEWS["fx_values"] = f"""
SELECT instance_id, test, subtask, name, value FROM (
  SELECT instance_id, test, 'hot_methods_time' AS subtask, func AS name, CAST(exclusive_time_s AS DOUBLE) AS value,
         row_number() OVER (PARTITION BY instance_id, test, func ORDER BY pos DESC) AS rn FROM fx_functions
  UNION ALL
  SELECT instance_id, test, 'hot_methods_alloc', func, CAST({_MEMORY} AS DOUBLE),
         row_number() OVER (PARTITION BY instance_id, test, func ORDER BY pos DESC) FROM fx_functions
  UNION ALL
  SELECT instance_id, test, 'hot_lines_time', file || ':' || CAST(line AS VARCHAR(20)), CAST(time_ns AS DOUBLE), 1 FROM fx_test_lines WHERE time_ns > 0
  UNION ALL
  SELECT instance_id, test, 'hot_lines_alloc', file || ':' || CAST(line AS VARCHAR(20)), CAST({_LINE_MEMORY} AS DOUBLE), 1
  FROM fx_test_lines WHERE {_LINE_MEMORY} > 0) WHERE rn = 1
"""
VIEWS["fx_truth"] = f"""
SELECT instance_id, test, subtask, CAST(rn - 1 AS BIGINT) AS pos, name FROM (
  SELECT instance_id, test, 'hot_methods_time' AS subtask, func AS name,
         row_number() OVER (PARTITION BY instance_id, test ORDER BY exclusive_time_s DESC, pos) AS rn FROM fx_functions WHERE exclusive_time_s > 0
  UNION ALL
  SELECT instance_id, test, 'hot_methods_alloc', func,
         row_number() OVER (PARTITION BY instance_id, test ORDER BY {_MEMORY} DESC, pos) FROM fx_functions WHERE {_MEMORY} > 0
  UNION ALL
  SELECT instance_id, test, 'hot_lines_time', name, row_number() OVER (PARTITION BY instance_id, test ORDER BY time_ns DESC, name DESC)
  FROM (SELECT *, file || ':' || CAST(line AS VARCHAR(20)) AS name FROM fx_test_lines) WHERE time_ns > 0
  UNION ALL
  SELECT instance_id, test, 'hot_lines_alloc', name, row_number() OVER (PARTITION BY instance_id, test ORDER BY {_LINE_MEMORY} DESC, name DESC)
  FROM (SELECT *, file || ':' || CAST(line AS VARCHAR(20)) AS name FROM fx_test_lines) WHERE {_LINE_MEMORY} > 0) WHERE rn <= 20
"""


@query("value_tables", "SELECT instance_id, test, subtask, name, round(value, 6) AS value FROM fx_values")
def value_tables(spark, sf_dir):
    done = traces.value_tables(frame(spark, sf_dir, "fx_functions"), frame(spark, sf_dir, "fx_test_lines"), KEYS)
    return done.withColumn("value", F.round("value", 6))


@query("hot_truth", "SELECT instance_id, test, subtask, pos, name FROM fx_truth")
def hot_truth(spark, sf_dir):
    return samples.hot_truth(frame(spark, sf_dir, "fx_functions"), frame(spark, sf_dir, "fx_test_lines"))


def _hot_query(name, source, columns, run):
    @query(name, f"SELECT instance_id, test, name, pos + 1 AS rank FROM fx_truth WHERE subtask = '{name}'")
    def one(spark, sf_dir):
        return run(frame(spark, sf_dir, source), KEYS).select(*KEYS, F.col(columns).alias("name"), "rank")


_hot_query("hot_methods_time", "fx_functions", "func", hotspots.hot_methods_time)
_hot_query("hot_methods_alloc", "fx_functions", "func", hotspots.hot_methods_alloc)
_hot_query("hot_lines_time", "fx_test_lines", "name", hotspots.hot_lines_time)
_hot_query("hot_lines_alloc", "fx_test_lines", "name", hotspots.hot_lines_alloc)


_ELIGIBLE = {
    "combined": "wall AND told AND enabled AND lines",
    "outcome": "told",
    "peak_rss": "wall AND enabled AND (traced OR resident)",
    "wall_time": "wall",
    "hot_methods_time": "wall",
    "hot_methods_alloc": "wall AND enabled AND f_alloc",
    "hot_lines_time": "wall AND lines",
    "hot_lines_alloc": "wall AND enabled AND l_alloc AND lines",
}
_SIGNALS = """
SELECT t.*, wall_time_s >= 0.001 AS wall, outcome IS NOT NULL AND outcome <> 'skipped' AS told, tracemalloc_enabled AS enabled,
       peak_traced_bytes IS NOT NULL AND start_traced_bytes IS NOT NULL AS traced,
       peak_rss_bytes IS NOT NULL AND start_rss_bytes IS NOT NULL AS resident,
       l.test IS NOT NULL AS lines, COALESCE(l.l_alloc, false) AS l_alloc, f.test IS NOT NULL AS functions, COALESCE(f.f_alloc, false) AS f_alloc
FROM fx_tests t
LEFT JOIN (SELECT instance_id, test, bool_or(COALESCE(alloc_bytes, 0) <> 0) AS l_alloc FROM fx_test_lines GROUP BY 1, 2) l
  ON l.instance_id = t.instance_id AND l.test = t.test
LEFT JOIN (SELECT instance_id, test, bool_or(COALESCE(exclusive_alloc_bytes, 0) <> 0) AS f_alloc FROM fx_functions GROUP BY 1, 2) f
  ON f.instance_id = t.instance_id AND f.test = t.test
"""
_ELIGIBLE_ROWS = " UNION ALL ".join(
    f"SELECT *, '{task}' AS task FROM ({_SIGNALS}) WHERE NOT trimmed_by_events AND {rule}" for task, rule in _ELIGIBLE.items()
)


@query("eligible_tasks", f"SELECT instance_id, test, task FROM ({_ELIGIBLE_ROWS})")
def eligible_tasks(spark, sf_dir):
    signalled = samples.with_signals(
        frame(spark, sf_dir, "fx_tests"), frame(spark, sf_dir, "fx_functions"), frame(spark, sf_dir, "fx_test_lines")
    )
    return samples.eligible_tasks(signalled).select(*KEYS, "task")


_KEPT = """(instance_id NOT IN (SELECT instance_id FROM fx_targets) AND test <> 'session')
           OR (instance_id, test) IN (SELECT (instance_id, test) FROM fx_targets)"""


@query("keep_target_tests", f"SELECT instance_id, test FROM fx_tests WHERE {_KEPT}")
def keep_target_tests(spark, sf_dir):
    kept = filters.keep_target_tests(frame(spark, sf_dir, "fx_tests"), frame(spark, sf_dir, "fx_targets"))
    return kept.select(*KEYS)


@query(
    "matches_target",
    """
    SELECT instance_id, test || '[a]' AS test FROM fx_tests
    WHERE instance_id NOT IN (SELECT instance_id FROM fx_targets) OR (instance_id, test) IN (SELECT (instance_id, test) FROM fx_targets)
    """,
)
def matches_target(spark, sf_dir):
    tests = frame(spark, sf_dir, "fx_tests").withColumn("test", F.concat("test", F.lit("[a]")))
    return filters.matches_target(tests, frame(spark, sf_dir, "fx_targets")).select(*KEYS)


SAMPLES_SQL = f"""
SELECT e.instance_id || '::' || substr(sha1(e.test), 1, 10) || '::' || e.task || '::post' AS sample_id, e.task, e.instance_id, e.test,
       e.gt_outcome, e.gt_peak_bytes, round(w.wall_ms, 6) AS gt_wall_ms, e.wall_time_s, e.peak_rss_bytes, e.peak_traced_bytes
FROM (SELECT *, {_GT_LABEL} AS gt_outcome, {_GT} AS gt_peak_bytes FROM ({_ELIGIBLE_ROWS}) WHERE functions AND ({_KEPT})) e
JOIN (SELECT instance_id, test, sum(exclusive_time_s) * 1000 AS wall_ms FROM fx_functions GROUP BY 1, 2) w
  ON w.instance_id = e.instance_id AND w.test = e.test
WHERE NOT (e.task LIKE 'hot%' AND (e.instance_id, e.test, e.task) NOT IN (SELECT (instance_id, test, subtask) FROM fx_truth))
"""


def sample_rows(spark, sf_dir, functions=None, lines=None):
    return samples.build_samples(
        frame(spark, sf_dir, "fx_tests"),
        frame(spark, sf_dir, "fx_functions") if functions is None else functions,
        frame(spark, sf_dir, "fx_test_lines") if lines is None else lines,
        frame(spark, sf_dir, "fx_targets"),
    )


@query(
    "build_samples",
    f"SELECT sample_id, task, instance_id, test, gt_outcome, gt_peak_bytes, gt_wall_ms FROM ({SAMPLES_SQL})",
)
def build_samples(spark, sf_dir):
    return sample_rows(spark, sf_dir).select(
        "sample_id", "task", *KEYS, "gt_outcome", "gt_peak_bytes", F.round("gt_wall_ms", 6).alias("gt_wall_ms")
    )


@query("sample_manifest", f"SELECT task, count(*) AS samples, count(DISTINCT instance_id) AS instances FROM ({SAMPLES_SQL}) GROUP BY task")
def sample_manifest(spark, sf_dir):
    return samples.sample_manifest(sample_rows(spark, sf_dir), frame(spark, sf_dir, "fx_tests"))[0]


@query(
    "instances_without_samples",
    f"SELECT DISTINCT instance_id FROM fx_tests WHERE instance_id NOT IN (SELECT instance_id FROM ({SAMPLES_SQL}))",
)
def instances_without_samples(spark, sf_dir):
    return samples.sample_manifest(sample_rows(spark, sf_dir), frame(spark, sf_dir, "fx_tests"))[1]


@query(
    "benchmark_dataset",
    f"""
    SELECT s.sample_id, s.instance_id || '::post' AS env_id, COALESCE(s.peak_rss_bytes, 0) AS peak_rss_bytes,
           COALESCE(string_agg(CASE WHEN t.subtask = 'hot_methods_time' THEN t.name END, ',' ORDER BY t.pos), '') AS methods_time,
           COALESCE(string_agg(CASE WHEN t.subtask = 'hot_lines_alloc' THEN t.name END, ',' ORDER BY t.pos), '') AS lines_alloc,
           (SELECT count(*) FROM fx_values v WHERE v.instance_id = s.instance_id AND v.test = s.test AND v.subtask = 'hot_lines_time') AS n_line_values
    FROM ({SAMPLES_SQL}) s LEFT JOIN fx_truth t ON t.instance_id = s.instance_id AND t.test = s.test
    GROUP BY s.sample_id, s.instance_id, s.test, s.peak_rss_bytes
    """,
)
def benchmark_dataset(spark, sf_dir):
    # Functions are laid out by test once; samples, truth and values, and the lines made of them, need no further shuffle.
    columns = ["pos", "func", "file", "lineno", "call_count", "exclusive_time_s", "exclusive_alloc_bytes", "exclusive_rss_bytes"]
    records = frame(spark, sf_dir, "fx_functions", repeated=True).select(*KEYS, *columns)
    functions = traces.laid_out(records, KEYS)
    lines = frame(spark, sf_dir, "fx_test_lines", fx_functions=functions)
    flat = samples.benchmark_dataset(
        sample_rows(spark, sf_dir, functions, lines), samples.hot_truth(functions, lines), traces.value_tables(functions, lines, KEYS)
    )
    return flat.select(
        "sample_id",
        "env_id",
        "peak_rss_bytes",
        F.array_join(F.coalesce("ground_truth_hot_methods_time", F.array()), ",").alias("methods_time"),
        F.array_join(F.coalesce("ground_truth_hot_lines_alloc", F.array()), ",").alias("lines_alloc"),
        F.coalesce(F.size(F.json_object_keys("values_hot_lines_time")), F.lit(0)).cast("long").alias("n_line_values"),
    )


@query(
    "environment_buckets",
    f"""
    SELECT instance_id, 'post' AS side,
           COALESCE(string_agg(DISTINCT CASE WHEN gt_outcome = 'passed' THEN test END, ',' ORDER BY CASE WHEN gt_outcome = 'passed' THEN test END), '') AS tests_pass,
           COALESCE(string_agg(DISTINCT CASE WHEN gt_outcome = 'passed' THEN NULL ELSE test END, ',' ORDER BY CASE WHEN gt_outcome = 'passed' THEN NULL ELSE test END), '') AS tests_fail
    FROM ({SAMPLES_SQL}) WHERE gt_outcome IS NOT NULL GROUP BY instance_id
    """,
)
def environment_buckets(spark, sf_dir):
    done = samples.environment_buckets(sample_rows(spark, sf_dir).where("gt_outcome IS NOT NULL"))
    return done.select(
        "instance_id", "side", F.array_join("tests_pass", ",").alias("tests_pass"), F.array_join("tests_fail", ",").alias("tests_fail")
    )


@query(
    "environments",
    f"""
    SELECT DISTINCT s.instance_id || '::' || side AS env_id, s.instance_id, side, c_mktsegment AS repo,
           CASE WHEN side = 'post' THEN c_name ELSE '' END AS patch, COALESCE(CASE WHEN c_acctbal > 0 THEN c_name END, '') AS container
    FROM (SELECT instance_id, 'post' AS side FROM ({SAMPLES_SQL}) WHERE gt_outcome IS NOT NULL UNION ALL
          SELECT instance_id, 'pre' FROM ({SAMPLES_SQL}) WHERE gt_outcome IS NOT NULL) s
    JOIN customer ON 'i' || CAST(c_custkey AS VARCHAR(20)) = s.instance_id
    """,
)
def environments(spark, sf_dir):
    told = sample_rows(spark, sf_dir).where("gt_outcome IS NOT NULL")
    both = told.unionByName(told.withColumn("side", F.lit("pre")))
    instances = frame(
        spark,
        sf_dir,
        """SELECT 'i' || CAST(c_custkey AS STRING) AS instance_id, c_mktsegment AS repo, 'c0' AS base_commit, c_name AS patch,
                  'tp' AS test_patch, CASE WHEN c_acctbal > 0 THEN c_name END AS container, 'pytest' AS command FROM customer""",
    )
    return samples.environments(both, instances).select("env_id", "instance_id", "side", "repo", "patch", "container")


@query(
    "with_prompts",
    f"""
    SELECT s.sample_id, COALESCE(CASE WHEN t.outcome = 'passed' THEN 'stored ' || s.task END, 'embedded ' || s.test) AS user_prompt
    FROM ({SAMPLES_SQL}) s JOIN fx_tests t ON t.instance_id = s.instance_id AND t.test = s.test
    """,
)
def with_prompts(spark, sf_dir):
    rows = sample_rows(spark, sf_dir).withColumn("user_prompt", F.concat(F.lit("embedded "), "test"))
    stored = rows.where("outcome = 'passed' OR outcome = 'error'").select(
        "sample_id",
        F.when(F.col("outcome") == "passed", F.concat(F.lit("stored "), "task")).otherwise("").alias("prompt"),
    )
    return samples.with_prompts(rows, stored).select("sample_id", "user_prompt")


# Samples whose test id is the trace's, a variant of it, or unknown; some traces have a session record.
_ASKED = """
SELECT 'q' || test AS sample_id, instance_id,
       CASE outcome WHEN 'passed' THEN test WHEN 'failed' THEN test || '[v]' ELSE 'elsewhere::' || test END AS test,
       wall_time_s, outcome, 'post' AS side
FROM fx_tests
"""
_TRACED = """
SELECT instance_id, test || CASE WHEN outcome = 'failed' THEN '[w]' ELSE '' END AS test, wall_time_s, peak_rss_bytes, outcome,
       CAST(row_number() OVER (PARTITION BY instance_id ORDER BY test) AS BIGINT) AS pos
FROM fx_tests WHERE outcome IN ('passed', 'failed')
UNION ALL
SELECT DISTINCT instance_id, 'session', 1.0, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR(8)), CAST(0 AS BIGINT) FROM fx_tests WHERE wall_time_s > 49
"""
_MATCHED = f"""
SELECT a.sample_id, a.instance_id, a.test, COALESCE(
         (SELECT max(t.test) FROM ({_TRACED}) t WHERE t.instance_id = a.instance_id AND t.test = a.test),
         (SELECT max(t.test) FROM ({_TRACED}) t WHERE t.instance_id = a.instance_id AND t.test = 'session'),
         (SELECT min_by(t.test, t.pos) FROM ({_TRACED}) t WHERE t.instance_id = a.instance_id AND t.test <> 'session'
            AND starts_with(a.test, split_part(t.test, '[', 1))),
         (SELECT min_by(t.test, t.pos) FROM ({_TRACED}) t WHERE t.instance_id = a.instance_id)) AS trace_test
FROM ({_ASKED}) a
"""


@query("match_trace_test", f"SELECT sample_id, trace_test FROM ({_MATCHED})")
def match_trace_test(spark, sf_dir):
    done = samples.match_trace_test(frame(spark, sf_dir, _ASKED), frame(spark, sf_dir, _TRACED))
    return done.select("sample_id", "trace_test")


@query(
    "trace_dataset",
    f"""
    SELECT m.sample_id, m.instance_id || '::post' AS env_id, m.trace_test, COALESCE(t.outcome, '') AS outcome,
           round(COALESCE(t.wall_time_s, 0), 6) AS wall_time_s, COALESCE(t.peak_rss_bytes, 0) AS peak_rss_bytes
    FROM ({_MATCHED}) m LEFT JOIN ({_TRACED}) t ON t.instance_id = m.instance_id AND t.test = m.trace_test
    """,
)
def trace_dataset(spark, sf_dir):
    done = samples.trace_dataset(frame(spark, sf_dir, _ASKED), frame(spark, sf_dir, _TRACED))
    return done.select(
        "sample_id", "env_id", "trace_test", "outcome", F.round("wall_time_s", 6).alias("wall_time_s"), "peak_rss_bytes"
    )


@query(
    "overlay_sources",
    """
    SELECT source AS instance_id, CAST(doc_id AS VARCHAR(20)) AS file, md5(CASE WHEN lang = 'en' THEN text ELSE 'after' || text END) AS digest
    FROM documents
    """,
)
def overlay_sources(spark, sf_dir):
    docs = frame(spark, sf_dir, "documents").select(
        F.col("source").alias("instance_id"), F.col("doc_id").cast("string").alias("file"), "text", "lang"
    )
    pre = docs.where("lang = 'en'").withColumn("content", F.col("text"))
    post = docs.withColumn("content", F.concat(F.lit("after"), "text"))
    return samples.overlay_sources(pre, post).select("instance_id", "file", F.md5("content").alias("digest"))


# Events -----------------------------------------------------------------------------------------

_PARENTS = """
SELECT c.test, c.seq, (SELECT min(p.seq) FROM fx_call_events p WHERE p.test = c.test AND p.depth = c.depth - 1 AND p.seq > c.seq) AS parent
FROM fx_call_events c
"""
_EXCLUSIVE = f"""
SELECT e.*, greatest(0, e.rss_after - e.rss_before) AS rss_inclusive,
       greatest(0, e.wall_ns - COALESCE(s.wall, 0)) AS exclusive_ns,
       greatest(0, e.alloc_inclusive - COALESCE(s.alloc, 0)) AS alloc_exclusive,
       greatest(0, greatest(0, e.rss_after - e.rss_before) - COALESCE(s.rss, 0)) AS rss_exclusive
FROM fx_call_events e LEFT JOIN (
  SELECT p.test, p.parent, CAST(sum(c.wall_ns) AS BIGINT) AS wall, CAST(sum(c.alloc_inclusive) AS BIGINT) AS alloc,
         CAST(sum(greatest(0, c.rss_after - c.rss_before)) AS BIGINT) AS rss
  FROM ({_PARENTS}) p JOIN fx_call_events c ON c.test = p.test AND c.seq = p.seq WHERE p.parent IS NOT NULL GROUP BY 1, 2) s
ON s.test = e.test AND s.parent = e.seq
"""


@query("exclusive_cost", f"SELECT test, seq, exclusive_ns, alloc_exclusive, rss_exclusive FROM ({_EXCLUSIVE})")
def exclusive_cost(spark, sf_dir):
    done = events.exclusive_cost(frame(spark, sf_dir, "fx_call_events"))
    return done.select("test", "seq", "exclusive_ns", "alloc_exclusive", "rss_exclusive")


@query(
    "function_summary",
    f"""
    SELECT test, func, max_by(file, seq) AS file, max_by(lineno, seq) AS lineno, count(*) AS call_count,
           CAST(sum(wall_ns) AS BIGINT) AS total_ns, CAST(sum(exclusive_ns) AS BIGINT) AS exclusive_ns, max(wall_ns) AS max_ns,
           max(depth) AS max_depth, greatest(0, max(rss_after - rss_before)) AS max_rss_delta,
           CAST(sum(alloc_inclusive) AS BIGINT) AS total_alloc, CAST(sum(alloc_exclusive) AS BIGINT) AS exclusive_alloc,
           max(alloc_inclusive) AS max_alloc, CAST(sum(rss_exclusive) AS BIGINT) AS exclusive_rss
    FROM ({_EXCLUSIVE}) GROUP BY test, func
    """,
)
def function_summary(spark, sf_dir):
    return events.function_summary(events.exclusive_cost(frame(spark, sf_dir, "fx_call_events")))


@query(
    "line_summary",
    """
    SELECT test, file, line, count(*) AS hits, CAST(sum(time_ns) AS BIGINT) AS time_ns,
           CAST(COALESCE(sum(alloc_bytes), 0) AS BIGINT) AS alloc_bytes FROM fx_line_events GROUP BY test, file, line
    """,
)
def line_summary(spark, sf_dir):
    return events.line_summary(frame(spark, sf_dir, "fx_line_events"))


# A line-level session per user: the event type is the kind of event.
_TIMELINE = """
SELECT 'u' || CAST(user_id AS VARCHAR(20)) AS test,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS seq,
       CASE event_type WHEN 'signup' THEN 'call' WHEN 'error' THEN 'return' ELSE 'line' END AS kind,
       'src/' || event_type || '.py' AS file, event_id % 50 AS line, event_id * 1000 AS ts_ns, CAST(floor(value * 10) AS BIGINT) AS alloc
FROM events
"""


@query(
    "line_costs",
    f"""
    SELECT test, file, line, seq, COALESCE(next_ts - ts_ns, 0) AS time_ns, greatest(0, COALESCE(next_alloc - alloc, 0)) AS alloc_bytes
    FROM (SELECT *, lead(ts_ns) OVER (PARTITION BY test ORDER BY seq) AS next_ts, lead(alloc) OVER (PARTITION BY test ORDER BY seq) AS next_alloc
          FROM ({_TIMELINE})) WHERE kind = 'line'
    """,
)
def line_costs(spark, sf_dir):
    return events.line_costs(frame(spark, sf_dir, _TIMELINE))


# Call events of depths 0 to 12 with the last return before each call: that of an event at most as deep.
VIEWS["fx_deep_events"] = """
SELECT test, seq, func, CAST((wall_ns + lineno) % 13 AS INT) AS depth FROM fx_call_events
"""
_CALLED = """
SELECT e.*, COALESCE((SELECT max(p.seq) FROM fx_deep_events p WHERE p.test = e.test AND p.seq < e.seq AND p.depth <= e.depth), 0) AS called
FROM fx_deep_events e
"""
_TOLD = f"""
SELECT c.*, u.place, count(CASE WHEN u.place <= 4 AND c.depth < 9 THEN 1 END) OVER (PARTITION BY c.test ORDER BY c.seq) AS recorded
FROM ({_CALLED}) c LEFT JOIN (
  SELECT test, func, row_number() OVER (PARTITION BY test ORDER BY min(called * 100 + depth)) AS place
  FROM ({_CALLED}) WHERE depth < 9 GROUP BY test, func) u ON u.test = c.test AND u.func = c.func
"""
_TIMED = f"""
SELECT t.*, f.full_at IS NULL OR t.called < f.full_at AS in_time
FROM ({_TOLD}) t LEFT JOIN (SELECT test, min(seq) AS full_at FROM ({_TOLD}) WHERE recorded >= 30 GROUP BY test) f ON f.test = t.test
"""


@query("with_called", f"SELECT test, seq, depth, called FROM ({_CALLED})")
def with_called(spark, sf_dir):
    return events.with_called(frame(spark, sf_dir, "fx_deep_events")).select("test", "seq", "depth", "called")


@query("apply_limits", f"SELECT test, seq FROM ({_TIMED}) WHERE in_time AND place <= 4 AND depth < 9")
def apply_limits(spark, sf_dir):
    kept, _ = events.apply_limits(frame(spark, sf_dir, "fx_deep_events"), max_events=30, max_depth=9, max_functions=4)
    return kept.select("test", "seq")


@query(
    "trim_reasons",
    f"""
    SELECT test, trim_reasons FROM (
      SELECT test, concat_ws(',', CASE WHEN max(depth) >= 9 THEN 'max_depth' END,
             CASE WHEN bool_or(depth < 9 AND in_time AND COALESCE(place, 9) > 4) THEN 'max_functions' END,
             CASE WHEN bool_or(depth < 9 AND NOT in_time) THEN 'max_events' END) AS trim_reasons
      FROM ({_TIMED}) GROUP BY test) WHERE trim_reasons <> ''
    """,
)
def trim_reasons(spark, sf_dir):
    _, trims = events.apply_limits(frame(spark, sf_dir, "fx_deep_events"), max_events=30, max_depth=9, max_functions=4)
    return trims.select("test", F.array_join("trim_reasons", ",").alias("trim_reasons"))


@query(
    "call_sequence",
    """
    SELECT e.test, e.func, e.depth, e.wall_ns, e.seq AS place, t.total_call_events, t.total_call_events > 50 AS call_sequence_truncated
    FROM fx_call_events e JOIN (SELECT test, count(*) AS total_call_events FROM fx_call_events GROUP BY test) t ON t.test = e.test
    WHERE e.seq <= 50
    """,
)
def call_sequence(spark, sf_dir):
    kept, totals = events.call_sequence(frame(spark, sf_dir, "fx_call_events"), 50)
    return kept.join(totals, "test").select(
        "test", "func", "depth", "wall_ns", "place", "total_call_events", "call_sequence_truncated"
    )


# Nested calls: every four consecutive events of a user call each other and return in reverse.
VIEWS["fx_blocks"] = """
SELECT 'u' || CAST(user_id AS VARCHAR(20)) AS session, CAST(floor((rn - 1) / 4) AS BIGINT) AS block, (rn - 1) % 4 AS depth,
       CASE WHEN event_type IN ('click', 'view') THEN 'test_' ELSE 'fn_' END || event_type AS func
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
"""
VIEWS["fx_frames"] = """
SELECT session, CAST(block * 8 + depth AS BIGINT) AS seq, 'call' AS kind, func, depth FROM fx_blocks
UNION ALL SELECT session, CAST(block * 8 + 7 - depth AS BIGINT), 'return', func, depth FROM fx_blocks
"""
SEGMENTS = """
SELECT f.session, f.seq, COALESCE(o.func, 'session') AS test, o.seq AS test_start
FROM fx_frames f LEFT JOIN (
  SELECT c.session, c.func, c.seq, c.depth, CAST(floor(c.seq / 8) AS BIGINT) AS block,
         row_number() OVER (PARTITION BY c.session, floor(c.seq / 8) ORDER BY c.depth) AS rn
  FROM fx_frames c WHERE c.kind = 'call' AND starts_with(c.func, 'test_')) o
ON o.rn = 1 AND o.session = f.session AND o.block = CAST(floor(f.seq / 8) AS BIGINT) AND f.depth >= o.depth
"""


@query("segment_tests", SEGMENTS, doubles=("test_start",))
def segment_tests(spark, sf_dir):
    done = events.segment_tests(frame(spark, sf_dir, "fx_frames"))
    return done.select("session", "seq", "test", "test_start")


# Memory: one segment per call of the nested frames, ended by its return.
VIEWS["fx_memory"] = """
SELECT session AS test, seq, depth, func, CAST(seq % 13 AS BIGINT) * 100 AS base, CAST(seq % 17 AS BIGINT) * 100 AS cur,
       CAST(seq % 29 AS BIGINT) * 100 AS peak FROM fx_frames WHERE kind = 'return'
"""
# Each return with the previous one of its level and its parent; readings between the two levels of a
# return lie below it.
_RETURNS = """
SELECT c.*, greatest(0, c.cur - c.base) AS incl_delta,
       COALESCE(lag(c.seq) OVER (PARTITION BY c.test, c.depth ORDER BY c.seq), -1) AS previous,
       (SELECT min(p.seq) FROM fx_memory p WHERE p.test = c.test AND p.depth = c.depth - 1 AND p.seq >= c.seq) AS parent
FROM fx_memory c
"""
_PEAKS = f"""
WITH returns AS ({_RETURNS}),
highest AS (
  SELECT c.test, c.seq, max(greatest(r.peak, r.base)) AS high
  FROM returns c JOIN returns r ON r.test = c.test AND r.depth >= c.depth AND r.seq <= c.seq AND r.seq > c.previous GROUP BY 1, 2),
own AS (
  SELECT c.test, c.seq, max(r.peak - COALESCE((SELECT sum(k.incl_delta) FROM returns k WHERE k.test = c.test AND k.parent = c.seq AND k.seq < r.seq), 0)) AS own_high
  FROM returns c JOIN returns r ON r.test = c.test AND r.depth = c.depth AND r.seq <= c.seq AND r.seq > c.previous GROUP BY 1, 2),
children AS (SELECT test, parent AS seq, sum(incl_delta) AS child_delta FROM returns WHERE parent IS NOT NULL GROUP BY 1, 2)
SELECT c.test, c.seq, c.func, greatest(0, h.high - c.base) AS incl_peak, greatest(0, COALESCE(o.own_high - c.base, 0)) AS excl_peak,
       c.incl_delta, greatest(0, c.incl_delta - COALESCE(k.child_delta, 0)) AS excl_delta
FROM returns c LEFT JOIN highest h ON h.test = c.test AND h.seq = c.seq LEFT JOIN own o ON o.test = c.test AND o.seq = c.seq
LEFT JOIN children k ON k.test = c.test AND k.seq = c.seq
"""
_QUANTITIES = ", ".join(
    f"CAST({agg}({q}) AS BIGINT) AS {q}_{agg}" for q in ("incl_peak", "excl_peak", "incl_delta", "excl_delta") for agg in ("sum", "max")
)


def _peaks(spark, sf_dir):
    returns = frame(spark, sf_dir, "fx_memory")
    return events.memory_peaks(returns.drop("peak"), returns.select("test", "seq", "depth", "peak"))


@query(
    "memory_calls",
    f"""SELECT test, seq, func, CAST(incl_peak AS BIGINT) AS incl_peak, CAST(excl_peak AS BIGINT) AS excl_peak,
               CAST(incl_delta AS BIGINT) AS incl_delta, CAST(excl_delta AS BIGINT) AS excl_delta FROM ({_PEAKS})""",
)
def memory_calls(spark, sf_dir):
    return _peaks(spark, sf_dir).select("test", "seq", "func", "incl_peak", "excl_peak", "incl_delta", "excl_delta")


@query("memory_peaks", f"SELECT test, func, count(*) AS call_count, {_QUANTITIES} FROM ({_PEAKS}) GROUP BY test, func")
def memory_peaks(spark, sf_dir):
    return events.memory_functions(_peaks(spark, sf_dir))


_ENTRIES = """
SELECT 'u' || CAST(l_suppkey AS VARCHAR(20)) AS test, 'f' || CAST(l_partkey % 50 AS VARCHAR(8)) AS name,
       'm' || CAST(l_linenumber % 2 AS VARCHAR(8)) || '.py' AS filename, CAST(l_linenumber % 3 AS BIGINT) AS firstlineno,
       l_orderkey * 100000 + l_partkey * 10 + l_linenumber AS pos, CAST(l_quantity AS BIGINT) AS call_count,
       CAST(l_quantity AS DOUBLE) / 8 AS exclusive_time_s, CAST(l_quantity AS DOUBLE) / 4 AS inclusive_time_s
FROM (SELECT l_suppkey, l_partkey, l_linenumber, l_orderkey, min(l_quantity) AS l_quantity FROM lineitem GROUP BY 1, 2, 3, 4)
"""


@query(
    "profile_functions",
    f"""
    WITH homed AS (
      SELECT e.*, first_value(filename) OVER w || ':' || CAST(first_value(firstlineno) OVER w AS VARCHAR) = filename || ':' || CAST(firstlineno AS VARCHAR) AS home
      FROM ({_ENTRIES}) e WINDOW w AS (PARTITION BY test, name ORDER BY pos))
    SELECT test, func, max_by(filename, pos) AS filename, max_by(firstlineno, pos) AS firstlineno,
           CASE WHEN bool_or(home) THEN CAST(sum(call_count) AS BIGINT) ELSE max_by(call_count, pos) END AS call_count,
           CASE WHEN bool_or(home) THEN sum(exclusive_time_s) ELSE max_by(exclusive_time_s, pos) END AS exclusive_time_s,
           CASE WHEN bool_or(home) THEN sum(inclusive_time_s) ELSE max_by(inclusive_time_s, pos) END AS inclusive_time_s
    FROM (SELECT *, CASE WHEN home THEN name ELSE name || '#L' || CAST(firstlineno AS VARCHAR) END AS func FROM homed) GROUP BY test, func
    """,
)
def profile_functions(spark, sf_dir):
    return events.profile_functions(frame(spark, sf_dir, _ENTRIES))


# Phases: line numbers are phases of an order's test.
_PHASES = """
SELECT 't' || CAST(l_orderkey AS VARCHAR(20)) AS test, l_orderkey * 1000000 + l_partkey * 10 + l_linenumber AS seq,
       CASE WHEN l_linenumber < 3 THEN 'setup' WHEN l_linenumber < 6 THEN 'call' ELSE 'teardown' END AS phase,
       CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'failed' WHEN l_returnflag = 'A' THEN 'skipped' ELSE 'passed' END AS outcome,
       CASE WHEN l_quantity < 10 THEN 'AssertionError: expected: ' || CAST(l_partkey AS VARCHAR(20)) WHEN l_quantity < 30 THEN 'ValueError: bad'
            WHEN l_quantity < 45 THEN 'Timeout' END AS message,
       CAST(l_quantity AS DOUBLE) / 16 AS duration
FROM (SELECT l_orderkey, l_partkey, l_linenumber, min(l_returnflag) AS l_returnflag, min(l_linestatus) AS l_linestatus, min(l_quantity) AS l_quantity
      FROM lineitem GROUP BY 1, 2, 3)
"""


@query(
    "fold_phases",
    f"""
    SELECT test, outcome, failure_phase, split_part(NULLIF(message, ''), ': ', 1) AS exception_type,
           CASE WHEN contains(message, ': ') THEN substr(message, strpos(message, ': ') + 2) END AS exception_message,
           COALESCE(split_part(message, ': ', 1) = 'AssertionError', false) AS is_assertion
    FROM (
      SELECT test, CASE WHEN f.phase IS NOT NULL THEN CASE f.phase WHEN 'call' THEN 'failed' ELSE 'error' END ELSE o.outcome END AS outcome,
             COALESCE(f.phase, CASE WHEN o.outcome = 'skipped' THEN o.phase END) AS failure_phase, f.message AS message
      FROM (SELECT test, arg_max({{'phase': phase, 'message': message}}, CASE WHEN outcome = 'failed' THEN seq END) AS f,
                   arg_min({{'phase': phase, 'outcome': outcome}}, CASE WHEN outcome = 'skipped' OR (outcome = 'passed' AND phase = 'call') THEN seq END) AS o
            FROM ({_PHASES}) GROUP BY test))
    WHERE outcome IS NOT NULL
    """,
)
def fold_phases(spark, sf_dir):
    return events.fold_phases(frame(spark, sf_dir, _PHASES))


@query(
    "phase_durations",
    f"""
    SELECT test, arg_max(duration, CASE WHEN phase = 'setup' THEN seq END) AS setup_time_s,
           arg_max(duration, CASE WHEN phase = 'call' THEN seq END) AS call_time_s,
           arg_max(duration, CASE WHEN phase = 'teardown' THEN seq END) AS teardown_time_s
    FROM ({_PHASES}) GROUP BY test
    """,
)
def phase_durations(spark, sf_dir):
    return events.phase_durations(frame(spark, sf_dir, _PHASES))
