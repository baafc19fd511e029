"""Queries on draws and the prediction datasets."""

from __future__ import annotations

from pyspark.sql import functions as F

from runlens.functions import prompts
from runlens.operators import filters, hotspots, sampling
from runlens.plans import datasets
from runlens.plans.catalog.inputs import narrow_states, states
from runlens.plans.catalog.registry import frame, query
from runlens.plans.catalog.views import VIEWS


def uniform(seed: int, *parts: str) -> str:
    """The keyed uniform in DuckDB's SQL."""
    text = " || '|' || ".join([f"'{seed}'", *parts])
    return f"((CAST(CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0)"


# States every test-status build keeps, their reported outcomes, and candidates of each group.
VIEWS["fx_kept"] = "SELECT * FROM fx_chain4 WHERE reason IS NULL"
VIEWS["fx_reported"] = """
SELECT k.group_id, k.instance_id, k.variant, k.row_index, o.test, o.status
FROM fx_kept k JOIN fx_outcomes o ON o.instance_id = k.instance_id WHERE o.status <> 'SKIPPED'
"""
VIEWS["fx_candidates"] = "SELECT DISTINCT group_id, test FROM fx_reported WHERE variant = 'base' AND status = 'PASSED'"
VIEWS["fx_group_sizes"] = "SELECT group_id, count(*) AS group_size FROM fx_kept GROUP BY group_id"
VIEWS["fx_agreement"] = """
SELECT c.group_id, c.test, g.group_size,
       CAST(sum(CASE WHEN r.status = 'PASSED' THEN 1 ELSE 0 END) AS BIGINT) AS passed, count(*) AS reported
FROM fx_candidates c JOIN fx_reported r ON r.group_id = c.group_id AND r.test = c.test
JOIN fx_group_sizes g ON g.group_id = c.group_id GROUP BY c.group_id, c.test, g.group_size
"""

_KIND = "CASE WHEN passed < reported THEN 'disagreed' WHEN passed = group_size THEN 'agreed' ELSE 'neither' END"
_AGREED = f"SELECT *, {_KIND} AS kind, 1 - passed / CAST(group_size AS DOUBLE) AS weight FROM fx_agreement"
_DRAWN = f"""
SELECT group_id, test FROM (
  SELECT group_id, test, row_number() OVER (PARTITION BY group_id ORDER BY CASE kind WHEN 'disagreed' THEN 0 ELSE 1 END,
    -ln({uniform(0, 'group_id', 'test')}) / CASE kind WHEN 'disagreed' THEN weight ELSE 1.0 END, test) AS rn
  FROM ({_AGREED}) WHERE kind <> 'neither') WHERE rn = 1
"""
_DRAWN_STATES = f"""
SELECT group_id, test, instance_id, status FROM (
  SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY CASE WHEN fr = 1 THEN 1 - ok ELSE 2 END, u, instance_id) AS rn FROM (
    SELECT *, row_number() OVER (PARTITION BY group_id, ok ORDER BY u, instance_id) AS fr FROM (
      SELECT r.group_id, r.test, r.instance_id, r.status, CASE WHEN r.status = 'PASSED' THEN 1 ELSE 0 END AS ok,
             {uniform(0, 'r.group_id', 'r.instance_id')} AS u
      FROM fx_reported r JOIN ({_DRAWN}) d ON d.group_id = r.group_id AND d.test = r.test
      WHERE r.variant NOT IN ('base', 'fixed')))) WHERE rn <= 2
"""


def _label(variant: str) -> str:
    return f"""CASE WHEN d.group_id IN (SELECT group_id FROM fx_kept WHERE variant = '{variant}')
      THEN COALESCE((SELECT max(status) FROM fx_reported r WHERE r.group_id = d.group_id AND r.variant = '{variant}' AND r.test = d.test), 'OTHER') END"""


_LABELS = f"SELECT d.group_id, d.test, {_label('base')} AS base_label, {_label('fixed')} AS fixed_label FROM ({_DRAWN}) d"


def _source(spark, sf_dir):
    """Filtered narrow states and their outcomes, as the builds see them."""
    kept, _ = datasets.filter_states(narrow_states(spark, sf_dir), frame(spark, sf_dir, "fx_known_groups"))
    return kept, frame(spark, sf_dir, "fx_measured").select("instance_id", "test", "status")


@query(
    "agreement",
    f"SELECT group_id, test, passed, reported, group_size, kind, round(weight, 6) AS weight FROM ({_AGREED})",
)
def agreement(spark, sf_dir):
    kept, outs = _source(spark, sf_dir)
    done = sampling.agreement(outs, kept).withColumn("weight", F.round("weight", 6))
    return done.drop("base_label", "fixed_label")


@query("draw_test", _DRAWN)
def draw_test(spark, sf_dir):
    kept, outs = _source(spark, sf_dir)
    return sampling.draw_test(sampling.agreement(outs, kept)).select("group_id", "test")


@query("draw_states", _DRAWN_STATES)
def draw_states(spark, sf_dir):
    kept, outs = _source(spark, sf_dir)
    drawn = sampling.draw_test(sampling.agreement(outs, kept))
    return sampling.draw_states(outs, kept, drawn).drop("row_index", "base_label", "fixed_label")


@query("variant_labels", _LABELS)
def variant_labels(spark, sf_dir):
    kept, outs = _source(spark, sf_dir)
    return sampling.draw_test(sampling.agreement(outs, kept))


_UNIFORM_STATES = f"""
SELECT group_id, instance_id FROM (
  SELECT group_id, instance_id, row_number() OVER (PARTITION BY group_id ORDER BY {uniform(0, 'group_id', 'instance_id')}, instance_id) AS rn
  FROM fx_kept WHERE variant NOT IN ('base', 'fixed')) WHERE rn <= 2
"""


@query("draw_uniform", _UNIFORM_STATES)
def draw_uniform(spark, sf_dir):
    kept, _ = _source(spark, sf_dir)
    return sampling.draw_uniform(kept).select("group_id", "instance_id")


_NON_PASSED = "SELECT group_id, test, group_size - passed AS non_passed FROM fx_agreement"


@query("non_passed_counts", _NON_PASSED)
def non_passed_counts(spark, sf_dir):
    kept, outs = _source(spark, sf_dir)
    return sampling.non_passed_counts(outs, kept)


_WEIGHTS = f"""
SELECT r.instance_id, r.test, r.status, CASE WHEN least_positive IS NULL THEN 1.0 WHEN non_passed > 0 THEN CAST(non_passed AS DOUBLE)
       ELSE least_positive / (zeros + 1.0) END AS weight
FROM (SELECT r.*, n.non_passed,
             min(CASE WHEN non_passed > 0 THEN non_passed END) OVER (PARTITION BY r.instance_id) AS least_positive,
             count(CASE WHEN non_passed = 0 THEN 1 END) OVER (PARTITION BY r.instance_id) AS zeros
      FROM fx_reported r JOIN ({_NON_PASSED}) n ON n.group_id = r.group_id AND n.test = r.test) r
"""


@query("sampling_weights", f"SELECT instance_id, test, round(weight, 6) AS weight FROM ({_WEIGHTS})")
def sampling_weights(spark, sf_dir):
    kept, outs = _source(spark, sf_dir)
    counted = sampling.reported(outs).join(kept.select("group_id", "instance_id"), "instance_id").join(
        sampling.non_passed_counts(outs, kept), ["group_id", "test"]
    )
    return sampling.sampling_weights(counted).select("instance_id", "test", F.round("weight", 6).alias("weight"))


def _drawn_tests(n: int) -> str:
    return f"""
    SELECT instance_id, test, status FROM (
      SELECT w.*, row_number() OVER (PARTITION BY instance_id ORDER BY -ln({uniform(0, 'instance_id', 'test')}) / weight, test) AS rn
      FROM ({_WEIGHTS}) w WHERE instance_id IN (SELECT instance_id FROM ({_UNIFORM_STATES}))) WHERE rn <= {n}
    """


@query("draw_tests", _drawn_tests(10))
def draw_tests(spark, sf_dir):
    kept, outs = _source(spark, sf_dir)
    return sampling.draw_tests(outs, kept, sampling.draw_uniform(kept), n=10).select("instance_id", "test", "status")


@query(
    "single_test_status",
    f"""
    SELECT s.instance_id, s.repo, s.base_commit, s.patch, s.container, s.command, d.test, d.status AS label,
           l.base_label, l.fixed_label
    FROM ({_DRAWN_STATES}) d JOIN fx_states s ON s.instance_id = d.instance_id JOIN ({_LABELS}) l ON l.group_id = d.group_id
    """,
)
def single_test_status(spark, sf_dir):
    built = datasets.build_single_test_status(states(spark, sf_dir), frame(spark, sf_dir, "fx_known_groups"))
    return built.drop("Q3", "Q4", "labels_description")


@query(
    "single_test_label_counts", f"SELECT status AS label, count(*) AS rows FROM ({_DRAWN_STATES}) GROUP BY status"
)
def single_test_label_counts(spark, sf_dir):
    built = datasets.build_single_test_status(states(spark, sf_dir), frame(spark, sf_dir, "fx_known_groups"))
    return datasets.label_counts(built)


@query(
    "test_status_anchored",
    f"""
    SELECT s.instance_id, s.repo, s.base_commit, s.patch, s.container, s.command,
           string_agg(d.test, ',' ORDER BY d.test) AS tests, string_agg(d.status, ',' ORDER BY d.test) AS labels
    FROM ({_drawn_tests(100)}) d JOIN fx_states s ON s.instance_id = d.instance_id GROUP BY ALL
    """,
)
def test_status_anchored(spark, sf_dir):
    built = datasets.build_test_status_anchored(states(spark, sf_dir), frame(spark, sf_dir, "fx_known_groups"))
    return built.select(
        *datasets.COPIED, F.array_join("tests", ",").alias("tests"), F.array_join("labels", ",").alias("labels")
    )


@query("anchored_label_counts", f"SELECT status AS labels, count(*) AS rows FROM ({_drawn_tests(100)}) GROUP BY status")
def anchored_label_counts(spark, sf_dir):
    built = datasets.build_test_status_anchored(states(spark, sf_dir), frame(spark, sf_dir, "fx_known_groups"))
    return datasets.label_counts(built, "labels")


# Times: one workload per state; profiled seconds from part prices through the state number.
VIEWS["fx_times"] = """
SELECT s.instance_id, p_retailprice * s.variant_no * s.variant_no / 40 - 30 AS time_s
FROM fx_states s JOIN part ON p_partkey = s.grp * 7 + s.variant_no
"""
_LADDERS = "(VALUES " + ", ".join(
    f"({i}, [{', '.join(repr(e) + '::DOUBLE' for e in run)}])" for i, run in enumerate(sampling.ladder_table())
) + ") AS ladder(no, d)"
_HELD = f"""
SELECT t.instance_id, t.time_s, no, d, c.correct FROM fx_times t, {_LADDERS}, (VALUES (0), (1), (2), (3)) AS c(correct)
WHERE time_s > 0 AND CASE c.correct WHEN 0 THEN time_s / d[1] BETWEEN 0.25 AND 0.75
   WHEN 3 THEN time_s / d[3] BETWEEN 1.4 AND 3.0
   ELSE (time_s - d[c.correct]) / (d[c.correct + 1] - d[c.correct]) BETWEEN 0.25 AND 0.75 END
"""
_BUCKETS = f"""
SELECT h.instance_id, h.time_s, h.d, h.correct FROM (
  SELECT h.*, row_number() OVER (PARTITION BY instance_id, correct ORDER BY no) - 1 AS place,
         count(*) OVER (PARTITION BY instance_id, correct) AS n FROM ({_HELD}) h) h
JOIN (SELECT instance_id, correct FROM (
        SELECT instance_id, correct, row_number() OVER (PARTITION BY instance_id ORDER BY correct) - 1 AS place,
               count(*) OVER (PARTITION BY instance_id) AS n FROM (SELECT DISTINCT instance_id, correct FROM ({_HELD})))
      WHERE place = floor({uniform(0, 'instance_id', "'bucket'")} * n)) b ON b.instance_id = h.instance_id AND b.correct = h.correct
WHERE h.place = floor({uniform(0, 'h.instance_id', "'ladder'")} * h.n)
"""


def _g(edge: str) -> str:
    return f"regexp_replace(CAST({edge} AS VARCHAR), '\\.0$', '')"


_LABEL_LIST = (
    f"['<' || {_g('d[1]')} || 's', {_g('d[1]')} || '-' || {_g('d[2]')} || 's', "
    f"{_g('d[2]')} || '-' || {_g('d[3]')} || 's', '>' || {_g('d[3]')} || 's']"
)


@query("bucket_ladders", f"SELECT instance_id, array_to_string(d, ',') AS dividers, correct FROM ({_HELD})")
def bucket_ladders(spark, sf_dir):
    held = sampling.bucket_ladders(frame(spark, sf_dir, "fx_times"))
    return held.select("instance_id", F.array_join("dividers", ",").alias("dividers"), "correct")


@query("draw_buckets", f"SELECT instance_id, array_to_string(d, ',') AS dividers, correct FROM ({_BUCKETS})")
def draw_buckets(spark, sf_dir):
    drawn, _ = sampling.draw_buckets(frame(spark, sf_dir, "fx_times"), "instance_id")
    return drawn.select("instance_id", F.array_join("dividers", ",").alias("dividers"), "correct")


@query("times_without_ladder", f"SELECT instance_id FROM fx_times WHERE instance_id NOT IN (SELECT instance_id FROM ({_HELD}))")
def times_without_ladder(spark, sf_dir):
    return sampling.draw_buckets(frame(spark, sf_dir, "fx_times"), "instance_id")[1].select("instance_id")


_TIME_ROWS = f"""
SELECT b.*, {_LABEL_LIST}[correct + 1] AS bucket, {_LABEL_LIST} AS labels
FROM ({_BUCKETS}) b JOIN fx_states s ON s.instance_id = b.instance_id WHERE s.group_id IS NOT NULL
"""


def _time_rows(spark, sf_dir):
    source = frame(spark, sf_dir, "fx_states").withColumn("command_workload", F.col("command"))
    return datasets.build_time_prediction(source, frame(spark, sf_dir, "fx_times"))[0]


@query(
    "time_prediction",
    f"""
    SELECT instance_id, round(time_s, 6) AS workload_time_s, array_to_string(d, ',') AS buckets, bucket,
           'Choose the bucket that the wall-clock time of the provided command falls into: ' || array_to_string(labels, ', ') || '.' AS "Q-bucket",
           time_s <= 5 AS fits_5, time_s <= 60 AS fits_60, time_s <= 300 AS fits_300
    FROM ({_TIME_ROWS})
    """,
)
def time_prediction(spark, sf_dir):
    time = F.col("workload_time_s")
    return _time_rows(spark, sf_dir).select(
        "instance_id",
        F.round(time, 6).alias("workload_time_s"),
        F.array_join("buckets", ",").alias("buckets"),
        "bucket",
        "`Q-bucket`",
        *[prompts.fits_budget(time, budget).alias(f"fits_{budget}") for budget in prompts.BUDGETS_S],
    )


@query(
    "time_summary",
    f"""
    SELECT CAST(correct AS BIGINT) AS position, count(*) AS rows, round(min(time_s), 6) AS shortest, round(max(time_s), 6) AS longest
    FROM ({_TIME_ROWS}) GROUP BY correct
    """,
)
def time_summary(spark, sf_dir):
    done = datasets.time_summary(_time_rows(spark, sf_dir))
    return done.withColumn("shortest", F.round("shortest", 6)).withColumn("longest", F.round("longest", 6))


# Profiled functions of a state: the parts of its lines.
VIEWS["fx_profile"] = """
SELECT 's' || CAST(grp AS VARCHAR(20)) || '__' || lpad(CAST(grp AS VARCHAR(20)), 8, '0') || '__' || variant AS instance_id,
       'pkg.f' || CAST(l_partkey AS VARCHAR(20)) AS key,
       CASE WHEN min(l_quantity) > 45 THEN '/usr/lib/x.py' WHEN min(l_quantity) > 40 THEN '<string>'
            WHEN min(l_quantity) > 35 THEN 'venv/site-packages/x.py' ELSE 'pkg/m' || CAST(min(l_partkey) % 9 AS VARCHAR(8)) || '.py' END AS filename,
       CAST(min(l_quantity) AS INTEGER) AS firstlineno, 'f' || CAST(l_partkey AS VARCHAR(20)) AS qualname,
       CASE WHEN max(severity) = 1 THEN 0.0 ELSE CAST(floor(sum(l_quantity) / 3) AS DOUBLE) / 16 END AS exclusive_time_s,
       count(*) AS call_count
FROM fx_lines_of_states GROUP BY grp, variant, l_partkey
"""
VIEWS["fx_workloads"] = """
SELECT instance_id, CASE WHEN variant = 'pred4' THEN 'failed' WHEN variant = 'pred5' AND group_id IS NULL THEN NULL ELSE 'passed' END AS outcome
FROM fx_states
"""
_OWN = "SELECT * FROM fx_profile WHERE filename NOT LIKE '/%' AND filename NOT LIKE '<%' AND filename NOT LIKE '%site-packages%'"
_RANKED = f"""
SELECT instance_id, key, exclusive_time_s, row_number() OVER (PARTITION BY instance_id ORDER BY exclusive_time_s DESC, key) AS rank
FROM ({_OWN}) WHERE exclusive_time_s > 0
"""


@query("rank_hotspots", f"SELECT instance_id, key, rank FROM ({_RANKED}) WHERE rank <= 20")
def rank_hotspots(spark, sf_dir):
    own = frame(spark, sf_dir, "fx_profile").where(filters.is_repo_source("filename"))
    return hotspots.rank_hotspots(own).select("instance_id", "key", "rank")


@query(
    "usable_profiles",
    f"""
    SELECT instance_id, reason FROM (
      SELECT w.instance_id, CASE WHEN w.outcome IS DISTINCT FROM 'passed' THEN 'workload outcome ' || COALESCE(w.outcome, 'None')
             WHEN count(CASE WHEN o.exclusive_time_s > 0 THEN 1 END) = 0
             THEN 'no repo function spent measurable time (' || CAST(count(o.key) AS VARCHAR) || ' profiled)' END AS reason
      FROM fx_workloads w LEFT JOIN ({_OWN}) o ON o.instance_id = w.instance_id GROUP BY w.instance_id, w.outcome)
    WHERE reason IS NOT NULL
    """,
)
def usable_profiles(spark, sf_dir):
    return filters.usable_profiles(frame(spark, sf_dir, "fx_profile"), frame(spark, sf_dir, "fx_workloads"))[1]


_HOT_ROWS = f"""
SELECT s.instance_id, s.container, h.hotspots, p.functions, h.n_ranked, p.n_pooled
FROM fx_states s JOIN fx_workloads w ON w.instance_id = s.instance_id AND w.outcome = 'passed'
JOIN (SELECT instance_id, string_agg(key, ',' ORDER BY rank) AS hotspots, count(*) AS n_ranked FROM ({_RANKED}) WHERE rank <= 20 GROUP BY 1) h
  ON h.instance_id = s.instance_id
JOIN (SELECT instance_id, string_agg(key, ',' ORDER BY key) AS functions, count(*) AS n_pooled FROM ({_OWN}) GROUP BY 1) p
  ON p.instance_id = s.instance_id
WHERE s.group_id IS NOT NULL
"""


def _hot_rows(spark, sf_dir):
    source = frame(spark, sf_dir, "fx_states").withColumn("command_workload", F.col("command"))
    return datasets.build_time_hotspot(
        source, frame(spark, sf_dir, "fx_workloads"), frame(spark, sf_dir, "fx_profile")
    )


@query("time_hotspot", f"SELECT instance_id, container, hotspots, functions FROM ({_HOT_ROWS})")
def time_hotspot(spark, sf_dir):
    return _hot_rows(spark, sf_dir).select(
        "instance_id",
        "container",
        F.array_join("hotspots.key", ",").alias("hotspots"),
        F.array_join("functions.key", ",").alias("functions"),
    )


@query(
    "hotspot_summary",
    f"""
    SELECT count(*) AS rows, min(n_pooled) AS pool_min, max(n_pooled) AS pool_max, min(n_ranked) AS ranked_min,
           max(n_ranked) AS ranked_max, count(CASE WHEN n_ranked >= 1 THEN 1 END) AS top1,
           count(CASE WHEN n_ranked >= 5 THEN 1 END) AS top5, count(CASE WHEN n_ranked >= 20 THEN 1 END) AS top20
    FROM ({_HOT_ROWS})
    """,
)
def hotspot_summary(spark, sf_dir):
    return datasets.hotspot_summary(_hot_rows(spark, sf_dir))


@query(
    "cap_per_key",
    """
    SELECT o_orderpriority, o_orderkey FROM (
      SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS rn FROM orders) WHERE rn <= 25
    """,
)
def cap_per_key(spark, sf_dir):
    orders = frame(spark, sf_dir, "orders")
    return sampling.cap_per_key(orders, "o_orderpriority", 25, [F.col("o_orderkey")]).select("o_orderpriority", "o_orderkey")


@query(
    "sample_instances",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey IN (
      SELECT l_orderkey FROM (
        SELECT l_orderkey, row_number() OVER (ORDER BY {uniform(0, 'CAST(l_orderkey AS VARCHAR)')}, l_orderkey) AS rn, count(*) OVER () AS n
        FROM (SELECT DISTINCT l_orderkey FROM lineitem)) WHERE rn <= greatest(1, round_even(n * 0.3, 0)))
    """,
)
def sample_instances(spark, sf_dir):
    return sampling.sample_instances(frame(spark, sf_dir, "lineitem"), 0.3, key="l_orderkey").select(
        "l_orderkey", "l_linenumber", "l_partkey"
    )


@query("shuffle_files", "SELECT test, file, md5(test || '|' || file) AS shuffle_key FROM (SELECT DISTINCT test, file FROM fx_functions)")
def shuffle_files(spark, sf_dir):
    files = frame(spark, sf_dir, "fx_functions").select("test", "file").distinct()
    return sampling.shuffle_files(files, ["test"])


# Mutations: order lines are candidate sites, suppliers are files.
VIEWS["fx_mutations"] = """
SELECT l_orderkey * 1000000 + l_partkey * 10 + l_linenumber AS pos, l_orderkey * 1000000 + l_partkey * 10 + l_linenumber AS number,
       'src/m' || CAST(l_suppkey AS VARCHAR(20)) || '.py' AS file,
       CASE l_returnflag WHEN 'A' THEN 'core/AddNot' WHEN 'R' THEN 'core/ReplaceTrue' ELSE 'NumberReplacer' END AS operator
FROM (SELECT DISTINCT l_orderkey, l_partkey, l_linenumber, min(l_suppkey) AS l_suppkey, min(l_returnflag) AS l_returnflag
      FROM lineitem GROUP BY l_orderkey, l_partkey, l_linenumber)
"""


@query(
    "sample_mutations",
    f"""
    SELECT pos, operator, row_number() OVER (ORDER BY u, pos) AS index,
           lpad(CAST(row_number() OVER (ORDER BY u, pos) AS VARCHAR), 6, '0') || '.patch' AS patch
    FROM (SELECT *, {uniform(3, 'CAST(pos AS VARCHAR)')} AS u FROM fx_mutations
          WHERE operator IN ('core/AddNot', 'NumberReplacer') ORDER BY u, pos LIMIT 200)
    """,
)
def sample_mutations(spark, sf_dir):
    picked = sampling.sample_mutations(frame(spark, sf_dir, "fx_mutations"), ["AddNot", "NumberReplacer"], 3, 200)
    return picked.select("pos", "operator", "index", "patch")


@query(
    "sample_mutation_per_file",
    f"""
    SELECT file, number FROM (
      SELECT file, number, row_number() OVER (PARTITION BY file ORDER BY {uniform(0, 'file', 'CAST(number AS VARCHAR)')}, number) AS rn
      FROM fx_mutations WHERE file IN (
        SELECT file FROM (
          SELECT file, row_number() OVER (ORDER BY {uniform(0, 'file')}, file) AS rn, count(*) OVER () AS n
          FROM (SELECT DISTINCT file FROM fx_mutations)) WHERE rn <= greatest(1, ceil(n * 0.25)))) WHERE rn = 1
    """,
)
def sample_mutation_per_file(spark, sf_dir):
    return sampling.sample_mutation_per_file(frame(spark, sf_dir, "fx_mutations"), 0.25).select("file", "number")
