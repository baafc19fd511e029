"""Queries on states, outcomes, pairs, sets and duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from runlens.functions import ids
from runlens.operators import dedup, filters, outcomes, pairing, sets
from runlens.plans import datasets
from runlens.plans.catalog.inputs import joined_list, narrow_states, state_scalars, states
from runlens.plans.catalog.registry import frame, query
from runlens.schemas import OUTCOME_FIELDS


def _folded(status: str) -> str:
    return f"string_agg(CASE WHEN status = '{status}' THEN test END, ',' ORDER BY test)"


@query(
    "fold_outcomes",
    f"""
    SELECT s.instance_id,
           COALESCE({_folded('PASSED')}, '') AS passed_tests, COALESCE({_folded('FAILED')}, '') AS failed_tests,
           COALESCE({_folded('SKIPPED')}, '') AS skipped_tests, COALESCE({_folded('ERROR')}, '') AS errored_tests,
           COALESCE((SELECT string_agg(module, ',' ORDER BY module) FROM fx_discovery d
                     WHERE d.instance_id = s.instance_id), '') AS discovery_errors
    FROM fx_states s LEFT JOIN fx_outcomes o ON o.instance_id = s.instance_id GROUP BY s.instance_id
    """,
)
def fold_outcomes(spark, sf_dir):
    folded = outcomes.fold_outcomes(frame(spark, sf_dir, "fx_outcomes"), frame(spark, sf_dir, "fx_discovery"))
    return folded.select("instance_id", *[joined_list(F.col(c), c) for c in OUTCOME_FIELDS])


def _doubled(spark, sf_dir):
    """States whose fixed variant lists its errored tests as passed, too."""
    both = F.when(F.col("variant") == "fixed", F.concat("passed_tests", "errored_tests"))
    return states(spark, sf_dir).withColumn("passed_tests", F.coalesce(both, F.col("passed_tests")))


@query("unfold_outcomes", "SELECT instance_id, test, status FROM fx_measured")
def unfold_outcomes(spark, sf_dir):
    return outcomes.unfold_outcomes(_doubled(spark, sf_dir))


@query(
    "outcome_conflicts",
    "SELECT instance_id, test, 'ERROR,PASSED' AS statuses FROM fx_measured WHERE variant = 'fixed' AND status = 'ERROR'",
)
def outcome_conflicts(spark, sf_dir):
    found = outcomes.outcome_conflicts(_doubled(spark, sf_dir))
    return found.select("instance_id", "test", joined_list(F.col("statuses"), "statuses"))


_MERGED = """
SELECT instance_id, report, test,
       CASE max(severity) WHEN 0 THEN 'PASSED' WHEN 1 THEN 'SKIPPED' WHEN 2 THEN 'FAILED' ELSE 'ERROR' END AS status
FROM fx_cases GROUP BY instance_id, report, test
"""


def _merged_cases(spark, sf_dir):
    cases = frame(spark, sf_dir, "fx_cases").withColumn("report", F.concat_ws("/", "instance_id", "report"))
    merged = outcomes.merge_report_cases(cases)
    return merged.select(
        F.substring_index("report", "/", 1).alias("instance_id"),
        F.substring_index("report", "/", -1).alias("report"),
        "test",
        "status",
    )


@query("merge_report_cases", _MERGED)
def merge_report_cases(spark, sf_dir):
    return _merged_cases(spark, sf_dir)


@query(
    "report_conflicts",
    f"""
    SELECT instance_id, test, string_agg(DISTINCT status, ',' ORDER BY status) AS statuses
    FROM ({_MERGED}) GROUP BY instance_id, test HAVING count(DISTINCT status) > 1
    """,
)
def report_conflicts(spark, sf_dir):
    found = outcomes.report_conflicts(_merged_cases(spark, sf_dir), ["instance_id"])
    return found.select("instance_id", "test", joined_list(F.col("statuses"), "statuses"))


@query("discovery_errors", "SELECT instance_id, module FROM fx_discovery")
def discovery_errors(spark, sf_dir):
    # Modules reported once per line: duplicates on purpose.
    raw = frame(
        spark,
        sf_dir,
        """SELECT 's' || CAST(grp AS STRING) || '__' || lpad(CAST(grp AS STRING), 8, '0') || '__' || variant AS instance_id,
                  'tests.m' || CAST(l_partkey % 5 AS STRING) AS module
           FROM fx_lines_of_states WHERE l_quantity >= 50 AND s_acctbal <= 5000""",
    )
    return outcomes.discovery_errors(raw)


@query("fill_status", "SELECT instance_id, measured AS filled FROM fx_states")
def fill_status(spark, sf_dir):
    return outcomes.with_fill_status(states(spark, sf_dir)).select("instance_id", "filled")


@query("needs_collect", "SELECT instance_id FROM fx_states WHERE NOT measured AND collection_error IS NULL")
def needs_collect(spark, sf_dir):
    return outcomes.needs_collect(states(spark, sf_dir)).select("instance_id")


@query("healthy_states", "SELECT instance_id, healthy FROM fx_health")
def healthy_states(spark, sf_dir):
    scalars = state_scalars(spark, sf_dir).where("measured").select("instance_id")
    return outcomes.healthy_states(
        frame(spark, sf_dir, "fx_outcomes"), frame(spark, sf_dir, "fx_discovery"), scalars
    )


@query(
    "collect_counts",
    """
    SELECT s.instance_id,
           CASE WHEN s.measured THEN count(CASE WHEN status = 'PASSED' THEN 1 END) END AS n_passed_tests,
           CASE WHEN s.measured THEN count(CASE WHEN status = 'FAILED' THEN 1 END) END AS n_failed_tests,
           CASE WHEN s.measured THEN count(CASE WHEN status = 'SKIPPED' THEN 1 END) END AS n_skipped_tests,
           CASE WHEN s.measured THEN count(CASE WHEN status = 'ERROR' THEN 1 END) END AS n_errored_tests,
           CASE WHEN s.measured THEN (SELECT count(*) FROM fx_discovery d WHERE d.instance_id = s.instance_id) END AS n_discovery_errors
    FROM fx_states s LEFT JOIN fx_outcomes o ON o.instance_id = s.instance_id GROUP BY s.instance_id, s.measured
    """,
    doubles=("n_passed_tests", "n_failed_tests", "n_skipped_tests", "n_errored_tests", "n_discovery_errors",),
)
def collect_counts(spark, sf_dir):
    return outcomes.collect_counts(states(spark, sf_dir))


_PAIRS = """
SELECT a.instance_id || '__::__' || b.variant AS pair_id, a.instance_id AS id_a, b.instance_id AS id_b, h.healthy,
       a.repo, a.base_commit
FROM fx_states a JOIN fx_states b ON a.grp = b.grp AND a.variant = 'base' AND b.variant <> 'base'
JOIN fx_health h ON h.instance_id = a.instance_id
WHERE a.measured AND b.measured AND a.container = b.container AND a.base_commit IS NOT NULL
"""

_MET = """
SELECT p.pair_id, COALESCE(x.test, y.test) AS test, x.status AS status_a, y.status AS status_b
FROM ({pairs}) p
JOIN fx_outcomes x ON x.instance_id = p.id_a
LEFT JOIN fx_outcomes y ON y.instance_id = p.id_b AND y.test = x.test
UNION ALL
SELECT p.pair_id, y.test, NULL, y.status FROM ({pairs}) p JOIN fx_outcomes y ON y.instance_id = p.id_b
WHERE NOT EXISTS (SELECT 1 FROM fx_outcomes x WHERE x.instance_id = p.id_a AND x.test = y.test)
"""


def _pair_oracle(pairs: str) -> str:
    return f"""
    SELECT p.pair_id, p.healthy AS is_base_healthy,
           CASE WHEN p.healthy THEN
             count(CASE WHEN (status_a = 'PASSED') IS DISTINCT FROM (status_b = 'PASSED')
                         AND COALESCE(status_a = 'PASSED', false) <> COALESCE(status_b = 'PASSED', false) THEN 1 END) = 0
             AND count(CASE WHEN COALESCE(status_a = 'SKIPPED', false) <> COALESCE(status_b = 'SKIPPED', false) THEN 1 END) = 0
             AND (SELECT healthy FROM fx_health h WHERE h.instance_id = p.id_a)
             AND (SELECT healthy FROM fx_health h WHERE h.instance_id = p.id_b) END AS is_clone,
           count(CASE WHEN status_a IS DISTINCT FROM status_b THEN 1 END) AS num_flipped_tests,
           round(count(CASE WHEN status_a IS DISTINCT FROM status_b THEN 1 END) / count(*)::DOUBLE, 6) AS flipped_ratio
    FROM ({pairs}) p JOIN ({_MET.format(pairs=pairs)}) m ON m.pair_id = p.pair_id
    GROUP BY p.pair_id, p.healthy, p.id_a, p.id_b
    """


def _figures(pairs, spark, sf_dir):
    figures = pairing.pair_figures(pairs, frame(spark, sf_dir, "fx_outcomes"), frame(spark, sf_dir, "fx_discovery"))
    return figures.select(
        "pair_id", "is_base_healthy", "is_clone", "num_flipped_tests", F.round("flipped_ratio", 6).alias("flipped_ratio")
    )


@query("pair_states", _pair_oracle(_PAIRS))
def pair_states(spark, sf_dir):
    pairs = pairing.pair_states(state_scalars(spark, sf_dir).where("measured")).pairs
    return _figures(pairs, spark, sf_dir)


# Requested pairs: each patched state with the next one of its base.
_NEXT = """
SELECT instance_id, lead(instance_id) OVER (PARTITION BY grp ORDER BY instance_id) AS next_id, measured, variant
FROM fx_states WHERE variant <> 'base' AND measured
"""

_REQUESTED = f"""
SELECT a.instance_id || '__::__' || b.variant AS pair_id, a.instance_id AS id_a, b.instance_id AS id_b, h.healthy
FROM ({_NEXT}) r JOIN fx_states a ON a.instance_id = r.instance_id JOIN fx_states b ON b.instance_id = r.next_id
JOIN fx_states c ON c.grp = a.grp AND c.variant = 'base' AND c.measured JOIN fx_health h ON h.instance_id = c.instance_id
WHERE a.container = b.container AND a.base_commit IS NOT NULL
"""


@query("pair_requested", _pair_oracle(_REQUESTED))
def pair_requested(spark, sf_dir):
    # Sides are handed over swapped; the operator restores the order.
    asked = frame(
        spark, sf_dir, f"SELECT next_id AS instance_id_A, instance_id AS instance_id_B FROM ({_NEXT}) WHERE next_id IS NOT NULL"
    )
    pairs = pairing.pair_states(state_scalars(spark, sf_dir).where("measured"), asked).pairs
    return _figures(pairs, spark, sf_dir)


@query(
    "pair_errors",
    """
    SELECT a.instance_id AS id_a, b.instance_id AS id_b,
           CASE WHEN a.container <> b.container THEN 'states disagree on container' ELSE 'no base commit' END AS reason
    FROM fx_states a JOIN fx_states b ON a.grp = b.grp AND a.variant = 'base' AND b.variant <> 'base'
    WHERE a.measured AND b.measured AND (a.container <> b.container OR a.base_commit IS NULL)
    """,
)
def pair_errors(spark, sf_dir):
    errors = pairing.pair_states(state_scalars(spark, sf_dir).where("measured")).errors
    return errors.select(F.col("instance_id_A").alias("id_a"), F.col("instance_id_B").alias("id_b"), "reason")


@query(
    "pairs_known_skipped",
    f"SELECT pair_id, 'known pair' AS reason FROM ({_PAIRS}) WHERE id_b LIKE '%fixed'",
)
def pairs_known_skipped(spark, sf_dir):
    scalars = state_scalars(spark, sf_dir).where("measured")
    known = (
        scalars.where("variant = 'base'")
        .select(F.concat("instance_id", F.lit("__::__fixed")).alias("pair_id"))
    )
    return pairing.pair_states(scalars, existing=known).skipped


@query(
    "groups_without_base",
    "SELECT repo, count(*) AS states FROM fx_states GROUP BY repo HAVING count(CASE WHEN variant = 'base' THEN 1 END) = 0",
)
def groups_without_base(spark, sf_dir):
    return pairing.groups_without_base(state_scalars(spark, sf_dir)).select("repo", "states")


@query("flipped_tests", f"SELECT pair_id, test, status_a, status_b, status_a IS DISTINCT FROM status_b AS flipped FROM ({_MET.format(pairs=_PAIRS)})")
def flipped_tests(spark, sf_dir):
    pairs = pairing.pair_states(state_scalars(spark, sf_dir).where("measured")).pairs
    return pairing.flipped_tests(pairs, frame(spark, sf_dir, "fx_outcomes"))


_SIGNATURES = """
SELECT s.grp, s.instance_id,
       COALESCE(string_agg(CASE WHEN o.status IN ('PASSED', 'SKIPPED') THEN o.status || o.test END, ',' ORDER BY o.status, o.test), '') AS signature,
       bool_and(h.healthy) AS clean
FROM fx_states s JOIN fx_health h ON h.instance_id = s.instance_id LEFT JOIN fx_outcomes o ON o.instance_id = s.instance_id
WHERE s.measured GROUP BY s.grp, s.instance_id
"""


@query(
    "clone_classes",
    f"""
    WITH sig AS ({_SIGNATURES}), base AS (
      SELECT s.grp, h.healthy FROM fx_states s JOIN fx_health h ON h.instance_id = s.instance_id WHERE s.variant = 'base')
    SELECT sig.instance_id,
           CASE WHEN sig.clean AND COALESCE(base.healthy, false) THEN
             count(CASE WHEN sig.clean THEN 1 END) OVER (PARTITION BY sig.grp, sig.signature, sig.clean) END AS clones
    FROM sig LEFT JOIN base ON base.grp = sig.grp
    """,
    doubles=("clones",),
)
def clone_classes(spark, sf_dir):
    classes = pairing.clone_classes(
        state_scalars(spark, sf_dir).where("measured"),
        frame(spark, sf_dir, "fx_outcomes"),
        frame(spark, sf_dir, "fx_discovery"),
    )
    sizes = classes.where(F.col("clone_class").isNotNull()).groupBy("repo", "base_ref", "clone_class").agg(
        F.count(F.lit(1)).alias("clones")
    )
    return classes.join(sizes, ["repo", "base_ref", "clone_class"], "left").select("instance_id", "clones")


@query(
    "valid_ids",
    """
    SELECT o_orderkey,
           o_orderpriority || '__' || CAST(o_custkey AS VARCHAR(20)) AS text,
           regexp_full_match(o_orderpriority, '[A-Za-z0-9._-]+') AS id_ok,
           regexp_full_match(o_orderpriority, '[A-Za-z0-9._-]+') AND o_orderstatus <> 'P' AS pair_id_ok,
           o_orderstatus <> 'F' AND o_orderpriority <> '1-URGENT' AS scope_ok
    FROM orders
    """,
)
def valid_ids(spark, sf_dir):
    orders = frame(spark, sf_dir, "orders")
    text = F.concat_ws("__", "o_orderpriority", F.col("o_custkey").cast("string"))
    pair = F.concat(text, F.when(F.col("o_orderstatus") == "P", "__::__a__::__b").otherwise("__::__a"))
    scope = F.array(
        F.lit("tests/"),
        F.concat(F.when(F.col("o_orderstatus") == "F", "/").otherwise("src/"), F.col("o_orderstatus")),
        F.when(F.col("o_orderpriority") == "1-URGENT", "a/../b").otherwise("a/..b"),
    )
    return orders.select(
        "o_orderkey",
        text.alias("text"),
        ids.valid_instance_id(text).alias("id_ok"),
        ids.valid_pair_id(pair).alias("pair_id_ok"),
        ids.valid_test_scope(scope).alias("scope_ok"),
    )


@query(
    "base_tests",
    """
    SELECT instance_id, variant = 'base' AS by_patch, variant = 'base' AS by_id,
           repo || '@' || COALESCE(base_commit, 'none_' || repo) AS base_key,
           split_part(repo, '/', 2) || '__' || COALESCE(substr(base_commit, 1, 8), 'none_T') || '__' || variant AS rebuilt_id
    FROM fx_states
    """,
)
def base_tests(spark, sf_dir):
    df = state_scalars(spark, sf_dir)
    return df.select(
        "instance_id",
        ids.is_base_by_patch("patch").alias("by_patch"),
        ids.is_base_by_id("instance_id").alias("by_id"),
        F.concat_ws("@", "repo", ids.base_ref()).alias("base_key"),
        ids.state_id(ids.base_stem("repo", "base_commit", F.lit("T")), "variant").alias("rebuilt_id"),
    )


@query(
    "valid_pairs",
    """
    SELECT a.instance_id AS id_a, b.instance_id AS id_b, b.variant <> 'base' AND a.instance_id <> b.instance_id AS ok
    FROM fx_states a JOIN fx_states b ON a.grp = b.grp AND a.variant_no = 1
    """,
)
def valid_pairs(spark, sf_dir):
    df = frame(spark, sf_dir, "fx_states")
    a = df.where("variant_no = 1").select("grp", F.col("instance_id").alias("instance_id_A"))
    b = df.select("grp", F.col("instance_id").alias("instance_id_B"), F.col("patch").alias("patch_B"))
    return a.join(b, "grp").select(
        F.col("instance_id_A").alias("id_a"), F.col("instance_id_B").alias("id_b"), ids.valid_pair().alias("ok")
    )


# Sets: states whose supplier number is in the first statement, changed rows in the second.
_BASE_SET = "SELECT instance_id, container, row_index FROM fx_states WHERE variant <> 'pred7'"
_CHANGED = "SELECT instance_id, 'new-' || container AS container, row_index FROM fx_states WHERE variant IN ('fixed', 'pred7')"


@query(
    "upsert",
    f"""
    SELECT COALESCE(c.instance_id, b.instance_id) AS instance_id, COALESCE(c.container, b.container) AS container,
           COALESCE(b.row_index, c.row_index) AS row_index, b.instance_id IS NULL AS inserted
    FROM ({_BASE_SET}) b FULL JOIN ({_CHANGED}) c ON b.instance_id = c.instance_id
    """,
)
def upsert(spark, sf_dir):
    return sets.upsert(frame(spark, sf_dir, _BASE_SET), frame(spark, sf_dir, _CHANGED), "instance_id", "row_index")


@query(
    "append_skip",
    f"SELECT * FROM ({_BASE_SET}) UNION ALL SELECT * FROM ({_CHANGED}) WHERE instance_id NOT IN (SELECT instance_id FROM ({_BASE_SET}))",
)
def append_skip(spark, sf_dir):
    return sets.append_skip(frame(spark, sf_dir, _BASE_SET), frame(spark, sf_dir, _CHANGED))


@query(
    "append_override",
    f"SELECT * FROM ({_CHANGED}) UNION ALL SELECT * FROM ({_BASE_SET}) WHERE instance_id NOT IN (SELECT instance_id FROM ({_CHANGED}))",
)
def append_override(spark, sf_dir):
    return sets.append_override(frame(spark, sf_dir, _BASE_SET), frame(spark, sf_dir, _CHANGED))


@query(
    "append_report",
    """
    SELECT instance_id, 'collision' AS issue FROM fx_states WHERE variant = 'fixed'
    UNION ALL SELECT instance_id, 'partial' FROM fx_states WHERE variant IN ('fixed', 'pred7') AND NOT measured
    """,
)
def append_report(spark, sf_dir):
    incoming = states(spark, sf_dir).where("variant IN ('fixed', 'pred7')")
    return sets.append_report(frame(spark, sf_dir, _BASE_SET), incoming)


@query("remove_rows", f"SELECT * FROM ({_BASE_SET}) WHERE instance_id NOT IN (SELECT instance_id FROM ({_CHANGED}))")
def remove_rows(spark, sf_dir):
    return sets.remove(frame(spark, sf_dir, _BASE_SET), frame(spark, sf_dir, _CHANGED).select("instance_id"))[0]


@query("remove_unknown_ids", "SELECT instance_id FROM fx_states WHERE variant = 'pred7'")
def remove_unknown_ids(spark, sf_dir):
    return sets.remove(frame(spark, sf_dir, _BASE_SET), frame(spark, sf_dir, _CHANGED).select("instance_id"))[1]


@query(
    "append_pairs",
    f"""
    SELECT pair_id, CASE WHEN id_b LIKE '%fixed' THEN 'existing' ELSE 'new' END AS origin FROM ({_PAIRS})
    """,
)
def append_pairs(spark, sf_dir):
    pairs = pairing.pair_states(state_scalars(spark, sf_dir).where("measured")).pairs
    existing = pairs.where(F.col("instance_id_B").endswith("fixed"))
    return sets.append_pairs(
        existing.select("pair_id", F.lit("existing").alias("origin")), pairs.select("pair_id", F.lit("new").alias("origin"))
    )


@query(
    "set_ops",
    """
    SELECT grp, count(CASE WHEN a IS DISTINCT FROM b THEN 1 END) = 0 AS equal,
           COALESCE(string_agg(test, ',' ORDER BY test), '') AS "union",
           COALESCE(string_agg(CASE WHEN a AND b THEN test END, ',' ORDER BY test), '') AS intersection,
           COALESCE(string_agg(CASE WHEN a AND NOT b THEN test END, ',' ORDER BY test), '') AS difference
    FROM (SELECT s.grp, o.test, bool_or(COALESCE(o.variant_no = 1, false)) AS a, bool_or(COALESCE(o.variant_no = 2, false)) AS b
          FROM (SELECT DISTINCT grp FROM fx_states WHERE measured) s
          LEFT JOIN fx_measured o ON o.grp = s.grp AND o.variant_no IN (1, 2) AND o.status = 'PASSED' GROUP BY s.grp, o.test)
    GROUP BY grp
    """,
)
def set_ops(spark, sf_dir):
    df = states(spark, sf_dir).where("measured")
    a = df.where("variant_no = 1").select("grp", F.col("passed_tests").alias("a"))
    b = df.where("variant_no = 2").select("grp", F.col("passed_tests").alias("b"))
    done = sets.set_ops(a.join(b, "grp"), "a", "b")
    return done.select(
        "grp", "equal", *[joined_list(F.col(c), c) for c in ("union", "intersection", "difference")]
    )


@query(
    "dedupe_first",
    """
    SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey FROM (
      SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey * 10 + l_linenumber, l_suppkey, l_extendedprice, l_quantity) AS rn
      FROM lineitem) WHERE rn = 1
    """,
)
def dedupe_first(spark, sf_dir):
    rows = frame(spark, sf_dir, "lineitem").withColumn(
        "place", F.struct(F.expr("l_orderkey * 10 + l_linenumber"), "l_suppkey", "l_extendedprice", "l_quantity")
    )
    return dedup.dedupe_first(rows, "l_partkey", "place")[0].select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey")


@query("dedupe_skipped", "SELECT l_partkey, count(*) - 1 AS skipped FROM lineitem GROUP BY l_partkey HAVING count(*) > 1")
def dedupe_skipped(spark, sf_dir):
    return dedup.dedupe_first(frame(spark, sf_dir, "lineitem"), "l_partkey", "l_orderkey")[1]


@query("duplicate_ids", "SELECT l_orderkey, count(*) AS copies FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def duplicate_ids(spark, sf_dir):
    return dedup.duplicate_ids(frame(spark, sf_dir, "lineitem"), "l_orderkey")


_LONGEST = """
SELECT test, pos, func FROM (
  SELECT *, row_number() OVER (PARTITION BY test ORDER BY exclusive_time_s DESC, pos) AS rn FROM fx_functions) WHERE rn = 1
"""


@query("keep_longest", _LONGEST)
def keep_longest(spark, sf_dir):
    records = frame(spark, sf_dir, "fx_functions")
    return dedup.keep_longest(records, ["test"], "exclusive_time_s").select("test", "pos", "func")


@query(
    "fold_first",
    """
    SELECT test, pos, file FROM (
      SELECT *, row_number() OVER (PARTITION BY test ORDER BY file, pos) AS rn FROM fx_functions) WHERE rn = 1
    """,
)
def fold_first(spark, sf_dir):
    return dedup.fold_first(frame(spark, sf_dir, "fx_functions"), ["test"]).select("test", "pos", "file")


@query(
    "fold_longest",
    """
    SELECT test, pos, side FROM (
      SELECT *, row_number() OVER (PARTITION BY test ORDER BY t DESC, side, pos) AS rn FROM (
        SELECT test, pos, exclusive_time_s AS t, 'main' AS side FROM fx_functions WHERE l_linestatus = 'F'
        UNION ALL SELECT test, pos, exclusive_time_s, 'side' FROM fx_functions WHERE l_linestatus = 'O')) WHERE rn = 1
    """,
)
def fold_longest(spark, sf_dir):
    records = frame(spark, sf_dir, "fx_functions")
    main = records.where("l_linestatus = 'F'").withColumn("side", F.lit("main"))
    side = records.where("l_linestatus = 'O'").withColumn("side", F.lit("side"))
    return dedup.fold_longest(main, side, ["test"], "exclusive_time_s").select("test", "pos", "side")


@query(
    "name_collisions",
    """
    SELECT substr(sha256(CAST(o_custkey AS VARCHAR(20))), 1, 3) AS name, min(CAST(o_custkey AS VARCHAR(20))) AS first_label,
           max(CAST(o_custkey AS VARCHAR(20))) AS last_label
    FROM orders GROUP BY 1 HAVING count(DISTINCT o_custkey) > 1
    """,
)
def name_collisions(spark, sf_dir):
    units = frame(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("label"))
    units = units.withColumn("name", ids.stable_hash("label", 3))
    return dedup.name_collisions(units, "name", "label")


@query(
    "state_names",
    """
    SELECT instance_id, substr(sha256(instance_id), 1, 12) AS digest,
           'run-' || replace(replace(instance_id, '__', '-'), '_', '-') || '-' || substr(sha256(instance_id), 1, 6) AS name,
           split_part(split_part(container, '/', 3), ':', 1) AS stem,
           'gs://bucket/' || container AS uri,
           'https://storage.googleapis.com/bucket/runs/r1/workers/' || instance_id || '/result.json' AS url
    FROM fx_states
    """,
)
def state_names(spark, sf_dir):
    df = frame(spark, sf_dir, "fx_states")
    return df.select(
        "instance_id",
        ids.stable_hash("instance_id").alias("digest"),
        ids.bounded_name("run", "instance_id").alias("name"),
        ids.stem_from_image(F.concat("container", F.lit(":v1@sha256:00"))).alias("stem"),
        ids.normalize_uri(F.concat(F.lit("https://storage.googleapis.com/bucket/"), F.col("container"))).alias("uri"),
        ids.result_url(F.lit("gs://bucket/runs/"), F.lit("r1"), "instance_id").alias("url"),
    )


@query(
    "trailing_number",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' AND o_custkey > 0 THEN o_custkey END AS number FROM orders
    """,
    doubles=("number",),
)
def trailing_number(spark, sf_dir):
    orders = frame(spark, sf_dir, "orders")
    tail = F.when(F.col("o_orderstatus") == "P", F.concat(F.col("o_custkey"), F.lit("x"))).otherwise(F.col("o_custkey").cast("string"))
    return orders.select("o_orderkey", ids.trailing_number(F.concat_ws("-", F.lit("own__re-po"), tail)).alias("number"))


_CHAIN_RULES = {
    "drop_without_group": ("NOT no_group", lambda k: [filters.without_group()]),
    "drop_without_outcomes": ("NOT no_outcomes", lambda k: [filters.without_outcomes()]),
    "drop_container_conflicts": (
        "(repo, COALESCE(base_commit, '')) NOT IN (SELECT (repo, COALESCE(base_commit, '')) FROM fx_states GROUP BY ALL HAVING count(DISTINCT container) > 1)",
        lambda k: [filters.container_conflicts()],
    ),
    "drop_unknown_groups": (
        "group_id IN (SELECT group_id FROM fx_known_groups)",
        lambda k: [filters.unknown_groups(k)],
    ),
    "drop_groups_without_variant": (
        "group_id IN (SELECT group_id FROM fx_states WHERE variant = 'base')",
        lambda k: [filters.groups_without_variant("base")],
    ),
}


def _chain_query(name, condition, rules):
    @query(name, f"SELECT instance_id FROM fx_chain WHERE {condition}")
    def run(spark, sf_dir):
        known = frame(spark, sf_dir, "fx_known_groups")
        df = filters.with_group(states(spark, sf_dir).drop("group_id", "variant"))
        if name == "drop_groups_without_variant":
            df = df.where(F.col("group_id").isNotNull())
        return filters.filter_chain(df, rules(known))[0].select("instance_id")


for _name, (_condition, _rules) in _CHAIN_RULES.items():
    _chain_query(_name, _condition, _rules)


@query(
    "filter_chain",
    """
    SELECT instance_id, COALESCE(reason, 'kept') AS reason,
           CASE reason WHEN 'container conflict' THEN container WHEN 'unknown group' THEN group_id
                WHEN 'group has no base state' THEN variant END AS detail
    FROM fx_chain4
    """,
)
def filter_chain(spark, sf_dir):
    told = filters.judged(narrow_states(spark, sf_dir), datasets.standard_rules(frame(spark, sf_dir, "fx_known_groups")))
    return told.select("instance_id", F.coalesce("reason", F.lit("kept")).alias("reason"), "detail")


@query(
    "filter_counts",
    "SELECT COALESCE(reason, 'kept') AS reason, count(*) AS rows FROM fx_chain4 GROUP BY 1",
)
def filter_counts(spark, sf_dir):
    return filter_chain(spark, sf_dir).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "drop_without_profile",
    "SELECT instance_id FROM fx_states WHERE grp IN (SELECT l_suppkey FROM lineitem WHERE l_quantity >= 49 AND l_tax >= 0.07)",
)
def drop_without_profile(spark, sf_dir):
    profiles = frame(
        spark,
        sf_dir,
        """SELECT s.instance_id FROM fx_states s
           WHERE s.grp IN (SELECT l_suppkey FROM lineitem WHERE l_quantity >= 49 AND l_tax >= 0.07)""",
    )
    return filters.filter_chain(frame(spark, sf_dir, "fx_states"), [filters.without_profile(profiles)])[0].select(
        "instance_id"
    )


@query(
    "image_checks",
    """
    SELECT instance_id, s_kind <> 'local' AND s_kind <> 'bare' AS valid, s_kind = 'digest' AS pinned,
           CASE WHEN s_kind = 'digest' THEN 'sha256:' || base END AS digest
    FROM (SELECT instance_id, COALESCE(base_commit, '0') AS base,
                 CASE variant WHEN 'base' THEN 'digest' WHEN 'fixed' THEN 'local' WHEN 'pred3' THEN 'bare' ELSE 'tag' END AS s_kind
          FROM fx_states)
    """,
)
def image_checks(spark, sf_dir):
    df = frame(spark, sf_dir, "fx_states")
    base = F.coalesce("base_commit", F.lit("0"))
    image = (
        F.when(F.col("variant") == "base", F.concat("container", F.lit("@sha256:"), base))
        .when(F.col("variant") == "fixed", F.lit("localhost:5000/app"))
        .when(F.col("variant") == "pred3", F.lit("app:latest"))
        .otherwise(F.col("container"))
    )
    return df.select(
        "instance_id",
        filters.valid_image(image).alias("valid"),
        filters.pinned_image(image, "reg/default:1").alias("pinned"),
        filters.image_digest(image).alias("digest"),
    )


@query(
    "name_filter",
    "SELECT c_custkey, c_name FROM customer WHERE (c_name LIKE '%11%' OR c_name LIKE '%42%') AND c_name NOT LIKE '%7%'",
)
def name_filter(spark, sf_dir):
    return filters.name_filter(frame(spark, sf_dir, "customer"), "c_name", ["11", "42"], ["7"]).select("c_custkey", "c_name")


@query(
    "operator_matches",
    "SELECT l_orderkey, l_linenumber, l_returnflag IN ('A', 'R') AS matched FROM lineitem",
)
def operator_matches(spark, sf_dir):
    name = F.when(F.col("l_linestatus") == "F", F.concat(F.lit("core/"), F.col("l_returnflag"))).otherwise(F.col("l_returnflag"))
    return frame(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", filters.operator_matches(name, ["A", "R"]).alias("matched")
    )


@query("aborted_session", "SELECT l_orderkey, l_linenumber, l_linenumber NOT IN (1, 2) AS aborted FROM lineitem")
def aborted_session(spark, sf_dir):
    return frame(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", filters.aborted_session(F.col("l_linenumber") - 1).alias("aborted")
    )


@query(
    "runnable",
    "SELECT instance_id, patch IS NOT NULL AS ready FROM fx_states",
)
def runnable(spark, sf_dir):
    rows, skipped = filters.runnable(frame(spark, sf_dir, "fx_states"), "patch")
    return rows.select("instance_id", F.lit(True).alias("ready")).unionByName(
        skipped.select("instance_id", F.lit(False).alias("ready"))
    )


@query(
    "project_files",
    """
    SELECT DISTINCT file, file LIKE 'src/%' AS own, file LIKE 'src/m1%' AS inside FROM (
      SELECT CASE l_returnflag WHEN 'N' THEN '/opt/' || file WHEN 'A' THEN file ELSE '<string>' END AS file FROM fx_functions)
    """,
)
def project_files(spark, sf_dir):
    df = frame(
        spark,
        sf_dir,
        "SELECT DISTINCT CASE l_returnflag WHEN 'N' THEN '/opt/' || file WHEN 'A' THEN file ELSE '<string>' END AS file FROM fx_functions",
    )
    return df.select(
        "file",
        filters.is_repo_source("file").alias("own"),
        filters.in_project("file", ["src"], ["m1", "m1x/"]).alias("inside"),
    )


@query(
    "validate_states",
    """
    SELECT instance_id, variant_no = 3 AS bad,
           CASE WHEN variant_no = 3 THEN 'container,test_scope' ELSE '' END AS broken_rules FROM fx_states
    """,
)
def validate_states(spark, sf_dir):
    raw = states(spark, sf_dir).withColumn(
        "test_scope", F.when(F.col("variant_no") == 3, F.array(F.lit("/abs"))).otherwise(F.array(F.lit("tests/")))
    )
    raw = raw.withColumn("container", F.when(F.col("variant_no") == 3, "").otherwise(F.col("container")))
    ok, bad = filters.validate_states(raw)
    return ok.select("instance_id", F.lit(False).alias("bad"), F.lit("").alias("broken_rules")).unionByName(
        bad.select("instance_id", F.lit(True).alias("bad"), F.array_join("broken_rules", ",").alias("broken_rules"))
    )
