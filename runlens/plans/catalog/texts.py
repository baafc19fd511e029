"""Queries on patches, commands, test names and other texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from runlens.functions import commands, patches, testnames, texts
from runlens.plans.catalog.registry import frame, query
from runlens.plans.catalog.views import VIEWS

# Each document is a patch of two files: a source file and a companion that is a test for some rows.
VIEWS["fx_patches"] = """
SELECT doc_id, lang || '/' || source || '/f' || CAST(doc_id % 9 AS VARCHAR(8)) || '.py' AS path,
       CASE WHEN lang = 'en' THEN 'tests/' || source || '.py' WHEN lang = 'de' THEN 'pkg/test_' || source || '.py' ELSE 'root' || source || '.cfg' END AS other,
       lang IN ('en', 'de') AS other_is_test, lang, source, text,
       '@@ -0,0 +1 @@' || chr(10) || '+' || replace(text, chr(10), chr(10) || '+') || chr(10) AS body
FROM documents
"""


def _section(path: str, body: str = "body", old: str = "", new: str = "") -> str:
    return (
        f"'diff --git a/{old}' || {path} || ' b/{new}' || {path} || chr(10) || 'index 00..11' || chr(10) || "
        f"'--- a/{old}' || {path} || chr(10) || '+++ b/{new}' || {path} || chr(10) || {body}"
    )


VIEWS["fx_diffs"] = f"""
SELECT doc_id, path, other, other_is_test, lang, source, {_section('path')} AS first_section, {_section('other')} AS second_section,
       {_section('path')} || {_section('other')} AS patch FROM fx_patches
"""


@query(
    "patch_dirs",
    """
    SELECT doc_id, CASE WHEN lang < t THEN lang || ',' || t ELSE t || ',' || lang END AS dirs
    FROM (SELECT doc_id, lang, CASE WHEN contains(other, '/') THEN split_part(other, '/', 1) ELSE other END AS t FROM fx_diffs)
    """,
)
def patch_dirs(spark, sf_dir):
    df = frame(spark, sf_dir, "fx_diffs")
    return df.select("doc_id", F.array_join(patches.patch_dirs("patch", F.lit(None).cast("string")), ",").alias("dirs"))


@query(
    "patch_parent_dirs",
    """
    SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter([lang || '/' || source,
             CASE WHEN contains(other, '/') THEN split_part(other, '/', 1) END], lambda x: x IS NOT NULL))), ',') AS dirs FROM fx_diffs
    """,
)
def patch_parent_dirs(spark, sf_dir):
    df = frame(spark, sf_dir, "fx_diffs")
    return df.select("doc_id", F.array_join(patches.patch_parent_dirs("patch"), ",").alias("dirs"))


@query("scope_from_patch", "SELECT doc_id, array_to_string(list_sort([path, other]), ',') AS scope FROM fx_diffs")
def scope_from_patch(spark, sf_dir):
    df = frame(spark, sf_dir, "fx_diffs")
    return df.select("doc_id", F.array_join(patches.scope_from_patch("patch"), ",").alias("scope"))


@query("patch_touches_scope", "SELECT doc_id, lang = 'en' OR source = 'src1' AS touches FROM fx_diffs")
def patch_touches_scope(spark, sf_dir):
    df = frame(spark, sf_dir, "fx_diffs").withColumn(
        "scope", F.array(F.lit("tests/"), F.when(F.col("source") == "src1", F.col("path")).otherwise("nowhere"))
    )
    return df.select("doc_id", patches.patch_touches_scope("patch", "scope").alias("touches"))


@query(
    "normalize_patch",
    "SELECT doc_id, md5(first_section || second_section) AS digest FROM fx_diffs",
)
def normalize_patch(spark, sf_dir):
    stray = F.lit("diff --git a/2024-01-02 10:00 b/2024-01-02 10:00\nnew file\n")
    broken = F.concat("first_section", stray, F.regexp_replace("second_section", r"\n\z", ""))
    return frame(spark, sf_dir, "fx_diffs").select("doc_id", F.md5(patches.normalize_patch(broken)).alias("digest"))


@query(
    "filter_test_sections",
    "SELECT doc_id, md5(CASE WHEN other_is_test THEN first_section ELSE patch END) AS digest FROM fx_diffs",
)
def filter_test_sections(spark, sf_dir):
    return frame(spark, sf_dir, "fx_diffs").select("doc_id", F.md5(patches.filter_test_sections("patch")).alias("digest"))


@query(
    "normalize_paths",
    "SELECT doc_id, md5(patch) AS digest FROM fx_diffs",
)
def normalize_paths(spark, sf_dir):
    mounted = frame(
        spark,
        sf_dir,
        f"""SELECT doc_id, {_section('path', old='golden_app/', new='testbed/')} || 'diff --git a/golden_app/x.bin b/testbed/x.bin' || chr(10) ||
            {_section("'.git/config'", "'@@ -1 +1 @@' || chr(10)", 'golden_app/', 'testbed/')} || {_section('other', old='golden_app/', new='testbed/')} AS patch
            FROM fx_patches""",
    )
    return mounted.select("doc_id", F.md5(patches.normalize_paths("patch")).alias("digest"))


@query("concat_patches", "SELECT doc_id, md5(CASE WHEN lang = 'fr' THEN NULL ELSE first_section || second_section END) AS digest FROM fx_diffs")
def concat_patches(spark, sf_dir):
    def part(name, bare):
        return F.when(F.col("lang") != "fr", F.regexp_replace(name, r"\n\z", "") if bare else F.col(name)).otherwise("")

    joined = patches.concat_patches(part("first_section", True), F.lit(None).cast("string"), part("second_section", False))
    return frame(spark, sf_dir, "fx_diffs").select("doc_id", F.md5(joined).alias("digest"))


@query(
    "diff_fingerprint",
    "SELECT doc_id, true AS same_reordered, false AS same_changed FROM fx_diffs",
)
def diff_fingerprint(spark, sf_dir):
    df = frame(spark, sf_dir, "fx_diffs")
    moved = F.regexp_replace(F.concat("second_section", "first_section"), "(?m)^@@ -0,0 .1 @@$", "@@ -7,0 +9 @@")
    moved = F.regexp_replace(moved, "(?m)^index 00..11$", "index aa..bb")
    changed = F.concat("patch", F.lit("+one more line\n"))
    own = patches.diff_fingerprint("patch")
    return df.select(
        "doc_id",
        (own == patches.diff_fingerprint(moved)).alias("same_reordered"),
        (own == patches.diff_fingerprint(changed)).alias("same_changed"),
    )


def _section_digest(section: str) -> str:
    lines = f"list_filter(string_split({section}, chr(10)), lambda x: NOT (starts_with(x, 'index ') OR starts_with(x, '@@ ') OR starts_with(x, chr(92) || ' ')))"
    return f"sha256(regexp_replace(array_to_string({lines}, ''), '[ \\t\\n\\x0B\\f\\r]+', '', 'g'))"


@query(
    "diff_fingerprints",
    f"""SELECT doc_id, sha256(array_to_string(list_sort([{_section_digest("first_section")}, {_section_digest("second_section")}]), '')) AS fingerprint
        FROM fx_diffs""",
)
def diff_fingerprints(spark, sf_dir):
    return frame(spark, sf_dir, "fx_diffs").select("doc_id", patches.diff_fingerprint("patch").alias("fingerprint"))


@query("heredoc_patch", "SELECT doc_id, CASE WHEN lang = 'es' THEN '' ELSE md5(rtrim(patch, chr(10))) END AS digest FROM fx_diffs")
def heredoc_patch(spark, sf_dir):
    df = frame(spark, sf_dir, "fx_diffs").withColumn("body", F.regexp_replace("patch", r"\n+\z", ""))
    script = F.concat(
        F.lit("set -e\ngit apply -v - <<'EOF_"), F.col("doc_id"), F.lit("'\n"), F.col("body"), F.lit("\nEOF_"), F.col("doc_id"), F.lit("\ntrue\n")
    )
    script = F.when(F.col("lang") == "es", F.lit("true\n")).otherwise(script)
    found = patches.heredoc_patch(script)
    return df.select("doc_id", F.when(found == "", "").otherwise(F.md5(found)).alias("digest"))


# Testcases: orders as reported by three kinds of runners.
_CASES = """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'tests/unit/test_' || CAST(o_custkey AS VARCHAR(20)) || '.py' END AS _file,
       CASE WHEN o_orderpriority = '1-URGENT' THEN '' ELSE 'tests.unit.test_' || CAST(o_custkey AS VARCHAR(20)) ||
         CASE o_orderpriority WHEN '2-HIGH' THEN '' WHEN '3-MEDIUM' THEN '.TestA' ELSE '.TestA.TestB' END END AS _classname,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'tests.unit.test_' || CAST(o_custkey AS VARCHAR(20)) ELSE 'test_x[' || CAST(o_orderkey AS VARCHAR(20)) || ']' END AS _name,
       CASE WHEN o_totalprice < 50000 AND o_orderpriority <> '1-URGENT' THEN 1 END AS failure,
       CASE WHEN o_totalprice < 100000 OR (o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P') THEN 1 END AS error,
       CASE WHEN o_totalprice < 150000 OR (o_orderpriority = '1-URGENT' AND o_orderstatus = 'P') THEN 1 END AS skipped
FROM orders
"""
_NODE = """
CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE 'tests/unit/test_' || CAST(o_custkey AS VARCHAR(20)) || '.py' ||
  CASE o_orderpriority WHEN '2-HIGH' THEN '' WHEN '3-MEDIUM' THEN '::TestA' ELSE '::TestA::TestB' END || '::test_x[' || CAST(o_orderkey AS VARCHAR(20)) || ']' END
"""


@query("node_id", f"SELECT o_orderkey, {_NODE} AS test FROM orders WHERE o_orderpriority <> '1-URGENT'")
def node_id(spark, sf_dir):
    cases = frame(spark, sf_dir, _CASES)
    return cases.where("_classname <> ''").select("o_orderkey", testnames.node_id("_file", "_classname", "_name").alias("test"))


@query(
    "case_status",
    f"""
    SELECT o_orderkey, CASE WHEN urgent AND NOT skip THEN 'discovery' ELSE 'test' END AS kind,
           CASE WHEN urgent AND skip THEN 'tests/unit/test_' || CAST(o_custkey AS VARCHAR(20)) || '.py' WHEN NOT urgent THEN {_NODE} END AS test,
           CASE WHEN urgent AND skip THEN 'SKIPPED' WHEN urgent THEN NULL WHEN o_totalprice < 50000 THEN 'FAILED' WHEN o_totalprice < 100000 THEN 'ERROR'
                WHEN o_totalprice < 150000 THEN 'SKIPPED' ELSE 'PASSED' END AS status,
           CASE WHEN urgent AND NOT skip THEN 'tests.unit.test_' || CAST(o_custkey AS VARCHAR(20)) END AS module
    FROM (SELECT *, o_orderpriority = '1-URGENT' AS urgent, o_totalprice < 150000 OR o_orderstatus = 'P' AS skip FROM orders)
    """,
)
def case_status(spark, sf_dir):
    done = testnames.with_case_status(frame(spark, sf_dir, _CASES))
    return done.select("o_orderkey", "kind", "test", "status", "module")


@query(
    "flag_status",
    """
    SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_linenumber > 5 THEN 'ERROR' WHEN l_returnflag = 'R' THEN 'FAILED'
           WHEN l_returnflag = 'A' THEN 'PASSED' ELSE 'SKIPPED' END AS status FROM lineitem
    """,
)
def flag_status(spark, sf_dir):
    number, flag = F.col("l_linenumber"), F.col("l_returnflag")
    status = testnames.flag_status(flag == "A", flag == "R", number == 6, number == 7, number > 7)
    return frame(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", status.alias("status"))


@query("prefix_path", "SELECT o_orderkey, 'test/units/' || CAST(o_custkey AS VARCHAR(20)) AS test FROM orders")
def prefix_path(spark, sf_dir):
    raw = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("test/units/"), "o_custkey")).otherwise(
        F.col("o_custkey").cast("string")
    )
    return frame(spark, sf_dir, "orders").select("o_orderkey", testnames.prefix_path(raw, "test/units/").alias("test"))


_IDS = """
SELECT o_orderkey, CAST(o_custkey % 100 AS VARCHAR(20)) AS instance_id,
       CASE o_orderstatus WHEN 'F' THEN 'a/b' || CAST(o_custkey AS VARCHAR(20)) || '.py::T::test_' || CAST(o_orderkey AS VARCHAR(20)) || '[x::y]'
            WHEN 'O' THEN 'test_' || CAST(o_orderkey AS VARCHAR(20)) || ' (mod.sub' || CAST(o_custkey % 1000 AS VARCHAR(20)) || '.ClassA)'
            ELSE 'test_' || CAST(o_orderkey AS VARCHAR(20)) || '[z]' END AS test
FROM orders
"""


@query(
    "test_func_name",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'y]' ELSE 'test_' || CAST(o_orderkey AS VARCHAR(20)) END AS func FROM orders",
)
def test_func_name(spark, sf_dir):
    return frame(spark, sf_dir, _IDS).select("o_orderkey", testnames.test_func_name("test").alias("func"))


@query(
    "test_files",
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'a/b' || CAST(o_custkey AS VARCHAR(20)) || '.py' WHEN 'P' THEN ''
           ELSE CASE WHEN o_custkey % 100 IN (SELECT c_custkey % 100 FROM customer WHERE c_custkey % 1000 = o_custkey % 1000 AND c_mktsegment = 'BUILDING')
                     THEN 'mod/sub' ELSE 'tests/mod/sub' END || CAST(o_custkey % 1000 AS VARCHAR(20)) || '.py' END AS test_file
    FROM orders
    """,
)
def test_files(spark, sf_dir):
    files = frame(
        spark,
        sf_dir,
        """SELECT CAST(c_custkey % 100 AS STRING) AS instance_id, 'mod/sub' || CAST(c_custkey % 1000 AS STRING) || '.py' AS file
           FROM customer WHERE c_mktsegment = 'BUILDING'""",
    )
    return testnames.test_files(frame(spark, sf_dir, _IDS), files, ["instance_id"]).select("o_orderkey", "test_file")


# Commands ---------------------------------------------------------------------------------------


@query("command_between", "SELECT doc_id, CASE WHEN lang <> 'fr' THEN md5('run ' || source || chr(10) || 'then ' || lang) END AS digest FROM documents")
def command_between(spark, sf_dir):
    start = F.when(F.col("lang") != "fr", ": '>>>>> Start Test Output'").otherwise("nothing")
    script = F.concat_ws(
        "\n",
        F.regexp_replace("text", ">>>>>", ""),
        start,
        F.concat(F.lit("run "), "source"),
        F.concat(F.lit("then "), "lang"),
        F.lit(": '>>>>> End Test Output'"),
        F.lit("cleanup"),
    )
    body = commands.command_between(script, "Start Test Output", "End Test Output")
    return frame(spark, sf_dir, "documents").select("doc_id", F.md5(body).alias("digest"))


_RUN = """
CASE o_orderstatus WHEN 'F' THEN 'python -m pip install pytest 1>&2 && python -m pytest -rA x'
     WHEN 'O' THEN 'cd /app && /app/.venv/bin/pytest' ELSE 'make check pytest.ini' END
"""


@query(
    "insert_args",
    """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'python -m pip install pytest 1>&2 && python -m pytest ' || args || ' -rA x'
           WHEN 'O' THEN 'cd /app && /app/.venv/bin/pytest ' || args END AS command
    FROM (SELECT *, 'a.py::t_' || CAST(o_orderkey AS VARCHAR(20)) || ' ''b.py::t[axis=''"''"''c''"''"'']''' AS args FROM orders)
    """,
)
def insert_args(spark, sf_dir):
    orders = frame(spark, sf_dir, f"SELECT *, {_RUN} AS command FROM orders")
    args = F.array(F.concat(F.lit("a.py::t_"), "o_orderkey"), F.lit("b.py::t[axis='c']"))
    return orders.select("o_orderkey", commands.insert_args("command", args).alias("command"))


@query(
    "workload_command",
    """
    SELECT doc_id, md5('cat > /tmp/test_workload.py <<''PYEOF''' || chr(10) || 'def test_workload():' || chr(10) || '    x = 1' || chr(10) || chr(10) || '    y = ''' || source
           || '''' || chr(10) || '    assert True' || chr(10) || 'PYEOF' || chr(10) || 'pytest /tmp/test_workload.py -rA ') AS digest,
           'x = 1' || chr(10) || source || chr(10) AS body
    FROM documents
    """,
)
def workload_command(spark, sf_dir):
    docs = frame(spark, sf_dir, "documents")
    body = F.concat(F.lit("x = 1\n\ny = '"), "source", F.lit("'\n\n"))
    stored = F.concat(F.lit("cat > f <<'PYEOF'\nx = 1\n"), "source", F.lit("\nPYEOF\nrun"))
    return docs.select(
        "doc_id",
        F.md5(commands.workload_command(F.lit("pytest -rA numpy/"), body, ["numpy/"])).alias("digest"),
        commands.workload_body(stored).alias("body"),
    )


@query(
    "adapt_command",
    """
    SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'python -m pytest own'
           WHEN '2-HIGH' THEN 'X=8 pytest -rA --tb=no -n auto'
           WHEN '3-MEDIUM' THEN 'pytest $(python -c ''import xdist'' 2>/dev/null && echo ''-n 4 --max-worker-restart=4'') -rA -n 0 --tb=no lib/'
           ELSE 'pytest $(python -c ''import xdist'' 2>/dev/null && echo ''-n 4 --max-worker-restart=4'') -rA -n 0 --tb=no' END AS command
    FROM orders
    """,
)
def adapt_command(spark, sf_dir):
    orders = frame(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("repo"), F.lit("pytest -rA -n 0 --tb=no").alias("command")
    )
    rules = frame(
        spark,
        sf_dir,
        """SELECT DISTINCT o_orderpriority AS repo, CASE WHEN o_orderpriority = '1-URGENT' THEN 'python -m pytest own' END AS override,
                  CASE WHEN o_orderpriority = '2-HIGH' THEN 'X=8 ' END AS env_prefix, CASE WHEN o_orderpriority = '2-HIGH' THEN '-n auto' END AS flags,
                  CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'lib/' END AS scope
           FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""",
    )
    return commands.adapt_command(orders, rules).select("o_orderkey", F.col("adapted").alias("command"))


_CAPTURED = """
SELECT doc_id, lang, n_text, text || chr(10) || CASE WHEN lang = 'en' THEN 'Before Mean: 9' || chr(10) || 'Mean: ' || CAST(n_text / 8.0 AS VARCHAR) || chr(10) || 'Std Dev: 0.25' || chr(10) ELSE '' END AS captured
FROM (SELECT doc_id, lang, text, length(text) + 1 AS n_text FROM documents)
"""


@query(
    "parse_timing_text",
    f"""
    SELECT doc_id, CASE WHEN lang = 'en' THEN CAST(n_text AS DOUBLE) / 8 END AS workload_mean_s, CASE WHEN lang = 'en' THEN CAST(0.25 AS DOUBLE) END AS workload_stdev_s,
           length(captured) > 16384 AS stdout_truncated, md5(right(captured, 16384)) AS tail_digest, md5(captured) AS whole_digest
    FROM ({_CAPTURED})
    """,
)
def parse_timing_text(spark, sf_dir):
    docs = frame(spark, sf_dir, "documents")
    mean = ((F.length("text") + 1) / F.lit(8.0)).cast("string")
    summary = F.concat(F.lit("Before Mean: 9\nMean: "), mean, F.lit("\nStd Dev: 0.25\n"))
    captured = docs.select("doc_id", F.concat("text", F.lit("\n"), F.when(F.col("lang") == "en", summary).otherwise("")).alias("captured"))
    whole = texts.parse_timing_text("captured")[0]
    parsed = captured.select("doc_id", *texts.parse_timing_text("captured", 16_384), F.md5(whole).alias("whole_digest"))
    return parsed.select("doc_id", "workload_mean_s", "workload_stdev_s", "stdout_truncated", F.md5("stdout").alias("tail_digest"), "whole_digest")


@query(
    "assemble_prompt",
    """
    SELECT doc_id, md5('## Source files (slice of the project)' || chr(10) || chr(10) || '### `' || source || '`' || chr(10) || '```python' || chr(10) || text || chr(10) || '```' || chr(10)
           || chr(10) || '## Test file: `t.py`' || chr(10) || '```python' || chr(10) || lang || chr(10) || '```' || chr(10) || chr(10) || '## Task' || chr(10) || chr(10) || 'Predict.') AS digest
    FROM documents
    """,
)
def assemble_prompt(spark, sf_dir):
    files = F.array(F.struct(F.col("source").alias("path"), F.col("text").alias("content")))
    prompt = texts.assemble_prompt(files, F.lit("t.py"), "lang", F.lit("Predict."))
    return frame(spark, sf_dir, "documents").select("doc_id", F.md5(prompt).alias("digest"))


@query(
    "normalize_hosts",
    """
    SELECT c_custkey, CASE WHEN c_nationkey < 10 THEN 25 ELSE 6 END AS family,
           CASE WHEN c_nationkey < 10 THEN CASE c_mktsegment WHEN 'BUILDING' THEN 'AMD Milan' WHEN 'MACHINERY' THEN 'AMD Genoa' END
                ELSE CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Intel Haswell' END END AS microarch,
           CASE WHEN c_acctbal > 0 THEN c_name END AS named_model, 3 AS flag_count,
           substr(sha256(array_to_string(list_sort(['avx', lower(c_mktsegment), 'sse']), ' ')), 1, 12) AS flags_hash
    FROM customer
    """,
)
def normalize_hosts(spark, sf_dir):
    hosts = frame(
        spark,
        sf_dir,
        """SELECT c_custkey, CASE WHEN c_nationkey < 10 THEN 'AuthenticAMD' ELSE 'GenuineIntel' END AS vendor,
                  CASE WHEN c_nationkey < 5 THEN 175 WHEN c_nationkey < 10 THEN 25 ELSE 6 END AS family,
                  CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 17 WHEN 'HOUSEHOLD' THEN 63 ELSE 0 END AS model,
                  CASE WHEN c_acctbal > 0 THEN c_name ELSE 'unknown' END AS model_name, 'sse ' || lower(c_mktsegment) || '  avx' AS flags
           FROM customer""",
    )
    done = texts.normalize_hosts(hosts)
    return done.select("c_custkey", "family", "microarch", "named_model", "flag_count", "flags_hash")
