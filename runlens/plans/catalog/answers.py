"""Queries on model answers, source slices, metadata, versions and logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from runlens.functions import responses
from runlens.operators import registries, sampling, slicing
from runlens.plans.catalog.inputs import scratch_folder, state_scalars
from runlens.plans.catalog.registry import frame, query
from runlens.plans.catalog.views import VIEWS
from runlens.schemas import STATES
from runlens.sources import reports, runs, sinks, states
from runlens.sources.documents import write_packed

# Conversations as answers: the text as prose around a JSON object in one of six spellings.
_SHAPE = "CASE WHEN role = 'system' THEN 'bare' WHEN role = 'user' THEN CASE WHEN turn = 0 THEN 'fenced' ELSE 'prose' END ELSE CASE WHEN turn = 1 THEN 'comment' WHEN turn = 3 THEN 'broken' ELSE 'none' END END"
VIEWS["fx_answers"] = f"""
SELECT 'm' || role AS model, 'c' || CAST(conv_id AS VARCHAR(20)) || '-' || CAST(turn AS VARCHAR(20)) AS sample_id, 'combined' AS task, {_SHAPE} AS shape,
       conv_id, turn, text, '{{"outcome": " failed ", "failure_line": "12", "exception_type": "KeyError", "peak_bytes": ' || CAST(conv_id * 1000 AS VARCHAR(20)) ||
       ', "wall_ms": ' || CAST(turn AS VARCHAR(20)) || '.5, "hot_methods_time": ["a", "f' || CAST(conv_id AS VARCHAR(20)) || '"]}}' AS answer
FROM conversations
"""


def _raw_answers(spark, sf_dir):
    prose = F.regexp_replace("text", r"[{}`\"<>]", " ")
    shape, answer = F.col("shape"), F.col("answer")
    raw = (
        F.when(shape == "bare", answer)
        .when(shape == "fenced", F.concat(prose, F.lit("\n```json\n"), answer, F.lit("\n```\n")))
        .when(shape == "prose", F.concat(prose, F.lit(" {x} "), answer, F.lit(" "), prose))
        .when(shape == "comment", F.replace(answer, F.lit('" failed ", '), F.lit('" failed ", // a note\n')))
        .when(
            shape == "broken",
            F.concat(F.lit('{"reasoning": "it "quotes" badly", '), F.substring(answer, F.lit(2), F.length(answer))),
        )
        .otherwise(prose)
    )
    return frame(spark, sf_dir, "fx_answers").withColumn("raw_response", raw)


_ANSWERS = "SELECT *, shape <> 'none' AS read FROM fx_answers"


@query("parse_responses", f"SELECT model, sample_id, CASE WHEN read THEN conv_id * 1000 END AS peak, read FROM ({_ANSWERS})", doubles=("peak",))
def parse_responses(spark, sf_dir):
    parsed = responses.parse_responses(_raw_answers(spark, sf_dir))
    return parsed.select(
        "model",
        "sample_id",
        F.get_json_object("parsed", "$.peak_bytes").cast("bigint").alias("peak"),
        F.col("parsed").isNotNull().alias("read"),
    )


@query(
    "extract_prediction",
    f"""
    SELECT model, sample_id, CASE WHEN read THEN 'failed' END AS pred_outcome, CASE WHEN read THEN 12 END AS pred_failure_line, CASE WHEN read THEN 'KeyError' END AS pred_exception,
           CASE WHEN read THEN conv_id * 1000 END AS pred_peak, CASE WHEN read THEN turn + 0.5::DOUBLE END AS pred_wall,
           CASE WHEN read THEN 'a,f' || CAST(conv_id AS VARCHAR) END AS names
    FROM ({_ANSWERS})
    """,
    doubles=("pred_failure_line", "pred_peak",),
)
def extract_prediction(spark, sf_dir):
    done = responses.extract_prediction(responses.parse_responses(_raw_answers(spark, sf_dir)))
    return done.select(
        "model",
        "sample_id",
        "pred_outcome",
        "pred_failure_line",
        "pred_exception",
        "pred_peak",
        "pred_wall",
        F.array_join("pred_hot_methods_time", ",").alias("names"),
    )


@query(
    "check_generated",
    """
    SELECT doc_id, CASE lang WHEN 'en' THEN NULL WHEN 'de' THEN 'missing test functions: test_heavy' WHEN 'fr' THEN 'timing harness not stripped'
           ELSE 'no fenced code block and response is not bare Python' END AS problem FROM documents
    """,
)
def check_generated(spark, sf_dir):
    docs = frame(spark, sf_dir, "documents").withColumn("prose", F.regexp_replace("text", "[`#]", " "))
    code = F.concat(
        F.lit("def test_light():\n    pass\n"),
        F.when(F.col("lang") != "de", "def test_heavy():\n    pass\n").otherwise(""),
        F.when(F.col("lang") == "fr", "import timeit\n").otherwise(""),
    )
    fenced = F.concat(F.col("prose"), F.lit("\n# SCALE: small\n```python\n"), code, F.lit("```\n"))
    text = F.when(F.col("lang").isin("en", "de", "fr"), fenced).otherwise(F.concat(F.lit("no code: ("), "prose"))
    checked = responses.check_generated(docs.select("doc_id", text.alias("text")), "# SCALE:", ["test_light", "test_heavy"], "timeit")
    return checked.select("doc_id", "problem")


# Documents as Python files: the text becomes the comment of the last function.
VIEWS["fx_python"] = """
SELECT 'd' || CAST(doc_id AS VARCHAR(20)) AS file_id, 'b' || CAST(doc_id % 25 AS VARCHAR(20)) AS sample_id, lang, doc_id,
       'import os' || chr(10) || chr(10) || chr(10) || 'def first():' || chr(10) || '    return 1' || chr(10) || chr(10) || chr(10) ||
       'class Box:' || chr(10) || '    size = 2' || chr(10) || chr(10) || '    def run(self):' || chr(10) || '        return 3' || chr(10) || chr(10) ||
       '    def idle(self):' || chr(10) || '        return 4' || chr(10) || chr(10) || chr(10) || 'def last():' || chr(10) || '    # ' ||
       replace(text, chr(10), chr(10) || '    # ') || chr(10) || CASE WHEN lang = 'es' THEN '    return (' ELSE '    return 5' END || chr(10) AS content
FROM documents
"""


def _executed(df):
    ran = F.when(F.col("lang") == "en", F.array(F.lit(5))).when(F.col("lang") == "de", F.array(F.lit(12), F.lit(9))).otherwise(F.array(F.lit(1)))
    return df.select("sample_id", "file_id", ran.alias("lines"), F.md5(F.concat_ws("|", "sample_id", "file_id")).alias("shuffle_key"))


@query(
    "slice_sources",
    """
    SELECT file_id, lang = 'es' AS parse_fail, length(content) AS full_chars,
           CASE lang WHEN 'es' THEN length(content) WHEN 'en' THEN head - box WHEN 'de' THEN head - first - idle ELSE head - first - box END AS essential_chars
    FROM (SELECT file_id, lang, content, strpos(content, 'def last') - 1 AS head, length('def first():') + length('    return 1') + 2 AS first,
                 strpos(content, '        return 4') + 17 - strpos(content, 'class Box') AS box, strpos(content, '        return 4') + 17 - strpos(content, '    def idle') AS idle
          FROM fx_python)
    """,
)
def slice_sources(spark, sf_dir):
    files = frame(spark, sf_dir, "fx_python")
    sliced = slicing.slice_sources(files.select("file_id", "content"), _executed(files), 0)
    return sliced.select("file_id", "parse_fail", "essential_chars", "full_chars")


# The droppable spans of those files, by what ran in them: first() in lines 4-5, Box in 8-15 or its idle() in 14-15, last()
# from line 18 to the last one. Chars count the line end.
_SPANS = """
SELECT *, length(t_first) + 1 AS c_first, length(t_mid) + 1 AS c_mid, length(t_last) + 1 AS c_last,
       n - COALESCE(length(t_first) + 1, 0) - COALESCE(length(t_mid) + 1, 0) - COALESCE(length(t_last) + 1, 0) AS essential,
       row_number() OVER (PARTITION BY sample_id ORDER BY md5(sample_id || '|' || file_id)) AS rn
FROM (SELECT sample_id, file_id, lang, content, length(content) AS n, length(content) - length(replace(content, chr(10), '')) AS end_line,
             CASE WHEN lang NOT IN ('es', 'en') THEN 'def first():' || chr(10) || '    return 1' END AS t_first,
             CASE WHEN lang = 'de' THEN 'def idle(self):' || chr(10) || '        return 4' WHEN lang <> 'es'
                  THEN substr(content, strpos(content, 'class Box'), strpos(content, '        return 4') + 16 - strpos(content, 'class Box')) END AS t_mid0,
             CASE WHEN lang = 'de' THEN '    ' || t_mid0 ELSE t_mid0 END AS t_mid,
             CASE WHEN lang <> 'es' THEN substr(content, strpos(content, 'def last'), length(content) - strpos(content, 'def last')) END AS t_last
      FROM fx_python)
"""


def _mark(first: str, last: str) -> str:
    return f"'# ... [' || ({last} - {first} + 1) || ' lines elided: original lines ' || {first} || '-' || {last} || ']'"


_FIRST_MID = "CASE WHEN lang = 'de' THEN 14 ELSE 8 END"


def _sliced(rows: str) -> str:
    """SQL: `rows` of spans with `r`, the budget left, and what the slice keeps of them."""
    for c, before, after in (("c_first", "essential", "u1"), ("c_mid", "u1", "u2"), ("c_last", "u2", "u3")):
        rows = f"SELECT *, CASE WHEN {before} + {c} <= r THEN {before} + {c} ELSE {before} END AS {after}, COALESCE({before} + {c} > r, false) AS no_{c[2:]} FROM ({rows})"
    text = "content"
    for name, first, last in (("first", "4", "5"), ("mid", _FIRST_MID, "15"), ("last", "18", "end_line")):
        text = f"CASE WHEN no_{name} THEN replace({text}, t_{name}, {_mark(first, last)}) ELSE {text} END"
    rows = f"SELECT *, {text} || CASE WHEN no_last THEN chr(10) ELSE '' END AS slice, lang = 'es' AS parse_fail FROM ({rows})"
    return f"SELECT *, length(slice) AS kept, NOT parse_fail AND essential > r AS essential_over FROM ({rows})"


_CONTEXT = f"""
fills AS (
  SELECT sample_id, CAST(0 AS BIGINT) AS rn, CAST(100 AS BIGINT) AS used, '' AS file_id, '' AS digest, CAST(0 AS BIGINT) AS essential_chars, CAST(0 AS BIGINT) AS kept_chars,
         false AS over_budget, false AS parse_fail FROM fx_python GROUP BY sample_id
  UNION ALL
  SELECT sample_id, rn, CAST(used + kept AS BIGINT), file_id, md5(slice), essential, kept, essential_over OR used + kept > 40000, parse_fail
  FROM ({_sliced("SELECT s.*, f.used, greatest(0, 40000 - f.used) AS r FROM fills f JOIN ordered s ON s.sample_id = f.sample_id AND s.rn = f.rn + 1")}))
"""


def _smart(spark, sf_dir):
    files = frame(spark, sf_dir, "fx_python")
    starts = files.groupBy("sample_id").agg(F.lit(100).alias("start_chars"))
    return slicing.smart_context(starts, files.select("file_id", "content"), _executed(files), 40_000)


@query(
    "smart_context",
    f"""
    WITH RECURSIVE ordered AS MATERIALIZED ({_SPANS}), {_CONTEXT}
    SELECT sample_id, 100 AS test_file_chars, CAST(max(used) AS BIGINT) AS total_chars, count(*) - 1 AS n_files, count_if(over_budget) AS n_files_over_budget,
           count_if(parse_fail) AS n_parse_failures, CAST(sum(essential_chars) AS BIGINT) AS essential_chars_total, max(used) > 40000 AS budget_exceeded
    FROM fills GROUP BY sample_id
    """,
)
def smart_context(spark, sf_dir):
    return _smart(spark, sf_dir)[1]


@query(
    "smart_slices",
    f"""
    WITH RECURSIVE ordered AS MATERIALIZED ({_SPANS}), {_CONTEXT}
    SELECT sample_id, file_id, digest, essential_chars, kept_chars, over_budget, parse_fail FROM fills WHERE rn > 0
    """,
)
def smart_slices(spark, sf_dir):
    return _smart(spark, sf_dir)[0].select(
        "sample_id", "file_id", F.md5("slice").alias("digest"), "essential_chars", "kept_chars", "over_budget", "parse_fail"
    )


_EXEC = "CASE WHEN lang = 'de' THEN 2 ELSE 1 END"


@query(
    "slice_texts",
    " UNION ALL ".join(
        f"""SELECT file_id, {budget} AS budget, md5(slice) AS digest, kept AS kept_chars, essential AS essential_chars, essential_over AS essential_over_budget,
                   parse_fail, {_EXEC} AS exec_total, {_EXEC} AS exec_in_kept
            FROM ({_sliced(f"SELECT *, {budget} AS r FROM ({_SPANS})")})"""
        for budget in (0, 200, 2000)
    ),
)
def slice_texts(spark, sf_dir):
    files = frame(spark, sf_dir, "fx_python")
    rows = slicing.classified(files.select("file_id", "content"), _executed(files))
    budgets = rows.withColumn("budget", F.explode(F.array(F.lit(0), F.lit(200), F.lit(2000))))
    sliced = slicing.render_slices(budgets.withColumn("file_id", F.concat_ws("|", "file_id", "budget")), F.col("budget"))
    return sliced.select(
        F.substring_index("file_id", "|", 1).alias("file_id"),
        F.substring_index("file_id", "|", -1).cast("int").alias("budget"),
        F.md5("slice").alias("digest"),
        "kept_chars", "essential_chars", "essential_over_budget", "parse_fail", "exec_total", "exec_in_kept",
    )


_FITTED = """
SELECT sample_id, file, shuffle_key, content, length(content) AS n,
       COALESCE(sum(length(content)) OVER (PARTITION BY sample_id ORDER BY shuffle_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
FROM (SELECT source AS sample_id, CAST(doc_id AS VARCHAR(20)) AS file, md5(source || '|' || CAST(doc_id AS VARCHAR(20))) AS shuffle_key,
             CASE WHEN length(text) <= 30000 THEN text ELSE substr(text, 1, 30000) || chr(10) || '... [truncated]' END AS content FROM documents)
"""


@query(
    "oracle_context",
    f"""
    SELECT sample_id, file, md5(CASE WHEN n <= 50000 - before THEN content ELSE substr(content, 1, CAST(50000 - before AS BIGINT)) || chr(10) || '... [truncated]' END) AS digest, n > 50000 - before AS cut
    FROM ({_FITTED}) WHERE before < 50000 AND (n <= 50000 - before OR 50000 - before >= 2000)
    """,
)
def oracle_context(spark, sf_dir):
    files = frame(spark, sf_dir, "documents").select(
        F.col("source").alias("sample_id"), F.col("doc_id").cast("string").alias("file"), F.col("text").alias("content"), F.lit(0).alias("start_chars")
    )
    keyed = sampling.shuffle_files(files, ["sample_id"])
    done = slicing.oracle_context(keyed, 50_000, 30_000, 2_000)
    return done.select("sample_id", "file", F.md5("content").alias("digest"), "cut")


@query(
    "carve_window",
    """
    SELECT doc_id, CASE WHEN length(text) * 3 + length(mid) + 2 <= 60000 THEN length(text) * 3 + length(mid) + 2 END AS whole_chars,
           length(text) * 3 + length(mid) + 2 > 60000 AS carved, true AS has_target
    FROM (SELECT doc_id, text, 'def test_x():' AS mid FROM documents)
    """,
    doubles=("whole_chars",),
)
def carve_window(spark, sf_dir):
    docs = frame(spark, sf_dir, "documents")
    content = F.concat("text", F.lit("\ndef test_x():\n"), "text", "text")
    done = slicing.carve_window(docs.select("doc_id", content.alias("content"), F.lit("a.py::test_x[1]").alias("test")), 60_000, 8_000, 50_000)
    long = F.length("content") > 60_000
    return done.select(
        "doc_id",
        F.when(~long, F.length("window")).alias("whole_chars"),
        (F.col("window") != F.col("content")).alias("carved"),
        F.col("window").contains("\ndef test_x():\n").alias("has_target"),
    )


@query(
    "fill_budget",
    """
    WITH RECURSIVE ordered AS (
      SELECT l_orderkey, CAST(floor(l_quantity) AS BIGINT) AS chars, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_linenumber, l_suppkey, l_extendedprice) AS rn FROM lineitem),
    fill AS (
      SELECT l_orderkey, rn, CASE WHEN chars <= 100 THEN chars ELSE 0 END AS used FROM ordered WHERE rn = 1
      UNION ALL SELECT o.l_orderkey, o.rn, f.used + CASE WHEN f.used + o.chars <= 100 THEN o.chars ELSE 0 END FROM fill f JOIN ordered o ON o.l_orderkey = f.l_orderkey AND o.rn = f.rn + 1)
    SELECT l_orderkey, max_by(used, rn) AS used FROM fill GROUP BY l_orderkey
    """,
)
def fill_budget(spark, sf_dir):
    order = F.struct("l_partkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    span = F.struct(
        F.lit(1).alias("first"), F.lit(1).alias("last"), F.floor("l_quantity").cast("int").alias("chars")
    )
    ranges = frame(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct(order.alias("o"), span.alias("s")))).alias("items")
    )
    filled = slicing.fill_budget(F.col("items.s"), F.lit(0), F.lit(100))
    return ranges.select("l_orderkey", filled["used"].alias("used"))


# Records ---------------------------------------------------------------------------------------------


@query(
    "select_ids",
    "SELECT instance_id, container, l_orderkey AS pos FROM fx_states JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON grp = l_orderkey WHERE variant = 'fixed'",
)
def select_ids(spark, sf_dir):
    asked = frame(
        spark,
        sf_dir,
        """SELECT DISTINCT l_orderkey AS pos, 's' || CAST(l_orderkey AS STRING) || '__' || lpad(CAST(l_orderkey AS STRING), 8, '0') || '__fixed' AS instance_id
           FROM lineitem""",
    )
    rows, _ = states.select_ids(frame(spark, sf_dir, "fx_states"), asked)
    return rows.select("instance_id", "container", "pos")


@query(
    "unknown_ids",
    "SELECT DISTINCT l_orderkey AS pos FROM lineitem WHERE l_orderkey NOT IN (SELECT grp FROM fx_states WHERE variant = 'fixed')",
)
def unknown_ids(spark, sf_dir):
    asked = frame(
        spark,
        sf_dir,
        """SELECT DISTINCT l_orderkey AS pos, 's' || CAST(l_orderkey AS STRING) || '__' || lpad(CAST(l_orderkey AS STRING), 8, '0') || '__fixed' AS instance_id
           FROM lineitem""",
    )
    return states.select_ids(frame(spark, sf_dir, "fx_states"), asked)[1].select("pos")


@query("read_states", "SELECT instance_id, container FROM fx_states WHERE grp IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 12)")
def read_states(spark, sf_dir):
    wanted = frame(
        spark, sf_dir, "SELECT instance_id FROM fx_states JOIN supplier ON s_suppkey = grp WHERE supplier.s_nationkey < 12"
    )
    folder = f"{scratch_folder(spark)}/states"
    rows = state_scalars(spark, sf_dir)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in STATES if f.name not in rows.columns}
    rows.withColumns(missing).select(*STATES.names).write.parquet(folder)
    return states.read_states(spark, folder, wanted).select("instance_id", "container")


# Stored answers of several models, read back, parsed and scored to a table of run health.
@query(
    "read_responses",
    f"""
    SELECT model, 'plain' AS label, count(*) AS n, count(CASE WHEN read THEN 1 END) AS n_valid,
           count(CASE WHEN read THEN 2 * conv_id END) * 2 AS n_names FROM ({_ANSWERS}) GROUP BY model
    """,
)
def read_responses(spark, sf_dir):
    folder = scratch_folder(spark)
    raw = _raw_answers(spark, sf_dir).select("model", "sample_id", "task", "raw_response").persist()
    for model in ("msystem", "muser", "massistant"):
        raw.where(F.col("model") == model).drop("model").write.json(f"{folder}/{model}/responses")
    raw.unpersist()
    stored = runs.read_responses(spark, [folder], ["plain"])
    predicted = responses.extract_prediction(responses.parse_responses(stored))
    names = responses.prediction_items(predicted).groupBy("model", "sample_id").agg(F.count(F.lit(1)).alias("names"))
    joined = predicted.join(names, ["model", "sample_id"], "left")
    return joined.groupBy("model", F.col("group").alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.count("parsed").alias("n_valid"), F.sum(F.coalesce("names", F.lit(0))).alias("n_names")
    )


# One commit log per customer: its orders, oldest first.
@query(
    "read_commit_log",
    """
    SELECT md5(CAST(o_orderkey AS VARCHAR)) AS sha, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS idx,
           CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1 THEN 0 ELSE 1 END AS n_parents, o_orderpriority AS message FROM orders
    """,
)
def read_commit_log(spark, sf_dir):
    folder = f"{scratch_folder(spark)}/logs"
    commits = frame(spark, sf_dir, "SELECT o_custkey, o_orderkey, md5(CAST(o_orderkey AS STRING)) AS sha, o_orderpriority FROM orders")
    ordered = commits.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "sha", "o_orderpriority"))).alias("c"))

    def block(commit, at):
        parent = F.when(at > 0, F.element_at("c.sha", F.greatest(at, F.lit(1)))).otherwise("")
        return F.concat_ws("\n", F.lit("--commit--"), commit["sha"], parent, commit["o_orderpriority"], F.lit(""))

    # The text ends with a line end of its own.
    text = F.concat(F.array_join(F.transform("c", block), ""), F.lit("\n"))
    write_packed(ordered.select(F.concat_ws("/", F.col("o_custkey").cast("string"), F.lit("log.txt")).alias("path"), text.alias("value")), folder)
    read = reports.read_commit_log(spark, folder, packed=True)
    return read.select("sha", "idx", F.size("parents").alias("n_parents"), "message")


# The registry: a metric and a ground truth by their names, and a reader the user adds.
@query(
    "score_by_name",
    "SELECT model, sample_id, round(peak_x, 6) AS peak_gt_log10, round(abs(peak_y - peak_x), 6) AS peak_log10_mae FROM fx_scored",
)
def score_by_name(spark, sf_dir):
    scored = registries.score("peak_rss", frame(spark, sf_dir, "fx_responses"))
    return scored.select("model", "sample_id", *[F.round(c, 6).alias(c) for c in ("peak_gt_log10", "peak_log10_mae")])


@query(
    "ground_truth_by_name",
    """
    SELECT instance_id, test, CAST(sum(COALESCE(exclusive_time_s, 0)) * 1000 AS DOUBLE) AS wall_ms FROM (
      SELECT 'i' || CAST(l_suppkey AS VARCHAR(20)) AS instance_id, 't' || CAST(l_linenumber AS VARCHAR(8)) AS test,
             CASE WHEN l_returnflag <> 'A' THEN CAST(l_quantity AS DOUBLE) / 8 END AS exclusive_time_s FROM lineitem) GROUP BY 1, 2
    """,
)
def ground_truth_by_name(spark, sf_dir):
    functions = frame(
        spark,
        sf_dir,
        """SELECT 'i' || CAST(l_suppkey AS STRING) AS instance_id, 't' || CAST(l_linenumber AS STRING) AS test,
                  CASE WHEN l_returnflag <> 'A' THEN CAST(l_quantity AS DOUBLE) / 8 END AS exclusive_time_s FROM lineitem""",
    )
    return registries.ground_truth("wall_time", functions)


@query("read_report_by_name", "SELECT 'i' || CAST(l_suppkey AS VARCHAR(20)) AS instance_id, 't' || CAST(l_linenumber AS VARCHAR(8)) AS test, l_returnflag AS status, count(*) AS n FROM lineitem GROUP BY 1, 2, 3")
def read_report_by_name(spark, sf_dir):
    folder = f"{scratch_folder(spark)}/report"
    lines = frame(
        spark,
        sf_dir,
        "SELECT 'i' || CAST(l_suppkey AS STRING) AS instance_id, 't' || CAST(l_linenumber AS STRING) AS test, l_returnflag AS status FROM lineitem",
    )
    lines.select(F.concat_ws(";", "instance_id", "test", "status").alias("value")).write.text(folder)

    def semicolons(session, path):
        parts = F.split("value", ";", 3)
        return session.read.text(path).select(parts[0].alias("instance_id"), parts[1].alias("test"), parts[2].alias("status"))

    reports.register_reader("semicolons", semicolons)
    told = reports.read_report("semicolons", spark, folder)
    return told.groupBy("instance_id", "test", "status").agg(F.count(F.lit(1)).alias("n"))


# An answer with a number that JSON does not have keeps its other fields.
@query(
    "parse_non_finite",
    """
    SELECT sample_id, 'failed' AS pred_outcome, conv_id * 1000 AS pred_peak, true AS no_wall
    FROM fx_answers
    """,
)
def parse_non_finite(spark, sf_dir):
    wall = F.when(F.col("turn") % 3 == 0, "NaN").when(F.col("turn") % 3 == 1, "-Infinity").otherwise("1e999")
    raw = F.concat(F.lit('{"outcome": "failed", "peak_bytes": '), F.col("conv_id") * 1000, F.lit(', "wall_ms": '), wall, F.lit("}"))
    answers = frame(spark, sf_dir, "fx_answers").withColumn("raw_response", raw)
    done = responses.extract_prediction(responses.parse_responses(answers))
    finite = F.col("pred_wall").isNull() | F.col("pred_wall").isin(float("inf"), float("-inf"))
    return done.select("sample_id", "pred_outcome", "pred_peak", finite.alias("no_wall"))


@query("decode_metadata", "SELECT instance_id, group_id, CASE WHEN group_id IS NOT NULL THEN variant END AS variant FROM fx_states")
def decode_metadata(spark, sf_dir):
    raw = state_scalars(spark, sf_dir).withColumn("metadata", F.when(F.col("group_id").isNotNull(), F.col("metadata")))
    decoded = states.decode_metadata(raw)
    return decoded.select(
        "instance_id",
        F.variant_get("metadata", "$.swefficiency.instance_id", "string").alias("group_id"),
        F.variant_get("metadata", "$.swefficiency.variant", "string").alias("variant"),
    )


@query(
    "encode_metadata",
    """
    SELECT instance_id, CASE WHEN variant = 'fixed' THEN '{}' WHEN group_id IS NULL THEN '{}' ELSE '{"group":"' || group_id || '"}' END AS metadata FROM fx_states
    """,
)
def encode_metadata(spark, sf_dir):
    raw = frame(spark, sf_dir, "fx_states")
    value = F.when(F.col("variant") != "fixed", F.struct(F.col("group_id").alias("group")))
    return states.encode_metadata(raw.withColumn("metadata", value)).select("instance_id", "metadata")


@query(
    "with_metadata_key",
    """
    SELECT instance_id, group_id, 'gs://b/' || instance_id AS gke_path, CASE WHEN collection_error THEN 'true' END AS collection_error FROM fx_states
    """,
)
def with_metadata_key(spark, sf_dir):
    raw = state_scalars(spark, sf_dir)
    added = states.with_metadata_key(raw, "gke_path", F.concat(F.lit("gs://b/"), "instance_id"))
    return added.select(
        "instance_id",
        F.get_json_object("metadata", "$.swefficiency.instance_id").alias("group_id"),
        F.get_json_object("metadata", "$.gke_path").alias("gke_path"),
        F.get_json_object("metadata", "$.collection_error").alias("collection_error"),
    )


_TAGS = """
SELECT 'v' || CAST(p_size AS VARCHAR(8)) || '.' || CAST(p_partkey % 20 AS VARCHAR(8)) || '.' || CAST(p_partkey AS VARCHAR(20)) || CASE WHEN p_type = 'ECONOMY' THEN '-rc' ELSE '' END AS tag,
       p_size AS x, p_partkey % 20 AS y, p_partkey AS z, p_type FROM part
"""


@query(
    "next_version",
    f"""
    SELECT tag AS current, 'v' || CAST(x AS VARCHAR) || '.' || CAST(y + 1 AS VARCHAR) || '.0' AS next FROM ({_TAGS}) WHERE p_type <> 'ECONOMY' ORDER BY x DESC, y DESC, z DESC LIMIT 1
    """,
)
def next_version(spark, sf_dir):
    return sinks.next_version(frame(spark, sf_dir, _TAGS), "y")


@query(
    "outcomes_from_log",
    """
    SELECT 'd' || CAST(doc_id AS VARCHAR(20)) AS instance_id, 't' || CAST(doc_id AS VARCHAR(20)) AS test, CASE lang WHEN 'en' THEN 'failed' ELSE 'passed' END AS outcome
    FROM documents WHERE lang IN ('en', 'de')
    """,
)
def outcomes_from_log(spark, sf_dir):
    name = F.concat(F.lit("t"), "doc_id")
    log = F.when(
        F.col("lang") == "en", F.concat(F.lit("PASSED "), name, F.lit("\n"), F.col("text"), F.lit("\nFAILED "), name)
    ).otherwise(F.concat(F.col("text"), F.lit("\n"), name, F.lit(" ... PASSED")))
    logs = frame(spark, sf_dir, "documents").select(
        F.concat(F.lit("d"), "doc_id").alias("instance_id"), F.col("lang").alias("repo"), log.alias("log")
    )
    rules = frame(
        spark,
        sf_dir,
        """SELECT DISTINCT lang AS repo, CASE lang WHEN 'en' THEN '^(PASSED|FAILED) (t\\\\d+)$' ELSE '^(t\\\\d+) [.]{3} (PASSED|FAILED)$' END AS pattern,
                  CASE lang WHEN 'en' THEN 2 ELSE 1 END AS test_group, CASE lang WHEN 'en' THEN 1 ELSE 2 END AS status_group
           FROM documents WHERE lang IN ('en', 'de')""",
    )
    return registries.outcomes_of("log", logs, rules)
