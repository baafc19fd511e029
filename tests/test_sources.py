import gzip
import json

import pytest
from pyspark.sql import functions as F

from runlens.operators import registries
from runlens.operators.runs import triage_run
from runlens.plans.catalog import files as catalog_files
from runlens.plans.catalog import registry
from runlens.sources import documents, reports, runs, sinks, states, traces
from tests.conftest import rows


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return path


def test_states_from_lines(spark, tmp_path):
    good = {
        "instance_id": "a__b__base", "repo": "o/a", "base_commit": "c", "patch": None, "container": "img", "command": "run",
        "test_scope": ["tests/"], "metadata": {"k": {"n": 1}}, "passed_tests": ["t"],
    }
    lines = [good, {**good, "instance_id": "a"}, {**good, "extra": 1}, {**good, "test_scope": []}, {**good, "metadata": ""}]
    write(tmp_path / "s.jsonl", "\n".join([json.dumps(x) for x in lines] + ["", "   ", "{broken"]) + "\n")
    ok, bad = states.read_states_jsonl(spark, str(tmp_path / "s.jsonl"))
    assert [json.loads(r["metadata"] or "{}") for r in ok.orderBy(F.length("metadata").desc()).collect()] == [{"k": {"n": 1}}, {}]
    assert sorted(r["broken_rules"][0] for r in bad.collect()) == ["instance_id", "json", "test_scope", "unknown_fields"]
    out = str(tmp_path / "p")
    ok.write.parquet(out)
    assert states.read_states(spark, out, ["a__b__base", "zz"]).count() == 2
    assert states.read_states(spark, out, [f"x{i}" for i in range(1500)]).count() == 0
    plan = states.read_states(spark, out, ["a__b__base"]).select("repo")._jdf.queryExecution().toString()
    assert "LeftSemi" in plan and "ReadSchema: struct<instance_id:string,repo:string>" in plan


def test_metadata_keeps_types(spark):
    df = spark.createDataFrame([('{"a": {"b": [1, 2.5]}, "k": "old"}',), ("broken",), (None,)], "metadata string")
    got = [json.loads(r[0]) for r in states.with_metadata_key(df, "k", F.lit("new")).collect()]
    assert got == [{"a": {"b": [1, 2.5]}, "k": "new"}, {"k": "new"}, {"k": "new"}]
    assert rows(states.encode_metadata(spark.createDataFrame([("",), (None,), ('{"a":1}',)], "metadata string"))) == [
        ('{"a":1}',), ("{}",), ("{}",)
    ]


JUNIT = """<testsuites><testsuite>
<testcase classname="tests.test_m.TestA" name="t1"/>
<testcase classname="tests.test_m.TestA" name="t2"><failure message="x">boom</failure></testcase>
<testcase classname="tests.test_m.TestA" name="t2"><error/></testcase>
<testcase classname="tests.test_m" name="t3" file="tests/test_m.py"><skipped/></testcase>
<testcase classname="" name="tests.broken"><error message="collection failure"/></testcase>
<testcase classname="" name="tests.skip_me"><skipped/></testcase>
</testsuite></testsuites>"""


def test_junit_reports_and_their_problems(spark, tmp_path):
    write(tmp_path / "good" / "a.xml", JUNIT)
    write(tmp_path / "clash" / "a.xml", '<s><testcase classname="m" name="t"/></s>')
    write(tmp_path / "clash" / "b.xml", '<s><testcase classname="m" name="t"><failure/></testcase></s>')
    write(tmp_path / "broken" / "a.xml", "<s><testcase")
    write(tmp_path / "empty" / "a.xml", "<s></s>")
    write(tmp_path / "nameless" / "a.xml", '<s><testcase classname="m"/></s>')
    cases = reports.read_junit(spark, str(tmp_path)).persist()
    assert rows(cases.where("instance_id = 'good' and kind = 'test'"), "test", "status") == [
        ("tests/skip_me.py", "SKIPPED"),
        ("tests/test_m.py::TestA::t1", "PASSED"),
        ("tests/test_m.py::TestA::t2", "ERROR"),
        ("tests/test_m.py::TestA::t2", "FAILED"),
        ("tests/test_m.py::t3", "SKIPPED"),
    ]
    assert rows(cases.where("kind = 'discovery'"), "module") == [("tests.broken",)]
    asked = spark.createDataFrame([(i,) for i in ("good", "clash", "broken", "empty", "nameless", "none")], "instance_id string")
    found = reports.junit_problems(asked, reports.list_reports(spark, str(tmp_path)), cases)
    assert rows(found) == [
        ("broken", "malformed"), ("clash", "conflicting"), ("empty", "empty"), ("nameless", "malformed"), ("none", "missing")
    ]
    assert reports.read_report("junit", spark, str(tmp_path / "good")).count() == 5
    with pytest.raises(KeyError):
        reports.read_report("nope", spark, "x")


def test_case_report(spark, tmp_path):
    def flags(**lists):
        return {f: lists.get(f, [False, False]) for f in reports.FLAGS}

    payload = {"task": {"good": flags(passed=[True, False], timeouts=[False, True]), "odd": {**flags(), "failed": [True]}, "none": {"passed": [True]}}}
    write(tmp_path / "i" / "report.json", json.dumps(payload))
    cases, bad = reports.read_case_report(spark, str(tmp_path / "i" / "report.json"))
    assert rows(cases, "test", "status") == [("task::good::case_000", "PASSED"), ("task::good::case_001", "ERROR")]
    assert rows(bad, "solution") == [("none",), ("odd",)]


def trace(instance, wall, func="m.f"):
    test = {
        "outcome": "failed", "outcome_details": {"is_assertion": True, "failure_line": 3, "exception_type": "E"}, "wall_time_s": wall,
        "tracemalloc_enabled": True, "trimmed": True, "trim_info": [{"reason": "max_events"}],
        "functions": [{"func": func, "file": "m.py", "lineno": 1, "call_count": 2, "exclusive_time_s": 0.5}, {"func": "m.g", "file": "m.py", "lineno": 9}],
        "lines": {"m.py": {"3": {"hits": 1, "time_ns": 5}, "x": {"hits": 1}}},
    }
    return json.dumps({"instance_id": instance, "tracer_version": "1", "tests": {"a.py::t[x.y]": test}})


def test_latest_trace_wins_and_gzip_beats_plain(spark, tmp_path):
    root = tmp_path / "traces"
    write(root / "run1" / "i" / "trace_output.json", trace("i", 1.0))
    write(root / "run2" / "i" / "trace_output.json", trace("i", 2.0))
    with gzip.open(root / "run2" / "i" / "trace_output.json.gz", "wt") as f:
        f.write(trace("i", 3.0, "m.h"))
    write(root / "run2" / "i" / "trace_output_pre.json", trace("i", 9.0))
    write(root / "j" / "trace_output.json", trace("j", 4.0))
    tables = traces.read_traces(spark, str(root))
    assert rows(tables.tests, "instance_id", "test", "wall_time_s", "trimmed_by_events", "failure_line") == [
        ("i", "a.py::t[x.y]", 3.0, True, 3), ("j", "a.py::t[x.y]", 4.0, True, 3)
    ]
    assert rows(tables.functions, "instance_id", "pos", "func") == [("i", 0, "m.h"), ("i", 1, "m.g"), ("j", 0, "m.f"), ("j", 1, "m.g")]
    assert rows(tables.lines, "instance_id", "file", "line", "time_ns") == [("i", "m.py", 3, 5), ("j", "m.py", 3, 5)]
    assert rows(traces.read_traces(spark, str(root), "pre").tests, "wall_time_s") == [(9.0,)]
    assert rows(tables.runs, "instance_id", "run") == [("i", "run2"), ("j", "")]


def test_workload_profiles(spark, tmp_path):
    record = {"outcome": "passed", "profile_time_s": 1.5, "functions": {"m.f": {"filename": "m.py", "firstlineno": 1, "qualname": "f", "call_count": 1, "exclusive_time_s": 0.5}}}
    write(tmp_path / "prof" / "s1" / "x" / "cprofile_output.json", json.dumps({"tests": {reports.WORKLOAD_TEST: record}}))
    write(tmp_path / "prof" / "s2" / "cprofile_output.json", json.dumps({"tests": {"other": record}}))
    workloads, functions, skipped = reports.read_workload_profiles(spark, str(tmp_path / "prof"))
    assert rows(workloads, "instance_id", "outcome", "time_s") == [("s1", "passed", 1.5)]
    assert rows(functions, "instance_id", "key", "filename", "exclusive_time_s") == [("s1", "m.f", "m.py", 0.5)]
    assert tuple(skipped.first()) == (1, 1, 2)


def test_predictions_reports_and_commits(spark, tmp_path):
    write(tmp_path / "p" / "oh_a.jsonl", json.dumps({"instance_id": "i", "model_name_or_path": "m", "model_patch": "d", "trajectory_length": 3}) + "\n")
    write(tmp_path / "p" / "zz.jsonl", json.dumps({"instance_id": "j"}) + "\n")
    assert rows(reports.read_predictions(spark, str(tmp_path / "p")).na.fill("-"), "instance_id", "harness", "source_stem") == [
        ("i", "OpenHands", "oh_a"), ("j", "-", "zz")
    ]
    write(tmp_path / "r" / "eval_report_m.csv", "instance_id,human_speedup_ratio,raw_pred_speedup_ratio,correctness_pct,gold_speedup_ratio,pre_edit_runtime\ni,1.5,,abc,0,2\n")
    got = reports.read_eval_reports(spark, str(tmp_path / "r")).first()
    assert tuple(got) == ("m", "i", 1.5, None, None, 0.0, 2.0)
    log = "--commit--\nsha1\n\nfirst\n\nbody\n--commit--\nsha2\nsha1 sha0\nsecond\n"
    write(tmp_path / "log" / "repo.txt", log)
    commits = reports.read_commit_log(spark, str(tmp_path / "log")).collect()
    assert [tuple(c) for c in sorted(commits, key=lambda c: c["idx"])] == [
        ("repo", 0, "sha1", [], "first\n\nbody"), ("repo", 1, "sha2", ["sha1", "sha0"], "second")
    ]


def test_run_directory(spark, tmp_path):
    run = tmp_path / "run"
    write(run / "run.json", json.dumps({"rows": [{"instance_id": i, "needs_cluster": i != "p"} for i in ("x", "p", "f", "m")]}))
    write(run / "input" / "rows.jsonl", "\n".join(json.dumps({"instance_id": i}) for i in ("x", "p", "f", "m")))
    write(run / "workers" / "x" / "result.json", '{"instance_id": "x"}\n')
    write(run / "workers" / "f" / "artifacts" / "failure.json", json.dumps({"instance_id": "f", "category": "row", "stage": "s", "reason": "r", "message": "m"}))
    read = runs.read_run(spark, str(run))
    done = triage_run(*read).collect()
    assert [(r["instance_id"], r["verdict"], r["reason"]) for r in done] == [
        ("x", "result", None), ("p", "passthrough", None), ("f", "failure", "r"), ("m", "missing", "missing_worker_artifact")
    ]


def test_sinks_and_versions(spark, tmp_path):
    df = spark.createDataFrame([("s1", "t1", "post", None), ("s2", "t1", "pre", 1), ("s3", "t2", "post", 2)], "sample_id string, task string, side string, v int")
    sinks.write_jsonl(df, str(tmp_path / "j"))
    lines = [r[0] for r in spark.read.text(str(tmp_path / "j")).collect()]
    assert sorted(lines)[0] == '{"sample_id":"s1","side":"post","task":"t1","v":null}'
    sinks.write_samples(df, str(tmp_path / "s"))
    assert runs.read_samples(spark, str(tmp_path / "s"), tasks=["t1"], sides=["post"]).count() == 1
    assert rows(runs.read_samples(spark, str(tmp_path / "s"), max_per_task=1), "sample_id") == [("s1",), ("s3",)]
    sinks.publish(df, str(tmp_path / "d"), "v0.1.0")
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        sinks.publish(df, str(tmp_path / "d"), "v0.1.0")
    with pytest.raises(ValueError):
        sinks.write_nonempty(df.where("false"), str(tmp_path / "e"))
    sinks.write_failures(df.select(F.col("sample_id").alias("instance_id"), F.lit("r1").alias("reason")), str(tmp_path / "f"))
    tags = spark.createDataFrame([("v0.9.0",), ("v0.10.1",), ("draft",), ("v1.0",)], "tag string")
    assert tuple(sinks.next_version(tags, "y").first()) == ("v0.10.1", "v0.11.0")
    assert tuple(sinks.next_version(tags.where("false"), "x").first()) == (None, "v0.1.0")


def test_responses_of_two_groups(spark, tmp_path):
    for group, model in (("a", "m1"), ("b", "m2")):
        write(tmp_path / group / model / "responses" / "x.jsonl", json.dumps({"sample_id": "s", "task": "combined"}) + "\n")
    got = runs.read_responses(spark, [str(tmp_path / "a"), str(tmp_path / "b")], ["plain", "tuned"])
    assert rows(got, "group", "model", "sample_id") == [("plain", "m1", "s"), ("tuned", "m2", "s")]


def packed(spark, folder, to):
    """The loose documents of a folder as packed ones."""
    rows = [(str(p.relative_to(folder)), p.read_text()) for p in sorted(folder.rglob("*")) if p.is_file()]
    documents.write_packed(spark.createDataFrame(rows, "path string, value string"), to)
    return to


def test_packed_reports_read_like_loose_ones(spark, tmp_path):
    root = tmp_path / "loose"
    write(root / "a" / "r1.xml", '<?xml version="1.0"?><testsuites><testsuite><testcase classname="t.mod" name="a&gt;b>"/><testcase classname="t.mod"'
          " name='q\"/x'><failure message=\"m\">no <![CDATA[</testcase>]]></failure></testcase ></testsuite></testsuites>")
    write(root / "a" / "r2.xml", '<testsuite><!-- <testcase classname="t.no" name="no"/> --><properties><testcases/></properties><testcase classname="t.mod" name="a"><skipped/><!-- </testcase> -->'
          '<system-out><![CDATA[<testcase classname="t.no" name="inner"/>]]></system-out></testcase>\n<testcase classname="" name="t.mod"><error message="e"/></testcase></testsuite>')
    write(root / "b" / "r1.xml", '<testsuite><testcase classname="t.mod" name="cut"/>')
    write(root / "c" / "r1.xml", '<testsuite><testcase name="lacking"/></testsuite>')
    write(root / "c" / "r1.log", "<testsuite><testcase/></testsuite>")
    write(root / "d" / "r1.xml", "<testsuite/>")
    store = packed(spark, root, str(tmp_path / "packed"))
    columns = ["instance_id", "report", "kind", "test", "status", "module", "failure"]
    fine = reports.list_reports(spark, str(root)).where("well_formed").select("instance_id", "report")
    loose = reports.read_junit(spark, str(root)).join(fine, ["instance_id", "report"], "left_semi")
    told = reports.read_junit(spark, store, packed=True)
    assert sorted(map(str, rows(told, *columns))) == sorted(map(str, rows(loose, *columns)))
    assert told.count() == 5
    listed = ["instance_id", "report", "well_formed"]
    assert rows(reports.list_reports(spark, store, packed=True), *listed) == rows(reports.list_reports(spark, str(root)), *listed)
    # A case of any length takes no stack.
    text = "<testsuite><testcase classname='t.mod' name='long'><failure>" + "<b>x</b>-" * 300_000 + "</failure></testcase></testsuite>"
    documents.write_packed(spark.createDataFrame([("e/r1.xml", text)], "path string, value string"), str(tmp_path / "long"))
    assert rows(reports.read_junit(spark, str(tmp_path / "long"), packed=True), "test", "status") == [("t/mod.py::long", "FAILED")]


def test_packed_documents_read_like_loose_ones(spark, tmp_path):
    document = {"tests": {"t.py::a": {"outcome": "passed", "functions": [], "lines": {"m.py": {"3": {"time_ns": 5, "hits": 1}}}}}}
    for run, wall in (("run1", 1.0), ("run2", 2.0)):
        document["tests"]["t.py::a"]["wall_time_s"] = wall
        write(tmp_path / "traces" / run / "i" / "trace_output.json", json.dumps(document))
    loose = traces.read_traces(spark, str(tmp_path / "traces"))
    told = traces.read_traces(spark, packed(spark, tmp_path / "traces", str(tmp_path / "p1")), packed=True)
    assert rows(told.tests, "instance_id", "wall_time_s") == rows(loose.tests, "instance_id", "wall_time_s") == [("i", 2.0)]
    assert rows(told.lines) == rows(loose.lines)
    write(tmp_path / "log" / "r.log", "--commit--\na1\n\nfirst\n--commit--\nb2\na1\nsecond\n\nmore\n")
    store = packed(spark, tmp_path / "log", str(tmp_path / "p2"))
    assert rows(reports.read_commit_log(spark, store, packed=True)) == rows(reports.read_commit_log(spark, str(tmp_path / "log")))
    flags = {f: [False, True] for f in reports.FLAGS}
    write(tmp_path / "cases" / "i" / "r.json", json.dumps({"task": {"v1": flags, "v2": {**flags, "passed": [True]}}}))
    store = packed(spark, tmp_path / "cases", str(tmp_path / "p3"))
    for one, other in zip(reports.read_case_report(spark, store, packed=True), reports.read_case_report(spark, str(tmp_path / "cases"))):
        assert sorted(map(str, rows(one.drop("path")))) == sorted(map(str, rows(other.drop("path")))) != []
    profile = {"tests": {reports.WORKLOAD_TEST: {"outcome": "passed", "profile_time_s": 2.0, "functions": {"k": {"filename": "m.py", "call_count": 1}}}}}
    write(tmp_path / "prof" / "s1" / "cprofile_output.json", json.dumps(profile))
    write(tmp_path / "prof" / "s2" / "cprofile_output.json", json.dumps({"tests": {}}))
    write(tmp_path / "prof" / "s2" / "other.json", json.dumps(profile))
    store = packed(spark, tmp_path / "prof", str(tmp_path / "p4"))
    for one, other in zip(reports.read_workload_profiles(spark, store, packed=True), reports.read_workload_profiles(spark, str(tmp_path / "prof"))):
        assert rows(one) == rows(other) != []


def test_documents_of_a_query_take_no_file_each(spark, tmp_path):
    table = spark.range(500).select(F.when(F.col("id") > 0, F.col("id").cast("string")).alias("k"), F.lit("a\nb").alias("value"))
    catalog_files._write_documents(table.unionAll(table.where("k = '7'")), str(tmp_path / "out"), "k")
    assert len(list((tmp_path / "out").glob("part-*"))) <= 8
    told = {r["path"]: r["value"] for r in documents.read_whole(spark, str(tmp_path / "out"), "*.txt", packed=True).collect()}
    assert len(told) == 500 and told["k=7/document.txt"] == "a\nb\na\nb\n"
    assert told["k=__HIVE_DEFAULT_PARTITION__/document.txt"] == "a\nb\n"


def test_logs_of_one_repository_are_dealt_into_shares(spark):
    logs = spark.range(2000).select(
        F.concat(F.lit("i"), "id").alias("instance_id"), F.lit("r").alias("repo"), F.concat(F.lit("PASSED t1\r\nnoise\nFAILED t1\nPASSED t"), "id").alias("log")
    )
    logs = logs.unionByName(logs.limit(1).select("instance_id", F.lit("other").alias("repo"), F.lit("PASSED t9").alias("log")))
    rules = spark.createDataFrame([("r", "^(PASSED|FAILED) (t\\d+)$", 2, 1)], "repo string, pattern string, test_group int, status_group int")
    told = registries.outcomes_from_log(logs, rules)
    assert told.count() == 3999 and told.where("test = 't1' and outcome = 'failed'").count() == 1999
    plan = told._jdf.queryExecution().optimizedPlan().toString()
    assert "_share" in plan


def test_shuffles_start_as_wide_as_the_tables_call_for(spark, tmp_path, monkeypatch):
    spark.range(1000).write.parquet(str(tmp_path / "nation.parquet"))
    monkeypatch.setattr(registry, "SHARE_BYTES", 100)
    try:
        assert registry.frame(spark, str(tmp_path), "nation").count() == 1000
        assert int(spark.conf.get(registry.FIRST_PARTITIONS)) > 40
    finally:
        spark.conf.unset(registry.FIRST_PARTITIONS)
