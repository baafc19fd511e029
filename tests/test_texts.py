import json
import shlex

from pyspark.sql import functions as F

from runlens.functions import commands, ids, patches, responses, testnames, texts


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column.alias("y")).first()["y"]


def test_ids(spark):
    for text, ok in [("a__b__base", True), ("a__b", True), ("a", False), ("a____b", False), ("a__b c", False), ("a__b\n", False)]:
        assert one(spark, text, ids.valid_instance_id("x")) is ok, text
    assert one(spark, "a__b__base__::__x__y", ids.valid_pair_id("x")) is True
    assert one(spark, "a__b__::__x__::__y", ids.valid_pair_id("x")) is False
    assert one(spark, "a__b__::__", ids.valid_pair_id("x")) is False
    assert one(spark, "f__c__ruff__format", ids.make_pair_id(F.lit("f__c__base"), "x")) == "f__c__base__::__ruff__format"
    assert one(spark, "a__b__base", ids.is_base_by_id("x")) is True
    assert one(spark, "a__b__base__x", ids.is_base_by_id("x")) is False
    assert one(spark, "own__re-po-64", ids.trailing_number("x")) == 64
    assert one(spark, "own__re-po-0", ids.trailing_number("x")) is None
    assert one(spark, "ghcr.io/foo/hvac__09902dea@sha256:1", ids.stem_from_image("x")) == "hvac__09902dea"
    assert one(spark, 'git clone "https://github.com/o/n.git"', ids.repo_from_text("x")) == "o/n"
    assert one(spark, "ftp://x", ids.normalize_uri("x")) is None
    assert len(one(spark, "Run Name " * 20, ids.bounded_name("p", "x", 40))) == 40


def test_node_ids(spark):
    cases = [
        ("tests/test_m.py", "tests.test_m", "test_f", "tests/test_m.py::test_f"),
        ("tests/test_m.py", "tests.test_m.TestA.TestB", "test_f", "tests/test_m.py::TestA::TestB::test_f"),
        (None, "tests.test_m.TestA", "test_f[a::b]", "tests/test_m.py::TestA::test_f[a::b]"),
        (None, "tests.test_m", "test_f", "tests/test_m.py::test_f"),
        ("tests/test_m.py", "elsewhere", "t", "tests/test_m.py::elsewhere::t"),
        (None, "TestOnly", "t", "::TestOnly::t"),
    ]
    df = spark.createDataFrame(cases, "f string, c string, n string, want string")
    for r in df.select("want", testnames.node_id("f", "c", "n").alias("got")).collect():
        assert r["got"] == r["want"]


def test_patch_repair(spark):
    a = "diff --git a/x.py b/x.py\n--- a/x.py\n+++ b/x.py\n@@ -1 +1 @@\n-a\n+b\n"
    stray = "diff --git a/2024-05-06 07:08 b/2024-05-06 07:08\nnew file mode\n"
    t = "diff --git a/tests/test_x.py b/tests/test_x.py\n--- a/tests/test_x.py\n+++ b/tests/test_x.py\n@@ -1 +1 @@\n+c\n"
    assert one(spark, stray + a.rstrip("\n"), patches.normalize_patch("x")) == a
    assert one(spark, a + t, patches.filter_test_sections("x")) == a
    mounted = a.replace("a/x.py", "a/golden_app/x.py").replace("b/x.py", "b/testbed/x.py")
    binary = "diff --git a/golden_app/b.bin b/testbed/b.bin\nBinary files differ\n"
    assert one(spark, mounted + binary, patches.normalize_paths("x")) == a
    assert one(spark, a, patches.concat_patches("x", F.lit(None).cast("string"), F.lit("z"))) == a + "z\n"
    assert one(spark, "", patches.concat_patches("x")) is None
    assert one(spark, a + t, patches.patch_dirs("x")) == ["tests", "x.py"]
    assert one(spark, "--- a/p/q.py\n+++ /dev/null\n", patches.scope_from_patch("x")) == ["p/q.py"]
    assert one(spark, "nothing", patches.scope_from_patch("x")) == ["tests/"]
    offset = a.replace("@@ -1 +1 @@", "@@ -9 +12 @@ def f")
    same = one(spark, a + t, patches.diff_fingerprint("x")) == one(spark, t + offset, patches.diff_fingerprint("x"))
    assert same and one(spark, " \n", patches.diff_fingerprint("x")) is None


def test_runner_call(spark):
    install = "python -m pip install -q pytest 1>&2 && python -m pytest -rA sympy"
    args = F.array(F.lit("a.py::t[x='1']"), F.lit("b"))
    got = one(spark, install, commands.insert_args("x", args))
    assert got == "python -m pip install -q pytest 1>&2 && python -m pytest " + shlex.join(["a.py::t[x='1']", "b"]) + " -rA sympy"
    assert one(spark, "pip install pytest pytest-cov && make", commands.insert_args("x", args)) is None
    assert one(spark, "pytest", commands.insert_args("x", F.array().cast("array<string>"))) == "pytest"
    assert one(spark, "a\n: START\nrun\n\n: END\nz", commands.command_between("x", "START", "END")) == "run"
    assert one(spark, ": END\n: START\nrun", commands.command_between("x", "START", "END")) is None
    made = one(spark, "bash -c 'cd /app && pytest -x tests'", commands.generated_command("x", F.lit("def t(): pass\n\n")))
    assert made.startswith("cat > /tmp/test_workload.py <<'PYEOF'\ndef t(): pass\nPYEOF\nbash -c 'cd /app && pytest /tmp")
    assert one(spark, "pytest tests", commands.generated_command("x", F.lit("x"))) is None


def test_timing_text(spark):
    text = "Before Mean: 9\n  Mean: 1.5\nStd Dev: 0.25\n"
    row = spark.createDataFrame([(text,)], "x string").select(*texts.parse_timing_text("x", tail=5)).first()
    assert (row["workload_mean_s"], row["workload_stdev_s"], row["stdout_truncated"], row["stdout"]) == (1.5, 0.25, True, text[-5:])


ANSWERS = {
    '{"outcome": "passed"}': {"outcome": "passed"},
    '```json\n{"a": 1}\n```': {"a": 1},
    "<think>{}</think>\n{\"a\": 2}": {"a": 2},
    '{"a": 1, // why\n "b": 2}': {"a": 1, "b": 2},
    'Looking at {x: y} code\n```json\n{"a": 3}\n```\nbye': {"a": 3},
    'text\n```python\n"peak_bytes": 5,\n"wall_ms": 1\n```': {"peak_bytes": 5, "wall_ms": 1},
    'first {"a": 1} then {"a": 4} done {}': {"a": 4},
    '{"reasoning": "it "breaks" here", "outcome": "failed"}': {"outcome": "failed", "reasoning": ""},
    "no answer": None,
    "": None,
    "[1, 2]": None,
}


def test_response_ladder(spark):
    df = spark.createDataFrame([(k,) for k in ANSWERS], "raw_response string")
    for r in responses.parse_responses(df).collect():
        want = ANSWERS[r["raw_response"]]
        got = json.loads(r["parsed"]) if r["parsed"] and want is not None and "//" not in r["parsed"] else r["parsed"]
        assert got == want, r


def test_extraction_is_defensive(spark):
    data = [
        ("combined", '{"outcome": " failed ", "failure_line": "x", "peak_bytes": 12.7, "wall_ms": "3.5", "hot_lines_time": "no", "exception_type": 5}'),
        ("peak_rss", '{"bytes": "12.5"}'),
        ("peak_rss", '{"bytes": "12"}'),
        ("wall_time", '{"seconds": 2}'),
        ("wall_time", '{"milliseconds": 7, "seconds": 2}'),
        ("hot_methods_alloc", '{"functions": ["a", 1]}'),
        ("outcome", None),
    ]
    df = spark.createDataFrame(data, "task string, parsed string")
    got = responses.extract_prediction(df).collect()
    first = got[0]
    assert (first["pred_outcome"], first["pred_failure_line"], first["pred_peak"], first["pred_wall"]) == ("failed", None, 12, 3.5)
    assert first["pred_hot_lines_time"] is None and first["pred_exception"] is None
    assert [r["pred_peak"] for r in got[1:3]] == [None, 12]
    assert [r["pred_wall"] for r in got[3:5]] == [2000.0, 7.0]
    assert got[5]["pred_hot_methods_alloc"] == ["a", "1"]
    assert got[6]["pred_outcome"] is None


def test_generated_files(spark):
    good = "# SCALE: x\n```python\ndef test_a():\n    pass\n```"
    data = {
        good: None,
        good.replace("pass", "import timeit"): "timing harness not stripped",
        good.replace("test_a", "test_b"): "missing test functions: test_a",
        good.replace("# SCALE", "# OTHER"): "no `# SCALE:` header anywhere in the response",
        good.replace("():", "("): "code does not parse",
        "not code (": "no fenced code block and response is not bare Python",
        "# SCALE: y\ndef test_a(): pass": None,
    }
    df = spark.createDataFrame([(k,) for k in data], "text string")
    for r in responses.check_generated(df, "# SCALE:", ["test_a"], "timeit").collect():
        assert r["problem"] == data[r["text"]], r


def test_runner_after_very_many_install_arguments(spark):
    many = "pip install " + "pkg-name[x]==1.0 " * 20_000
    df = spark.createDataFrame([(many + "pytest",), (many + "&& pytest -q",), (many,)], "command string")
    parts = df.select(commands.runner_parts("command").alias("p")).collect()
    assert parts[0]["p"] is None and parts[2]["p"] is None
    assert parts[1]["p"]["upto"] == many + "&& pytest" and parts[1]["p"]["after"] == " -q"
