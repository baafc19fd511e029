import ast
import random

from pyspark.sql import functions as F

from runlens.operators import slicing


def make_source(rng):
    """A random module: statements, functions, classes with methods."""
    lines = []
    for i in range(rng.randrange(1, 7)):
        kind = rng.choice(["stmt", "def", "class", "blank", "deco"])
        body = [f"    x{j} = {j}" for j in range(rng.randrange(1, 4))]
        if kind == "stmt":
            lines.append(f"v{i} = 1")
        elif kind == "blank":
            lines += ["", "# note"]
        elif kind == "class":
            lines.append(f"class C{i}:")
            lines.append("    attr = 1")
            for m in range(rng.randrange(0, 3)):
                lines += [f"    def m{m}(self):", "        pass"] + ([""] if rng.random() < 0.5 else [])
        else:
            lines += (["@deco"] if kind == "deco" else []) + [f"def f{i}():"] + body
        if rng.random() < 0.4:
            lines.append("")
    return "\n".join(lines) + ("\n" if rng.random() < 0.7 else "")


def droppable(source, ran):
    """Spans a slice may leave out, by walking the tree."""
    def extent(node):
        return min([node.lineno] + [d.lineno for d in node.decorator_list]), node.end_lineno

    out = []
    for node in ast.parse(source).body:
        if isinstance(node, ast.FunctionDef):
            span = extent(node)
            out += [] if any(span[0] <= n <= span[1] for n in ran) else [span]
        elif isinstance(node, ast.ClassDef):
            span = extent(node)
            if not any(span[0] <= n <= span[1] for n in ran):
                out.append(span)
                continue
            methods = [extent(m) for m in node.body if isinstance(m, ast.FunctionDef)]
            out += [m for m in methods if not any(m[0] <= n <= m[1] for n in ran)]
    return sorted(out)


def brute(source, ran, budget):
    """Slice by keeping or dropping whole lines."""
    lines = source.split("\n")
    size = lambda a, b: sum(len(line) + 1 for line in lines[a - 1 : b]) - (b >= len(lines))
    spans = droppable(source, ran)
    essential = len(source) - sum(size(*s) for s in spans)
    used, dropped = essential, set()
    for a, b in spans:
        if used + size(a, b) <= budget:
            used += size(a, b)
        else:
            dropped |= set(range(a, b + 1))
    parts, n = [], 1
    while n <= len(lines):
        end = n
        while end + 1 <= len(lines) and ((end + 1) in dropped) == (n in dropped):
            end += 1
        if n in dropped:
            parts.append(f"# ... [{end - n + 1} lines elided: original lines {n}-{end}]")
        else:
            text = "\n".join(lines[n - 1 : end]) + ("\n" if end < len(lines) else "")
            parts.append(text[:-1] if text.endswith("\n") else text)
        n = end + 1
    return "\n".join(parts) + "\n", essential, sum(n not in dropped for n in ran)


def cases(rng, n):
    out = []
    for i in range(n):
        source = make_source(rng)
        while not source.strip():
            source = make_source(rng)
        total = source.count("\n") + 1
        out.append((f"f{i}", source, sorted(rng.sample(range(1, total + 1), min(total, rng.randrange(0, 3))))))
    return out


def frames(spark, data, sample=lambda i: "s"):
    files = spark.createDataFrame([(f, s) for f, s, _ in data], "file_id string, content string")
    executed = spark.createDataFrame([(sample(i), f, ran) for i, (f, _, ran) in enumerate(data)], "sample_id string, file_id string, lines array<int>")
    return files, executed.withColumn("shuffle_key", F.md5(F.concat_ws("|", "sample_id", "file_id")))


def test_slices_match_brute_force(spark):
    data = cases(random.Random(4), 40)
    files, executed = frames(spark, data)
    for budget in (0, 60, 10_000):
        got = {r["file_id"]: r for r in slicing.slice_sources(files, executed, budget).collect()}
        assert len(got) == len(data)
        for name, source, ran in data:
            text, essential, kept = brute(source, ran, budget)
            r = got[name]
            assert (r["slice"], r["essential_chars"], r["exec_in_kept"]) == (text, essential, kept), (name, source)
            assert r["kept_chars"] == len(text) and r["essential_over_budget"] == (essential > budget)


def test_files_that_are_no_python_stay_whole(spark):
    data = [("bad", "def (:\n", [1]), ("blank", " \n", [])]
    files, executed = frames(spark, data)
    got = {r["file_id"]: r for r in slicing.slice_sources(files, executed, 1).collect()}
    assert got["bad"]["slice"] == "def (:\n" and got["bad"]["parse_fail"] and got["bad"]["exec_in_kept"] == 1
    assert got["blank"]["slice"] == " \n" and got["blank"]["kept_chars"] == 0 and not got["blank"]["parse_fail"]


def test_running_budget_matches_the_sequential_rule(spark):
    data = cases(random.Random(9), 30) + [("zbad", "def (:\n" * 5, [1])]
    files, executed = frames(spark, data, lambda i: f"s{i % 3}")
    starts = spark.createDataFrame([("s0", 0), ("s1", 50), ("s2", 400)], "sample_id string, start_chars int")
    budget = 300
    flagged, stats = slicing.smart_context(starts, files, executed, budget)
    got = {(r["sample_id"], r["file_id"]): r for r in flagged.collect()}
    keys = {(r["sample_id"], r["file_id"]): r["shuffle_key"] for r in executed.collect()}
    totals = {}
    for sample, start in (("s0", 0), ("s1", 50), ("s2", 400)):
        used, over = start, 0
        mine = sorted([d for i, d in enumerate(data) if f"s{i % 3}" == sample], key=lambda d: keys[(sample, d[0])])
        for name, source, ran in mine:
            remaining = max(0, budget - used)
            if name == "zbad":
                text, is_over = source, False
            else:
                text, essential, _ = brute(source, ran, remaining)
                is_over = essential > remaining
            is_over = is_over or used + len(text) > budget
            r = got[(sample, name)]
            assert r["slice"] == text and r["over_budget"] == is_over, (sample, name)
            used += len(text)
            over += is_over
        totals[sample] = (used, over, used > budget)
    assert {r["sample_id"]: (r["total_chars"], r["n_files_over_budget"], r["budget_exceeded"]) for r in stats.collect()} == totals


def test_long_test_files_are_carved_around_their_target(spark):
    filler = "".join(f"# line {i:06d}\n" for i in range(8000))
    late = filler + "def test_x():\n    pass\n" + filler
    early = "def test_x():\n    pass\n" + filler
    data = [("late", late, "a.py::T::test_x[1]"), ("early", early, "test_x (m.T)"), ("lost", filler, "test_x"), ("short", "def test_x(): 1\n", "test_x")]
    df = spark.createDataFrame(data, "name string, content string, test string")
    got = {r["name"]: r["window"] for r in slicing.carve_window(df, 60_000, 8_000, 50_000).collect()}
    assert got["short"] == "def test_x(): 1\n"
    assert got["lost"].startswith(filler[:60000]) and got["lost"].endswith("target `test_x` not located]\n")
    assert got["early"].startswith(early[:25000]) and "truncated past byte" in got["early"]
    assert "\ndef test_x():\n    pass\n" in got["late"] and "chars]\n# line" in got["late"] and "trailing chars]" in got["late"]
    head = got["late"].split("\n# ... [skipped")[0]
    assert late.startswith(head) and 8000 <= len(head) < 8030 and late[len(head)] == "\n"
    skipped = int(got["late"].split("[skipped ")[1].split(" ")[0])
    trailing = int(got["late"].split("[skipped ")[2].split(" ")[0])
    middle = got["late"].split(" chars]\n", 1)[1].rsplit("\n# ... [skipped", 1)[0]
    assert len(head) + skipped + len(middle) + trailing == len(late)


def test_optional_ranges_skip_and_go_on(spark):
    df = spark.createDataFrame([([(1, 1, 50), (2, 2, 70), (3, 3, 40), (4, 4, 10)],)], "r array<struct<first:int,last:int,chars:int>>")
    filled = df.select(slicing.fill_budget("r", F.lit(0), F.lit(100)).alias("x")).first()["x"]
    assert filled["used"] == 100 and [s["first"] for s in filled["left"]] == [2]


def test_files_reach_python_in_batches_of_bounded_size(spark):
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(limit)
    files = spark.range(40, numPartitions=1).select(
        F.concat(F.lit("f"), "id").alias("file_id"), F.concat(F.lit("def a():\n    return '"), F.repeat(F.lit("x"), 300_000), F.lit("'\n")).alias("content")
    )
    spans = slicing.definition_spans(files)
    assert int(spark.conf.get(limit)) <= 4 << 20
    assert spans.where("parsed and size(spans) = 1").count() == 40
