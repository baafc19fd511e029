"""Runtime-behaviour samples: eligibility, ground truth and the published flat tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.functions.ids import make_sample_id
from runlens.operators import hotspots
from runlens.operators.filters import keep_target_tests
from runlens.operators.skew import first_row, top_n
from runlens.operators.traces import KEYS, gt_outcome, gt_peak_bytes, wall_ms

# Tasks, the metric of each, and the floor a timed test must reach.
METRICS = {
    "combined": "combined_task",
    "outcome": "outcome_combined",
    "peak_rss": "log10_mae",
    "wall_time": "log10_mae",
    "hot_methods_time": "hotspot_topk",
    "hot_methods_alloc": "hotspot_topk",
    "hot_lines_time": "hotspot_topk",
    "hot_lines_alloc": "hotspot_topk",
}
TASKS = list(METRICS)
HOT_TASKS = ["hot_methods_time", "hot_methods_alloc", "hot_lines_time", "hot_lines_alloc"]
TIMED_TASKS = ["wall_time", "combined", "peak_rss", *HOT_TASKS]
OUTCOME_TASKS = ["outcome", "combined"]
ALLOC_TASKS = ["hot_methods_alloc", "hot_lines_alloc", "peak_rss", "combined"]
LINE_TASKS = ["hot_lines_time", "hot_lines_alloc", "combined"]
WALL_FLOOR_S = 0.001


def with_signals(tests: DataFrame, functions: DataFrame, lines: DataFrame) -> DataFrame:
    """Which measurements each test has: functions, lines, allocation per function and per line."""
    return _with_figures(tests, functions, lines).select(*tests.columns, *SIGNALS)


SIGNALS = ["has_functions", "has_function_alloc", "has_lines", "has_line_alloc"]


def _with_figures(tests: DataFrame, functions: DataFrame, lines: DataFrame) -> DataFrame:
    """Signals, wall time and whether each hot list would hold anything, from one aggregate per table."""

    def any_positive(value: Column, task: str) -> Column:
        return F.bool_or(value > 0).alias(f"_any_{task}")

    of_functions = functions.groupBy(*KEYS).agg(
        F.lit(True).alias("has_functions"),
        F.bool_or(F.coalesce(F.col("exclusive_alloc_bytes") != 0, F.lit(False))).alias("has_function_alloc"),
        any_positive(F.coalesce("exclusive_time_s", F.lit(0.0)), "hot_methods_time"),
        any_positive(hotspots.exclusive_memory(), "hot_methods_alloc"),
        wall_ms().alias("wall_ms"),
    )
    of_lines = lines.groupBy(*KEYS).agg(
        F.lit(True).alias("has_lines"),
        F.bool_or(F.coalesce(F.col("alloc_bytes") != 0, F.lit(False))).alias("has_line_alloc"),
        any_positive(F.coalesce("time_ns", F.lit(0)), "hot_lines_time"),
        any_positive(hotspots.line_memory(), "hot_lines_alloc"),
    )
    joined = tests.join(of_functions, KEYS, "left").join(of_lines, KEYS, "left")
    for flag in SIGNALS:
        joined = joined.withColumn(flag, F.coalesce(flag, F.lit(False)))
    return joined


def eligible(task: str) -> Column:
    """Can a test with its signals produce a sample of this task?"""
    ok = ~F.coalesce("trimmed_by_events", F.lit(False))
    if task in TIMED_TASKS:
        ok = ok & (F.coalesce("wall_time_s", F.lit(0.0)) >= WALL_FLOOR_S)
    if task in OUTCOME_TASKS:
        ok = ok & F.col("outcome").isNotNull() & (F.col("outcome") != "skipped")
    if task == "peak_rss":
        traced = F.col("peak_traced_bytes").isNotNull() & F.col("start_traced_bytes").isNotNull()
        resident = F.col("peak_rss_bytes").isNotNull() & F.col("start_rss_bytes").isNotNull()
        ok = ok & (traced | resident)
    if task in ALLOC_TASKS:
        ok = ok & F.coalesce("tracemalloc_enabled", F.lit(False))
    if task == "hot_methods_alloc":
        ok = ok & F.col("has_function_alloc")
    if task == "hot_lines_alloc":
        ok = ok & F.col("has_line_alloc")
    if task in LINE_TASKS:
        ok = ok & F.col("has_lines")
    return F.coalesce(ok, F.lit(False))


def eligible_tasks(signalled: DataFrame, tasks: list[str] | None = None) -> DataFrame:
    """One row per (test, task) that qualifies."""
    flags = F.array_compact(F.array(*[F.when(eligible(t), F.lit(t)) for t in tasks or TASKS]))
    return signalled.withColumn("task", F.explode(flags))


def hot_truth(functions: DataFrame, lines: DataFrame, k: int = hotspots.TOP_K) -> DataFrame:
    """Ground-truth ranking of every sub-task, long: (instance, test, subtask, pos, name).

    One ranking over the functions and lines, each with both its values.
    """

    def entry(subtask: str, seconds: Column, amount: Column) -> Column:
        return F.struct(F.lit(subtask).alias("subtask"), seconds.alias("_seconds"), amount.alias("_amount"))

    no_seconds, no_amount = F.lit(None).cast("double"), F.lit(None).cast("long")
    of_functions = functions.select(
        *KEYS,
        F.col("func").alias("name"),
        F.col("pos").alias("_pos"),
        F.inline(
            F.array(
                entry("hot_methods_time", F.coalesce("exclusive_time_s", F.lit(0.0)).cast("double"), no_amount),
                entry("hot_methods_alloc", no_seconds, hotspots.exclusive_memory().cast("long")),
            )
        ),
    )
    of_lines = lines.select(
        *KEYS,
        hotspots.line_name().alias("name"),
        F.lit(None).cast(functions.schema["pos"].dataType).alias("_pos"),
        F.inline(
            F.array(
                entry("hot_lines_time", no_seconds, F.coalesce("time_ns", F.lit(0)).cast("long")),
                entry("hot_lines_alloc", no_seconds, hotspots.line_memory().cast("long")),
            )
        ),
    )
    rows = of_functions.unionByName(of_lines).where((F.col("_seconds") > 0) | (F.col("_amount") > 0))
    # A sub-task has one of the two; functions with equal values keep their order, lines go by name, descending.
    order = [F.col("_seconds").desc(), F.col("_amount").desc(), F.col("_pos"), F.col("name").desc()]
    ranked = top_n(rows, [*KEYS, "subtask"], order, k)
    return ranked.select(*KEYS, "subtask", (F.col("rank") - 1).alias("pos"), "name")


def build_samples(
    tests: DataFrame,
    functions: DataFrame,
    lines: DataFrame,
    targets: DataFrame,
    side: str = "post",
    tasks: list[str] | None = None,
) -> DataFrame:
    """Eligible (test, task) rows with scalar ground truth.

    Tests without functions or outside the target list are left out, and so is a single hot task
    whose list would be empty. The lists themselves stay long, in `hot_truth` and `value_tables`.
    """
    figures = _with_figures(keep_target_tests(tests, targets), functions, lines).where("has_functions")
    rows = eligible_tasks(figures, tasks)
    empty = F.coalesce(
        *[F.when(F.col("task") == t, ~F.coalesce(F.col(f"_any_{t}"), F.lit(False))) for t in HOT_TASKS], F.lit(False)
    )
    return rows.where(~empty).select(
        make_sample_id("instance_id", "test", "task", F.lit(side)).alias("sample_id"),
        "task",
        *KEYS,
        F.lit(side).alias("side"),
        *gt_outcome(),
        gt_peak_bytes().alias("gt_peak_bytes"),
        F.coalesce("wall_ms", F.lit(0.0)).alias("gt_wall_ms"),
        F.coalesce(*[F.when(F.col("task") == t, F.lit(m)) for t, m in METRICS.items()]).alias("metric"),
        "wall_time_s",
        "peak_rss_bytes",
        "peak_traced_bytes",
        "outcome",
    )


def benchmark_dataset(samples: DataFrame, truth: DataFrame, values: DataFrame) -> DataFrame:
    """One flat row per sample: ranked lists and value maps of its test laid out as columns."""
    lists = truth.groupBy(*KEYS).agg(
        *[
            F.transform(
                F.array_sort(F.collect_list(F.when(F.col("subtask") == t, F.struct("pos", "name")))),
                lambda item: item["name"],
            ).alias(f"ground_truth_{t}")
            for t in HOT_TASKS
        ]
    )
    maps = values.groupBy(*KEYS).agg(
        *[
            F.to_json(
                F.map_from_entries(
                    F.array_sort(F.collect_list(F.when(F.col("subtask") == t, F.struct("name", "value"))))
                )
            ).alias(f"values_{t}")
            for t in HOT_TASKS
        ]
    )
    return (
        samples.join(lists, KEYS, "left")
        .join(maps, KEYS, "left")
        .withColumn("env_id", F.concat_ws("::", "instance_id", "side"))
        .withColumn("wall_time_s", F.coalesce("wall_time_s", F.lit(0.0)))
        .withColumn("peak_rss_bytes", F.coalesce("peak_rss_bytes", F.lit(0)))
        .withColumn("peak_traced_bytes", F.coalesce("peak_traced_bytes", F.lit(0)))
    )


def environment_buckets(samples: DataFrame) -> DataFrame:
    """Tests passed and not passed per environment, each once, sorted, one row per environment."""
    tests = samples.select("instance_id", "side", "test", (F.col("gt_outcome") == "passed").alias("_passed")).distinct()
    return tests.groupBy("instance_id", "side").agg(
        F.array_sort(F.collect_list(F.when(F.col("_passed"), F.col("test")))).alias("tests_pass"),
        F.array_sort(F.collect_list(F.when(~F.col("_passed"), F.col("test")))).alias("tests_fail"),
    )


def environments(samples: DataFrame, instances: DataFrame) -> DataFrame:
    """One row per (instance, side) with instance details; the fixing patch only on the post side."""
    joined = environment_buckets(samples).join(instances, "instance_id", "left")
    blank = F.lit("")
    return joined.select(
        F.concat_ws("::", "instance_id", "side").alias("env_id"),
        "instance_id",
        "side",
        "repo",
        "base_commit",
        F.when(F.col("side") == "post", F.coalesce("patch", blank)).otherwise(blank).alias("patch"),
        F.coalesce("test_patch", blank).alias("test_patch"),
        F.coalesce("container", blank).alias("container"),
        F.coalesce("command", blank).alias("command"),
        "tests_pass",
        "tests_fail",
    )


def with_prompts(samples: DataFrame, prompts: DataFrame) -> DataFrame:
    """Stored prompt text by sample id, else the embedded one."""
    stored = prompts.select("sample_id", F.nullif(F.col("prompt"), F.lit("")).alias("_prompt"))
    joined = samples.join(stored, "sample_id", "left")
    return joined.withColumn("user_prompt", F.coalesce("_prompt", "user_prompt", F.lit(""))).drop("_prompt")


def match_trace_test(samples: DataFrame, tests: DataFrame) -> DataFrame:
    """Which trace test a sample reads: its own id, `session`, a bare id it starts with, the first one.

    Every rung is an equality join; for the third a sample offers its own prefixes, so samples and
    tests of one instance are never paired up. `tests(instance_id, test, pos)`.
    """
    exact = tests.select(*KEYS, F.col("test").alias("_exact"))
    sessions = tests.where(F.col("test") == "session").select("instance_id", F.lit("session").alias("_session")).distinct()
    step = samples.join(exact, KEYS, "left").join(sessions, "instance_id", "left")
    open_rows = step.where(F.col("_exact").isNull() & F.col("_session").isNull())
    bare = (
        tests.where(F.col("test") != "session")
        .groupBy("instance_id", F.substring_index("test", "[", 1).alias("_prefix"))
        .agg(F.min_by(F.struct("pos", "test"), F.col("pos")).alias("_found"))
    )
    # A sample offers only prefixes as long as some bare id of its instance.
    lengths = bare.groupBy("instance_id").agg(F.collect_set(F.length("_prefix")).alias("_lengths"))
    prefixes = open_rows.select("sample_id", "instance_id", "test").join(lengths, "instance_id")
    prefixes = prefixes.withColumn("_length", F.explode(F.filter("_lengths", lambda n: n <= F.length("test"))))
    prefixes = prefixes.withColumn("_prefix", F.expr("substring(test, 1, _length)"))
    hits = (
        prefixes.join(bare, ["instance_id", "_prefix"])
        .groupBy("sample_id")
        .agg(F.min("_found").alias("_found"))
        .select("sample_id", F.col("_found.test").alias("_by_prefix"))
    )
    first = tests.groupBy("instance_id").agg(F.min_by("test", "pos").alias("_first"))
    return (
        step.join(hits, "sample_id", "left")
        .join(first, "instance_id", "left")
        .withColumn("trace_test", F.coalesce("_exact", "_session", "_by_prefix", "_first"))
        .drop("_exact", "_session", "_by_prefix", "_first")
    )


TRACE_TEXTS = ["outcome"]
TRACE_SECONDS = ["wall_time_s", "setup_time_s", "call_time_s", "teardown_time_s"]
TRACE_BYTES = ["start_rss_bytes", "peak_rss_bytes", "start_traced_bytes", "peak_traced_bytes"]


def trace_dataset(samples: DataFrame, tests: DataFrame) -> DataFrame:
    """One row per sample with the record of its trace test; missing values get defaults."""
    matched = match_trace_test(samples.select("sample_id", "instance_id", "test", "side"), tests)
    columns = [c for c in [*TRACE_TEXTS, *TRACE_SECONDS, *TRACE_BYTES] if c in tests.columns]
    records = tests.select("instance_id", F.col("test").alias("trace_test"), *columns)
    joined = matched.join(records, ["instance_id", "trace_test"], "left")

    def default(name: str) -> Column:
        if name in TRACE_TEXTS:
            return F.coalesce(name, F.lit("")).alias(name)
        return F.coalesce(name, F.lit(0.0) if name in TRACE_SECONDS else F.lit(0)).alias(name)

    return joined.select(
        "sample_id",
        F.concat_ws("::", "instance_id", "side").alias("env_id"),
        "instance_id",
        "test",
        "side",
        "trace_test",
        *[default(c) for c in columns],
    )


def sample_manifest(samples: DataFrame, instances: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Samples and instances per task, and instances without any sample."""
    tasks = samples.groupBy("task").agg(
        F.count(F.lit(1)).alias("samples"), F.count_distinct("instance_id").alias("instances")
    )
    missing = instances.select("instance_id").distinct().join(samples, "instance_id", "left_anti")
    return tasks, missing


def overlay_sources(pre: DataFrame, post: DataFrame) -> DataFrame:
    """A file as it was before the fix where that snapshot has it, else as it is after."""
    a = pre.select("instance_id", "file", F.col("content").alias("_pre"))
    b = post.select("instance_id", "file", F.col("content").alias("_post"))
    joined = a.join(b, ["instance_id", "file"], "full")
    return joined.select("instance_id", "file", F.coalesce("_pre", "_post").alias("content"))


def first_samples(samples: DataFrame) -> DataFrame:
    """First sample per instance by id, where its repository and commit are read."""
    return first_row(samples, ["instance_id"], [F.col("sample_id")])
