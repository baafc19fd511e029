"""Trace tables: merging of profiling passes, ground truth, lookups."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.operators.hotspots import exclusive_memory, line_memory, line_name
from runlens.operators.skew import first_row

KEYS = ["instance_id", "test"]


def merge_walltime(tests: DataFrame, walltime: DataFrame) -> DataFrame:
    """Clean wall time replaces the traced one where it was measured."""
    clean = walltime.select(*KEYS, F.col("wall_time_s").alias("_wall"))
    return tests.join(clean, KEYS, "left").withColumn("wall_time_s", F.coalesce("_wall", "wall_time_s")).drop("_wall")


def merge_cprofile(functions: DataFrame, cprofile: DataFrame) -> DataFrame:
    """Profiled exclusive time replaces the traced one per function."""
    profiled = cprofile.select(*KEYS, "func", F.col("exclusive_time_s").alias("_time"))
    joined = functions.join(profiled, [*KEYS, "func"], "left")
    return joined.withColumn("exclusive_time_s", F.coalesce("_time", "exclusive_time_s")).drop("_time")


def merge_memprof_tests(tests: DataFrame, memprof: DataFrame) -> DataFrame:
    """Allocation baseline and peak per test."""
    fields = ["start_traced_bytes", "peak_traced_bytes"]
    measured = memprof.select(*KEYS, *[F.col(c).alias(f"_{c}") for c in fields])
    joined = tests.join(measured, KEYS, "left")
    for c in fields:
        joined = joined.withColumn(c, F.coalesce(f"_{c}", c)).drop(f"_{c}")
    return joined


def merge_memprof_functions(functions: DataFrame, memprof_functions: DataFrame) -> DataFrame:
    """Allocation per function: a match without a value becomes 0, no match keeps the traced value."""
    measured = memprof_functions.select(
        *KEYS, "func", F.coalesce("exclusive_alloc_peak_sum", F.lit(0)).alias("_alloc")
    )
    joined = functions.join(measured, [*KEYS, "func"], "left")
    return joined.withColumn("exclusive_alloc_bytes", F.coalesce("_alloc", "exclusive_alloc_bytes")).drop("_alloc")


def laid_out(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The same rows, those of a key together.

    They are folded to one row per key and unfolded again. A fold holds all columns, so every reader shares its one
    shuffle; what readers group and rank by the key, or by more, needs none.
    """
    rest = [c for c in rows.columns if c not in keys]
    folded = rows.groupBy(*keys).agg(F.collect_list(F.struct(*rest)).alias("_rows"))
    return folded.select(*keys, F.inline("_rows"))


class MergedPasses(NamedTuple):
    tests: DataFrame
    functions: DataFrame
    enriched: DataFrame
    orphans: DataFrame


def merge_passes(
    tests: DataFrame,
    functions: DataFrame,
    walltime: DataFrame | None = None,
    cprofile: DataFrame | None = None,
    memprof_tests: DataFrame | None = None,
    memprof_functions: DataFrame | None = None,
) -> MergedPasses:
    """All passes onto the main trace; each auxiliary pass is optional.

    `enriched` counts tests the memory pass covered per instance; `orphans` names instances with an
    auxiliary pass but no main trace.
    """
    instances = tests.select("instance_id").distinct()
    auxiliary = [p.select("instance_id") for p in (walltime, cprofile, memprof_tests) if p is not None]
    orphans = instances.where(F.lit(False))
    for part in auxiliary:
        orphans = orphans.unionByName(part)
    orphans = orphans.distinct().join(instances, "instance_id", "left_anti")
    enriched = instances.withColumn("enriched", F.lit(0).cast("long"))
    if memprof_tests is not None:
        covered = tests.select(*KEYS).join(memprof_tests.select(*KEYS), KEYS, "left_semi")
        counts = covered.groupBy("instance_id").agg(F.count(F.lit(1)).alias("_covered"))
        enriched = instances.join(counts, "instance_id", "left").select(
            "instance_id", F.coalesce("_covered", F.lit(0)).alias("enriched")
        )
        tests = merge_memprof_tests(tests, memprof_tests)
    if walltime is not None:
        tests = merge_walltime(tests, walltime)
    if cprofile is not None:
        functions = merge_cprofile(functions, cprofile)
    if memprof_functions is not None:
        functions = merge_memprof_functions(functions, memprof_functions)
    return MergedPasses(tests, functions, enriched, orphans)


def merge_outcomes(tests: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Observed outcomes onto trace tests; unknown tests are ignored, unmatched ones keep theirs."""
    observed = outcomes.select(*KEYS, F.col("outcome").alias("_outcome"))
    return tests.join(observed, KEYS, "left").withColumn("outcome", F.coalesce("_outcome", "outcome")).drop("_outcome")


TRACER_BACKENDS = ["setprofile", "settrace", "sysmon"]


def fill_outcomes(tests: DataFrame, graded: DataFrame) -> DataFrame:
    """Fill outcomes only where empty.

    Tracer-backed and session records that stay empty pass when every graded outcome of the instance
    passed, and fail otherwise.
    """
    known = graded.select(*KEYS, F.col("outcome").alias("_outcome"))
    overall = graded.groupBy("instance_id").agg(F.bool_and(F.col("outcome") == "passed").alias("_all_passed"))
    own = F.nullif(F.col("outcome"), F.lit(""))
    session = (F.col("test") == "session") | F.coalesce(F.col("backend").isin(TRACER_BACKENDS), F.lit(False))
    total = F.when(session & F.col("_all_passed").isNotNull(), F.when(F.col("_all_passed"), "passed").otherwise("failed"))
    return (
        tests.join(known, KEYS, "left")
        .join(overall, "instance_id", "left")
        .withColumn("outcome", F.coalesce(own, F.col("_outcome"), total))
        .drop("_outcome", "_all_passed")
    )


def fail_to_pass(outcomes: DataFrame, states: DataFrame) -> DataFrame:
    """Tests broken at the base and passing in any augmented sibling.

    `states(instance_id, base_ref, is_base)` places each state; one pass over the outcomes.
    """
    placed = outcomes.join(states.select("instance_id", "base_ref", "is_base"), "instance_id")
    flags = placed.groupBy("base_ref", "test").agg(
        F.bool_or(F.col("is_base") & F.col("status").isin("FAILED", "ERROR")).alias("_broken"),
        F.bool_or(~F.col("is_base") & (F.col("status") == "PASSED")).alias("_passes"),
    )
    return flags.where(F.col("_broken") & F.col("_passes")).select("base_ref", "test")


def wall_ms() -> Column:
    return F.sum(F.coalesce("exclusive_time_s", F.lit(0.0))) * 1000


def gt_wall_ms(functions: DataFrame) -> DataFrame:
    """Ground truth time: the sum of exclusive function times, in milliseconds."""
    return functions.groupBy(*KEYS).agg(wall_ms().alias("wall_ms"))


def gt_peak_bytes() -> Column:
    """The larger of the heap and the resident growth, each at least zero."""

    def growth(peak: str, start: str) -> Column:
        return F.greatest(F.lit(0), F.coalesce(F.col(peak), F.lit(0)) - F.coalesce(F.col(start), F.lit(0)))

    return F.greatest(growth("peak_traced_bytes", "start_traced_bytes"), growth("peak_rss_bytes", "start_rss_bytes"))


def gt_outcome() -> list[Column]:
    """Label, failing line and exception; details only for a failing test."""
    failing = F.col("outcome").isin("failed", "error")
    label = F.when(failing, F.when(F.coalesce("is_assertion", F.lit(False)), "failed").otherwise("error")).otherwise(
        F.col("outcome")
    )
    return [
        label.alias("gt_outcome"),
        F.when(failing, F.col("failure_line")).alias("gt_failure_line"),
        F.when(failing, F.nullif(F.col("exception_type"), F.lit(""))).alias("gt_exception"),
    ]


def executed_lines(lines: DataFrame, functions: DataFrame, keys: list[str]) -> DataFrame:
    """Lines that ran per file: line records and function first lines, one row each."""
    ran = lines.select(*keys, "file", F.col("line").cast("string").try_cast("bigint").alias("line"))
    starts = functions.select(*keys, "file", F.col("lineno").cast("string").try_cast("bigint").alias("line"))
    both = ran.unionByName(starts.where(F.length("file") > 0))
    return both.where(F.col("line").isNotNull()).distinct()


def trace_files(lines: DataFrame, functions: DataFrame, keys: list[str]) -> DataFrame:
    """Files a trace refers to."""
    both = lines.select(*keys, "file").unionByName(functions.select(*keys, "file"))
    return both.where(F.length("file") > 0).distinct()


def value_tables(functions: DataFrame, lines: DataFrame, keys: list[str]) -> DataFrame:
    """Name to value per sub-task, long. A function named twice counts with its last value.

    One pass over the functions and one over the lines: a row gives the entries of both its sub-tasks.
    """
    totals = functions.groupBy(*keys, F.col("func").alias("name")).agg(
        F.max_by(F.coalesce("exclusive_time_s", F.lit(0.0)), F.col("pos")).alias("_time"),
        F.max_by(exclusive_memory().cast("double"), F.col("pos")).alias("_memory"),
    )

    def entry(subtask: str, value: Column) -> Column:
        return F.struct(F.lit(subtask).alias("subtask"), value.cast("double").alias("value"))

    def entries(df: DataFrame, *found: Column) -> DataFrame:
        rows = df.select(*keys, "name", F.inline(F.array(*found)))
        return rows.select(*keys, "subtask", "name", "value")

    spots = lines.withColumn("name", line_name())
    of_lines = entries(spots, entry("hot_lines_time", F.coalesce("time_ns", F.lit(0))), entry("hot_lines_alloc", line_memory()))
    # The condition stays above the aggregation, so that other readers of the same functions share its shuffle.
    named = F.when(F.length("name") > 0, F.array(entry("hot_methods_time", F.col("_time")), entry("hot_methods_alloc", F.col("_memory"))))
    of_functions = totals.select(*keys, "name", F.inline(named)).select(*keys, "subtask", "name", "value")
    return of_functions.unionByName(of_lines.where(F.col("value") > 0))


def latest_run(documents: DataFrame) -> DataFrame:
    """Latest run per instance; a compressed document beats a plain one of the same run."""
    order = [F.col("run").desc(), F.col("compressed").desc(), F.col("path")]
    return first_row(documents, ["instance_id"], order)
