"""Runs: remaining work, triage of finished rows, status, ledgers and totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The failure synthesized for a row that left nothing behind.
MISSING_CATEGORY = "infrastructure"
MISSING_STAGE = "materialize"
MISSING_REASON = "missing_worker_artifact"
MISSING_MESSAGE = "worker reached a terminal state without result.json or failure.json"
NO_OUTPUT_MESSAGE = "no tracer unit produced output for this row"


def remaining(items: DataFrame, done: DataFrame, key: str = "instance_id") -> DataFrame:
    """Items not finished yet, in (kind, repository, id) order."""
    return items.join(done.select(key), key, "left_anti").orderBy("kind", "repo", key)


def _failure(message: str, when: Column) -> list[Column]:
    parts = {
        "category": MISSING_CATEGORY,
        "stage": MISSING_STAGE,
        "reason": MISSING_REASON,
        "message": message,
    }
    return [F.when(when, F.coalesce(F.col(name), F.lit(text))).alias(name) for name, text in parts.items()]


def triage_run(rows: DataFrame, results: DataFrame, failures: DataFrame) -> DataFrame:
    """Outcome of every row of a run: passed through, result, failure, or a synthesized failure.

    `rows(instance_id, input_index, needs_cluster, payload)` holds the input rows.
    """
    done = results.select("instance_id", F.col("payload").alias("_result"))
    failed = failures.select("instance_id", "category", "stage", "reason", "message", F.lit(True).alias("_failed"))
    joined = rows.join(done, "instance_id", "left").join(failed, "instance_id", "left")
    verdict = (
        F.when(~F.col("needs_cluster"), "passthrough")
        .when(F.col("_result").isNotNull(), "result")
        .when(F.col("_failed"), "failure")
        .otherwise("missing")
    )
    lost = verdict.isin("failure", "missing")
    return joined.select(
        "instance_id",
        "input_index",
        verdict.alias("verdict"),
        F.when(verdict == "passthrough", F.col("payload")).when(verdict == "result", F.col("_result")).alias("payload"),
        *_failure(MISSING_MESSAGE, lost),
    ).orderBy("input_index")


def triage_trace_run(units: DataFrame, outputs: DataFrame) -> DataFrame:
    """Tracer outputs per row over its units; a row no unit produced anything for fails."""
    found = outputs.select("instance_id", "tracer").distinct().withColumn("_found", F.lit(1))
    joined = units.join(found, ["instance_id", "tracer"], "left")
    per_row = joined.groupBy("instance_id").agg(
        F.count(F.lit(1)).alias("units"),
        F.coalesce(F.sum("_found"), F.lit(0)).alias("outputs"),
        F.coalesce(F.max(F.when(F.col("tracer") == "trace", F.col("_found"))), F.lit(0)).alias("_trace"),
    )
    ok = F.col("outputs") > 0
    return per_row.select(
        "instance_id",
        "units",
        "outputs",
        ok.alias("ok"),
        (F.col("_trace") > 0).alias("merges"),
        F.when(~ok, F.lit(MISSING_REASON)).alias("reason"),
    )


def job_state(complete: Column, failed: Column, active: Column) -> Column:
    """Queued work has no condition and no active pod, so it counts as pending."""
    return (
        F.when(F.coalesce(complete, F.lit(False)), "succeeded")
        .when(F.coalesce(failed, F.lit(False)), "failed")
        .when(F.coalesce(active, F.lit(0)) > 0, "active")
        .otherwise("pending")
    )


JOB_STATES = ["pending", "active", "succeeded", "failed"]


def run_status(jobs: DataFrame, pods: DataFrame) -> DataFrame:
    """Jobs by component and state and pods by phase, long, with an unfinished flag per run."""
    counted = jobs.groupBy("run", F.concat_ws("_", "component", "state").alias("counter")).agg(
        F.count(F.lit(1)).alias("n"), F.bool_or(F.col("state").isin("pending", "active")).alias("_open")
    )
    of_pods = pods.groupBy("run", F.concat(F.lit("pod_"), F.lower("phase")).alias("counter")).agg(
        F.count(F.lit(1)).alias("n"), F.lit(False).alias("_open")
    )
    both = counted.unionByName(of_pods)
    unfinished = counted.groupBy("run").agg(F.bool_or("_open").alias("unfinished"))
    return both.drop("_open").join(unfinished, "run", "left").withColumn(
        "unfinished", F.coalesce("unfinished", F.lit(False))
    )


def collect_summary(states: DataFrame, failures: DataFrame) -> DataFrame:
    """Rows filled, skipped and failed. `states(instance_id, was_filled, is_filled)`."""
    failed = failures.select("instance_id").distinct().withColumn("_failed", F.lit(True))
    joined = states.join(failed, "instance_id", "left")
    lost = F.coalesce("_failed", F.lit(False))
    return joined.agg(
        F.count_if(~lost & ~F.col("was_filled") & F.col("is_filled")).alias("ok"),
        F.count_if(~lost & F.col("was_filled")).alias("skip"),
        F.count_if(lost).alias("fail"),
    )


def cost_totals(log: DataFrame, keys: list[str]) -> DataFrame:
    """Tokens and cost of a generation log; a missing cost counts as nothing."""
    return log.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("calls"),
        *[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in ("input_tokens", "output_tokens", "cost_usd")],
    )


def failure_counts(failures: DataFrame) -> DataFrame:
    return failures.groupBy("category", "stage", "reason").agg(F.count(F.lit(1)).alias("rows"))


def pass_ledger(passes: DataFrame, outputs: DataFrame) -> DataFrame:
    """One row per (instance, tracer) with its status demoted when the output is unusable.

    `outputs(instance_id, tracer, readable, test_count)` lists what was written.
    """
    written = outputs.select("instance_id", "tracer", "readable", F.col("test_count").alias("_tests"))
    joined = passes.join(written, ["instance_id", "tracer"], "left")
    status = (
        F.when((F.col("status") == "ok") & F.col("readable").isNull(), "no_output")
        .when((F.col("status") == "ok") & ~F.col("readable"), "invalid_output")
        .otherwise(F.col("status"))
    )
    usable = F.coalesce("readable", F.lit(False))
    return joined.select(
        "instance_id",
        "tracer",
        status.alias("status"),
        usable.alias("ok"),
        "duration_s",
        F.when(usable, F.col("_tests")).otherwise(0).cast("long").alias("test_count"),
        "host",
    )


def ledger_totals(ledger: DataFrame) -> DataFrame:
    """Passes, usable outputs, tests and time per tracer."""
    return ledger.groupBy("tracer").agg(
        F.count(F.lit(1)).alias("passes"),
        F.count_if("ok").alias("usable"),
        F.sum("test_count").alias("tests"),
        F.sum("duration_s").alias("duration_s"),
    )
