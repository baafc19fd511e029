"""User-supplied metrics, ground truths and outcome providers, kept by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.operators import scoring, traces
from runlens.operators.outcomes import unfold_outcomes

METRICS: dict[str, Callable[..., DataFrame]] = {}
GROUND_TRUTHS: dict[str, Callable[..., DataFrame]] = {}
PROVIDERS: dict[str, Callable[..., DataFrame]] = {}


def register_metric(task: str, score: Callable[..., DataFrame]) -> None:
    METRICS[task] = score


def register_ground_truth(task: str, extract: Callable[..., DataFrame]) -> None:
    GROUND_TRUTHS[task] = extract


def register_provider(name: str, provide: Callable[..., DataFrame]) -> None:
    PROVIDERS[name] = provide


def score(task: str, *frames: DataFrame) -> DataFrame:
    """Score with the metric of a task; an unknown task is an error."""
    if task not in METRICS:
        raise KeyError(f"no metric for {task!r}; known: {sorted(METRICS)}")
    return METRICS[task](*frames)


def ground_truth(task: str, *frames: DataFrame) -> DataFrame:
    if task not in GROUND_TRUTHS:
        raise KeyError(f"no ground truth for {task!r}; known: {sorted(GROUND_TRUTHS)}")
    return GROUND_TRUTHS[task](*frames)


def outcomes_of(name: str, *frames: DataFrame) -> DataFrame:
    if name not in PROVIDERS:
        raise KeyError(f"no outcome provider {name!r}; known: {sorted(PROVIDERS)}")
    return PROVIDERS[name](*frames)


def outcomes_from_states(states: DataFrame) -> DataFrame:
    """Outcomes a state row already carries, labels in lower case."""
    return unfold_outcomes(states).select("instance_id", "test", F.lower("status").alias("outcome"))


# Shares that the logs of one repository are dealt into.
SHARES = 256


def outcomes_from_log(logs: DataFrame, rules: DataFrame) -> DataFrame:
    """Outcomes from run logs by one line pattern per repository.

    `logs(instance_id, repo, log)`; `rules(repo, pattern, test_group, status_group)` holds Java
    patterns and is a registry the user maintains. The last line about a test decides. Repositories
    without a rule give no rows; `logs_without_rule` names them.
    """
    # Each log meets the rules of its repository whole, in one of many shares of that repository.
    dealt = logs.select("instance_id", "repo", "log", F.pmod(F.xxhash64("instance_id", "log"), F.lit(SHARES)).alias("_share"))
    spread = rules.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1)).cast("array<bigint>")))
    ruled = dealt.join(spread, ["repo", "_share"]).drop("_share")
    lines = ruled.select("*", F.posexplode(F.split("log", "\r\n|\n")).alias("at", "line")).drop("log")
    matched = lines.where(F.expr("line rlike pattern"))
    told = matched.select(
        "instance_id",
        "at",
        F.expr("regexp_extract(line, pattern, test_group)").alias("test"),
        F.lower(F.expr("regexp_extract(line, pattern, status_group)")).alias("outcome"),
    )
    return told.groupBy("instance_id", "test").agg(F.max_by("outcome", "at").alias("outcome"))


def logs_without_rule(logs: DataFrame, rules: DataFrame) -> DataFrame:
    return logs.join(rules, "repo", "left_anti").select("instance_id", "repo")


register_metric("outcome", lambda responses: responses.select("*", *scoring.score_outcome()))
register_metric("peak_rss", lambda responses: responses.select("*", *scoring.score_numeric("peak")))
register_metric("wall_time", lambda responses: responses.select("*", *scoring.score_numeric("wall")))
register_metric("hot", scoring.score_hot)
register_ground_truth("outcome", lambda tests: tests.select(*traces.KEYS, *traces.gt_outcome()))
register_ground_truth("peak_rss", lambda tests: tests.select(*traces.KEYS, traces.gt_peak_bytes().alias("peak_bytes")))
register_ground_truth("wall_time", traces.gt_wall_ms)
register_provider("states", outcomes_from_states)
register_provider("log", outcomes_from_log)
