"""The four prediction datasets, each one lazy plan from states to rows.

Draws run on narrow keys (group, state, test); wide columns are joined back to the drawn rows only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.functions import prompts
from runlens.operators import filters, sampling
from runlens.operators.hotspots import rank_hotspots
from runlens.operators.outcomes import list_conflict_keys, unfold_outcomes
from runlens.schemas import STATUS_FIELDS
from runlens.session import reliable_checkpoint

COPIED = ["instance_id", "repo", "base_commit", "patch", "container", "command"]
COPIED_WORKLOAD = ["instance_id", "repo", "base_commit", "patch", "container", "command_workload"]


def standard_rules(known: DataFrame) -> list[filters.Rule]:
    """What both test-status builds leave out, in this order."""
    return [
        filters.without_group(),
        filters.without_outcomes(),
        filters.container_conflicts(),
        filters.unknown_groups(known),
        filters.groups_without_variant("base"),
    ]


NARROW = ["instance_id", "repo", "base_commit", "container", "group_id", "variant", "row_index", "has_outcomes"]


def narrow_states(states: DataFrame) -> DataFrame:
    """Scalar columns the filters and draws work on; list columns are only looked at for emptiness."""
    flag = filters.has_entries("passed_tests", "failed_tests", "errored_tests")
    return states.select(*NARROW[:-1], flag.alias("has_outcomes"))


def filter_states(narrow: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Kept and dropped scalar rows, decided in one pass over them.

    The kept ones are a few scalars per state and feed several draws, so they are checkpointed, not decided again.
    """
    kept, dropped = filters.filter_chain(narrow, standard_rules(known))
    return reliable_checkpoint(kept), dropped


def source_outcomes(states: DataFrame, kept: DataFrame) -> DataFrame:
    """Long outcomes of the kept states. A test a state reports twice differently is refused.

    Reported statuses are passed, failed and errored; a skipped entry never conflicts.
    """
    lists = states.select("instance_id", *STATUS_FIELDS).join(kept.select("instance_id"), "instance_id", "left_semi")
    lists = lists.withColumn("skipped_tests", F.array().cast("array<string>"))
    return unfold_outcomes(lists)


def conflicting_states(states: DataFrame) -> DataFrame:
    """States a test-status build has to refuse; writers check that this is empty."""
    return list_conflict_keys(states.withColumn("skipped_tests", F.array().cast("array<string>")))


def single_test_draw(outcomes: DataFrame, states: DataFrame, rows: int = 2, seed: int = 0) -> DataFrame:
    """Drawn (state, test) rows with the state's label and the reference labels."""
    drawn = sampling.draw_test(sampling.agreement(outcomes, states), seed)
    return sampling.draw_states(outcomes, states, drawn, rows, seed).withColumnRenamed("status", "label")


def build_single_test_status(states: DataFrame, known: DataFrame, rows: int = 2, seed: int = 0) -> DataFrame:
    """One test per group, asked about up to two of its states."""
    kept, _ = filter_states(narrow_states(states), known)
    outcomes = source_outcomes(states, kept)
    drawn = single_test_draw(outcomes, kept, rows, seed)
    wide = states.select(*COPIED)
    return wide.join(drawn, "instance_id").select(
        *COPIED,
        "test",
        "label",
        "base_label",
        "fixed_label",
        *prompts.constants({**prompts.SINGLE_TEST_QUESTIONS, "labels_description": prompts.LABELS_DESCRIPTION}),
    )


def build_test_status_anchored(
    states: DataFrame, known: DataFrame, rows: int = 2, tests: int = 100, seed: int = 0
) -> DataFrame:
    """Up to two states per group, each with up to 100 tests and parallel labels.

    The list per row is bounded by `tests`, so gathering it is safe for any group size.
    """
    kept, _ = filter_states(narrow_states(states), known)
    outcomes = source_outcomes(states, kept)
    picked = sampling.draw_uniform(kept, rows, seed)
    asked = sampling.draw_tests(outcomes, kept, picked, tests, seed)
    gathered = asked.groupBy("instance_id").agg(
        F.array_sort(F.collect_list(F.struct("test", "status"))).alias("_asked")
    )
    return states.select(*COPIED).join(gathered, "instance_id").select(
        *COPIED,
        F.col("_asked.test").alias("tests"),
        F.col("_asked.status").alias("labels"),
        *prompts.constants({**prompts.ANCHORED_QUESTIONS, "labels_description": prompts.LABELS_DESCRIPTION}),
    )


def build_time_prediction(states: DataFrame, times: DataFrame, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Seconds, buckets and budgets per timed state; times no ladder holds are the second frame."""
    kept, _ = filters.filter_chain(
        states.select("instance_id", "group_id", "variant"), [filters.without_group(), filters.without_profile(times)]
    )
    timed = kept.select("instance_id").join(times.select("instance_id", "time_s"), "instance_id")
    drawn, lost = sampling.draw_buckets(timed, "instance_id", "time_s", seed)
    labels = prompts.bucket_labels("dividers")
    rows = states.select(*COPIED_WORKLOAD).join(drawn, "instance_id").select(
        *COPIED_WORKLOAD,
        F.col("time_s").alias("workload_time_s"),
        F.col("dividers").alias("buckets"),
        F.get(labels, F.col("correct")).alias("bucket"),
        prompts.bucket_prompt(labels).alias("Q-bucket"),
        *prompts.constants(prompts.TIME_QUESTIONS),
    )
    return rows, lost


FUNCTION_FIELDS = ["key", "filename", "firstlineno", "qualname", "exclusive_time_s", "call_count"]


def _top_questions() -> list[Column]:
    return prompts.constants(
        {f"Q-top{n}": prompts.TOP_QUESTION.format(n=n, plural="" if n == 1 else "s") for n in prompts.TOP_N}
    )


def build_time_hotspot(states: DataFrame, workloads: DataFrame, functions: DataFrame) -> DataFrame:
    """Ranked hotspots and the function pool they were ranked out of, one row per state."""
    usable, _ = filters.usable_profiles(functions, workloads)
    kept, _ = filters.filter_chain(
        states.select("instance_id", "group_id", "variant"), [filters.without_group(), filters.without_profile(usable)]
    )
    pool = functions.where(filters.is_repo_source("filename")).join(kept.select("instance_id"), "instance_id", "left_semi")
    record = F.struct(*FUNCTION_FIELDS)
    hotspots = (
        rank_hotspots(pool, max(prompts.TOP_N))
        .groupBy("instance_id")
        .agg(F.array_sort(F.collect_list(F.struct("rank", record.alias("function")))).alias("_ranked"))
        .select("instance_id", F.col("_ranked.function").alias("hotspots"))
    )
    pools = pool.groupBy("instance_id").agg(F.array_sort(F.collect_list(record)).alias("functions"))
    return (
        states.select(*COPIED_WORKLOAD)
        .join(hotspots, "instance_id")
        .join(pools, "instance_id")
        .select(*COPIED_WORKLOAD, "hotspots", "functions", *_top_questions())
    )


def label_counts(dataset: DataFrame, label: str = "label") -> DataFrame:
    """Rows per label; a column of label lists is counted entry by entry."""
    if dataset.schema[label].dataType.typeName() == "array":
        dataset = dataset.select(F.explode(label).alias(label))
    return dataset.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))


def hotspot_summary(dataset: DataFrame) -> DataFrame:
    """Pool and answer size ranges, and how many rows can answer each top-n question."""
    sized = dataset.groupBy("instance_id").agg(
        F.max(F.size("hotspots")).alias("_ranked"), F.sum(F.size("functions")).alias("_pooled")
    )
    return sized.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("_pooled").alias("pool_min"),
        F.max("_pooled").alias("pool_max"),
        F.min("_ranked").cast("long").alias("ranked_min"),
        F.max("_ranked").cast("long").alias("ranked_max"),
        *[F.count_if(F.col("_ranked") >= n).alias(f"top{n}") for n in prompts.TOP_N],
    )


def time_summary(dataset: DataFrame) -> DataFrame:
    """Rows per answer position, with the range of times behind each."""
    position = F.array_position(prompts.bucket_labels("buckets"), F.col("bucket")) - 1
    return dataset.groupBy(position.alias("position")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("workload_time_s").alias("shortest"),
        F.max("workload_time_s").alias("longest"),
    )
