"""Keyed draws: tests, states, instances, mutations, answer buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.functions.keyed import keyed_uniform, weighted_key
from runlens.operators.filters import operator_matches
from runlens.operators.skew import first_row, top_n

REPORTED = ["PASSED", "FAILED", "ERROR"]
REFERENCE_VARIANTS = ["base", "fixed"]
OTHER = "OTHER"


def reported(outcomes: DataFrame) -> DataFrame:
    """Outcomes a dataset may label; skipped tests are not reported."""
    return outcomes.where(F.col("status").isin(REPORTED))


def group_sizes(states: DataFrame) -> DataFrame:
    return states.groupBy("group_id").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.bool_or(F.col("variant") == "base").alias("has_base"),
        F.bool_or(F.col("variant") == "fixed").alias("has_fixed"),
    )


def candidate_counts(outcomes: DataFrame, states: DataFrame) -> DataFrame:
    """Per test the base state of its group passes: who reported it, who passed it, and what the
    reference variants say. One pass over the outcomes; the candidate test is an aggregate, not a join.
    """
    members = states.select("group_id", "instance_id", "variant")
    told = reported(outcomes).join(members, "instance_id")
    counts = told.groupBy("group_id", "test").agg(
        F.count_if(F.col("status") == "PASSED").alias("passed"),
        F.count(F.lit(1)).alias("reported"),
        F.max(F.when(F.col("variant") == "base", F.col("status"))).alias("base_status"),
        F.max(F.when(F.col("variant") == "fixed", F.col("status"))).alias("fixed_status"),
    )
    return counts.where(F.col("base_status") == "PASSED").join(group_sizes(states), "group_id")


def reference_label(variant: str) -> Column:
    """The variant's status, OTHER if it stayed silent, null if the group has no such state."""
    return F.when(F.col(f"has_{variant}"), F.coalesce(f"{variant}_status", F.lit(OTHER)))


def agreement(outcomes: DataFrame, states: DataFrame) -> DataFrame:
    """Whether the group disagrees about each candidate, with draw weight and reference labels.

    disagreed: some state reported it as not passed. agreed: every state passed it. The rest is
    neither, because a state reported nothing. A group holds one state per reference variant.
    """
    kind = (
        F.when(F.col("passed") < F.col("reported"), "disagreed")
        .when(F.col("passed") == F.col("group_size"), "agreed")
        .otherwise("neither")
    )
    return candidate_counts(outcomes, states).select(
        "group_id",
        "test",
        "passed",
        "reported",
        "group_size",
        kind.alias("kind"),
        (1 - F.col("passed") / F.col("group_size")).alias("weight"),
        *[reference_label(variant).alias(f"{variant}_label") for variant in REFERENCE_VARIANTS],
    )


def draw_test(agreed: DataFrame, seed: int = 0) -> DataFrame:
    """With its reference labels, one test per group: weighted among the disagreed, else uniform among the agreed."""
    usable = agreed.where(F.col("kind") != "neither")
    weight = F.when(F.col("kind") == "disagreed", F.col("weight")).otherwise(F.lit(1.0))
    order = [
        F.when(F.col("kind") == "disagreed", 0).otherwise(1),
        weighted_key(seed, weight, "group_id", "test"),
        F.col("test"),
    ]
    labels = [f"{variant}_label" for variant in REFERENCE_VARIANTS]
    return first_row(usable, ["group_id"], order).select("group_id", "test", *labels)


def draw_states(outcomes: DataFrame, states: DataFrame, drawn: DataFrame, n: int = 2, seed: int = 0) -> DataFrame:
    """Up to n states per drawn test: one that passes, one that does not, then any other reporter.

    Reference variants are never drawn. At most n rows per (group, pass flag) survive the first
    ranking, so the second one is small whatever the group size.
    """
    members = states.where(~F.col("variant").isin(REFERENCE_VARIANTS)).select("group_id", "instance_id", "row_index")
    reporters = (
        reported(outcomes)
        .join(members, "instance_id")
        .join(drawn, ["group_id", "test"])
        .withColumn("_passes", (F.col("status") == "PASSED").cast("int"))
        .withColumn("_u", keyed_uniform(seed, "group_id", "instance_id"))
    )
    by_flag = top_n(reporters, ["group_id", "_passes"], [F.col("_u"), F.col("instance_id")], n, "_flag_rank")
    preferred = F.when(F.col("_flag_rank") == 1, 1 - F.col("_passes")).otherwise(2)
    picked = top_n(by_flag, ["group_id"], [preferred, F.col("_u"), F.col("instance_id")], n, "_rank")
    labels = [f"{variant}_label" for variant in REFERENCE_VARIANTS]
    return picked.select("group_id", "test", "instance_id", "row_index", "status", *labels)


def draw_uniform(states: DataFrame, n: int = 2, seed: int = 0) -> DataFrame:
    """Up to n states per group, never a reference variant."""
    pool = states.where(~F.col("variant").isin(REFERENCE_VARIANTS))
    u = keyed_uniform(seed, "group_id", "instance_id")
    return top_n(pool, ["group_id"], [u, F.col("instance_id")], n, "_rank").drop("_rank")


def non_passed_counts(outcomes: DataFrame, states: DataFrame) -> DataFrame:
    """States of the group that do not pass a candidate, silent ones included."""
    return candidate_counts(outcomes, states).select(
        "group_id", "test", (F.col("group_size") - F.col("passed")).alias("non_passed")
    )


def sampling_weights(counts: DataFrame, key: str = "instance_id") -> DataFrame:
    """Draw weight per (key, test): the count, a small epsilon for zero, 1 when nothing is positive."""
    limits = counts.groupBy(key).agg(
        F.min(F.when(F.col("non_passed") > 0, F.col("non_passed"))).alias("_least"),
        F.count_if(F.col("non_passed") == 0).alias("_zeros"),
    )
    weight = (
        F.when(F.col("_least").isNull(), F.lit(1.0))
        .when(F.col("non_passed") > 0, F.col("non_passed").cast("double"))
        .otherwise(F.col("_least") / (F.col("_zeros") + 1))
    )
    return counts.join(limits, key).withColumn("weight", weight).drop("_least", "_zeros")


def draw_tests(outcomes: DataFrame, states: DataFrame, drawn_states: DataFrame, n: int = 100, seed: int = 0) -> DataFrame:
    """Up to n reported candidates per drawn state, weighted by how much of the group fails them."""
    asked = reported(outcomes).join(drawn_states.select("group_id", "instance_id"), "instance_id")
    counted = asked.join(non_passed_counts(outcomes, states), ["group_id", "test"])
    weighted = sampling_weights(counted)
    order = [weighted_key(seed, F.col("weight"), "instance_id", "test"), F.col("test")]
    return top_n(weighted, ["instance_id"], order, n, "_rank").drop("_rank")


def cap_per_key(df: DataFrame, key: str, n: int, order: list[Column]) -> DataFrame:
    """First n rows per key in the given order."""
    return top_n(df, [key], order, n, "_rank").drop("_rank")


# Uniforms fall into this many ranges; a per-range table has a fixed size and may be broadcast.
SLICES = 65_536


def keep_smallest(ids: DataFrame, key: str, seed: int, target: Column) -> DataFrame:
    """The `target` ids with the smallest uniforms, exactly and without a global sort.

    `target` may use the column `total`, the number of ids. Counts per range of the uniform tell
    which ranges are kept whole; only ids of the one range that is cut are ranked.
    """
    drawn = ids.select(key).distinct().withColumn("_u", keyed_uniform(seed, key))
    drawn = drawn.withColumn("_slice", F.floor(F.col("_u") * SLICES))
    counts = drawn.groupBy("_slice").agg(F.count(F.lit(1)).alias("_rows"))
    everything = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    running = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    limits = (
        counts.withColumn("total", F.sum("_rows").over(everything))
        .withColumn("_before", F.sum("_rows").over(running) - F.col("_rows"))
        .withColumn("_keep", F.least("_rows", F.greatest(F.lit(0), target - F.col("_before"))))
        .select("_slice", "_rows", "_keep")
        .where(F.col("_keep") > 0)
    )
    met = drawn.join(F.broadcast(limits), "_slice")
    whole = met.where(F.col("_keep") == F.col("_rows")).select(key)
    rank = F.row_number().over(Window.partitionBy("_slice").orderBy("_u", key))
    cut = met.where(F.col("_keep") < F.col("_rows")).withColumn("_rank", rank)
    return whole.unionByName(cut.where(F.col("_rank") <= F.col("_keep")).select(key))


def sample_instances(df: DataFrame, fraction: float, seed: int = 0, key: str = "instance_id") -> DataFrame:
    """All rows of a fraction of the instances, at least one instance."""
    target = F.greatest(F.lit(1), F.rint(F.col("total") * F.lit(fraction)).cast("long"))
    return df.join(keep_smallest(df, key, seed, target), key, "left_semi")


def shuffle_files(files: DataFrame, keys: list[str], file: str = "file") -> DataFrame:
    """A reproducible order key per file that does not follow names or costs."""
    return files.withColumn("shuffle_key", F.md5(F.concat_ws("|", *[F.col(k) for k in [*keys, file]])))


def sample_mutations(mutations: DataFrame, names: list[str] | None, seed: int | None, limit: int) -> DataFrame:
    """The first `limit` mutations of a seeded order, numbered, with their patch names."""
    if names:
        mutations = mutations.where(operator_matches("operator", names))
    order = [F.col("pos")] if seed is None else [keyed_uniform(seed, "pos"), F.col("pos")]
    drawn = mutations.orderBy(*order).limit(limit)
    numbered = drawn.withColumn("index", F.row_number().over(Window.orderBy(*order)).cast("long"))
    return numbered.withColumn("patch", F.concat(F.lpad(F.col("index").cast("string"), 6, "0"), F.lit(".patch")))


def sample_mutation_per_file(mutations: DataFrame, fraction: float, seed: int = 0) -> DataFrame:
    """One mutation for each of ceil(fraction * files) files, at least one file."""
    target = F.greatest(F.lit(1), F.ceil(F.col("total") * F.lit(fraction)))
    files = keep_smallest(mutations, "file", seed, target)
    pool = mutations.join(files, "file", "left_semi")
    return first_row(pool, ["file"], [keyed_uniform(seed, "file", "number"), F.col("number")])


# The rules of the bucket question.
NICE_EDGES = [
    0.1, 0.2, 0.5, 1, 2, 3, 5, 8, 10, 15, 20, 30, 45, 60, 90, 120, 180, 240, 300, 450,
    600, 900, 1200, 1800, 2700, 3600, 5400, 7200, 10800, 14400,
]
NUM_BUCKETS = 4
BUCKET_STRIDES = [1, 2, 3]
BUCKET_POSITION = (0.25, 0.75)
OPEN_TOP_MARGIN = (1.4, 3.0)


def ladder_table() -> list[list[float]]:
    """Every run of neighbours in the edges and in each thinned-out list of them, sorted."""
    width = NUM_BUCKETS - 1
    thinned = [NICE_EDGES[first::stride] for stride in BUCKET_STRIDES for first in range(stride)]
    runs = [edges[at : at + width] for edges in thinned for at in range(len(edges) - width + 1)]
    return sorted([float(edge) for edge in run] for run in runs)


def _holds(time: Column, dividers: Column, correct: int) -> Column:
    """May the time be the answer bucket `correct` of these dividers?"""
    last = NUM_BUCKETS - 1
    if correct == 0:
        return (time / dividers[0]).between(*BUCKET_POSITION)
    if correct == last:
        return (time / dividers[last - 1]).between(*OPEN_TOP_MARGIN)
    low, high = dividers[correct - 1], dividers[correct]
    return ((time - low) / (high - low)).between(*BUCKET_POSITION)


def _choices(time: Column) -> list[Column]:
    """Per answer bucket, the sorted ladders that allow it; a constant table inside each row."""
    table = F.array(*[F.array(*[F.lit(edge) for edge in run]) for run in ladder_table()])
    return [
        F.when(time > 0, F.filter(table, _ladder_test(time, correct))).otherwise(F.array().cast("array<array<double>>"))
        for correct in range(NUM_BUCKETS)
    ]


def _ladder_test(time: Column, correct: int):
    return lambda dividers: _holds(time, dividers, correct)


def bucket_ladders(times: DataFrame, time: str = "time_s") -> DataFrame:
    """All (dividers, answer bucket) a time may be asked with."""
    options = [
        F.transform(ladders, _as_option(correct)) for correct, ladders in enumerate(_choices(F.col(time)))
    ]
    return times.select("*", F.inline(F.concat(*options)))


def _as_option(correct: int):
    return lambda dividers: F.struct(dividers.alias("dividers"), F.lit(correct).alias("correct"))


def draw_buckets(times: DataFrame, key: str, time: str = "time_s", seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """The answer bucket uniformly over the possible ones, then one of its ladders.

    Everything happens inside the row. Times no ladder holds come back as the second frame.
    """
    offered = times.withColumn("_ladders", F.array(*_choices(F.col(time))))
    possible = F.filter(
        F.transform("_ladders", lambda ladders, at: F.when(F.size(ladders) > 0, at)), lambda at: at.isNotNull()
    )
    offered = offered.withColumn("_possible", possible)
    bucket = F.get(
        F.col("_possible"), F.floor(keyed_uniform(seed, key, F.lit("bucket")) * F.size("_possible")).cast("int")
    )
    drawn = offered.withColumn("correct", bucket)
    ladders = F.get(F.col("_ladders"), F.col("correct"))
    dividers = F.get(ladders, F.floor(keyed_uniform(seed, key, F.lit("ladder")) * F.size(ladders)).cast("int"))
    drawn = drawn.withColumn("dividers", dividers)
    lost = drawn.where(F.size("_possible") == 0).select(*times.columns)
    return drawn.where(F.size("_possible") > 0).drop("_ladders", "_possible"), lost
