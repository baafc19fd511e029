"""Test outcomes: long rows, folded lists, report merging, health."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.schemas import OUTCOME_FIELDS, SEVERITY, STATUS_BY_FIELD


def rank_of(status: Column, ranks: dict[str, int]) -> Column:
    """Position of a status label in a fixed order."""
    return F.coalesce(*[F.when(status == label, F.lit(rank)) for label, rank in ranks.items()])


def label_of(rank: Column, ranks: dict[str, int]) -> Column:
    return F.coalesce(*[F.when(rank == position, F.lit(label)) for label, position in ranks.items()])


def fold_outcomes(outcomes: DataFrame, errors: DataFrame) -> DataFrame:
    """Long outcomes and discovery errors to one row of five sorted lists per state, whatever its size.

    This is the record format of stored states; operators work on the long form.
    """
    long = outcomes.select("instance_id", F.col("test").alias("entry"), "status").unionByName(
        errors.select("instance_id", F.col("module").alias("entry"), F.lit("DISCOVERY").alias("status"))
    )
    statuses = {**STATUS_BY_FIELD, "discovery_errors": "DISCOVERY"}
    lists = [
        F.sort_array(F.collect_list(F.when(F.col("status") == status, F.col("entry")))).alias(field)
        for field, status in statuses.items()
    ]
    return long.groupBy("instance_id").agg(*lists).withColumn("discovery_errors", F.array_distinct("discovery_errors"))


def list_entries(states: DataFrame, *keys: str) -> DataFrame:
    """Every entry of the four status lists as a row, duplicates and conflicts included."""
    tagged = [
        F.transform(
            F.coalesce(F.col(field), F.array().cast("array<string>")),
            _tag(status),
        )
        for field, status in STATUS_BY_FIELD.items()
    ]
    return states.select(*keys, F.inline(F.concat(*tagged)))


def _tag(status: str):
    return lambda test: F.struct(test.alias("test"), F.lit(status).alias("status"))


def unfold_outcomes(states: DataFrame, key: str = "instance_id") -> DataFrame:
    """Lists to long outcomes; the last list in reference order wins for a test named twice.

    Each list drops what a later list names, so the work stays inside the row: no shuffle.
    """
    lists = {field: F.coalesce(F.col(field), F.array().cast("array<string>")) for field in STATUS_BY_FIELD}
    entries = []
    for place, (field, status) in enumerate(STATUS_BY_FIELD.items()):
        later = list(lists.values())[place + 1 :]
        own = F.array_except(lists[field], F.concat(*later)) if later else F.array_distinct(lists[field])
        entries.append(F.transform(own, _tag(status)))
    return states.select(key, F.inline(F.concat(*entries)))


def outcome_conflicts(states: DataFrame, key: str = "instance_id") -> DataFrame:
    """Tests one state reports under two statuses; dataset builds refuse such states."""
    lists = {s: F.coalesce(F.col(f), F.array().cast("array<string>")) for f, s in STATUS_BY_FIELD.items()}
    shared = [F.array_intersect(lists[a], lists[b]) for a, b in combinations(lists, 2)]
    twice = states.select(key, *STATUS_BY_FIELD, F.explode(F.array_distinct(F.concat(*shared))).alias("test"))
    named = [F.when(F.array_contains(items, F.col("test")), F.lit(s)) for s, items in lists.items()]
    return twice.select(key, "test", F.array_sort(F.array_compact(F.array(*named))).alias("statuses"))


def list_conflict_keys(states: DataFrame, key: str = "instance_id") -> DataFrame:
    return outcome_conflicts(states, key).select(key).distinct()


def merge_report_cases(cases: DataFrame) -> DataFrame:
    """Duplicate cases of one report keep the most severe status."""
    return (
        cases.groupBy("report", "test")
        .agg(F.max(rank_of(F.col("status"), SEVERITY)).alias("_rank"))
        .select("report", "test", label_of(F.col("_rank"), SEVERITY).alias("status"))
    )


def report_conflicts(merged: DataFrame, keys: list[str]) -> DataFrame:
    """Tests whose merged status differs between report files."""
    return (
        merged.groupBy(*keys, "test")
        .agg(F.array_sort(F.collect_set("status")).alias("statuses"))
        .where(F.size("statuses") > 1)
    )


def discovery_errors(errors: DataFrame) -> DataFrame:
    """Distinct modules that failed collection, one row each."""
    return errors.select("instance_id", "module").distinct()


def is_filled() -> Column:
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in OUTCOME_FIELDS])


def is_unmeasured() -> Column:
    return reduce(Column.__and__, [F.col(c).isNull() for c in OUTCOME_FIELDS])


def with_fill_status(states: DataFrame) -> DataFrame:
    """Filled when all five lists are present."""
    return states.withColumn("filled", is_filled())


def needs_collect(states: DataFrame) -> DataFrame:
    """Rows with no list at all and no collection error noted in the metadata."""
    noted = F.coalesce(F.get_json_object("metadata", "$.collection_error"), F.lit("false"))
    return states.where(is_unmeasured() & noted.isin("false", "", "0"))


def has_entries(*fields: str) -> Column:
    return reduce(Column.__or__, [F.coalesce(F.size(c) > 0, F.lit(False)) for c in fields])


def is_healthy() -> Column:
    """No failed, errored or discovery entry."""
    return ~has_entries("failed_tests", "errored_tests", "discovery_errors")


def healthy_states(outcomes: DataFrame, errors: DataFrame, states: DataFrame) -> DataFrame:
    """Health per state from long rows, without folding lists."""
    broken = (
        outcomes.where(F.col("status").isin("FAILED", "ERROR"))
        .select("instance_id")
        .unionByName(errors.select("instance_id"))
        .distinct()
        .withColumn("_broken", F.lit(True))
    )
    return states.join(broken, "instance_id", "left").withColumn("healthy", F.col("_broken").isNull()).drop("_broken")


def collect_counts(states: DataFrame) -> DataFrame:
    """Per-row counts of the five lists; null where the list was not measured."""
    return states.select(
        "instance_id", *[F.when(F.col(c).isNotNull(), F.size(c)).cast("long").alias(f"n_{c}") for c in OUTCOME_FIELDS]
    )


def graded_outcomes(reports: DataFrame) -> DataFrame:
    """Category to success and failure lists: a test listed once as a success has passed."""
    entries = reports.select("instance_id", F.explode("categories").alias("category", "lists")).select(
        "instance_id",
        F.inline(
            F.concat(
                F.transform("lists.success", lambda t: F.struct(t.alias("test"), F.lit(1).alias("ok"))),
                F.transform("lists.failure", lambda t: F.struct(t.alias("test"), F.lit(0).alias("ok"))),
            )
        ),
    )
    return (
        entries.groupBy("instance_id", "test")
        .agg(F.max("ok").alias("_ok"))
        .select("instance_id", "test", F.when(F.col("_ok") == 1, "passed").otherwise("failed").alias("outcome"))
    )


# Labels kept as they are.
KNOWN_LABELS = ["passed", "failed", "error", "skipped", "xfail"]


def pre_outcomes(parsed: DataFrame, targets: DataFrame) -> DataFrame:
    """Labels to lower case, unknown ones to error; targets never reported count as failed."""
    plain = F.lower(F.trim("label"))
    label = F.when(plain.isin(KNOWN_LABELS), plain).otherwise("error")
    reported = parsed.select("instance_id", "test", label.alias("outcome"))
    missing = targets.join(parsed, ["instance_id", "test"], "left_anti").select(
        "instance_id", "test", F.lit("failed").alias("outcome")
    )
    return reported.unionByName(missing)


def check_outcomes(before: DataFrame, after: DataFrame, expected: DataFrame) -> DataFrame:
    """Do two states match the expected lists?

    A test fails when it is neither passed nor skipped, so an absent test fails; an empty list
    holds. `expected(instance_id, test, kind)` has kind fail_to_pass or pass_to_pass, and a null
    test for an instance whose lists are empty.
    """

    def flags(outcomes: DataFrame, side: str) -> DataFrame:
        return outcomes.groupBy("instance_id", "test").agg(
            F.bool_or(F.col("status") == "PASSED").alias(f"_passed_{side}"),
            F.bool_or(F.col("status") == "SKIPPED").alias(f"_skipped_{side}"),
        )

    def flag(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(False))

    joined = expected.join(flags(before, "before"), ["instance_id", "test"], "left").join(
        flags(after, "after"), ["instance_id", "test"], "left"
    )
    fails_before = ~flag("_passed_before") & ~flag("_skipped_before")
    named = F.col("test").isNotNull()
    f2p = F.when(named & (F.col("kind") == "fail_to_pass"), fails_before & flag("_passed_after"))
    p2p = F.when(named & (F.col("kind") == "pass_to_pass"), flag("_passed_before") & flag("_passed_after"))
    return joined.groupBy("instance_id").agg(
        F.coalesce(F.bool_and(f2p), F.lit(True)).alias("fail_to_pass_match"),
        F.coalesce(F.bool_and(p2p), F.lit(True)).alias("pass_to_pass_match"),
    )
