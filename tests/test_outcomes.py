from pyspark.sql import functions as F

from runlens.operators import outcomes
from tests.conftest import rows

LISTS = "instance_id string, passed_tests array<string>, failed_tests array<string>, skipped_tests array<string>, errored_tests array<string>, discovery_errors array<string>"


def states(spark, *data):
    return spark.createDataFrame(list(data), LISTS)


def test_last_list_wins_and_conflicts_are_named(spark):
    df = states(spark, ("a", ["t1", "t2", "t2"], ["t1"], ["t3"], ["t3"], []), ("b", None, None, None, None, None))
    assert rows(outcomes.unfold_outcomes(df), "instance_id", "test", "status") == [
        ("a", "t1", "FAILED"),
        ("a", "t2", "PASSED"),
        ("a", "t3", "ERROR"),
    ]
    found = {r["test"]: r["statuses"] for r in outcomes.outcome_conflicts(df).collect()}
    assert found == {"t1": ["FAILED", "PASSED"], "t3": ["ERROR", "SKIPPED"]}


def test_a_state_is_one_row_whatever_its_size(spark):
    long = spark.range(250_000).select(
        F.lit("big").alias("instance_id"), F.concat(F.lit("t"), "id").alias("test"), F.lit("PASSED").alias("status")
    )
    small = spark.createDataFrame([("small", "x", "FAILED")], "instance_id string, test string, status string")
    errors = spark.createDataFrame([("small", "m"), ("small", "m")], "instance_id string, module string")
    folded = outcomes.fold_outcomes(long.unionByName(small), errors)
    assert "part" not in folded.columns
    big = folded.where("instance_id = 'big'").select(F.size("passed_tests"), F.size(F.array_distinct("passed_tests"))).collect()
    assert [tuple(r) for r in big] == [(250_000, 250_000)]
    one = folded.where("instance_id = 'small'").collect()
    assert [(r["failed_tests"], r["passed_tests"], r["discovery_errors"]) for r in one] == [(["x"], [], ["m"])]


def test_filled_and_needs_collect_are_not_complements(spark):
    df = states(
        spark,
        ("filled", [], [], [], [], []),
        ("partial", ["t"], None, None, None, None),
        ("empty", None, None, None, None, None),
        ("noted", None, None, None, None, None),
    ).withColumn("metadata", F.when(F.col("instance_id") == "noted", '{"collection_error": true}').otherwise("{}"))
    assert rows(outcomes.with_fill_status(df), "instance_id", "filled") == [
        ("empty", False),
        ("filled", True),
        ("noted", False),
        ("partial", False),
    ]
    assert rows(outcomes.needs_collect(df), "instance_id") == [("empty",)]


def test_expected_lists_hold_on_empty_and_absent_tests_fail(spark):
    schema = "instance_id string, test string, status string"
    before = spark.createDataFrame([("a", "f", "FAILED"), ("a", "p", "PASSED"), ("c", "s", "SKIPPED")], schema)
    after = spark.createDataFrame([("a", "f", "PASSED"), ("a", "new", "PASSED"), ("a", "p", "PASSED"), ("c", "s", "PASSED")], schema)
    expected = spark.createDataFrame(
        [
            ("a", "f", "fail_to_pass"),
            ("a", "new", "fail_to_pass"),
            ("a", "p", "pass_to_pass"),
            ("b", None, "fail_to_pass"),
            ("c", "s", "fail_to_pass"),
        ],
        "instance_id string, test string, kind string",
    )
    assert rows(outcomes.check_outcomes(before, after, expected)) == [("a", True, True), ("b", True, True), ("c", False, True)]


def test_pre_outcomes_lower_known_labels_and_fail_silent_targets(spark):
    parsed = spark.createDataFrame(
        [("i", "a", " XFAIL "), ("i", "b", "crashed")], "instance_id string, test string, label string"
    )
    targets = spark.createDataFrame([("i", "a"), ("i", "z")], "instance_id string, test string")
    assert rows(outcomes.pre_outcomes(parsed, targets)) == [("i", "a", "xfail"), ("i", "b", "error"), ("i", "z", "failed")]


def test_report_merging_by_severity_and_conflicts(spark):
    cases = spark.createDataFrame(
        [("r1", "t", "PASSED"), ("r1", "t", "ERROR"), ("r2", "t", "PASSED"), ("r2", "u", "SKIPPED")],
        "report string, test string, status string",
    )
    merged = outcomes.merge_report_cases(cases)
    assert rows(merged) == [("r1", "t", "ERROR"), ("r2", "t", "PASSED"), ("r2", "u", "SKIPPED")]
    found = outcomes.report_conflicts(merged, []).collect()
    assert [(r["test"], r["statuses"]) for r in found] == [("t", ["ERROR", "PASSED"])]
