import itertools

import pytest
from pyspark.sql import functions as F

from runlens.functions import prompts
from runlens.operators import filters, sampling
from runlens.plans import datasets
from tests.conftest import rows

STATES = "instance_id string, repo string, base_commit string, patch string, container string, command string, command_workload string, group_id string, variant string, row_index long, passed_tests array<string>, failed_tests array<string>, skipped_tests array<string>, errored_tests array<string>, discovery_errors array<string>"


def world(spark):
    """Group a disagrees about t1, group b about nothing, group c spans containers, d has no base."""
    def state(group, variant, index, passed, failed=(), container="img"):
        return (
            f"{group}__{variant}", f"r{group}", "c", None if variant == "base" else "d", container, "run", "run", group, variant,
            index, list(passed), list(failed), [], [], [],
        )

    data = [
        state("a", "base", 0, ["t1", "t2", "t3"]),
        state("a", "fixed", 1, ["t1", "t2"]),
        state("a", "p1", 2, ["t2"], ["t1"]),
        state("a", "p2", 3, ["t1", "t2"]),
        state("a", "p3", 4, ["t1", "t2"]),
        state("b", "base", 5, ["u"]),
        state("b", "p1", 6, ["u"]),
        state("c", "base", 7, ["v"]),
        state("c", "p1", 8, ["v"], container="other"),
        state("d", "p1", 9, ["w"]),
        state("a", "p4", 10, []),
    ]
    known = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "group_id string")
    return spark.createDataFrame(data, STATES), known


def test_single_test_rows_follow_the_rules_for_every_seed_and_partitioning(spark):
    states, known = world(spark)
    for seed in (0, 1):
        built = [
            rows(datasets.build_single_test_status(states.repartition(n), known, 2, seed), "instance_id", "test", "label", "base_label", "fixed_label")
            for n in (1, 5)
        ]
        assert built[0] == built[1]
        of_a = [r for r in built[0] if r[0].startswith("a__")]
        assert {r[1] for r in of_a} == {"t1"}
        assert sorted(r[2] for r in of_a) == ["FAILED", "PASSED"]
        assert all(r[3:] == ("PASSED", "PASSED") for r in of_a)
        assert [r for r in built[0] if r[0].startswith("b__")] == [("b__p1", "u", "PASSED", "PASSED", None)]
        assert not any(r[0].split("__")[1] in ("base", "fixed") for r in built[0])
        assert {r[0][0] for r in built[0]} == {"a", "b"}


def test_chain_reports_the_first_rule_that_dropped_a_row(spark):
    states, known = world(spark)
    kept, dropped = filters.filter_chain(datasets.narrow_states(states), datasets.standard_rules(known))
    assert rows(dropped, "instance_id", "reason") == [
        ("a__p4", "no test outcomes"),
        ("c__base", "container conflict"),
        ("c__p1", "container conflict"),
        ("d__p1", "group has no base state"),
    ]
    assert kept.count() == 7


def test_anchored_rows_have_parallel_lists(spark):
    states, known = world(spark)
    built = datasets.build_test_status_anchored(states, known).collect()
    assert {r["instance_id"].split("__")[0] for r in built} == {"a", "b"}
    for r in built:
        assert r["tests"] == sorted(r["tests"]) and len(r["tests"]) == len(r["labels"])
    assert datasets.label_counts(datasets.build_test_status_anchored(states, known), "labels").count() >= 1


def test_conflicting_states_are_refused(spark):
    states, _ = world(spark)
    twice = states.withColumn("failed_tests", F.when(F.col("instance_id") == "b__p1", F.array(F.lit("u"))).otherwise(F.col("failed_tests")))
    assert rows(datasets.conflicting_states(twice)) == [("b__p1",)]


def test_weights(spark):
    counts = spark.createDataFrame(
        [("s", "a", 4), ("s", "b", 2), ("s", "c", 0), ("s", "d", 0), ("z", "a", 0)], "instance_id string, test string, non_passed long"
    )
    got = {(r["instance_id"], r["test"]): r["weight"] for r in sampling.sampling_weights(counts).collect()}
    assert got == {("s", "a"): 4.0, ("s", "b"): 2.0, ("s", "c"): 2 / 3, ("s", "d"): 2 / 3, ("z", "a"): 1.0}


@pytest.mark.parametrize("fraction", [0.0001, 0.1, 0.5, 1.0])
def test_exact_fraction_without_a_global_sort(spark, fraction, monkeypatch):
    monkeypatch.setattr(sampling, "SLICES", 7)
    ids = spark.range(1000).select(F.col("id").cast("string").alias("instance_id"))
    doubled = ids.unionByName(ids)
    kept = sampling.sample_instances(doubled, fraction)
    assert kept.count() == 2 * max(1, round(1000 * fraction))
    assert kept.distinct().count() == max(1, round(1000 * fraction))
    ranked = ids.orderBy(sampling.keyed_uniform(0, "instance_id")).limit(max(1, round(1000 * fraction)))
    assert rows(kept.distinct()) == rows(ranked)


def test_every_time_lands_in_its_bucket_and_ladders_match_brute_force(spark):
    values = [0.01, 0.07, 0.3, 1.0, 4.2, 17.0, 33.3, 95.0, 700.0, 5000.0, 40000.0, 100000.0, -1.0, 0.0]
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "instance_id string, time_s double")

    def holds(run, correct, t):
        if correct == 0:
            return 0.25 <= t / run[0] <= 0.75
        if correct == 3:
            return 1.4 <= t / run[2] <= 3.0
        return 0.25 <= (t - run[correct - 1]) / (run[correct] - run[correct - 1]) <= 0.75

    edges = sampling.NICE_EDGES
    runs = [[float(edges[s + k * stride]) for k in range(3)] for stride in (1, 2, 3) for s in range(len(edges) - 2 * stride)]
    want = {
        (str(i), tuple(run), c)
        for (i, t), run, c in itertools.product(enumerate(values), runs, range(4))
        if t > 0 and holds(run, c, t)
    }
    got = {(r["instance_id"], tuple(r["dividers"]), r["correct"]) for r in sampling.bucket_ladders(df).collect()}
    assert got == want
    drawn, lost = sampling.draw_buckets(df, "instance_id")
    drawn = drawn.withColumn("labels", prompts.bucket_labels("dividers")).collect()
    assert {r["instance_id"] for r in drawn} | {r["instance_id"] for r in lost.collect()} == {str(i) for i in range(len(values))}
    for r in drawn:
        assert (r["instance_id"], tuple(r["dividers"]), r["correct"]) in want
        assert len(r["labels"]) == 4 and ".0s" not in "".join(r["labels"])


def test_mutation_draws(spark):
    data = [(i, f"f{i % 10}.py", i, "core/AddNot" if i % 2 else "Other") for i in range(100)]
    df = spark.createDataFrame(data, "pos long, file string, number long, operator string")
    picked = sampling.sample_mutations(df, ["AddNot"], 1, 7).collect()
    assert [r["index"] for r in sorted(picked, key=lambda r: r["index"])] == list(range(1, 8))
    assert picked[0]["patch"].endswith(".patch") and all(r["operator"] == "core/AddNot" for r in picked)
    per_file = sampling.sample_mutation_per_file(df, 0.25).collect()
    assert len(per_file) == 3 and len({r["file"] for r in per_file}) == 3
