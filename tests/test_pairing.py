import itertools
import random

from pyspark.sql import functions as F

from runlens.operators import pairing
from tests.conftest import rows

HEAD = "instance_id string, repo string, base_commit string, patch string, container string, command string, metadata string"


def heads(spark, *data):
    return spark.createDataFrame([(i, "r", c, p, k, "run", m) for i, c, p, k, m in data], HEAD)


def test_base_goes_first_and_disagreement_is_an_error(spark):
    df = heads(
        spark,
        ("r__c__zz", "c", "d1", "img", "{}"),
        ("r__c__base", "c", None, "img", "{}"),
        ("r__c__odd", "c", "d2", "other", "{}"),
        ("r__x__lone", "x", "d", "img", "{}"),
        ("r__n__base", None, None, "img", '{"base_id": "n"}'),
        ("r__n__aug", None, "d", "img", '{"base_id": "n"}'),
    )
    pairs, skipped, errors = pairing.pair_states(df)
    assert rows(pairs, "pair_id") == [("r__c__base__::__zz",)]
    assert rows(errors, "instance_id_B", "reason") == [
        ("r__c__odd", "states disagree on container"),
        ("r__n__aug", "no base commit"),
    ]
    assert rows(pairing.groups_without_base(df), "base_ref", "states") == [("x", 1)]
    asked = spark.createDataFrame([("r__c__zz", "r__c__base")], "instance_id_A string, instance_id_B string")
    assert rows(pairing.pair_states(df, asked).pairs, "instance_id_A", "instance_id_B") == [("r__c__base", "r__c__zz")]
    known = spark.createDataFrame([("r__c__base__::__zz",)], "pair_id string")
    again = pairing.pair_states(df, existing=known)
    assert again.pairs.count() == 0
    assert rows(again.skipped, "reason") == [("known pair",)]


def test_missing_base_key_is_named(spark):
    df = heads(spark, ("a__b__base", None, None, "img", "{}"), ("a__b__x", "c", "d", "img", "{}"))
    assert rows(pairing.base_key_errors(df)) == [("a__b__base",)]


def brute(a, b):
    """Status maps with the last list winning, flips over all observed tests, clone by list sets."""
    order = ["PASSED", "FAILED", "SKIPPED", "ERROR"]
    final = [{t: s for s in order for t in side[s]} for side in (a, b)]
    names = set(final[0]) | set(final[1])
    flips = sum(final[0].get(n) != final[1].get(n) for n in names)
    clean = not any(side[s] for side in (a, b) for s in ("FAILED", "ERROR"))
    clone = clean and all(set(a[s]) == set(b[s]) for s in ("PASSED", "SKIPPED"))
    return flips, flips / len(names) if names else 0.0, clone


def test_figures_and_classes_match_brute_force(spark):
    rng = random.Random(5)
    sides = {}
    for n in range(12):
        bad = 0.3 if n % 3 == 2 else 0.0
        lists = {s: [] for s in pairing.BITS}
        for t in range(rng.choice([0, 2, 3])):
            lists["PASSED"].append(f"t{t}")
            if rng.random() < 0.3:
                lists["SKIPPED"].append(f"t{t}")
            if rng.random() < bad:
                lists[rng.choice(["FAILED", "ERROR"])].append(f"t{t}")
        sides["base" if n == 0 else f"a{n:02d}"] = lists
    sides["base"] = {"PASSED": ["t0", "t1"], "FAILED": [], "SKIPPED": [], "ERROR": []}
    df = heads(spark, *[(f"r__c__{s}", "c", None if s == "base" else "d", "img", "{}") for s in sides])
    entries = spark.createDataFrame(
        [(f"r__c__{s}", t, status) for s, lists in sides.items() for status, tests in lists.items() for t in tests],
        "instance_id string, test string, status string",
    )
    errors = spark.createDataFrame([], "instance_id string, module string")
    asked = spark.createDataFrame(
        [(f"r__c__{a}", f"r__c__{b}") for a, b in itertools.combinations(sides, 2)],
        "instance_id_A string, instance_id_B string",
    )
    pairs = pairing.pair_states(df, asked).pairs
    got = {
        (r["instance_id_A"], r["instance_id_B"]): (r["num_flipped_tests"], round(r["flipped_ratio"], 9), r["is_clone"])
        for r in pairing.pair_figures(pairs, entries, errors).collect()
    }
    assert len(got) == 66
    classes = {r["instance_id"]: r["clone_class"] for r in pairing.clone_classes(df, entries, errors).collect()}
    for (a, b), figures in got.items():
        flips, ratio, clone = brute(sides[a.split("__")[2]], sides[b.split("__")[2]])
        assert figures == (flips, round(ratio, 9), clone), (a, b)
        assert clone == (classes[a] is not None and classes[a] == classes[b])
    flipped = pairing.flipped_tests(pairs, entries).where("flipped").groupBy("pair_id").count()
    assert sum(r["count"] for r in flipped.collect()) == sum(f[0] for f in got.values())


def test_record_form_carries_lists_and_an_unhealthy_base_has_no_clones(spark):
    df = heads(spark, ("r__c__base", "c", None, "img", "{}"), ("r__c__x", "c", "d", "img", "{}"))
    lists = spark.createDataFrame(
        [("r__c__base", ["b", "a"], ["f"], [], [], ["m", "m"]), ("r__c__x", ["a", "b"], [], [], [], [])],
        "instance_id string, passed_tests array<string>, failed_tests array<string>, skipped_tests array<string>, errored_tests array<string>, discovery_errors array<string>",
    )
    pair = pairing.pairs_of_lists(df.join(lists, "instance_id")).pairs.collect()[0]
    assert pair["is_clone"] is None and pair["is_base_healthy"] is False
    assert pair["passed_tests_A"] == ["a", "b"] and pair["discovery_errors_A"] == ["m"]
    assert pair["num_flipped_tests"] == 1 and pair["flipped_ratio"] == 1 / 3


def test_sets_of_rows(spark):
    from runlens.operators import sets

    base = spark.createDataFrame([("a", 1, 0), ("b", 1, 1)], "id string, v int, seq int")
    new = spark.createDataFrame([("b", 2, 0), ("c", 2, 1)], "id string, v int, seq int")
    assert rows(sets.upsert(base, new, "id", "seq"), "id", "v", "seq", "inserted") == [
        ("a", 1, 0, False),
        ("b", 2, 1, False),
        ("c", 2, 1, True),
    ]
    assert rows(sets.append_skip(base, new, "id"), "id", "v") == [("a", 1), ("b", 1), ("c", 2)]
    assert rows(sets.append_override(base, new, "id"), "id", "v") == [("a", 1), ("b", 2), ("c", 2)]
    left, unknown = sets.remove(base, new.select("id"), "id")
    assert rows(left, "id") == [("a",)] and rows(unknown) == [("c",)]
    pair = spark.createDataFrame([(["x", "y"], ["y", "z"])], "a array<string>, b array<string>")
    got = sets.set_ops(pair, "a", "b").select(F.col("equal"), "union", "intersection", "difference").first()
    assert tuple(got) == (False, ["x", "y", "z"], ["y"], ["x"])
